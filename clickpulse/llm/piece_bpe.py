"""Merge-type (BPE) encoding over a SentencePiece model, exact and in one pass.

Two ways to the library's own result, both on an Aho-Corasick automaton of the
pieces:

* ``encode`` takes the longest piece at each position and backtracks where a
  piece does not fit its left neighbour; a bitfield keeps the positions from
  which no encoding exists, so none is tried twice.
* ``prefix_counts`` fills, for every prefix, the one last piece that fits and
  the number of tokens, by dynamic programming.

Two neighbours fit if merging their joined text again gives just these two.
A sequence whose neighbours all fit is the one that merging gives.

The text is handled in units that no piece crosses (a run of the space mark and
what follows it), and each unit's result is kept in a bounded table.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MARK = "▁"
KEEP = 1_000_000  # units in the table before it is emptied
KEEP_PAIRS = 1_000_000
KEEP_CHARS = 64  # longer units are not kept
_PARTS = re.compile(rf"{MARK}*[^\W\d_²³¹]+|[\W\d_²³¹]+")  # letters, with space marks in front, and what is between them
_LETTER = re.compile(r"[^\W\d_²³¹]")
ODD = 1 << 24  # and a character's number: its code where the model has no piece for it
NO_MATCH = (-2, (1, -1))


class PieceModel:
    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.plain: list[str | None] = []  # an id's text; None for bytes, controls and the unknown id
        for i in range(sp.get_piece_size()):
            self.plain.append(None if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) else sp.id_to_piece(i).replace(MARK, " "))
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i):
                continue
            self.ids[sp.id_to_piece(i)] = i
            self.score[sp.id_to_piece(i)] = sp.get_score(i)
        self.size = sp.get_piece_size()
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.fallback = all(sp.is_byte(i) for i in self.bytes)
        self.unknown, self.end = sp.unk_id(), sp.eos_id()
        self.automaton = ahocorasick.Automaton()
        for p in self.ids:
            self.automaton.add_word(p, len(p))
        self.automaton.make_automaton()
        self.splits = not any(MARK in p.lstrip(MARK) for p in self.ids)
        letter = {c: bool(_LETTER.match(c)) for p in self.ids for c in p}
        self.parted = not any(MARK not in (a, b) and letter[a] != letter[b] for p in self.ids for a, b in zip(p, p[1:], strict=False))
        self.numbered = ahocorasick.Automaton()  # piece -> (size, id)
        for p, i in self.ids.items():
            self.numbered.add_word(p, (len(p), i))
        self.numbered.make_automaton()
        self.names = {i: p for p, i in self.ids.items()}
        self.letters = frozenset(p for p in self.ids if len(p) == 1)
        self.odd = re.compile(f"([^{re.escape(''.join(sorted(self.letters)))}])")  # a character that no piece holds
        self._id_fits: dict[int, bool] = {}
        self._fits: dict[tuple[str, str], bool] = {}
        self._shorter: dict[int, tuple[int, int]] = {}
        self._units: dict[str, object] = {}

    def normalize(self, text: str) -> str:
        return self.sp.normalize(text) if text else ""

    def units(self, normal: str) -> list[str]:
        """The normalized text cut before each run of space marks."""
        if not self.splits:
            return [normal] if normal else []
        parts = normal.split(MARK)
        if parts[0] == "" and "" not in parts[1:]:
            return [MARK + p for p in parts[1:]]
        out, run = [parts[0]] if parts[0] else [], ""
        for p in parts[1:]:
            run += MARK
            if p:
                out.append(run + p)
                run = ""
        return out + [run] if run else out

    def parts(self, unit: str) -> list[str]:
        """A unit cut where letters meet other signs, if no piece holds both: ids and text are those of the parts in a row."""
        return _PARTS.findall(unit) if self.parted and self.splits else [unit]

    def fine_units(self, normals: list[str]) -> tuple[pa.Array, np.ndarray]:
        """(units of all normalized texts in a row, offsets of each text's), cut further around each character that no piece holds."""
        rows = [self._marked(n) for n in normals]
        parts = pc.split_pattern(pa.array(rows, pa.large_string()), "\0")
        row = np.repeat(np.arange(len(rows)), pc.list_value_length(parts).to_numpy(zero_copy_only=False))
        units = parts.flatten()
        full = pc.not_equal(units, "")
        return units.filter(full), np.searchsorted(row[full.to_numpy(zero_copy_only=False)], np.arange(len(rows) + 1))

    def _marked(self, normal: str) -> str:
        """The normalized text with a zero character wherever units meet (a zero of its own is a unit, written as U+0001)."""
        if "\0" in normal or "\1" in normal or not self.splits:
            odd = [part for i, part in enumerate(self.odd.split(normal)) if part]
            return "\0".join("\1" if x == "\0" else x for part in odd for x in ([part] if part in ("\0", "\1") else self.units(part)))
        if not self.letters.issuperset(normal):
            normal = self.odd.sub("\0\\1\0", normal) if not self.letters.issuperset(normal.replace("\n", "")) else normal.replace("\n", "\0\n\0")
        if MARK + MARK in normal:
            return "\0".join(u for part in normal.split("\0") for u in self.units(part))
        return normal.replace(MARK, "\0" + MARK)

    def merged(self, text: str) -> list[str]:
        """Pieces by merging: the best-scored neighbours first, the leftmost of equals."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fit(self, left: str, right: str) -> bool:
        known = self._fits.get((left, right))
        if known is None:
            if len(self._fits) > KEEP_PAIRS:
                self._fits.clear()
            known = self._fits[left, right] = self.merged(left + right) == [left, right]
        return known

    def _name(self, code: int) -> str:
        return self.names[code] if code < ODD else chr(code - ODD)

    def _fit(self, pair: int) -> bool:
        """Whether two neighbours fit, given as ``left << 32 | right``."""
        known = self._id_fits.get(pair)
        if known is None:
            if len(self._id_fits) > KEEP_PAIRS:
                self._id_fits.clear()
            left, right = self._name(pair >> 32), self._name(pair & 0xFFFFFFFF)
            known = self._id_fits[pair] = self.merged(left + right) == [left, right]
        return known

    def _shorter_of(self, code: int) -> tuple[int, int]:
        """(size, code) of the next shorter piece that begins this one (a single character always counts); size 0 if none."""
        found = self._shorter.get(code)
        if found is None:
            piece = self._name(code)
            n = len(piece) - 1
            while n > 1 and piece[:n] not in self.ids:
                n -= 1
            found = self._shorter[code] = (n, self.ids.get(piece[:n], ODD + ord(piece[0])) if n else -1)
        return found

    def codes(self, unit: str) -> list[int]:
        """The ids of the unit's pieces by backtracking; ``ODD`` and its number for a character that is no piece."""
        n, fits, fit, shorter = len(unit), self._id_fits.get, self._fit, self._shorter_of
        failed = 0  # bit p: nothing encodes the unit from p on
        out: list[int] = []
        sizes: list[int] = []
        # leftmost-longest matches run on by themselves until a shorter piece is taken
        matches, end, at = self.numbered.iter_long(unit), -1, 0
        size, code, fresh = 0, -1, True
        while at < n:
            if fresh:
                if end + 1 != at:
                    matches = self.numbered.iter_long(unit, at)
                end, (size, code) = next(matches, NO_MATCH)
                if end - size + 1 != at:  # no piece begins here: the character alone
                    end, size, code = -2, 1, ODD + ord(unit[at])
                fresh = False
            while size:
                if not (failed and failed >> (at + size) & 1):
                    if not out:
                        break
                    pair = out[-1] << 32 | code
                    good = fits(pair)
                    if good is None:
                        good = fit(pair)
                    if good:
                        break
                size, code = shorter(code)
            if size:
                out.append(code)
                sizes.append(size)
                at += size
                fresh = True
            else:
                failed |= 1 << at
                if not out:
                    raise ValueError(f"no encoding of {unit!r}")
                at -= sizes.pop()
                size, code = shorter(out.pop())
                end = -2
        return out

    def encode(self, unit: str) -> list[str]:
        """The unit's pieces (a single character may be none of the model's) by backtracking."""
        return [self._name(c) for c in self.codes(unit)]

    def encode_ids(self, unit: str) -> list[int]:
        """The unit's ids by backtracking."""
        codes = self.codes(unit)
        return codes if max(codes, default=0) < ODD else self.piece_ids([self._name(c) for c in codes])

    def prefix_counts(self, unit: str) -> list[int]:
        """Token counts of the unit's prefixes of 0, 1, 2, ... characters."""
        ends: list[list[int]] = [[] for _ in unit]
        for end, size in self.automaton.iter(unit):
            ends[end].append(size)
        counts, last, fits = [0], [""], self._fits.get
        for i, sizes in enumerate(ends, 1):
            if not sizes or sizes[-1] != 1:  # the character alone, if it is no piece
                sizes.append(1)
            for size in sizes:
                before = i - size
                piece = unit[before:i]
                if before:
                    good = fits((last[before], piece))
                    if good is None:
                        good = self.fit(last[before], piece)
                    if not good:
                        continue
                last.append(piece)
                counts.append(counts[before] + (1 if size > 1 else self.width(piece)))
                break
            else:
                raise ValueError(f"no encoding of {unit[:i]!r}")
        return counts

    def prefix_steps(self, units: list[str]) -> list[list[int]]:
        """For each unit, by how much its token count changes with each character.

        The units are those of ``fine_units``, sorted: what the dynamic programme
        knows of a prefix that a unit shares with the one before is used again.
        """
        out, before_unit, counts, last, fits = [], "", [0], [0], self._id_fits.get
        for unit in units:
            if len(unit) == 1 and unit not in self.letters:
                out.append([self.width(unit)])
                continue
            shared = 0
            for a, b in zip(before_unit, unit, strict=False):
                if a != b:
                    break
                shared += 1
            before_unit = unit
            del counts[shared + 1 :], last[shared + 1 :]
            known = shared  # characters whose prefix is done
            # every character is a piece, so a piece that fits ends at each: the first found, longest first
            for end, (size, piece) in self.numbered.iter(unit):
                if end < known:
                    continue
                start = end + 1 - size
                if start:
                    pair = last[start] << 32 | piece
                    good = fits(pair)
                    if good is None:
                        good = self._fit(pair)
                    if not good:
                        continue
                counts.append(counts[start] + 1)
                last.append(piece)
                known += 1
            if known != len(unit):
                raise ValueError(f"no encoding of a prefix of {unit!r}")
            out.append([b - a for a, b in zip(counts, counts[1:], strict=False)])
        return out

    def width(self, piece: str) -> int:
        return 1 if piece in self.ids or not self.fallback else len(piece.encode())

    def piece_ids(self, pieces: list[str]) -> list[int]:
        found = list(map(self.ids.get, pieces))
        if None not in found:
            return found
        out: list[int] = []
        for p in pieces:
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
            elif self.fallback:
                out += [self.bytes[b] for b in p.encode()]
            else:
                out.append(self.unknown)
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of the ids: space marks as spaces, byte pieces joined, without the space put in front."""
        plain = [self.plain[i] for i in ids]
        if None not in plain:
            text = "".join(plain)
            return text[1:] if text.startswith(" ") else text
        sp, out, run = self.sp, [], bytearray()
        for i in ids:
            if (plain := self.plain[i]) is not None:
                if run:
                    out.append(run.decode("utf-8", "replace"))
                    run = bytearray()
                out.append(plain)
                continue
            if sp.is_byte(i):
                run.append(int(sp.id_to_piece(i)[3:5], 16))
                continue
            if run:
                out.append(run.decode("utf-8", "replace"))
                run = bytearray()
            if sp.is_unknown(i):
                out.append(" ⁇ ")
        if run:
            out.append(run.decode("utf-8", "replace"))
        text = "".join(out)
        return text[1:] if text.startswith(" ") else text

    def kept(self, make):
        """A function from units to their ``make(unit)`` that remembers short units."""
        table: dict[str, object] = {}

        def look(units: list[str]) -> list:
            found = list(map(table.get, units))
            if None in found:
                own: dict[str, object] = {}  # of this call's new units
                for i, unit in enumerate(units):
                    if found[i] is None:
                        if unit not in own:
                            own[unit] = make(unit)
                        found[i] = own[unit]
                if len(table) + len(own) > KEEP:
                    table.clear()
                table.update((u, value) for u, value in own.items() if len(u) <= KEEP_CHARS)
            return found

        return look


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """The model, loaded once in each Python worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]
