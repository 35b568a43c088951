"""Token ids of whole texts by the tokenizers library, chunk by chunk.

A text is cut where no token of the file's tokenizer can reach across: before
a space that stands between two other characters (byte-level BPE, whose tokens
take a space in front) or at white space (word BPE, which drops it). Equal
chunks have equal ids, so each worker encodes a chunk once and keeps its ids. A
new chunk of plain ASCII is cut further, as the tokenizer itself cuts it before
merging, so that a word is encoded once whatever sign follows it.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from clickpulse.llm.byte_bpe import byte_alphabet
from clickpulse.llm.common import lowered, spread

KEEP = 900_000  # chunks and parts in the tables before they are emptied
KEEP_CHARS = 16  # or so many characters for each
LOT = 512  # words that are encoded together
# the tokenizers' own cutting of a text before merging, for ASCII: words, digits, other signs, white space
_BYTE_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^ \t\n\r\x0b\x0cA-Za-z0-9]+|[ \t\n\r\x0b\x0c]+(?![^ \t\n\r\x0b\x0c])|[ \t\n\r\x0b\x0c]+")
# (words of Latin-1 letters in lower case too)
_WORD_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^ \t\n\r\x0b\x0ca-z0-9ß-öø-ÿ]+")
_OTHER_SPACE = [c for c in map(chr, range(0x3001)) if c.isspace() and c != " "]
_ODD = ["  ", *[c + " " for c in _OTHER_SPACE], *[" " + c for c in _OTHER_SPACE]]
_LETTERS = re.compile("[a-zß-öø-ÿ]+")
_LATIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]+")  # what _WORD_PARTS cuts: no change by NFC, one lower-case letter for each
_GAP = re.compile(r"(?<=\S)(?= \S)")
_NOT_SPACE = re.compile("[\x1c-\x1f]")  # white space to Python alone
_RARE_SPACE = r"[\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_SPACES = re.compile(r"[^\S\x1c-\x1f]+")
# ASCII characters for the bytes of lower-case Latin-1 letters in UTF-8: inside a word, and for its last byte; 0 for other bytes
_WORD_BYTES = sorted({b for x in [*map(chr, range(97, 123)), *map(chr, range(0xDF, 0x100))] for b in x.encode()})
_INNER, _LAST = np.zeros(256, np.uint8), np.zeros(256, np.uint8)
_INNER[_WORD_BYTES] = np.arange(1, len(_WORD_BYTES) + 1)
_LAST[_WORD_BYTES] = np.arange(len(_WORD_BYTES) + 1, 2 * len(_WORD_BYTES) + 1)


def _letter_encoding(model: dict, vocabulary: dict[str, int]):
    """(an encoding of words of lower-case Latin-1 letters by rank, the tokenizer's id of each of its ids, whether that ends a word).

    Each byte of a word is written as one ASCII character, another one for its
    last byte, which stands for the byte with the mark of a word's end; merges
    then go by rank as in the file (``_INNER``, ``_LAST``). ``tiktoken`` does
    them several times as fast. None where the file is not of this kind.
    """
    import tiktoken

    if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or model.get("continuing_subword_prefix"):
        return None, None, None

    def recoded(token: str) -> bytes | None:
        body = token.removesuffix("</w>")
        raw = bytes(alphabet.get(x, 0) for x in body)
        if not raw or not all(_INNER[b] for b in raw):
            return None
        inner = bytes(_INNER[b] for b in raw)
        return inner if body == token else inner[:-1] + bytes([_LAST[raw[-1]]])

    alphabet = byte_alphabet()
    names = [x + end for end in ("", "</w>") for x, b in alphabet.items() if _INNER[b]]
    names += ["".join(m) for m in model["merges"]]
    ranks: dict[bytes, int] = {}
    ids, ends = [], []
    for name in names:
        code = recoded(name)
        if code is not None and code not in ranks:
            if name not in vocabulary:
                return None, None, None
            ranks[code] = len(ids)
            ids.append(vocabulary[name])
            ends.append(name.endswith("</w>"))
    last = "".join(f"\\x{x:02x}" for x in sorted({int(_LAST[b]) for b in range(256) if _INNER[b]}))
    return tiktoken.Encoding("words", pat_str=f"[^{last}]*[{last}]", mergeable_ranks=ranks, special_tokens={}), np.array(ids, "<u4"), np.array(ends, bool)


class ChunkedTokenizer:
    """``ids(texts)``: for each text its ids as little-endian unsigned 32-bit numbers."""

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        self.size = self.tokenizer.get_vocab_size()
        self.drops_space = spec["model"].get("end_of_word_suffix") == "</w>"
        vocabulary = self.tokenizer.get_vocab()
        self.last = bytearray(max(vocabulary.values()) + 1)  # whether an id ends a word
        for token, i in vocabulary.items():
            self.last[i] = self.drops_space and token.endswith("</w>")
        self.letters, self.letter_ids, self.letter_ends = _letter_encoding(spec["model"], vocabulary) if self.drops_space else (None, None, None)
        self.table: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {}
        self.held = 0

    def chunks(self, text: str) -> list[str]:
        if self.drops_space:
            return [c for c in _SPACES.split(text) if c] if _NOT_SPACE.search(text) else text.split()
        if any(x in text for x in _ODD) or text[:1] == " " or text[-1:] == " " or "\0" in text:
            return [c for c in _GAP.split(text) if c]
        return text.replace(" ", "\0 ").split("\0") if text else []

    def ids(self, texts: list[str]) -> list[bytes]:
        ids, at = self.column_ids(pa.array(texts, pa.large_string()))
        return [ids[a:b].tobytes() for a, b in zip(at, at[1:], strict=False)]

    def column_ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, offsets of each text's). Null counts as empty."""
        column = column.cast(pa.large_string()).fill_null("")
        if self.drops_space and not pc.any(pc.match_substring(column, "<|")).as_py():
            column = lowered(column)  # as the tokenizer does, but for strings of special tokens
        simple = self.drops_space and not pc.any(pc.match_substring_regex(column, _RARE_SPACE)).as_py()
        if simple:
            for space in "\n\t\r":
                column = pc.replace_substring(column, space, " ")
            parts = pc.split_pattern(column, " ")  # empty chunks have no ids
            chunks = parts.flatten()
            at = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False), dtype=np.int64)])
        else:
            cuts = [self.chunks(t) for t in column.to_pylist()]
            chunks = pa.array([x for c in cuts for x in c], pa.large_string())
            at = np.concatenate([[0], np.cumsum([len(c) for c in cuts], dtype=np.int64)])
        coded = chunks.dictionary_encode()
        return spread(self._values(coded.dictionary.to_pylist()), "<u4", coded.indices.to_numpy(), at)

    def _values(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks."""
        table, known = self.table, self.parts
        fresh = [c for c in chunks if c not in table]
        words = [c for c in fresh if _LETTERS.fullmatch(c)] if self.letters else []
        table.update(zip(words, self._words(words), strict=True))
        rest = [c for c in fresh if c not in table] if words else fresh
        cut = [self._cut(c) for c in rest]
        new = {p for c in cut for p in c if p not in table and p not in known}
        words = [p for p in new if _LETTERS.fullmatch(p)] if self.letters else []
        spelt = dict(zip(words, self._words(words), strict=True))
        new = [p for p in new if p not in spelt]
        for lo in range(0, len(new), 8192):
            part = new[lo : lo + 8192]
            known.update(zip(part, self._encoded(part), strict=True))
        made = [b"".join([known[p] if p in known else spelt[p] if p in spelt else table[p] for p in parts]) for parts in cut]
        table.update(zip(rest, made, strict=True))
        out = [table[c] for c in chunks]
        self.held += sum(map(len, fresh)) + sum(map(len, new))
        if len(table) + len(known) > KEEP or self.held > KEEP_CHARS * KEEP:
            table.clear()
            table[""] = b""
            known.clear()
            self.held = 0
        return out

    def _words(self, words: list[str]) -> list[bytes]:
        """Ids of words of lower-case Latin-1 letters: merged by rank, all in one text."""
        if not words:
            return []
        raw = np.frombuffer("\n".join([*words, ""]).encode(), np.uint8)
        ends_at = np.flatnonzero(raw == 10)
        text = _INNER[raw]
        text[ends_at - 1] = _LAST[raw[ends_at - 1]]
        found = np.array(self.letters.encode_ordinary(np.delete(text, ends_at).tobytes().decode("ascii")), np.int64)
        raw, ends = self.letter_ids[found].tobytes(), (4 * (np.flatnonzero(self.letter_ends[found]) + 1)).tolist()
        return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def _encoded(self, parts: list[str]) -> list[bytes]:
        """Ids of each part. Single words go many at a time: each ends with an id that ends a word."""
        words = [p for p in parts if p.isascii() and "<|" not in p] if self.drops_space else []
        found: dict[str, bytes] = {}
        lots = [words[at : at + LOT] for at in range(0, len(words), LOT)]
        for lot, got in zip(lots, self.tokenizer.encode_batch_fast([" ".join(x) for x in lots], add_special_tokens=False), strict=True):
            ids = array("I", got.ids)
            ends = [i + 1 for i, x in enumerate(ids) if self.last[x]]
            if len(ends) == len(lot) and ends[-1] == len(ids):
                raw = ids.tobytes()
                found.update((w, raw[4 * a : 4 * b]) for w, a, b in zip(lot, [0, *ends], ends, strict=False))
        rest = [p for p in parts if p not in found]
        found.update((p, array("I", e.ids).tobytes()) for p, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True))
        return [found[p] for p in parts]

    def _cut(self, chunk: str) -> list[str]:
        if "<|" in chunk:
            return [chunk]
        if self.drops_space:
            return _WORD_PARTS.findall(chunk.lower()) if _LATIN.fullmatch(chunk) else [chunk]
        return _BYTE_PARTS.findall(chunk) if chunk.isascii() else [chunk]


_LOADED: dict[str, ChunkedTokenizer] = {}


def chunked(path: str) -> ChunkedTokenizer:
    """The tokenizer, loaded once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = ChunkedTokenizer(path)
    return _LOADED[path]
