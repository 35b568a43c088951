"""Ids of a byte-level BPE file, by the faster of two libraries that give the same ids.

``tiktoken`` merges by rank and is several times as fast as ``tokenizers``. It
is built from the tokenizer file itself, where that is plain byte-level BPE:
no normalizer, the usual cutting pattern, and ids that grow in the order of the
merges. It is used for texts of the Latin blocks, whose character classes
no version of Unicode will change; all other texts go to ``tokenizers``.
"""

from __future__ import annotations

import json
import re
from functools import cached_property

# fixed value: the pattern by which byte-level BPE cuts a text before merging
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SURE = re.compile("[\t\n\r\x20-\x7e\xa1-\u024f]*")


def byte_alphabet() -> dict[str, int]:
    """Byte-level BPE's characters for bytes: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + i)] = b
    return out


class ByteTokenizer:
    """``encode(texts)``: ids of each text; strings of special tokens inside texts are plain text if ``plain_special``."""

    def __init__(self, path: str, plain_special: bool = True):
        self.path, self.plain_special = path, plain_special
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = {t["id"]: t["content"] for t in spec.get("added_tokens") or []}
        self.special = [] if plain_special else list(self.added.values())
        self.vocabulary: dict[str, int] = {**spec["model"]["vocab"], **{t: i for i, t in self.added.items()}}
        #: whether a text can be cut before a space between two other characters
        self.cuts = (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel" and spec["pre_tokenizer"].get("use_regex", True) and not spec.get("normalizer")
        self.fast = self._fast(spec)

    @cached_property
    def slow(self):
        """The other library's tokenizer: each worker holds it from the first text that asks for it."""
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.path)
        out.encode_special_tokens = self.plain_special
        return out

    def _fast(self, spec: dict):
        import tiktoken

        model = spec["model"]
        if not self.cuts or spec["pre_tokenizer"].get("add_prefix_space") or model["type"] != "BPE" or model.get("ignore_merges") or model.get("dropout"):
            return None
        if any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")):
            return None
        alphabet = byte_alphabet()
        made = [self.vocabulary["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        single = [i for t, i in self.vocabulary.items() if len(t) == 1]
        if made != sorted(set(made)) or len(single) != 256 or max(single) >= min(made, default=1 << 32):
            return None
        ranks = {bytes(alphabet[c] for c in t): i for t, i in self.vocabulary.items() if i not in self.added}
        if len(ranks) != len(made) + 256:
            return None
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def sure(self, text: str) -> bool:
        """Whether both libraries are sure to agree on a text."""
        return self.fast is not None and _SURE.fullmatch(text) is not None and not any(s in text for s in self.special)

    def encode(self, texts: list[str]) -> list[list[int]]:
        quick = [self.sure(t) for t in texts]
        rest = iter([])
        if not all(quick):
            rest = iter(self.slow.encode_batch_fast([t for t, q in zip(texts, quick, strict=True) if not q], add_special_tokens=False))
        return [self.fast.encode_ordinary(t) if q else next(rest).ids for t, q in zip(texts, quick, strict=True)]

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id."""
        alphabet = byte_alphabet()
        out = [b""] * (max(self.vocabulary.values()) + 1)
        for t, i in self.vocabulary.items():
            out[i] = t.encode() if i in self.added else bytes(alphabet[c] for c in t)
        return out


_LOADED: dict[str, ByteTokenizer] = {}


def byte_tokenizer(path: str) -> ByteTokenizer:
    """The tokenizer as the library reads it (special strings in texts are special), loaded once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = ByteTokenizer(path, plain_special=False)
    return _LOADED[path]
