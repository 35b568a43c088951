"""Plain versions of the registered queries, one row at a time, for comparison."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ids_bytes(ids) -> bytes:
    return np.array(ids, "<u4").tobytes()


def quality_counts(text):
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    marked = [False] * len(words)
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            marked[i : i + 3] = [True] * 3
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), sum(marked)


def shingles(text, k: int) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) or frozenset([tuple(words)])


def jaccard_components(rows, k: int, num: int, den: int):
    """For each row (size of its set, least id of its component), every pair of rows compared."""
    sets = [shingles(r["text"], k) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b) if a and b and rows[i]["doc_id"] is not None and rows[j]["doc_id"] is not None else 0
            if common and den * common >= num * (len(a) + len(b) - common):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    least: dict = {}
    for i, r in enumerate(rows):
        if r["doc_id"] is not None:
            least[find(i)] = min(least.get(find(i), math.inf), r["doc_id"])
    return [(len(s), least.get(find(i)) if r["doc_id"] is not None else None) for i, (s, r) in enumerate(zip(sets, rows, strict=True))]


def unigram_scores(rows):
    counts, tokens = Counter(), []
    held = [zlib.crc32(b"" if r["doc_id"] is None else str(r["doc_id"]).encode()) % 10 == 0 for r in rows]
    for r, h in zip(rows, held, strict=True):
        tokens.append([*WORD.findall((r["text"] or "").translate(LOWER)), None])
        if not h:
            counts.update(tokens[-1])
    total, norm = sum(counts.values()), sum(counts.values()) + 0.1 * (len(counts) + 1)
    return [(h, len(t), sum(counts[x] > 0 for x in t), total, sum(math.log10((counts[x] + 0.1) / norm) for x in t)) for h, t in zip(held, tokens, strict=True)]


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- sentence spans, word by word ----------------------------------------------

FULL = (1 << 64) - 1


def mixed(x: int) -> int:
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & FULL
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & FULL
    return x ^ x >> 31


def word_hash(word: str) -> int:
    total = 0
    for i, b in enumerate(word.translate(LOWER).encode()):
        total += (b + 1) * (mixed((i + 1) * 0x9E3779B97F4A7C15 & FULL) | 1)
    return mixed(total & FULL)


def pieces(text: str) -> list[tuple[int, int, tuple]]:
    """(first byte, end, words) of each sentence, long ones cut further."""
    found = list(WORD.finditer(text))
    groups: list[list] = []
    for i, m in enumerate(found):
        if i and not (found[i - 1].group()[-1] in ".!?" or "\n" in text[found[i - 1].end() : m.start()]):
            groups[-1].append(m)
        else:
            groups.append([m])
    cut = []
    for g in groups:
        if len(g) > 15:
            names = [word_hash(m.group()) for m in g]
            marks = [mixed((a * 0x9E3779B97F4A7C15 + b) & FULL) for a, b in zip(names, names[1:], strict=False)]
            places = sorted({min(range(i, i + 10), key=lambda k: (marks[k], -k)) + 1 for i in range(len(marks) - 9)})
            cut += [g[a:b] for a, b in zip([0, *places], [*places, len(g)], strict=True)]
        else:
            cut.append(g)
    at = [0, *(len(text[: g[0].start()].encode()) for g in cut[1:]), len(text.encode())]
    return [(at[i], at[i + 1], tuple(m.group().translate(LOWER) for m in g)) for i, g in enumerate(cut)]


def shortest_runs(sizes: list[int], least: int) -> list[tuple[int, int]]:
    out = set()
    for i in range(len(sizes)):
        for way in (range(i + 1, len(sizes) + 1), range(i, -1, -1)):
            for j in way:
                a, b = (i, j) if way.step > 0 else (j, i + 1)
                if sum(sizes[a:b]) >= least:
                    out.add((a, b))
                    break
    return sorted(out)


def without_repeats(rows: list[tuple], least: int) -> list[tuple]:
    """(text, dropped sentences) of each row (doc_id, text); of equal ids the order of unlike texts is left to their first span."""
    cut = {t: pieces(t) for _, t in rows if t}
    runs = {t: shortest_runs([len(p[2]) for p in c], least) for t, c in cut.items()}
    words = {t: {r: tuple(w for p in cut[t][r[0] : r[1]] for w in p[2]) for r in runs[t]} for t in cut}
    first: dict = {}
    for doc, t in sorted({(d, t) for d, t in rows if d is not None and t}):
        for r in runs[t]:
            first.setdefault(words[t][r], (doc, t, r[0]))
    out = []
    for doc, t in rows:
        gone = set()
        if doc is not None and t:
            for r in runs[t]:
                if first[words[t][r]] != (doc, t, r[0]):
                    gone.update(range(*r))
        raw = (t or "").encode()
        out.append((t if not gone else b"".join(raw[a:b] for i, (a, b, _) in enumerate(cut[t]) if i not in gone).decode(), len(gone)))
    return out
