"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter

import xxhash


def words(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    out, word = [], ""
    for c in lower:
        if c == " " or "\t" <= c <= "\r":
            out, word = out + [word] * bool(word), ""
        else:
            word += c
    return out + [word] * bool(word)


def simhash(text: str | None, size: int) -> int:
    w = words(text)
    shingles = [" ".join(w[i:i + size]) for i in range(len(w) - size + 1)] if len(w) > size else [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows: list[tuple], near: int) -> list[tuple]:
    """``(id, print, smallest id reachable)`` of rows ``(id, print)``."""
    prints = sorted({p for _, p in rows})
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= near:
                root[find(a)] = find(b)
    least: dict = {}
    for d, p in rows:
        if d is not None:
            least[find(p)] = min(d, least.get(find(p), d))
    return [(d, p, least.get(find(p))) for d, p in rows]


def without_repeats(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        spans = sum(1 for i in range(len(d)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def without_passages(texts: list[str | None], length: int, least_words: int, whole: int) -> list[str | None]:
    """Each text without its stretches of repeated ``length``-byte strings that hold so many whole words or ``whole`` bytes; None: all gone."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        starts = [i for i in range(len(d) - length + 1) if seen[d[i:i + length]] > 1]
        gone = bytearray(len(d))
        for k, i in enumerate(starts):
            if k and starts[k - 1] == i - 1:
                continue
            last = k
            while last + 1 < len(starts) and starts[last + 1] == starts[last] + 1:
                last += 1
            a, b = i, starts[last] + length
            spaces = b" \t\n\v\f\r"
            at = [x for x in range(a, b) if d[x] not in spaces and (x == 0 or d[x - 1] in spaces)]
            ends = [next((y for y in range(x, len(d)) if d[y] in spaces), len(d)) for x in at]
            if b - a >= whole or sum(y <= b for y in ends) >= least_words:
                gone[a:b] = b"\1" * (b - a)
        kept = bytes(x for x, g in zip(d, gone) if not g)
        out.append(kept.decode("utf-8", "ignore") if kept or not d else None)
    return out


def crc(doc_id) -> int:
    return zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
