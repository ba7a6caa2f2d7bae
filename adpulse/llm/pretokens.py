"""Pre-tokens of byte-level tokenizers, and what is remembered about them.

Such a tokenizer cuts a text before each single space that stands between two characters that are no white
space, whatever else it does: its pattern lets a space start a piece, and only runs of white space hold one
inside. So the ids of a text are those of the parts between these cuts, one after the other. A special
token's string has no space inside and stays within a part.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache
from itertools import islice
from struct import pack

# A worker remembers the ids of so many pre-tokens, the frequent ones first met; this changes no result.
CACHE = 1_000_000
# So many pre-tokens are encoded at a time: the tokenizer's answer holds about 0.7 KB of each, its ids a few bytes.
AT_ONCE = 4_096

_CUT = re.compile(r"(?<=\S) (?=\S)")


def pretokens(text: str) -> list[str]:
    """The parts of a text, each after the first with its space. They join to the text."""
    if not text:
        return []
    parts = text.split(" ")
    # white space next to a space, or at an end, needs the pattern
    if not all(parts) or " ".join(map(str.strip, parts)) != text:
        parts = _CUT.split(text)
    first, *rest = parts
    return [first, *map(" ".__add__, rest)]


@lru_cache(2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(2)
def _cache(path: str) -> dict[str, bytes]:
    return {}


def encode(texts: list[str], path: str, most: int = CACHE) -> list[bytes]:
    """Ids of each text, without added special tokens, as little-endian unsigned 32-bit numbers.

    No pre-token is added to the remembered ones once there are ``most``.
    """
    cache, missing = _cache(path), {}
    known = cache.get
    out, gaps = [], []
    for text in texts:
        names = pretokens(text)
        found = list(map(known, names))
        try:  # one look-up each: to join says whether all are known
            out.append(b"".join(found))
        except TypeError:
            at = [k for k, f in enumerate(found) if f is None]
            missing.update((names[k], None) for k in at)
            gaps.append((len(out), names, found, at))
            out.append(None)
    unknown = list(missing)
    for at in range(0, len(unknown), AT_ONCE):
        few = unknown[at:at + AT_ONCE]
        for name, e in zip(few, tokenizer(path).encode_batch_fast(few, add_special_tokens=False)):
            ids = e.ids
            missing[name] = pack(f"<{len(ids)}I", *ids)
    cache.update(islice(missing.items(), max(0, most - len(cache))))
    for i, names, found, at in gaps:
        for k in at:
            found[k] = missing[names[k]]
        out[i] = b"".join(found)
    return out
