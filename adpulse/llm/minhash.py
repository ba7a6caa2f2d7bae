"""One-permutation MinHash with optimal densification, stored as packed low-order bits."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import shingle_hashes, texts, words_of

BINS, LOW_BITS, SHINGLE = 512, 4, 5
HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


@lru_cache(2)
def _orders(bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Each bin's own random order of all bins, and the place of each bin in it."""
    order = np.random.default_rng(20140622).random((bins, bins)).argsort(1).astype(np.int32)
    return order, order.argsort(1).astype(np.int32)


def bin_minima(hashes: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The smallest hash of each bin; an empty bin takes that of the first bin in its own order that has one.

    Each hash falls into the bin of its leading bits, so all minima are found in one sort. Letting each
    empty bin pick its donor at random, independently of the others and alike for all texts, gives the
    smallest variance that filling can have (Shrivastava, "Optimal Densification", 2017).
    """
    shift = np.uint64(64 - bins.bit_length() + 1)
    ordered = np.sort(hashes)
    at = np.searchsorted(ordered, np.arange(bins, dtype=np.uint64) << shift)
    minima = ordered[np.minimum(at, len(ordered) - 1)]
    full = (minima >> shift) == np.arange(bins, dtype=np.uint64)
    empty = np.flatnonzero(~full)
    if not len(empty):
        return minima
    order, place = _orders(bins)
    donors = np.flatnonzero(full)
    if len(donors) * 8 > bins:
        for step in range(8):
            pick = order[empty, step]
            hit = full[pick]
            minima[empty[hit]] = minima[pick[hit]]
            empty = empty[~hit]
            if not len(empty):
                return minima
    minima[empty] = minima[donors[place[np.ix_(empty, donors)].argmin(1)]]
    return minima


def signature(text: bytes) -> np.ndarray:
    """The low-order bits per bin. A text without words has the empty shingle."""
    hashes = shingle_hashes(words_of(text), SHINGLE)
    if not len(hashes):
        hashes = shingle_hashes([b""], SHINGLE)
    return (bin_minima(hashes) & np.uint64((1 << LOW_BITS) - 1)).astype(np.uint8)


def pack(signature_: np.ndarray) -> str:
    """Four bits a bin, so one hexadecimal digit a bin."""
    return HEX[signature_].tobytes().decode()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity: the share of equal bins, less what equal low bits give by chance."""
    chance = 2.0 ** -LOW_BITS
    return min(1.0, max(0.0, (float((a == b).mean()) - chance) / (1 - chance)))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def fingerprint_with_next(docs: DataFrame, rows_per_range: int = 4000) -> DataFrame:
    """Fingerprints of all texts, of their edited texts, and their likeness to those and to the next document's.

    ``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)``.
    Documents are cut into ranges of ``doc_id`` whose first ids are known, each sorted in one task; the first
    document of a range is sent to the range before as well, and the very first to the last range. So texts
    are shuffled once, compressed, and nothing passes through a single task.

    Null texts are empty; an empty text has the fingerprint of the empty shingle. Rows of equal ``doc_id``
    follow each other in an order by their compressed text; a null id comes first. One row follows itself.
    No rows: no result. Other columns are ignored.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    facts = ids.agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.count("doc_id").alias("some")).first()
    ranges = max(1, min(20_000, facts.n // rows_per_range))
    firsts = np.empty(0, np.int64)
    if facts.some and ranges > 1:
        shares = [i / ranges for i in range(1, ranges)]
        cut = ids.agg(F.percentile_approx("doc_id", shares, 100 * ranges)).first()[0]
        firsts = np.array(sorted(set(cut) - {facts.low}), np.int64)  # values that occur, so each is its range's first
    nulls, low = facts.n > facts.some, facts.low

    def deal(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                doc, bucket, late, source = [], [], [], []
                for i, d in enumerate(part.column(0).to_pylist()):
                    k = 0 if d is None else int(np.searchsorted(firsts, d, "right"))
                    places = [(k, 0)]
                    if d is not None and k and firsts[k - 1] == d:
                        places.append((k - 1, 1))
                    if d is None if nulls else d == low:
                        places.append((len(firsts), 2))
                    for b, l in places:
                        doc.append(d)
                        bucket.append(b)
                        late.append(l)
                        source.append(i)
                packed = [press.compress(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket, pa.int32()), pa.array(late, pa.int32()), pa.array(doc, pa.int64()),
                     pa.array(packed, pa.binary()).take(pa.array(source, pa.int64()))],
                    ["bucket", "late", "doc_id", "text"])

    def walk(batches):
        press = zstandard.ZstdDecompressor()
        before = None  # bucket, doc_id, text, signature of the row whose next one is awaited
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                out = []
                for bucket, late, doc, packed in zip(*(c.to_pylist() for c in batch.slice(at, 1000).columns)):
                    if late and (before is None or before[0] != bucket):
                        continue  # a later one of several rows that follow this range
                    raw = press.decompress(packed)
                    text, print_ = raw.decode(), signature(raw)
                    if before is not None and before[0] == bucket:
                        out.append(_compare(*before[1:], text, print_))
                    before = None if late else (bucket, doc, text, print_)
                if out:
                    yield pa.RecordBatch.from_pylist(out, _SCHEMA)

    dealt = texts(docs.withColumn("doc_id", F.col("doc_id").cast("long"))).mapInArrow(deal, "bucket int, late int, doc_id long, text binary")
    ordered = dealt.repartition(ranges, "bucket").sortWithinPartitions("bucket", "late", "doc_id", "text")
    return ordered.mapInArrow(walk, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                    "edited_fingerprint string, near_edited double, near_next double")


_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compare(doc, text: str, print_: np.ndarray, following: str, following_print: np.ndarray) -> dict:
    changed = edited(text, following).encode()
    changed_print = signature(changed)
    return {
        "doc_id": doc, "n_chars": len(text), "edited_sha256": hashlib.sha256(changed).hexdigest(),
        "fingerprint": pack(print_), "edited_fingerprint": pack(changed_print),
        "near_edited": likeness(print_, changed_print), "near_next": likeness(print_, following_print),
    }
