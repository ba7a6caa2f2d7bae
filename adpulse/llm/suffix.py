"""Removal of long repeated byte strings by a logarithmic family of suffix arrays.

Only stretches that can hold a repeat are indexed. Each ``length``-byte window is named by its smallest
128-byte string under a hash (the leftmost of equals), so equal windows have equal names wherever they stand.
Consecutive windows of one name form a run. A run whose name occurs once holds no repeat; runs that are equal
byte for byte repeat as a whole; only runs that share a name and differ go to the suffix arrays of their
name's shard.
"""

from __future__ import annotations

import hashlib
from operator import eq, methodcaller

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .common import PART, map_batches, materialize, per_key, texts, words_of

LENGTH = 400
NAME = 128            # bytes of the string that names a window
PIECE = 1 << 20       # windows of one document that are named at a time
SHARD = 60_000        # suffixes per shard
TASKS = 2_000         # tasks that index shards, one after the other, unless the session shuffles into more
BATCH = 8_000         # suffixes of a batch within a shard
CROWDED = 250_000     # suffixes of one name beyond which it is no longer indexed in one task

_U = np.uint64
_TABLE = np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = _U(0x9E3779B97F4A7C15)
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, PIECE + 2 * LENGTH)
        _POWERS.clear()
        for base in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS.append(np.multiply.accumulate(p))
        _POWERS.append(np.arange(size, dtype=np.uint64))
    return tuple(p[:n] for p in _POWERS)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(32))) * _U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U(29))) * _U(0xBF58476D1CE4E5B9)
    return x ^ (x >> _U(32))


class Rolling:
    """Hashes of substrings of ``data`` from one running sum."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        up, self.down, self.place = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[data] * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray | slice, end: np.ndarray | slice) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start])


def runs(data: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(name, content, start, count)`` of the runs of windows of a text; content hashes all their bytes."""
    none = np.empty(0, np.int64)
    found = [(none.view(np.uint64), none.view(np.uint64), none, none)]
    name = min(NAME, max(length // 2, 1))
    width = length - name + 1
    for at in range(0, len(data) - length + 1, PIECE):
        part = data[at:at + PIECE + length - 1]
        roll = Rolling(part)
        strings = len(part) - name + 1
        hashes = roll.of(slice(0, strings), slice(name, None))
        low = _U((1 << 22) - 1)
        smallest = (hashes & ~low) | roll.place[:strings]  # the place in the low bits makes the leftmost win
        step = 1
        while step * 2 <= width:
            smallest = np.minimum(smallest[:-step], smallest[step:])
            step *= 2
        windows = len(part) - length + 1
        smallest = np.minimum(smallest[:windows], smallest[width - step:width - step + windows])
        start = np.concatenate([[0], np.flatnonzero(smallest[1:] != smallest[:-1]) + 1])
        end = np.append(start[1:], windows)
        found.append((hashes[(smallest[start] & low).astype(np.int64)], roll.of(start, end + (length - 1)), start + at, end - start))
    return tuple(np.concatenate(x) for x in zip(*found))


class SuffixArray:
    """Sorted suffixes, compared by their first ``length`` bytes, of some starts in a text."""

    def __init__(self, text: bytes, starts: np.ndarray, owners: np.ndarray, length: int) -> None:
        self.text, self.length, self.starts, self.owners = text, length, starts, owners

    def prefixes(self) -> list[bytes]:
        text, length = self.text, self.length
        return [text[s:s + length] for s in self.starts.tolist()]

    @classmethod
    def merged(cls, older: SuffixArray | None, text: bytes, starts: np.ndarray, owners: np.ndarray, length: int):
        """The array of both, and the owners of all suffixes that agree with a neighbour in ``length`` bytes.

        The sort finds the older array in order and merges the rest into it.
        """
        keys = older.prefixes() if older else []
        if older:
            starts = np.concatenate([older.starts, starts + len(older.text)])
            owners = np.concatenate([older.owners, owners])
            text = older.text + text
        keys += cls(text, starts[len(keys):], owners, length).prefixes()
        order = sorted(range(len(keys)), key=keys.__getitem__)
        ordered = [keys[i] for i in order]
        same = np.fromiter(map(eq, ordered, ordered[1:]), bool, len(ordered) - 1) if len(ordered) > 1 else np.empty(0, bool)
        order = np.array(order, np.int64)
        repeated = owners[order[np.flatnonzero(np.append(same, False) | np.insert(same, 0, False))]] if len(order) else owners
        return cls(text, starts[order], owners[order], length), repeated


class SuffixIndexFamily:
    """Levels of geometrically growing suffix arrays; a new batch is merge-scanned against each of them."""

    def __init__(self, length: int = LENGTH) -> None:
        self.length, self.levels = length, []

    def add(self, text: bytes, starts: np.ndarray, owners: np.ndarray) -> np.ndarray:
        """Index a batch; the owners, old and new, of suffixes now known to have a match."""
        new, repeated = SuffixArray.merged(None, text, starts, owners, self.length)
        found = [repeated]
        for k in range(len(self.levels) - 1, -1, -1):
            both, repeated = SuffixArray.merged(self.levels[k], new.text, new.starts, new.owners, self.length)
            found.append(repeated)
            if k == len(self.levels) - 1 and len(self.levels[k].starts) <= len(new.starts):
                self.levels.pop()  # equal sizes: the merge that was scanned becomes the level
                new = both
        self.levels.append(new)
        return np.unique(np.concatenate(found))


def repeated_windows(segments: list[bytes], length: int = LENGTH, batch: int = BATCH) -> list[list[tuple[int, int]]]:
    """Per segment the ranges (first, count) of its windows that occur more than once in the segments."""
    family = SuffixIndexFamily(length)
    firsts = np.cumsum([0] + [max(0, len(s) - length + 1) for s in segments])
    hit = np.zeros(firsts[-1], bool)
    k = 0
    while k < len(segments):
        begin = k
        while k < len(segments) and (k == begin or firsts[k + 1] - firsts[begin] <= batch):
            k += 1
        part = segments[begin:k]
        at = np.cumsum([0] + [len(s) for s in part])
        starts = [np.arange(a, a + max(0, len(s) - length + 1)) for a, s in zip(at, part)]
        hit[family.add(b"".join(part), np.concatenate(starts), np.arange(firsts[begin], firsts[k]))] = True
    return [ranges(hit[a:b]) for a, b in zip(firsts, firsts[1:])]


def ranges(flags: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(int(a), int(b - a)) for a, b in zip(edges[::2], edges[1::2])]


def _packed(docs: DataFrame, also: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, digest, packed, *also)``: texts compressed for a shuffle, and what identifies them."""

    def press(rows: pa.RecordBatch) -> pa.RecordBatch:
        tool, raw = zstandard.ZstdCompressor(level=1), rows.column(1).to_pylist()
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array([hashlib.md5(t).digest() for t in raw], pa.binary()),
             pa.array([tool.compress(t) for t in raw], pa.binary()), *rows.columns[2:]], ["doc_id", "digest", "packed", *also])

    return map_batches(texts(docs, *also), press, f"{_field(docs, 'doc_id')}, digest binary, packed binary" + "".join(f", {_field(docs, c)}" for c in also), PART)


def _field(docs: DataFrame, name: str) -> str:
    return f"`{name}` {docs.schema[name].dataType.simpleString()}"


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(digest, spans)``: per different text, by MD5, its repeated windows as ranges (start, count)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def name(rows: pa.RecordBatch) -> pa.RecordBatch | None:
        who, columns = [], []
        raw = rows.column(1).to_pylist()
        for i, text in enumerate(raw):
            if len(text) >= length:
                columns.append(runs(np.frombuffer(text, np.uint8), length))
                who.append(np.full(len(columns[-1][0]), i))
        if not who:
            return None
        who = pa.array(np.concatenate(who))
        digests = pa.array([hashlib.md5(t).digest() for t in raw], pa.binary())
        name_, content, start, count = (np.concatenate(c) for c in zip(*columns))
        return pa.RecordBatch.from_arrays(
            [rows.column(0).take(who), digests.take(who), pa.array(name_.view(np.int64)), pa.array(content.view(np.int64)),
             pa.array(start), pa.array(count)], ["doc_id", "digest", "name", "content", "start", "count"])

    schema = f"doc_id {kind}, digest binary, name long, content long, start long, count long"
    every = materialize(map_batches(texts(docs), name, schema, PART), "runs")
    names = per_key(every, ["name"], F.count("*").alias("n")).where("n > 1").select("name")
    live = materialize(every.join(names, "name"), "live")

    # one representative of equal runs; a run that occurs twice repeats as a whole
    first = F.min(F.struct("doc_id", "digest", "start")).alias("first")
    unique = live.groupBy("name", "content").agg(F.count("*").alias("n"), F.min("count").alias("count"), first)
    unique = materialize(unique.select("name", "content", "n", "count", "first.*"), "unique")
    shared = per_key(unique, ["name"], F.count("*").alias("kinds"), F.sum("count").alias("suffixes")).where("kinds > 1")
    wanted = unique.join(shared.select("name", "suffixes"), "name")

    # the bytes of those runs
    asked = wanted.groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "count", "name", "content", "n", "suffixes")).alias("asked"))
    asked = asked.select(F.col("doc_id").alias("of"), F.col("digest").alias("what"), "asked")
    texts_ = _packed(docs).join(asked, F.col("digest").eqNullSafe(F.col("what")) & F.col("doc_id").eqNullSafe(F.col("of")))

    def cut(rows: pa.RecordBatch) -> pa.RecordBatch:
        tool, out = zstandard.ZstdDecompressor(), []
        for packed, asks in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist()):
            text = tool.decompress(packed)
            out += [(a["name"], a["content"], a["n"], a["suffixes"], text[a["start"]:a["start"] + a["count"] + length - 1]) for a in asks]
        columns = zip(*out)
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c, pa.int64()) for c, _ in zip(columns, range(4))), pa.array([o[4] for o in out], pa.binary())],
            ["name", "content", "n", "suffixes", "bytes"])

    segments = map_batches(texts_.select("packed", "asked"), cut, "name long, content long, n long, suffixes long, bytes binary", PART)
    segments = materialize(segments.dropDuplicates(["name", "content"]), "segments")
    total = segments.where(F.col("suffixes") <= CROWDED).agg(F.sum(F.length("bytes") - (length - 1))).first()[0] or 0
    shards = max(1, -(-total // SHARD))

    def index(group: pa.Table) -> pa.Table:
        # a fixed order, so that reruns build the same levels
        group = group.sort_by([("name", "ascending"), ("content", "ascending")])
        found = repeated_windows(group["bytes"].to_pylist(), length)
        who = pa.array([i for i, r in enumerate(found) for _ in r], pa.int64())
        flat = [x for r in found for x in r]
        return pa.table({
            "name": group["name"].take(who), "content": group["content"].take(who),
            "offset": pa.array([x[0] for x in flat], pa.int64()), "windows": pa.array([x[1] for x in flat], pa.int64())})

    spans = "name long, content long, offset long, windows long"
    calm = segments.where(F.col("suffixes") <= CROWDED).withColumn("shard", F.pmod(F.xxhash64("name"), F.lit(shards)))
    # a number of tasks of its own: what shards cost doesn't show in their bytes, by which adaptive execution merges tasks
    tasks = min(2 * shards, max(TASKS, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    indexed = calm.repartition(tasks, "shard").groupBy("shard").applyInArrow(index, spans)
    parts = indexed.unionByName(_crowded_windows(segments.where(F.col("suffixes") > CROWDED), length))
    parts = parts.groupBy("name", "content").agg(F.collect_list(F.struct("offset", "windows")).alias("parts"))
    whole = unique.where("n > 1").select("name", "content", F.array(F.struct(F.lit(0).cast("long").alias("offset"), F.col("count").alias("windows"))).alias("whole"))
    flagged = parts.join(whole, ["name", "content"], "full").select("name", "content", F.coalesce("whole", "parts").alias("parts"))
    # read back, this side is shuffled for the join itself, which can then split a run with very many copies
    flagged = materialize(flagged, "flagged")
    flat = live.join(flagged, ["name", "content"]).select("digest", "start", F.explode("parts").alias("part"))
    flat = flat.select("digest", F.struct((F.col("start") + F.col("part.offset")).alias("start"), F.col("part.windows").alias("count")).alias("span"))
    return per_key(flat.distinct(), ["digest"], F.collect_list("span").alias("spans"))


def _crowded_windows(segments: DataFrame, length: int) -> DataFrame:
    """Repeated windows of names that very many different runs share, one row per window.

    Such a name's suffixes are not indexed in one task. Windows are grouped by a 128-bit hash instead, with
    partial counts before the shuffle, so that no group is held anywhere.
    """

    def windows(rows: pa.RecordBatch) -> pa.RecordBatch:
        who, offset, one, two = [], [], [], []
        for i, data in enumerate(rows.column(2).to_pylist()):
            for k in range(len(data) - length + 1):
                digest = hashlib.md5(data[k:k + length]).digest()
                who.append(i)
                offset.append(k)
                one.append(int.from_bytes(digest[:8], "little", signed=True))
                two.append(int.from_bytes(digest[8:], "little", signed=True))
        take = pa.array(who, pa.int64())
        return pa.RecordBatch.from_arrays(
            [rows.column(0).take(take), rows.column(1).take(take), *(pa.array(x, pa.int64()) for x in (offset, one, two))],
            ["name", "content", "offset", "one", "two"])

    every = map_batches(segments.select("name", "content", "bytes"), windows, "name long, content long, offset long, one long, two long", PART)
    many = per_key(every, ["one", "two"], F.count("*").alias("n")).where("n > 1")
    return every.join(many, ["one", "two"]).select("name", "content", "offset", F.lit(1).cast("long").alias("windows"))


def _stretches(found, text: bytes, length: int, words: int, whole: int) -> list[tuple[int, int]]:
    """``(start, stop)`` of the stretches of repeated windows that are long enough, in order."""
    merged: list[list[int]] = []
    for s in sorted(found, key=lambda s: s["start"]):
        stop = s["start"] + s["count"]
        if merged and s["start"] <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], stop)
        else:
            merged.append([s["start"], stop])
    out = [(start, stop + length - 1) for start, stop in merged]
    return [(a, b) for a, b in out if not words or b - a >= whole or _whole_words(text, a, b) >= words]


def _whole_words(text: bytes, start: int, stop: int) -> int:
    """Words of ``text`` that lie wholly between two places."""
    inside = words_of(text[start:stop])
    cut = [bool(inside) and not text[a:a + 1].isspace() and not text[b:b + 1].isspace()
           for a, b in ((start - 1, start), (stop - 1, stop)) if 0 <= a and b < len(text)]
    return max(0, len(inside) - sum(cut))


def remove_repeats(docs: DataFrame, length: int = LENGTH, also: tuple[str, ...] = (), as_text: bool = False,
                   words: int = 0, whole: int = 0) -> DataFrame:
    """``(doc_id, kept, n_bytes, n_removed, n_spans, *also)`` per row; ``kept`` are the bytes that stay.

    Each byte goes that lies in a string of ``length`` bytes that also starts elsewhere, in the same document
    or another; every copy goes, judged on the input. Texts are whole UTF-8 byte strings; null and empty ones
    have no byte to lose, nor has a text shorter than ``length``. Repeated rows are copies, so all of a row
    repeated goes if it is long enough. ``as_text`` gives ``kept`` as text, without the rest of a character
    that a cut has split. With ``words``, of the stretches in which such strings start at each byte only those
    go that hold so many whole words, or ``whole`` bytes. No rows: no result. Columns named in ``also`` are handed through, others ignored.
    """
    spans = repeated_spans(docs, length).select(F.col("digest").alias("what"), "spans")
    both = _packed(docs, also).join(spans, F.col("digest") == F.col("what"), "left").select("doc_id", "packed", "spans", *also)

    decode = methodcaller("decode", "utf-8", "ignore")

    def cut(rows: pa.RecordBatch) -> pa.RecordBatch:
        tool, out = zstandard.ZstdDecompressor(), []
        for packed, found in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist()):
            text = tool.decompress(packed)
            pieces, end, removed, n = [], 0, 0, 0
            for start, stop in _stretches(found or (), text, length, words, whole):
                if start > end or not n:
                    pieces.append(text[end:start])
                    n, removed, end = n + 1, removed + stop - start, stop
                elif stop > end:
                    removed, end = removed + stop - end, stop
            pieces.append(text[end:])
            out.append((b"".join(pieces), len(text), removed, n))
        kept, size, removed, n = zip(*out)
        return pa.RecordBatch.from_arrays(
            [rows.column(0), pa.array(map(decode, kept), pa.string()) if as_text else pa.array(kept, pa.binary()),
             *(pa.array(x, pa.int64()) for x in (size, removed, n)), *rows.columns[3:]],
            ["doc_id", "kept", "n_bytes", "n_removed", "n_spans", *also])

    schema = f"{_field(docs, 'doc_id')}, kept {'string' if as_text else 'binary'}, n_bytes long, n_removed long, n_spans long"
    return map_batches(both, cut, schema + "".join(f", {_field(docs, c)}" for c in also), PART)
