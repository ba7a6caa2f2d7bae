"""Cross-tokenizer alignment: groups of tokens of two tokenizers that end at the same byte, and what links them."""

from __future__ import annotations

import os
from functools import lru_cache
from hashlib import sha256
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import materialize, most_frequent
from .pretokens import pretokens

# Id pairs whose counts each task holds: two numbers and a flag each, so 9 MB however much data there is. All
# others are joined.
FREQUENT = 1 << 19
# A worker remembers so many parts of texts, of at most so many characters: some 200 MB. Results don't depend on it.
CACHE, CACHED = 1 << 19, 48
# A task hands on its pair counts when it holds so many pairs.
HELD = 1 << 21


def _byte_of() -> dict[str, int]:
    """Byte-level alphabets show a printable Latin-1 character as itself and the other bytes, in order, from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@lru_cache(4)
def load(path: str):
    """``(encode, pieces)`` of a byte-level ``.json`` or a sentencepiece ``.model`` vocabulary.

    ``encode`` gives the ids of texts that start with a space, special strings read as plain text; a sentencepiece
    model puts that space there itself. ``pieces`` holds the bytes of each id.
    """
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.vocab_size())]
        pieces = [bytes([int(n[3:5], 16)]) if model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        return lambda texts: model.encode([t[1:] for t in texts], num_threads=1), pieces
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(path)
    known.encode_special_tokens = True
    byte = _byte_of()
    names = [known.id_to_token(i) for i in range(known.get_vocab_size())]
    pieces = [bytes(byte[c] for c in n) if all(c in byte for c in n) else n.encode() for n in names]
    return lambda texts: [e.ids for e in known.encode_batch_fast(texts, add_special_tokens=False)], pieces


def align_ids(a: list[int], b: list[int], pieces_a: list[bytes], pieces_b: list[bytes]) -> tuple[str, list[int]]:
    """Groups ``a1,a2|b1;a3|b2,b3`` and the linked pairs, each as ``a << 32 | b``, of two id lists over the same bytes.

    Cumulative ends of either list are the keys of a dictionary to its indices; the ends that both have cut the
    lists into groups, and within a group the tokens that overlap are linked.
    """
    ends_a: dict[int, int] = {}
    ends_b: dict[int, int] = {}
    for ids, pieces, ends in ((a, pieces_a, ends_a), (b, pieces_b, ends_b)):
        at = 0
        for i, token in enumerate(ids):
            at += len(pieces[token])
            ends[at] = i
    last_a, last_b = list(ends_a), list(ends_b)
    groups, links = [], []
    i = j = 0
    for end in sorted(ends_a.keys() & ends_b.keys()):
        to_a, to_b = ends_a[end] + 1, ends_b[end] + 1
        groups.append(f"{','.join(map(str, a[i:to_a]))}|{','.join(map(str, b[j:to_b]))}")
        while i < to_a and j < to_b:
            links.append(a[i] << 32 | b[j])
            x, y = last_a[i], last_b[j]
            i, j = i + (x <= y), j + (y <= x)
        i, j = to_a, to_b
    return ";".join(groups), links


@lru_cache(2)
def _cache(path_a: str, path_b: str) -> dict[str, tuple[bytes, bytes, int] | None]:
    return {}


def _aligned(texts: list[str], path_a: str, path_b: str) -> list[tuple[bytes, bytes, int] | None]:
    """Groups, packed links and number of A's tokens of texts that start with a space; None: bytes differ."""
    (encode_a, pieces_a), (encode_b, pieces_b) = load(path_a), load(path_b)
    out = []
    for text, a, b in zip(texts, encode_a(texts), encode_b(texts)):
        want = text.encode()
        if b"".join([pieces_a[i] for i in a]) != want or b"".join([pieces_b[i] for i in b]) != want:
            out.append(None)
            continue
        groups, links = align_ids(a, b, pieces_a, pieces_b)
        out.append((groups.encode(), pack(f"<{len(links)}q", *links), len(a)))
    return out


def align_texts(texts: list[str], path_a: str, path_b: str) -> list[tuple[bytes, bytes, int] | None]:
    """:func:`_aligned` of whole texts, part by part.

    Neither tokenizer has a token over a single space between two characters that are no white space, so both cut
    there, each part starts with its space, and the groups of a text are those of its parts. If the bytes of a part
    differ, the text is taken as a whole.
    """
    cache, missing = _cache(path_a, path_b), {}
    parts = [pretokens(" " + t) if t else [] for t in texts]
    for names in parts:
        missing.update(dict.fromkeys(n for n in names if n not in cache))
    missing = dict(zip(missing, _aligned(list(missing), path_a, path_b)))
    if len(cache) < CACHE:
        cache.update((k, v) for k, v in missing.items() if len(k) <= CACHED)
    out = []
    for text, names in zip(texts, parts):
        found = [cache[n] if n in cache else missing[n] for n in names]
        if not found:
            out.append(None)
        elif None in found:
            out += _aligned([" " + text], path_a, path_b)
        else:
            groups, links, counts = zip(*found)
            out.append((b";".join(groups), b"".join(links), sum(counts)))
    return out


def align(docs: DataFrame, path_a: str, path_b: str, digest: bool = False) -> DataFrame:
    """``(row, doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times)`` per row of ``docs``.

    ``groups`` is the text of :func:`align_ids`, or with ``digest`` its SHA-256 in hex; ``pairs`` holds the different
    linked pairs, ascending, as packed little-endian 32-bit ids (all of A, then all of B), and ``times`` how often
    each is linked, packed alike. ``row`` tells repeated rows apart. Texts that are null, empty or not given back
    byte for byte by both tokenizers have no tokens: zeros and empty values. Other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                numbers, shown, pairs, times = [], [], [], []
                for found in align_texts(part.column(2).to_pylist(), path_a, path_b):
                    if found is None:
                        numbers.append((0, 0, 0, 0))
                        shown.append("")
                        pairs.append(b"")
                        times.append(b"")
                        continue
                    groups, links, n_a = found
                    n_groups, n_links = groups.count(b"|"), len(links) // 8
                    numbers.append((n_a, n_links - n_a + n_groups, n_groups, n_links))
                    shown.append(sha256(groups).hexdigest() if digest else groups.decode())
                    keys, n = np.unique(np.frombuffer(links, "<i8"), return_counts=True)
                    pairs.append(np.concatenate([keys >> 32, keys & 0xFFFFFFFF]).astype("<u4").tobytes())
                    times.append(n.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(pa.array(c, pa.int64()) for c in zip(*numbers)),
                     pa.array(shown, pa.string()), pa.array(pairs, pa.binary()), pa.array(times, pa.binary())],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    source = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(run, f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs binary, times binary")


def _keys(packed: bytes) -> np.ndarray:
    a, b = np.frombuffer(packed, "<u4").astype(np.int64).reshape(2, -1)
    return a << 32 | b


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, n, best)``: how many rows of :func:`align` hold each pair, and whether no pair of its A id has more."""

    def run(batches):
        def flush(held):
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n.astype(np.int64))], ["pair", "n"])

        held, size = [], 0
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                if packed:
                    held.append(_keys(packed))
                    size += len(held[-1])
                if size > HELD:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    counted = aligned.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    # one partition holds the pairs of one A id: no more than B has ids
    most = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    return counted.withColumn("best", F.col("n") == most)


def link_scores(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """:func:`align` of all ``docs`` (groups by their hash) with ``n_best`` and ``count_sum`` in place of the pairs.

    ``count_sum`` adds, over all links of a text, how many texts of the corpus hold that id pair linked; ``n_best``
    counts the links whose number is their A id's highest, ties included. The :data:`FREQUENT` pairs that most texts
    hold are looked up in the task, the others joined, where none is hot any more. Repeated rows count once each; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    aligned = materialize(align(docs, path_a, path_b, digest=True), "aligned")
    table = materialize(pair_counts(aligned), "pairs")
    top = most_frequent(table, "pair", FREQUENT).sort_values("pair")
    held = spark.sparkContext.broadcast((top["pair"].to_numpy(np.int64), top["n"].to_numpy(np.int64), top["best"].to_numpy(bool)))
    names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"]

    def run(batches):
        pairs, counts, best = held.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                keys = [_keys(p) for p in part.column(7).to_pylist()]
                ends = np.cumsum([len(k) for k in keys])
                keys, times = np.concatenate(keys), np.frombuffer(b"".join(part.column(8).to_pylist()), "<u4").astype(np.int64)
                place = np.minimum(np.searchsorted(pairs, keys), max(len(pairs) - 1, 0))
                known = pairs[place] == keys if len(pairs) else np.zeros(len(keys), bool)

                def sums(values):  # per text, also for texts without pairs
                    return np.diff(np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], ends])])

                def looked_up(values):
                    return np.where(known, values[place], 0) * times if len(pairs) else times * 0

                offsets = np.concatenate([[0], np.cumsum(~known)])[np.concatenate([[0], ends])]
                rare = pa.StructArray.from_arrays([pa.array(keys[~known]), pa.array(times[~known])], ["pair", "times"])
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:7], pa.array(sums(looked_up(best))), pa.array(sums(looked_up(counts))),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rare)],
                    [*names, "n_best", "count_sum", "rare"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.select(names).schema)
    scored = materialize(aligned.mapInArrow(run, f"{schema}, n_best long, count_sum long, rare array<struct<pair: bigint, times: bigint>>"), "scored")
    rest = scored.select("row", F.explode("rare").alias("r")).select("row", "r.pair", "r.times").join(table, "pair")
    rest = rest.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("n") * F.col("times")).alias("more_sum"))
    total = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return scored.join(rest, "row", "left").select(*names, total("n_best", "more_best"), total("count_sum", "more_sum"))
