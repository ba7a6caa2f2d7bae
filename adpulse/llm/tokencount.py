"""Token counts: pieces once per distinct pre-token, joined to the frequencies of each document."""

from __future__ import annotations

from collections import Counter
from itertools import repeat

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import map_batches, materialize, most_frequent, texts
from .pretokens import pretokens, tokenizer

# Most frequent pre-tokens whose piece counts each task holds; all others are joined. A fixed number, so what
# is broadcast doesn't grow with the data.
FREQUENT = 1 << 18
# A task hands on its counts when it holds so many different pre-tokens.
HELD = 1 << 18


def pretoken_table(docs: DataFrame, path: str) -> DataFrame:
    """``(pretoken, n, pieces)``: occurrences in all whole texts, and how many tokens each pre-token gives."""

    def count(batches):
        def flush(held):
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["pretoken", "n"])

        held: Counter[str] = Counter()
        for batch in batches:
            for text in batch.column(1).to_pylist():
                held.update(pretokens(text.decode()))
                if len(held) > HELD:
                    yield flush(held)
                    held = Counter()
        if held:
            yield flush(held)

    def pieces(rows: pa.RecordBatch) -> pa.RecordBatch:
        found = tokenizer(path).encode_batch(rows.column(0).to_pylist(), add_special_tokens=False)
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array([len(e.ids) for e in found], pa.int64())], ["pretoken", "n", "pieces"])

    counted = texts(docs).mapInArrow(count, "pretoken string, n long").groupBy("pretoken").agg(F.sum("n").alias("n"))
    return materialize(map_batches(counted, pieces, "pretoken string, n long, pieces long"), "pretokens")


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` per row of ``docs``; no ids are ever made for a document.

    Each document's frequencies meet the piece counts: the :data:`FREQUENT` most frequent pre-tokens in the
    task that reads the text, all others in a join on the pre-token, where none is hot any more.

    Null and empty texts have 0 tokens. Repeated rows are counted once each. Special tokens' strings inside a
    text count as the tokenizer's default has it. No rows: no result. Other columns are ignored.
    """
    spark = docs.sparkSession
    table = pretoken_table(docs, path)
    top = most_frequent(table, "pretoken", FREQUENT)
    frequent = spark.sparkContext.broadcast(dict(zip(top["pretoken"], top["pieces"].tolist())))

    def frequencies(batches):
        known = frequent.value.get
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                doc, pre, tf, base, size = [], [], [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    names = pretokens(text.decode())
                    pieces = list(map(known, names, repeat(0)))
                    rest = Counter(n for n, p in zip(names, pieces) if not p) if 0 in pieces else {}
                    # a document without rare pre-tokens still sends one row, under a key spread by its place
                    pre += rest or [str(part.column(2)[i])]
                    tf += rest.values() or [0]
                    k = len(rest) or 1
                    doc += [i] * k
                    base += [sum(pieces)] + [0] * (k - 1)
                    size += [len(text)] + [0] * (k - 1)
                take = pa.array(doc, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(2).take(take), part.column(0).take(take), pa.array(pre, pa.string()),
                     *(pa.array(x, pa.int64()) for x in (tf, base, size))],
                    ["row", "doc_id", "pretoken", "tf", "base", "size"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = texts(docs).withColumn("row", F.monotonically_increasing_id())
    rows = rows.mapInArrow(frequencies, f"row long, doc_id {kind}, pretoken string, tf long, base long, size long")
    joined = rows.join(table.select("pretoken", "pieces"), "pretoken", "left")
    tokens = F.col("base") + F.col("tf") * F.coalesce("pieces", F.lit(0))
    return (joined.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("size").alias("n_bytes"), F.sum(tokens).alias("n_tokens"))
            .drop("row"))
