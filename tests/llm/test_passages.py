"""Repeated passages of the pipeline by their number of words."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from adpulse.llm import simhash, suffix, toxicity
from adpulse.llm.common import map_batches

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_passages_of_over_fifty_words_go(spark):
    rng = np.random.default_rng(6)
    word = lambda n: "".join(chr(97 + int(c)) for c in rng.integers(0, 26, n))
    passage = lambda n: " ".join(word(int(rng.integers(2, 9))) for _ in range(n))
    short_words = lambda n: " ".join(word(int(rng.integers(3, 5))) for _ in range(n))
    planted, brief, line, other, wide = passage(51), short_words(51), passage(45), passage(40), " ".join(word(12) for _ in range(32))
    assert len(planted) < 400 and len(brief) < 300 and len(line) > 200 and len(other) > 200 and len(wide) > 400
    rows, want = [], {}
    for i in range(4):
        a, b, c = passage(80), passage(70), passage(60)
        rows += [(i, f"{a} {planted} {b} {brief} {c}"), (10 + i, f"{a[:-1]}0 {line} 1{b}"), (20 + i, f"{c[:-1]}{i} {wide}")]
        # two lines that meet, neither of which is so long
        rows += [(30 + i, f"{passage(50)} {line} {i} {other} {passage(50)}")]
    parts = dict(rows)
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], SCHEMA).repartition(3)
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_passages(spark, docs, "").collect()}
    for i in range(4):
        assert planted[10:-10] not in got[i] and brief[10:-10] not in got[i]
        assert wide[10:-10] not in got[20 + i]
        assert got[30 + i] == parts[30 + i]


def test_only_whole_words_count(spark):
    """Fifty whole shared words with a shared fragment on either side stay; fifty-one go."""
    rng = np.random.default_rng(7)
    word = lambda n: "".join(chr(97 + int(c)) for c in rng.integers(0, 26, n))
    for n in (50, 51):
        core = " ".join(word(6) for _ in range(n))
        texts = [f"{word(40)} {word(30)}shared {core} shared{word(30)} {word(40)}" for _ in range(2)]
        docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], SCHEMA)
        got = sorted(r.text for r in corpus_pipeline.drop_repeated_passages(spark, docs, "").collect())
        assert (got == sorted(texts)) == (n == 50) and (core in got[0]) == (n == 50)


def test_a_worker_makes_much_of_few_rows_at_a_time(spark, monkeypatch):
    """What is made of a text, its runs above all, is larger than the text, so a whole batch of them at once fills an executor."""
    rng = np.random.default_rng(8)
    word = lambda n: "".join(chr(97 + int(c)) for c in rng.integers(0, 26, n))
    planted = " ".join(word(7) for _ in range(60))
    texts = [f"{word(700)} {planted if i % 10 == 0 else word(400)} {word(700)}" for i in range(1500)] + [None, ""]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in enumerate(texts)], SCHEMA).coalesce(1)

    def small(df, function, schema, size=0):
        def checked(rows):
            assert rows.nbytes < 1 << 21, f"{rows.nbytes} bytes at once"
            return function(rows)

        return map_batches(df, checked, schema, size)

    for module in (suffix, simhash, toxicity):
        monkeypatch.setattr(module, "map_batches", small)
    assert len(simhash.near_duplicate_groups(docs).collect()) == len(texts)
    labels = docs.select("doc_id", (F.col("doc_id") % 10 == 0).cast("int").alias("toxic"))
    assert len(toxicity.score_toxicity(docs, labels, also=("text",)).collect()) == len(texts)
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_repeated_passages(spark, docs, "").collect()}
    assert len(got) == len(texts)
    assert all((planted[10:-10] not in (got[i] or "")) and (i % 10 == 0 or got[i] == (t or "")) for i, t in enumerate(texts))
