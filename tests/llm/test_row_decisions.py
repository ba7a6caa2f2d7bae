"""The pipeline's stages decide per row where ids are null or repeated."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline

from . import brute
from .test_documents import water_fill

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def document(i, name: str, n: int = 60, source: str = "a"):
    text = " ".join(f"{name}{k}" for k in range(n))
    return (i, text, "en", source, len(text))


def test_near_duplicates_of_null_and_repeated_ids(spark):
    rows = [document(1, "a"), document(5, "b"), document(5, "c"), document(7, "d")]
    rows += [document(None, "a"), document(None, "d")] + [document(None, f"clean{i}x") for i in range(8)] + [document(None, "clean0x")]
    rows += [document(5, "a"), document(9, "c"), document(1, "a")]
    out = corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "")
    want = [document(1, "a"), document(5, "b"), document(5, "c"), document(7, "d"), *(document(None, f"clean{i}x") for i in range(8))]
    assert Counter(map(tuple, out.collect())) == Counter(want)


def test_mix_of_null_and_repeated_ids(spark):
    rows = [document(None if i % 3 else 7, f"t{i}x", 20 + i % 9, "abc"[i % 3]) for i in range(90)] + [document(None, "twice", 30, "a")] * 4
    out = corpus_pipeline.mix_sources(spark, spark.createDataFrame(rows, SCHEMA), "").collect()
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r[3]] += len(brute.words(r[1]))
    for r in out:
        taken[r.source] += len(brute.words(r.text))
    assert all(abs(taken[s] - t) <= 30 for s, t in water_fill(sizes).items())
    copies = Counter(rows)
    assert all(n <= 2 * copies[r] for r, n in Counter(map(tuple, out)).items())
