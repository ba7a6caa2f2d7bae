"""The pipeline's stages against plain versions, on the smallest tables with planted cases."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from adpulse.llm import toxicity

from . import brute
from .test_documents import check_packing, water_fill

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = {r.doc_id: r for r in docs.collect()}
    scores = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == corpus_pipeline.COLUMNS
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append(docs.collect())
    toxic, near, passages, mixed = kept
    assert {r.doc_id for r in toxic} == {d for d, p in scores.items() if not p}
    # one of equal texts stays, the first; texts that share nothing all stay
    first: dict = {}
    for r in sorted(toxic, key=lambda r: r.doc_id):
        first.setdefault(r.text, r.doc_id)
    ids = {r.doc_id for r in near}
    assert ids <= set(first.values()) and len(near) == len(ids)
    shingles = {r.doc_id: {tuple(brute.words(r.text)[i:i + 5]) for i in range(max(1, len(brute.words(r.text)) - 4))} for r in toxic}
    for r in toxic:
        if r.doc_id not in ids:
            assert max(len(shingles[r.doc_id] & shingles[o]) / len(shingles[r.doc_id] | shingles[o]) for o in shingles if o != r.doc_id) > 0.6
    plain = sorted(near, key=lambda r: r.doc_id)
    want = {r.doc_id: t for r, t in zip(plain, brute.without_passages([r.text for r in plain], 200, 51, 400)) if t is not None}
    assert {r.doc_id: r.text for r in passages} == want
    untouched = [d for d, t in want.items() if before[d].text == t]
    assert 0.5 * len(want) < len(untouched) < len(want)
    sizes, taken = Counter(), Counter(r.source for r in mixed)
    for r in passages:
        sizes[r.source] += len(brute.words(r.text))
    targets, most = water_fill(sizes), max(len(brute.words(r.text)) for r in passages)
    taken = Counter()
    for r in mixed:
        taken[r.source] += len(brute.words(r.text))
    assert all(abs(taken[s] - t) <= most for s, t in targets.items())
    assert max(Counter(r.doc_id for r in mixed).values()) <= 2
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    check_packing(packed, [(r.doc_id, r.text) for r in mixed])


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).columns[:3] == ["doc_id", "piece", "start"]


def test_empty_and_awkward_documents(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (None, "no id", "en", "a", 5), (3, "x " * 300, "en", "b", 600), (3, "x " * 300, "en", "b", 600)]
    for df, n in ((spark.createDataFrame([], schema), 0), (spark.createDataFrame(rows, schema), None)):
        docs = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, SF).collect(), schema)
        assert n is None or docs.count() == n
