"""What the pipeline holds in memory at a time, on its way through Python."""

from __future__ import annotations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adpulse.llm import pretokens
from adpulse.llm.common import PART
from adpulse.llm.queries import tokenizer_path

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def usual(spark):
    before = spark.conf.get(ARROW_BYTES)
    spark.conf.unset(ARROW_BYTES)
    yield spark
    spark.conf.set(ARROW_BYTES, before)


def test_stages_hand_python_about_a_megabyte_of_texts(usual, tmp_path):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    docs = usual.range(0, 4_000, 1, 1).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("some text "), F.lit(200)).alias("text"), F.lit("en").alias("lang"), F.lit("web").alias("source"),
        F.lit(2_000).cast("long").alias("n_chars"))
    corpus_pipeline.pack_sequences(usual, docs.limit(1), str(tmp_path))
    found = [r.n for r in docs.mapInArrow(sizes, "n long").collect()]
    assert sum(found) >= 8_000_000 and max(found) <= 1.1 * PART


def test_the_tokenizer_gets_few_pretokens_at_a_time(monkeypatch):
    path = tokenizer_path()
    real, asked = pretokens.tokenizer(path), []

    class Noting:
        def encode_batch_fast(self, names, **more):
            asked.append(len(names))
            return real.encode_batch_fast(names, **more)

    monkeypatch.setattr(pretokens, "tokenizer", lambda _: Noting())
    monkeypatch.setattr(pretokens, "_cache", lambda _, kept={}: kept)
    texts = [" ".join(f"word{i * k}" for i in range(2_000)) for k in (1, 3, 7, 11)]
    want = [e.ids for e in real.encode_batch(texts, add_special_tokens=False)]
    assert [[int.from_bytes(b[i:i + 4], "little") for i in range(0, len(b), 4)] for b in pretokens.encode(texts, path)] == want
    assert sum(asked) > 4_096 and max(asked) <= 4_096


def test_no_more_pretokens_are_remembered_than_asked_for(monkeypatch):
    path, kept = tokenizer_path(), {}
    monkeypatch.setattr(pretokens, "_cache", lambda _: kept)
    texts = [" ".join(f"item{i * k}" for i in range(500)) for k in (1, 3, 7)]
    want = [e.ids for e in pretokens.tokenizer(path).encode_batch(texts, add_special_tokens=False)]
    for part in ([0], [1, 2], [0, 1, 2]):
        found = pretokens.encode([texts[k] for k in part], path, 700)
        assert [len(b) // 4 for b in found] == [len(want[k]) for k in part]
        assert [[int.from_bytes(b[i:i + 4], "little") for i in range(0, len(b), 4)] for b in found] == [want[k] for k in part]
        assert len(kept) <= 700
    assert len(kept) == 700
