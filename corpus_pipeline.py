"""A corpus from raw documents to packed token sequences, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before kept; its result is
written as Parquet and read again. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from adpulse.llm import mixing, packing, simhash, suffix, toxicity
from adpulse.llm.common import delete_folders, materialize, recorded, row_hash, small_batches
from adpulse.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
PASSAGE_BYTES, PASSAGE_WORDS = 200, 51
REMEMBERED = 400_000  # pre-tokens a worker keeps the ids of, also while other stages need the memory


_FOLDERS: list[str] = []


def _stage(function):
    """Delete what the stage before left in shared storage, since its result has been written, and note anew.

    The session's batches for Python become small, as :func:`small_batches` says, also for what runs after the call.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        delete_folders(spark, _FOLDERS)
        with recorded(_FOLDERS):
            return function(spark, docs, sf_dir)

    return run_stage


@_stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    scores = toxicity.score_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), also=("text", "lang", "source", "n_chars"))
    return scores.where("predicted = 0").select(COLUMNS)


@_stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id stays, once; rows of one id are judged each.

    SimHash fingerprints at most 4 bits apart propose pairs, MinHash bands those that fingerprints miss; the exact
    similarity of the texts accepts them.
    """
    keyed = docs.select(*COLUMNS, row_hash(*COLUMNS).alias("_row"))
    kept = simhash.near_duplicate_groups(keyed, row="_row").where("first").select(F.col("row").alias("_row"))
    return keyed.join(kept, "_row", "left_semi").distinct().select(COLUMNS)


@_stage
def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of over 50 words, or of 400 bytes, that also occur elsewhere go; a document of which nothing is left goes.

    Passages are looked for from 200 bytes on: over 50 words are longer if they average three letters.
    """
    left = suffix.remove_repeats(docs, PASSAGE_BYTES, also=("lang", "source"), as_text=True, words=PASSAGE_WORDS, whole=suffix.LENGTH).withColumnRenamed("kept", "text")
    left = left.where("n_removed = 0 or n_removed < n_bytes")
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought to their target weights: a row is repeated as often as the mix takes it."""
    keyed = docs.select(*COLUMNS, row_hash(*COLUMNS).alias("_row"))
    # rows equal in all columns stand for each other, so one of them takes the repeats of all
    taken = mixing.mix(keyed, row="_row").groupBy("_row").agg(F.sum("repeats").cast("int").alias("_n")).where("_n > 0")
    joined = keyed.distinct().join(taken, "_row")
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(COLUMNS)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and where each is packed."""
    return packing.pack(docs, tokenizer_path(), remembered=REMEMBERED)


STAGES = [
    ("toxicity", drop_toxic), ("near_duplicates", drop_near_duplicates), ("repeated_passages", drop_repeated_passages),
    ("mixing", mix_sources), ("packing", pack_sequences),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to shared storage before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
