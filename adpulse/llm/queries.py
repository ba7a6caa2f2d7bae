"""The registered queries of this subpackage: each operator over its whole table, and SQL where it can say so."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession, functions as F

from adpulse.session import shared_folder

from . import align, hmm, kdtree, minhash, mixing, packing, pages, simhash, suffix, tokencount, toxicity, warc, whitening
from .common import materialize

MAX_TOKENS = 1024


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents, 4-word shingles, at most 4 bits apart."""
    found = simhash.simhash_components(_table(spark, sf_dir, "documents"), shingle=4, max_distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every document under a hidden Markov model learned from nine tenths of them."""
    return hmm.score_texts(_table(spark, sf_dir, "documents"), folds=10)


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and what they say about likeness."""
    return minhash.fingerprint_with_next(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), folds=5)


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best other vectors for every hundredth vector."""
    found = kdtree.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without strings of 400 bytes that start elsewhere too."""
    left = suffix.remove_repeats(_table(spark, sf_dir, "documents"), length=400)
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    counts = tokencount.token_counts(_table(spark, sf_dir, "documents"), tokenizer_path())
    return counts.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), tokenizer_path(), end_id=0, capacity=2048)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150 % of all words takes of every document."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, cap=2)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.main_text(_table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of every document's tokens under two tokenizers."""
    docs = _table(spark, sf_dir, "documents")
    scored = align.link_scores(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))
    return scored.drop("row").withColumnRenamed("groups", "groups_sha256")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back from them."""
    path = shared_folder(spark, "llm-warc")
    warc.write_warc(_table(spark, sf_dir, "pages"), path)
    records = warc.read_warc(spark, path).withColumns({
        "payload_sha256": F.sha2("payload", 256), "payload_bytes": F.octet_length("payload").cast("long")})
    records = materialize(records.drop("payload", "target_uri"), "records")
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+):", 1).try_cast("long")
    return warc.resolve(records).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"), "problem")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whitened along the first 16 components."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=16)


QUERIES = {
    "op1_simhash": op1_simhash, "op2_hmm": op2_hmm, "op3_minhash": op3_minhash, "op4_toxicity": op4_toxicity,
    "op5_top_k": op5_top_k, "op6_suffix": op6_suffix, "op7_token_counts": op7_token_counts, "op8_packing": op8_packing,
    "op9_mixing": op9_mixing, "op10_html": op10_html,
    "op11_align": op11_align, "op12_warc": op12_warc, "op13_whitening": op13_whitening,
}

ORACLES = {
    "op5_top_k": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS x
          FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS BIGINT) AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10""",
    "op9_mixing": r"""
        WITH d AS (
          SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
        s AS (
          SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                 [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
          FROM d GROUP BY source),
        o AS (
          SELECT *, 2.0 * source_size / weight AS height,
                 row_number() OVER (ORDER BY 2.0 * source_size / weight, source) AS place FROM s),
        c AS (
          SELECT *, coalesce(sum(2 * source_size) OVER w, 0) AS clamped, sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS free,
                 1.5 * sum(source_size) OVER () AS total
          FROM o WINDOW w AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        f AS (
          SELECT CAST(total - clamped AS DOUBLE) AS remainder, CAST(free AS DOUBLE) AS free FROM c
          WHERE (total - clamped) * weight / free <= 2 * source_size ORDER BY place LIMIT 1),
        t AS (
          SELECT source, source_size, least(coalesce((SELECT remainder * weight / free FROM f), 2.0 * source_size), CAST(2.0 * source_size AS DOUBLE)) AS target FROM s),
        j AS (
          SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
                 coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), size
                                          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, CAST(target AS DOUBLE) AS target,
               CAST(size * (whole + CASE WHEN size > 0 AND before + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken
        FROM j""",
}
