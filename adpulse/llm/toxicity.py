"""Toxicity by non-negative positive-unlabelled learning of a numpy classifier."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import PART, doc_crc, map_batches, materialize, texts

# Bounds of the sample that the classifier is fitted to; scores cover all texts.
POSITIVES = 8_192    # confirmed toxic texts
UNLABELLED = 24_576  # other training texts, labels unread
FEATURES = 3_000     # words with a weight
STEPS = 400
_BLANK = bytes(32 if 0 < i < 128 and not chr(i).isalnum() else i for i in range(256))


def features(text: bytes) -> set[bytes]:
    """The different words of a text, in lower case and without ASCII punctuation."""
    return set(text.lower().translate(_BLANK).split())


def choose_words(names: list[str], positive: np.ndarray, unlabelled: np.ndarray, n_p: int, n_u: int, most: int = FEATURES) -> list[str]:
    """Words by how surely their shares of ``n_p`` and ``n_u`` texts differ (log-likelihood ratio)."""
    rate = (positive + unlabelled) / (n_p + n_u)

    def term(k, n):
        return k * np.log(np.maximum(k, 1e-9) / (n * rate)) + (n - k) * np.log(np.maximum(n - k, 1e-9) / np.maximum(n * (1 - rate), 1e-9))

    gain = term(positive, n_p) + term(unlabelled, n_u)
    order = sorted(range(len(names)), key=lambda i: (-gain[i], names[i]))
    return [names[i] for i in order[:most] if gain[i] > 3]


def _sparse(samples: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    rows = np.repeat(np.arange(len(samples)), [len(s) for s in samples])
    return rows, np.concatenate([np.empty(0, np.int64), *(np.asarray(s, np.int64) for s in samples)])


def fit_nnpu(positive: list[list[int]], unlabelled: list[list[int]], prior: float, n_w: int,
             steps: int = STEPS, rate: float = 0.05, decay: float = 3e-4) -> tuple[np.ndarray, float]:
    """Weights of ``n_w`` words, and bias, of a linear classifier of texts given as the places of their words.

    It minimises the non-negative PU risk with logistic loss,
    prior * E_p[l(+)] + max(0, E_u[l(-)] - prior * E_p[l(-)]) (Kiryo et al., 2017). Where the
    second part, an estimate of the negatives' risk, falls below zero, the step goes up that part instead,
    which is what keeps the classifier from fitting the positives away.
    """
    (pr, pc), (ur, uc) = _sparse(positive), _sparse(unlabelled)
    n_p, n_u = max(1, len(positive)), max(1, len(unlabelled))
    w, m, v = np.zeros(n_w + 1), np.zeros(n_w + 1), np.zeros(n_w + 1)
    w[-1] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -40, 40)))

    def slope(rows, columns, per_row):
        return np.append(np.bincount(columns, per_row[rows], n_w)[:n_w], per_row.sum())

    for step in range(1, steps + 1):
        fp = np.bincount(pr, w[pc], len(positive)) + w[-1]
        fu = np.bincount(ur, w[uc], len(unlabelled)) + w[-1]
        negative = np.logaddexp(0, fu).sum() / n_u - prior * np.logaddexp(0, fp).sum() / n_p
        up_p, up_u = slope(pr, pc, sigmoid(fp)) / n_p, slope(ur, uc, sigmoid(fu)) / n_u
        down_p = slope(pr, pc, sigmoid(fp) - 1) / n_p
        gradient = prior * down_p + (up_u - prior * up_p) if negative >= 0 else -(up_u - prior * up_p)
        gradient[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        w = w - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return w[:-1], float(w[-1])


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, also: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, held_out, score, predicted, *also)`` per row of ``docs``; ``score`` estimates P(toxic | text).

    Texts whose CRC of the id is divisible by ``folds`` are held out: neither they nor their labels are
    learned from. The rest gives at most :data:`POSITIVES` confirmed toxic texts and :data:`UNLABELLED`
    texts without regard to labels; of these the driver gets word counts and the places of chosen words. The class prior is the share of toxic ones among the training labels.
    Only words of the text enter a score.

    Null and empty texts get the score of a text without known words. Rows of one id are scored alike if their
    texts are; of several labels for an id any toxic one counts. Without toxic labels every score is 0.
    No rows: no result. Columns of ``docs`` named in ``also`` are handed through, others are ignored.
    """
    spark = docs.sparkSession
    labelled = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    labelled = labelled.where(doc_crc() % folds != 0)
    prior = labelled.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0
    toxic = labelled.where("toxic = 1").orderBy(F.xxhash64("doc_id")).limit(POSITIVES).select("doc_id").collect()
    training = texts(docs).where(doc_crc() % folds != 0)
    words, weights, bias = [], np.empty(0), -40.0
    if toxic:
        ids = F.broadcast(spark.createDataFrame(toxic, labelled.select("doc_id").schema).withColumnRenamed("doc_id", "_id"))
        hashed = F.pmod(F.xxhash64("doc_id", F.lit("u")), F.lit(1 << 30))
        bound = int((1 << 30) * min(1.0, UNLABELLED / max(1, training.count())))
        sample = training.join(ids, F.col("doc_id") == F.col("_id"), "left")
        sample = sample.where((hashed < bound) | F.col("_id").isNotNull())
        sample = sample.select("text", F.col("_id").isNotNull().alias("confirmed"), (hashed < bound).alias("drawn"))

        def reduce(rows: pa.RecordBatch) -> pa.RecordBatch:
            joined = [sorted(w.decode("utf-8", "replace") for w in features(t)) for t in rows.column(0).to_pylist()]
            return pa.RecordBatch.from_arrays([pa.array(joined, pa.list_(pa.string())), rows.column(1), rows.column(2)], ["words", "confirmed", "drawn"])

        sample = materialize(map_batches(sample, reduce, "words array<string>, confirmed boolean, drawn boolean", PART), "sample")
        n_p, n_u = (sample.where(c).count() for c in ("confirmed", "drawn"))
        if n_p and n_u:
            seen = sample.select(F.explode("words").alias("word"), "confirmed", "drawn").groupBy("word")
            seen = seen.agg(*(F.sum(F.col(c).cast("double")).alias(c) for c in ("confirmed", "drawn"))).where("confirmed + drawn >= 3").toPandas()
            words = choose_words(seen["word"].tolist(), seen["confirmed"].to_numpy(), seen["drawn"].to_numpy(), n_p, n_u)
            place = {w: i for i, w in enumerate(words)}

            def locate(rows: pa.RecordBatch) -> pa.RecordBatch:
                found = [[place[w] for w in ws if w in place] for ws in rows.column(0).to_pylist()]
                return pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), rows.column(1), rows.column(2)], ["places", "confirmed", "drawn"])

            got = map_batches(sample, locate, "places array<int>, confirmed boolean, drawn boolean", PART).toPandas()
            weights, bias = fit_nnpu(got["places"][got["confirmed"]].tolist(), got["places"][got["drawn"]].tolist(), prior, len(words))
    model = spark.sparkContext.broadcast((dict(zip([w.encode() for w in words], weights.tolist())), bias))

    def score(rows: pa.RecordBatch) -> pa.RecordBatch:
        weight, bias_ = model.value
        names = weight.keys()
        total = np.array([bias_ + sum(map(weight.__getitem__, sorted(names & features(t)))) for t in rows.column(1).to_pylist()])
        risk = pa.array(1 / (1 + np.exp(-np.clip(total, -700, 700))))
        return pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), risk, *rows.columns[3:]], ["doc_id", "held_out", "score", *also])

    source = docs.select(
        "doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("_bytes"), (doc_crc() % folds == 0).alias("_held"), *also)
    kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = f"doc_id {kinds['doc_id']}, held_out boolean, score double" + "".join(f", `{c}` {kinds[c]}" for c in also)
    return map_batches(source, score, schema, PART).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
