"""A hidden Markov language model: Baum-Welch counts summed over partitions, exact scaled forward scores.

Latent states emit symbols. The most frequent words are symbols of their own; all others fall into classes by
their last bytes, and a class emits its words by their frequency in the class. So every word has a
probability, the states' tables have a fixed size, and what grows with the vocabulary is joined.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, islice, repeat
from math import ceil
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import doc_crc, map_batches, materialize, most_frequent, texts, words_of

STATES = 8
OWN = 61_440       # words with a symbol of their own; symbol 0 is the end of a text
CLASSES = 4_095    # classes of all other words
SYMBOLS = 1 + OWN + CLASSES
KNOWN = 1 << 18    # words whose counts each task holds; the counts of all others are joined
HELD = 1 << 18     # different words at which a task hands on its counts
BLOCK = 4_096      # symbols in one row of partial counts
SEGMENT = 1 << 16  # tokens after which training starts a sequence anew; scoring never does
# Shares of the training texts in the first rounds of Baum-Welch: nested growing parts, at last all of them. Rounds
# over all of them follow until one gains less than SETTLED of the log-likelihood, or MOST have run in all.
ROUNDS = (1 / 32,) * 6 + (1 / 8,) * 4 + (1.0,)
SETTLED, MOST = 1e-4, 100
SLICE = 1 << 22    # tokens whose sequences are grouped by length together, at least one text
SMOOTHING = 0.1
PRIOR = 200.0      # pseudo-tokens by overall frequency that each state starts from


def word_class(word: bytes) -> int:
    return crc32(word[-3:]) % CLASSES


def _class_column():
    return F.pmod(F.crc32(F.expr("substring(word, greatest(length(word) - 2, 1), 3)")), F.lit(CLASSES))


def word_table(training: DataFrame) -> DataFrame:
    """``(word, n)`` over the whole texts of ``training``."""

    def count(batches):
        def flush(held):
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["word", "n"])

        held: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(1).to_pylist():
                held.update(words_of(text))
                if len(held) > HELD:
                    yield flush(held)
                    held = Counter()
        if held:
            yield flush(held)

    counted = texts(training).mapInArrow(count, "word binary, n long")
    return materialize(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")


def slices(column: pa.Array) -> Iterator[list[np.ndarray]]:
    """The symbols of consecutive texts, about :data:`SLICE` at a time, so that memory does not grow with their lengths."""
    held, size = [], 0
    for data in column:
        held.append(np.frombuffer(data.as_buffer(), np.uint16))
        size += len(held[-1])
        if size >= SLICE:
            yield held
            held, size = [], 0
    if held:
        yield held


def sequences(symbols: list[np.ndarray], group: int = 512, area: int = 1 << 19):
    """Groups ``(indices, flat, active)`` of sequences by length: ``flat`` holds, step by step, the t-th symbols of the
    ``active[t]`` sequences that are so long."""
    order = sorted((i for i in range(len(symbols)) if len(symbols[i])), key=lambda i: -len(symbols[i]))
    k = 0
    while k < len(order):
        longest = len(symbols[order[k]])
        n = 1
        while k + n < len(order) and n < group and (n + 1) * longest <= area and 2 * len(symbols[order[k + n]]) + 64 >= longest:
            n += 1
        take = order[k:k + n]
        lengths = np.array([len(symbols[i]) for i in take])
        matrix = np.zeros((longest, n), np.uint16)
        for j, i in enumerate(take):
            matrix[:lengths[j], j] = symbols[i]
        active = np.searchsorted(-lengths, -np.arange(longest), "left")
        yield take, matrix[np.arange(n) < active[:, None]], active
        k += n


def _steps(active: np.ndarray):
    """``(begin, end, n)`` of each step's symbols in ``flat``."""
    ends = np.cumsum(active)
    return list(zip((ends - active).tolist(), ends.tolist(), active.tolist()))


def forward(symbols: list[np.ndarray], start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
    """Natural log-likelihood of each whole sequence, by the scaled forward recursion in double precision."""
    out = np.zeros(len(symbols))
    start, move, emit = (np.ascontiguousarray(x, np.float64) for x in (start, move, emit))
    ones = np.ones_like(move)
    for take, flat, active in sequences(symbols):
        logs = np.zeros(len(take))
        room = np.empty((4, len(take), len(start)))
        before = None
        for t, (begin, end, n) in enumerate(_steps(active)):
            a, b, total = room[t % 2, :n], room[2, :n], room[3, :n]
            emit.take(flat[begin:end], 0, b, "clip")
            np.multiply(start if before is None else np.dot(before[:n], move, a), b, a)
            np.dot(a, ones, total)  # the sum of a row in each of its columns, so that dividing is one flat pass
            np.divide(a, total, a)
            logs[:n] += np.log(total[:, 0])
            before = a
        out[take] = logs
    return out


class Counts:
    """Expected counts of one Baum-Welch step."""

    def __init__(self, states: int = STATES, symbols: int = SYMBOLS) -> None:
        self.start, self.move, self.emit = np.zeros(states), np.zeros((states, states)), np.zeros((symbols, states))
        self.loglik = 0.0
        self._seen: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, symbols: list[np.ndarray], start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        start, move, emit = (np.ascontiguousarray(x, np.float32) for x in (start, move, emit))
        back, ones, moved = np.ascontiguousarray(move.T), np.ones_like(move), np.zeros(move.shape)
        for take, flat, active in sequences(symbols):
            steps = _steps(active)
            ahead = emit.take(flat, 0)  # first what a state emits, then that over the scale, at last that times beta
            alphas, scales = np.empty_like(ahead), np.empty(len(flat), np.float32)
            room = np.empty((len(take), len(start)), np.float32)
            before = None
            for begin, end, n in steps:
                a, b, total = alphas[begin:end], ahead[begin:end], room[:n]
                np.multiply(start if before is None else np.dot(before[:n], move, a), b, a)
                np.dot(a, ones, total)  # the sum of a row in each of its columns, so that dividing is one flat pass
                np.divide(a, total, a)
                np.divide(b, total, b)
                scales[begin:end] = total[:, 0]
                before = a
            self.loglik += float(np.log(scales).sum(dtype=np.float64))
            # where a sequence ends beta is one; alphas become the shares of the states
            for (begin, _, _), (of, end, n) in zip(steps[-2::-1], steps[:0:-1]):
                a, weighted, beta = alphas[begin:begin + n], ahead[of:end], room[:n]
                moved += np.dot(a.T, weighted)
                np.dot(weighted, back, beta)
                np.multiply(a, beta, a)
                b = ahead[begin:begin + n]
                np.multiply(b, beta, b)
            self.start += alphas[:active[0]].sum(0)
            self._seen.append((flat, alphas))
            if sum(len(f) for f, _ in self._seen) > 1 << 19:
                self._settle()
        self.move += move * moved

    def _settle(self) -> None:
        if self._seen:
            flat = np.concatenate([f for f, _ in self._seen])
            posts = np.concatenate([p for _, p in self._seen])
            for k in range(posts.shape[1]):
                self.emit[:, k] += np.bincount(flat, posts[:, k], self.emit.shape[0])
            self._seen = []

    def rows(self):
        """Rows ``(block, data)``: the tables in pieces, single precision."""
        self._settle()
        yield -1, np.concatenate([self.start, self.move.ravel(), [self.loglik]]).astype(np.float64).tobytes()
        for k in range(0, len(self.emit), BLOCK):
            yield k // BLOCK, self.emit[k:k + BLOCK].astype(np.float32).tobytes()


def _summed(rows: DataFrame, *by: str) -> DataFrame:
    """Sum the pieces of each block, one at a time."""

    def add(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = key[0].as_py(), None
        for batch in batches:
            for data in batch.column("data").to_pylist():
                x = np.frombuffer(data, np.float64 if block < 0 else np.float32)
                total = x.astype(np.float64) if total is None else total + x
        data = total.astype(np.float64 if block < 0 else np.float32).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([data], pa.binary())], ["block", "data"])

    return rows.groupBy(*by).applyInArrow(add, "block int, data binary")


def baum_welch(encoded: DataFrame, overall: np.ndarray, rounds=ROUNDS, states: int = STATES, seed: int = 11):
    """Tables ``(start, move, emit)`` fitted to the symbol sequences ``encoded(doc_id, symbols)``.

    ``overall`` is the share of each symbol. Each round sums expected counts within tasks, then over groups
    of tasks, then over groups; the driver sees tables of fixed size. Early rounds read a part of the texts,
    drawn by a hash of the id, to leave the flat start cheaply; a part without texts is passed over. If the
    last of ``rounds`` reads every training text, further such rounds follow until the likelihood settles.
    """
    spark = encoded.sparkSession
    tasks = encoded.rdd.getNumPartitions()
    rng = np.random.default_rng(seed)
    emit = overall[:, None] * np.exp(rng.normal(0, 1, (len(overall), states)))
    emit /= emit.sum(0)
    move = np.full((states, states), 0.1 / states) + np.eye(states) * 0.9
    start = np.full(states, 1 / states)
    before = None
    for share in islice(chain(rounds, repeat(rounds[-1])), max(MOST, len(rounds)) if rounds[-1] == 1 else len(rounds)):
        model = spark.sparkContext.broadcast((start, move, emit))

        def expect(batches):
            counts = Counts(states, len(overall))
            for batch in batches:
                for raw in slices(batch.column(0)):
                    counts.add([s[k:k + SEGMENT] for s in raw for k in range(0, len(s), SEGMENT)], *model.value)
            block, data = zip(*counts.rows())
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int32()), pa.array(data, pa.binary())], ["block", "data"])

        part = encoded.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20))).select("symbols")
        # a step costs much the same for few sequences as for many, so a small part is read by fewer tasks
        part = part.coalesce(max(1, min(tasks, ceil(2 * share * tasks))))
        partial = part.mapInArrow(expect, "block int, data binary")
        partial = partial.withColumn("some", F.floor(F.spark_partition_id() / 64))
        got = {r.block: r.data for r in _summed(_summed(partial, "block", "some"), "block").collect()}
        model.unpersist()
        head = np.frombuffer(got[-1], np.float64) if got else np.zeros(states)
        if not head[:states].any():
            if share == 1:
                break
            continue
        loglik = head[-1] if share == 1 else None
        start = head[:states] + 1
        move = head[states:states + states * states].reshape(states, states) + 1
        emit = np.concatenate([np.frombuffer(got[k], np.float32) for k in range(len(got) - 1)]).reshape(-1, states)
        emit = emit.astype(np.float64) + PRIOR * overall[:, None]
        start, move, emit = start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0)
        if before is not None and loglik - before < SETTLED * abs(before):
            break
        before = loglik
    return start, move, emit


def score_texts(docs: DataFrame, folds: int = 10, rounds=ROUNDS) -> DataFrame:
    """Log10 probabilities of all whole texts under the hidden Markov model and under the unigram base.

    ``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` per row of ``docs``; texts whose
    CRC of the id is divisible by ``folds`` are held out, all others are learned from. Words that training
    has not seen share one place in their class.

    Null and empty texts are the end token alone. Repeated rows are scored once each, and learned from as
    often as they occur. Texts of any length are scored as one sequence. Without training texts each
    symbol is equally likely. No rows: no result. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.withColumn("held_out", doc_crc() % folds == 0)
    training = docs.where("not held_out")
    table = word_table(training)
    ends = training.count()
    facts = table.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    tokens, kinds = (facts.n or 0) + ends, facts.v + (1 if ends else 0)
    spread = np.log10(tokens + SMOOTHING * (kinds + 1))

    top = most_frequent(table, "word", KNOWN)
    top_words, top_n = [bytes(w) for w in top["word"]], top["n"].to_numpy(np.float64)
    # sums of the classes, over all words without an own symbol
    per_class = table.groupBy(_class_column().alias("class")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    class_n, class_v = np.zeros(CLASSES), np.zeros(CLASSES)
    for r in per_class:
        class_n[r["class"]], class_v[r["class"]] = r.n, r.v
    for w, n in zip(top_words[:OWN], top_n[:OWN]):
        class_n[word_class(w)] -= n
        class_v[word_class(w)] -= 1
    class_spread = np.log10(class_n + SMOOTHING * (class_v + 1))

    overall = np.zeros(SYMBOLS)
    overall[0] = ends
    overall[1:1 + len(top_n[:OWN])] = top_n[:OWN]
    overall[1 + OWN:] = class_n
    overall = (overall + SMOOTHING) / (overall + SMOOTHING).sum()

    classes = np.array([word_class(w) for w in top_words], np.int64)
    places = np.arange(len(top_words))
    symbol_of = np.where(places < OWN, 1 + places, 1 + OWN + classes).astype(np.uint16)
    base_of = np.log10(top_n + SMOOTHING) - spread
    within_of = np.where(places < OWN, 0.0, np.log10(top_n + SMOOTHING) - class_spread[classes])
    end_base = np.log10(ends + SMOOTHING) - spread
    known = spark.sparkContext.broadcast(({w: i for i, w in enumerate(top_words)}, symbol_of, base_of, within_of))

    def encode(batches):
        place, symbols_, base_, within_ = known.value
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                out, rare, rare_n, lists = [], [], [], [0]
                for text in part.column(1).to_pylist():
                    words = words_of(text)
                    at_ = np.fromiter(map(place.get, words, repeat(-1)), np.int64, len(words))
                    new = np.flatnonzero(at_ < 0)
                    seq = np.zeros(len(words) + 1, np.uint16)
                    if len(symbols_):
                        seq[:-1] = symbols_[at_]
                    others = [words[i] for i in new]
                    seq[new] = [1 + OWN + word_class(w) for w in others]
                    hit = at_[at_ >= 0]
                    tf = Counter(others)
                    rare += tf.keys()
                    rare_n += tf.values()
                    lists.append(len(rare))
                    out.append((seq.tobytes(), len(seq), len(hit) + (ends > 0), base_[hit].sum() + end_base, within_[hit].sum()))
                seqs, n, n_known, base, within = zip(*out)
                lists = pa.array(lists, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(seqs, pa.binary()), pa.array(n, pa.int64()), pa.array(n_known, pa.int64()),
                     pa.array(base, pa.float64()), pa.array(within, pa.float64()),
                     pa.ListArray.from_arrays(lists, pa.array(rare, pa.binary())), pa.ListArray.from_arrays(lists, pa.array(rare_n, pa.int64()))],
                    ["doc_id", "held_out", "symbols", "n_tokens", "n_known", "base", "within", "rare", "rare_n"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    encoded = texts(docs, "held_out").mapInArrow(
        encode, f"doc_id {kind}, held_out boolean, symbols binary, n_tokens long, n_known long, base double, within double, "
                "rare array<binary>, rare_n array<long>")
    encoded = materialize(encoded.withColumn("row", F.monotonically_increasing_id()), "encoded")

    # rare words: their counts by a join, one sum per text back
    rare = encoded.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("r")).select("row", F.col("r.rare").alias("word"), F.col("r.rare_n").alias("tf"))
    spreads = spark.createDataFrame([(i, float(x)) for i, x in enumerate(class_spread)], "class long, class_spread double")
    rare = rare.join(table, "word", "left").withColumn("class", _class_column()).join(F.broadcast(spreads), "class")
    log = F.log10(F.coalesce("n", F.lit(0)) + F.lit(SMOOTHING))
    sums = rare.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("tf")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("tf") * (log - float(spread))).alias("rare_base"),
        F.sum(F.col("tf") * (log - F.col("class_spread"))).alias("rare_within"))

    model = spark.sparkContext.broadcast(baum_welch(encoded.where("not held_out"), overall, rounds))

    def likelihood(rows: pa.RecordBatch) -> pa.RecordBatch:
        found = [forward(symbols, *model.value) for symbols in slices(rows.column(1))]
        return pa.RecordBatch.from_arrays([rows.column(0), *rows.columns[2:], pa.array(np.concatenate(found) / np.log(10))], rows.schema.names[:1] + rows.schema.names[2:] + ["path"])

    scored = map_batches(encoded.select("row", "symbols", "doc_id", "held_out", "n_tokens", "n_known", "base", "within"), likelihood,
                         f"row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, within double, path double")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    return scored.join(sums, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + zero("rare_known")).alias("n_known"), F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + zero("rare_base")).alias("base_score"), (F.col("path") + F.col("within") + zero("rare_within")).alias("score"))
