"""Operators on documents against plain versions, on the smallest tables and on awkward rows."""

from __future__ import annotations

import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from adpulse.llm import hmm, minhash, mixing, packing, pretokens, queries, simhash, suffix, tokencount, toxicity
from adpulse.llm.common import shingle_hashes, words_of

from . import brute
from .conftest import EDGE, SF

BPE = queries.tokenizer_path()


def ordered(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def unsigned(x):
    return x & (1 << 64) - 1


# --- SimHash

@pytest.mark.parametrize("near", [4, 12])
def test_simhash_components(docs, rows, near):
    got = simhash.simhash_components(docs, 4, 4) if near == 4 else simhash.simhash_components(docs, 1, 6)
    size, near = (4, 4) if near == 4 else (1, 6)
    want = brute.components([(r.doc_id, brute.simhash(r.text, size)) for r in rows], near)
    assert sorted((d, unsigned(f), c) for d, f, c in ordered(got, "doc_id", "fp", "component_id")) == sorted(want)


def test_simhash_edge(edge, empty):
    got = [(d, unsigned(f), c) for d, f, c in ordered(simhash.simhash_components(edge), "doc_id", "fp", "component_id")]
    want = brute.components([(d, brute.simhash(t, 4)) for d, t, *_ in EDGE], 4)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert simhash.simhash_components(empty).count() == 0


def test_crowded_blocks_keep_every_link(spark, monkeypatch):
    rng = np.random.default_rng(3)
    centre = int(rng.integers(1 << 62))
    prints = {centre ^ sum(1 << int(b) for b in rng.choice(60, rng.integers(0, 6), replace=False)) for _ in range(150)}
    nodes = spark.createDataFrame([(p, p) for p in prints], "node long, fp long")
    monkeypatch.setattr(simhash, "CROWDED", 3)
    edges = simhash.close_pairs(nodes, len(prints), 4)
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    want = {p: c for _, p, c in brute.components([(p, p) for p in prints], 4)}
    assert {p: got.get(p, p) for p in prints} == want


def test_near_duplicate_groups(spark):
    base = " ".join(f"w{i * 7919 % 1013}" for i in range(400))
    near = base.replace("w7919 ", "changed ").replace(base.split()[200], "other")
    far = " ".join(f"v{i * 104729 % 2003}" for i in range(400))
    df = spark.createDataFrame([(5, base), (3, near), (9, base), (4, far), (8, None), (7, "")], "doc_id long, text string")
    assert ordered(simhash.near_duplicate_groups(df), "doc_id", "group_id") == [(3, 3), (4, 4), (5, 3), (7, 7), (8, 7), (9, 3)]


# --- hidden Markov model

def test_forward_is_the_sum_over_paths():
    rng = np.random.default_rng(1)
    k, s = 3, 5
    start, move, emit = rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(s), k).T
    seqs = [rng.integers(0, s, n).astype(np.uint16) for n in (1, 4, 6, 2)]
    for seq, got in zip(seqs, hmm.forward(seqs, start, move, emit)):
        total = 0
        for path in np.ndindex(*(k,) * len(seq)):
            p = start[path[0]] * emit[seq[0], path[0]]
            for t in range(1, len(seq)):
                p *= move[path[t - 1], path[t]] * emit[seq[t], path[t]]
            total += p
        assert got == pytest.approx(math.log(total), rel=1e-9)


def test_expected_counts():
    rng = np.random.default_rng(2)
    k, s = 2, 4
    start, move, emit = rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(s), k).T
    seqs = [rng.integers(0, s, n).astype(np.uint16) for n in (5, 3, 1, 5)]
    counts = hmm.Counts(k, s)
    counts.add(seqs, start, move, emit)
    counts._settle()
    w_start, w_move, w_emit = np.zeros(k), np.zeros((k, k)), np.zeros((s, k))
    for seq in seqs:
        paths, ps = list(np.ndindex(*(k,) * len(seq))), []
        for path in paths:
            p = start[path[0]] * emit[seq[0], path[0]]
            for t in range(1, len(seq)):
                p *= move[path[t - 1], path[t]] * emit[seq[t], path[t]]
            ps.append(p)
        for path, p in zip(paths, np.array(ps) / sum(ps)):
            w_start[path[0]] += p
            for t in range(len(seq)):
                w_emit[seq[t], path[t]] += p
                if t:
                    w_move[path[t - 1], path[t]] += p
    assert np.allclose(counts.start, w_start, atol=1e-4) and np.allclose(counts.move, w_move, atol=1e-4) and np.allclose(counts.emit, w_emit, atol=1e-4)


def base_scores(rows):
    train = [w for d, t in rows if brute.crc(d) % 10 for w in [*brute.words(t), None]]
    c, n = Counter(train), len(train)
    v = len(c)
    out = []
    for d, t in rows:
        tokens = [*brute.words(t), None]
        out.append((d, brute.crc(d) % 10 == 0, len(tokens), sum(c[w] > 0 for w in tokens), n,
                    round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens), 4)))
    return sorted(out, key=str)


@pytest.mark.parametrize("known", [1 << 18, 50])
def test_base_score(docs, rows, known, monkeypatch):
    monkeypatch.setattr(hmm, "KNOWN", known)
    monkeypatch.setattr(hmm, "OWN", min(hmm.OWN, known))
    monkeypatch.setattr(hmm, "SYMBOLS", 1 + min(hmm.OWN, known) + hmm.CLASSES)
    got = hmm.score_texts(docs, rounds=(1.0,)).withColumn("b", F.round("base_score", 4))
    assert ordered(got, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "b") == base_scores([(r.doc_id, r.text) for r in rows])


def test_hmm_beats_the_base_on_held_out_texts(spark):
    got = hmm.score_texts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    r = got.where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert r.s / r.n > r.b / r.n + 0.05


def test_hmm_edge(edge, empty):
    got = hmm.score_texts(edge, rounds=(1.0,)).withColumn("b", F.round("base_score", 4))
    assert ordered(got, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "b") == base_scores([(d, t) for d, t, *_ in EDGE])
    assert all(r.score < 0 and math.isfinite(r.score) for r in got.collect())
    assert hmm.score_texts(empty).count() == 0


# --- MinHash

def test_minhash_estimates(docs, rows):
    got = {r.doc_id: r for r in minhash.fingerprint_with_next(docs, rows_per_range=30).collect()}
    assert len(got) == len(rows)
    errors = []
    for r, following in zip(rows, rows[1:] + rows[:1]):
        half = len(r.text) // 2
        changed = r.text[:len(r.text) - half] + following.text[:half]
        g = got[r.doc_id]
        assert g.n_chars == len(r.text) and g.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        sets = [set(shingle_hashes(words_of(t.encode()), 5).tolist()) or {0} for t in (r.text, changed, following.text)]
        for estimate, other in ((g.near_edited, sets[1]), (g.near_next, sets[2])):
            errors.append((len(sets[0] | other), estimate - len(sets[0] & other) / len(sets[0] | other)))
    sizes, errors = np.array(errors).T
    # few shingles fill few bins, and what is copied from them varies together
    assert abs(errors.mean()) < 0.01 and np.abs(errors).max() < 0.3 and np.abs(errors[sizes > 200]).max() < 0.12
    again = {r.doc_id: tuple(r) for r in minhash.fingerprint_with_next(docs, rows_per_range=1000).collect()}
    assert again == {d: tuple(r) for d, r in got.items()}


def test_densification_is_consistent_between_its_two_paths():
    rng = np.random.default_rng(5)
    order, place = minhash._orders(minhash.BINS)
    for n in (1, 3, 70, 300, 2000):
        h = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        shift = np.uint64(64 - 9)
        want = np.zeros(minhash.BINS, np.uint64)
        by_bin = {}
        for x in h.tolist():
            by_bin[x >> int(shift)] = min(x, by_bin.get(x >> int(shift), x))
        for b in range(minhash.BINS):
            want[b] = by_bin[b] if b in by_bin else by_bin[next(int(j) for j in order[b] if int(j) in by_bin)]
        assert (minhash.bin_minima(h) == want).all()


def test_minhash_edge(edge, empty, spark):
    got = minhash.fingerprint_with_next(edge, rows_per_range=2).collect()
    assert len(got) == len(EDGE)
    by_text = {}
    for r in got:
        by_text.setdefault(next(t or "" for d, t, *_ in EDGE if d == r.doc_id), set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    one = minhash.fingerprint_with_next(spark.createDataFrame([(1, "a b c d e f g")], "doc_id long, text string")).collect()
    assert one[0].near_next == 1.0
    assert minhash.fingerprint_with_next(empty).count() == 0


# --- toxicity

def test_toxicity_on_held_out_labels(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    r = toxicity.score_toxicity(docs, labels).where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").toPandas()
    assert ((r.predicted == r.toxic).mean()) > 0.95
    positive, negative = r.score[r.toxic == 1].to_numpy(), r.score[r.toxic == 0].to_numpy()
    assert (positive[:, None] > negative[None, :]).mean() > 0.9


def test_toxicity_edge(edge, empty, spark):
    labels = spark.createDataFrame([(1, 0), (6, 1), (7, 1), (7, None), (None, 1)], "doc_id long, toxic int")
    got = toxicity.score_toxicity(edge, labels)
    assert got.count() == len(EDGE) and got.where("score is null or score < 0 or score > 1").count() == 0
    assert {(r.doc_id, r.held_out) for r in got.collect()} == {(d, brute.crc(d) % 5 == 0) for d, *_ in EDGE}
    assert toxicity.score_toxicity(edge, labels.where("false")).where("predicted = 1").count() == 0
    assert toxicity.score_toxicity(empty, labels).count() == 0


# --- suffix arrays

@pytest.mark.parametrize("length", [400, 60])
def test_repeats_removed(docs, rows, length, spark, monkeypatch):
    monkeypatch.setattr(suffix, "SHARD", 3000)
    chosen = rows[:60] if length == 60 else rows
    df = spark.createDataFrame([(r.doc_id, r.text) for r in chosen], "doc_id long, text string")
    got = suffix.remove_repeats(df, length).withColumn("h", F.sha2("kept", 256))
    want = brute.without_repeats([r.text for r in chosen], length)
    assert ordered(got, "doc_id", "n_bytes", "n_removed", "n_spans", "h") == sorted([(r.doc_id, *w) for r, w in zip(chosen, want)], key=str)


def test_crowded_names_give_the_same(docs, rows, spark, monkeypatch):
    df = spark.createDataFrame([(r.doc_id, r.text) for r in rows[:60]], "doc_id long, text string")
    plain = ordered(suffix.remove_repeats(df, 100), "doc_id", "n_removed", "n_spans")
    monkeypatch.setattr(suffix, "CROWDED", 20)
    assert ordered(suffix.remove_repeats(df, 100), "doc_id", "n_removed", "n_spans") == plain


def test_repeats_edge(edge, empty):
    got = suffix.remove_repeats(edge, 400).withColumn("h", F.sha2("kept", 256))
    want = brute.without_repeats([t for _, t, *_ in EDGE], 400)
    assert ordered(got, "doc_id", "n_bytes", "n_removed", "n_spans", "h") == sorted([(d, *w) for (d, *_), w in zip(EDGE, want)], key=str)
    assert suffix.remove_repeats(empty, 400).count() == 0


def test_family_of_levels_finds_what_one_array_finds():
    rng = np.random.default_rng(8)
    segments = [bytes(rng.integers(97, 99, rng.integers(20, 60)).astype(np.uint8)) for _ in range(40)]
    windows = Counter(s[i:i + 12] for s in segments for i in range(len(s) - 11))
    want = [suffix.ranges(np.array([windows[s[i:i + 12]] > 1 for i in range(len(s) - 11)])) for s in segments]
    for batch in (1, 50, 10_000):
        assert suffix.repeated_windows(segments, 12, batch) == want
    family = suffix.SuffixIndexFamily(12)
    for k, s in enumerate(segments):
        family.add(s, np.arange(len(s) - 11), np.full(len(s) - 11, k))
    sizes = [len(level.starts) for level in family.levels]
    assert sizes == sorted(sizes, reverse=True) and len(sizes) < 12
    level = family.levels[0]
    assert level.prefixes() == sorted(level.prefixes())


# --- tokens

AWKWARD = ["", " ", "a", " a", "a ", "a  b", "a \n b", "a\n b", "a \nb", "\n\n a", "it's  'll  we're", "x<|endoftext|>y <|endoftext|> z", "é ü  ñ 　中 文",
           "\x1c a \x1f b", "tabs\t \tmix \r\n x", "1 2  3,4 5", "🙂 🙂  🙂", " leading and trailing ", "a  b", "a\x85 b"]


def test_pretokens_join_to_the_tokenizers_ids(rows):
    texts = AWKWARD + [r.text for r in rows]
    want = [np.array(e.ids, "<u4").tobytes() for e in pretokens.tokenizer(BPE).encode_batch(texts, add_special_tokens=False)]
    assert pretokens.encode(texts, BPE) == want and pretokens.encode(texts, BPE) == want
    assert all("".join(pretokens.pretokens(t)) == t for t in texts)


@pytest.mark.parametrize("frequent", [1 << 18, 20])
def test_token_counts(docs, rows, edge, empty, frequent, monkeypatch):
    monkeypatch.setattr(tokencount, "FREQUENT", frequent)
    for df, plain in ((docs, [(r.doc_id, r.text) for r in rows]), (edge, [(d, t) for d, t, *_ in EDGE])):
        counts = [len(e.ids) for e in pretokens.tokenizer(BPE).encode_batch([t or "" for _, t in plain], add_special_tokens=False)]
        want = [(d, len((t or "").encode()), n) for (d, t), n in zip(plain, counts)]
        assert ordered(tokencount.token_counts(df, BPE), "doc_id", "n_bytes", "n_tokens") == sorted(want, key=str)
    assert tokencount.token_counts(empty, BPE).count() == 0


def check_packing(pieces, plain):
    import zlib

    found = Counter()
    by_sequence: dict = {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        found[(p.doc_id, p.piece, p.start, p.length, p.ids_crc32)] += 1
    for parts in by_sequence.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 2048
    want = Counter()
    for (d, t), e in zip(plain, pretokens.tokenizer(BPE).encode_batch([t or "" for _, t in plain], add_special_tokens=False)):
        ids = [*e.ids, 0]
        at, k = 0, 0
        while at < len(ids):
            n = len(ids) % 2048 or 2048 if k == 0 else 2048
            part = ids[at:at + n]
            want[(d, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
            at, k = at + n, k + 1
    assert found == want
    assert len(by_sequence) <= math.ceil(sum(p.length for p in pieces) / 2048) * 1.02 + 1


def test_packing(docs, rows, edge, empty, monkeypatch):
    monkeypatch.setattr(packing, "SLICE", 40)
    check_packing(packing.pack(docs, BPE).collect(), [(r.doc_id, r.text) for r in rows])
    check_packing(packing.pack(edge, BPE).collect(), [(d, t) for d, t, *_ in EDGE])
    assert packing.pack(empty, BPE).count() == 0


def test_best_fit_plan_fills_slots_once():
    rng = np.random.default_rng(4)
    histogram = {int(n): int(c) for n, c in zip(rng.integers(1, 101, 40), rng.integers(1, 50, 40))}
    used, taken = Counter(), Counter()
    for length, low, high, first, offset in packing.best_fit_plan(histogram, 100):
        for k in range(high - low):
            taken[(length, low + k)] += 1
            for i in range(length):
                used[(first + k, offset + i)] += 1
    assert set(used.values()) == {1} and set(taken.values()) == {1}
    assert Counter(n for n, _ in taken) == Counter(histogram) and max(o for _, o in used) < 100


# --- mixing

def water_fill(sizes: dict, share=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, capped = share * sum(sizes.values()), set()
    while True:
        free = sum(weight[s] for s in names if s not in capped)
        rest = total - sum(cap * sizes[s] for s in capped)
        over = {s for s in names if s not in capped and rest * weight[s] / free > cap * sizes[s]}
        if not over or not free:
            return {s: float(cap * sizes[s]) if s in capped else rest * weight[s] / free for s in names}
        capped |= over


def test_mixing(docs, rows, edge, empty, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE", 10)
    for df, plain in ((docs, [(r.doc_id, r.text, r.source) for r in rows]), (edge, [(d, t, s) for d, t, s, _ in EDGE])):
        sizes: dict = Counter()
        for _, t, s in plain:
            sizes[s] += len(brute.words(t))
        targets = water_fill(sizes)
        got = mixing.mix(df).collect()
        assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((d, s, len(brute.words(t))) for d, t, s in plain)
        taken, most = Counter(), Counter()
        for r in got:
            assert r.target == targets[r.source] and r.source_size == sizes[r.source] and 0 <= r.repeats <= 2
            taken[r.source] += r.size * r.repeats
            most[r.source] = max(most[r.source], r.size)
        assert all(abs(taken[s] - targets[s]) <= most[s] for s in targets)
        assert Counter(map(tuple, got)) == Counter(map(tuple, mixing.mix(df.repartition(5)).collect()))
    assert mixing.mix(empty).count() == 0


def test_registered_queries_match_sql(spark):
    from ..compare import connect, difference

    con = connect(SF)
    for name, sql in queries.ORACLES.items():
        assert difference(queries.QUERIES[name](spark, SF).toPandas(), con.execute(sql).df()) is None, name
