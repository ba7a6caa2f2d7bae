"""Baum-Welch reads all training texts until the likelihood settles, and passes over parts without texts."""

from __future__ import annotations

import time

import numpy as np
import pytest

from adpulse.llm import hmm


@pytest.fixture(scope="module")
def encoded(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(60):
        state, seq = 0, []
        for _ in range(50):
            state = state if rng.random() < 0.8 else 1 - state
            seq.append(4 * state + int(rng.integers(0, 4)))
        rows.append((i, bytearray(np.array(seq, np.uint16).tobytes())))
    return spark.createDataFrame(rows, "doc_id long, symbols binary").repartition(2)


def likelihood(encoded, model) -> float:
    return float(hmm.forward([np.frombuffer(r.symbols, np.uint16) for r in encoded.collect()], *model).sum())


def test_full_rounds_go_on_until_the_likelihood_settles(encoded, monkeypatch):
    monkeypatch.setattr(hmm, "PRIOR", 0.1)
    overall = np.full(8, 1 / 8)
    fitted = likelihood(encoded, hmm.baum_welch(encoded, overall, (0.5, 1.0), states=2))
    monkeypatch.setattr(hmm, "MOST", 2)
    once = likelihood(encoded, hmm.baum_welch(encoded, overall, (0.5, 1.0), states=2))
    assert fitted > once + 0.01 * abs(once)


def test_parts_without_texts_keep_the_seeded_start(encoded, monkeypatch):
    monkeypatch.setattr(hmm, "MOST", 2)
    overall = np.full(8, 1 / 8)
    got = hmm.baum_welch(encoded, overall, (0.0, 1.0), states=2)
    assert np.abs(got[2][:, 0] - got[2][:, 1]).max() > 1e-3
    monkeypatch.setattr(hmm, "MOST", 1)
    assert all(np.array_equal(a, b) for a, b in zip(got, hmm.baum_welch(encoded, overall, (1.0,), states=2)))
    nothing = hmm.baum_welch(encoded.where("false"), overall, (0.5, 1.0), states=2)
    assert np.abs(nothing[2][:, 0] - nothing[2][:, 1]).max() > 1e-3


def plain_counts(symbols, start, move, emit, group=512):
    """Baum-Welch counts ``(start, move, emit, log-likelihood)`` in single precision, each step with arrays of its own."""
    k = len(start)
    model = start, move, emit = [x.astype(np.float32) for x in (start, move, emit)]
    starts, moves, emits, loglik = (np.zeros(x.shape) for x in (*model, np.array(0)))
    order = sorted(range(len(symbols)), key=lambda i: -len(symbols[i]))
    for at in range(0, len(order), group):
        some = [symbols[i] for i in order[at:at + group]]
        lengths = np.array([len(s) for s in some])
        matrix = np.zeros((lengths[0], len(some)), np.uint16)
        for j, x in enumerate(some):
            matrix[:len(x), j] = x
        columns = [matrix[t, :n] for t, n in enumerate(np.searchsorted(-lengths, -np.arange(lengths[0]), "left"))]
        alphas, scales, seen = [], [], []
        for column in columns:
            seen.append(emit[column])
            a = (alphas[-1][:len(column)] @ move if alphas else start) * seen[-1]
            scales.append(a.sum(1, keepdims=True))
            alphas.append(a / scales[-1])
        loglik += sum(np.log(s.astype(np.float64)).sum() for s in scales)
        posts, beta, before, ahead = [alphas[-1]], np.ones_like(alphas[-1]), [], []
        for t in range(len(columns) - 2, -1, -1):
            ahead.append(seen[t + 1] * beta / scales[t + 1])
            before.append(alphas[t][:len(columns[t + 1])])
            beta = np.ones_like(alphas[t])
            beta[:len(columns[t + 1])] = ahead[-1] @ move.T
            posts.append(alphas[t] * beta)
        if ahead:
            moves += move * (np.concatenate(before).T @ np.concatenate(ahead))
        starts += posts[-1].sum(0)
        flat, shares = np.concatenate(columns[::-1]), np.concatenate(posts)
        for i in range(k):
            emits[:, i] += np.bincount(flat, shares[:, i], len(emit))
    return starts, moves, emits, float(loglik)


def drawn(rng, lengths, k=8, s=300):
    model = rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(s), k).T
    return model, [rng.integers(0, s, n).astype(np.uint16) for n in lengths], hmm.Counts(k, s)


def test_counts_agree_with_a_plain_version():
    rng = np.random.default_rng(5)
    model, symbols, counts = drawn(rng, [1, 1, 2, 2, 900, 0, 3, *rng.integers(1, 200, 700)])
    counts.add(symbols[:300], *model)
    counts.add(symbols[300:], *model)
    counts.add([], *model)
    list(counts.rows())
    start, move, emit, loglik = plain_counts([x for x in symbols if len(x)], *model)
    assert abs(counts.loglik - loglik) < 1e-6 * abs(loglik)
    for got, want in ((counts.start, start), (counts.move, move), (counts.emit, emit)):
        assert np.abs(got - want).max() < 1e-4 * want.max()


def test_steps_cost_less_than_with_arrays_of_their_own():
    rng = np.random.default_rng(6)
    model, symbols, counts = drawn(rng, np.sort(rng.integers(600, 1000, 150)))

    def seconds(function):
        began = time.thread_time()
        function(symbols, *model)
        return time.thread_time() - began

    mine, plain = (min(x) for x in zip(*((seconds(counts.add), seconds(plain_counts)) for _ in range(8))))
    assert mine < 0.8 * plain, (mine, plain)


def test_small_parts_are_read_by_few_tasks(encoded, monkeypatch, spark):
    monkeypatch.setattr(hmm, "MOST", 2)
    tasks = []

    def seen(rows, *by):
        tasks.append(rows.rdd.getNumPartitions())
        return summed(rows, *by)

    summed = hmm._summed
    monkeypatch.setattr(hmm, "_summed", seen)
    hmm.baum_welch(encoded.repartition(16), np.full(8, 1 / 8), (1 / 16, 1.0), states=2)
    assert tasks[0] <= 2 and tasks[2] == 16
