"""Whitening against exact fractions and a plain eigendecomposition."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from adpulse.llm import whitening


def check(spark, rows, components=16, zero=0):
    """Compare with plain arithmetic over ``rows`` of one width; ``zero`` components have no spread."""
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string").repartition(3), components).collect()
    kept = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v, _ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, width = len(fit), len(fit[0])
    sums = [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(n * v - s, n)) for v, s in zip(x, sums)] for x in fit])
    e, vectors = np.linalg.eigh(centred.T @ centred / n)
    e, vectors = e[::-1], vectors[:, ::-1]
    k = min(components, width)
    assert len(got) == len(kept) * k
    by_id: dict = {}
    for r in got:
        by_id.setdefault(r.vec_id, {})[r.component] = r
    signs = {}
    for i, x in kept:
        y = np.array([float(Fraction(n * v - s, n)) for v, s in zip(x, sums)])
        for c in range(1, k + 1):
            r = by_id[i][c]
            dev = sum((n * v - s) ** 2 for v, s in zip(x, sums))
            assert r.n == n and r.deviation == (dev if dev < 2 ** 63 else None)
            if c > width - zero:
                assert r.whitened is None and r.explained == 0
                continue
            assert r.explained == pytest.approx(e[c - 1] / e.sum(), rel=1e-6) and r.identity_error < 1e-9
            want = y @ vectors[:, c - 1] / np.sqrt(e[c - 1])
            if abs(want) > 1e-3:
                signs.setdefault(c, np.sign(want * r.whitened))
            assert r.whitened * signs.get(c, 1) == pytest.approx(want, abs=2e-6)


def test_random(spark):
    g = np.random.default_rng(1)
    rows = [(i, (g.normal(size=6) * [3, 2, 1, .7, .5, .3]).tolist(), "clash") for i in range(300)]
    check(spark, rows + [(1000 + i, rows[i % 5][1], "clash") for i in range(400)], 4)


def test_nulls_and_bad_values(spark):
    g = np.random.default_rng(2)
    rows = [(i, g.normal(size=3).tolist(), None) for i in range(40)]
    rows += [(90, None, None), (91, [1.0, None, 2.0], None), (92, [float("nan")] * 3, None), (93, [float("inf"), 1.0, 2.0], None), (94, [], None)]
    check(spark, rows)


def test_directions_without_spread(spark):
    g = np.random.default_rng(3)
    a = g.integers(-50, 50, size=(60, 2))
    rows = [(i, [float(x), float(y), float(x + y), 4.0], None) for i, (x, y) in enumerate(a.tolist())]
    check(spark, rows, zero=2)


def test_very_uneven_spread(spark):
    g = np.random.default_rng(4)
    rows = [(i, (g.normal(size=4) * [1e7, 1e3, 10, 0.1]).tolist(), None) for i in range(200)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string")).collect()
    assert max(r.identity_error for r in got) < 1e-6 and all(r.whitened is not None for r in got)


def test_large_values_one_vector_and_none(spark):
    schema = "vec_id long, embedding array<double>"
    big = [(1, [1e15, 2.0]), (2, [-1e15, 1.0]), (3, [5.0, 3.0]), (4, [1e300, 1.0])]
    got = whitening.whiten(spark.createDataFrame(big, schema)).collect()
    assert {r.vec_id for r in got} == {1, 2, 3} and all(r.deviation is None for r in got if r.vec_id < 3)
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one} == {(1, 0, None, None, None)} and len(one) == 4
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []


def test_widths_apart(spark):
    g = np.random.default_rng(5)
    rows = [(i, g.normal(size=2 + i % 2).tolist()) for i in range(60)]
    got = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert len(got) == 30 * 2 + 30 * 3 and {r.n for r in got} == {30}


def test_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    check(spark, [(r.vec_id, [float(c) for c in r.embedding], None) for r in rows])
