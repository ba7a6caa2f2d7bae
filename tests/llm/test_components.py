"""Connected components against a plain search."""

from __future__ import annotations

import numpy as np
import pytest

from pyspark.sql import functions as F

from adpulse.llm import common, components


def plain(edges):
    root = {n: n for e in edges for n in e if e[0] != e[1]}

    def top(n):
        while root[n] != n:
            root[n] = n = root[root[n]]
        return n

    for a, b in edges:
        if a != b:
            a, b = sorted((top(a), top(b)))
            root[b] = a
    return {(n, top(n)) for n in root}


def cases():
    rng = np.random.default_rng(1)
    yield "none", []
    yield "loops only", [(3, 3), (4, 4)]
    yield "stars already", [(5, 1), (6, 1), (9, 2), (2, 9)]
    yield "path", [(i, i + 1) for i in range(40)]
    path = (rng.permutation(60) - 30).tolist()
    yield "shuffled path", list(zip(path, path[1:]))
    yield "largest in the middle", [(100, i) for i in range(50)] + [(200, 201)]
    ids = rng.integers(-(1 << 62), 1 << 62, 300).tolist()
    yield "random", [(ids[a], ids[b]) for a, b in rng.integers(0, 300, (250, 2)).tolist()]
    yield "repeated", [(1, 2), (2, 1), (1, 2), (-7, 2)]


@pytest.mark.parametrize("edges", [pytest.param(e, id=n) for n, e in cases()])
def test_components(spark, edges):
    found = components.components(spark.createDataFrame(edges, "a long, b long")).select("node", "root").collect()
    assert len(found) == len({r.node for r in found}) and {tuple(r) for r in found} == plain(edges)


def test_a_large_centre_can_be_split(spark):
    """The side of smallest neighbours is shuffled for the join itself, not taken from its aggregation."""
    pairs = spark.range(1000).selectExpr("id % 500 AS a", "id % 7 AS b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = pairs.join(components._lowest(pairs), "a")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 3 and plan.count("SortMergeJoin") == 1


def test_a_hot_key_can_be_split(spark):
    """A side made by :func:`per_key` is shuffled for the join itself; its rows are those of the plain grouping."""
    rows = spark.range(1000).selectExpr("IF(id % 3 = 0, NULL, id % 7) AS k", "id % 5 AS m", "id")
    found = common.per_key(rows, ["k", "m"], F.count("*").alias("n"), F.max("id").alias("last"))
    assert sorted(map(str, found.collect())) == sorted(map(str, rows.groupBy("k", "m").agg(F.count("*").alias("n"), F.max("id").alias("last")).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = rows.join(found, ["k", "m"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 3 and plan.count("SortMergeJoin") == 1
