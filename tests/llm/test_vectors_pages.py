"""KD-tree search and page extraction against plain versions."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from adpulse.llm import kdtree, pages


def plain_top(rows, k, every):
    kept = {}
    for i, x in rows:
        if i is not None and x and all(v is not None and math.isfinite(v) for v in x):
            kept[(i, tuple(math.floor(1024 * float(np.float32(v))) for v in x))] = None
    out = set()
    for q, a in kept:
        if q % every == 0:
            best = {(-sum(u * v for u, v in zip(a, b)), c) for c, b in kept if c != q and len(a) == len(b)}
            out |= {(q, r, c, -s) for r, (s, c) in enumerate(sorted(best)[:k], 1)}
    return out


@pytest.mark.parametrize("tree,queries", [(1 << 24, 1024), (60 * 64 * 8, 3)])
def test_top_k(spark, tree, queries, monkeypatch):
    monkeypatch.setattr(kdtree, "TREE_BYTES", tree)
    monkeypatch.setattr(kdtree, "QUERIES", queries)
    monkeypatch.setattr(kdtree, "LEAF", 16)
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    got = kdtree.top_k(df, F.col("vec_id") % 20 == 0, k=10)
    want = plain_top([(r.vec_id, r.embedding) for r in df.collect()], 10, 20)
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == want


def test_top_k_edge(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (2, [1.0, 0.5]), (3, None), (4, [nan, 1.0]), (5, [inf, 0.0]), (6, [None, 1.0]),
            (7, []), (8, [1.0]), (None, [1.0, 1.0]), (9, [-1.0, 0.0]), (10, [0.25, -0.3])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("query", F.lit("clash")).withColumn("x", F.lit(1))
    got = kdtree.top_k(df, F.col("vec_id") % 2 == 0, k=3)
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == plain_top(rows, 3, 2)
    assert kdtree.top_k(df.where("false"), F.col("vec_id") % 2 == 0).count() == 0


@pytest.mark.parametrize("size", [1e5, 1e9, 1e300, 1.7e308])
def test_top_k_of_large_vectors(spark, size, monkeypatch):
    """Against Python's integers; neighbours differ in the last bit of a component, some scores cancel, ties are planted."""
    monkeypatch.setattr(kdtree, "TREE_BYTES", 40 * 8 * 8)
    monkeypatch.setattr(kdtree, "LEAF", 8)
    rng = np.random.default_rng(3)
    rows = [(i, (rng.uniform(-1, 1, 8) * size).tolist()) for i in range(120)]
    for i in range(0, 60, 3):  # a tie, a neighbour and an opposite
        x = rows[i][1]
        rows[i + 60] = (i + 60, x)
        rows[i + 61] = (i + 61, [float(np.nextafter(x[0], 0)), *x[1:]])
        rows[i + 62] = (i + 62, [-v for v in x])
    rows += [(200, [1.5] * 8), (202, [0.0] * 8), (200, [size] + [2.5] * 7), (203, [1.5] * 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = [(i, [math.floor(Fraction(v) * 1024) for v in x]) for i, x in rows]
    want = set()
    for q in {i for i, _ in rows if i % 10 == 0}:
        best = {(-sum(u * v for u, v in zip(a, b)), c) for i, a in whole if i == q for c, b in whole if c != q and len(a) == len(b)}
        want |= {(q, r, c, max(min(-s, 2 ** 63 - 1), -2 ** 63)) for r, (s, c) in enumerate(sorted(best)[:10], 1)}
    got = kdtree.top_k(df, F.col("vec_id") % 10 == 0, k=10).select("query_id", "rank", "vec_id", "score").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_one_id_in_many_rows_spreads_over_shards(spark, monkeypatch):
    monkeypatch.setattr(kdtree, "TREE_BYTES", 50 * 2 * 8)
    rows = [(0 if i % 3 else i, [i / 7, -i / 9]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = kdtree.top_k(df, F.col("vec_id") % 50 == 0, k=5)
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == plain_rows(rows, 5, 50)


def plain_rows(rows, k, every):
    """As ``plain_top``, with all rows of an id as one query."""
    whole = [(i, [math.floor(1024 * float(np.float32(v))) for v in x]) for i, x in rows]
    out = set()
    for q in {i for i, _ in whole if i % every == 0}:
        best = {(-sum(u * v for u, v in zip(a, b)), c) for i, a in whole if i == q for c, b in whole if c != q}
        out |= {(q, r, c, -s) for r, (s, c) in enumerate(sorted(best)[:k], 1)}
    return out


def test_keys_sort_as_numbers():
    numbers = sorted({s * (10 ** e + d) for e in (0, 1, 2, 5, 18, 19, 38, 600) for d in (-1, 0, 1, 255, 256) for s in (-1, 1)} | {2 ** 63, -2 ** 63, 2 ** 63 - 1, 256, 255})
    keys = [kdtree.sortable(n) for n in numbers]
    assert keys == sorted(keys) and [kdtree.from_sortable(k) for k in keys] == numbers


def test_tree_bounds_and_pruning():
    rng = np.random.default_rng(0)
    points = rng.integers(-50, 50, (500, 3)).astype(float)
    tree = kdtree.KDTree(np.arange(500), points, leaf=20)
    q = rng.integers(-50, 50, (10, 3)).astype(float)
    bounds = tree.bounds(q)
    for node, rows in enumerate(tree.rows):
        assert np.allclose(bounds[:, node].max(), bounds[:, node].max()) and (q @ points[rows].T).max(1).max() <= bounds[:, node].max()
        assert ((q @ points[rows].T).max(1) <= bounds[:, node]).all()
    for i in range(10):
        scores = points @ q[i]
        want = sorted(((s, -k) for k, s in enumerate(scores)), reverse=True)[:5]
        assert tree.search(q[i], -1, 5, bounds[i], -np.inf) == want
        assert tree.search(q[i], -1, 5, bounds[i], want[-1][0]) == want


def text(page: str) -> list[str]:
    return [t for t, _ in pages.page_blocks(page)[0]]


def test_article_only():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
      <header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav><div class="ad">Buy</div>
      <article><h1>Title</h1><p>One  &amp;\n two<p><b>Three<br>four</b><div class="share-bar">Share</div><ul><li>x<li>y</ul>
      <form>Mail <input></form><aside>More</aside><section id="comments"><p>First!</section></article>
      <div id="cookie-notice">Cookies</div><footer>&copy; me</footer></body></html>"""
    assert text(page) == ["Title", "One & two", "Three four", "x", "y"]


def test_awkward_markup():
    assert text("<p>a<!-- <p>no --> b<p title='x > y'>c</P>d<td>e") == ["a b", "c", "d", "e"]
    assert text("plain &lt;b&gt; &#233;&nbsp;x &am") == ["plain <b> é x &am"]
    assert text("<article><p>cut off &amp <b>here") == ["cut off & here"]
    assert text("<p>a < b and <3") == ["a < b and <3"]
    assert text("<p>kept<script>if (a<b) '</p>'</script> too<p>open<div class=") == ["kept too", "open"]
    assert text("") == [] and text("<html><body></body></html>") == []


def test_templates_recurring_on_a_host_go(spark):
    rows = [(i, "http://a.org/x", f"<body><div class=x><p>Shared strip</p></div><p>Own text {i}</p></body>") for i in range(12)]
    rows += [(100 + i, "http://b.org/x", f"<body><div class=x><p>Shared strip</p></div><p>Rare {i}</p></body>") for i in range(2)]
    rows += [(200 + i, "http://a.org/y", "<article><p>Same article</p></article>") for i in range(8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.main_text(df).collect()}
    assert all(got[i] == f"Own text {i}" for i in range(12))
    assert all(got[100 + i] == f"Shared strip\nRare {i}" for i in range(2))
    assert all(got[200 + i] == "Same article" for i in range(8))


def test_pages_edge(spark):
    rows = [(1, None, None), (1, None, None), (2, "http://[bad", ""), (None, "x", "<p>" + "long " * 50_000), (3, "http://a", "<p>t</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("row", F.lit(1))
    got = sorted((tuple(r) for r in pages.main_text(df).collect()), key=str)
    assert got == sorted([(1, None, ""), (1, None, ""), (2, "http://[bad", ""), (None, "x", ("long " * 50_000).strip()), (3, "http://a", "t")], key=str)
    assert pages.main_text(df.where("false")).count() == 0
