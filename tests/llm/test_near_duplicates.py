"""The near-duplicate stage on planted pairs of known Jaccard similarity."""

from __future__ import annotations

import numpy as np

from adpulse.llm import simhash

from . import brute


def jaccard(a: str, b: str) -> float:
    x, y = ({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} for w in (brute.words(a), brute.words(b)))
    return len(x & y) / len(x | y)


def linked(spark, pairs: list[tuple[str, str]]) -> list[bool]:
    rows = [(2 * i + k, t) for i, p in enumerate(pairs) for k, t in enumerate(p)]
    got = {r.doc_id: r.group_id for r in simhash.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    return [got[2 * i] == got[2 * i + 1] for i in range(len(pairs))]


def test_pairs_at_the_limit_are_found_wherever_they_differ(spark):
    rng = np.random.default_rng(5)
    pairs = []
    for i in range(400):
        words = [f"w{x}" for x in rng.integers(0, 50_000, 300)]
        other = list(words)
        if i % 2:  # one passage replaced
            at = int(rng.integers(0, 250))
            other[at:at + 28] = [f"n{x}" for x in rng.integers(0, 50_000, 28)]
        else:      # words replaced here and there
            for at in range(7, 300, 50):
                other[at] = "n" + other[at]
        pairs.append((" ".join(words), " ".join(other)))
    assert all(0.8 <= jaccard(*p) < 0.83 for p in pairs)
    assert sum(linked(spark, pairs)) >= 0.98 * len(pairs)


def test_number_of_bands_gives_the_recall():
    for similarity in (0.5, 0.8, 0.95):
        assert 1 - (1 - similarity ** simhash.BAND) ** simhash.bands_for(similarity) >= simhash.RECALL


def test_pairs_are_judged_by_the_sets_themselves(spark):
    cases = [(4, 0, 1), (5, 0, 1), (12, 0, 3), (42, 5, 5), (3, 0, 1), (11, 0, 3), (42, 5, 6), (79, 10, 10)]
    rng = np.random.default_rng(2)
    pairs, of = [], []
    for n, (common, left, right) in enumerate(cases):
        for i in range(60):
            middle = [f"m{n}x{i}x{x}" for x in rng.integers(0, 1 << 30, common + 4)]
            pairs.append(tuple(" ".join([*(f"{s}{n}x{i}x{k}" for k in range(m)), *middle]) for s, m in (("a", left), ("b", right))))
            of.append(n)
    found = linked(spark, pairs)
    for n, (common, left, right) in enumerate(cases):
        near = common / (common + left + right) >= 0.8
        assert all((jaccard(*p) >= 0.8) == near for p, k in zip(pairs, of) if k == n)
        hits = sum(f for f, k in zip(found, of) if k == n)
        assert hits >= 57 if near else hits == 0


def test_a_crowd_of_unlike_texts_costs_no_pairs(spark):
    """20,000 sets share four fifths of their members and none is near another, but for 50 planted pairs."""
    from pyspark.sql import functions as F

    shared = F.sequence(F.lit(1), F.lit(100))
    own = lambda c: F.transform(F.sequence(F.lit(0), F.lit(24)), lambda i: F.xxhash64(c, i))
    sets = spark.range(20_000).select(F.col("id").alias("node"), F.concat(shared, own(F.col("id"))).alias("shingles"))
    twins = sets.where("node < 50").select(
        (F.col("node") + 100_000).alias("node"), F.concat(F.slice("shingles", 1, 120), F.array(F.xxhash64("node"))).alias("shingles"))
    sets = sets.unionByName(twins)
    nodes = sets.select("node", F.col("node").alias("root"))
    pairs = simhash.prefix_pairs(nodes, sets, 0.8).select(F.col("l.node").alias("a"), F.col("r.node").alias("b")).distinct().collect()
    assert {(i, i + 100_000) for i in range(50)} <= {(r.a, r.b) for r in pairs} and len(pairs) <= 2000


def test_prefix_pairs_lose_none(spark):
    rng = np.random.default_rng(9)
    base = [int(x) for x in rng.integers(0, 1 << 40, 60)]
    sets = {}
    for i in range(150):
        kept = [x for x in base if rng.random() > rng.choice([0.02, 0.05, 0.1])]
        sets[i] = set(kept + [int(x) for x in rng.integers(0, 1 << 40, int(rng.integers(0, 8)))])
    near = {(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8}
    frame = spark.createDataFrame([(i, sorted(s)) for i, s in sets.items()], "node long, shingles array<long>")
    found = simhash.prefix_pairs(frame.selectExpr("node", "node AS root"), frame, 0.8).selectExpr("l.node AS a", "r.node AS b").distinct().collect()
    assert len(near) > 100 and near <= {(r.a, r.b) for r in found}


def test_edited_copies_of_a_copy_are_one_group(spark):
    """Copies that are near the text they come from and not each other, more than a block pairs with itself."""
    rng = np.random.default_rng(10)
    words = [f"w{x}" for x in rng.integers(0, 50_000, 150)]
    rows = [(5000, " ".join(words))]
    for i in range(300):
        other = list(words)
        for at in rng.choice(145, 3, replace=False):
            other[at] = f"n{i}x{at}"
        rows.append((i, " ".join(other)))
    for i in range(300):  # six words changed: near to nothing
        other = list(words)
        for at in range(10 + i % 15, 150, 22):
            other[at] = f"m{i}x{at}"
        rows.append((10_000 + i, " ".join(other)))
    got = {r.doc_id: r.group_id for r in simhash.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[i] == 0 for i, _ in rows[:301]) >= 0.98 * 301  # each is proposed with probability 0.99
    assert all(got[i] == i for i, _ in rows[301:])


def test_slots_never_count_too_little(spark, monkeypatch):
    """Few slots, so that members share them: counts stay at or over the true ones and no pair is lost."""
    rng = np.random.default_rng(12)
    base = [int(x) for x in rng.integers(-(1 << 62), 1 << 62, 60)]
    sets = {i: sorted({x for x in base if rng.random() > 0.05} | {int(x) for x in rng.integers(0, 1 << 62, 4)}) for i in range(100)}
    frame = spark.createDataFrame(list(sets.items()), "node long, shingles array<long>").repartition(4)
    true = {}
    for s in sets.values():
        for x in s:
            true[x] = true.get(x, 0) + 1
    near = {(i, j) for i in sets for j in sets if i < j and len({*sets[i]} & {*sets[j]}) / len({*sets[i]} | {*sets[j]}) >= 0.8}
    found = []
    for slots in (16, 1 << 22):
        monkeypatch.setattr(simhash, "SLOTS", slots)
        counts = simhash.slot_counts(frame)
        assert len(counts) <= slots and all(counts[x & (len(counts) - 1)] >= n for x, n in true.items())
        assert counts.sum() == sum(true.values())
        pairs = simhash.prefix_pairs(frame.selectExpr("node", "node AS root"), frame, 0.8).selectExpr("l.node AS a", "r.node AS b").distinct().collect()
        found.append({(r.a, r.b) for r in pairs})
    assert near and all(near <= f for f in found)


def test_no_crowd(spark):
    empty = spark.createDataFrame([], "node long, shingles array<long>")
    assert simhash.prefix_pairs(empty.selectExpr("node", "node AS root"), empty, 0.8).count() == 0


def edited_pairs(n: int, changed: int) -> list[tuple[str, str]]:
    rng = np.random.default_rng(13)
    pairs = []
    for i in range(n):
        words = [f"w{x}" for x in rng.integers(0, 50_000, 300)]
        other = list(words)
        for at in range(10, 10 + 40 * changed, 40):
            other[at] = f"n{i}x{at}"
        pairs.append((" ".join(words), " ".join(other)))
    return pairs


def bits(a: str, b: str) -> int:
    one, two = (simhash.fingerprint(t.encode().split()) for t in (a, b))
    return ((one ^ two) & ((1 << 64) - 1)).bit_count()


def test_close_prints_propose_what_bands_miss(spark, monkeypatch):
    """With one band of six minima a fifth of these pairs is not proposed by MinHash; SimHash proposes all within 4 bits."""
    monkeypatch.setattr(simhash, "bands_for", lambda similarity: 1)
    pairs = [p for p in edited_pairs(150, 1) if bits(*p) <= 4]
    assert len(pairs) > 60 and all(jaccard(*p) >= 0.8 for p in pairs)
    assert all(linked(spark, pairs))


def test_every_close_pair_of_prints_meets_in_a_block(spark, monkeypatch):
    """A cluster of prints round one, blocks of over FEW among them, and prints that are far from all."""
    rng = np.random.default_rng(14)
    base = int(rng.integers(-(1 << 62), 1 << 62))
    prints = [base] + [base ^ sum(1 << int(b) for b in rng.choice(63, int(rng.integers(1, 6)), replace=False)) for _ in range(200)]
    prints += [int(x) for x in rng.integers(-(1 << 62), 1 << 62, 300)]
    prints = sorted(set(prints))
    near = {(i, j) for i, a in enumerate(prints) for j, b in enumerate(prints) if i < j and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4}
    frame = spark.createDataFrame(list(enumerate(prints)), "node long, fp long")
    for few in (4, 64):
        monkeypatch.setattr(simhash, "FEW", few)
        blocks: dict = {}
        for r in simhash.close_blocks(frame, len(prints), 4).collect():
            blocks.setdefault(r.block, set()).add(r.node)
        met = {(a, b) for block in blocks.values() for a in block for b in block if a < b}
        assert len(near) > 200 and near <= met


def test_same_words_in_other_numbers_are_one_group(spark):
    """Sets of shingles that are equal though the prints, which count repeats, may differ."""
    part = " ".join(f"w{i}" for i in range(40))
    rows = [(1, " ".join([part] * 3)), (2, " ".join([part] * 2)), (3, "other words " + part), (4, " ".join([part] * 2))]
    got = {r.doc_id: r.group_id for r in simhash.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == got[2] == got[4] == 1
