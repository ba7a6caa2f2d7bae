"""Near-duplicates by SimHash (pigeonhole blocks, verified Hamming distance) and by exact Jaccard similarity."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from math import ceil, log, log1p, log2, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import PART, map_batches, materialize, per_key, row_hash, shingle_hashes, texts, words_of
from .components import components

BITS = 64
# A block combination shared by more different fingerprints than this is linked through midpoints.
CROWDED = 1024
# Turns in which all nodes of a block are held against one of them, before those still apart are paired.
TURNS = 2
# A block of more nodes that are still apart pairs them by their rarest shingles.
FEW = 64
# Slots in which the shingles of such blocks are counted. A fixed number, so what is broadcast doesn't grow with the data.
SLOTS = 1 << 22
# Bits in which fingerprints of near-duplicates differ at most.
DISTANCE = 4
# Near-duplicates: minima in one band, share of the pairs just similar enough that meet in a band, and bits
# of each minimum that are compared before the sets are.
BAND, RECALL, LOW_BITS = 6, 0.99, 4
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def majority(hashes: np.ndarray) -> int:
    """The 64-bit fingerprint: a bit is 1 if it is set in over half of the hashes. No hash: 0."""
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 65536):
        part = hashes[start:start + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(words: list[bytes], shingle: int = 4) -> int:
    """SimHash of the ``shingle``-word shingles of a text, with repeats."""
    return majority(shingle_hashes(words, shingle))


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``(doc_id, fp)`` of every whole text, over ``shingle``-word shingles with repeats."""

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        fp = [fingerprint(words_of(t), shingle) for t in rows.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(texts(docs), batch, f"doc_id {kind}, fp long")


def block_masks(rows: int, max_distance: int) -> list[int]:
    """Masks such that any two fingerprints within ``max_distance`` bits agree on one whole mask.

    Of n blocks at least n - ``max_distance`` agree. n is the smallest number whose combinations have two
    bits more than the number of rows has, so that a combination rarely meets by chance at any size.
    """
    for n in range(max_distance + 1, BITS + 1):
        edges = [BITS * i // n for i in range(n + 1)]
        blocks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
        masks = [sum(c) for c in combinations(blocks, n - max_distance)]
        if min(m.bit_count() for m in masks) >= log2(max(rows, 2)) + 2 or len(masks) > 1000:
            break
    return [_signed(m) for m in masks]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def meeting(nodes: DataFrame, rows: int, max_distance: int) -> DataFrame:
    """``nodes(node, fp)`` under each block combination ``(mask, part)`` they share with others; ``n`` share it."""
    masks = block_masks(rows, max_distance)
    keyed = nodes.withColumn("mask", F.explode(F.lit(masks))).withColumn("part", F.col("fp").bitwiseAND(F.col("mask")))
    sizes = per_key(keyed, ["mask", "part"], F.count("*").alias("n")).where("n > 1")
    return materialize(keyed.join(sizes, ["mask", "part"]), "combinations")


def close_blocks(nodes: DataFrame, rows: int, max_distance: int) -> DataFrame:
    """``(block, node)`` such that any two of ``nodes(node, fp)`` within ``max_distance`` bits meet in a block.

    A block is a block combination. Those of at most :data:`FEW` nodes keep only the nodes that are close to another
    in them, so what meets by chance goes; in larger ones all stay, and no pairs are formed.
    """
    met = meeting(nodes, rows, max_distance)
    block = F.xxhash64("mask", "part").alias("block")
    calm = met.where(F.col("n") <= FEW)
    same_block = (F.col("l.mask") == F.col("r.mask")) & (F.col("l.part") == F.col("r.part"))
    on = same_block & (F.col("l.node") < F.col("r.node")) & (bits_apart("fp") <= max_distance)
    pairs = calm.alias("l").join(calm.alias("r"), on).select("l.mask", "l.part", F.explode(F.array("l.node", "r.node")).alias("node"))
    return pairs.select(block, "node").distinct().unionByName(met.where(F.col("n") > FEW).select(block, "node"))


def close_pairs(nodes: DataFrame, rows: int, max_distance: int) -> DataFrame:
    """Edges ``(a, b)`` that connect exactly the nodes whose ``fp`` differ in at most ``max_distance`` bits.

    ``nodes(node, fp)`` has one row per node. Every close pair meets in a shared block combination and is
    verified there. Where over :data:`CROWDED` nodes share one, pairs are not formed: each fingerprint is
    keyed by all values within half the distance, and those that meet in a value, which are within the
    distance of each other, point at the smallest. Two close values always share such a midpoint, so no link
    is lost and the cost stays linear. An odd distance has no midpoint; then :func:`pivot_pairs` links.
    """
    met = meeting(nodes, rows, max_distance)
    close = bits_apart("fp") <= max_distance
    if max_distance % 2:
        return pivot_pairs(met.select(F.xxhash64("mask", "part").alias("block"), "node", "fp"), close)
    same_block = (F.col("l.mask") == F.col("r.mask")) & (F.col("l.part") == F.col("r.part"))
    pairwise = met.where(F.col("n") <= CROWDED)
    on = same_block & (F.col("l.node") < F.col("r.node")) & close
    pairs = pairwise.alias("l").join(pairwise.alias("r"), on).select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))
    flips = [_signed(sum(1 << i for i in c)) for k in range(max_distance // 2 + 1) for c in combinations(range(BITS), k)]
    crowd = met.where(F.col("n") > CROWDED).select("node", "fp").distinct()
    near = crowd.withColumn("flip", F.explode(F.lit(flips))).select("node", F.col("fp").bitwiseXOR(F.col("flip")).alias("mid"))
    stars = per_key(near, ["mid"], F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1")
    return pairs.unionByName(near.join(stars, "mid").where("a <> node").select("a", F.col("node").alias("b"))).distinct()


def pivot_pairs(met: DataFrame, close, accept=lambda pairs: pairs, crowd=None) -> DataFrame:
    """Edges ``(a, b)`` that connect the nodes of ``met(block, node, ...)`` which meet in a block and are close.

    ``close`` is a condition on the sides ``l`` and ``r`` of a pair; ``accept`` filters pairs
    ``(left, right, a, b)`` further by what other tables say of the nodes ``left`` and ``right``. All nodes of
    a block are first held against that which meets most others in its blocks: among edited copies of a text
    the text itself, which each is nearer to than to another copy. Then they are held against others drawn by
    a hash anew in each block and turn. Each of :data:`TURNS` turns costs one comparison a row, and only nodes that they leave in different
    components are paired: those of a block of at most :data:`FEW` with each other, all others as ``crowd``
    says, which turns rows ``(node, root, ...)`` into the pairs, sides ``l`` and ``r``, that can be close.
    """
    columns = [c for c in met.columns if c != "block"]
    same_block = F.col("l.block") == F.col("r.block")
    ends = [F.col("l.node").alias("left"), F.col("r.node").alias("right"), F.col("l.root").alias("a"), F.col("r.root").alias("b")]
    sizes = per_key(met, ["block"], F.count("*").alias("n"))
    meets = met.select("node", "block").join(sizes, "block").groupBy("node").agg(F.sum("n").alias("meets"))
    apart, edges = met.withColumn("root", F.col("node")).join(materialize(meets, "meets"), "node"), None
    for turn in range(TURNS):
        order = F.xxhash64("node", "block", F.lit(turn)) if turn else -F.col("meets")
        pivot = per_key(apart, ["block"], F.min(F.struct(order.alias("order"), "root", *columns)).alias("least"))
        pivot = pivot.select("block", "least.*").alias("r")
        found = apart.alias("l").join(pivot, same_block & (F.col("l.root") != F.col("r.root")) & close)
        found = accept(found.select(ends).distinct()).select("a", "b").distinct()
        edges = materialize(edges.unionByName(found) if edges else found, "stars")
        roots = components(edges).withColumnRenamed("node", "of")
        apart = met.join(roots, F.col("node") == F.col("of"), "left").withColumn("root", F.coalesce("root", "node"))
    split = per_key(apart, ["block"], F.count("*").alias("n"), F.min("root").alias("low_root"), F.max("root").alias("high_root"))
    split = split.where("low_root < high_root").select("block", "n")
    left = materialize(apart.join(split, "block"), "apart")
    calm = left.where(F.col("n") <= FEW) if crowd else left
    pairs = calm.alias("l").join(calm.alias("r"), same_block & (F.col("l.root") < F.col("r.root")) & close).select(ends)
    if crowd:
        others = left.where(F.col("n") > FEW).select(*columns, "root").distinct()
        pairs = pairs.unionByName(crowd(others).where(close).select(ends))
    return edges.unionByName(accept(pairs.distinct()).select("a", "b").distinct())


def prefix_pairs(nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs, sides ``l`` and ``r``, of rows ``(node, root, ...)`` of different roots that can be so similar.

    Sets of m and n members and a Jaccard similarity of t have at least c = ceil(t (m + n) / (1 + t)) in common, so the
    first common one, in any order all sets agree on, is among the first m - c + 1 of one and the first n - c + 1 of the
    other. Members go by how often :func:`slot_counts` saw their slot, then by value, so rare ones come first. What no
    other node can have is left out, so a node with more of that than its prefix holds meets none: a crowd of texts
    that share most of their shingles and still are not near costs little more than its prefixes.
    """
    members = materialize(sets.join(nodes.select("node"), "node").select("node", "shingles"), "members")
    seen = members.sparkSession.sparkContext.broadcast(slot_counts(members))

    def prefixes(rows: pa.RecordBatch) -> pa.RecordBatch | None:
        counts, out = seen.value, []
        for i, s in enumerate(rows.column(1)):
            shingles = s.values.to_numpy()
            often = counts[shingles & (len(counts) - 1)]
            first = np.lexsort((shingles, often))[:len(shingles) - ceil(len(shingles) * similarity - 1e-9) + 1]
            place = np.flatnonzero(often[first] > 1)
            out.append((np.full(len(place), i), np.full(len(place), len(shingles)), shingles[first[place]], place + 1))
        row, n, shingle, place = (np.concatenate(c) for c in zip(*out))
        return pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(row)), pa.array(n), pa.array(shingle), pa.array(place)], ["node", "n", "shingle", "place"])

    first = map_batches(members, prefixes, "node long, n long, shingle long, place long", PART)
    first = materialize(first.join(nodes, "node"), "prefixes")
    seen.unpersist()
    common = F.ceil((F.col("l.n") + F.col("r.n")) * (similarity / (1 + similarity)) - 1e-9)
    early = (F.col("l.place") <= F.col("l.n") - common + 1) & (F.col("r.place") <= F.col("r.n") - common + 1)
    return first.alias("l").join(first.alias("r"), (F.col("l.shingle") == F.col("r.shingle")) & (F.col("l.root") < F.col("r.root")) & early)


def slot_counts(members: DataFrame) -> np.ndarray:
    """In how many sets of ``members(node, shingles)`` members of each slot are; a slot is the low bits of a hash.

    There are about as many slots as members, at most :data:`SLOTS` (16 MB), whatever the input: members that
    share a slot are taken to be as frequent as all of them together, never as less.
    """
    total = members.agg(F.sum(F.size("shingles")).alias("n")).first().n or 1
    slots = min(SLOTS, 1 << total.bit_length())

    def count(batches):
        counts = np.zeros(slots, np.int64)
        for batch in batches:
            counts += np.bincount(batch.column(0).flatten().to_numpy() & (slots - 1), minlength=slots)
        slot = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(counts[slot])], ["slot", "n"])

    found = members.select("shingles").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    found = found.select(F.col("slot").cast("int"), F.least("n", F.lit(2**31 - 1)).cast("int").alias("n")).toPandas()
    counts = np.zeros(slots, np.int32)
    counts[found["slot"]] = found["n"]
    return counts


def bits_apart(column: str):
    """Differing bits of a column between the sides ``l`` and ``r`` of a join."""
    return F.bit_count(F.col(f"l.{column}").bitwiseXOR(F.col(f"r.{column}")))


def near_components(prints: DataFrame, max_distance: int) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``prints``: the smallest ``doc_id`` each is linked to.

    Rows equal in ``fp`` collapse to one node first, so thousands of copies cost one. Null ids take no part in
    the minimum; a component of such rows alone has a null id.
    """
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    nodes = materialize(nodes.withColumn("node", F.col("fp")), "nodes")
    least = _least(nodes, close_pairs(nodes.select("node", "fp"), nodes.count(), max_distance))
    return prints.join(least.withColumnRenamed("node", "fp"), "fp")


def _least(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(node, component_id)``: the smallest ``first`` of the nodes that edges connect."""
    rooted = nodes.join(components(edges), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = per_key(rooted, ["root"], F.min("first").alias("component_id"))
    return rooted.join(least, "root").select("node", "component_id")


def simhash_components(docs: DataFrame, shingle: int = 4, max_distance: int = DISTANCE) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row of ``docs``.

    Null and empty texts have fingerprint 0 and are linked like any other. Repeated rows and ties keep
    their own rows in one component. An empty table gives an empty result; other columns are ignored.
    """
    prints = materialize(fingerprints(docs, shingle), "prints")
    return near_components(prints, max_distance).select("doc_id", "fp", "component_id")


def bands_for(similarity: float) -> int:
    """Bands of :data:`BAND` minima in one of which a pair of that Jaccard similarity agrees with probability
    :data:`RECALL`. Neither the number of texts nor where they differ matters."""
    return max(1, ceil(log(1 - RECALL) / log1p(-(min(similarity, 0.999) ** BAND))))


@lru_cache(4)
def _odd(n: int) -> np.ndarray:
    """Odd multipliers, one per minimum."""
    return np.array([xxhash.xxh64_intdigest(i.to_bytes(4, "little")) | 1 for i in range(n)], np.uint64)[:, None]


def minima(hashes: np.ndarray, n: int) -> np.ndarray:
    """The smallest of the hashes under each of ``n`` mixings; two sets agree in one as often as they are similar."""
    least = np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), 1024):
        part = hashes[start:start + 1024] * _odd(n)
        part ^= part >> np.uint64(32)
        part *= _MIX
        np.minimum(least, part.min(1), out=least)
    return least


def _low_bits(least: np.ndarray) -> list[int]:
    """:data:`LOW_BITS` bits of each minimum, 16 minima to a number."""
    low = (least >> np.uint64(24)) & np.uint64((1 << LOW_BITS) - 1)
    low = np.concatenate([low, np.zeros(-len(low) % 16, np.uint64)]).reshape(-1, 16)
    return np.bitwise_or.reduce(low << (np.arange(16, dtype=np.uint64) * np.uint64(LOW_BITS)), axis=1).view(np.int64).tolist()


def _minima_apart(columns: list[str]):
    """Minima whose low bits differ between the sides ``l`` and ``r`` of a join."""
    ones = F.lit(0x1111111111111111)

    def different(c: str):
        x = F.col(f"l.{c}").bitwiseXOR(F.col(f"r.{c}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(ones))

    return sum(different(c) for c in columns)


def near_duplicate_groups(docs: DataFrame, similarity: float = 0.8, row: str | None = None) -> DataFrame:
    """``(doc_id, group_id, row, first)`` per row of ``docs``: near-duplicates share a group.

    ``group_id`` is the smallest id of the group, null if all are null. ``row`` is the column of ``docs`` that
    tells rows apart, a long (default: a hash of the id and the text). Equal ids, null ones included, don't
    link rows. ``first`` marks the row with the smallest id and then the smallest ``row``, null ids last, and
    whatever equals it in both.

    Two texts are near-duplicates if the Jaccard similarity of their sets of five-word shingles is
    ``similarity`` or more. Pairs are proposed by their SimHash fingerprints, those of :func:`fingerprints`: all that
    differ in at most :data:`DISTANCE` bits, found by block combinations. Pairs that are similar enough and yet have
    prints further apart are proposed by bands of MinHash values, :func:`bands_for` of them, so a pair
    just at the limit is proposed with probability 0.99 whatever the number of rows, and a more similar one
    more surely. Proposed pairs are checked on the whole sets; Hamming distance, sizes, and minima five standard
    errors below the limit, only spare that check. Documents without words form one group.
    """
    n_bands = bands_for(similarity)
    n_minima = n_bands * BAND

    def batch(rows: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text in rows.column(1).to_pylist():
            words = words_of(text)
            shingles, fp = np.unique(shingle_hashes(words, 5)), fingerprint(words)
            least = minima(shingles, n_minima)
            raw = least.tobytes()
            found = [xxhash.xxh64_intdigest(raw[8 * BAND * i:8 * BAND * (i + 1)], i) - (1 << 63) for i in range(n_bands)]
            # texts of one set and different prints are nodes of their own, which meet in every band
            node = xxhash.xxh64_intdigest(shingles.tobytes(), fp & ((1 << BITS) - 1)) - (1 << 63)
            out.append([node, len(shingles), fp, *_low_bits(least), *found])
        columns = [pa.array(c, pa.int64()) for c in zip(*out)]
        return pa.RecordBatch.from_arrays([rows.column(0), rows.column(2), *columns], ["doc_id", "row", "node", *key])

    low, bands = [f"m{i}" for i in range(-(-n_minima // 16))], [f"b{i}" for i in range(n_bands)]
    key = ["size", "fp", *low, *bands]
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}, row long", *(f"{c} long" for c in ("node", *key))])
    docs = docs.select("doc_id", "text", (F.col(row) if row else row_hash("doc_id", "text")).alias("row"))
    marked = materialize(map_batches(texts(docs, "row"), batch, schema, PART), "prints")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row")
    nodes = marked.groupBy("node", *key).agg(F.min(order).alias("first"))
    nodes = materialize(nodes, "nodes")
    worded = nodes.where("size > 0")
    of_node = ["size", "fp", *low]
    keyed = worded.select("node", *of_node, F.explode(F.array(*bands)).alias("block"))
    shared = per_key(keyed, ["block"], F.count("*").alias("n")).where("n > 1").select("block")
    by_prints = close_blocks(worded.select("node", "fp"), nodes.count(), DISTANCE).join(worded.select("node", *of_node), "node")
    met = materialize(keyed.join(shared, "block").unionByName(by_prints), "blocks")

    # the sets of one text of each node that met another
    def shingle_sets(rows: pa.RecordBatch) -> pa.RecordBatch:
        sets = [np.unique(shingle_hashes(words_of(t), 5)).view(np.int64) for t in rows.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([rows.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])

    wanted = nodes.join(met.select("node").distinct(), "node", "left_semi").select("node", F.col("first.row").alias("of"))
    chosen = texts(docs, "row").join(wanted, F.col("row") == F.col("of")).select("node", "text")
    chosen = chosen.dropDuplicates(["node"])
    sets = materialize(map_batches(chosen, shingle_sets, "node long, shingles array<long>", PART), "sets")

    def accept(pairs: DataFrame) -> DataFrame:
        both = pairs.join(sets.alias("l"), F.col("left") == F.col("l.node")).join(sets.alias("r"), F.col("right") == F.col("r.node"))
        common = F.size(F.array_intersect("l.shingles", "r.shingles"))
        return both.where(common / (F.size("l.shingles") + F.size("r.shingles") - common) >= similarity)

    apart = (1 - similarity) * (1 - 2.0 ** -LOW_BITS)
    most = n_minima * apart + 5 * sqrt(n_minima * apart * (1 - apart))
    alike = (bits_apart("fp") <= DISTANCE) | (_minima_apart(low) <= most)
    close = (F.least("l.size", "r.size") / F.greatest("l.size", "r.size") >= similarity) & alike
    least = _least(nodes.select("node", "first"), pivot_pairs(met, close, accept, lambda crowd: prefix_pairs(crowd, sets, similarity)))
    return marked.select("doc_id", "row", "node").join(least, "node").select(
        "doc_id", F.col("component_id.doc_id").alias("group_id"), "row",
        (F.col("doc_id").eqNullSafe(F.col("component_id.doc_id")) & (F.col("row") == F.col("component_id.row"))).alias("first"))
