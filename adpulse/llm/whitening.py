"""Embedding whitening by shifted CholeskyQR: distributed Gram passes, triangular solves, SVD of the composed factor."""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialize

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
PASSES = 8         # most Gram passes; three are enough unless the covariance is near singular
SETTLED = 1e-13    # a pass this near to orthonormal is the last
NULL = 1e-24       # eigenvalues below this share of the largest are zero
LONG = 1 << 63


def quantized(vectors: DataFrame, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``(vec_id, x)`` with ``x = floor(scale * c) + offset``; rows with a null vector, a null or non-finite component go.

    So do vectors without components and those of which a component does not fit a 62-bit number.
    """
    scaled = lambda v: v.cast("double") * scale
    usable = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(scaled(v)) < float(1 << 62)))
    kept = vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & usable)
    return kept.select("vec_id", F.transform("embedding", lambda v: F.floor(scaled(v)).cast("long") + F.lit(offset).cast("long")).alias("x"))


def _matrices(column: pa.Array):
    """``(places, matrix)`` per width of the list column."""
    lengths = np.diff(column.offsets.to_numpy())
    values, starts = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])
    for width in np.unique(lengths):
        at = np.flatnonzero(lengths == width)
        yield at, values[(starts[at][:, None] + np.arange(width))]


class Centre:
    """``n`` vectors of one width and the exact sums ``S`` of their components."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n, self.base = n, np.array([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]
        self.fraction = np.array([r / n for r in self.rest])

    def rows(self, x: np.ndarray) -> np.ndarray:
        """``x - S/n`` in doubles; the whole part of the mean is taken off exactly first."""
        far = np.abs(x.astype(np.float64) - self.base) >= LONG / 2
        whole = (x.astype(object) - self.base.astype(object)).astype(np.float64) if far.any() else (x - self.base).astype(np.float64)
        return whole - self.fraction

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over components of ``(n*x - S)**2``, exactly; None where it does not fit a long."""
        most = np.abs(x.astype(np.float64) - self.base).max(initial=0.0) + 1
        if (self.n * most) ** 2 * x.shape[1] < LONG / 2:
            return (((x - self.base) * self.n - np.array(self.rest)) ** 2).sum(1).tolist()
        rest, base = np.array(self.rest, object), self.base.astype(object)
        exact = (((x.astype(object) - base) * self.n - rest) ** 2).sum(1)
        return [int(v) if v < LONG else None for v in exact]


def _centres(distinct: DataFrame) -> dict[int, Centre]:
    """Number and exact component sums of the vectors of each width."""

    def run(batches):
        for batch in batches:
            out = []
            for at, x in _matrices(batch.column(0)):
                # two halves, so that no sum of a batch leaves 64 bits
                high, low = (x >> 31).sum(0), (x & 0x7FFFFFFF).sum(0)
                out += [(x.shape[1], i, len(at), Decimal((int(h) << 31) + int(lo))) for i, (h, lo) in enumerate(zip(high, low))]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)))],
                    ["width", "i", "n", "total"])

    parts = distinct.mapInArrow(run, "width int, i int, n long, total decimal(38,0)")
    found: dict[int, dict[int, tuple[int, int]]] = {}
    for r in parts.groupBy("width", "i").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        found.setdefault(r.width, {})[r.i] = (r.n, int(r.total))
    return {w: Centre(rows[0][0], [rows[i][1] for i in range(w)]) for w, rows in found.items()}


def _gram(distinct: DataFrame, centres: dict[int, Centre], maps: dict[int, np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per width the sums and the Gram matrix of the centred vectors times ``maps``.

    Tasks add up their own rows and hand on one upper triangle; the driver gets one triangle per width.
    """

    def run(batches):
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for _, x in _matrices(batch.column(0)):
                w = x.shape[1]
                if w not in maps:
                    continue
                y = centres[w].rows(x) @ maps[w]
                before = held.get(w, (0.0, 0.0))
                held[w] = (before[0] + y.sum(0), before[1] + y.T @ y)
        for w, (sums, gram) in held.items():
            i, j = np.triu_indices(len(sums))
            i, j = np.concatenate([i, np.arange(len(sums))]), np.concatenate([j, np.full(len(sums), -1)])
            values = np.concatenate([gram[np.triu_indices(len(sums))], sums])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), w, np.int32)), pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(values)], ["width", "i", "j", "v"])

    out = {w: (np.zeros(m.shape[1]), np.zeros((m.shape[1], m.shape[1]))) for w, m in maps.items()}
    added = distinct.mapInArrow(run, "width int, i int, j int, v double").groupBy("width", "i", "j").agg(F.sum("v").alias("v"))
    for w, i, j, v in added.collect():
        if j < 0:
            out[w][0][i] = v
        else:
            out[w][1][i, j] = out[w][1][j, i] = v
    return out


def _upper(gram: np.ndarray, shift: float) -> np.ndarray:
    """``R`` with ``R'R = gram + shift``, the shift raised until it exists."""
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(len(gram))).T
        except np.linalg.LinAlgError:
            shift *= 16


def factor(distinct: DataFrame, centres: dict[int, Centre]) -> dict[int, np.ndarray]:
    """Per width an ``R`` with ``R'R`` the Gram matrix of the centred vectors, by shifted CholeskyQR.

    Each pass takes the rows times the inverse of the factor so far (a triangular solve), which are nearer to
    orthonormal; its Cholesky factor is composed with it. Directions without any spread stay zero, and so does
    their part of the result, because the square root of the last Gram matrix comes in as well.
    """
    tiny = np.finfo(float).eps
    composed = {w: np.eye(w) for w in centres}
    done: dict[int, np.ndarray] = {}
    for turn in range(PASSES):
        todo = {w: r for w, r in composed.items() if w not in done}
        if not todo:
            break
        grams = _gram(distinct, centres, {w: np.linalg.solve(r, np.eye(w)) for w, r in todo.items()})
        for w, (_, gram) in grams.items():
            values, vectors = np.linalg.eigh(gram)
            spread = values[values > 1e-6]
            if turn and (np.abs(spread - 1) < SETTLED * w).all() and (np.abs(values[values <= 1e-6]) < SETTLED * w).all() or turn == PASSES - 1 or not gram.any():
                done[w] = (vectors * np.sqrt(np.maximum(values, 0))) @ vectors.T @ composed[w]
                continue
            # the shift that keeps the factor defined whatever the condition
            shift = 11 * (centres[w].n * w + w * (w + 1)) * tiny / 2 * values[-1] if turn == 0 else 2 * w * tiny * values[-1]
            composed[w] = _upper(gram, min(shift, 1e-3 * values[-1])) @ composed[w]
    return done


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` per usable row and component.

    The covariance is that of the different vectors ``x`` (:func:`quantized`), each once: ``n`` of them, with sums
    ``S``. Components are its eigenvectors by falling eigenvalue; ``whitened`` is ``x - S/n`` along the component over
    the root of its eigenvalue; ``explained`` the eigenvalue's share of the trace; ``deviation`` the sum of
    ``(n*x - S)**2``, null beyond a long. ``identity_error`` is measured by a pass over the whitened vectors.

    Components without spread have null ``whitened`` and an ``explained`` of 0 (null where nothing has spread). Vectors
    of different widths are whitened apart, each by its own covariance. Repeated rows and ids are rows of their own;
    an empty table gives no rows; other columns are ignored. The driver holds one square matrix per width.
    """
    points = materialize(quantized(vectors, scale, offset), "points")
    distinct = materialize(points.select("x").distinct(), "distinct")
    centres = _centres(distinct)
    models, maps = {}, {}
    for w, r in factor(distinct, centres).items():
        _, sigma, rows = np.linalg.svd(r)
        e = sigma ** 2 / centres[w].n
        use = (e > NULL * e[0]) & (e > 0)
        k = min(components, w)
        maps[w] = rows.T[:, :k] / np.where(use, np.sqrt(np.where(use, e, 1)), np.inf)[:k]
        models[w] = (use[:k], np.where(use, e, 0.0)[:k] / e.sum() if e.sum() > 0 else None)
    errors = {}
    for w, (sums, gram) in (_gram(distinct, centres, maps) if maps else {}).items():
        n, use = centres[w].n, models[w][0]
        off = np.abs(gram / n - np.outer(sums, sums) / n ** 2 - np.eye(len(use)))[np.ix_(use, use)]
        errors[w] = float(off.max()) if use.any() else None

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                for at, x in _matrices(part.column(1)):
                    w = x.shape[1]
                    (use, explained), centre, k = models[w], centres[w], maps[w].shape[1]
                    z, rows = centre.rows(x) @ maps[w], len(at)
                    yield pa.RecordBatch.from_arrays([
                        part.column(0).take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                        pa.array(np.full(rows * k, centre.n)), pa.array([d for d in centre.deviations(x) for _ in range(k)], pa.int64()),
                        pa.array(z.ravel(), pa.float64(), mask=~np.tile(use, rows)),
                        pa.array([None] * (rows * k) if explained is None else np.tile(explained, rows), pa.float64()),
                        pa.array([errors[w]] * (rows * k), pa.float64()),
                    ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = points.schema["vec_id"].dataType.simpleString()
    return points.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
