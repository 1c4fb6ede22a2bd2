"""L2-penalised logistic regression by Newton's method with distributed Hessian-vector products.

Minimises ``|w|^2 / 2 + c * sum log(1 + exp(-s * z))`` over ``z = x w``, ``s = +-1``, with the intercept as one more
weight of a constant feature, so it is penalised like the others. The optimum is unique, and the gradient's
norm bounds the distance to it, so a fit ends with a certificate instead of a number of steps.

The rows ``(y, j array<int>, x array<double>)`` are written once and read once a pass. A pass is one job: tasks get
the weights (and a direction) with their closure, add up the loss, the gradient or the Hessian's product with the direction over their
rows, and hand on one vector each, cut into chunks; a chunk's parts are summed in the order of their tasks, so
a rerun gives the same bits. The driver holds vectors of the number of features, which the vocabulary's or the hash space's size bounds.

Newton's equations are solved by conjugate gradients, one pass a step. They are preconditioned with the Hessian
of a bounded set of rows, which the driver solves by itself: it changes how many passes are needed, never the result.
The set is a sample (``SAMPLE_ROWS``) where rows are of like length. Where some are far longer than the mean, as with raw
counts, a plain sample misses them though they make most of the Hessian, and which rows make most of it changes with the
weights, as long rows are soon decided. Then each Newton step draws its own rows, by their part in the Hessian's trace at the
step's weights, and one pass more brings them; what the drawn rows leave of the Hessian's diagonal stands in it as a diagonal.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tonestream.operators.partitioning import BYTES_PER_PARTITION
from tonestream.sinks.files import materialize

#: Rows that the driver's preconditioner is made of, at most.
SAMPLE_ROWS = 8192
#: Where a row's squared norm is above ``LONG`` times the mean, the rows are drawn by their part in the Hessian, about ``DRAWN_ENTRIES`` entries at most.
LONG, DRAWN_ENTRIES = 16, 1 << 21
#: Share of the curvature of rows that stand for others too which the preconditioner takes as a diagonal, as fewer rows than features leave directions out.
DIAGONAL = 0.1
#: Rows are counted by half powers of 2 of their part in the trace; the first bin is for 2 ** -96 and less.
BINS, FIRST_BIN = 256, -192
#: The fit ends when the gradient's norm is at most this share of that at zero.
TOLERANCE = 1e-8
MAX_PASSES = 200
CHUNK = 1024

# the functions of this module travel with their code, so workers need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Rows:
    """Sparse rows with a constant feature behind the last one, as numpy arrays."""

    def __init__(self, y: np.ndarray, lengths: np.ndarray, j: np.ndarray, x: np.ndarray, dim: int):
        self.y, self.j, self.x, self.dim = y, j, x, dim
        self.row = np.repeat(np.arange(len(y)), lengths)

    def times(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.x * w[self.j], minlength=len(self.y)) + w[-1]

    def gathered(self, r: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(self.j, self.x * r[self.row], minlength=self.dim), r.sum())

    def squares(self, r: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(self.j, self.x * self.x * r[self.row], minlength=self.dim), r.sum())


def rows_of(batch: pa.RecordBatch | pa.Table, dim: int) -> Rows:
    y, j, x = (c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in (batch.column(n) for n in ("y", "j", "x")))
    return Rows(y.to_numpy(zero_copy_only=False), np.diff(j.offsets.to_numpy()), j.flatten().to_numpy(), x.flatten().to_numpy(), dim)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def loss_and_gradient(rows: Rows, w: np.ndarray) -> np.ndarray:
    """The rows' loss, then its gradient."""
    z = rows.times(w)
    return np.append((np.logaddexp(0, z) - rows.y * z).sum(), rows.gathered(_sigmoid(z) - rows.y))


def hessian_times(rows: Rows, w: np.ndarray, v: np.ndarray) -> np.ndarray:
    p = _sigmoid(rows.times(w))
    return rows.gathered(p * (1 - p) * rows.times(v))


def _summed(rows: DataFrame, dim: int, size: int, part: Callable[[Rows], np.ndarray]) -> np.ndarray:
    """``part`` of all rows, one vector of ``size`` a task, summed chunk by chunk."""

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = np.zeros(size)
        for batch in batches:
            total += part(rows_of(batch, dim))
        chunks = [total[a:a + CHUNK].tobytes() for a in range(0, size, CHUNK)]
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()] * len(chunks), pa.int32()), pa.array(range(len(chunks)), pa.int32()),
                                          pa.array(chunks, pa.binary())], ["task", "chunk", "part"])

    def of_chunk(parts: pa.Table) -> pa.Table:
        parts = parts.sort_by("task")
        total = sum(np.frombuffer(p) for p in parts["part"].to_pylist())
        return pa.table({"chunk": pa.array([parts["chunk"][0].as_py()], pa.int32()), "part": pa.array([total.tobytes()], pa.binary())})

    parts = rows.mapInArrow(of_task, "task int, chunk int, part binary")
    found = parts.groupBy("chunk").applyInArrow(of_chunk, "chunk int, part binary").collect()  # ``size`` numbers
    return np.concatenate([np.frombuffer(r["part"]) for r in sorted(found, key=lambda r: r["chunk"])]) if found else np.zeros(size)


@dataclass
class Fit:
    weights: np.ndarray
    intercept: float
    rows: int
    passes: int
    loss: float
    gradient: float  # the gradient's norm at the result
    gradient_at_zero: float

    def certificate(self, spark) -> DataFrame:
        """One row: what the fit did, and how far from the optimum the weights can be (the penalty's curvature is 1)."""
        return spark.createDataFrame([(self.rows, self.passes, self.loss, self.gradient, self.gradient_at_zero, self.gradient)],
                                     "n_rows long, passes int, loss double, gradient double, gradient_at_zero double, distance_bound double")


def _conjugate(apply, right: np.ndarray, solve, tolerance: float, most: int) -> np.ndarray:
    """``x`` with ``apply(x)`` near ``right``, by preconditioned conjugate gradients (whose preconditioner may vary a little)."""
    x, r = np.zeros_like(right), right.copy()
    z = solve(r)
    p, rz, goal = z, r @ z, tolerance * np.linalg.norm(right)
    for _ in range(most):
        ap = apply(p)
        a = (r @ p) / (p @ ap)
        x, before, r = x + a * p, r, r - a * ap
        if np.linalg.norm(r) <= goal:
            break
        z = solve(r)
        p, rz = z + max(0.0, (z @ (r - before)) / rz) * p, r @ z
    return x


def pulls(rows: Rows, w: np.ndarray) -> np.ndarray:
    """Each row's part in the trace of the Hessian."""
    p = _sigmoid(rows.times(w))
    return p * (1 - p) * (1 + np.bincount(rows.row, rows.x * rows.x, minlength=len(rows.y)))


def loss_gradient_and_curve(rows: Rows, w: np.ndarray) -> np.ndarray:
    """The rows' loss, then its gradient, its Hessian's diagonal, and for each bin of ``pulls`` their sum, the rows and the entries."""
    p, pull = _sigmoid(rows.times(w)), pulls(rows, w)
    at = np.clip(np.floor(2 * np.log2(np.maximum(pull, 2.0 ** (FIRST_BIN // 2)))) - FIRST_BIN, 0, BINS - 1).astype(np.int64)
    lengths = np.bincount(rows.row, minlength=len(pull))
    return np.concatenate([loss_and_gradient(rows, w), rows.squares(p * (1 - p)), *(np.bincount(at, v, minlength=BINS) for v in (pull, np.ones_like(pull), lengths))])


def _uneven(rows: DataFrame) -> bool:
    """Whether any row is far longer than the mean."""
    mean, most = rows.select(F.aggregate("x", F.lit(1.0), lambda s, v: s + v * v).alias("norm")).agg(F.avg("norm"), F.max("norm")).first()
    return most > LONG * mean


def _chance(bins: np.ndarray, rows_most: int, entries_most: int) -> float:
    """The factor that makes ``pulls`` into chances (1 at most) of about ``rows_most`` rows and ``entries_most`` entries, or fewer."""
    pull, n, entries = bins.reshape(3, BINS)
    met = pull > 0
    pull, n, entries = pull[met] / n[met], n[met], entries[met]
    if not len(pull):
        return 0.0
    low, high = -700.0, np.log(4 / pull.min())
    for _ in range(60):
        mid = (low + high) / 2
        chance = np.minimum(1.0, np.exp(mid) * pull)
        low, high = (mid, high) if n @ chance <= rows_most and entries @ chance <= entries_most else (low, mid)
    return float(np.exp(low))


def _drawn(rows: DataFrame, dim: int, w: np.ndarray, factor: float, step: int) -> pa.Table:
    """Rows drawn with the chance ``factor * pulls``, and ``stands``, the number of rows that each stands for.

    The draw hangs on the step, the task and the row's place in it alone.
    """
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        dice = np.random.default_rng([step, TaskContext.get().partitionId()])
        for batch in batches:
            chance = np.minimum(1.0, factor * pulls(rows_of(batch, dim), w))
            kept = np.flatnonzero(dice.random(len(chance)) < chance)
            found = batch.take(pa.array(kept))
            yield pa.RecordBatch.from_arrays([*(found.column(n) for n in ("y", "j", "x")), pa.array(1 / chance[kept])], ["y", "j", "x", "stands"])

    return rows.mapInArrow(of_task, StructType([*rows.schema.fields, StructField("stands", DoubleType())])).toArrow()


def _drawn_solver(drawn: Rows, stands: np.ndarray, curve_of_all: np.ndarray, w: np.ndarray, c: float):
    """Solves with the Hessian of the drawn rows and the diagonal of what they leave (``curve_of_all``: the whole Hessian's diagonal)."""
    p = _sigmoid(drawn.times(w))
    curve = c * stands * p * (1 - p) * np.where(stands > 1, 1 - DIAGONAL, 1.0)
    others = np.maximum(curve_of_all - drawn.squares(curve), 1.0)
    apply = lambda v: others * v + drawn.gathered(curve * drawn.times(v))
    return lambda right: _conjugate(apply, right, lambda r: r / curve_of_all, 3e-2, 300)


def _sample_solver(sample: Rows, share: float, w: np.ndarray, c: float):
    """Solves with the Hessian of the sample, blown up to all rows."""
    p = _sigmoid(sample.times(w))
    curve = c * share * p * (1 - p)
    apply = lambda v: v + sample.gathered(curve * sample.times(v))
    diagonal = 1 + sample.squares(curve)
    return lambda right: _conjugate(apply, right, lambda r: r / diagonal, 1e-2, 300)


def fit_newton(rows: DataFrame, dim: int, c: float = 1.0, tolerance: float = TOLERANCE, max_passes: int = MAX_PASSES,
               sample_rows: int = SAMPLE_ROWS) -> Fit:
    """Fit on ``rows`` (``y`` 0 or 1, ``j`` feature numbers below ``dim``, ``x`` their values).

    Raises where ``max_passes`` don't reach the ``tolerance``.
    """
    rows = materialize(rows.select("y", "j", "x"), "sparse-rows")
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("j")).alias("entries")).first()
    n, size = stats["n"], dim + 1
    if not n:
        return Fit(np.zeros(dim), 0.0, 0, 0, 0.0, 0.0, 0.0)
    # read once a pass: enough tasks for the cores or the bytes, no more
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = min(rows.rdd.getNumPartitions(), max(1, 12 * stats["entries"] // BYTES_PER_PARTITION, min(cores, 1 + n // 256)))
    rows = rows.coalesce(parts)
    uneven = _uneven(rows)
    # any bounded set of rows will do, it only preconditions: about as many as asked for, by a hash of their places in the written table
    dealt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 30))
    if not uneven:
        few = rows.where(dealt <= int(min(1.0, sample_rows / n) * (1 << 30))).limit(2 * sample_rows).toArrow()
        few = few if len(few) else rows.limit(1).toArrow()
        sample, share = rows_of(few, dim), n / len(few)

    # a table within the bounds is fetched once
    whole, drawn = n <= sample_rows and stats["entries"] <= DRAWN_ENTRIES, None
    passes, w = 0, np.zeros(size)

    def at(w):
        nonlocal passes
        passes += 1
        found = _summed(rows, dim, size + 1, lambda r: loss_and_gradient(r, w)) if not uneven else _summed(
            rows, dim, 2 * size + 1 + 3 * BINS, lambda r: loss_gradient_and_curve(r, w))
        return w @ w / 2 + c * found[0], w + c * found[1:size + 1], 1 + c * found[size + 1:2 * size + 1], found[2 * size + 1:]

    def curved(v):
        nonlocal passes
        passes += 1
        return v + c * _summed(rows, dim, size, lambda r: hessian_times(r, w, v))

    def solver():
        nonlocal passes, drawn
        if not uneven:
            return _sample_solver(sample, share, w, c)
        if drawn is None or not whole:
            passes += 1
            drawn = rows.withColumn("stands", F.lit(1.0)).toArrow() if whole else _drawn(rows, dim, w, _chance(bins, sample_rows, DRAWN_ENTRIES), passes)
        return _drawn_solver(rows_of(drawn, dim), drawn["stands"].to_numpy(), curve, w, c)

    loss, g, curve, bins = at(w)
    zero = norm = float(np.linalg.norm(g))
    while norm > tolerance * zero:
        if passes >= max_passes:
            raise RuntimeError(f"not converged in {passes} passes: the gradient is {norm / zero:.1e} of that at zero")
        step = _conjugate(curved, -g, solver(), min(0.1, (norm / zero) ** 0.5), 50)
        t, slope = 1.0, g @ step
        while True:
            near = at(w + t * step)
            # near the optimum the loss no longer tells steps apart, the gradient does; elsewhere a shorter gradient may be a way uphill
            if near[0] <= loss + 1e-4 * t * slope + 1e-12 * abs(loss) or t < 1e-6 or (
                    near[0] <= loss + 1e-9 * abs(loss) and np.linalg.norm(near[1]) < 0.5 * norm):
                break
            t /= 2
        w, (loss, g, curve, bins) = w + t * step, near
        norm = float(np.linalg.norm(g))
    return Fit(w[:-1], float(w[-1]), n, passes, float(loss), norm, zero)
