"""Nearest neighbours through shifted Hilbert curves.

Method: rows are cut into bands of length (the greatest is at most twice the smallest), so that a few long
rows don't squeeze the others. In each band vectors are lifted so that the largest inner product becomes the
smallest angle (one more component brings every vector to the band's greatest norm), projected at random
to a few dimensions for each of ``curves`` curves, made about uniform by each projected
coordinate's mean and spread over the band, shifted at random, and ordered along a Hilbert
curve. Spark range-partitions every curve's rows; counts by partition give each row its exact
rank. In every band a query meets the rows whose rank is within ``reach`` (a share of all rows, not of the band)
of its own on some curve. Windows are cut into blocks of ranks of bounded size, each block of rows meets
bounded groups of queries, each in one task, and the best of all blocks are merged and ranked by the exact measure.

Bands that a window holds whole meet all queries without a curve, so fewer than ``1 / reach`` bands have curves. A query
meets a row once a curve at most, whatever the lengths.

``reach`` is a share so that recall is the same at every size. On vectors without structure (64
independent components) 8 curves with a reach of 0.1 find 0.96 of the true neighbours; on clustered ones a
far smaller share is enough, and the work is in proportion to it.

A vector that many rows repeat is kept with its ``k + 1`` smallest ids as candidate: by the
rule for ties no result can hold another. All of its rows can still be queries.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take no part, nor
do rows without an id; repeated ids are one row each (a query never meets its own id); ties go to the
smaller id; fewer candidates than ``k`` give all; an empty table gives an empty result;
vectors of different lengths are an error; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonestream.llm.common import materialize, small_batches

CURVES, DIMS, BITS, REACH, SEED = 8, 4, 10, 0.1, 5
#: Most rows of a block, and the blocks' worth of places whose queries go together.
BLOCK_ROWS, QUERY_BLOCKS = 32768, 16
#: Fewest rows that a window reaches to either side.
LEAST_ROWS = 512


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position along the Hilbert curve of grid cells, shape (rows, dims)."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    dims = len(x)
    for level in range(bits - 1, 0, -1):  # undo the curve's turns and reflections, coarse to fine
        low = (1 << level) - 1
        for i in range(dims):
            bit = (x[i] >> level) & 1 == 1
            swap = np.where(bit, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(bit, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = x[i] ^ swap
    for i in range(1, dims):  # Gray code across the dimensions
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> level) & 1 == 1, (1 << level) - 1, 0)
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for v in x:
            index = (index << 1) | (((v ^ turn) >> level) & 1)
    return index


def _matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.float64).reshape(len(column), -1)


def _norm(x: np.ndarray) -> float:
    top = np.abs(x).max()
    return float(top * np.sqrt(((x / top) ** 2).sum()))


class Curves:
    """Random projections, fitted to the spread of a band's rows."""

    def __init__(self, length: int, norm: float, curves: int, dims: int, seed: int):
        rng = np.random.default_rng(seed)
        dims = min(dims, length + 1)
        self.norm, self.shape = norm, (curves, dims)
        self.axes = np.concatenate([np.linalg.qr(rng.normal(size=(length + 1, dims)))[0] for _ in range(curves)], axis=1)
        self.shift = rng.random(curves * dims)
        self.mean = self.spread = None

    def project(self, vectors: np.ndarray) -> np.ndarray:
        v = vectors / self.norm
        lift = np.sqrt(np.maximum(0, 1 - (v * v).sum(axis=1)))
        return np.concatenate([v, lift[:, None]], axis=1) @ self.axes

    def project_queries(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        return unit @ self.axes[:-1]

    def order(self, projected: np.ndarray, bits: int) -> np.ndarray:
        """Hilbert positions, shape (rows, curves)."""
        even = 1 / (1 + np.exp(-1.702 * np.clip((projected - self.mean) / self.spread, -30, 30)))
        cells = np.minimum(((even + self.shift) / 2 * (1 << bits)).astype(np.int64), (1 << bits) - 1)
        curves, dims = self.shape
        return np.stack([hilbert_index(cells[:, c * dims:(c + 1) * dims], bits) for c in range(curves)], axis=1)


def _valid(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    rows = df.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    # equal vectors must group together, so -0.0 becomes 0.0
    return rows.where(F.col("id").isNotNull() & fine).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))


def search(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
           curves: int = CURVES, dims: int = DIMS, bits: int = BITS, reach: float = REACH, seed: int = SEED) -> DataFrame:
    """Per query the ``k`` nearest rows found: ``query_id, rank, vec_id, score`` (inner product).

    ``is_query`` is a condition on the column ``id``.
    """
    spark = df.sparkSession
    small_batches(spark)
    first = Window.partitionBy("v").orderBy("id")
    rows = _valid(df, id_col, vector_col).dropDuplicates(["id", "v"])
    kept = rows.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1).select("id", "v", F.lit(True).alias("candidate"))
    asked = rows.where(is_query).select("id", "v", F.lit(False).alias("candidate"))

    def packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            vectors = [np.asarray(x, np.float64) for x in f["v"]]
            yield f.assign(v=[x.tobytes() for x in vectors], norm=[_norm(x) for x in vectors])

    rows = materialize(kept.unionAll(asked).mapInPandas(packed, "id long, v binary, candidate boolean, norm double"), "vectors")
    top = rows.agg(F.max("norm").alias("norm"), F.min(F.length("v")).alias("low"), F.max(F.length("v")).alias("high"),
                   F.count_if("candidate").alias("candidates"), F.count_if(~F.col("candidate")).alias("asked")).first()
    if top["low"] is None:
        return spark.range(0).selectExpr("id as query_id", "cast(id as int) as rank", "id as vec_id", "cast(id as double) as score")
    if top["low"] != top["high"]:
        raise ValueError("the vectors differ in length")
    near = max(int(reach * top["candidates"]), LEAST_ROWS)
    block = min(-(-near // 2), BLOCK_ROWS)
    window = -(-near // block)

    # bands: levels of length by powers of 2 (at most as many as a double has exponents); runs of them that fit a window are one band
    level = F.greatest(F.floor(F.log2(F.lit(top["norm"])) - F.log2("norm")), F.lit(0)).cast("int")
    rows = rows.withColumn("level", level)
    levels = rows.where("candidate").groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.max("norm").alias("norm")).collect()
    fitted = {r["level"]: Curves(top["low"] // 8, r["norm"], curves, dims, seed) for r in levels if r["n"] > near}
    whole = sum(r["n"] for r in levels if r["n"] <= near)

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for band, g in f.groupby("level"):
                p = fitted[band].project(_matrix(g["v"]))
                yield pd.DataFrame({"level": band, "axis": np.arange(p.shape[1]), "n": len(p), "s": p.sum(axis=0), "q": (p * p).sum(axis=0)})

    curved = F.col("level").isin(list(fitted))
    if fitted:
        stats = rows.where(F.col("candidate") & curved).mapInPandas(sums, "level int, axis int, n long, s double, q double")
        stats = stats.groupBy("level", "axis").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).toPandas()
        for band, g in stats.sort_values("axis").groupby("level"):  # curves * dims rows a band
            fitted[band].mean = (g["s"] / g["n"]).to_numpy()
            fitted[band].spread = np.sqrt(np.maximum((g["q"] / g["n"]).to_numpy() - fitted[band].mean**2, 1e-18))

    def along(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            candidate = f["candidate"].to_numpy()
            for band, curve in fitted.items():
                g = f[~candidate | (f["level"] == band).to_numpy()]  # queries go along the curves of every band
                if len(g):
                    v = _matrix(g["v"])
                    at = curve.order(np.where(g["candidate"].to_numpy()[:, None], curve.project(v), curve.project_queries(v)), bits)
                    for c in range(at.shape[1]):
                        yield g.drop(columns="norm").assign(level=band, curve=c, at=at[:, c])

    def places(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Of a sorted partition's rows: how many rows and how many candidates come before."""
        part, place, passed = TaskContext.get().partitionId(), 0, 0
        for f in frames:
            c = f["candidate"].to_numpy().astype(np.int64)
            yield f.assign(part=part, place=place + np.arange(len(f)), passed=passed + c.cumsum() - c)
            place, passed = place + len(f), passed + int(c.sum())

    line = ["level", "curve"]
    keys, met = [*line, "block", "queries"], []
    if fitted:
        sort = [*line, "at", "id", "candidate"]
        spread = rows.where(~F.col("candidate") | curved).mapInPandas(along, "id long, v binary, candidate boolean, level int, curve int, at long")
        ordered = materialize(spread.repartitionByRange(*sort).sortWithinPartitions(*sort).mapInPandas(
            places, "id long, v binary, candidate boolean, level int, curve int, at long, part int, place long, passed long"), "curves")
        parts = ordered.groupBy(*line, "part").agg(
            F.min("place").alias("place0"), F.count(F.lit(1)).alias("n"), F.min("passed").alias("passed0"), F.count_if("candidate").alias("c"))
        before = Window.partitionBy(*line).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.select(*line, "part", "place0", "passed0", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("places"),
                             F.coalesce(F.sum("c").over(before), F.lit(0)).alias("candidates"),
                             F.sum("c").over(Window.partitionBy(*line)).alias("all"))
        # a query's rank counts candidates alone; its group counts queries too, so that equal queries don't all meet in one task
        ranked = ordered.join(materialize(parts, "parts"), [*line, "part"]).withColumn(
            "block", F.floor((F.col("candidates") + F.col("passed") - F.col("passed0")) / block))
        group = F.floor((F.col("places") + F.col("place") - F.col("place0")) / (QUERY_BLOCKS * block))
        reached = F.sequence(F.greatest(F.col("block") - window, F.lit(0)),
                             F.least(F.col("block") + window, F.floor((F.col("all") - 1) / block)))
        asked = ranked.where("not candidate").select(*line, "id", "v", group.alias("queries"), reached.alias("reached"))
        blocks = materialize(asked.select(*line, "queries", F.explode("reached").alias("block")).distinct(), "blocks")
        data = ranked.where("candidate").select(*line, "block", "id", "v").join(blocks, [*line, "block"]).select(*keys, "id", "v")
        asked = asked.select(*line, F.explode("reached").alias("block"), "queries", "id", "v")
        met.append((data, asked))

    # bands that a window holds whole: every block of rows meets every group of queries
    parted = lambda n: (-(-n // BLOCK_ROWS) or 1)
    dealt = lambda n: F.pmod(F.xxhash64("id"), F.lit(parted(n)))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parted(n) - 1).cast("long")))
    none = [F.lit(-1).alias("level"), F.lit(-1).alias("curve")]
    if whole:
        met.append((rows.where(F.col("candidate") & ~curved).select(*none, dealt(whole).alias("block"), every(top["asked"]).alias("queries"), "id", "v"),
                    rows.where("not candidate").select(*none, every(whole).alias("block"), dealt(top["asked"]).alias("queries"), "id", "v")))
    data, asked = (reduce(DataFrame.unionByName, frames) for frames in zip(*met))
    asked = asked.select(*[F.col(c).alias(c) for c in asked.columns])

    def best(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(queries):
            ids, x = rows["id"].to_numpy(), _matrix(rows["v"])
            asking, q = queries["id"].to_numpy(), _matrix(queries["v"])
            for a in range(0, len(q), 256):
                near = q[a:a + 256] @ x.T
                near[asking[a:a + 256, None] == ids[None]] = -np.inf
                few = min(k, len(ids))
                least = np.partition(near, len(ids) - few, axis=1)[:, len(ids) - few]
                slack = 1e-9 * np.maximum(1, np.abs(np.where(np.isfinite(least), least, 0)))
                i, j = np.nonzero((near >= (least - slack)[:, None]) & np.isfinite(near))
                # the measure itself, in one order of summation whatever the block
                score = (q[a + i] * x[j]).sum(axis=1)
                f = pd.DataFrame({"query_id": asking[a + i], "vec_id": ids[j], "score": score})
                f = f.sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
                found.append(f.groupby("query_id").head(k))
        return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})

    found = data.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(best, "query_id long, vec_id long, score double")
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranks = found.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranks.select("query_id", "rank", "vec_id", "score")
