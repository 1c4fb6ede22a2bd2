"""Hard-negative mining: exact integer scores by Kronecker-packed products.

Method: components are scaled to integers. The same component of many candidates is biased to be
non-negative and packed into separated fields of one wide integer; one multiplication by an anchor's
(biased) component multiplies them all, and the sum over the components holds every candidate's score in a field of
its own. A field is wide enough for the largest sum, so fields never touch; the biases' share is known and taken off,
so scores are exact. Fields are 4 or 8 bytes; scores must stay below 2**56 (larger ones are an error).

Every anchor meets every row. Anchors are cut into blocks and rows into shards, both of bounded size; each block
meets each shard in one group of a cogrouped join, so no task ever holds more than a block and a shard. The first round
finds each anchor's positives, the second, which knows their scores, the negatives in their band; a
group returns only the few best of each anchor (and positive), and those of all shards are ranked together.
Both read one written table of integers, so groups and their numbers are the same whatever is run again.

Defined results:

* rows with a null id, label or vector, or a null or non-finite component take no part; an id is needed to name a row;
* vectors of different lengths are compared as if zeros followed the shorter one; an empty vector scores 0;
* rows that repeat an id are rows of their own: each may be an anchor, a positive and a negative, never of itself;
* ties go to the smaller id; repeated rows with the same id and score are returned as often as they are there;
* an anchor without a positive, and a positive without a negative in its band, return nothing; an empty table gives an empty result;
* other columns, whatever their names, aren't read.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonestream.llm.common import materialize

#: Rows of a shard and anchors of a block: the most that a group holds.
SHARD_ROWS, BLOCK_ANCHORS = 1 << 15, 1 << 10
#: Candidates whose components share one wide integer.
PACK = 256
#: Scores must stay below this, so that a hundred times a score still fits a long.
SCORE_LIMIT = 1 << 56


class Packed:
    """Rows of integers whose components lie in the fields of wide integers."""

    def __init__(self, rows: np.ndarray, other_bound: int):
        """``other_bound``: the largest absolute component of the vectors that these will meet."""
        self.n, self.dims = rows.shape
        self.bias = int(np.abs(rows).max(initial=0))
        self.other = other_bound
        if self.bias * other_bound * max(self.dims, 1) >= SCORE_LIMIT:
            raise ValueError("scores don't fit: components are too large")
        most = 2 * self.bias * 2 * other_bound * max(self.dims, 1)
        self.field = np.dtype("<u4" if most < 1 << 32 else "<u8")
        self.sums = rows.sum(axis=1)
        biased = (rows + self.bias).astype(self.field)
        # a wide integer for each component of each pack of candidates
        self.packs = [[int.from_bytes(column.tobytes(), "little") for column in np.ascontiguousarray(biased[a:a + PACK].T)]
                      for a in range(0, self.n, PACK)]

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """The inner products of one vector with all rows."""
        by = (anchor + self.other).tolist()
        out = np.empty(self.n, np.int64)
        for k, pack in enumerate(self.packs):
            width = min(PACK, self.n - k * PACK)
            fields = sum(map(operator.mul, pack, by)).to_bytes(width * self.field.itemsize, "little")
            out[k * PACK:k * PACK + width] = np.frombuffer(fields, self.field).astype(np.int64)
        # sum (a + A)(c + C) = sum ac + C sum a + A sum c + dims A C
        return out - self.bias * int(anchor.sum()) - self.other * self.sums - self.dims * self.other * self.bias


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """The lists as rows, zeros behind the shorter ones."""
    lists = column.combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0) if lists.num_chunks else pa.array([], lists.type)
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), dims), np.int64)
    out[np.arange(dims) < lengths[:, None]] = lists.flatten().to_numpy()
    return out


def _largest(x: np.ndarray) -> int:
    return int(np.abs(x).max(initial=0))


def _best(score: np.ndarray, ids: np.ndarray, fits: np.ndarray, k: int) -> np.ndarray:
    """Of the rows that fit, the ``k`` of the highest score, ties by id."""
    at = np.flatnonzero(fits)
    if len(at) > k:
        least = np.partition(score[at], len(at) - k)[len(at) - k]
        at = at[score[at] >= least]
    return at[np.lexsort((ids[at], -score[at]))][:k]


def scaled(df: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """``id, label, v`` of the rows that take part: components times ``scale``, rounded down."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = df.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"))
    fine = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & fine)
    # beyond a long, floor() would wrap silently
    whole = lambda c: F.when(F.abs(c * scale) < 2.0**62, F.floor(c * scale)).otherwise(F.raise_error(F.lit("a component is too large")).cast("long"))
    return rows.select("id", "label", F.transform("x", whole).alias("v"))


def mine(df: DataFrame, label: Column, is_anchor: Column, positives: int = 5, negatives: int = 10, band: tuple[int, int] = (30, 90),
         id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256, shard_rows: int = SHARD_ROWS,
         block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``label`` and ``is_anchor`` are expressions on the columns of ``df``. A negative's score, times 100, lies
    between ``band`` times the positive's.
    """
    anchor = df.select("*").where(is_anchor)
    rows = scaled(df, label, id_col, vector_col, scale).withColumn("anchor", F.lit(False))
    rows = rows.unionAll(scaled(anchor, label, id_col, vector_col, scale).withColumn("anchor", F.lit(True)))
    rows = materialize(rows.withColumn("deal", F.monotonically_increasing_id()), "integers")
    kinds = {r["anchor"]: r for r in rows.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dims")).collect()}
    if len(kinds) < 2:
        return df.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    dims = max(r["dims"] for r in kinds.values())
    shards, blocks = -(-kinds[False]["n"] // shard_rows), -(-kinds[True]["n"] // block_anchors)

    # which row a row is doesn't follow from its id, so rows and anchors are numbered by their place in the written table; dealt by a hash
    # of that number, blocks and shards are even whatever is repeated
    deal = lambda n: F.pmod(F.xxhash64("deal"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.where("not anchor").select(every(blocks).alias("block"), deal(shards).alias("shard"), "id", "label", "v")
    anchors = materialize(rows.where("anchor").select(deal(blocks).alias("block"), F.col("deal").alias("anchor"), "id", "label", "v"), "anchors")

    def met(candidates: pa.Table, anchors: pa.Table, pick) -> Iterator[tuple]:
        """A group's candidates packed, then what ``pick`` takes for each of its anchors."""
        if len(candidates) and len(anchors):
            ids, labels = candidates["id"].to_numpy(), candidates["label"].to_numpy()
            x, a = _matrix(candidates["v"], dims), _matrix(anchors["v"], dims)
            packed = Packed(x, _largest(a))
            for k, row in enumerate(anchors.drop(["v"]).to_pylist()):
                yield from pick(row, packed.scores(a[k]), ids, labels, x, a[k])

    def near(row, score, ids, labels, x, v):
        # one more than asked for: the anchor's own row, or one equal to it, is left out when all shards are ranked
        best = _best(score, ids, labels == row["label"], positives + 1)
        return [(row["anchor"], row["id"], int(ids[i]), int(score[i]), bool(ids[i] == row["id"] and (x[i] == v).all())) for i in best]

    def hard(row, score, ids, labels, x, v):
        out, other = [], labels != row["label"]
        for p in row["found"]:
            low, high = -(-band[0] * p["score"] // 100), band[1] * p["score"] // 100
            if low <= high:
                out += [(row["anchor"], row["id"], p["rank"], p["id"], p["score"], int(ids[i]), int(score[i]))
                        for i in _best(score, ids, other & (score >= low) & (score <= high), negatives)]
        return out

    def grouped(left: DataFrame, right: DataFrame, pick, schema: str) -> DataFrame:
        names = [c.split()[0] for c in schema.split(", ")]
        kinds = [{"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}[c.split()[1]] for c in schema.split(", ")]

        def as_table(a: pa.Table, b: pa.Table) -> pa.Table:
            found = list(met(a, b, pick))
            return pa.Table.from_arrays([pa.array([f[k] for f in found], kind) for k, kind in enumerate(kinds)], names)

        return left.groupBy("block", "shard").cogroup(right.groupBy("block", "shard")).applyInArrow(as_table, schema)

    spread = anchors.withColumn("shard", every(shards))
    seen = grouped(candidates, spread, near, "anchor long, anchor_id long, id long, score long, self boolean")
    order = [F.desc("score"), F.col("id")]
    # one row that equals the anchor is the anchor itself
    itself = F.row_number().over(Window.partitionBy("anchor", "self").orderBy("id"))
    ranked = seen.withColumn("same", itself).where(~(F.col("self") & (F.col("same") == 1)))
    ranked = ranked.withColumn("rank", F.row_number().over(Window.partitionBy("anchor").orderBy(*order))).where(F.col("rank") <= positives)
    found = ranked.groupBy("anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("found"))
    asked = materialize(anchors.join(found, "anchor"), "positives").withColumn("shard", every(shards))
    seen = grouped(candidates, asked, hard, "anchor long, anchor_id long, nth int, positive_id long, positive_score long, negative_id long, negative_score long")
    last = Window.partitionBy("anchor", "nth").orderBy(F.desc("negative_score"), "negative_id")
    return seen.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
