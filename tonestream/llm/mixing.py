"""Mixing sources to target weights through a splitting tree over block quotas.

Method:

1. Every document falls into one of ``blocks`` blocks of its source by a hash of its
   id and text. A source's blocks in hash order are its permutation.
2. Sources get targets (weighted shares of all words, stopped at ``max_repeat``
   times their size, the excess reshared). A source's target is met by whole
   passes over its blocks plus a part pass: permuted blocks up to the remainder; ``fill``
   times over, blocks that still fit, and one more where that is nearer. This gives the
   source's exact quota of block draws.
3. The quotas of all sources are split among ``2**levels`` output shards by a tree:
   each node's draws are an urn of which the left child receives exactly half
   without replacement, so its sources are multivariate-hypergeometric; the right
   child gets the rest. Only quotas travel down the tree, never documents.
4. A shard's quota of a source is a run of that source's permuted draws; runs are
   disjoint. Documents join the draws of their block, and each shard is shuffled
   locally by a hash.

Everything is DataFrame functions. Draws number at most ``max_repeat * blocks`` a
source, whatever the number of documents; a source with a third of all documents
is spread over its blocks, and neither all sources nor all draws of a node meet in one task. All randomness hashes ``seed``, so reruns agree.

Defined results:

* null text has size 0; documents of size 0 are drawn like others and take 0 words;
* a null source is a source of its own, last in order;
* null ids are hashed by their text; rows that repeat id and text share a block, each counts;
* without any words all targets are 0; an empty table gives an empty result;
* other columns, whatever their names, pass through ``mix`` unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonestream.llm.common import WORD, fresh, materialize, text_or_empty

WEIGHTS = (5, 2, 1)
BLOCKS = 4096
MAX_REPEAT = 3
LEVELS = 4
FILL = 4
SEED = 20240229
#: Cells into which the keys of a node's draws are counted: at most 2**16 rows a node, whatever its draws.
CELL_BITS = 16


def word_count(text_col: str) -> Column:
    return F.regexp_count(text_or_empty(text_col), F.lit(WORD)).cast("long")


def _block(id_col: str, text_col: str, blocks: int, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col(id_col), text_or_empty(text_col)), F.lit(blocks)).cast("int")


def source_targets(sizes: DataFrame, weights=WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``source, source_size, weight, target`` from ``source, source_size``.

    Sharing the excess again until no target is above its stop is the water level
    at which the targets sum to all words: ordered by stop over weight, the stopped
    sources come first. Both orders are cut into ranges, so no task ranks all sources.
    """
    weight = F.array(*[F.lit(int(w)) for w in weights])
    ranked = _running(sizes.withColumn("one", F.lit(1).cast("long")), [F.col("source").asc_nulls_last()], ["one"], "mix_ranks")
    s = ranked.withColumn("weight", F.get(weight, (F.col("one_before") % len(weights)).cast("int")).cast("long")).select("source", "source_size", "weight")
    s = s.withColumn("stop", F.col("source_size") * max_repeat).withColumn("level", F.col("stop") / F.col("weight"))
    s = _running(s, [F.col("level").asc(), F.col("source").asc_nulls_last()], ["stop", "weight"], "mix_levels")
    total = s.agg(F.sum("source_size").alias("total"), F.sum("weight").alias("weights")).first()
    here = (F.lit(total["total"]) - F.col("stop_before")) / (F.lit(total["weights"]) - F.col("weight_before"))
    s = s.withColumn("stopped", here > F.col("level"))
    rest = s.agg(F.sum(F.when(F.col("stopped"), F.col("stop"))).alias("stops"), F.sum(F.when(~F.col("stopped"), F.col("weight"))).alias("share")).first()
    left = (total["total"] or 0) - (rest["stops"] or 0)
    target = F.when(F.col("stopped"), F.col("stop").cast("double")).otherwise(F.lit(left) * F.col("weight") / F.lit(rest["share"]))
    return s.withColumn("target", target).select("source", "source_size", "weight", "target")


def _running(df: DataFrame, order: list[Column], of: list[str], name: str) -> DataFrame:
    """``df`` with ``<c>_before``: the sum of ``c`` over all rows that come earlier in the order.

    Rows are dealt out by ranges of the order and summed within their range; only the ranges' totals, one row each,
    meet in one task.
    """
    dealt = df.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    dealt = materialize(dealt, name)
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("range").agg(*[F.sum(c).alias(c) for c in of])
    totals = totals.select(F.col("range").alias("r"), *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_ranges") for c in of])
    mine = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = dealt.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(mine), F.lit(0)) for c in of})
    rows = rows.join(totals, F.col("range") == F.col("r")).withColumns({f"{c}_before": F.col(f"{c}_before") + F.col(f"{c}_ranges") for c in of})
    return rows.drop("range", "r", *[f"{c}_ranges" for c in of])


def _quotas(words: DataFrame, targets: DataFrame, max_repeat: int, fill: int, seed: int) -> DataFrame:
    """``source, block, words, perm, copies``: how often each block is drawn."""
    same = F.col("source").eqNullSafe(F.col("s"))
    b = words.join(targets.select(F.col("source").alias("s"), "source_size", "target"), same).drop("s")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    b = b.withColumn("passes", passes.cast("long"))
    b = b.withColumn("perm", F.row_number().over(
        Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), "block"), "block")).cast("long"))
    mine = Window.partitionBy("source")
    so_far = mine.orderBy("copies", "perm").rowsBetween(Window.unboundedPreceding, 0)
    b = b.withColumn("copies", F.col("passes"))
    short = F.col("target") - F.sum(F.col("copies") * F.col("words")).over(mine)
    for _ in range(fill):  # permuted blocks that still fit, those drawn least first
        b = b.withColumn("short", short)
        fits = (F.col("copies") < max_repeat) & (F.col("words") > 0) & (F.col("words") <= F.col("short"))
        upto = F.sum(F.when(fits, F.col("words"))).over(so_far)
        b = b.withColumn("more", (fits & (upto <= F.col("short"))).cast("long"))
        b = b.withColumn("copies", F.col("copies") + F.col("more"))
    # and one block more where that ends nearer to the target
    b = b.withColumn("short", short)
    over = F.col("words") - F.col("short")
    b = b.withColumn("over", F.when((F.col("copies") < max_repeat) & (over > 0) & (over < F.col("short")), over))
    last = F.row_number().over(mine.orderBy(F.col("over").asc_nulls_last(), "perm")) == 1
    copies = F.col("copies") + (F.col("over").isNotNull() & last).cast("long")
    return b.select("source", "block", "words", "perm", copies.alias("copies"))


def _tree(quotas: DataFrame, levels: int, seed: int) -> DataFrame:
    """``source, shard, quota``: the sources' draws split among the shards."""
    nodes = quotas.groupBy("source").agg(F.sum("copies").alias("quota")).where("quota > 0").withColumn("node", F.lit(0).cast("long"))
    for level in range(levels):
        nodes = materialize(nodes, "mix_nodes")
        ball = F.explode(F.sequence(F.lit(1).cast("long"), F.col("quota"))).alias("ball")
        urn = nodes.select("node", "source", ball).withColumn("key", F.xxhash64(F.lit(seed + level), "source", "ball"))
        urn = urn.withColumn("cell", F.shiftright("key", 64 - CELL_BITS))
        # the left child gets the half with the smallest keys: its border is found on counts of key cells, and only the cell that the
        # border runs through is ranked
        cells = urn.groupBy("node", "cell").agg(F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy("node").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        cells = cells.withColumn("upto", F.sum("n").over(upto)).withColumn("half", F.ceil(F.sum("n").over(Window.partitionBy("node")) / 2))
        border = materialize(cells.where("upto >= half AND upto - n < half").select(
            "node", F.col("cell").alias("border"), (F.col("half") - F.col("upto") + F.col("n")).alias("need")), "mix_borders")
        urn = urn.join(F.broadcast(border), "node")  # a row for each node of the level, 2**levels at most
        side = F.when(F.col("cell") < F.col("border"), 0).otherwise(1)
        clear = urn.where("cell <> border").groupBy((F.col("node") * 2 + side).alias("node"), "source").agg(F.count(F.lit(1)).alias("quota"))
        drawn = Window.partitionBy("node").orderBy("key", "source", "ball")
        on = urn.where("cell = border").withColumn("side", F.when(F.row_number().over(drawn) <= F.col("need"), 0).otherwise(1))
        on = on.groupBy((F.col("node") * 2 + F.col("side")).alias("node"), "source").agg(F.count(F.lit(1)).alias("quota"))
        nodes = clear.unionAll(on).groupBy("node", "source").agg(F.sum("quota").alias("quota"))
    return nodes.select("source", F.col("node").alias("shard"), "quota")


def draws(df: DataFrame, weights=WEIGHTS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          blocks: int = BLOCKS, levels: int = LEVELS, max_repeat: int = MAX_REPEAT, fill: int = FILL,
          seed: int = SEED) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(documents, targets, draws)``.

    documents: ``id, source, block, size``, one row per row of ``df``; targets: see
    ``source_targets``; draws: ``source, block, shard``, a row each time a block is drawn.
    """
    docs = materialize(df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"),
                                 _block(id_col, text_col, blocks, seed).alias("block"),
                                 word_count(text_col).alias("size")), "mix_docs")
    words = materialize(docs.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix_blocks")
    targets = materialize(source_targets(
        words.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_repeat), "mix_targets")
    quotas = materialize(_quotas(words, targets, max_repeat, fill, seed), "mix_quotas")
    tree = _tree(quotas, levels, seed)
    # a shard's run of the source's draws in permuted order: pass by pass, block by block
    upto = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    runs = tree.withColumn("to", F.sum("quota").over(upto)).select(
        F.col("source").alias("s"), "shard", (F.col("to") - F.col("quota")).alias("from"), "to")
    units = quotas.where("copies > 0").select("source", "block", "perm", F.explode(
        F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    nth = Window.partitionBy("source").orderBy("copy", "perm")
    units = units.withColumn("nth", F.row_number().over(nth).cast("long"))
    mine = F.col("source").eqNullSafe(F.col("s")) & (F.col("nth") > F.col("from")) & (F.col("nth") <= F.col("to"))
    return docs, targets, materialize(units.join(runs, mine).select("source", "block", "shard", "copy"), "mix_draws")


def report(df: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Per document: ``id_col, size, source_size, target, taken`` (words, repeats counted)."""
    docs, targets, drawn = draws(df, id_col=id_col, **options)
    times = drawn.groupBy(F.col("source").alias("s"), F.col("block").alias("b")).agg(F.count(F.lit(1)).alias("times"))
    per_source = targets.select(F.col("source").alias("s"), "source_size", "target")
    out = docs.join(per_source, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    out = out.join(times, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")), "left")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target",
                      (F.col("size") * F.coalesce("times", F.lit(0))).alias("taken"))


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        blocks: int = BLOCKS, seed: int = SEED, keep_place: bool = False, **options) -> DataFrame:
    """The mix: the rows of ``df`` drawn, each as often as its block.

    With ``keep_place`` the columns ``shard`` and ``place`` (the order in a shard) come
    first; sorting each shard's rows by ``place`` is its local shuffle.
    """
    _, _, drawn = draws(df, id_col=id_col, text_col=text_col, source_col=source_col, blocks=blocks, seed=seed, **options)
    row, s, b = fresh(df, "row", "s", "b")
    rows = df.select(F.struct("*").alias(row), F.col(source_col).alias(s), _block(id_col, text_col, blocks, seed).alias(b),
                     F.xxhash64(F.lit(seed), F.col(id_col), text_or_empty(text_col)).alias("key"))
    got = rows.join(drawn, F.col(s).eqNullSafe(F.col("source")) & (F.col(b) == F.col("block")))
    if not keep_place:
        return got.select(f"{row}.*")
    return got.select("shard", F.xxhash64("key", "copy", "shard").alias("place"), f"{row}.*")


def write_shards(mixed: DataFrame, path: str, shards: int = 2**LEVELS) -> str:
    """Write the mix of ``mix(..., keep_place=True)``, one folder a shard, shuffled within each file."""
    mixed.repartition("shard", F.pmod("place", F.lit(shards))).sortWithinPartitions("shard", "place").write.partitionBy(
        "shard").mode("errorifexists").parquet(path)
    return path


__all__ = ["source_targets", "draws", "report", "mix", "write_shards", "word_count"]
