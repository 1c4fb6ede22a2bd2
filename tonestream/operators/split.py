"""Deterministic train / test splits keyed by a hash of the row key.

``randomSplit`` depends on how the input happens to be partitioned; a hash of
the key does not, and it is map-only (no shuffle, no sort).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonestream.operators.joins import sized_join
from tonestream.session import ensure_checkpoint_dir

TWO_POW_32 = 4294967296.0


def key_md5(key: Column | str) -> Column:
    col = F.col(key) if isinstance(key, str) else key
    return F.md5(col.cast("string"))


def key_unit(key: Column | str) -> Column:
    """A uniform number in [0, 1) from the first 32 bits of md5(key)."""
    return F.conv(F.substring(key_md5(key), 1, 8), 16, 10).cast("bigint") / F.lit(TWO_POW_32)


def hash_split(df: DataFrame, key: str, frac: float = 0.8, out: str = "is_train") -> DataFrame:
    """Adds ``is_train``: the row goes to training when its key's unit hash < ``frac``.
    A null key goes to the test side, so no row falls out of both."""
    return df.withColumn(out, F.coalesce(key_unit(key) < F.lit(frac), F.lit(False)))


def random_split(df: DataFrame, frac: float = 0.8, seed: int = 42, out: str = "is_train") -> DataFrame:
    """Spark's own ``randomSplit([frac, 1 - frac], seed)``, as a flag column.

    Kept for parity with a ``randomSplit`` workflow. Its assignment depends on
    how the input is partitioned and ordered, and the two halves are two seeded
    samples that each read the input, so ``hash_split`` (one map-only pass, the
    same split on any partitioning) is the default here.
    """
    train, test = df.randomSplit([frac, 1.0 - frac], seed)
    return train.withColumn(out, F.lit(True)).unionByName(test.withColumn(out, F.lit(False)))


def stratified_split(df: DataFrame, key: str, label: str = "target", frac: float = 0.8,
                     bucket_bits: int = 20, out: str = "is_train") -> DataFrame:
    """Exact stratified split: per class, the ``floor(frac * n_class)`` rows with
    the smallest ``(md5(key), key)`` go to training.

    Computed without sorting a class in one task: rows are counted per
    (class, hash bucket) - at most ``classes * 2**bucket_bits`` rows - a running
    sum over those counts finds each class's boundary bucket, and only the rows
    of that one bucket (about ``n / 2**bucket_bits``) are ranked to find the
    exact cut. The two per-class results have one row per class; they are
    checkpointed and broadcast behind the row bound of ``sized_join``, so the
    input is read three times in all, and the final flag is a map-only pass.

    ``key`` must identify a row (as the row index does for a shuffled split);
    rows sharing a key are indistinguishable to the ordering. For keys that
    repeat, use ``hash_split``, which keeps all rows of a key on one side. Rows
    with a null key rank last and, being indistinguishable, stay on the test side.
    """
    ensure_checkpoint_dir(df.sparkSession)
    hexdigits = (bucket_bits + 3) // 4
    bucket = F.shiftright(F.conv(F.substring("_m", 1, hexdigits), 16, 10).cast("bigint"), hexdigits * 4 - bucket_bits)
    # null keys come last: a bucket of their own behind all others
    d = df.withColumn("_m", key_md5(key)).withColumn("_b", F.coalesce(bucket, F.lit(1 << bucket_bits).cast("bigint")))
    # Pass 1: counts per (class, bucket); running sums find the boundary bucket.
    counts = d.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_c"))
    by_class = Window.partitionBy(label)
    running = by_class.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    stats = counts.select(
        label, "_b", "_c",
        F.sum("_c").over(running).alias("_cum"),
        F.floor(F.lit(frac) * F.sum("_c").over(by_class)).cast("bigint").alias("_k"),
    )
    # One row per class, checkpointed (reliable, shared folder) so the passes
    # below do not recompute the counting pass.
    bounds = (
        stats.where(F.col("_cum") >= F.col("_k"))
        .groupBy(label)
        .agg(F.min_by(F.struct("_b", (F.col("_k") - (F.col("_cum") - F.col("_c"))).alias("_need")), "_b").alias("s"))
        .select(label, F.col("s._b").alias("_bstar"), F.col("s._need").alias("_need"))
        .checkpoint()
    )
    n_classes = bounds.count()  # reads the checkpoint: one row per class
    # Pass 2: rank only the rows of each class's boundary bucket.
    edge = (
        sized_join(d, bounds.withColumnRenamed(label, "_lab"),
                   (F.col(label) == F.col("_lab")) & (F.col("_b") == F.col("_bstar")), known_bytes=256 * n_classes)
        .select(label, "_m", F.col(key).alias("_key"), "_need")
        .withColumn("_rn", F.row_number().over(Window.partitionBy(label).orderBy("_m", "_key")))
        .where(F.col("_rn") == F.col("_need"))
        .select(label, F.col("_m").alias("_mstar"), F.col("_key").alias("_kstar"))
    )
    cut = bounds.join(edge, label, "left").checkpoint()
    # Pass 3: map-only flag against the per-class cut.
    flagged = sized_join(d, cut, label, "left", known_bytes=256 * n_classes)
    m, k = F.col("_m"), F.col(key)
    at_or_below_cut = (m < F.col("_mstar")) | ((m == F.col("_mstar")) & (k <= F.col("_kstar")))
    is_train = (F.col("_b") < F.col("_bstar")) | ((F.col("_b") == F.col("_bstar")) & F.coalesce(at_or_below_cut, F.lit(False)))
    return flagged.withColumn(out, F.coalesce(is_train, F.lit(False))).drop("_m", "_b", "_bstar", "_need", "_mstar", "_kstar")
