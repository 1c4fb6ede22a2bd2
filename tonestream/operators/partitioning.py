"""Partition sizing by bytes: enough tasks for the cores, not more than the data needs."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

# Featurized bytes per partition for inputs that are scanned many times (iterative fits).
BYTES_PER_PARTITION = 4 << 20
# Largest table whose rows are dealt out anew because its files give too few splits.
SPREAD_BYTES = 1 << 30


def spread(df: DataFrame) -> DataFrame:
    """Give CPU-heavy per-row work at least one task per core.

    A scan yields one task per file split, and a row group can't be split. When a
    small table in few row groups gives fewer splits than there are cores, its rows are dealt
    round-robin over ``defaultParallelism`` tasks. That costs a shuffle, so only tables of at
    most ``SPREAD_BYTES`` are; larger ones should be written with more row groups. The
    result is the same either way. Only file sizes and the plan are looked at; no job runs.
    """
    target = df.sparkSession.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size <= SPREAD_BYTES and df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def fit_partitions(df: DataFrame, n_bytes: int, bytes_per_partition: int = BYTES_PER_PARTITION) -> DataFrame:
    """Coalesce (no shuffle) an input that is read once per iteration to about
    ``n_bytes / bytes_per_partition`` partitions, ``n_bytes`` as measured on the rows.

    Each optimizer step is one job with one task per partition; a task over less than a
    few MB costs more to start than to run. An input whose partitions hold more than that keeps them.
    """
    want = max(1, math.ceil(n_bytes / bytes_per_partition))
    if df.rdd.getNumPartitions() > want:
        return df.coalesce(want)
    return df
