"""Evaluate an expensive expression once per row, even when rows are filtered on it.

Catalyst pushes a filter on a computed column through the projection that
computes it, substituting the expression into the predicate; the expression then
runs once in the filter and again in the projection (seen in ``explain`` for the
regex cleaning and for JSON parsing). A value produced by a generator is an
attribute of the generator's output, and predicates on it stay above the
generator, so a one-element array unpacked by ``explode_outer`` evaluates the
expression exactly once and keeps the row count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_column_once(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """``df.withColumn(name, expr)`` whose value later filters cannot re-evaluate."""
    return df.select("*", F.explode_outer(F.array(expr)).alias(name))


def with_kept_column(df: DataFrame, name: str, expr: Column, keep: Callable[[Column], Column]) -> DataFrame:
    """Add ``name = expr`` and keep the rows where ``keep(value)`` holds,
    evaluating ``expr`` once per row (the filter runs inside the array)."""
    kept = F.filter(F.array(expr), lambda v: F.coalesce(keep(v), F.lit(False)))
    return df.select("*", F.explode_outer(kept).alias(name)).where(F.col(name).isNotNull())
