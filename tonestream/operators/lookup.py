"""Look terms up inside the row: a bounded table of terms as one value that every task holds.

A join of a document's words with a table of weights moves a row for each word. Where the table
is small, it is packed into one row instead: an array of buckets, each a short array of the entries
whose terms hash there. A scalar subquery hands that row to the tasks, and an expression
finds a term by its bucket, so a document's words are weighed and summed in a projection,
without a shuffle and without a row for each word; a stream's plan can hold it too.

The packed row goes through the driver, so it is only made of tables of a measured size (``LOOKUP_BYTES``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonestream.operators.evaluation import with_column_once
from tonestream.operators.joins import BROADCAST_BYTES

#: The largest table that is packed, as the caller measures it.
LOOKUP_BYTES = BROADCAST_BYTES
#: Entries of a bucket, on average.
BUCKET_ENTRIES = 2
ENTRY_BYTES = 64

Find = Callable[[Column], Column]


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


@dataclass
class Lookup:
    """A packed table at ``path``: one row, ``buckets array<array<struct<term, ...>>>``."""

    spark: SparkSession
    path: str
    buckets: int

    def table(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


def pack_lookup(terms: DataFrame, n_terms: int, path: str) -> Lookup:
    """Write ``terms`` (a column ``term`` without repeats, and its values) packed at ``path``."""
    spark, buckets = terms.sparkSession, max(1, n_terms // BUCKET_ENTRIES)
    values = [c for c in terms.columns if c != "term"]
    entries = terms.groupBy(_bucket(F.col("term"), buckets).alias("b")).agg(
        F.sort_array(F.collect_list(F.struct("term", *values))).alias("entries"))
    every = spark.range(buckets).select(F.col("id").cast("int").alias("b")).join(entries, "b", "left")
    row = every.agg(F.transform(F.sort_array(F.collect_list(F.struct("b", "entries"))), lambda x: x["entries"]).alias("buckets"))
    row.coalesce(1).write.mode("overwrite").parquet(path)
    return Lookup(spark, path, buckets)


def with_lookup(df: DataFrame, lookup: Lookup, out: str, words: Column, expr: Callable[[Column, Find], Column]) -> DataFrame:
    """Add ``out = expr(words, find)``, where ``find(term)`` is the term's entry or null.

    ``words`` are computed once, behind a generator. What stands between that and ``expr`` is only the
    packed row, so Catalyst folds both projections into one, and the row stays a value of the
    task: it never becomes a column of the data (a plan test holds this).
    """
    given = df.columns
    df = with_column_once(df, "_words", words)
    df = df.withColumn("_lookup", lookup.table().scalar())
    find = lambda term: F.get(F.filter(F.get(F.col("_lookup"), _bucket(term, lookup.buckets)), lambda e: e["term"] == term), F.lit(0))
    df = df.select(*given, expr(F.col("_words"), find).alias("_found"))
    # filters on the result stay above the generator, so they don't look up again
    return df.select(*given, F.explode_outer(F.array("_found")).alias(out))


def bound(value: Column, expr: Callable[[Column], Column]) -> Column:
    """``expr(value)`` with ``value`` computed once, however often ``expr`` uses it."""
    return F.transform(F.array(value), expr)[0]
