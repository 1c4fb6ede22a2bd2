"""Small helpers that the operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonestream.sinks.files import materialize

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows that one Arrow batch carries to Python. Texts can be long, so batches
#: are kept small; it bounds a Python worker's memory, not the result.
ARROW_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one of the given tables."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def text_or_empty(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def key_of(c: Column) -> Column:
    """An id as a string that is never null and differs for different ids, for equi-joins whose partitioning a window shares."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of texts small unless the session asks for smaller ones."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def fresh(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def literal_table(spark: SparkSession, rows: str, schema: str) -> DataFrame:
    """A small constant table from a JSON array, made by SQL functions alone."""
    parsed = F.from_json(F.lit(rows), f"array<struct<{schema}>>")
    return spark.range(1).select(F.explode(parsed).alias("r")).select("r.*")


def once_a_worker(name: str, make):
    """What ``make`` returns, made once in each Python worker and kept for its later tasks.

    Only for tables that speed work up and whose content changes no result.
    """
    import sys
    import types

    kept = sys.modules.setdefault("tonestream_worker_tables", types.ModuleType("tonestream_worker_tables")).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def byte_letters() -> dict[int, str]:
    """The letter that byte-level tokenizers write for each byte of UTF-8, read off the library."""
    from tokenizers.pre_tokenizers import ByteLevel

    level, letters = ByteLevel(add_prefix_space=False, use_regex=False), {}
    for c in (*range(0x800), *range(0x800, 0xD800, 0x40), *range(0xE000, 0x110000, 0x40)):
        letters.update(zip(chr(c).encode(), level.pre_tokenize_str(chr(c))[0][0], strict=True))
    return letters


__all__ = ["once_a_worker", "byte_letters", "key_of", "WORD", "table", "ascii_lower", "text_or_empty", "small_batches", "fresh", "literal_table", "materialize"]
