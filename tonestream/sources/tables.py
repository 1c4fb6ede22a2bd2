"""Readers for the parquet tables and the labelled-text adapter built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonestream.functions.labels import RAW_POSITIVE
from tonestream.operators.joins import sized_join
from tonestream.operators.partitioning import spread

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


# Tables whose rows carry long texts or JSON: per-row work on them is CPU-heavy.
TEXT_TABLES = ("documents", "pages", "conversations", "benchmark", "events")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """One parquet table; projections and filters applied later reach the scan.

    Text tables are read with only the requested ``columns`` (so the pruning
    happens before the spread) and spread over the cores when under-split.
    """
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if columns:
        df = df.select(*columns)
    if name in TEXT_TABLES:
        df = spread(df)
    return df


#: Bytes of a row of labels in a broadcast relation.
LABEL_BYTES = 40


def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled texts: ``documents`` joined to ``labels`` on ``doc_id``.

    ``target`` = quality (0/1), ``raw_label`` = quality * 4 as in the six-column
    layout (0 negative, 4 positive), ``toxic`` kept for the deterministic rule
    prediction used by the metric queries. Catalyst prunes the scans to the used
    columns. Labels are three numbers a row and texts are long, so the counted labels are broadcast
    as long as they are below the bound of ``sized_join``, and the texts stay where they are; beyond it
    this is a plain equi-join, whose skewed keys AQE splits.
    """
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang", "source", "n_chars"])
    labs = read_table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return sized_join(docs, labs, "doc_id", known_bytes=LABEL_BYTES * labs.count()).select(
        "doc_id", "text", "lang", "source", "n_chars",
        F.col("quality").alias("target"),
        (F.col("quality") * RAW_POSITIVE).alias("raw_label"),
        "toxic",
    )


def rule_prediction(df: DataFrame, out: str = "prediction") -> DataFrame:
    """A deterministic stand-in prediction so metrics can be checked in SQL:
    non-toxic -> 1.0, toxic -> 0.0 (double, like a model's prediction)."""
    return df.withColumn(out, F.when(F.col("toxic") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
