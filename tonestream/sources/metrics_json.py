"""The stored metrics report: nested JSON <-> long table.

The report mixes per-class structs with a bare double ``accuracy``; a map
schema cannot hold both, so the schema is an explicit struct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

CLASS_KEYS = ("0", "1", "macro avg", "weighted avg")

CLASS_STATS = StructType([
    StructField("precision", DoubleType()),
    StructField("recall", DoubleType()),
    StructField("f1-score", DoubleType()),
    StructField("support", DoubleType()),
])
METRICS_SCHEMA = StructType([
    StructField("accuracy", DoubleType()),
    StructField("classification_report", StructType(
        [StructField(k, CLASS_STATS) for k in CLASS_KEYS[:2]]
        + [StructField("accuracy", DoubleType())]
        + [StructField(k, CLASS_STATS) for k in CLASS_KEYS[2:]]
    )),
])


def report_struct(report: DataFrame) -> DataFrame:
    """Fold the five-row long report into the nested one-row form."""
    def stats(name: str):
        row = F.when(F.col("class") == name, F.struct(
            F.col("precision").alias("precision"), F.col("recall").alias("recall"),
            F.col("f1").alias("f1-score"), F.col("support").cast("double").alias("support")))
        return F.first(row, ignorenulls=True).alias(name)

    acc = F.first(F.when(F.col("class") == "accuracy", F.col("f1")), ignorenulls=True)
    folded = report.agg(acc.alias("accuracy"), *[stats(k) for k in CLASS_KEYS])
    inner = F.struct(F.col("0"), F.col("1"), F.col("accuracy").alias("accuracy"),
                     F.col("macro avg"), F.col("weighted avg"))
    return folded.select(F.col("accuracy"), inner.alias("classification_report"))


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """Read a report (pretty-printed or one line) into the long table
    ``class, precision, recall, f1, support``."""
    raw = spark.read.option("multiLine", "true").schema(METRICS_SCHEMA).json(path)
    r = "classification_report"

    def row(key: str):
        s = F.col(f"{r}.`{key}`")
        return F.struct(F.lit(key).alias("class"), s["precision"].alias("precision"), s["recall"].alias("recall"),
                        s["f1-score"].alias("f1"), s["support"].cast("bigint").alias("support"))

    total = F.col(f"{r}.`macro avg`.support").cast("bigint")
    acc_row = F.struct(F.lit("accuracy").alias("class"), F.lit(None).cast("double").alias("precision"),
                       F.lit(None).cast("double").alias("recall"), F.col(f"{r}.accuracy").alias("f1"),
                       total.alias("support"))
    return raw.select(F.inline(F.array(row("0"), row("1"), acc_row, row("macro avg"), row("weighted avg"))))
