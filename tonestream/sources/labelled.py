"""Labelled and to-score CSV / Parquet readers with fixed schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from tonestream.functions.labels import binarize_label

# Six-column headerless layout (target 0/4, id, date, flag, user, text).
RAW_SCHEMA = StructType([
    StructField("target", IntegerType()),
    StructField("id", LongType()),
    StructField("date", StringType()),
    StructField("flag", StringType()),
    StructField("user", StringType()),
    StructField("text", StringType()),
])
GENERIC_SCHEMA = StructType([StructField("target", IntegerType()), StructField("text", StringType())])
CLEANED_V1_SCHEMA = StructType([
    StructField("target", IntegerType()), StructField("text", StringType()), StructField("clean_text", StringType()),
])
CLEANED_V2_SCHEMA = StructType([StructField("target", IntegerType()), StructField("clean_text", StringType())])

# Quoting that lets quotes, newlines and backslashes survive a write and a read.
CSV_OPTIONS = {"quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
RAW_ENCODING = "ISO-8859-1"


def csv_reader(spark: SparkSession, header: bool, encoding: str = "UTF-8", multi_line: bool = True):
    """``multi_line``: records may hold line breaks. Such a file can't be split, so it is one task;
    without it a file of one record a line is read by many tasks."""
    return (spark.read.options(**CSV_OPTIONS).option("multiLine", multi_line).option("header", header).option("encoding", encoding))


def detect_layout(spark: SparkSession, path: str, encoding: str = RAW_ENCODING) -> str:
    """The layout by the first record: ``generic`` where it names ``target`` and ``text``,
    ``sentiment140`` where it has six or more cells, the first a whole number; else an error."""
    first = csv_reader(spark, header=False, encoding=encoding, multi_line=False).csv(path).first()
    cells = [c or "" for c in first or ()]
    if {"target", "text"} <= {c.strip() for c in cells}:  # names
        return "generic"
    if len(cells) >= 6 and cells[0].strip().lstrip("-").isdigit():
        return "sentiment140"
    raise ValueError(f"CSV format not recognized: first record {cells[:8]}")


def _whole_lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    """``RAW_SCHEMA`` records of one line each; a record that isn't whole in its line is an error.

    Spark keeps the line of records whose number of cells isn't the schema's, so the schema has a cell too many.
    """
    schema = StructType([*RAW_SCHEMA.fields, StructField("_more", StringType()), StructField("_line", StringType())])
    reader = csv_reader(spark, header=False, encoding=encoding, multi_line=False).option("columnNameOfCorruptRecord", "_line")
    times = lambda c: F.length("_line") - F.length(F.replace("_line", F.lit(c), F.lit("")))
    # the last quote opens a cell that no quote closes
    open_ = (times('"') % 2 == 1) & F.replace("_line", F.lit('""'), F.lit("")).rlike('(^|,)"[^"]*$')
    cut = F.coalesce(open_ | (F.col("text").isNull() & (times(",") < len(RAW_SCHEMA) - 1)), F.lit(False))
    # a filter of all cells: a column would be pruned where nothing reads it, and pruned cells aren't counted
    error = F.raise_error(F.concat(F.lit("a record isn't whole in its line; read texts with line breaks with multi_line=True: "),
                                   F.substring(F.concat_ws(" ", "_line", *[f.name for f in schema[:-1]]), 1, 80)))
    return reader.schema(schema).csv(path).where(F.when(cut, error.cast("boolean")).otherwise(F.lit(True))).drop("_more", "_line")


def load_labelled(spark: SparkSession, path: str, layout: str = "auto", binarize: bool | None = None,
                  encoding: str | None = None, multi_line: bool | None = None) -> DataFrame:
    """Labelled texts as ``(target int, text string)``.

    ``multi_line``: see ``csv_reader``; by default off for ``sentiment140`` (one tweet a line) and on for ``generic``.
    Where it is off for ``sentiment140``, a record that a line break cuts is an error.

    ``sentiment140``: headerless six-column Latin-1 file, target 0/4 -> 0/1.
    ``generic``: headered file with ``target`` and ``text``; labels are kept as
    they are unless ``binarize=True``.
    """
    if layout == "auto":
        layout = detect_layout(spark, path, encoding or RAW_ENCODING)
    if layout == "sentiment140":
        if multi_line:
            df = csv_reader(spark, header=False, encoding=encoding or RAW_ENCODING).schema(RAW_SCHEMA).csv(path)
        else:
            df = _whole_lines(spark, path, encoding or RAW_ENCODING)
        do_binarize = True if binarize is None else binarize
    elif layout == "generic":
        raw = csv_reader(spark, header=True, encoding=encoding or "UTF-8", multi_line=multi_line is not False).csv(path)
        missing = {"target", "text"} - set(raw.columns)
        if missing:
            raise ValueError(f"CSV format not recognized: missing columns {sorted(missing)}")
        df = raw.select(F.col("target").try_cast("int").alias("target"), F.col("text").cast("string").alias("text"))
        do_binarize = bool(binarize)
    else:
        raise ValueError(f"unknown layout {layout!r}")
    target = binarize_label("target") if do_binarize else F.col("target")
    return df.select(target.alias("target"), "text")


def read_cleaned(spark: SparkSession, path: str, fmt: str = "parquet", version: str = "v2") -> DataFrame:
    """Cleaned training table with its declared schema (no inference pass)."""
    schema = CLEANED_V2_SCHEMA if version == "v2" else CLEANED_V1_SCHEMA
    if fmt == "csv":
        return csv_reader(spark, header=True).schema(schema).csv(path)
    return spark.read.schema(schema).parquet(path)


def read_to_score(spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = True) -> DataFrame:
    """A table to score: every column kept, strings as read."""
    if fmt == "csv":
        return csv_reader(spark, header=True, multi_line=multi_line).csv(path)
    return spark.read.format(fmt).load(path)


def texts_frame(spark: SparkSession, texts: list[str], col: str = "clean_text") -> DataFrame:
    """A small in-memory frame of texts to score (interactive use)."""
    return spark.createDataFrame([(t,) for t in texts], StructType([StructField(col, StringType())]))
