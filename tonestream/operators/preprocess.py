"""Table-level cleaning and evaluation entry points (what the scripts did)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonestream.functions.clean import STOP_WORDS, clean_v1, clean_v2
from tonestream.functions.labels import binarize_label
from tonestream.operators import metrics
from tonestream.operators.filters import with_clean_text


def clean_table(df: DataFrame, version: str = "v2", text_col: str = "text", label_col: str = "target",
                binarize: bool = False, stop_words: Iterable[str] | None = STOP_WORDS) -> DataFrame:
    """Cleaned training table.

    ``v2`` (canonical): ``target, clean_text``; rows with a null label or text
    dropped, rows whose cleaned text is blank dropped.
    ``v1``: ``target, text, clean_text``; every row kept, cleaning of a null
    text gives ``''``.
    ``binarize``: map raw labels 4 -> 1, other -> 0 first.
    """
    target = binarize_label(label_col) if binarize else F.col(label_col)
    if version == "v1":
        return df.select(target.alias("target"), F.col(text_col).alias("text"),
                         F.coalesce(clean_v1(text_col, stop_words), F.lit("")).alias("clean_text"))
    if version == "v2":
        out = df.select(target.alias("target"), F.col(text_col).alias("_text")).dropna(subset=["target"])
        return with_clean_text(out, clean_v2("_text", stop_words)).select("target", "clean_text")
    raise ValueError(f"unknown cleaning version {version!r}")


def evaluate(scored: DataFrame, label: str = "target", prediction: str = "prediction") -> dict[str, DataFrame]:
    """``accuracy`` (one row), ``report`` (long per-class table) and
    ``confusion`` (2x2) of a scored table; each is one aggregation, lazy."""
    return {
        "accuracy": metrics.accuracy(scored, label, prediction),
        "report": metrics.class_report(scored, label, prediction),
        "confusion": metrics.confusion_matrix(scored, label, prediction),
    }
