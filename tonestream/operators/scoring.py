"""Batch scoring: resolve the text column, optionally clean, transform, label."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonestream.functions.clean import clean_v2, text_or_empty
from tonestream.functions.labels import label_name, label_name_strict, prediction_int
from tonestream.sources.labelled import texts_frame

TEXT_COLUMNS = ("clean_text", "text")
SCORE_COLUMNS = ("prediction", "pred", "sentiment", "p_neg", "p_pos")


def resolve_text_column(df: DataFrame, candidates: tuple[str, ...] = TEXT_COLUMNS) -> str:
    """First of ``clean_text``, ``text`` present in the frame; error otherwise (plan time)."""
    for c in candidates:
        if c in df.columns:
            return c
    raise ValueError(f"input must contain one of the columns {list(candidates)}; has {df.columns}")


def require_columns(df: DataFrame, cols: list[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; has {df.columns}")


def model_input(df: DataFrame, clean_first: bool = False, text_col: str | None = None) -> DataFrame:
    """The frame a model sees: the resolved text as ``clean_text`` (null -> ``''``),
    cleaned first when ``clean_first``; every other column kept."""
    src = text_col or resolve_text_column(df)
    text = text_or_empty(src)
    if clean_first:
        text = F.coalesce(clean_v2(text), F.lit(""))
    return df.withColumn("clean_text", text)


def with_labels(scored: DataFrame, strict: bool = True) -> DataFrame:
    """``pred`` (int), ``sentiment`` and, when the model gives them, ``p_neg``/``p_pos``."""
    out = scored.withColumn("pred", prediction_int("prediction"))
    out = out.withColumn("sentiment", label_name_strict("pred") if strict else label_name("pred"))
    if "probability" in scored.columns and "p_pos" not in scored.columns:
        probs = vector_to_array("probability")
        out = out.withColumns({"p_neg": probs[0], "p_pos": probs[1]})
    return out


def score_table(df: DataFrame, model: PipelineModel, clean_first: bool = False,
                text_col: str | None = None, keep_model_columns: bool = False) -> DataFrame:
    """Score every row; input columns kept, plus ``prediction, pred, sentiment,
    p_neg, p_pos`` (input columns of these names are replaced). Model stages run as
    JVM expressions in the same stage; they see only ``clean_text`` and the input row as one
    struct, so no input column can clash with a stage's own columns."""
    given = model_input(df, clean_first, text_col)
    scored = with_labels(model.transform(given.select("clean_text", F.struct("*").alias("_row"))))
    kept = [F.col("_row").getField(c).alias(c) for c in given.columns if c not in SCORE_COLUMNS]
    results = [c for c in SCORE_COLUMNS if c in scored.columns]
    stages = [c for c in scored.columns if c not in (*given.columns, *results, "_row")] if keep_model_columns else []
    return scored.select(*kept, *results, *stages)


def score_texts(spark: SparkSession, model: PipelineModel, texts: list[str], clean_first: bool = False) -> DataFrame:
    """Score a short list of texts (interactive use):
    ``clean_text, prediction, sentiment, p_neg, p_pos``."""
    return score_table(texts_frame(spark, texts), model, clean_first).select(
        "clean_text", "prediction", "sentiment", "p_neg", "p_pos"
    )
