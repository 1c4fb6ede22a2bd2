"""Row filters: blank text, topic keywords, retweets, language; table checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonestream.functions.clean import WORD_CLASS, is_blank
from tonestream.operators.evaluation import with_kept_column

# The ingest query's topic keywords, its language and the retweet prefix.
TOPIC_KEYWORDS = ("technology", "AI", "sports")
TOPIC_LANG = "en"
RETWEET_PATTERN = r"^RT @"


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose ``col`` is null or empty after trimming."""
    return df.where(F.col(col).isNotNull() & ~is_blank(col))


def with_clean_text(df: DataFrame, expr: Column, name: str = "clean_text") -> DataFrame:
    """Add a cleaned-text column, dropping rows where it is null or blank."""
    return with_kept_column(df, name, expr, lambda v: ~is_blank(v))


def keyword_pattern(keywords: Iterable[str]) -> str:
    """Case-insensitive whole-word match of any keyword, taken literally (Python's word characters)."""
    quoted = [r"\Q" + k.lower().replace(r"\E", r"\E\\E\Q") + r"\E" for k in keywords]
    if not all(keywords) or not quoted:
        raise ValueError("a topic filter needs at least one keyword, and none may be empty")
    return rf"(?iu)(^|[^{WORD_CLASS}])({'|'.join(quoted)})([^{WORD_CLASS}]|$)"


def topic_filter(df: DataFrame, keywords: Iterable[str] = TOPIC_KEYWORDS, lang: str | None = TOPIC_LANG,
                 text_col: str = "text", lang_col: str = "lang", exclude_retweets: bool = True) -> DataFrame:
    """Rows that mention a keyword, in ``lang``, and are not retweets; every
    condition applies to every keyword. The language test reaches the scan as a
    pushed filter."""
    cond = F.col(text_col).rlike(keyword_pattern(list(keywords)))
    if exclude_retweets:
        cond = cond & ~F.col(text_col).rlike(RETWEET_PATTERN)
    if lang is not None:
        cond = (F.col(lang_col) == F.lit(lang)) & cond
    return df.where(cond)


def require_not_empty(df: DataFrame) -> DataFrame:
    """Batch-only check: raise when the input has no rows (one-row probe)."""
    if df.isEmpty():
        raise ValueError("input table is empty")
    return df
