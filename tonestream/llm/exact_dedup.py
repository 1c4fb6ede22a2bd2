"""Exact dedup: group by a 128-bit content hash, compare the bytes inside each group.

Method: every text is keyed by its MD5 (128 bits). Grouping on (hash, text) makes
Spark compare the bytes themselves inside a hash group, so a collision of the hash
can never merge two different texts. The grouping combines on the map side: a text
that a third of all rows repeat leaves each map task once. One stable id stays per
group; its id and the group's size go back to the rows over narrow keys (id and
hashes, no text), in an equi-join whose skewed partitions AQE splits.

Defined results:

* null text counts as the empty text;
* a null id takes part like any other; it stays only in a group without ids;
* rows that repeat both id and text are one document: ``annotate`` returns each of
  them, ``dedup`` returns one of them;
* an empty table gives an empty result;
* other columns, whatever their names, pass through ``dedup`` unchanged and are
  not read by ``annotate``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonestream.llm.common import ascii_lower, fresh, key_of, text_or_empty

KEEP = {"min": F.min, "max": F.max}


def _keyed(df: DataFrame, id_col: str, text_col: str, normalise) -> DataFrame:
    norm = normalise(text_or_empty(text_col))
    return df.select(F.col(id_col).alias("id"), norm.alias("norm")).select(
        "id", "norm", F.unhex(F.md5("norm")).alias("hash"))


def _groups(keyed: DataFrame, keep: str) -> DataFrame:
    groups = keyed.groupBy("hash", "norm").agg(F.count(F.lit(1)).alias("group_size"), KEEP[keep]("id").alias("keep_id"))
    return groups.select("hash", F.unhex(F.sha2("norm", 256)).alias("sha"), "group_size", "keep_id")


def annotate(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
             normalise=ascii_lower) -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    ``keep`` says which id of equal texts stays (``min`` or ``max``);
    ``normalise`` maps the text column to the form that is compared.
    """
    keyed = _keyed(df, id_col, text_col, normalise)
    rows = keyed.select("id", "hash", F.unhex(F.sha2("norm", 256)).alias("sha"))
    return rows.join(_groups(keyed, keep), ["hash", "sha"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min",
          normalise=ascii_lower) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns."""
    (row,) = fresh(df, "row")
    groups = _groups(_keyed(df, id_col, text_col, normalise), keep).select("hash", "sha", key_of(F.col("keep_id")).alias("key"))
    norm = normalise(text_or_empty(text_col))
    rows = df.select(F.struct("*").alias(row), key_of(F.col(id_col)).alias("key"), norm.alias("norm")).select(
        row, "key", F.unhex(F.md5("norm")).alias("hash"), F.unhex(F.sha2("norm", 256)).alias("sha"))
    # the row that stays is found by its id too, so that a large group's rows are spread
    once = Window.partitionBy("hash", "sha", "key").orderBy("key")
    stay = rows.join(groups, ["hash", "sha", "key"]).withColumn("nth", F.row_number().over(once))
    return stay.where("nth = 1").select(f"{row}.*")
