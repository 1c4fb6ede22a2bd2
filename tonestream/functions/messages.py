"""JSON message encode / decode for the ``{"text": ...}`` message format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

MESSAGE_SCHEMA = StructType([StructField("text", StringType())])


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def encode_message(text: Column | str) -> Column:
    """``{"text": ...}`` as a JSON string (the message value)."""
    return F.to_json(F.struct(_col(text).alias("text")))


def decode_declared(value: Column | str, schema: StructType | str = MESSAGE_SCHEMA) -> Column:
    """Decode with a declared schema; returns a struct, null fields when absent.

    This is the strict form: a malformed message or a non-object payload gives a
    struct of nulls, which the text defaulting turns into ``''``.
    """
    return F.from_json(_col(value).cast("string"), schema)


def parsed_message(value: Column | str) -> Column:
    """The message as a VARIANT, null when the bytes are not valid JSON."""
    return F.try_parse_json(_col(value).cast("string"))


def message_text(parsed: Column) -> Column:
    """Text of a parsed message.

    Object: its ``text`` field as a string, ``''`` when absent or null.
    Any other JSON value (string, number, array): the value itself as text.
    Malformed (null parse): null, so the caller can route it to quarantine.
    """
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    return (
        F.when(parsed.isNull(), F.lit(None).cast("string"))
        .when(is_object, F.coalesce(F.try_variant_get(parsed, "$.text", "string"), F.lit("")))
        .otherwise(F.coalesce(F.try_variant_get(parsed, "$", "string"), F.lit("")))
    )


def decode_messages(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Adds ``is_valid`` and ``text`` to a frame with a message column.

    The message is parsed once per row, also when the caller then filters on
    ``is_valid`` (see ``operators.evaluation``).
    """
    from tonestream.operators.evaluation import with_column_once

    return with_column_once(df, "_msg", parsed_message(value_col)).withColumns(
        {"is_valid": F.col("_msg").isNotNull(), "text": message_text(F.col("_msg"))}
    ).drop("_msg")


def split_quarantine(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, malformed rows) of a frame produced by ``decode_messages``."""
    return decoded.where(F.col("is_valid")), decoded.where(~F.col("is_valid"))
