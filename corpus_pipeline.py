"""A training corpus from raw documents, in five stages.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)`` and returns a
DataFrame, which is written as Parquet and read again as the next stage's ``docs``. All but
the last keep the columns of ``documents``. Each stage works on everything that the one before it kept.

Results for unusual rows are those of the operators that the stages call: null texts count as
empty, empty tables give empty results, columns with any further names pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tonestream.llm import exact_dedup, mixing, ngram_join, packing, quality
from tonestream.llm.common import materialize, table
from tonestream.llm.queries import tokenizer_file


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier doesn't reject."""
    model = quality.learn(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.keep(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest id, as in the query of the operator."""
    return exact_dedup.dedup(docs, keep="max")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link, that with the smallest id."""
    return ngram_join.keep(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the sources' target weights, each up to three times."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each drawn document stands in the training sequences."""
    return packing.pack(docs, tokenizer_file("word_bpe_49k.json"))


STAGES = [
    ("quality", classify),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

#: A fitted classifier, hashes of Spark's own and token ids can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
