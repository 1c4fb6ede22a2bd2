"""Multinomial Naive Bayes, as a relational model and as a Spark ML pipeline.

Relational form: the model is a table ``(term, ll_0, ll_1)`` of smoothed log
likelihoods plus two log priors. Fitting counts each document's words inside
its row, then aggregates the per-class counts by term (partial on the map
side); the table is written to the shared folder, which cuts the lineage and
keeps the model through executor loss. The vocabulary is a distributed table, so it may grow with the
data; nothing of it passes through the driver beyond a measured bound.

Scoring sums the words' log likelihoods. While the model's measured size is below the bound, it is also written as
a packed row (``operators.lookup``), and a document is scored inside its own row: no text and no word is
shuffled, nothing is written, and a streaming plan can hold it. Beyond the bound its most frequent terms are packed,
as many as fit, and weigh most words of a document inside its row; only the words left over meet the rest of the
model in a join, and their sums go back by a row number to the documents that hold such words.

Formulas (same as ``pyspark.ml.classification.NaiveBayes``, multinomial):
prior ``ln(n_c + a) - ln(n + K a)``, likelihood
``ln(count(c, t) + a) - ln(total_c + V a)``; unknown terms are ignored; the
prediction is the larger score, ties to class 0.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizer, SQLTransformer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonestream.operators.features import explode_terms, with_term_counts
from tonestream.operators.joins import BROADCAST_BYTES, sized_join
from tonestream.operators.lookup import ENTRY_BYTES, LOOKUP_BYTES, Lookup, bound, pack_lookup, with_lookup
from tonestream.session import shared_path
from tonestream.sinks.files import materialize

NUM_CLASSES = 2
#: A row number with its two sums in a broadcast relation.
SUM_BYTES = 64


def prob_positive(raw_0: Column, raw_1: Column) -> Column:
    """P(class 1) from two log scores, without overflow."""
    d = raw_0 - raw_1
    return F.when(d >= 0, F.exp(-d) / (F.lit(1.0) + F.exp(-d))).otherwise(F.lit(1.0) / (F.lit(1.0) + F.exp(d)))


@dataclass
class Head:
    """A model's most frequent terms, packed, and its other terms as a table."""

    lookup: Lookup
    n_bytes: int
    others: DataFrame


@dataclass
class NaiveBayesTable:
    terms: DataFrame  # term, ll_0, ll_1
    prior_0: float
    prior_1: float
    vocab_size: int
    path: str
    model_bytes: int

    lookup: Lookup | None = None
    head: Head | None = None  # of a model that is too large to be packed

    def in_row(self, max_broadcast_bytes: int = BROADCAST_BYTES) -> bool:
        """Whether documents are scored inside their rows, so also inside a streaming plan."""
        return self.lookup is not None and self.model_bytes <= max_broadcast_bytes

    def transform(self, df: DataFrame, words: Column | str, id_cols: list[str] | None = None,
                  max_broadcast_bytes: int = BROADCAST_BYTES, scratch: list[str] | None = None,
                  keep: list[str] | None = None) -> DataFrame:
        """Adds ``raw_0, raw_1, prediction (double), p_neg, p_pos`` to ``df``.

        A document's score needs only its own row, so ids may repeat or be null.
        ``id_cols`` only say which columns callers read. ``scratch`` is given the folders that the result
        is read from, for callers that remove them when they are done. ``keep`` are the columns of ``df`` that
        the result has, by default all; a joined model stores no others.
        """
        w = F.col(words) if isinstance(words, str) else words
        if self.in_row(max_broadcast_bytes):
            df = self._scored_in_row(df, w)
            df = df.select(*keep, "raw_0", "raw_1") if keep is not None else df
        elif df.isStreaming:
            raise ValueError("the model is too large to score inside a streaming plan; score its micro-batches")
        else:
            df = self._scored_by_join(df, w, max_broadcast_bytes, scratch, keep)
        return (
            df.withColumns({
                "prediction": F.when(F.col("raw_1") > F.col("raw_0"), F.lit(1.0)).otherwise(F.lit(0.0)),
                "p_pos": prob_positive(F.col("raw_0"), F.col("raw_1")),
            })
            .withColumn("p_neg", F.lit(1.0) - F.col("p_pos"))
        )

    def _scored_in_row(self, df: DataFrame, words: Column) -> DataFrame:
        def score(words: Column, find) -> Column:
            start = F.struct(F.lit(self.prior_0).alias("raw_0"), F.lit(self.prior_1).alias("raw_1"))
            add = lambda s, e: F.when(e.isNull(), s).otherwise(
                F.struct((s["raw_0"] + e["ll_0"]).alias("raw_0"), (s["raw_1"] + e["ll_1"]).alias("raw_1")))
            return F.aggregate(words, start, lambda s, w: bound(find(w), lambda e: add(s, e)))

        words = F.coalesce(words, F.array().cast("array<string>"))
        df = df.drop("raw_0", "raw_1")
        return with_lookup(df, self.lookup, "_raw", words, score).select(*df.columns, "_raw.raw_0", "_raw.raw_1")

    def _with_parts(self, df: DataFrame, words: Column, lookup: Lookup | None) -> DataFrame:
        """Add ``raw_0, raw_1`` of the priors and the words that ``lookup`` knows, and ``_rest``, the other words."""
        start = F.struct(F.lit(self.prior_0).alias("raw_0"), F.lit(self.prior_1).alias("raw_1"))

        def score(words: Column, find) -> Column:
            found = F.transform(words, lambda w: F.struct(w.alias("term"), find(w).alias("e")))
            add = lambda s, x: F.struct((s["raw_0"] + x["e"]["ll_0"]).alias("raw_0"), (s["raw_1"] + x["e"]["ll_1"]).alias("raw_1"))
            return bound(found, lambda found: F.struct(
                F.aggregate(F.filter(found, lambda x: x["e"].isNotNull()), start, add).alias("sums"),
                F.transform(F.filter(found, lambda x: x["e"].isNull() & x["term"].isNotNull()), lambda x: x["term"]).alias("rest")))

        given = [c for c in df.columns if c not in ("raw_0", "raw_1")]
        words = F.coalesce(words, F.array().cast("array<string>"))
        df = df.drop("raw_0", "raw_1")
        if lookup is None:
            df = df.withColumn("_part", F.struct(start.alias("sums"), F.filter(words, lambda w: w.isNotNull()).alias("rest")))
        else:
            df = with_lookup(df, lookup, "_part", words, score)
        return df.select(*given, "_part.sums.raw_0", "_part.sums.raw_1", F.col("_part.rest").alias("_rest"))

    def _scored_by_join(self, df: DataFrame, words: Column, max_broadcast_bytes: int, scratch: list[str] | None,
                        keep: list[str] | None) -> DataFrame:
        kept = [c for c in (df.columns if keep is None else keep) if c not in ("raw_0", "raw_1")]
        head = self.head if self.head is not None and self.head.n_bytes <= max_broadcast_bytes else None
        df = self._with_parts(df, words, head.lookup if head else None).select(*kept, "raw_0", "raw_1", "_rest")
        df = materialize(df.withColumn("_rid", F.monotonically_increasing_id()), "nb-input", scratch)
        open_ = F.size("_rest") > 0
        counted = with_term_counts(df.where(open_).select("_rid", "_rest"), F.col("_rest"))
        terms = explode_terms(counted, ["_rid"], F.col("term_counts")).select(
            "_rid", F.col("term.term").alias("term"), F.col("term.tf").alias("tf"))
        others, known = (head.others, self.model_bytes - head.n_bytes) if head else (self.terms, self.model_bytes)
        hits = sized_join(terms, others, "term", known_bytes=known, max_bytes=max_broadcast_bytes)
        sums = hits.groupBy("_rid").agg(F.sum(F.col("tf") * F.col("ll_0")).alias("_s0"),
                                        F.sum(F.col("tf") * F.col("ll_1")).alias("_s1"))
        # rows whose words are all weighed stay where they are
        rest = df.where(open_).drop("_rest")
        rest = sized_join(rest, sums, "_rid", "left", known_bytes=SUM_BYTES * rest.count(), max_bytes=max_broadcast_bytes)
        rest = rest.withColumns({"raw_0": F.col("raw_0") + F.coalesce(F.col("_s0"), F.lit(0.0)),
                                 "raw_1": F.col("raw_1") + F.coalesce(F.col("_s1"), F.lit(0.0))})
        return df.where(~open_).select(*kept, "raw_0", "raw_1").unionByName(rest.select(*kept, "raw_0", "raw_1"))


def head_of(counts: DataFrame, max_bytes: int) -> tuple[int, int, int] | None:
    """The least count of the most frequent terms that fit into ``max_bytes`` packed, their number and their bytes.

    Found on the histogram of counts. A term takes ``ENTRY_BYTES`` at least, which bounds the counts that are looked at.
    """
    sizes = counts.groupBy((F.col("c_0") + F.col("c_1")).alias("n")).agg(
        F.count(F.lit(1)).alias("v"), F.sum(F.octet_length("term") + F.lit(ENTRY_BYTES)).alias("bytes"))
    most = sizes.orderBy(F.desc("n")).limit(max(1, max_bytes // ENTRY_BYTES))
    running = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    cut = most.select("n", F.sum("v").over(running).alias("v"), F.sum("bytes").over(running).alias("bytes"))
    row = cut.where(F.col("bytes") <= max_bytes).agg(F.min("n").alias("n"), F.max("v").alias("v"), F.max("bytes").alias("bytes")).first()
    return None if row.n is None else (int(row.n), int(row.v), int(row.bytes))


def fit_naive_bayes_table(train: DataFrame, words: Column | str, label: str = "target",
                          smoothing: float = 1.0, path: str | None = None) -> NaiveBayesTable:
    """Fit the relational model on ``train`` (labels 0/1, one word array per row)."""
    spark = train.sparkSession
    w = F.col(words) if isinstance(words, str) else words
    y = F.col(label).cast("int")
    counted = with_term_counts(train.select(y.alias("_y"), w.alias("_w")), F.col("_w"))
    counts = (
        explode_terms(counted, [F.col("_y")], F.col("term_counts"))
        .select("_y", F.col("term.term").alias("term"), F.col("term.tf").alias("tf"))
        .groupBy("term")
        .agg(F.sum(F.when(F.col("_y") == 0, F.col("tf")).otherwise(F.lit(0))).alias("c_0"),
             F.sum(F.when(F.col("_y") == 1, F.col("tf")).otherwise(F.lit(0))).alias("c_1"))
    )
    path = path or shared_path(spark, "nb-model")
    counts.write.mode("overwrite").parquet(f"{path}/counts")
    counts = spark.read.parquet(f"{path}/counts")
    stats = counts.agg(F.count(F.lit(1)).alias("v"), F.sum("c_0").alias("t0"), F.sum("c_1").alias("t1"),
                       F.sum(F.octet_length("term")).alias("bytes")).first()
    docs = train.agg(F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1")).first()
    v, t0, t1 = int(stats.v), int(stats.t0 or 0), int(stats.t1 or 0)
    n0, n1 = int(docs.n0), int(docs.n1)
    a = float(smoothing)
    denom = math.log(n0 + n1 + NUM_CLASSES * a)
    weights = [
        F.col("term"),
        (F.log(F.col("c_0") + F.lit(a)) - F.lit(math.log(t0 + v * a))).alias("ll_0"),
        (F.log(F.col("c_1") + F.lit(a)) - F.lit(math.log(t1 + v * a))).alias("ll_1"),
    ]
    terms = counts.select(*weights)
    size = int(stats.bytes or 0) + ENTRY_BYTES * v
    lookup = head = None
    if size <= LOOKUP_BYTES:
        lookup = pack_lookup(terms, v, f"{path}/lookup")
    elif (cut := head_of(counts, LOOKUP_BYTES)) is not None:
        least, n_terms, n_bytes = cut
        frequent = F.col("c_0") + F.col("c_1") >= least
        head = Head(pack_lookup(counts.where(frequent).select(*weights), n_terms, f"{path}/head"), n_bytes,
                    counts.where(~frequent).select(*weights))
    return NaiveBayesTable(terms, math.log(n0 + a) - denom, math.log(n1 + a) - denom, v, path, size, lookup, head)


def naive_bayes_estimator(input_col: str = "clean_text", label: str = "target", smoothing: float = 1.0,
                         vocab_size: int = (1 << 31) - 1) -> Pipeline:
    """Spark ML form: words -> CountVectorizer -> NaiveBayes (multinomial).

    The whole vocabulary is kept, and Spark ML holds it on the driver; where it doesn't fit
    there, use the relational form.
    """
    return Pipeline(stages=[
        SQLTransformer(statement=(
            f"SELECT *, filter(split(coalesce({input_col}, ''), ' '), w -> w != '') AS nb_words FROM __THIS__"
        )),
        CountVectorizer(inputCol="nb_words", outputCol="nb_counts", vocabSize=vocab_size),
        NaiveBayes(featuresCol="nb_counts", labelCol=label, smoothing=smoothing, modelType="multinomial"),
    ])


def fit_naive_bayes_ml(train: DataFrame, input_col: str = "clean_text", label: str = "target",
                       smoothing: float = 1.0) -> PipelineModel:
    data = train.withColumn(label, F.col(label).cast("double"))
    return naive_bayes_estimator(input_col, label, smoothing).fit(data)
