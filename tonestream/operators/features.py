"""Text features: long-form term tables (SQL-checkable) and Spark ML stages.

Long form: ``(doc_id, term, tf)`` rows counted over batches of documents (no
shuffle, see ``operators.term_counts``); document frequency and IDF are one aggregation keyed by term, partial
on the map side, so a very common term costs one row per task before the
shuffle. The term statistics are written and then joined back to documents with a
plain equi-join, which AQE turns into a broadcast when the table is measured small and
splits when one term is hot; the top-k vocabulary, bounded by k, is packed and looked up inside the row.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizer,
    ElementwiseProduct,
    HashingTF,
    Normalizer,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
    Tokenizer,
)
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonestream.functions.clean import STOP_WORDS
from tonestream.operators.evaluation import with_column_once
from tonestream.operators.lookup import Lookup, bound, pack_lookup, with_lookup
from tonestream.operators.term_counts import lists_of_batches, rows_of_batches, stats_of_batches
from tonestream.session import shared_path
from tonestream.sinks.files import materialize


def split_words(c: Column | str) -> Column:
    """Words of a single-spaced cleaned text (no empty tokens)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.filter(F.split(col, " "), lambda w: w != F.lit(""))


def with_bigrams(words: Column) -> Column:
    """Unigrams followed by space-joined bigrams of a word array."""
    n = F.size(words)
    firsts = F.slice(words, 1, F.greatest(n - 1, F.lit(0)))
    seconds = F.slice(words, 2, F.greatest(n - 1, F.lit(0)))
    bigrams = F.zip_with(firsts, seconds, lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(words, bigrams)


def explode_terms(df: DataFrame, cols: list, terms: Column) -> DataFrame:
    """One row per array element, as ``term``, next to ``cols``.

    ``explode_outer`` plus a null filter rather than ``explode``: for a plain
    explode Catalyst infers a ``size(array) > 0`` filter and pushes a copy of
    the whole array expression (here: the regex cleaning) down to the scan, so
    it would run twice, the first time before any repartition.
    """
    return df.select(*cols, F.explode_outer(terms).alias("term")).where(F.col("term").isNotNull())


def with_term_counts(df: DataFrame, terms: Column, out: str = "term_counts") -> DataFrame:
    """Add ``out``: the distinct terms of each row with their counts,
    ``array<struct<term string, tf bigint>>`` in term order, computed inside the
    row (no shuffle).

    The row's terms are sorted once; a run of equal terms starts where an
    element differs from its predecessor, and a term's count is the distance to
    the next run start. The sorted array and the run starts are each evaluated
    once (``with_column_once``); the counting is O(n) array work per row.
    """
    d = with_column_once(df, "_s", F.sort_array(terms))
    s, n = F.col("_s"), F.size(F.col("_s"))
    starts = F.when(n > 0, F.filter(F.sequence(F.lit(0), n - 1),
                                    lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1))))
    d = with_column_once(d, "_st", F.coalesce(starts, F.array().cast("array<int>")))
    st = F.col("_st")
    counts = F.transform(st, lambda p, k: F.struct(F.get(s, p).alias("term"),
                                                  (F.coalesce(F.get(st, k + 1), n) - p).cast("bigint").alias("tf")))
    return d.withColumn(out, counts).drop("_s", "_st")


def doc_terms(df: DataFrame, id_col: str, terms: Column, bigrams: bool = False) -> DataFrame:
    """``(id, term, tf)``: one row per distinct term of each row (document), with ``bigrams`` also per
    distinct pair of neighbours; counted batch by batch, so building it needs no shuffle."""
    d = df.select(F.col(id_col), terms.alias("_terms"))
    kind = d.schema[id_col].dataType.simpleString()
    return d.mapInArrow(rows_of_batches(bigrams, id_col), f"`{id_col}` {kind}, term string, tf long")


def term_stats(terms: DataFrame) -> DataFrame:
    """``(term, df, cf)``: documents holding the term and its total count."""
    return terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def term_stats_of(df: DataFrame, terms: Column, bigrams: bool = False) -> DataFrame:
    """``(term, df, cf)`` straight from each row's term array, with ``bigrams`` also of its pairs of neighbours:
    counted batch by batch (no shuffle), then one aggregation by term, partial on the map side."""
    counted = df.select(terms.alias("_terms")).mapInArrow(stats_of_batches(bigrams), "term string, df long, cf long")
    return counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))


def top_terms(stats: DataFrame, k: int = 20000, min_df: int = 2) -> DataFrame:
    """Vocabulary cut: ``df >= min_df``, then the ``k`` most frequent terms,
    ties broken by term.

    A plain ordered limit keeps k rows per partition and merges all of them in
    one task (k x partitions rows). Here the ``cf`` of the k-th term is found
    first, on the histogram of ``cf`` values: its top ``k`` values (at most k
    rows) and a running count over them give the threshold as a scalar subquery.
    Only terms at or above it - k plus the ties at the threshold - reach the
    final ordered limit.
    """
    eligible = stats.where(F.col("df") >= min_df)
    hist = eligible.groupBy("cf").agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("cf")).limit(k)
    running = F.sum("_n").over(Window.orderBy(F.desc("cf")).rowsBetween(Window.unboundedPreceding, 0))
    threshold = hist.select("cf", running.alias("_cum")).where(F.col("_cum") >= k).agg(F.max("cf")).scalar()
    candidates = eligible.where(F.col("cf") >= F.coalesce(threshold, F.lit(0)))
    return candidates.orderBy(F.desc("cf"), F.asc("term")).limit(k)


def spark_idf(stats: DataFrame, n_docs: Column) -> DataFrame:
    """``idf = ln((m + 1) / (df + 1))`` (Spark ML's formula)."""
    return stats.withColumn("idf", F.log((n_docs + F.lit(1.0)) / (F.col("df") + F.lit(1.0))))


def tfidf_spark(terms: DataFrame, id_col: str, n_docs: Column) -> DataFrame:
    """``(id, term, tf, idf, w = tf * idf)`` with Spark's IDF.

    The term statistics are written before the join: a join straight on top of an
    aggregation by the same key has no exchange on that side, and AQE then can't split the rows of a hot term.
    """
    idf = materialize(spark_idf(term_stats(terms), n_docs).select("term", "df", "idf"), "idf")
    return terms.join(idf, "term").select(id_col, "term", "tf", "df", "idf", (F.col("tf") * F.col("idf")).alias("w"))


def fit_vocabulary(stats: DataFrame, n_docs: int, k: int = 20000, min_df: int = 2, path: str | None = None) -> Lookup:
    """The ``k`` most frequent terms with ``idf1 = ln((1 + n) / (1 + df)) + 1``, written packed for look-ups inside the row.

    The vocabulary is bounded by ``k``, so it may go through the driver.
    """
    vocab = spark_idf(top_terms(stats, k, min_df), F.lit(float(n_docs)))
    vocab = materialize(vocab.select("term", (F.col("idf") + F.lit(1.0)).alias("idf1")), "vocabulary")
    return pack_lookup(vocab, vocab.count(), path or shared_path(stats.sparkSession, "vocabulary-packed"))


def with_tfidf_sklearn(df: DataFrame, counts: str, vocab: Lookup, out: str = "weights") -> DataFrame:
    """Add ``out``: ``array<struct<term, tf, w>>`` of a document's vocabulary terms, ``w = tf * idf1`` divided by the
    L2 norm of all of them, from the column ``counts`` of its distinct terms. Weighed and normalised inside the row: no shuffle, nothing written."""
    def weigh(counts: Column, find) -> Column:
        raw = F.sort_array(F.filter(F.transform(counts, lambda c: bound(find(c["term"]), lambda e: F.when(
            e.isNotNull(), F.struct(c["term"].alias("term"), c["tf"].alias("tf"), (c["tf"] * e["idf1"]).alias("w"))))), lambda r: r.isNotNull()))

        def normalised(raw: Column) -> Column:
            norm = F.sqrt(F.aggregate(raw, F.lit(0.0), lambda s, r: s + r["w"] * r["w"]))
            return bound(norm, lambda n: F.transform(raw, lambda r: F.struct(r["term"].alias("term"), r["tf"].alias("tf"), (r["w"] / n).alias("w"))))

        return bound(raw, normalised)

    return with_lookup(df, vocab, out, F.col(counts), weigh)


def tfidf_sklearn(df: DataFrame, id_col: str, terms: Column, vocab: Lookup, bigrams: bool = False) -> DataFrame:
    """``(id, term, tf, w)``: one row for each vocabulary term of each document (with ``bigrams`` also of its pairs of
    neighbours), see ``with_tfidf_sklearn``. Terms are counted batch by batch, without a shuffle."""
    d = df.select(F.col(id_col), terms.alias("_terms"))
    kind = d.schema[id_col].dataType.simpleString()
    d = d.mapInArrow(lists_of_batches(bigrams, id_col), f"`{id_col}` {kind}, _counts array<struct<term: string, tf: bigint>>")
    d = with_tfidf_sklearn(d, "_counts", vocab)
    return explode_terms(d, [F.col(id_col)], F.col("weights")).select(id_col, "term.term", "term.tf", "term.w")


def stored_vectors(df: DataFrame, vector_cols: list[str], name: str = "vectors") -> DataFrame:
    """Write ``df`` to the shared folder and read it back with each ML vector
    column as its storage struct ``(type, size, indices, values)``
    (``VectorUDT().sqlType()``).

    Per-row statistics then run on the stored (sparse) arrays instead of a
    dense ``vector_to_array`` copy of every dimension, which for hashed features
    is ``numFeatures`` doubles per row.
    """
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import StructField, StructType

    stored = materialize(df, name)
    schema = StructType([
        StructField(f.name, VectorUDT().sqlType(), f.nullable) if f.name in vector_cols else f
        for f in stored.schema.fields
    ])
    return df.sparkSession.read.schema(schema).parquet(*stored.inputFiles())


def vector_nnz(v: Column) -> Column:
    """Non-zero entries of a stored vector struct (dense or sparse)."""
    return F.size(F.filter(v["values"], lambda x: x != 0))


def vector_sum(v: Column) -> Column:
    """Sum of the entries of a stored vector struct."""
    return F.aggregate(v["values"], F.lit(0.0), lambda acc, x: acc + x)


# --- Spark ML stages ---------------------------------------------------------


def hashed_tfidf_stages(input_col: str = "clean_text", num_features: int = 10000,
                        stop_words: list[str] | None = None) -> list:
    """Tokenizer -> StopWordsRemover -> HashingTF -> IDF (``features``)."""
    return [
        Tokenizer(inputCol=input_col, outputCol="words"),
        StopWordsRemover(inputCol="words", outputCol="filtered", stopWords=list(stop_words or STOP_WORDS)),
        HashingTF(inputCol="filtered", outputCol="rawFeatures", numFeatures=num_features),
        IDF(inputCol="rawFeatures", outputCol="features"),
    ]


def ngram_stages(input_col: str = "clean_text") -> list:
    """Tokens of two or more word characters (lower-cased), then the tokens
    followed by their space-joined bigrams as ``grams``."""
    return [
        RegexTokenizer(inputCol=input_col, outputCol="tokens", pattern=r"(?U)\b\w\w+\b", gaps=False,
                       toLowercase=True),
        SQLTransformer(statement=(
            "SELECT *, concat(tokens, zip_with(slice(tokens, 1, greatest(size(tokens) - 1, 0)), "
            "slice(tokens, 2, greatest(size(tokens) - 1, 0)), (a, b) -> concat_ws(' ', a, b))) AS grams "
            "FROM __THIS__"
        )),
    ]


def ngram_count_stages(input_col: str = "clean_text", vocab_size: int = 20000, min_df: int = 2) -> list:
    """``ngram_stages`` plus Spark's own ``CountVectorizer`` estimator (its ties
    at the vocabulary cut are left open; ``fit_sklearn_tfidf`` breaks them by term)."""
    return [*ngram_stages(input_col),
            CountVectorizer(inputCol="grams", outputCol="tf", vocabSize=vocab_size, minDF=float(min_df))]


def fit_sklearn_tfidf(train: DataFrame, input_col: str = "clean_text", vocab_size: int = 20000,
                      min_df: int = 2) -> PipelineModel:
    """Vocabulary TF-IDF with the ``+1`` IDF and L2 norm (``features``).

    One aggregation fits everything: the 1-2-gram statistics of the training
    texts (counts by batch, one shuffle by term) give the vocabulary - the
    ``vocab_size`` most frequent terms with ``df >= min_df``, ties broken by
    term - and each term's document frequency. At most ``vocab_size`` rows
    reach the driver, to build a ``CountVectorizerModel`` and the fixed
    ``ElementwiseProduct`` of IDF weights plus one; ``Normalizer(p=2)`` follows.
    """
    import math

    from pyspark.ml.feature import CountVectorizerModel

    count_stages = ngram_stages(input_col)
    grams = PipelineModel(stages=count_stages).transform(train)
    n_docs = train.count()
    vocab = top_terms(term_stats_of(grams, F.col("tokens"), bigrams=True), vocab_size, min_df).collect()
    terms = [r.term for r in vocab]
    weights = DenseVector([math.log((n_docs + 1.0) / (r.df + 1.0)) + 1.0 for r in vocab])
    return PipelineModel(stages=[
        *count_stages,
        CountVectorizerModel.from_vocabulary(terms, inputCol="grams", outputCol="tf"),
        ElementwiseProduct(inputCol="tf", outputCol="tfidf", scalingVec=weights),
        Normalizer(inputCol="tfidf", outputCol="features", p=2.0),
    ])
