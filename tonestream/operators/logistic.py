"""Logistic regression on hashed or vocabulary features: Spark ML pipelines, and a model whose coefficients are a table.

``train_logistic`` fits with Spark ML. ``fit_logistic_table`` fits the L2-penalised optimum (intercept
penalised too) with few passes and a certificate, see ``operators.newton``; its coefficients are a
table ``(feature, coef)``, packed for look-ups, so scoring is a projection.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonestream.operators.features import fit_sklearn_tfidf, hashed_tfidf_stages
from tonestream.operators.lookup import Lookup, bound, pack_lookup, with_lookup
from tonestream.operators.newton import TOLERANCE, Fit, fit_newton
from tonestream.operators.partitioning import fit_partitions
from tonestream.session import shared_path
from tonestream.sinks.files import materialize


def _prepared(df: DataFrame, input_col: str, label: str) -> DataFrame:
    """Training rows: null text and null labels dropped, label as double."""
    return df.where(F.col(input_col).isNotNull() & F.col(label).isNotNull()).withColumn(
        label, F.col(label).cast("double")
    )


def _fit_lr(featurized: DataFrame, lr: LogisticRegression, text_col: str):
    """Fit LR on featurized rows cached once (computed at full parallelism) and
    read by every optimizer step through ``fit_partitions``. Gradients are summed over a tree that
    gets deeper with their width, so no task merges many wide ones."""
    cached = featurized.persist()
    try:
        # fills the cache at the input's parallelism; about 12 bytes for each word of the text
        n_bytes = cached.agg(F.sum(F.octet_length(text_col)).alias("b")).first()["b"] or 0
        return lr.setAggregationDepth(3).fit(fit_partitions(cached, 2 * n_bytes))
    finally:
        cached.unpersist()


def train_logistic(df: DataFrame, features: str = "hashed", input_col: str = "clean_text", label: str = "target",
                   num_features: int = 10000, max_iter: int | None = None, vocab_size: int = 20000,
                   min_df: int = 2, label_indexer: bool = False) -> PipelineModel:
    """Fit TF-IDF + logistic regression.

    ``hashed``: Tokenizer, StopWordsRemover, HashingTF(num_features), IDF, LR
    (unregularized, ``max_iter`` default 50).
    ``vocab``: 1-2-gram vocabulary TF-IDF with ``+1`` IDF and L2 norm, LR with an
    L2 penalty equal to C=1 on the summed loss (``regParam = 1/n``), no
    standardization, ``max_iter`` default 200.
    ``label_indexer``: index the label with StringIndexer (value order, so
    index 0 is label 0) and train on the index.

    Feature stages are fitted on the input as partitioned; only the featurized
    rows that the optimizer reads once per step are cached and sized by their bytes.
    """
    data = _prepared(df, input_col, label).persist()
    try:
        n = data.count()
        label_col = label
        pre = []
        if label_indexer:
            pre = [StringIndexer(inputCol=label, outputCol="label_idx", stringOrderType="alphabetAsc")]
            label_col = "label_idx"
        if features == "hashed":
            feats = Pipeline(stages=[*pre, *hashed_tfidf_stages(input_col, num_features)]).fit(data)
            lr = LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=max_iter or 50)
        elif features == "vocab":
            stages = [*([Pipeline(stages=pre).fit(data)] if pre else []), fit_sklearn_tfidf(data, input_col, vocab_size, min_df)]
            feats = PipelineModel(stages=stages)
            lr = LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=max_iter or 200,
                                    regParam=1.0 / max(n, 1), elasticNetParam=0.0, standardization=False)
        else:
            raise ValueError(f"unknown features {features!r}")
        model = _fit_lr(feats.transform(data), lr, input_col)
        return PipelineModel(stages=[*feats.stages, model])
    finally:
        data.unpersist()


def vector_entries(vector: str) -> Column:
    """A vector column's stored entries: ``array<struct<j int, x double>>``."""
    v = F.unwrap_udt(F.col(vector))
    return bound(v, lambda v: F.zip_with(F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1)), v["values"],
                                         lambda j, x: F.struct(j.alias("j"), x.alias("x"))))


@dataclass
class LogisticTable:
    """A fitted model: feature stages, ``coefficients (feature int, coef double)`` and an intercept."""

    features: PipelineModel
    coefficients: DataFrame
    intercept: float
    fit: Fit
    packed: Lookup

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds the features, ``prediction, p_pos, p_neg``; the score is found inside the row."""
        def score(entries: Column, find) -> Column:
            return F.aggregate(entries, F.lit(self.intercept), lambda z, e: z + e["x"] * F.coalesce(find(e["j"])["coef"], F.lit(0.0)))

        scored = with_lookup(self.features.transform(df), self.packed, "_z", vector_entries("features"), score)
        z = F.col("_z")
        return scored.withColumns({
            "prediction": (z > 0).cast("double"),
            "p_pos": F.lit(1.0) / (F.lit(1.0) + F.exp(-z)),
        }).withColumn("p_neg", F.lit(1.0) - F.col("p_pos")).drop("_z")


def fit_logistic_table(df: DataFrame, features: str = "vocab", c: float = 1.0, input_col: str = "clean_text", label: str = "target",
                       num_features: int = 10000, vocab_size: int = 20000, min_df: int = 2, tolerance: float = TOLERANCE) -> LogisticTable:
    """Fit TF-IDF (``vocab``: 1-2-gram vocabulary, L2 norm; ``hashed``) and the penalised logistic model on it.

    The loss is ``|w|^2 / 2 + c * sum of log losses`` with the intercept as one of the weights. The number of
    coefficients is bounded by the vocabulary or the hash space, so they may pass through the driver.
    """
    data = _prepared(df, input_col, label)
    if features == "hashed":
        feats, dim = Pipeline(stages=hashed_tfidf_stages(input_col, num_features)).fit(data), num_features
    elif features == "vocab":
        feats = fit_sklearn_tfidf(data, input_col, vocab_size, min_df)
        dim = len(feats.stages[2].vocabulary)
    else:
        raise ValueError(f"unknown features {features!r}")
    entries = feats.transform(data).select(F.col(label).alias("y"), vector_entries("features").alias("e"))
    fit = fit_newton(entries.select("y", F.col("e.j").alias("j"), F.col("e.x").alias("x")), dim, c, tolerance)
    table = df.sparkSession.createDataFrame(list(enumerate(fit.weights.tolist())), "feature int, coef double")
    coefficients = materialize(table, "coefficients")
    packed = pack_lookup(coefficients.select(F.col("feature").alias("term"), "coef"), dim, shared_path(df.sparkSession, "coefficients-packed"))
    return LogisticTable(feats, coefficients, fit.intercept, fit, packed)


def penalised_gradient(df: DataFrame, model: LogisticTable, c: float = 1.0, input_col: str = "clean_text", label: str = "target") -> DataFrame:
    """``feature, gradient`` of the penalised loss at the model's coefficients, by joins and sums (-1 is the intercept).

    It shares nothing with the fit but the features, so it checks the fit.
    """
    data = _prepared(df, input_col, label)
    rows = model.features.transform(data).select(F.monotonically_increasing_id().alias("row"), F.col(label).alias("y"), vector_entries("features").alias("e"))
    rows = materialize(rows, "entries")
    at = rows.select("row", "y", F.explode_outer("e").alias("e")).select("row", "y", F.col("e.j").alias("feature"), F.col("e.x").alias("x"))
    z = at.join(model.coefficients, "feature", "left").groupBy("row", "y").agg(
        (F.lit(model.intercept) + F.sum(F.coalesce(F.col("x") * F.col("coef"), F.lit(0.0)))).alias("z"))
    miss = materialize(z.select("row", (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("z"))) - F.col("y")).alias("miss")), "misses")
    sums = at.where("feature IS NOT NULL").join(miss, "row").groupBy("feature").agg(F.sum(F.col("x") * F.col("miss")).alias("s"))
    weights = model.coefficients.join(sums, "feature", "left").select("feature", (F.col("coef") + c * F.coalesce("s", F.lit(0.0))).alias("gradient"))
    return weights.unionAll(miss.agg(F.lit(-1).alias("feature"), (F.lit(model.intercept) + c * F.sum("miss")).alias("gradient")))
