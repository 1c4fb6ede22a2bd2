"""Classification metrics and summaries as single aggregations.

Everything derives from one pass that counts the (label, prediction) pairs -
partial aggregation per task, then a handful of rows - for whatever classes the
data holds; the report rows come from those counts, with no collect and no second scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REPORT_CLASSES = ("0", "1", "accuracy", "macro avg", "weighted avg")


def confusion_cells(df: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """``label, prediction, n`` (doubles and a bigint) of every pair that occurs; rows without a label or a prediction don't count."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return df.select(y.alias("label"), p.alias("prediction")).dropna().groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def _ratio(num: Column, den: Column) -> Column:
    """num / den as double, 0.0 on a zero denominator."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def _ratio_d(num: Column, den: Column) -> Column:
    """num (already double) / den, 0.0 on a zero denominator."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den.cast("double"))


def _f1(p: Column, r: Column) -> Column:
    return F.when((p + r) == 0, F.lit(0.0)).otherwise(F.lit(2.0) * p * r / (p + r))


def accuracy(df: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """One row ``n, correct, accuracy``; accuracy is 0.0 on empty input."""
    y = F.col(label).cast("double")
    p = F.col(prediction).cast("double")
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(p == y).alias("correct")).select(
        "n", "correct", _ratio(F.col("correct"), F.col("n")).alias("accuracy")
    )


def _class_name(c: Column) -> Column:
    return F.when(c == F.floor(c), c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def class_report(df: DataFrame, label: str = "target", prediction: str = "prediction") -> DataFrame:
    """The report of ``report_from_cells`` from one aggregation by class: every row counts once as a label and once as a prediction."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    return _report(df.select(y.alias("label"), p.alias("prediction")).dropna(), F.lit(1).cast("bigint"))


def report_from_cells(cells: DataFrame) -> DataFrame:
    """Long report ``class, precision, recall, f1, support``.

    A row for each class that occurs as label or prediction, in order, then
    ``accuracy`` (f1 column holds the accuracy, support the total, as in the text
    form of the report), ``macro avg`` and ``weighted avg``. An undefined ratio is 0.
    """
    return _report(cells, F.col("n"))


def _report(cells: DataFrame, n: Column) -> DataFrame:
    zero, hit = F.lit(0).cast("bigint"), F.col("label") == F.col("prediction")
    sides = cells.select(F.inline(F.array(
        F.struct(F.col("label").alias("c"), n.alias("s"), zero.alias("m"), zero.alias("t")),
        F.struct(F.col("prediction").alias("c"), zero.alias("s"), n.alias("m"), F.when(hit, n).otherwise(zero).alias("t")))))
    per = sides.groupBy("c").agg(*[F.sum(x).alias(x) for x in ("s", "m", "t")])
    per = per.select("c", "s", "t", _ratio(F.col("t"), F.col("m")).alias("p"), _ratio(F.col("t"), F.col("s")).alias("r"))
    per = per.withColumn("f", _f1(F.col("p"), F.col("r")))
    # one row per class: the averages add up in class order, so reruns agree to the last bit
    whole = per.agg(F.sort_array(F.collect_list(F.struct("c", "p", "r", "f", "s", "t"))).alias("k"))
    total = lambda of: F.aggregate("k", F.lit(0).cast("bigint"), lambda a, x: a + x[of])
    whole = whole.select("k", total("s").alias("n"), total("t").alias("ok"), F.size("k").alias("classes"))

    def row(name: Column, p: Column, r: Column, f: Column, s: Column) -> Column:
        return F.struct(name.alias("class"), p.cast("double").alias("precision"), r.cast("double").alias("recall"),
                        f.cast("double").alias("f1"), s.cast("bigint").alias("support"))

    def average(of: str, weighted: bool) -> Column:
        summed = F.aggregate("k", F.lit(0.0), lambda a, x: a + (x[of] * x["s"] if weighted else x[of]))
        return _ratio_d(summed, F.col("n") if weighted else F.col("classes"))

    classes = F.transform("k", lambda x: row(_class_name(x["c"]), x["p"], x["r"], x["f"], x["s"]))
    rows = F.concat(classes, F.array(
        row(F.lit("accuracy"), F.lit(None), F.lit(None), _ratio(F.col("ok"), F.col("n")), F.col("n")),
        *[row(F.lit(name), *[average(of, weighted) for of in "prf"], F.col("n"))
          for name, weighted in (("macro avg", False), ("weighted avg", True))]))
    return whole.select(F.inline(rows))


def confusion_matrix(df: DataFrame, label: str = "target", prediction: str = "prediction",
                     labels: list[int] | None = None) -> DataFrame:
    """Matrix of truth by prediction: ``target`` and a count column ``pred_X`` for each class.

    ``labels`` are the classes (whole numbers), by default all that occur. With ``labels`` given,
    pairs of other classes are an error, not left out.
    """
    cells = {(r["label"], r["prediction"]): r["n"] for r in confusion_cells(df, label, prediction).collect()}  # a few pairs
    found = sorted({v for pair in cells for v in pair})
    names = found if labels is None else [float(x) for x in labels]
    if set(found) - set(names):
        raise ValueError(f"classes outside of the given ones: {sorted(set(found) - set(names))}")
    whole = all(c == int(c) for c in names)
    schema = ", ".join(["target " + ("int" if whole else "double"), *[f"`pred_{int(c) if c == int(c) else c}` bigint" for c in names]])
    rows = [(int(y) if whole else y, *[cells.get((y, p), 0) for p in names]) for y in names]
    return df.sparkSession.createDataFrame(rows, schema)


def sentiment_distribution(df: DataFrame, col: str = "sentiment") -> DataFrame:
    """``sentiment, n, pct``: counts per label (nulls skipped), share in percent
    with one decimal (half-up on the exact ratio), by count descending.

    The share window runs over the grouped rows only (one per label value).
    """
    grouped = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    pct = F.expr("(2000 * n + total) div (2 * total)")
    return (
        grouped.withColumn("total", total)
        .select(col, "n", (pct / 10.0).alias("pct"))
        .orderBy(F.desc("n"), F.col(col))
    )


def row_counts(df: DataFrame, kept: Column) -> DataFrame:
    """One pass: ``rows_before`` and ``rows_after`` (rows where ``kept`` is true)."""
    return df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(F.coalesce(kept, F.lit(False))).alias("rows_after"))
