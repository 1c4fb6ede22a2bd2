"""The penalised fit, its table of coefficients, stream progress and recovery, plans of the report."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonestream.functions import messages
from tonestream.operators import metrics, newton
from tonestream.operators.logistic import fit_logistic_table, penalised_gradient
from tonestream.operators.newton import fit_newton
from tonestream.operators.scoring import score_table
from tonestream.plans.queries import cleaned_labelled
from tonestream.session import shared_path
from tonestream.sources.tables import read_table, rule_prediction, labelled_texts
from tonestream.streaming import progress
from tonestream.streaming import scoring as stream
from tests.conftest import SF01
from tests.test_plans import plan

ROWS = "y double, j array<int>, x array<double>"


def sparse(n=300, dim=12, seed=2):
    r = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        j = sorted(r.choice(dim, r.integers(0, 6), replace=False).tolist())
        rows.append((float(r.random() < 0.8), j, [float(v) for v in r.normal(size=len(j))]))
    return rows


def plain_optimum(rows, dim, c):
    x, y = np.zeros((len(rows), dim + 1)), np.array([r[0] for r in rows])
    x[:, -1] = 1
    for k, (_, j, v) in enumerate(rows):
        x[k, j] = v
    w = np.zeros(dim + 1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ w))
        g = w + c * x.T @ (p - y)
        w -= np.linalg.solve(np.eye(dim + 1) + c * (x * (p * (1 - p))[:, None]).T @ x, g)
    return w


@pytest.mark.parametrize("c, parts, sample_rows", [(1.0, 1, 4096), (5.0, 7, 20), (0.01, 3, 1)])
def test_newton_finds_the_optimum(spark, c, parts, sample_rows):
    rows = sparse()
    fit = fit_newton(spark.createDataFrame(rows, ROWS).repartition(parts), 12, c, sample_rows=sample_rows)
    assert np.abs(np.append(fit.weights, fit.intercept) - plain_optimum(rows, 12, c)).max() < 1e-6
    assert fit.gradient <= 1e-8 * fit.gradient_at_zero and fit.rows == 300
    row = fit.certificate(spark).first()
    assert (row.passes, row.distance_bound) == (fit.passes, fit.gradient)


def test_newton_on_nothing_and_too_few_passes(spark):
    none = fit_newton(spark.createDataFrame([], ROWS), 4)
    assert none.rows == 0 and none.weights.tolist() == [0.0] * 4
    one = fit_newton(spark.createDataFrame([(1.0, [], [])], ROWS), 3)
    assert one.weights.tolist() == [0.0] * 3 and one.intercept == pytest.approx(1 / (1 + math.exp(one.intercept)))
    with pytest.raises(RuntimeError, match="not converged"):
        fit_newton(spark.createDataFrame(sparse(), ROWS), 12, max_passes=2)


@pytest.mark.parametrize("kind, c", [("vocab", 1.0), ("hashed", 1e-4)])
def test_logistic_table(spark, kind, c):
    data = cleaned_labelled(spark, SF01)
    train, test = data.where("is_train"), data.where("not is_train")
    model = fit_logistic_table(train, kind, c)
    assert model.fit.passes <= 25
    worst = penalised_gradient(train, model, c).agg(F.max(F.abs("gradient"))).first()[0]
    assert worst < 1e-5
    scored = score_table(test, model)
    assert set(scored.columns) == {*test.columns, "prediction", "pred", "sentiment", "p_neg", "p_pos"}
    coef = {r.feature: r.coef for r in model.coefficients.collect()}
    by_hand = {}
    for r in model.features.transform(test).select("doc_id", "features").collect():
        z = model.intercept + sum(x * coef[int(j)] for j, x in zip(r.features.indices, r.features.values, strict=True))
        by_hand[r.doc_id] = 1 / (1 + math.exp(-z))
    got = {r.doc_id: r.p_pos for r in scored.collect()}
    assert got.keys() == by_hand.keys() and all(abs(got[k] - by_hand[k]) < 1e-12 for k in got)
    p = plan(scored)
    assert "Exchange" not in p and "_lookup" not in p


def test_one_class_and_null_texts(spark):
    rows = [(1, "good film"), (1, "good good"), (None, "x"), (1, None), (0, "bad film")]
    model = fit_logistic_table(spark.createDataFrame(rows, "target int, clean_text string"), min_df=1)
    assert model.fit.rows == 3
    got = score_table(spark.createDataFrame([("good",), ("bad",), (None,), ("",)], "clean_text string"), model).collect()
    assert got[0].p_pos > got[2].p_pos == got[3].p_pos > got[1].p_pos


def test_report_needs_two_exchanges(spark):
    p = plan(metrics.class_report(rule_prediction(labelled_texts(spark, SF01)).select("target", "prediction").persist()))
    assert p.split("InMemoryTableScan")[0].count("Exchange") == 2
    assert "Exchange" not in plan(metrics.confusion_matrix(spark.createDataFrame([(0, 1.0)], "target int, prediction double")))


def served(spark, tmp, value, per_batch=2):
    conv = read_table(spark, SF01, "conversations", ["conv_id", "turn", "role", "text"])
    src = shared_path(spark, tmp)
    stream.write_message_files(conv.repartition(6), src, key_cols=("conv_id", "turn"), value=value)
    live = stream.decoded_stream(stream.message_stream(spark, src, "conv_id bigint, turn bigint, value binary", max_files_per_trigger=per_batch))
    return conv, stream.by_status(live.select("conv_id", "turn", "text", "is_valid"), ["text"])


def test_counts_of_batches_and_a_drained_stop(spark):
    value = F.when(F.col("turn") % 4 == 1, F.lit("{")).otherwise(messages.encode_message("text"))
    conv, live = served(spark, "watched", value)
    counts = progress.BatchCounts("watched-query")
    spark.streams.addListener(counts)
    try:
        out = shared_path(spark, "watched-out")
        query = stream.start_by_status(progress.observed(live), out, shared_path(spark, "watched-ckpt"), available_now=False, name="watched-query")
        progress.stop_drained(query, counts)
    finally:
        spark.streams.removeListener(counts)
    n, bad = conv.count(), conv.where("turn % 4 = 1").count()
    assert counts.totals == {"batches": 3, "input": n, "output": n, "scored": n - bad, "quarantine": bad}
    frame = counts.frame(spark).collect()
    assert [r.batch_id for r in frame] == [0, 1, 2] and sum(r.quarantine for r in frame) == bad
    assert spark.read.parquet(out).count() == n and not query.isActive


def test_a_lost_commit_is_run_again_once(spark):
    conv, live = served(spark, "lost", messages.encode_message("text"))
    out, ckpt = shared_path(spark, "lost-out"), shared_path(spark, "lost-ckpt")
    seen = []

    def keep(batch):
        seen.append(batch.count())
        return batch.select("conv_id", "turn")

    stream.run_until_done(stream.start_foreach_batch(live, keep, out, ckpt))
    first = list(seen)
    assert progress.forget_last_commit(spark, ckpt) == len(first) - 1
    stream.run_until_done(stream.start_foreach_batch(live, keep, out, ckpt))
    assert seen == [*first, first[-1]]
    got = spark.read.parquet(out).select("conv_id", "turn")
    assert got.count() == got.distinct().count() == conv.count()


def test_newton_on_few_rows_that_are_far_longer(spark):
    r, rows = np.random.default_rng(5), []
    for k in range(1200):  # one row in twenty is up to a hundred times as long, and labels say nothing
        j = np.sort(r.choice(600, 60, replace=False))
        x = r.exponential(1.0, 60) * (100 * r.random() if k % 20 == 0 else 1)
        rows.append((float(r.integers(2)), j.tolist(), x.tolist()))
    fit = fit_newton(spark.createDataFrame(rows, ROWS).coalesce(2), 600, 0.01, sample_rows=200, max_passes=60)
    x, y = np.zeros((len(rows), 601)), np.array([row[0] for row in rows])
    x[:, -1] = 1
    for i, (_, j, v) in enumerate(rows):
        x[i, j] = v
    gradient = lambda w: w + 0.01 * x.T @ (0.5 * (1 + np.tanh(x @ w / 2)) - y)
    assert np.linalg.norm(gradient(np.append(fit.weights, fit.intercept))) <= 1e-7 * np.linalg.norm(gradient(np.zeros(601)))


def test_newton_where_the_long_rows_are_decided_first(spark):
    """Lengths spread widely and labels follow the features, so the rows that matter change with the weights (over 100 passes with the longest rows alone)."""
    r = np.random.default_rng(7)
    truth, rows = r.normal(size=600), []
    for _ in range(3000):
        j = np.sort(r.choice(600, 40, replace=False))
        x = r.exponential(1.0, 40) * np.exp(1.5 * r.normal())
        rows.append((float(x @ truth[j] + 0.5 * np.linalg.norm(x) * r.normal() > 0), j.tolist(), x.tolist()))
    fit = fit_newton(spark.createDataFrame(rows, ROWS).coalesce(2), 600, 1.0, sample_rows=1000, max_passes=80)
    assert fit.passes < 80 and fit.gradient <= 1e-8 * fit.gradient_at_zero
    assert np.abs(np.append(fit.weights, fit.intercept) - damped_optimum(rows, 600, 1.0)).max() < 1e-5


def damped_optimum(rows, dim, c):
    x, y = np.zeros((len(rows), dim + 1)), np.array([r[0] for r in rows])
    x[:, -1] = 1
    for k, (_, j, v) in enumerate(rows):
        x[k, j] = v
    loss = lambda w: w @ w / 2 + c * (np.logaddexp(0, x @ w) - y * (x @ w)).sum()
    w = np.zeros(dim + 1)
    for _ in range(60):
        p = 0.5 * (1 + np.tanh(x @ w / 2))
        g = w + c * x.T @ (p - y)
        step, t = np.linalg.solve(np.eye(dim + 1) + c * (x * (p * (1 - p))[:, None]).T @ x, -g), 1.0
        while loss(w + t * step) > loss(w) + 1e-4 * t * (g @ step) + 1e-10 * loss(w) and t > 1e-6:
            t /= 2
        w = w + t * step
    return w


def test_drawn_rows_keep_their_bounds_and_stand_for_all():
    r = np.random.default_rng(1)
    pull = np.concatenate([np.exp(3 * r.normal(size=5000)), np.zeros(10)])
    at = np.clip(np.floor(2 * np.log2(np.maximum(pull, 2.0 ** -96))) + 192, 0, newton.BINS - 1).astype(int)
    bins = np.concatenate([np.bincount(at, v, minlength=newton.BINS) for v in (pull, np.ones_like(pull), np.full(len(pull), 50))])
    few = np.minimum(1, newton._chance(bins, 500, 1 << 40) * pull)
    assert few.sum() == pytest.approx(500, rel=0.05) and few[np.argmax(pull)] == 1
    assert np.minimum(1, newton._chance(bins, 500, 5000) * pull).sum() == pytest.approx(100, rel=0.05)
    every = np.minimum(1, newton._chance(bins, 1 << 20, 1 << 40) * pull)
    assert (every[pull > 0] == 1).all() and (every[pull == 0] == 0).all()
    assert newton._chance(np.zeros(3 * newton.BINS), 500, 5000) == 0
