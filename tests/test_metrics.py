"""Golden arithmetic: the published report must follow from its confusion matrix."""

import json

import pytest

from tonestream.operators import metrics
from tonestream.session import shared_path
from tonestream.sinks.files import write_metrics_json
from tonestream.sources.metrics_json import read_metrics_json

# The published report and the confusion matrix derived from it
# (recall x support): TN, FP, FN, TP.
GOLDEN_COUNTS = (121273, 37764, 31077, 127763)
GOLDEN = {
    "0": (0.7960157531998687, 0.7625458226701962, 0.7789214064813239, 159037),
    "1": (0.7718559509928894, 0.8043502895995971, 0.7877681761708188, 158840),
    "macro avg": (0.7839358520963791, 0.7834480561348967, 0.7833447913260714, 317877),
    "weighted avg": (0.7839433384527917, 0.7834351022565332, 0.783342049992743, 317877),
}
GOLDEN_ACCURACY = 0.7834351022565332


def _counts(spark, tn, fp, fn, tp):
    return spark.createDataFrame([(0.0, 0.0, tn), (0.0, 1.0, fp), (1.0, 0.0, fn), (1.0, 1.0, tp)], "label double, prediction double, n bigint")


def test_golden_report(spark):
    rows = {r["class"]: r for r in metrics.report_from_cells(_counts(spark, *GOLDEN_COUNTS)).collect()}
    for k, (p, r, f, s) in GOLDEN.items():
        assert rows[k].precision == pytest.approx(p, abs=1e-12)
        assert rows[k].recall == pytest.approx(r, abs=1e-12)
        assert rows[k].f1 == pytest.approx(f, abs=1e-12)
        assert rows[k].support == s
    assert rows["accuracy"].f1 == pytest.approx(GOLDEN_ACCURACY, abs=1e-15)
    assert rows["accuracy"].support == 317877


def test_zero_division_is_zero(spark):
    rows = {r["class"]: r for r in metrics.report_from_cells(_counts(spark, 0, 0, 0, 5)).collect()}
    assert rows["0"].precision == 0.0 and rows["0"].recall == 0.0 and rows["0"].f1 == 0.0
    assert rows["1"].f1 == 1.0


def _pairs(spark, pairs):
    return spark.createDataFrame(pairs, "target int, prediction double")


def test_accuracy_and_matrix(spark):
    df = _pairs(spark, [(0, 0.0), (0, 1.0), (1, 1.0), (1, 1.0)])
    a = metrics.accuracy(df).first()
    assert (a.n, a.correct, a.accuracy) == (4, 3, 0.75)
    assert metrics.accuracy(df.limit(0)).first().accuracy == 0.0
    m = {r.target: (r.pred_0, r.pred_1) for r in metrics.confusion_matrix(df).collect()}
    assert m == {0: (1, 1), 1: (0, 2)}
    # class absent from the truth is still a row of zeros
    m1 = {r.target: (r.pred_0, r.pred_1) for r in metrics.confusion_matrix(_pairs(spark, [(1, 0.0)])).collect()}
    assert m1 == {0: (0, 0), 1: (1, 0)}


def test_more_than_two_classes(spark):
    df = _pairs(spark, [(0, 0.0), (4, 4.0), (4, 2.0), (2, 2.0), (1, 4.0), (None, 1.0), (1, None)])
    rows = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in metrics.class_report(df).collect()}
    assert rows["0"] == (1.0, 1.0, 1.0, 1) and rows["1"] == (0.0, 0.0, 0.0, 1)
    assert rows["2"] == (0.5, 1.0, pytest.approx(2 / 3), 1) and rows["4"] == (0.5, 0.5, 0.5, 2)
    assert rows["accuracy"][2:] == (0.6, 5) and rows["macro avg"][0] == 0.5 and rows["weighted avg"][1] == pytest.approx(0.6)
    m = {r.target: (r.pred_0, r.pred_1, r.pred_2, r.pred_4) for r in metrics.confusion_matrix(df).collect()}
    assert m == {0: (1, 0, 0, 0), 1: (0, 0, 0, 1), 2: (0, 0, 1, 0), 4: (0, 0, 1, 1)}
    with pytest.raises(ValueError):
        metrics.confusion_matrix(df, labels=[0, 1])


def test_report_of_nothing(spark):
    rows = {r["class"]: (r.f1, r.support) for r in metrics.class_report(_pairs(spark, [(None, 1.0)])).collect()}
    assert rows == {"accuracy": (0.0, 0), "macro avg": (0.0, 0), "weighted avg": (0.0, 0)}


def test_distribution(spark):
    df = spark.createDataFrame([("Positive",)] * 2 + [("Negative",)] + [(None,)], "sentiment string")
    got = [tuple(r) for r in metrics.sentiment_distribution(df).collect()]
    assert got == [("Positive", 2, 66.7), ("Negative", 1, 33.3)]


def test_metrics_json_round_trip(spark, tmp_path):
    report = metrics.report_from_cells(_counts(spark, *GOLDEN_COUNTS))
    path = shared_path(spark, "metrics")
    write_metrics_json(report, path)
    back = {r["class"]: r for r in read_metrics_json(spark, path).collect()}
    for k, (p, r, f, s) in GOLDEN.items():
        assert back[k].precision == pytest.approx(p, abs=1e-12) and back[k].support == s
    # the published pretty-printed form reads with the same schema
    pub = tmp_path / "metrics.json"
    rep = {k: {"precision": v[0], "recall": v[1], "f1-score": v[2], "support": float(v[3])} for k, v in GOLDEN.items()}
    rep["accuracy"] = GOLDEN_ACCURACY
    pub.write_text(json.dumps({"accuracy": GOLDEN_ACCURACY, "classification_report": rep}, indent=2))
    rows = {r["class"]: r for r in read_metrics_json(spark, str(pub)).collect()}
    assert rows["accuracy"].f1 == GOLDEN_ACCURACY and rows["1"].recall == GOLDEN["1"][1]
