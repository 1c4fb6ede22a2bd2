"""Unit rows for the cleaning, label and message expressions (FIXTURES.md edge rows)."""

import pytest
from pyspark.sql import functions as F

from tonestream.functions import clean, labels, messages

NBSP = " "

V2_ROWS = [
    ("Check http://t.co/x now", "check"),
    ("see www.site.com great", "see great"),
    ("@user loves #spark daily", "loves daily"),
    ("@joséabc fine", "fine"),
    (f"a http://x{NBSP}rest here", "rest"),
    ("I don't like it!!!", "like"),
    ("12345 !!!", ""),
    ("Line one\nline two", "line one line two"),
    ("\u212aelvin scale", "elvin scale"),  # Kelvin sign: not an ASCII letter, removed before lower-casing
    (None, None),
]


def _one_col(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("t"))).collect()]


def test_clean_v2_edge_rows(spark):
    got = _one_col(spark, [r[0] for r in V2_ROWS], clean.clean_v2)
    assert got == [r[1] for r in V2_ROWS]


def test_clean_v1_keeps_short_words_and_www(spark):
    got = _one_col(spark, ["Check http://t.co/x now ok", "see www.site.com great", "a b  c", None],
                   clean.clean_v1)
    # v1: URL removed without space, no length filter, 'a' is a stop word
    assert got == ["check ok", "see www site com great", "b c", None]


def test_stop_words_match_spark_default(spark):
    from pyspark.ml.feature import StopWordsRemover

    assert list(clean.STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_blank_snippet_and_default(spark):
    assert _one_col(spark, ["  ", "x", None], clean.is_blank) == [True, False, None]
    assert _one_col(spark, [None, "a"], clean.text_or_empty) == ["", "a"]
    assert _one_col(spark, ["ab\ncd" * 50], lambda c: clean.snippet(c, 7)) == ["ab cdab"]


def test_labels(spark):
    df = spark.createDataFrame([(0,), (4,), (1,), (None,)], "x int")
    rows = df.select(labels.binarize_label("x").alias("b"), labels.label_name("x").alias("n"),
                     labels.label_name_strict("x").alias("s")).collect()
    assert [r.b for r in rows] == [0, 1, 0, None]
    assert [r.n for r in rows] == ["Negative", "Negative", "Positive", "Negative"]
    assert [r.s for r in rows] == ["Negative", None, "Positive", None]
    line = spark.range(1).select(labels.display_line(F.lit("great\nday"), F.lit(1.0), F.lit(0.123),
                                                     F.lit(0.877)).alias("l")).first().l
    assert line == "great day -> Positive (conf: 0.12/0.88)"


@pytest.mark.parametrize("value,valid,text", [
    ('{"text":"hello"}', True, "hello"),
    ("bad", False, None),
    ('{"x":1}', True, ""),
    ('{"text":null}', True, ""),
    ('{"text":5}', True, "5"),
    ('"str"', True, "str"),
    ("[1,2]", True, "[1,2]"),
    ("", False, None),
])
def test_message_decode(spark, value, valid, text):
    df = spark.createDataFrame([(bytearray(value.encode()),)], "value binary")
    row = messages.decode_messages(df).first()
    assert row.is_valid is valid
    assert row.text == text


def test_message_round_trip(spark):
    texts = ['say "hi", ok\nline two \\ end', "é", ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    enc = df.select(messages.encode_message("text").alias("value"))
    got = [r.text for r in messages.decode_messages(enc).collect()]
    assert got == texts
    strict = enc.select(messages.decode_declared("value").text.alias("t")).collect()
    assert [r.t for r in strict] == texts


def test_nltk_stop_word_list(spark):
    assert len(clean.NLTK_STOP_WORDS) == 179 == len(set(clean.NLTK_STOP_WORDS))
    assert clean.stop_word_list("nltk") is clean.NLTK_STOP_WORDS
    got = _one_col(spark, ["I didn't like it, it would fail"],
                   lambda c: clean.clean_v2(c, clean.stop_word_list("spark")))
    assert got == ["didn like fail"]
    assert _one_col(spark, ["I didn't like it, it would fail"], clean.clean_v2) == ["like would fail"]
