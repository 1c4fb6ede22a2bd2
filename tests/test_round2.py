"""Answers that were wrong before: split with null keys, repeated ids, rounding, layouts, names, keywords, the shared folder."""

import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tonestream.functions import labels
from tonestream.operators.filters import topic_filter
from tonestream.operators.naive_bayes import fit_naive_bayes_ml, fit_naive_bayes_table
from tonestream.operators.scoring import score_table
from tonestream.operators.split import stratified_split
from tonestream.sources.labelled import detect_layout, load_labelled


def test_null_keys_rank_last(spark):
    rows = [(i if i < 16 else None, 1) for i in range(20)]
    got = stratified_split(spark.createDataFrame(rows, "k long, target int"), "k", frac=0.8).collect()
    assert sum(r.is_train for r in got) == 16 and all(r.is_train == (r.k is not None) for r in got)


def test_repeated_and_null_ids_are_scored_by_row(spark):
    train = spark.createDataFrame([(["good"], 1), (["bad"], 0), (["good"], 1)], "words array<string>, target int")
    model = fit_naive_bayes_table(train, "words")
    df = spark.createDataFrame([(1, ["good"]), (1, ["bad"]), (None, ["good"]), (None, [])], "id long, words array<string>")
    got = {(r.id, tuple(r.words)): r.p_pos for r in model.transform(df, "words", ["id"]).collect()}
    assert got[1, ("good",)] == got[None, ("good",)] > 0.5 > got[1, ("bad",)]
    assert len(got) == 4


def test_two_decimals_round_the_binary_value(spark):
    values = [k / 1000 for k in range(1001)] + [0.125, 0.375, 0.625, 0.875, 0.285, 0.015, 0.29, 1e-9, 0.9950000000000001, 1.0, 0.0]
    rows = spark.createDataFrame([(v,) for v in values], "p double").select("p", labels.two_decimals("p").alias("t")).collect()
    assert [r.t for r in rows] == [f"{r.p:.2f}" for r in rows]


def test_headered_wide_files_are_read_by_name(spark, tmp_path):
    (tmp_path / "wide.csv").write_text("id,target,a,b,c,text\n9,1,x,y,z,hello there\n")
    assert detect_layout(spark, str(tmp_path / "wide.csv")) == "generic"
    assert [tuple(r) for r in load_labelled(spark, str(tmp_path / "wide.csv")).collect()] == [(1, "hello there")]
    (tmp_path / "raw.csv").write_text('"4","1","d","q","u","nice day"\n')
    assert [tuple(r) for r in load_labelled(spark, str(tmp_path / "raw.csv")).collect()] == [(1, "nice day")]
    (tmp_path / "odd.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        load_labelled(spark, str(tmp_path / "odd.csv"))


@pytest.mark.parametrize("cut", ['"4","1","d","q","u","nice\nday"', '"4","1","d","q","u","say ""hi\n"', '"4","1","d","q","u","a\n0,2,d,q,u,b"',
                                 '"4","1","d","q","u","x,""\n""y"'])
def test_records_cut_by_line_breaks_are_errors(spark, tmp_path, cut):
    whole = '"0","2","d","q","u","x ""y"", z"\n0,3,d,q,u,5" screen\n"0","4","d","q","u",""\n"4","5","d","q","u","ends,"\n'
    path = str(tmp_path / "raw.csv")
    (tmp_path / "raw.csv").write_text(whole)
    rows = load_labelled(spark, path)
    assert sorted((r.target, r.text or "") for r in rows.collect()) == [(0, ""), (0, '5" screen'), (0, 'x "y", z'), (1, "ends,")]
    assert rows.count() == 4
    (tmp_path / "raw.csv").write_text(whole + cut + "\n")
    for read in (lambda df: df.collect(), lambda df: df.count(), lambda df: df.select("target").collect()):
        with pytest.raises(Exception, match="multi_line=True"):
            read(load_labelled(spark, path))
    assert load_labelled(spark, path, multi_line=True).where(F.contains("text", F.lit("\n"))).count() == 1


def test_input_columns_named_like_model_stages(spark):
    rows = [("good day", 1, "w", 1.0), ("bad day", 0, "w", 2.0)] * 3
    df = spark.createDataFrame(rows, "text string, target int, nb_words string, probability double").withColumn("words", F.lit("mine"))
    model = fit_naive_bayes_ml(df.select(F.col("text").alias("clean_text"), "target"))
    got = score_table(df, model)
    assert got.columns == ["text", "target", "nb_words", "probability", "words", "clean_text", "prediction", "pred", "sentiment", "p_neg", "p_pos"]
    assert {(r.nb_words, r.words) for r in got.collect()} == {("w", "mine")}


def test_keywords_are_literal(spark):
    df = spark.createDataFrame([("I write c++ daily", "en"), ("vitamin c is fine", "en"), ("a.b", "en"), ("axb", "en")], "text string, lang string")
    assert [r.text for r in topic_filter(df, ["C++"]).collect()] == ["I write c++ daily"]
    assert [r.text for r in topic_filter(df, ["a.b"]).collect()] == ["a.b"]
    for bad in ([], [""]):
        with pytest.raises(ValueError):
            topic_filter(df, bad)


SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
from tonestream.session import build_session, shared_path
s = build_session(master="local[1]")
if {own!r}:
    s.sparkContext.setCheckpointDir({own!r})
path = shared_path(s, "x")
s.range(3).write.parquet(path)
print("PATH", path, s.read.parquet(path).count())
"""


@pytest.mark.parametrize("own", ["", "mine"])
def test_shared_folder_without_the_setting(tmp_path, own):
    import os

    (tmp_path / "conf").mkdir()
    own = str(tmp_path / own) if own else ""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=repo, own=own)], env=os.environ | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "TMPDIR": str(tmp_path)},
                         capture_output=True, text=True, timeout=120)
    assert " 3" in out.stdout, out.stderr[-2000:]
    assert not own or own in out.stdout
