"""Streams: batch = stream, quarantine, restart from the checkpoint."""

import pytest
from pyspark.sql import functions as F

from tonestream.functions import messages
from tonestream.operators.naive_bayes import fit_naive_bayes_ml
from tonestream.operators.scoring import score_table
from tonestream.plans.queries import cleaned_labelled
from tonestream.session import shared_path
from tonestream.sources.tables import read_table
from tonestream.streaming import scoring as stream
from tests.conftest import SF01

SCHEMA = "conv_id bigint, turn bigint, value binary"


def _messages(spark, value=None):
    conv = read_table(spark, SF01, "conversations", ["conv_id", "turn", "text"])
    path = shared_path(spark, "msgs")
    stream.write_message_files(conv.repartition(6), path, key_cols=("conv_id", "turn"), value=value)
    return conv, path


@pytest.mark.parametrize("kind", ["naive_bayes", "logistic"])
def test_stream_equals_batch(spark, kind):
    from tonestream.operators.logistic import train_logistic

    train = cleaned_labelled(spark, SF01).where("is_train")
    model = fit_naive_bayes_ml(train) if kind == "naive_bayes" else train_logistic(train, "hashed", max_iter=10)
    conv, src = _messages(spark)
    live = stream.decoded_stream(stream.message_stream(spark, src, SCHEMA, max_files_per_trigger=2))
    scored = stream.score_stream(live.select("conv_id", "turn", "text"), model, clean_first=True)
    out, ckpt = shared_path(spark, "out"), shared_path(spark, "ckpt")
    q = stream.start_to_files(scored.select("conv_id", "turn", "prediction"), out, ckpt)
    stream.run_until_done(q)
    assert len(q.recentProgress) >= 3  # six files, two per trigger
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    want = sorted(tuple(r) for r in score_table(conv, model, clean_first=True)
                  .select("conv_id", "turn", "prediction").collect())
    assert got == want


def test_restart_resumes_from_checkpoint(spark):
    conv, src = _messages(spark)
    live = stream.decoded_stream(stream.message_stream(spark, src, SCHEMA, max_files_per_trigger=1))
    out, ckpt = shared_path(spark, "out"), shared_path(spark, "ckpt")
    sel = live.select("conv_id", "turn", "text")
    stream.run_until_done(stream.start_to_files(sel, out, ckpt))
    first = spark.read.parquet(out).count()
    # second run over the same checkpoint: nothing new, nothing duplicated
    stream.run_until_done(stream.start_to_files(sel, out, ckpt))
    assert spark.read.parquet(out).count() == first == conv.count()


def test_quarantine_split(spark):
    df = spark.createDataFrame([(b'{"text":"ok"}',), (b"bad",), (b"",), (b'{"x":1}',)], "value binary")
    good, bad = messages.split_quarantine(messages.decode_messages(df))
    assert sorted(r.text for r in good.collect()) == ["", "ok"]
    assert bad.count() == 2


def test_foreach_batch_is_idempotent_per_batch(spark):
    conv, src = _messages(spark)
    live = stream.decoded_stream(stream.message_stream(spark, src, SCHEMA, max_files_per_trigger=3))
    out, ckpt = shared_path(spark, "fb"), shared_path(spark, "fb-ckpt")
    q = stream.start_foreach_batch(live, lambda b: b.select("conv_id", "turn", F.length("text").alias("n")), out, ckpt)
    stream.run_until_done(q)
    assert spark.read.parquet(out).count() == conv.count()


def test_console_sink_runs(spark):
    conv, src = _messages(spark)
    live = stream.decoded_stream(stream.message_stream(spark, src, SCHEMA, max_files_per_trigger=6))
    q = stream.start_console(live.select("conv_id", "turn"), processing_time="100 milliseconds")
    try:
        q.processAllAvailable()
        assert q.lastProgress is not None and q.exception() is None
    finally:
        q.stop()


def test_quarantine_from_one_pass(spark):
    value = F.when(F.col("turn") % 3 == 0, F.lit("not json")).otherwise(messages.encode_message("text"))
    conv, src = _messages(spark, value)
    live = stream.decoded_stream(stream.message_stream(spark, src, SCHEMA, max_files_per_trigger=2))
    good, bad = shared_path(spark, "good"), shared_path(spark, "bad")
    stream.run_until_done(stream.start_with_quarantine(live, lambda b: b.select("conv_id", "turn", "text"), good, bad, shared_path(spark, "q-ckpt")))
    kept = spark.read.parquet(good).select("conv_id", "turn", "text")
    assert kept.exceptAll(conv.where("turn % 3 <> 0").select("conv_id", "turn", "text")).isEmpty()
    assert kept.count() + spark.read.parquet(bad).count() == conv.count()


def test_a_table_is_a_stream(spark):
    live = stream.decoded_stream(stream.table_stream(spark, f"{SF01}/conversations.parquet"))
    out = shared_path(spark, "table-out")
    stream.run_until_done(stream.start_to_files(live.select("conv_id", "turn", "text"), out, shared_path(spark, "table-ckpt")))
    assert spark.read.parquet(out).count() == spark.read.parquet(f"{SF01}/conversations.parquet").count()


def test_failed_batch_is_replayed_exactly_once(spark):
    import os

    conv, src = _messages(spark)
    live = stream.decoded_stream(stream.message_stream(spark, src, SCHEMA, max_files_per_trigger=2))
    out, ckpt = shared_path(spark, "fail-out"), shared_path(spark, "fail-ckpt")
    marker = shared_path(spark, "fail-marker")

    def flaky(b):
        # the first attempt dies once batch 1 has written part of its output
        if not os.path.exists(marker) and b.count() and os.path.exists(f"{out}/batch_id=0"):
            os.makedirs(marker)
            b.limit(1).select("conv_id", "turn").write.mode("overwrite").parquet(f"{out}/batch_id=1")
            raise RuntimeError("executor lost")
        return b.select("conv_id", "turn")

    q = stream.start_foreach_batch(live, flaky, out, ckpt)
    with pytest.raises(Exception, match="executor lost"):
        q.awaitTermination(300)
    stream.run_until_done(stream.start_foreach_batch(live, flaky, out, ckpt))
    got = spark.read.parquet(out).select("conv_id", "turn")
    assert got.count() == conv.count() == got.distinct().count()


def test_run_until_stopped_stops_and_resumes(spark):
    conv, src = _messages(spark)
    live = stream.decoded_stream(stream.message_stream(spark, src, SCHEMA, max_files_per_trigger=1))
    out, ckpt = shared_path(spark, "serve-out"), shared_path(spark, "serve-ckpt")
    sel = live.select("conv_id", "turn")
    q = stream.start_to_files(sel, out, ckpt, available_now=False, processing_time="100 milliseconds")
    stream.run_until_stopped(q, timeout_s=2)
    assert not q.isActive
    stream.run_until_done(stream.start_to_files(sel, out, ckpt))  # resume: the rest, nothing twice
    got = spark.read.parquet(out)
    assert got.count() == got.distinct().count() == conv.count()


@pytest.mark.parametrize("name", ["q32_stream_clean_score", "q42_stream_naive_bayes_ml", "q44_replay_display_lines"])
def test_broken_messages_come_back_from_the_queries(spark, name):
    from tonestream.plans.queries import QUERIES

    enc = messages.encode_message("text")
    got = QUERIES[name](spark, SF01, F.when(F.col("turn") % 2 == 0, F.substring(enc, 1, 10)).otherwise(enc))
    conv = read_table(spark, SF01, "conversations", ["conv_id", "turn"])
    assert got.count() == conv.count()
    assert got.where(F.col(got.columns[-1]).isNull()).select("conv_id", "turn").exceptAll(conv.where("turn % 2 = 0")).isEmpty()
    assert got.where(F.col(got.columns[-1]).isNull()).count() == conv.where("turn % 2 = 0").count()


def test_logistic_scores_return_broken_messages(spark):
    from tonestream.plans.queries import q38_stream_logistic_scores

    got = q38_stream_logistic_scores(spark, SF01)
    conv = read_table(spark, SF01, "conversations", ["conv_id", "turn"])
    assert got.select("conv_id", "turn").exceptAll(conv).isEmpty() and got.count() == conv.count()
    cut = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(10)) == 0
    assert got.where(cut != F.col("prediction").isNull()).isEmpty() and 0 < got.where(cut).count() < conv.count()


@pytest.mark.parametrize("bound", [1 << 20, 0], ids=["in the plan", "joined"])
def test_scoring_many_batches_writes_only_the_result(spark, bound):
    import glob

    from tonestream.operators.naive_bayes import fit_naive_bayes_table

    train = spark.createDataFrame([(["good"], 1), (["bad"], 0), (["good"], 1)], "words array<string>, target int")
    model = fit_naive_bayes_table(train, "words")
    texts = spark.range(0, 50, 1, 50).select("id", F.when(F.col("id") % 3 == 0, "very good").otherwise("bad").alias("text"))
    value = F.when(F.col("id") % 10 == 7, F.lit("not json")).otherwise(messages.encode_message("text"))
    src, out, ckpt = shared_path(spark, "many"), shared_path(spark, "many-out"), shared_path(spark, "many-ckpt")
    stream.write_message_files(texts, src, key_cols=("id",), value=value)
    live = stream.decoded_stream(stream.message_stream(spark, src, "id bigint, value binary", max_files_per_trigger=1), clean_first=True)
    shared = src.rsplit("/", 1)[0].replace("file:", "")
    before = set(glob.glob(f"{shared}/*"))
    query = stream.start_table_model_by_status(live, model, out, ckpt, ("id",), max_broadcast_bytes=bound)
    stream.run_until_done(query)
    assert query.lastProgress["batchId"] == 49
    after = {p.rsplit("/", 1)[-1] for p in set(glob.glob(f"{shared}/*")) - before}
    assert after == {p.rsplit("/", 1)[-1] for p in (out, ckpt)}
    got = {r.id: (r.status, r.prediction) for r in spark.read.parquet(out).collect()}
    assert got == {i: ("quarantine", None) if i % 10 == 7 else ("scored", float(i % 3 == 0)) for i in range(50)}
