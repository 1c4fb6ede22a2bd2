"""Physical-plan properties that matter at scale (checked on the executed plan text)."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tonestream.operators import features
from tonestream.operators.naive_bayes import fit_naive_bayes_table
from tonestream.plans.queries import cleaned_labelled, table_scores
from tonestream.sources.tables import read_table
from tests.conftest import SF01

Q = entry.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_language_filter_reaches_the_scan(spark):
    p = plan(Q["q08_topic_filter"](spark, SF01))
    assert "PushedFilters: [IsNotNull(lang), IsNotNull(text), EqualTo(lang,en)]" in p


def test_metric_queries_read_only_the_key_of_documents(spark):
    p = plan(Q["q14_accuracy"](spark, SF01))
    assert "ReadSchema: struct<doc_id:bigint>" in p
    assert "text" not in p.split("documents.parquet")[0].split("FileScan")[-1]


def test_cleaning_runs_once_per_row(spark):
    # explode_outer keeps Catalyst from copying the cleaning into an inferred filter
    p = plan(Q["q22_term_doc_frequency"](spark, SF01))
    assert p.count("http[^") == 1


def nb_model(spark):
    data = cleaned_labelled(spark, SF01).withColumn("words", features.split_words("clean_text"))
    return fit_naive_bayes_table(data.where("is_train"), "words"), data.where(~F.col("is_train"))


def test_nb_model_is_packed_only_under_bound(spark):
    model, test = nb_model(spark)
    small = plan(model.transform(test, "words", ["doc_id"]))
    assert "Join" not in small and "Exchange" not in small.split("Subquery")[0]
    # beyond the bound (and beyond Spark's own size threshold) the term join shuffles
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = plan(model.transform(test, "words", ["doc_id"], max_broadcast_bytes=0))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "SortMergeJoin [term" in big and "BroadcastExchange" not in big


def test_scores_are_found_in_the_row(spark):
    # no exchange at all between the cleaned texts and their scores, and the packed model is never a column of the data
    for df in (Q["q29_naive_bayes_scores"](spark, SF01), table_scores(spark, SF01, read_table(spark, SF01, "documents", ["doc_id", "text"]))):
        p = plan(df)
        assert "Exchange" not in p.replace("RoundRobinPartitioning", "") or p.count("Exchange") == p.count("Exchange RoundRobinPartitioning")
        assert "_lookup" not in p and p.count("Subquery subquery") >= 1
        scored = plan(df.where("prediction = 1"))
        assert scored.count("aggregate(") == p.count("aggregate(") == 1


def test_both_ways_of_scoring_agree(spark):
    model, test = nb_model(spark)
    rows = lambda d: {r.doc_id: (r.prediction, round(r.raw_0, 7), round(r.raw_1, 7)) for r in d.collect()}
    assert rows(model.transform(test, "words")) == rows(model.transform(test, "words", max_broadcast_bytes=0))


def test_hash_split_is_map_only(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    from tonestream.operators.split import hash_split

    assert "Exchange" not in plan(hash_split(df, "k"))


def test_stratified_split_never_sorts_a_whole_class(spark):
    from tonestream.operators.split import stratified_split

    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 2).cast("int").alias("y"))
    # the counting and boundary passes are checkpointed per-class rows; what is
    # left is a map-only flag over the input against a broadcast per-class cut
    p = plan(stratified_split(df, "k", "y"))
    assert "row_number()" not in p and "Window" not in p
    assert "hashpartitioning" not in p
    assert "BroadcastHashJoin" in p


def test_blank_filter_does_not_repeat_the_cleaning(spark):
    # a filter on a computed column would be pushed through its projection and
    # re-evaluate the cleaning per predicate; with_clean_text keeps one copy
    for name in ("q06_drop_blank_and_null", "q07_clean_row_counts", "q03_clean_v2"):
        assert plan(Q[name](spark, SF01)).count("http[^") == 1, name
    from tonestream.operators.preprocess import clean_table

    raw = spark.createDataFrame([(4, "Good day"), (0, "!!!")], "target int, text string")
    assert plan(clean_table(raw, "v2", binarize=True)).count("http[^") == 1


def test_message_parsed_once_when_filtered(spark):
    from tonestream.streaming import scoring as stream

    df = spark.range(10).select(F.to_json(F.struct(F.col("id").cast("string").alias("text"))).cast("binary")
                                .alias("value"))
    d = stream.decoded_stream(df, clean_first=True)
    for part in (d.where("is_valid"), d.where(~F.col("is_valid"))):
        assert plan(part).count("parseJson") == 1


def test_relational_queries_hold_no_vocabulary_on_the_driver(spark, monkeypatch):
    from pyspark.ml.feature import CountVectorizer

    def refuse(self, dataset):
        raise AssertionError("the vocabulary would go to the driver")

    monkeypatch.setattr(CountVectorizer, "_fit", refuse)
    for name in ("q32_stream_clean_score", "q43_score_uploaded_csv", "q44_replay_display_lines", "q48_checked_scores"):
        assert Q[name](spark, SF01).count() > 0


def test_vocabulary_weights_are_found_in_the_row(spark):
    p = plan(Q["q24_tfidf_sklearn_weight"](spark, SF01))
    assert p.count("FileScan parquet [doc_id") == 1 and "Join" not in p and "Aggregate" not in p and "_lookup" not in p
    assert p.count("Exchange") == p.count("Exchange RoundRobinPartitioning")  # the spread of a small table


def test_lookup_finds_every_term_and_no_other(spark):
    from tonestream.operators.lookup import pack_lookup, with_lookup
    from tonestream.session import shared_path

    rows = [(f"t{i}", float(i)) for i in range(500)] + [("", -1.0), ("été", -2.0)]
    packed = pack_lookup(spark.createDataFrame(rows, "term string, x double"), len(rows), shared_path(spark, "packed"))
    words = [t for t, _ in rows] + ["absent", "t500", None]
    df = spark.createDataFrame([(1, words), (2, []), (3, None)], "id int, words array<string>")
    out = with_lookup(df, packed, "found", F.col("words"), lambda w, find: F.transform(w, lambda t: find(t)["x"]))
    got = {r.id: r.found for r in out.collect()}
    assert got == {1: [x for _, x in rows] + [None] * 3, 2: [], 3: None}
    none = pack_lookup(spark.createDataFrame([], "term string, x double"), 0, shared_path(spark, "packed"))
    assert [r.found for r in with_lookup(df, none, "found", F.col("words"), lambda w, find: F.transform(w, lambda t: find(t)["x"])).collect()][1] == []
