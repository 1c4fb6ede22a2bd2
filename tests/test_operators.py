"""Operator behaviour beyond the oracle: splits, Naive Bayes forms, scoring, sources."""

import pytest
from pyspark.sql import functions as F

from tonestream.functions import clean
from tonestream.operators import features
from tonestream.operators.filters import topic_filter
from tonestream.operators.naive_bayes import fit_naive_bayes_ml, fit_naive_bayes_table
from tonestream.operators.scoring import resolve_text_column, score_table, score_texts
from tonestream.operators.split import hash_split, stratified_split
from tonestream.plans.queries import cleaned_labelled
from tonestream.session import shared_path
from tonestream.sinks.files import write_table
from tonestream.sources.labelled import detect_layout, load_labelled, read_to_score
from tests.conftest import SF01


def _brute_stratified(rows, frac):
    import hashlib
    import math

    out = {}
    for y in {r[1] for r in rows}:
        cls = sorted((hashlib.md5(str(k).encode()).hexdigest(), k) for k, t in rows if t == y)
        cut = math.floor(frac * len(cls))
        for i, (_, k) in enumerate(cls):
            out[k] = i < cut
    return out


@pytest.mark.parametrize("bits", [1, 4, 20])
@pytest.mark.parametrize("frac", [0.0, 0.5, 0.8, 1.0])
def test_stratified_split_exact(spark, bits, frac):
    rows = [(i, int(i % 7 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "k bigint, y int")
    got = {r.k: r.is_train for r in stratified_split(df, "k", "y", frac, bucket_bits=bits).collect()}
    assert got == _brute_stratified(rows, frac)


def test_hash_split_is_deterministic(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r.k: r.is_train for r in hash_split(df, "k").collect()}
    b = {r.k: r.is_train for r in hash_split(df.repartition(7), "k").collect()}
    assert a == b and 700 < sum(a.values()) < 900


def test_relational_nb_equals_spark_ml(spark):
    data = cleaned_labelled(spark, SF01)
    train, test = data.where("is_train"), data.where(~F.col("is_train"))
    table = fit_naive_bayes_table(train.withColumn("words", features.split_words("clean_text")), "words")
    rel = table.transform(test.withColumn("words", features.split_words("clean_text")), "words", ["doc_id"])
    ml = fit_naive_bayes_ml(train).transform(test)
    from pyspark.ml.functions import vector_to_array

    a = {r.doc_id: (r.prediction, r.p_pos) for r in rel.collect()}
    b = {r.doc_id: (r.prediction, r.p) for r in ml.select("doc_id", "prediction",
                                                           vector_to_array("probability")[1].alias("p")).collect()}
    assert a.keys() == b.keys() and len(a) > 0
    for k in a:
        assert a[k][0] == b[k][0]
        assert a[k][1] == pytest.approx(b[k][1], abs=1e-9)


def test_nb_sized_join_shuffle_path_equals_broadcast(spark):
    data = cleaned_labelled(spark, SF01).withColumn("words", features.split_words("clean_text"))
    table = fit_naive_bayes_table(data.where("is_train"), "words")
    test = data.where(~F.col("is_train"))
    a = {r.doc_id: r.raw_1 for r in table.transform(test, "words", ["doc_id"]).collect()}
    b = {r.doc_id: r.raw_1 for r in table.transform(test, "words", ["doc_id"], max_broadcast_bytes=0).collect()}
    assert a.keys() == b.keys()
    assert all(a[k] == pytest.approx(b[k], abs=1e-9) for k in a)


def test_resolve_and_score_texts(spark):
    df = spark.createDataFrame([("a",)], "text string")
    assert resolve_text_column(df) == "text"
    assert resolve_text_column(df.withColumn("clean_text", F.lit("b"))) == "clean_text"
    with pytest.raises(ValueError):
        resolve_text_column(spark.createDataFrame([(1,)], "x int"))
    data = cleaned_labelled(spark, SF01)
    model = fit_naive_bayes_ml(data.where("is_train"))
    out = score_texts(spark, model, ["I absolutely love this phone!", None], clean_first=True).collect()
    assert [r.clean_text for r in out] == ["absolutely love phone", ""]
    assert all(r.sentiment in ("Positive", "Negative") and abs(r.p_neg + r.p_pos - 1) < 1e-9 for r in out)
    # every input column kept, null text scored as ''
    scored = score_table(spark.createDataFrame([(1, None), (2, "great")], "id int, text string"), model)
    assert set(scored.columns) >= {"id", "text", "clean_text", "prediction", "pred", "sentiment", "p_neg", "p_pos"}
    assert scored.count() == 2


def test_csv_quoting_survives(spark):
    text = 'say "hi", ok\nline two \\ end'
    df = spark.createDataFrame([(4, text), (0, "  padded  ")], "target int, text string")
    path = shared_path(spark, "csv-test")
    write_table(df, path, "csv", header=True)
    assert detect_layout(spark, path) == "generic"
    back = sorted(tuple(r) for r in load_labelled(spark, path, "generic", binarize=True).collect())
    assert back == [(0, "  padded  "), (1, text)]
    assert sorted(r.text for r in read_to_score(spark, path).collect()) == ["  padded  ", text]


def test_sentiment140_layout(spark):
    raw = spark.createDataFrame([(4, 1, "d", "NO_QUERY", "u", "héllo, \"x\""), (0, 2, "d", "NO_QUERY", "u", "bad")],
                                "target int, id long, date string, flag string, user string, text string")
    path = shared_path(spark, "raw-test")
    write_table(raw, path, "csv", header=False, encoding="ISO-8859-1")
    assert detect_layout(spark, path) == "sentiment140"
    got = sorted(tuple(r) for r in load_labelled(spark, path).collect())
    assert got == [(0, "bad"), (1, "héllo, \"x\"")]


def test_topic_filter_semantics(spark):
    df = spark.createDataFrame([
        (1, "en", "New AI chips"), (2, "en", "RT @x: AI news"), (3, "fr", "AI en France"),
        (4, "en", "said nothing"), (5, "en", "Sports!"), (6, "en", "TECHNOLOGY rocks"),
    ], "id int, lang string, text string")
    assert sorted(r.id for r in topic_filter(df).collect()) == [1, 5, 6]


def test_bigrams(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), (["x"],), ([],)], "w array<string>")
    got = [r.g for r in df.select(features.with_bigrams(F.col("w")).alias("g")).collect()]
    assert got == [["a", "b", "c", "a b", "b c"], ["x"], []]


def test_letter_text(spark):
    df = spark.createDataFrame([("  Hi,  there\tYou 2 ",)], "t string")
    assert df.select(clean.letter_text("t")).first()[0] == "hi there you"


def test_table_checks(spark):
    from tonestream.operators.filters import require_not_empty
    from tonestream.operators.scoring import require_columns

    df = spark.createDataFrame([(1, "a")], "target int, text string")
    require_columns(df, ["target", "text"])
    with pytest.raises(ValueError):
        require_columns(df, ["clean_text"])
    assert require_not_empty(df) is df
    with pytest.raises(ValueError):
        require_not_empty(df.limit(0))


def test_kafka_source_options_and_missing_connector(spark):
    from tonestream.streaming.scoring import kafka_options, kafka_stream

    opts = kafka_options("broker:9092", "tweets", "latest", max_offsets_per_trigger=1000)
    assert opts["subscribe"] == "tweets" and opts["startingOffsets"] == "latest"
    assert opts["maxOffsetsPerTrigger"] == "1000"
    with pytest.raises(RuntimeError):
        kafka_stream(spark, bootstrap="broker:9092", topic="tweets")


def test_read_cleaned_declared_schema(spark):
    from tonestream.sources.labelled import read_cleaned

    df = spark.createDataFrame([(1, "good day")], "target int, clean_text string")
    path = shared_path(spark, "cleaned-test")
    write_table(df, path, "csv", header=True)
    back = read_cleaned(spark, path, fmt="csv")
    assert back.schema.simpleString() == "struct<target:int,clean_text:string>"
    assert [tuple(r) for r in back.collect()] == [(1, "good day")]


def test_spread_and_fit_partitions(spark):
    from tonestream.operators.partitioning import fit_partitions, spread

    one = spark.range(100).coalesce(1)
    assert spread(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(100).repartition(64)
    assert spread(many).rdd.getNumPartitions() == 64  # already split finer: unchanged
    assert fit_partitions(many, 100).rdd.getNumPartitions() == 1
    assert fit_partitions(many, 1 << 30).rdd.getNumPartitions() == 64
    assert sorted(r.id for r in spread(one).collect()) == list(range(100))


def test_kafka_sink_frame_and_display(spark):
    from tonestream.sinks.files import display_frame, kafka_sink_frame

    df = spark.createDataFrame([("hi \"you\"",)], "text string")
    assert [r.value for r in kafka_sink_frame(df).collect()] == ['{"text":"hi \\"you\\""}']
    scored = spark.createDataFrame([("good day", 1, 0.25, 0.75)], "clean_text string, pred int, p_neg double, p_pos double")
    assert display_frame(scored).first().display_line == "good day -> Positive (conf: 0.25/0.75)"


def test_label_indexer_keeps_label_meaning(spark):
    from tonestream.operators.logistic import train_logistic

    data = cleaned_labelled(spark, SF01)
    model = train_logistic(data.where("is_train"), features="hashed", label_indexer=True, max_iter=10)
    idx = model.stages[0]
    assert idx.labels == ["0.0", "1.0"]  # value order: index 0 is label 0
    out = score_table(data.where(~F.col("is_train")), model)
    assert out.where("prediction NOT IN (0.0, 1.0)").count() == 0
    # rows without any label column still score (the indexer stage is skipped)
    unlabelled = data.where(~F.col("is_train")).select("doc_id", "clean_text")
    assert score_table(unlabelled, model).count() == unlabelled.count()


def test_clean_table_and_evaluate(spark):
    from tonestream.operators.preprocess import clean_table, evaluate

    raw = spark.createDataFrame([(4, "Loving #spark today http://x.y"), (0, "12345 !!!"), (0, None), (None, "ok fine")],
                                "target int, text string")
    v2 = clean_table(raw, "v2", binarize=True).collect()
    assert [tuple(r) for r in v2] == [(1, "loving today")]
    v1 = clean_table(raw, "v1").orderBy("text").collect()
    assert len(v1) == 4 and {r.clean_text for r in v1} >= {"", "loving spark today"}
    scored = spark.createDataFrame([(0, 0.0), (1, 1.0), (1, 0.0)], "target int, prediction double")
    ev = evaluate(scored)
    assert ev["accuracy"].first().accuracy == 2 / 3
    assert {r["class"] for r in ev["report"].collect()} == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert ev["confusion"].count() == 2


def test_nb_scoring_under_a_hot_term(spark):
    # one term holds a third of all tokens; the shuffle path with AQE skew-join
    # splitting must give the broadcast path's scores
    rows = [(i, i % 2, " ".join(["hot"] * 4 + [f"w{i % 50}", f"v{i % 7}", f"u{i}", f"x{i % 3}", f"y{i % 11}",
                                               f"z{i % 13}", f"k{i % 17}", f"m{i % 19}"]))
            for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, target int, clean_text string").withColumn(
        "words", features.split_words("clean_text"))
    df = hash_split(df, "doc_id", 0.8)
    model = fit_naive_bayes_table(df.where("is_train"), "words")
    test = df.where(~F.col("is_train"))
    want = {r.doc_id: r.raw_1 for r in model.transform(test, "words", ["doc_id"]).collect()}
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    prev = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        got = {r.doc_id: r.raw_1 for r in model.transform(test, "words", ["doc_id"], max_broadcast_bytes=0).collect()}
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
    assert got.keys() == want.keys() and len(got) == test.count() > 0
    assert all(got[k] == pytest.approx(want[k], abs=1e-9) for k in got)


def test_vocab_tfidf_vectors_equal_long_form(spark):
    # the ML featurizer (T6/T7) and the SQL-checked long form give the same weights
    data = cleaned_labelled(spark, SF01).where("is_train")
    model = features.fit_sklearn_tfidf(data)
    vocab = model.stages[2].vocabulary
    ml = {}
    for r in model.transform(data).select("doc_id", "features").collect():
        v = r.features
        for i, x in zip(v.indices, v.values):
            ml[(r.doc_id, vocab[i])] = x
    grams = features.with_bigrams(features.split_words("clean_text"))
    packed = features.fit_vocabulary(features.term_stats_of(data, grams), data.count(), 20000, 2)
    long = {(r.doc_id, r.term): r.w for r in features.tfidf_sklearn(data, "doc_id", grams, packed).collect()}
    assert ml.keys() == long.keys() and len(ml) > 1000
    assert all(abs(ml[k] - long[k]) < 1e-12 for k in ml)


def test_stored_vectors_equal_dense_statistics(spark):
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import Vectors, VectorUDT
    from pyspark.sql.types import IntegerType, StructField, StructType

    schema = StructType([StructField("id", IntegerType()), StructField("v", VectorUDT())])
    df = spark.createDataFrame([(1, Vectors.sparse(6, [1, 4], [2.0, 0.0])), (2, Vectors.dense([1.0, 0.0, 3.0]))],
                               schema)
    dense = df.select("id", F.size(F.filter(vector_to_array("v"), lambda x: x != 0)).alias("n"),
                      F.aggregate(vector_to_array("v"), F.lit(0.0), lambda a, x: a + x).alias("s"))
    stored = features.stored_vectors(df, ["v"], "vec-test")
    sparse = stored.select("id", features.vector_nnz(F.col("v")).alias("n"), features.vector_sum(F.col("v")).alias("s"))
    assert sorted(map(tuple, dense.collect())) == sorted(map(tuple, sparse.collect())) == [(1, 1, 2.0), (2, 2, 4.0)]


def test_hash_split_null_key_goes_to_test(spark):
    df = spark.createDataFrame([(None,), (1,)], "k bigint")
    rows = {r.k: r.is_train for r in hash_split(df, "k").collect()}
    assert rows[None] is False and rows[1] in (True, False)


def test_recommended_conf_scales_with_input():
    from tonestream.session import recommended_conf

    small = recommended_conf(25 << 20, 8)
    big = recommended_conf(100 << 40, 8000)  # 100 TB on 1,000 executors x 8 cores
    assert int(small["spark.sql.shuffle.partitions"]) == 16
    assert int(big["spark.sql.shuffle.partitions"]) == 262144
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_kafka_sink_needs_the_connector(spark):
    from tonestream.sinks.files import publish_kafka

    df = spark.createDataFrame([("hi",)], "text string")
    with pytest.raises(RuntimeError, match="Kafka sink unavailable"):
        publish_kafka(df, "tweets", "localhost:9092")


def test_random_split_keeps_every_row_once(spark):
    from tonestream.operators.split import random_split

    df = spark.range(2000).withColumnRenamed("id", "k")
    out = random_split(df, 0.8, 42)
    assert out.count() == 2000 == out.select("k").distinct().count()
    assert 1500 < out.where("is_train").count() < 1700


def test_evaluation_helpers_keep_rows_and_semantics(spark):
    from tonestream.operators.evaluation import with_column_once, with_kept_column

    df = spark.createDataFrame([(1, "a"), (2, None), (3, "")], "id int, t string")
    once = with_column_once(df, "u", F.upper("t"))
    assert sorted((r.id, r.u) for r in once.collect()) == [(1, "A"), (2, None), (3, "")]  # nulls kept, rows kept
    kept = with_kept_column(df, "u", F.upper("t"), lambda v: F.length(v) > 0)
    assert sorted((r.id, r.u) for r in kept.collect()) == [(1, "A")]  # null and failing rows dropped


@pytest.mark.parametrize("feats", ["hashed", "vocab"])
def test_logistic_scores_equal_brute_force(spark, feats):
    # q30 / q31 have no SQL oracle: on a small fixture, recompute every score
    # from the fitted coefficients, and (hashed) every IDF weight from counts
    import math

    from tonestream.operators.logistic import train_logistic
    from tests.conftest import SF001

    data = cleaned_labelled(spark, SF001)
    model = train_logistic(data.where("is_train"), features=feats, max_iter=15)
    lr = model.stages[-1]
    w, b = lr.coefficients, lr.intercept
    rows = score_table(data.where(~F.col("is_train")), model, keep_model_columns=True) \
        .select("features", "p_pos", "prediction").collect()
    assert rows
    for r in rows:
        p = 1.0 / (1.0 + math.exp(-(r.features.dot(w) + b)))
        assert r.p_pos == pytest.approx(p, abs=1e-9)
        assert r.prediction == (1.0 if p > 0.5 else 0.0)
    if feats == "hashed":
        idf = model.stages[3].idf.toArray()
        train = model.transform(data.where("is_train")).select("rawFeatures").collect()
        m = len(train)
        df_count = {}
        for r in train:
            for j in r.rawFeatures.indices:
                df_count[int(j)] = df_count.get(int(j), 0) + 1
        for j, c in df_count.items():
            assert idf[j] == pytest.approx(math.log((m + 1.0) / (c + 1.0)), abs=1e-12)


@pytest.mark.parametrize("k", [1, 5, 37, 1000])
def test_top_terms_threshold_equals_brute_force(spark, k):
    import random

    rnd = random.Random(k)
    rows = [(f"t{i:03d}", rnd.randint(1, 4), rnd.choice([1, 2, 2, 3, 5, 5, 5, 8])) for i in range(300)]
    stats = spark.createDataFrame(rows, "term string, df bigint, cf bigint").repartition(7)
    got = [tuple(r) for r in features.top_terms(stats, k, 2).collect()]
    want = sorted((r for r in rows if r[1] >= 2), key=lambda r: (-r[2], r[0]))[:k]
    assert got == want


def test_build_session_applies_recommended_conf(spark):
    from tonestream.session import build_session, recommended_conf

    keys = list(recommended_conf(1, 1))
    prev = {k: spark.conf.get(k, None) for k in keys}
    try:
        s = build_session(input_bytes=100 << 30)  # the running session, resized for 100 GB
        cores = s.sparkContext.defaultParallelism
        assert int(s.conf.get("spark.sql.shuffle.partitions")) == max(2 * cores, 256)
        assert s.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    finally:
        for k, v in prev.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
