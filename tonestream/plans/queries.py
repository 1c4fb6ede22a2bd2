"""The registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame.

Each one reads the given tables in full and composes the library's operators;
``tonestream.plans.oracle`` holds the DuckDB SQL for the same result where one
exists. Metric queries use a deterministic rule prediction (non-toxic ->
positive) so SQL can repeat them; model queries fit real models.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonestream.functions import clean, labels, messages
from tonestream.operators import features, metrics
from tonestream.operators.filters import drop_blank, require_not_empty, topic_filter, with_clean_text
from tonestream.operators.logistic import fit_logistic_table, penalised_gradient, train_logistic, vector_entries
from tonestream.operators.naive_bayes import fit_naive_bayes_ml, fit_naive_bayes_table
from tonestream.operators.scoring import model_input, require_columns, resolve_text_column, score_table, score_texts, with_labels
from tonestream.operators.split import hash_split, stratified_split
from tonestream.session import shared_path
from tonestream.sinks.files import materialize, write_metrics_json, write_table
from tonestream.sources.labelled import load_labelled, read_cleaned, read_to_score
from tonestream.sources.metrics_json import read_metrics_json
from tonestream.sources.tables import labelled_texts, read_table, rule_prediction
from tonestream.streaming import progress
from tonestream.streaming import scoring as stream

Query = Callable[[SparkSession, str], DataFrame]

SPLIT_FRAC = 0.8
P_DIGITS = 6


# --- shared building blocks ----------------------------------------------------


def cleaned_labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled texts cleaned with v2, null and blank texts dropped, hash split
    flag; written once to the shared folder (the cleaned training table), so
    fitting and scoring read it instead of re-running the cleaning."""
    t = labelled_texts(spark, sf).select("doc_id", "target", "text").dropna(subset=["doc_id", "target"])
    t = with_clean_text(t, clean.clean_v2("text")).drop("text")
    return materialize(hash_split(t, "doc_id", SPLIT_FRAC), "cleaned")


def nb_holdout_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Relational Naive Bayes fitted on the training side, scores on the holdout."""
    data = cleaned_labelled(spark, sf).withColumn("words", features.split_words("clean_text"))
    model = fit_naive_bayes_table(data.where("is_train"), "words")
    return model.transform(data.where(~F.col("is_train")), "words")


def table_scores(spark: SparkSession, sf: str, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``df`` cleaned and scored by the relational Naive Bayes of the training side, with labels; ``keep``: the columns callers read."""
    data = cleaned_labelled(spark, sf).withColumn("words", features.split_words("clean_text"))
    model = fit_naive_bayes_table(data.where("is_train"), "words")
    return with_labels(model.transform(model_input(df, clean_first=True), features.split_words("clean_text"), keep=keep))


def _round(c: str, digits: int = P_DIGITS):
    return F.round(F.col(c), digits).alias(c)


def _rule_scored(spark: SparkSession, sf: str) -> DataFrame:
    return rule_prediction(labelled_texts(spark, sf))


def _words_v2(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return docs.select("doc_id", clean.words(clean.letters_only(clean.strip_mentions(
        clean.strip_urls("text", "v2"))), 3).alias("words"))


# --- cleaning, filters, text functions -------------------------------------------


def q01_binarize_label(spark, sf):
    t = labelled_texts(spark, sf)
    return t.select("doc_id", "raw_label", labels.binarize_label("raw_label").alias("target"), "text")


def q02_clean_v1(spark, sf):
    return read_table(spark, sf, "documents", ["doc_id", "text"]).select("doc_id", clean.clean_v1("text").alias("clean_text"))


def q03_clean_v2(spark, sf):
    return read_table(spark, sf, "documents", ["doc_id", "text"]).select("doc_id", clean.clean_v2("text").alias("clean_text"))


def q41_clean_v2_spark_stop_words(spark, sf):
    """Cleaning with the stop words of the trainers' ``StopWordsRemover`` instead of NLTK's."""
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return docs.select("doc_id", clean.clean_v2("text", clean.STOP_WORDS).alias("clean_text"))


def q04_strip_urls(spark, sf):
    body = F.concat(F.col("url"), F.lit(" "), F.col("html"))
    return read_table(spark, sf, "pages", ["page_id", "url", "html"]).select(
        "page_id", clean.strip_urls(body, "v1").alias("stripped_v1"), clean.strip_urls(body, "v2").alias("stripped_v2"))


def q05_strip_mentions(spark, sf):
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    return docs.select("doc_id", clean.strip_mentions("text").alias("stripped"))


def q06_drop_blank_and_null(spark, sf):
    t = drop_blank(labelled_texts(spark, sf), "text").select("doc_id", "target", "text")
    t = t.dropna(subset=["doc_id", "target"])
    return with_clean_text(t, clean.clean_v2("text")).select("doc_id", "target", "clean_text")


def q07_clean_row_counts(spark, sf):
    t = labelled_texts(spark, sf).select("target", clean.clean_v2("text").alias("clean_text"))
    kept = F.col("target").isNotNull() & F.col("clean_text").isNotNull() & ~clean.is_blank("clean_text")
    return metrics.row_counts(t, kept)


def q08_topic_filter(spark, sf):
    docs = read_table(spark, sf, "documents", ["doc_id", "lang", "text"])
    return topic_filter(docs).select("doc_id", "lang", "text")


# Keywords that occur in the test prose, so the filter keeps rows there.
DATA_KEYWORDS = ("from", "he")


def q40_topic_filter_keywords(spark, sf):
    docs = read_table(spark, sf, "documents", ["doc_id", "lang", "text"])
    return topic_filter(docs, DATA_KEYWORDS).select("doc_id", "lang", "text")


def q09_snippet(spark, sf):
    conv = read_table(spark, sf, "conversations", ["conv_id", "turn", "text"])
    return conv.select("conv_id", "turn", clean.snippet("text", 120).alias("snippet"),
                       clean.snippet("text", 80).alias("snippet80"))


def q10_json_decode(spark, sf):
    ev = read_table(spark, sf, "events", ["event_id", "props"])
    parsed = messages.decode_declared("props", "k bigint")
    return ev.select("event_id", parsed["k"].alias("k"),
                     F.try_variant_get(messages.parsed_message("props"), "$.k", "string").alias("k_text"))


def q11_json_encode(spark, sf):
    conv = read_table(spark, sf, "conversations", ["conv_id", "turn", "text"])
    enc = conv.select("conv_id", "turn", "text", messages.encode_message("text").alias("value"))
    out = enc.select("conv_id", "turn", "text", messages.decode_declared("value")["text"].alias("text_out"))
    return out.select("conv_id", "turn", "text_out")


def q12_resolve_text_column(spark, sf):
    t = labelled_texts(spark, sf).select("doc_id", "target", "text")
    resolved = resolve_text_column(t)
    return model_input(t, text_col=resolved).select("doc_id", "target", "clean_text")


# --- labels, metrics, summaries --------------------------------------------------


def q13_label_names(spark, sf):
    s = _rule_scored(spark, sf)
    return s.select("doc_id", labels.prediction_int("prediction").alias("pred"),
                    labels.label_name(labels.prediction_int("prediction")).alias("sentiment"),
                    labels.label_name_strict("raw_label").alias("raw_sentiment"))


def q14_accuracy(spark, sf):
    return metrics.accuracy(_rule_scored(spark, sf))


def q15_class_report(spark, sf):
    return metrics.class_report(_rule_scored(spark, sf))


def q16_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(_rule_scored(spark, sf))


def q17_sentiment_distribution(spark, sf):
    return metrics.sentiment_distribution(with_labels(_rule_scored(spark, sf)))


def q18_scored_preview(spark, sf):
    return with_labels(_rule_scored(spark, sf)).orderBy("doc_id").limit(30)


def q19_display_line(spark, sf):
    # Every row is kept. The class probabilities are thousandths derived from the data, so
    # many lie next to a half hundredth, where rounding the decimal text and the binary value differ.
    s = _rule_scored(spark, sf).withColumn("p_pos", (F.col("n_chars") % 1001) / F.lit(1000.0))
    s = s.withColumn("p_neg", F.lit(1.0) - F.col("p_pos"))
    return s.select("doc_id", labels.display_line("text", "prediction", "p_neg", "p_pos").alias("display_line"))


def q20_evaluator_accuracy(spark, sf):
    # the evaluator's four metrics are lines of the report, which one aggregation gives
    report = metrics.class_report(_rule_scored(spark, sf))
    line = lambda name, of: F.max(F.when(F.col("class") == name, F.round(of, 10)))
    return report.agg(line("accuracy", "f1").alias("accuracy"), line("weighted avg", "precision").alias("weighted_precision"),
                      line("weighted avg", "recall").alias("weighted_recall"), line("weighted avg", "f1").alias("weighted_f1"))


def _three_classes(spark, sf):
    """Raw labels (0, 4) with a third class for toxic texts, and a prediction of all three."""
    t = labelled_texts(spark, sf)
    wrong = F.col("n_chars") % 5
    return t.select(F.when(F.col("toxic") == 1, 2).otherwise(F.col("raw_label")).alias("target"),
                    F.when(wrong == 0, 2.0).when(wrong == 1, 0.0).otherwise(F.col("raw_label").cast("double")).alias("prediction"))


def q45_report_of_three_classes(spark, sf):
    r = metrics.class_report(_three_classes(spark, sf))
    return r.select("class", *[F.round(c, 10).alias(c) for c in ("precision", "recall", "f1")], "support")


def q46_confusion_cells(spark, sf):
    return metrics.confusion_cells(_three_classes(spark, sf))


# --- features ----------------------------------------------------------------------


def q21_token_counts(spark, sf):
    from pyspark.ml.feature import StopWordsRemover, Tokenizer

    docs = read_table(spark, sf, "documents", ["doc_id", "text"]).select(
        "doc_id", F.coalesce(clean.letter_text("text"), F.lit("")).alias("letters"))
    tok = Tokenizer(inputCol="letters", outputCol="words").transform(docs)
    rem = StopWordsRemover(inputCol="words", outputCol="filtered", stopWords=list(clean.STOP_WORDS)).transform(tok)
    return rem.select("doc_id", F.size("words").alias("n_words"), F.size("filtered").alias("n_filtered"),
                      F.array_join("filtered", " ").alias("filtered_text"))


def q22_term_doc_frequency(spark, sf):
    return features.term_stats_of(_words_v2(spark, sf), F.col("words"))


def q23_tfidf_spark_weight(spark, sf):
    w = _words_v2(spark, sf)
    n_docs = w.agg(F.count(F.lit(1))).scalar()
    # The term table is map-only (counts by batch): the IDF aggregation and the
    # weight join each read it from the scan, which costs less than writing it.
    terms = features.doc_terms(w, "doc_id", F.col("words"))
    out = features.tfidf_spark(terms, "doc_id", n_docs)
    return out.select("doc_id", "term", "tf", "df", _round("idf"), _round("w"))


def q24_tfidf_sklearn_weight(spark, sf):
    w = _words_v2(spark, sf)
    # fitted from the one-shuffle term statistics; the weights are then found inside each document's row
    n_docs = read_table(spark, sf, "documents", ["doc_id"]).count()
    vocab = features.fit_vocabulary(features.term_stats_of(w, F.col("words"), bigrams=True), n_docs, 20000, 2)
    return features.tfidf_sklearn(w, "doc_id", F.col("words"), vocab, bigrams=True).select("doc_id", "term", "tf", _round("w"))


def q25_top_terms(spark, sf):
    w = _words_v2(spark, sf)
    return features.top_terms(features.term_stats_of(w, F.col("words"), bigrams=True), 20000, 2)


def q26_hashed_tfidf(spark, sf):
    from pyspark.ml import Pipeline

    docs = read_table(spark, sf, "documents", ["doc_id", "text"]).select(
        "doc_id", F.coalesce(clean.clean_v2("text"), F.lit("")).alias("clean_text"))
    # the IDF fit and the transform both read the cleaned texts: clean once
    docs = materialize(docs, "cleaned-docs")
    model = Pipeline(stages=features.hashed_tfidf_stages("clean_text", 10000)).fit(docs)
    # statistics on the stored sparse arrays, not a dense copy of 10,000 dimensions per row
    vecs = features.stored_vectors(model.transform(docs).select("doc_id", "features"), ["features"], "hashed-tfidf")
    return vecs.select("doc_id", features.vector_nnz(F.col("features")).alias("nnz"),
                       F.round(features.vector_sum(F.col("features")), P_DIGITS).alias("l1"))


def q51_hashed_weights(spark, sf):
    """Each document's buckets with their weights, in the form that Spark ML stores."""
    from pyspark.ml import Pipeline

    docs = materialize(read_table(spark, sf, "documents", ["doc_id", "text"]).select(
        "doc_id", F.coalesce(clean.clean_v2("text"), F.lit("")).alias("clean_text")), "cleaned-docs")
    model = Pipeline(stages=features.hashed_tfidf_stages("clean_text", 10000)).fit(docs)
    entries = model.transform(docs).select("doc_id", vector_entries("features").alias("e"))
    return features.explode_terms(entries, ["doc_id"], F.col("e")).select(
        "doc_id", F.col("term.j").alias("bucket"), F.round("term.x", P_DIGITS).alias("w"))


# --- splits and models ----------------------------------------------------------------


def q27_hash_split(spark, sf):
    return hash_split(labelled_texts(spark, sf), "doc_id", SPLIT_FRAC).select("doc_id", "target", "is_train")


def q28_stratified_split(spark, sf):
    t = labelled_texts(spark, sf).select("doc_id", "target")
    return stratified_split(t, "doc_id", "target", SPLIT_FRAC).select("doc_id", "target", "is_train")


def q29_naive_bayes_scores(spark, sf):
    s = nb_holdout_scores(spark, sf)
    return s.select("doc_id", "target", "prediction", _round("p_pos"))


def _lr_holdout(spark, sf, feats: str) -> DataFrame:
    data = cleaned_labelled(spark, sf)
    model = train_logistic(data.where("is_train"), features=feats)
    s = score_table(data.where(~F.col("is_train")), model)
    return s.select("doc_id", "target", "prediction", _round("p_pos"))


def q30_logistic_scores(spark, sf):
    return _lr_holdout(spark, sf, "hashed")


def q31_logistic_vocab_scores(spark, sf):
    """The penalised optimum is unique, so SQL finds the same probabilities by its own iteration."""
    data = cleaned_labelled(spark, sf)
    s = score_table(data.where(~F.col("is_train")), fit_logistic_table(data.where("is_train"), "vocab"))
    return s.select("doc_id", "target", "prediction", _round("p_pos"))


#: Weight of the loss against the penalty for raw hashed TF-IDF features, whose squares are large.
HASHED_C = 0.0001


def q52_logistic_hashed_penalised(spark, sf):
    """Hashed features with a penalty: SQL recomputes the buckets, the IDF and the optimum."""
    data = cleaned_labelled(spark, sf)
    s = score_table(data.where(~F.col("is_train")), fit_logistic_table(data.where("is_train"), "hashed", HASHED_C))
    return s.select("doc_id", "target", "prediction", _round("p_pos"))


def q50_logistic_gradient(spark, sf):
    """The loss gradient at the fitted coefficients, by joins and sums: each term of the vocabulary and the intercept (no term)."""
    train = cleaned_labelled(spark, sf).where("is_train")
    model = fit_logistic_table(train, "vocab")
    names = spark.createDataFrame(list(enumerate(model.features.stages[2].vocabulary)), "feature int, term string")  # bounded by the vocabulary's size
    g = penalised_gradient(train, model).join(names, "feature", "left")
    return g.select("term", (F.abs("gradient") < 1e-5).alias("stationary"))


def q53_logistic_certificate(spark, sf):
    """What the fit says of itself: rows, and whether it came within its bound of the optimum in few passes."""
    train = cleaned_labelled(spark, sf).where("is_train")
    row = fit_logistic_table(train, "vocab").fit.certificate(spark)
    return row.select("n_rows", (F.col("passes") <= 25).alias("few_passes"), (F.col("gradient") <= 1e-8 * F.col("gradient_at_zero")).alias("at_optimum"))


# --- streams ---------------------------------------------------------------------------


def _conversation_stream(spark, sf, value=None, clean_first=False):
    """The conversations table itself as a stream of messages, decoded again."""
    live = stream.table_stream(spark, f"{sf.rstrip('/')}/conversations.parquet", value)
    return stream.decoded_stream(live.select("conv_id", "turn", "role", "value"), clean_first=clean_first)


def _with_quarantined(spark, scored, bad_out, columns):
    """Scored messages and, with nulls for all but their ids, the quarantined ones."""
    types = dict(scored.dtypes)
    bad = spark.read.parquet(bad_out).select("conv_id", "turn", *[F.lit(None).cast(types[c]).alias(c) for c in columns])
    return scored.select("conv_id", "turn", *columns).unionByName(bad)


def _scored_by_status(done, columns):
    """Scored messages and, with nulls for all but their ids, the quarantined ones."""
    ok = F.col("status") == stream.STATUS[0]
    return done.select("conv_id", "turn", *[F.when(ok, F.col(c)).alias(c) for c in columns])


def _table_model_stream(spark, sf, value, keep=()):
    """All messages scored by the relational Naive Bayes model."""
    data = cleaned_labelled(spark, sf).withColumn("words", features.split_words("clean_text"))
    model = fit_naive_bayes_table(data.where("is_train"), "words")
    live = _conversation_stream(spark, sf, value, clean_first=True)
    out = shared_path(spark, "stream-out")
    stream.run_until_done(stream.start_table_model_by_status(live, model, out, shared_path(spark, "stream-ckpt"), ("conv_id", "turn", *keep)))
    return spark.read.parquet(out)


def q32_stream_clean_score(spark, sf, value=None):
    scored = _table_model_stream(spark, sf, value).withColumn("p_pos", _round("p_pos"))
    return _scored_by_status(scored, ["clean_text", "prediction", "p_pos"])


def q33_stream_quarantine(spark, sf):
    live = _conversation_stream(spark, sf, _broken_by_role())
    good_out, bad_out = shared_path(spark, "stream-good"), shared_path(spark, "stream-bad")
    stream.run_until_done(stream.start_with_quarantine(
        live, lambda good: good.select("conv_id", "turn", "text"), good_out, bad_out, shared_path(spark, "ckpt-quarantine")))
    ok = spark.read.parquet(good_out).select("conv_id", "turn", F.lit("ok").alias("status"), "text")
    quarantined = spark.read.parquet(bad_out).select("conv_id", "turn", F.lit("quarantine").alias("status"),
                                                     F.lit(None).cast("string").alias("text"))
    return ok.unionByName(quarantined)


def q38_stream_logistic_scores(spark, sf):
    """One message of ten is cut short; such messages come back without a score."""
    data = cleaned_labelled(spark, sf)
    model = train_logistic(data.where("is_train"), features="hashed")
    enc = messages.encode_message("text")
    value = F.when(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(10)) == 0, F.substring(enc, 1, 10)).otherwise(enc)
    live = _conversation_stream(spark, sf, value)
    out, bad_out = shared_path(spark, "stream-lr"), shared_path(spark, "stream-lr-bad")

    def score(good):
        scored = stream.score_stream(good.select("conv_id", "turn", "text"), model, clean_first=True)
        return scored.select("conv_id", "turn", "clean_text", "prediction", "p_pos")

    stream.run_until_done(stream.start_with_quarantine(live, score, out, bad_out, shared_path(spark, "ckpt-lr")))
    scored = spark.read.parquet(out).withColumn("p_pos", _round("p_pos"))
    return _with_quarantined(spark, scored, bad_out, ["clean_text", "prediction", "p_pos"])


def q42_stream_naive_bayes_ml(spark, sf, value=None):
    """A fitted Spark ML pipeline run on the stream itself (``model.transform`` inside the streaming plan)."""
    model = fit_naive_bayes_ml(cleaned_labelled(spark, sf).where("is_train"))
    live = _conversation_stream(spark, sf, value, clean_first=True)
    scored = stream.score_stream(live.select("conv_id", "turn", "clean_text", "is_valid"), model)
    scored = stream.by_status(scored.withColumn("p_pos", _round("p_pos")), ["prediction", "p_pos"])
    out = shared_path(spark, "stream-out")
    stream.run_until_done(stream.start_by_status(scored.select("conv_id", "turn", "clean_text", "prediction", "p_pos", "status"), out,
                                                 shared_path(spark, "stream-ckpt")))
    return _scored_by_status(spark.read.parquet(out), ["clean_text", "prediction", "p_pos"])


def q44_replay_display_lines(spark, sf, value=None):
    """Messages scored by a fitted model, one display line per message from its probabilities."""
    scored = _table_model_stream(spark, sf, value, keep=("text",))
    scored = scored.withColumn("display_line", labels.display_line("text", "prediction", "p_neg", "p_pos"))
    return _scored_by_status(scored, ["display_line"])


def _broken_by_role(text="text"):
    """Messages as q33 breaks them: users' are whole, assistants' have another field, others are cut short."""
    enc = messages.encode_message(text)
    return (F.when(F.col("role") == "user", enc).when(F.col("role") == "assistant", F.to_json(F.struct(F.col(text).alias("body"))))
            .otherwise(F.substring(enc, 1, 10)))


def q54_stream_resume(spark, sf):
    """Two runs over one checkpoint: files arrive between them, and the first run's last commit was lost, so its batch runs again."""
    conv = read_table(spark, sf, "conversations", ["conv_id", "turn", "text"])
    src, out, ckpt = shared_path(spark, "resume-in"), shared_path(spark, "resume-out"), shared_path(spark, "resume-ckpt")
    schema = "conv_id bigint, turn bigint, value binary"
    early = F.coalesce(F.pmod("turn", F.lit(2)) == 0, F.lit(True))
    for arrived, part in ((early, "1"), (~early, "2")):
        stream.write_message_files(conv.where(arrived).repartition(4), f"{src}/part={part}", key_cols=("conv_id", "turn"))
        live = stream.decoded_stream(stream.message_stream(spark, src, schema, max_files_per_trigger=2))
        stream.run_until_done(stream.start_foreach_batch(live, lambda b: b.select("conv_id", "turn", "text"), out, ckpt))
        if part == "1":
            progress.forget_last_commit(spark, ckpt)
    return spark.read.parquet(out).select("conv_id", "turn", "text")


def q55_stream_progress(spark, sf):
    """A served stream, stopped once it has worked off its messages: what its batches' events counted."""
    live = _conversation_stream(spark, sf, _broken_by_role())
    live = progress.observed(stream.by_status(live.select("conv_id", "turn", "text", "is_valid"), []))
    counts = progress.BatchCounts(shared_path(spark, "served").rsplit("/", 1)[-1])
    spark.streams.addListener(counts)
    try:
        query = stream.start_by_status(live, shared_path(spark, "served-out"), shared_path(spark, "served-ckpt"), False, name=counts.name)
        progress.stop_drained(query, counts)
    finally:
        spark.streams.removeListener(counts)
    return counts.totals_frame(spark)


def q56_score_texts(spark, sf):
    """A short list of texts scored at once, as the dashboard does: the first 30 documents (a preview's limit)."""
    model = fit_naive_bayes_ml(cleaned_labelled(spark, sf).where("is_train"))
    texts = [r.text for r in read_table(spark, sf, "documents", ["doc_id", "text"]).orderBy("doc_id").limit(30).collect()]
    s = score_texts(spark, model, texts, clean_first=True)
    return s.select("clean_text", "prediction", "sentiment", _round("p_pos"))


# --- sinks, save / load, report files ------------------------------------------------------


def q34_csv_round_trip(spark, sf):
    t = labelled_texts(spark, sf)
    raw = t.select(F.col("raw_label").alias("target"), F.col("doc_id").alias("id"), F.lit("").alias("date"),
                   F.lit("NO_QUERY").alias("flag"), F.col("source").alias("user"),
                   "text")
    p_raw, p_gen = shared_path(spark, "csv-raw"), shared_path(spark, "csv-generic")
    write_table(raw, p_raw, "csv", header=False, encoding="ISO-8859-1")
    write_table(t.select("target", "text"), p_gen, "csv", header=True)
    # the texts come back whole, line breaks too; only the answer shows these as spaces
    a = load_labelled(spark, p_raw, "auto", multi_line=True).select(
        F.lit("sentiment140").alias("layout"), "target", F.translate("text", "\r\n", "  ").alias("text"))
    b = load_labelled(spark, p_gen, "auto").select(F.lit("generic").alias("layout"), "target", "text")
    return a.unionByName(b)


def q57_csv_one_line_records(spark, sf):
    """The six-column file as it is read by default: many tasks share a file, a record is a line."""
    t = labelled_texts(spark, sf)
    raw = t.select(F.col("raw_label").alias("target"), F.col("doc_id").alias("id"), F.lit("").alias("date"), F.lit("NO_QUERY").alias("flag"),
                   F.col("source").alias("user"), F.translate("text", "\r\n", "  ").alias("text"))
    path = shared_path(spark, "csv-lines")
    write_table(raw, path, "csv", header=False, encoding="ISO-8859-1")
    return load_labelled(spark, path).select("target", "text")


def q35_model_save_load(spark, sf):
    from pyspark.ml import PipelineModel

    data = cleaned_labelled(spark, sf)
    model = train_logistic(data.where("is_train"), features="hashed")
    path = shared_path(spark, "lr-model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    test = data.where(~F.col("is_train"))
    a = score_table(test, model).select("doc_id", F.col("prediction").alias("before"), F.col("p_pos").alias("p_before"))
    b = score_table(test, loaded).select("doc_id", F.col("prediction").alias("after"), F.col("p_pos").alias("p_after"))
    # every holdout document with what both models say about it, in forms that SQL can check against each other
    differs = F.abs(F.col("p_before") - F.col("p_after"))
    return a.join(b, "doc_id", "full").select(
        "doc_id", differs.alias("differs"), (F.col("before") - F.col("after")).alias("label_differs"),
        (F.col("after") == (F.col("p_after") > 0.5).cast("double")).alias("label_follows_p"))


def q43_score_uploaded_csv(spark, sf):
    """The batch-scoring flow: a CSV of texts to score is read (all columns kept),
    scored with a fitted model after cleaning, exported as CSV, and summarized."""
    docs = read_table(spark, sf, "documents", ["doc_id", "text"])
    upload = shared_path(spark, "upload-csv")
    write_table(docs, upload, "csv", header=True)
    scored = table_scores(spark, sf, read_to_score(spark, upload), keep=["doc_id", "text"])
    export = shared_path(spark, "scored-csv")
    write_table(scored.select("doc_id", "text", "pred", "sentiment"), export, "csv", header=True)
    return metrics.sentiment_distribution(read_to_score(spark, export))


def q36_metrics_json(spark, sf):
    path = shared_path(spark, "metrics-json")
    write_metrics_json(metrics.class_report(_rule_scored(spark, sf)), path)
    return read_metrics_json(spark, path)


def q37_label_index(spark, sf):
    t = labelled_texts(spark, sf).select("doc_id", F.col("target").cast("string").alias("target_s"), "target")
    alpha = StringIndexer(inputCol="target_s", outputCol="idx_alpha", stringOrderType="alphabetAsc").fit(t)
    freq = StringIndexer(inputCol="target_s", outputCol="idx_freq", stringOrderType="frequencyDesc").fit(t)
    out = freq.transform(alpha.transform(t))
    return out.groupBy("target", "idx_alpha", "idx_freq").agg(F.count(F.lit(1)).alias("n"))


def q47_read_cleaned(spark, sf):
    """The cleaned training table written and read back in both of its forms."""
    t = with_clean_text(labelled_texts(spark, sf), clean.clean_v2("text")).select("target", "clean_text")
    p_csv, p_parquet = shared_path(spark, "cleaned-csv"), shared_path(spark, "cleaned-parquet")
    write_table(t, p_csv, "csv")
    write_table(t, p_parquet)
    return read_cleaned(spark, p_csv, "csv").withColumn("form", F.lit("csv")).unionByName(
        read_cleaned(spark, p_parquet).withColumn("form", F.lit("parquet")))


def q48_checked_scores(spark, sf):
    """Table checks, then a fitted model's names for the labelled texts: the row set and what must hold of every row."""
    t = require_not_empty(labelled_texts(spark, sf).select("doc_id", "text"))
    require_columns(t, ["doc_id", "text"])
    s = table_scores(spark, sf, t, keep=["doc_id"])
    named = F.when(F.col("pred") == 1, "Positive").otherwise("Negative")
    return s.select("doc_id", (F.col("sentiment") == named).alias("named"), F.col("p_pos").between(0, 1).alias("in_range"),
                    (F.abs(F.col("p_pos") + F.col("p_neg") - 1) < 1e-9).alias("sums_to_one"))


def q49_hashed_term_counts(spark, sf):
    """What a document's hashed term vector sums to: its number of words, whichever of them share a bucket."""
    from pyspark.ml import Pipeline

    docs = read_table(spark, sf, "documents", ["doc_id", "text"]).select(
        "doc_id", F.coalesce(clean.clean_v2("text"), F.lit("")).alias("clean_text"))
    stages = features.hashed_tfidf_stages("clean_text", 10000)[:-1]
    vecs = Pipeline(stages=stages).fit(docs).transform(docs).select("doc_id", "rawFeatures")
    vecs = features.stored_vectors(vecs, ["rawFeatures"], "hashed-tf")
    return vecs.select("doc_id", features.vector_sum(F.col("rawFeatures")).cast("bigint").alias("n_words"))


def q39_naive_bayes_ml(spark, sf):
    data = cleaned_labelled(spark, sf)
    model = fit_naive_bayes_ml(data.where("is_train"))
    s = with_labels(model.transform(data.where(~F.col("is_train"))))
    return s.select("doc_id", "target", "prediction", _round("p_pos"))


def flagship_distribution(spark, sf):
    """Labelled texts -> clean -> Naive Bayes on the training side -> holdout
    sentiment distribution."""
    return metrics.sentiment_distribution(with_labels(nb_holdout_scores(spark, sf)))


QUERIES: dict[str, Query] = {
    "q01_binarize_label": q01_binarize_label,
    "q02_clean_v1": q02_clean_v1,
    "q03_clean_v2": q03_clean_v2,
    "q04_strip_urls": q04_strip_urls,
    "q05_strip_mentions": q05_strip_mentions,
    "q06_drop_blank_and_null": q06_drop_blank_and_null,
    "q07_clean_row_counts": q07_clean_row_counts,
    "q08_topic_filter": q08_topic_filter,
    "q09_snippet": q09_snippet,
    "q10_json_decode": q10_json_decode,
    "q11_json_encode": q11_json_encode,
    "q12_resolve_text_column": q12_resolve_text_column,
    "q13_label_names": q13_label_names,
    "q14_accuracy": q14_accuracy,
    "q15_class_report": q15_class_report,
    "q16_confusion_matrix": q16_confusion_matrix,
    "q17_sentiment_distribution": q17_sentiment_distribution,
    "q18_scored_preview": q18_scored_preview,
    "q19_display_line": q19_display_line,
    "q20_evaluator_accuracy": q20_evaluator_accuracy,
    "q21_token_counts": q21_token_counts,
    "q22_term_doc_frequency": q22_term_doc_frequency,
    "q23_tfidf_spark_weight": q23_tfidf_spark_weight,
    "q24_tfidf_sklearn_weight": q24_tfidf_sklearn_weight,
    "q25_top_terms": q25_top_terms,
    "q26_hashed_tfidf": q26_hashed_tfidf,
    "q27_hash_split": q27_hash_split,
    "q28_stratified_split": q28_stratified_split,
    "q29_naive_bayes_scores": q29_naive_bayes_scores,
    "q30_logistic_scores": q30_logistic_scores,
    "q31_logistic_vocab_scores": q31_logistic_vocab_scores,
    "q32_stream_clean_score": q32_stream_clean_score,
    "q33_stream_quarantine": q33_stream_quarantine,
    "q34_csv_round_trip": q34_csv_round_trip,
    "q35_model_save_load": q35_model_save_load,
    "q36_metrics_json": q36_metrics_json,
    "q37_label_index": q37_label_index,
    "q38_stream_logistic_scores": q38_stream_logistic_scores,
    "q39_naive_bayes_ml": q39_naive_bayes_ml,
    "q40_topic_filter_keywords": q40_topic_filter_keywords,
    "q41_clean_v2_spark_stop_words": q41_clean_v2_spark_stop_words,
    "q42_stream_naive_bayes_ml": q42_stream_naive_bayes_ml,
    "q43_score_uploaded_csv": q43_score_uploaded_csv,
    "q44_replay_display_lines": q44_replay_display_lines,
    "q45_report_of_three_classes": q45_report_of_three_classes,
    "q46_confusion_cells": q46_confusion_cells,
    "q47_read_cleaned": q47_read_cleaned,
    "q48_checked_scores": q48_checked_scores,
    "q49_hashed_term_counts": q49_hashed_term_counts,
    "q50_logistic_gradient": q50_logistic_gradient,
    "q51_hashed_weights": q51_hashed_weights,
    "q52_logistic_hashed_penalised": q52_logistic_hashed_penalised,
    "q53_logistic_certificate": q53_logistic_certificate,
    "q54_stream_resume": q54_stream_resume,
    "q55_stream_progress": q55_stream_progress,
    "q56_score_texts": q56_score_texts,
    "q57_csv_one_line_records": q57_csv_one_line_records,
    "flagship_distribution": flagship_distribution,
}
