"""Structured Streaming: message sources, decoding with quarantine, scoring.

Stateless end to end: parse, clean and score with a fitted pipeline, or with a
relational model that fits a packed row, are per-row projections, so such a micro-batch is a map-only job that
writes its result and nothing else. Only a relational model beyond that bound is joined
inside each batch (``foreachBatch``). Progress lives in the
checkpoint folder (the source offsets and the sink's commit log), which is what
replaces consumer auto-commit; a restarted query resumes from its last
committed batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tonestream.functions.clean import clean_v2
from tonestream.functions.messages import decode_messages
from tonestream.operators.joins import BROADCAST_BYTES
from tonestream.operators.scoring import score_table
from tonestream.sinks.files import remove_folders


def write_message_files(df: DataFrame, path: str, text_col: str = "text", key_cols: tuple[str, ...] = (),
                        value: Column | None = None) -> str:
    """Write ``(key..., value binary)`` message files that a file stream can replay, partitioned as the input is.

    ``value`` defaults to ``{"text": ...}`` JSON.
    """
    from tonestream.functions.messages import encode_message

    v = value if value is not None else encode_message(text_col)
    df.select(*key_cols, v.cast("binary").alias("value")).write.mode("errorifexists").parquet(path)
    return path


def message_stream(spark: SparkSession, path: str, schema: StructType | str,
                   max_files_per_trigger: int | None = None, fmt: str = "parquet") -> DataFrame:
    """Files as a stream. ``max_files_per_trigger`` cuts it into micro-batches of so many files."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def table_stream(spark: SparkSession, path: str, value: Column | None = None, text_col: str = "text",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A Parquet table as a stream of messages: its columns and ``value``, encoded in the plan."""
    from tonestream.functions.messages import encode_message

    schema = spark.read.parquet(path).schema
    # a pattern, as the table can be one file or a folder of files
    rows = message_stream(spark, f"{path.rstrip('/')}*", schema, max_files_per_trigger)
    return rows.withColumn("value", (encode_message(text_col) if value is None else value).cast("binary"))


def kafka_options(bootstrap: str = "localhost:9092", topic: str = "tweets", starting_offsets: str = "latest",
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Source options for the Kafka connector (bootstrap, topic, start, rate cap)."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting_offsets}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_stream(spark: SparkSession, **options) -> DataFrame:
    """``readStream.format("kafka")``; needs the spark-sql-kafka connector on the classpath."""
    try:
        return spark.readStream.format("kafka").options(**kafka_options(**options)).load()
    except Exception as e:  # connector missing
        raise RuntimeError("Kafka source unavailable: add the spark-sql-kafka connector to the session") from e


def decoded_stream(stream: DataFrame, value_col: str = "value", clean_first: bool = False) -> DataFrame:
    """Adds ``is_valid``, ``text`` and ``clean_text`` (``''`` for missing text)."""
    d = decode_messages(stream, value_col)
    clean = F.coalesce(clean_v2("text"), F.lit("")) if clean_first else F.coalesce(F.col("text"), F.lit(""))
    return d.withColumn("clean_text", F.when(F.col("is_valid"), clean))


def score_stream(stream: DataFrame, model: PipelineModel, clean_first: bool = False) -> DataFrame:
    """Score a streaming frame with a fitted pipeline (``model.transform`` is
    stateless, so it runs per micro-batch)."""
    return score_table(stream, model, clean_first)


def start_to_files(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet",
                   available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Append a stream to files with its own checkpoint (exactly-once file sink)."""
    w = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 second")
    return w.start(path)


def start_console(df: DataFrame, truncate: bool = False, processing_time: str = "1 second") -> StreamingQuery:
    """Console sink (development): append each micro-batch's rows."""
    return (df.writeStream.format("console").outputMode("append").option("truncate", str(truncate).lower())
            .trigger(processingTime=processing_time).start())


def start_foreach_batch(df: DataFrame, fn: Callable[[DataFrame], DataFrame], path: str, checkpoint: str,
                        fmt: str = "parquet", available_now: bool = True) -> StreamingQuery:
    """Run a batch function on every micro-batch and write its result.

    Each batch goes to ``path/batch_id=N`` in overwrite mode, so a batch
    replayed after a failure replaces its own output (idempotent).
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        fn(batch).write.mode("overwrite").format(fmt).save(f"{path}/batch_id={batch_id}")

    w = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def start_with_quarantine(df: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, quarantine_path: str,
                          checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Score the valid rows of a decoded stream and keep the others, from one pass over each micro-batch.

    The batch is persisted, so it is read and parsed once; both results go to
    ``batch_id=N`` folders in overwrite mode, so a replayed batch replaces its own output.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            score(batch.where("is_valid")).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            batch.where("not is_valid").write.mode("overwrite").parquet(f"{quarantine_path}/batch_id={batch_id}")
        finally:
            batch.unpersist()

    w = df.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start()


def start_table_model_scoring(df: DataFrame, model, id_cols: list[str], path: str, checkpoint: str,
                              text_col: str = "clean_text", keep: tuple[str, ...] = (),
                              available_now: bool = True, quarantine_path: str | None = None) -> StreamingQuery:
    """Score a stream with a relational model (``NaiveBayesTable``).

    The model is a table, so scoring is a join plus a per-message sum. Every
    message's words arrive in the same micro-batch, so the sum is complete
    within the batch: each batch is scored as a static frame and written to
    ``path/batch_id=N`` (idempotent on replay). Malformed messages of a decoded
    stream go to ``quarantine_path``, by default ``path`` with ``-quarantine``.
    """
    from tonestream.operators.features import split_words

    scratch: list[str] = []  # of a model that is joined; the batch before has been written when a batch is scored

    def score(batch: DataFrame) -> DataFrame:
        remove_folders(batch.sparkSession, scratch)
        b = batch.select(*dict.fromkeys((*id_cols, *keep, text_col)))
        out = model.transform(b, split_words(text_col), id_cols, scratch=scratch)
        return out.select(*id_cols, *keep, text_col, "prediction", "p_neg", "p_pos")

    if "is_valid" not in df.columns:
        return start_foreach_batch(df, score, path, checkpoint, available_now=available_now)
    return start_with_quarantine(df, score, path, quarantine_path or f"{path.rstrip('/')}-quarantine", checkpoint, available_now)


STATUS = ("scored", "quarantine")


def score_stream_with_table(stream: DataFrame, model, keep: tuple[str, ...] = (), text_col: str = "clean_text") -> DataFrame:
    """Score a decoded stream with a relational model inside the streaming plan.

    Every message comes out once: ``keep``, ``text_col``, ``prediction, p_neg, p_pos`` and
    ``status``, which is ``quarantine`` for malformed messages; those have null scores.
    """
    from tonestream.operators.features import split_words

    columns = [*dict.fromkeys((*keep, text_col))]
    scored = model.transform(stream.select(*columns, "is_valid"), split_words(text_col))
    return by_status(scored.select(*columns, "is_valid", "prediction", "p_neg", "p_pos"), ["prediction", "p_neg", "p_pos"])


def by_status(scored: DataFrame, results: list[str]) -> DataFrame:
    """``is_valid`` turned into ``status``; ``results`` are null where a message is malformed."""
    valid = F.coalesce(F.col("is_valid"), F.lit(False))
    return scored.withColumns({c: F.when(valid, F.col(c)) for c in results} | {
        "status": F.when(valid, STATUS[0]).otherwise(STATUS[1])}).drop("is_valid")


def start_table_model_by_status(stream: DataFrame, model, path: str, checkpoint: str, keep: tuple[str, ...] = (),
                                text_col: str = "clean_text", max_broadcast_bytes: int = BROADCAST_BYTES) -> StreamingQuery:
    """Score a decoded stream with a relational model into folders by ``status``, until its source is worked off.

    A model below the bound is part of the streaming plan. A larger one is joined with each micro-batch; what that
    writes in between is removed when the batch's result is written, to ``batch_id=N`` in overwrite mode.
    """
    from tonestream.operators.features import split_words

    if model.in_row(max_broadcast_bytes):
        return start_by_status(score_stream_with_table(stream, model, keep, text_col), path, checkpoint)
    columns = [*dict.fromkeys((*keep, text_col))]

    def run(batch: DataFrame, batch_id: int) -> None:
        scratch: list[str] = []
        scored = model.transform(batch.select(*columns, "is_valid"), split_words(text_col), max_broadcast_bytes=max_broadcast_bytes, scratch=scratch)
        scored = by_status(scored.select(*columns, "is_valid", "prediction", "p_neg", "p_pos"), ["prediction", "p_neg", "p_pos"])
        scored.write.mode("overwrite").partitionBy("status").parquet(f"{path}/batch_id={batch_id}")
        remove_folders(batch.sparkSession, scratch)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def start_by_status(df: DataFrame, path: str, checkpoint: str, available_now: bool = True, name: str | None = None) -> StreamingQuery:
    """One file sink for both results: a folder ``status=...`` each, committed together with the batch (exactly once).

    Nothing is persisted and no other folder is written, however many batches there are.
    """
    w = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).partitionBy("status")
    w = w.queryName(name) if name else w
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    return w.start(path)


def run_until_done(query: StreamingQuery) -> None:
    """Wait for an available-now query, however long it takes; raise its error if it failed."""
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def run_until_stopped(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Serve a continuous query until it stops, the timeout passes or the
    process is interrupted; then stop it cleanly (its checkpoint keeps the
    position, so the next start resumes there)."""
    try:
        if timeout_s is None:
            query.awaitTermination()
        else:
            query.awaitTermination(timeout_s)
    except KeyboardInterrupt:
        pass
    finally:
        if query.isActive:
            query.stop()
