"""File and message sinks: Parquet / CSV tables, metrics JSON, Kafka publish."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tonestream.functions.messages import encode_message
from tonestream.sources.labelled import CSV_OPTIONS
from tonestream.sources.metrics_json import report_struct


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                header: bool = True, encoding: str = "UTF-8") -> str:
    """Write a table; CSV with quoting that keeps quotes, newlines and backslashes."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.options(**CSV_OPTIONS).option("header", header).option("encoding", encoding).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def materialize(df: DataFrame, name: str, scratch: list[str] | None = None) -> DataFrame:
    """Write ``df`` as Parquet to a fresh folder under the shared checkpoint
    folder and read it back: the lineage is cut (a lost executor recomputes
    nothing upstream) and later jobs read the stored columns instead of
    re-running the plan. The folder is removed when the session's JVM ends,
    or earlier by a caller that has it added to ``scratch``."""
    from tonestream.session import shared_path

    path = shared_path(df.sparkSession, name)
    remove_at_exit(df.sparkSession, path)
    if scratch is not None:
        scratch.append(path)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)  # no job to infer it


def _folder(spark, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def remove_at_exit(spark, path: str) -> None:
    """Have a scratch folder removed when the driver's JVM ends, whatever its file system."""
    files, place = _folder(spark, path)
    files.deleteOnExit(place)


def remove_folders(spark, paths: list[str]) -> None:
    """Remove folders that nothing reads any more, and forget them."""
    while paths:
        files, place = _folder(spark, paths.pop())
        files.delete(place, True)


def write_metrics_json(report: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a long report (``class, precision, recall, f1, support``) as one JSON
    object ``{accuracy, classification_report: {0, 1, accuracy, macro avg,
    weighted avg}}``. The report has five rows, so the fold is one small task."""
    report_struct(report).coalesce(1).write.mode(mode).json(path)
    return path


def publish_kafka(df: DataFrame, topic: str, bootstrap: str = "localhost:9092", text_col: str = "text") -> None:
    """Publish ``{"text": ...}`` messages to a topic (needs the Kafka connector)."""
    try:
        (kafka_sink_frame(df, text_col)
           .write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("topic", topic).save())
    except Exception as e:
        if "kafka" in str(e).lower() and "data source" in str(e).lower():
            raise RuntimeError("Kafka sink unavailable: add the spark-sql-kafka connector to the session") from e
        raise


def publish_kafka_stream(df: DataFrame, topic: str, checkpoint: str, bootstrap: str = "localhost:9092", text_col: str = "text"):
    """Publish a stream of texts as ``{"text": ...}`` messages (needs the Kafka connector)."""
    return (kafka_sink_frame(df, text_col).writeStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
            .option("topic", topic).option("checkpointLocation", checkpoint).start())


def kafka_sink_frame(df: DataFrame, text_col: str = "text") -> DataFrame:
    """The frame a Kafka sink receives: one ``value`` column of JSON text."""
    return df.select(encode_message(text_col).alias("value"))


def display_frame(df: DataFrame, text_col: str = "clean_text") -> DataFrame:
    """One ``display_line`` per scored row, for console or log sinks."""
    from tonestream.functions.labels import display_line

    has_p = "p_neg" in df.columns and "p_pos" in df.columns
    line = display_line(text_col, "pred", "p_neg" if has_p else None, "p_pos" if has_p else None)
    return df.select(line.alias("display_line"))


__all__ = ["write_table", "materialize", "write_metrics_json", "publish_kafka", "publish_kafka_stream", "kafka_sink_frame", "display_frame"]
