"""tonestream: Spark-native text sentiment classification on tables and streams.

DataFrame in, DataFrame out. Cleaning, JSON decoding, metrics and the relational
TF-IDF / Naive Bayes forms are built-in Column expressions and aggregations; the
model stages are Spark ML; streams are Structured Streaming.
"""

from tonestream.session import build_session, recommended_conf, shared_path

__all__ = ["build_session", "recommended_conf", "shared_path"]
