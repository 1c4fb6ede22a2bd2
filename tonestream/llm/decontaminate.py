"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows, met by every window of the corpus.

Method (DataFrame and SQL functions only): items become windows of ``size`` consecutive normalised words
(an item of fewer words is one window). The 64-bit hashes of the distinct windows are a broadcast set as long
as there are at most ``SET_ROWS``; beyond that the same semi join shuffles. Every position of every whole text hashes its
window, for each length that the benchmark has, inside one scan; a hit takes its words along and is
verified by comparing them with the benchmark's. What is found for a text is kept under the text's 128-bit hash,
so copies are answered once, and spans of hit words or whole documents are removed from there.

What moves: hits only. Positions without a hit never leave their task, and neither do texts. Items are told from windows through
classes of windows that the same items share, once for each distinct set of classes, so a window that a
third of all items or documents hold costs one row for each distinct text.

Defined results:

* null text has no words, in documents and in items; it neither hits nor is hit;
* a null ``item_id`` hits like any other and is listed as the empty string; items that repeat an id are one item;
* null and repeated document ids: every row is answered by its own text;
* a text that is one long word, or very long, is scanned whole; empty tables give empty results, an empty benchmark hits nothing;
* other columns, whatever their names, pass through ``remove_spans`` and ``drop_documents`` unchanged and aren't read by ``annotate``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonestream.llm.common import ascii_lower, fresh, materialize, text_or_empty
from tonestream.operators.joins import sized_join

#: A word of a lower-cased text: a run of 0-9, a-z and anything beyond ASCII. Java takes some
#: twenty times as long over the same class written as what a word isn't.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
#: The same before A-Z are lower-cased, and what stands between such words.
RAW_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
SIZE = 10
#: Hashes that are broadcast at most: about 40 bytes each in Spark's hash relation.
SET_ROWS = 1 << 20
#: Bytes of a row of windows or flags, for the bound of the joins that verify and answer.
WINDOW_BYTES, FLAG_BYTES = 256, 160


def _words(text_col: str) -> Column:
    return F.regexp_extract_all(ascii_lower(text_or_empty(text_col)), F.lit(WORD), F.lit(0))


def _text_key(text_col: str) -> Column:
    return F.unhex(F.md5(text_or_empty(text_col)))


def windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", size: int = SIZE) -> DataFrame:
    """The distinct windows of all items: ``item, gram`` (an array of words)."""
    words = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), _words(text_col).alias("w"))
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1))))
    return words.select("item", "w", at.alias("at")).select("item", F.slice("w", F.col("at"), size).alias("gram")).where(F.size("gram") > 0).distinct()


def _classes(benchmark: DataFrame, id_col: str, text_col: str, size: int) -> tuple[DataFrame, DataFrame]:
    """``h, gram, class`` of the distinct windows, and ``class, items`` of each set of items that share some."""
    shared = windows(benchmark, id_col, text_col, size).groupBy("gram").agg(F.sort_array(F.collect_set("item")).alias("items"))
    named = shared.withColumn("class", F.unhex(F.md5(F.to_json("items"))))
    grams = materialize(named.select(F.xxhash64("gram").alias("h"), "gram", "class", "items"), "grams")
    return grams.select("h", "gram", "class"), grams.select("class", "items").dropDuplicates(["class"])


def flagged(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
            size: int = SIZE, set_rows: int = SET_ROWS) -> tuple[DataFrame, int]:
    """Of each distinct text with a hit: ``key, n_hit, spans, items``; and how many such texts there are.

    ``key`` is the text's MD5, ``spans`` are the maximal runs of hit words (``start, stop``, word numbers from 0).
    """
    grams, classes = _classes(benchmark, item_id, item_text, size)
    counts = {r["n"]: r["rows"] for r in grams.groupBy(F.size("gram").alias("n")).agg(F.count(F.lit(1)).alias("rows")).collect()}  # at most ``size`` rows
    total = sum(counts.values())
    words = df.select(_text_key(text_col).alias("key"), _words(text_col).alias("w"))
    at = words.select("key", "w", F.posexplode_outer("w").alias("at", "word"))
    here = lambda n: F.slice("w", F.col("at") + 1, n)
    # slice() of the last positions is shorter than n and so is the hash of another length's window: verified below
    each = [F.struct(F.lit(n).alias("n"), F.xxhash64(here(n)).alias("h")) for n in sorted(counts)] or [F.lit(None).cast("struct<n: int, h: bigint>")]
    probe = at.where("at is not null").select("key", "w", "at", F.explode_outer(F.array(*each)).alias("p")).select("key", "w", "at", "p.n", "p.h")
    hashes = grams.select("h").distinct()
    met = probe.join(F.broadcast(hashes) if total <= set_rows else hashes, "h", "left_semi")
    met = met.select("h", "key", "at", F.slice("w", F.col("at") + 1, F.col("n")).alias("gram"))
    hits = sized_join(met, grams, ["h", "gram"], known_bytes=total * WINDOW_BYTES).select("key", "at", F.size("gram").alias("n"), "class")
    hits = materialize(hits.distinct(), "hits")

    # runs of hit words: a hit that begins beyond all before it opens a new one
    order = Window.partitionBy("key").orderBy("at", "n")
    before = F.max(F.col("at") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = hits.select("key", "at", "n").distinct().withColumn("new", F.coalesce(F.col("at") > before, F.lit(True)).cast("int"))
    runs = opened.withColumn("run", F.sum("new").over(order)).groupBy("key", "run").agg(
        F.min("at").alias("start"), F.max(F.col("at") + F.col("n")).alias("stop"))
    spans = runs.groupBy("key").agg(F.sum(F.col("stop") - F.col("start")).cast("long").alias("n_hit"),
                                    F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))

    # the items of each distinct set of classes
    sets = hits.groupBy("key").agg(F.array_sort(F.collect_set("class")).alias("classes"))
    sets = materialize(sets.withColumn("set", F.unhex(F.md5(F.array_join(F.transform("classes", F.hex), "")))), "sets")
    members = sets.dropDuplicates(["set"]).select("set", F.explode("classes").alias("class"))
    lists = members.join(classes, "class").select("set", F.explode("items").alias("item")).distinct().groupBy("set").agg(
        F.array_sort(F.collect_list("item")).alias("items"))
    found = materialize(spans.join(sets.select("key", "set").join(materialize(lists, "lists"), "set"), "key").drop("set"), "flagged")
    return found, found.count()


def _with_flags(df: DataFrame, rows: DataFrame, found: tuple[DataFrame, int]) -> DataFrame:
    flags, n = found
    return sized_join(rows, flags, "key", "left", known_bytes=n * FLAG_BYTES)


def annotate(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: ``id_col, n_words, n_hit, spans, items`` (sorted ids of the items with occurring windows), ``contaminated``."""
    found = flagged(df, benchmark, text_col, **options)
    rows = df.select(F.col(id_col).alias("id"), _text_key(text_col).alias("key"),
                     F.regexp_count(text_or_empty(text_col), F.lit(RAW_WORD)).cast("long").alias("n_words"))
    return _with_flags(df, rows, found).select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("spans", F.array().cast(
            "array<struct<start: int, stop: int>>")).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        F.col("n_hit").isNotNull().alias("contaminated"))


def drop_documents(df: DataFrame, benchmark: DataFrame, text_col: str = "text", least_hit: int = 1, **options) -> DataFrame:
    """The rows with fewer than ``least_hit`` hit words, with all their columns."""
    found = flagged(df, benchmark, text_col, **options)
    (row,) = fresh(df, "row")
    rows = df.select(F.struct("*").alias(row), _text_key(text_col).alias("key"))
    return _with_flags(df, rows, found).where(F.coalesce("n_hit", F.lit(0)) < least_hit).select(f"{row}.*")


def remove_spans(df: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """All rows, their texts without the hit words and what stands directly before each of them."""
    found = flagged(df, benchmark, text_col, **options)
    (row,) = fresh(df, "row")
    rows = df.select(F.struct("*").alias(row), _text_key(text_col).alias("key"))
    text = F.col(f"{row}.`{text_col}`")
    # each word with what stands before it; cut between the spans, so the work follows the text's length
    units = F.regexp_extract_all(text, F.lit(BETWEEN + RAW_WORD), F.lit(0))
    from_ = F.concat(F.array(F.lit(0)), F.col("spans.stop"))
    kept = lambda u: F.array_join(F.flatten(F.zip_with(
        from_, F.concat(F.col("spans.start"), F.array(F.size(u))), lambda a, b: F.slice(u, a + 1, b - a))), "")
    cut = F.concat(F.transform(F.array(units), kept)[0], F.regexp_extract(text, f"({BETWEEN})\\z", 1))
    text = F.when(F.col("n_hit").isNull(), text).otherwise(cut)
    return _with_flags(df, rows, found).select(F.col(row).withField(f"`{text_col}`", text).alias(row)).select(f"{row}.*")
