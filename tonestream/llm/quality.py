"""Quality scores from compression.

Method: two zstandard dictionaries are built from chunks of good and of bad labelled
texts. A text is cut into chunks of ``CHUNK`` bytes, all of them, and each is compressed with
both. The compressed sizes per byte say which dictionary explains the text better; the normalised
difference (bad minus good), together with the size under the good dictionary (a text of
repetitions is small under either), goes through a logistic curve fitted to labelled texts that the
dictionaries haven't seen, so the score is a calibrated probability of label 1.

The fit uses a bounded sample of the labelled rows, chosen by a hash of the id: at
most ``SAMPLE_ROWS`` texts of each label for the dictionaries, as many again for the
curve, and about ``SAMPLE_CHUNKS`` chunks a dictionary. Rows of each label are
weighted by their number, so the curve keeps the labels' shares. Scoring reads every whole text.

Defined results: null text counts as empty; an empty text has the score of a text without any
evidence, the curve at zero; null labels are left out of the fit; with no rows of one label
all scores are the share of label 1 (one half without any labels); a null id is held out; rows that repeat are
scored each; an empty table gives an empty result; ``keep`` passes all columns
through, whatever their names.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tonestream.llm.common import fresh, materialize, small_batches, text_or_empty

CHUNK, LEVEL, DICTIONARY = 256, 3, 112 << 10
SAMPLE_ROWS, SAMPLE_CHUNKS = 3000, 32768
THRESHOLD = 0.3
FOLDS = 5


@dataclasses.dataclass
class Model:
    """Dictionaries of bad and good text, trained or raw, and the curve's weights."""

    bad: bytes
    good: bytes
    weights: tuple[float, float, float]

    def compressors(self) -> list:
        import zstandard

        made = []
        for raw in (self.bad, self.good):
            trained = raw[:4] == b"\x37\xa4\x30\xec"
            kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
            d = zstandard.ZstdCompressionDict(raw, dict_type=kind) if raw else None
            if d:
                d.precompute_compress(level=LEVEL)
            made.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False,
                                                 write_dict_id=False))
        return made


def features(text: bytes, compressors: list) -> tuple[float, float]:
    """(bad minus good, good) compressed bytes per byte, over all chunks."""
    if not text:
        return 0.0, 0.0
    view = memoryview(text)
    bad, good = (sum(len(c.compress(view[a:a + CHUNK])) for a in range(0, len(text), CHUNK)) for c in compressors)
    return (bad - good) / len(text), good / len(text)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-4) -> tuple[float, ...]:
    """Newton's method for a weighted logistic curve with a small ridge."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), slope)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(w.tolist())


def held_out(id_col: str) -> Column:
    """Whether a row is never learned from: crc32 of the id's text mod 5 is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def _dictionary(chunks: list[bytes]) -> bytes:
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY, chunks).as_bytes()
    except zstandard.ZstdError:  # too little text to select from: all of it is the dictionary
        return b"".join(chunks)[:DICTIONARY]


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> Model:
    """Fit to the labelled rows that aren't held out."""
    small_batches(docs.sparkSession)
    known = labels.where(~held_out(id_col)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where(
        "label in (0, 1)").distinct()
    known = known.withColumn("key", F.xxhash64("id")).withColumn("part", F.pmod(F.col("key"), F.lit(2)).cast("int"))
    found = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    ids = None
    for label in (0, 1):
        for part in (0, 1):
            some = known.where((F.col("label") == label) & (F.col("part") == part)).orderBy("key", "id").limit(SAMPLE_ROWS)
            ids = some if ids is None else ids.unionAll(some)
    # at most 4 * SAMPLE_ROWS ids: a proven bound for the broadcast
    sample = materialize(found.join(F.broadcast(ids), "id").select("label", "part", "key", "text"), "labelled")
    shares = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    counts = {(r["label"], r["part"]): r for r in sample.groupBy("label", "part").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).collect()}
    if any((label, part) not in counts for label in (0, 1) for part in (0, 1)):
        p = (shares.get(1, 0) + 0.5) / (sum(shares.values()) + 1)
        return Model(b"", b"", (0.0, 0.0, float(np.log(p / (1 - p)))))
    # one chunk in ``nth``, by position and id, so that a dictionary sees about SAMPLE_CHUNKS of them
    nth = {label: max(1, counts[label, 0]["bytes"] // CHUNK // SAMPLE_CHUNKS) for label in (0, 1)}

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_label, out = [], []
            for label, key, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                for k, a in enumerate(range(0, len(raw), CHUNK)):
                    if (k + key) % nth[label] == 0:
                        out_label.append(label)
                        out.append(raw[a:a + CHUNK])
            yield pa.RecordBatch.from_arrays([pa.array(out_label, pa.int32()), pa.array(out, pa.binary())], names=["label", "chunk"])

    parts: dict[int, list[bytes]] = {0: [], 1: []}
    for r in sample.where("part = 0").select("label", "key", "text").mapInArrow(chunks, "label int, chunk binary").collect():
        parts[r["label"]].append(bytes(r["chunk"]))  # bounded by SAMPLE_CHUNKS and the longest texts of the sample
    model = Model(*(_dictionary(sorted(parts[label])) for label in (0, 1)), (0.0, 0.0, 0.0))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = model.compressors()
        for batch in batches:
            f = [features(t.encode(), both) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([x[i] for x in f], pa.float64()) for i in (0, 1))],
                                             names=["label", "difference", "size"])

    rows = sorted(tuple(r) for r in sample.where("part = 1").select("label", "text").mapInArrow(
        measure, "label int, difference double, size double").collect())  # at most 2 * SAMPLE_ROWS numbers
    y, x = np.array([r[0] for r in rows]), np.array([r[1:] for r in rows])
    weight = np.array([shares[label] / counts[label, 1]["rows"] for label in y])
    model.weights = logistic(x, y, weight / weight.mean())
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``id_col, held_out, score, predicted``."""
    return _scored(docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text")), model).select(
        F.col("id").alias(id_col), held_out("id").alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _scored(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with their column ``text`` and a column ``score``, last."""
    small_batches(rows.sparkSession)
    at = rows.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = model.compressors()
        a, b, c = model.weights
        for batch in batches:
            f = np.array([features(t.encode(), both) for t in batch.column(at).to_pylist()]).reshape(-1, 2)
            scores = 1 / (1 + np.exp(-np.clip(f @ np.array([a, b]) + c, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=[*batch.schema.names, "score"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())]))


def keep(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns."""
    (row,) = fresh(docs, "row")
    scored = _scored(docs.select(F.struct("*").alias(row), text_or_empty(text_col).alias("text")), model)
    return scored.where(F.col("score") >= threshold).select(f"{row}.*")
