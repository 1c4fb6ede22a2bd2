"""Removal of long byte strings that occur more than once, by bucket-pointer refinement.

Every byte that lies in a string of ``WINDOW`` bytes which also starts anywhere else is
removed. A window is a window start; the work is to tell which window starts share their bytes.

Method:

1. Initial buckets are q-grams. Of the q-grams inside a window, the one with the smallest hash is its
   anchor (the leftmost among equals), so equal windows have equal anchors at equal offsets. An
   anchor stands for the run of window starts that choose it; about one byte in a
   hundred is an anchor, as all suffixes of a corpus can't be shuffled. Windows can only be equal within a bucket, and a
   bucket with one occurrence is done.
2. A bucket is split once by a hash of what stands before and behind the anchor, as far as its
   windows reach. Occurrences that agree in all of it are one class: of two or more, every window
   repeats. Copies of documents and the inside of long passages end here, as counts.
3. What is left, one representative of each class of a bucket with several, is refined. The bytes around the
   anchor are fetched; a task takes many small buckets at once. All their positions start in the buckets of their q-grams. A round
   sorts the positions that undecided windows hold by the pair (bucket here, bucket at the offset of the buckets' length): equal pairs are the
   new buckets, twice as long, and the next round reuses them at its own, larger offset. A position alone in its bucket decides
   all windows that hold it. After the last round, whose offset ends the window, the windows left repeat. Buckets of more than ``BUCKET``
   bytes are settled by a shuffle on hashes of their windows instead, with counts combined on the map side.
4. The classes' repeated window starts go back to the documents over narrow keys.

Q-grams and classes are told apart by independent 64-bit hashes. Nothing grows with the
number of occurrences of a string: repeated rows inside a document are collapsed before the shuffle. What a
join meets is written first, so that AQE can split the rows of a hot bucket.

Defined results: null text counts as empty; texts shorter than a window lose nothing; rows that repeat id and text are each
a place where their strings start; empty tables give empty results; other columns aren't read. Matches never cross rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonestream.llm.byte_hash import FIRST, SECOND, Ranges, mix
from tonestream.llm.common import materialize, small_batches, text_or_empty

WINDOW, GRAM = 400, 64
#: Most bytes of a bucket that one task sorts, at some 80 bytes of memory each.
BUCKET = 6_000_000
#: Window starts of a text, and bytes of contexts, that are looked at together.
SLICE, STEP = 1 << 18, 1 << 21


def anchors(text: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """``(bucket, class, first, last, place)`` of every anchor: the window starts first to
    last choose the q-gram at place. Runs are cut at multiples of ``SLICE``."""
    out = []
    for a in range(0, max(0, len(text) - window + 1), SLICE):
        part = text[a:a + SLICE + window - 1]
        n, inside = len(part) - window + 1, window - gram + 1
        grams = np.arange(len(part) - gram + 1)
        hashed = Ranges(part, FIRST).hash(grams, grams + gram)
        # the smallest 40 bits of hash, then the leftmost place, of each window by doubling
        least, span = (hashed >> np.uint64(24) << np.uint64(24)) | grams.astype(np.uint64), 1
        while 2 * span <= inside:
            least, span = np.minimum(least[:-span], least[span:]), 2 * span
        if rest := inside - span:
            least = np.minimum(least[:-rest], least[rest:])
        chosen = (least & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
        last = np.r_[first[1:], n] - 1
        place = chosen[first]
        around = Ranges(part, SECOND).hash(first, last + window)
        kind = mix(around ^ mix(((place - first) * window + last - first).astype(np.uint64)))
        out.append((hashed[place].view(np.int64), kind.view(np.int64), first + a, last + a, place + a))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    for t in column.to_pylist():
        yield np.frombuffer(t.encode() if t else b"", np.uint8)


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return df.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("k"), text.alias("text"))


def _anchor_rows(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """``id, k, h, c, first, span, n``: a row for each class of a document, with its first place; n is 1, or 2 for more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owner, found = [], []
            for row, text in enumerate(_texts(batch.column(2))):
                h, c, first, last, _ = anchors(text, window, gram)
                if len(h):
                    _, at, times = np.unique(np.stack([h, c], axis=1), axis=0, return_index=True, return_counts=True)
                    owner.append(np.full(len(at), row))
                    found.append((h[at], c[at], first[at], (last - first)[at], np.minimum(times, 2)))
            if owner:
                at = pa.array(np.concatenate(owner))
                h, c, first, span, n = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(at), batch.column(1).take(at), pa.array(h), pa.array(c), pa.array(first),
                     pa.array(span.astype(np.int32)), pa.array(n.astype(np.int32))], names=["id", "k", "h", "c", "first", "span", "n"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.where(F.octet_length("text") >= window).mapInArrow(
        run, f"id {kind}, k long, h long, c long, first long, span int, n int")


def _runs(flags: np.ndarray) -> list[int]:
    """First and last place of every run of true values."""
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    edge[1::2] -= 1
    return edge.tolist()


def _window_ids(contexts: list[bytes], buckets: np.ndarray, spans: np.ndarray, window: int) -> np.ndarray:
    """Identifiers of all windows of the contexts, one after the other."""
    out, a = [], 0
    sizes = np.array([len(c) for c in contexts])
    while a < len(contexts):
        b = max(a + 1, int(np.searchsorted(np.cumsum(sizes[a:]), STEP, side="right")) + a)
        ranges = Ranges(np.frombuffer(b"".join(contexts[a:b]), np.uint8), SECOND)
        many = spans[a:b] + 1
        base = np.cumsum(sizes[a:b]) - sizes[a:b]
        starts = np.arange(many.sum()) + np.repeat(base - (np.cumsum(many) - many), many)
        out.append(ranges.hash(starts, starts + window) ^ np.repeat(mix(buckets[a:b].view(np.uint64)), many))
        a = b
    return np.concatenate(out)


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key a bucket number, equal for equal keys, and whether it is alone in its bucket."""
    order = np.argsort(keys)
    in_order = keys[order]
    new = np.ones(len(keys) + 1, bool)
    new[1:-1] = in_order[1:] != in_order[:-1]
    names, alone = np.empty(len(keys), np.int64), np.empty(len(keys), bool)
    names[order], alone[order] = np.cumsum(new[:-1]) - 1, new[:-1] & new[1:]
    return names, alone


def _covered(starts: np.ndarray, reach: int, size: int) -> np.ndarray:
    """The positions from each start to ``reach`` behind it, in order."""
    edge = np.zeros(size + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + reach + 1, -1)
    return np.flatnonzero(np.cumsum(edge[:-1]) > 0)


def repeated_windows(contexts: list[bytes], spans: np.ndarray, window: int, gram: int = GRAM) -> np.ndarray:
    """Which windows (``span + 1`` of each context, one after the other) occur again among them."""
    sizes = np.array([len(c) for c in contexts], np.int64)
    base, size, many = np.cumsum(sizes) - sizes, int(sizes.sum()), spans + 1
    starts = np.arange(int(many.sum())) + np.repeat(base - (np.cumsum(many) - many), many)
    long = min(gram, window)
    at = _covered(starts, window - long, size)
    pointer = np.full(size, -1, np.int64)
    pointer[at], alone = _named(Ranges(np.frombuffer(b"".join(contexts), np.uint8), SECOND).hash(at, at + long))
    undecided = starts
    while True:
        # a window that holds a position alone in its bucket is decided: nothing else has its bytes
        lone = np.zeros(size + 1, np.int32)
        lone[at + 1] = alone
        lone = np.cumsum(lone)
        undecided = undecided[lone[undecided + window - long + 1] == lone[undecided]]
        if long == window:
            break
        step = min(long, window - long)
        at = _covered(undecided, window - long - step, size)
        pointer[at], alone = _named(pointer[at] << 32 | pointer[at + step])
        long += step
    flags = np.zeros(size, bool)
    flags[undecided] = True
    return flags[starts]


def _refine(contexts: DataFrame, window: int, gram: int) -> DataFrame:
    """``h, c, runs`` of the classes whose windows repeat elsewhere in their bucket."""

    def settle(rows: list[tuple]) -> pa.RecordBatch:
        h, c, once, span, raw = (list(x) for x in zip(*rows, strict=True))
        spans = np.array(span, np.int64)
        flags = repeated_windows(raw, spans, window, gram)
        ends = np.cumsum(spans + 1)
        found = [(h[i], c[i], r) for i in range(len(h)) if once[i] and (r := _runs(flags[ends[i] - spans[i] - 1:ends[i]]))]
        cols = [list(x) for x in zip(*found, strict=True)] if found else [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
                                           pa.array(cols[2], pa.list_(pa.int32()))], names=["h", "c", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0  # rows come sorted by bucket; whole buckets are settled together
        for batch in batches:
            for row in zip(*(col.to_pylist() for col in batch.columns), strict=True):
                if size > STEP and row[0] != waiting[-1][0]:
                    yield settle(waiting)
                    waiting, size = [], 0
                waiting.append(row)
                size += len(row[4])
        if waiting:
            yield settle(waiting)

    near = contexts.where("not large").select("h", "c", "once", "span", "context")
    near = near.repartition("h").sortWithinPartitions("h")
    return near.mapInArrow(run, "h long, c long, runs array<int>")


def _refine_large(contexts: DataFrame, window: int) -> DataFrame:
    """The same for buckets that are too large for a task: windows are rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, c, once, span, raw = (col.to_pylist() for col in batch.columns)
            if h:
                spans = np.array(span, np.int64)
                ids = _window_ids(raw, np.array(h, np.int64), spans, window)
                row = np.repeat(np.arange(len(h)), spans + 1)
                at = np.arange(len(ids)) - np.repeat(np.cumsum(spans + 1) - spans - 1, spans + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(h, np.int64)[row]), pa.array(np.array(c, np.int64)[row]), pa.array(np.array(once, bool)[row]),
                     pa.array(ids.view(np.int64)), pa.array(at.astype(np.int32))], names=["h", "c", "once", "w", "at"])

    windows = materialize(contexts.where("large").select("h", "c", "once", "span", "context").mapInArrow(
        run, "h long, c long, once boolean, w long, at int"), "windows")
    twice = materialize(windows.groupBy("h", "w").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "w"), "twice")
    found = windows.where("once").join(twice, ["h", "w"]).groupBy("h", "c").agg(F.sort_array(F.collect_set("at")).alias("at"))
    return found.select("h", "c", F.flatten(F.transform("at", lambda x: F.array(x, x))).alias("runs"))


def _fetch(rows: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """``h, c, once, large, span, context`` for representatives ``id, k, h, c, first, span, once, large``."""
    lists = wanted.groupBy(F.col("id").alias("i"), F.col("k").alias("j")).agg(
        F.collect_list(F.struct("h", "c", "first", "span", "once", "large")).alias("list"))
    both = rows.join(lists, F.col("id").eqNullSafe(F.col("i")) & (F.col("k") == F.col("j"))).select("text", "list")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = batch.column(1)
            flat = items.flatten()
            lengths = np.diff(items.offsets.to_numpy())
            first, span = (flat.field(i).to_numpy() for i in (2, 3))
            pieces, at = [], 0
            for text, n in zip(_texts(batch.column(0)), lengths, strict=True):
                raw = memoryview(text)
                pieces += [bytes(raw[f:f + s + window]) for f, s in zip(first[at:at + n].tolist(), span[at:at + n].tolist(), strict=True)]
                at += n
            yield pa.RecordBatch.from_arrays(
                [flat.field(0), flat.field(1), flat.field(4), flat.field(5), flat.field(3), pa.array(pieces, pa.binary())],
                names=["h", "c", "once", "large", "span", "context"])

    return both.mapInArrow(run, "h long, c long, once boolean, large boolean, span int, context binary")


def removed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, gram: int = GRAM,
            bucket: int = BUCKET, keep_bytes: bool = False) -> DataFrame:
    """Per row: ``id_col, n_bytes, n_removed, n_spans, kept_sha256, spans`` (``spans``: first and
    last byte of each removed run), and with ``keep_bytes`` the bytes that stay as ``kept``."""
    small_batches(df.sparkSession)
    rows = _rows(df, id_col, text_col)
    found = _anchor_rows(rows, window, gram)
    # 1: buckets with more than one occurrence, and their anchors
    again = materialize(found.groupBy("h").agg(F.sum("n").alias("all")).where(F.col("all") > 1).select("h"), "again")
    live = materialize(found.join(again, "h"), "anchors")
    # 2: classes, and buckets that hold several
    classes = live.groupBy("h", "c").agg(F.sum("n").alias("n"), *[F.first(x).alias(x) for x in ("id", "k", "first", "span")])
    classes = materialize(classes, "classes")
    open_ = classes.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.sum(F.col("span") + window).alias("bytes"),
                                     F.max((F.col("n") == 1).cast("int")).alias("undecided")).where("m > 1 and undecided = 1")
    open_ = materialize(open_, "open")
    wanted = classes.join(open_.select("h", (F.col("bytes") > bucket).alias("large")), "h").withColumn("once", F.col("n") == 1)
    # 3: their windows
    contexts = _fetch(rows, wanted, window)
    whole = classes.where("n > 1").select("h", "c", F.array(F.lit(0), F.col("span")).alias("runs"))
    if open_.where(F.col("bytes") > bucket).isEmpty():
        repeats = whole.unionAll(_refine(contexts, window, gram))
    else:
        contexts = materialize(contexts, "contexts")
        repeats = whole.unionAll(_refine(contexts, window, gram)).unionAll(_refine_large(contexts, window))
    repeats = materialize(repeats, "repeats")
    # 4: back to the documents
    per_text = live.select("id", "k", "h", "c").join(repeats, ["h", "c"]).groupBy(F.col("id").alias("i"), F.col("k").alias("j")).agg(
        F.collect_list(F.struct("h", "c", "runs")).alias("list"))
    both = rows.join(per_text, F.col("id").eqNullSafe(F.col("i")) & (F.col("k") == F.col("j")), "left").select("id", "text", "list")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cut, spans, sha, kept = [], [], [], [], []
            for text, found in zip(_texts(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                gone = _gone(text, found, window, gram) if found else []
                stay, at = hashlib.sha256(), 0
                parts = []
                for a, b in zip(gone[::2], gone[1::2], strict=True):
                    parts.append(memoryview(text)[at:a])
                    at = b + 1
                parts.append(memoryview(text)[at:])
                for p in parts:
                    stay.update(p)
                n.append(len(text)), spans.append(gone), sha.append(stay.hexdigest())
                cut.append(len(text) - sum(map(len, parts)))
                if keep_bytes:
                    kept.append(b"".join(parts))
            cols = [batch.column(0), pa.array(n, pa.int64()), pa.array(cut, pa.int64()), pa.array([len(s) // 2 for s in spans], pa.int64()),
                    pa.array(sha, pa.string()), pa.array(spans, pa.list_(pa.int64()))]
            names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            if keep_bytes:
                cols.append(pa.array(kept, pa.binary()))
                names.append("kept")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = rows.schema["id"].dataType.simpleString()
    out = both.mapInArrow(run, f"id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>"
                          + ", kept binary" * keep_bytes)
    return out.withColumnRenamed("id", id_col)


def _gone(text: np.ndarray, found: list[dict], window: int, gram: int) -> list[int]:
    """First and last byte of each maximal removed run."""
    runs = {(f["h"], f["c"]): f["runs"] for f in found}
    h, c, first, _, _ = anchors(text, window, gram)
    starts = np.zeros(len(text) + 1, np.int32)
    for a, b, at in zip(h.tolist(), c.tolist(), first.tolist(), strict=True):
        for r, s in zip(*(iter(runs.get((a, b), ())),) * 2, strict=True):
            starts[at + r] += 1
            starts[min(at + s + window, len(text))] -= 1
    return _runs(np.cumsum(starts[:-1]) > 0)


__all__ = ["anchors", "removed"]
