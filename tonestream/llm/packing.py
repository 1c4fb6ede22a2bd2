"""Packing tokenized documents into sequences: dominance reduction, then best fit.

Method (after Martello and Toth): lengths are integers up to the capacity, so the whole
instance is a histogram with at most ``capacity`` counts, however many documents there
are. On it, sets of lengths that provably dominate every alternative are fixed for good
and taken out:

* lengths that sum to the capacity exactly, in pairs;
* the largest length alone, where nothing else fits beside it;
* the largest length with the largest partner, where no two others fit beside it, or
  no three do and the partner is at least the best fitting pair;
* the largest length with the two largest partners, where no three fit beside it and no fitting pair
  has a larger second member.

This repeats until nothing more is fixed; the shrunk instance is packed by best fit, longest
first, again on the histogram. The plan is a table of runs: "documents of length w with
rank a to b go to sequences from s on, t in each, from offset o". Its size depends on
the capacity alone. Documents get their rank among equal lengths from counts by task
and length (narrow rows, no text), and look their place up in the plan.

Accepted tokenizers are byte-level BPE files with the normaliser and splitter named below (``NORMALIZERS``, ``SPLITTERS``);
others are an error.

Defined results: null text counts as empty and is one end token; only documents longer
than the capacity are cut, into whole capacities, the last piece may be shorter; rows that
repeat are packed each; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import struct
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonestream.llm.common import byte_letters, materialize, once_a_worker, small_batches

CAPACITY = 2048
END_ID = 0
#: Most words whose ids a worker keeps; beyond it the table starts anew.
TABLE_LIMIT = 1_000_000
#: White space on which libraries disagree, or that normalisers treat in ways of their own.
ODD = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: The pieces that the splitter makes of lower-case Latin-1 text (its letters, numbers and white space), and that lower case.
LATIN = re.compile(b"[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|'(?:[stmd]|re|ve|ll)"
                   b"|[^a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe\t-\r \x85\xa0]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 or 0xC0 <= c <= 0xDE and c != 0xD7 else c for c in range(256))
#: The normaliser and splitter that these rules, and cutting at white space, are for; fixed values.
NORMALIZERS = [("NFC", None), ("Replace", {"Regex": r"\s+"}), ("Lowercase", None)]
SPLITTERS = [("Split", {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}), ("ByteLevel", None)]
#: Characters of a text that are split together, cut at a space.
STRETCH = 1 << 20
#: Words longer than this aren't kept in the table.
LONG_WORD = 48


class WordIds:
    """Ids of texts for the tokenizer that lower-cases and drops white space: pieces are encoded once each.

    Latin-1 text is split as the tokenizer splits it. Other text is cut at white space, as each run in between is
    treated by itself; texts with unusual white space or special strings are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters, self.runs = byte_letters(), {}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [(spec[part] or {}).get(name) or [] for part, name in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))]
        if [[(x["type"], x.get("pattern")) for x in part] for part in steps] != [NORMALIZERS, SPLITTERS] or spec["post_processor"]:
            raise ValueError("ids are put together from words only for the normaliser and splitter whose rules LATIN and LOWER are")
        self.table: dict[str, bytes] = {}  # words

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _run(self, run: bytes) -> bytes:
        """Ids of a piece, given in lower-case Latin-1, straight from the merges."""
        if run not in self.runs:
            made = self.tokenizer.model.tokenize(run.decode("latin-1").encode().decode("latin-1").translate(self.letters))
            self.runs[run] = struct.pack(f"<{len(made)}I", *(t.id for t in made))
        return self.runs[run]

    def _latin(self, raw: bytes) -> bytes:
        found, runs, a = [], self.runs, 0
        while a < len(raw):
            b = raw.find(b" ", a + STRETCH)
            pieces = LATIN.findall(raw, a, len(raw) if b < 0 else b)
            ids = list(map(runs.get, pieces))
            if None in ids:
                if len(runs) > TABLE_LIMIT:
                    runs.clear()
                ids = list(map(self._run, pieces))
            found.append(b"".join(ids))
            a = len(raw) if b < 0 else b
        return b"".join(found)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the whole text."""
        if any(special in text for special in self.specials):
            return self._whole(text)
        try:
            return self._latin(text.encode("latin-1").translate(LOWER))
        except UnicodeEncodeError:  # other letters
            pass
        if ODD.search(text):
            return self._whole(text)
        words = text.split()
        found = list(map(self.table.get, words))
        if None in found:
            if len(self.table) > TABLE_LIMIT:
                self.table.clear()
            more = {w: self._whole(w) for w in dict.fromkeys(words) if w not in self.table}
            self.table.update((w, i) for w, i in more.items() if len(w) <= LONG_WORD)
            found = [more[w] if a is None else a for w, a in zip(words, found, strict=True)]
        return b"".join(found)


def pieces(df: DataFrame, path: str, id_col: str, text_col: str, capacity: int, keep_ids: bool) -> DataFrame:
    """``id, piece, start, length, ids_crc32, task, nth`` (and ``ids``): the cut documents.

    ``nth`` counts the pieces of a length within a task.
    """
    small_batches(df.sparkSession)
    end = struct.pack("<I", END_ID)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, task, seen = once_a_worker(f"words {path}", lambda: WordIds(path)), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            row, piece, start, length, crc, nth, raw = [], [], [], [], [], [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                ids = memoryview(words.ids(text or "") + end)
                for p, at in enumerate(range(0, len(ids) // 4, capacity)):
                    part = ids[4 * at:4 * (at + capacity)]
                    n = len(part) // 4
                    row.append(k), piece.append(p), start.append(at), length.append(n)
                    crc.append(zlib.crc32(part)), nth.append(seen[n])
                    if keep_ids:
                        raw.append(bytes(part))
                    seen[n] += 1
            cols = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(row), pa.int32()),
                    pa.array(nth, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32", "task", "nth"]
            if keep_ids:
                cols.append(pa.array(raw, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, piece int, start long, length long, ids_crc32 long, task int, nth long"
                           + ", ids binary" * keep_ids)


class Plan:
    """Runs (length, first rank, items, items a sequence, first sequence, first offset)."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.capacity, self.left = capacity, {w: n for w, n in counts.items() if n}
        self.rank: dict[int, int] = defaultdict(int)
        self.runs: list[tuple[int, int, int, int, int, int]] = []
        self.sequences = 0

    def place(self, w: int, items: int, each: int, sequence: int, offset: int) -> None:
        self.runs.append((w, self.rank[w], items, each, sequence, offset))
        self.rank[w] += items
        self.left[w] -= items
        if not self.left[w]:
            del self.left[w]

    def fix(self, lengths: list[int], times: int) -> None:
        """``times`` sequences of these lengths."""
        offset = 0
        for w in lengths:
            self.place(w, times, 1, self.sequences, offset)
            offset += w
        self.sequences += times

    def reduce(self) -> None:
        """Fix dominating sets until none is found."""
        for w in sorted(self.left, reverse=True):
            if 2 * w > self.capacity and (twin := self.capacity - w) in self.left:
                self.fix([w, twin], min(self.left[w], self.left[twin]))
        if (half := self.capacity / 2) in self.left and self.left[half] > 1:
            self.fix([int(half)] * 2, self.left[half] // 2)
        while self.left and (found := self._dominating()):
            self.fix(*found)

    def _dominating(self) -> tuple[list[int], int] | None:
        sizes = sorted(self.left)
        w = sizes[-1]
        room = self.capacity - w
        others = dict(self.left)
        others[w] -= 1
        sizes = [s for s in sizes if others[s]]
        cut = bisect.bisect_right(sizes, room)
        if not cut:
            return [w], self.left[w]
        fit = sizes[:cut]
        k = fit[-1]
        smallest = [s for s in fit[:3] for _ in range(min(3, others[s]))][:3]
        alone = len(smallest) < 2 or smallest[0] + smallest[1] > room
        if not alone and len(smallest) == 3 and sum(smallest) <= room:
            return None
        if alone or k >= self._best_pair(fit, others, room):
            return [w, k], (self.left[w] // 2 if k == w else min(self.left[w], self.left[k])) or 1
        others[k] -= 1
        second = [s for s in fit if s <= room - k and others[s]]
        if not second:
            return None
        b = second[-1]
        others[k] += 1
        larger = [s for s in fit if s > b for _ in range(min(2, others[s]))][:2]
        if len(larger) == 2 and sum(larger) <= room:
            return None
        # taking such sets out only takes alternatives away, so all of them are fixed at once
        sets = [w, k, b]
        return sets, min(self.left[x] // sets.count(x) for x in sets)

    @staticmethod
    def _best_pair(fit: list[int], others: dict[int, int], room: int) -> int:
        best, a, b = 0, 0, len(fit) - 1
        while a <= b:
            if fit[a] + fit[b] > room or (a == b and others[fit[a]] < 2):
                b -= 1
            else:
                best = max(best, fit[a] + fit[b])
                a += 1
        return best

    def best_fit(self) -> None:
        """Longest first, each into the fullest sequence that has room for it."""
        free: dict[int, list[tuple[int, int]]] = {}  # room -> runs of sequences (first, number)
        rooms: list[int] = []

        def put(room: int, first: int, number: int) -> None:
            if room and number:
                if room not in free:
                    free[room] = []
                    bisect.insort(rooms, room)
                free[room].append((first, number))

        for w in sorted(self.left, reverse=True):
            while n := self.left.get(w, 0):
                at = bisect.bisect_left(rooms, w)
                if at < len(rooms):
                    room = rooms[at]
                    first, number = free[room].pop()
                    if not free[room]:
                        del free[room], rooms[at]
                else:
                    room, first, number = self.capacity, self.sequences, -(-n // (self.capacity // w))
                    self.sequences += number
                each = min(room // w, n)
                used = min(number, n // each)
                self.place(w, used * each, each, first, self.capacity - room)
                put(room - each * w, first, used)
                put(room, first + used, number - used)

    def table(self) -> np.ndarray:
        return np.array(sorted(self.runs), np.int64).reshape(-1, 6)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    p = Plan(counts, capacity)
    p.reduce()
    p.best_fit()
    return p


def pack(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         keep_ids: bool = False) -> DataFrame:
    """Per piece: ``id_col, piece, start, length, ids_crc32, sequence_id, offset``.

    With ``keep_ids`` the piece's ids (little-endian unsigned 32-bit) come too, so that
    a sequence, at most ``capacity`` tokens, can be put together by grouping.
    """
    cut = materialize(pieces(df, path, id_col, text_col, capacity, keep_ids), "pieces")
    counts = materialize(cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    runs = plan(histogram, capacity).table()
    keys = (runs[:, 0] << 44) | runs[:, 1]
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = cut.join(base, ["task", "length"]).withColumn("rank", F.col("base") + F.col("nth"))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            _, first, _, each, sequence, offset = runs[np.searchsorted(keys, (w << 44) | rank, side="right") - 1].T
            place = rank - first
            drop = {"sequence_id": sequence + place // each, "offset": offset + place % each * w}
            names = [n for n in batch.schema.names if n != "rank"]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index(n)) for n in names]
                                             + [pa.array(v, pa.int64()) for v in drop.values()], names=[*names, *drop])

    keep = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * keep_ids
    ranked = ranked.select(*keep, "rank")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.schema if f.name != "rank")
    return ranked.mapInArrow(look_up, schema + ", sequence_id long, offset long").withColumnRenamed("id", id_col)
