"""Periodic run detection: online dyadic square catching over the words of each text.

Method: a text's words arrive portion by portion (``Catchers.append``). Every completed block of
2**j words that starts at a multiple of 2**j has a catcher. It waits for the block's words to come
again p words later, 2 * 2**j - 1 <= p <= 4 * 2**j - 2. Any p consecutive words hold such a block whole,
so the first half of every square of period p has its catcher, and each new word meets two
catchers a level: the hash of the last 2**j words is compared with those of the two blocks in reach. Catches
of neighbouring blocks at the same distance merge; at the ends, fewer than 2**j words to either
side are compared by halving steps. Squares of one period that overlap so become one run. Hashes only
propose: each run's words are compared in the end, and where hashes ever deceived, the periods
that they proposed are compared word by word.

A text's n words cost O(n log n), whatever they repeat: a text of one word a million times
has many catches, but each level makes at most two a word.

A text is one row and is worked on alone, so the work is one pass without a shuffle, and a lost task is
simply run again. Memory follows the longest text (some 100 bytes a word), not the table.

Defined results:

* null text counts as the empty text: no words, no runs, the collapsed text is empty;
* a null id is returned like any other; rows that repeat an id or a text are each answered;
* an empty table gives an empty result; other columns, whatever their names, aren't read;
* a run is maximal, has its smallest period and at least ``least_words`` words and
  ``least_exponent`` periods (2 or more); runs are listed by start, then period.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonestream.llm.byte_hash import FIRST, _powers, mix
from tonestream.llm.common import WORD, small_batches, text_or_empty

LEAST_WORDS = 6
LEAST_EXPONENT = 4
#: Words that are taken in at once; bounds the temporary arrays, not the result.
PORTION = 1 << 16


class Catchers:
    """Catches the squares of a growing sequence of word numbers."""

    def __init__(self, least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT, multiplier: int = FIRST):
        if least_exponent < 2:
            raise ValueError("a run has at least two periods")
        self.least_words, self.least_exponent, self.multiplier = least_words, least_exponent, multiplier
        self.n = 0
        self.words = np.zeros(64, np.int64)
        self.sums = np.zeros(65, np.uint64)
        self.levels: list[int] = []  # of each level, how many starts of windows have met its catchers
        self.caught: list[list[tuple[np.ndarray, np.ndarray]]] = []  # of each level, (period, start of the block)

    def append(self, words: np.ndarray) -> None:
        """Take in the next words and let the catchers see them."""
        old, self.n = self.n, self.n + len(words)
        if self.n > len(self.words):
            room = 1 << int(self.n).bit_length()
            self.words, self.sums = np.resize(self.words, room), np.resize(self.sums, room + 1)
        self.words[old:self.n] = words
        self.up, self.down = _powers(self.multiplier, 1 << max(16, int(self.n + 1).bit_length()))
        with np.errstate(over="ignore"):
            values = mix(words.astype(np.uint64) + np.uint64(1)) * self.up[old:self.n]
            self.sums[old + 1:self.n + 1] = self.sums[old] + np.cumsum(values)
        # a level's catchers begin once the words could hold a run of its periods, and catch up on those before
        while self.least_exponent * ((2 << len(self.levels)) - 1) <= self.n:
            self.levels.append(0)
            self.caught.append([])
        for level, seen in enumerate(self.levels):
            for a in range(seen, self.n - (1 << level) + 1, PORTION):
                self._meet(level, a, min(a + PORTION, self.n - (1 << level) + 1))
            self.levels[level] = max(seen, self.n - (1 << level) + 1)

    def _hash(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (self.sums[stop] - self.sums[start]) * self.down[start]

    def _meet(self, level: int, a: int, b: int) -> None:
        """Windows of 2**level words that start at ``a`` up to ``b`` meet the two catchers in their reach."""
        size = 1 << level
        a = max(a, 2 * size - 1)
        if a >= b:
            return
        start = np.arange(a, b)
        now = self._hash(start, start + size)
        nearest = (start - (2 * size - 1)) >> level
        first = max(int(nearest[0]) - 1, 0)
        block = np.arange(first, int(nearest[-1]) + 1) << level
        blocks = self._hash(block, block + size)
        for catcher in (nearest, nearest - 1):
            hit = np.flatnonzero((blocks[np.maximum(catcher, first) - first] == now) & (catcher >= 0))
            if len(hit):
                at = catcher[hit] << level
                self.caught[level].append((start[hit] - at, at))

    def _same(self, at: np.ndarray, period: np.ndarray, most: np.ndarray, size: int, forward: bool) -> np.ndarray:
        """How many words on (or back) from ``at`` equal those a period later: fewer than ``size``, at most ``most``."""
        found, step = np.zeros(len(at), np.int64), size >> 1
        while step:
            a, b = (at + found, at + found + step) if forward else (at - found - step, at - found)
            fits = found + step <= most
            a, b = np.where(fits, a, 0), np.where(fits, b, 0)
            far = np.where(fits, period, 0)
            found += np.where(fits & (self._hash(a, b) == self._hash(a + far, b + far)), step, 0)
            step >>= 1
        return found

    def _least(self, period: np.ndarray) -> np.ndarray:
        return np.maximum(self.least_words, self.least_exponent * period)

    def runs(self) -> np.ndarray:
        """The runs of the words so far: rows of start, length, period."""
        proposed = []
        for level, parts in enumerate(self.caught):
            if not parts:
                continue
            size = 1 << level
            period, at = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.lexsort((at, period))
            period, at = period[order], at[order]
            new = np.ones(len(at), bool)
            new[1:] = (period[1:] != period[:-1]) | (at[1:] != at[:-1] + size)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(at)) - 1
            start, stop, period = at[first], at[last] + size, period[first]
            long = stop - start + 2 * (size - 1) + period >= self._least(period)
            start, stop, period = start[long], stop[long], period[long]
            if len(start):
                begin = start - self._same(start, period, start, size, False)
                end = stop + self._same(stop, period, self.n - period - stop, size, True) + period
                proposed.append(np.stack([begin, end, period], axis=1))
        if not proposed:
            return np.zeros((0, 3), np.int64)
        found = np.concatenate(proposed)
        runs = self._distinct(found)
        words = self.words
        if not all(np.array_equal(words[s:e - p], words[s + p:e]) for s, e, p in runs.tolist()):
            runs = self._distinct(np.concatenate([self._by_words(p) for p in np.unique(found[:, 2]).tolist()]))
        return np.stack([runs[:, 0], runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)

    def _distinct(self, found: np.ndarray) -> np.ndarray:
        """Of what is long enough (begin, end, period), each stretch once, with its smallest period."""
        found = found[found[:, 1] - found[:, 0] >= self._least(found[:, 2])]
        found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
        new = np.ones(len(found), bool)
        new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
        found = found[new]
        return found[np.lexsort((found[:, 2], found[:, 0]))]

    def _by_words(self, period: int) -> np.ndarray:
        """The maximal stretches of one period, word by word."""
        words = self.words[:self.n]
        same = np.concatenate([[0], (words[:-period] == words[period:]).astype(np.int8), [0]])
        edge = np.diff(same)
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        return np.stack([start, stop + period, np.full(len(start), period)], axis=1)


def runs_of(words: list[str], least_words: int = LEAST_WORDS, least_exponent: int = LEAST_EXPONENT) -> np.ndarray:
    """The runs of a list of words: rows of start, length, period."""
    if len(words) < max(least_words, least_exponent):
        return np.zeros((0, 3), np.int64)
    ids = pa.array(words, pa.large_string()).dictionary_encode().indices.to_numpy().astype(np.int64)
    catchers = Catchers(least_words, least_exponent)
    for a in range(0, len(ids), PORTION):
        catchers.append(ids[a:a + PORTION])
    return catchers.runs()


def collapse(words: list[str], runs: np.ndarray) -> str:
    """The words without any run's repetitions (all but its first period), joined by one space."""
    if not len(runs):
        return " ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return " ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()])


def find_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS,
              least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """One row per input row: ``id_col, n_words, runs (array of start, length, period), collapsed``."""
    small_batches(df.sparkSession)
    word = re.compile(WORD)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            n_words, ends, rows, collapsed = [], [0], [], []
            for text in batch.column(1):
                words = word.findall(text.as_py())
                runs = runs_of(words, least_words, least_exponent)
                n_words.append(len(words))
                rows.append(runs)
                ends.append(ends[-1] + len(runs))
                collapsed.append(collapse(words, runs))
            flat = np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)
            fields = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], fields=list(kind.value_type))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), fields, type=kind)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), lists, pa.array(collapsed, pa.string())],
                                             [id_col, "n_words", "runs", "collapsed"])

    kind = df.select(F.col(id_col)).schema[0].dataType.simpleString()
    return df.select(F.col(id_col), text_or_empty(text_col).alias("text")).mapInArrow(
        answer, f"`{id_col}` {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")


def longest(runs: Column) -> Column:
    """The run with the greatest length; of several the one that starts first, then that of the smallest period."""
    return F.aggregate(runs, F.lit(None).cast("struct<start: long, length: long, period: long>"), lambda a, r: F.when(
        a.isNull() | (r["length"] > a["length"]) | ((r["length"] == a["length"]) & ((r["start"] < a["start"]) | (
            (r["start"] == a["start"]) & (r["period"] < a["period"])))), r).otherwise(a))
