"""Terms counted over Arrow batches: words become numbers, a row's repeats are found by one sort of whole numbers.

A batch is cut into parts of whole rows. A part's words are dictionary-encoded and a bigram is the pair
of its words' numbers, so texts of terms are only made for what is handed on: once for each distinct term of a part.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

#: Words that are counted together, unless one row holds more.
PART_WORDS = 1 << 20

# the functions of this module travel with their code, so workers need not have the package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def parts(words: pa.ListArray, bigrams: bool, most: int = PART_WORDS) -> Iterator[tuple]:
    """``(first, n, row, which, tf, terms)`` of each part: its rows' place in the batch and number; for every distinct
    term of a row, ordered by term number then row, the row in the part, the term's place in ``terms`` and its count."""
    sizes = pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, flat, a = np.cumsum(sizes), words.flatten(), 0
    while a < len(sizes):
        start = ends[a] - sizes[a]
        b = max(a + 1, int(np.searchsorted(ends, start + most, side="right")))
        part, n = flat.slice(start, ends[b - 1] - start), b - a
        row = np.repeat(np.arange(n), sizes[a:b])
        if part.null_count:
            row, part = row[pc.is_valid(part).to_numpy(zero_copy_only=False)], part.drop_null()
        encoded = part.dictionary_encode()
        word, names = encoded.indices.to_numpy().astype(np.int64), encoded.dictionary
        key, v = word, len(names)
        if bigrams:
            beside = row[1:] == row[:-1]
            key, row = np.r_[key, v + word[:-1][beside] * v + word[1:][beside]], np.r_[row, row[1:][beside]]
        both, tf = np.unique(key * n + row, return_counts=True)
        key, row = both // n, both % n
        new = np.r_[True, key[1:] != key[:-1]] if len(key) else np.zeros(0, bool)
        single = key[new]
        ones = int(np.searchsorted(single, v))
        pair = single[ones:] - v
        terms = names.take(pa.array(single[:ones]))
        if len(pair):
            terms = pa.concat_arrays([terms, pc.binary_join_element_wise(names.take(pa.array(pair // v)), names.take(pa.array(pair % v)), " ")])
        yield a, n, row, np.cumsum(new) - 1, tf, terms
        a = b


def stats_of_batches(bigrams: bool):
    """From batches of one column of words, ``term, df, cf`` of each part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, _, which, tf, terms in parts(batch.column(0), bigrams):
                if len(terms):
                    starts = np.searchsorted(which, np.arange(len(terms)))
                    yield pa.RecordBatch.from_arrays([terms, pa.array(np.diff(np.r_[starts, len(which)])), pa.array(np.add.reduceat(tf, starts))],
                                                     names=["term", "df", "cf"])
    return run


def rows_of_batches(bigrams: bool, name: str):
    """From batches of an id and words, ``id, term, tf``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, _, row, which, tf, terms in parts(batch.column(1), bigrams):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row + first)), terms.take(pa.array(which)), pa.array(tf)],
                                                 names=[name, "term", "tf"])
    return run


def lists_of_batches(bigrams: bool, name: str):
    """From batches of an id and words, ``id`` and the row's ``_counts``: terms with their counts in no order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, n, row, which, tf, terms in parts(batch.column(1), bigrams):
                by_row = np.argsort(row, kind="stable")
                items = pa.StructArray.from_arrays([terms.take(pa.array(which[by_row])), pa.array(tf[by_row])], names=["term", "tf"])
                ends = np.r_[0, np.cumsum(np.bincount(row, minlength=n))].astype(np.int32)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), pa.ListArray.from_arrays(pa.array(ends), items)], names=[name, "_counts"])
    return run
