"""Terms counted over Arrow batches against a plain count of each row."""

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tonestream.operators import features, term_counts
from tests.test_plans import plan

ROWS = [(1, ["b", "a", "b", "a", "b"]), (2, []), (None, ["a"]), (1, ["b", "a", "b", "a", "b"]), (3, None), (4, ["a", "é", "a"])]
SCHEMA = "id long, words array<string>"


def counted(bigrams):
    out = []
    for i, words in ROWS:
        w = list(words or [])
        out.append((i, Counter(w + [f"{a} {b}" for a, b in zip(w, w[1:])] * bigrams)))
    return out


@pytest.mark.parametrize("bigrams", [False, True])
@pytest.mark.parametrize("most", [1, 4, 1000])
def test_parts_of_a_batch(bigrams, most):
    words = pa.array([["x"], *[w for _, w in ROWS]], pa.list_(pa.string())).slice(1)
    got = [Counter() for _ in ROWS]
    for first, _, row, which, tf, terms in term_counts.parts(words, bigrams, most):
        for r, t, n in zip(row, which, tf):
            got[first + r][terms[t].as_py()] = n
    assert got == [c for _, c in counted(bigrams)]


@pytest.mark.parametrize("bigrams", [False, True])
def test_statistics_and_rows_of_terms(spark, bigrams):
    df = spark.createDataFrame(ROWS, SCHEMA).coalesce(1)
    want = Counter((i, t, n) for i, c in counted(bigrams) for t, n in c.items())
    assert Counter(map(tuple, features.doc_terms(df, "id", F.col("words"), bigrams).collect())) == want
    stats = {r.term: (r.df, r.cf) for r in features.term_stats_of(df, F.col("words"), bigrams).collect()}
    docs, total = Counter(), Counter()
    for _, c in counted(bigrams):
        docs.update(c.keys())
        total.update(c)
    assert stats == {t: (docs[t], total[t]) for t in total}


def test_terms_are_not_sorted_and_counted_row_by_row(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for made in (features.term_stats_of(df, F.col("words"), True), features.doc_terms(df, "id", F.col("words"))):
        p = plan(made)
        assert "MapInArrow" in p and "sort_array" not in p and "sequence(" not in p
