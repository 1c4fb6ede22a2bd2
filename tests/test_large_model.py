"""A Naive Bayes model too large to be packed: its frequent terms are, and only other words meet a join."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tonestream.operators import naive_bayes
from tonestream.operators.naive_bayes import fit_naive_bayes_table

COMMON = [f"common{i}" for i in range(8)]
SCHEMA = "id int, target int, words array<string>"


def train_rows():
    """Eight words that every document holds, and a word of its own."""
    return [(i, i % 2, COMMON * (1 + i % 3) + [f"own{i:03d}"]) for i in range(60)]


TEST_ROWS = [(1, 0, COMMON[:3]), (2, 0, [*COMMON[:2], "own003", "own003", "own010"]), (2, 1, ["own005"]), (None, 0, ["unheard", "common1"]),
             (5, 0, []), (6, 0, None), (7, 0, ["unheard", None, "own002"])]


def expected(words):
    train = train_rows()
    counts = [Counter(w for _, y, ws in train if y == c for w in ws) for c in (0, 1)]
    vocab = set(counts[0]) | set(counts[1])
    raw = []
    for c in (0, 1):
        n, total = sum(y == c for _, y, _ in train), sum(counts[c].values())
        raw.append(math.log(n + 1) - math.log(len(train) + 2)
                   + sum(math.log(counts[c][w] + 1) - math.log(total + len(vocab)) for w in words or [] if w in vocab))
    return [round(x, 9) for x in raw]


def fitted(spark):
    return fit_naive_bayes_table(spark.createDataFrame(train_rows(), SCHEMA), "words")


def check_scores(scored):
    got = sorted([(r.id or 0, r.target, round(r.raw_0, 9), round(r.raw_1, 9), r.prediction) for r in scored.collect()])
    want = sorted((i or 0, y, *expected(w), float(expected(w)[1] > expected(w)[0])) for i, y, w in TEST_ROWS)
    assert got == want


@pytest.mark.parametrize("most", [1000, 100, 1 << 20])  # the common words fit; no term does; all do
def test_scores_are_the_same_however_much_is_packed(spark, monkeypatch, most):
    monkeypatch.setattr(naive_bayes, "LOOKUP_BYTES", most)
    model, test = fitted(spark), spark.createDataFrame(TEST_ROWS, SCHEMA)
    assert (model.lookup is None, model.head is None) == (most < 1 << 20, most != 1000)
    check_scores(model.transform(test, "words"))
    check_scores(model.transform(test, "words", max_broadcast_bytes=0))
    check_scores(model.transform(test, "words", keep=["id", "target"]))


def test_only_words_beyond_the_packed_terms_are_moved(spark, monkeypatch):
    monkeypatch.setattr(naive_bayes, "LOOKUP_BYTES", 1000)
    model, test, scratch = fitted(spark), spark.createDataFrame(TEST_ROWS, SCHEMA).withColumn("text", F.lit("long")), []
    assert model.head.others.where(F.col("term").startswith("common")).count() == 0
    scored = model.transform(test, "words", scratch=scratch, keep=["id", "target"])
    assert scored.columns == ["id", "target", "raw_0", "raw_1", "prediction", "p_pos", "p_neg"]
    stored = spark.read.parquet(*scratch)
    assert "text" not in stored.columns and "words" not in stored.columns
    left = Counter(w for r in stored.collect() for w in r["_rest"])
    assert left == Counter(w for _, _, ws in TEST_ROWS for w in ws or [] if w is not None and not w.startswith("common"))


def test_terms_of_one_count_are_packed_together_or_not_at_all(spark):
    counts = spark.createDataFrame([("a", 5, 0), ("b", 0, 3), ("c", 2, 1), ("dd", 1, 0)], "term string, c_0 long, c_1 long")
    entry = naive_bayes.ENTRY_BYTES + 1
    for most, cut in ((entry - 1, None), (entry, (5, 1, entry)), (3 * entry - 1, (5, 1, entry)), (3 * entry, (3, 3, 3 * entry)),
                      (10 * entry, (1, 4, 4 * entry + 1))):
        assert naive_bayes.head_of(counts, most) == cut
