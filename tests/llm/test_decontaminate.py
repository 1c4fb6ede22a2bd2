"""Benchmark decontamination against a plain scan of all windows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import CLASHING, DOCS, clashing, lower, messy_docs
from tonestream.llm import decontaminate

ITEMS = "item_id long, text string"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, lower(text or ""))


def plain(docs, items, size=10):
    grams = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - size + 1, 1) if w else 0):
            grams.setdefault(tuple(w[i:i + size]), set()).add("" if item is None else str(item))
    out = []
    for r in docs:
        w, hit, found = words(r[1]), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit.update(range(i, i + n))
                    found |= grams[tuple(w[i:i + n])]
        out.append((r[0], len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def case(seed=3):
    r = random.Random(seed)
    docs = messy_docs(seed)
    items = []
    for k, d in enumerate(docs[:40]):
        w = words(d[1])
        if len(w) > 12 and k % 3 == 0:
            a = r.randrange(len(w) - 10)
            items.append((k, "! ".join(w[a:a + r.randint(10, 40)]).upper()))
    items += [(100, "w1 w2"), (101, "W3"), (None, "w4, w5 w6"), (None, None), (102, ""), (103, None), (104, "!!"), (101, "w7 w8 w9 w10"), items[0],
              (105, items[0][1])]
    return docs, items


def digest(spark, docs, items, schema=DOCS, **options):
    out = decontaminate.annotate(spark.createDataFrame(docs, schema), spark.createDataFrame(items, ITEMS), **options)
    return sorted(((r.doc_id, r.n_words, r.n_hit, len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r.contaminated)
                   for r in out.collect()), key=repr)


@pytest.mark.parametrize("set_rows", [1 << 20, 1])
def test_against_all_windows(spark, set_rows):
    docs, items = case()
    assert digest(spark, docs, items, set_rows=set_rows) == sorted(plain(docs, items), key=repr)


def test_clashing_columns_and_ten_word_items(spark):
    docs, items = case(5)
    items = [i for i in items if len(words(i[1])) >= 10]
    assert items and digest(spark, clashing(docs), items, CLASHING) == sorted(plain(docs, items), key=repr)


def test_empty_tables(spark):
    docs, items = case()
    assert digest(spark, [], items) == []
    assert digest(spark, docs, []) == sorted(plain(docs, []), key=repr)


def test_a_third_of_all_texts_are_one(spark):
    docs, items = case()
    docs = docs + [(1000 + i, items[0][1], "en", "a", 1) for i in range(80)] + [(7, items[0][1], "en", "a", 1)] * 20
    assert digest(spark, docs, items) == sorted(plain(docs, items), key=repr)


def test_spans_are_removed(spark):
    docs, items = case()
    frame, bench = spark.createDataFrame(clashing(docs), CLASHING), spark.createDataFrame(items, ITEMS)
    out = decontaminate.remove_spans(frame, bench)
    assert out.schema == frame.schema and out.count() == len(docs)
    spans = {(r.doc_id, r.n_words): r.spans for r in decontaminate.annotate(frame, bench).collect()}
    kept = {}
    for i, text, *_ in docs:
        w = words(text)
        hit = {k for s in spans[i, len(w)] for k in range(s.start, s.stop)}
        kept.setdefault(i, []).append([x for k, x in enumerate(w) if k not in hit])
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(words(r.text))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in kept.items()}
    untouched = {r[1] for r in docs if not any(spans[r[0], len(words(r[1]))])}
    assert untouched <= {r.text for r in out.collect()}


def test_texts_keep_what_stands_around(spark):
    docs = spark.createDataFrame([(1, "Keep this; one two, Three! and that.\n"), (2, "one two three"), (3, "ONE TWO THREE.")], "doc_id long, text string")
    out = decontaminate.remove_spans(docs, spark.createDataFrame([(1, "one two three")], ITEMS)).orderBy("doc_id").collect()
    assert [r.text for r in out] == ["Keep this! and that.\n", "", "."]


def test_documents_are_dropped(spark):
    docs, items = case()
    frame, bench = spark.createDataFrame(clashing(docs), CLASHING), spark.createDataFrame(items, ITEMS)
    hits = plain(docs, items)
    out = decontaminate.drop_documents(frame, bench, least_hit=5)
    assert out.schema == frame.schema
    assert sorted(repr(r.doc_id) for r in out.collect()) == sorted(repr(h[0]) for h in hits if h[2] < 5)


def test_positions_stay_in_their_task(spark):
    docs, items = case()
    frame = spark.createDataFrame(docs, DOCS)
    found, n = decontaminate.flagged(frame, spark.createDataFrame(items, ITEMS))
    assert n == found.count() == len({d[1] or "" for d, p in zip(docs, plain(docs, items), strict=True) if p[5]})
    assert found.where(F.expr("exists(spans, s -> s.start >= s.stop)")).count() == 0
