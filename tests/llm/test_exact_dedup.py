import hashlib
from collections import defaultdict

import pytest

from tests.llm.helpers import CLASHING, DOCS, clashing, lower, messy_docs
from tonestream.llm import exact_dedup


def expected(rows, keep):
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r[1] or "")].append(r[0])
    out = []
    for r in rows:
        ids = [i for i in groups[lower(r[1] or "")] if i is not None]
        keep_id = keep(ids) if ids else None
        out.append((r[0], keep_id, len(groups[lower(r[1] or "")]), r[0] == keep_id, hashlib.sha256(lower(r[1] or "").encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep", ["min", "max"])
def test_annotate(spark, keep):
    rows = messy_docs()
    got = exact_dedup.annotate(spark.createDataFrame(rows, DOCS), keep=keep)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, min if keep == "min" else max)


def test_dedup_keeps_one_of_each_text(spark):
    rows = clashing(messy_docs())
    got = exact_dedup.dedup(spark.createDataFrame(rows, CLASHING), keep="max")
    assert got.schema == spark.createDataFrame(rows, CLASHING).schema
    got = [tuple(r) for r in got.collect()]
    texts = [lower(r[1] or "") for r in got]
    assert len(texts) == len(set(texts)) and set(texts) == {lower(r[1] or "") for r in rows}
    assert set(got) <= set(rows)


def test_a_hash_collision_merges_nothing(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(exact_dedup.F, "md5", lambda c: F.lit("00" * 16))
    got = exact_dedup.annotate(spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id long, text string")).collect()
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == {1: (1, 2), 2: (2, 1), 3: (1, 2)}


def test_empty(spark):
    empty = spark.createDataFrame([], DOCS)
    assert exact_dedup.annotate(empty).count() == exact_dedup.dedup(empty).count() == 0
