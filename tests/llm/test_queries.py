"""The registered queries, and the pipeline stage by stage, on the given tables."""

from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.helpers import CLASHING, clashing, lower, messy_docs
from tests.llm.test_ngram_join import plain
from tests.oracle_compare import compare, duck
from tonestream.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(SQL))
def test_oracle(spark, name):
    assert compare(spark, duck(SF), name, QUERIES[name], SQL[name], SF)[0] == "OK"


def test_all_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_stages(spark, tmp_path):
    docs = given = spark.read.parquet(f"{SF}/documents.parquet")
    results = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        results[name] = docs
        if name != "pack":
            assert docs.dtypes == given.dtypes
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in results["quality"].collect()}
    assert sum(i in kept for i, q in labels.items() if q) >= 0.97 * sum(labels.values())
    assert sum(i not in kept for i, q in labels.items() if not q) >= 0.9 * sum(not q for q in labels.values())
    before, after = (results[n].collect() for n in ("quality", "exact_dedup"))
    largest = {}
    for r in before:
        largest[lower(r.text)] = max(largest.get(lower(r.text), -1), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(largest.values())
    before, after = after, results["near_dedup"].collect()
    assert sorted(r.doc_id for r in after) == sorted({c for _, _, c in plain([(r.doc_id, r.text) for r in before])})
    before, after = after, results["mix"].collect()
    times = Counter(map(tuple, after))
    assert max(times.values()) <= 3 and set(times) <= set(map(tuple, before))
    pieces = results["pack"].collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in after}
    assert sum(r.piece == 0 for r in pieces) == len(after)


@pytest.mark.parametrize("rows", [clashing(messy_docs(n=60)), []], ids=["messy", "empty"])
def test_stages_on_unusual_rows(spark, tmp_path, rows):
    docs = given = spark.createDataFrame(rows, CLASHING)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "pack":
            assert out.schema == docs.schema or out.dtypes == given.dtypes
        out.write.parquet(f"{tmp_path}/{name}")
        if name == "quality":  # the sample's texts are rejected or not; the later stages see all of them
            assert spark.read.schema(out.schema).parquet(f"{tmp_path}/{name}").count() <= len(rows)
            continue
        docs = spark.read.schema(out.schema).parquet(f"{tmp_path}/{name}")
    texts = {r[1] for r in rows}
    assert docs.count() >= (1 if rows else 0) and (bool(texts) == bool(docs.count()))
