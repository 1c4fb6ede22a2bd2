"""Periodic runs against a plain search of all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import CLASHING, DOCS, clashing, messy_docs
from tonestream.llm import periodic_runs
from tonestream.llm.common import WORD
from tonestream.llm.periodic_runs import Catchers, collapse, find_runs, runs_of
from tonestream.llm.queries import op11_periodic_runs

SF = "/root/testdata/sf0.01"


def plain(w, least_words=6, least_exponent=4):
    """All maximal stretches of all periods, each with its smallest."""
    n, out = len(w), {}
    for p in range(1, n // least_exponent + 1):
        i = 0
        while i + p < n:
            if w[i] != w[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(least_words, least_exponent * p):
                out.setdefault((i, j + p), p)
            i = j
    return sorted(((s, e - s, p) for (s, e), p in out.items()), key=lambda x: (x[0], x[2]))


def caught(ids, portions, least_words, least_exponent):
    catchers, at = Catchers(least_words, least_exponent), 0
    for size in portions:
        catchers.append(np.array(ids[at:at + size], np.int64))
        at += size
    catchers.append(np.array(ids[at:], np.int64))
    return [tuple(r) for r in catchers.runs().tolist()]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=70), st.integers(1, 9), st.integers(0, 60), st.lists(st.integers(0, 30), max_size=5),
       st.sampled_from([(6, 4), (2, 2), (1, 3)]))
def test_any_words_in_any_portions(ids, period, start, portions, least):
    ids = [ids[start + (i - start) % period] if start + period <= len(ids) and i >= start else x for i, x in enumerate(ids)]
    assert caught(ids, portions, *least) == plain(ids, *least)


def test_hashes_only_propose(monkeypatch):
    monkeypatch.setattr(periodic_runs, "mix", lambda x: x * np.uint64(0))  # every range looks like every other
    r = random.Random(5)
    for _ in range(100):
        ids = [r.randrange(2) for _ in range(r.randint(0, 60))]
        assert caught(ids, [7, 20], 2, 2) == plain(ids, 2, 2)


def test_runs_are_reported_as_words_come():
    catchers = Catchers()
    seen = []
    for x in [9, 8, 1, 2, 1, 2, 1, 2, 1, 2, 1, 7]:
        catchers.append(np.array([x]))
        seen.append(len(catchers.runs()))
    assert seen == [0] * 9 + [1] * 3 and catchers.runs().tolist() == [[2, 9, 2]]


def test_long_texts():
    assert runs_of(["a"] * 300_000).tolist() == [[0, 300_000, 1]]
    words = [str(i) for i in range(50_000)]
    assert runs_of(words * 4 + ["0", "x"]).tolist() == [[0, 200_001, 50_000]]
    assert runs_of(words * 3).tolist() == []
    thue = [bin(i).count("1") % 2 for i in range(1 << 14)]  # no word three times in a row, and bad for polynomial hashes
    assert runs_of([str(x) for x in thue]).tolist() == [] and runs_of([str(x) for x in thue * 4]).tolist() == [[0, 4 << 14, 1 << 14]]


def rows(spark, docs, schema=DOCS):
    return sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in find_runs(spark.createDataFrame(docs, schema)).collect()), key=repr)


def answers(docs):
    out = []
    for r in docs:
        w = re.findall(WORD, r[1] or "")
        runs = plain(w) if len(w) < 5000 else runs_of(w).tolist()
        out.append((r[0], len(w), [tuple(x) for x in runs], collapse(w, np.array(runs, np.int64).reshape(-1, 3))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("docs, schema", [(messy_docs(), DOCS), (clashing(messy_docs(n=20)), CLASHING), ([], DOCS)], ids=["messy", "clashing", "empty"])
def test_unusual_rows(spark, docs, schema):
    docs = docs and docs + [(600, "x " + "a b c " * 9 + "a b d " * 5, "en", "a", 1, *docs[0][5:]), (601, "né x " * 8, "en", "a", 1, *docs[0][5:])]
    assert rows(spark, docs, schema) == answers(docs)


def test_collapse_keeps_the_first_period():
    words = "x a b a b a b a b a y".split()
    assert collapse(words, np.array([[1, 9, 2]])) == "x a b y" and collapse(words, np.zeros((0, 3), np.int64)) == " ".join(words)


def test_query_against_a_plain_search(spark):
    got = {r.doc_id: r for r in op11_periodic_runs(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    planted = 0
    for r in docs:
        w = re.findall(WORD, r.text or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[a + (i - a) % p] if i >= a else w[i] for i in range(n)]
            planted += 1
        if n > 1200 and not h % 10 == 0:
            continue  # the plain search takes the square of a text's length
        if n > 6000:
            continue
        runs = plain(w)
        drop = {i for s, length, p in runs for i in range(s + p, s + length)}
        lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        top = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        x = got[r.doc_id]
        assert (x.n_runs, x.start, x.length, x.period) == (len(runs), *top)
        assert x.exponent_milli == (top[1] and 1000 * top[1] // top[2])
        assert x.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert x.collapsed_sha256 == hashlib.sha256(" ".join(v for i, v in enumerate(w) if i not in drop).encode()).hexdigest()
    assert planted > 50
