import random
import re
from collections import defaultdict

import pytest

from tests.llm.helpers import CLASHING, DOCS, clashing, lower, messy_docs
from tonestream.llm import ngram_join
from tonestream.llm.components import components


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows):
    """(id, set size, smallest id of the group) by comparing all pairs that share a shingle."""
    sets, root = [shingle_set(r[1]) for r in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    where = defaultdict(list)
    for i, s in enumerate(sets):
        for t in s:
            where[t].append(i)
    for a, b in {(a, b) for ids in where.values() for a in ids for b in ids if a < b}:
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            root[find(a)] = find(b)
    ids = defaultdict(list)
    for i, r in enumerate(rows):
        ids[find(i)].append(r[0])
    out = []
    for i, r in enumerate(rows):
        known = [x for x in ids[find(i)] if x is not None]
        out.append((r[0], len(sets[i]), (min(known) if known else None) if sets[i] else r[0]))
    return out


def near_copies(seed, words, n=200):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    base = [[r.choice(vocabulary) for _ in range(r.randint(0, 60))] for _ in range(7)]
    rows = []
    for i in range(n):
        text = list(r.choice(base))
        for _ in range(r.randint(0, 4)):
            if text:
                text[r.randrange(len(text))] = r.choice([*vocabulary, f"x{r.randrange(99)}"])
        rows.append((i, r.choice([" ", "\n"]).join(text[:r.choice([99, 99, 99, 6, 3])])))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("words, hot", [(12, 32), (12, 3), (40, 32), (40, 10**9)])
def test_groups_are_exact(spark, words, hot):
    rows = near_copies(words, words)
    got = ngram_join.annotate(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), hot=hot)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain(rows), key=str)


def test_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = ngram_join.annotate(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain(rows), key=str)


def test_messy_rows(spark):
    rows = messy_docs(n=80)
    got = ngram_join.annotate(spark.createDataFrame(clashing(rows), CLASHING))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(plain(rows), key=str)


def test_keep_leaves_one_of_each_group(spark):
    rows = clashing(messy_docs(n=80))
    df = spark.createDataFrame(rows, CLASHING)
    kept = ngram_join.keep(df)
    assert kept.schema == df.schema
    kept = [tuple(r) for r in kept.collect()]
    assert set(kept) <= set(rows)
    group = {}  # several rows have no id, but here no two of them are in one group
    for r, p in zip(rows, plain(rows), strict=True):
        group[r[0], r[1]] = p[2]
    with_words = [group[r[0], r[1]] for r in kept if shingle_set(r[1])]
    assert sorted(with_words, key=str) == sorted({group[r[0], r[1]] for r in rows if shingle_set(r[1])}, key=str)
    assert sum(not shingle_set(r[1]) for r in kept) == sum(not shingle_set(r[1]) for r in rows)


def test_large_buckets_pass_whole(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "SEARCHED", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    rows = near_copies(3, 12, 120)
    got = ngram_join.annotate(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, got), key=str) == sorted(plain(rows), key=str)


def test_long_texts_are_hashed_in_stretches(monkeypatch):
    texts = [" ".join(f"Word{i % 97}" for i in range(400)).encode(), b"", b"x" * 500, b"a b\tc", "é ".encode() * 60]
    whole = ngram_join.shingle_sets(texts)
    monkeypatch.setattr(ngram_join, "STRETCH", 16)
    assert [s.tolist() for s in ngram_join.shingle_sets(texts)] == [s.tolist() for s in whole]
    assert [len(s) for s in whole] == [len(shingle_set(t.decode())) for t in texts]


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 164)] + [(7, i) for i in range(300, 400)] + [(5, 5)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 165)} | {i: 7 for i in range(300, 400)} | {7: 7}


def test_empty(spark):
    empty = spark.createDataFrame([], DOCS)
    assert ngram_join.annotate(empty).count() == ngram_join.keep(empty).count() == 0


def check_links(spark, rows, schema, **options):
    pairs, members = ngram_join.links(spark.createDataFrame(rows, schema), **options)
    sets = [frozenset(shingle_set(r[1])) for r in rows]
    linked = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    least = {}
    for r, own in zip(rows, sets, strict=True):
        if own:
            known = [x for x in (least.get(own, r[0]), r[0]) if x is not None]
            least[own] = min(known) if known else None
    want = []
    for r, own in zip(rows, sets, strict=True):
        equal = sum(own == other for other in sets) if own else 0
        want.append((str(r[0]), len(own), str(least.get(own)), equal, sum(bool(linked(own, other)) for other in sets) - 1 if own else 0))
    got = members.collect()
    assert sorted((str(m.doc_id), m.n_shingles, str(m.class_id), m.n_equal, m.n_links) for m in got) == sorted(want)
    different = list(least)
    all_links = [tuple(sorted((str(least[a]), str(least[b])))) for k, a in enumerate(different) for b in different[:k] if linked(a, b)]
    found = pairs.collect()
    assert sorted(tuple(sorted((str(p.left), str(p.right)))) for p in found) == sorted(all_links)
    assert len({(p.left_set, p.right_set) for p in found}) == len(found)
    return found


@pytest.mark.parametrize("schema, change", [(DOCS, list), (CLASHING, clashing)])
def test_links_equal_brute_force(spark, schema, change):
    check_links(spark, change(messy_docs()), schema, hot=3)


def test_links_inside_a_family_of_near_copies(spark):
    r = random.Random(9)
    base = [f"w{r.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(70):  # all share most shingles; a third of the rows are copies of one
        words = list(base)
        for _ in range(r.choice([0, 1, 2, 3, 4])):
            words[r.randrange(120)] = f"x{r.randrange(40)}"
        rows.append((i, " ".join(words), "en", "a", 1))
    rows += [(100 + i, rows[0][1], "en", "a", 1) for i in range(35)]
    assert len(check_links(spark, rows, DOCS)) > 100


def test_links_of_nothing(spark):
    pairs, members = ngram_join.links(spark.createDataFrame([], DOCS))
    assert pairs.count() == 0 and members.count() == 0
