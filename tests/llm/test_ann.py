import numpy as np
import pytest
from pyspark.sql import functions as F

from tonestream.llm import ann

VECTORS = "vec_id long, embedding array<float>, id string, v string, curve string"


def plain(rows, asked, k):
    out = {}
    for q, x in rows:
        if asked(q):
            near = sorted(((-sum(float(a) * float(b) for a, b in zip(x, y)), i) for i, y in rows if i != q))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def read(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_small_tables_are_searched_whole_with_ties(spark):
    r = np.random.default_rng(1)
    vectors = [(i, r.integers(-3, 4, 5).astype(float).tolist()) for i in range(200)]
    vectors += [(300 + i, [1.0, 0.0, 2.0, 0.0, 0.0]) for i in range(90)]  # a third are one vector
    good = [(i, v) for i, v in vectors if any(v)]
    bad = [(900, None), (901, []), (902, [0.0] * 5), (903, [float("nan")] * 5), (904, [None, 1.0, 1.0, 1.0, 1.0]), (905, [float("inf")] + [0.0] * 4),
           (None, [1.0] * 5)]
    df = spark.createDataFrame([(i, v, "", "", "") for i, v in vectors + bad + [vectors[0]]], VECTORS)
    got = read(ann.search(df, F.col("id") % 10 == 0, k=20))
    want = plain(good, lambda q: q % 10 == 0, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)


def test_recall_on_unstructured_vectors(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(6000, 32)).astype(np.float32)
    x *= r.uniform(0.5, 2, size=(6000, 1)).astype(np.float32)  # lengths differ: inner product isn't cosine
    df = spark.createDataFrame([(i, v.tolist(), "", "", "") for i, v in enumerate(x)], VECTORS)
    got = read(ann.search(df, F.col("id") % 100 == 0, k=20))
    found = 0
    for q in range(0, 6000, 100):
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        found += len({i for i, _ in got[q]} & set(np.argsort(-s)[:20].tolist()))
    assert found / (20 * len(got)) >= 0.9


@pytest.mark.parametrize("every", [60, 1])
def test_recall_with_a_few_very_long_rows(spark, every):
    r = np.random.default_rng(3)
    x = r.normal(size=(6000, 32))
    x /= np.sqrt((x * x).sum(axis=1))[:, None]
    x[[17, 18, 19]] *= [[1e4], [1e4], [30]]
    x = x.astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), "", "", "") for i, v in enumerate(x)], VECTORS)
    got = read(ann.search(df, F.col("id") % every == 0, k=20))
    asked = range(0, 6000, 60)
    found = 0
    for q in asked:
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        want = np.argsort(-s)[:20].tolist()
        ids = [i for i, _ in got[q]]
        assert all(i in ids for i in {17, 18, 19} & set(want))
        found += len(set(ids) & set(want))
    assert len(got) == len(range(0, 6000, every)) and found / (20 * len(asked)) >= 0.9


def test_clustered_vectors_cost_less_than_exhaustive_search(spark):
    r, n, reach = np.random.default_rng(4), 16_000, 0.02
    middles = r.normal(size=(80, 32))
    x = (middles[r.integers(0, 80, n)] + 0.15 * r.normal(size=(n, 32))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), "", "", "") for i, v in enumerate(x)], VECTORS)
    got = read(ann.search(df, F.col("id") % 200 == 0, k=20, reach=reach))
    found = 0
    for q in range(0, n, 200):
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        found += len({i for i, _ in got[q]} & set(np.argsort(-s)[:20].tolist()))
    assert found / (20 * len(got)) >= 0.9
    # a curve's window is at most five blocks of half the reach, so this bounds a query's products
    most = ann.CURVES * 2.5 * max(int(reach * n), ann.LEAST_ROWS)
    assert len(got) == n // 200 and most < 0.7 * n


def test_hilbert_curve_visits_neighbours():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    order = np.argsort(ann.hilbert_index(cells, 3))
    assert sorted(ann.hilbert_index(cells, 3).tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_few_or_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], "", "", ""), (5, [0.5, 1.0], "", "", "")], VECTORS)
    assert read(ann.search(df, F.col("id") == 0, k=20)) == {0: [(5, 0.5)]}
    assert ann.search(spark.createDataFrame([], VECTORS), F.col("id") == 0).count() == 0
    with pytest.raises(ValueError):
        ann.search(spark.createDataFrame([(0, [1.0], "", "", ""), (5, [0.5, 1.0], "", "", "")], VECTORS), F.col("id") == 0)
