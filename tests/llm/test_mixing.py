from collections import Counter, defaultdict
import re

from tests.llm.helpers import CLASHING, DOCS, by, clashing, messy_docs
from tonestream.llm import mixing

SF01 = "/root/testdata/sf0.01"


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(5, 2, 1), most=3):
    """Share by weight, stop at the cap, share the excess again until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), {}
    while True:
        left, share = total - sum(stopped.values()), sum(w for s, w in weight.items() if s not in stopped)
        above = {s: most * sizes[s] for s in names if s not in stopped and left * weight[s] / share > most * sizes[s]}
        if not above:
            return {s: stopped.get(s, left * weight[s] / share if share else 0) for s in names}
        stopped |= above


def check(rows, got, near):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r[1])
    goal = targets(sizes)
    taken = Counter()
    for (r, g) in zip(by([{"doc_id": r[0], "size": size(r[1]), "source": r[3]} for r in rows], "doc_id", "size"),
                      by([g.asDict() for g in got], "doc_id", "size"), strict=True):
        assert (r["doc_id"], r["size"]) == (g["doc_id"], g["size"])
        assert g["taken"] in {k * g["size"] for k in range(4)}
    return sizes, goal, taken


def test_report_on_messy_rows(spark):
    rows = messy_docs(n=400)
    got = mixing.report(spark.createDataFrame(rows, DOCS)).collect()
    sizes, goal, _ = check(rows, got, 0.1)
    for g in got:
        source = [s for s in sizes if sizes[s] == g.source_size and abs(goal[s] - g.target) < 1e-6]
        assert source
    # sources are told apart by their target and size here
    taken = Counter()
    for g in got:
        taken[g.source_size, round(g.target, 6)] += g.taken
    for (source_size, target), words in taken.items():
        assert abs(words - target) <= max(0.05 * target, 30_000 if target > 30_000 else 60)


def test_targets_stop_and_reshare(spark):
    sizes = {"a": 10, "b": 1000, "c": 5, "d": 200, None: 40}
    rows = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    goal = targets(sizes)
    assert {r.source: round(r.target, 9) for r in rows} == {s: round(t, 9) for s, t in goal.items()}


def test_shards_hold_equal_disjoint_draws(spark):
    docs = spark.createDataFrame(messy_docs(n=300), DOCS)
    _, _, drawn = mixing.draws(docs, levels=3)
    rows = drawn.collect()
    quotas = Counter(r.shard for r in rows)
    assert len(quotas) == 8 and max(quotas.values()) - min(quotas.values()) <= 3
    assert len({(r.source, r.block, r.copy) for r in rows}) == len(rows)


def test_mix_repeats_whole_rows_and_reruns_agree(spark):
    rows = clashing(messy_docs(n=200))
    df = spark.createDataFrame(rows, CLASHING)
    a, b = (Counter(map(tuple, mixing.mix(df).collect())) for _ in range(2))
    assert a == b and set(a) <= set(rows)
    given = Counter(rows)
    assert all(n <= 3 * given[r] for r, n in a.items())
    placed = mixing.mix(df, keep_place=True)
    assert placed.columns[:2] == ["shard", "place"] and placed.count() == sum(a.values())


def test_near_targets_on_the_given_table(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    got = mixing.report(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    words, goal = Counter(), {}
    for g in got:
        words[g.source] += g.taken
        goal[g.source] = g.target
    assert all(abs(words[s] / goal[s] - 1) < 0.03 for s in goal)


def test_empty(spark):
    empty = spark.createDataFrame([], DOCS)
    assert mixing.report(empty).count() == mixing.mix(empty).count() == 0
