import pytest
from pyspark.sql import functions as F

from tonestream.llm import chat

NODES = "conv long, node long, parent long, role string, text string, score double"
TURNS = "conv_id long, turn long, role string, text string, node string, score string, leaf string"


def read_back(out):
    return {(r.conv, r.rank): ([tuple(t) for t in r.turns], list(r.learned)) for r in out.select(
        "conv", "rank", chat.parse(F.col("formatted")).alias("turns"), chat.masked_texts(F.col("formatted"), F.col("loss")).alias("learned")).collect()}


def test_branches_are_ranked_by_score(spark):
    nodes = [(1, 1, None, "user", "q", 0.0), (1, 2, 1, "assistant", "bad", 0.1), (1, 3, 1, "assistant", "good", 0.9),
             (1, 4, 3, "user", "more", 0.5), (1, 5, 4, "assistant", "end", 0.1), (1, 6, 2, "user", "hm", 0.2),
             (2, 1, 99, None, None, None), (3, 7, None, "assistant", "<a>\\b</turn>\n", 1.0)]
    got = read_back(chat.format_trees(spark.createDataFrame(nodes, NODES), branches=2))
    assert got == {
        (1, 1): ([("user", "q"), ("assistant", "good"), ("user", "more"), ("assistant", "end")], ["good", "end"]),
        (1, 2): ([("user", "q"), ("assistant", "bad"), ("user", "hm")], ["bad"]),
        (2, 1): ([("", "")], []), (3, 1): ([("assistant", "<a>\\b</turn>\n")], ["<a>\\b</turn>\n"])}


def test_linear_conversations_round_trip(spark):
    hard = ["\\### Assistant: </turn> ok", "<turn user>", "\\l\\b\\g", "", None, "x" * 200_000, "日本\n</turn>\n", ">\\"]
    rows = [(c, t, ["user", "assistant", "system", None][((c or 0) + t) % 4], hard[((c or 0) * 3 + t) % len(hard)], "n", "s", "l")
            for c in (1, 2, None) for t in range(9)]
    rows += [rows[0], (4, None, "assistant", "a", "", "", ""), (4, 0, "user", "b", "", "", ""), *((5, t, "assistant", str(t), "", "", "") for t in range(130))]
    got = read_back(chat.format_trees(chat.linear(spark.createDataFrame(rows, TURNS))))
    for conv in (1, 2, 4, 5, None):
        mine = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        turns = [(role, text) for _, _, role, text in mine]
        assert got[conv, 1] == (turns, [t for r, t in turns if r == "assistant"])
    assert len(got) == 5


def test_a_cycle_is_an_error(spark):
    with pytest.raises(ValueError):
        chat.format_trees(spark.createDataFrame([(1, 1, 2, "user", "a", 0.0), (1, 2, 1, "user", "b", 0.0)], NODES)).collect()


def test_empty(spark):
    assert chat.format_trees(chat.linear(spark.createDataFrame([], TURNS))).count() == 0
