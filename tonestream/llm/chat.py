"""Chat formatting from reply trees.

Method: messages are nodes with a parent; iterative self-joins double the known
ancestor distance (1, 2, 4, ... replies up), so a tree of depth d takes log2(d)
rounds, not d. The same rounds add up the scores along each branch. Every
conversation's leaves are ranked by branch score, the best ``branches`` paths are
enumerated by joining the chosen leaves with the stored jumps, and each path is
formatted as one conversation.

Format: ``<turn ROLE>TEXT</turn>\\n`` per message. In roles and texts ``\\`` becomes
``\\b``, ``<`` becomes ``\\l`` and ``>`` becomes ``\\g``; an escaped text holds no angle bracket, so a control
string can't occur in it and two literal replacements undo the escaping.

The loss mask of a conversation is a list of spans (start, length) in code
points of the formatted text, one per message of ``loss_role``.

Defined results:

* null role or text counts as empty; null scores count as 0;
* a parent that is null or missing makes a root; a reply cycle has no leaf and no
  root, and raises an error, as nothing of it could be formatted;
* ``linear`` orders rows by turn (nulls first), then role, then text, so repeated rows stay,
  next to each other;
* rows with a null conversation id form one conversation with a null id;
* an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonestream.llm.common import materialize, text_or_empty

OPEN, MID, CLOSE = "<turn ", ">", "</turn>\n"


def escape(c: Column) -> Column:
    """Remove ``\\``, ``<`` and ``>`` from a text, reversibly."""
    for char, code in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        c = F.replace(c, F.lit(char), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    for char, code in ((">", "\\g"), ("<", "\\l"), ("\\", "\\b")):
        c = F.replace(c, F.lit(code), F.lit(char))
    return c


def linear(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Nodes of conversations given as numbered turns: each replies to the one before."""
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), text_or_empty(role_col).alias("role"),
                     text_or_empty(text_col).alias("text"))
    w = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return rows.withColumn("node", F.row_number().over(w).cast("long")).select(
        "conv", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def _paths(nodes: DataFrame, branches: int) -> DataFrame:
    """(conv, leaf, up, node): the chosen root-to-leaf paths, ``up`` replies above the leaf."""
    links = nodes.select("conv", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))
    has = links.select(F.col("conv").alias("c"), F.col("node").alias("p")).distinct()
    same = F.col("conv").eqNullSafe(F.col("c"))
    n_nodes = nodes.count()
    jumps = [materialize(links.join(has, same & (F.col("parent") == F.col("p")), "left").select(
        "conv", "node", F.col("p").alias("to"), "score", F.lit(1).cast("long").alias("steps")), "jump")]
    total = None
    while True:  # jumps[k] leads 2**k replies up, or ends at null above the root
        last = jumps[-1]
        if last.where("to is not null").isEmpty():
            total = last
            break
        if 2 ** (len(jumps) - 1) > n_nodes:
            raise ValueError("the reply links hold a cycle")
        far = last.select(F.col("conv").alias("c"), F.col("node").alias("n"), F.col("to").alias("further"),
                          F.col("score").alias("more"), F.col("steps").alias("on"))
        # branches that have reached their root take no further part
        further = last.where("to is not null").join(far, same & (F.col("to") == F.col("n")), "left").select(
            "conv", "node", F.col("further").alias("to"), (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
            (F.col("steps") + F.coalesce("on", F.lit(0))).alias("steps"))
        jumps.append(materialize(last.where("to is null").unionAll(further), "jump"))
    # total: every node's whole branch; leaves are nodes without a reply
    replied = jumps[0].where("to is not null").select(F.col("conv").alias("c"), F.col("to").alias("n")).distinct()
    leaves = total.join(replied, same & (F.col("node") == F.col("n")), "left_anti")
    best = Window.partitionBy("conv").orderBy(F.desc("score"), F.desc("steps"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= branches)
    path = chosen.select("conv", F.col("node").alias("leaf"), "rank", F.lit(0).cast("long").alias("up"), "node")
    for k, jump in enumerate(jumps[:-1]):  # after round k a path holds its lowest 2**(k+1) nodes
        up = jump.where("to is not null").select(F.col("conv").alias("c"), F.col("node").alias("n"), "to")
        above = path.join(up, same & (F.col("node") == F.col("n"))).select(
            "conv", "leaf", "rank", (F.col("up") + 2**k).alias("up"), F.col("to").alias("node"))
        path = materialize(path.unionAll(above), "paths")  # else every round would double the plan
    return path


def format_trees(nodes: DataFrame, branches: int = 1, loss_role: str = "assistant") -> DataFrame:
    """Format the best ``branches`` root-to-leaf paths of every conversation.

    ``nodes``: ``conv, node, parent, role, text, score``, node ids unique in a
    conversation. Returns ``conv, rank, formatted, loss`` with ``loss`` an array of
    (start, length).
    """
    nodes = materialize(nodes.select("conv", "node", "parent", "role", "text", "score"), "nodes")
    path = _paths(nodes, branches)
    texts = nodes.select(F.col("conv").alias("c"), F.col("node").alias("n"), "role",
                         F.concat(F.lit(OPEN), escape(text_or_empty("role")), F.lit(MID)).alias("head"),
                         escape(text_or_empty("text")).alias("body"))
    turns = path.join(texts, F.col("conv").eqNullSafe(F.col("c")) & (F.col("node") == F.col("n")))
    size = F.length("head") + F.length("body") + F.lit(len(CLOSE))
    before = Window.partitionBy("conv", "rank").orderBy(F.desc("up")).rowsBetween(Window.unboundedPreceding, -1)
    turns = turns.withColumn("at", F.coalesce(F.sum(size).over(before), F.lit(0)).cast("int"))
    turn = F.struct((-F.col("up")).alias("nth"), "at", "head", "body", F.col("role").eqNullSafe(loss_role).alias("loss"))
    talks = turns.groupBy("conv", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))), "")
    spans = F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(
        (t["at"] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length")))
    return talks.select("conv", "rank", formatted.alias("formatted"), spans.alias("loss"))


def parse(formatted: Column) -> Column:
    """The messages of a formatted conversation: array of (role, text), unescaped."""
    parts = F.filter(F.split(formatted, CLOSE), lambda p: F.length(p) > 0)
    return F.transform(parts, lambda p: F.struct(
        unescape(F.substring_index(F.substring(p, len(OPEN) + 1, 2**31 - 1), MID, 1)).alias("role"),
        unescape(F.substring(p, F.instr(p, MID) + F.lit(1), F.length(p))).alias("text")))


def masked_texts(formatted: Column, loss: Column) -> Column:
    """The texts under the loss mask, in order, unescaped."""
    return F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["length"])))
