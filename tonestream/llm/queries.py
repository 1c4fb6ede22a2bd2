"""The registered queries of the operators, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonestream.llm import (ann, chat, decontaminate, exact_dedup, hard_negatives, mixing, ngram_join, packing, periodic_runs,
                            quality, suffix_dedup, token_count, url_filter)
from tonestream.llm.common import WORD, table, text_or_empty


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return exact_dedup.annotate(docs, keep="max")


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_file("word_bpe_49k.json"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op4_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_file("byte_bpe_50k.json"))


#: A conversation whose texts hold the template's own control strings.
TRICKY = r"\### Assistant: </turn> ok"


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    more = spark.range(1).select(F.explode(F.array(*[
        F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(role).alias("role"),
                 F.lit(TRICKY).alias("text")) for k, role in enumerate(("user", "assistant"))])).alias("r")).select("r.*")
    out = chat.format_trees(chat.linear(given.unionByName(more)))
    back = out.select(F.col("conv").alias("conv_id"), "formatted", chat.parse(F.col("formatted")).alias("turns"),
                      F.array_join(chat.masked_texts(F.col("formatted"), F.col("loss")), "").alias("learned"))
    shown = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(shown, 256).alias("turns_sha256"),
                       F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    return quality.score(docs, quality.learn(docs, labels))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removed(table(spark, sf_dir, "documents", "doc_id", "text")).drop("spans")


def op8_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.annotate(table(spark, sf_dir, "documents", "doc_id", "text"))


#: (rule, verdict); a rule is a host and the beginning of a path.
URL_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
             ("net/fr/", "block"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)


def op10_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.search(vectors, F.col("id") % 20 == 0, k=20)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents of which the contract asks (by the CRC-32 of their ids) with a period planted from some word on."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))

    def planted(w):
        n = F.size(w)
        g = F.floor(h / 10)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        at = lambda i: F.when(i < a, i).otherwise(a + F.pmod(i - a, p)).cast("int")
        return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.element_at(w, at(i) + 1)), " ")).otherwise("")

    words = F.regexp_extract_all(text_or_empty("text"), F.lit(WORD), F.lit(0))
    # the array of one element binds the words to a name, so they are taken from the text once
    text = F.when(F.pmod(h, F.lit(10)) == 0, F.transform(F.array(words), planted)[0]).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_planted_runs(table(spark, sf_dir, "documents", "doc_id", "text")))
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","),
                                                   r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("top", periodic_runs.longest(F.col("runs"))).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.annotate(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"), label, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_exact_dedup, op2_best_fit_packing, op3_mix_sources, op4_token_count, op5_chat_format,
        op6_quality, op7_suffix_dedup, op8_ngram_join, op9_url_filter, op10_nearest, op11_periodic_runs,
        op12_decontaminate, op13_hard_negatives)
}

SQL: dict[str, str] = {
    "op1_exact_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
                   FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
        FROM t""",
    "op5_chat_format": r"""
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
                   UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
             e AS (SELECT *, replace(replace(replace(text, '\', '\b'), '<', '\l'), '>', '\g') AS escaped FROM c),
             s AS (SELECT conv_id, count(*) AS n_turns,
                          string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS shown,
                          coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS learned,
                          sum(length('<turn ' || role || '>' || escaped || '</turn>') + 1) AS formatted_chars
                   FROM e GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(shown) AS turns_sha256, length(learned)::BIGINT AS loss_chars,
               sha256(learned) AS loss_sha256, formatted_chars::BIGINT AS formatted_chars FROM s""",
    "op9_url_filter": r"""
        WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
                   FROM pages),
             p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                             'abcdefghijklmnopqrstuvwxyz') AS host,
                          regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
             r AS (SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                                         ('net', '/es/', 'block'), ('net', '/fr/', 'block')) t(rule_host, rule_path, verdict)),
             f AS (SELECT page_id, rule_host || rule_path AS rule, verdict,
                          row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC) AS nth
                   FROM p JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
        SELECT p.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM p LEFT JOIN f ON f.page_id = p.page_id AND nth = 1""",
    "op12_decontaminate": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
             b AS (SELECT coalesce(item_id::VARCHAR, '') AS item,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
             g AS (SELECT DISTINCT item, len(w[a:a + 9]) AS n, array_to_string(w[a:a + 9], ' ') AS gram
                   FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS a FROM b WHERE len(w) > 0)),
             p AS (SELECT r, w, unnest(generate_series(1, len(w))) AS a FROM d WHERE len(w) > 0),
             h AS (SELECT p.r, p.a, g.n, g.item
                   FROM (SELECT r, a, n, array_to_string(w[a:a + n - 1], ' ') AS gram FROM p, (SELECT DISTINCT n FROM g) s WHERE a + n - 1 <= len(w)) p
                   JOIN g ON g.gram = p.gram AND g.n = p.n),
             c AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(generate_series(a, a + n - 1)) AS pos FROM h) GROUP BY r),
             i AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN c USING (r) LEFT JOIN i USING (r)""",
    "op13_hard_negatives": """
        WITH r AS (SELECT row_number() OVER () AS row, vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
                   FROM embeddings
                   WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
                     AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
             s AS (SELECT a.row AS a_row, a.id AS anchor_id, a.label = c.label AS same, c.id, list_inner_product(a.v, c.v)::BIGINT AS score
                   FROM r a JOIN r c ON a.row <> c.row WHERE a.id % 100 = 0),
             p AS (SELECT a_row, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY a_row ORDER BY score DESC, id) AS nth
                   FROM s WHERE same QUALIFY nth <= 5),
             n AS (SELECT anchor_id, positive_id, nth, row_number() OVER (PARTITION BY a_row, nth ORDER BY score DESC, id) AS rank,
                          id AS negative_id, positive_score, score AS negative_score
                   FROM s JOIN p USING (a_row) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
        SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10""",
}
