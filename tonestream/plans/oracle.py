"""DuckDB SQL for the registered queries (the correctness oracle).

Each string runs on DuckDB with the parquet tables registered as views and
returns the same columns as the Spark query of the same name. The regex
classes spell out what Python's ``\\s`` and ``\\w`` match, since DuckDB's
RE2 shorthands are ASCII-only.
"""

from __future__ import annotations

from tonestream.functions.clean import NLTK_STOP_WORDS, STOP_WORDS
from tonestream.operators.filters import TOPIC_KEYWORDS
from tonestream.plans.queries import DATA_KEYWORDS, HASHED_C

def sql_list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


STOP_SQL = sql_list(NLTK_STOP_WORDS)
SPARK_STOP_SQL = sql_list(STOP_WORDS)
WS = r"\t-\r\x{1C}-\x{1F}\x{85}\p{Z}"
WORD = r"\p{L}\p{N}_"
BODY = "(url || ' ' || html)"


def urls_v1(x: str) -> str:
    return f"regexp_replace({x}, 'http[^{WS}]+', '', 'g')"


def urls_v2(x: str) -> str:
    return rf"regexp_replace({x}, 'http[^{WS}]+|www\.[^{WS}]+', ' ', 'g')"


def mentions(x: str) -> str:
    return f"regexp_replace({x}, '[@#][{WORD}]+', ' ', 'g')"


def letters(x: str) -> str:
    return f"lower(regexp_replace({x}, '[^a-zA-Z]', ' ', 'g'))"


def words(x: str, min_len: int, stops: bool = True, stop_sql: str = STOP_SQL) -> str:
    cond = f"length(w) >= {min_len}" + (f" AND w NOT IN ({stop_sql})" if stops else "")
    return f"list_filter(string_split_regex({x}, ' +'), lambda w: {cond})"


def words_v2(x: str) -> str:
    return words(letters(mentions(urls_v2(x))), 3)


def clean_v1(x: str) -> str:
    return f"array_to_string({words(letters(urls_v1(x)), 1)}, ' ')"


def clean_v2(x: str, stop_sql: str = STOP_SQL) -> str:
    return f"array_to_string({words(letters(mentions(urls_v2(x))), 3, True, stop_sql)}, ' ')"


def letter_text(x: str) -> str:
    return f"trim(regexp_replace({letters(mentions(urls_v2(x)))}, ' +', ' ', 'g'))"


def blank(x: str) -> str:
    return f"regexp_full_match({x}, '[{WS}]*')"


def unit(key: str) -> str:
    return f"CAST(('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296::DOUBLE"


def topic_sql(keywords) -> str:
    alts = "|".join(k.lower() for k in keywords)
    return ("SELECT doc_id, lang, text FROM documents WHERE lang = 'en' AND "
            f"regexp_matches(text, '(?i)(^|[^{WORD}])({alts})([^{WORD}]|$)') AND "
            "NOT regexp_matches(text, '^RT @')")


def snippet(x: str, n: int) -> str:
    return f"replace(substring({x}, 1, {n}), chr(10), ' ')"


TWEETS = """tweets AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality AS target, l.quality * 4 AS raw_label, l.toxic
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

SCORED = TWEETS + """,
scored AS (SELECT *, CASE WHEN toxic = 0 THEN 1::DOUBLE ELSE 0::DOUBLE END AS prediction FROM tweets)"""

COUNTS = SCORED + """,
yp AS (SELECT CAST(target AS INTEGER) AS y, CAST(prediction AS INTEGER) AS p FROM scored),
c AS (SELECT count(*) FILTER (WHERE y = 0 AND p = 0) AS tn, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
             count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 1 AND p = 1) AS tp FROM yp),
b AS (SELECT tn + fp AS s0, fn + tp AS s1, tn + fp + fn + tp AS n,
        CASE WHEN tn + fn = 0 THEN 0::DOUBLE ELSE CAST(tn AS DOUBLE) / CAST(tn + fn AS DOUBLE) END AS p0,
        CASE WHEN tn + fp = 0 THEN 0::DOUBLE ELSE CAST(tn AS DOUBLE) / CAST(tn + fp AS DOUBLE) END AS r0,
        CASE WHEN tp + fp = 0 THEN 0::DOUBLE ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END AS p1,
        CASE WHEN fn + tp = 0 THEN 0::DOUBLE ELSE CAST(tp AS DOUBLE) / CAST(fn + tp AS DOUBLE) END AS r1,
        CASE WHEN tn + fp + fn + tp = 0 THEN 0::DOUBLE
             ELSE CAST(tn + tp AS DOUBLE) / CAST(tn + fp + fn + tp AS DOUBLE) END AS acc
      FROM c),
f AS (SELECT *, CASE WHEN p0 + r0 = 0 THEN 0::DOUBLE ELSE 2::DOUBLE * p0 * r0 / (p0 + r0) END AS f0,
                CASE WHEN p1 + r1 = 0 THEN 0::DOUBLE ELSE 2::DOUBLE * p1 * r1 / (p1 + r1) END AS f1 FROM b)"""

REPORT = "WITH " + COUNTS + """
SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM f
UNION ALL SELECT '1', p1, r1, f1, s1 FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, acc, n FROM f
UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM f
UNION ALL SELECT 'weighted avg',
  CASE WHEN n = 0 THEN 0::DOUBLE ELSE (p0 * s0 + p1 * s1) / CAST(n AS DOUBLE) END,
  CASE WHEN n = 0 THEN 0::DOUBLE ELSE (r0 * s0 + r1 * s1) / CAST(n AS DOUBLE) END,
  CASE WHEN n = 0 THEN 0::DOUBLE ELSE (f0 * s0 + f1 * s1) / CAST(n AS DOUBLE) END, n FROM f"""

THREE_CLASSES = "WITH " + TWEETS + """,
t AS (SELECT CASE WHEN toxic = 1 THEN 2::DOUBLE ELSE raw_label::DOUBLE END AS target,
             CASE WHEN n_chars % 5 = 0 THEN 2::DOUBLE WHEN n_chars % 5 = 1 THEN 0::DOUBLE ELSE raw_label::DOUBLE END AS prediction
      FROM tweets)"""

LABELLED = TWEETS + f""",
cl AS (SELECT doc_id, target, {clean_v2('text')} AS clean_text FROM tweets),
lab AS (SELECT doc_id, target, clean_text, coalesce({unit('doc_id')} < 0.8::DOUBLE, false) AS is_train,
               list_filter(string_split(clean_text, ' '), lambda w: w <> '') AS words
        FROM cl WHERE doc_id IS NOT NULL AND target IS NOT NULL AND clean_text IS NOT NULL
          AND NOT {blank('clean_text')})"""

NB_MODEL = LABELLED + """,
tr AS (SELECT * FROM lab WHERE is_train),
ct AS (SELECT term, count(*) FILTER (WHERE y = 0) AS c0, count(*) FILTER (WHERE y = 1) AS c1
       FROM (SELECT CAST(target AS INTEGER) AS y, unnest(words) AS term FROM tr) GROUP BY term),
st AS (SELECT count(*) AS v, sum(c0) AS t0, sum(c1) AS t1 FROM ct),
pr AS (SELECT ln(count(*) FILTER (WHERE CAST(target AS INTEGER) = 0) + 1::DOUBLE) - ln(count(*) + 2::DOUBLE) AS pr0,
              ln(count(*) FILTER (WHERE CAST(target AS INTEGER) = 1) + 1::DOUBLE) - ln(count(*) + 2::DOUBLE) AS pr1
       FROM tr),
mdl AS (SELECT term, ln(c0 + 1::DOUBLE) - ln(t0 + v * 1::DOUBLE) AS ll0,
                     ln(c1 + 1::DOUBLE) - ln(t1 + v * 1::DOUBLE) AS ll1 FROM ct, st)"""


def nb_scores(rows_cte: str, id_cols: str) -> str:
    """CTEs ``sc`` and ``res`` scoring ``rows_cte`` (id columns + ``words``)."""
    return f""",
sc AS (SELECT {id_cols}, sum(ll0) AS s0, sum(ll1) AS s1
       FROM (SELECT {id_cols}, unnest(words) AS term FROM {rows_cte}) JOIN mdl USING (term) GROUP BY {id_cols}),
res AS (SELECT r.*, pr.pr0 + coalesce(sc.s0, 0) AS raw0, pr.pr1 + coalesce(sc.s1, 0) AS raw1
        FROM {rows_cte} r LEFT JOIN sc USING ({id_cols}), pr),
out AS (SELECT *, CASE WHEN raw1 > raw0 THEN 1::DOUBLE ELSE 0::DOUBLE END AS prediction,
          CASE WHEN raw0 - raw1 >= 0 THEN exp(-(raw0 - raw1)) / (1 + exp(-(raw0 - raw1)))
               ELSE 1 / (1 + exp(raw0 - raw1)) END AS p_pos FROM res)"""


NB_HOLDOUT = "WITH " + NB_MODEL + """,
te AS (SELECT * FROM lab WHERE NOT is_train)""" + nb_scores("te", "doc_id")

DOC_WORDS = f"w AS (SELECT doc_id, {words_v2('text')} AS words FROM documents)"
DOC_TERMS = DOC_WORDS + """,
t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM w) GROUP BY doc_id, term)"""
NGRAM_TERMS = DOC_WORDS + """,
g AS (SELECT doc_id, list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))
      AS grams FROM w),
t AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(grams) AS term FROM g) GROUP BY doc_id, term),
s AS (SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf FROM t GROUP BY term),
v AS (SELECT term, df, cf FROM s WHERE df >= 2 ORDER BY cf DESC, term LIMIT 20000)"""

MESSAGES_SQL = f"""WITH v AS (
  SELECT conv_id, turn,
    CASE WHEN role = 'user' THEN to_json({{'text': text}})::VARCHAR
         WHEN role = 'assistant' THEN to_json({{'body': text}})::VARCHAR
         ELSE substring(to_json({{'text': text}})::VARCHAR, 1, 10) END AS value
  FROM conversations)
SELECT conv_id, turn, CASE WHEN json_valid(value) THEN 'ok' ELSE 'quarantine' END AS status,
  CASE WHEN NOT json_valid(value) THEN NULL
       WHEN json_type(value) = 'OBJECT' THEN coalesce(json_extract_string(value, '$.text'), '')
       ELSE json_extract_string(value, '$') END AS text
FROM v"""

SENTIMENT = "CASE CAST(prediction AS INTEGER) WHEN 0 THEN 'Negative' WHEN 1 THEN 'Positive' END"


def distribution(src: str) -> str:
    return f""",
gd AS (SELECT sentiment, count(*) AS n FROM (SELECT {SENTIMENT} AS sentiment FROM {src})
       WHERE sentiment IS NOT NULL GROUP BY sentiment),
td AS (SELECT sentiment, n, sum(n) OVER () AS total FROM gd)
SELECT sentiment, n, CAST((2000 * n + total) // (2 * total) AS DOUBLE) / 10 AS pct FROM td"""


STREAM_NB = ("WITH " + NB_MODEL + f""",
msg AS (SELECT conv_id, turn, coalesce({clean_v2("coalesce(text, '')")}, '') AS clean_text FROM conversations),
mw AS (SELECT conv_id, turn, clean_text, list_filter(string_split(clean_text, ' '), lambda w: w <> '') AS words
       FROM msg)""" + nb_scores("mw", "conv_id, turn")
    + " SELECT conv_id, turn, clean_text, prediction, round(p_pos, 6) AS p_pos FROM out")


UPLOAD_NB = ("WITH " + NB_MODEL + f""",
dc AS (SELECT doc_id, coalesce({clean_v2("coalesce(text, '')")}, '') AS clean_text FROM documents),
dw AS (SELECT doc_id, clean_text, list_filter(string_split(clean_text, ' '), lambda w: w <> '') AS words
       FROM dc)""" + nb_scores("dw", "doc_id") + distribution("out"))


REPLAY_LINES = ("WITH " + NB_MODEL + f""",
msg AS (SELECT conv_id, turn, text, coalesce({clean_v2("coalesce(text, '')")}, '') AS clean_text FROM conversations),
mw AS (SELECT conv_id, turn, text, clean_text, list_filter(string_split(clean_text, ' '), lambda w: w <> '') AS words
       FROM msg)""" + nb_scores("mw", "conv_id, turn") + f"""
SELECT conv_id, turn, {snippet("coalesce(text, '')", 120)} || ' -> ' ||
  CASE WHEN prediction = 1 THEN 'Positive' ELSE 'Negative' END ||
  ' (conf: ' || printf('%.2f/%.2f', 1 - p_pos, p_pos) || ')' AS display_line
FROM out""")


MASK = "4294967295::UBIGINT"


def murmur3(terms_cte: str, out: str, seed: int = 42) -> str:
    """CTE ``out (term, h)``: the 32-bit murmur3 hash of the ASCII ``term``s of a CTE, a UBIGINT."""
    byte = lambda p: f"(CASE WHEN {p} <= length(term) THEN ascii(substr(term, ({p})::BIGINT, 1)) ELSE 0 END)::UBIGINT"
    word = lambda p: f"{byte(f'{p} + 1')} + {byte(f'{p} + 2')} * 256 + {byte(f'{p} + 3')} * 65536 + {byte(f'{p} + 4')} * 16777216"
    turn = lambda x, r: f"((({x}) << {r}) | (({x}) >> {32 - r})) & {MASK}"
    mixed = lambda k: f"(({turn(f'(({k}) * 3432918353::UBIGINT) & {MASK}', 15)}) * 461845907::UBIGINT) & {MASK}"
    return f""",
mk AS (SELECT term, length(term)::UBIGINT AS n, [{mixed('b')} FOR b IN [{word('i * 4')} FOR i IN range(length(term) // 4)]] AS blocks,
              {mixed(word('(length(term) // 4) * 4'))} AS rest FROM (SELECT DISTINCT term FROM {terms_cte})),
m0 AS (SELECT term, xor(xor(list_reduce(list_prepend({seed}::UBIGINT, blocks),
                lambda h, k: (({turn('xor(h, k)', 13)}) * 5 + 3864292196::UBIGINT) & {MASK}), rest), n) AS h FROM mk),
m1 AS (SELECT term, (xor(h, h >> 16) * 2246822507::UBIGINT) & {MASK} AS h FROM m0),
m2 AS (SELECT term, (xor(h, h >> 13) * 3266489909::UBIGINT) & {MASK} AS h FROM m1),
{out} AS (SELECT term, xor(h, h >> 16) AS h FROM m2)"""


#: A hash as Spark's non-negative bucket number of 10,000, by its signed value.
BUCKET = ("(((CASE WHEN h >= 2147483648 THEN h::BIGINT - 4294967296 ELSE h::BIGINT END) % 10000 + 10000) % 10000)::INTEGER")


def hashed_weights(words_cte: str) -> str:
    """CTEs ``hw (doc_id, bucket, tf)``, ``hi (bucket, idf)`` over the documents of ``words_cte (doc_id, words)``."""
    return f""",
ht AS (SELECT doc_id, unnest(words) AS term FROM {words_cte})""" + murmur3("ht", "hh") + f""",
hw AS (SELECT doc_id, {BUCKET} AS bucket, count(*)::DOUBLE AS tf FROM ht JOIN hh USING (term) GROUP BY ALL)"""


#: What the trainers' tokenizer and stop-word remover leave of a cleaned text; an empty text is one empty token.
HASH_WORDS = (f"c AS (SELECT doc_id, coalesce({clean_v2('text')}, '') AS t FROM documents), "
              f"hx AS (SELECT doc_id, list_filter(string_split(t, ' '), lambda w: w NOT IN ({SPARK_STOP_SQL})) AS words FROM c)")
HASHED_DOCS = "WITH " + HASH_WORDS + hashed_weights("hx") + """,
hi AS (SELECT bucket, ln((n + 1::DOUBLE) / (count(*) + 1::DOUBLE)) AS idf FROM hw, (SELECT count(*) AS n FROM hx) GROUP BY bucket, n)"""


def logistic_optimum(rows: str, c: float, curvature: str, steps: int = 600) -> str:
    """The penalised optimum's probabilities, found in SQL by accelerated gradient steps on the training rows' multipliers.

    ``rows`` is a CTE ``(doc_id, y, is_train, f, x)`` of all entries; ``curvature`` bounds the largest eigenvalue of the Hessian. The
    weights are ``sum a_i x_i``, so a step needs only the inner products of rows (a constant feature's 1 included). CTE ``po (doc_id, z)``.
    """
    return f""",
ids AS (SELECT DISTINCT doc_id, y, is_train FROM {rows}),
kp AS (SELECT a.doc_id AS i, b.doc_id AS j, sum(a.x * b.x) AS k FROM {rows} a JOIN {rows} b ON a.f = b.f AND b.is_train GROUP BY ALL),
kk AS MATERIALIZED (SELECT p.doc_id AS i, q.doc_id AS j, coalesce(k, 0) + 1 AS k
       FROM ids p JOIN ids q ON q.is_train LEFT JOIN kp ON kp.i = p.doc_id AND kp.j = q.doc_id),
kt AS MATERIALIZED (SELECT i, j, k FROM kk JOIN ids ON doc_id = i WHERE is_train),
yt AS MATERIALIZED (SELECT doc_id, y FROM ids WHERE is_train),
lm AS MATERIALIZED (SELECT {curvature} AS l),
po_steps AS (
  SELECT 0 AS t, doc_id, 0::DOUBLE AS a, 0::DOUBLE AS v FROM yt
  UNION ALL
  SELECT t + 1, doc_id, n AS a, n + (sqrt(l) - 1) / (sqrt(l) + 1) * (n - a) AS v
  FROM (SELECT s.t, s.doc_id, s.a, l, s.v - (s.v - {c} * (y - 1 / (1 + exp(-z)))) / l AS n
        FROM po_steps s JOIN yt USING (doc_id) JOIN (SELECT kt.i, sum(kt.k * o.v) AS z FROM kt JOIN po_steps o ON o.doc_id = kt.j GROUP BY kt.i) m
          ON m.i = s.doc_id, lm) WHERE t < {steps}),
po AS (SELECT kk.i AS doc_id, sum(kk.k * s.a) AS z FROM kk JOIN (SELECT * FROM po_steps WHERE t = {steps}) s ON s.doc_id = kk.j GROUP BY kk.i)"""


def logistic_holdout(rows: str, c: float, curvature: str) -> str:
    return logistic_optimum(rows, c, curvature) + f"""
SELECT ids.doc_id, lab.target, (z > 0)::DOUBLE AS prediction, round(1 / (1 + exp(-z)), 6) AS p_pos
FROM ids JOIN po USING (doc_id) JOIN lab USING (doc_id) WHERE NOT ids.is_train"""


#: 1-2-gram TF-IDF rows of the labelled texts over the vocabulary of the training side, and each text without a term.
VOCAB_ROWS = LABELLED + """,
lg AS (SELECT doc_id, CAST(target AS INTEGER) AS y, is_train, list_concat(words, list_transform(range(1, len(words)),
              lambda i: words[i] || ' ' || words[i + 1])) AS grams FROM lab),
lt AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(grams) AS term FROM lg) GROUP BY ALL),
ls AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM lt JOIN lg USING (doc_id) WHERE is_train GROUP BY term),
lv AS (SELECT term, df FROM ls WHERE df >= 2 ORDER BY cf DESC, term LIMIT 20000),
lr AS (SELECT doc_id, term, tf * (ln((n + 1::DOUBLE) / (df + 1::DOUBLE)) + 1) AS raw
       FROM lt JOIN lv USING (term), (SELECT count(*) AS n FROM lg WHERE is_train)),
le AS MATERIALIZED (SELECT lg.doc_id, y, is_train, term AS f, coalesce(raw / sqrt(sum(raw * raw) OVER (PARTITION BY lg.doc_id)), 0) AS x
       FROM lg LEFT JOIN lr USING (doc_id))"""

#: Hashed TF-IDF rows of the labelled texts, IDF of the training side.
HASHED_ROWS = LABELLED + f""",
hx AS (SELECT doc_id, list_filter(string_split(clean_text, ' '), lambda w: w NOT IN ({SPARK_STOP_SQL})) AS words FROM lab)""" + hashed_weights("hx") + """,
hi AS (SELECT bucket, ln((n + 1::DOUBLE) / (count(*) + 1::DOUBLE)) AS idf
       FROM hw JOIN lab USING (doc_id), (SELECT count(*) AS n FROM lab WHERE is_train) WHERE is_train GROUP BY bucket, n),
he AS MATERIALIZED (SELECT lab.doc_id, CAST(target AS INTEGER) AS y, is_train, bucket AS f, coalesce(tf * coalesce(idf, ln(n + 1::DOUBLE)), 0) AS x
       FROM lab LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (bucket), (SELECT count(*) AS n FROM lab WHERE is_train))"""


SQL: dict[str, str] = {
    "q01_binarize_label": f"WITH {TWEETS} SELECT doc_id, raw_label, "
                          "CASE WHEN TRY_CAST(raw_label AS INTEGER) = 4 THEN 1 "
                          "WHEN TRY_CAST(raw_label AS INTEGER) IS NOT NULL THEN 0 END AS target, text FROM tweets",
    "q02_clean_v1": f"SELECT doc_id, {clean_v1('text')} AS clean_text FROM documents",
    "q03_clean_v2": f"SELECT doc_id, {clean_v2('text')} AS clean_text FROM documents",
    "q04_strip_urls": f"SELECT page_id, {urls_v1(BODY)} AS stripped_v1, {urls_v2(BODY)} AS stripped_v2 FROM pages",
    "q05_strip_mentions": f"SELECT doc_id, {mentions('text')} AS stripped FROM documents",
    "q06_drop_blank_and_null": f"WITH {TWEETS}, t AS (SELECT doc_id, target, {clean_v2('text')} AS clean_text "
                               f"FROM tweets WHERE text IS NOT NULL AND NOT {blank('text')}) "
                               "SELECT doc_id, target, clean_text FROM t WHERE doc_id IS NOT NULL AND target IS NOT NULL "
                               f"AND clean_text IS NOT NULL AND NOT {blank('clean_text')}",
    "q07_clean_row_counts": f"WITH {TWEETS}, t AS (SELECT target, {clean_v2('text')} AS clean_text FROM tweets) "
                            "SELECT count(*) AS rows_before, count(*) FILTER (WHERE target IS NOT NULL AND clean_text "
                            f"IS NOT NULL AND NOT {blank('clean_text')}) AS rows_after FROM t",
    "q08_topic_filter": topic_sql(TOPIC_KEYWORDS),
    "q40_topic_filter_keywords": topic_sql(DATA_KEYWORDS),
    "q41_clean_v2_spark_stop_words": f"SELECT doc_id, {clean_v2('text', SPARK_STOP_SQL)} AS clean_text FROM documents",
    "q09_snippet": f"SELECT conv_id, turn, {snippet('text', 120)} AS snippet, {snippet('text', 80)} AS snippet80 "
                   "FROM conversations",
    "q10_json_decode": "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, "
                       "json_extract_string(props, '$.k') AS k_text FROM events",
    "q11_json_encode": "SELECT conv_id, turn, text AS text_out FROM conversations",
    "q12_resolve_text_column": f"WITH {TWEETS} SELECT doc_id, target, coalesce(text, '') AS clean_text FROM tweets",
    "q13_label_names": f"WITH {SCORED} SELECT doc_id, CAST(prediction AS INTEGER) AS pred, "
                       "CASE WHEN CAST(prediction AS INTEGER) = 1 THEN 'Positive' ELSE 'Negative' END AS sentiment, "
                       "CASE WHEN raw_label = 0 THEN 'Negative' WHEN raw_label = 1 THEN 'Positive' END AS raw_sentiment "
                       "FROM scored",
    "q14_accuracy": f"WITH {SCORED} SELECT count(*) AS n, "
                    "count(*) FILTER (WHERE prediction = CAST(target AS DOUBLE)) AS correct, "
                    "CASE WHEN count(*) = 0 THEN 0::DOUBLE ELSE CAST(count(*) FILTER (WHERE prediction = "
                    "CAST(target AS DOUBLE)) AS DOUBLE) / CAST(count(*) AS DOUBLE) END AS accuracy FROM scored",
    "q15_class_report": REPORT,
    "q16_confusion_matrix": f"WITH {SCORED}, gm AS (SELECT CAST(target AS INTEGER) AS target, "
                            "count(*) FILTER (WHERE CAST(prediction AS INTEGER) = 0) AS pred_0, "
                            "count(*) FILTER (WHERE CAST(prediction AS INTEGER) = 1) AS pred_1 FROM scored GROUP BY 1) "
                            "SELECT k.target, coalesce(gm.pred_0, 0) AS pred_0, coalesce(gm.pred_1, 0) AS pred_1 "
                            "FROM (SELECT unnest([0, 1]) AS target) k LEFT JOIN gm ON k.target = gm.target",
    "q17_sentiment_distribution": f"WITH {SCORED}" + distribution("scored"),
    "q18_scored_preview": f"WITH {SCORED} SELECT doc_id, text, lang, source, n_chars, target, raw_label, toxic, "
                          f"prediction, CAST(prediction AS INTEGER) AS pred, {SENTIMENT} AS sentiment "
                          "FROM scored ORDER BY doc_id LIMIT 30",
    "q19_display_line": f"WITH {SCORED}, sp AS (SELECT *, CAST(n_chars % 1001 AS DOUBLE) / 1000 AS p_pos FROM scored) "
                        f"SELECT doc_id, {snippet('text', 120)} || ' -> ' || CASE WHEN prediction = 1 THEN 'Positive' "
                        "ELSE 'Negative' END || ' (conf: ' || printf('%.2f/%.2f', 1 - p_pos, p_pos) || ')' "
                        "AS display_line FROM sp",
    "q20_evaluator_accuracy": "WITH " + COUNTS + """
SELECT round(acc, 10) AS accuracy,
  round(CASE WHEN n = 0 THEN 0::DOUBLE ELSE p0 * s0 / n + p1 * s1 / n END, 10) AS weighted_precision,
  round(CASE WHEN n = 0 THEN 0::DOUBLE ELSE r0 * s0 / n + r1 * s1 / n END, 10) AS weighted_recall,
  round(CASE WHEN n = 0 THEN 0::DOUBLE ELSE f0 * s0 / n + f1 * s1 / n END, 10) AS weighted_f1 FROM f""",
    "q21_token_counts": f"WITH d AS (SELECT doc_id, coalesce({letter_text('text')}, '') AS letters FROM documents), "
                        "tw AS (SELECT doc_id, string_split(letters, ' ') AS words FROM d), "
                        f"tf AS (SELECT doc_id, words, list_filter(words, lambda w: w NOT IN ({SPARK_STOP_SQL})) AS fl FROM tw) "
                        "SELECT doc_id, CAST(len(words) AS INTEGER) AS n_words, CAST(len(fl) AS INTEGER) AS n_filtered, "
                        "array_to_string(fl, ' ') AS filtered_text FROM tf",
    "q22_term_doc_frequency": f"WITH {DOC_TERMS} SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf "
                              "FROM t GROUP BY term",
    "q23_tfidf_spark_weight": f"WITH {DOC_TERMS}, s AS (SELECT term, count(*) AS df FROM t GROUP BY term), "
                              "m AS (SELECT count(*) AS n FROM w), "
                              "j AS (SELECT t.doc_id, t.term, t.tf, s.df, ln((m.n + 1::DOUBLE) / (s.df + 1::DOUBLE)) "
                              "AS idf FROM t JOIN s ON t.term = s.term, m) "
                              "SELECT doc_id, term, tf, df, round(idf, 6) AS idf, round(tf * idf, 6) AS w FROM j",
    "q24_tfidf_sklearn_weight": f"WITH {NGRAM_TERMS}, m AS (SELECT count(*) AS n FROM w), "
                                "r AS (SELECT t.doc_id, t.term, t.tf, t.tf * (ln((m.n + 1::DOUBLE) / (v.df + 1::DOUBLE)) "
                                "+ 1) AS raw FROM t JOIN v ON t.term = v.term, m) "
                                "SELECT doc_id, term, tf, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) "
                                "AS w FROM r",
    "q25_top_terms": f"WITH {NGRAM_TERMS} SELECT term, df, cf FROM v",
    "q27_hash_split": f"WITH {TWEETS} SELECT doc_id, target, coalesce({unit('doc_id')} < 0.8::DOUBLE, false) "
                      "AS is_train FROM tweets",
    "q28_stratified_split": f"WITH {TWEETS} SELECT doc_id, target, row_number() OVER (PARTITION BY target ORDER BY "
                            "md5(CAST(doc_id AS VARCHAR)), doc_id) <= floor(0.8::DOUBLE * count(*) OVER "
                            "(PARTITION BY target)) AS is_train FROM tweets",
    "q29_naive_bayes_scores": NB_HOLDOUT + " SELECT doc_id, target, prediction, round(p_pos, 6) AS p_pos FROM out",
    "q32_stream_clean_score": STREAM_NB,
    "q33_stream_quarantine": MESSAGES_SQL,
    "q42_stream_naive_bayes_ml": STREAM_NB,
    "q43_score_uploaded_csv": UPLOAD_NB,
    "q44_replay_display_lines": REPLAY_LINES,
    "q34_csv_round_trip": f"WITH {TWEETS} SELECT 'sentiment140' AS layout, target, replace(replace(text, chr(13), ' '), chr(10), ' ') AS text FROM tweets "
                          "UNION ALL SELECT 'generic' AS layout, target, text FROM tweets",
    "q35_model_save_load": "WITH " + LABELLED + " SELECT doc_id, 0::DOUBLE AS differs, 0::DOUBLE AS label_differs, "
                           "TRUE AS label_follows_p FROM lab WHERE NOT is_train",
    "q36_metrics_json": REPORT,
    "q45_report_of_three_classes": THREE_CLASSES + """,
k AS (SELECT target AS c FROM t UNION SELECT prediction FROM t),
a AS (SELECT c, (SELECT count(*) FROM t WHERE target = c) AS s, (SELECT count(*) FROM t WHERE prediction = c) AS m,
             (SELECT count(*) FROM t WHERE target = c AND prediction = c) AS h FROM k),
r AS (SELECT c, s, h, CASE WHEN m = 0 THEN 0::DOUBLE ELSE h / m::DOUBLE END AS p,
             CASE WHEN s = 0 THEN 0::DOUBLE ELSE h / s::DOUBLE END AS r FROM a),
f AS (SELECT *, CASE WHEN p + r = 0 THEN 0::DOUBLE ELSE 2::DOUBLE * p * r / (p + r) END AS f FROM r)
SELECT CAST(CAST(c AS BIGINT) AS VARCHAR) AS class, round(p, 10) AS precision, round(r, 10) AS recall, round(f, 10) AS f1, s AS support FROM f
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(h) / sum(s)::DOUBLE, 10), CAST(sum(s) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(p), 10), round(avg(r), 10), round(avg(f), 10), CAST(sum(s) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s)::DOUBLE, 10), round(sum(r * s) / sum(s)::DOUBLE, 10),
  round(sum(f * s) / sum(s)::DOUBLE, 10), CAST(sum(s) AS BIGINT) FROM f""",
    "q46_confusion_cells": THREE_CLASSES + " SELECT target AS label, prediction, count(*) AS n FROM t GROUP BY target, prediction",
    "q47_read_cleaned": f"WITH {TWEETS}, t AS (SELECT target, {clean_v2('text')} AS clean_text FROM tweets), "
                        f"k AS (SELECT * FROM t WHERE clean_text IS NOT NULL AND NOT {blank('clean_text')}) "
                        "SELECT target, clean_text, 'csv' AS form FROM k UNION ALL SELECT target, clean_text, 'parquet' FROM k",
    "q49_hashed_term_counts": f"WITH c AS (SELECT doc_id, coalesce({clean_v2('text')}, '') AS t FROM documents) SELECT doc_id, "
                              f"len(list_filter(string_split(t, ' '), lambda w: w NOT IN ({SPARK_STOP_SQL}))) AS n_words FROM c",
    "q26_hashed_tfidf": HASHED_DOCS + " SELECT hx.doc_id, count(bucket) FILTER (WHERE idf <> 0)::INTEGER AS nnz, "
                        "round(coalesce(sum(tf * idf), 0), 6) AS l1 FROM hx LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (bucket) GROUP BY hx.doc_id",
    "q51_hashed_weights": HASHED_DOCS + " SELECT doc_id, bucket, round(tf * idf, 6) AS w FROM hw JOIN hi USING (bucket)",
    # every row has length 1 and a constant 1, so the Hessian's largest eigenvalue is at most 1 + 2 n / 4
    "q31_logistic_vocab_scores": "WITH RECURSIVE " + VOCAB_ROWS + logistic_holdout("le", 1, "(SELECT 1 + count(*) / 2 FROM yt)"),
    "q50_logistic_gradient": "WITH " + VOCAB_ROWS + " SELECT term, TRUE AS stationary FROM lv UNION ALL SELECT NULL, TRUE",
    "q52_logistic_hashed_penalised": "WITH RECURSIVE " + HASHED_ROWS + logistic_holdout(
        "he", HASHED_C, f"(SELECT 1 + {HASHED_C} / 4 * max(s) FROM (SELECT sum(abs(k)) AS s FROM kt GROUP BY i))"),
    "q54_stream_resume": "SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations",
    "q55_stream_progress": "WITH m AS (" + MESSAGES_SQL + ") SELECT kind, count(*) AS messages FROM "
                           "(SELECT unnest(['input', 'output', CASE status WHEN 'ok' THEN 'scored' ELSE status END]) AS kind FROM m) GROUP BY kind",
    "q56_score_texts": ("WITH " + NB_MODEL + f""",
dc AS (SELECT doc_id, coalesce({clean_v2("coalesce(text, '')")}, '') AS clean_text FROM documents ORDER BY doc_id LIMIT 30),
dw AS (SELECT doc_id, clean_text, list_filter(string_split(clean_text, ' '), lambda w: w <> '') AS words
       FROM dc)""" + nb_scores("dw", "doc_id") + f" SELECT clean_text, prediction, {SENTIMENT} AS sentiment, round(p_pos, 6) AS p_pos FROM out"),
    "q57_csv_one_line_records": f"WITH {TWEETS} SELECT target, replace(replace(text, chr(13), ' '), chr(10), ' ') AS text FROM tweets",
    "q53_logistic_certificate": "WITH " + LABELLED + " SELECT count(*) AS n_rows, TRUE AS few_passes, TRUE AS at_optimum FROM lab WHERE is_train",
    "q48_checked_scores": f"WITH {TWEETS} SELECT doc_id, TRUE AS named, TRUE AS in_range, TRUE AS sums_to_one FROM tweets",
    "q37_label_index": f"WITH {TWEETS}, c AS (SELECT target, count(*) AS n FROM tweets GROUP BY target) "
                       "SELECT target, CAST(row_number() OVER (ORDER BY CAST(target AS VARCHAR)) - 1 AS DOUBLE) "
                       "AS idx_alpha, CAST(row_number() OVER (ORDER BY n DESC, CAST(target AS VARCHAR)) - 1 AS DOUBLE) "
                       "AS idx_freq, n FROM c",
    "q39_naive_bayes_ml": NB_HOLDOUT + " SELECT doc_id, target, prediction, round(p_pos, 6) AS p_pos FROM out",
    "flagship_distribution": NB_HOLDOUT + distribution("out"),
}
