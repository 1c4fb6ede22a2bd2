import random
import re

import pytest

from tonestream.llm import url_filter

PAGES = "page_id long, url string, host string, path string, id string, keys string, verdict string"
RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = []
    for rule, verdict in rules:
        at, slash, begin = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith(slash + begin):
            fits.append((len(rule), len(at), rule, verdict))
    rule, verdict = max(fits)[2:] if fits else (None, "allow")
    return host, path, rule, verdict


def rows_of(urls):
    return [(i, u, "h", "p", "i", "k", "v") for i, u in enumerate(urls)]


def test_contract_rules(spark):
    urls = ["http://a.example.com/en/1", "https://www.EXAMPLE.com/en/x?y#z", "http://example.com/en", "http://example.com", "ftp://x.net/es/",
            "http://net/fr/9", "http://xnet/fr/9", None, "", "no scheme/en/", "http:///en/", "http://a..net/es/", "http://É.com/\n/x",
            "http://x.com://y.net/es/", "http://net?/fr/", "://net/fr/", "http://" + "a." * 3000 + "net/es/" + "b" * 9000]
    urls += urls[:3]
    got = url_filter.judge(spark.createDataFrame(rows_of(urls), PAGES), RULES).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {i: plain(u, RULES) for i, u in enumerate(urls)}


def test_many_rules_through_several_levels(spark):
    r = random.Random(3)
    hosts = [f"{a}.{b}.{c}" for a in ("x", "y", "z", "www") for b in (f"h{i}" for i in range(150)) for c in ("com", "net")]
    urls = [f"http://{r.choice(hosts)}/{r.choice(['', 'en/', 'fr/', 'en/a'])}{i}" for i in range(3000)]
    rules = {f"{h.split('.', r.choice([0, 1]))[-1]}/{r.choice(['', 'en/'])}": r.choice(["allow", "block"]) for h in r.sample(hosts, 250)}
    got = url_filter.judge(spark.createDataFrame(rows_of(urls), PAGES), [*rules.items()]).collect()
    assert {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in got} == {i: plain(u, rules.items()) for i, u in enumerate(urls)}


def test_cascade_is_exact_on_its_universe(spark):
    from pyspark.sql import functions as F

    keys = spark.range(20_000).select(F.xxhash64(F.lit(1), "id").alias("h1"), F.xxhash64(F.lit(2), "id").alias("h2"), (F.col("id") % 37 == 0).alias("listed"))
    cascade = url_filter.build_cascade(keys)
    all_keys = keys.toPandas()
    assert (cascade.listed(all_keys["h1"].to_numpy(), all_keys["h2"].to_numpy()) == all_keys["listed"].to_numpy()).all()
    assert len(cascade.levels) > 2 and sum(bits for bits, _, _ in cascade.levels) < 40 * all_keys["listed"].sum()


def test_no_rules_and_no_pages(spark):
    some = spark.createDataFrame(rows_of(["http://a.com/"]), PAGES)
    assert [r.verdict for r in url_filter.judge(some, [], default="block").collect()] == ["block"]
    assert url_filter.judge(spark.createDataFrame([], PAGES), RULES).count() == 0
    with pytest.raises(ValueError):
        url_filter.judge(some, [("a.com/", "allow"), ("a.com/", "block")])
