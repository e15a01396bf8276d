from __future__ import annotations

import re

import pytest
from checks.compare import connect, differ

from gaugeloom.llm import url_filter
from gaugeloom.llm.queries import ORACLES, QUERIES, URL_RULES
from pyspark.sql import functions as F

URLS = [
    None, "", "no scheme", "http://", "http://net/", "http://net", "https://A.Example.NET/en/x?y#z", "http://example.net/enx",
    "http://notexample.com/de/1", "http://x.example.com/de/1", "http://x.example.com/de", "ftp://a.b.org/fr/", "http://org/fr/a?b",
    "http://a.org?fr/", "http://a.net#/", "http://a.net:80/", "http://a.net./", "x://y://z.net/", "http://.net/", "http://a.NÉT/é",
    "http://" + "a." * 5000 + "net/" + "q" * 5000, "http://EXAMPLE.ORG/FR/",
]


def plain(url, rules=URL_RULES):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = []
    for action, key in rules:
        name, at = key.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + at):
            fits.append((len(key), action, key))
    best = max(fits, default=(0, "allow", None))
    return host, path, best[2], best[1]


def judged(spark, urls, rules=URL_RULES):
    pages = spark.createDataFrame([(k, u, "h", "r") for k, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    rows = url_filter.judge(pages, url_filter.rules_table(spark, rules)).collect()
    return {r["row"]["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows}


def test_awkward_urls(spark):
    got = judged(spark, URLS + URLS)
    assert got == {k: plain(u) for k, u in enumerate(URLS + URLS)}
    assert judged(spark, []) == {}
    assert judged(spark, URLS, []) == {k: (*plain(u)[:2], None, "allow") for k, u in enumerate(URLS)}


def test_same_key_on_both_lists_is_blocked(spark):
    got = judged(spark, ["http://a.b/", "http://c.b/x/"], [("block", "b/"), ("allow", "b/"), ("allow", "c.b/"), ("block", "b/x/")])
    assert got[0][2:] == ("b/", "block") and got[1][2:] == ("c.b/", "allow")


@pytest.mark.parametrize("listed", [0, 1, 50, 700])
def test_cascade_is_exact(spark, listed):
    """With over a hundred keys outside for each inside, the first level makes mistakes and deeper ones mend them."""
    keys = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), "id")
    inside = keys.filter(F.col("id") < listed).select("key")
    cascade = url_filter.Cascade(inside.union(inside), keys.select("key").union(keys.select("key")))
    wrong = keys.filter(cascade.has(F.col("key")) != (F.col("id") < listed)).count()
    assert wrong == 0 and len(cascade.levels) == (0 if not listed else len(cascade.levels))
    assert listed < 50 or len(cascade.levels) > 1


def test_long_list_is_refused(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "MAX_BITS", 64)
    keys = spark.range(100).select(F.col("id").cast("string").alias("key"))
    with pytest.raises(ValueError, match="split the list"):
        url_filter.Cascade(keys, keys)


def test_query_equals_sql(spark, small):
    got = QUERIES["op8_bloom_cascade_urls"](spark, small)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "Join"))
    assert differ(got.toPandas(), connect(small).sql(ORACLES["op8_bloom_cascade_urls"]).df()) is None
