from __future__ import annotations

import random

import pytest

from waybill.llm import url_rules
from waybill.llm.queries import URL_RULES, op7_url_rules

from .conftest import SF

RULES = [*URL_RULES, ("example.org", "/en/1", "block"), ("a.example.org", "/e", "allow"), ("x.net", "", "block")]


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[: min((path.index(c) for c in "?#" if c in path), default=len(path))]


def brute(url, rules):
    host, path = parts(url)
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[1]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else "allow"


def urls():
    rng = random.Random(3)
    hosts = ["example.org", "A.Example.ORG", "b.com", "org", "notexample.org", "x.net", "y.x.net", "", "a..com", "org.", "é.com"]
    paths = ["", "/", "/es", "/es/", "/es/9", "/en/1", "/en/12", "/EN/1", "/fr/é", "/de/x?y", "/de", "?a", "#b", "/\n/de/"]
    out = [f"http{s}://{rng.choice(hosts)}{rng.choice(paths)}{t}" for s in ("", "s") for t in ("", "?q=http://z.com/de/", "#t") for _ in range(60)]
    return [*out, None, "", "example.org/es/", "://", "x://y://example.org/es/", "http:/example.org/es/"]


@pytest.mark.parametrize("prefix", [8, 0])
def test_verdicts(spark, space, prefix, monkeypatch):
    monkeypatch.setattr(url_rules, "PREFIX", prefix)
    rows = list(enumerate(urls())) + [(0, "http://twice.org/"), (0, "http://twice.org/"), (None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    rules = url_rules.rule_table(spark, [*RULES, (None, "/", "block"), ("b.com", None, "block"), ("b.com", "/", None)])
    got = url_rules.judge(pages, rules, space).collect()
    want = [(i, *brute(u, RULES)) for i, u in rows]
    assert sorted(((r.page_id, r.host, r.path, r.rule, r.verdict) for r in got), key=str) == sorted(want, key=str)


def test_clashes_empty_tables_and_default(spark, space):
    pages = spark.createDataFrame([(1, "http://b.com/de/", "h", "r")], "page_id long, url string, Host string, rule string")
    rules = url_rules.rule_table(spark, URL_RULES)
    got = url_rules.judge(pages, rules, space).first()
    assert (got.page_Host, got.page_rule, got.host, got.verdict) == ("h", "r", "b.com", "block")
    none = url_rules.rule_table(spark, [])
    assert url_rules.judge(pages, none, space, default="block").first().verdict == "block"
    assert url_rules.judge(pages.limit(0), rules, space).collect() == []


def test_query_on_the_table_is_native(spark):
    out = op7_url_rules(spark, SF)
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in out.collect():
        assert (r.host, r.path, r.rule, r.verdict) == brute(pages[r.page_id], URL_RULES)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert "html" not in plan


def test_columns_that_clash_with_those_of_the_result_and_with_their_new_names(spark, space):
    pages = spark.createDataFrame([("https://a.org/x", "h", "p", "v")], "url string, host string, page_host string, verdict string")
    rules = url_rules.rule_table(spark, [("org", "/", "block")])
    out = url_rules.judge(pages, rules, space)
    assert out.columns == ["url", "page_host_", "page_host", "page_verdict", "host", "path", "rule", "verdict"]
    assert out.first()[1:] == ("h", "p", "v", "a.org", "/x", "org/", "block")
