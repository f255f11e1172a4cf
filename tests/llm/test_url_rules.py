"""URL rules beside a loop over all rules."""

import random

import pytest
from pyspark.sql import functions as F

from millrace.llm.registry import URL_RULES
from millrace.llm.url_rules import judge_urls, rule_table


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:end], rest[end:]
    path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def judge(url, rules):
    host, path = split(url)
    fits = [(len(h + p), len(h), a == "block", h + p, a) for h, p, a in rules
            if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[3], max(fits)[4]) if fits else (host, path, None, "allow")


def urls():
    rng = random.Random(2)
    hosts = ["net", "example.net", "www.example.net", "EXAMPLE.com", "m.example.com", "notexample.com", "org", "a.org", "..net", "net.", "Ünet.net"]
    paths = ["", "/", "/en", "/en/", "/en/x/y", "/de/1", "/fr/?q=/en/", "/fr#a", "//en/", "/de", "/d", "/a\nb/c"]
    found = [f"{rng.choice(['http', 'https', 'x'])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)]
    return [None, "", "no scheme/net/", "://", "http://", "http://?q", "a://b://net/", "http://" + "a." * 3000 + "net/" + "x/" * 3000, *found, *found[:50]]


RULES = [*URL_RULES, ("example.com", "/d", "allow"), ("m.example.com", "/de/1", "block"), ("net", "/e", "allow"), ("org", "", "block"), ("net", "/e", "allow")]


@pytest.mark.parametrize("rules", [URL_RULES, RULES])
def test_against_a_loop(spark, rules):
    rows = [(k if k % 7 else None, u, k, "r") for k, u in enumerate(urls())]
    pages = spark.createDataFrame(rows, "page_id long, url string, n long, rule string")
    got = judge_urls(pages, rule_table(spark, rules), keep=("page_id", "n")).collect()
    assert sorted((r["n"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got if r["rule"]) == sorted(
        (k, *judge(u, rules)) for _, u, k, _ in rows if judge(u, rules)[2])
    assert sorted((r["n"], r["host"], r["path"], r["verdict"]) for r in got) == sorted(
        (k, *judge(u, rules)[:2], judge(u, rules)[3]) for _, u, k, _ in rows)


def test_empty_tables_and_incomplete_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, action string")
    assert [r["verdict"] for r in judge_urls(pages, none).collect()] == ["allow"]
    odd = spark.createDataFrame([(None, "/", "block"), ("net", None, "block"), ("a.net", "/x", None)], none.schema)
    assert [(r["rule"], r["verdict"]) for r in judge_urls(pages, odd).collect()] == [("net", "block")]
    assert judge_urls(pages.where(F.lit(False)), odd).count() == 0


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    rules = spark.range(1).selectExpr("'net' AS host", "'/' AS path", "'block' AS action")
    plan = judge_urls(pages, rules)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
