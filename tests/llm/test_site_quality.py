"""The classifier on held-out labels, and posteriors beside their formulas."""

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from frames import no_documents, odd_documents, prose  # noqa: E402

from millrace.llm import site_quality  # noqa: E402
from millrace.llm.registry import QUERIES  # noqa: E402
from millrace.session import load  # noqa: E402

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    """Fitted on half of the labels, held against the other half."""
    folder = "/root/testdata/sf0.1"
    labels = load(spark, folder, "labels")
    half = labels.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0)
    rest = labels.join(half.select("doc_id"), "doc_id", "left_anti")
    judged = site_quality.classify(load(spark, folder, "documents"), half).join(rest, "doc_id")
    n = {(r["unwanted"], r["kept"]): r["n"] for r in judged.groupBy(
        ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("unwanted"), "kept").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert n[True, False] / (n[True, False] + n.get((True, True), 0)) > 0.95
    assert n[False, True] / (n[False, True] + n.get((False, False), 0)) > 0.99


def test_query_over_the_table(spark, data):
    rows = QUERIES["op2_site_quality"](spark, data).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in load(spark, data, "documents").collect())
    assert all(0 <= r["evidence"] <= 1 and 0 < r["posterior"] < 1 and r["kept"] == (r["posterior"] < 0.5) for r in rows)


def pull(rates, prior):
    """Strength of a level: rates are (n, s), priors one for each."""
    n, s = (np.array(x, float) for x in zip(*rates))
    prior = np.array(prior, float)
    between = ((n * (s / n - prior) ** 2).sum() - (prior * (1 - prior)).sum()) / n.sum()
    level = (n * prior * (1 - prior)).sum() / n.sum()
    return min(max(level / max(between, 1e-12) - 1, 1), 1e4) if between > 0 else 1e4


def test_posteriors_beside_a_loop(spark, data):
    """Every document's site prior, posterior and verdict from all evidence, by dictionaries."""
    docs = {r["doc_id"]: (r["source"], r["lang"]) for r in load(spark, data, "documents").select(
        "doc_id", "source", "lang").collect()}
    got = {r["doc_id"]: r for r in site_quality.classify(
        load(spark, data, "documents"), load(spark, data, "labels")).collect()}
    p = {i: round(r["evidence"] * 1e6) / 1e6 for i, r in got.items()}
    paths, hosts = {}, {}
    for i, site in docs.items():
        for level, key in ((paths, site), (hosts, site[0])):
            n, s = level.get(key, (0, 0.0))
            level[key] = (n + 1, s + p[i])
    rate = (sum(p.values()) + 0.5) / (len(p) + 1)
    k = pull(hosts.values(), [rate] * len(hosts))
    host_rate = {h: (k * rate + s) / (k + n) for h, (n, s) in hosts.items()}
    k = pull(paths.values(), [host_rate[h] for h, _ in paths])
    for i, site in docs.items():
        n, s = paths[site]
        prior = min(max((k * host_rate[site[0]] + max(s - p[i], 0)) / (k + n - 1), 1e-6), 1 - 1e-6)
        e = min(max(got[i]["evidence"], 1e-9), 1 - 1e-9)
        odds = e / (1 - e) * (1 - rate) / rate * prior / (1 - prior)
        assert got[i]["site_prior"] == pytest.approx(prior, rel=1e-5)
        assert got[i]["posterior"] == pytest.approx(odds / (1 + odds), rel=1e-4)
        assert got[i]["kept"] == (got[i]["posterior"] < 0.5)


def test_words_are_weighed_in_other_folds(spark):
    """Labels that no word explains: words of one fold tell nothing in the others, so evidence stays near the rate."""
    rng = random.Random(31)
    docs = spark.createDataFrame([(k, f"{prose(rng, 40)} tag{k // 24} x", "s", "en") for k in range(1200)],
                                 "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(k, int(rng.random() < 0.5), 0) for k in range(1200)], LABELS)
    evidence = [r["evidence"] for r in site_quality.classify(docs, labels, least=4, least_weight=0.1).collect()]
    assert 0.35 < np.mean(evidence) < 0.65 and np.std(evidence) < 0.25


def test_sites_are_pulled_to_the_level_above(spark):
    rows = [("big", "x", 0.9)] * 2000 + [("big", "y", 0.9)] * 2 + [("clean", "x", 0.02)] * 2000 + [("one", "x", 1.0)]
    rows += [(None, None, 0.5)] * 3
    scores = spark.createDataFrame(rows, "host string, path string, p double")
    got = {tuple(r["key"]): r for r in site_quality.site_posteriors(scores).collect()}
    rate = (sum(r[2] for r in rows) + 0.5) / (len(rows) + 1)
    assert got["big", "x"]["rate"] == pytest.approx(rate)
    assert got["big", "x"]["n"] == 2000 and got["big", "x"]["s"] == pytest.approx(1800)
    assert got["big", "x"]["host_rate"] > 0.89  # large host: its own rate
    assert got["clean", "x"]["host_rate"] < 0.03
    assert rate < got["one", "x"]["host_rate"] < 1  # one document: between the global rate and its own
    assert (None, None) in got
    # The host level by hand: strength from the spread beyond sampling.
    hosts = {}
    for h, _, p in rows:
        n, s = hosts.get(h, (0, 0.0))
        hosts[h] = (n + 1, s + p)
    n, s = (np.array(x) for x in zip(*hosts.values()))
    between = ((n * (s / n - rate) ** 2).sum() - len(n) * rate * (1 - rate)) / n.sum()
    strength = min(max(rate * (1 - rate) / between - 1, 1), 1e4)
    assert got["one", "x"]["host_rate"] == pytest.approx((strength * rate + 1.0) / (strength + 1), rel=1e-6)


def test_the_site_decides_doubtful_documents(spark):
    """The same text goes on a host of junk and stays on a clean one."""
    rng = random.Random(9)
    rows, labels = [], []
    for k in range(1200):
        bad = k % 2 == 0
        text = prose(rng, 60)
        if bad:
            text = " ".join(w + rng.choice(["", "###"]) for w in text.split())
        rows.append((k, text, "junk" if bad else "fine", "en"))
        labels.append((k, 0 if bad else 1, 0))
    doubtful = " ".join(w + ("###" if j % 17 == 0 else "") for j, w in enumerate(prose(rng, 60).split()))
    rows += [(5000, doubtful, "junk", "en"), (5001, doubtful, "fine", "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = {r["doc_id"]: r for r in site_quality.classify(docs, spark.createDataFrame(labels, LABELS)).collect()}
    assert got[5000]["evidence"] == got[5001]["evidence"]
    assert got[5000]["posterior"] > got[5001]["posterior"] and got[5000]["site_prior"] > 0.9 > 0.1 > got[5001]["site_prior"]
    assert np.mean([got[k]["kept"] == (k % 2 == 1) for k in range(1200)]) > 0.99


def test_odd_rows(spark):
    docs = odd_documents(spark)
    odd = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (5, 0, 1), (None, 0, 0), (6, None, 0), (9, 1, None), (77, 1, 1)], LABELS)
    none = spark.createDataFrame([], LABELS)
    for labels in (odd, none):
        for stored in (True, False):
            rows = site_quality.classify(docs, labels, keep=("doc_id", "text"), store_rows=stored).collect()
            assert len(rows) == docs.count() and all(0 < r["posterior"] < 1 for r in rows)
    assert all(r["kept"] for r in site_quality.classify(docs, none).collect())
    assert site_quality.classify(no_documents(spark), odd).count() == 0
