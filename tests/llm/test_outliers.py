"""Counts beside loops over texts; estimates beside numpy; junk goes and prose stays."""

import random
import re
import sys
from collections import Counter as Multiset
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from frames import no_documents, odd_documents, prose  # noqa: E402

from millrace.llm import outliers  # noqa: E402
from millrace.llm.registry import QUERIES  # noqa: E402
from millrace.session import load  # noqa: E402


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    often, inside = Multiset(runs), set()
    for k, run in enumerate(runs):
        if often[run] > 1:
            inside.update(range(k, k + 8))
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(inside))


def failed(c):
    return c[0] < 20 or 100 * c[4] > 30 * c[0]


@pytest.mark.parametrize("size", [1, 300, 1 << 20])
def test_counts(size):
    rng = random.Random(size)
    texts = ["".join(rng.choice("ab #|é\n\t🙂A!") for _ in range(rng.randint(0, 120))) for _ in range(300)]
    texts += ["", "\n\n", "a " * 50, "a b c d e f g h i " * 4, "x\ny\nx\n\n x\nx", "one line\none line", "a" * 3000]
    from millrace.llm.common import chunks

    counter = outliers.Counter()
    rows = np.concatenate([counter.run(part) for part in chunks([t.encode() for t in texts], size)])
    for text, row in zip(texts, rows):
        assert tuple(row[:5]) == counts(text), text


def test_query_over_the_table(spark, data):
    docs = {r["doc_id"]: r["text"] for r in load(spark, data, "documents").collect()}
    rows = QUERIES["op5_robust_outliers"](spark, data).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        c = counts(docs[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == c
        assert r["base_failed"] == failed(c)
        assert not (r["base_failed"] and r["kept"])


def test_labelled_documents(spark):
    """At the next scale: most documents labelled as poor go, hardly any good one does."""
    folder = "/root/testdata/sf0.01"
    judged = QUERIES["op5_robust_outliers"](spark, folder).join(load(spark, folder, "labels"), "doc_id")
    shares = {(r["quality"], r["base_failed"]): r for r in judged.groupBy("quality", "base_failed").agg(
        F.avg(F.col("kept").cast("int")).alias("kept"), F.count(F.lit(1)).alias("n")).collect()}
    assert shares[1, False]["kept"] > 0.98
    assert judged.where("quality = 0 AND NOT kept").count() > 0.8 * judged.where("quality = 0").count()


def test_concentration_steps_ignore_outliers(spark):
    """A quarter of far rows doesn't move the estimate, as it does the plain mean."""
    rng = np.random.default_rng(8)
    p = len(outliers.FEATURES)
    good = rng.normal(size=(900, p)) * 0.3 + np.arange(p)
    far = rng.normal(size=(200, p)) * 0.1 + 30
    rows = [(*map(float, x), "en", "a") for x in np.concatenate([good, far])]
    rows += [(*map(float, x), "en", f"s{k}") for k, x in enumerate(good[:60])]  # sources too small for themselves
    rows += [(*map(float, x), None, None) for x in good[:3]]
    frame = spark.createDataFrame(rows, ", ".join(f"x{k} double" for k in range(p)) + ", lang string, source string")
    est = {tuple(r["key"]): r for r in outliers.fit(frame, least=50).collect()}
    center = np.array(est["en", "a"]["center"])
    assert np.abs(center - good.mean(0)).max() < 0.1 and (rows and np.abs(np.concatenate([good, far]).mean(0) - good.mean(0)).max() > 1)
    assert est["en", "s0"]["center"] == est["en", "s59"]["center"]
    assert (None, None) not in est  # three rows are too few for an estimate
    inverse = np.array(est["en", "a"]["inverse"]).reshape(p, p)
    floors = np.array([f for _, _, f in outliers.FEATURES])
    d2 = np.einsum("ij,jk,ik->i", good - center, inverse, good - center)
    d2_far = np.einsum("ij,jk,ik->i", far - center, inverse, far - center)
    assert d2_far.min() > 20 * np.median(d2) and (np.linalg.eigvalsh(np.linalg.inv(inverse)) > 0.5 * floors.min() ** 2).all()


def brute_force_mcd(x, core, rng, starts=60):
    """Concentration steps on exact subsets from random small subsets; floors' squares on the scatter, as stated."""
    floors = np.array([f for _, _, f in outliers.FEATURES])
    h = int(core * len(x))
    best = (np.inf, None, None)
    for _ in range(starts):
        subset = rng.choice(len(x), x.shape[1] + 1, replace=False)
        last = np.inf
        while True:
            center, scatter = x[subset].mean(0), np.cov(x[subset].T, bias=True) + np.diag(floors**2)
            logdet = np.linalg.slogdet(scatter)[1]
            if len(subset) == h and logdet > last - 1e-9:
                break
            last = logdet if len(subset) == h else np.inf
            d2 = np.einsum("ij,jk,ik->i", x - center, np.linalg.inv(scatter), x - center)
            subset = np.argsort(d2, kind="stable")[:h]
        if logdet < best[0]:
            best = (logdet, center, scatter)
    return best


def finished(x, center, scatter):
    """The re-weighted estimate: consistent by the median, rows within 97.5%, consistent again."""
    p, floors = x.shape[1], np.array([f for _, _, f in outliers.FEATURES])

    def squares(center, scatter):
        d2 = np.einsum("ij,jk,ik->i", x - center, np.linalg.inv(scatter), x - center)
        return d2 / max(np.median(d2) / outliers.chi_square(0.5, p), 1)

    near = x[squares(center, scatter) <= outliers.chi_square(0.975, p)]
    center, scatter = near.mean(0), np.cov(near.T, bias=True) + np.diag(floors**2)
    return center, squares(center, scatter)


def test_least_determinant_beside_numpy(spark):
    """Correlated groups with a quarter of the rows in one far lump, or spread along one axis."""
    rng = np.random.default_rng(17)
    p = len(outliers.FEATURES)
    root = rng.normal(size=(p, p)) * 0.4
    clean = {g: rng.normal(size=(700, p)) @ root for g in "abc"}
    groups = {"a": clean["a"], "b": np.concatenate([clean["b"], rng.normal(size=(200, p)) * 0.05 + 6 * root[0]]),
              "c": np.concatenate([clean["c"], rng.normal(size=(200, 1)) * 9 + np.zeros((1, p))])}
    rows = [(g, *map(float, v)) for g, x in groups.items() for v in x]
    names = ", ".join(f"x{k} double" for k in range(p))
    found = {r["g"]: r for r in outliers.minimum_determinant(spark.createDataFrame(rows, "g string, " + names)).collect()}
    frame = spark.createDataFrame([("en", g, *v) for g, *v in rows], "lang string, source string, " + names)
    final = {r["key"]["source"]: r for r in outliers.fit(frame).collect()}
    for g, x in groups.items():
        logdet, center, scatter = brute_force_mcd(x, 0.75, rng)
        assert abs(found[g]["logdet"] - logdet) < 0.05, g
        sd = np.sqrt(np.diag(scatter))
        assert (np.abs(np.array(found[g]["center"]) - center) < 0.1 * sd).all(), g
        center, d2 = finished(x, center, scatter)
        got, inverse = np.array(final[g]["center"]), np.array(final[g]["inverse"]).reshape(p, p)
        mine = np.einsum("ij,jk,ik->i", x - got, inverse, x - got)
        assert (np.abs(got - center) < 0.1 * sd).all(), g
        limit = outliers.chi_square(0.999, p)
        assert np.mean((mine > limit) != (d2 > limit)) < 0.01 and np.median(np.abs(mine / d2 - 1)) < 0.08, g


def test_junk_goes_and_prose_stays(spark):
    rng = random.Random(6)
    rows = [(k, prose(rng, rng.randint(25, 400)), "en", "hot" if k % 3 else f"s{k % 5}") for k in range(600)]
    junk = [(1000, " ".join(f"{w}###" for w in prose(rng, 80).split())), (1001, " | ".join(prose(rng, 60).split())),
            (1002, prose(rng, 80).upper().replace(" ", "!! ")), (1003, " ".join(w for w in prose(rng, 9).split() for _ in range(12)))]
    rows += [(i, t, "en", "hot") for i, t in junk]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r["doc_id"]: r["kept"] for r in outliers.reject_outliers(df).collect()}
    assert not any(kept[i] for i, _ in junk)
    assert sum(kept[k] for k in range(600)) >= 597


def test_odd_rows(spark):
    docs = odd_documents(spark)
    for stored in (True, False):
        rows = outliers.reject_outliers(docs, keep=("doc_id", "n_chars"), store_rows=stored).collect()
        assert len(rows) == docs.count()
        assert sorted(r["n_words"] for r in rows) == sorted(counts(d["text"])[0] for d in docs.collect())
        assert {r["kept"] for r in rows if r["n_words"] < 20} == {False}
    assert outliers.reject_outliers(no_documents(spark)).count() == 0
