"""Source mixing: targets beside the resharing they are defined by, and what the mix must keep."""

import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
from frames import no_documents, odd_documents, prose  # noqa: E402

from millrace.llm import mixing  # noqa: E402
from millrace.llm.registry import QUERIES  # noqa: E402
from millrace.session import load  # noqa: E402


def reshare(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: cap * sizes[s] for s in over}


def check(rows, sizes_of):
    """Rows: doc_id, source, size, source_size, target, taken."""
    sizes, taken, largest, target = {}, {}, {}, {}
    for r in rows:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        largest[r["source"]] = max(largest.get(r["source"], 0), r["size"])
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
    want = reshare(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-9, abs=1e-6)
        assert abs(taken[s] - target[s]) <= max(largest[s] / 2 + 1, 1)
    assert sum(target.values()) == pytest.approx(sum(sizes.values()), rel=1e-9)


def skewed(spark, n=1500):
    """A source with a third of the rows, a copied text, sources too small for their share."""
    rng = random.Random(4)
    copy = prose(rng, 50)
    rows = []
    for k in range(n):
        source = "hot" if k % 3 == 0 else rng.choice(["a", "b", "c", "tiny" if k < 30 else "d", None])
        rows.append((k, copy if k % 4 == 0 else prose(rng, rng.choice([0, 3, 20, 60, 400])), "en", source, 0))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_targets_caps_and_near_sums(spark):
    rows = mixing.mix_sources(skewed(spark)).collect()
    assert len(rows) == 1500
    check(rows, None)
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    for rs in by_source.values():  # rates are an exponential in the size, up to the cap
        free = [(r["size"], r["rate"]) for r in rs if 0 < r["rate"] < 3 and r["size"]]
        import math

        slopes = {round(math.log(rate) / size, 9) for size, rate in free}
        assert len(slopes) <= 1


def test_reruns_and_partitioning_agree(spark):
    docs = skewed(spark, 400)
    first = sorted(map(tuple, mixing.mix_sources(docs).select("doc_id", "taken", "target").collect()))
    again = sorted(map(tuple, mixing.mix_sources(docs.repartition(7, "text")).select("doc_id", "taken", "target").collect()))
    assert first == again


def test_query_over_the_table(spark, data):
    docs = load(spark, data, "documents")
    got = QUERIES["op3_entropy_mix"](spark, data).join(docs.select("doc_id", "source"), "doc_id").collect()
    assert len(got) == docs.count()
    check(got, None)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = mixing.mix_sources(docs).collect()
    check(rows, None)
    assert len(rows) == docs.count()
    mixed = mixing.apply_mix(docs, mixing.mix_sources(docs))
    assert mixed.columns == docs.columns
    assert mixed.where("doc_id = 3").count() == 1  # no words: stays as it is
    assert mixing.mix_sources(no_documents(spark)).count() == 0
    assert mixing.apply_mix(no_documents(spark), mixing.mix_sources(no_documents(spark))).count() == 0


def test_word_count(spark):
    texts = [None, "", " \t\n\r\x0b\x0c ", "a", " a  b\nc ", "a b \x1c é🙂", "x" * 10_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = [len((t or "").encode().split()) for t in texts]
    assert [r[0] for r in df.select(mixing.word_count(F.col("t"))).collect()] == want


def test_no_python_in_the_plan(spark):
    plan = mixing.mix_sources(skewed(spark, 60))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_equal_rows_share_their_copies(spark):
    """Rows that agree in id, source and size get as many copies together as the mix says."""
    rows = [(k % 4, "one two three " * (1 + k % 3), "abc"[k % 3]) for k in range(60)] + [(None, "x y", None)] * 7 + [(9, None, "a")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix_sources(docs).cache()
    out = mixing.apply_mix(docs, mixed)
    want = {tuple(r)[:3]: r["n"] for r in mixed.groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("n")).collect() if r["n"]}
    got = {tuple(r)[:3]: r["n"] for r in out.groupBy(
        "doc_id", "source", mixing.word_count(F.col("text")).alias("size")).agg(F.count("*").alias("n")).collect()}
    assert got == want
    assert out.count() == mixed.agg(F.sum("copies")).first()[0]
