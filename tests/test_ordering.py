"""Distributed ranks and quantiles, above all with hot values and hot groups."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import features as f
from millrace.operators.ordering import column_quantiles, latest_per_key, positions, value_counts
from millrace.operators.text import pack_text


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of the rows share one group, a third share one value."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(6000):
        g = "hot" if i % 2 else f"g{i % 7}"
        v = 500 if i % 3 == 0 else int(rng.integers(0, 1000))
        rows.append((i, g if i % 101 else None, v))
    return rows, spark.createDataFrame(rows, "id long, g string, v int").repartition(16)


def test_positions_are_dense_and_ordered(skewed):
    rows, df = skewed
    got = {(r["g"], r["pos"]): r["id"] for r in positions(df, [F.col("v").desc(), F.col("id")], ["g"]).collect()}
    assert len(got) == len(rows)
    for g in {r[1] for r in rows}:
        want = [r[0] for r in sorted((r for r in rows if r[1] == g), key=lambda r: (-r[2], r[0]))]
        assert [got[(g, i)] for i in range(len(want))] == want


def test_value_counts_running_totals(skewed):
    rows, df = skewed
    got = {r["v"]: r for r in value_counts(df, "v").collect()}
    values = np.array([r[2] for r in rows])
    for v in np.unique(values):
        assert (got[v]["n"], got[v]["n_before"]) == ((values == v).sum(), (values < v).sum())
        assert got[v]["n_total"] == len(rows)


@pytest.mark.parametrize("interpolate", [True, False])
@pytest.mark.parametrize("how", [{}, {"accuracy": 20}])
def test_column_quantiles(spark, skewed, interpolate, how):
    rows, df = skewed
    df = df.withColumn("w", F.when(F.col("g").isNotNull(), F.col("id") % 997 / 7)).withColumn("none", F.lit(None))
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.99, "e": 1.0}
    got = {r["variable"]: r for r in column_quantiles(df, ["v", "w", "none"], probs, interpolate, **how).collect()}
    assert set(got) == {"v", "w"}
    method = "linear" if interpolate else "inverted_cdf"
    for c, values in (("v", [r[2] for r in rows]), ("w", [r[0] % 997 / 7 for r in rows if r[1] is not None])):
        for name, p in probs.items():
            assert np.isclose(got[c][name], np.quantile(values, p, method=method)), (c, name)


def test_column_quantiles_when_the_sketch_misses(spark):
    # Far too coarse a sketch: the windows miss, so whole columns are ranked.
    df = spark.range(5000).select(F.col("id").cast("double").alias("v")).repartition(40)
    out = column_quantiles(df, ["v"], {"m": 0.5, "q": 0.9}, accuracy=2).first()
    assert (out["m"], out["q"]) == (2499.5, 4499.1)


def test_latest_per_key_cuts_before_the_shuffle(skewed):
    rows, df = skewed
    out = latest_per_key(df, ["g"], [F.desc("id")], 3)
    got = {(r["g"], r["id"]) for r in out.collect()}
    want = set()
    for g in {r[1] for r in rows}:
        want |= {(g, i) for i in sorted((r[0] for r in rows if r[1] == g), reverse=True)[:3]}
    assert got == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_pack_text_splits_hot_group_without_loss(skewed):
    rows, df = skewed
    out = pack_text(df, "g", F.col("id").cast("string"), ["v", "id"], sep="|", part_rows=500).collect()
    packed = {}
    for r in sorted(out, key=lambda r: r["part"]):
        assert r["item_count"] <= 500 and r["packed_text"].count("|") == r["item_count"] - 1
        packed.setdefault(r["g"], []).extend(r["packed_text"].split("|"))
    for g in {r[1] for r in rows}:
        want = [str(r[0]) for r in sorted((r for r in rows if r[1] == g), key=lambda r: (-r[2], -r[0]))]
        assert packed[g] == want
    assert len([r for r in out if r["g"] == "hot"]) > 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=60), st.integers(2, 6))
def test_bins_partition_the_rows(spark, values, n):
    df = spark.createDataFrame([(v,) for v in values], "v int")
    present = [v for v in values if v is not None]
    for make in (f.equal_freq_bins, f.equal_width_bins):
        out = make(df, "v", n).collect()
        assert sorted(r["v"] for r in out) == sorted(present)
        assert all(1 <= r["bin"] <= n for r in out)
        by_value = sorted((r["v"], r["bin"]) for r in out)
        assert [b for _, b in by_value] == sorted(b for _, b in by_value)


def test_target_encoding_by_hand(spark):
    rows = [("a", 0, 10.0), ("a", 1, 20.0), ("a", 1, 40.0), ("b", 0, 5.0), ("b", 0, None)]
    df = spark.createDataFrame(rows, "c string, fold int, y double")
    out = f.target_encode_oof(df, "c", "y", "fold", m=2).collect()
    for r in out:
        others = [(c, y) for c, fold, y in rows if fold != r["fold"] and y is not None]
        prior = sum(y for _, y in others) / len(others)
        own = [y for c, y in others if c == r["c"]]
        assert np.isclose(r["c_target_enc"], (sum(own) + 2 * prior) / (len(own) + 2))
    assert len(out) == 4


def test_ngrams_and_tokens(spark):
    df = spark.createDataFrame([(1, "The Cat, x"), (2, "ab"), (3, None), (4, "AAAA")], "id int, t string")
    grams = sorted(map(tuple, f.char_ngrams(df, "id", "t").collect()))
    assert grams == [(1, "atx"), (1, "cat"), (1, "eca"), (1, "hec"), (1, "the"), (4, "aaa"), (4, "aaa")]
    assert sorted(map(tuple, f.tokens(df, "id", "t").collect())) == [(1, "cat"), (1, "x"), (2, "ab"), (4, "aaaa")]
    # Upper-case letters go before lower-casing in compat mode.
    assert sorted(map(tuple, f.tokens(df, "id", "t", compat=True).collect())) == [
        (1, "at"), (1, "he"), (1, "x"), (2, "ab")]
    assert f.char_ngrams(df, "id", "t", compat=True).count() == 3


def test_trip_features_with_points(spark):
    df = spark.createDataFrame(
        [("m", 100, "2024-01-07 10:00:00", "s", 0.0, 0.0, 0.0, 1.0), ("m", 10, "2024-01-07 10:00:00", "s", 0.0, 0.0, 0.0, 1.0)],
        "k string, d int, t string, p string, x1 double, y1 double, x2 double, y2 double",
    ).withColumn("t", F.to_timestamp("t"))
    out = f.trip_features(df, "k", "d", "t", "p", ("x1", "y1"), ("x2", "y2")).collect()
    assert len(out) == 1 and out[0]["day_of_week"] == 1 and out[0]["start_hour"] == 10
    assert abs(out[0]["distance_m"] - 111195) < 10


def test_order_lines_are_dealt_by_their_number(spark, monkeypatch):
    from millrace.plans import semantic
    from millrace.registry import inputs as i

    class T:
        lineitem = spark.range(4000).selectExpr(
            "id div 4 AS l_orderkey", "id % 7 AS l_partkey", "1.0D AS l_quantity", "CAST(id AS DOUBLE) AS l_extendedprice")
        orders = spark.range(1000).selectExpr(
            "id AS o_orderkey", "id % 9 AS o_custkey", "timestamp'2024-01-05' + make_interval(0, id % 3) AS o_orderdate")

    T.spark = spark
    monkeypatch.setattr(i, "LINES_PER_TASK", 100)
    dealt = i.fct_orders(T, dealt=True)
    # As many tasks as the lines need, whatever the session's number is; an order's lines in one of them.
    assert dealt.rdd.getNumPartitions() == 40
    ask = lambda fct: sorted(map(tuple, semantic.metric_query(
        semantic.orders_model(fct), ["total_orders", "avg_order_value"], grain="month", dims=["product_id"]).collect()))
    assert ask(dealt) == ask(i.fct_orders(T)) and len(ask(dealt)) == 21
