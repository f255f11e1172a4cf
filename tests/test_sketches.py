"""Stored sketches: errors, merges, replacement of days."""

import datetime as dt

import numpy as np
from pyspark.sql import functions as F

from millrace.operators import sketches
from millrace.session import work_path

START = dt.date(2024, 1, 1)


def rows_of(spark):
    rng = np.random.default_rng(4)
    return spark.createDataFrame(
        [(START + dt.timedelta(int(d)), "hot" if k % 3 else f"s{k % 4}", int(u), float(v)) for k, (d, u, v) in enumerate(
            zip(rng.integers(0, 20, 20_000), rng.integers(0, 6000, 20_000), rng.lognormal(size=20_000)))],
        "d date, seg string, user long, v double")


def test_ranges_against_exact_values(spark):
    df = rows_of(spark).cache()
    path = work_path(spark, "sketches")
    sketches.write_days(df, path, F.col("d"), ["seg"], ["user"], ["v"])
    for first, last in ((0, 19), (3, 9), (7, 7)):
        lo, hi = START + dt.timedelta(first), START + dt.timedelta(last)
        part = df.where(F.col("d").between(lo, hi)).toPandas()
        got = sketches.range_stats(spark, path, lo, hi).first()
        assert got["rows"] == len(part) and abs(got["user_distinct"] / part["user"].nunique() - 1) < 0.06
        assert np.isclose(got["v_sum"], part["v"].sum()) and got["v_min"] == part["v"].min() and got["v_max"] == part["v"].max()
        for p in (0.25, 0.5, 0.75):
            assert abs((part["v"] <= got[f"v_q{p * 100:g}"]).mean() - p) < 0.03
        by = {r["seg"]: r for r in sketches.range_stats(spark, path, lo, hi, ["seg"]).collect()}
        for seg, group in part.groupby("seg"):
            assert by[seg]["rows"] == len(group) and abs(by[seg]["user_distinct"] / group["user"].nunique() - 1) < 0.08


def test_days_are_units_and_only_theirs_are_read(spark):
    df = rows_of(spark)
    path = work_path(spark, "sketches")
    early = df.where(F.col("d") < START + dt.timedelta(10))
    sketches.write_days(early, path, F.col("d"), [], ["user"], ["v"])
    sketches.write_days(early, path, F.col("d"), [], ["user"], ["v"])  # again: nothing changes
    rest = sketches.missing_days(df, path, F.col("d"))
    assert rest.agg(F.min("d")).first()[0] == START + dt.timedelta(10)
    sketches.write_days(rest, path, F.col("d"), [], ["user"], ["v"])
    assert sketches.range_stats(spark, path, START, START + dt.timedelta(30)).first()["rows"] == 20_000
    plan = sketches.range_stats(spark, path, START, START)._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and plan.count("day") > 0 and "PartitionFilters: []" not in plan


def test_odd_rows(spark):
    path = work_path(spark, "sketches")
    df = spark.createDataFrame([(None, "a", 1, 1.0), (START, None, None, None), (START, "a", 2, None)], "d date, seg string, user long, v double")
    sketches.write_days(df, path, F.col("d"), ["seg"], ["user"], ["v"])
    got = {r["seg"]: r for r in sketches.range_stats(spark, path, START, START, ["seg"]).collect()}
    assert set(got) == {None, "a"} and got[None]["user_distinct"] == 0 and got["a"]["v_q50"] is None
    assert sketches.range_stats(spark, path, START + dt.timedelta(1), START + dt.timedelta(2)).first()["rows"] == 0
