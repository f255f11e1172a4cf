"""Statistics against numpy on the small weather table and random data."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import chi2_sf, great_circle_m, hash63, normal_cdf, plain_number, round_half_up
from millrace.operators import evaluate as ev
from millrace.operators import stats as s

# The 12-row weather sample.
WEATHER_COLS = ["Temp9am", "Temp3pm", "Humidity9am", "Pressure9am", "Pressure3pm", "Rainfall"]
WEATHER = [
    (18.2, 24.5, 72, 1015.2, 1012.8, 0.0), (15.8, 22.1, 68, 1018.5, 1016.2, 2.4),
    (21.3, 28.7, 55, 1012.1, 1008.9, 0.0), (12.5, 18.3, 85, 1020.8, 1018.5, 8.6),
    (19.7, 26.2, 62, 1014.3, 1011.7, 0.2), (16.4, 23.8, 78, 1016.9, 1014.1, 5.1),
    (22.8, 31.5, 48, 1009.5, 1005.8, 0.0), (14.1, 19.6, 88, 1022.1, 1019.8, 12.3),
    (17.9, 25.1, 65, 1017.2, 1014.6, 0.8), (20.5, 27.9, 58, 1013.8, 1010.4, 0.0),
    (None, 21.4, 71, 1019.1, None, 3.2), (13.2, None, 82, None, 1017.3, 6.5),
]


@pytest.fixture(scope="module")
def weather(spark):
    return spark.createDataFrame(
        WEATHER,
        "Temp9am double, Temp3pm double, Humidity9am int, Pressure9am double, Pressure3pm double, Rainfall double",
    )


@pytest.mark.parametrize("median", ["approx", "exact"])
def test_weather_profile(weather, median):
    got = {r["variable"]: r for r in s.dataset_stats(weather, WEATHER_COLS, median=median).collect()}
    for i, c in enumerate(WEATHER_COLS):
        v = np.array([row[i] for row in WEATHER if row[i] is not None], dtype=float)
        r, sd, n = got[c], v.std(ddof=1), len(v)
        assert (r["num_records"], r["num_nulls"]) == (n, 12 - n)
        assert r["min"] == v.min() and r["max"] == v.max()
        assert r["median"] == sorted(v)[math.ceil(n / 2) - 1]
        assert math.isclose(r["average"], v.mean()) and math.isclose(r["stddev"], sd)
        assert math.isclose(r["variance"], sd**2)
        assert math.isclose(r["skewness"], ((v - v.mean()) ** 3).mean() / sd**3, abs_tol=1e-12)
        assert math.isclose(r["kurtosis"], ((v - v.mean()) ** 4).mean() / sd**4)


def test_weather_profile_without_nulls(weather):
    out = s.dataset_stats(weather, WEATHER_COLS, drop_nulls=True).collect()
    assert {r["num_nulls"] for r in out} == {0}


@pytest.fixture(scope="module")
def groups(spark):
    rng = np.random.default_rng(7)
    rows = [(g, float(round(rng.normal(m, 2), 1))) for g, m, n in (("a", 5, 60), ("b", 6, 45), ("c", 5.5, 80)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "g string, v double")


def midranks(v):
    v = np.asarray(v)
    return np.array([(v < x).sum() + ((v == x).sum() + 1) / 2 for x in v])


def upper(z):
    return math.erfc(z / math.sqrt(2)) / 2


@pytest.mark.parametrize("ties", [False, True])
def test_mann_whitney(groups, ties):
    rows, df = groups
    a = [v for g, v in rows if g == "a"]
    b = [v for g, v in rows if g == "b"]
    ranks = midranks(a + b)
    u = ranks[: len(a)].sum() - len(a) * (len(a) + 1) / 2
    n = len(a) + len(b)
    t = sum(c**3 - c for c in np.unique(a + b, return_counts=True)[1]) / (n * (n - 1)) if ties else 0
    sd = math.sqrt(len(a) * len(b) / 12 * (n + 1 - t))
    p = 2 * upper((abs(u - len(a) * len(b) / 2) - 0.5) / sd)
    out = s.mann_whitney(df, "g", "a", "b", "v", tie_correction=ties).first()
    assert out["u_statistic"] == u and math.isclose(out["p_value"], p, abs_tol=1e-6)
    other = s.mann_whitney(df, "g", "b", "a", "v").first()["u_statistic"]
    assert u + other == len(a) * len(b)


def test_mann_whitney_separated_samples(spark):
    x, y = [2, 4, 6, 2, 3, 7, 5, 1], [8, 10, 11, 14, 20, 18, 19, 9]
    df = spark.createDataFrame([("x", float(v)) for v in x] + [("y", float(v)) for v in y], "g string, v double")
    out = s.mann_whitney(df, "g", "x", "y", "v").first()
    assert out["u_statistic"] == 0 and math.isclose(out["p_value"], 9.39106e-4, rel_tol=1e-3)


def test_kruskal_wallis(groups):
    rows, df = groups
    v = [x for _, x in rows]
    ranks, g, n = midranks(v), np.array([k for k, _ in rows]), len(rows)
    h = 12 / (n * (n + 1)) * sum(ranks[g == k].sum() ** 2 / (g == k).sum() for k in "abc") - 3 * (n + 1)
    ties = np.unique(v, return_counts=True)[1]
    h /= 1 - (ties**3 - ties).sum() / (n**3 - n)
    out = s.kruskal_wallis(df, "g", "v").first()
    assert math.isclose(out["h_statistic"], h) and out["degrees_of_freedom"] == 2
    assert math.isclose(out["p_value"], math.exp(-h / 2), rel_tol=1e-9)


def test_anova_sums_add_up(groups):
    rows, df = groups
    parts = s.anova_components(s.anova_groups(df, "g", "v")).first()
    v = np.array([x for _, x in rows])
    assert math.isclose(parts["ssb"] + parts["ssw"], ((v - v.mean()) ** 2).sum())
    assert (parts["df_between"], parts["df_within"]) == (2, len(rows) - 3)
    compat = s.anova_components(s.anova_groups(df, "g", "v", compat=True)).first()
    assert compat["ssw"] < parts["ssw"]


def test_f_critical_lookup_and_approximation(spark):
    df = spark.createDataFrame([(2, 30), (4, 20), (2, 997)], "a int, b int")
    got = [r[0] for r in df.select(s.f_critical_05(F.col("a"), F.col("b"))).collect()]
    assert got[:2] == [3.32, 2.87] and math.isclose(got[2], 3 + 10 / 997 - 0.2)


@pytest.mark.parametrize("ties", ["min", "average"])
def test_spearman(groups, spark, ties):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 20, 200)
    y = x + rng.integers(0, 15, 200)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in zip(x, y)] + [(None, 1), (1, None)], "x int, y int")

    def rank(v):
        return midranks(v) if ties == "average" else np.array([(v < a).sum() + 1 for a in v])

    want = np.corrcoef(rank(x), rank(y))[0, 1]
    assert math.isclose(s.spearman(df, "x", "y", ties).first()[0], want)


def test_ks_normal(groups):
    rows, df = groups
    v = np.sort([x for _, x in rows])
    cdf = np.array([upper(-(x - v.mean()) / v.std(ddof=1)) for x in v])
    want = np.abs(np.arange(1, len(v) + 1) / len(v) - cdf).max()
    assert math.isclose(s.ks_normal(df, "v").first()[0], want, abs_tol=1e-6)


def test_t_test_leaves_out_nulls(spark):
    # Body-fat example: t = 2.8958 with 21 degrees of freedom.
    men = [13.3, 6.0, 20.0, 8.0, 14.0, 19.0, 18.0, 25.0, 16.0, 24.0, 15.0, 1.0, 15.0]
    women = [22.0, 16.0, 21.7, 21.0, 30.0, 26.0, 12.0, 23.2, 28.0, 23.0]
    df = spark.createDataFrame(
        [("m", v) for v in men] + [("w", v) for v in women] + [("m", None)], "g string, v double"
    )
    out = s.t_test(df, "g", "m", "w", "v").first()
    assert math.isclose(out["t_statistic"], 2.8957935572829476) and out["degrees_of_freedom"] == 21


def test_percentile_outliers_approx_is_near_exact(spark):
    df = spark.range(100_000).select((F.rand(5) * 1000).alias("v"))
    df = df.persist()
    approx = s.percentile_outliers(df, "v").select("p_lo", "p_hi").first()
    exact = s.percentile_outliers(df, "v", method="exact").select("p_lo", "p_hi").first()
    assert abs(approx[0] - exact[0]) < 1 and abs(approx[1] - exact[1]) < 1
    df.unpersist()


def test_expressions(spark):
    row = spark.sql("SELECT 1").select(
        normal_cdf(F.lit(1.0), F.lit(0.0), F.lit(1.0)).alias("phi"),
        *[chi2_sf(F.lit(7.5), F.lit(k)).alias(f"chi{k}") for k in (1, 2, 3, 4, 5, 8)],
        hash63(F.lit("abc")).alias("h"),
        round_half_up(F.lit(2.675), 1).alias("r"),
        plain_number(F.lit(12000000.5), 3).alias("n"),
        plain_number(F.lit(300.0), 2).alias("whole"),
        great_circle_m(F.lit(-73.99), F.lit(40.73), F.lit(-73.98), F.lit(40.75)).alias("d"),
    ).first()
    assert math.isclose(row["phi"], 0.8413447460685429, abs_tol=2e-7)
    for k in (1, 2, 3, 4, 5, 8):
        # Integrate the density from 7.5 upwards.
        x = np.linspace(7.5, 200, 400_001)
        density = x ** (k / 2 - 1) * np.exp(-x / 2) / (2 ** (k / 2) * math.gamma(k / 2))
        assert math.isclose(row[f"chi{k}"], np.trapezoid(density, x), abs_tol=1e-6), k
    assert row["h"] == 648541476951500027
    assert row["r"] == 2.7 and row["n"] == "12000000.5" and row["whole"] == "300"
    assert abs(row["d"] - 2378.6) < 5


def test_auc_equals_mann_whitney(spark):
    rng = np.random.default_rng(1)
    rows = [(int(y), float(round(rng.normal(0.4 + 0.2 * y, 0.2), 2))) for y in rng.integers(0, 2, 300)]
    df = spark.createDataFrame(rows, "y int, s double")
    auc = ev.eval_metrics(df, "y", "s").first()["roc_auc"]
    u = s.mann_whitney(df, "y", 1, 0, "s").first()["u_statistic"]
    n1 = sum(y for y, _ in rows)
    assert math.isclose(auc, u / (n1 * (len(rows) - n1)))


def test_shift_of_equal_samples_is_zero(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", None)], "k string, v double")
    out = {r["feature"]: r for r in ev.distribution_shift(df, df, ["k"], ["v"]).collect()}
    assert out["k"]["value"] == 0 and out["v"]["value"] == 0 and not out["k"]["is_anomaly"]
    other = spark.createDataFrame([("c", 9.0)], "k string, v double")
    out = {r["feature"]: r for r in ev.distribution_shift(df, other, ["k"], ["v"]).collect()}
    assert out["k"]["value"] == 1 and out["v"]["value"] == 1 and out["v"]["is_anomaly"]
