"""Descriptive statistics, outliers and hypothesis tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import sketches
from millrace.operators import stats as s
from millrace.registry.core import query, r, r_sql
from millrace.session import work_path

# P(Z > z) for z >= 0, the same polynomial as the library's.
TAIL_SQL = (
    "0.5 * (((((1.061405429 * ({t}) - 1.453152027) * ({t}) + 1.421413741) * ({t}) - 0.284496736) * ({t})"
    " + 0.254829592) * ({t})) * exp(-({z}) * ({z}) / 2)"
)


def tail_sql(z: str) -> str:
    return TAIL_SQL.format(t=f"1 / (1 + 0.3275911 * ({z}) / sqrt(2.0::DOUBLE))", z=z)


def rounded(df, digits):
    return df.select(*[r(F.col(c), digits[c]).alias(c) if c in digits else F.col(c) for c in df.columns])


def measures(t):
    """Order-line measures; a tax of 0 counts as missing, prices are in thousands."""
    return t.lineitem.select(
        "l_quantity",
        (F.col("l_extendedprice") / 1000).alias("price_k"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
    )


MEASURES = """m AS (SELECT l_quantity, l_extendedprice / 1000 AS price_k, nullif(l_tax, 0) AS tax FROM lineitem)"""


def profile_sql(col: str) -> str:
    return f"""
  SELECT '{col}' AS variable, count({col}) AS num_records, count(*) - count({col}) AS num_nulls,
         min({col}) AS min, quantile_disc({col}, 0.5) AS median, {r_sql(f'avg({col})', 6)} AS average,
         max({col}) AS max, {r_sql(f'stddev_samp({col})', 6)} AS stddev, {r_sql(f'var_samp({col})', 6)} AS variance,
         {r_sql(f'sum(pow({col} - mean, 3)) / count({col}) / pow(stddev_samp({col}), 3)', 6)} AS skewness,
         {r_sql(f'sum(pow({col} - mean, 4)) / count({col}) / pow(var_samp({col}), 2)', 6)} AS kurtosis
  FROM m, (SELECT avg({col}) AS mean FROM m)"""


@query("dataset_stats", f"WITH {MEASURES}" + " UNION ALL ".join(map(profile_sql, ["l_quantity", "price_k", "tax"])))
def _(t):
    out = s.dataset_stats(measures(t), ["l_quantity", "price_k", "tax"], median="exact")
    return rounded(out, {c: 6 for c in ("average", "stddev", "variance", "skewness", "kurtosis")})


@query("pearson", f"SELECT {r_sql('corr(l_quantity, l_extendedprice)', 9)} AS r FROM lineitem")
def _(t):
    return rounded(s.pearson(t.lineitem, "l_quantity", "l_extendedprice"), {"r": 9})


@query("spearman", f"""
WITH k AS (
  SELECT rank() OVER (ORDER BY l_quantity) AS a, rank() OVER (ORDER BY l_extendedprice) AS b FROM lineitem)
SELECT {r_sql('corr(a, b)', 9)} AS spearman_r FROM k""")
def _(t):
    return rounded(s.spearman(t.lineitem, "l_quantity", "l_extendedprice"), {"spearman_r": 9})


@query("regression_aggregates", f"""
WITH d AS (SELECT l_extendedprice AS y, l_quantity AS x FROM lineitem
           WHERE l_extendedprice BETWEEN 1000 AND 100000 AND l_quantity BETWEEN 2 AND 49)
SELECT {r_sql('regr_slope(y, x)', 6)} AS slope, {r_sql('regr_intercept(y, x)', 4)} AS intercept,
       {r_sql('regr_r2(y, x)', 9)} AS r2 FROM d""")
def _(t):
    rows = t.lineitem.where(F.col("l_extendedprice").between(1000, 100000) & F.col("l_quantity").between(2, 49))
    return rounded(s.ols(rows, "l_extendedprice", "l_quantity"), {"slope": 6, "intercept": 4, "r2": 9})


@query("outlier_zscore", f"""
WITH m AS (SELECT avg(value) AS mu, stddev_samp(value) AS sd FROM events)
SELECT event_id, value, {r_sql('(value - mu) / sd', 6)} AS z_score FROM events, m WHERE abs((value - mu) / sd) > 3""")
def _(t):
    return rounded(s.zscore_outliers(t.events.select("event_id", "value"), "value"), {"z_score": 6})


@query("outlier_percentile", """
WITH p AS (SELECT quantile_disc(value, 0.01) AS p_lo, quantile_disc(value, 0.99) AS p_hi FROM events)
SELECT event_id, value, p_lo, p_hi FROM events, p WHERE value < p_lo OR value > p_hi""")
def _(t):
    return s.percentile_outliers(t.events.select("event_id", "value"), "value", method="exact")


@query("ks_normal", f"""
WITH x AS (SELECT l_quantity AS x FROM lineitem), f AS (SELECT avg(x) AS mu, stddev_samp(x) AS sd FROM x),
e AS (SELECT (x - mu) / sd AS z, row_number() OVER (ORDER BY x) / count(*) OVER () AS emp FROM x, f),
p AS (SELECT emp, CASE WHEN z >= 0 THEN 1 - ({tail_sql('abs(z)')}) ELSE {tail_sql('abs(z)')} END AS theo FROM e)
SELECT {r_sql('max(abs(emp - theo))', 9)} AS d_stat FROM p""")
def _(t):
    return rounded(s.ks_normal(t.lineitem, "l_quantity"), {"d_stat": 9})


@query("confidence_intervals", f"""
SELECT year(l_shipdate) AS grp, {r_sql('avg(l_quantity)', 8)} AS mean, {r_sql('stddev_samp(l_quantity)', 8)} AS s,
       count(*) AS n,
       {r_sql('avg(l_quantity) - 1.96 * stddev_samp(l_quantity) / sqrt(count(*))', 8)} AS ci_lower,
       {r_sql('avg(l_quantity) + 1.96 * stddev_samp(l_quantity) / sqrt(count(*))', 8)} AS ci_upper
FROM lineitem GROUP BY 1""")
def _(t):
    rows = t.lineitem.withColumn("year", F.year("l_shipdate").cast("bigint"))
    return rounded(s.mean_ci(rows, "year", "l_quantity"), {c: 8 for c in ("mean", "s", "ci_lower", "ci_upper")})


@query("t_test", f"""
WITH d AS (
  SELECT CAST(o_orderdate AS DATE) AS day, CAST(count(*) AS DOUBLE) AS n,
         dayofweek(CAST(o_orderdate AS DATE)) IN (0, 6) AS weekend
  FROM orders GROUP BY 1, 3),
g AS (
  SELECT avg(n) FILTER (weekend) AS a, avg(n) FILTER (NOT weekend) AS b,
         var_samp(n) FILTER (weekend) / count(*) FILTER (weekend) AS ea,
         var_samp(n) FILTER (NOT weekend) / count(*) FILTER (NOT weekend) AS eb,
         count(*) FILTER (weekend) AS na, count(*) FILTER (NOT weekend) AS nb FROM d)
SELECT {r_sql('a', 8)} AS mean_a, {r_sql('b', 8)} AS mean_b, {r_sql('abs(a - b) / sqrt(ea + eb)', 8)} AS t_statistic,
       CAST(na + nb - 2 AS DOUBLE) AS degrees_of_freedom,
       {r_sql('pow(ea + eb, 2) / (ea * ea / (na - 1) + eb * eb / (nb - 1))', 6)} AS welch_dof FROM g""")
def _(t):
    daily = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    daily = daily.withColumn("weekend", F.dayofweek("day").isin(1, 7))
    out = s.t_test(daily, "weekend", True, False, "n")
    return rounded(out, {"mean_a": 8, "mean_b": 8, "t_statistic": 8, "welch_dof": 6})


@query("mann_whitney", f"""
WITH d AS (SELECT l_returnflag AS g, l_quantity AS v FROM lineitem WHERE l_returnflag IN ('A', 'R')),
k AS (SELECT g, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS mid FROM d),
u AS (SELECT sum(mid) FILTER (g = 'A') AS ra, CAST(count(*) FILTER (g = 'A') AS DOUBLE) AS na,
             CAST(count(*) FILTER (g = 'R') AS DOUBLE) AS nb FROM k),
z AS (SELECT ra - na * (na + 1) / 2 AS u,
             greatest(abs(ra - na * (na + 1) / 2 - na * nb / 2) - 0.5, 0)
             / sqrt(na * nb / 12 * (na + nb + 1)) AS z FROM u)
SELECT u AS u_statistic, {r_sql('least(2 * ' + tail_sql('z') + ', 1.0)', 8)} AS p_value FROM z""")
def _(t):
    return rounded(s.mann_whitney(t.lineitem, "l_returnflag", "A", "R", "l_quantity"), {"p_value": 8})


@query("kruskal_wallis", f"""
WITH k AS (
  SELECT p_type AS g, rank() OVER (ORDER BY p_size) + (count(*) OVER (PARTITION BY p_size) - 1) / 2.0 AS mid
  FROM part),
per AS (SELECT g, sum(mid) AS r, CAST(count(*) AS DOUBLE) AS n FROM k GROUP BY g),
tie AS (SELECT sum(c * c * c - c) AS ties FROM (SELECT CAST(count(*) AS DOUBLE) AS c FROM part GROUP BY p_size)),
tot AS (SELECT sum(r * r / n) AS q, sum(n) AS n, count(*) AS k FROM per),
h AS (SELECT (12 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - ties / (n * n * n - n)) AS h, k FROM tot, tie)
SELECT {r_sql('h', 8)} AS h_statistic, k - 1 AS degrees_of_freedom,
       {r_sql('2 * ' + tail_sql('sqrt(h)') + " + exp(-h / 2) * (sqrt(h / 2) / 0.886226925452758"
               " + pow(h / 2, 1.5) / 1.329340388179137)", 8)} AS p_value
FROM h""")
def _(t):
    return rounded(s.kruskal_wallis(t.part, "p_type", "p_size"), {"h_statistic": 8, "p_value": 8})


def plain_sql(expr: str, digits: int) -> str:
    text = f"CAST(CAST({r_sql(expr, digits)} AS DECIMAL(38,{digits})) AS VARCHAR)"
    return f"regexp_replace({text}, '\\.?0+$', '')"


def anova_sql(variance: str) -> str:
    return f"""
WITH g AS (SELECT l_returnflag AS category, count(*) AS n, avg(l_quantity) AS mean,
                  {variance}(l_quantity) AS v FROM lineitem GROUP BY 1),
o AS (SELECT count(*) AS total, avg(l_quantity) AS grand, count(DISTINCT l_returnflag) AS k FROM lineitem),
a AS (SELECT k - 1 AS dfb, total - k AS dfw, sum(n * pow(mean - grand, 2)) AS ssb, sum((n - 1) * v) AS ssw
      FROM g, o GROUP BY k, total)"""


def anova_table_sql(variance: str) -> str:
    return anova_sql(variance) + f"""
SELECT 'GROUP_SUMMARY' AS result_type, category, CAST(n AS VARCHAR) AS value_1, {plain_sql('mean', 3)} AS value_2,
       {plain_sql('sqrt(v)', 3)} AS value_3 FROM g
UNION ALL SELECT 'ANOVA_TABLE', 'Between_Groups', CAST(dfb AS VARCHAR), {plain_sql('ssb', 2)},
       {plain_sql('ssb / dfb', 4)} FROM a
UNION ALL SELECT 'ANOVA_TABLE', 'Within_Groups', CAST(dfw AS VARCHAR), {plain_sql('ssw', 2)},
       {plain_sql('ssw / dfw', 4)} FROM a
UNION ALL SELECT 'ANOVA_TABLE', 'F_Statistic', NULL, NULL, {plain_sql('ssb / dfb / (ssw / dfw)', 4)} FROM a"""


@query("anova_table", anova_table_sql("var_samp"))
def _(t):
    return s.anova(t.lineitem, "l_returnflag", "l_quantity")


@query("anova_table_compat", anova_table_sql("var_pop"))
def _(t):
    return s.anova(t.lineitem, "l_returnflag", "l_quantity", compat=True)


def anova_rows_sql(name: str, table: str, group: str, col: str) -> str:
    """Sums of squares from the single values."""
    return f"""{name} AS (
  SELECT '{table}' AS rows_of, count(DISTINCT {group}) - 1 AS dfb, count(*) - count(DISTINCT {group}) AS dfw,
         sum(pow(mean - grand, 2)) AS ssb, sum(pow(v - mean, 2)) AS ssw
  FROM (SELECT {group}, {col} AS v, avg({col}) OVER (PARTITION BY {group}) AS mean, avg({col}) OVER () AS grand
        FROM {table}))"""


@query("anova_conclusion", f"""
WITH {anova_rows_sql("a", "lineitem", "l_returnflag", "l_quantity")},
{anova_rows_sql("b", "nation", "n_regionkey", "n_nationkey")},
f AS (SELECT *, ssb / dfb / (ssw / dfw) AS f, CASE WHEN dfb = 4 AND dfw = 20 THEN 2.87
        ELSE 3.0 + 10.0 / dfw - 0.1 * dfb END AS critical FROM (FROM a UNION ALL FROM b))
SELECT rows_of, {r_sql('f', 6)} AS f_statistic, dfb AS df_between, dfw AS df_within, {r_sql('critical', 6)} AS f_critical,
       CASE WHEN f > critical THEN 'SIGNIFICANT - Reject H0'
            ELSE 'NOT SIGNIFICANT - Fail to reject H0' END AS conclusion FROM f""")
def _(t):
    """Lines by return flag (critical value by formula) and nations by region (by table)."""
    tables = {"lineitem": (t.lineitem, "l_returnflag", "l_quantity"), "nation": (t.nation, "n_regionkey", "n_nationkey")}
    out = [
        s.anova_conclusion(s.anova_components(s.anova_groups(*args))).withColumn("rows_of", F.lit(name))
        for name, args in tables.items()
    ]
    return rounded(out[0].unionByName(out[1]), {"f_statistic": 6, "f_critical": 6})


@query("daily_sketches", """
SELECT event_type, count(*) AS row_count, count(DISTINCT user_id) AS users, true AS users_close, true AS quantiles_close
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' GROUP BY 1""")
def _(t):
    """Sixteen days out of stored daily sketches, beside the exact counts and ranks of the same rows."""
    path = work_path(t.spark, "sketches")
    sketches.write_days(t.events, path, F.to_date("ts"), ["event_type"], ["user_id"], ["value"])
    first, last = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
    told = sketches.range_stats(t.spark, path, first, last, ["event_type"])
    rows = t.events.where(F.to_date("ts").between(F.lit(first), F.lit(last)))
    exact = rows.join(told.select("event_type", "value_q50"), "event_type").groupBy("event_type").agg(
        F.count_distinct("user_id").alias("users"), F.avg((F.col("value") <= F.col("value_q50")).cast("double")).alias("below"))
    return told.join(exact, "event_type").select(
        "event_type", F.col("rows").alias("row_count"), "users",
        (F.abs(F.col("user_id_distinct") - F.col("users")) <= F.greatest(F.lit(2.0), 0.08 * F.col("users"))).alias("users_close"),
        (F.abs(F.col("below") - 0.5) <= 0.05).alias("quantiles_close"))
