"""Descriptive statistics, outliers and hypothesis tests as DataFrame aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import chi2_sf, normal_cdf, plain_number
from millrace.functions.constants import F_CRITICAL_05, NOT_SIGNIFICANT, SIGNIFICANT
from millrace.functions.exprs import normal_tail
from millrace.operators.ordering import column_quantiles, value_counts
from millrace.session import materialize


def one_row(stats: DataFrame, name: str = "_s") -> Column:
    """A one-row DataFrame as a scalar struct column (a scalar subquery, not a join)."""
    return stats.select(F.struct("*").alias(name)).scalar()


def dataset_stats(
    df: DataFrame,
    cols: Sequence[str],
    drop_nulls: bool = False,
    median: str = "approx",
    accuracy: int = 10000,
) -> DataFrame:
    """Profile of numeric columns, one row per column.

    All moments come from one scan and one row of partial results per task; the
    wide result is turned into rows afterwards, so input rows are never multiplied.
    ``skewness`` and ``kurtosis`` put population moments over the sample deviation.
    ``median='approx'`` takes a bounded sketch in a scan of its own (beside a sketch
    Spark would run the moments without code generation); ``'exact'`` refines it.
    ``drop_nulls=True`` leaves NULLs out of the null count, as UNPIVOT does.
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        n = F.count(x).cast("double")
        shrink = (n - 1) / n
        aggs.append(
            F.struct(
                F.lit(c).alias("variable"),
                F.count(x).alias("num_records"),
                (F.lit(0) if drop_nulls else F.count(F.lit(1)) - F.count(x)).cast("bigint").alias("num_nulls"),
                F.min(x).alias("min"),
                F.avg(x).alias("average"),
                F.max(x).alias("max"),
                F.stddev_samp(x).alias("stddev"),
                F.var_samp(x).alias("variance"),
                (F.skewness(x) * F.pow(shrink, 1.5)).alias("skewness"),
                ((F.kurtosis(x) + 3) * F.pow(shrink, 2.0)).alias("kurtosis"),
            ).alias(c)
        )
    moments = df.agg(*aggs).select(F.inline(F.array(*cols)))
    if median == "exact":
        middle = column_quantiles(df, cols, {"median": 0.5}, interpolate=False)
    else:
        sketches = [
            F.struct(F.lit(c).alias("variable"), F.percentile_approx(F.col(c).cast("double"), 0.5, accuracy).alias("median"))
            .alias(c) for c in cols
        ]
        middle = df.agg(*sketches).select(F.inline(F.array(*cols)))
    return moments.join(middle, "variable", "left").select(
        "variable", "num_records", "num_nulls", "min", "median", "average", "max",
        "stddev", "variance", "skewness", "kurtosis",
    )


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson correlation over rows where both values are present."""
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).agg(F.corr(x, y).alias("r"))


def spearman(df: DataFrame, x: str, y: str, ties: str = "min") -> DataFrame:
    """Rank correlation; ``ties='min'`` ranks like RANK(), ``'average'`` uses mid-ranks.

    Equal (x, y) pairs are counted first and stored: ranks of the distinct values come from them
    and are joined back to them, so the table is read once and no window sees it whole.
    """
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(x).alias("x"), F.col(y).alias("y"))
    pairs = materialize(both.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w")))

    def ranks(col: str) -> DataFrame:
        mid = (F.col("n") + 1) / 2 if ties == "average" else F.lit(1.0)
        # Ranks from the middle of the table, which keeps the sums below small.
        rank = F.col("n_before") + mid - F.col("n_total") / 2
        return value_counts(pairs, col, rows=F.col("w")).select(col, rank.alias(f"r{col}"))

    ranked = pairs.join(ranks("x"), "x").join(ranks("y"), "y")
    centred = ranked.select(F.col("w").cast("double").alias("w"), F.col("rx").alias("a"), F.col("ry").alias("b"))
    s = centred.agg(
        F.sum("w").alias("n"),
        F.sum(F.col("w") * F.col("a")).alias("sa"),
        F.sum(F.col("w") * F.col("b")).alias("sb"),
        F.sum(F.col("w") * F.col("a") * F.col("a")).alias("saa"),
        F.sum(F.col("w") * F.col("b") * F.col("b")).alias("sbb"),
        F.sum(F.col("w") * F.col("a") * F.col("b")).alias("sab"),
    )
    cov = F.col("sab") - F.col("sa") * F.col("sb") / F.col("n")
    va = F.col("saa") - F.col("sa") * F.col("sa") / F.col("n")
    vb = F.col("sbb") - F.col("sb") * F.col("sb") / F.col("n")
    return s.select(F.try_divide(cov, F.sqrt(va) * F.sqrt(vb)).alias("spearman_r"))


def ols(df: DataFrame, y: str, x: str) -> DataFrame:
    """Slope, intercept and R2 of y on x from one pass of aggregates."""
    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    s = both.agg(
        F.avg(y).alias("my"), F.avg(x).alias("mx"), F.covar_pop(y, x).alias("c"),
        F.var_pop(x).alias("v"), F.corr(y, x).alias("r"),
    )
    slope = F.try_divide(F.col("c"), F.col("v"))
    return s.select(
        slope.alias("slope"),
        (F.col("my") - slope * F.col("mx")).alias("intercept"),
        F.pow("r", F.lit(2.0)).alias("r2"),
    )


def zscore_outliers(df: DataFrame, col: str, z: float = 3.0) -> DataFrame:
    """Rows whose z-score exceeds ``z`` in size, with the score."""
    s = one_row(df.agg(F.avg(col).alias("m"), F.stddev_samp(col).alias("sd")))
    score = F.try_divide(F.col(col) - s["m"], s["sd"])
    return df.withColumn("z_score", score).where(F.abs("z_score") > z)


def percentile_outliers(
    df: DataFrame, col: str, lo: float = 0.01, hi: float = 0.99, method: str = "approx", accuracy: int = 10000
) -> DataFrame:
    """Rows below the ``lo`` or above the ``hi`` percentile, with both limits.

    ``'approx'`` keeps a bounded sketch per task; ``'exact'`` refines it in two more scans.
    """
    if method == "exact":
        limits = column_quantiles(df, [col], {"p_lo": lo, "p_hi": hi}, interpolate=False)
    else:
        limits = df.agg(
            F.percentile_approx(col, lo, accuracy).alias("p_lo"),
            F.percentile_approx(col, hi, accuracy).alias("p_hi"),
        )
    s = one_row(limits)
    return (
        df.withColumn("p_lo", s["p_lo"])
        .withColumn("p_hi", s["p_hi"])
        .where((F.col(col) < F.col("p_lo")) | (F.col(col) > F.col("p_hi")))
    )


def ks_normal(df: DataFrame, col: str) -> DataFrame:
    """Kolmogorov-Smirnov distance between the empirical distribution and the fitted normal.

    The empirical distribution steps row by row; inside equal values the largest
    gap is at the first or the last row, so both ends of each value are checked.
    """
    x = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("x"))
    fit = one_row(x.agg(F.avg("x").alias("mu"), F.stddev_samp("x").alias("sigma")))
    steps = value_counts(x, "x")
    theory = normal_cdf(F.col("x"), fit["mu"], fit["sigma"])
    first = F.abs((F.col("n_before") + 1) / F.col("n_total") - F.col("f"))
    last = F.abs((F.col("n_before") + F.col("n")) / F.col("n_total") - F.col("f"))
    return steps.withColumn("f", theory).agg(F.max(F.greatest(first, last)).alias("d_stat"))


def mean_ci(df: DataFrame, group: str, col: str, z: float = 1.96) -> DataFrame:
    """Normal-approximation confidence interval of the mean per group."""
    margin = F.lit(z) * F.col("s") / F.sqrt(F.col("n"))
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(group).alias("grp"))
        .agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("s"), F.count(F.lit(1)).alias("n"))
        .withColumn("ci_lower", F.col("mean") - margin)
        .withColumn("ci_upper", F.col("mean") + margin)
    )


def t_test(df: DataFrame, group: str, a, b, col: str) -> DataFrame:
    """Two-sample t statistic (absolute, unequal variances) for groups ``a`` and ``b``.

    ``degrees_of_freedom`` is n_a + n_b - 2; ``welch_dof`` is the Welch-Satterthwaite
    value.  NULLs are left out.
    """
    def stat(fn, value):
        return fn(F.when(F.col(group) == F.lit(value), F.col(col).cast("double")))

    s = df.where(F.col(group).isin(a, b)).agg(
        stat(F.avg, a).alias("mean_a"), stat(F.avg, b).alias("mean_b"),
        stat(F.var_samp, a).alias("va"), stat(F.var_samp, b).alias("vb"),
        stat(F.count, a).alias("na"), stat(F.count, b).alias("nb"),
    )
    ea, eb = F.col("va") / F.col("na"), F.col("vb") / F.col("nb")
    return s.select(
        "mean_a",
        "mean_b",
        F.try_divide(F.abs(F.col("mean_a") - F.col("mean_b")), F.sqrt(ea + eb)).alias("t_statistic"),
        (F.col("na") + F.col("nb") - 2).cast("double").alias("degrees_of_freedom"),
        F.try_divide(
            F.pow(ea + eb, F.lit(2.0)),
            ea * ea / (F.col("na") - 1) + eb * eb / (F.col("nb") - 1),
        ).alias("welch_dof"),
    )


def mann_whitney(
    df: DataFrame, group: str, a, b, col: str, continuity: bool = True, tie_correction: bool = False
) -> DataFrame:
    """Mann-Whitney U of group ``a`` against ``b`` with the two-sided normal p-value.

    Mid-ranks come from counts per distinct value; no row-level ranks are needed.
    """
    two = df.where(F.col(group).isin(a, b) & F.col(col).isNotNull())
    ranked = value_counts(two, col, sums={
        "na": F.when(F.col(group) == F.lit(a), 1).otherwise(0),
        "nb": F.when(F.col(group) == F.lit(b), 1).otherwise(0),
    })
    mid = F.col("n_before") + (F.col("n") + 1) / 2
    n = F.col("n").cast("double")
    s = ranked.agg(
        F.sum(F.col("na") * mid).alias("ra"),
        F.max("na_total").cast("double").alias("na"),
        F.max("nb_total").cast("double").alias("nb"),
        F.sum(n * n * n - n).alias("ties"),
    )
    na, nb = F.col("na"), F.col("nb")
    total = na + nb
    u = F.col("ra") - na * (na + 1) / 2
    spread = total + 1
    if tie_correction:
        spread = spread - F.col("ties") / (total * (total - 1))
    sd = F.sqrt(na * nb / 12 * spread)
    gap = F.greatest(F.abs(F.col("u") - na * nb / 2) - F.lit(0.5 if continuity else 0.0), F.lit(0.0))
    p = F.least(F.lit(2.0) * normal_tail(F.try_divide(gap, sd)), F.lit(1.0))
    return s.withColumn("u", u).select(F.col("u").alias("u_statistic"), p.alias("p_value"))


def kruskal_wallis(df: DataFrame, group: str, col: str) -> DataFrame:
    """Tie-corrected Kruskal-Wallis H, chi-square p-value and degrees of freedom.

    Reads the rows once; ranks come from the stored counts per (group, value).
    """
    data = df.where(F.col(col).isNotNull() & F.col(group).isNotNull()).select(
        F.col(group).alias("g"), F.col(col).alias("v")
    )
    cells = materialize(data.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n")))
    ranks = value_counts(cells, "v", rows=F.col("n")).select(
        "v",
        (F.col("n_before") + (F.col("n") + 1) / 2).alias("mid"),
        F.col("n").alias("tie"),
        F.col("n_total").alias("all_n"),
    )
    per_group = cells.join(ranks, "v").groupBy("g").agg(
        F.sum(F.col("n") * F.col("mid")).alias("r"),
        F.sum("n").cast("double").alias("n"),
    )
    tie = F.col("tie").cast("double")
    overall = one_row(ranks.agg(
        F.sum(tie * tie * tie - tie).alias("ties"), F.max("all_n").cast("double").alias("n")
    ))
    s = per_group.agg(
        F.sum(F.col("r") * F.col("r") / F.col("n")).alias("q"), F.count(F.lit(1)).alias("k")
    ).withColumn("o", overall)
    n = F.col("o.n")
    raw = F.lit(12.0) / (n * (n + 1)) * F.col("q") - F.lit(3.0) * (n + 1)
    h = F.try_divide(raw, F.lit(1.0) - F.col("o.ties") / (n * n * n - n))
    out = s.select(h.alias("h_statistic"), (F.col("k") - 1).alias("degrees_of_freedom"))
    return out.withColumn("p_value", chi2_sf(F.col("h_statistic"), F.col("degrees_of_freedom")))


def anova_groups(df: DataFrame, group: str, col: str, compat: bool = False) -> DataFrame:
    """Count, mean and variance per group (population variance with ``compat``)."""
    variance = F.var_pop if compat else F.var_samp
    return (
        df.where(F.col(col).isNotNull() & F.col(group).isNotNull())
        .groupBy(F.col(group).cast("string").alias("category"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(col).alias("mean"),
            F.coalesce(variance(col), F.lit(0.0)).alias("variance"),
        )
    )


def anova_components(groups: DataFrame) -> DataFrame:
    """One row of degrees of freedom, sums of squares and mean squares.

    The overall mean follows from the group counts and means, so the data is read
    once and only one row per group is combined.
    """
    grand = one_row(groups.agg((F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("m")))["m"]
    off = F.col("mean") - grand
    s = groups.agg(
        (F.count(F.lit(1)) - 1).alias("df_between"),
        (F.sum("n") - F.count(F.lit(1))).alias("df_within"),
        F.sum(F.col("n") * off * off).alias("ssb"),
        F.sum((F.col("n") - 1) * F.col("variance")).alias("ssw"),
    )
    msb, msw = F.try_divide("ssb", "df_between"), F.try_divide("ssw", "df_within")
    return s.withColumn("msb", msb).withColumn("msw", msw).withColumn("f", F.try_divide("msb", "msw"))


def anova(df: DataFrame, group: str, col: str, compat: bool = False) -> DataFrame:
    """One-way ANOVA report: one row per group, then the between/within/F rows.

    ``compat=True`` weights population variances by n - 1 in the within sum.
    """
    groups = anova_groups(df, group, col, compat)
    parts = anova_components(groups)
    summary = groups.select(
        F.lit("GROUP_SUMMARY").alias("result_type"),
        "category",
        F.col("n").cast("string").alias("value_1"),
        plain_number(F.col("mean"), 3).alias("value_2"),
        plain_number(F.sqrt("variance"), 3).alias("value_3"),
    )
    none = F.lit(None).cast("string")

    def line(name: str, v1: Column, v2: Column, v3: Column) -> Column:
        return F.struct(
            F.lit("ANOVA_TABLE").alias("result_type"), F.lit(name).alias("category"),
            v1.alias("value_1"), v2.alias("value_2"), v3.alias("value_3"),
        )

    table = parts.select(F.inline(F.array(
        line("Between_Groups", F.col("df_between").cast("string"),
             plain_number(F.col("ssb"), 2), plain_number(F.col("msb"), 4)),
        line("Within_Groups", F.col("df_within").cast("string"),
             plain_number(F.col("ssw"), 2), plain_number(F.col("msw"), 4)),
        line("F_Statistic", none, none, plain_number(F.col("f"), 4)),
    )))
    return summary.unionByName(table).orderBy(F.desc("result_type"), F.asc_nulls_last("value_1"), "category")


def f_critical_05(df1: Column, df2: Column) -> Column:
    """Critical F value at 5 %: table lookup, else 3 + 10/df2 - df1/10."""
    pairs = [p for (a, b), v in F_CRITICAL_05.items() for p in (F.lit(f"{a},{b}"), F.lit(v))]
    known = F.try_element_at(F.create_map(*pairs), F.concat_ws(",", df1.cast("string"), df2.cast("string")))
    return F.coalesce(known, F.lit(3.0) + F.lit(10.0) / df2 - F.lit(0.1) * df1)


def anova_conclusion(parts: DataFrame) -> DataFrame:
    """F statistic, critical value and verdict from ``anova_components``."""
    critical = f_critical_05(F.col("df_between"), F.col("df_within"))
    return parts.select(
        F.col("f").alias("f_statistic"),
        "df_between",
        "df_within",
        critical.alias("f_critical"),
        F.when(F.col("f") > critical, SIGNIFICANT).otherwise(NOT_SIGNIFICANT).alias("conclusion"),
    )
