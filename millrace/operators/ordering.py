"""Running totals, ranks and exact quantiles without pulling the data into one task.

A window without PARTITION BY sorts every row in one task, and one partitioned by
a hot key does the same for that key.  Here the rows are range-partitioned by
(group, order value), running sums are taken inside each range, and each range is
shifted by the sums of the ranges before it.  The table of range sums has one row
per (group, range), so with no group it has at most one row per shuffle partition.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.session import materialize


def running_sums(
    df: DataFrame,
    order: Sequence[Column],
    sums: Sequence[str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Add ``<s>_before`` (sum over earlier rows) and ``<s>_total`` (sum over the group).

    ``order`` must identify a row inside its group: aggregate equal values first.
    Runs one eager job (the range-partitioned rows are written to the checkpoint
    folder, which pins every row to its range).
    """
    keys = [F.col(c) for c in by]
    placed = materialize(
        df.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    )
    # One struct as the group key: NULL groups are equal to each other, and the window
    # and the join below share one hash partitioning.
    group = F.struct(*keys) if by else F.lit(0)
    placed = placed.withColumn("_group", group)
    inside = W.partitionBy("_group", "_range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = placed
    for s in sums:
        local = local.withColumn(f"{s}_local", F.coalesce(F.sum(s).over(inside), F.lit(0)))

    earlier = W.partitionBy("_group").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy("_group")
    ranges = placed.groupBy("_group", "_range").agg(*[F.sum(s).alias(s) for s in sums])
    offsets = ranges.select(
        "_group",
        "_range",
        *[F.coalesce(F.sum(s).over(earlier), F.lit(0)).alias(f"{s}_offset") for s in sums],
        *[F.sum(s).over(whole).alias(f"{s}_total") for s in sums],
    )
    if not by:
        offsets = F.broadcast(offsets)  # one row per range: at most the number of shuffle partitions
    joined = local.join(offsets, ["_group", "_range"])
    return joined.select(
        *df.columns,
        *[(F.col(f"{s}_local") + F.col(f"{s}_offset")).alias(f"{s}_before") for s in sums],
        *[F.col(f"{s}_total") for s in sums],
    )


def value_counts(
    df: DataFrame,
    col: str,
    by: Sequence[str] = (),
    sums: Mapping[str, Column] | None = None,
    descending: bool = False,
    rows: Column | None = None,
) -> DataFrame:
    """One row per distinct non-null value with its count ``n`` and running sums.

    ``rows`` says how many rows one row of ``df`` stands for (1 by default).

    Columns: ``by``, ``col``, ``n`` and every name in ``sums``, each with
    ``_before`` and ``_total``.  Equal values are combined map-side, so a value
    that holds a third of all rows is still one row.
    """
    measures = {"n": F.lit(1).cast("bigint") if rows is None else rows, **(sums or {})}
    counted = (
        df.where(F.col(col).isNotNull())
        .groupBy(*by, col)
        .agg(*[F.sum(expr).alias(name) for name, expr in measures.items()])
    )
    order = F.col(col).desc() if descending else F.col(col).asc()
    return running_sums(counted, [order], list(measures), by)


def column_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Mapping[str, float],
    interpolate: bool = True,
    accuracy: int = 10000,
) -> DataFrame:
    """Exact quantiles of several columns: one row (``variable``, one column per entry of ``probs``).

    ``interpolate=True`` follows PERCENTILE_CONT, otherwise PERCENTILE_DISC.

    A sketch first gives a narrow window of values around each quantile and a second
    scan counts what lies below it; then only the values inside the windows (a few
    ten-thousandths of the rows) are shuffled and ranked.  If a window turns out not to
    hold its quantile, the whole column is ranked instead.  The two scans are eager and bring one row each to the
    driver.
    """
    data = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    margin = 2 / accuracy
    edges = [e for p in probs.values() for e in (max(0.0, p - margin), min(1.0, p + margin))]
    sketch = data.agg(*[
        F.struct(
            F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"),
            F.percentile_approx(c, edges, accuracy).alias("edges"),
        ).alias(c)
        for c in cols
    ]).first()

    # Per column and quantile: the wanted positions, and the window of values to rank.
    wanted, window = {}, {}
    for c in cols:
        n = sketch[c]["n"]
        for i, (name, p) in enumerate(probs.items() if n else ()):
            if interpolate:
                wanted[c, name] = math.floor(p * (n - 1)), math.ceil(p * (n - 1))
            else:
                wanted[c, name] = (max(math.ceil(p * n) - 1, 0),) * 2
            window[c, name] = tuple(sketch[c]["edges"][2 * i: 2 * i + 2])
    if not wanted:
        return data.sparkSession.createDataFrame([], "variable string, " + ", ".join(f"{q} double" for q in probs))

    counts = data.agg(*[
        F.struct(F.count_if(F.col(c) < window[c, q][0]), F.count_if(F.col(c) <= window[c, q][1])) for c, q in wanted
    ]).first()
    for (c, q), (below, upto) in zip(list(wanted), counts):
        first, last = wanted[c, q]
        if below <= first and last < upto:
            wanted[c, q] = first - below, last - below
        else:
            window[c, q] = sketch[c]["lo"], sketch[c]["hi"]

    # Quantiles with the same window share its ranked values.
    spans = sorted({(c, window[c, q]) for c, q in wanted})

    def within(c: str, span: tuple[float, float]) -> Column:
        return F.col(c).between(*span)

    cells = [
        F.when(within(*span), F.struct(F.lit(i).alias("span"), F.col(span[0]).alias("value")))
        for i, span in enumerate(spans)
    ]
    values = (
        data.where(reduce(lambda x, y: x | y, [within(*span) for span in spans]))
        .select(F.explode(F.filter(F.array(*cells), lambda e: e.isNotNull())).alias("e"))
        .groupBy("e.span", "e.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_sums(values, [F.col("value")], ["n"], ["span"])

    def value_at(c: str, q: str, position: int) -> Column:
        here = F.col("span") == spans.index((c, window[c, q]))
        return F.max(F.when(
            here & (F.col("n_before") <= position) & (F.lit(position) < F.col("n_before") + F.col("n")), F.col("value")
        ))

    # One row of all wanted values, then one row per column.
    found = ranked.agg(*[
        value_at(c, q, wanted[c, q][side]).alias(f"{i}_{side}")
        for i, (c, q) in enumerate(wanted) for side in (0, 1)
    ])

    def quantile(c: str, q: str) -> Column:
        if (c, q) not in wanted:
            return F.lit(None).cast("double")
        i = list(wanted).index((c, q))
        low, high = F.col(f"{i}_0"), F.col(f"{i}_1")
        position = probs[q] * (sketch[c]["n"] - 1)
        return low + (high - low) * F.lit(float(position - math.floor(position))) if interpolate else low

    rows = [
        F.struct(F.lit(c).alias("variable"), *[quantile(c, q).alias(q) for q in probs])
        for c in cols if sketch[c]["n"]
    ]
    return found.select(F.inline(F.array(*rows)))


def positions(df: DataFrame, order: Sequence[Column], by: Sequence[str] = ()) -> DataFrame:
    """Add the 0-based position ``pos`` of every row inside its group.

    ``order`` must be total inside a group (end it with a unique key).
    """
    out = running_sums(df.withColumn("_one", F.lit(1).cast("bigint")), order, ["_one"], by)
    return out.withColumnRenamed("_one_before", "pos").drop("_one", "_one_total")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key.

    The row-number filter lets Spark cut every key to ``n`` rows per map task before
    the shuffle (WindowGroupLimit), so a hot key never reaches one task whole.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")
