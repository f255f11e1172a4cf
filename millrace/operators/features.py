"""Feature engineering: encodings, bins, tokens, folds, entity and time features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import great_circle_m, hash63, hash_bucket
from millrace.functions.constants import STOPWORDS
from millrace.operators.ordering import column_quantiles
from millrace.operators.stats import one_row
from millrace.session import materialize


def one_hot(df: DataFrame, col: str, values: Sequence[str], prefix: str | None = None) -> DataFrame:
    """One 0/1 column per listed value; rows without a value are left out."""
    prefix = prefix or col
    flags = [(F.col(col) == F.lit(v)).cast("int").alias(f"{prefix}_{str(v).lower()}") for v in values]
    return df.where(F.col(col).isNotNull()).select("*", *flags)


def frequency_encode(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Add the number of rows that share the value of ``col``.

    The counts are partial-aggregated, then joined back; Catalyst broadcasts them
    when small, and adaptive execution splits a hot value when they are not.
    """
    freq = df.groupBy(col).agg(F.count(F.lit(1)).alias(out or f"{col}_freq"))
    return df.join(freq, col)


def hash_feature(df: DataFrame, col: str, n: int = 1024, out: str | None = None) -> DataFrame:
    """Hashing trick: bucket 0 .. n-1 of a non-null string."""
    return df.where(F.col(col).isNotNull()).withColumn(out or f"{col}_bucket_{n}", hash_bucket(F.col(col), n))


def _clean(text: Column, keep: str, compat: bool) -> Column:
    """Lower-case and drop all other characters; ``compat`` drops before lower-casing."""
    pattern = f"[^{keep}]+"
    if compat:
        return F.lower(F.regexp_replace(text, pattern, ""))
    return F.regexp_replace(F.lower(text), pattern, "")


def tokens(
    df: DataFrame, id_col: str, col: str, stopwords: Sequence[str] = STOPWORDS, compat: bool = False
) -> DataFrame:
    """One row (id, token) per word of a text, without stop words."""
    words = F.split(_clean(F.col(col), "a-z0-9 ", compat), " ")
    kept = F.filter(words, lambda t: (t != "") & ~t.isin(*stopwords)) if stopwords else F.filter(words, lambda t: t != "")
    return df.where(F.col(col).isNotNull()).select(id_col, F.explode(kept).alias("token"))


def char_ngrams(df: DataFrame, id_col: str, col: str, n: int = 3, compat: bool = False) -> DataFrame:
    """One row (id, ngram) per character n-gram of a text's letters and digits.

    A look-ahead match yields overlapping n-grams in one pass over the text; taking
    substrings by position would walk the text again for each of them.
    """
    grams = F.regexp_extract_all(_clean(F.col(col), "a-z0-9", compat), F.lit(f"(?=(.{{{n}}}))"), F.lit(1))
    return df.where(F.col(col).isNotNull()).select(id_col, F.explode(grams).alias("ngram"))


def equal_freq_bins(df: DataFrame, col: str, n: int = 10, out: str = "bin") -> DataFrame:
    """Bins 1 .. n of nearly equal size from exact interpolated quantiles."""
    present = df.where(F.col(col).isNotNull())
    probs = {f"q{i}": i / n for i in range(1, n)}
    cuts = one_row(column_quantiles(present, [col], probs))
    label = F.lit(n)
    for i in range(n - 1, 0, -1):
        label = F.when(F.col(col) < cuts[f"q{i}"], i).otherwise(label)
    return present.withColumn(out, label)


def equal_width_bins(df: DataFrame, col: str, n: int = 10, out: str = "bin") -> DataFrame:
    """Bins 1 .. n of equal width between minimum and maximum (all 1 if they are equal)."""
    present = df.where(F.col(col).isNotNull())
    s = one_row(present.agg(F.min(col).alias("lo"), ((F.max(col) - F.min(col)) / n).alias("width")))
    step = F.floor(F.try_divide(F.col(col) - s["lo"], s["width"])).cast("int")
    return present.withColumn(out, F.coalesce(F.least(F.lit(n), step + 1), F.lit(1)))


def kfold(df: DataFrame, key: str, k: int = 5, out: str = "fold") -> DataFrame:
    """Stable fold 0 .. k-1 from the hash of a key."""
    return df.withColumn(out, hash_bucket(F.col(key), k))


def target_encode_oof(
    df: DataFrame, category: str, target: str, fold: str, m: float = 20.0, out: str | None = None
) -> DataFrame:
    """Out-of-fold target mean per category, shrunk by ``m`` rows towards the out-of-fold mean.

    One scan builds the (category, fold) sums, which are stored because four totals
    derive from them (one eager job); one join brings the encoding back to the rows.
    """
    items = df.where(F.col(target).isNotNull() & F.col(category).isNotNull())
    cells = materialize(items.groupBy(category, fold).agg(
        F.sum(target).cast("double").alias("cs"), F.count(F.lit(1)).alias("cn")
    ))
    per_category = cells.groupBy(category).agg(F.sum("cs").alias("ks"), F.sum("cn").alias("kn"))
    per_fold = cells.groupBy(fold).agg(F.sum("cs").alias("fs"), F.sum("cn").alias("fn"))
    everything = one_row(cells.agg(F.sum("cs").alias("s"), F.sum("cn").alias("n")))
    prior = F.try_divide(everything["s"] - F.col("fs"), (everything["n"] - F.col("fn")).cast("double"))
    encoded = (
        cells.join(per_category, category)
        .join(per_fold, fold)
        .select(
            F.col(category).alias("_c"),
            F.col(fold).alias("_f"),
            F.try_divide(
                F.col("ks") - F.col("cs") + F.lit(float(m)) * prior,
                (F.col("kn") - F.col("cn")).cast("double") + F.lit(float(m)),
            ).alias(out or f"{category}_target_enc"),
        )
    )
    # Every row has its cell; a left join keeps Spark from testing the fold for NULL first,
    # which would compute its hash twice.
    joined = items.join(encoded, (F.col(category) == F.col("_c")) & (F.col(fold) == F.col("_f")), "left")
    return joined.drop("_c", "_f")


def trip_features(
    df: DataFrame,
    label: str,
    duration: str,
    start: str,
    place: str,
    start_point: tuple[str, str] | None = None,
    end_point: tuple[str, str] | None = None,
    low: float = 60,
    high: float = 7200,
) -> DataFrame:
    """Per-event features: hour, weekday (1 = Sunday), point distance, with range and null guards.

    Points are (longitude, latitude) column names; without them no distance is added.
    """
    rows = df.where(
        F.col(label).isNotNull() & F.col(place).isNotNull() & F.col(duration).between(low, high)
    )
    cols = [
        F.col(label), F.col(duration), F.col(start),
        F.hour(start).alias("start_hour"), F.dayofweek(start).alias("day_of_week"), F.col(place),
    ]
    if start_point and end_point:
        (x1, y1), (x2, y2) = start_point, end_point
        rows = rows.where(F.col(y1).isNotNull() & F.col(y2).isNotNull())
        cols.append(great_circle_m(F.col(x1), F.col(y1), F.col(x2), F.col(y2)).alias("distance_m"))
    return rows.select(*cols)


def entity_features(
    df: DataFrame,
    entity: str,
    duration: str,
    start: str,
    kind: str,
    min_rows: int = 100,
    low: float = 60,
    high: float = 7200,
) -> DataFrame:
    """Per-entity aggregates for entities with at least ``min_rows`` rows.

    Rows are summed per (entity, day, kind) first, so the distinct days and kinds need no copies of the
    rows: each is counted at its first cell.  Sums of squares are taken around the entity's mean in a
    second step over the cells' own means.
    """
    rows = df.where(F.col(entity).isNotNull() & F.col(duration).between(low, high)).select(
        F.col(entity).alias("_e"), F.to_date(start).alias("_day"), F.col(kind).alias("_kind"),
        F.col(duration).cast("double").alias("_d"), F.hour(start).alias("_h"))
    cells = rows.groupBy("_e", "_day", "_kind").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_d").alias("s"), F.var_pop("_d").alias("v"), F.avg("_d").alias("a"),
        F.count("_h").alias("hn"), F.sum("_h").alias("hs"))
    days = cells.groupBy("_e", "_day").agg(
        F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum(F.col("n") * F.col("v")).alias("inside"),
        F.sum(F.col("n") * F.col("a") * F.col("a")).alias("squares"), F.sum("hn").alias("hn"), F.sum("hs").alias("hs"),
        F.collect_set("_kind").alias("kinds"))
    total, mean = F.sum("n"), F.sum("s") / F.sum("n")
    spread = F.greatest(F.sum("inside") + F.sum("squares") - total * mean * mean, F.lit(0.0))
    return days.groupBy(F.col("_e").alias(entity)).agg(
        total.alias("total_trips"), mean.alias("avg_duration"),
        F.sqrt(F.try_divide(spread, total - 1)).alias("stddev_duration"),
        F.count("_day").alias("active_days"), F.try_divide(F.sum("hs"), F.sum("hn")).alias("avg_start_hour"),
        F.size(F.array_distinct(F.flatten(F.collect_set("kinds")))).cast("long").alias("user_types"),
    ).where(F.col("total_trips") >= min_rows)


def interactions(
    df: DataFrame, user_parts: Sequence[str], item: str, users: int = 10000, min_count: int = 2, cap: int = 5
) -> DataFrame:
    """User-item table with rating = min(number of uses, cap); users are hashed ids."""
    guard = F.col(item).isNotNull()
    for c in user_parts:
        guard = guard & F.col(c).isNotNull()
    key = F.concat(*[F.col(c).cast("string") for c in user_parts])
    return (
        df.where(guard)
        .groupBy(
            F.concat(F.lit("user_"), (hash63(key) % users).cast("string")).alias("user_id"),
            F.col(item).alias("item_id"),
        )
        .agg(F.count(F.lit(1)).alias("uses"))
        .where(F.col("uses") >= min_count)
        .select("user_id", "item_id", F.least(F.col("uses"), F.lit(cap)).cast("int").alias("rating"))
    )


def daily_series(df: DataFrame, start: str, duration: str, place: str, since=None, until=None) -> DataFrame:
    """One row per day: rows, mean duration, distinct places, weekend flag.  ``until`` is exclusive."""
    rows = df
    if since is not None:
        rows = rows.where(F.col(start) >= F.lit(since))
    if until is not None:
        rows = rows.where(F.col(start) < F.lit(until))
    return rows.groupBy(F.to_date(start).alias("trip_date")).agg(
        F.count(F.lit(1)).alias("daily_trips"),
        F.avg(duration).alias("avg_duration"),
        F.countDistinct(place).alias("active_places"),
        F.max(F.dayofweek(start).isin(1, 7).cast("int")).alias("is_weekend"),
    )
