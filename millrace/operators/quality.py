"""Data-quality checks.  Each returns the rows that break its rule; an empty result passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_positive(col: str) -> Column:
    return F.col(col).isNull() | (F.col(col) <= 0)


def blank(col: str) -> Column:
    return F.col(col).isNull() | (F.trim(F.col(col)) == "")


def check_positive(df: DataFrame, col: str) -> DataFrame:
    return df.where(not_positive(col))


def check_not_blank(df: DataFrame, col: str) -> DataFrame:
    return df.where(blank(col))


def check_fk(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows without a parent (a NULL key has no parent)."""
    keys = parent.select(F.col(parent_key).alias("_pk"))
    return child.join(keys, F.col(child_key) == F.col("_pk"), "left_anti")


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def split(df: DataFrame, rule: Column) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) by one rule; a rule that is NULL counts as broken, so no row is lost."""
    ok = F.coalesce(rule, F.lit(False))
    return df.where(ok), df.where(~ok)


def order_rule() -> Column:
    """What a live order needs to be accepted."""
    present = [F.col(c).isNotNull() for c in
               ("id", "customer_id", "product_id", "quantity", "total_amount", "currency", "created_at_ts")]
    return reduce(lambda a, b: a & b, present, (F.col("quantity") > 0) & (F.col("currency") != ""))


def count_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """(check, violations) for many row rules in one pass over ``df``."""
    counts = df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])
    pairs = [F.struct(F.lit(n).alias("check"), F.col(n).alias("violations")) for n in rules]
    return counts.select(F.inline(F.array(*pairs)))


def orphan_rules(df: DataFrame, parents: Mapping[str, tuple[DataFrame, str, str]]) -> tuple[DataFrame, dict[str, Column]]:
    """``df`` with a flag for every parent key it lacks, and the flags as rules for ``count_violations``.

    ``parents``: check name to (parent, child key, parent key).  Each parent is joined once, by its distinct
    keys, and all rules are counted in one pass over ``df``.
    """
    out, rules = df, {}
    for name, (parent, child_key, parent_key) in parents.items():
        keys = parent.select(F.col(parent_key).alias(f"_{name}_key")).distinct().withColumn(f"_{name}", F.lit(True))
        out = out.join(keys, F.col(child_key) == F.col(f"_{name}_key"), "left")
        rules[name] = F.col(f"_{name}").isNull()
    return out, rules


def run_suite(parts: Sequence[DataFrame]) -> DataFrame:
    """Combine (check, violations) tables and add whether each check passed."""
    every = reduce(lambda a, b: a.unionByName(b), parts)
    return every.withColumn("passed", F.col("violations") == 0)


def violations(name: str, broken: DataFrame) -> DataFrame:
    """(check, violations) of one check's broken rows."""
    return broken.agg(F.lit(name).alias("check"), F.count(F.lit(1)).alias("violations"))
