"""Evaluation of binary scores: metrics, ROC curve, confusion matrix; skew and drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordering import value_counts
from millrace.operators.stats import one_row


def _scored(df: DataFrame, label: str, score: str) -> DataFrame:
    return df.select(F.col(label).cast("int").alias("y"), F.col(score).cast("double").alias("s")).where(
        F.col("y").isNotNull() & F.col("s").isNotNull()
    )


def _by_score(scored: DataFrame) -> DataFrame:
    """Distinct scores from high to low with running positives and negatives."""
    return value_counts(scored, "s", sums={"pos": F.col("y"), "neg": 1 - F.col("y")}, descending=True)


def eval_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, accuracy, F1, log loss and ROC AUC in one row.

    All come from the counts per distinct score, so the rows are read once.  AUC counts concordant
    pairs, ties as half.
    """
    hit = F.col("s") >= threshold
    p = F.least(F.greatest(F.col("s"), F.lit(1e-15)), F.lit(1 - 1e-15))
    pos, neg = F.col("pos"), F.col("neg")
    base = _by_score(_scored(df, label, score)).agg(
        F.coalesce(F.sum(F.when(hit, pos).otherwise(0)), F.lit(0)).alias("tp"),
        F.coalesce(F.sum(F.when(hit, neg).otherwise(0)), F.lit(0)).alias("fp"),
        F.coalesce(F.sum(F.when(hit, 0).otherwise(pos)), F.lit(0)).alias("fn"),
        F.coalesce(F.sum(F.when(hit, 0).otherwise(neg)), F.lit(0)).alias("tn"),
        F.try_divide(-F.sum(pos * F.log(p) + neg * F.log(1 - p)), F.sum(pos + neg)).alias("log_loss"),
        F.try_divide(
            F.sum((F.col("pos_before") + pos / 2) * neg), F.max("pos_total").cast("double") * F.max("neg_total"),
        ).alias("auc"),
    )
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    precision, recall = F.try_divide(tp, tp + fp), F.try_divide(tp, tp + fn)
    return base.select(
        precision.alias("precision"),
        recall.alias("recall"),
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        "log_loss",
        F.col("auc").alias("roc_auc"),
    )


def roc_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct score: rates and counts when it is used as threshold."""
    steps = _by_score(_scored(df, label, score))
    tp, fp = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    return steps.select(
        F.col("s").alias("threshold"),
        F.try_divide(tp.cast("double"), F.col("pos_total")).alias("recall"),
        F.try_divide(fp.cast("double"), F.col("neg_total")).alias("false_positive_rate"),
        tp.alias("true_positives"),
        fp.alias("false_positives"),
        (F.col("neg_total") - fp).alias("true_negatives"),
        (F.col("pos_total") - tp).alias("false_negatives"),
    )


def confusion_matrix(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Rows per (expected, predicted) pair that occurs."""
    return df.groupBy(F.col(label).alias("expected_label"), F.col(predicted).alias("predicted_label")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def distribution_shift(
    base: DataFrame,
    study: DataFrame,
    cat_cols: Sequence[str] = (),
    num_cols: Sequence[str] = (),
    cat_threshold: float = 0.2,
    num_threshold: float = 0.3,
    bins: int = 10,
) -> DataFrame:
    """Distance between two samples per feature, with an anomaly flag.

    Categorical features: largest difference of a value's share (L-infinity).
    Numeric features: Jensen-Shannon divergence (base 2) over equal-width bins
    between the joint minimum and maximum.  All features go through one group-by.
    """
    cols = [*cat_cols, *num_cols]
    both = base.select(F.lit(1).alias("_b"), *cols).unionByName(study.select(F.lit(0).alias("_b"), *cols))
    ranges = [F.min(c).cast("double").alias(f"{c}_lo") for c in num_cols] + [
        F.max(c).cast("double").alias(f"{c}_hi") for c in num_cols
    ]
    limits = one_row(both.agg(*ranges)) if num_cols else None

    def bin_of(c: str) -> Column:
        lo, width = limits[f"{c}_lo"], (limits[f"{c}_hi"] - limits[f"{c}_lo"]) / bins
        step = F.floor(F.try_divide(F.col(c) - lo, width)).cast("int")
        # A column with one value only has bin 0, a missing value stays missing.
        return F.when(F.col(c).isNull(), None).otherwise(F.coalesce(F.least(step, F.lit(bins - 1)), F.lit(0)))

    cells = [
        F.struct(F.lit(c).alias("feature"), F.lit("categorical").alias("kind"), F.col(c).cast("string").alias("value"))
        for c in cat_cols
    ] + [
        F.struct(F.lit(c).alias("feature"), F.lit("numeric").alias("kind"), bin_of(c).cast("string").alias("value"))
        for c in num_cols
    ]
    counts = (
        both.select("_b", F.explode(F.array(*cells)).alias("c"))
        .select("_b", "c.*")
        .where(F.col("value").isNotNull())
        .groupBy("feature", "kind", "value")
        .agg(F.sum("_b").alias("nb"), F.sum(1 - F.col("_b")).alias("ns"))
    )
    totals = counts.groupBy("feature").agg(F.sum("nb").alias("tb"), F.sum("ns").alias("ts"))
    shares = counts.join(F.broadcast(totals), "feature").select(  # one row per feature
        "feature", "kind",
        F.coalesce(F.try_divide(F.col("nb"), F.col("tb")), F.lit(0.0)).alias("p"),
        F.coalesce(F.try_divide(F.col("ns"), F.col("ts")), F.lit(0.0)).alias("q"),
    )
    mid = (F.col("p") + F.col("q")) / 2

    def part(x: str) -> Column:
        return F.when(F.col(x) > 0, F.col(x) * F.log2(F.col(x) / mid)).otherwise(F.lit(0.0))

    value = F.when(F.col("kind") == "categorical", F.col("linf")).otherwise(F.col("jsd"))
    limit = F.when(F.col("kind") == "categorical", F.lit(cat_threshold)).otherwise(F.lit(num_threshold))
    return (
        shares.groupBy("feature", "kind")
        .agg(F.max(F.abs(F.col("p") - F.col("q"))).alias("linf"), (F.sum(part("p") + part("q")) / 2).alias("jsd"))
        .select(
            "feature",
            F.when(F.col("kind") == "categorical", "l_infinity").otherwise("jensen_shannon").alias("metric"),
            limit.alias("threshold"),
            value.alias("value"),
            (value > limit).alias("is_anomaly"),
        )
    )
