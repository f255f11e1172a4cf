"""Semantic metrics: measures over a time dimension, simple and ratio metrics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """An aggregate of one column; ``agg`` is ``sum``, ``count`` or ``count_distinct``."""

    agg: str
    expr: str

    def column(self) -> Column:
        made = {"sum": F.sum, "count": F.count, "count_distinct": F.countDistinct}
        return made[self.agg](self.expr)


@dataclass(frozen=True)
class Simple:
    measure: str


@dataclass(frozen=True)
class Ratio:
    numerator: str
    denominator: str


@dataclass(frozen=True)
class SemanticModel:
    """A fact table with its time dimension, measures and metrics."""

    facts: DataFrame
    time: str
    measures: dict[str, Measure]
    metrics: dict[str, Simple | Ratio]
    dimensions: Sequence[str] = field(default_factory=tuple)


def orders_model(fct: DataFrame) -> SemanticModel:
    """One row per order line; orders counted by distinct id."""
    return SemanticModel(
        facts=fct,
        time="created_at",
        measures={
            "order_count": Measure("count_distinct", "order_id"),
            "total_amount_sum": Measure("sum", "total_amount"),
        },
        metrics={
            "total_revenue": Simple("total_amount_sum"),
            "total_orders": Simple("order_count"),
            "avg_order_value": Ratio("total_revenue", "total_orders"),
        },
        dimensions=("customer_id", "product_id"),
    )


def metric_query(
    model: SemanticModel,
    metrics: Sequence[str],
    grain: str = "day",
    dims: Sequence[str] = (),
    spine: DataFrame | None = None,
) -> DataFrame:
    """Metrics per period (``metric_time``) and dimension.

    With a spine every period of the spine appears, with NULL metrics where there
    are no facts (only without further dimensions).
    """
    unknown = set(dims) - set(model.dimensions)
    if unknown:
        raise ValueError(f"not a dimension: {sorted(unknown)}")
    if spine is not None and dims:
        raise ValueError("a spine fills periods, not combinations with other dimensions")

    def base(name: str) -> set[str]:
        m = model.metrics[name]
        return {m.measure} if isinstance(m, Simple) else base(m.numerator) | base(m.denominator)

    needed = sorted(set().union(*[base(m) for m in metrics]))
    period = F.to_date(F.date_trunc(grain, F.col(model.time)))
    grouped = model.facts.groupBy(period.alias("metric_time"), *dims).agg(
        *[model.measures[m].column().alias(f"_{m}") for m in needed]
    )
    if spine is not None:
        periods = spine.select(F.to_date(F.date_trunc(grain, "date_day")).alias("metric_time")).distinct()
        grouped = periods.join(grouped, "metric_time", "left")

    def value(name: str) -> Column:
        m = model.metrics[name]
        if isinstance(m, Simple):
            return F.col(f"_{m.measure}")
        return F.try_divide(value(m.numerator).cast("double"), value(m.denominator).cast("double"))

    return grouped.select("metric_time", *dims, *[value(m).alias(m) for m in metrics])
