"""Forecasts of daily series: an autoregressive fit per series, and trend plus weekday in plain aggregates."""

from __future__ import annotations

from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FORECAST_SCHEMA = (
    "forecast_timestamp date, forecast_value double, standard_error double, confidence_level double, "
    "prediction_interval_lower_bound double, prediction_interval_upper_bound double"
)


def _fit_and_extend(y: np.ndarray, horizon: int, season: int, max_lag: int) -> tuple[np.ndarray, np.ndarray]:
    """Forecast and standard errors of one series.

    Trend and season means are removed by least squares, the rest follows an
    autoregression whose order (0 .. max_lag) has the lowest corrected AIC.
    """
    n = len(y)
    t = np.arange(n + horizon)
    seasonal = season > 1 and n >= 2 * season
    design = [np.ones(n + horizon), t / max(n, 1)]
    if seasonal:
        design += [(t % season == s).astype(float) for s in range(1, season)]
    x = np.column_stack(design)
    beta, *_ = np.linalg.lstsq(x[:n], y, rcond=None)
    level = x @ beta
    rest = y - level[:n]

    best = (np.inf, np.zeros(0), float(np.mean(rest**2)))
    top = min(max_lag, max(0, n // 4 - 1))
    target = rest[top:]
    for p in range(top + 1):
        if p:
            lags = np.column_stack([rest[top - i:n - i] for i in range(1, p + 1)])
            phi, *_ = np.linalg.lstsq(lags, target, rcond=None)
            error = target - lags @ phi
        else:
            phi, error = np.zeros(0), target
        m, params = len(target), p + 1
        sigma2 = float(np.mean(error**2)) if m else 0.0
        if m - params - 1 <= 0:
            continue
        aicc = m * np.log(max(sigma2, 1e-12)) + 2 * params + 2 * params * (params + 1) / (m - params - 1)
        if aicc < best[0] - 1e-9:
            best = (aicc, phi, sigma2)
    _, phi, sigma2 = best
    history = list(rest)
    for _ in range(horizon):
        history.append(float(sum(c * history[-i] for i, c in enumerate(phi, 1))))
    # Variance grows with the squared weights of past shocks.
    psi = [1.0]
    for h in range(1, horizon):
        psi.append(float(sum(c * psi[h - i] for i, c in enumerate(phi, 1) if h - i >= 0)))
    errors = np.sqrt(sigma2 * np.cumsum(np.square(psi[:horizon])))
    return level[n:] + np.array(history[n:]), errors


def forecast_ar(
    daily: DataFrame, series: str, ts: str, value: str, horizon: int = 30, level: float = 0.95,
    season: int = 7, max_lag: int = 7,
) -> DataFrame:
    """One fit per series, series in parallel.  Input: one row per series and day.

    Missing days are filled along a straight line.
    """
    z = NormalDist().inv_cdf(0.5 + level / 2)
    data = daily.where(F.col(value).isNotNull()).select(
        F.col(series).alias("series"), F.to_date(ts).alias("ds"), F.col(value).cast("double").alias("y")
    )
    kind = data.schema["series"].dataType.simpleString()

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        days = pdf.assign(ds=pd.to_datetime(pdf["ds"])).set_index("ds")["y"].sort_index()
        y = days.asfreq("D").interpolate()
        ahead, error = _fit_and_extend(y.to_numpy(), horizon, season, max_lag)
        dates = pd.date_range(y.index[-1] + pd.Timedelta(days=1), periods=horizon, freq="D")
        return pd.DataFrame({
            "series": pdf["series"].iloc[0],
            "forecast_timestamp": dates.date,
            "forecast_value": ahead,
            "standard_error": error,
            "confidence_level": level,
            "prediction_interval_lower_bound": ahead - z * error,
            "prediction_interval_upper_bound": ahead + z * error,
        })

    return data.groupBy("series").applyInPandas(fit, f"series {kind}, {FORECAST_SCHEMA}").withColumnRenamed(
        "series", series
    )


def forecast_trend_weekday(
    daily: DataFrame, series: str, ts: str, value: str, horizon: int = 30, level: float = 0.95
) -> DataFrame:
    """Straight-line trend plus mean weekday deviation per series, in plain aggregates.

    The standard error is the population deviation of what trend and weekday leave over.
    """
    z = NormalDist().inv_cdf(0.5 + level / 2)
    day = F.datediff(F.col("ds"), F.lit("1970-01-01").cast("date")).cast("double")
    data = daily.where(F.col(value).isNotNull()).select(
        F.col(series).alias("series"), F.to_date(ts).alias("ds"), F.col(value).cast("double").alias("y")
    ).withColumn("day", day)
    trend = data.groupBy("series").agg(
        F.coalesce(F.regr_slope("y", "day"), F.lit(0.0)).alias("slope"),
        F.avg("y").alias("my"), F.avg("day").alias("md"), F.max("ds").alias("last_day"),
    )
    line = F.col("my") + F.col("slope") * (F.col("day") - F.col("md"))
    rest = data.join(trend, "series").withColumn("rest", F.col("y") - line).withColumn("dow", F.dayofweek("ds"))
    by_day = rest.groupBy("series", "dow").agg(
        F.avg("rest").alias("shift"), F.count(F.lit(1)).alias("n"), F.var_pop("rest").alias("v")
    )
    noise = by_day.groupBy("series").agg(F.sqrt(F.sum(F.col("n") * F.col("v")) / F.sum("n")).alias("se"))
    steps = F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    future = (
        trend.join(noise, "series")
        .withColumn("step", steps)
        .withColumn("ds", F.date_add("last_day", F.col("step")))
        .withColumn("day", day)
        .withColumn("dow", F.dayofweek("ds"))
    )
    point = line + F.coalesce(F.col("shift"), F.lit(0.0))
    out = future.join(by_day.select("series", "dow", "shift"), ["series", "dow"], "left")
    return out.select(
        F.col("series").alias(series),
        F.col("ds").alias("forecast_timestamp"),
        point.alias("forecast_value"),
        F.col("se").alias("standard_error"),
        F.lit(level).alias("confidence_level"),
        (point - z * F.col("se")).alias("prediction_interval_lower_bound"),
        (point + z * F.col("se")).alias("prediction_interval_upper_bound"),
    )
