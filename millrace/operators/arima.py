"""Automatic seasonal ARIMA models, one per series, series in parallel.

Each daily series is short, so a task fits it whole:

* the number of differences by KPSS tests of level stationarity, a seasonal one if the seasonal part of a
  classical decomposition is strong;
* (1 - phi B ...)(1 - Phi B^s ...) w = (1 + theta B ...)(1 + Theta B^s ...) e by conditional sum of squares, with zeros
  before the series, minimised by Levenberg-Marquardt steps that keep both polynomials' roots outside the unit
  circle;
* orders by a stepwise search for the lowest corrected AIC: neighbours of the best model until none is better.

Residuals are one convolution with the power series of the inverse moving-average polynomial, so a fit needs no
loop over days.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.forecast import FORECAST_SCHEMA

# 5 % point of the KPSS level test, seasonal strength that calls for a difference, least modulus of a root.
KPSS_LIMIT, STRONG_SEASON, LEAST_ROOT = 0.463, 0.64, 1.001
ARIMA_SCHEMA = f"{FORECAST_SCHEMA}, model string, sigma2 double, aicc double"


def kpss(y: np.ndarray) -> float:
    """The statistic of the test for level stationarity, with a Bartlett window of 4 (n / 100)^(1/4) lags."""
    n = len(y)
    e = y - y.mean()
    lags = int(4 * (n / 100) ** 0.25)
    spread = float(e @ e) / n
    for k in range(1, lags + 1):
        spread += 2 * (1 - k / (lags + 1)) * float(e[k:] @ e[:-k]) / n
    return float(np.sum(np.cumsum(e) ** 2)) / (n * n * spread) if spread > 1e-12 else 0.0


def season_strength(y: np.ndarray, season: int) -> float:
    """1 - variance left over / variance of seasonal part and what is left over, after a moving average; 0 at least."""
    weights = np.ones(season) if season % 2 else np.r_[0.5, np.ones(season - 1), 0.5]
    half = len(weights) // 2
    rest = y[half : len(y) - half] - np.convolve(y, weights / weights.sum(), "valid")
    place = (np.arange(len(rest)) + half) % season
    means = np.array([rest[place == k].mean() for k in range(season)])
    left = rest - means[place]
    total = float(np.var(rest))
    return max(0.0, 1 - float(np.var(left)) / total) if total > 1e-12 else 0.0


def differences(y: np.ndarray, season: int, most: int = 2) -> tuple[int, int]:
    """How many plain and seasonal differences make the series level-stationary."""
    seasonal = int(season > 1 and len(y) >= 3 * season and season_strength(y, season) > STRONG_SEASON)
    w = _differenced(y, 0, seasonal, season)
    plain = 0
    while plain < most and len(w) > 10 and kpss(w) > KPSS_LIMIT:
        w, plain = np.diff(w), plain + 1
    return plain, seasonal


def _differenced(y: np.ndarray, plain: int, seasonal: int, season: int) -> np.ndarray:
    for _ in range(seasonal):
        y = y[season:] - y[:-season]
    return np.diff(y, plain) if plain else y


@dataclass(frozen=True)
class Orders:
    p: int
    q: int
    P: int
    Q: int
    constant: bool

    @property
    def size(self) -> int:
        return self.p + self.q + self.P + self.Q + self.constant


@dataclass
class Fit:
    orders: Orders
    params: np.ndarray
    sse: float
    n: int
    residuals: np.ndarray = field(repr=False)

    @property
    def sigma2(self) -> float:
        return self.sse / max(self.n - self.orders.size, 1)

    @property
    def aicc(self) -> float:
        k = self.orders.size + 1
        if self.n - k - 1 <= 0:
            return np.inf
        return self.n * np.log(max(self.sse / self.n, 1e-12)) + 2 * k + 2 * k * (k + 1) / (self.n - k - 1)


def _polynomials(orders: Orders, params: np.ndarray, season: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Autoregressive and moving-average polynomial in B, and the mean."""
    cuts = np.cumsum([orders.p, orders.q, orders.P, orders.Q])
    phi, theta, big_phi, big_theta, rest = np.split(params, cuts)

    def spread(values: np.ndarray, sign: int) -> np.ndarray:
        out = np.zeros(len(values) * season + 1)
        out[0] = 1
        out[season::season] = sign * values
        return out

    ar = np.convolve(np.r_[1, -phi], spread(big_phi, -1) if orders.P else [1.0])
    ma = np.convolve(np.r_[1, theta], spread(big_theta, 1) if orders.Q else [1.0])
    return ar, ma, float(rest[0]) if orders.constant else 0.0


def _steady(polynomial: np.ndarray) -> bool:
    """All roots outside the unit circle (those of 1 + c1 B + c2 B^2 + ...)."""
    trimmed = np.trim_zeros(polynomial, "b")
    return len(trimmed) < 2 or bool(np.abs(np.roots(trimmed[::-1])).min() > LEAST_ROOT)


def _product(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The first n terms of the product of two power series."""
    if min(len(a), len(b)) <= 64:
        return np.convolve(a, b)[:n]
    size = 1 << (len(a) + len(b) - 1).bit_length()
    return np.fft.irfft(np.fft.rfft(a, size) * np.fft.rfft(b, size), size)[: len(a) + len(b) - 1][:n]


def _inverse(ma: np.ndarray, n: int) -> np.ndarray:
    """The first n terms of the power series of 1 / ma, cut off where they have died out.

    Newton's iteration doubles the number of right terms.
    """
    out, right = np.ones(1), 1
    while right < n:
        right = min(2 * right, n)
        rest = -_product(ma[:right], out, right)
        rest[0] += 2
        more = _product(out, rest, right)
        if right > 2 * len(ma) and np.abs(more[right // 2 :]).max(initial=0) < 1e-13:
            return more[: right // 2]
        out = np.r_[more, np.zeros(right - len(more))]
    return out


def residuals(w: np.ndarray, orders: Orders, params: np.ndarray, season: int) -> np.ndarray | None:
    """One-step errors with zeros before the series; None for parameters without a steady model."""
    ar, ma, mean = _polynomials(orders, params, season)
    if not (_steady(ar) and _steady(ma)):
        return None
    filtered = np.convolve(w - mean, ar)[: len(w)]
    if len(ma) == 1:
        return filtered
    return _product(filtered, _inverse(ma, len(w)), len(w))


def fit_css(w: np.ndarray, orders: Orders, season: int, steps: int = 40) -> Fit:
    """The parameters with the least sum of squared errors, from zero and the series' mean."""
    params = np.zeros(orders.size)
    if orders.constant:
        params[-1] = w.mean()
    e = residuals(w, orders, params, season)
    sse, damping = float(e @ e), 1e-3
    for _ in range(steps if orders.size else 0):
        slopes = np.empty((len(w), orders.size))
        for k in range(orders.size):
            h = 1e-6 * max(1.0, abs(params[k]))
            moved = params.copy()
            moved[k] += h
            other = residuals(w, orders, moved, season)
            if other is None:
                moved[k] -= 2 * h
                other, h = residuals(w, orders, moved, season), -h
            slopes[:, k] = (other - e) / h if other is not None else 0.0
        square, pull = slopes.T @ slopes, slopes.T @ e
        gained = 0.0
        for _ in range(12):
            step = np.linalg.lstsq(square + damping * np.diag(np.diag(square) + 1e-12), -pull, rcond=None)[0]
            tried = residuals(w, orders, params + step, season)
            if tried is not None and float(tried @ tried) < sse:
                gained = sse - float(tried @ tried)
                params, e, sse, damping = params + step, tried, float(tried @ tried), damping / 5
                break
            damping *= 4
        if gained <= 1e-9 * max(sse, 1e-12):
            break
    return Fit(orders, params, sse, len(w), e)


def search(
    w: np.ndarray, season: int, constant: bool, most: tuple[int, int] = (5, 2), fits: dict[Orders, Fit] | None = None,
) -> Fit:
    """The model no neighbour of which (an order one up or down, or both of a pair) has a lower corrected AIC."""
    fits = {} if fits is None else fits
    short, long = most
    if season <= 1 or len(w) < 3 * season:
        long = 0
    short = min(short, max(0, len(w) // 4 - 1))

    def at(p: int, q: int, P: int, Q: int, c: bool) -> Fit | None:
        if not (0 <= p <= short and 0 <= q <= short and 0 <= P <= long and 0 <= Q <= long) or (c and not constant):
            return None
        orders = Orders(p, q, P, Q, c)
        if orders not in fits:
            fits[orders] = fit_css(w, orders, season)
        return fits[orders]

    s = min(long, 1)
    first = [(0, 0, 0, 0), (min(2, short), min(2, short), s, s), (min(1, short), 0, s, 0), (0, min(1, short), 0, s)]
    best = min((at(*o, constant) for o in first), key=lambda m: m.aicc)
    while True:
        o = best.orders
        moves = [(dp, dq, 0, 0) for dp in (-1, 0, 1) for dq in (-1, 0, 1) if dp or dq]
        moves += [(0, 0, dP, dQ) for dP in (-1, 0, 1) for dQ in (-1, 0, 1) if dP or dQ]
        near = [at(o.p + a, o.q + b, o.P + c, o.Q + d, o.constant) for a, b, c, d in moves]
        near.append(at(o.p, o.q, o.P, o.Q, not o.constant))
        better = min((m for m in near if m is not None), key=lambda m: m.aicc, default=best)
        if better.aicc >= best.aicc - 1e-9:
            return best
        best = better


def extend(y: np.ndarray, fit: Fit, plain: int, seasonal: int, season: int, horizon: int) -> tuple[np.ndarray, np.ndarray]:
    """Forecasts and standard errors on the scale of ``y``."""
    ar, ma, mean = _polynomials(fit.orders, fit.params, season)
    whole = ar
    for _ in range(plain):
        whole = np.convolve(whole, [1.0, -1.0])
    for _ in range(seasonal):
        whole = np.convolve(whole, np.r_[1.0, np.zeros(season - 1), -1.0])
    drift = mean * float(ar.sum())
    past, errors = list(y), list(np.r_[np.zeros(len(y) - len(fit.residuals)), fit.residuals])
    for _ in range(horizon):
        back = sum(-c * past[-k] for k, c in enumerate(whole[1:], 1) if k <= len(past))
        shocks = sum(c * errors[-k] for k, c in enumerate(ma[1:], 1) if k <= len(errors))
        past.append(back + shocks + drift)
        errors.append(0.0)
    psi = np.zeros(horizon)
    for h in range(horizon):
        psi[h] = (ma[h] if h < len(ma) else 0.0) - sum(whole[k] * psi[h - k] for k in range(1, min(h, len(whole) - 1) + 1))
    return np.array(past[len(y) :]), np.sqrt(fit.sigma2 * np.cumsum(psi**2))


def auto_arima(y: np.ndarray, season: int = 7) -> tuple[Fit, int, int]:
    """The chosen fit, its plain and its seasonal differences."""
    plain, seasonal = differences(y, season) if len(y) > 10 else (0, 0)
    w = _differenced(y, plain, seasonal, season)
    return search(w, season, constant=plain + seasonal <= 1), plain, seasonal


def forecast_arima(
    daily: DataFrame, series: str, ts: str, value: str, horizon: int = 30, level: float = 0.95, season: int = 7,
) -> DataFrame:
    """Forecasts of every series with its model, residual variance and corrected AIC.

    Input: one row per series and day; missing days are filled along a straight line, rows without a value are left
    out.  A constant or very short series has its mean ahead.
    """
    z = NormalDist().inv_cdf(0.5 + level / 2)
    data = daily.where(F.col(value).isNotNull()).select(
        F.col(series).alias("series"), F.to_date(ts).alias("ds"), F.col(value).cast("double").alias("y"))
    kind = data.schema["series"].dataType.simpleString()

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        days = pdf.assign(ds=pd.to_datetime(pdf["ds"])).set_index("ds")["y"].sort_index()
        y = days.asfreq("D").interpolate().to_numpy()
        found, plain, seasonal = auto_arima(y, season)
        ahead, error = extend(y, found, plain, seasonal, season, horizon)
        o = found.orders
        name = f"({o.p},{plain},{o.q})({o.P},{seasonal},{o.Q})[{season}]" + (" with constant" if o.constant else "")
        dates = pd.date_range(days.index[-1] + pd.Timedelta(days=1), periods=horizon, freq="D")
        return pd.DataFrame({
            "series": pdf["series"].iloc[0], "forecast_timestamp": dates.date, "forecast_value": ahead, "standard_error": error,
            "confidence_level": level, "prediction_interval_lower_bound": ahead - z * error,
            "prediction_interval_upper_bound": ahead + z * error, "model": name, "sigma2": found.sigma2, "aicc": found.aicc})

    return data.groupBy("series").applyInPandas(fit, f"series {kind}, {ARIMA_SCHEMA}").withColumnRenamed("series", series)
