"""Automatic ARIMA beside direct recursions, grids and exhaustive searches."""

import datetime as dt
from itertools import product

import numpy as np
import pytest

import __spark_entry__ as entry_point
from millrace.operators import arima
from millrace.operators.arima import Orders


def simulate(n, ar=(), ma=(), season=7, big_ar=(), big_ma=(), mean=0.0, seed=1, burn=300):
    rng = np.random.default_rng(seed)
    e = rng.normal(size=n + burn)
    a, b, _ = arima._polynomials(Orders(len(ar), len(ma), len(big_ar), len(big_ma), False), np.array([*ar, *ma, *big_ar, *big_ma]), season)
    w = np.zeros(n + burn)
    for t in range(n + burn):
        w[t] = sum(b[k] * e[t - k] for k in range(len(b)) if t >= k) - sum(a[k] * w[t - k] for k in range(1, len(a)) if t >= k)
    return w[burn:] + mean


def recursion(w, orders, params, season):
    """Errors day by day."""
    a, b, mean = arima._polynomials(orders, params, season)
    x, e = w - mean, np.zeros(len(w))
    for t in range(len(w)):
        e[t] = sum(a[k] * x[t - k] for k in range(len(a)) if t >= k) - sum(b[k] * e[t - k] for k in range(1, len(b)) if t >= k)
    return e


@pytest.mark.parametrize("orders,params", [
    (Orders(2, 1, 0, 0, True), [0.5, -0.3, 0.6, 2.0]), (Orders(0, 2, 1, 1, False), [0.4, 0.2, 0.5, -0.7]), (Orders(1, 0, 0, 2, True), [0.9, 0.3, 0.2, 1.0]),
])
def test_errors_against_the_recursion(orders, params):
    w = simulate(150, ar=(0.6,), ma=(0.3,), mean=2)
    assert np.allclose(arima.residuals(w, orders, np.array(params), 7), recursion(w, orders, np.array(params), 7), atol=1e-9)


def test_fit_against_a_grid():
    w = simulate(200, ar=(0.7,), ma=(0.4,), seed=3)
    fit = arima.fit_css(w, Orders(1, 1, 0, 0, False), 7)
    grid = min(((float(np.sum(recursion(w, fit.orders, np.array(x), 7) ** 2)), x) for x in product(np.arange(-0.95, 0.96, 0.05), repeat=2)))
    assert fit.sse <= grid[0] + 1e-9
    fine = min(((float(np.sum(recursion(w, fit.orders, fit.params + x, 7) ** 2)), x) for x in product((-0.01, 0.0, 0.01), repeat=2)))
    assert fine[1] == (0.0, 0.0)
    assert abs(fit.params[0] - 0.7) < 0.15 and abs(fit.params[1] - 0.4) < 0.2


def test_search_against_all_orders():
    w = simulate(160, ar=(0.6,), big_ma=(0.5,), season=4, seed=5)
    best = arima.search(w, 4, constant=False, most=(2, 1))
    every = [arima.fit_css(w, Orders(p, q, P, Q, False), 4) for p, q, P, Q in product(range(3), range(3), range(2), range(2))]
    least = min(m.aicc for m in every)
    assert best.aicc <= least + 2 and best.orders.P + best.orders.Q >= 1


def test_differences():
    walk = np.cumsum(simulate(400, seed=2))
    assert arima.differences(walk, 1)[0] == 1
    assert arima.differences(simulate(400, ar=(0.3,), seed=4), 7) == (0, 0)
    weekly = simulate(210, seed=6) * 0.3 + np.tile([5, 1, 0, 2, 8, 9, 3], 30)
    assert arima.differences(weekly, 7) == (0, 1)


def test_forecasts_of_known_models():
    """A random walk stays, a weekly pattern repeats, a drift goes on, and intervals widen as they should."""
    walk = np.cumsum(simulate(300, seed=2))
    fit = arima.fit_css(np.diff(walk), Orders(0, 0, 0, 0, False), 7)
    ahead, error = arima.extend(walk, fit, 1, 0, 7, 10)
    assert np.allclose(ahead, walk[-1]) and np.allclose(error, np.sqrt(fit.sigma2 * np.arange(1, 11)))
    week = np.tile([5.0, 1, 0, 2, 8, 9, 3], 10)
    fit = arima.fit_css(np.zeros(63), Orders(0, 0, 0, 0, False), 7)
    assert np.allclose(arima.extend(week, fit, 0, 1, 7, 14)[0], week[:14])
    line = 3 + 2.0 * np.arange(100)
    found, plain, seasonal = arima.auto_arima(line, 7)
    assert plain == 1 and np.allclose(arima.extend(line, found, plain, seasonal, 7, 5)[0], 3 + 2.0 * np.arange(100, 105), atol=1e-6)
    ar = simulate(500, ar=(0.8,), mean=10, seed=8)
    fit = arima.fit_css(ar, Orders(1, 0, 0, 0, True), 7)
    ahead, error = arima.extend(ar, fit, 0, 0, 7, 60)
    assert abs(ahead[-1] - fit.params[-1]) < 0.05
    assert np.isclose(error[-1], np.sqrt(fit.sigma2 / (1 - fit.params[0] ** 2)), rtol=1e-3)


def test_odd_series(spark):
    day = dt.date(2024, 1, 1)
    rows = [("flat", day + dt.timedelta(k), 5.0) for k in range(60)] + [("one", day, 2.0)] + [("few", day + dt.timedelta(2 * k), float(k)) for k in range(4)]
    rows += [("null", day, None), (None, day, 1.0), (None, day + dt.timedelta(3), 4.0)]
    df = spark.createDataFrame(rows, "s string, d date, v double")
    out = arima.forecast_arima(df, "s", "d", "v", horizon=5).toPandas()
    assert set(out["s"].fillna("-")) == {"flat", "one", "few", "-"} and len(out) == 20
    assert np.allclose(out[out["s"] == "flat"]["forecast_value"], 5) and np.isfinite(out["forecast_value"]).all()
    assert arima.forecast_arima(df.limit(0), "s", "d", "v").count() == 0


def test_query(spark, data):
    """Thirty rows for every series, each with an error."""
    rows = entry_point.queries()["forecast_arima"](spark, data).toPandas()
    assert (rows.groupby("l_returnflag").size() == 30).all() and (rows["standard_error"] > 0).all()
