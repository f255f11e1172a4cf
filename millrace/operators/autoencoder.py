"""An autoencoder with hidden layers, trained where the rows are.

A round is one job: every task starts from the same weights, makes Adam steps over mini-batches of its own rows, and
sends its weights as rows (place, weight * rows); their sums come together map-side first, so what is
shuffled and collected is one number per weight, however many tasks and rows there are.  Before its steps a task measures
the starting weights on its held-out rows; training ends when that has not improved for ``patience`` rounds,
and the best weights are kept.  The rows are stored once in a fixed layout and every task draws from its own seed, so a
lost task repeats its steps.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import materialize

#: Rows for held-out measurement: one in so many, by a hash of the row.
HELD_OUT = 10
#: Rows of a task, about.
TASK_ROWS = 250_000


@dataclass
class Autoencoder:
    cols: list[str]
    means: np.ndarray
    spreads: np.ndarray
    units: list[int]
    activation: str
    weights: np.ndarray
    history: list[float] = field(default_factory=list)

    def layers(self) -> list[tuple[np.ndarray, np.ndarray]]:
        return _layers(self.weights, self.units)


def _layers(flat: np.ndarray, units: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    out, at = [], 0
    for a, b in zip(units[:-1], units[1:]):
        out.append((flat[at : at + a * b].reshape(a, b), flat[at + a * b : at + a * b + b]))
        at += a * b + b
    return out


def _forward(layers: list, x: np.ndarray, activation: str, keep: list[np.ndarray] | None = None) -> list[np.ndarray]:
    """Outputs of all layers, the input first; the last layer is linear.  ``keep``: dropout masks of the hidden ones."""
    out = [x]
    for k, (w, b) in enumerate(layers):
        z = out[-1] @ w + b
        if k < len(layers) - 1:
            z = np.tanh(z) if activation == "tanh" else np.maximum(z, 0.01 * z)
            if keep is not None:
                z = z * keep[k]
        out.append(z)
    return out


def _gradient(flat: np.ndarray, units: Sequence[int], x: np.ndarray, activation: str, keep: list[np.ndarray] | None = None) -> np.ndarray:
    """Slope of the mean squared error by back-propagation."""
    layers = _layers(flat, units)
    out = _forward(layers, x, activation, keep)
    delta, parts = 2 * (out[-1] - x) / x.size, []
    for k in range(len(layers) - 1, -1, -1):
        parts.append(np.r_[(out[k].T @ delta).ravel(), delta.sum(0)])
        if k:
            here = out[k]
            delta = delta @ layers[k][0].T
            if keep is not None:
                delta = delta * keep[k - 1]
                here = np.divide(here, keep[k - 1], out=np.zeros_like(here), where=keep[k - 1] > 0)
            delta = delta * (1 - here**2 if activation == "tanh" else np.where(here > 0, 1.0, 0.01))
    return np.concatenate(parts[::-1])


def _start(units: Sequence[int], seed: int) -> np.ndarray:
    rng, parts = np.random.default_rng(seed), []
    for a, b in zip(units[:-1], units[1:]):
        parts += [rng.normal(size=a * b) * np.sqrt(2 / (a + b)), np.zeros(b)]
    return np.concatenate(parts)


def _standardised(df: DataFrame, cols: Sequence[str], means: np.ndarray, spreads: np.ndarray):
    """The columns as an array of standard scores; a missing value counts as the mean."""
    return F.array(*[
        F.coalesce((F.col(c).cast("double") - float(m)) / float(s), F.lit(0.0)) for c, m, s in zip(cols, means, spreads)])


def train_autoencoder(
    df: DataFrame,
    cols: Sequence[str],
    hidden: Sequence[int] = (10, 4, 2, 4, 10),
    activation: str = "tanh",
    rounds: int = 40,
    epochs: int = 1,
    batch: int = 256,
    rate: float = 0.01,
    dropout: float = 0.0,
    patience: int = 5,
    seed: int = 7,
) -> Autoencoder:
    """Fit ``cols`` through layers of ``hidden`` units back to themselves.

    Values are standardised; NULL counts as the mean, a column without spread as zero.  ``activation`` is ``tanh`` or
    ``relu`` (leaky).  Rows that differ only by their order give the same layout.  No rows end with an error.
    """
    if activation not in ("tanh", "relu"):
        raise ValueError(f"no activation {activation}")
    spark, d = df.sparkSession, len(cols)
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{n}{k}") for k, c in enumerate(cols) for n, f in (("m", F.avg), ("s", F.stddev_pop))],
                 F.count(F.lit(1)).alias("n")).first()
    if not row["n"]:
        raise ValueError("no rows to train on")
    # Rounded, so that the order of summation can't move a row to another place.
    means = np.array([float(f"{row[f'm{k}'] or 0.0:.9g}") for k in range(d)])
    spreads = np.array([float(f"{row[f's{k}'] or 0.0:.9g}") or 1.0 for k in range(d)])
    units = [d, *hidden, d]
    x = _standardised(df, cols, means, spreads)
    rows = df.select(x.alias("x")).withColumn("h", F.xxhash64("x"))
    rows = materialize(rows.repartition(max(1, -(-row["n"] // TASK_ROWS)), F.col("h")).sortWithinPartitions("h", "x"))
    weights, best = _start(units, seed), (np.inf, None)
    history: list[float] = []

    for number in range(rounds + 1):
        shared = spark.sparkContext.broadcast(weights)

        def steps(batches: Iterator[pd.DataFrame], number: int = number, shared=shared) -> Iterator[pd.DataFrame]:
            # Numbers alone are kept of a batch; its rows as objects take several times the place.
            parts = [(np.vstack(p["x"].to_numpy()), p["h"].to_numpy() % HELD_OUT == 0) for p in batches if len(p)]
            if not parts:
                return
            flat = shared.value.copy()
            x, held = np.vstack([v for v, _ in parts]), np.concatenate([h for _, h in parts])
            parts.clear()
            loss = float(np.mean((_forward(_layers(flat, units), x[held], activation)[-1] - x[held]) ** 2, axis=1).sum()) if held.any() else 0.0
            x = x[~held]
            rng = np.random.default_rng([seed, number, TaskContext.get().partitionId()])
            first, second, step = np.zeros_like(flat), np.zeros_like(flat), 0
            for _ in range(epochs if number < rounds else 0):
                order = rng.permutation(len(x))
                for at in range(0, len(x), batch):
                    part = x[order[at : at + batch]]
                    keep = [(rng.random((len(part), u)) >= dropout) / (1 - dropout) for u in hidden] if dropout else None
                    slope = _gradient(flat, units, part, activation, keep)
                    step += 1
                    first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope**2
                    flat -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            values = np.r_[flat * len(x), len(x), loss, held.sum()]
            yield pd.DataFrame({"place": np.arange(len(values)), "value": values})

        summed = rows.mapInPandas(steps, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
        sums = np.zeros(len(weights) + 3)
        for r in summed.collect():  # a number per weight
            sums[r["place"]] = r["value"]
        shared.unpersist()
        n, loss, held = sums[-3:]
        if held:
            history.append(float(loss / held))
            if history[-1] < best[0] - 1e-9:
                best = (history[-1], weights, number)
            elif number - best[2] >= patience:
                break
        else:
            best = (0.0, sums[:-3] / n if n else weights, number)
        if number < rounds and n:
            weights = sums[:-3] / n
            rate *= 0.97
    return Autoencoder(list(cols), means, spreads, units, activation, best[1], history)


def reconstruct(model: Autoencoder, df: DataFrame) -> DataFrame:
    """``df`` with ``reconstruction_error``: the mean squared error of each standardised row."""
    units, flat, activation = model.units, model.weights, model.activation

    @F.pandas_udf("double")
    def error(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        layers = _layers(flat, units)
        for v in batches:
            x = np.vstack(v.to_numpy()) if len(v) else np.zeros((0, units[0]))
            yield pd.Series(np.mean((_forward(layers, x, activation)[-1] - x) ** 2, axis=1))

    return df.withColumn("reconstruction_error", error(_standardised(df, model.cols, model.means, model.spreads)))
