"""Quality rules: robust multivariate outliers among documents of one language and source.

Each text becomes a vector of transformed statistics.  Per language and source the minimum
covariance determinant (MCD) estimate of centre and scatter is searched for from several starts by concentration
steps: keep the share ``core`` of the rows nearest to the current estimate, estimate anew from them, until the
determinant stops falling; the start that ends with the least determinant wins.  All rows near its estimate then give
the final one (re-weighting).  A document whose Mahalanobis distance from that is beyond a chi-square quantile is an
outlier.

Steps are grouped aggregations over a narrow stored table: a histogram of distances gives the
cut, sums and cross products give the estimate.  A group with a third of all rows is combined
map-side like any other; no group is ever collected.  Histograms have a fixed number of bins, so
results don't depend on the order of rows.

Sources with fewer than ``least`` rows are pooled by language, and languages whose pool is
still smaller are pooled together.  A last pool below ``least`` has no estimate, and its
documents are held to the plain rules alone.  Variances have floors, since most clean documents
have no symbols or repeats at all and their scatter would be singular.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.llm.common import WordScan, bounded_batches, chunks, joined, release, shape, store, text_bytes, windows

#: Counts of a text, in order.
COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_marks", "n_next_same",
]

#: The vector: name, SQL expression over COUNTS, floor of its deviation.
FEATURES = [
    ("mean_length", "ln(word_chars / n_words)", 0.15),
    ("symbols", "n_symbols / word_chars", 0.01),
    ("dup_lines", "n_dup_lines / greatest(n_lines, 1)", 0.08),
    ("repeats", "n_repeat_words / n_words", 0.06),
    ("upper", "n_upper / word_chars", 0.05),
    ("marks", "n_marks / word_chars", 0.03),
    ("next_same", "n_next_same / n_words", 0.03),
]
WIDTH = 8  # words of a window that counts as repeated
BINS = 4096


class Counter:
    """The counts of many texts at a time."""

    def __init__(self):
        self.scan = WordScan()
        self.symbol, self.upper, self.mark = (np.zeros(256, bool) for _ in range(3))
        self.symbol[[ord(c) for c in "#*$%&|<>"]] = True
        self.upper[65:91] = True
        self.mark[[ord(c) for c in "!?.,;:\"'()-"]] = True
        self.first = np.ones(256, bool)  # not a continuation byte: one per code point
        self.first[0x80:0xC0] = False

    def run(self, texts: list[bytes]) -> np.ndarray:
        """A row of COUNTS for each text."""
        whole, begins = joined(texts)
        raw = np.frombuffer(whole, np.uint8)
        starts, ends = self.scan.words(raw)
        at = np.searchsorted(starts, begins)  # words before each text
        hashes = self.scan.hashes(raw, starts, ends)

        def total(flags: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(flags)])[begins])

        words = np.diff(at)
        owner = np.repeat(np.arange(len(texts)), words)
        dup, lines = self._lines(raw, begins)
        same = np.zeros(len(hashes), np.int64)
        if len(hashes) > 1:
            same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
        return np.stack([
            words, total(self.first[raw] & ~self.scan.separator[raw]), total(self.symbol[raw]), dup,
            self._repeats(hashes, owner, at), lines, total(self.upper[raw]), total(self.mark[raw]),
            np.diff(np.concatenate([[0], np.cumsum(same)])[at]),
        ], 1).astype(np.int64)

    def _lines(self, raw: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text: lines with a word that equal an earlier line; lines with a word."""
        stops = np.flatnonzero(raw == 10)
        starts = np.concatenate([[0], stops[:-1] + 1])
        full = np.concatenate([[0], np.cumsum(~self.scan.separator[raw])])
        kept = full[stops] > full[starts]
        starts, stops = starts[kept], stops[kept]
        n = len(begins) - 1
        owner = np.searchsorted(begins, starts, "right") - 1
        key = np.stack([owner.astype(np.uint64), self.scan.hashes(raw, starts, stops)], 1)
        _, first = np.unique(key, axis=0, return_index=True)
        again = np.ones(len(starts), bool)
        again[first] = False
        return np.bincount(owner[again], minlength=n)[:n], np.bincount(owner, minlength=n)[:n]

    @staticmethod
    def _repeats(hashes: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Per text: words that lie in a window found twice or more in the text."""
        n = len(at) - 1
        if len(hashes) < WIDTH:
            return np.zeros(n, np.int64)
        runs = windows(hashes, WIDTH)
        inside = np.flatnonzero(owner[: len(runs)] == owner[WIDTH - 1 :])
        order = inside[np.lexsort((runs[inside], owner[inside]))]
        equal = (runs[order[1:]] == runs[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
        twice = np.zeros(len(order), bool)
        twice[1:] |= equal
        twice[:-1] |= equal
        cover = np.zeros(len(hashes) + 1, np.int64)
        hit = order[twice]
        np.add.at(cover, hit, 1)
        np.add.at(cover, hit + WIDTH, -1)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
        return np.diff(covered[at])


def measure(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` as a struct ``row``, and COUNTS, for every row; NULL counts as an empty text."""
    rows = bounded_batches(docs).select(text_bytes(text).alias("bytes"), F.struct(*[F.col(c) for c in keep]).alias("row"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter()
        for batch in batches:
            found = [np.zeros((0, len(COUNTS)), np.int64)]
            found += [counter.run(part) for part in chunks(batch.column(0).to_pylist())]
            table = np.concatenate(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), *[pa.array(np.ascontiguousarray(table[:, k])) for k in range(len(COUNTS))]],
                names=["row", *COUNTS])
            release()

    return rows.mapInArrow(task, shape({"row": rows.schema["row"].dataType} | dict.fromkeys(COUNTS, "long")))


def base_failed(least_words: int = 20, repeat_percent: int = 30) -> Column:
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))


def features() -> list[Column]:
    return [F.expr(sql).cast("double").alias(f"x{k}") for k, (_, sql, _) in enumerate(FEATURES)]


def chi_square(level: float, p: int) -> float:
    """Quantile by the Wilson-Hilferty approximation."""
    from statistics import NormalDist

    z = NormalDist().inv_cdf(level)
    return p * (1 - 2 / (9 * p) + z * (2 / (9 * p)) ** 0.5) ** 3


def _distance() -> Column:
    """Squared Mahalanobis distance of x0.. from the columns ``center`` and ``inverse``."""
    p = len(FEATURES)
    diff = [F.col(f"x{k}") - F.col("center")[k] for k in range(p)]
    terms = [diff[i] * diff[j] * F.col("inverse")[i * p + j] * (1 if i == j else 2) for i in range(p) for j in range(i, p)]
    out = terms[0]
    for term in terms[1:]:
        out = out + term
    return F.greatest(out, F.lit(0.0))


def _bin(d2: Column) -> Column:
    """Bin of a squared distance: 64 to a factor of e, BINS in all."""
    return F.least(F.floor(F.log1p(d2) * 64), F.lit(BINS - 1)).cast("int")


def _quantile_bins(counted: DataFrame, keys: Sequence[str], bin_: str, shares: Sequence[float]) -> DataFrame:
    """Per key the first bin below which (and in which) a share of the rows lies; at most BINS rows a key."""
    upto = W.partitionBy(*keys).orderBy(bin_).rowsBetween(W.unboundedPreceding, 0)
    summed = counted.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(W.partitionBy(*keys))})
    return summed.groupBy(*keys).agg(*[
        F.min(F.when(F.col("upto") >= F.col("all") * share, F.col(bin_))).alias(f"q{k}") for k, share in enumerate(shares)
    ])


def assign_groups(rows: DataFrame, least: int) -> DataFrame:
    """Table from (lang, source) to the group that estimates for it: itself or a pool."""
    counts = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    by_lang = W.partitionBy("lang")
    small = F.when(F.col("n") < least, F.col("n")).otherwise(0)
    pooled = counts.groupBy("lang").agg(F.sum(small).alias("pool"))
    joined_ = counts.join(pooled.withColumnRenamed("lang", "pool_lang"), F.col("lang").eqNullSafe(F.col("pool_lang")))
    none = F.lit(None).cast("string")
    group = (
        F.when(F.col("n") >= least, F.struct(F.lit(1).alias("level"), F.col("lang").alias("a"), F.col("source").alias("b")))
        .when(F.col("pool") >= least, F.struct(F.lit(2).alias("level"), F.col("lang").alias("a"), none.alias("b")))
        .otherwise(F.struct(F.lit(3).alias("level"), none.alias("a"), none.alias("b")))
    )
    return joined_.select(
        F.struct("lang", "source").alias("key"), F.to_json(group, {"ignoreNullFields": "false"}).alias("g"))


def _medians(data: DataFrame) -> DataFrame:
    """Per group ``center`` and ``v``: medians and squared quartile deviations, from histograms of 1/20 of each floor."""
    p = len(FEATURES)
    floors = [f for _, _, f in FEATURES]
    cells = data.select("g", F.explode(F.array(*[
        F.struct(F.lit(k).alias("k"), F.floor(F.col(f"x{k}") / F.lit(float(floors[k] / 20))).cast("long").alias("bin"))
        for k in range(p)])).alias("c")).groupBy("g", "c.k", "c.bin").agg(F.count(F.lit(1)).alias("n"))
    quartiles = _quantile_bins(cells, ["g", "k"], "bin", [0.25, 0.5, 0.75])
    step = F.element_at(F.array(*[F.lit(float(f / 20)) for f in floors]), F.col("k") + 1)
    floor = F.element_at(F.array(*[F.lit(float(f)) for f in floors]), F.col("k") + 1)
    sigma = (F.col("q2") - F.col("q0")) * step / 1.349
    wide = quartiles.select(
        "g", "k", ((F.col("q1") + 0.5) * step).alias("m"), (sigma * sigma + floor * floor).alias("v"))
    listed = F.array_sort(F.collect_list(F.struct("k", "m", "v")))  # a row per feature
    return store(wide.groupBy("g").agg(listed.alias("l")).select(
        "g", F.col("l.m").alias("center"), F.col("l.v").alias("v")), "medians")


STATE = "g string, start int, center array<double>, inverse array<double>, logdet double, done boolean"


def _starts(data: DataFrame) -> DataFrame:
    """Three starts a group: medians with quartile deviations alone, and with the correlations of the standardised
    vectors' hyperbolic tangents, and of their directions."""
    p = len(FEATURES)
    medians = _medians(data)
    z = [(F.col(f"x{k}") - F.col("center")[k]) / F.sqrt(F.col("v")[k]) for k in range(p)]
    scaled = data.join(medians, "g").select("g", *[c.alias(f"z{k}") for k, c in enumerate(z)])
    length = F.sqrt(sum((F.col(f"z{k}") * F.col(f"z{k}") for k in range(p)), F.lit(0.0)))
    bent = scaled.select("g", *[F.tanh(f"z{k}").alias(f"h{k}") for k in range(p)],
                         *[F.when(length > 0, F.col(f"z{k}") / length).otherwise(0.0).alias(f"u{k}") for k in range(p)])
    sums = bent.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"h{k}").alias(f"h{k}") for k in range(p)],
        *[F.sum(F.col(f"{c}{i}") * F.col(f"{c}{j}")).alias(f"{c}{i}_{j}") for c in "hu" for i, j in PAIRS])

    def shapes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.to_dict("records"):
                deviation = np.sqrt(np.array(row["v"]))
                mean = np.array([row[f"h{k}"] for k in range(p)]) / row["n"]
                moments = [np.eye(p), symmetric(row, "h") / row["n"] - np.outer(mean, mean), symmetric(row, "u") / row["n"]]
                for k, moment in enumerate(moments):
                    root = np.sqrt(np.maximum(np.diag(moment), 1e-6))
                    # A tenth of independence keeps the matrix well away from singular ones.
                    shape_ = 0.9 * moment / np.outer(root, root) + 0.1 * np.eye(p)
                    scatter = shape_ * np.outer(deviation, deviation)
                    out.append((row["g"], k, list(row["center"]), np.linalg.inv(scatter).ravel().tolist(), np.inf, False))
            yield pd.DataFrame(out, columns=["g", "start", "center", "inverse", "logdet", "done"])

    return store(medians.join(sums, "g").mapInPandas(shapes, STATE), "mcd")


PAIRS = [(i, j) for i in range(len(FEATURES)) for j in range(i, len(FEATURES))]


def symmetric(row: dict, name: str) -> np.ndarray:
    out = np.zeros((len(FEATURES),) * 2)
    for i, j in PAIRS:
        out[i, j] = out[j, i] = row[f"{name}{i}_{j}"]
    return out


def _moments() -> list[Column]:
    """Sums of differences from the current centre, which is close: no loss of digits."""
    p = len(FEATURES)
    diff = [F.col(f"x{i}") - F.col("center")[i] for i in range(p)]
    return [F.count(F.lit(1)).alias("n"), F.first("center").alias("center"), *[F.sum(diff[i]).alias(f"s{i}") for i in range(p)],
            *[F.sum(diff[i] * diff[j]).alias(f"t{i}_{j}") for i, j in PAIRS]]


def _estimate(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Centre, inverse scatter and log determinant from sums; scatters have the floors' squares added."""
    floors = np.array([f for _, _, f in FEATURES])
    for frame in frames:
        out = []
        for row in frame.to_dict("records"):
            mean = np.array([row[f"s{k}"] for k in range(len(floors))]) / row["n"]
            scatter = symmetric(row, "t") / row["n"] - np.outer(mean, mean) + np.diag(floors**2)
            out.append((row["g"], row["start"], (np.array(row["center"]) + mean).tolist(),
                        np.linalg.inv(scatter).ravel().tolist(), float(np.linalg.slogdet(scatter)[1]), False))
        yield pd.DataFrame(out, columns=["g", "start", "center", "inverse", "logdet", "done"])


def _concentrate(data: DataFrame, state: DataFrame, core: float, tolerance: float) -> DataFrame:
    """One step of all estimates that are not done: anew from the ``core`` nearest rows, or done if the determinant
    doesn't fall.

    Sums are taken per bin of distance in one pass, and the cut on the bins: of the bin it falls into, all
    rows count with the weight that makes the core's size exact.
    """
    p = len(FEATURES)
    active = state.where(~F.col("done"))
    binned = data.join(active.select("g", "start", "center", "inverse"), "g").withColumn("bin", _bin(_distance()))
    counted = binned.groupBy("g", "start", "bin").agg(*_moments())
    one = W.partitionBy("g", "start")
    nearer = F.coalesce(F.sum("n").over(one.orderBy("bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    share = (core * F.sum("n").over(one) - nearer) / F.col("n")
    near = counted.withColumn("share", F.least(share, F.lit(1.0))).where("share > 0")
    names = ["n", *[f"s{i}" for i in range(p)], *[f"t{i}_{j}" for i, j in PAIRS]]
    sums = near.groupBy("g", "start").agg(
        F.first("center").alias("center"), *[F.sum(F.col("share") * F.col(c)).alias(c) for c in names])
    found = sums.mapInPandas(_estimate, STATE).select("g", "start", F.struct("center", "inverse", "logdet").alias("next"))
    better = F.col("next.logdet") < F.col("logdet") - tolerance
    moved = active.join(found, ["g", "start"]).select("g", "start", *[
        F.when(better, F.col("next")[c]).otherwise(F.col(c)).alias(c) for c in ("center", "inverse", "logdet")],
        (~better).alias("done"))
    return store(moved.unionByName(state.where("done")), "mcd")


def minimum_determinant(
    data: DataFrame, core: float = 0.75, first: int = 2, most: int = 100, tolerance: float = 1e-3,
) -> DataFrame:
    """Per group g of ``data`` (g, x0..) the estimate with the least determinant: g, center, inverse, logdet.

    All starts take ``first`` concentration steps, the two with the least determinants of each group
    go on until theirs stops falling by ``tolerance`` (of its logarithm), and the lesser stays.  The determinant falls
    with every step, so this ends; an error after ``most`` steps.
    """
    rank = F.row_number().over(W.partitionBy("g").orderBy("logdet", "start"))  # three rows a group
    state = _starts(data)
    for step in range(most):
        if step == first:
            state = store(state.withColumn("rank", rank).where("rank <= 2").drop("rank"), "mcd")
        if step >= first and state.where(~F.col("done")).isEmpty():
            return store(state.withColumn("rank", rank).where("rank = 1").select("g", "center", "inverse", "logdet"), "mcd")
        state = _concentrate(data, state, core, tolerance)
    raise RuntimeError(f"The determinants still fall after {most} steps.")


def _scaled(data: DataFrame, state: DataFrame) -> DataFrame:
    """Inverses scaled so that the median squared distance is that of a chi-square; adds ``rows``.

    Never enlarged: floors of variances make the distances of very even groups smaller.
    """
    counted = data.join(state, "g").withColumn("bin", _bin(_distance())).groupBy("g", "bin").agg(F.count(F.lit(1)).alias("n"))
    middle = _quantile_bins(counted, ["g"], "bin", [0.5]).join(counted.groupBy("g").agg(F.sum("n").alias("rows")), "g")
    scale = F.greatest(F.expm1((F.col("q0") + 0.5) / 64) / chi_square(0.5, len(FEATURES)), F.lit(1.0))
    return store(state.join(middle, "g").select(
        "g", "center", F.transform("inverse", lambda v: v / scale).alias("inverse"), "rows"), "mcd")


def fit(rows: DataFrame, core: float = 0.75, least: int = 50) -> DataFrame:
    """Estimates for every (lang, source): columns key, center, inverse.

    ``rows``: lang, source (strings, NULL is a value) and x0.. of the documents to learn from.
    The estimate of least determinant is made consistent by its median distance; all rows within its 97.5%
    quantile then give the final one, scaled in the same way.
    """
    names = [f"x{k}" for k in range(len(FEATURES))]
    groups = store(assign_groups(rows, least), "groups")
    data = store(
        rows.select(F.struct("lang", "source").alias("key"), *names).join(groups, "key").select("g", *names), "vectors")
    raw = _scaled(data, minimum_determinant(data, core)).drop("rows")
    within = data.join(raw, "g").where(_distance() <= chi_square(0.975, len(FEATURES)))
    sums = within.groupBy("g").agg(*_moments()).withColumn("start", F.lit(0))
    weighed = store(sums.mapInPandas(_estimate, STATE).select("g", "center", "inverse"), "mcd")
    final = _scaled(data, weighed).where(F.col("rows") >= least)
    return store(groups.join(final, "g").select("key", "center", "inverse"), "estimates")


def judge(measured: DataFrame, estimates: DataFrame, level: float) -> DataFrame:
    """Adds base_failed, distance (squared, NULL without an estimate) and kept to measured rows
    that have the columns lang and source."""
    limit = chi_square(level, len(FEATURES))
    names = [f"x{k}" for k in range(len(FEATURES))]
    failed = measured.withColumn("base_failed", base_failed()).withColumn("key", F.struct("lang", "source"))
    valued = failed.withColumns({
        f"x{k}": F.when(~F.col("base_failed"), F.expr(sql).cast("double")) for k, (_, sql, _) in enumerate(FEATURES)})
    joined_ = valued.join(estimates, "key", "left").withColumn("distance", _distance_or_null())
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= limit, F.lit(True))
    return joined_.withColumn("kept", kept).drop("key", "center", "inverse", *names)


def _distance_or_null() -> Column:
    return F.when(F.col("x0").isNotNull() & F.col("center").isNotNull(), _distance())


def reject_outliers(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    level: float = 1 - 1e-7,
    core: float = 0.75,
    least: int = 50,
    store_rows: bool = True,
) -> DataFrame:
    """The columns ``keep`` of every row with COUNTS, base_failed, distance and kept.

    Plain rules: fewer than 20 words, or more than 30% of the words in repeated 8-word windows.
    The others learn the estimates and are held against them; ``level`` is the chi-square level
    beyond which a document goes.  NULL or empty texts have no words and fail.  NULL languages and
    sources are values of their own; repeated rows are judged alike and each counts; no rows
    give an empty result.

    With ``store_rows`` the columns ``keep`` are stored beside the counts; without, as is right
    if they hold the texts, the documents are read a second time instead.
    """
    names = {"lang": F.col(lang).cast("string"), "source": F.col(source).cast("string")}
    table = docs.select(F.struct(*[F.col(c) for c in keep]).alias("kept_row"), F.col(text).alias("text"),
                        *[c.alias(n) for n, c in names.items()])
    whole = measure(table, ["lang", "source", "kept_row"]).select("row.*", *COUNTS)
    narrow = store(whole if store_rows else measure(table, ["lang", "source"]).select("row.*", *COUNTS), "statistics")
    estimates = fit(narrow.where(~base_failed()).select("lang", "source", *features()), core=core, least=least)
    judged = judge(narrow if store_rows else whole, estimates, level)
    return judged.select("kept_row.*", *COUNTS, "base_failed", "distance", "kept")
