"""Quality classifier: evidence of the document, and of its host and path by hierarchical empirical Bayes.

A document has a classifier's probability of being unwanted (of low quality, or toxic).  Hosts and paths
have beta-binomial posteriors: the global rate is the prior of the hosts' rates, a host's posterior that
of its paths.  How strongly a level is pulled to the one above is estimated from the spread of its
rates beyond what sampling explains, so sparse sites stay near the level above and large ones speak
for themselves.  A document's posterior odds are its classifier's likelihood ratio times the prior
odds of its path, its own share in the path left out.

Site statistics are grouped aggregations over all documents, combined map-side: a host that holds
a third of all documents is one row per task.  The classifier is fitted on a bounded sample of the
labelled documents (``max_labelled``), which also bounds its word features: each occurs in several documents
of that sample.  It is cross-fitted: the words of each fold of the sample are weighed in the other folds, so
the regression learns how far a word's weight holds for documents that had no part in it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import bounded_batches, chunks, joined, mix, release, shape, store, text_bytes
from millrace.llm.outliers import COUNTS, Counter

HEADS = ("low", "toxic")
#: Lengths of beginnings of words, in bytes, that are features beside whole words (0).
BEGINNINGS = (4, 5, 6, 7, 8)
#: Folds of the labelled sample.
FOLDS = 5


def _salt(n: int) -> np.uint64:
    """Keeps beginnings of different lengths apart from each other and from words."""
    return np.uint64(0x452821E638D01377 + n)


class Evidence:
    """Counts and word features of many texts at a time."""

    def __init__(self):
        self.counter = Counter()

    def counts(self, texts: list[bytes]) -> np.ndarray:
        return self.counter.run(texts)

    def words(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Feature hashes with the index of their text: words, and beginnings of longer words."""
        scan = self.counter.scan
        whole, begins = joined(texts)
        raw = np.frombuffer(whole.lower(), np.uint8)
        starts, ends = scan.words(raw)
        owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, begins)))
        # Marks around a word aren't part of it.
        letter = (raw >= 0x80) | ((raw >= 97) & (raw <= 122)) | ((raw >= 48) & (raw <= 57))
        ends = ends - ~letter[ends - 1]
        starts = starts + ~letter[np.minimum(starts, max(len(raw) - 1, 0))]
        fine = ends > starts
        starts, ends, owner = starts[fine], ends[fine], owner[fine]
        found, owners = [mix(scan.hashes(raw, starts, ends) ^ _salt(0))], [owner]
        for n in BEGINNINGS:
            long = ends - starts > n
            found.append(mix(scan.hashes(raw, starts[long], starts[long] + n) ^ _salt(n)))
            owners.append(owner[long])
        return np.concatenate(found), np.concatenate(owners)


def dense(counts: np.ndarray) -> np.ndarray:
    """Shape of a text from its counts."""
    c = {name: counts[:, k].astype(np.float64) for k, name in enumerate(COUNTS)}
    chars, words, lines = (np.maximum(c[k], 1) for k in ("word_chars", "n_words", "n_lines"))
    return np.stack([
        np.log1p(c["n_words"]), np.log(chars / words),
        *[np.log1p(200 * c[k] / chars) for k in ("n_symbols", "n_upper", "n_marks")],
        *[np.log1p(50 * c[k] / words) for k in ("n_repeat_words", "n_next_same")],
        np.log1p(50 * c["n_dup_lines"] / lines),
    ], 1)


class Lexicon:
    """Words that speak for a head, with their weights; looks up many hashes at a time."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.weights = keys[order], weights[order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[(keys & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def sums(self, hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
        """Per text: weight and number of its distinct features."""
        maybe = self.seen[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)]
        hashes, owner = hashes[maybe], owner[maybe]
        at = np.minimum(np.searchsorted(self.keys, hashes), max(len(self.keys) - 1, 0))
        hit = self.keys[at] == hashes if len(self.keys) else np.zeros(len(at), bool)
        pairs = np.unique(np.stack([owner[hit], at[hit]]), axis=1)
        return np.stack([
            np.log1p(np.bincount(pairs[0], self.weights[pairs[1]], n)), np.log1p(np.bincount(pairs[0], minlength=n))], 1)


class Model:
    """Both heads: a lexicon and a logistic regression each."""

    def __init__(self, lexicons: Sequence[Lexicon]):
        self.lexicons = lexicons
        self.evidence, self.mean, self.scale, self.coefficients = None, None, None, None

    def __getstate__(self):
        return self.__dict__ | {"evidence": None}

    def inputs(self, texts: list[bytes], lexicons: Sequence[Lexicon] | None = None) -> np.ndarray:
        """Per text and head its row of inputs: shape, then the sums of the lexicon (the model's own if not given)."""
        self.evidence = self.evidence or Evidence()
        counts = dense(self.evidence.counts(texts))
        hashes, owner = self.evidence.words(texts)
        return np.stack([np.concatenate([counts, x.sums(hashes, owner, len(texts))], 1) for x in lexicons or self.lexicons], 1)

    def fit(self, inputs: np.ndarray, labels: np.ndarray, ridge: float = 1.0) -> None:
        """inputs: rows x heads x features; labels: rows x heads of 0 and 1."""
        self.mean, self.scale = inputs.mean(0), inputs.std(0) + 1e-3
        x = self._standard(inputs)
        self.coefficients = [newton_logistic(x[:, h], labels[:, h], ridge) for h in range(labels.shape[1])]

    def _standard(self, inputs: np.ndarray) -> np.ndarray:
        z = np.clip((inputs - self.mean) / self.scale, -8, 8)
        return np.concatenate([np.ones((*z.shape[:2], 1)), z, np.square(z[:, :, 1:])], 2)

    def unwanted(self, texts: list[bytes]) -> np.ndarray:
        """Probability that one head or the other applies."""
        x = self._standard(self.inputs(texts))
        p = [sigmoid(x[:, h] @ w) for h, w in enumerate(self.coefficients)]
        return 1 - np.prod([1 - q for q in p], axis=0)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def newton_logistic(x: np.ndarray, y: np.ndarray, ridge: float, rounds: int = 40) -> np.ndarray:
    """Coefficients with a ridge penalty on all but the first."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(rounds):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (y - p) - penalty * w)
        step *= min(1.0, 4.0 / max(np.abs(step).max(), 1e-12))
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_model(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", quality: str = "quality",
    toxic: str = "toxic", max_labelled: int = 20_000, least: int = 4, least_weight: float = 4.0,
) -> Model | None:
    """Both heads from at most ``max_labelled`` labelled documents, chosen by a hash of their id.

    A document is of low quality if its labels' mean ``quality`` is under one half, toxic if their mean
    ``toxic`` is one half or more.  NULL ids and labels are left out.  Word features: all in ``least``
    documents of a head or more (fewer, in proportion, for all folds but one), exp(``least_weight``) times as often as in
    the others.  None without a labelled document.
    """
    ids = (
        labels.where(F.col(id).isNotNull()).groupBy(F.col(id).alias("id"))
        .agg((F.avg(quality) < 0.5).alias("low"), (F.avg(toxic) >= 0.5).alias("toxic"))
        .where("low IS NOT NULL AND toxic IS NOT NULL")
        .orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    )
    rows = bounded_batches(docs).select(F.col(id).alias("id"), text_bytes(text).alias("text"))
    # max_labelled rows of an id and two flags: under a megabyte at the default.
    fold = F.pmod(F.xxhash64(F.lit("fold"), "id"), F.lit(FOLDS)).cast("int").alias("fold")
    chosen = store(rows.join(F.broadcast(ids), "id").select(
        "text", fold, *[F.col(h).cast("int").alias(h) for h in HEADS]), "labelled")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Evidence()
        for batch in batches:
            heads = np.stack([batch.column(h).to_numpy() for h in HEADS], 1)
            folds = batch.column("fold").to_numpy()
            done = 0
            for part in chunks(batch.column("text").to_pylist()):
                hashes, owner = evidence.words(part)
                key, of = np.unique(np.stack([hashes, owner.astype(np.uint64)]), axis=1)
                name, same = np.unique(key, return_inverse=True)
                of = done + of.astype(np.int64)
                done += len(part)
                columns = []
                for k in range(FOLDS):
                    inside = folds[of] == k
                    for flags in (np.ones(len(of)), *heads[of].T):
                        columns.append(np.bincount(same, inside * flags, len(name)).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name.view(np.int64)), *map(pa.array, columns)], names=["feature", *tallies])
            release()

    tallies = [f"{c}{k}" for k in range(FOLDS) for c in ("n", *HEADS)]
    totals = {r["fold"]: r for r in chosen.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(h).alias(h) for h in HEADS]).collect()}  # FOLDS rows at most
    if not totals:
        return None
    fewer = max(least * (FOLDS - 1) // FOLDS, 1)
    counted = store(
        chosen.mapInArrow(count, ", ".join(["feature long", *[f"{c} long" for c in tallies]]))
        .groupBy("feature").agg(*[F.sum(c).alias(c) for c in tallies]).where(" + ".join(f"n{k}" for k in range(FOLDS)) + f" >= {fewer}"),
        "features")

    def lexicon(head: str, folds: Sequence[int], least: int) -> Lexicon:
        """Words that speak for a head in these folds of the sample."""
        yes = sum(totals[k][head] for k in folds if k in totals)
        no = sum(totals[k]["n"] for k in folds if k in totals) - yes
        with_, all_ = (sum((F.col(f"{c}{k}") for k in folds), F.lit(0)) for c in (head, "n"))
        weight = F.log((with_ + 0.5) / (yes + 1.0)) - F.log((all_ - with_ + 0.5) / (no + 1.0))
        found = counted.where(with_ >= least).select("feature", weight.alias("weight")).where(
            F.col("weight") > least_weight).toArrow()
        return Lexicon(found.column("feature").to_numpy().view(np.uint64), found.column("weight").to_numpy())

    lexicons = [lexicon(head, range(FOLDS), least) for head in HEADS]
    # A fold's documents are looked up in what the others taught.
    crossed = [[lexicon(head, [j for j in range(FOLDS) if j != k], fewer) for head in HEADS] for k in range(FOLDS)]
    model = Model(lexicons)
    width = len(dense(np.zeros((1, len(COUNTS)), np.int64))[0]) + 2

    def inputs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, folds = batch.column("text").to_pylist(), batch.column("fold").to_numpy()
            found = np.zeros((len(texts), len(HEADS), width))
            for k in range(FOLDS):
                at = np.flatnonzero(folds == k)
                parts = [model.inputs(part, crossed[k]) for part in chunks([texts[i] for i in at])]
                found[at] = np.concatenate([found[:0], *parts])
            flat = found.reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays([
                pa.array(list(flat), pa.list_(pa.float64())), *[batch.column(h) for h in HEADS]], names=["x", *HEADS])

    # At most max_labelled rows of some twenty numbers.
    table = chosen.mapInArrow(inputs, "x array<double>, low int, toxic int").toArrow()
    x = table.column("x").combine_chunks().flatten().to_numpy().reshape(table.num_rows, len(HEADS), width)
    y = np.stack([table.column(h).to_numpy() for h in HEADS], 1).astype(np.float64)
    order = np.lexsort(np.concatenate([x.reshape(len(x), -1).T, y.T]))  # the same sums in every run
    model.fit(x[order], y[order])
    return model


def score(docs: DataFrame, model: Model | None, keep: Sequence[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` as a struct ``row``, and ``p``: the classifier's probability of an unwanted document."""
    rows = bounded_batches(docs).select(text_bytes(text).alias("text"), F.struct(*[F.col(c) for c in keep]).alias("row"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                p = np.full(batch.num_rows, 0.5)
            else:
                p = np.concatenate([np.zeros(0), *[model.unwanted(x) for x in chunks(batch.column(0).to_pylist())]])
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(p)], names=["row", "p"])
            release()

    return rows.mapInArrow(task, shape({"row": rows.schema["row"].dataType, "p": "double"}))


def _strength(rates: DataFrame, n: str, s: str, prior: Column) -> Column:
    """Prior strength by moments: how far the rates s/n spread around their priors beyond sampling.

    A scalar between 1 (sites differ freely) and 10,000 (sites are alike)."""
    spread = F.sum(F.col(n) * F.pow(F.col(s) / F.col(n) - prior, 2))
    noise = F.sum(prior * (1 - prior))
    between = (spread - noise) / F.sum(n)
    level = F.sum(F.col(n) * prior * (1 - prior)) / F.sum(n)
    strength = F.when(between > 0, level / F.greatest(between, F.lit(1e-12)) - 1).otherwise(F.lit(1e4))
    bounded = F.least(F.greatest(F.coalesce(strength, F.lit(1e4)), F.lit(1.0)), F.lit(1e4))
    return rates.agg(F.round(bounded, 6).alias("strength")).scalar()


def site_posteriors(scores: DataFrame) -> DataFrame:
    """Per (host, path) of ``scores`` (host, path, p): n, s (sum of p) and what pulls them, strength and
    ``host_rate``.

    Probabilities are summed as integers, so the sums don't depend on the order of rows.
    """
    units = F.sum(F.round(F.col("p") * 1e6).cast("long")) / 1e6
    paths = store(scores.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), units.alias("s")), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    rate = paths.agg(((F.sum("s") + 0.5) / (F.sum("n") + 1)).alias("rate")).scalar()
    strength = _strength(hosts, "host_n", "host_s", rate)
    known = hosts.select(F.struct("host").alias("key"), (
        (strength * rate + F.col("host_s")) / (strength + F.col("host_n"))).alias("host_rate"))
    joined_ = store(paths.withColumn("key", F.struct("host")).join(known, "key").drop("key"), "hosts")
    pull = _strength(joined_, "n", "s", F.col("host_rate"))
    return store(joined_.select(F.struct("host", "path").alias("key"), "n", "s", "host_rate", pull.alias("pull"),
                                rate.alias("rate")), "sites")


def classify(
    docs: DataFrame,
    labels: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    path: str = "lang",
    threshold: float = 0.5,
    store_rows: bool = True,
    **fitting,
) -> DataFrame:
    """The columns ``keep`` of every row with evidence, site_prior, posterior and kept.

    ``evidence``: the classifier's probability that the document is of low quality or toxic;
    ``site_prior``: the rate of its path without the document itself; ``posterior``: both together;
    ``kept``: posterior under ``threshold``.  ``host`` and ``path`` name the columns of the two levels of
    sites; NULL is a value of its own.  Without labels all have the same evidence and stay.  NULL
    and empty texts are judged like any other, repeated rows alike.  No rows give an empty result.

    With ``store_rows`` the columns ``keep`` are stored beside the scores; without, as is right if
    they hold the texts, the documents are read again instead.
    """
    model = fit_model(docs, labels, id=id, text=text, **fitting)
    table = docs.select(
        F.struct(*[F.col(c) for c in keep]).alias("kept_row"), F.col(text).alias("text"),
        F.col(host).cast("string").alias("host"), F.col(path).cast("string").alias("path"))
    whole = score(table, model, ["host", "path", "kept_row"]).select("row.*", "p")
    narrow = store(whole if store_rows else score(table, model, ["host", "path"]).select("row.*", "p"), "scores")
    sites = site_posteriors(narrow)
    rows = (narrow if store_rows else whole).withColumn("key", F.struct("host", "path")).join(sites, "key", "left")

    own = F.round(F.col("p") * 1e6) / 1e6
    prior = (F.col("pull") * F.col("host_rate") + F.greatest(F.col("s") - own, F.lit(0.0))) / (F.col("pull") + F.col("n") - 1)
    prior = F.least(F.greatest(prior, F.lit(1e-6)), F.lit(1 - 1e-6))
    p = F.least(F.greatest(F.col("p"), F.lit(1e-9)), F.lit(1 - 1e-9))
    # The classifier's odds contain the overall rate; the site's takes its place.
    odds = (p / (1 - p)) * ((1 - F.col("rate")) / F.col("rate")) * (prior / (1 - prior))
    if model is None:
        return rows.select("kept_row.*", F.col("p").alias("evidence"), prior.alias("site_prior"),
                           prior.alias("posterior"), F.lit(True).alias("kept"))
    posterior = odds / (1 + odds)
    return rows.select(
        "kept_row.*", F.col("p").alias("evidence"), prior.alias("site_prior"), posterior.alias("posterior"),
        (posterior < threshold).alias("kept"))
