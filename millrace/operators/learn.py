"""Training, scoring, tuning and explaining models with Spark ML."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import (
    PCA, FeatureHasher, Imputer, OneHotEncoder, QuantileDiscretizer, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler, VectorSlicer,
)
from pyspark.ml.feature import ImputerModel, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.evaluate import eval_metrics
from millrace.operators.features import kfold
from millrace.operators.ordering import positions
from millrace.session import materialize, shared_folder
from millrace.sources.tables import write_folder

LABEL, FEATURES = "_label", "_features"


def _filled(num_cols: Sequence[str]) -> tuple[list, list[str]]:
    """Stages that put the median in place of missing numbers, and the names of the filled columns."""
    typed = SQLTransformer(statement="SELECT *, " + ", ".join(
        f"CAST(`{c}` AS DOUBLE) AS `_num_{c}`" for c in num_cols) + " FROM __THIS__")
    names = [f"_num_{c}" for c in num_cols]
    return [typed, Imputer(inputCols=names, outputCols=names, strategy="median")], names


def hash_buckets(df: DataFrame, cat_cols: Sequence[str], low: int = 64, high: int = 1 << 18) -> int:
    """A power of two, four times the number of category values or more, so that few of them share a bucket."""
    counts = df.agg(*[F.approx_count_distinct(c) for c in cat_cols]).first()
    return min(high, max(low, 1 << (4 * sum(counts) - 1).bit_length()))


#: Values of an input that trees tell apart, Spark's own number of bins.
BINS = 32


def _binned(num_cols: Sequence[str]) -> tuple[list, list[str]]:
    """Stages that put the number of its quantile bin in place of each number (missing: the median's)."""
    stages, parts = _filled(num_cols)
    names = [f"_bin_{c}" for c in num_cols]
    return [*stages, QuantileDiscretizer(
        inputCols=parts, outputCols=names, numBucketsArray=[BINS] * len(parts), handleInvalid="keep")], names


# ---------------------------------------------------------------- classification


#: Parts of the training rows that label shares are taken out of.
PARTS = 5


def _label_shares(rows: DataFrame, col: str, shares: Sequence[float], m: float = 20.0) -> tuple[Model, Model]:
    """Models that add the vector ``_share_<col>``: the share of each label among ``rows`` (``_hash_<col>``, label) with
    the value of ``col``, shrunk by ``m`` rows towards ``shares``; a missing or unknown value has those.

    Naive Bayes over one bucket per row gives just that share.  One row per label that holds all buckets puts the ``m``
    rows into each of them.
    """
    buckets = rows.schema[f"_hash_{col}"].metadata["ml_attr"]["num_attrs"]
    every = Vectors.dense(np.ones(buckets))
    prior = rows.sparkSession.createDataFrame(
        [(float(k), every, m * p) for k, p in enumerate(shares)], [LABEL, f"_hash_{col}", "_weight"])
    counted = rows.select(LABEL, f"_hash_{col}", F.lit(1.0).alias("_weight")).unionAll(prior)
    model = NaiveBayes(
        labelCol=LABEL, featuresCol=f"_hash_{col}", weightCol="_weight", smoothing=0.0, probabilityCol=f"_shares_{col}",
        predictionCol="", rawPredictionCol="").fit(counted)
    # The shares add up to one, so the first one tells nothing more.
    kept = VectorSlicer(
        inputCol=f"_shares_{col}", outputCol=f"_share_{col}", indices=list(range(min(1, len(shares) - 1), len(shares))))
    return model, kept


def train_forest(
    df: DataFrame, label: str, num_cols: Sequence[str], cat_cols: Sequence[str] = (),
    trees: int = 100, depth: int = 10, subsample: float = 0.8, min_gain: float = 0.0, seed: int = 42,
) -> PipelineModel:
    """Random forest with string labels; rows without a label teach nothing, all others count.

    ``min_gain`` is the least decrease of impurity (between 0 and 0.5 here) of a split; a loss
    threshold of boosted trees is on another scale.

    Trees bin every input and keep a number of each row for it, so a category is not one input per value but the shares
    of the labels among the rows with its value (``_label_shares``), in the order of which a tree can split the values as
    it likes.  Training rows get them from the other of five parts, so no row is told its own label; rows to score from
    all training rows.  Values are hashed to buckets (``hash_buckets``), so no list of them is collected.
    """
    indexer = StringIndexer(inputCol=label, outputCol=LABEL, stringOrderType="alphabetAsc", handleInvalid="skip").fit(df)
    rows = indexer.transform(df).select(
        LABEL, *dict.fromkeys([*num_cols, *cat_cols]), (F.rand(seed) * PARTS).cast("int").alias("_part"))
    # Dealt over all cores: trees go over the rows once per level.  The label's list of values is kept by its metadata,
    # which a stored table loses.
    dealt = rows.repartition(df.sparkSession.sparkContext.defaultParallelism)
    rows = materialize(dealt).withMetadata(LABEL, rows.schema[LABEL].metadata)
    stages, parts = _filled(num_cols)
    stages = list(Pipeline(stages=stages).fit(rows).stages)
    training = PipelineModel(stages).transform(rows)
    if cat_cols:
        buckets = hash_buckets(rows, cat_cols)
        hashers = [
            FeatureHasher(inputCols=[c], categoricalCols=[c], outputCol=f"_hash_{c}", numFeatures=buckets) for c in cat_cols]
        hashed = PipelineModel(hashers).transform(training)
        counts = {r[LABEL]: r["count"] for r in rows.groupBy(LABEL).count().collect()}  # a row per label
        shares = [counts[float(k)] / sum(counts.values()) for k in range(len(counts))]

        def told(some: DataFrame) -> list:
            return [stage for c in cat_cols for stage in _label_shares(some, c, shares)]

        training = reduce(DataFrame.unionAll, [
            PipelineModel(told(hashed.where(F.col("_part") != part))).transform(hashed.where(F.col("_part") == part))
            for part in range(PARTS)])
        stages += [*hashers, *told(hashed)]
        parts = [*parts, *[f"_share_{c}" for c in cat_cols]]
    stages.append(VectorAssembler(inputCols=parts, outputCol=FEATURES, handleInvalid="keep"))
    trained = RandomForestClassifier(
        labelCol=LABEL, featuresCol=FEATURES, numTrees=trees, maxDepth=depth, subsamplingRate=subsample,
        minInfoGain=min_gain, seed=seed, probabilityCol="_prob", rawPredictionCol="_raw",
        predictionCol="_pred",
    ).fit(stages[-1].transform(training).select(LABEL, FEATURES))
    return PipelineModel([indexer, *stages, trained])


def class_probs(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``predicted_label`` and ``probs`` (array of label and probability, in label order)."""
    labels = F.array(*[F.lit(v) for v in model.stages[0].labels])
    # The label is not needed to score, so its indexer is left out.
    scored = PipelineModel(model.stages[1:]).transform(df)
    probs = F.zip_with(
        labels, vector_to_array("_prob"), lambda name, p: F.struct(name.alias("label"), p.alias("prob"))
    )
    return scored.select(
        *df.columns,
        F.element_at(labels, F.col("_pred").cast("int") + 1).alias("predicted_label"),
        probs.alias("probs"),
    )


def prob_of(probs: Column, label: str) -> Column:
    """Probability of one label from a ``probs`` array."""
    return F.element_at(F.transform(F.filter(probs, lambda e: e["label"] == label), lambda e: e["prob"]), 1)


def top_by_prob(scored: DataFrame, index: int, tiebreak: Sequence[str], n: int = 20) -> DataFrame:
    """The ``n`` rows with the highest probability of the label at ``index``."""
    return scored.orderBy(F.col("probs")[index]["prob"].desc(), *tiebreak).limit(n)


def score(model: PipelineModel, df: DataFrame, positive: str, negative: str, threshold: float = 0.40) -> DataFrame:
    """Probability of the positive label and the decision at a business threshold."""
    p = F.col("predicted_probability")
    return (
        class_probs(model, df)
        .withColumn("label", F.lit(positive))
        .withColumn("predicted_probability", prob_of(F.col("probs"), positive))
        .withColumn("business_decision", F.when(p >= threshold, positive).otherwise(negative))
        .drop("predicted_label", "probs")
    )


def daily_scores(scored: DataFrame, run_date, key: Sequence[str]) -> DataFrame:
    """Scores of one run date with a key that is the same on every run."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key]
    return scored.select(
        F.md5(F.concat_ws("|", F.lit(str(run_date)), *parts)).alias("trip_key"),
        F.col("business_decision").alias("predicted_label"),
        "predicted_probability",
        F.lit(run_date).cast("date").alias("score_date"),
    )


def write_daily_scores(scores: DataFrame, path: str) -> None:
    """Store scores by ``score_date``; scoring a day again replaces that day."""
    write_folder(scores, path, ["score_date"])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


# ---------------------------------------------------------------- tuning


def random_trials(space: Mapping[str, object], n: int, seed: int = 42) -> list[dict]:
    """``n`` settings: a (low, high) tuple is a range, a list holds candidates."""
    rng = random.Random(seed)

    def draw(spec):
        if isinstance(spec, tuple):
            low, high = spec
            return rng.uniform(low, high)
        return rng.choice(list(spec))

    return [{name: draw(spec) for name, spec in space.items()} for _ in range(n)]


def _target_encoded(parts: DataFrame, names: Mapping[str, str], m: float = 20.0) -> DataFrame:
    """Add for each category column the mean label of its value, shrunk by ``m`` rows towards the mean of all.

    Holdout rows (part 0) see all training rows, training rows those of the other parts, so no row sees its own
    label or one of the holdout.  A missing or unknown value has the mean of all.
    """
    train = parts.where((F.col("_part") != 0) & F.col(LABEL).isNotNull())
    totals = {r["_part"]: (r["s"], r["n"]) for r in train.groupBy("_part").agg(
        F.sum(LABEL).alias("s"), F.count(F.lit(1)).alias("n")).collect()}
    prior = F.lit(0.0)
    for part in range(5):
        s, n = (sum(v[k] for p, v in totals.items() if p != part) for k in (0, 1))
        prior = F.when(F.col("_part") == part, F.lit(s / n if n else 0.0)).otherwise(prior)
    out = parts
    for col, name in names.items():
        cells = materialize(train.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_c"), F.col("_part").alias("_f")).agg(
            F.sum(LABEL).alias("_cs"), F.count(F.lit(1)).alias("_cn")))
        values = cells.groupBy(F.col("_c").alias("_v")).agg(F.sum("_cs").alias("_vs"), F.sum("_cn").alias("_vn"))
        zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
        out = (
            out.join(values, F.col(col) == F.col("_v"), "left")
            .join(cells, (F.col(col) == F.col("_c")) & (F.col("_part") == F.col("_f")), "left")
            .withColumn(name, (zero("_vs") - zero("_cs") + m * prior) / (zero("_vn") - zero("_cn") + m))
            .drop("_v", "_vs", "_vn", "_c", "_f", "_cs", "_cn"))
    return out


#: Rows of a task that grows trees: a level of a tree is a job, so tasks with less to do cost more than they share out.
ROWS_PER_TASK = 50_000


def _in_few_tasks(rows: DataFrame) -> DataFrame:
    """``rows`` dealt to as many tasks as their number needs."""
    return rows.repartition(max(1, -(-rows.count() // ROWS_PER_TASK)))


def tune_gbt(
    df: DataFrame, label: str, num_cols: Sequence[str], cat_cols: Sequence[str] = (),
    space: Mapping[str, object] | None = None, n_trials: int = 20, parallelism: int = 2,
    split_key: str | None = None, rounds: int = 20, seed: int = 42,
) -> tuple[list, DataFrame]:
    """Boosted trees for a 0/1 label under seeded random search.

    Trials run as separate Spark jobs, ``parallelism`` at a time, on the same
    prepared training and holdout rows (one fifth, by the hash of ``split_key``).
    Returns the fitted models and the trials: number, settings and metrics.

    Boosted trees look at every input at every node, so a category is one number, exact for each of its values:
    its target mean out of fold (``_target_encoded``).

    A tree sees no more of a number than its bin, so inputs are binned once for all trials, and training rows with the same
    bins and label are one row of their weight: as many as there are such cells, however many rows there are.  A subsample
    takes cells; ``minInstancesPerNode`` counts rows, as a share of the weight.  The models take the vectors of bins.
    """
    space = space or {"stepSize": (0.01, 0.3), "maxDepth": [4, 6, 8, 10], "subsamplingRate": (0.6, 1.0)}
    settings = random_trials(space, n_trials, seed)
    parts = kfold(df, split_key, 5, "_part") if split_key else df.withColumn("_part", (F.rand(seed) * 5).cast("int"))
    parts = parts.select(F.col(label).cast("double").alias(LABEL), *dict.fromkeys([*num_cols, *cat_cols]), "_part")
    encoded = {c: f"_target_{c}" for c in cat_cols}
    if encoded:
        parts = _target_encoded(materialize(parts), encoded)
    inputs = [*num_cols, *encoded.values()]
    parts = materialize(parts)
    stages, bins = _binned(inputs)
    # Added to, bins lose the mark of a category: they stay ordered.
    binned = Pipeline(stages=stages).fit(parts).transform(parts).withColumns({b: F.col(b) + F.lit(0.0) for b in bins})
    vector = VectorAssembler(inputCols=bins, outputCol=FEATURES, handleInvalid="keep")
    cells = vector.transform(binned.where(F.col("_part") != 0).groupBy(LABEL, *bins).agg(
        F.count(F.lit(1)).cast("double").alias("_weight"))).select(LABEL, FEATURES, "_weight")
    cells = _in_few_tasks(materialize(cells)).persist()
    held = vector.transform(binned.where(F.col("_part") == 0)).select(LABEL, FEATURES).persist()
    total = cells.agg(F.sum("_weight").alias("n")).first()["n"] or 1.0

    def run(numbered):
        number, params = numbered
        given = {k: v for k, v in params.items() if k != "minInstancesPerNode"}
        least = min(0.499, params.get("minInstancesPerNode", 1) / total)
        model = GBTClassifier(
            labelCol=LABEL, featuresCol=FEATURES, weightCol="_weight", maxIter=rounds, maxBins=BINS, seed=seed,
            minWeightFractionPerNode=least, **given
        ).fit(cells)
        scored = model.transform(held).withColumn(
            "_p", vector_to_array("probability")[1]
        )
        metrics = eval_metrics(scored, LABEL, "_p").first().asDict()
        return model, {"trial_id": number, **params, **metrics}

    try:
        with ThreadPool(parallelism) as pool:
            done = pool.map(run, list(enumerate(settings, 1)), chunksize=1)
    finally:
        cells.unpersist()
        held.unpersist()
    rows = [r for _, r in done]
    fields = ", ".join(
        f"{c} {'int' if c == 'trial_id' else 'double'}" for c in rows[0]
    )
    data = [tuple(v if c == "trial_id" or v is None else float(v) for c, v in r.items()) for r in rows]
    return [m for m, _ in done], df.sparkSession.createDataFrame(data, fields)


def pareto(trials: DataFrame, first: str, second: str) -> DataFrame:
    """Trials no other trial beats in both metrics.

    For tables of trials, one row each: a single window goes over all distinct first metrics.
    """
    ahead = W.partitionBy(F.lit(0)).orderBy(F.desc(first)).rowsBetween(W.unboundedPreceding, -1)
    best = trials.groupBy(first).agg(F.max(second).alias("_best")).withColumn("_ahead", F.max("_best").over(ahead))
    front = best.where(F.col("_ahead").isNull() | (F.col("_best") > F.col("_ahead")))
    return trials.join(front, first).where(F.col(second) == F.col("_best")).select(trials.columns)


# ---------------------------------------------------------------- clustering


def _scaled(cols: Sequence[str]) -> list:
    stages, names = _filled(cols)
    return [
        *stages,
        VectorAssembler(inputCols=names, outputCol="_assembled", handleInvalid="keep"),
        StandardScaler(inputCol="_assembled", outputCol=FEATURES, withMean=True, withStd=True),
    ]


def train_kmeans(df: DataFrame, cols: Sequence[str], k: int = 5, max_iter: int = 50, seed: int = 42) -> PipelineModel:
    """K-means on standardised features."""
    stage = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol=FEATURES, predictionCol="_cluster")
    return Pipeline(stages=[*_scaled(cols), stage]).fit(df)


def assign_clusters(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add ``cluster_id``, counted from 1."""
    return model.transform(df).select(*df.columns, (F.col("_cluster") + 1).alias("cluster_id"))


def cluster_profile(assigned: DataFrame, means: Mapping[str, str]) -> DataFrame:
    """Members and rounded means per cluster; ``means`` maps column to output name."""
    return assigned.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("members"), *[F.round(F.avg(c), 0).alias(out) for c, out in means.items()]
    )


def davies_bouldin(model: PipelineModel, df: DataFrame) -> float:
    """Davies-Bouldin index of a fitted k-means pipeline; only k rows reach the driver."""
    centers = [c.tolist() for c in model.stages[-1].clusterCenters()]
    table = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])
    placed = model.transform(df).select("_cluster", vector_to_array(FEATURES).alias("v"))
    gap = F.zip_with(F.col("v"), F.get(table, F.col("_cluster")), lambda a, b: (a - b) * (a - b))
    spread = placed.groupBy("_cluster").agg(
        F.avg(F.sqrt(F.aggregate(gap, F.lit(0.0), lambda acc, x: acc + x))).alias("s")
    )
    s = {r["_cluster"]: r["s"] for r in spread.collect()}
    worst = []
    for i in s:
        ratios = [
            (s[i] + s[j]) / np.linalg.norm(np.subtract(centers[i], centers[j]))
            for j in s if j != i and centers[i] != centers[j]
        ]
        worst.append(max(ratios, default=0.0))
    return float(np.mean(worst)) if worst else 0.0


def select_k(
    df: DataFrame, cols: Sequence[str], ks: Sequence[int] = (3, 5, 7, 10), fraction: float = 0.2,
    seed: int = 42, max_iter: int = 20,
) -> DataFrame:
    """Davies-Bouldin index per k on a sample (the sample is the operator's purpose): lower is better."""
    part = df.select(*cols).sample(fraction=fraction, seed=seed).persist()
    try:
        rows = []
        for k in ks:
            model = train_kmeans(part, cols, k, max_iter, seed)
            rows.append((int(k), davies_bouldin(model, part)))
    finally:
        part.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, davies_bouldin double")


# ---------------------------------------------------------------- PCA and anomalies


def pca(df: DataFrame, cols: Sequence[str], var: float = 0.95) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Principal components that explain at least ``var`` of the standardised variance.

    Returns the model, the projected rows (``principal_component_1`` …) and one row
    per component with eigenvalue, variance ratios and loadings.
    """
    full = Pipeline(stages=[*_scaled(cols), PCA(k=len(cols), inputCol=FEATURES, outputCol="_pc")]).fit(df)
    ratios = full.stages[-1].explainedVariance.toArray()
    running = np.cumsum(ratios)
    k = int(np.searchsorted(running, var - 1e-12) + 1)
    k = min(k, len(cols))
    scores = full.transform(df).withColumn("_a", vector_to_array("_pc")).select(
        *df.columns, *[F.col("_a")[i].alias(f"principal_component_{i + 1}") for i in range(k)]
    )
    loadings = full.stages[-1].pc.toArray()
    info = df.sparkSession.createDataFrame(
        [
            (i + 1, float(ratios[i] * len(cols)), float(ratios[i]), float(running[i]),
             dict(zip(cols, (float(x) for x in loadings[:, i]))))
            for i in range(k)
        ],
        "principal_component int, eigenvalue double, explained_variance_ratio double, "
        "cumulative_explained_variance_ratio double, loadings map<string,double>",
    )
    return full, scores, info


def reconstruction_error(df: DataFrame, cols: Sequence[str], k: int = 2) -> DataFrame:
    """Mean squared error of rebuilding each standardised row from ``k`` principal components.

    A linear bottleneck: components are orthonormal, so the lost part of a row is its
    squared length minus that of its projection.
    """
    model = Pipeline(stages=[*_scaled(cols), PCA(k=k, inputCol=FEATURES, outputCol="_pc")]).fit(df)

    def length2(v: str) -> Column:
        return F.aggregate(vector_to_array(v), F.lit(0.0), lambda acc, x: acc + x * x)

    error = F.greatest(length2(FEATURES) - length2("_pc"), F.lit(0.0)) / len(cols)
    return model.transform(df).select(*df.columns, error.alias("reconstruction_error"))


def flag_anomalies(errors: DataFrame, q: float = 0.95, accuracy: int = 10000) -> DataFrame:
    """Mark rows whose error exceeds its ``q`` quantile."""
    limit = errors.agg(F.percentile_approx("reconstruction_error", q, accuracy).alias("t")).scalar()
    flag = F.when(F.col("reconstruction_error") > limit, "ANOMALY").otherwise("NORMAL")
    return errors.withColumn("anomaly_flag", flag)


# ---------------------------------------------------------------- recommendation


def als_recommend(
    df: DataFrame, user: str, item: str, rating: str, users: DataFrame | None = None, n: int = 10,
    rank: int = 50, reg: float = 0.1, max_iter: int = 30, seed: int = 42,
) -> DataFrame:
    """Matrix factorisation and the top ``n`` items per requested user (all users if None).

    Numeric ids come from distributed positions, so no list of users or items is collected.
    """
    shared_folder(df.sparkSession)  # ALS checkpoints its long lineage there
    names = {}
    for col, number in ((user, "_u"), (item, "_i")):
        distinct = df.where(F.col(col).isNotNull()).select(col).distinct()
        numbered = positions(distinct, [F.col(col)])
        # The factorisation's ids are 32-bit; more of them would wrap around unnoticed.
        fits = F.when(F.col("pos") < 2**31, F.col("pos").cast("int")).otherwise(
            F.raise_error(F.lit(f"more than 2**31 values of {col}")).cast("int"))
        names[col] = numbered.select(col, fits.alias(number))
    coded = df.join(names[user], user).join(names[item], item).select("_u", "_i", F.col(rating).cast("float"))
    model = ALS(
        userCol="_u", itemCol="_i", ratingCol=rating, rank=rank, regParam=reg, maxIter=max_iter, seed=seed,
        coldStartStrategy="drop",
    ).fit(coded)
    wanted = names[user] if users is None else names[user].join(users.select(user).distinct(), user)
    best = model.recommendForUserSubset(wanted.select("_u"), n)
    return (
        best.select("_u", F.explode("recommendations").alias("r"))
        .select("_u", F.col("r._i").alias("_i"), F.col("r.rating").cast("double").alias("predicted_rating"))
        .join(names[user], "_u")
        .join(names[item], "_i")
        .select(user, item, "predicted_rating")
    )


# ---------------------------------------------------------------- cross-validation and explanation


def train_logistic(
    df: DataFrame, label: str, cols: Sequence[str], max_iter: int = 50, cat_cols: Sequence[str] = (),
    max_values: int = 1000,
) -> PipelineModel:
    """Logistic regression on numeric and categorical columns for a 0/1 label.

    Each value of a categorical column is a 0/1 input (the last one the base; values not seen in training
    count as a value of their own), so that ``explain_linear`` can name it.  More than ``max_values``
    values of a column are refused: hash or bin them first.
    """
    for c in cat_cols:
        if df.select(c).distinct().limit(max_values + 1).count() > max_values:
            raise ValueError(f"{c} has more than {max_values} values")
    stages, parts = _filled(cols)
    if cat_cols:
        codes, flags = [f"_code_{c}" for c in cat_cols], [f"_flag_{c}" for c in cat_cols]
        stages += [
            StringIndexer(inputCols=list(cat_cols), outputCols=codes, stringOrderType="alphabetAsc", handleInvalid="keep"),
            OneHotEncoder(inputCols=codes, outputCols=flags),
        ]
        parts = [*parts, *flags]
    return Pipeline(stages=[
        *stages, VectorAssembler(inputCols=parts, outputCol=FEATURES, handleInvalid="keep"),
        LogisticRegression(labelCol=label, featuresCol=FEATURES, probabilityCol="_prob", rawPredictionCol="_raw",
                           predictionCol="_pred", maxIter=max_iter),
    ]).fit(df)


def positive_score(model: PipelineModel, df: DataFrame, out: str = "score") -> DataFrame:
    return model.transform(df).select(*df.columns, vector_to_array("_prob")[1].alias(out))


def cross_validate(
    df: DataFrame, label: str, cols: Sequence[str], fold: str = "fold", k: int = 5, cat_cols: Sequence[str] = ()
) -> DataFrame:
    """Metrics per fold: train on the other folds, evaluate on this one."""
    data = df.select(F.col(label).cast("double").alias(label), *cols, *cat_cols, fold).persist()
    try:
        rows = []
        for f in range(k):
            model = train_logistic(data.where(F.col(fold) != f), label, cols, cat_cols=cat_cols)
            scored = positive_score(model, data.where(F.col(fold) == f))
            rows.append((f, *eval_metrics(scored, label, "score").first()))
    finally:
        data.unpersist()
    return df.sparkSession.createDataFrame(
        rows,
        "fold int, precision double, recall double, accuracy double, f1_score double, log_loss double, roc_auc double",
    )


def cv_summary(folds: DataFrame) -> DataFrame:
    return folds.agg(
        F.avg("precision").alias("avg_precision"),
        F.avg("recall").alias("avg_recall"),
        F.avg("f1_score").alias("avg_f1"),
        F.avg("roc_auc").alias("avg_roc_auc"),
        F.stddev_samp("roc_auc").alias("sd_roc_auc"),
    )


def explain_linear(
    model: PipelineModel, df: DataFrame, cols: Sequence[str], baseline: DataFrame, top_n: int = 5
) -> DataFrame:
    """Per-row attributions coefficient x (value - baseline mean), largest first.

    Missing numbers count as the median they are replaced by.  A categorical column's share is the
    weight of its value minus the baseline's mean weight.
    """
    weights = [float(w) for w in model.stages[-1].coefficients.toArray()]
    indexer = next((s for s in model.stages if isinstance(s, StringIndexerModel)), None)
    # The model's own filling of missing numbers and its list of category values.
    filled = PipelineModel([s for s in model.stages if isinstance(s, (SQLTransformer, ImputerModel))])
    rows, base = filled.transform(positive_score(model, df)), filled.transform(baseline)
    shares = {c: F.lit(w) * F.col(f"_num_{c}") for c, w in zip(cols, weights)}
    at = len(cols)
    for c, values in zip(indexer.getInputCols() if indexer else [], indexer.labelsArray if indexer else []):
        # One input per value; the value for unseen ones is the base and has none.
        named = [x for v, w in zip(values, weights[at : at + len(values)]) for x in (F.lit(v), F.lit(w))]
        shares[c] = F.coalesce(F.try_element_at(F.create_map(*named), F.col(c)), F.lit(0.0))
        at += len(values)
    means = base.agg(*[F.avg(share).alias(c) for c, share in shares.items()]).first()
    parts = F.array(*[
        F.struct(F.lit(c).alias("feature"), (share - means[c]).alias("attribution")) for c, share in shares.items()
    ])
    by_size = F.array_sort(
        parts,
        lambda a, b: F.when(F.abs(a["attribution"]) > F.abs(b["attribution"]), -1)
        .when(F.abs(a["attribution"]) < F.abs(b["attribution"]), 1)
        .otherwise(0),
    )
    return rows.select(*df.columns, "score", F.slice(by_size, 1, top_n).alias("top_feature_attributions"))


