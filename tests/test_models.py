"""Models on data with a known answer."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import forecast as fc
from millrace.operators import learn as ml


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        c = i % 3
        rows.append((i, float(rng.normal(c * 10, 1)), float(rng.normal(-c * 5, 1)), f"s{c}", int(c == 2), "yes" if c == 2 else "no"))
    return spark.createDataFrame(rows, "id long, x double, y double, place string, label int, name string").persist()


def test_forest_scores_and_reloads(blobs, tmp_path):
    model = ml.train_forest(blobs, "name", ["x", "y"], ["place"], trees=10, depth=4)
    scored = ml.class_probs(model, blobs.drop("name"))
    joined = scored.join(blobs.select("id", "name"), "id")
    assert joined.where(F.col("name") == F.col("predicted_label")).count() >= 595
    first = scored.first()
    assert [e["label"] for e in first["probs"]] == ["no", "yes"]
    assert abs(sum(e["prob"] for e in first["probs"]) - 1) < 1e-9
    ml.save_model(model, str(tmp_path / "m"))
    again = ml.score(ml.load_model(str(tmp_path / "m")), blobs, "yes", "no")
    want = scored.select("id", ml.prob_of(F.col("probs"), "yes").alias("p"))
    both = again.join(want, "id")
    assert both.where(F.abs(F.col("p") - F.col("predicted_probability")) > 1e-12).isEmpty()
    assert both.where((F.col("p") >= 0.4) != (F.col("business_decision") == "yes")).isEmpty()


def test_forest_gives_trees_one_input_per_category(spark):
    """5,000 values, each with a label of its own: two inputs, and new or missing values are told the labels' shares."""
    rng = np.random.default_rng(4)
    side = rng.integers(0, 2, 5000)
    rows = [(f"v{k % 5000}", 0.0, "yes" if side[k % 5000] else "no") for k in range(40000)]
    df = spark.createDataFrame(rows, "place string, x double, name string")
    model = ml.train_forest(df, "name", ["x"], ["place"], trees=5, depth=3)
    assert model.stages[-1].numFeatures == 2
    scored = ml.class_probs(model, df)
    assert scored.where("name = predicted_label").count() > 0.95 * 40000
    odd = spark.createDataFrame([(None, 0.0), ("never seen", 0.0)], "place string, x double")
    probs = [r["probs"][1]["prob"] for r in ml.class_probs(model, odd).collect()]
    assert len(probs) == 2 and probs[0] == probs[1]


def test_forest_tells_no_row_its_own_label(spark):
    """A value of its own for every row and labels by chance: nothing to learn."""
    rng = np.random.default_rng(6)
    rows = [(f"v{k}", float(rng.normal()), "yes" if rng.random() < 0.5 else "no") for k in range(4000)]
    df = spark.createDataFrame(rows, "place string, x double, name string")
    model = ml.train_forest(df, "name", ["x"], ["place"], trees=5, depth=3)
    sure = ml.class_probs(model, df).agg(F.avg(F.abs(F.col("probs")[1]["prob"] - 0.5))).first()[0]
    assert sure < 0.1  # told its own label, it would be near a half


def test_rows_with_missing_features_are_kept(spark, blobs):
    holes = blobs.withColumn("x", F.when(F.col("id") % 5 != 0, F.col("x"))).withColumn(
        "place", F.when(F.col("id") % 7 != 0, F.col("place")))
    forest = ml.train_forest(holes, "name", ["x", "y"], ["place"], trees=5, depth=4)
    scored = ml.score(forest, holes, "yes", "no")
    assert scored.count() == 600 and scored.where("predicted_probability IS NULL").isEmpty()
    assert ml.assign_clusters(ml.train_kmeans(holes, ["x", "y"], 3), holes).count() == 600
    assert ml.pca(holes, ["x", "y"])[1].count() == 600 and ml.reconstruction_error(holes, ["x", "y"], 1).count() == 600
    logistic = ml.train_logistic(holes.withColumn("label", F.col("label").cast("double")), "label", ["x", "y"], cat_cols=["place"])
    out = ml.explain_linear(logistic, holes, ["x", "y"], holes, top_n=3)
    assert out.count() == 600 and out.where(F.exists("top_feature_attributions", lambda e: e["attribution"].isNull())).isEmpty()
    shares = out.select(F.explode("top_feature_attributions").alias("e")).groupBy("e.feature").agg(F.sum("e.attribution").alias("s"))
    assert all(abs(r["s"]) < 1e-6 for r in shares.collect()) and shares.count() == 3  # around the baseline's mean


def test_categories_get_buckets_of_their_own(spark):
    many = spark.range(5000).selectExpr("concat('s', id) AS place")
    assert ml.hash_buckets(many, ["place"]) >= 4 * 4500 and ml.hash_buckets(many.limit(3), ["place"]) == 64
    with pytest.raises(ValueError, match="more than"):
        ml.train_logistic(many.withColumn("y", F.lit(1.0)), "y", [], cat_cols=["place"])


def test_daily_scores_replace_their_day(spark, tmp_path):
    scored = spark.createDataFrame([("a", 0.5, "yes"), ("b", 0.1, "no")], "k string, predicted_probability double, business_decision string")
    for day, rows in (("2024-01-01", scored), ("2024-01-02", scored), ("2024-01-01", scored.limit(1))):
        ml.write_daily_scores(ml.daily_scores(rows, day, ["k"]), str(tmp_path / "s"))
    out = spark.read.parquet(str(tmp_path / "s"))
    assert out.where("score_date = '2024-01-01'").count() == 1 and out.where("score_date = '2024-01-02'").count() == 2
    assert out.select("trip_key").distinct().count() == 3


def test_clusters(blobs):
    model = ml.train_kmeans(blobs, ["x", "y"], 3)
    profile = ml.cluster_profile(ml.assign_clusters(model, blobs), {"x": "mean_x"}).collect()
    assert sorted(r["members"] for r in profile) == [200, 200, 200] and {r["cluster_id"] for r in profile} == {1, 2, 3}
    by_k = {r["k"]: r["davies_bouldin"] for r in ml.select_k(blobs, ["x", "y"], ks=(2, 3, 5), fraction=0.9).collect()}
    assert min(by_k, key=by_k.get) == 3


def test_pca_and_reconstruction(spark):
    rng = np.random.default_rng(2)
    z = rng.normal(size=400)
    rows = [(i, float(a), float(2 * a + rng.normal() * 0.01), float(rng.normal())) for i, a in enumerate(z)]
    rows.append((400, 3.0, -6.0, 0.0))  # breaks the pattern
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    _, scores, info = ml.pca(df, ["a", "b", "c"])
    m = np.array([r[1:] for r in rows])
    eigen = np.sort(np.linalg.eigvalsh(np.corrcoef(m.T)))[::-1]
    got = [r["eigenvalue"] for r in info.orderBy("principal_component").collect()]
    assert np.allclose(got, eigen[: len(got)], atol=1e-6) and len(got) == 2
    assert scores.columns[-1] == "principal_component_2"
    worst = ml.flag_anomalies(ml.reconstruction_error(df, ["a", "b", "c"], 2)).orderBy(F.desc("reconstruction_error")).first()
    assert worst["id"] == 400 and worst["anomaly_flag"] == "ANOMALY"


def test_tuning_and_pareto(spark, blobs):
    models, trials = ml.tune_gbt(blobs, "label", ["x", "y"], n_trials=3, split_key="id", rounds=3)
    assert len(models) == 3 and trials.count() == 3
    assert trials.agg(F.max("roc_auc")).first()[0] > 0.95
    table = spark.createDataFrame([(1, 0.9, 0.1), (2, 0.5, 0.5), (3, 0.4, 0.4), (4, 0.1, 0.9), (5, 0.5, 0.5), (6, 0.9, 0.05)],
                                  "trial_id int, precision double, recall double")
    front = {r["trial_id"] for r in ml.pareto(table, "precision", "recall").collect()}
    rows = [tuple(r) for r in table.collect()]
    want = {a[0] for a in rows if not any(b[1] >= a[1] and b[2] >= a[2] and b[1:] != a[1:] for b in rows)}
    assert front == want
    assert ml.random_trials({"a": (0, 1), "b": [1, 2]}, 4, 1) == ml.random_trials({"a": (0, 1), "b": [1, 2]}, 4, 1)


def test_boosted_trees_tell_many_categories_apart(spark):
    """More values than any cap on buckets, each with a label of its own."""
    rng = np.random.default_rng(4)
    side = rng.integers(0, 2, 3000)
    rows = [(k, f"v{k % 3000}", 0.0, int(side[k % 3000])) for k in range(24000)]
    df = spark.createDataFrame(rows, "id int, place string, x double, y int")
    trials = ml.tune_gbt(df, "y", ["x"], ["place"], n_trials=1, split_key="id", rounds=2)[1]
    assert trials.first()["roc_auc"] > 0.95


def test_boosted_trees_train_on_cells(spark, monkeypatch):
    """Training rows that trees can't tell apart come as one, with their number as its weight."""
    seen = []
    fit = ml.GBTClassifier.fit
    monkeypatch.setattr(ml.GBTClassifier, "fit", lambda self, df: seen.append(df.collect()) or fit(self, df))
    df = spark.range(20000).selectExpr("id", "double(id % 50) AS x", "int(id % 50 >= 25) AS y")
    trials = ml.tune_gbt(df, "y", ["x"], n_trials=1, split_key="id", rounds=2)[1]
    assert len(seen[0]) <= 2 * ml.BINS and 15000 < sum(r["_weight"] for r in seen[0]) < 17000
    assert trials.first()["roc_auc"] > 0.99


def test_target_encoding_sees_no_label_of_its_own_part(spark):
    rng = np.random.default_rng(5)
    rows = [(int(k), None if k % 11 == 0 else f"c{int(rng.integers(0, 6))}", int(rng.integers(0, 5)), float(rng.integers(0, 2)))
            for k in range(200)] + [(200, "only held out", 0, 1.0)]
    df = spark.createDataFrame(rows, f"id int, c string, _part int, {ml.LABEL} double")
    got = {r["id"]: r["e"] for r in ml._target_encoded(df, {"c": "e"}).collect()}
    assert len(got) == len(rows)
    for k, c, part, _ in rows:
        seen = [r for r in rows if r[2] not in (0, part)]
        mine = [r[3] for r in seen if r[1] == c and c is not None]
        prior = sum(r[3] for r in seen) / len(seen)
        assert got[k] == pytest.approx((sum(mine) + 20 * prior) / (len(mine) + 20))


def test_recommendations_follow_taste(spark):
    rows = [(f"u{u}", f"i{i}", 5 if (u % 2) == (i % 2) else 1) for u in range(20) for i in range(10) if (u + i) % 7]
    df = spark.createDataFrame(rows, "user string, item string, rating int")
    one = spark.createDataFrame([("u3",)], "user string")
    out = ml.als_recommend(df, "user", "item", "rating", one, n=3, rank=4, max_iter=8).collect()
    assert len(out) == 3 and {r["user"] for r in out} == {"u3"} and all(int(r["item"][1:]) % 2 for r in out)


def test_cross_validation_and_explanation(blobs):
    from millrace.operators.features import kfold

    folds = ml.cross_validate(kfold(blobs, "id", 3), "label", ["x", "y"], k=3)
    assert folds.count() == 3 and ml.cv_summary(folds).first()["avg_roc_auc"] > 0.99
    model = ml.train_logistic(blobs.withColumn("label", F.col("label").cast("double")), "label", ["x", "y"])
    row = ml.explain_linear(model, blobs.where("id = 2"), ["x", "y"], blobs, top_n=2).first()
    parts = row["top_feature_attributions"]
    assert abs(parts[0]["attribution"]) >= abs(parts[1]["attribution"])
    means = blobs.agg(F.avg("x"), F.avg("y")).first()
    weights = model.stages[-1].coefficients.toArray()
    want = {"x": weights[0] * (row["x"] - means[0]), "y": weights[1] * (row["y"] - means[1])}
    assert all(np.isclose(p["attribution"], want[p["feature"]]) for p in parts)


def test_forecasts_continue_trend_and_week(spark):
    import datetime as dt

    def value(i):
        return 100 + 2 * i + (30 if i % 7 == 0 else 0)

    start = dt.date(2024, 1, 1)
    rows = [("s", start + dt.timedelta(days=i), float(value(i))) for i in range(140) if i != 50]
    rows += [("flat", start + dt.timedelta(days=i), 5.0) for i in range(10)]
    df = spark.createDataFrame(rows, "series string, day date, y double")
    for make in (fc.forecast_ar, fc.forecast_trend_weekday):
        out = make(df, "series", "day", "y", horizon=14).orderBy("forecast_timestamp").collect()
        s = [r for r in out if r["series"] == "s"]
        flat = [r for r in out if r["series"] == "flat"]
        assert len(s) == len(flat) == 14 and s[0]["forecast_timestamp"] == start + dt.timedelta(days=140)
        assert max(abs(r["forecast_value"] - value(140 + i)) for i, r in enumerate(s)) < 8
        assert all(abs(r["forecast_value"] - 5) < 1e-6 for r in flat)
        assert all(r["prediction_interval_lower_bound"] <= r["forecast_value"] <= r["prediction_interval_upper_bound"] for r in out)


def test_few_rows_grow_trees_in_few_tasks(spark, monkeypatch):
    """A level of a tree is a job: tasks go by the rows there are, whatever the session's number of partitions."""
    from pyspark.ml.classification import GBTClassifier

    from millrace.operators import learn

    rows = spark.range(2000, numPartitions=8).select(
        "id", (F.col("id") % 40).alias("x"), (F.col("id") % 7).alias("z"), (F.col("id") % 2).cast("int").alias("y"))
    seen, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df: seen.append((df.rdd.getNumPartitions(), df.count())) or fit(self, df))
    learn.tune_gbt(rows, "y", ["x", "z"], space={"maxDepth": [2]}, n_trials=1, rounds=1, split_key="id")
    monkeypatch.setattr(learn, "ROWS_PER_TASK", 100)
    learn.tune_gbt(rows, "y", ["x", "z"], space={"maxDepth": [2]}, n_trials=1, rounds=1, split_key="id")
    (few, n), (many, m) = seen
    assert few == 1 and n == m and many == -(-m // 100) > 1
