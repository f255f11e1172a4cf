"""Model training, scoring, tuning, explaining and forecasting."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import arima
from millrace.operators import autoencoder as ae
from millrace.operators import features as f
from millrace.operators import forecast as fc
from millrace.operators import learn as ml
from millrace.registry.core import query, r, r_sql
from millrace.registry.features import PLACES_SQL, RATINGS_SQL, daily_by_flag, places, ratings, trips
from millrace.session import materialize, work_path

RUN_DATE = dt.date(2024, 1, 30)
NUMBERS = ["tripduration", "start_hour", "day_of_week"]
PLACE_COLS = ["total_trips", "avg_duration", "stddev_duration", "active_days", "avg_start_hour", "user_types"]


def labelled_trips(t):
    """Trips labelled as purchase or other; all durations count."""
    rows = f.trip_features(trips(t), "usertype", "tripduration", "starttime", "start_station_name", low=0, high=1e9)
    kind = F.when(F.col("usertype") == "purchase", "Subscriber").otherwise("Customer")
    return rows.withColumn("usertype", kind)


def forest(t):
    return ml.train_forest(labelled_trips(t), "usertype", NUMBERS, ["start_station_name"])


# What a fitted model gives depends on its random draws.  The keys below hand out what is determined all the
# same (rows, keys, sums that any fit has to keep) and flags that compare the outputs with each other.

LABELLED_SQL = """trips AS (
  SELECT CASE WHEN event_type = 'purchase' THEN 'Subscriber' ELSE 'Customer' END AS usertype, value AS tripduration,
         ts AS starttime, hour(ts) AS start_hour, 'station_' || user_id AS start_station_name
  FROM events WHERE event_type IS NOT NULL AND value BETWEEN 0 AND 1e9)"""


def probability(col):
    return F.coalesce(col.between(0, 1), F.lit(False))


@query("forest_train_predict", f"""
WITH {LABELLED_SQL}
SELECT usertype, count(*) AS row_count, true AS known_labels, true AS more_right_than_wrong FROM trips GROUP BY 1""")
def _(t):
    scored = ml.class_probs(forest(t), labelled_trips(t))
    counted = scored.groupBy("usertype", "predicted_label").agg(F.count(F.lit(1)).alias("n"))
    right = F.sum(F.when(F.col("usertype") == F.col("predicted_label"), F.col("n")).otherwise(0))
    total = counted.agg(right.alias("right"), F.sum("n").alias("all"))
    return counted.groupBy("usertype").agg(
        F.sum("n").alias("row_count"),
        F.bool_and(F.col("predicted_label").isin("Subscriber", "Customer")).alias("known_labels"),
    ).withColumn("more_right_than_wrong", total.select(2 * F.col("right") > F.col("all")).scalar())


@query("forest_predict", f"""
WITH {LABELLED_SQL}
SELECT least(20, count(*)) AS row_count, true AS sums_to_one, true AS best_first FROM trips""")
def _(t):
    """The 20 rows with the highest probability: none of the others has a higher one."""
    scored = ml.class_probs(forest(t), labelled_trips(t))
    top = ml.top_by_prob(scored, 1, ["starttime", "start_station_name"], 20)
    whole = F.aggregate("probs", F.lit(0.0), lambda acc, e: acc + e["prob"])
    highest = scored.agg(F.max(F.col("probs")[1]["prob"])).scalar()
    return top.agg(
        F.count(F.lit(1)).alias("row_count"), F.bool_and(F.abs(whole - 1) < 1e-9).alias("sums_to_one"),
        (F.max(F.col("probs")[1]["prob"]) == highest).alias("best_first"))


@query("scored_view", f"""
WITH {LABELLED_SQL}
SELECT 'Subscriber' AS label, tripduration, start_station_name, start_hour, true AS decided FROM trips""")
def _(t):
    p = F.col("predicted_probability")
    follows = F.col("business_decision") == F.when(p >= 0.4, "Subscriber").otherwise("Customer")
    scored = ml.score(forest(t), labelled_trips(t), "Subscriber", "Customer")
    return scored.select(
        "label", "tripduration", "start_station_name", "start_hour", (probability(p) & follows).alias("decided"))


def gappy_trips(t):
    """Trips of which a third lack their duration and a seventh their station."""
    rows = labelled_trips(t)
    hole = F.pmod(F.xxhash64("starttime", "start_station_name"), F.lit(21))
    return rows.withColumn("tripduration", F.when(hole % 3 != 0, F.col("tripduration"))).withColumn(
        "start_station_name", F.when(hole % 7 != 0, F.col("start_station_name")))


@query("scored_view_missing", """
SELECT CASE WHEN event_type = 'purchase' THEN 'Subscriber' ELSE 'Customer' END AS usertype, count(*) AS row_count,
       true AS all_scored FROM events
WHERE event_type IS NOT NULL AND value BETWEEN 0 AND 1e9 GROUP BY 1""")
def _(t):
    """Every row has a score, whatever it lacks."""
    scored = ml.score(forest(t), gappy_trips(t), "Subscriber", "Customer")
    p = F.col("predicted_probability")
    fine = p.between(0, 1) & (F.col("business_decision") == F.when(p >= 0.4, "Subscriber").otherwise("Customer"))
    return scored.groupBy("usertype").agg(
        F.count(F.lit(1)).alias("row_count"), F.bool_and(F.coalesce(fine, F.lit(False))).alias("all_scored"))


@query("daily_scores_append", f"""
WITH {LABELLED_SQL}
SELECT md5('2024-01-30|' || start_station_name || '|' || CAST(starttime AS VARCHAR)) AS trip_key,
       '2024-01-30' AS score_date, true AS decided
FROM trips WHERE CAST(starttime AS DATE) = DATE '2024-01-30'""")
def _(t):
    """Score one day twice into the same folder: the second run replaces the first."""
    lo = dt.datetime.combine(RUN_DATE, dt.time())
    day = labelled_trips(t).where(
        (F.col("starttime") >= F.lit(lo)) & (F.col("starttime") < F.lit(lo + dt.timedelta(days=1)))
    )
    path = work_path(t.spark, "scores")
    scores = ml.daily_scores(
        ml.score(forest(t), day, "Subscriber", "Customer"), RUN_DATE, ["start_station_name", "starttime"]
    )
    ml.write_daily_scores(scores, path)
    ml.write_daily_scores(scores, path)
    p = F.col("predicted_probability")
    follows = F.col("predicted_label") == F.when(p >= 0.4, "Subscriber").otherwise("Customer")
    return t.spark.read.parquet(path).select(
        "trip_key", F.col("score_date").cast("string").alias("score_date"), (probability(p) & follows).alias("decided"))


@query("kmeans_profile", f"""
WITH p AS ({PLACES_SQL})
SELECT least(count(*), 5) AS most_clusters, count(*) AS members, true AS numbered,
       {r_sql("sum(total_trips)", 3)} AS trips FROM p""")
def _(t):
    """Clusters take in every place once; their members' trips add up."""
    data = materialize(places(t))  # medians, scaling, each step of the clustering and the profile read it
    assigned = ml.assign_clusters(ml.train_kmeans(data, PLACE_COLS), data)
    profile = ml.cluster_profile(
        assigned, {"total_trips": "avg_trips_per_station", "avg_duration": "avg_trip_duration"})
    trips_ = assigned.agg(F.sum("total_trips")).scalar()
    return profile.agg(
        F.count(F.lit(1)).alias("most_clusters"),
        F.coalesce(F.sum("members"), F.lit(0)).alias("members"),
        F.coalesce(F.bool_and(F.col("cluster_id").between(1, 5)), F.lit(True)).alias("numbered"),
        r(trips_.cast("double"), 3).alias("trips"))


@query("kmeans_select_k", """
SELECT unnest([3, 5, 7, 10]) AS k, count(*) > 0 AS measured FROM lineitem""")
def _(t):
    """Every line's measures; the operator itself takes a 20 % sample."""
    found = ml.select_k(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    return found.select("k", (F.col("davies_bouldin") > 0).alias("measured"))


def line_measures(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

#: Entries of the measures' correlation matrix, and the traces of its powers.
CORRELATION_SQL = """m AS (
  SELECT """ + ", ".join(f"corr({a}, {b}) AS r{i}{j}" for i, a in enumerate(MEASURES) for j, b in enumerate(MEASURES)) + """
  FROM lineitem), r AS (""" + " UNION ALL ".join(
    f"SELECT {i} AS i, {j} AS j, r{i}{j} AS v FROM m" for i in range(4) for j in range(4)) + """),
r2 AS (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM r a JOIN r b ON a.j = b.i GROUP BY 1, 2),
r3 AS (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM r2 a JOIN r b ON a.j = b.i GROUP BY 1, 2),
r4 AS (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM r2 a JOIN r2 b ON a.j = b.i GROUP BY 1, 2)"""


@query("pca_project", """
SELECT l_orderkey, l_linenumber, 4.0::DOUBLE AS components,
       true AS same_length FROM lineitem""")
def _(t):
    """All components: a turn of the standardised row, so its length stays."""
    model, scores, _info = ml.pca(line_measures(t), MEASURES, var=1.0)
    parts = [c for c in scores.columns if c.startswith("principal_component_")]
    square = sum((F.col(c) * F.col(c) for c in parts[1:]), F.col(parts[0]) * F.col(parts[0]))
    stats = line_measures(t).agg(*[f_(c).alias(f"{n}_{c}") for c in MEASURES for n, f_ in (("m", F.avg), ("s", F.stddev))]).first()
    z = [(F.col(c) - stats[f"m_{c}"]) / stats[f"s_{c}"] for c in MEASURES]
    length = sum((v * v for v in z[1:]), z[0] * z[0])
    # Scores aren't centred by the projection itself; the scaler has centred the rows.
    return scores.select("l_orderkey", "l_linenumber", F.lit(float(len(parts))).alias("components"),
                         (F.abs(square - length) < 1e-6 * (1 + length)).alias("same_length"))


@query("pca_info", f"""
WITH {CORRELATION_SQL}
SELECT 1 AS power, {r_sql("sum(v)", 6)} AS eigenvalue_sum FROM r WHERE i = j
UNION ALL SELECT 2, {r_sql("sum(v)", 6)} FROM r2 WHERE i = j
UNION ALL SELECT 3, {r_sql("sum(v)", 6)} FROM r3 WHERE i = j
UNION ALL SELECT 4, {r_sql("sum(v)", 6)} FROM r4 WHERE i = j""")
def _(t):
    """Sums of the powers of all eigenvalues, which determine them: the traces of the matrix's powers."""
    info = ml.pca(line_measures(t), MEASURES, var=1.0)[2]
    powers = info.select(F.explode(F.array(*[F.lit(k) for k in range(1, 5)])).alias("power"), "eigenvalue")
    return powers.groupBy("power").agg(r(F.sum(F.pow("eigenvalue", F.col("power"))), 6).alias("eigenvalue_sum"))


@query("anomaly_reconstruction", """
SELECT count(*) AS row_count, true AS errors_are_lengths, true AS flags_follow FROM lineitem""")
def _(t):
    """Every row has an error, flagged beyond the limit; about a twentieth is."""
    flagged = ml.flag_anomalies(ml.reconstruction_error(line_measures(t), MEASURES, k=2))
    odd = F.col("anomaly_flag") == "ANOMALY"
    share = F.count_if(odd) / F.count(F.lit(1))
    apart = F.coalesce(F.min(F.when(odd, F.col("reconstruction_error"))), F.lit(float("inf"))) >= F.coalesce(
        F.max(F.when(~odd, F.col("reconstruction_error"))), F.lit(0.0))
    return flagged.agg(
        F.count(F.lit(1)).alias("row_count"), F.bool_and(F.col("reconstruction_error") >= 0).alias("errors_are_lengths"),
        (apart & (share <= 0.051) & (share >= 0.02)).alias("flags_follow"))


@query("anomaly_autoencoder")
def _(t):
    """Every order line with the error of its measures behind a bottleneck of two units, flagged in the top twentieth."""
    rows = line_measures(t)
    model = ae.train_autoencoder(rows, MEASURES, rounds=8, batch=512)
    return ml.flag_anomalies(ae.reconstruct(model, rows))


@query("als_recommend", f"""
WITH r AS ({RATINGS_SQL})
SELECT user_id, least(10, (SELECT count(DISTINCT item_id) FROM r)) AS items, true AS rated FROM r GROUP BY user_id""")
def _(t):
    """Ten different items for every user."""
    best = ml.als_recommend(ratings(t), "user_id", "item_id", "rating")
    return best.groupBy("user_id").agg(
        F.count_distinct("item_id").alias("items"),
        F.bool_and(~F.isnan("predicted_rating") & F.col("predicted_rating").isNotNull()).alias("rated"))


METRICS = ("precision", "recall", "accuracy", "f1_score", "roc_auc")


def metrics_fit(col=F.col):
    """Metrics are shares, or missing where nothing was predicted."""
    fine = F.lit(True)
    for name in METRICS:
        fine = fine & (col(name).isNull() | col(name).between(0, 1))
    return fine & (col("log_loss") >= 0)


@query("gbt_tune_trials", "SELECT unnest(range(1, 21)) AS trial_id, count(*) > 0 AS in_space, true AS metrics_fit FROM events")
def _(t):
    data = labelled_trips(t).withColumn("y", (F.col("usertype") == "Subscriber").cast("int"))
    trials = ml.tune_gbt(data, "y", NUMBERS, ["start_station_name"], split_key="starttime")[1]
    inside = (F.col("stepSize").between(0.01, 0.3) & F.col("maxDepth").isin(4, 6, 8, 10)
              & F.col("subsamplingRate").between(0.6, 1.0))
    return trials.select(F.col("trial_id").cast("bigint").alias("trial_id"), inside.alias("in_space"),
                         metrics_fit().alias("metrics_fit"))


@query("pareto_trials", "SELECT count(*) > 0 AS some, true AS none_beaten FROM lineitem")
def _(t):
    """No trial on the front is beaten by any trial."""
    data = line_measures(t).withColumn("y", (F.col("l_tax") > 0.06).cast("int"))
    space = {"maxDepth": [3, 4, 5, 6], "minInstancesPerNode": [1, 3, 5], "stepSize": (0.05, 0.3)}
    trials = ml.tune_gbt(
        data, "y", ["l_quantity", "l_extendedprice", "l_discount"], space=space, n_trials=15, parallelism=3,
        split_key="l_orderkey",
    )[1].fillna(0.0, ["precision"])
    front = ml.pareto(trials, "precision", "recall").select("trial_id", "precision", "recall")
    other = trials.select(F.col("precision").alias("p"), F.col("recall").alias("q"))
    beaten = front.join(other, (F.col("p") >= F.col("precision")) & (F.col("q") >= F.col("recall"))
                        & ((F.col("p") > F.col("precision")) | (F.col("q") > F.col("recall"))), "left_semi")
    return front.agg((F.count(F.lit(1)) > 0).alias("some")).withColumn(
        "none_beaten", beaten.agg(F.count(F.lit(1)) == 0).scalar())


RETURN_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def return_rows(t):
    data = t.lineitem.withColumn("returned", (F.col("l_returnflag") == "R").cast("double"))
    data = data.withColumn("line_place", F.concat(F.lit("line "), F.col("l_linenumber").cast("string")))
    return f.kfold(data, "l_orderkey").select(
        "returned", *RETURN_COLS, "line_place", "fold", "l_orderkey", "l_linenumber")


@query("cross_validation", "SELECT unnest(range(5)) AS fold, count(*) > 0 AS metrics_fit FROM lineitem")
def _(t):
    folds = ml.cross_validate(return_rows(t), "returned", RETURN_COLS, cat_cols=["line_place"])
    return folds.select(F.col("fold").cast("bigint").alias("fold"), metrics_fit().alias("metrics_fit"))


@query("cv_summary", "SELECT count(*) > 0 AS means_lie_inside, true AS spread_fits FROM lineitem")
def _(t):
    """Means lie between the folds' least and greatest values."""
    folds = ml.cross_validate(return_rows(t), "returned", RETURN_COLS, cat_cols=["line_place"])
    lines = folds.agg(*[g(c).alias(f"{n}_{c}") for c in ("recall", "f1_score", "roc_auc") for n, g in (("lo", F.min), ("hi", F.max))])
    inside = F.lit(True)
    for out, c in (("avg_recall", "recall"), ("avg_f1", "f1_score"), ("avg_roc_auc", "roc_auc")):
        value, lo, hi = F.col(out), F.col(f"lo_{c}"), F.col(f"hi_{c}")
        inside = inside & (lo.isNull() | value.between(lo - 1e-9, hi + 1e-9))
    both = ml.cv_summary(folds).join(F.broadcast(lines))  # two tables of one row
    return both.select(inside.alias("means_lie_inside"), (
        (F.col("sd_roc_auc") >= 0) & (F.col("sd_roc_auc") <= F.col("hi_roc_auc") - F.col("lo_roc_auc") + 1e-9)).alias("spread_fits"))


@query("explain_linear", """
SELECT unnest(['l_quantity', 'l_extendedprice', 'l_discount', 'l_tax', 'line_place']) AS feature, count(*) AS row_count,
       0.0 AS total FROM lineitem""")
def _(t):
    """Attributions are taken around the baseline's mean, so those of the baseline's own rows add up to zero."""
    data = return_rows(t)
    model = ml.train_logistic(data, "returned", RETURN_COLS, cat_cols=["line_place"])
    explained = ml.explain_linear(model, data, RETURN_COLS, data, top_n=5)
    parts = explained.select(F.explode("top_feature_attributions").alias("e"))
    return parts.groupBy("e.feature").agg(
        F.count(F.lit(1)).alias("row_count"), F.abs(F.round(F.sum("e.attribution"), 6)).cast("decimal(2,1)").alias("total"))


@query("forecast_ar", """
WITH d AS (SELECT l_returnflag, max(CAST(l_shipdate AS DATE)) AS last FROM lineitem GROUP BY 1)
SELECT l_returnflag, CAST(last + CAST(n AS INTEGER) AS VARCHAR) AS forecast_timestamp, true AS inside_interval
FROM d, range(1, 31) AS s(n)""")
def _(t):
    """Thirty days after each series' last, the forecast inside its interval."""
    out = fc.forecast_ar(daily_by_flag(t), "l_returnflag", "day", "n")
    return out.select("l_returnflag", F.col("forecast_timestamp").cast("string").alias("forecast_timestamp"),
                      F.col("forecast_value").between(F.col("prediction_interval_lower_bound"),
                                                      F.col("prediction_interval_upper_bound")).alias("inside_interval"))


@query("forecast_arima")
def _(t):
    """Thirty days of every series by its automatic seasonal ARIMA model."""
    return arima.forecast_arima(daily_by_flag(t), "l_returnflag", "day", "n")
