"""Feature engineering, evaluation of scores, skew and drift."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.functions import constants as c
from millrace.functions.exprs import EARTH_RADIUS_M
from millrace.operators import evaluate as ev
from millrace.operators import features as f
from millrace.operators import forecast as fc
from millrace.operators import learn
from millrace.registry.core import query, r, r_sql
from millrace.registry.statistics import rounded

HASH_SQL = "CAST('0x' || substr(md5({}), 1, 15) AS BIGINT)"


@query("one_hot", """
SELECT event_id, event_type, CAST(event_type = 'click' AS INTEGER) AS type_click,
       CAST(event_type = 'purchase' AS INTEGER) AS type_purchase FROM events WHERE event_type IS NOT NULL""")
def _(t):
    return f.one_hot(t.events.select("event_id", "event_type"), "event_type", ["click", "purchase"], "type")


@query("frequency_encoding", """
SELECT p_partkey, p_type, count(*) OVER (PARTITION BY p_type) AS p_type_freq FROM part""")
def _(t):
    return f.frequency_encode(t.part.select("p_partkey", "p_type"), "p_type")


@query("feature_hashing", f"""
SELECT p_partkey, p_name, {HASH_SQL.format('p_name')} % 1024 AS p_name_bucket_1024 FROM part
WHERE p_name IS NOT NULL""")
def _(t):
    return f.hash_feature(t.part.select("p_partkey", "p_name"), "p_name")


STOP_SQL = ", ".join(f"'{w}'" for w in c.STOPWORDS)


def tokens_sql(clean: str) -> str:
    return f"""
WITH w AS (
  SELECT unnest(string_split({clean}, ' ')) AS token FROM documents)
SELECT token, count(*) AS n FROM w
WHERE token <> '' AND token NOT IN ({STOP_SQL}) GROUP BY token"""


def token_counts(t, compat):
    return f.tokens(t.documents, "doc_id", "text", compat=compat).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query("tokens_no_stopwords", tokens_sql("regexp_replace(lower(text), '[^a-z0-9 ]', '', 'g')"))
def _(t):
    return token_counts(t, compat=False)


@query("tokens_no_stopwords_compat", tokens_sql("lower(regexp_replace(text, '[^a-z0-9 ]', '', 'g'))"))
def _(t):
    return token_counts(t, compat=True)


@query("char_trigrams", """
WITH d AS (SELECT regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS s FROM documents),
g AS (SELECT substr(s, unnest(range(1, length(s) - 1)), 3) AS ngram FROM d WHERE length(s) >= 3)
SELECT ngram, count(*) AS n FROM g GROUP BY ngram""")
def _(t):
    return f.char_ngrams(t.documents, "doc_id", "text").groupBy("ngram").agg(F.count(F.lit(1)).alias("n"))


def cut_sql(i: int) -> str:
    return f"max(CASE WHEN rn = floor({i / 10} * (n - 1)) THEN value END)" \
           f" + (max(CASE WHEN rn = ceil({i / 10} * (n - 1)) THEN value END)" \
           f" - max(CASE WHEN rn = floor({i / 10} * (n - 1)) THEN value END))" \
           f" * max({i / 10}::DOUBLE * (n - 1) - floor({i / 10}::DOUBLE * (n - 1))) AS q{i}"


@query("equal_freq_bins", f"""
WITH o AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS rn, count(*) OVER () AS n FROM events),
b AS (SELECT {", ".join(cut_sql(i) for i in range(1, 10))} FROM o)
SELECT event_id, value, CASE {" ".join(f"WHEN value < q{i} THEN {i}" for i in range(1, 10))} ELSE 10 END AS bin
FROM events, b""")
def _(t):
    return f.equal_freq_bins(t.events.select("event_id", "value"), "value")


@query("equal_width_bins", """
WITH s AS (SELECT min(value) AS lo, (max(value) - min(value)) / 10 AS width FROM events)
SELECT event_id, value,
       CASE WHEN width = 0 THEN 1 ELSE least(10, 1 + CAST(floor((value - lo) / width) AS INTEGER)) END AS bin
FROM events, s""")
def _(t):
    return f.equal_width_bins(t.events.select("event_id", "value"), "value")


@query("kfold_split", f"""
SELECT o_orderkey, {HASH_SQL.format('CAST(o_orderkey AS VARCHAR)')} % 5 AS fold FROM orders""")
def _(t):
    return f.kfold(t.orders.select("o_orderkey"), "o_orderkey")


def priced_lines(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey",
                              F.col("l_extendedprice").cast("decimal(18,2)").alias("price"))
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("category"))
    return f.kfold(lines.join(parts, "l_partkey"), "l_orderkey")


@query("target_encoding_oof", f"""
WITH i AS (
  SELECT l_orderkey, l_linenumber, l_partkey, p_type AS category, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
         {HASH_SQL.format('CAST(l_orderkey AS VARCHAR)')} % 5 AS fold
  FROM lineitem JOIN part ON l_partkey = p_partkey),
cf AS (SELECT category, fold, CAST(sum(price) AS DOUBLE) AS s, count(*) AS n FROM i GROUP BY 1, 2),
c AS (SELECT category, sum(s) AS s, sum(n) AS n FROM cf GROUP BY 1),
f AS (SELECT fold, sum(s) AS s, sum(n) AS n FROM cf GROUP BY 1),
g AS (SELECT sum(s) AS s, sum(n) AS n FROM cf)
SELECT i.l_orderkey, i.l_linenumber, i.l_partkey, i.category, i.fold, CAST(i.price AS DOUBLE) AS price,
       {r_sql('(c.s - cf.s + 20 * ((g.s - f.s) / (g.n - f.n))) / (c.n - cf.n + 20)', 4)} AS category_target_enc
FROM i JOIN cf USING (category, fold) JOIN c USING (category) JOIN f USING (fold), g""")
def _(t):
    out = f.target_encode_oof(priced_lines(t), "category", "price", "fold")
    return rounded(out.withColumn("price", F.col("price").cast("double")), {"category_target_enc": 4})


#: Made-up coordinates of trips, in degrees: a multiplier of the user's number for each.
POINTS = [(7, "lon_a"), (11, "lat_a"), (13, "lon_b"), (17, "lat_b")]


def trips(t):
    """Events as trips; the value is the duration."""
    return t.events.select(
        "event_id", F.col("event_type").alias("usertype"), F.col("value").alias("tripduration"),
        F.col("ts").alias("starttime"),
        F.concat(F.lit("station_"), F.col("user_id").cast("string")).alias("start_station_name"),
        *[((F.col("user_id") * k % 3600) / 20.0 - 90.0).alias(n) for k, n in POINTS],
    )


POINTS_SQL = ", ".join(f"radians(user_id * {k} % 3600 / 20.0::DOUBLE - 90.0::DOUBLE) AS {n}" for k, n in POINTS)


@query("classification_features", f"""
WITH p AS (SELECT *, {POINTS_SQL} FROM events WHERE event_type IS NOT NULL AND value BETWEEN 60 AND 7200),
h AS (SELECT *, pow(sin((lat_b - lat_a) / 2), 2) + cos(lat_a) * cos(lat_b) * pow(sin((lon_b - lon_a) / 2), 2) AS h FROM p)
SELECT event_type AS usertype, value AS tripduration, CAST(ts AS VARCHAR) AS starttime, hour(ts) AS start_hour,
       dayofweek(ts) + 1 AS day_of_week, 'station_' || user_id AS start_station_name,
       {r_sql(f"{2 * EARTH_RADIUS_M} * asin(sqrt(least(h, 1.0)))", 2)} AS distance_m FROM h""")
def _(t):
    out = f.trip_features(trips(t), "usertype", "tripduration", "starttime", "start_station_name",
                          start_point=("lon_a", "lat_a"), end_point=("lon_b", "lat_b"))
    return rounded(out.withColumn("starttime", F.col("starttime").cast("string")), {"distance_m": 2})


def places(t):
    """Per-supplier aggregates of order lines."""
    return f.entity_features(t.lineitem, "l_suppkey", "l_extendedprice", "l_shipdate", "l_returnflag",
                             min_rows=100, low=1000, high=100000)


PLACES_SQL = f"""
SELECT l_suppkey, count(*) AS total_trips, {r_sql('avg(l_extendedprice)', 5)} AS avg_duration,
       {r_sql('stddev_samp(l_extendedprice)', 5)} AS stddev_duration,
       count(DISTINCT CAST(l_shipdate AS DATE)) AS active_days, avg(hour(l_shipdate)) AS avg_start_hour,
       count(DISTINCT l_returnflag) AS user_types
FROM lineitem WHERE l_extendedprice BETWEEN 1000 AND 100000 GROUP BY 1 HAVING count(*) >= 100"""


@query("station_features", PLACES_SQL)
def _(t):
    return rounded(places(t), {"avg_duration": 5, "stddev_duration": 5})


def ratings(t):
    return f.interactions(t.lineitem, ["l_suppkey", "l_partkey"], "l_partkey")


RATINGS_SQL = f"""
SELECT 'user_' || ({HASH_SQL.format("CAST(l_suppkey AS VARCHAR) || CAST(l_partkey AS VARCHAR)")} % 10000) AS user_id,
       l_partkey AS item_id, least(count(*), 5) AS rating
FROM lineitem GROUP BY 1, 2 HAVING count(*) >= 2"""


@query("interactions", RATINGS_SQL)
def _(t):
    return ratings(t)


@query("daily_volume", """
SELECT CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS trip_date, count(*) AS daily_trips,
       avg(CAST(round(l_extendedprice * 100) AS BIGINT)) AS avg_duration, count(DISTINCT l_suppkey) AS active_places,
       max(CAST(dayofweek(l_shipdate) IN (0, 6) AS INTEGER)) AS is_weekend
FROM lineitem GROUP BY 1""")
def _(t):
    # Whole cents: their sums are exact, so the means agree to the last bit.
    lines = t.lineitem.withColumn("cents", F.round(F.col("l_extendedprice") * 100).cast("bigint"))
    out = f.daily_series(lines, "l_shipdate", "cents", "l_suppkey")
    return out.withColumn("trip_date", F.col("trip_date").cast("string"))


# ---- evaluation: 'returned' scored by quantity, a score with many ties


def scored_lines(t):
    return t.lineitem.select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), (F.col("l_quantity") / 51).alias("score")
    )


SCORED = "s AS (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS label, l_quantity / 51 AS score FROM lineitem)"
STEPS = SCORED + """, g AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM s GROUP BY 1),
w AS (SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
             sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM g)"""


@query("eval_metrics", f"""
WITH {STEPS},
a AS (SELECT sum((tp - pos + pos / 2.0) * neg) / (max(p) * max(n)) AS auc FROM w),
c AS (SELECT CAST(count(*) FILTER (score >= 0.5 AND label = 1) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (score >= 0.5 AND label = 0) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (score < 0.5 AND label = 1) AS DOUBLE) AS fn,
             CAST(count(*) FILTER (score < 0.5 AND label = 0) AS DOUBLE) AS tn,
             avg(-CASE WHEN label = 1 THEN ln(score) ELSE ln(1 - score) END) AS ll FROM s)
SELECT {r_sql('tp / (tp + fp)', 9)} AS precision, {r_sql('tp / (tp + fn)', 9)} AS recall,
       {r_sql('(tp + tn) / (tp + fp + fn + tn)', 9)} AS accuracy, {r_sql('2 * tp / (2 * tp + fp + fn)', 9)} AS f1_score,
       {r_sql('ll', 9)} AS log_loss, {r_sql('auc', 9)} AS roc_auc FROM c, a""")
def _(t):
    out = ev.eval_metrics(scored_lines(t), "label", "score")
    return rounded(out, {col: 9 for col in out.columns})


@query("roc_curve", f"""
WITH {STEPS}
SELECT {r_sql('score', 9)} AS threshold, {r_sql('tp / p', 9)} AS recall, {r_sql('fp / n', 9)} AS false_positive_rate,
       CAST(tp AS BIGINT) AS true_positives, CAST(fp AS BIGINT) AS false_positives,
       CAST(n - fp AS BIGINT) AS true_negatives, CAST(p - tp AS BIGINT) AS false_negatives FROM w""")
def _(t):
    out = ev.roc_curve(scored_lines(t), "label", "score")
    return rounded(out, {"threshold": 9, "recall": 9, "false_positive_rate": 9})


@query("confusion_matrix", f"""
WITH {SCORED}
SELECT label AS expected_label, CAST(score >= 0.5 AS INTEGER) AS predicted_label, count(*) AS row_count
FROM s GROUP BY 1, 2""")
def _(t):
    return ev.confusion_matrix(
        scored_lines(t).withColumn("predicted", (F.col("score") >= 0.5).cast("int")), "label", "predicted"
    )


@query("class_prob", f"""
SELECT l_orderkey, l_linenumber, l_partkey, {r_sql('1 - l_discount * 4', 6)} AS kept_prob,
       CASE WHEN 1 - l_discount * 4 >= 0.8 THEN 'kept' ELSE 'returned' END AS decision FROM lineitem""")
def _(t):
    probs = F.array(
        F.struct(F.lit("returned").alias("label"), (F.col("l_discount") * 4).alias("prob")),
        F.struct(F.lit("kept").alias("label"), (1 - F.col("l_discount") * 4).alias("prob")),
    )
    p = learn.prob_of(F.col("probs"), "kept")
    return t.lineitem.withColumn("probs", probs).select(
        "l_orderkey", "l_linenumber", "l_partkey", r(p, 6).alias("kept_prob"),
        F.when(p >= 0.8, "kept").otherwise("returned").alias("decision"),
    )


# ---- skew and drift


def shift_sql(base: str, study: str, cats: list[str], nums: list[str]) -> str:
    parts = []
    for x in cats:
        parts.append(f"SELECT b, '{x}' AS feature, 'categorical' AS kind, CAST({x} AS VARCHAR) AS value FROM d")
    for x in nums:
        bin_of = (f"coalesce(least(CAST(floor(({x} - lo) / nullif((hi - lo) / 10, 0)) AS INTEGER), 9), 0)")
        parts.append(
            f"SELECT b, '{x}', 'numeric', CAST({bin_of} AS VARCHAR) FROM d, "
            f"(SELECT CAST(min({x}) AS DOUBLE) AS lo, CAST(max({x}) AS DOUBLE) AS hi FROM d)"
        )
    return f"""
WITH d AS (SELECT 1 AS b, * FROM ({base}) UNION ALL SELECT 0, * FROM ({study})),
l AS ({" UNION ALL ".join(parts)}),
n AS (SELECT feature, kind, value, sum(b) AS nb, sum(1 - b) AS ns FROM l WHERE value IS NOT NULL GROUP BY 1, 2, 3),
h AS (SELECT feature, kind, CAST(nb AS DOUBLE) / sum(nb) OVER (PARTITION BY feature) AS p,
             CAST(ns AS DOUBLE) / sum(ns) OVER (PARTITION BY feature) AS q FROM n),
v AS (SELECT feature, kind, max(abs(p - q)) AS linf,
             sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                 + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2 AS jsd FROM h GROUP BY 1, 2)
SELECT feature, CASE WHEN kind = 'categorical' THEN 'l_infinity' ELSE 'jensen_shannon' END AS metric,
       CASE WHEN kind = 'categorical' THEN 0.2::DOUBLE ELSE 0.3::DOUBLE END AS threshold,
       {r_sql("CASE WHEN kind = 'categorical' THEN linf ELSE jsd END", 9)} AS value,
       CASE WHEN kind = 'categorical' THEN linf > 0.2 ELSE jsd > 0.3 END AS is_anomaly FROM v"""


@query("data_skew", shift_sql(
    "SELECT l_returnflag, l_linestatus, l_quantity, l_extendedprice, l_orderkey FROM lineitem"
    " WHERE l_shipdate < TIMESTAMP '1998-01-01'",
    "SELECT l_returnflag, l_linestatus, l_quantity, l_extendedprice, l_orderkey FROM lineitem"
    " WHERE l_shipdate >= TIMESTAMP '1998-01-01'",
    ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice"]))
def _(t):
    cut = F.col("l_shipdate") < F.lit(dt.datetime(1998, 1, 1))
    out = ev.distribution_shift(
        t.lineitem.where(cut), t.lineitem.where(~cut),
        ["l_returnflag", "l_linestatus"], ["l_quantity", "l_extendedprice"],
    )
    return rounded(out, {"value": 9})


RUN_DATE = dt.date(2024, 1, 30)


@query("data_drift", shift_sql(
    "SELECT event_type, user_id, value, hour(ts) AS start_hour FROM events"
    " WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-16' AND DATE '2024-01-22'",
    "SELECT event_type, user_id, value, hour(ts) AS start_hour FROM events"
    " WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-23' AND DATE '2024-01-29'",
    ["event_type", "user_id"], ["value", "start_hour"]))
def _(t):
    rows = t.events.select("event_type", "user_id", "value", F.hour("ts").alias("start_hour"), "ts")

    def window(first: int, last: int):
        lo = dt.datetime.combine(RUN_DATE - dt.timedelta(days=first), dt.time())
        hi = dt.datetime.combine(RUN_DATE - dt.timedelta(days=last - 1), dt.time())
        return rows.where((F.col("ts") >= F.lit(lo)) & (F.col("ts") < F.lit(hi)))

    out = ev.distribution_shift(window(14, 8), window(7, 1), ["event_type", "user_id"], ["value", "start_hour"])
    return rounded(out, {"value": 9})


# ---- forecast in plain aggregates


def daily_by_flag(t):
    return t.lineitem.groupBy("l_returnflag", F.to_date("l_shipdate").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("forecast_trend_weekday", f"""
WITH d AS (SELECT l_returnflag, CAST(l_shipdate AS DATE) AS ds, CAST(count(*) AS DOUBLE) AS y FROM lineitem GROUP BY 1, 2),
x AS (SELECT *, CAST(date_diff('day', DATE '1970-01-01', ds) AS DOUBLE) AS day FROM d),
t AS (SELECT l_returnflag, regr_slope(y, day) AS slope, avg(y) AS my, avg(day) AS md, max(ds) AS last FROM x GROUP BY 1),
e AS (SELECT l_returnflag, dayofweek(ds) AS dow, y - (my + slope * (day - md)) AS rest FROM x JOIN t USING (l_returnflag)),
w AS (SELECT l_returnflag, dow, avg(rest) AS shift, count(*) AS n, var_pop(rest) AS v FROM e GROUP BY 1, 2),
s AS (SELECT l_returnflag, sqrt(sum(n * v) / sum(n)) AS se FROM w GROUP BY 1),
h AS (SELECT l_returnflag, last + CAST(i AS INTEGER) AS ds, slope, my, md, se
      FROM t JOIN s USING (l_returnflag), range(1, 31) AS g(i)),
p AS (SELECT h.l_returnflag, ds, se, my + slope * (date_diff('day', DATE '1970-01-01', ds) - md) + shift AS point
      FROM h JOIN w ON w.l_returnflag = h.l_returnflag AND w.dow = dayofweek(ds))
SELECT l_returnflag, CAST(ds AS VARCHAR) AS forecast_timestamp, {r_sql('point', 7)} AS forecast_value,
       {r_sql('se', 7)} AS standard_error, 0.95::DOUBLE AS confidence_level,
       {r_sql('point - 1.959963984540054 * se', 7)} AS prediction_interval_lower_bound,
       {r_sql('point + 1.959963984540054 * se', 7)} AS prediction_interval_upper_bound FROM p""")
def _(t):
    out = fc.forecast_trend_weekday(daily_by_flag(t), "l_returnflag", "day", "n")
    out = out.withColumn("forecast_timestamp", F.col("forecast_timestamp").cast("string"))
    return rounded(out, {col: 7 for col in (
        "forecast_value", "standard_error", "prediction_interval_lower_bound", "prediction_interval_upper_bound")})
