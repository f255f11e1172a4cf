"""Logs, caching, reviews and access rules on small tables."""

import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import monitor as m

DAY = dt.datetime(2025, 1, 8, 9)


def calls(spark):
    rows = [("r1", DAY, "p", 1, "m", 10, 5, 100, None, "h", "a"), ("r2", DAY, "p", 1, "m", None, 1, 300, "error", "h", "b"),
            ("r3", DAY + dt.timedelta(hours=1), "p", 1, "m", 1, 1, None, "ok", "h", "c"),
            ("r4", DAY - dt.timedelta(days=1), "p", 1, "m", 1, 1, 1, "ok", "i", "d")]
    return spark.createDataFrame(
        rows, "run_id string, created_at timestamp, prompt_id string, prompt_version long, model string, tokens_in long, "
        "tokens_out long, latency_ms long, status string, input_hash string, output_text string",
    ).withColumn("params_json", F.lit("{}"))


def test_daily_calls_alerts_and_caps(spark):
    daily = m.llm_calls_daily(calls(spark)).persist()
    row = daily.where("run_date = '2025-01-08'").first()
    assert (row["call_count"], row["error_count"], row["tokens_in"], row["tokens_out"], row["avg_latency_ms"]) == (3, 1, 11, 7, 200)
    assert m.call_alerts(daily, DAY.date()).count() == 1 and m.call_alerts(daily, dt.date(2025, 1, 7)).isEmpty()
    caps = spark.createDataFrame([("p", 1, 17)], "prompt_id string, prompt_version long, daily_token_cap long")
    assert m.cap_breaches(daily, caps, DAY.date()).first()["tokens_total"] == 18


def test_cache_keeps_newest_success(spark):
    got = {r["input_hash"]: r["output_text"] for r in m.cache_latest(calls(spark)).collect()}
    assert got == {"h": "c", "i": "d"}


def test_retrieval_runs(spark):
    runs = spark.createDataFrame(
        [("a", DAY, "c", "e", "1", "q", [("x", 0.5), ("y", 0.2)]), ("b", DAY, "c", "e", "1", "q", [("x", 0.6)])],
        m.LOG_SCHEMAS["retrieval_runs"],
    )
    row = m.retrieval_runs_daily(runs).first()
    assert (row["run_count"], row["avg_top_k"], row["avg_best_distance"]) == (2, 1.5, 0.4)
    assert m.retrieval_alerts(m.retrieval_runs_daily(runs), DAY.date()).count() == 1


def test_active_prompt_is_highest_active_version(spark):
    rows = [("p", 1, True), ("p", 2, True), ("p", 3, False), ("q", 1, False)]
    df = spark.createDataFrame(rows, "prompt_id string, prompt_version long, is_active boolean")
    assert [tuple(r) for r in m.active_prompts(df).collect()] == [("p", 2, True)]


def test_review_queue_and_cap(spark):
    answers = spark.createDataFrame([(str(i), DAY + dt.timedelta(minutes=i)) for i in range(5)], "run_id string, created_at timestamp")
    reviews = spark.createDataFrame([("4",)], "run_id string")
    assert [r["run_id"] for r in m.review_queue(answers, reviews, 2).collect()] == ["3", "2"]
    out = m.capped(answers, [F.asc("run_id")], 3).collect()
    assert [r["run_id"] for r in out] == ["0", "1", "2"] and all(r["has_more"] for r in out)
    assert not any(r["has_more"] for r in m.capped(answers, [F.asc("run_id")], 5).collect())


def test_eval_scores(spark):
    sets = spark.createDataFrame([("s", "1", '{"c": "x"}'), ("s", "2", '{"c": "y"}')], "eval_set_id string, row_id string, expected_json string")
    actual = spark.createDataFrame([("s", "1", '{"c": "x"}', "p", 1), ("s", "2", "broken", "p", 1)],
                                   "eval_set_id string, row_id string, actual_json string, prompt_id string, prompt_version long")
    row = m.pass_rate(m.score_evals(sets, actual, "c", "c string")).first()
    assert (row["row_count"], row["passed_count"], row["pass_rate"]) == (2, 1, 0.5)


def test_query_log(spark):
    rows = [("SELECT 1 FROM t WHERE product_id = 'p1'",), ("  with a as (select 1) select 1",), ("drop table t",),
            ("UPDATE t SET a=1 WHERE product_id='p1'",), ("-- hi",)]
    out = m.query_log_audit(spark.createDataFrame(rows, "q string"), "q", "product_id", F.lit("p1")).collect()
    assert [(r["verb"], r["is_read_only"], r["has_tenant_filter"], r["allowed"]) for r in out] == [
        ("SELECT", True, True, True), ("WITH", True, False, False), ("DROP", False, False, False),
        ("UPDATE", False, True, False), ("", False, False, False)]


def test_query_log_tricks(spark):
    good = "SELECT * FROM t WHERE product_id = 'p1'"
    rows = [(good + "; DROP TABLE t", False), (good + ";", True), ("SELECT 1 FROM t -- WHERE product_id='p1'", False),
            ("SELECT 1 FROM t WHERE xproduct_id='p1'", False), ("SELECT 1 FROM t WHERE PRODUCT_ID='p1'", True),
            ("SELECT ';', '--' FROM t WHERE product_id='p1'", True), ("/* x; */ " + good, True),
            ("WITH a AS (SELECT 1) DELETE FROM t WHERE product_id='p1'", False), ("SELECT 'delete' FROM t WHERE product_id='p1'", True),
            ("SELECT 1 FROM t WHERE product_id='p12'", False), ("SELECT 1 FROM t WHERE t.product_id='p1'", True), (None, False)]
    out = m.query_log_audit(spark.createDataFrame(rows, "q string, ok boolean"), "q", "product_id", F.lit("p1")).collect()
    assert all(r["allowed"] == r["ok"] for r in out), [r for r in out if r["allowed"] != r["ok"]]
