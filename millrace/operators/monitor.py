"""Call logs, daily views, alerts, caching, reviews and access rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.operators.ordering import latest_per_key

# Columns of the log and review tables.
LOG_SCHEMAS = {
    "prompt_versions": (
        "prompt_id string, prompt_version long, description string, template_text string, "
        "created_at timestamp, owner string, is_active boolean"
    ),
    "llm_calls": (
        "run_id string, parent_run_id string, created_at timestamp, prompt_id string, prompt_version long, "
        "model string, params_json string, input_hash string, retrieval_run_id string, tokens_in long, "
        "tokens_out long, latency_ms long, status string, output_text string"
    ),
    "retrieval_runs": (
        "retrieval_run_id string, created_at timestamp, retrieval_config_id string, embedding_model string, "
        "embedding_version string, query_hash string, retrieved array<struct<chunk_id:string,distance:double>>"
    ),
    "eval_sets": "eval_set_id string, row_id string, input_text string, expected_json string, created_at timestamp",
    "eval_results": (
        "eval_run_id string, eval_set_id string, row_id string, metric_name string, metric_value double, "
        "passed boolean, prompt_id string, prompt_version long, retrieval_config_id string, model string, "
        "created_at timestamp"
    ),
    "rag_answers": (
        "run_id string, ticket_id string, created_at timestamp, answer_text string, "
        "retrieved_chunk_ids array<string>, prompt_id string, prompt_version long, model string"
    ),
    "rag_answer_reviews": "run_id string, reviewer string, decision string, notes string, created_at timestamp",
    "prompt_cost_caps": (
        "prompt_id string, prompt_version long, daily_token_cap long, owner string, created_at timestamp"
    ),
}
CACHE_KEY = ("prompt_id", "prompt_version", "model", "params_json", "input_hash")


def succeeded(status: Column) -> Column:
    return F.coalesce(status, F.lit("ok")) == "ok"


def active_prompts(registry: DataFrame) -> DataFrame:
    """The highest active version of each prompt."""
    return latest_per_key(registry.where("is_active"), ["prompt_id"], [F.desc("prompt_version")])


def llm_calls_daily(calls: DataFrame) -> DataFrame:
    return calls.groupBy(
        F.to_date("created_at").alias("run_date"), "prompt_id", "prompt_version", "model"
    ).agg(
        F.count(F.lit(1)).alias("call_count"),
        F.count_if(~succeeded(F.col("status"))).alias("error_count"),
        F.sum(F.coalesce("tokens_in", F.lit(0))).alias("tokens_in"),
        F.sum(F.coalesce("tokens_out", F.lit(0))).alias("tokens_out"),
        F.avg("latency_ms").alias("avg_latency_ms"),
    )


def retrieval_runs_daily(runs: DataFrame) -> DataFrame:
    best = F.array_min(F.transform("retrieved", lambda r: r["distance"]))
    return runs.groupBy(
        F.to_date("created_at").alias("run_date"), "retrieval_config_id", "embedding_model", "embedding_version"
    ).agg(
        F.count(F.lit(1)).alias("run_count"),
        F.avg(F.size("retrieved")).alias("avg_top_k"),
        F.avg(best).alias("avg_best_distance"),
    )


def call_alerts(daily: DataFrame, as_of) -> DataFrame:
    """Call groups of one day with errors."""
    return daily.where((F.col("run_date") == F.lit(as_of).cast("date")) & (F.col("error_count") > 0))


def retrieval_alerts(daily: DataFrame, as_of, limit: float = 0.35) -> DataFrame:
    """Retrieval groups of one day whose best hits are too far away."""
    return daily.where((F.col("run_date") == F.lit(as_of).cast("date")) & (F.col("avg_best_distance") > limit))


def cap_breaches(daily: DataFrame, caps: DataFrame, as_of) -> DataFrame:
    """Groups of one day that used more tokens than their prompt's daily cap."""
    total = F.col("tokens_in") + F.col("tokens_out")
    return (
        daily.where(F.col("run_date") == F.lit(as_of).cast("date"))
        .join(caps.select("prompt_id", "prompt_version", "daily_token_cap"), ["prompt_id", "prompt_version"])
        .where(total > F.col("daily_token_cap"))
        .select("run_date", "prompt_id", "prompt_version", total.alias("tokens_total"), "daily_token_cap")
    )


def cache_latest(calls: DataFrame, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Newest successful output per cache key."""
    order = [F.desc("created_at"), *[F.desc(c) for c in tiebreak]]
    ok = calls.where(succeeded(F.col("status")))
    return latest_per_key(ok, CACHE_KEY, order).select(*CACHE_KEY, "output_text", "created_at")


def with_input_hash(df: DataFrame, prompt: Column) -> DataFrame:
    """Add ``prompt`` and its SHA-256 as ``input_hash``."""
    return df.withColumn("prompt", prompt).withColumn("input_hash", F.sha2("prompt", 256))


def cached_for(cache: DataFrame, prompt_id: str, prompt_version: int, model: str, params_json: str) -> DataFrame:
    """(input_hash, output_text) of one prompt version, model and parameters, from ``cache_latest``."""
    wanted = {"prompt_id": prompt_id, "prompt_version": prompt_version, "model": model, "params_json": params_json}
    rows = cache
    for name, value in wanted.items():
        rows = rows.where(F.col(name).eqNullSafe(F.lit(value)))
    return rows.select("input_hash", "output_text")


def cache_misses(
    prompts: DataFrame, cache: DataFrame, prompt_id: str, prompt_version: int, model: str, params_json: str
) -> DataFrame:
    """One row (input_hash, prompt) per distinct input without an answer for this prompt version, model
    and parameters in ``cache`` (from ``cache_latest``)."""
    known = cached_for(cache, prompt_id, prompt_version, model, params_json)
    missing = prompts.join(known.select("input_hash"), "input_hash", "left_anti")
    return missing.groupBy("input_hash").agg(F.min("prompt").alias("prompt"))


def pass_rate(results: DataFrame) -> DataFrame:
    """Share of passed evaluation rows per set, metric and prompt version."""
    return results.groupBy("eval_set_id", "metric_name", "prompt_id", "prompt_version").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if("passed").alias("passed_count"),
        (F.count_if("passed") / F.count(F.lit(1))).alias("pass_rate"),
        F.avg("metric_value").alias("avg_value"),
    )


def score_evals(eval_set: DataFrame, actual: DataFrame, field: str, schema: str) -> DataFrame:
    """Compare one JSON field of expected and actual output per row: metric value 1 or 0, passed flag."""
    wanted = F.from_json("expected_json", schema)[field]
    got = F.from_json("actual_json", schema)[field]
    same = F.coalesce(wanted == got, F.lit(False))
    return eval_set.join(actual, ["eval_set_id", "row_id"]).select(
        "eval_set_id", "row_id", F.lit(f"{field}_match").alias("metric_name"),
        same.cast("double").alias("metric_value"), same.alias("passed"), "prompt_id", "prompt_version",
    )


def review_queue(answers: DataFrame, reviews: DataFrame, n: int = 100) -> DataFrame:
    """The newest ``n`` answers nobody has reviewed."""
    waiting = answers.join(reviews.select("run_id"), "run_id", "left_anti")
    return waiting.select(*answers.columns).orderBy(F.desc("created_at"), "run_id").limit(n)


def tenant_scope(df: DataFrame, col: str, value) -> DataFrame:
    """Only the rows of one tenant; hand out this DataFrame instead of the table."""
    return df.where(F.col(col) == F.lit(value))


def capped(df: DataFrame, order: Sequence[Column], n: int = 50) -> DataFrame:
    """The first ``n`` rows in order, each with ``has_more`` telling whether rows were left out."""
    head = df.orderBy(*order).limit(n + 1).withColumn("_all", F.lit(0))
    every = W.partitionBy("_all")  # over at most n + 1 rows
    numbered = head.withColumn("has_more", F.count(F.lit(1)).over(every) > n).withColumn(
        "_place", F.row_number().over(every.orderBy(*order))
    )
    return numbered.where(F.col("_place") <= n).drop("_place", "_all")


# Comments outside of literals (which are the first group), and words that change data or tables.
COMMENTS = r"('(?:[^']|'')*')|--[^\n]*|/\*[\s\S]*?\*/"
WRITING_WORDS = r"(?i)\b(insert|update|delete|merge|truncate|drop|alter|create|grant|revoke)\b"


def query_log_audit(df: DataFrame, sql_col: str, tenant_col: str, tenant: Column) -> DataFrame:
    """Classify logged statements: first word, read-only or not, a single one or not, tenant predicate.

    Works on the text only, without parsing it: comments are blanked first, and a second statement or a
    writing word outside of literals is refused.  The tenant column counts as a whole word in any case
    of letters, compared with the literal.  NULL statements are refused.
    """
    code = F.regexp_replace(F.col(sql_col), COMMENTS, "$1 ")
    bare = F.regexp_replace(code, "'(?:[^']|'')*'", "''")
    verb = F.upper(F.regexp_extract(code, r"^\s*([A-Za-z]+)", 1))
    single = F.coalesce(~F.regexp_replace(bare, r"[;\s]+$", "").contains(";"), F.lit(False))
    writes = F.coalesce(F.regexp_like(bare, F.lit(WRITING_WORDS)), F.lit(True))
    marked = F.regexp_replace(code, rf"(?i)(^|[^A-Za-z0-9_])({tenant_col})\s*=\s*'", "$1\u0001'")
    wanted = F.concat(F.lit("\u0001'"), tenant.cast("string"), F.lit("'"))
    scoped = F.coalesce(F.instr(marked, wanted) > 0, F.lit(False))
    read_only = F.coalesce(verb.isin("SELECT", "WITH"), F.lit(False)) & ~writes
    return df.withColumns({
        "verb": verb, "is_read_only": read_only, "is_single": single, "has_tenant_filter": scoped,
        "allowed": read_only & single & scoped,
    })


def open_tickets_by_product(tickets: DataFrame) -> DataFrame:
    return tickets.where(F.col("status") == "open").groupBy("product_id").agg(F.count(F.lit(1)).alias("open_tickets"))
