"""The operators' input tables, derived from the test tables (DataFrame and SQL side by side)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import text as x
from millrace.plans import lakehouse as lh
from millrace.registry.core import Tables

NEWER, OLDER = dt.datetime(2002, 1, 2), dt.datetime(2002, 1, 1)
MONEY = "decimal(18,2)"


def two_snapshots(df: DataFrame) -> DataFrame:
    """The same rows ingested twice, one day apart."""
    return df.withColumn("ingest_ts", F.lit(OLDER)).unionByName(df.withColumn("ingest_ts", F.lit(NEWER)))


def raw_customers(t: Tables) -> DataFrame:
    return t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("country"),
    )


CUSTOMERS = """customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, 'c' || c_custkey || '@example.com' AS email,
         n_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def raw_products(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(18,2)) AS price
  FROM part)"""


# Order lines that a task joins and groups by order where all of them are grouped so.
LINES_PER_TASK = 500_000


def raw_orders(t: Tables, dealt: bool = False) -> DataFrame:
    """One row per order line.

    ``dealt``: both tables are dealt by order into as many tasks as the lines need, so that what a task holds to
    tell orders apart doesn't grow with the table.
    """
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    if dealt:
        n = max(t.spark.sparkContext.defaultParallelism, -(-lines.count() // LINES_PER_TASK))
        lines, orders = lines.repartition(n, "l_orderkey"), orders.repartition(n, "o_orderkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.try_divide("l_extendedprice", "l_quantity").alias("unit_price"),
        F.col("l_extendedprice").alias("total_amount"),
        F.lit("EUR").alias("currency"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


ORDERS = """fct AS (
  SELECT l_orderkey AS order_id, o_custkey AS customer_id, l_partkey AS product_id,
         CAST(l_quantity AS BIGINT) AS quantity,
         CAST(l_extendedprice / l_quantity AS DECIMAL(38,9)) AS unit_price,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS total_amount, o_orderdate AS created_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


# The gold tables below start from one snapshot, so there is no newest one to look for
# (that would read the source a second time); the stg_* queries show that step.


def fct_orders(t: Tables, numeric: str = MONEY, dealt: bool = False) -> DataFrame:
    return lh.fct_orders(lh.silver_orders(raw_orders(t, dealt).withColumn("ingest_ts", F.lit(NEWER)), numeric))


def dim_products(t: Tables) -> DataFrame:
    return lh.dim_products(lh.silver_products(raw_products(t).withColumn("ingest_ts", F.lit(NEWER)), MONEY))


def dim_customers(t: Tables) -> DataFrame:
    return lh.dim_customers(lh.silver_customers(raw_customers(t).withColumn("ingest_ts", F.lit(NEWER))))


def prop_k(col="props"):
    return F.get_json_object(F.col(col), "$.k").cast("bigint")


def live_orders(t: Tables) -> DataFrame:
    """Events as order versions: the same user's events are versions of one order."""
    return t.events.select(
        F.col("user_id").alias("id"),
        F.col("event_id").alias("customer_id"),
        prop_k().alias("product_id"),
        prop_k().cast("int").alias("quantity"),
        F.col("value").alias("total_amount"),
        F.try_divide(F.col("value"), prop_k().cast("double")).alias("unit_price"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.col("ts").cast("timestamp").alias("ingest_ts"),
    )


LIVE = """live AS (
  SELECT user_id AS id, event_id AS customer_id, CAST(json_extract(props, '$.k') AS BIGINT) AS product_id,
         CAST(json_extract(props, '$.k') AS BIGINT) AS quantity, value AS total_amount, ts AS created_at
  FROM events)"""

TICKET_START = dt.datetime(2024, 1, 8)


def tickets(t: Tables) -> DataFrame:
    """Every user turn of a conversation as a support ticket."""
    turn, conv = F.col("turn"), F.col("conv_id")
    return t.conversations.where(F.col("role") == "user").select(
        F.concat(F.lit("tkt_"), conv.cast("string"), F.lit("_"), turn.cast("string")).alias("ticket_id"),
        F.timestamp_add("SECOND", conv * 60 + turn, F.lit(TICKET_START).cast("timestamp")).alias("created_at"),
        F.concat(F.lit("src"), (conv % 20).cast("string")).alias("product_id"),
        F.when(turn == 0, "open").when(turn == 2, "in_progress").otherwise("resolved").alias("status"),
        F.regexp_extract("text", r"^[^.\n]*", 0).alias("subject"),
        F.col("text").alias("body"),
    )


TICKETS = r"""tickets AS (
  SELECT 'tkt_' || conv_id || '_' || turn AS ticket_id,
         TIMESTAMP '2024-01-08 00:00:00' + to_seconds(conv_id * 60 + turn) AS created_at,
         'src' || (conv_id % 20) AS product_id,
         CASE WHEN turn = 0 THEN 'open' WHEN turn = 2 THEN 'in_progress' ELSE 'resolved' END AS status,
         regexp_extract(text, '^[^.\n]*', 0) AS subject, text AS body
  FROM conversations WHERE role = 'user')"""


def articles(t: Tables) -> DataFrame:
    """Documents as knowledge-base articles that belong to one or two products."""
    other = F.concat(F.lit("src"), (F.col("doc_id") % 20).cast("string"))
    return t.documents.select(
        F.col("doc_id").alias("article_id"),
        F.col("text").alias("body"),
        F.col("lang").alias("language"),
        F.array("source", other).alias("product_ids"),
        F.date_sub(F.lit("2024-01-31").cast("date"), (F.col("doc_id") % 30).cast("int")).alias("updated_at"),
    )


ARTICLES = """articles AS (
  SELECT doc_id AS article_id, text AS body, lang AS language,
         [source, 'src' || (doc_id % 20)] AS product_ids,
         DATE '2024-01-31' - CAST(doc_id % 30 AS INTEGER) AS updated_at
  FROM documents)"""


def english_chunks(t: Tables) -> DataFrame:
    """All chunks of all English articles."""
    english = articles(t).where(F.col("language") == "en")
    return x.chunk(english, "article_id", "body", "\n").withColumnRenamed("chunk_text", "content")


def asked_tickets(t: Tables) -> DataFrame:
    """Every conversation as a ticket, with the texts of all its user turns (else of all its turns)."""
    def told(turns) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(turns)), lambda x: x["text"]), "\n")

    turn = F.struct("turn", "text")
    user = F.when(F.col("role") == "user", turn)
    text = F.when(F.count(user) > 0, told(user)).otherwise(told(turn))
    return t.conversations.groupBy(F.col("conv_id").alias("ticket_id")).agg(text.alias("ticket_text")).withColumn(
        "product_id", F.concat(F.lit("src"), (F.col("ticket_id") % 20).cast("string")))


TICKETS_ASKED = """asked AS (
  SELECT conv_id AS ticket_id, 'src' || (conv_id % 20) AS product_id,
         coalesce(string_agg(text, chr(10) ORDER BY turn, text) FILTER (role = 'user'),
                  string_agg(text, chr(10) ORDER BY turn, text)) AS ticket_text
  FROM conversations GROUP BY conv_id)"""


def hashed_sql(name: str, source: str, id: str, text: str, dims: int = 512) -> str:
    """SQL of ``retrieval.hashed_vectors``: a table (id, cell, v) of unit vectors, weighed by the words of ``chunks``."""
    h = "CAST('0x' || substr(md5(word), 1, 15) AS BIGINT)"
    return rf"""{name}_words AS (
  SELECT id, word, count(*) AS tf FROM (
    SELECT {id} AS id, unnest(regexp_extract_all(lower({text}), '[\pL\pN]+')) AS word FROM {source}) GROUP BY ALL),
{name}_cells AS (
  SELECT id, {h} % {dims} AS cell,
         sum(CASE WHEN {h} // {dims} % 2 = 0 THEN 1 ELSE -1 END * tf * (ln((n + 1) / (coalesce(df, 0) + 1)::DOUBLE) + 1)) AS w
  FROM {name}_words LEFT JOIN known USING (word) CROSS JOIN (SELECT count(*) AS n FROM texts) GROUP BY ALL),
{name} AS (SELECT id, cell, w / nullif(sqrt(sum(w * w) OVER (PARTITION BY id)), 0) AS v FROM {name}_cells)"""


# Distance as the search operator rounds it, from two DOUBLE[] columns a and b.
DISTANCE = "floor((1 - list_cosine_similarity({a}, {b})) * 1e9 + 0.5) / 1e9"


def calls(t: Tables) -> DataFrame:
    """Events as a log of model calls."""
    return t.events.select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.concat(F.lit("prompt_"), (F.col("user_id") % 7).cast("string")).alias("prompt_id"),
        (F.col("user_id") % 3 + 1).alias("prompt_version"),
        F.concat(F.lit("model_"), (F.col("user_id") % 2).cast("string")).alias("model"),
        F.lit('{"temperature":0.2}').alias("params_json"),
        F.md5("props").alias("input_hash"),
        prop_k().alias("tokens_in"),
        F.floor("value").alias("tokens_out"),
        F.floor(F.col("value") * 10).alias("latency_ms"),
        F.when(F.col("event_type") == "error", "error").when(F.col("event_type") != "signup", "ok").alias("status"),
        F.concat(F.lit("out "), F.col("event_id").cast("string")).alias("output_text"),
    )


CALLS = """calls AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, ts AS created_at, 'prompt_' || (user_id % 7) AS prompt_id,
         user_id % 3 + 1 AS prompt_version, 'model_' || (user_id % 2) AS model,
         '{"temperature":0.2}' AS params_json, md5(props) AS input_hash,
         CAST(json_extract(props, '$.k') AS BIGINT) AS tokens_in, CAST(floor(value) AS BIGINT) AS tokens_out,
         CAST(floor(value * 10) AS BIGINT) AS latency_ms,
         CASE WHEN event_type = 'error' THEN 'error' WHEN event_type <> 'signup' THEN 'ok' END AS status,
         'out ' || event_id AS output_text
  FROM events)"""

CALLS_DAILY = CALLS + """, daily AS (
  SELECT CAST(created_at AS DATE) AS run_date, prompt_id, prompt_version, model, count(*) AS call_count,
         CAST(sum(CASE WHEN status = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS error_count,
         CAST(sum(tokens_in) AS BIGINT) AS tokens_in, CAST(sum(tokens_out) AS BIGINT) AS tokens_out,
         CAST(sum(latency_ms) AS DOUBLE) / count(*) AS avg_latency_ms
  FROM calls GROUP BY 1, 2, 3, 4)"""


def retrieval_runs(t: Tables) -> DataFrame:
    """Events as retrieval runs with one to three hits."""
    hits = F.transform(
        F.sequence(F.lit(1), (prop_k() % 3 + 1).cast("int")),
        lambda i: F.struct(
            F.concat(F.lit("c"), i.cast("string")).alias("chunk_id"), (F.col("value") / 500 * i).alias("distance")
        ),
    )
    return t.events.select(
        F.col("event_id").cast("string").alias("retrieval_run_id"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.col("event_type").alias("retrieval_config_id"),
        F.lit("hashed-tfidf").alias("embedding_model"),
        (F.col("user_id") % 2).cast("string").alias("embedding_version"),
        hits.alias("retrieved"),
    )


RUNS_DAILY = """runs AS (
  SELECT CAST(ts AS DATE) AS run_date, event_type AS retrieval_config_id, 'hashed-tfidf' AS embedding_model,
         CAST(user_id % 2 AS VARCHAR) AS embedding_version,
         1 + CAST(json_extract(props, '$.k') AS BIGINT) % 3 AS hits, value / 500 AS best
  FROM events),
daily AS (
  SELECT run_date, retrieval_config_id, embedding_model, embedding_version, count(*) AS run_count,
         avg(hits) AS avg_top_k, avg(best) AS avg_best_distance
  FROM runs GROUP BY 1, 2, 3, 4)"""

