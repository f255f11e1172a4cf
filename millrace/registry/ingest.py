"""Landing zone, bronze tables and the live-orders stream, fed from the test tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from millrace.functions import constants as c
from millrace.operators.quality import order_rule, split
from millrace.plans import lakehouse as lh
from millrace.registry import inputs as i
from millrace.registry.core import query
from millrace.registry.retail import LIVE_SQL, live_result, text
from millrace.session import work_path
from millrace.sources import landing as lz
from millrace.sources import tables as tb
from millrace.streaming import orders as live

FIRST = dt.datetime(2024, 1, 1, 6, 0, tzinfo=dt.timezone.utc)
SECOND = dt.datetime(2024, 1, 2, 6, 30, tzinfo=dt.timezone.utc)


def landed(t, entity):
    """Two landed snapshots of an entity; returns the landing-zone folder."""
    root = work_path(t.spark, "landing")
    rows = {"customers": i.raw_customers, "products": i.raw_products, "orders": i.raw_orders}[entity](t)
    if entity == "orders":
        rows = rows.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    lz.snapshot_land(rows, entity, FIRST, root)
    return lz.snapshot_land(rows, entity, SECOND, root)


@query("snapshot_land", f"""
WITH {i.ORDERS}
SELECT order_id AS id, customer_id, product_id, quantity, CAST(total_amount AS DOUBLE) AS total_amount, 'EUR' AS currency,
       strftime(created_at, '%Y-%m-%d %H:%M:%S.%f') AS created_at, 'created' AS status, 'batch_snapshot' AS source,
       'batch' AS _ingest_type, 'orders' AS _entity, _ingest_time_utc
FROM fct, (VALUES ('2024-01-01T06:00:00+00:00'), ('2024-01-02T06:30:00+00:00')) AS s(_ingest_time_utc)""")
def _(t):
    folder = landed(t, "orders")
    return t.spark.read.schema(lz.SCHEMAS["orders"]).json(folder).drop(
        "_pubsub_message_id", "_pubsub_publish_time", "snapshot_dt", "snapshot_ts"
    )


SNAPSHOTS = """(VALUES ('2024-01-01', '20240101T060000Z', '2024-01-01T06:00:00+00:00', '2024-01-01 06:00:00'),
      ('2024-01-02', '20240102T063000Z', '2024-01-02T06:30:00+00:00', '2024-01-02 06:30:00'))
      AS s(snapshot_dt, snapshot_ts, t, ingest_ts)"""

LZ_SQL = f"""
WITH {i.CUSTOMERS}
SELECT customer_id AS id, customer_name AS name, email, country, t AS _ingest_time_utc, 'batch' AS _ingest_type,
       'customers' AS _entity, snapshot_dt, snapshot_ts,
       'customers/snapshot_dt=' || snapshot_dt || '/snapshot_ts=' || snapshot_ts AS _input_file
FROM customers, {SNAPSHOTS}"""


@query("lz_read", LZ_SQL)
def _(t):
    df = lz.require_snapshot(lz.lz_read(t.spark, "customers", landed(t, "customers")))
    return source_folder(df, "_input_file")


@query("lz_snapshot_filter", LZ_SQL + " WHERE snapshot_dt = '2024-01-02'")
def _(t):
    return source_folder(lz.lz_read(t.spark, "customers", landed(t, "customers"), "2024-01-02"), "_input_file")


def source_folder(df, name):
    """The source file without what differs from run to run: its folder below the landing zone."""
    return df.withColumn(name, F.regexp_extract(name, "/([a-z]+/snapshot_dt=[^/]*/snapshot_ts=[^/]*)/[^/]*$", 1))


def normalized(t, entity):
    df = lz.normalize(entity, lz.lz_read(t.spark, entity, landed(t, entity))).drop("input_file")
    if entity == "orders":
        df = df.drop("pubsub_message_id", "pubsub_publish_time")
    return df


def as_text(df):
    return df.withColumns({n: text(n) for n, kind in df.dtypes if kind in ("timestamp", "date")})


TRAILER = "'batch' AS ingest_type, '{}' AS entity, snapshot_dt, snapshot_ts, ingest_ts"
CUSTOMER_ROWS = f"""
WITH {i.CUSTOMERS}
SELECT customer_id AS id, customer_name AS name, email, country, {TRAILER.format('customers')}
FROM customers, {SNAPSHOTS}"""


@query("normalize_customers", CUSTOMER_ROWS)
def _(t):
    return as_text(normalized(t, "customers"))


@query("normalize_products", f"""
SELECT p_partkey AS id, p_name AS name, p_type AS category, p_retailprice AS price, {TRAILER.format('products')}
FROM part, {SNAPSHOTS}""")
def _(t):
    return as_text(normalized(t, "products"))


@query("normalize_orders", f"""
SELECT l_orderkey AS id, o_custkey AS customer_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
       l_extendedprice / l_quantity AS unit_price, l_extendedprice AS total_amount, 'EUR' AS currency,
       CAST(o_orderdate AS VARCHAR) AS created_at, 'created' AS status, 'batch_snapshot' AS source,
       {TRAILER.format('orders')}
FROM lineitem JOIN orders ON l_orderkey = o_orderkey, {SNAPSHOTS}""")
def _(t):
    return as_text(normalized(t, "orders"))


def bronze_table(t, entity):
    """A new empty bronze table stored in the shared folder."""
    columns, partitions = tb.BRONZE_TABLES[entity]
    name = f"bronze_{entity}_{uuid.uuid4().hex[:12]}"
    tb.ensure_table(t.spark, name, columns, partitions, location=work_path(t.spark, name))
    return name


@query("bronze_overwrite_partitions", CUSTOMER_ROWS)
def _(t):
    rows = lz.normalize("customers", lz.lz_read(t.spark, "customers", landed(t, "customers")))
    name = bronze_table(t, "customers")
    tb.overwrite_partitions(rows, name)
    # The second snapshot again: its partition is replaced, the first one stays.
    tb.overwrite_partitions(rows.where(F.col("snapshot_dt") == "2024-01-02"), name)
    return as_text(t.spark.table(name).drop("input_file"))


@query("bronze_append", f"""
SELECT p_partkey AS id, p_name AS name, p_type AS category, p_retailprice AS price, {TRAILER.format('products')}
FROM part, {SNAPSHOTS}, range(2)""")
def _(t):
    rows = lz.normalize("products", lz.lz_read(t.spark, "products", landed(t, "products")))
    name = bronze_table(t, "products")
    tb.append(rows, name)
    tb.append(rows.select(*reversed(rows.columns)), name)
    return as_text(t.spark.table(name).drop("input_file"))


@query("stg_from_bronze", f"""
WITH {i.CUSTOMERS}
SELECT customer_id, customer_name, email, country, '2024-01-02 06:30:00' AS ingest_time FROM customers""")
def _(t):
    rows = lz.normalize("customers", lz.lz_read(t.spark, "customers", landed(t, "customers")))
    name = bronze_table(t, "customers")
    tb.overwrite_partitions(rows, name)
    return as_text(lh.stg_customers(t.spark.table(name), ts="snapshot_ts"))


@query("parse_or_wrap", """
WITH p AS (
  SELECT event_id, event_type, props, CASE
    WHEN event_type = 'error' THEN 'not json ' || props
    WHEN event_type = 'signup' THEN [CAST(event_id AS VARCHAR), '"text"', '[{"k": 1}]', 'null', NULL][event_id % 5 + 1]
  END AS wrapped FROM events)
SELECT event_id,
       CASE WHEN event_type NOT IN ('error', 'view', 'signup') THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
       wrapped AS _corrupt_record, CASE WHEN wrapped IS NOT NULL THEN 'non_json_payload' END AS _ingest_error
FROM p""")
def _(t):
    payload = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("not json "), F.col("props")))
        .when(F.col("event_type") == "view", '{"k": "wrong type"}')
        .when(F.col("event_type") == "signup", F.get(
            F.array(F.col("event_id").cast("string"), F.lit('"text"'), F.lit('[{"k": 1}]'), F.lit("null"),
                    F.lit(None).cast("string")), (F.col("event_id") % 5).cast("int")))
        .otherwise(F.col("props"))
    )
    return lz.parse_or_wrap(t.events.select("event_id", payload.alias("payload")), "payload", "k bigint")


@query("parse_timestamps", """
SELECT event_id, CASE event_type WHEN 'error' THEN NULL
         WHEN 'signup' THEN CAST(date_trunc('day', ts) AS VARCHAR)
         ELSE CAST(ts AS VARCHAR) END AS parsed FROM events""")
def _(t):
    kind = F.col("event_type")
    written = (
        F.when(kind == "click", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        .when(kind == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(kind == "purchase", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")))
        .when(kind == "signup", F.date_format("ts", "yyyy-MM-dd"))
        .otherwise("soon")
    )
    return t.events.select("event_id", lz.parse_first(written).cast("string").alias("parsed"))


@query("unit_price", """
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_discount <> 0 THEN l_extendedprice / (CASE WHEN l_tax <> 0 THEN l_quantity END) END AS unit_price
FROM lineitem""")
def _(t):
    # No quantity without tax, quantity 0 without discount.
    quantity = F.when(F.col("l_discount") == 0, 0).otherwise(F.when(F.col("l_tax") != 0, F.col("l_quantity")))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey",
        lz.unit_price(F.col("l_extendedprice"), quantity).alias("unit_price"),
    )


# ---- stream of live orders


def order_lines(t):
    """Events as landed order messages; some break the rules."""
    kind = F.col("event_type")
    return t.events.select(
        F.col("user_id").alias("id"),
        F.col("event_id").alias("customer_id"),
        i.prop_k().alias("product_id"),
        F.when(kind == "error", 0).otherwise(i.prop_k().cast("int") + 1).alias("quantity"),
        F.col("value").alias("total_amount"),
        F.when(kind == "signup", "").otherwise("EUR").alias("currency"),
        F.when((kind == "view") & (i.prop_k() < 50), "yesterday")
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("created_at"),
        F.col("event_id").cast("string").alias("_pubsub_message_id"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("_ingest_time_utc"),
        F.date_format("ts", "yyyy-MM-dd").alias("ingest_dt"),
        F.lit("05").alias("ingest_hr"),
    )


LINES = """lines AS (
  SELECT user_id AS id, event_id AS customer_id, CAST(json_extract(props, '$.k') AS BIGINT) AS product_id,
         CASE WHEN event_type = 'error' THEN 0 ELSE CAST(json_extract(props, '$.k') AS BIGINT) + 1 END AS quantity,
         value AS total_amount, CASE WHEN event_type = 'signup' THEN '' ELSE 'EUR' END AS currency,
         CASE WHEN NOT (event_type = 'view' AND CAST(json_extract(props, '$.k') AS BIGINT) < 50) THEN ts END
           AS created_at, ts AS ingest_ts
  FROM events),
checked AS (SELECT *, quantity > 0 AND currency <> '' AND created_at IS NOT NULL AS good FROM lines)"""


def ingest_clock():
    """Ingest time as written in the message, so that results do not depend on the wall clock."""
    return F.try_to_timestamp(F.col("_ingest_time_utc"))


def stream_rows(t):
    rows = order_lines(t).withColumn("_pubsub_publish_time", F.lit(None).cast("string"))
    return live.stream_normalize(rows.withColumn("input_file", F.lit("table")), ingest_clock())


@query("stream_normalize", f"""
WITH {LINES}
SELECT id, customer_id, product_id, quantity, total_amount,
       CASE WHEN quantity <> 0 THEN total_amount / quantity END AS unit_price, currency, 'unknown' AS status,
       'pubsub' AS source, CAST(created_at AS VARCHAR) AS created_at, CAST(ingest_ts AS VARCHAR) AS ingest_ts,
       CAST(CAST(ingest_ts AS DATE) AS VARCHAR) AS ingest_date, strftime(ingest_ts, '%Y-%m-%d') AS ingest_dt,
       '05' AS ingest_hr FROM lines""")
def _(t):
    rows = stream_rows(t).withColumn("created_at", F.col("created_at_ts"))
    return as_text(rows.select(
        "id", "customer_id", "product_id", "quantity", "total_amount", "unit_price", "currency", "status", "source",
        "created_at", "ingest_ts", "ingest_date", "ingest_dt", "ingest_hr"))


@query("quarantine_split", f"""
WITH {LINES}
SELECT customer_id, good AS is_valid, CASE WHEN NOT good THEN 'failed_minimal_validation' END AS quarantine_reason
FROM checked""")
def _(t):
    good, bad = split(stream_rows(t), order_rule())
    return good.select(
        "customer_id", F.lit(True).alias("is_valid"), F.lit(None).cast("string").alias("quarantine_reason")
    ).unionByName(bad.select(
        "customer_id", F.lit(False).alias("is_valid"), F.lit(c.QUARANTINE_REASON).alias("quarantine_reason")
    ))


def streamed(t):
    """Land the messages as files, run the stream over all of them, return the paths it wrote."""
    root = work_path(t.spark, "live")
    order_lines(t).write.partitionBy("ingest_dt", "ingest_hr").json(f"{root}/in")
    job = live.start_orders_stream(
        t.spark, f"{root}/in", f"{root}/table", f"{root}/quarantine", f"{root}/checkpoint",
        max_files=50, trigger_seconds=None, now=ingest_clock(), name=f"live_orders_{uuid.uuid4().hex}",
    )
    live.run_for(job)
    return f"{root}/table", f"{root}/quarantine"


@query("live_orders_stream", LIVE_SQL.replace(
    i.LIVE, LINES.replace("checked AS", "live AS")).replace("FROM live WHERE", "FROM live WHERE good AND"))
def _(t):
    table, _quarantine = streamed(t)
    bronze = t.spark.read.parquet(table)
    return live_result(lh.live_orders_latest(bronze, dt.date(2024, 1, 30), tiebreak="customer_id"))


@query("live_orders_quarantine", f"""
WITH {LINES}
SELECT customer_id, currency, quantity, strftime(ingest_ts, '%Y-%m-%d') AS ingest_dt, '05' AS ingest_hr,
       'failed_minimal_validation' AS quarantine_reason FROM checked WHERE NOT good""")
def _(t):
    _table, quarantine = streamed(t)
    return t.spark.read.schema(
        "customer_id bigint, currency string, quantity bigint, ingest_dt string, ingest_hr string, "
        "quarantine_reason string"
    ).json(quarantine).drop("run", "batch")
