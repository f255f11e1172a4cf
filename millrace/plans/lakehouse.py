"""Silver, gold and consume models of the retail lakehouse, each DataFrame to DataFrame."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ordering import latest_per_key

# Fixed value: type of money and price columns.
NUMERIC = "decimal(38,9)"


def latest_snapshot(df: DataFrame, ts: str = "ingest_ts") -> DataFrame:
    """Rows of the newest snapshot: those whose ``ts`` equals the maximum.

    On a bronze table pass its partition column (``snapshot_ts``): the maximum is a
    scalar subquery, so the scan then reads the newest partition only.
    """
    newest = df.agg(F.max(ts).alias("newest")).scalar()
    return df.where(F.col(ts) == newest)


def silver_customers(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("id").cast("long").alias("customer_id"),
        F.col("name").alias("customer_name"),
        "email",
        "country",
        F.col("ingest_ts").alias("ingest_time"),
    )


def silver_products(rows: DataFrame, numeric: str = NUMERIC) -> DataFrame:
    return rows.select(
        F.col("id").cast("long").alias("product_id"),
        F.col("name").alias("product_name"),
        "category",
        F.col("price").cast(numeric).alias("price"),
        F.col("ingest_ts").alias("ingest_time"),
    )


def silver_orders(rows: DataFrame, numeric: str = NUMERIC) -> DataFrame:
    return rows.select(
        F.col("id").cast("long").alias("order_id"),
        F.col("customer_id").cast("long").alias("customer_id"),
        F.col("product_id").cast("long").alias("product_id"),
        F.col("quantity").cast("long").alias("quantity"),
        F.col("unit_price").cast(numeric).alias("unit_price"),
        F.col("total_amount").cast(numeric).alias("total_amount"),
        "created_at",
        F.col("ingest_ts").alias("ingest_time"),
    )


def stg_customers(bronze: DataFrame, ts: str = "ingest_ts") -> DataFrame:
    return silver_customers(latest_snapshot(bronze, ts))


def stg_products(bronze: DataFrame, ts: str = "ingest_ts", numeric: str = NUMERIC) -> DataFrame:
    return silver_products(latest_snapshot(bronze, ts), numeric)


def stg_orders(bronze: DataFrame, ts: str = "ingest_ts", numeric: str = NUMERIC) -> DataFrame:
    return silver_orders(latest_snapshot(bronze, ts), numeric)


def dim_customers(stg: DataFrame) -> DataFrame:
    return stg.drop("ingest_time")


def dim_products(stg: DataFrame) -> DataFrame:
    return stg.drop("ingest_time")


def fct_orders(stg: DataFrame) -> DataFrame:
    return stg.drop("ingest_time")


def mart_customer_orders(fct: DataFrame) -> DataFrame:
    return fct.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_amount").alias("revenue"),
        F.max("created_at").alias("last_order_at"),
    )


def mart_sales(fct: DataFrame) -> DataFrame:
    return fct.groupBy(F.to_date("created_at").alias("order_date")).agg(
        F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("total_revenue")
    )


def mart_revenue_by_category_daily(fct: DataFrame, products: DataFrame) -> DataFrame:
    """Orders and revenue per day and category.

    With products small enough to broadcast, the one shuffle carries partial sums per
    (day, category); otherwise adaptive execution splits the partitions of hot products.
    """
    return (
        fct.join(products.select("product_id", "category"), "product_id")
        .groupBy(F.to_date("created_at").alias("order_date"), "category")
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("total_amount").alias("revenue"))
    )


def daily_order_metrics(fct: DataFrame) -> DataFrame:
    """Distinct orders, revenue and revenue per order by day.

    Lines are summed per (day, order) first; the second step then counts orders
    without a distinct aggregate.
    """
    per_order = fct.groupBy(F.to_date("created_at").alias("order_date"), "order_id").agg(
        F.sum("total_amount").alias("amount")
    )
    return per_order.groupBy("order_date").agg(
        F.count("order_id").alias("total_orders"), F.sum("amount").alias("total_revenue")
    ).withColumn("avg_order_value", F.try_divide(F.col("total_revenue").cast("double"), F.col("total_orders")))


def star_join(orders: DataFrame, products: DataFrame, customers: DataFrame) -> DataFrame:
    """Order lines with product and customer attributes (join strategy left to Catalyst)."""
    p = products.select(F.col("product_id"), "product_name", "category", "price")
    c = customers.select(F.col("customer_id"), "customer_name", "country")
    return orders.join(p, "product_id").join(c, "customer_id").select(
        "customer_id", "customer_name", "country", "product_name", "category",
        "quantity", "total_amount", "unit_price", "price",
    )


def live_orders_latest(
    bronze: DataFrame, as_of: dt.date, horizon_hours: int = 48, numeric: str = NUMERIC, tiebreak: str | None = None
) -> DataFrame:
    """Orders created on ``as_of``, ingested within the horizon, newest version per id.

    A table partitioned by ``ingest_date`` is read from the horizon's day on only.
    """
    midnight = dt.datetime.combine(as_of, dt.time())
    since = midnight - dt.timedelta(hours=horizon_hours)
    # A range on the raw column reaches the scan; DATE(created_at) = … would not.
    recent = bronze.where(
        (F.col("created_at") >= F.lit(midnight))
        & (F.col("created_at") < F.lit(midnight + dt.timedelta(days=1)))
        & (F.col("ingest_ts") >= F.lit(since))
    )
    if "ingest_date" in bronze.columns:
        recent = recent.where(F.col("ingest_date") >= F.lit(since.date()))
    order = [F.desc("ingest_ts")] + ([F.desc(tiebreak)] if tiebreak else [])
    return silver_orders(latest_per_key(recent, ["id"], order), numeric)


def time_spine(spark: SparkSession, start: str = "2000-01-01", end: str = "2050-01-01") -> DataFrame:
    """One row per day from ``start`` up to, but not including, ``end``."""
    span = spark.range(1).select(F.lit(start).cast("date").alias("a"), F.lit(end).cast("date").alias("b"))
    return _days(span)


def time_spine_of(df: DataFrame, ts: str) -> DataFrame:
    """One row per day from the first to the last day that occurs in ``df``."""
    span = df.agg(
        F.to_date(F.min(ts)).alias("a"), F.date_add(F.to_date(F.max(ts)), 1).alias("b")
    )
    return _days(span)


def _days(span: DataFrame) -> DataFrame:
    n = F.date_diff(F.col("b"), F.col("a"))
    steps = span.select("a", n.alias("n"), F.explode(F.sequence(F.lit(0), n)).alias("i"))
    # A sequence to 0 or below is not empty in Spark, so the bounds are checked here.
    return steps.where((F.col("i") >= 0) & (F.col("i") < F.col("n"))).select(
        F.date_add("a", F.col("i")).alias("date_day")
    )


def build_all(bronze: dict[str, DataFrame], write, ts: str = "snapshot_ts") -> dict[str, DataFrame]:
    """Full refresh: silver views, then gold tables, then marts and metrics.

    ``ts`` tells snapshots apart; bronze tables are partitioned by ``snapshot_ts``, so only the newest
    one is read.

    ``write(name, df)`` stores a gold table and returns it read back, so the marts
    start from the stored fact table instead of repeating the silver work.
    """
    customers = write("dim_customers", dim_customers(stg_customers(bronze["customers"], ts)))
    products = write("dim_products", dim_products(stg_products(bronze["products"], ts)))
    fct = write("fct_orders", fct_orders(stg_orders(bronze["orders"], ts)))
    out = {"dim_customers": customers, "dim_products": products, "fct_orders": fct}
    marts = {
        "mart_customer_orders": mart_customer_orders(fct),
        "mart_sales": mart_sales(fct),
        "mart_revenue_by_category_daily": mart_revenue_by_category_daily(fct, products),
    }
    for name, df in marts.items():
        out[name] = write(name, df)
    out["daily_order_metrics"] = daily_order_metrics(fct)
    return out


