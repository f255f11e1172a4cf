"""Lakehouse models, semantic metrics and data-quality checks."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from millrace.operators import quality as q
from millrace.plans import lakehouse as lh
from millrace.plans import semantic
from millrace.registry import inputs as i
from millrace.registry.core import query


def text(c):
    return F.col(c).cast("string").alias(c)


def number(c):
    return F.col(c).cast("double").alias(c)


# ---- silver


@query("stg_customers", f"""
WITH {i.CUSTOMERS}
SELECT *, '2002-01-02 00:00:00' AS ingest_time FROM customers""")
def _(t):
    return lh.stg_customers(i.two_snapshots(i.raw_customers(t))).withColumn("ingest_time", text("ingest_time"))


@query("stg_products", f"""
WITH {i.PRODUCTS}
SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price, '2002-01-02 00:00:00' AS ingest_time
FROM products""")
def _(t):
    stg = lh.stg_products(i.two_snapshots(i.raw_products(t)))
    return stg.withColumn("price", number("price")).withColumn("ingest_time", text("ingest_time"))


STG_SELECT = """order_id, customer_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(total_amount AS DOUBLE) AS total_amount, CAST(created_at AS VARCHAR) AS created_at"""


@query("stg_orders", f"""
WITH {i.ORDERS}
SELECT {STG_SELECT}, '2002-01-02 00:00:00' AS ingest_time FROM fct""")
def _(t):
    stg = lh.stg_orders(i.two_snapshots(i.raw_orders(t)))
    return stg.withColumns({c: number(c) for c in ("unit_price", "total_amount")}).withColumns(
        {c: text(c) for c in ("created_at", "ingest_time")}
    )


@query("latest_snapshot", """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)""")
def _(t):
    return lh.latest_snapshot(t.lineitem, "l_shipdate").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", text("l_shipdate")
    )


# ---- gold


@query("dim_customers", f"WITH {i.CUSTOMERS} SELECT * FROM customers")
def _(t):
    return i.dim_customers(t)


@query("dim_products", f"""
WITH {i.PRODUCTS}
SELECT product_id, product_name, category, CAST(price AS DOUBLE) AS price FROM products""")
def _(t):
    return i.dim_products(t).withColumn("price", number("price"))


@query("fct_orders", f"WITH {i.ORDERS} SELECT {STG_SELECT} FROM fct")
def _(t):
    fct = i.fct_orders(t, lh.NUMERIC)
    return fct.withColumns({c: number(c) for c in ("unit_price", "total_amount")}).withColumn(
        "created_at", text("created_at")
    )


@query("mart_customer_orders", f"""
WITH {i.ORDERS}
SELECT customer_id, count(*) AS orders, CAST(sum(total_amount) AS DOUBLE) AS revenue,
       CAST(max(created_at) AS VARCHAR) AS last_order_at
FROM fct GROUP BY customer_id""")
def _(t):
    return lh.mart_customer_orders(i.fct_orders(t)).withColumn("revenue", number("revenue")).withColumn(
        "last_order_at", text("last_order_at")
    )


@query("mart_sales", f"""
WITH {i.ORDERS}
SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS order_date, count(*) AS orders,
       CAST(sum(total_amount) AS DOUBLE) AS total_revenue
FROM fct GROUP BY 1""")
def _(t):
    return lh.mart_sales(i.fct_orders(t)).withColumn("order_date", text("order_date")).withColumn(
        "total_revenue", number("total_revenue")
    )


@query("mart_revenue_by_category_daily", f"""
WITH {i.ORDERS}, {i.PRODUCTS}
SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS order_date, category, count(*) AS orders,
       CAST(sum(total_amount) AS DOUBLE) AS revenue
FROM fct JOIN products USING (product_id) GROUP BY 1, 2""")
def mart_revenue_by_category_daily(t):
    mart = lh.mart_revenue_by_category_daily(i.fct_orders(t), i.dim_products(t))
    return mart.withColumn("order_date", text("order_date")).withColumn("revenue", number("revenue"))


@query("star_join", f"""
WITH {i.ORDERS}, {i.PRODUCTS}, {i.CUSTOMERS}
SELECT customer_id, customer_name, country, product_name, category, quantity,
       CAST(total_amount AS DOUBLE) AS total_amount, CAST(unit_price AS DOUBLE) AS unit_price,
       CAST(price AS DOUBLE) AS price
FROM fct JOIN products USING (product_id) JOIN customers USING (customer_id)""")
def _(t):
    joined = lh.star_join(i.fct_orders(t, lh.NUMERIC), i.dim_products(t), i.dim_customers(t))
    return joined.withColumns({c: number(c) for c in ("total_amount", "unit_price", "price")})


LIVE_SQL = f"""
WITH {i.LIVE}, kept AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY created_at DESC, customer_id DESC) AS rn
  FROM live WHERE CAST(created_at AS DATE) = DATE '2024-01-30')
SELECT id AS order_id, customer_id, product_id, quantity, total_amount,
       CAST(created_at AS VARCHAR) AS created_at
FROM kept WHERE rn = 1"""


def live_result(latest):
    return latest.select(
        "order_id", "customer_id", "product_id", "quantity", number("total_amount"), text("created_at")
    )


@query("live_orders_latest", LIVE_SQL)
def _(t):
    return live_result(lh.live_orders_latest(i.live_orders(t), dt.date(2024, 1, 30), tiebreak="customer_id"))


# ---- consume


@query("daily_order_metrics", f"""
WITH {i.ORDERS}
SELECT CAST(CAST(created_at AS DATE) AS VARCHAR) AS order_date, count(DISTINCT order_id) AS total_orders,
       CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
       CAST(sum(total_amount) AS DOUBLE) / count(DISTINCT order_id) AS avg_order_value
FROM fct GROUP BY 1""")
def _(t):
    return lh.daily_order_metrics(i.fct_orders(t)).withColumn("order_date", text("order_date")).withColumn(
        "total_revenue", number("total_revenue")
    )


@query("time_spine", """
SELECT CAST(CAST(d AS DATE) AS VARCHAR) AS date_day
FROM generate_series((SELECT min(o_orderdate) FROM orders), (SELECT max(o_orderdate) FROM orders),
                     INTERVAL 1 DAY) AS g(d)""")
def _(t):
    return lh.time_spine_of(t.orders, "o_orderdate").select(text("date_day"))


@query("metric_query", f"""
WITH {i.ORDERS}, spine AS (
  SELECT CAST(d AS DATE) AS day
  FROM generate_series((SELECT min(l_shipdate) FROM lineitem), (SELECT max(l_shipdate) FROM lineitem),
                       INTERVAL 1 DAY) AS g(d)),
m AS (
  SELECT CAST(created_at AS DATE) AS day, CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
         count(DISTINCT order_id) AS total_orders
  FROM fct GROUP BY 1)
SELECT CAST(day AS VARCHAR) AS metric_time, total_revenue, total_orders,
       total_revenue / total_orders AS avg_order_value
FROM spine LEFT JOIN m USING (day)""")
def _(t):
    out = semantic.metric_query(
        semantic.orders_model(i.fct_orders(t, dealt=True)),
        ["total_revenue", "total_orders", "avg_order_value"],
        spine=lh.time_spine_of(t.lineitem, "l_shipdate"),
    )
    return out.withColumn("metric_time", text("metric_time")).withColumn("total_revenue", number("total_revenue"))


@query("metric_query_by_product", f"""
WITH {i.ORDERS}
SELECT CAST(CAST(date_trunc('month', created_at) AS DATE) AS VARCHAR) AS metric_time, product_id,
       CAST(sum(total_amount) AS DOUBLE) / count(DISTINCT order_id) AS avg_order_value
FROM fct GROUP BY 1, 2""")
def _(t):
    model = semantic.orders_model(i.fct_orders(t, dealt=True))
    out = semantic.metric_query(model, ["avg_order_value"], grain="month", dims=["product_id"])
    return out.withColumn("metric_time", text("metric_time"))


# ---- data quality: the defects are made by rule, as the tables hold none


def broken_orders(t):
    """Order lines whose amount is 0 without tax and whose quantity is missing without discount."""
    orders = t.orders.select("o_orderkey", "o_custkey")
    return t.lineitem.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_discount") != 0, F.col("l_quantity")).alias("quantity"),
        F.when(F.col("l_tax") != 0, F.col("l_extendedprice")).otherwise(0.0).alias("total_amount"),
    )


BROKEN_ORDERS = """broken AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line, o_custkey AS customer_id, l_partkey AS product_id,
         CASE WHEN l_discount <> 0 THEN l_quantity END AS quantity,
         CASE WHEN l_tax <> 0 THEN l_extendedprice ELSE 0 END AS total_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def broken_products(t):
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_size") != 1, F.col("p_type")).otherwise("  ").alias("category"),
        F.when(F.col("p_size") != 2, F.col("p_retailprice")).alias("price"),
    )


BROKEN_PRODUCTS = """broken AS (
  SELECT p_partkey AS product_id, CASE WHEN p_size <> 1 THEN p_type ELSE '  ' END AS category,
         CASE WHEN p_size <> 2 THEN p_retailprice END AS price FROM part)"""


@query("dq_amount_positive", f"""
WITH {BROKEN_ORDERS} SELECT * FROM broken WHERE total_amount IS NULL OR total_amount <= 0""")
def _(t):
    return q.check_positive(broken_orders(t), "total_amount")


@query("dq_quantity_positive", f"""
WITH {BROKEN_ORDERS} SELECT * FROM broken WHERE quantity IS NULL OR quantity <= 0""")
def _(t):
    return q.check_positive(broken_orders(t), "quantity")


@query("dq_price_positive", f"WITH {BROKEN_PRODUCTS} SELECT * FROM broken WHERE price IS NULL OR price <= 0")
def _(t):
    return q.check_positive(broken_products(t), "price")


@query("dq_category_not_empty", f"""
WITH {BROKEN_PRODUCTS} SELECT * FROM broken WHERE category IS NULL OR trim(category) = ''""")
def _(t):
    return q.check_not_blank(broken_products(t), "category")


def known_customers(t):
    return t.customer.where(F.col("c_acctbal") >= 0)


def known_products(t):
    """All but every tenth product, so that some lines have a parent and some don't."""
    return t.part.where(F.col("p_partkey") % 10 != 0)


@query("dq_customer_fk", f"""
WITH {BROKEN_ORDERS}
SELECT broken.* FROM broken LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) c
  ON customer_id = c_custkey WHERE c_custkey IS NULL""")
def _(t):
    return q.check_fk(broken_orders(t), known_customers(t), "customer_id", "c_custkey")


@query("dq_product_fk", f"""
WITH {BROKEN_ORDERS}
SELECT broken.* FROM broken LEFT JOIN (SELECT p_partkey FROM part WHERE p_partkey % 10 <> 0) p
  ON product_id = p_partkey WHERE p_partkey IS NULL""")
def _(t):
    return q.check_fk(broken_orders(t), known_products(t), "product_id", "p_partkey")


@query("dq_unique_key", """
SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""")
def _(t):
    return q.check_unique(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("dq_suite", f"""
WITH {BROKEN_ORDERS}, {BROKEN_PRODUCTS.replace("broken AS", "products AS")},
v AS (
  SELECT 'amount_positive' AS "check", count(*) AS violations FROM broken WHERE NOT coalesce(total_amount > 0, false)
  UNION ALL SELECT 'quantity_positive', count(*) FROM broken WHERE NOT coalesce(quantity > 0, false)
  UNION ALL SELECT 'price_positive', count(*) FROM products WHERE NOT coalesce(price > 0, false)
  UNION ALL SELECT 'category_not_empty', count(*) FROM products WHERE coalesce(trim(category), '') = ''
  UNION ALL SELECT 'customer_fk', count(*) FROM broken
    WHERE customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
  UNION ALL SELECT 'product_fk', count(*) FROM broken
    WHERE product_id NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 10 <> 0))
SELECT "check", violations, violations = 0 AS passed FROM v""")
def _(t):
    orders, orphans = q.orphan_rules(broken_orders(t), {
        "customer_fk": (known_customers(t), "customer_id", "c_custkey"),
        "product_fk": (known_products(t), "product_id", "p_partkey"),
    })
    return q.run_suite([
        q.count_violations(orders, {
            "amount_positive": q.not_positive("total_amount"), "quantity_positive": q.not_positive("quantity"), **orphans,
        }),
        q.count_violations(broken_products(t), {
            "price_positive": q.not_positive("price"), "category_not_empty": q.blank("category"),
        }),
    ])
