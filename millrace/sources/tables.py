"""Catalog tables: creation, idempotent writes, upserts, clustering."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ordering import latest_per_key

# Bronze table columns and partitions.
SNAPSHOT_TRAILER = (
    "ingest_ts timestamp, input_file string, ingest_type string, entity string, "
    "snapshot_dt string, snapshot_ts string"
)
BRONZE_TABLES = {
    "customers": ("id bigint, name string, email string, country string, " + SNAPSHOT_TRAILER,
                  ("snapshot_dt", "snapshot_ts")),
    "products": ("id bigint, name string, category string, price double, " + SNAPSHOT_TRAILER,
                 ("snapshot_dt", "snapshot_ts")),
    "orders": ("id bigint, customer_id bigint, product_id bigint, quantity int, unit_price double, "
               "total_amount double, currency string, created_at timestamp, status string, source string, "
               "pubsub_message_id string, pubsub_publish_time string, " + SNAPSHOT_TRAILER,
               ("snapshot_dt", "snapshot_ts")),
    "live_orders": ("id bigint, customer_id bigint, product_id bigint, quantity int, total_amount double, "
                    "unit_price double, currency string, status string, source string, created_at timestamp, "
                    "pubsub_message_id string, pubsub_publish_time timestamp, ingest_ts timestamp, "
                    "ingest_dt string, ingest_hr string, input_file string, ingest_date date, run string, "
                    "batch int",
                    ("ingest_date", "run", "batch")),
}


def ensure_table(
    spark: SparkSession,
    table: str,
    columns: str,
    partitions: Sequence[str] = (),
    location: str | None = None,
    reset: bool = False,
) -> None:
    """Create the database and partitioned parquet table if missing; ``reset`` drops the table first."""
    if "." in table:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {table.rsplit('.', 1)[0]}")
    if reset:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{by}{at}")


def _in_table_order(df: DataFrame, table: str) -> DataFrame:
    target = df.sparkSession.table(table).schema
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])


def _by_partition(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Bring the rows of a partition together, so that it is not written as one file per task.

    The rebalance hint lets adaptive execution split a hot partition over many tasks
    and combine small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in partitions]) if partitions else df


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace exactly the partitions that occur in ``df``; writing twice changes nothing.

    The table's folder is written with the mode set for this write alone (``insertInto`` would take it
    from the session, where writes of other threads would see it), then new partitions are registered.
    A table without partitions is replaced.
    """
    spark = df.sparkSession
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    rows = _in_table_order(df, table)
    if not partitions:
        rows.write.mode("overwrite").insertInto(table)
        return
    where = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").first()["data_type"]
    write_folder(rows, where, partitions)
    spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def append(df: DataFrame, table: str) -> None:
    """Append, with columns picked by name and put in the table's order."""
    _in_table_order(df, table).write.insertInto(table)


def write_folder(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Partition-idempotent write to a parquet folder without a catalog entry."""
    writer = _by_partition(df, partitions).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partitions).parquet(path)


def replace_table(df: DataFrame, table: str, location: str | None = None) -> None:
    """Create or replace a table from a query."""
    writer = df.write.mode("overwrite").format("parquet")
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def write_clustered(
    df: DataFrame, table: str, cluster: Sequence[str], buckets: int, location: str | None = None
) -> None:
    """Replace a table bucketed and sorted by its lookup columns, so joins on them need no shuffle."""
    writer = df.write.mode("overwrite").format("parquet").bucketBy(buckets, *cluster).sortBy(*cluster)
    if location:
        writer = writer.option("path", location)
    writer.saveAsTable(table)


def upsert(
    target: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    extra: Mapping[str, Column] | None = None,
    order: Sequence[Column] = (),
) -> DataFrame:
    """MERGE as a DataFrame: matched rows take ``update`` columns from ``delta``, new rows are added whole.

    ``extra`` sets columns on changed and new rows (for example the time of the
    change).  Both sides are hashed on the key once; rows without a match pass through.

    Two rows of ``delta`` with one key end the job, as MERGE does, unless ``order`` says which comes
    first: that one is taken.  NULL keys match nothing.
    """
    t = target.withColumn("_t", F.lit(True))
    rest = [c for c in delta.columns if c not in keys]
    row = F.struct(F.lit(True).alias("_s"), *rest)
    if order:
        picked = latest_per_key(delta, list(keys), list(order)).withColumn("_s", F.lit(True))
    else:
        # NULL keys stay apart: they match nothing and aren't duplicates of each other.
        named = delta.where(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])).withColumn("_s", F.lit(True))
        grouped = delta.dropna(subset=list(keys)).groupBy(*keys).agg(F.first(row).alias("_r"), F.count(F.lit(1)).alias("_n"))
        checked = F.when(F.col("_n") == 1, F.col("_r")).otherwise(
            F.raise_error(F.concat_ws(", ", F.lit("several source rows for the key"), *[F.col(k).cast("string") for k in keys])))
        picked = grouped.select(*keys, checked.alias("_r")).select(*keys, "_r.*").unionByName(
            named.select(*keys, "_s", *rest))
    s = picked
    cond = F.lit(True)
    for k in keys:
        cond = cond & (F.col(f"t.{k}") == F.col(f"s.{k}"))
    joined = t.alias("t").join(s.alias("s"), cond, "full_outer")
    touched, is_new = F.col("s._s").isNotNull(), F.col("t._t").isNull()
    out = []
    for c in target.columns:
        old = F.col(f"t.{c}")
        new = F.col(f"s.{c}") if c in delta.columns else F.lit(None).cast(target.schema[c].dataType)
        if extra and c in extra:
            value = F.when(touched, extra[c]).otherwise(old)
        elif c in keys:
            value = F.coalesce(old, new)
        elif c in update:
            value = F.when(touched, new).otherwise(old)
        else:
            value = F.when(is_new, new).otherwise(old)
        out.append(value.alias(c))
    return joined.select(*out)
