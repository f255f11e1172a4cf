"""Live orders: files to an idempotent bronze table with quarantine, as a structured stream."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.constants import (
    INGEST_DT_PATTERN,
    INGEST_HR_PATTERN,
    QUARANTINE_REASON,
    STREAM_CREATED_AT_FORMAT,
    STREAM_ORDER_DEFAULTS,
)
from millrace.operators.quality import order_rule, split
from millrace.sources.landing import SCHEMAS, path_part, unit_price
from millrace.sources.tables import BRONZE_TABLES, ensure_table

# Fixed value: columns of the live-orders table, partition columns last.
LIVE_COLUMNS = (
    "id", "customer_id", "product_id", "quantity", "total_amount", "unit_price", "currency", "status",
    "source", "created_at", "pubsub_message_id", "pubsub_publish_time", "ingest_ts", "ingest_dt",
    "ingest_hr", "input_file",
)


def read_order_files(spark: SparkSession, path: str, max_files: int = 50) -> DataFrame:
    """Stream of landed order lines with fixed schema, source file and path partition values."""
    raw = (
        spark.readStream.schema(SCHEMAS["live_orders"])
        .option("maxFilesPerTrigger", max_files)
        .json(path)
    )
    return raw.select(
        *[c for c in raw.columns if c not in ("ingest_dt", "ingest_hr")],
        F.col("_metadata.file_path").alias("input_file"),
        path_part(INGEST_DT_PATTERN).alias("ingest_dt"),
        path_part(INGEST_HR_PATTERN).alias("ingest_hr"),
    )


def stream_normalize(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Typed, defaulted order rows; path values fall back to the clock ``now``."""
    now = F.current_timestamp() if now is None else now

    def from_path(col: str, pattern: str) -> Column:
        return F.coalesce(F.nullif(F.col(col), F.lit("")), F.date_format(now, pattern))

    return df.select(
        "id", "customer_id", "product_id", "quantity", "total_amount",
        unit_price(F.col("total_amount"), F.col("quantity")).alias("unit_price"),
        "currency",
        *[F.lit(v).alias(c) for c, v in STREAM_ORDER_DEFAULTS.items()],
        "created_at",
        F.try_to_timestamp(F.col("created_at"), F.lit(STREAM_CREATED_AT_FORMAT)).alias("created_at_ts"),
        F.col("_pubsub_message_id").alias("pubsub_message_id"),
        F.try_to_timestamp(F.col("_pubsub_publish_time")).alias("pubsub_publish_time"),
        F.try_to_timestamp(F.col("_ingest_time_utc")).alias("ingest_time_utc"),
        now.alias("ingest_ts"),
        F.to_date(now).alias("ingest_date"),
        from_path("ingest_dt", "yyyy-MM-dd").alias("ingest_dt"),
        from_path("ingest_hr", "HH").alias("ingest_hr"),
        "input_file",
    )


def write_batch(table_path: str, quarantine_path: str, now: Column | None = None, run_id: str | None = None):
    """A ``foreachBatch`` function: normalise, split, write both parts under their batch id.

    Rows lie in ``ingest_date=<day>/run=<query id>/batch=<id>``, so a reader of some days
    lists those alone; ``compact_day`` puts the batches of a closed day together.  Each batch
    owns its folders under all days and replaces them, so a batch replayed after a failure, even
    past midnight, leaves the same rows as one that ran once.  The query id lives in the
    checkpoint: a stream started with a new checkpoint counts its batches from 0 again but
    writes beside the old ones.  Outside of a
    stream ``run_id`` has to name the run; without either the batch is refused, since two streams
    would overwrite each other.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        run_name = run_id or batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not run_name:
            raise ValueError("no streaming query id: pass run_id")
        own = f"run={run_name}/batch={batch_id}"
        rows = stream_normalize(batch, now).persist()
        try:
            good, bad = split(rows, order_rule())
            _remove(batch.sparkSession, f"{table_path}/ingest_date=*/{own}")
            (
                good.withColumn("created_at", F.col("created_at_ts"))
                .select(*LIVE_COLUMNS, "ingest_date", F.lit(run_name).alias("run"), F.lit(batch_id).alias("batch"))
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("ingest_date", "run", "batch")
                .parquet(table_path)
            )
            if not bad.isEmpty():
                (
                    bad.withColumn("quarantine_reason", F.lit(QUARANTINE_REASON))
                    .write.mode("overwrite")
                    .json(f"{quarantine_path}/{own}")
                )
        finally:
            rows.unpersist()

    return run


def _remove(spark: SparkSession, pattern: str) -> None:
    """Delete the folders that a path pattern names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for found in fs.globStatus(path) or []:
        fs.delete(found.getPath(), True)


def compact_day(spark: SparkSession, table_path: str, day: str) -> None:
    """Put the batches of a day that gets no more of them into few files.

    The new folder appears whole, then the old ones go.  A reader in between sees rows twice,
    which the newest-version-per-id of ``live_orders_latest`` hides; a run that fails in between
    is made good by running again after removing the folder it left.
    """
    folder = f"{table_path}/ingest_date={day}"
    run = f"compacted-{uuid.uuid4().hex}"
    rows = spark.read.parquet(folder).drop("run", "batch")
    staged = f"{table_path}/_{run}"
    rows.hint("rebalance").write.parquet(f"{staged}/batch=0")
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    old = [s.getPath() for s in fs.globStatus(path(f"{folder}/run=*"))]
    if not fs.rename(path(staged), path(f"{folder}/run={run}")):
        raise OSError(f"could not move {staged}")
    for done in old:
        fs.delete(done, True)


def start_orders_stream(
    spark: SparkSession,
    in_path: str,
    table_path: str,
    quarantine_path: str,
    checkpoint: str,
    max_files: int = 50,
    trigger_seconds: int | None = 15,
    now: Column | None = None,
    name: str = "live_orders",
) -> StreamingQuery:
    """Start the stream.  ``trigger_seconds=None`` takes what is there now and stops."""
    writer = (
        read_order_files(spark, in_path, max_files)
        .writeStream.queryName(name)
        .foreachBatch(write_batch(table_path, quarantine_path, now))
        .option("checkpointLocation", checkpoint)
    )
    if trigger_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{trigger_seconds} seconds").start()


def live_orders_table(spark: SparkSession, table: str, table_path: str) -> DataFrame:
    """The stream's folder as a catalog table with all partitions written so far."""
    columns, partitions = BRONZE_TABLES["live_orders"]
    ensure_table(spark, table, columns, partitions, location=table_path)
    spark.catalog.recoverPartitions(table)
    return spark.table(table)


def ttl_seconds(ttl: str) -> int:
    """'10m', '2h' or plain seconds."""
    m = re.fullmatch(r"\s*(\d+)\s*([smh]?)\s*", ttl.lower())
    if not m:
        raise ValueError(f"not a duration: {ttl!r}")
    return int(m[1]) * {"": 1, "s": 1, "m": 60, "h": 3600}[m[2]]


def run_for(query: StreamingQuery, ttl: str | None = None) -> bool:
    """Wait for the query; stop it when ``ttl`` is over.  True if it ended by itself."""
    if ttl is None:
        query.awaitTermination()
        return True
    ended = query.awaitTermination(ttl_seconds(ttl))
    if not ended:
        query.stop()
    return bool(ended)


def preview(df: DataFrame, checkpoint: str, seen: list, rows: int = 10) -> StreamingQuery:
    """Append (batch id, row count, first rows) of each available batch to ``seen``."""

    def look(batch: DataFrame, batch_id: int) -> None:
        seen.append((batch_id, batch.count(), batch.limit(rows).collect()))

    return df.writeStream.foreachBatch(look).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_per_key(stream: DataFrame, key: str = "id", ts: str = "created_at", lateness: str = "48 hours") -> DataFrame:
    """Streaming deduplication: the first row per key within the lateness horizon."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([key])
