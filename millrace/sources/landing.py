"""Landing-zone files: fixed schemas, reading, enriching, landing, wrapping of bad payloads."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions.constants import (
    BATCH_ORDER_DEFAULTS,
    CREATED_AT_FORMATS,
    NON_JSON_ERROR,
)

# Field names and types of the landed files.
#: Rows of a landed file at most: a compressed file is read by one task.
FILE_ROWS = 1_000_000
INGEST_FIELDS = "_ingest_time_utc string, _ingest_type string, _entity string"
MESSAGE_FIELDS = "_pubsub_message_id string, _pubsub_publish_time string"
ORDER_FIELDS = (
    "id long, customer_id long, product_id long, quantity int, "
    "total_amount double, currency string, created_at string"
)
SCHEMAS = {
    "customers": f"id long, name string, email string, country string, {INGEST_FIELDS}",
    "products": f"id long, name string, category string, price double, {INGEST_FIELDS}",
    "orders": f"{ORDER_FIELDS}, status string, source string, {MESSAGE_FIELDS}, {INGEST_FIELDS}",
    "live_orders": f"{ORDER_FIELDS}, {MESSAGE_FIELDS}, _ingest_time_utc string",
}


def path_part(pattern: str) -> Column:
    """A partition value cut from the file path, '' when the path has none.

    ``_metadata.file_path`` is constant per file, so a filter on it skips whole
    files at listing time; the value stays a string ('05' keeps its zero).
    """
    return F.regexp_extract(F.col("_metadata.file_path"), pattern, 1)


def lz_read(spark: SparkSession, entity: str, path: str, snapshot_dt: str | None = None) -> DataFrame:
    """Read one entity's NDJSON files with its fixed schema, source file and snapshot values.

    The snapshot values are partition columns, read as text ('' without such folders), so no row is
    worked on for them and a filter prunes folders.  ``path`` may be the entity's folder or one below it.
    """
    reader = spark.read.schema(SCHEMAS[entity] + ", snapshot_dt string, snapshot_ts string")
    root = path.split("/snapshot_dt=")[0]
    raw = (reader.option("basePath", root) if root != path else reader).json(path)
    df = raw.select(
        *[F.col(f.name) for f in raw.schema.fields if f.name not in ("snapshot_dt", "snapshot_ts")],
        F.col("_metadata.file_path").alias("_input_file"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("snapshot_dt", "snapshot_ts")],
    )
    return df if snapshot_dt is None else df.where(F.col("snapshot_dt") == snapshot_dt)


def require_snapshot(df: DataFrame) -> DataFrame:
    """Raise if any row lacks its snapshot values (stops at the first such row)."""
    missing = F.coalesce(F.col("snapshot_dt"), F.lit("")) == ""
    missing |= F.coalesce(F.col("snapshot_ts"), F.lit("")) == ""
    if not df.where(missing).isEmpty():
        raise ValueError("rows without snapshot_dt/snapshot_ts in their path")
    return df


def parse_first(col: Column, formats=CREATED_AT_FORMATS) -> Column:
    """Timestamp by the first format that fits, then by default parsing, else NULL."""
    tries = [F.try_to_timestamp(col, F.lit(f)) for f in formats]
    return F.coalesce(*tries, F.try_to_timestamp(col))


def unit_price(total: Column, quantity: Column) -> Column:
    """total / quantity, NULL if either is missing or the quantity is 0."""
    return F.try_divide(total.cast("double"), quantity.cast("double"))


def _trailer() -> list[Column]:
    return [
        F.try_to_timestamp(F.col("_ingest_time_utc")).alias("ingest_ts"),
        F.col("snapshot_dt"),
        F.col("snapshot_ts"),
        F.col("_input_file").alias("input_file"),
        F.col("_ingest_type").alias("ingest_type"),
        F.col("_entity").alias("entity"),
    ]


def normalize(entity: str, df: DataFrame) -> DataFrame:
    """Landed rows as bronze rows: typed, renamed, with derived and default values."""
    key = F.col("id").cast("long").alias("id")
    if entity == "customers":
        body = [key, F.col("name"), F.col("email"), F.col("country")]
    elif entity == "products":
        body = [key, F.col("name"), F.col("category"), F.col("price").cast("double").alias("price")]
    elif entity == "orders":
        body = [
            key,
            F.col("customer_id").cast("long").alias("customer_id"),
            F.col("product_id").cast("long").alias("product_id"),
            F.col("quantity").cast("int").alias("quantity"),
            unit_price(F.col("total_amount"), F.col("quantity")).alias("unit_price"),
            F.col("total_amount").cast("double").alias("total_amount"),
            F.col("currency"),
            parse_first(F.col("created_at")).alias("created_at"),
            *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in BATCH_ORDER_DEFAULTS.items()],
            F.col("_pubsub_message_id").alias("pubsub_message_id"),
            F.col("_pubsub_publish_time").alias("pubsub_publish_time"),
        ]
    else:
        raise ValueError(f"unknown entity {entity!r}")
    return df.select(*body, *_trailer())


def enrich(df: DataFrame, entity: str, ingest_ts: datetime) -> DataFrame:
    """Add ingest metadata, and for orders the default status and source where the column is absent."""
    out = (
        df.withColumn("_ingest_time_utc", F.lit(ingest_ts.astimezone(timezone.utc).isoformat()))
        .withColumn("_ingest_type", F.lit("batch"))
        .withColumn("_entity", F.lit(entity))
    )
    if entity == "orders":
        for name, value in BATCH_ORDER_DEFAULTS.items():
            if name not in out.columns:
                out = out.withColumn(name, F.lit(value))
    return out


def snapshot_land(df: DataFrame, entity: str, ingest_ts: datetime, root: str) -> str:
    """Write a full snapshot as NDJSON below ``root/entity/snapshot_dt=…/snapshot_ts=…``.

    Every task writes its own files, compressed by gzip, since names and repeated values are most of the text; a file
    ends after ``FILE_ROWS`` rows, as one can't be split by readers.  Landing the same snapshot again replaces it.
    Returns the entity's folder.
    """
    at = ingest_ts.astimezone(timezone.utc)
    folder = f"{root.rstrip('/')}/{entity}"
    leaf = f"{folder}/snapshot_dt={at:%Y-%m-%d}/snapshot_ts={at:%Y%m%dT%H%M%SZ}"
    writer = enrich(df, entity, ingest_ts).write.mode("overwrite").option("ignoreNullFields", "true")
    writer.option("compression", "gzip").option("maxRecordsPerFile", FILE_ROWS).json(leaf)
    return folder


def parse_or_wrap(df: DataFrame, raw: str, schema: str) -> DataFrame:
    """Parse a JSON object in a text column; keep all else as ``_corrupt_record`` with an error name.

    Numbers, strings, arrays and ``null`` are valid JSON but no records, so they are kept as well.  A field
    of the wrong type becomes NULL but the row still counts as a record.  A NULL payload has nothing to
    keep and gives NULLs alone.
    """
    names = StructType.fromDDL(schema).names
    parsed = F.from_json(F.col(raw), schema, {"mode": "PERMISSIVE"})
    # The second parse is for texts that begin like an object only.
    is_json = F.when(F.ltrim(F.col(raw)).startswith("{"), F.try_parse_json(F.col(raw)).isNotNull()).otherwise(
        F.col(raw).isNull())
    return df.withColumn("_parsed", parsed).withColumn("_is_json", is_json).select(
        *[F.col(c) for c in df.columns if c != raw],
        *[F.when(F.col("_is_json"), F.col(f"_parsed.{n}")).alias(n) for n in names],
        F.when(~F.col("_is_json"), F.col(raw)).alias("_corrupt_record"),
        F.when(~F.col("_is_json"), F.lit(NON_JSON_ERROR)).alias("_ingest_error"),
    )
