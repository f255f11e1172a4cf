"""Logs of model calls and retrievals, written from the output of the jobs that made them.

A run's rows go to a partition of their own, replaced as a unit: running a job again under the same run id changes
nothing, and runs of other ids are never touched.  What a run wrote is counted by the same job that writes it
(``Observation``), and its line in the run log is written last.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators.monitor import LOG_SCHEMAS
from millrace.sources.tables import write_folder

# Fixed value: columns of the run log.
RUN_SCHEMA = "log string, run string, created_at timestamp, row_count long, failed long"


def _words(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != "")).cast("long")


def call_rows(
    answers: DataFrame, run: str, created_at: dt.datetime, prompt_id: str, prompt_version: int, model: str,
    prompt: str = "prompt", output: str = "output_text", key: str = "ticket_id", params_json: str = "{}",
) -> DataFrame:
    """Call-log rows of generated texts: one per row of ``answers``, an error where there is no output.

    The call's id is the run and the row's key, so a repeated run has the same ids; tokens are counted as words.
    """
    rows = answers.select(
        F.concat_ws(":", F.lit(run), F.col(key).cast("string")).alias("run_id"), F.lit(run).alias("parent_run_id"),
        F.lit(created_at).cast("timestamp").alias("created_at"), F.lit(prompt_id).alias("prompt_id"),
        F.lit(prompt_version).cast("long").alias("prompt_version"), F.lit(model).alias("model"), F.lit(params_json).alias("params_json"),
        F.sha2(F.coalesce(F.col(prompt), F.lit("")), 256).alias("input_hash"), F.lit(None).cast("string").alias("retrieval_run_id"),
        _words(F.col(prompt)).alias("tokens_in"), _words(F.col(output)).alias("tokens_out"), F.lit(None).cast("long").alias("latency_ms"),
        F.when(F.col(output).isNull(), "error").otherwise("ok").alias("status"), F.col(output).alias("output_text"))
    return rows


def retrieval_rows(
    found: DataFrame, run: str, created_at: dt.datetime, config: str, model: str, version: str, key: str = "ticket_id", query: Column | None = None,
) -> DataFrame:
    """Retrieval-log rows of hits (``key``, chunk_id, distance): one per query, its hits by distance.

    A query has the few hits that the retrieval kept.
    """
    hits = F.transform(F.array_sort(F.collect_list(F.struct("distance", "chunk_id"))), lambda h: F.struct(
        h["chunk_id"].cast("string").alias("chunk_id"), h["distance"].alias("distance")))
    hashed = F.md5(F.col(key).cast("string") if query is None else query)
    return found.groupBy(key).agg(hits.alias("retrieved")).select(
        F.concat_ws(":", F.lit(run), F.col(key).cast("string")).alias("retrieval_run_id"),
        F.lit(created_at).cast("timestamp").alias("created_at"), F.lit(config).alias("retrieval_config_id"),
        F.lit(model).alias("embedding_model"), F.lit(version).alias("embedding_version"), hashed.alias("query_hash"), "retrieved")


def write_run(rows: DataFrame, folder: str, log: str, run: str, created_at: dt.datetime) -> int:
    """Write ``rows`` as this run's part of ``log`` (a name of LOG_SCHEMAS) below ``folder``; how many they were.

    Columns are picked by name and cast to the log's schema; a missing one ends the run before anything is written.
    """
    spark = rows.sparkSession
    target = spark.createDataFrame([], LOG_SCHEMAS[log]).schema
    typed = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])
    counted = Observation()
    status = F.col("status") if "status" in typed.columns else F.lit("ok")
    observed = typed.observe(counted, F.count(F.lit(1)).alias("row_count"), F.count_if(status == "error").alias("failed"))
    write_folder(observed.withColumn("run", F.lit(run)), f"{folder}/{log}", ["run"])
    told = counted.get
    line = spark.createDataFrame([(log, run, created_at, told["row_count"], told["failed"])], RUN_SCHEMA)
    write_folder(line.coalesce(1), f"{folder}/runs", ["log", "run"])
    return told["row_count"]


def read_log(spark: SparkSession, folder: str, log: str) -> DataFrame:
    """The rows of all finished runs of a log: those with a line in the run log."""
    schema = spark.createDataFrame([], f"{LOG_SCHEMAS[log]}, run string").schema
    rows = spark.read.schema(schema).parquet(f"{folder}/{log}")
    done = spark.read.schema(RUN_SCHEMA).parquet(f"{folder}/runs").where(F.col("log") == log).select("run")
    return rows.join(done, "run", "left_semi").drop("run")
