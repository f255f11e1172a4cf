"""Session settings, table loading and the shared work folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that results depend on; leave sizing to the cluster."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One parquet table of a test-data folder."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local-mode session, where driver and executors share one disk, may
    fall back to a fresh temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        # setCheckpointDir appends one random folder to the path it was given
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


_WORK: set[str] = set()


def work_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder; ``clean_work`` removes it."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _WORK.add(path)
    return path


def clean_work(spark: SparkSession | None = None) -> None:
    """Remove the work folders made so far.  DataFrames that read them can't be used any more.

    Runs by itself at the end of the program, if the session is still there.
    """
    spark = spark or SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _WORK:
        path = spark._jvm.org.apache.hadoop.fs.Path(_WORK.pop())
        path.getFileSystem(conf).delete(path, True)


atexit.register(clean_work)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder once and cut its lineage.

    Used where a result is read several times, or where a value must not change
    between readings (for example which range partition a row landed in).  The
    files survive the loss of any executor.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
