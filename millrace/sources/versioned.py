"""Merges into a stored table that rewrite only the files they touch and are seen whole or not at all.

A table is a folder of immutable parquet files (``data/``), file lists with the rows and key ranges of each file
(``manifests/``), and a numbered marker per version (``versions/``) that names its file list.  A marker is
created only if its number is free, after everything it refers to is written: a job that fails before leaves the
table as it was, readers go on with the version they began with, and of two writers that start from one version the
second one fails.  Files that no kept version names are removed by ``vacuum``.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import materialize
from millrace.sources.tables import upsert

#: Rows of a file, about, and bytes before it is encoded: each file is written by one task.
FILE_ROWS, FILE_BYTES = 4_000_000, 256 << 20


class VersionConflict(RuntimeError):
    """Another writer has made the version that this one was about to make."""


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def latest_version(spark: SparkSession, path: str) -> int:
    """The number of the newest version, -1 without any."""
    at, fs = _files(spark, f"{path}/versions")
    if not fs.exists(at):
        return -1
    return max((int(s.getPath().getName()) for s in fs.listStatus(at) if s.getPath().getName().isdigit()), default=-1)


def _commit(spark: SparkSession, path: str, version: int, manifest: str) -> None:
    """A marker, complete under a name of its own first; the rename fails if the number is taken."""
    at, fs = _files(spark, f"{path}/versions/{version:010d}")
    draft, _ = _files(spark, f"{path}/versions/.{manifest}")
    out = fs.create(draft, False)
    out.write(bytearray(manifest.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(draft, at, plain)
    except Exception as taken:
        if fs.exists(at):
            fs.delete(draft, False)
            raise VersionConflict(f"version {version} of {path} exists") from taken
        raise


def manifest(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The files of a version: file (below the table's folder), rows, lo and hi (structs of the keys, NULLs apart)."""
    number = latest_version(spark, path) if version is None else version
    at, fs = _files(spark, f"{path}/versions/{number:010d}")
    if number < 0 or not fs.exists(at):
        raise FileNotFoundError(f"{path} has no version {number}")
    name = spark.read.text(f"{path}/versions/{number:010d}").first()[0]
    return spark.read.parquet(f"{path}/manifests/{name}")


def _read_files(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    return spark.read.parquet(*[f"{path}/{f}" for f in files])


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version (the newest by default).  The list of files goes through the driver, as any scan's does."""
    found = manifest(spark, path, version)
    files = [r["file"] for r in found.where("rows > 0").select("file").collect()]
    if files:
        return _read_files(spark, path, files)
    # A version without rows keeps the columns in its empty files.
    return spark.read.parquet(*[f"{path}/{r['file']}" for r in found.select("file").collect()]).limit(0)


def _file_column() -> Column:
    return F.regexp_extract(F.col("_metadata.file_path"), r"(data/[^/]+/[^/]+)$", 1)


def _write(df: DataFrame, path: str, keys: Sequence[str], parts: int) -> DataFrame:
    """New files of ``df`` with disjoint key ranges, and their entries for a file list."""
    spark, folder = df.sparkSession, f"data/{uuid.uuid4().hex}"
    order = [F.col(k) for k in keys]
    df.repartitionByRange(parts, *order).sortWithinPartitions(*order).write.parquet(f"{path}/{folder}")
    written = spark.read.schema(df.schema).parquet(f"{path}/{folder}")
    complete = reduce(lambda a, b: a & b, [c.isNotNull() for c in order])
    entry = F.struct(*keys)
    entries = written.groupBy(_file_column().alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(F.when(complete, entry)).alias("lo"), F.max(F.when(complete, entry)).alias("hi"))
    if not entries.isEmpty():
        return entries
    at, fs = _files(spark, f"{path}/{folder}")
    names = [s.getPath().getName() for s in fs.listStatus(at) if s.getPath().getName().endswith(".parquet")]
    kinds = ", ".join(f"`{k}`: {df.schema[k].dataType.simpleString()}" for k in keys)
    return spark.createDataFrame([(f"{folder}/{n}", 0, None, None) for n in names], f"file string, rows long, lo struct<{kinds}>, hi struct<{kinds}>")


def _parts(*tables: DataFrame) -> int:
    """The number of files for the rows of all ``tables``, by rows and by bytes."""
    rows = size = 0
    for df in tables:
        widths = [
            F.octet_length(F.col(f"`{f.name}`")) if f.dataType.typeName() in ("string", "binary")
            else F.size(F.col(f"`{f.name}`")) * 8 if f.dataType.typeName() == "array" else F.lit(8)
            for f in df.schema]
        width = reduce(lambda a, b: a + b, [F.greatest(F.coalesce(w, F.lit(0)), F.lit(0)).cast("long") for w in widths])
        found = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("size")).first()
        rows, size = rows + found["rows"], size + found["size"]
    return max(1, -(-rows // FILE_ROWS), -(-size // FILE_BYTES))


def create(df: DataFrame, path: str, keys: Sequence[str], parts: int | None = None) -> int:
    """Version 0 of a table: ``df`` in ``parts`` files (by rows and bytes, unless given) of disjoint key ranges."""
    spark = df.sparkSession
    if parts is None:
        df = materialize(df)
        parts = _parts(df)
    name = uuid.uuid4().hex
    _write(df, path, keys, parts).write.parquet(f"{path}/manifests/{name}")
    _commit(spark, path, 0, name)
    return 0


def touched_files(spark: SparkSession, path: str, delta: DataFrame, keys: Sequence[str], version: int) -> DataFrame:
    """The entries of the files that hold a key of ``delta``.

    Files out of the delta's range of keys are left out by the file list; of the others the key columns alone are
    read and joined.
    """
    entries = manifest(spark, path, version)
    asked = delta.select(*keys).dropna().distinct()
    span = asked.agg(F.min(F.struct(*keys)).alias("lo"), F.max(F.struct(*keys)).alias("hi"))
    near = entries.join(span.select(F.col("lo").alias("from"), F.col("hi").alias("to")), F.lit(True)).where(
        (F.col("hi") >= F.col("from")) & (F.col("lo") <= F.col("to")))
    files = [r["file"] for r in near.select("file").collect()]
    if not files:
        return entries.limit(0)
    held = _read_files(spark, path, files).select(*keys, _file_column().alias("file"))
    return entries.join(held.join(asked, list(keys), "left_semi").select("file").distinct(), "file", "left_semi")


def merge(
    spark: SparkSession,
    path: str,
    delta: DataFrame,
    keys: Sequence[str],
    update: Sequence[str],
    extra: Mapping[str, Column] | None = None,
    order: Sequence[Column] = (),
) -> int:
    """MERGE ``delta`` into the table and return the new version.

    Matched rows take the columns ``update``, other rows of the delta are added whole, ``extra`` and ``order`` are
    those of ``upsert``.  Only files with a matched key are rewritten; the others keep their names.  NULL keys match
    nothing.  An empty delta makes no version.
    """
    version = latest_version(spark, path)
    delta = materialize(delta)
    if delta.isEmpty():
        return version
    touched = materialize(touched_files(spark, path, delta, keys, version))
    rewritten = touched.collect()  # an entry per file to rewrite
    current = read(spark, path, version)
    old = _read_files(spark, path, [r["file"] for r in rewritten]).select(*current.columns) if rewritten else current.limit(0)
    fresh = _write(upsert(old, delta, keys, update, extra, order), path, keys, _parts(old, delta))
    kept = manifest(spark, path, version).join(touched.select("file"), "file", "left_anti")
    name = uuid.uuid4().hex
    kept.unionByName(fresh).where("rows > 0").write.parquet(f"{path}/manifests/{name}")
    _commit(spark, path, version + 1, name)
    return version + 1


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Forget all but the newest ``keep`` versions and remove the folders of data that none of those names.

    Not while a merge runs: its files aren't named yet.  Returns the removed folders.
    """
    newest = latest_version(spark, path)
    at, fs = _files(spark, f"{path}/versions")
    numbers = sorted(int(s.getPath().getName()) for s in fs.listStatus(at) if s.getPath().getName().isdigit())
    kept = [n for n in numbers if n > newest - keep]
    named = {
        r["folder"] for n in kept for r in manifest(spark, path, n).select(
            F.substring_index("file", "/", 2).alias("folder")).distinct().collect()}
    for n in numbers:
        if n not in kept:
            fs.delete(_files(spark, f"{path}/versions/{n:010d}")[0], False)
    data, fs = _files(spark, f"{path}/data")
    gone = [f"data/{s.getPath().getName()}" for s in fs.listStatus(data) if f"data/{s.getPath().getName()}" not in named]
    for folder in gone:
        fs.delete(_files(spark, f"{path}/{folder}")[0], True)
    return gone
