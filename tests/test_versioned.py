"""Merges into stored tables: files touched, crashes, conflicts, old versions."""

import pytest
from pyspark.sql import functions as F

from millrace.session import work_path
from millrace.sources import versioned


@pytest.fixture
def table(spark):
    path = work_path(spark, "merged")
    rows = spark.range(1000).select("id", (F.col("id") % 7).alias("n"), F.lit("old").alias("state"))
    versioned.create(rows, path, ["id"], parts=10)
    return path


def content(df):
    return sorted(map(tuple, df.select("id", "n", "state").collect()), key=repr)


def delta_of(spark, ids):
    return spark.createDataFrame([(i, 100) for i in ids], "id long, n long")


def merge(spark, path, ids):
    return versioned.merge(spark, path, delta_of(spark, ids), ["id"], ["n"], {"state": F.lit("new")})


def want(ids, upto=1000):
    return sorted([(i, 100, "new") if i in ids else (i, i % 7, "old") for i in set(range(upto)) | set(ids)], key=repr)


def names(spark, path, version=None):
    return {r["file"] for r in versioned.manifest(spark, path, version).collect()}


def test_only_touched_files_are_rewritten(spark, table):
    before = names(spark, table)
    assert len(before) == 10 and content(versioned.read(spark, table)) == want(set())
    ranges = {r["file"]: (r["lo"]["id"], r["hi"]["id"]) for r in versioned.manifest(spark, table).collect()}
    ids = [5, 6, 990, 5000]
    assert merge(spark, table, ids) == 1
    after = names(spark, table)
    hit = {f for f, (lo, hi) in ranges.items() if any(lo <= i <= hi for i in ids)}
    assert before - after == hit and len(hit) == 2
    assert content(versioned.read(spark, table)) == want(set(ids))
    # New rows alone rewrite nothing.
    assert merge(spark, table, [6000, 6001]) == 2
    assert after <= names(spark, table)
    assert content(versioned.read(spark, table)) == want({*ids, 6000, 6001})
    # Old versions stay readable.
    assert content(versioned.read(spark, table, 0)) == want(set())


def test_crash_before_the_commit(spark, table, monkeypatch):
    """A job that dies between writing and committing leaves the table as it was, and can be run again."""
    def dies(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(versioned, "_commit", dies)
        with pytest.raises(RuntimeError, match="driver lost"):
            merge(spark, table, [1, 2])
    assert versioned.latest_version(spark, table) == 0
    assert content(versioned.read(spark, table)) == want(set())
    assert merge(spark, table, [1, 2]) == 1
    assert content(versioned.read(spark, table)) == want({1, 2})


def test_two_writers(spark, table, monkeypatch):
    """The second of two merges from one version fails, and reads see the first."""
    real = versioned.latest_version
    merge(spark, table, [1])
    monkeypatch.setattr(versioned, "latest_version", lambda *_: 0)
    with pytest.raises(versioned.VersionConflict):
        merge(spark, table, [2])
    monkeypatch.setattr(versioned, "latest_version", real)
    assert content(versioned.read(spark, table)) == want({1})


def test_reader_keeps_its_version(spark, table):
    reading = versioned.read(spark, table)
    merge(spark, table, [3])
    assert content(reading) == want(set())


def test_vacuum(spark, table):
    merge(spark, table, [3])
    merge(spark, table, [3, 999])
    assert versioned.vacuum(spark, table, keep=3) == []
    first = {f.rsplit("/", 1)[0] for f in names(spark, table, 1)}
    gone = versioned.vacuum(spark, table, keep=1)
    kept = {f.rsplit("/", 1)[0] for f in names(spark, table)}
    assert gone and set(gone) <= first and not set(gone) & kept
    assert content(versioned.read(spark, table)) == want({3, 999})
    with pytest.raises(FileNotFoundError):
        versioned.read(spark, table, 0)


def test_odd_keys(spark):
    """NULL and repeated keys, keys of two columns, empty tables and deltas."""
    path = work_path(spark, "merged")
    schema = "a string, b long, v string"
    versioned.create(spark.createDataFrame([("x", 1, "p"), (None, 2, "q"), ("x", None, "r")], schema), path, ["a", "b"])
    delta = spark.createDataFrame([("x", 1, "P"), (None, 2, "Q"), ("y", 1, "N")], schema)
    versioned.merge(spark, path, delta, ["a", "b"], ["v"])
    got = sorted(map(tuple, versioned.read(spark, path).collect()), key=repr)
    assert got == sorted([("x", 1, "P"), (None, 2, "q"), (None, 2, "Q"), ("x", None, "r"), ("y", 1, "N")], key=repr)
    assert versioned.merge(spark, path, delta.limit(0), ["a", "b"], ["v"]) == 1
    twice = spark.createDataFrame([("x", 1, "1"), ("x", 1, "2")], schema)
    with pytest.raises(Exception, match="several source rows"):
        versioned.merge(spark, path, twice, ["a", "b"], ["v"])
    assert versioned.latest_version(spark, path) == 1
    versioned.merge(spark, path, twice, ["a", "b"], ["v"], order=[F.desc("v")])
    assert [r["v"] for r in versioned.read(spark, path).where("a = 'x' AND b = 1").collect()] == ["2"]
    empty = work_path(spark, "merged")
    versioned.create(spark.createDataFrame([], schema), empty, ["a", "b"])
    assert versioned.read(spark, empty).count() == 0
    versioned.merge(spark, empty, delta, ["a", "b"], ["v"])
    assert versioned.read(spark, empty).count() == 3


def test_wide_rows_make_more_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versioned, "FILE_BYTES", 100_000)
    df = spark.range(1000).selectExpr("id", "array_repeat(double(id), 100) AS v", "CAST(NULL AS string) AS s")
    versioned.create(df, str(tmp_path / "t"), ["id"])
    assert versioned.manifest(spark, str(tmp_path / "t")).count() == 9  # 816 bytes a row
    assert versioned.read(spark, str(tmp_path / "t")).count() == 1000
