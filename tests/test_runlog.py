"""Logs written from job output: idempotent, complete, and fit for the daily views."""

import datetime as dt

import pytest

from millrace.operators import monitor, runlog
from millrace.session import work_path

AT = dt.datetime(2024, 1, 30, 12)


def answers(spark):
    return spark.createDataFrame(
        [(1, "say  one two", "one two"), (2, "", ""), (3, "fails", None)], "ticket_id long, prompt string, output_text string")


def write(spark, folder, run, rows=None):
    calls = runlog.call_rows(answers(spark) if rows is None else rows, run, AT, "summary", 3, "offline")
    return runlog.write_run(calls, folder, "llm_calls", run, AT)


def test_runs_are_written_once(spark):
    folder = work_path(spark, "logs")
    assert write(spark, folder, "a") == 3 and write(spark, folder, "a") == 3 and write(spark, folder, "b") == 3
    log = runlog.read_log(spark, folder, "llm_calls")
    assert log.count() == 6 and log.select("run_id").distinct().count() == 6
    daily = monitor.llm_calls_daily(log).collect()
    assert [(r["call_count"], r["error_count"], r["tokens_in"], r["tokens_out"]) for r in daily] == [(6, 2, 8, 4)]
    runs = {r["run"]: (r["row_count"], r["failed"]) for r in spark.read.parquet(f"{folder}/runs").collect()}
    assert runs == {"a": (3, 1), "b": (3, 1)}


def test_unfinished_runs_are_not_read(spark, monkeypatch):
    folder = work_path(spark, "logs")
    write(spark, folder, "a")
    real = runlog.write_folder

    def dies(df, path, partitions):
        if path.endswith("/runs"):
            raise RuntimeError("driver lost")
        real(df, path, partitions)

    with monkeypatch.context() as m:
        m.setattr(runlog, "write_folder", dies)
        with pytest.raises(RuntimeError):
            write(spark, folder, "b")
    assert runlog.read_log(spark, folder, "llm_calls").count() == 3
    write(spark, folder, "b")
    assert runlog.read_log(spark, folder, "llm_calls").count() == 6


def test_retrievals_and_odd_rows(spark):
    folder = work_path(spark, "logs")
    hits = spark.createDataFrame([(1, "c2", 0.5), (1, "c1", 0.2), (2, "c1", 0.9), (None, "c3", 0.1)], "ticket_id long, chunk_id string, distance double")
    rows = runlog.retrieval_rows(hits, "r", AT, "top5", "hashed", "1")
    assert runlog.write_run(rows, folder, "retrieval_runs", "r", AT) == 3
    got = {r["retrieval_run_id"]: [tuple(h) for h in r["retrieved"]] for r in runlog.read_log(spark, folder, "retrieval_runs").collect()}
    assert got == {"r:1": [("c1", 0.2), ("c2", 0.5)], "r:2": [("c1", 0.9)], "r": [("c3", 0.1)]}
    daily = monitor.retrieval_runs_daily(runlog.read_log(spark, folder, "retrieval_runs")).first()
    assert daily["run_count"] == 3
    assert write(spark, folder, "none", answers(spark).limit(0)) == 0
    with pytest.raises(Exception, match="retrieved"):
        runlog.write_run(rows.drop("retrieved"), folder, "retrieval_runs", "s", AT)
