"""Landing zone, tables, stream: files with defects, replays and restarts."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from millrace.operators import quality as q
from millrace.plans import lakehouse as lh
from millrace.plans import semantic
from millrace.sources import landing as lz
from millrace.sources import tables as tb
from millrace.streaming import orders as live

T0 = dt.datetime(2026, 1, 6, 11, 30, tzinfo=dt.timezone.utc)


def put(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n")


def table(spark, tmp_path, entity):
    columns, partitions = tb.BRONZE_TABLES[entity]
    name = f"t_{uuid.uuid4().hex[:10]}"
    tb.ensure_table(spark, name, columns, partitions, str(tmp_path / name))
    return name


def test_orders_from_files(spark, tmp_path):
    leaf = tmp_path / "orders" / "snapshot_dt=2026-01-06" / "snapshot_ts=20260106T113000Z"
    put(leaf / "a.ndjson", [
        {"id": 1, "customer_id": 2, "product_id": 3, "quantity": 4, "total_amount": 10.0, "currency": "EUR",
         "created_at": "2026-01-06 11:26:26.043133", "_ingest_time_utc": "2026-01-06T11:38:55.439592+00:00"},
        {"id": 2, "quantity": 0, "total_amount": 5.0, "created_at": "2026-01-06T11:26:26.043133", "status": "paid"},
        {"id": 3, "quantity": None, "total_amount": 5.0, "created_at": "not a time"},
        {"id": 4, "quantity": "many", "total_amount": 1.5, "created_at": "2026-01-06"},
    ])
    raw = lz.lz_read(spark, "orders", str(tmp_path / "orders"))
    rows = {r["id"]: r for r in lz.normalize("orders", lz.require_snapshot(raw)).collect()}
    assert rows[1]["unit_price"] == 2.5 and rows[1]["created_at"] == dt.datetime(2026, 1, 6, 11, 26, 26, 43133)
    assert (rows[1]["status"], rows[1]["source"]) == ("created", "batch_snapshot")
    assert rows[1]["ingest_ts"] == dt.datetime(2026, 1, 6, 11, 38, 55, 439592)
    assert rows[2]["unit_price"] is None and rows[2]["status"] == "paid" and rows[2]["created_at"] == rows[1]["created_at"]
    assert rows[3]["created_at"] is None and rows[4]["quantity"] is None
    assert {r["snapshot_ts"] for r in rows.values()} == {"20260106T113000Z"}
    assert rows[1]["input_file"].endswith("a.ndjson")


def test_reading_a_leaf_folder_keeps_the_snapshot(spark, tmp_path):
    leaf = tmp_path / "products" / "snapshot_dt=2026-01-06" / "snapshot_ts=20260106T113000Z"
    put(leaf / "a.ndjson", [{"id": 1, "name": "n", "category": "c", "price": 2}])
    row = lz.normalize("products", lz.lz_read(spark, "products", str(leaf))).first()
    assert (row["snapshot_dt"], row["snapshot_ts"], row["price"]) == ("2026-01-06", "20260106T113000Z", 2.0)


def test_path_without_snapshot_fails(spark, tmp_path):
    put(tmp_path / "loose" / "a.ndjson", [{"id": 1}])
    with pytest.raises(ValueError):
        lz.require_snapshot(lz.lz_read(spark, "customers", str(tmp_path / "loose")))
    with pytest.raises(ValueError):
        lz.normalize("suppliers", lz.lz_read(spark, "customers", str(tmp_path / "loose")))


def test_snapshot_filter_reads_only_its_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "n", "e", "PT")], "id long, name string, email string, country string")
    for day in range(3):
        folder = lz.snapshot_land(df, "customers", T0 + dt.timedelta(days=day), str(tmp_path))
    picked = lz.lz_read(spark, "customers", folder, "2026-01-07")
    assert picked.count() == 1

    def files(plan):
        own = [plan.metrics().apply("numFiles").value()] if plan.getClass().getSimpleName() == "FileSourceScanExec" else []
        children = plan.children()
        return own + [n for i in range(children.size()) for n in files(children.apply(i))]

    picked.collect()
    assert files(picked._jdf.queryExecution().executedPlan()) == [1]


def test_landing_again_replaces_the_snapshot(spark, tmp_path):
    df = spark.createDataFrame([(1, 5), (2, 6)], "id long, quantity int")
    for _ in range(2):
        folder = lz.snapshot_land(df, "orders", T0, str(tmp_path))
    rows = lz.lz_read(spark, "orders", folder).collect()
    assert len(rows) == 2 and rows[0]["status"] == "created" and rows[0]["_entity"] == "orders"


def test_landed_files_are_small_and_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lz, "FILE_ROWS", 3000)
    df = spark.range(7000).coalesce(1).selectExpr("id", "'a name' AS name", "'an@address' AS email", "'PT' AS country")
    folder = lz.snapshot_land(df, "customers", T0, str(tmp_path))
    files = list((tmp_path / "customers").rglob("part-*"))
    assert len(files) == 3 and sum(f.stat().st_size for f in files) < 7000 * 20
    assert lz.lz_read(spark, "customers", folder).where("name = 'a name'").count() == 7000


def test_overwrite_partitions_is_idempotent(spark, tmp_path):
    name = table(spark, tmp_path, "customers")
    df = spark.createDataFrame([(1, "n", "e", "PT")], "id long, name string, email string, country string")
    for day in (0, 1):
        folder = lz.snapshot_land(df, "customers", T0 + dt.timedelta(days=day), str(tmp_path / "lz"))
    rows = lz.normalize("customers", lz.lz_read(spark, "customers", folder))
    tb.overwrite_partitions(rows, name)
    tb.overwrite_partitions(rows.where("snapshot_dt = '2026-01-07'").withColumn("name", F.lit("new")), name)
    got = {(r["snapshot_dt"], r["name"]) for r in spark.table(name).collect()}
    assert got == {("2026-01-06", "n"), ("2026-01-07", "new")}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    newest = lh.stg_customers(spark.table(name), ts="snapshot_ts")
    assert [r["customer_name"] for r in newest.collect()] == ["new"]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_ts" in plan
    tb.ensure_table(spark, name, *tb.BRONZE_TABLES["customers"], location=str(tmp_path / "fresh"), reset=True)
    assert spark.table(name).isEmpty()


def test_namespace_and_append(spark, tmp_path):
    db = f"bronze_{uuid.uuid4().hex[:8]}"
    for _ in range(2):
        tb.ensure_table(spark, f"{db}.items", "id bigint, v string, day string", ["day"])
    rows = spark.createDataFrame([("2026-01-06", "x", 1)], "day string, v string, id int")
    tb.append(rows, f"{db}.items")
    tb.append(rows, f"{db}.items")
    assert [tuple(r) for r in spark.table(f"{db}.items").distinct().collect()] == [(1, "x", "2026-01-06")]
    assert spark.table(f"{db}.items").count() == 2


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", "x", 0), (2, "b", "y", 0)], "k int, v string, keep string, at int")
    delta = spark.createDataFrame([(2, "B", "Z"), (3, "C", "W")], "k int, v string, keep string")
    once = tb.upsert(target, delta, ["k"], ["v"], {"at": F.lit(9)})
    want = {(1, "a", "x", 0), (2, "B", "y", 9), (3, "C", "W", 9)}
    assert set(map(tuple, once.collect())) == want
    assert set(map(tuple, tb.upsert(once, delta, ["k"], ["v"], {"at": F.lit(9)}).collect())) == want
    twice = delta.union(spark.createDataFrame([(2, "A", "Q"), (None, "n", "N")], delta.schema))
    with pytest.raises(Exception, match="several source rows"):
        tb.upsert(target, twice, ["k"], ["v"]).collect()
    picked = tb.upsert(target, twice, ["k"], ["v"], {"at": F.lit(9)}, order=[F.asc("v")]).collect()
    assert sorted(map(tuple, picked), key=str) == [(1, "a", "x", 0), (2, "A", "y", 9), (3, "C", "W", 9), (None, "n", "N", 9)]
    nulls = spark.createDataFrame([(None, "n", "N"), (None, "m", "N")], delta.schema)
    assert tb.upsert(target, nulls, ["k"], ["v"]).count() == 4


def test_clustered_tables_join_without_shuffle(spark, tmp_path):
    names = []
    for i in range(2):
        name = f"c_{uuid.uuid4().hex[:10]}"
        tb.write_clustered(spark.range(1000).withColumn("v", F.col("id") + i), name, ["id"], 8, str(tmp_path / name))
        names.append(name)
    a, b = (spark.table(n) for n in names)
    joined = a.hint("merge").join(b, "id")
    assert joined.count() == 1000 and "Exchange hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()
    tb.replace_table(spark.range(3), names[0], str(tmp_path / names[0]))
    assert spark.table(names[0]).count() == 3


def test_parse_or_wrap(spark):
    df = spark.createDataFrame([(1, '{"k": 5}'), (2, "oops"), (3, '{"k": "x"}'), (4, None),
                                (5, "123"), (6, '"x"'), (7, '[{"k": 1}]'), (8, "null"), (9, ' {"k": 7} '), (10, '{"k": ')], "id int, raw string")
    got = {r["id"]: (r["k"], r["_corrupt_record"], r["_ingest_error"]) for r in lz.parse_or_wrap(df, "raw", "k int").collect()}
    assert got[1] == (5, None, None) and got[2] == (None, "oops", "non_json_payload") and got[3] == (None, None, None)
    assert got[4] == (None, None, None) and got[9] == (7, None, None)
    assert {k: v[1:] for k, v in got.items() if k in (5, 6, 7, 8, 10)} == {
        k: (raw, "non_json_payload") for k, raw in ((5, "123"), (6, '"x"'), (7, '[{"k": 1}]'), (8, "null"), (10, '{"k": '))}


LINE = {"customer_id": 2, "product_id": 5, "quantity": 1, "total_amount": 94.18, "currency": "EUR",
        "created_at": "2026-01-06 11:26:26.043133", "_pubsub_message_id": "m", "_pubsub_publish_time":
        "2026-01-06T11:26:26.152000+00:00", "_ingest_time_utc": "2026-01-06T11:38:55.439592+00:00"}


class Stream:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def file(self, name, lines):
        put(self.root / "in" / "ingest_dt=2026-01-06" / "ingest_hr=05" / name, lines)

    def run(self):
        r = self.root
        job = live.start_orders_stream(self.spark, str(r / "in"), str(r / "table"), str(r / "quarantine"),
                                       str(r / "checkpoint"), max_files=1, trigger_seconds=None)
        live.run_for(job, "10m")

    def rows(self, part="table"):
        reader = self.spark.read
        return (reader.parquet(str(self.root / part)) if part == "table" else reader.json(str(self.root / part))).collect()


def test_stream_restart_and_quarantine(spark, tmp_path):
    s = Stream(spark, tmp_path)
    s.file("a.json", [{"id": 1, **LINE}, {"id": 2, **LINE, "quantity": 0}, {"id": 3, **LINE, "currency": ""},
                      "not json", {"id": 4, **LINE, "created_at": "soon"}, {"id": 5, **LINE, "total_amount": "x"},
                      {"id": 7, **LINE, "created_at": "2026-01-06T11:26:26.043133"}])
    s.run()
    assert [r["id"] for r in s.rows()] == [1] and len(s.rows("quarantine")) == 6
    s.file("b.json", [{"id": 1, **LINE, "quantity": 2}, {"id": 6, **LINE}])
    s.run()
    s.run()
    assert sorted(r["id"] for r in s.rows()) == [1, 1, 6]
    table = live.live_orders_table(spark, f"live_{uuid.uuid4().hex[:10]}", str(tmp_path / "table"))
    assert sorted(r["id"] for r in table.collect()) == [1, 1, 6]
    row = s.rows()[0]
    assert (row["ingest_dt"], row["ingest_hr"], row["status"], row["source"]) == ("2026-01-06", "05", "unknown", "pubsub")
    assert {r["quarantine_reason"] for r in s.rows("quarantine")} == {"failed_minimal_validation"}
    runs = {r["run"] for r in s.rows()}
    assert len(runs) == 1 and runs != {"none"}
    # A new checkpoint reads all files again, and must not overwrite what is there.
    live.run_for(live.start_orders_stream(spark, str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "q2"),
                                          str(tmp_path / "checkpoint2"), trigger_seconds=None))
    assert sorted(r["id"] for r in s.rows()) == [1, 1, 1, 1, 6, 6]


def test_replayed_batch_writes_the_same_rows(spark, tmp_path):
    raw = spark.createDataFrame([json.dumps({"id": i, **LINE, "quantity": i}) for i in range(4)], "string")
    batch = raw.select(F.from_json("value", lz.SCHEMAS["live_orders"]).alias("r")).select(
        "r.*", F.lit("f").alias("input_file"), F.lit("").alias("ingest_dt"), F.lit("").alias("ingest_hr"))
    run = live.write_batch(str(tmp_path / "t"), str(tmp_path / "q"), run_id="test")
    for _ in range(2):
        run(batch, 7)
    rows = spark.read.parquet(str(tmp_path / "t")).collect()
    assert sorted(r["id"] for r in rows) == [1, 2, 3]
    assert spark.read.json(str(tmp_path / "q")).count() == 1
    # Without path values the clock fills them.
    assert rows[0]["ingest_dt"] == f"{rows[0]['ingest_ts']:%Y-%m-%d}" and len(rows[0]["ingest_hr"]) == 2
    run(batch.limit(0), 8)
    assert not list((tmp_path / "t").glob("ingest_date=*/run=test/batch=8"))
    # Replayed after midnight: the batch's rows of the day before go.
    late = live.write_batch(str(tmp_path / "t"), str(tmp_path / "q"), F.lit("2031-01-01 00:00:01").cast("timestamp"), "test")
    late(batch, 7)
    assert sorted((r["id"], str(r["ingest_date"])) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [
        (i, "2031-01-01") for i in (1, 2, 3)]
    with pytest.raises(ValueError, match="run_id"):
        live.write_batch(str(tmp_path / "t"), str(tmp_path / "q"))(batch, 9)


def test_closed_days_are_compacted_and_pruned(spark, tmp_path):

    raw = spark.createDataFrame([json.dumps({"id": i, **LINE}) for i in range(1, 9)], "string")
    rows = raw.select(F.from_json("value", lz.SCHEMAS["live_orders"]).alias("r")).select(
        "r.*", F.lit("f").alias("input_file"), F.lit("").alias("ingest_dt"), F.lit("").alias("ingest_hr"))
    table = str(tmp_path / "t")
    for day in ("2026-01-05", "2026-01-06"):
        run = live.write_batch(table, str(tmp_path / "q"), F.lit(f"{day} 12:00:00").cast("timestamp"), "a")
        for batch in range(3):
            run(rows.where(F.col("id") % 3 == batch), batch + 10 * int(day[-1]))
    columns = ["id", "ingest_date", "created_at", "total_amount"]
    before = sorted(map(tuple, spark.read.parquet(table).select(columns).collect()))
    assert len(before) == 16
    live.compact_day(spark, table, "2026-01-05")
    assert sorted(map(tuple, spark.read.parquet(table).select(columns).collect())) == before
    runs = [p.name for p in (tmp_path / "t" / "ingest_date=2026-01-05").iterdir() if p.name.startswith("run=")]
    assert len(runs) == 1 and runs[0].startswith("run=compacted-")
    latest = lh.live_orders_latest(spark.read.parquet(table), dt.date(2026, 1, 6), horizon_hours=10)
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: []" not in plan and "ingest_date" in plan.split("PartitionFilters")[1][:200]
    assert latest.count() == 8


def test_stream_preview_and_ttl(spark, tmp_path):
    s = Stream(spark, tmp_path)
    s.file("a.json", [{"id": i, **LINE} for i in range(12)])
    s.file("b.json", [{"id": 99, **LINE}])
    seen = []
    live.preview(live.read_order_files(spark, str(tmp_path / "in"), 1), str(tmp_path / "look"), seen).awaitTermination()
    assert sorted(n for _, n, _ in seen) == [1, 12] and all(len(first) <= 10 for _, _, first in seen)
    job = live.start_orders_stream(spark, str(tmp_path / "in"), str(tmp_path / "t"), str(tmp_path / "q"),
                                   str(tmp_path / "c"), trigger_seconds=1)
    assert live.run_for(job, "8s") is False and not job.isActive
    assert spark.read.parquet(str(tmp_path / "t")).count() == 13
    assert [live.ttl_seconds(x) for x in ("90", "10m", "2H")] == [90, 600, 7200]


def test_first_per_key_in_stream(spark, tmp_path):
    s = Stream(spark, tmp_path)
    s.file("a.json", [{"id": 1, **LINE}, {"id": 1, **LINE, "quantity": 9}, {"id": 2, **LINE}])
    rows = live.read_order_files(spark, str(tmp_path / "in")).withColumn("created_at", F.to_timestamp("created_at"))
    out = live.first_per_key(rows).writeStream.format("parquet").option("path", str(tmp_path / "o")).option(
        "checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    out.awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [1, 2]


def test_split_keeps_every_row(spark):
    df = spark.createDataFrame([(1,), (-1,), (None,)], "v int")
    good, bad = q.split(df, F.col("v") > 0)
    assert good.count() == 1 and bad.count() == 2


def test_checks_return_the_broken_rows(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (2, 0.0, " "), (2, None, None)], "id int, amount double, c string")
    assert q.check_positive(df, "amount").count() == 2 and q.check_not_blank(df, "c").count() == 2
    assert [tuple(r) for r in q.check_unique(df, ["id"]).collect()] == [(2, 2)]
    assert q.check_fk(df, spark.createDataFrame([(1,)], "k int"), "id", "k").count() == 2


def test_full_refresh(spark, tmp_path):
    ts = dt.datetime(2026, 1, 6)
    bronze = {
        "customers": spark.createDataFrame([(1, "n", "e", "PT", ts)], "id long, name string, email string, country string, ingest_ts timestamp"),
        "products": spark.createDataFrame([(7, "p", "cat", 2.5, ts), (7, "old", "cat", 1.0, ts - dt.timedelta(days=1))],
                                          "id long, name string, category string, price double, ingest_ts timestamp"),
        "orders": spark.createDataFrame([(1, 1, 7, 2, 2.5, 5.0, ts, ts), (2, 1, 7, 4, 2.5, 10.0, ts, ts)],
                                        "id long, customer_id long, product_id long, quantity int, unit_price double, "
                                        "total_amount double, created_at timestamp, ingest_ts timestamp"),
    }

    def write(name, df):
        df.write.mode("overwrite").parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    out = lh.build_all(bronze, write, ts="ingest_ts")
    assert tuple(out["mart_revenue_by_category_daily"].first()) == (ts.date(), "cat", 2, 15)
    assert out["mart_customer_orders"].first()["revenue"] == 15 and out["dim_products"].count() == 1
    assert out["daily_order_metrics"].first()["avg_order_value"] == 7.5
    spine = lh.time_spine(spark, "2026-01-05", "2026-01-08")
    daily = semantic.metric_query(semantic.orders_model(out["fct_orders"]), ["avg_order_value"], spine=spine)
    assert sorted(r["avg_order_value"] or 0 for r in daily.collect()) == [0, 0, 7.5]
    with pytest.raises(ValueError):
        semantic.metric_query(semantic.orders_model(out["fct_orders"]), ["total_orders"], dims=["country"])


def test_time_spine(spark):
    span = lh.time_spine(spark)
    first, last, n = span.selectExpr("min(date_day)", "max(date_day)", "count(*)").first()
    assert (str(first), str(last), n) == ("2000-01-01", "2049-12-31", 18263)
    assert lh.time_spine(spark, "2026-01-01", "2026-01-01").isEmpty()


def test_cluster_session_needs_a_shared_folder():
    from types import SimpleNamespace

    from millrace.session import shared_folder

    def session(master, conf):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: conf.get(key, default)), sparkContext=context)

    assert shared_folder(session("yarn", {"spark.checkpoint.dir": "hdfs:///work/"})) == "hdfs:///work"
    with pytest.raises(RuntimeError):
        shared_folder(session("yarn", {}))
