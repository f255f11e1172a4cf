"""The inverted-file index beside the exact search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import retrieval as rt
from millrace.operators import vector_index as vi
from millrace.session import work_path


def clustered(spark, n=3000, dims=16, seed=1, hot=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, dims)) * 2
    rows = [(int(k), (centres[rng.integers(40)] + rng.normal(size=dims)).tolist(), [f"t{k % 5}", f"u{k % 3}"]) for k in range(n)]
    rows += [(n + k, rows[0][1], ["t0"]) for k in range(hot)] + [(10**6, [0.0] * dims, None), (10**6 + 1, None, ["t1"])]
    return spark.createDataFrame(rows, "chunk_id long, embedding array<double>, tags array<string>").repartition(6)


def hits(df):
    return sorted(map(tuple, df.select("query_id", "base_id", "distance").collect()))


@pytest.fixture(scope="module")
def base(spark):
    return clustered(spark).cache()


@pytest.fixture(scope="module")
def index(spark, base):
    path = work_path(spark, "index")
    vi.build_index(base, path, tags="tags")
    return path


def queries_of(base, every=37):
    return base.where(F.col("chunk_id") % every == 0).select(F.col("chunk_id").alias("query_id"), "embedding")


def test_recall_and_pruned_lists(spark, base, index):
    queries = queries_of(base)
    exact = rt.vector_search(base, queries, 10)
    exact = exact.select("query_id", F.col("base_id"), "distance")
    found = vi.search_index(spark, index, queries, 10, probes=8)
    assert vi.recall(found, exact) >= 0.9
    lists = spark.read.parquet(f"{index}/lists")
    assert lists.agg(F.sum("n")).first()[0] == base.where("embedding IS NOT NULL").count()
    # Two queries read their own lists' files and no others.
    few = spark.read.parquet(f"{index}/vectors").where(F.col("list").isin([3, 5]))
    plan = few._jdf.queryExecution().toString()
    assert "PartitionFilters: [" in plan and "list" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert 0 < len(few.inputFiles()) and few.select("list").distinct().count() == 2


def test_tuned_probes(spark, base, index):
    """As many lists as a sample needs, and no more: recall holds for other queries too."""
    probes = vi.tune_probes(spark, index, 0.95)
    lists = spark.read.parquet(f"{index}/lists").count()
    assert 1 <= probes < lists
    queries = queries_of(base, 41)
    exact = rt.vector_search(base, queries, 10)
    assert vi.recall(vi.search_index(spark, index, queries, 10, probes=probes), exact) >= 0.9


def test_certified_equals_the_full_scan(spark, base, index):
    queries = queries_of(base, 50)
    exact = hits(rt.vector_search(base, queries, 7))
    for probes in (1, 4, 1000):
        assert hits(vi.search_index(spark, index, queries, 7, probes=probes, certify=True)) == exact
    # Blocks of a few queries give the same.
    assert hits(vi.search_index(spark, index, queries, 7, probes=2, certify=True, block_bytes=2000)) == exact


def test_tags_inside_the_search(spark, base, index):
    """A restricted query has k hits of its own kind, however far they are."""
    queries = queries_of(base, 300).withColumn("tag", F.concat(F.lit("t"), (F.col("query_id") % 4).cast("string")))
    queries = queries.unionByName(queries.limit(1).select((F.col("query_id") + 7).alias("query_id"), "embedding", F.lit(None).cast("string").alias("tag")))
    got = hits(vi.search_index(spark, index, queries, 5, probes=2, certify=True, tag="tag"))
    want = []
    for q in queries.collect():
        held = base if q["tag"] is None else base.where(F.array_contains("tags", q["tag"]))
        one = spark.createDataFrame([(q["query_id"], q["embedding"])], "query_id long, embedding array<double>")
        want += hits(rt.vector_search(held, one, 5))
    assert got == sorted(want)


def test_hot_list_ties_and_empty_tables(spark):
    """Copies that fill a third of the index: k of them are found, smallest ids first."""
    base = clustered(spark, n=400, hot=300)
    path = work_path(spark, "index")
    vi.build_index(base, path)
    one = base.where("chunk_id = 0").select(F.lit(1).cast("long").alias("query_id"), "embedding")
    got = hits(vi.search_index(spark, path, one, 5, certify=True))
    assert [b for _, b, _ in got] == [0, 400, 401, 402, 403]
    none = base.where("chunk_id < 0")
    assert vi.search_index(spark, path, none.select(F.col("chunk_id").alias("query_id"), "embedding"), 5).count() == 0
    empty = work_path(spark, "index")
    assert vi.build_index(base.where("chunk_id = 1000001"), empty).count() == 0


def test_batches_are_cut_by_the_number_of_lists():
    import pandas as pd

    whole = pd.DataFrame({"x": range(10_000)})
    parts = list(vi._slices([whole], 4096))
    assert max(map(len, parts)) * 4096 <= 1_000_000 and pd.concat(parts).equals(whole)


def test_lists_of_a_query_stay_bits_on_the_driver(spark, base, index, monkeypatch):
    """Every list is open to every query of the second pass, and a block's share of it is a bit for each."""
    blocks, whole = [], vi._blocks
    monkeypatch.setattr(vi, "_blocks", lambda *a: (blocks.append(b) or b for b in whole(*a)))
    number = spark.read.parquet(f"{index}/lists").count()
    queries = queries_of(base, 50)
    vi.search_index(spark, index, queries, 2900, probes=1, certify=True)
    assert len(blocks) > 1
    for block in blocks:
        assert {len(b) for b in block["lists"].to_pylist()} == {-(-number // 8)}
    assert (np.unpackbits(vi._bits(blocks[-1]["lists"].to_pylist()), axis=1).sum(1) > number / 2).all()
