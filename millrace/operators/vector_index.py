"""A stored inverted-file index for vector search by cosine distance.

Coarse centroids are fitted on a bounded sample, then every row of the base is assigned to its nearest centroid and
written to that centroid's partition.  A query reads only the partitions of the centroids next to it; the
distances inside are exact.  With ``certify`` a second pass reads every partition that could still hold a nearer
row: by the triangle inequality of angles no row of a list is nearer than the angle to its centroid less the
list's radius, so the result is that of the full scan.

Rows are never grouped by centroid in a task: a list that holds a third of all rows is many files, and each task keeps
k hits per query.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Normalizer, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.exprs import cosine_distance
from millrace.operators.ordering import latest_per_key
from millrace.operators.retrieval import _matrix, _Nearest, _sortable, _unit, _unit_rows
from millrace.session import materialize, work_path

#: Angles are compared with this margin: distances are rounded to nine digits.
MARGIN = 1e-4
#: The list of vectors without a direction: their distance to everything is 1.
NOWHERE = -1


def _angles(unit: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(unit @ centroids.T, -1.0, 1.0))


def _slices(batches: Iterator[pd.DataFrame], lists: int) -> Iterator[pd.DataFrame]:
    """Batches so short that a table of rows by lists stays small (a million numbers)."""
    step = max(1, 1_000_000 // max(1, lists))
    for pdf in batches:
        for at in range(0, len(pdf), step):
            yield pdf.iloc[at : at + step]


def _packed(chosen: np.ndarray) -> list[bytes]:
    """A bit per list for each query: 512 bytes of 4,096 lists, where a list of numbers took a hundred times that."""
    return list(map(bytes, np.packbits(chosen, axis=1, bitorder="little")))


def _bits(packed: Sequence[bytes]) -> np.ndarray:
    """What ``_packed`` gave, a row of bytes per query."""
    return np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1)


def build_index(
    base: DataFrame,
    path: str,
    id: str = "chunk_id",
    vector: str = "embedding",
    tags: str | None = None,
    lists: int | None = None,
    most_lists: int = 4096,
    sample_rows: int = 50_000,
    iterations: int = 8,
    seed: int = 7,
) -> DataFrame:
    """Write an index of ``base`` to ``path`` (rows below ``vectors/``, a row per list in ``lists``) and return its lists.

    ``lists`` is about the square root of the rows, ``most_lists`` at most, unless given; the centroids, which every task
    gets, are fitted on about ``sample_rows`` rows picked by a hash of the id, all rows are indexed.  Rows with a NULL
    vector are left out, as in a search; vectors of length zero have a list of their own.  ``tags`` names an array
    column that queries can be restricted by.  The list table is written last: an index without it was not finished.
    """
    spark = base.sparkSession
    rows = base.select(
        F.col(id).alias("base_id"), F.col(vector).cast("array<double>").alias("v"),
        (F.col(tags) if tags else F.lit(None)).cast("array<string>").alias("tags")).where("v IS NOT NULL")
    length = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    n = rows.where(length > 0).count()
    wanted = max(1, min(most_lists, lists or round(n**0.5)))
    share = min(1.0, sample_rows / max(n, 1))
    picked = rows.where((length > 0) & (F.pmod(F.xxhash64("base_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1))
    unit = Normalizer(inputCol="raw", outputCol="unit").transform(picked.select(array_to_vector("v").alias("raw")))
    centroids = np.zeros((0, 0))
    if n:
        # The assembler makes a vector sparse if that is shorter.
        features = VectorAssembler(inputCols=["unit"], outputCol="features").transform(materialize(unit.select("unit")))
        fitted = KMeans(k=wanted, maxIter=iterations, seed=seed).fit(features.select("features")).clusterCenters()
        centroids = _unit_rows(pd.Series(fitted))
    shared = spark.sparkContext.broadcast(centroids)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _slices(batches, len(shared.value)):
            where, angle = np.full(len(pdf), NOWHERE), np.zeros(len(pdf))
            if len(shared.value):
                m = _unit_rows(pdf["v"])
                a = _angles(m, shared.value)
                some = (m != 0).any(1)
                where[some], angle[some] = a.argmin(1)[some], a.min(1)[some]
            yield pdf.assign(list=where, angle=angle)

    kind = rows.schema["base_id"].dataType.simpleString()
    placed = rows.mapInPandas(assign, f"base_id {kind}, v array<double>, tags array<string>, list int, angle double")
    placed.hint("rebalance", F.col("list")).sortWithinPartitions("list").write.mode("overwrite").partitionBy("list").parquet(
        f"{path}/vectors")
    found = spark.read.parquet(f"{path}/vectors").groupBy("list").agg(
        F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")) if not rows.isEmpty() else None
    ends = np.arange(len(centroids) + 1) * (centroids.shape[1] if n else 0)
    known = spark.createDataFrame(pa.table({
        "list": pa.array([*range(len(centroids)), NOWHERE], pa.int32()),
        "centroid": pa.ListArray.from_arrays(np.append(ends, ends[-1]).astype(np.int32), centroids.ravel())}))
    told = known.join(found, "list", "left") if found is not None else known.select(
        "*", F.lit(None).cast("long").alias("n"), F.lit(None).cast("double").alias("radius"))
    told.where("n > 0").coalesce(1).write.mode("overwrite").parquet(f"{path}/lists")
    return spark.read.parquet(f"{path}/lists")


def _blocks(asked: DataFrame, k: int, block_bytes: int, block_hits: int) -> Iterator[pa.Table]:
    """Queries in blocks of bounded size, those with the same nearest list together, so that a block reads few lists."""
    sizes = asked.groupBy("near").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("v") * 8).alias("bytes")).orderBy("near").collect()
    group, weight = [], 0.0

    def fetch(near: list[int], part: int = 0, parts: int = 1) -> pa.Table:
        rows = asked.where(F.col("near").isin(near))
        if parts > 1:
            rows = rows.where(F.pmod(F.xxhash64("query_id"), F.lit(parts)) == part)
        return rows.select("query_id", "v", "lists", "tag", "limit").toArrow()

    for row in sizes:  # one row per list
        load = max(row["bytes"] / block_bytes, row["n"] * k / block_hits)
        if load > 1:
            parts = -(-int(load * 1024) // 1024)
            yield from (fetch([row["near"]], part, parts) for part in range(parts))
            continue
        if group and weight + load > 1:
            yield fetch(group)
            group, weight = [], 0.0
        group.append(row["near"])
        weight += load
    if group:
        yield fetch(group)


def _scan(
    vectors: DataFrame, names: np.ndarray, asked: DataFrame, k: int, schema: str, folder: str, block_bytes: int, block_hits: int,
) -> None:
    """The k best hits per query in its lists, appended to ``folder``.

    Which lists a query reads stays a bit per list, on the driver as in the tasks.
    """
    spark = vectors.sparkSession
    for local in _blocks(asked, k, block_bytes, block_hits):
        if not len(local):
            continue
        bits = _bits(local["lists"].to_pylist())
        opened = np.append(names, NOWHERE)[np.flatnonzero(
            np.unpackbits(np.bitwise_or.reduce(bits, axis=0), count=len(names) + 1, bitorder="little"))]
        tags = local["tag"].to_pylist()
        codes = {t: c for c, t in enumerate(sorted({t for t in tags if t is not None}))}
        tag = np.array([codes.get(t, -1) for t in tags])
        shared = spark.sparkContext.broadcast(
            (local["query_id"].to_pandas().to_numpy(), _unit(_matrix(local["v"])),
             local["limit"].to_pandas().astype(float).fillna(np.inf).to_numpy(), bits, codes, tag))

        def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            query_ids, m, limit, bits, codes, tag = shared.value
            best = _Nearest(m, k, limit)
            asking = {c: np.flatnonzero(tag == c) for c in (*codes.values(), -1)}
            for pdf in batches:
                if not len(pdf):
                    continue
                ids, vectors, lists = _sortable(pdf["base_id"]), _unit_rows(pdf["v"]), pdf["list"].to_numpy()
                # The places of rows per tag, each row once; None are all rows, for queries without a tag.
                places: dict[int, list[int]] = {}
                if codes:
                    for row, held in enumerate(pdf["tags"]):
                        for t in set(held) if held is not None else ():
                            if t in codes:
                                places.setdefault(codes[t], []).append(row)
                rows = {c: np.array(r) for c, r in places.items()} | {-1: np.arange(len(pdf))}
                for c, of_tag in rows.items():
                    if not len(asking[c]):
                        continue
                    order = of_tag[np.argsort(lists[of_tag], kind="stable")]
                    found, starts = np.unique(lists[order], return_index=True)
                    for x, place in zip(found, np.split(order, starts[1:])):
                        at = len(names) if x == NOWHERE else int(np.searchsorted(names, x))
                        among = asking[c][(bits[asking[c], at >> 3] >> (at & 7)) & 1 == 1]
                        if len(among):
                            best.offer(ids[place], vectors[place], among)
            yield from best.hits(query_ids)

        # A filter on the partition column: other lists' files are not opened.
        hits = vectors.where(F.col("list").isin(opened.tolist())).mapInPandas(scan, schema)
        latest_per_key(hits, ["query_id"], [F.asc("distance"), F.asc("base_id")], k).write.mode("append").parquet(folder)
        shared.unpersist()


def search_index(
    spark: SparkSession,
    path: str,
    queries: DataFrame,
    k: int,
    probes: int = 8,
    certify: bool = False,
    query_id: str = "query_id",
    vector: str = "embedding",
    tag: str | None = None,
    block_bytes: int = 32 << 20,
    block_hits: int = 1_000_000,
) -> DataFrame:
    """Top-k by cosine distance: (``query_id``, base_id, distance), ties by id.

    Every query reads its ``probes`` nearest lists, and, with ``certify``, in a second pass all lists that could hold
    something nearer than its k-th hit.  ``tag`` names a column: hits must hold it among their tags (NULL: no
    restriction), inside the search, so a query has k hits if there are as many.  Queries with a NULL vector have
    no hits.  Ids must be unique.
    """
    lists = spark.read.parquet(f"{path}/lists").orderBy("list").toArrow()  # most_lists rows at most
    stored = spark.read.parquet(f"{path}/vectors")
    kinds = (queries.schema[query_id].dataType.simpleString(), stored.schema["base_id"].dataType.simpleString())
    schema = f"query_id {kinds[0]}, base_id {kinds[1]}, distance double"
    numbers = lists["list"].to_numpy()
    names, radius = numbers[numbers != NOWHERE].astype(np.int64), lists["radius"].to_numpy()[numbers != NOWHERE]
    centroids = _matrix(lists["centroid"].filter(pa.array(numbers != NOWHERE)))
    always = NOWHERE in numbers
    shared = spark.sparkContext.broadcast((names, radius, centroids))

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, radius, centroids = shared.value
        for pdf in _slices(batches, len(names)):
            chosen, nearest = np.zeros((len(pdf), len(names) + 1), bool), np.full(len(pdf), NOWHERE)
            chosen[:, -1] = always
            if len(pdf) and len(names):
                order = np.argsort(_angles(_unit_rows(pdf["v"]), centroids), axis=1, kind="stable")[:, :probes]
                np.put_along_axis(chosen, order, True, 1)
                nearest = names[order[:, 0]]
            yield pdf.assign(near=nearest, lists=_packed(chosen))

    def left_over(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """The lists not read yet that could hold a row nearer than the k-th hit."""
        names, radius, centroids = shared.value
        for pdf in _slices(batches, len(names)):
            if not len(names) or not len(pdf):
                continue
            unit = _unit_rows(pdf["v"])
            reach = np.arccos(np.clip(1.0 - pdf["limit"].fillna(2.0).to_numpy(), -1.0, 1.0))
            # A query without a direction is as far from everything.
            open_ = (_angles(unit, centroids) - radius <= reach[:, None] + MARGIN) | ~(unit != 0).any(1)[:, None]
            done = np.unpackbits(_bits(pdf["lists"].tolist()), axis=1, count=len(names) + 1, bitorder="little").astype(bool)
            more = np.zeros_like(done)
            more[:, :-1] = open_ & ~done[:, :-1]
            yield pdf.assign(lists=_packed(more))[more.any(1)]

    if not len(lists):
        return spark.createDataFrame([], schema)
    asked = queries.select(
        F.col(query_id).alias("query_id"), F.col(vector).cast("array<double>").alias("v"),
        (F.col(tag) if tag else F.lit(None)).cast("string").alias("tag"), F.lit(None).cast("double").alias("limit")).where("v IS NOT NULL")
    shape = f"query_id {kinds[0]}, v array<double>, tag string, limit double, near int, lists binary"
    asked = materialize(asked.mapInPandas(near, shape))
    folder = work_path(spark, "index-hits")
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(folder)
    _scan(stored, names, asked, k, schema, folder, block_bytes, block_hits)
    hits = spark.read.schema(schema).parquet(folder)
    if certify:
        last = hits.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.max("distance")).alias("limit"))
        rest = asked.drop("limit").join(last, "query_id", "left").mapInPandas(left_over, shape)
        more = work_path(spark, "index-hits")
        hits.write.mode("overwrite").parquet(more)
        _scan(stored, names, materialize(rest), k, schema, more, block_bytes, block_hits)
        hits = latest_per_key(
            spark.read.schema(schema).parquet(more), ["query_id"], [F.asc("distance"), F.asc("base_id")], k)
    return hits.withColumnRenamed("query_id", query_id)


def tune_probes(
    spark: SparkSession, path: str, target: float = 0.95, k: int = 10, queries: int = 200,
) -> int:
    """The least number of lists per query that finds ``target`` of the exact k hits of stored rows.

    About ``queries`` rows, picked by a hash of the id, ask; their exact hits come from a certified search, and a hit is
    found with as many probes as the place of its list in the query's order.
    """
    stored = spark.read.parquet(f"{path}/vectors")
    lists = spark.read.parquet(f"{path}/lists").where(F.col("list") != NOWHERE)
    n, number = stored.count(), lists.count()
    if not number:
        return 1
    share = int(min(1.0, queries / max(n, 1)) * (1 << 20)) + 1
    asked = materialize(stored.where((F.col("list") != NOWHERE) & (F.pmod(F.xxhash64("base_id", F.lit(1)), F.lit(1 << 20)) < share)).select(
        F.col("base_id").alias("query_id"), F.col("v").alias("embedding")))
    exact = search_index(spark, path, asked, k, certify=True)
    held = stored.select("base_id", "list")
    pairs = exact.join(held, "base_id").join(asked, "query_id").join(lists.select("list", "centroid"), "list")
    # The place of the hit's list: how many centroids are nearer to the query.
    near = cosine_distance(F.col("embedding"), F.col("centroid"))
    every = asked.join(lists.select(F.collect_list("centroid").alias("all")), F.lit(True))  # most_lists rows at most
    ordered = every.select("query_id", F.transform("all", lambda c: cosine_distance(F.col("embedding"), c)).alias("all"))
    place = pairs.withColumn("near", near).join(ordered, "query_id").select(
        F.size(F.filter("all", lambda d: d < F.col("near") - 1e-12)).alias("place"))
    row = place.agg(F.percentile("place", F.lit(target)).alias("p")).first()
    return min(number, int(np.ceil(row["p"])) + 1) if row["p"] is not None else 1


def recall(found: DataFrame, exact: DataFrame, keys: Sequence[str] = ("query_id", "base_id")) -> float:
    """The share of the exact hits that were found."""
    row = exact.select(*keys).join(found.select(*keys, F.lit(True).alias("hit")), list(keys), "left").agg(
        F.avg(F.col("hit").isNotNull().cast("double"))).first()
    return row[0] if row[0] is not None else 1.0
