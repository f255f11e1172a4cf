"""Exact top-k by inner product, with bounds from segment means and deviations.

A vector is cut into m equal segments; of each, mean and deviation (root of the summed squared
differences) are kept.  For vectors q and x, segment by segment of length L,

    |q - x|^2  >=  sum L (mean_q - mean_x)^2 + (dev_q - dev_x)^2

by the Cauchy-Schwarz inequality; with the exact norms this is an upper bound on the inner product,
sum L mean_q mean_x + dev_q dev_x.  Bounds go from one segment to many; only pairs that can
still reach a query's current k-th score go on to the next resolution, the survivors of the last
one are scored exactly in integers.

Queries go in blocks of bounded size that every task reads; vectors are scanned in place and never
shuffled.  A task passes on k rows per query at most.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.llm.common import store
from millrace.session import work_path

#: Components that reach this end the job.  Pairs whose norms' product reaches it are scored in Python integers,
#: since sums of 64 bits may not hold them on the way.
LIMIT = 1 << 62


def quantise(vectors: pa.ListArray, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows that take part, by length, and their integer components floor(scale * x).

    Left out: NULL vectors, and those that hold a NULL, a NaN or an infinity.  An integer that 64 bits have no
    room for is an error.
    """
    n = len(vectors)
    offsets = vectors.offsets.to_numpy()
    flat = vectors.values.cast(pa.float64())
    bad = ~np.isfinite(flat.to_numpy(zero_copy_only=False)) | flat.is_null().to_numpy(zero_copy_only=False)
    before = np.concatenate([[0], np.cumsum(bad)])
    lengths = np.diff(offsets)
    good = vectors.is_valid().to_numpy(zero_copy_only=False) & (before[offsets[1:]] == before[offsets[:-1]])
    values = flat.to_numpy(zero_copy_only=False)
    out = {}
    for length in np.unique(lengths[good]) if n else []:
        rows = np.flatnonzero(good & (lengths == length))
        at = offsets[rows][:, None] + np.arange(length)
        whole = np.floor(values[at] * scale)
        if (np.abs(whole) >= LIMIT).any():
            raise OverflowError(f"a component times {scale} is beyond 2**62")
        out[int(length)] = (rows, whole.astype(np.int64))
    return out


def summaries(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Columns whose products are the bound: root(L) * mean and deviation of every segment."""
    edges = np.linspace(0, vectors.shape[1], min(segments, max(vectors.shape[1], 1)) + 1).astype(int)
    parts = []
    for a, b in zip(edges[:-1], edges[1:]):
        part = vectors[:, a:b].astype(np.float64)
        mean = part.mean(1) if b > a else np.zeros(len(part))
        parts += [mean * np.sqrt(b - a), np.sqrt(((part - mean[:, None]) ** 2).sum(1))]
    return np.stack(parts, 1) if parts else np.zeros((len(vectors), 1))


class Best:
    """The k best rows of each query so far: score descending, then id ascending with NULL last."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, levels: Sequence[int]):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.bounds = [summaries(vectors, m) for m in levels]
        self.levels = levels
        self.norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        self.query = np.empty(0, np.int64)
        self.score, self.id, self.null = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
        self.least = np.full(len(ids), np.iinfo(np.int64).min)

    def scores(self, q: np.ndarray, x: np.ndarray, vectors: np.ndarray, norms: np.ndarray) -> np.ndarray:
        out = np.empty(len(q), np.int64)
        large = self.norms[q] * norms[x] >= LIMIT
        for a in range(0, len(q), 20_000):
            s = slice(a, a + 20_000)
            out[s] = (self.vectors[q[s]] * vectors[x[s]]).sum(1)
        for k in np.flatnonzero(large):
            score = sum(a * b for a, b in zip(self.vectors[q[k]].tolist(), vectors[x[k]].tolist()))
            if abs(score) >= 1 << 63:
                raise OverflowError(f"the score of query {self.ids[q[k]]} has no room in 64 bits")
            out[k] = score
        return out

    def offer(self, ids: np.ndarray, null: np.ndarray, vectors: np.ndarray) -> None:
        """Take in a batch of candidates."""
        if not len(vectors) or not len(self.ids):
            return
        coarse = [summaries(vectors, m) for m in self.levels]
        # Room for rounding, in units of the two norms.
        norms = np.sqrt((vectors.astype(np.float64) ** 2).sum(1))
        slack = 1e-9 * np.outer(self.norms, norms) + 1e-6
        floor = np.where(self.least == np.iinfo(np.int64).min, -np.inf, self.least.astype(np.float64))
        bound = self.bounds[0] @ coarse[0].T + slack
        open_ = bound >= floor[:, None]
        for mine, theirs in zip(self.bounds[1:], coarse[1:]):
            if open_.mean() > 0.02:
                open_ &= mine @ theirs.T + slack >= floor[:, None]
                q, x = np.nonzero(open_)
            else:
                q, x = np.nonzero(open_)
                keep = np.einsum("ij,ij->i", mine[q], theirs[x]) + slack[q, x] >= floor[q]
                q, x = q[keep], x[keep]
                open_[:] = False
                open_[q, x] = True
        q, x = np.nonzero(open_)
        keep = (self.ids[q] != ids[x]) | null[x]  # every row but the query's own
        q, x = q[keep], x[keep]
        self._take(q, self.scores(q, x, vectors, norms), ids[x], null[x])

    def _take(self, q, score, id_, null) -> None:
        q = np.concatenate([self.query, q])
        score, id_ = np.concatenate([self.score, score]), np.concatenate([self.id, id_])
        null = np.concatenate([self.null, null])
        order = np.lexsort((id_, null, -score, q))
        q = q[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        order, rank, q = order[rank < self.k], rank[rank < self.k], q[rank < self.k]
        self.query, self.score, self.id, self.null = q, score[order], id_[order], null[order]
        full = rank == self.k - 1
        self.least[q[full]] = self.score[full]


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id: str = "vec_id",
    vector: str = "embedding",
    scale: float = 1024.0,
    levels: Sequence[int] = (1, 4, 16),
    block_rows: int = 4096,
    batch_rows: int = 512,
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the highest score for each query; all, if there are fewer.

    Score: inner product of the integer vectors floor(scale * x), whole; a component
    or a score that 64 bits have no room for ends the job.
    Ties go to the smaller id, NULL ids last.  Columns: query_id, rank, vec_id, score.

    Vectors that are NULL or hold a NULL or non-finite component take no part, as query or
    candidate; a query meets vectors of its own length only.  Candidates are all rows whose id
    differs from the query's; repeated rows count one by one, repeated queries once.  Queries with a
    NULL id are left out.  No rows or queries give an empty result.

    Runs one job per block of ``block_rows`` queries; a block's vectors are what every task
    holds.  The result of each block is a file in the shared work folder.
    """
    spark = vectors.sparkSession
    asked = store(
        queries.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v"))
        .where("id IS NOT NULL").dropDuplicates(["id", "v"]), "queries")
    blocks = max(1, -(-asked.count() // block_rows))
    schema = "query_id long, vec_id long, score long"
    folder = work_path(spark, "top-k")

    for b in range(blocks):
        # About block_rows rows, by a hash that spreads ids evenly.
        block = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).orderBy("id").toArrow()
        lists = block.column("v").combine_chunks()
        ids = block.column("id").to_numpy()
        by_length = {n: (ids[rows], v) for n, (rows, v) in quantise(lists, scale).items()}
        held = spark.sparkContext.broadcast(by_length)

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = {n: Best(i, v, k, levels) for n, (i, v) in held.value.items()}
            for batch in batches:
                for at in range(0, batch.num_rows, batch_rows):
                    part = batch.slice(at, batch_rows)
                    own = part.column(0)
                    null = own.is_null().to_numpy(zero_copy_only=False)
                    numbers = own.fill_null(0).to_numpy()
                    for n, (rows, v) in quantise(part.column(1), scale).items():
                        if n in best:
                            best[n].offer(numbers[rows], null[rows], v)
            for found in best.values():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.ids[found.query]), pa.array(found.id, mask=found.null), pa.array(found.score)],
                    names=["query_id", "vec_id", "score"])

        rows = vectors.select(F.col(id).cast("long").alias("id"), F.col(vector).alias("v"))
        near = rows.mapInArrow(task, schema)
        order = W.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
        (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
         .write.mode("append").parquet(folder))
        held.unpersist()
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(folder)
