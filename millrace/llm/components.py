"""Connected components of an edge table, by joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import store


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """``node`` and ``label`` for every node of the edges (columns a, b; NULLs and loops don't count).

    ``label`` is the smallest node of the component.  Alternating star operations: every node
    links its larger neighbours, then its smaller ones, to the smallest node it knows, until the
    edges no longer change.  The edges stay distributed; each round writes them to the shared
    folder, so plans stay short and a lost executor costs one round at most.  Rounds grow with the logarithm
    of the longest path; edges that still change after ``most`` rounds end the job.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs = store(pairs, "edges")
    if not pairs.take(1):
        return pairs.select(F.col("a").alias("node"), F.col("b").alias("label"))
    state = None
    for _ in range(most):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.where("m <> a").select("a", F.col("m").alias("b"))).distinct()
        # Small star: neighbours below a node, and the node itself, link to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where(F.col("b") > F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = store(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        check = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if check == state:
            break
        state = check
    else:
        raise RuntimeError(f"components still change after {most} rounds")
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
