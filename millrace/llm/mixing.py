"""Mixing sources to target weights by entropy balancing, native DataFrame operations only.

Every document gets a rate r.  Among all rates between 0 and ``cap`` that give each source its
target number of words, those nearest to one in relative entropy over the documents are
exponentially tilted in the balanced quantity, the document's words:

    r = min(cap, exp(lambda_source * words / mean words of the source))

The lambdas minimise the convex dual, whose gradient is (words taken - target).  Newton's method
on the logarithm of the words taken finds them, inside a bracket that every step narrows.  Rates
depend on source and size alone, so the iterations run on counts per (source, size), which
are pre-aggregated map-side; a source or a size that holds a third of all rows costs no more than
another.

Rates become copies by systematic rounding: along a source, largest documents first, running sums of
the rates are kept in integers (units of 2**-20), and a document gets as many copies as whole
numbers lie in its stretch.  The running sums come from range partitions, not from a window over
a source.  Of several offsets of the whole numbers the one that comes nearest to the source's
target is taken.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import WORD, store
from millrace.operators.ordering import running_sums

UNIT = 1 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sources: DataFrame, weights: Sequence[float], cap: float) -> DataFrame:
    """``target`` of every source (rows: source, source_size).

    Sources by code point, NULL last, weigh ``weights``, repeating, and share all words; a target
    stops at ``cap`` times its source's size and the excess is shared by weight among the others
    until none is above.  That fixed point is a level x with target = min(weight * x, cap * size):
    in the order of cap * size / weight, the sources below the level are exactly those that stop.
    """
    placed = running_sums(sources.withColumn("one", F.lit(1).cast("long")), [F.col("source").asc_nulls_last()], ["one"])
    choice = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("one_before") % len(weights) + 1).cast("int"))
    weighed = placed.select("source", "source_size", choice.alias("weight")).withColumn(
        "most", F.col("source_size") * F.lit(float(cap))).withColumn("ratio", F.col("most") / F.col("weight"))
    weighed = running_sums(weighed, [F.col("ratio"), F.col("source")], ["most", "weight", "source_size"])
    level = (F.col("source_size_total") - F.col("most_before")) / (F.col("weight_total") - F.col("weight_before"))
    levels = weighed.withColumn("level", level)
    settled = levels.where(F.col("ratio") >= F.col("level")).agg(F.min_by("level", "ratio").alias("x"))
    x = settled.scalar()
    target = F.least(F.col("most"), F.coalesce(F.col("weight") * x, F.col("most")))
    return levels.select("source", "source_size", target.alias("target"))


def balance(strata: DataFrame, sources: DataFrame, cap: float, tolerance: float = 1e-9, most: int = 60) -> DataFrame:
    """The tilt of every source (rows: source, source_size, target), by Newton iterations.

    ``strata``: source, size, n.  Adds ``mean`` (words per document that has any) and ``tilt``; NULL
    where the target needs the cap for every document, or the source has no words.
    """
    key = F.struct("source")
    strata = strata.where("size > 0").select(key.alias("key"), "size", "n")
    shape = strata.groupBy("key").agg(
        F.sum("n").alias("docs"), F.sum(F.col("n") * F.col("size") * F.col("size").cast("double")).alias("squares"))
    state = sources.withColumn("key", key).join(shape, "key", "left").select(
        "key", "source", "source_size", "target",
        (F.col("source_size") / F.col("docs")).alias("mean"),
        (F.col("docs").isNotNull() & (F.col("target") < F.col("source_size") * cap * (1 - 1e-12))).alias("open"),
        F.col("squares"),
    )
    # First step: the tangent at lambda = 0.
    state = store(state.select(
        "key", "source", "source_size", "target", "mean",
        F.when(F.col("open"), F.log(F.col("target") / F.col("source_size")) * F.col("source_size") * F.col("mean")
               / F.col("squares")).alias("tilt"),
        F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), F.lit(1.0).alias("gap"),
    ), "tilts")
    for _ in range(most):
        z = F.col("size") / F.col("mean")
        rate = F.least(F.lit(float(cap)), F.exp(F.least(F.col("tilt") * z, F.lit(50.0))))
        words = F.col("n") * F.col("size").cast("double")
        sums = (
            strata.join(state.where("tilt IS NOT NULL").select("key", "tilt", "mean"), "key")
            .groupBy("key")
            .agg(F.sum(words * rate).alias("taken"),
                 F.sum(F.when(rate < cap, words * z * rate).otherwise(0.0)).alias("slope"))
        )
        low = F.when(F.col("taken") <= F.col("target"), F.col("tilt")).otherwise(F.col("low"))
        high = F.when(F.col("taken") >= F.col("target"), F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") + F.log(F.col("target") / F.col("taken")) * F.col("taken") / F.col("slope")
        newton = F.when((F.col("taken") > 0) & (F.col("slope") > 0), newton)
        half = F.when(F.col("low").isNotNull() & F.col("high").isNotNull(), (F.col("low") + F.col("high")) / 2)
        wide = F.when(F.col("low").isNull(), F.col("tilt") - F.abs(F.col("tilt")) - 1).otherwise(
            F.col("tilt") + F.abs(F.col("tilt")) + 1)
        inside = (F.col("low").isNull() | (newton > F.col("low"))) & (F.col("high").isNull() | (newton < F.col("high")))
        done = F.abs(F.col("taken") / F.col("target") - 1) <= tolerance
        state = store(
            state.join(sums, "key", "left")
            .withColumns({"low": low, "high": high})
            .select("key", "source", "source_size", "target", "mean",
                    F.when(done, F.col("tilt")).when(inside, newton).otherwise(F.coalesce(half, wide)).alias("tilt"),
                    "low", "high", F.abs(F.col("taken") / F.col("target") - 1).alias("gap")), "tilts")
        if not state.where(F.col("gap") > tolerance).take(1):
            break
    else:
        raise RuntimeError(f"a source's tilt still misses its target after {most} steps")
    return state.select("key", "source_size", "target", "mean", "tilt")


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    cap: int = 3,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    offsets: int = 32,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate, copies, taken.

    Size: words of the text, none for NULL.  ``taken`` is copies * size, at most ``cap`` * size.
    A source's taken words differ from its target by less than the largest document's size;
    documents without words have one copy.  NULL is a source of its own.  Results depend on the rows
    alone, not on their order or partitioning; rows that agree in id, source and size are
    interchangeable, and copies may go to any of them.  No rows give an empty result.
    """
    sized = store(docs.select(F.col(id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                              word_count(F.col(text)).alias("size")), "sizes")
    strata = store(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "strata")
    sources = strata.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    targets = store(source_targets(sources, weights, cap), "targets")
    tilts = balance(strata, targets, cap)

    tilted = F.least(F.lit(float(cap)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("mean"), F.lit(50.0))))
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(F.col("tilt").isNull(), F.lit(float(cap))).otherwise(tilted)
    rated = (
        sized.withColumn("key", F.struct("source")).join(tilts, "key")
        .select("doc_id", "source", "size", "source_size", "target", rate.alias("rate"))
        .withColumn("units", F.round(F.col("rate") * UNIT).cast("long"))
    )
    order = [F.col("size").desc(), F.xxhash64(F.col("doc_id"), F.lit(7)).asc(), F.col("doc_id").asc()]
    placed = running_sums(rated, order, ["units"], ["source"])

    def copies(offset: Column) -> Column:
        begin = F.col("units_before") + offset
        return (F.shiftright(begin + F.col("units"), 20) - F.shiftright(begin, 20)).cast("int")

    tried = [(2 * k + 1) * UNIT // (2 * offsets) for k in range(offsets)]
    totals = placed.groupBy("source").agg(
        F.first("target").alias("target"),
        *[F.sum(copies(F.lit(o).cast("long")) * F.col("size")).alias(f"taken_{o}") for o in tried])
    best = totals.select(F.struct("source").alias("key"), F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"taken_{o}") - F.col("target")).alias("miss"), F.lit(o).cast("long").alias("offset"))
        for o in tried])).getField("offset").alias("offset"))
    return (
        placed.withColumn("key", F.struct("source")).join(best, "key")
        .withColumn("copies", copies(F.col("offset")))
        .select("doc_id", "source", "size", "source_size", "target", "rate", "copies",
                (F.col("copies") * F.col("size")).cast("long").alias("taken"))
    )


def apply_mix(docs: DataFrame, mixed: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` with each row repeated as often as ``mixed`` says, in its own columns.

    Rows that agree in id, source and size share the copies of all of them, dealt out by a hash of the row: the
    mix has as many rows as ``mixed`` says.  NULL texts and texts without words have size 0; no rows
    give an empty result.
    """
    # A key's copies, all together, and its rows; most keys have one row.
    per_key = mixed.groupBy("doc_id", "source", "size").agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("rows"))
    per_key = per_key.select(F.struct("doc_id", "source", "size").alias("key"), "copies", "rows").where("copies > 0")
    rows = docs.select(
        F.struct("*").alias("row"),
        F.struct(F.col(id).alias("doc_id"), F.col(source).cast("string").alias("source"),
                 word_count(F.col(text)).alias("size")).alias("key"))
    found = rows.join(per_key, "key")
    among = W.partitionBy("key").orderBy(F.xxhash64(F.to_json("row")))
    shared = found.where("rows > 1").withColumn("place", F.row_number().over(among) - 1)
    dealt = shared.withColumn("copies", F.expr("copies div rows + IF(place < copies % rows, 1, 0)")).drop("place")
    kept = found.where("rows = 1").unionByName(dealt).where("copies > 0")
    return kept.select("row", F.explode(F.expr("sequence(1L, copies)"))).select("row.*")
