"""Text operators: chunking, redaction, packing, prompt building, output rules."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import strip
from millrace.functions.constants import (
    EMAIL_MASK,
    EMAIL_PATTERN,
    ISSUE_CATEGORIES,
    ISSUE_CATEGORY_DEFAULT,
    PACK_SEPARATOR,
    PROMPT_UNSAFE_CHARS,
    RATIONALE_DEFAULT,
    RATIONALE_LENGTH,
    SEVERITIES,
    SEVERITY_DEFAULT,
    UNSAFE_CHUNK_PATTERN,
)
from millrace.operators.ordering import positions


def chunk(df: DataFrame, id_col: str, body: str, sep: str = "\n\n", keep: Sequence[str] = ()) -> DataFrame:
    """Split a text into stable chunks: index, id ``<id>:0000``, trimmed text and its MD5.

    Blank chunks are left out but keep their place in the numbering.
    """
    parts = F.split(F.col(body), re.escape(sep), -1)
    rows = df.select(id_col, *keep, F.posexplode(parts).alias("chunk_index", "_part"))
    index = F.col("chunk_index").cast("string")
    padded = F.when(F.length(index) < 4, F.lpad(index, 4, "0")).otherwise(index)
    return (
        rows.withColumn("chunk_text", strip(F.col("_part")))
        .where(F.col("chunk_text") != "")
        .select(
            id_col,
            *keep,
            "chunk_index",
            F.concat(F.col(id_col).cast("string"), F.lit(":"), padded).alias("chunk_id"),
            "chunk_text",
            F.md5("chunk_text").alias("chunk_hash"),
        )
    )


def chunk_delta(df: DataFrame, id_col: str, body: str, updated: str, since, sep: str = "\n\n",
                keep: Sequence[str] = ()) -> DataFrame:
    """Chunks of the articles changed at or after ``since`` only."""
    changed = df.where(F.col(updated) >= F.lit(since))
    return chunk(changed, id_col, body, sep, [*keep, updated])


def redact_email(col: Column) -> Column:
    """Addresses masked.  Texts without an @ are left alone: the pattern would start anew at each letter."""
    return F.when(F.contains(col, F.lit("@")), F.regexp_replace(col, EMAIL_PATTERN, EMAIL_MASK)).otherwise(col)


def pack_text(
    df: DataFrame,
    group: str,
    text: Column,
    order: Sequence[str],
    ascending: bool = False,
    sep: str = PACK_SEPARATOR,
    part_rows: int = 1000,
) -> DataFrame:
    """Join the texts of each group in order, in numbered parts of at most ``part_rows`` texts.

    A group of up to ``part_rows`` rows gives one row, with ``part`` = 0.  A larger one
    goes on in further parts (nothing is dropped), so no task or string holds an
    unbounded group.  ``order`` columns (newest first by default) must be total inside
    a group: end them with a unique key.
    """
    rows = df.select(group, *order, text.alias("_text"))
    placed = positions(rows, [F.col(c).asc() if ascending else F.col(c).desc() for c in order], [group])
    entry = F.struct(F.col("pos"), F.col("_text"))
    part = F.floor(F.col("pos") / part_rows).cast("int").alias("part")
    packed = placed.groupBy(group, part).agg(
        F.count(F.lit(1)).alias("item_count"), F.array_sort(F.collect_list(entry)).alias("_items")
    )
    joined = F.array_join(F.transform("_items", lambda e: e["_text"]), sep)
    return packed.select(group, "part", "item_count", joined.alias("packed_text"))


def clean_for_prompt(col: Column, missing: str = "N/A") -> Column:
    """A value made safe for a one-line place in a prompt."""
    return F.regexp_replace(F.coalesce(col.cast("string"), F.lit(missing)), PROMPT_UNSAFE_CHARS, " ")


def fill(template: str, values: Mapping[str, Column]) -> Column:
    """A prompt column: the template with every ``{name}`` replaced by its column."""
    pieces = []
    for i, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if i % 2:
            pieces.append(values[piece].cast("string"))
        elif piece:
            pieces.append(F.lit(piece))
    return F.concat(*pieces)


def one_of(col: Column, allowed: Sequence[str], default: str) -> Column:
    """The value if it is allowed, else the default (also for NULL)."""
    return F.when(col.isin(*allowed), col).otherwise(F.lit(default))


def triage_enforce(df: DataFrame, keep: Sequence[str] = ("ticket_id",)) -> DataFrame:
    """Force triage output onto its allowed values, defaults and lengths."""
    rationale = F.coalesce(F.col("short_rationale"), F.lit(RATIONALE_DEFAULT))
    return df.select(
        *keep,
        one_of(F.col("issue_category"), ISSUE_CATEGORIES, ISSUE_CATEGORY_DEFAULT).alias("issue_category"),
        one_of(F.col("severity"), SEVERITIES, SEVERITY_DEFAULT).alias("severity"),
        F.coalesce(F.col("needs_engineering"), F.lit(False)).alias("needs_engineering"),
        F.substring(rationale, 1, RATIONALE_LENGTH).alias("short_rationale"),
    )


def safe_retrieval(chunks: DataFrame, content: str = "content", approved: str = "is_approved",
                   pattern: str = UNSAFE_CHUNK_PATTERN) -> DataFrame:
    """Approved chunks whose text shows no injection or secret pattern."""
    return chunks.where(F.col(approved) & ~F.lower(content).rlike(pattern))


def query_tokens(text: Column) -> Column:
    """Array of the words of at least three letters or digits of a query, repeats kept."""
    words = F.split(F.regexp_replace(F.lower(text), "[^a-z0-9 ]", " "), " ")
    return F.filter(words, lambda t: F.length(t) >= 3)


def lexical_hits(content: Column, query: Column) -> Column:
    """How many query words (an array) occur in the content as whole words."""
    words = F.array_distinct(F.split(F.lower(content), "[^a-z0-9]+"))
    # Bound as a lambda variable, the word list is made once and not once per query word.
    counts = F.transform(F.array(words), lambda w: F.size(F.filter(query, lambda t: F.array_contains(w, t))))
    return counts[0]
