"""URL filter by host and path rules, native DataFrame operations only.

Every URL is expanded into expressions host-suffix + path-prefix, as list-based URL
filters do.  The expressions meet the rules by an equi-join on a short prefix of their
SHA-256; a match counts only if the full digests agree and the path begins with the
rule's path.  The longest matching rule decides.

A rule's path may end inside a path segment ("/en" fits "/english"): its expression
ends at its last slash and the rest is compared after the join.  URLs are expanded no
deeper than the longest rule goes, because deeper expressions can't equal any rule's.

Each distinct (host, path) is expanded once, so a URL that holds a third of all rows
costs one row after the map-side combine; the verdicts go back by an outer join whose
hot side adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import ascii_lower


def split_url(url: Column) -> tuple[Column, Column]:
    """Host and path; both empty for NULL or a text without ``://``.

    Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased.
    Path: from there up to ``?``, ``#`` or the end.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return ascii_lower(host), path


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, action) as a DataFrame; a rule list can as well be read from a table."""
    return spark.createDataFrame(list(rules), "host string, path string, action string")


def _folder(path: Column) -> Column:
    """The path up to and with its last slash."""
    return F.regexp_extract(path, "(?s)^.*/", 0)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    keep: Sequence[str] = ("page_id",),
    default: str = "allow",
    hash_digits: int = 8,
) -> DataFrame:
    """The columns ``keep`` of every row of ``pages`` with host, path, rule and verdict.

    A rule fits its host and all subdomains of it, if the path begins with the rule's
    path.  The longest rule (characters of host and path) wins, then the longer host, then
    ``block``; without any, ``rule`` is NULL and ``verdict`` is ``default``.  Rules with a NULL or
    empty host or a NULL action fit nothing; a NULL path is the empty one.  Repeated rules
    and rows change nothing else; an empty rule table lets everything have ``default``.
    """
    host, path = split_url(F.col(url).cast("string"))
    rows = pages.select(
        F.struct(*[F.col(c) for c in keep]).alias("row"), host.alias("host"), path.alias("path")
    )

    known = rules.select(
        ascii_lower(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "action"
    ).where("rule_host <> '' AND action IS NOT NULL")
    key = F.concat("rule_host", _folder(F.col("rule_path")))
    known = known.select(
        "*",
        F.sha2(key, 256).alias("rule_digest"),
        F.length(F.concat("rule_host", "rule_path")).alias("rule_length"),
        F.size(F.split("rule_host", r"\.")).alias("labels"),
        (F.size(F.split("rule_path", "/")) - 1).alias("folders"),
    )
    # How deep expressions can go and still equal a rule's: two numbers, joined as scalars.
    labels = known.agg(F.coalesce(F.max("labels"), F.lit(0))).scalar()
    folders = known.agg(F.coalesce(F.max("folders"), F.lit(0))).scalar()

    parts, steps = F.split("host", r"\."), F.split("path", "/")
    distinct = (
        rows.select("host", "path").where("host <> ''").distinct()
        .select("host", "path", parts.alias("parts"), steps.alias("steps"))
        .select("*", F.least(F.size("parts"), labels).alias("n_suffix"),
                F.least(F.size("steps") - 1, folders).alias("n_prefix"))
    )
    expressions = (
        distinct.where("n_suffix > 0")
        .select("host", "path", "steps", "n_prefix", F.explode(F.expr(
            "transform(sequence(1, n_suffix), k -> array_join(slice(parts, size(parts) - k + 1, k), '.'))"
        )).alias("suffix"))
        .select("host", "path", "suffix", F.explode(F.expr(
            "transform(sequence(0, n_prefix), k -> if(k = 0, '', concat(array_join(slice(steps, 1, k), '/'), '/')))"
        )).alias("prefix"))
        .select("host", "path", F.sha2(F.concat("suffix", "prefix"), 256).alias("digest"))
        .withColumn("short", F.substring("digest", 1, hash_digits))
    )
    known = known.withColumn("rule_short", F.substring("rule_digest", 1, hash_digits))
    best = (
        expressions.join(known, F.col("short") == F.col("rule_short"))
        .where((F.col("digest") == F.col("rule_digest")) & F.col("path").startswith(F.col("rule_path")))
        .groupBy("host", "path")
        .agg(F.max(F.struct(
            "rule_length", F.length("rule_host").alias("host_length"), (F.col("action") == "block").alias("blocks"),
            F.concat("rule_host", "rule_path").alias("rule"), "action",
        )).alias("best"))
    )
    return rows.join(best, ["host", "path"], "left").select(
        "row.*", "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )
