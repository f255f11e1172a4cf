"""The numbered queries over the test tables, each beside its check SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    byte_bpe, collocations, interpolated_lm, license_scan, mixing, ngram_join, outliers, segment_search, site_quality, token_orc, turn_repair,
    url_rules, warc_archive,
)
from millrace.session import load, prepare, work_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Rules of the URL filter: host, path, action.
URL_RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(prepare(spark), folder)
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


@query("op1_token_orc")
def token_orc_query(spark: SparkSession, folder: str) -> DataFrame:
    out = work_path(spark, "tokens")
    token_orc.write_tokens(load(spark, folder, "documents"), out, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    summed = token_orc.with_starts(token_orc.checksums(token_orc.read_tokens(spark, out)))
    return summed.select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids_crc32")


@query("op2_site_quality")
def site_quality_query(spark: SparkSession, folder: str) -> DataFrame:
    return site_quality.classify(load(spark, folder, "documents"), load(spark, folder, "labels"), keep=("doc_id",))


@query("op3_entropy_mix")
def entropy_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(load(spark, folder, "documents"), weights=(5, 2, 1), cap=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


@query("op4_interpolated_lm")
def interpolated_lm_query(spark: SparkSession, folder: str) -> DataFrame:
    return interpolated_lm.score_documents(load(spark, folder, "documents"))


@query("op5_robust_outliers")
def robust_outliers_query(spark: SparkSession, folder: str) -> DataFrame:
    judged = outliers.reject_outliers(load(spark, folder, "documents"), keep=("doc_id",))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "distance")


@query("op6_segment_search", """
WITH parts AS (
    SELECT vec_id, generate_subscripts(embedding, 1) AS i, unnest(embedding) AS x
    FROM embeddings
    WHERE embedding IS NOT NULL
), usable AS (
    SELECT vec_id FROM parts GROUP BY vec_id HAVING bool_and(x IS NOT NULL AND isfinite(x))
), ints AS (
    SELECT vec_id, i, CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) AS v FROM parts SEMI JOIN usable USING (vec_id)
), scores AS (
    SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.v * c.v) AS BIGINT) AS score
    FROM ints q JOIN ints c ON q.i = c.i
    WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
    GROUP BY 1, 2
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
""")
def segment_search_query(spark: SparkSession, folder: str) -> DataFrame:
    vectors = load(spark, folder, "embeddings")
    return segment_search.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0), k=10)


@query("op7_byte_bpe")
def byte_bpe_query(spark: SparkSession, folder: str) -> DataFrame:
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = byte_bpe.decode(byte_bpe.encode(load(spark, folder, "documents"), ranks, pattern), ranks, pattern)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"))


@query("op8_warc_archive", """
WITH p AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
    SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p
), o AS (
    SELECT *, min(page_id) OVER (PARTITION BY digest) AS owner FROM d
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> owner THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> owner THEN owner END AS refers_to
FROM o
""")
def warc_archive_query(spark: SparkSession, folder: str) -> DataFrame:
    out = work_path(spark, "archive")
    warc_archive.write_archive(load(spark, folder, "pages"), out)
    return warc_archive.read_records(spark, out).select(
        warc_archive.record_number("WARC-Record-ID").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        warc_archive.field("WARC-Type").alias("record_type"),
        warc_archive.record_number("WARC-Refers-To").alias("refers_to"))


@query("op9_url_rules", """
WITH rules(host, path, action) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'),
           ('org', '/fr/', 'allow')
), rest AS (
    SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM rest
), urls AS (
    SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
    FROM parts
), judged AS (
    SELECT u.page_id, u.host, u.path, r.host || r.path AS rule, r.action,
           row_number() OVER (PARTITION BY u.page_id ORDER BY length(r.host || r.path) DESC NULLS LAST) AS place
    FROM urls u LEFT JOIN rules r
      ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM judged WHERE place = 1
""")
def url_rules_query(spark: SparkSession, folder: str) -> DataFrame:
    rules = url_rules.rule_table(spark, URL_RULES)
    return url_rules.judge_urls(load(spark, folder, "pages"), rules, keep=("page_id",))


@query("op10_ngram_join")
def ngram_join_query(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.ngram_components(load(spark, folder, "documents"), percent=75, width=5)


@query("op13_turn_repair")
def turn_repair_query(spark: SparkSession, folder: str) -> DataFrame:
    return turn_repair.repair_conversations(load(spark, folder, "conversations"))


@query("op12_collocations", r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), totals AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang
), places AS (
    SELECT lang, w, unnest(generate_series(1, len(w))) AS i FROM words
), grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM places, (VALUES (1), (2), (3), (4), (5)) AS sizes(k)
    WHERE i + k - 1 <= len(w)
    GROUP BY ALL HAVING count(*) >= 100
), candidates AS (
    SELECT lang, k, phrase, f, string_split(phrase, ' ') AS w FROM grams WHERE k >= 2
), inside AS (
    SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(f) AS around
    FROM candidates, (VALUES (2), (3), (4)) AS shorter(m), (VALUES (1), (2), (3), (4)) AS starts(s)
    WHERE m < k AND s + m - 1 <= k
    GROUP BY ALL
), cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, h.f AS l, t.f AS r, n, j,
           CAST(CAST(1000 AS HUGEINT) * c.f * n // (CAST(h.f AS HUGEINT) * t.f) AS BIGINT) AS score
    FROM candidates c
    JOIN totals USING (lang)
    CROSS JOIN (VALUES (1), (2), (3), (4)) AS places_cut(j)
    JOIN grams h ON h.lang = c.lang AND h.k = j AND h.phrase = array_to_string(c.w[1:j], ' ')
    JOIN grams t ON t.lang = c.lang AND t.k = c.k - j AND t.phrase = array_to_string(c.w[j + 1:c.k], ' ')
    WHERE j < c.k
), lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), kept AS (
    SELECT * FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE around IS NULL OR around < a
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
""")
def collocations_query(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(load(spark, folder, "documents"))


def _license_sql() -> str:
    """The licence scan by a plain search of every template at every place, from the operator's own tables."""
    templates, base = license_scan.TEMPLATES, license_scan.BASE
    listed = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    posts = ", ".join(
        f"({k}, '{t.label}', {place}, '{word}', {len(t.text.split())}, {len(set(t.key))})"
        for k, t in enumerate(templates) for place, word in enumerate(t.text.split()) if word not in license_scan.STOP)
    keys = ", ".join(f"({k}, {listed(p.split())}, '{p}')" for k, t in enumerate(templates) for p in sorted(set(t.key)))
    bases = ", ".join(f"({listed(p.split())}, '{label}')" for p, label in base)
    return rf"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), posts(template, label, place, word, length, keys) AS (VALUES {posts}
), must(template, words, phrase) AS (VALUES {keys}
), base(words, label) AS (VALUES {bases}
), spots AS (SELECT row, w, unnest(generate_series(0, len(w) - 1)) AS pos FROM docs
), hits AS (
    SELECT row, w, pos, w[pos + 1] AS word FROM spots
    WHERE w[pos + 1] IN (SELECT word FROM posts UNION SELECT words[1] FROM must UNION SELECT words[1] FROM base)
), known AS (SELECT word, count(DISTINCT row) AS df FROM hits GROUP BY word
), weighed AS (
    SELECT posts.*, ln(((SELECT count(*) FROM docs) + 1) / (coalesce(df, 0) + 1)::DOUBLE) + 1 AS weight
    FROM posts LEFT JOIN known USING (word)
), mass AS (SELECT template, sum(weight) AS mass FROM weighed GROUP BY template
), votes AS (
    SELECT DISTINCT row, template, label, length, keys, place, weight, pos - place + slack AS begins
    FROM hits JOIN weighed USING (word), (VALUES (0), (1), (2)) AS s(slack)
), agreed AS (
    SELECT row, template, label, length, keys, begins, least(sum(weight) / any_value(mass), 1.0) AS share
    FROM votes JOIN mass USING (template) GROUP BY ALL HAVING sum(weight) / any_value(mass) >= 0.75 * (1 - 1e-9)
), stands AS (
    SELECT DISTINCT row, template, phrase, pos FROM hits JOIN must ON word = words[1] AND w[pos + 1:pos + len(words)] = words
), verified AS (
    SELECT row, template, label, begins, share FROM agreed JOIN stands USING (row, template)
    WHERE pos BETWEEN begins - 3 AND begins + length + 2
    GROUP BY row, template, label, begins, share, keys HAVING count(DISTINCT phrase) = keys
), found AS (SELECT row, list(DISTINCT label) AS more, max(share) AS share FROM verified GROUP BY row
), based AS (
    SELECT row, count(*) AS n, min(pos) AS lo, max(pos) AS hi, list(DISTINCT label) AS own
    FROM hits JOIN base ON word = words[1] AND w[pos + 1:pos + len(words)] = words GROUP BY row
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(own), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(more, [])))), ',') AS labels,
       CASE WHEN own IS NOT NULL THEN 1.0::DOUBLE ELSE round(coalesce(share, 0.0)::DOUBLE, 9) END AS score
FROM docs LEFT JOIN based USING (row) LEFT JOIN found USING (row)"""


@query("op11_license_scan", _license_sql())
def license_scan_query(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan_licenses(load(spark, folder, "documents"))
