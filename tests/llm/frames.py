"""Small tables with everything that real ones may hold."""

from __future__ import annotations

import random

WORDS = ("the of and to in is was for that with on as at by from river stone light garden window paper music "
         "winter travel market engine yellow silver bridge forest letter number answer question morning evening").split()


def prose(rng: random.Random, n: int) -> str:
    out = []
    while n > 0:
        k = min(n, rng.randint(4, 12))
        out.append(" ".join(rng.choice(WORDS) for _ in range(k)).capitalize() + ".")
        n -= k
    return " ".join(out)


def odd_documents(spark):
    """NULLs in every column, empty, short and very long texts, repeated rows, and columns with the
    names that operators use inside."""
    rng = random.Random(3)
    rows = [
        (1, prose(rng, 60), "en", "a"), (2, None, "en", "a"), (3, "", None, "b"), (4, " \n\t ", "de", None),
        (None, prose(rng, 40), "en", "a"), (None, None, None, None), (5, "one two", "en", "a"),
        (6, prose(rng, 30_000), "en", "a"), (7, "x" * 200_000, "en", "b"), (8, "Grüße, naïve Ærø 日本語 🙂", "de", "b"),
        (9, "same text as before " * 3, "fr", "c"), (9, "same text as before " * 3, "fr", "c"),
        (10, "same text as before " * 3, "fr", "c"), (11, "line one is here\nline one is here\n\nother\nline one is here", "fr", "c"),
        (12, "a\x00b \x1c c\x85d\u00a0e \u2003f", "en", "a"), (13, "<|endoftext|> it's WE'LL don't", "en", "a"),
    ]
    clash = [(i, i, "r", [i], i, "k", i, b"x", i, "t", i) for i in range(len(rows))]
    names = "row long, set long, key string, ids array<long>, size long, whole string, p long, bytes binary, kept long, label string, fold long"
    return spark.createDataFrame(
        [(*r, len(r[1] or ""), *c) for r, c in zip(rows, clash)],
        f"doc_id long, text string, lang string, source string, n_chars long, {names}")


def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
