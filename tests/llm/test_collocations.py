"""Phrase mining beside dictionaries of counts."""

import random
import re
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from frames import no_documents, odd_documents  # noqa: E402

from millrace.llm import collocations  # noqa: E402
from millrace.llm.registry import QUERIES  # noqa: E402
from millrace.session import load  # noqa: E402

UPPER = {ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def brute(docs, least=100, longest=5, top=2000, share=100):
    counts, n = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        f = counts.setdefault(lang, Counter())
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(UPPER)):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        around = {}
        for p, a in found.items():
            for m in range(2, len(p)):
                for s in range(len(p) - m + 1):
                    around[p[s : s + m]] = max(a, around.get(p[s : s + m], 0))
        rows = []
        for p, a in found.items():
            if 100 * around.get(p, 0) >= share * a:
                continue
            score, k = min((1000 * a * n[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def result(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


def corpus(seed, n=400):
    rng = random.Random(seed)
    names = [f"w{k}" for k in range(40)] + ["Ünit", "日本", "a b"]
    weights = [1 / (k + 1) for k in range(len(names))]
    fixed = ["once upon a time there", "Of The kind", "x x x x x x"]
    docs = []
    for _ in range(n):
        words = rng.choices(names, weights, k=rng.randint(0, 60))
        for _ in range(rng.randint(0, 3)):
            words.insert(rng.randint(0, len(words)), rng.choice(fixed))
        ends = rng.choices(["", "", "", "", ",", ".", "!\n", "\t"], k=len(words))
        docs.append((rng.choice(["en", "en", "de", None, "und", ""]), " ".join(w + e for w, e in zip(words, ends))))
    return docs


@pytest.mark.parametrize("seed,least,block,entries,dense", [(1, 5, 1 << 22, 1 << 20, 8), (2, 3, 3000, 200, 1), (3, 8, 2000, 4000, 100_000)])
def test_against_dictionaries(spark, monkeypatch, seed, least, block, entries, dense):
    monkeypatch.setattr(collocations, "BLOCK_BYTES", block)
    monkeypatch.setattr(collocations, "SLOT_ENTRIES", entries)
    monkeypatch.setattr(collocations, "DENSE", dense)
    docs = corpus(seed)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    assert result(collocations.collocations(df, least=least, top=300)) == brute(docs, least, top=300)


def test_length_share_and_top(spark):
    docs = corpus(9)
    df = spark.createDataFrame(docs, "lang string, text string")
    got = result(collocations.collocations(df, least=4, longest=3, top=7, share=60))
    assert got == brute(docs, 4, 3, 7, 60)


def test_query_over_the_table(spark, data):
    docs = [tuple(r) for r in load(spark, data, "documents").select("lang", "text").collect()]
    assert result(QUERIES["op12_collocations"](spark, data)) == brute(docs)


def test_odd_rows(spark):
    df = odd_documents(spark)
    docs = [tuple(r) for r in df.select("lang", "text").collect()]
    assert result(collocations.collocations(df, least=2)) == brute(docs, 2)
    assert result(collocations.collocations(df)) == brute(docs)
    assert result(collocations.collocations(no_documents(spark))) == []
    long = [("en", "one two three, " * 200_000), ("en", "x " * 300_000), (None, None)]
    assert result(collocations.collocations(spark.createDataFrame(long, "lang string, text string"))) == brute(long)


def test_tiles_and_coordinates_agree():
    rng = np.random.default_rng(1)
    keys = (rng.geometric(0.05, 20_000).astype(np.uint64) << np.uint64(32)) | rng.geometric(0.05, 20_000).astype(np.uint64)
    counts = rng.integers(1, 50, 20_000).astype(np.float64)
    want = Counter()
    for k, c in zip(keys.tolist(), counts.tolist()):
        want[k] += c
    for side in (None, 0, 1, 3, 6):
        for dense in (1, 8, 10**9):
            assert collocations.tile_totals(keys, counts, side, dense).tolist() == [want[k] for k in keys.tolist()]


def test_products_past_64_bits(spark):
    from pyspark.sql import functions as F

    values = [(3 * 10**12, 9 * 10**12, 4 * 10**12, 3 * 10**12), (100, 10**13, 100, 101), (7, 7, 7, 7), (10**12 + 1, 10**13 - 1, 10**12 + 3, 10**12 + 7)]
    df = spark.createDataFrame(values, "a long, n long, l long, r long")
    got = df.select("a", "n", "l", "r", collocations._score(*map(F.col, "anlr")).alias("s")).collect()
    assert [r["s"] for r in got] == [1000 * r["a"] * r["n"] // (r["l"] * r["r"]) for r in got]
