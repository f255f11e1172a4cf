"""The Jaccard join beside all pairs."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from frames import no_documents, odd_documents, prose  # noqa: E402

from millrace.llm import ngram_join  # noqa: E402
from millrace.llm.components import components  # noqa: E402
from millrace.llm.registry import QUERIES  # noqa: E402
from millrace.session import load  # noqa: E402


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1)))


def brute(docs, percent=75, width=5):
    sets = [shingles(t, width) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for k, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    seen = set()
    for group in holders.values():
        for i, a in enumerate(group):
            for b in group[:i]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    both = len(sets[a] & sets[b])
                    if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                        parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(docs):
        if i is not None and sets[k]:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted(((i, len(s), least.get(root(k)) if s else i) for k, ((i, _), s) in enumerate(zip(docs, sets))), key=repr)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_shingles", "component_id").collect()), key=repr)


def near(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


def copies(seed):
    """Groups of near copies with growing distance, chains, a shared passage, short texts."""
    rng = random.Random(seed)
    passage = prose(rng, 60)
    docs = []
    for g in range(6):
        base = prose(rng, rng.choice([30, 80, 200]))
        docs.append(base)
        docs += [near(rng, base, rng.randint(0, 9)) for _ in range(25)]
        chain = base
        for _ in range(8):
            chain = near(rng, chain, 2)
            docs.append(chain)
        docs += [base, base.upper()]
    docs += [f"{passage} {prose(rng, n)}" for n in (5, 10, 15, 20, 30, 60) for _ in range(4)]
    docs += [prose(rng, rng.randint(1, 300)) for _ in range(80)] + ["a b", "A b", "a b c", "a", "a a", "a a a a a a", "", None]
    rng.shuffle(docs)
    return [(k * 3 + 1, t) for k, t in enumerate(docs)]


@pytest.mark.parametrize("seed,percent,block", [(1, 75, 200_000), (2, 75, 300), (3, 90, 300), (4, 50, 1000)])
def test_against_all_pairs(spark, monkeypatch, seed, percent, block):
    monkeypatch.setattr(ngram_join, "BLOCK_TOKENS", block)
    docs = copies(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert result(ngram_join.ngram_components(df, percent=percent)) == brute(docs, percent)


def test_query_over_the_table(spark, data):
    docs = [tuple(r) for r in load(spark, data, "documents").select("doc_id", "text").collect()]
    assert result(QUERIES["op10_ngram_join"](spark, data)) == brute(docs)


def test_odd_rows(spark):
    df = odd_documents(spark)
    docs = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert result(ngram_join.ngram_components(df)) == brute(docs)
    assert ngram_join.ngram_components(no_documents(spark)).count() == 0
    kept = ngram_join.drop_near_copies(df)
    assert kept.columns == df.columns
    ids = [r["doc_id"] for r in kept.select("doc_id").collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12, 13] and ids.count(None) == 2
    assert ngram_join.drop_near_copies(no_documents(spark)).count() == 0


def test_components(spark):
    rng = random.Random(7)
    edges = [(k, k + 1) for k in range(0, 60)] + [(200 + rng.randrange(100), 200 + rng.randrange(100)) for _ in range(60)]
    edges += [(5, 5), (None, 3), (900, 901), (901, 900)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            parent[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_rows_that_repeat_an_id_or_have_none(spark):
    """Rows link by text, not by id: unlinked rows stay whatever their id, linked ones leave one."""
    rng = random.Random(5)
    a, b, c = (prose(rng, 50) for _ in range(3))
    rows = [(1, a), (1, b), (2, c), (None, c), (None, c.upper()), (3, a + " end"), (4, ""), (4, ""), (None, None), (5, "x y"),
            (5, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = sorted(map(tuple, ngram_join.drop_near_copies(df).collect()), key=repr)
    assert kept == sorted([(1, a), (1, b), (2, c), (4, ""), (4, ""), (None, None), (5, "x y")], key=repr)
    nameless = spark.createDataFrame([(None, a), (None, a + " end"), (None, b)], "doc_id long, text string")
    assert ngram_join.drop_near_copies(nameless).count() == 2


def test_tiles_are_bounded(monkeypatch):
    """A block of 20,000 short sets made of 40 common lines, compared under a limit on memory."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(3)
    lines = rng.integers(1, 1 << 48, (40, 5)).astype(np.uint64)
    lists = [np.unique(lines[rng.choice(40, 5, replace=False)].ravel()) for _ in range(20_000)]
    table = pa.table({
        "low": [0] * len(lists), "high": [0] * len(lists), "set": range(len(lists)), "label": range(len(lists)),
        "block": [0] * len(lists), "size": pa.array([len(x) for x in lists], pa.int32()),
        "shared": pa.array([len(x) for x in lists], pa.int32()),
        "tokens": [ngram_join.pack(x, 6) for x in lists], "marks": [b"\7" * len(x) for x in lists]})
    few = table.slice(0, 2500)
    tracemalloc.start()
    tiles = ngram_join._open_tiles(75)(few)
    parts = ngram_join._tiles(table)
    assert max(p.num_rows for p in parts) <= ngram_join.TILE_SETS
    found = [
        ngram_join._compare(75)(tiles.filter(pa.compute.equal(tiles["tile"], name)).join(
            few.select(["set", "size", "shared", "tokens"]), "set").combine_chunks())
        for name in sorted(set(tiles["tile"].to_pylist()))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20
    links = [(a, b) for t in found for a, b in zip(t["a"].to_pylist(), t["b"].to_pylist())]
    parent = list(range(2500))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    got = [root(k) for k in range(2500)]
    for a, b in links:
        both = len(np.intersect1d(lists[a], lists[b]))
        assert 100 * both >= 75 * (len(lists[a]) + len(lists[b]) - both)
    held = np.zeros((2500, 40), np.float32)
    for k in range(2500):
        held[k] = np.isin(lines[:, 0], lists[k])
    both = (held @ held.T).astype(int) * 5
    linked = 100 * both >= 75 * (50 - both)
    for a, b in zip(*np.nonzero(linked)):
        assert got[a] == got[b]
