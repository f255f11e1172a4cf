"""Exact top-k beside a full scan in numpy."""

import numpy as np
import pyarrow as pa
import pytest

from millrace.llm.segment_search import summaries, top_k

INF, NAN = float("inf"), float("nan")


def brute(rows, queries, k, scale=1024.0):
    def ints(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v):
            return None
        return np.floor(np.array(v, np.float64) * scale).astype(np.int64)

    usable = [(i, ints(v)) for i, v in rows if ints(v) is not None]
    out = set()
    for qi, qv in {(i, None if v is None else tuple(v)) for i, v in queries}:
        q = None if qv is None else ints(qv)
        if qi is None or q is None:
            continue
        found = sorted(((-int((q * v).sum()), i is None, i or 0, i) for i, v in usable if i != qi and len(v) == len(q)),
                       key=lambda t: t[:3])
        out |= {(qi, r + 1, f[3], -f[0]) for r, f in enumerate(found[:k])}
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string").repartition(5)


@pytest.mark.parametrize("dims,block", [(16, 4096), (7, 3), (1, 2)])
def test_against_a_full_scan(spark, dims, block):
    rng = np.random.default_rng(dims)
    base = rng.normal(size=(300, dims)).astype(np.float32)
    base[50:90] = base[3]  # copies: ties
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    rows += [(i, v) for i, v in rows[60:64]]  # repeated rows
    rows += [(900, None), (901, [NAN] * dims), (902, [INF] + [0.0] * (dims - 1)), (903, [None] * dims), (904, []),
             (905, [1.0] * (dims + 3)), (906, [0.5] * (dims + 3)), (None, rows[3][1]), (None, rows[7][1]), (907, [0.0] * dims)]
    queries = [r for r in rows if r[0] is None or r[0] % 10 == 0 or r[0] > 899]
    got = top_k(frame(spark, rows), frame(spark, queries), k=10, block_rows=block, batch_rows=17).collect()
    assert {tuple(r) for r in got} == {(a, b, c, d) for a, b, c, d in brute(rows, queries, 10)}


def test_fewer_rows_than_k_and_none(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    got = top_k(frame(spark, rows), frame(spark, rows[:1]), k=10).collect()
    assert {tuple(r) for r in got} == brute(rows, rows[:1], 10)
    assert top_k(frame(spark, []), frame(spark, []), k=3).count() == 0
    assert top_k(frame(spark, []), frame(spark, rows), k=3).count() == 0
    assert top_k(frame(spark, rows[:1]), frame(spark, rows[:1]), k=3).count() == 0


def test_large_components_are_whole(spark):
    rows = [(0, [9000.0, 1.0]), (1, [20000.0, 0.5]), (2, [9000.0, -3.0]), (3, [-50000.0, 0.0]), (4, [8192.0, 2.0]),
            (5, [2.0**21, 2.0**21]), (6, [2.0**21, -(2.0**21)]), (7, [2.0**20, 2.0**20 - 1])]
    got = top_k(frame(spark, rows), frame(spark, rows[:7]), k=10, batch_rows=3).collect()
    assert {tuple(r) for r in got} == brute(rows, rows[:7], 10)


def test_scores_beyond_64_bits():
    from millrace.llm.segment_search import Best, quantise

    q, x = np.array([[1 << 40, 1 << 40]]), np.array([[1 << 40, 5 - (1 << 40)], [3, 4]])
    best = Best(np.array([1]), q, 5, (1, 2))
    best.offer(np.array([2, 3]), np.zeros(2, bool), x)
    assert best.score.tolist() == [7 << 40, 5 << 40] and best.id.tolist() == [3, 2]
    for far in ([1 << 40, 1 << 40], [-(1 << 40), -(1 << 40)]):
        with pytest.raises(OverflowError, match="query 1"):
            Best(np.array([1]), q, 5, (1, 2)).offer(np.array([2]), np.zeros(1, bool), np.array([far]))
    with pytest.raises(OverflowError, match="component"):
        quantise(pa.array([[1e30, 0.0]]), 1024.0)


def test_bounds_never_fall_below_the_product():
    rng = np.random.default_rng(1)
    a, b = (rng.integers(-2000, 2000, size=(40, 30)).astype(np.int64) for _ in range(2))
    exact = a @ b.T
    last = None
    for m in (1, 4, 16, 30):
        bound = summaries(a, m) @ summaries(b, m).T
        assert (bound >= exact - 1e-6).all()
        last = bound
    assert np.allclose(last, exact)  # one component a segment: nothing left to bound
