"""The model beside counts in dictionaries."""

import math
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from frames import no_documents, odd_documents  # noqa: E402

from millrace.llm import interpolated_lm as lm  # noqa: E402
from millrace.llm.registry import QUERIES  # noqa: E402
from millrace.session import load  # noqa: E402

END = b"</end>"


def tokens(text):
    return [*(text or "").encode().lower().split(), END]


def fold(id_):
    return 0 if id_ is None else zlib.crc32(str(id_).encode()) % 7


def brute(docs):
    """Weights and scores from dictionaries; the estimates on the same logarithmic grid."""
    def counts(folds):
        words, pairs, contexts, n = Counter(), Counter(), Counter(), 0
        for id_, text in docs:
            if fold(id_) in folds:
                ts = tokens(text)
                words.update(ts)
                n += len(ts)
                for h, w in zip([None, *ts], ts):
                    pairs[h, w] += 1
                    contexts[h] += 1
        return words, pairs, contexts, n

    words, pairs, contexts, n = counts({0, 1, 3, 4, 5, 6})
    kept_words, kept_pairs, kept_contexts, kept_n = counts({0, 1, 4, 5, 6})
    bucket = lambda c: min(int(math.log2(c)) + 1, 63) if c else 0
    grid = lambda p: int(np.rint(8 * np.log2(p))) if p else 1
    cells = Counter()
    for id_, text in docs:
        if fold(id_) == 3:
            ts = tokens(text)
            for h, w in zip([None, *ts], ts):
                c = kept_contexts[h]
                cells[bucket(c), grid(kept_pairs[h, w] / c if c else 0), grid(kept_words[w] / max(kept_n, 1))] += 1
    v = len(words)
    table = np.array([[*k, m] for k, m in sorted(cells.items())], np.int64).reshape(-1, 4)
    weights = lm.learn_weights(table, 1 / (v + 1))
    out = []
    for id_, text in docs:
        ts = tokens(text)
        base = sum(math.log10((words[w] + 1) / (n + v + 1)) for w in ts)
        score = 0.0
        for h, w in zip([None, *ts], ts):
            c = contexts[h]
            a = weights[bucket(c)]
            p = a[0] * pairs[h, w] / max(c, 1) + a[1] * words[w] / max(n, 1) + a[2] / (v + 1)
            score += math.log10(p if c else p / (1 - a[0]))
        out.append((id_, fold(id_) == 2, len(ts), sum(words[w] > 0 for w in ts), n, base, score))
    return out, (words, pairs, contexts, n, weights, bucket)


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9)
        assert g[6] == pytest.approx(w[6], rel=1e-6)


def test_query_over_the_table(spark, data):
    docs = [(r["doc_id"], r["text"]) for r in load(spark, data, "documents").select("doc_id", "text").collect()]
    rows = QUERIES["op4_interpolated_lm"](spark, data).collect()
    want, _ = brute(docs)
    same(rows, want)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_odd_rows(spark, monkeypatch):
    docs = odd_documents(spark)
    rows = lm.score_documents(docs.repartition(3)).collect()
    want, _ = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    same(rows, want)
    assert lm.score_documents(no_documents(spark)).count() == 0


def test_rows_in_another_order_in_each_job(spark):
    """A scan that is cut, or a shuffle that is read, differently whenever it runs loses no document."""
    def shuffled(batches):
        for batch in batches:
            order = list(range(batch.num_rows))
            random.SystemRandom().shuffle(order)
            yield batch.take(pa.array(order))

    docs = [(k, f"a b w{k % 5} w{k % 7} c") for k in range(60)]
    given = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    want, _ = brute(docs)
    same(lm.score_documents(given.mapInArrow(shuffled, given.schema)).collect(), want)


def test_block_without_all_its_answers():
    row = next(lm._block_rows(iter([pa.RecordBatch.from_pydict({"id": [1], "fold": [3], "text": [b"a b"]})])))
    left = pa.Table.from_batches([row])
    task = lm._score(np.full((64, 3), 1 / 3), 3, 3, 1)
    answer = pa.table({"kind": [1, 2], "slot": [0, 0], "block": [1, 1], "train": [lm.pack(np.ones(3))] * 2})
    assert task(left, answer).num_rows == 1
    for some in (answer.slice(0, 0), answer.slice(0, 1)):
        with pytest.raises(RuntimeError, match="asked for 3 words and 3 pairs"):
            task(left, some)
    pairs = pa.Table.from_batches(list(lm._deleted_rows(3)(iter([row]))))
    with pytest.raises(RuntimeError, match="asked for 3 words and 3 pairs"):
        lm._grid(3, 1)(pairs, answer.drop_columns("train").append_column("kept", answer["train"]).slice(0, 0))


def test_only_held_out_documents(spark):
    ids = [k for k in range(200) if fold(k) == 2][:3]
    docs = spark.createDataFrame([(k, "a b c") for k in ids], "doc_id long, text string")
    for r in lm.score_documents(docs).collect():
        assert r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0 and abs(r["score"]) < 1e-9


def test_probabilities_sum_to_one():
    """Over all known words and one unknown, after any context."""
    docs = [(k, t) for k, t in enumerate(["a b a b c", "a b", "c c a", "b a b", "", "a a a b c d"] * 6)]
    _, (words, pairs, contexts, n, weights, bucket) = brute(docs)
    for h in [None, b"a", b"b", b"c", b"d"]:
        c, v = contexts[h], len(words)
        a = weights[bucket(c)]
        total = sum(a[0] * pairs[h, w] / c + a[1] * words[w] / n + a[2] / (v + 1) for w in words) + a[2] / (v + 1)
        assert total == pytest.approx(1)


def test_weights_follow_the_deleted_counts():
    good = np.array([[5, -8, -40, 1000]])  # the pair estimate explains the events
    poor = np.array([[5, 1, -40, 1000]])  # no pair was ever seen before
    assert lm.learn_weights(good, 1e-6)[5, 0] > 0.9
    assert lm.learn_weights(poor, 1e-6)[5, 0] < 0.05
    assert np.allclose(lm.learn_weights(good, 1e-6).sum(1), 1)
