"""Scoring with an n-gram model by deleted interpolation.

The probability of a word after another mixes maximum-likelihood estimates,

    p(w | h) = a c(h, w) / c(h) + b c(w) / N + c / (V + 1),

with weights a, b, c for each bucket of the context's count c(h), a bucket per power of two.  The
weights are those that expectation-maximisation finds on counts deleted from the estimates: one of
the seven folds of documents is left out of the counts while the weights are learned and goes back
in for scoring.  Another fold is held out of the model altogether.

Every text is counted and scored whole, and no count is dropped.

1.  Texts become blocks of bounded size, once: they are stored, and all that follows reads that table, so
    that how the scan was cut doesn't matter.  A block asks for the counts of its distinct words and word
    pairs, as sorted 64-bit hashes in ranges, and tells how often it has each itself.  A word that makes up
    a third of the corpus is one entry per block; ranges, not words, are dealt out.
2.  A range adds up its keys over all blocks and answers every block in the order it asked.
3.  The answers meet the deleted fold's pairs: a table of (bucket, pair estimate, word estimate) on a
    logarithmic grid, whose size doesn't depend on the corpus, is what the weights are learned from.
4.  The answers meet the blocks again, which score their documents.  A block whose answers aren't all
    there ends the job.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import (
    WordScan, bounded_batches, chunks, joined, mix, pack, pack_sorted, release, store, text_bytes, unpack, unpack_sorted,
)

BLOCK_BYTES = 8 << 20
#: Rows of the stored blocks are large: a row group closes as soon as it has this many bytes, so that
#: neither writer nor reader holds more than about one block.
BLOCK_OPTIONS = {"parquet.block.size": str(BLOCK_BYTES), "parquet.page.size.row.check.min": "1"}
RANGE_KEYS = 1 << 20
#: Stand for the start and the end of a text among the hashes of words.
START, END = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
#: Steps of the grid to a power of two, and buckets of context counts.
GRID, BUCKETS = 8, 64
NONE = -(1 << 63)


class Block:
    """The tokens of some documents: ids, fold, tokens per document, distinct hashes (sorted) and for each
    token which of them it is."""

    def __init__(self, ids: np.ndarray, folds: np.ndarray, sizes: np.ndarray, words: np.ndarray, word: np.ndarray):
        self.ids, self.folds, self.sizes, self.words, self.word = ids, folds, sizes, words, word

    def keys(self):
        """Distinct words and pairs, sorted, and for each token its word, its pair and its context's word
        (-1 for the start)."""
        words, word = self.words, self.word
        hashes = words[word]
        before = np.empty_like(hashes)
        before[1:] = hashes[:-1]
        context = np.empty(len(word), np.int64)
        context[1:] = word[:-1]
        first = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        before[first], context[first] = START, -1
        pairs, pair = np.unique(mix(before * np.uint64(0x9E3779B97F4A7C15) + hashes), return_inverse=True)
        return words, word, pairs, pair, context

    def name(self) -> int:
        """A number that depends on what the block holds, so that a repeated task gives the same."""
        parts = np.concatenate([self.ids.view(np.uint64), self.sizes.astype(np.uint64), self.words[self.word]])
        return int(mix(np.add.reduce(mix(parts + np.arange(len(parts), dtype=np.uint64))).reshape(1)).view(np.int64)[0])


def _cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    """Blocks from rows (id, fold, text as bytes)."""
    scan, held = WordScan(), 0
    parts: list[tuple] = []

    def block() -> Block:
        ids, folds, sizes, hashes = [np.concatenate(x) for x in zip(*parts)]
        parts.clear()
        return Block(ids, folds, sizes, *np.unique(hashes, return_inverse=True))

    for batch in batches:
        ids, folds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        done = 0
        for texts in chunks(batch.column(2).to_pylist()):
            whole, begins = joined(texts)
            raw = np.frombuffer(whole.lower(), np.uint8)
            starts, ends = scan.words(raw)
            at = np.searchsorted(starts, begins)
            hashes = np.insert(scan.hashes(raw, starts, ends), at[1:], END)
            upto = done + len(texts)
            parts.append((ids[done:upto], folds[done:upto], np.diff(at) + 1, hashes))
            done = upto
            held += len(raw)
            if held >= BLOCK_BYTES:
                yield block()
                held = 0
    if parts:
        yield block()


BLOCKS = "block long, ids binary, folds binary, sizes binary, words binary, tokens binary"


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in _cut_blocks(batches):
        release()
        yield pa.RecordBatch.from_arrays([
            pa.array([block.name()]), pa.array([pack(block.ids)]), pa.array([pack(block.folds)]),
            pa.array([pack(block.sizes)]), pa.array([pack_sorted(block.words)]),
            pa.array([block.word.astype(np.uint32).tobytes()])],
            names=["block", "ids", "folds", "sizes", "words", "tokens"])


def _block(row: dict) -> Block:
    """A block from its stored row."""
    return Block(
        unpack(row["ids"]).view(np.int64), unpack(row["folds"]).astype(np.int64), unpack(row["sizes"]).astype(np.int64),
        unpack_sorted(row["words"]), np.frombuffer(row["tokens"], np.uint32).astype(np.int64))


def _stored_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    """Names and blocks, one at a time, from stored rows."""
    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1).to_pylist()[0]
            yield row["block"], _block(row)


REQUEST = "kind int, slot int, block long, keys binary, train binary, kept binary"
ANSWER = "kind int, slot int, block long, train binary, kept binary, n_distinct long, n_train long, n_kept long"


def _slots_of(keys: np.ndarray, slots: int) -> np.ndarray:
    """Where each range of hashes begins among sorted keys."""
    return np.searchsorted(((keys >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64), np.arange(slots + 1))


def _requests(slots: int, held_out: int, deleted: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, block in _stored_blocks(batches):
            words, word, pairs, pair, _ = block.keys()
            fold = np.repeat(block.folds, block.sizes)
            train, kept = fold != held_out, (fold != held_out) & (fold != deleted)
            for kind, keys, of in ((1, words, word), (2, pairs, pair)):
                n_train = np.bincount(of[train], minlength=len(keys))
                n_kept = np.bincount(of[kept], minlength=len(keys))
                cuts = _slots_of(keys, slots)
                filled = [(k, a, b) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]
                for at in range(0, len(filled), 64):
                    columns = zip(*[(kind, k, name, pack_sorted(keys[a:b]), pack(n_train[a:b]), pack(n_kept[a:b]))
                                    for k, a, b in filled[at : at + 64]])
                    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, kinds)],
                        names=["kind", "slot", "block", "keys", "train", "kept"])
            release()

    return task


def _answers(table: pa.Table) -> pa.Table:
    """Sums over all blocks for one range of keys, for each block in its own order.

    The totals of the range stand in the first row."""
    # One column at a time: a range's rows are large.
    ends = np.cumsum([len(x.as_buffer()) // 8 for x in table["keys"]])
    begins = np.concatenate([[0], ends[:-1]])
    _, same = np.unique(np.concatenate([unpack_sorted(x.as_buffer()) for x in table["keys"]]), return_inverse=True)
    sums = {}
    for name in ("train", "kept"):
        counts = np.concatenate([unpack(x.as_buffer()) for x in table[name]]).astype(np.float64)
        sums[name] = np.bincount(same, weights=counts).astype(np.uint64)
    n = table.num_rows
    first = lambda v: [int(v), *[0] * (n - 1)]
    each = {name: [pack(v[same[a:b]]) for a, b in zip(begins, ends)] for name, v in sums.items()}
    del same
    release()
    return pa.table({
        "kind": table["kind"], "slot": table["slot"], "block": table["block"],
        "train": pa.array(each["train"], pa.binary()), "kept": pa.array(each["kept"], pa.binary()),
        "n_distinct": pa.array(first((sums["train"] > 0).sum()), pa.int64()),
        "n_train": pa.array(first(sums["train"].sum()), pa.int64()),
        "n_kept": pa.array(first(sums["kept"].sum()), pa.int64()),
    })


def _answered(table: pa.Table, column: str, name: int, n_words: int, n_pairs: int) -> tuple[np.ndarray, np.ndarray]:
    """The counts of a block's words and pairs, in the order of its sorted keys; an error if some are missing."""
    rows = table.select(["kind", "slot", column]).to_pydict()
    out = []
    for kind in (1, 2):
        by_slot = {s: v for k, s, v in zip(rows["kind"], rows["slot"], rows[column]) if k == kind}
        out.append(np.concatenate([np.zeros(0, np.uint64), *[unpack(by_slot[s]) for s in sorted(by_slot)]]).astype(np.float64))
    if (len(out[0]), len(out[1])) != (n_words, n_pairs):
        raise RuntimeError(
            f"block {name} asked for {n_words} words and {n_pairs} pairs, got {len(out[0])} and {len(out[1])}")
    return tuple(out)


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the whole logarithm of its count."""
    return np.where(context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)


def _deleted_rows(deleted: int):
    """The deleted fold's tokens, each distinct pair once: where its counts stand in the block's answers."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, block in _stored_blocks(batches):
            words, word, keys, pair, context = block.keys()
            own = np.flatnonzero(np.repeat(block.folds, block.sizes) == deleted)
            if not len(own):
                continue
            pairs, first, n = np.unique(pair[own], return_index=True, return_counts=True)
            at = own[first]
            yield pa.RecordBatch.from_arrays([
                pa.array([name]), pa.array([len(words)]), pa.array([len(keys)]),
                pa.array([pack_sorted(pairs.astype(np.uint64))]),
                pa.array([pack(word[at])]), pa.array([pack(context[at] + 1)]), pa.array([pack(n)])],
                names=["block", "n_words", "n_pairs", "pairs", "words", "contexts", "n"])

    return task


def _grid(n_kept: int, starts: int):
    """Cells (bucket, pair estimate, word estimate) of the deleted pairs of a block; estimates as
    GRID * log2, 1 for zero."""

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        cells = []
        # Blocks without the deleted fold have answers only.
        if left.num_rows:
            for row in left.to_pylist():
                of_word, of_pair = _answered(right, "kept", row["block"], row["n_words"], row["n_pairs"])
                pair = of_pair[unpack_sorted(row["pairs"]).astype(np.int64)]
                word = of_word[unpack(row["words"]).astype(np.int64)]
                at = unpack(row["contexts"]).astype(np.int64)
                context = np.where(at > 0, of_word[at - 1], starts)
                n = unpack(row["n"]).astype(np.int64)
                with np.errstate(divide="ignore", invalid="ignore"):
                    fine = np.where(pair > 0, np.rint(GRID * np.log2(pair / context)), 1).astype(np.int64)
                    coarse = np.where(word > 0, np.rint(GRID * np.log2(word / max(n_kept, 1))), 1).astype(np.int64)
                cells.append(np.stack([_bucket(context), fine, coarse, n]))
        found = np.concatenate([np.zeros((4, 0), np.int64), *cells], axis=1)
        if found.shape[1]:
            key, same = np.unique(found[:3], axis=1, return_inverse=True)
            n = np.bincount(same.ravel(), weights=found[3]).astype(np.int64)
        else:
            key, n = found[:3], found[3]
        return pa.table({"bucket": key[0], "fine": key[1], "coarse": key[2], "n": n})

    return task


def learn_weights(cells: np.ndarray, uniform: float, rounds: int = 50, prior: float = 20.0) -> np.ndarray:
    """Weights (BUCKETS x 3) by expectation-maximisation from rows (bucket, fine, coarse, n).

    Buckets share a prior of ``prior`` events at the weights of all buckets together, so one with few
    deleted counts stays near them.
    """
    weights = np.full((BUCKETS, 3), 1 / 3)
    if not len(cells):
        return weights
    bucket, n = cells[:, 0], cells[:, 3].astype(np.float64)
    parts = np.stack([
        np.where(cells[:, 1] > 0, 0.0, np.exp2(cells[:, 1] / GRID)),
        np.where(cells[:, 2] > 0, 0.0, np.exp2(cells[:, 2] / GRID)), np.full(len(cells), uniform)], 1)
    whole = np.full(3, 1 / 3)
    for _ in range(rounds):
        share = parts * whole
        whole = (n[:, None] * share / share.sum(1, keepdims=True)).sum(0) / n.sum()
    for _ in range(rounds):
        share = parts * weights[bucket]
        share *= (n / share.sum(1))[:, None]
        sums = np.stack([np.bincount(bucket, share[:, k], BUCKETS) for k in range(3)], 1)
        # A context never seen has no pair estimate, whatever the others need.
        base = np.tile(whole, (BUCKETS, 1))
        base[0] = [0.0, whole[1] / (whole[1] + whole[2]), whole[2] / (whole[1] + whole[2])]
        sums += prior * base
        weights = sums / sums.sum(1, keepdims=True)
    return weights


SCORES = "doc_id long, fold int, n_tokens long, n_known long, base_score double, score double"


def _score(weights: np.ndarray, n_train: int, n_words: int, starts: int):
    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[] for _ in range(6)]
        if not left.num_rows:
            raise RuntimeError(f"answers for block {right['block'][0]}, which isn't stored")
        for row in left.to_pylist():
            block = _block(row)
            sizes = block.sizes
            words, word, pairs, pair, context = block.keys()
            of_word, of_pair = _answered(right, "train", row["block"], len(words), len(pairs))
            word_n = of_word[word]
            context_n = np.where(context >= 0, of_word[context], starts)
            w = weights[_bucket(context_n)]
            fine = of_pair[pair] / np.maximum(context_n, 1)
            p = w[:, 0] * fine + w[:, 1] * (word_n / max(n_train, 1)) + w[:, 2] / (n_words + 1)
            # A context without a count has no pair estimate: its weight goes to the others.
            p = np.where(context_n > 0, p, p / np.maximum(1 - w[:, 0], 1e-300))
            base = np.log10((word_n + 1) / (n_train + n_words + 1))
            first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            for column, value in zip(out, (
                block.ids, block.folds.astype(np.int32), sizes, np.add.reduceat((word_n > 0).astype(np.int64), first),
                np.add.reduceat(base, first), np.add.reduceat(np.log10(p), first),
            )):
                column.append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
        names = ["doc_id", "fold", "n_tokens", "n_known", "base_score", "score"]
        return pa.table({n: pa.array(np.concatenate(c) if c else [], k) for n, c, k in zip(names, out, kinds)})

    return task


def score_documents(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    held_out: int = 2,
    deleted: int = 3,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens: words with A-Z lower-cased, then one end.  A document's fold is crc32(id as text) mod 7, that of
    a NULL id is 0.  The model learns from all folds but ``held_out``; ``deleted`` is the fold that the
    weights are learned on.  ``base_score``: log10 probability under add-one counts of words;
    ``score``: log10 probability of the whole text under the model.  NULL and empty texts are one end
    token.  Repeated rows count and are scored each.  Without training documents all probabilities
    are those of the uniform distribution; no rows give an empty result.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(id).cast("string"), F.lit(""))
    fold = F.when(F.col(id).isNull(), 0).otherwise(F.crc32(key.cast("binary")) % 7).cast("long")
    rows = bounded_batches(docs).select(F.coalesce(F.col(id).cast("long"), F.lit(NONE)).alias("id"), fold.alias("fold"),
                       text_bytes(text).alias("text"))
    sizes = rows.agg(
        F.sum(F.octet_length("text")).alias("n"),
        F.count_if(F.col("fold") != held_out).alias("train"),
        F.count_if((F.col("fold") != held_out) & (F.col("fold") != deleted)).alias("kept")).first()
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(sizes["n"] or 0) // (6 * RANGE_KEYS)))

    blocks = store(rows.mapInArrow(_block_rows, BLOCKS), "blocks", options=BLOCK_OPTIONS)
    asked = blocks.mapInArrow(_requests(slots, held_out, deleted), REQUEST)
    answers = store(asked.groupBy("kind", "slot").applyInArrow(_answers, ANSWER), "answers")
    totals = answers.where("kind = 1").agg(F.sum("n_distinct"), F.sum("n_train"), F.sum("n_kept")).first()
    n_words, n_train, n_kept = (int(x or 0) for x in totals)

    pairs = blocks.mapInArrow(
        _deleted_rows(deleted),
        "block long, n_words long, n_pairs long, pairs binary, words binary, contexts binary, n binary")
    by_block = answers.select("block", "kind", "slot", "train", "kept")
    cells = (
        pairs.groupBy("block").cogroup(by_block.drop("train").groupBy("block"))
        .applyInArrow(_grid(n_kept, sizes["kept"]), "bucket long, fine long, coarse long, n long")
        .groupBy("bucket", "fine", "coarse").agg(F.sum("n").alias("n")).toArrow()
    )
    table = np.stack([c.to_numpy() for c in cells.columns], 1) if cells.num_rows else np.zeros((0, 4), np.int64)
    weights = learn_weights(table[np.lexsort(table.T)], 1 / (n_words + 1))
    if not n_train:
        weights[:] = [0, 0, 1]

    scored = blocks.groupBy("block").cogroup(by_block.drop("kept").groupBy("block")).applyInArrow(
        _score(weights, n_train, n_words, sizes["train"]), SCORES)
    return scored.select(
        F.nullif("doc_id", F.lit(NONE)).alias("doc_id"), (F.col("fold") == held_out).alias("held_out"), "n_tokens",
        "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score")
