"""Token ids in ORC: run-length encoded stripes, row indexes and Bloom filters on document ids.

Rows are range-partitioned and sorted by document id, so that file, stripe and row-group
statistics are disjoint id ranges: readers take stripes in parallel and skip those whose
range or Bloom filter rules an id out.  Beside the ids every row stores its part and the number
of ids before it in that part; with the totals of the parts (one row per file) that gives every
document's place in the whole stream without sorting or scanning documents again.

The tokenizer works word by word: it lower-cases, and its pattern never matches across the white
space that it drops, so the ids of a text are those of its words in order.  Each distinct word is
encoded once by the library, not at every occurrence.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from millrace.llm.common import WordScan, bounded_batches, chunks, joined, shape, text_bytes, worker_cache

# How byte-level BPE writes bytes as characters. Printable bytes stand for themselves,
# the others for the characters from 256 on.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
BYTE_CHARS = {b: chr(b) for b in PRINTABLE} | {
    b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(PRINTABLE))
}
# Letters whose lower case and normal form are one letter of the same block.
PLAIN = {chr(c) for c in [*range(65, 91), *range(97, 123), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]}




def gather(bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the items of the given rows one after another, and where each row ends in them."""
    starts, lengths = bounds[rows], bounds[rows + 1] - bounds[rows]
    ends = np.concatenate([[0], np.cumsum(lengths)])
    return np.arange(ends[-1]) + np.repeat(starts - ends[:-1], lengths), ends


class WordIds:
    """Ids of texts by a tokenizer file, put together from the ids of their words.

    A mark behind a plain Latin letter is a word of its own, as it is for the pattern.  Words of
    plain letters, lower-cased and written as byte characters, go straight to the file's BPE
    model; all others take the whole tokenizer.  ``most`` words are remembered; then those met
    only once are dropped.  Texts that might hold a special token's string are encoded whole.
    """

    def __init__(self, path: str, most: int = 600_000):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.tokenize = self.full.model.tokenize
        self.most, self.scan = most, WordScan()
        self.gone = dict.fromkeys(map(ord, PLAIN))
        self.table = str.maketrans({c: "".join(BYTE_CHARS[b] for b in c.encode()) for c in PLAIN})
        letters = [*range(65, 91), *range(97, 123)]
        self.letter, self.tail, self.mark = (np.zeros(256, bool) for _ in range(3))
        self.letter[letters], self.mark[[ord(c) for c in ".,;:!?"]] = True, True
        self.tail[[c for c in range(0x80, 0xC0) if c not in (0x97, 0xB7)]] = True
        self._keep([], np.empty(0, np.uint16), np.zeros(1, np.int64))

    def _keep(self, words: list[bytes], ids: np.ndarray, bounds: np.ndarray) -> None:
        self.known = dict(zip(words, range(len(words))))
        self.ids, self.bounds, self.met = ids, bounds, np.zeros(len(words), np.int32)

    def _forget(self) -> None:
        words, again = list(self.known), np.flatnonzero(self.met > 1)
        if len(again) > self.most // 2:
            again = again[:0]
        source, bounds = gather(self.bounds, again)
        self._keep([words[k] for k in again], self.ids[source], bounds)

    def _ids(self, raw: bytes) -> list[int]:
        if raw.isalpha():
            return [t.id for t in self.tokenize(raw.decode())]
        word = raw.decode("utf-8", "replace")
        if word.translate(self.gone):
            return self.full.encode(word, add_special_tokens=False).ids
        return [t.id for t in self.tokenize(word.lower().translate(self.table))]

    def _rows(self, words: list[bytes]) -> np.ndarray:
        """The row of each distinct word; new ones are encoded."""
        if len(self.known) + len(words) > self.most:
            self._forget()
        known, ids = self.known, []
        rows = np.empty(len(words), np.int64)
        for k, word in enumerate(words):
            row = known.get(word)
            if row is None:
                row = known[word] = len(known)
                ids.append(self._ids(word))
            rows[k] = row
        if ids:
            ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) + self.bounds[-1]
            self.bounds = np.concatenate([self.bounds, ends])
            self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(ids), np.uint16)])
            self.met = np.concatenate([self.met, np.zeros(len(ids), np.int32)])
        self.met[rows] += 1
        return rows

    def _run(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        whole, begins = joined(texts)
        whole = whole.lower()
        raw = np.frombuffer(whole, np.uint8)
        starts, ends = self.scan.words(raw)
        # A last mark is cut off if a plain letter stands before it.
        last = raw[ends - 1]
        before = raw[np.maximum(ends - 2, 0)]
        two = self.tail[before] & (raw[np.maximum(ends - 3, 0)] == 0xC3) & (ends - starts > 2)
        cut = self.mark[last] & (ends - starts > 1) & (self.letter[before] | two)
        pieces = 1 + cut
        at = np.cumsum(pieces)
        a, b = np.empty(at[-1] if len(at) else 0, np.int64), np.empty(at[-1] if len(at) else 0, np.int64)
        a[at - pieces], b[at - pieces] = starts, ends - cut
        a[at[cut] - 1], b[at[cut] - 1] = ends[cut] - 1, ends[cut]
        _, first, place = np.unique(self.scan.hashes(raw, a, b), return_index=True, return_inverse=True)
        rows = self._rows([whole[i:j] for i, j in zip(a[first].tolist(), b[first].tolist())])
        source, total = gather(self.bounds, rows[place])
        per_text = total[np.searchsorted(a, begins)]
        ids = np.insert(self.ids[source].astype(np.int32), per_text[1:], end_id)
        return ids, per_text + np.arange(len(per_text))

    def encode(self, texts: list[bytes], end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, each text followed by ``end_id``; and where each text begins and ends."""
        odd = [k for k, t in enumerate(texts) if b"<|" in t]
        if odd:
            plain = [b"" if b"<|" in t else t for t in texts]
            ids, ends = self.encode(plain, end_id)
            parts = np.split(ids, ends[1:-1])
            for k in odd:
                own = self.full.encode(texts[k].decode("utf-8", "replace"), add_special_tokens=False).ids
                parts[k] = np.array([*own, end_id], np.int32)
            return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])
        found, ends = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
        for run in chunks(texts):
            ids, stops = self._run(run, end_id)
            found.append(ids)
            ends.append(stops[1:] + ends[-1][-1])
        return np.concatenate(found), np.concatenate(ends)


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer_file: str,
    end_id: int = 1,
    id: str = "doc_id",
    text: str = "text",
    row_index_stride: int = 1_000,
    stripe_bytes: int = 16 << 20,
) -> None:
    """Encode every whole text, append ``end_id`` and write the ids in ascending id order.

    NULL and empty texts have just the end id.  NULL document ids come first, rows that share
    an id stay together in the order of their texts.  No rows give an empty table.  A row has
    its whole text, so none is split; texts travel through one range shuffle.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = worker_cache(f"word ids {tokenizer_file}", lambda: WordIds(tokenizer_file))
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                ids, ends = words.encode(rows.column(1).to_pylist(), end_id)
                n = np.diff(ends)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(before + ends[:-1]),
                     pa.array(n.astype(np.int32)),
                     pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                    names=["doc_id", "part", "before", "n_tokens", "ids"])
                before += int(ends[-1])

    rows = bounded_batches(docs).select(F.col(id).cast("long").alias("doc_id"), text_bytes(text).alias("text"))
    placed = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    encoded = placed.mapInArrow(task, "doc_id long, part int, before long, n_tokens int, ids array<int>")
    (encoded.write.mode("overwrite").option("compression", "snappy")
     .option("orc.create.index", "true").option("orc.row.index.stride", str(row_index_stride))
     .option("orc.stripe.size", str(stripe_bytes))
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", "0.01")
     .orc(folder))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """The stored rows; filters on ``doc_id`` reach the stripes' statistics and Bloom filters.

    Columns: doc_id, part, before (ids before it in its part), n_tokens, ids.
    """
    schema = "doc_id long, part int, before long, n_tokens int, ids array<int>"
    return spark.read.schema(schema).orc(folder)


def with_starts(tokens: DataFrame) -> DataFrame:
    """``start``: the number of ids in all documents before each.

    Only the totals of the parts, one row per file, are summed in order.
    """
    totals = tokens.groupBy("part").agg(F.sum(F.col("n_tokens").cast("long")).alias("n"))
    earlier = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    shift = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    return tokens.join(shift, "part").withColumn("start", F.col("shift") + F.col("before")).drop("shift")


def checksums(tokens: DataFrame, column: str = "ids") -> DataFrame:
    """``ids_crc32``: unsigned CRC-32 of each row's ids as little-endian unsigned 32-bit integers."""
    kept = [f for f in tokens.schema.fields if f.name != column]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            lists = batch.column(0)
            flat, ends = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
            sums = np.array([zlib.crc32(flat[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(sums)], names=[*(f.name for f in kept), "ids_crc32"])

    out = shape({f.name: f.dataType for f in kept} | {"ids_crc32": "long"})
    return tokens.select(column, *[f.name for f in kept]).mapInArrow(task, out)
