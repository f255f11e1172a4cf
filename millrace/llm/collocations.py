"""Phrase collocations: contiguous phrases of 2 to 5 words, counted by direct-address tiling.

Words get ids in order of their frequency, by powers of two.  A pair of neighbouring ids is a cell of a square
table, which is cut into tiles of equal sides; a tile that holds many entries is counted by a dense
bincount over its addresses, all others as sorted coordinates.  Frequent pairs get ids by
frequency again, and a pair of pairs that begin at neighbouring words is a phrase of three: the same table of
ids counts phrases one word longer at each level.  A phrase can't be more frequent than its parts, so what
is rare at one level is a gap at the next, and nothing that matters is lost.

1.  Texts become stored blocks of bounded size: the distinct keys of a block, sorted, with their counts, and
    which key each place has (0: a gap).  A word's key is a 64-bit hash of it and its language.
2.  A block asks for the ids of its keys, a row for each slot that tiles (or ranges of hashes) are dealt to.
    A slot adds up its keys over all blocks and answers with the frequent ones.  A word or pair
    that a third of all places have is one entry in each block; the sides of a tile shrink as blocks
    become more, and slots grow with the entries, so the share of a task is bounded.
3.  Ids come from totals per (frequency class, slot), so no list of words or phrases is sent to every task.
4.  The answers meet the blocks again; the keys of the next level come out.

Phrases, their parts' counts and scores are joined level by level.  There are at most as many as words in the corpus
over the least count.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import (
    WordScan, bounded_batches, chunks, joined, mix, pack, pack_sorted, release, store, text_bytes, unpack, unpack_sorted,
    worker_cache,
)
from millrace.operators.ordering import running_sums

# What separates pieces of a text, and what separates words besides.
PIECE_ENDS, BLANKS = b".,;:!?\x0A\x0B\x0C\x0D", b"\x20\x09"
NO_LANGUAGE = "und"
PIECE_END = re.compile(rb"[.,;:!?\x0A-\x0D]")
#: Bytes of text in a block, and entries (keys of blocks) in a slot, about.
BLOCK_BYTES, SLOT_ENTRIES = 4 << 20, 1 << 20
#: Frequency classes (powers of two).
CLASSES = 48
#: A tile is counted densely if one in so many of its cells has an entry.
DENSE = 8


class PieceScan(WordScan):
    """Words between blanks and ends of pieces."""

    def __init__(self):
        super().__init__()
        self.ends = np.zeros(256, bool)
        self.ends[list(PIECE_ENDS)] = True
        self.separator = self.ends.copy()
        self.separator[list(BLANKS)] = True


STATE = ("block long, n_keys int, keys binary, counts binary, tokens binary, texts binary, "
         "langs array<string>, totals array<long>")


def _state(block: int, sequence: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, dict]:
    """Distinct keys and, for each place, which one it has; ``gap`` places have none.  Runs of gaps become one."""
    keys, first, of = np.unique(sequence[~gap], return_index=True, return_inverse=True)
    tokens = np.zeros(len(sequence), np.uint64)
    tokens[~gap] = of + 1
    again = np.zeros(len(tokens), bool)
    again[1:] = (tokens[1:] == 0) & (tokens[:-1] == 0)
    row = {"block": block, "n_keys": len(keys), "keys": pack_sorted(keys),
           "counts": pack(np.bincount(of, minlength=len(keys)), 4), "tokens": pack(tokens[~again], 4)}
    return first, row


def _rows(rows: list[dict]) -> pa.RecordBatch:
    binary = {name: pa.array([r.get(name) for r in rows], pa.binary()) for name in ("keys", "counts", "tokens", "texts")}
    return pa.RecordBatch.from_pydict({
        "block": pa.array([r["block"] for r in rows], pa.int64()), "n_keys": pa.array([r["n_keys"] for r in rows], pa.int32()),
        **binary, "langs": pa.array([r.get("langs") for r in rows], pa.list_(pa.string())),
        "totals": pa.array([r.get("totals") for r in rows], pa.list_(pa.int64()))})


def _pieces(langs: list[str], texts: list[bytes], most: int = 1 << 20) -> tuple[list[str], list[bytes]]:
    """Long texts in parts of about ``most`` bytes, cut behind ends of pieces, where no phrase passes."""
    names, parts = [], []
    for lang, text in zip(langs, texts):
        start = 0
        while len(text) - start > most:
            end = PIECE_END.search(text, start + most)
            if end is None:
                break
            names.append(lang)
            parts.append(text[start : end.end()])
            start = end.end()
        names.append(lang)
        parts.append(text[start:] if start else text)
    return names, parts


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of words, with the words' texts (behind the place of their language) in order of the keys, and
    words per language."""
    scan = worker_cache("piece scan", PieceScan)
    number = TaskContext.get().partitionId() << 32

    def flush(langs: dict[str, int], parts: list) -> pa.RecordBatch:
        nonlocal number
        texts = [p[0] for p in parts]
        raw = b"\n".join([*texts, b""])
        shift = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        sequence, gap, lang = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3))
        start, end = (np.concatenate([p[k] + at for p, at in zip(parts, shift)]) for k in (4, 5))
        first, row = _state(number, sequence, gap)
        number += 1
        words = np.flatnonzero(~gap)[first]
        row |= {"texts": b"\n".join(
                    b"%d\t%b" % (k, raw[x:y]) for k, x, y in zip(lang[words].tolist(), start[words].tolist(), end[words].tolist())),
                "langs": list(langs), "totals": np.bincount(lang[~gap], minlength=len(langs)).tolist()}
        return _rows([row])

    langs: dict[str, int] = {}
    parts, held = [], 0
    for batch in batches:
        names, texts = _pieces(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        done = 0
        for part in chunks(texts):
            here = names[done : done + len(part)]
            done += len(part)
            whole, begins = joined(part)
            whole = whole.lower()
            raw = np.frombuffer(whole, np.uint8)
            starts, ends = scan.words(raw)
            words = np.diff(np.searchsorted(starts, begins))
            salt = np.array([_language(x) for x in here], np.uint64)
            key = mix(scan.hashes(raw, starts, ends) ^ np.repeat(salt, words))
            # A gap before every word that doesn't follow another in its piece: texts are joined by line feeds.
            upto = np.concatenate([[0], np.cumsum(scan.ends[raw])])
            fresh = np.ones(len(starts), bool)
            fresh[1:] = upto[starts[1:]] > upto[ends[:-1]]
            place = np.arange(len(starts)) + np.cumsum(fresh)
            n = len(starts) + int(fresh.sum())
            gap = np.ones(n, bool)
            gap[place] = False
            values = np.repeat([langs.setdefault(x, len(langs)) for x in here], words)
            spread = []
            for column in (key, values, starts, ends):
                out = np.zeros(n, column.dtype)
                out[place] = column
                spread.append(out)
            parts.append((whole, spread[0], gap, *spread[1:]))
            held += len(whole)
            if held >= BLOCK_BYTES:
                yield flush(langs, parts)
                langs, parts, held = {}, [], 0
                release()
    if parts:
        yield flush(langs, parts)
    release()


def _language(name: str) -> int:
    """64 bits for a language."""
    raw = name.encode() or b"\0"
    scan = worker_cache("piece scan", PieceScan)
    return int(scan.hashes(np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(raw)]))[0])


def _slot_of(keys: np.ndarray, slots: int, side: int | None) -> np.ndarray:
    """Words: by the upper bits of the hash.  Pairs: by their tile of 2**side ids."""
    if side is not None:
        keys = mix(_tile_of(keys, side))
    return ((keys >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)


def _tile_of(keys: np.ndarray, side: int) -> np.ndarray:
    s, low = np.uint64(side), np.uint64(0xFFFFFFFF)
    return (keys >> np.uint64(32) >> s << np.uint64(32)) | ((keys & low) >> s)


def _asking(slots: int, side: int | None):
    """A row for each block and slot: the keys and counts that go there."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw, numbers in zip(*[batch.column(c) for c in ("block", "keys", "counts")]):
                keys, counts = unpack_sorted(raw.as_py()), unpack(numbers.as_py(), 4)
                slot = _slot_of(keys, slots, side)
                order = np.argsort(slot, kind="stable")
                cuts = np.searchsorted(slot[order], np.arange(slots + 1))
                full = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_pydict({
                    "slot": pa.array(full, pa.int32()), "block": pa.array([block.as_py()] * len(full), pa.int64()),
                    "keys": pa.array([pack_sorted(keys[order[cuts[k] : cuts[k + 1]]]) for k in full], pa.binary()),
                    "counts": pa.array([pack(counts[order[cuts[k] : cuts[k + 1]]], 4) for k in full], pa.binary())})

    return task


ANSWERS = "kind int, slot int, block long, at binary, place binary, owned binary, keys binary, totals binary, classes array<long>"


def tile_totals(keys: np.ndarray, counts: np.ndarray, side: int | None, dense: int = DENSE) -> np.ndarray:
    """For each entry (key, count): the sum of the counts of its key.

    Tiles with many entries for their cells by direct address, the others as sorted coordinates.
    """
    totals = np.zeros(len(keys), np.int64)
    rest = np.arange(len(keys))
    if side is not None and len(keys):
        cells = 1 << 2 * side
        tiles, of, entries = np.unique(_tile_of(keys, side), return_inverse=True, return_counts=True)
        order = np.argsort(of, kind="stable")
        cuts = np.concatenate([[0], np.cumsum(entries)])
        mask = np.uint64((1 << side) - 1)
        address = ((keys >> np.uint64(32) & mask) << np.uint64(side) | keys & mask).astype(np.int64)
        full = entries * dense >= cells
        for k in np.flatnonzero(full):
            here = order[cuts[k] : cuts[k + 1]]
            table = np.bincount(address[here], weights=counts[here], minlength=cells)
            totals[here] = table[address[here]].astype(np.int64)
        rest = np.flatnonzero(~full[of])
    if len(rest):
        _, same = np.unique(keys[rest], return_inverse=True)
        totals[rest] = np.bincount(same, weights=counts[rest]).astype(np.int64)[same]
    return totals


def _answering(least: int, side: int | None):
    """For one slot: its frequent keys (kind 0: in order of class, then key), and for each block which of the keys
    it asked for are frequent and their places among those (kind 1)."""

    def task(table: pa.Table) -> pa.Table:
        keys = [unpack_sorted(x.as_buffer()) for x in table["keys"]]
        ends = np.cumsum([len(k) for k in keys])
        begins = np.concatenate([[0], ends[:-1]])
        keys = np.concatenate(keys)
        counts = np.concatenate([unpack(x.as_buffer(), 4) for x in table["counts"]]).astype(np.float64)
        totals = tile_totals(keys, counts, side)
        del counts
        kept = np.flatnonzero(totals >= least)
        found, first, same = np.unique(keys[kept], return_index=True, return_inverse=True)
        sums = totals[kept][first]
        kind = np.minimum(np.log2(np.maximum(sums, 1)).astype(np.int64), CLASSES - 1)
        order = np.lexsort((found, -kind))
        place = np.empty(len(found), np.int64)
        place[order] = np.arange(len(found))
        owner = np.zeros(len(kept), bool)
        owner[first] = True
        slot = table["slot"][0].as_py()
        out = []
        if len(found):
            classes = np.bincount(kind, minlength=CLASSES)
            out.append({"kind": 0, "slot": slot, "keys": found[order].tobytes(), "totals": pack(sums[order]), "classes": classes.tolist()})
        cuts = np.searchsorted(kept, np.concatenate([begins, ends[-1:]]))
        blocks = table["block"].to_pylist()
        for k, block in enumerate(blocks):
            a, b = cuts[k], cuts[k + 1]
            if a < b:
                out.append({"kind": 1, "slot": slot, "block": block, "at": pack(kept[a:b] - begins[k], 4),
                            "place": pack(place[same[a:b]], 4), "owned": owner[a:b].tobytes()})
        kinds = {"kind": pa.int32(), "slot": pa.int32(), "block": pa.int64(), "at": pa.binary(), "place": pa.binary(),
                 "owned": pa.binary(), "keys": pa.binary(), "totals": pa.binary(), "classes": pa.list_(pa.int64())}
        result = pa.table({name: pa.array([r.get(name) for r in out], t) for name, t in kinds.items()})
        del keys, totals, kept, same
        release()
        return result

    return task


def _ids(place: np.ndarray, classes: list[int], bases: list[int]) -> np.ndarray:
    """Places in a slot's list of frequent keys as ids in the whole: more frequent classes first."""
    sizes = np.array(classes[::-1])
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    kind = np.searchsorted(np.cumsum(sizes), place, "right")
    return np.array(bases[::-1])[kind] + place - begin[kind]


def _with_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            ids = [pack(_ids(unpack(p, 4).astype(np.int64), c, b), 4) for p, c, b in zip(
                part["place"].to_pylist(), part["classes"].to_pylist(), part["bases"].to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [part["block"], part["slot"], part["at"], pa.array(ids, pa.binary()), part["owned"]],
                names=["block", "slot", "at", "ids", "owned"])


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each frequent key: id, key and its two halves, count."""
    for batch in batches:
        for row in batch.to_pylist():
            keys, total = np.frombuffer(row["keys"], np.uint64), unpack(row["totals"]).astype(np.int64)
            ids = _ids(np.arange(len(keys)), row["classes"], row["bases"])
            for at in range(0, len(keys), 1 << 16):
                s = slice(at, at + (1 << 16))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[s].astype(np.int64)), pa.array((keys[s] >> np.uint64(32)).astype(np.int64)),
                     pa.array((keys[s] & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(total[s])],
                    names=["id", "left", "right", "f"])


def _next_level(slots: int, side: int | None):
    """A block with its answers: the keys of neighbouring pairs of frequent ids."""

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([_rows([])])
        keys, tokens = unpack_sorted(left["keys"][0].as_py()), unpack(left["tokens"][0].as_py(), 4).astype(np.int64)
        slot = _slot_of(keys, slots, side)
        order = np.argsort(slot, kind="stable")
        cuts = np.searchsorted(slot[order], np.arange(slots + 1))
        ids = np.full(len(keys) + 1, -1, np.int64)  # in front: a gap
        for k, at, found in zip(right["slot"].to_pylist(), right["at"].to_pylist(), right["ids"].to_pylist()):
            ids[order[cuts[k] + unpack(at, 4).astype(np.int64)] + 1] = unpack(found, 4).astype(np.int64)
        place = ids[tokens]
        both = (place[:-1] >= 0) & (place[1:] >= 0)
        sequence = (np.maximum(place[:-1], 0).astype(np.uint64) << np.uint64(32)) | np.maximum(place[1:], 0).astype(np.uint64)
        rows = []
        if both.any():
            rows.append(_state(left["block"][0].as_py(), sequence, ~both)[1])
        del keys, tokens, place, sequence
        release()
        return pa.Table.from_batches([_rows(rows)])

    return task


def _owned_words(slots: int):
    """The texts and languages of the words that a block answers for."""

    def task(left: pa.Table, right: pa.Table) -> pa.Table:
        found, names, langs = [], [], []
        if left.num_rows and right.num_rows:
            keys, texts = unpack_sorted(left["keys"][0].as_py()), left["texts"][0].as_py().split(b"\n")
            known = left["langs"][0].as_py()
            cuts = np.searchsorted(_slot_of(keys, slots, None), np.arange(slots + 1))
            for k, at, ids, owned in zip(*[right[c].to_pylist() for c in ("slot", "at", "ids", "owned")]):
                mine = np.frombuffer(owned, bool)
                found += unpack(ids, 4)[mine].tolist()
                for x in (cuts[k] + unpack(at, 4).astype(np.int64)[mine]).tolist():
                    lang, _, word = texts[x].partition(b"\t")
                    names.append(word)
                    langs.append(known[int(lang)])
        return pa.table({"id": pa.array(found, pa.int64()), "lang": pa.array(langs, pa.string()), "raw": pa.array(names, pa.binary())})

    return task


def _level(state: DataFrame, least: int, words: bool) -> tuple[DataFrame, DataFrame, int, int | None] | None:
    """Frequent keys of a level and the answers to its blocks; None if there are no keys."""
    spark = state.sparkSession
    sizes = state.agg(F.sum(F.col("n_keys").cast("long")), F.count(F.lit(1))).first()
    if not sizes[0]:
        return None
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slots = max(-(-sizes[0] // SLOT_ENTRIES), min(tasks, -(-sizes[0] // (1 << 14))))
    # A cell has an entry per block at most: the side of a tile follows from the number of blocks.
    side = None if words else max(0, min(10, (max(1, SLOT_ENTRIES // (2 * sizes[1])).bit_length() - 1) // 2))
    asked = state.select("block", "keys", "counts").mapInArrow(
        _asking(slots, side), "slot int, block long, keys binary, counts binary").repartition(slots, "slot")
    answers = store(asked.groupBy("slot").applyInArrow(_answering(least, side), ANSWERS), "answers")
    heads = answers.where("kind = 0")
    if not heads.take(1):
        return None
    # Where each class of each slot begins among all ids: higher classes first, then by slot.
    per_class = heads.select("slot", F.posexplode("classes").alias("class", "n")).where("n > 0")
    placed = running_sums(per_class, [F.col("class").desc(), F.col("slot").asc()], ["n"])
    if placed.agg(F.max("n_total")).first()[0] > 1 << 32:
        raise RuntimeError("more than 2**32 frequent phrases of one length: raise the least count")
    bases = placed.groupBy("slot").agg(F.map_from_entries(F.collect_list(F.struct("class", "n_before"))).alias("m"))
    bases = bases.join(heads.select("slot", "classes"), "slot").select("slot", "classes", F.transform(
        F.sequence(F.lit(0), F.lit(CLASSES - 1)), lambda c: F.coalesce(F.try_element_at("m", c), F.lit(0)).cast("long")).alias("bases"))
    bases = store(bases, "bases")
    frequent = heads.select("slot", "keys", "totals").join(bases, "slot").mapInArrow(_frequent, "id long, left long, right long, f long")
    told = answers.where("kind = 1").select("slot", "block", "at", "place", "owned").join(bases, "slot").mapInArrow(
        _with_ids, "block long, slot int, at binary, ids binary, owned binary")
    return store(frequent, "frequent"), told, slots, side


def _grow(frequent: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases one word longer, from those that are their first and their last words."""
    head = shorter.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("head"), "heads")
    tail = shorter.select(F.col("id").alias("right"), F.col("phrase").alias("tail"), "tails")
    last = F.substring_index("tail", " ", -1)
    return frequent.join(head, "left").join(tail, "right").select(
        "id", "lang", F.concat_ws(" ", "head", last).alias("phrase"), "f",
        F.array_append("heads", F.col("f")).alias("heads"), F.array_append("tails", F.col("f")).alias("tails"), "left", "right")


def count_phrases(docs: DataFrame, least: int, longest: int, lang: str, text: str) -> tuple[DataFrame, list[DataFrame]]:
    """Words per language (lang, n), and for each length from 1 the phrases found ``least`` times or more: id, lang,
    phrase, f, heads and tails (counts of the first and of the last 1, 2, ... words)."""
    language = F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANGUAGE)).alias("lang")
    rows = bounded_batches(docs).select(language, text_bytes(text).alias("text"))
    state = store(rows.mapInArrow(_cut, STATE), "blocks", options={"parquet.block.size": str(BLOCK_BYTES)})
    totals = state.select(F.explode(F.arrays_zip("langs", "totals")).alias("t")).groupBy(F.col("t.langs").alias("lang")).agg(
        F.sum("t.totals").alias("n"))
    levels: list[DataFrame] = []
    for length in range(1, longest + 1):
        found = _level(state, least, length == 1)
        if found is None:
            break
        frequent, told, slots, side = found
        told = store(told, "told") if length == 1 else told
        if length == 1:
            texts = state.select("block", "keys", "texts", "langs").groupBy("block").cogroup(
                told.where(F.locate("\x01", F.col("owned").cast("string")) > 0).groupBy("block")
            ).applyInArrow(_owned_words(slots), "id long, lang string, raw binary")
            count = F.array("f")
            phrases = frequent.join(texts, "id").select(
                "id", "lang", F.col("raw").cast("string").alias("phrase"), "f", count.alias("heads"), count.alias("tails"))
            levels.append(store(phrases, "phrases"))
        else:
            levels.append(store(_grow(frequent, levels[-1]), "phrases"))
        if length < longest:
            state = store(state.select("block", "keys", "tokens").groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
                _next_level(slots, side), STATE), "blocks", options={"parquet.block.size": str(BLOCK_BYTES)})
    return totals, levels


def _score(a: Column, n: Column, l: Column, r: Column) -> Column:
    """floor(1000 * a * n / (l * r)), exactly: integers of up to 38 digits."""
    wide = lambda c: c.cast("decimal(38,0)")
    above = (wide(a) * wide(n) * F.lit(1000).cast("decimal(4,0)")).cast("decimal(38,0)")
    below = (wide(l) * wide(r)).cast("decimal(38,0)")
    return F.call_function("div", above, below)


def collocations(
    docs: DataFrame,
    least: int = 100,
    longest: int = 5,
    top: int = 2000,
    share: int = 100,
    lang: str = "lang",
    text: str = "text",
) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts (A-Z lower-cased) are cut into pieces at . , ; : ! ? and line ends (0A-0D), pieces into words at spaces and
    tabs.  A phrase is 2 to ``longest`` words that follow each other in a piece ``least`` times or more (``a``, overlaps
    included).  Of its cuts into two parts found l and r times the one with the lowest score
    floor(1000 a n / (l r)) counts, n being all words of the language, ties to the shorter first part.
    A phrase is dropped if a longer one that holds it occurs in at least ``share`` percent of its places.  Ranks go by
    score, a (both downwards) and phrase.

    NULL texts count as empty, a NULL language is ``und``.  Rows count as often as they are there.  No rows, or no phrase
    frequent enough, give an empty result.  Only ``lang`` and ``text`` are read.  Words are told apart by 64-bit hashes of
    word and language.  Texts of any length are read whole, in parts cut between pieces.  Runs
    several jobs; what lies between them is in the shared work folder.
    """
    totals, levels = count_phrases(docs, least, longest, lang, text)
    shape = "lang string, rank int, phrase string, a long, l long, r long, n long, score long"
    if len(levels) < 2:
        return docs.sparkSession.createDataFrame([], shape)
    kept = []
    for length, level in enumerate(levels[1:], 2):
        found = level.withColumn("length", F.lit(length))
        if length < len(levels):
            longer = levels[length]
            parents = longer.select(F.explode(F.array("left", "right")).alias("id"), F.col("f").alias("around"))
            parents = parents.groupBy("id").agg(F.max("around").alias("around"))
            found = found.join(parents, "id", "left").where(
                F.coalesce(100 * F.col("around") < share * F.col("f"), F.lit(True)))
        kept.append(found.select("lang", "phrase", "f", "heads", "tails", "length"))
    every = kept[0]
    for more in kept[1:]:
        every = every.unionByName(more)
    cuts = F.transform(F.sequence(F.lit(1), F.col("length") - 1), lambda k: F.struct(
        _score(F.col("f"), F.col("n"), F.get("heads", k - 1), F.get("tails", F.col("length") - k - 1)).alias("score"),
        k.alias("k"), F.get("heads", k - 1).alias("l"), F.get("tails", F.col("length") - k - 1).alias("r")))
    scored = every.join(totals, "lang").select("lang", "phrase", F.col("f").alias("a"), "n", F.array_min(cuts).alias("cut"))
    scored = scored.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
