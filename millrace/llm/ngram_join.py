"""N-gram Jaccard join: candidates share prefix tokens under several global orders of the tokens.

A document's set holds its distinct word shingles, as 64-bit hashes.  If two sets have
100 * |A and B| >= percent * |A or B|, then under any one order of all tokens the first
n - ceil(percent * n / 100) + 1 tokens of both share one.  Candidates must pass that test under
several orders at once before they are verified:

1. rare tokens first (by the number of sets that hold a token, then by hash),
2. by the magnitude of that number, then by another hash,
3. tokens of a single set first, then by a third hash.

In each order tokens of a single set come first, take up their share of a prefix and match
nobody, so only tokens of two or more sets are kept from the first shuffle on; what two sets
have in common lies among those, so the same lists serve to verify pairs exactly.

1.  Texts become packed blocks of sorted hashes, a row for each block and range of hashes.
    Equal sets collapse at once: a set goes by a hash of all its tokens and its size.
2.  One shuffle by range of hashes counts the sets of each token.  A frequent token is one
    entry in each block; ranges, not tokens, are dealt out.
3.  Lists of shared tokens come together per set, each token with three marks: which prefixes it is in.  Sets
    without a shared token in their prefix drop out.
4.  In every group of sets that share a prefix token, one member, the one with the fewest tokens of
    its own, is paired with the others: pairs grow with the postings, not with the square of a
    group.  Verified links make components.
5.  Where a token still joins different components, and one of its sets has few enough tokens of its own for
    any partner, its sets are laid in blocks of bounded size.  Pairs of blocks that share such a
    token are compared inside a task on prefixes alone, in tiles of bounded sides.  Only tiles with a pair
    that passes all orders fetch whole lists and are verified.  No pairs are written out; this finds every
    link that the first round left, and needs no cap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import (
    WORD, WordScan, bounded_batches, chunks, joined, mix, pack, release, store, text_bytes, unpack, windows,
)
from millrace.llm.components import components
from millrace.operators.ordering import running_sums

#: Bytes of text per block, and hashes per range, about.
BLOCK_BYTES = 4 << 20
RANGE_TOKENS = 2 << 20
#: Bytes of a token inside its range of hashes, and among all ranges.  Ranges don't grow with the corpus, so
#: neither does the chance that two different tokens of a pair of documents look alike.
NARROW, WIDE = 5, 6
#: Prefix tokens and sets in a block of the last step, at most (a larger set is a block of its own).
BLOCK_TOKENS, BLOCK_SETS = 1 << 20, 4096
#: Tokens and sets on a side of a tile.
TILE_TOKENS, TILE_SETS = 1 << 20, 1024


def prefix_length(n, percent: int):
    """Tokens of a set of n in which it must share one with any partner."""
    return n - (n * percent + 99) // 100 + 1


class Shingles:
    """The distinct shingles of many texts at a time."""

    def __init__(self, width: int):
        self.width, self.scan = width, WordScan()

    def run(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All sets one after another, each sorted, and where each begins."""
        whole, begins = joined(texts)
        raw = np.frombuffer(whole.lower(), np.uint8)
        starts, ends = self.scan.words(raw)
        at = np.searchsorted(starts, begins)
        hashes = self.scan.hashes(raw, starts, ends)
        words = np.diff(at)
        owner = np.repeat(np.arange(len(texts)), words)
        runs = windows(hashes, self.width)
        inside = owner[: len(runs)] == owner[self.width - 1 :] if len(runs) else np.zeros(0, bool)
        token, of = runs[inside], owner[: len(runs)][inside]
        short = np.flatnonzero((words > 0) & (words < self.width))
        if len(short):  # the whole sequence as one, apart from those of other lengths
            own = [windows(hashes[at[k] : at[k + 1]], int(words[k]))[0] for k in short]
            own = mix(np.array(own, np.uint64) + words[short].astype(np.uint64))
            token, of = np.concatenate([token, own]), np.concatenate([of, short])
        order = np.lexsort((token, of))
        token, of = token[order], of[order]
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (of[1:] != of[:-1])
        token, of = token[fresh], of[fresh]
        return token, np.searchsorted(of, np.arange(len(texts) + 1))


def set_ids(tokens: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A signed 64-bit hash of each set; 0 for the empty one."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens * np.uint64(0xD1342543DE82EF95)))])
    sizes = np.diff(begins).astype(np.uint64)
    found = mix((sums[begins[1:]] - sums[begins[:-1]]) + sizes * np.uint64(0x2545F4914F6CDD1D))
    return np.where(sizes == 0, np.uint64(0), found).view(np.int64)


ROWS = ("kind int, slot int, doc_ids array<long>, texts array<long>, sets array<long>, sizes array<int>, "
        "runs binary, tokens binary")


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(parts) if parts else [], kind))


def _blocks(docs: DataFrame, id: str, text: str, width: int, slots: int) -> DataFrame:
    """Kind 0: the block's sets with their sizes and, behind those, where each set's documents begin in doc_ids
    and texts (a hash of the text).  Kind 1, a row per block and range of hashes (slot): the block's sets,
    how many tokens each has there, and the tokens in order of the sets."""

    def flush(ids: list, texts: list, sets: list, tokens: list, begins: list) -> Iterator[pa.RecordBatch]:
        ids, texts, sets = np.concatenate(ids), np.concatenate(texts), np.concatenate(sets)
        sizes = np.concatenate([np.diff(b) for b in begins]).astype(np.int32)
        token = np.concatenate(tokens)
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), sizes)
        alone, first, members = np.unique(sets, return_index=True, return_counts=True)
        together = np.argsort(sets, kind="stable")
        where = np.concatenate([[0], np.cumsum(members)]).astype(np.int32)
        chosen = np.zeros(len(sets), bool)
        chosen[first] = True  # equal sets of a block: tokens once
        kept = chosen[owner]
        token, owner = token[kept], owner[kept]
        # The range of a hash: its upper bits times the number of ranges.
        slot = ((token >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int32)
        order = np.lexsort((owner, slot))
        token, owner, slot = token[order], owner[order], slot[order]
        cuts = np.searchsorted(slot, np.arange(slots + 1))
        none = np.zeros(0, np.int64)
        kinds, slot_of, doc_ids, text_of, set_of = [0], [int(sets[0] % slots)], [ids[together]], [texts[together]], [alone]
        size_of, runs, packed = [np.concatenate([sizes[first], where])], [b""], [b""]
        for k in range(slots):
            a, b = cuts[k], cuts[k + 1]
            if a == b:
                continue
            here, run = np.unique(owner[a:b], return_counts=True)
            kinds.append(1)
            slot_of.append(k)
            doc_ids.append(none)
            text_of.append(none)
            set_of.append(sets[here])
            size_of.append(sizes[here])
            runs.append(pack(run, 4))
            packed.append(pack(token[a:b], NARROW))
        for at in range(0, len(kinds), 64):
            s = slice(at, at + 64)
            yield pa.RecordBatch.from_arrays([
                pa.array(kinds[s], pa.int32()), pa.array(slot_of[s], pa.int32()), _lists(doc_ids[s], pa.int64()),
                _lists(text_of[s], pa.int64()), _lists(set_of[s], pa.int64()), _lists(size_of[s], pa.int32()),
                pa.array(runs[s], pa.binary()), pa.array(packed[s], pa.binary())],
                names=["kind", "slot", "doc_ids", "texts", "sets", "sizes", "runs", "tokens"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, held = Shingles(width), 0
        kept: list[list[np.ndarray]] = [[] for _ in range(5)]
        for batch in batches:
            numbers = batch.column(0).to_numpy(zero_copy_only=False)
            hashes = batch.column(1).to_numpy(zero_copy_only=False)
            done = 0
            for part in chunks(batch.column(2).to_pylist()):
                token, begin = shingles.run(part)
                upto = done + len(part)
                for column, value in zip(kept, (numbers[done:upto], hashes[done:upto], set_ids(token, begin), token, begin)):
                    column.append(value)
                done = upto
                held += sum(map(len, part))
                if held >= BLOCK_BYTES:
                    yield from flush(*kept)
                    kept, held = [[] for _ in range(5)], 0
                    release()
        if kept[0]:
            yield from flush(*kept)
        release()

    # A stand-in keeps NULL ids apart from all numbers; they come back as NULL.
    rows = bounded_batches(docs).select(
        F.coalesce(F.col(id).cast("long"), F.lit(NONE)).alias("id"), text_hash(text).alias("hash"),
        text_bytes(text).alias("text"))
    return rows.mapInArrow(task, ROWS)


def text_hash(text: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text).cast("string"), F.lit("")))


#: Stands for a NULL id inside arrays.
NONE = -(1 << 63)

SHARED = ("kind int, slot int, doc_ids array<long>, texts array<long>, sets array<long>, sizes array<int>, "
          "tokens binary, counts binary, runs binary")


def _shared_rows(kinds, slots, doc_ids, texts, sets, sizes, tokens, counts, runs) -> pa.Table:
    return pa.Table.from_arrays([
        pa.array(kinds, pa.int32()), pa.array(slots, pa.int32()), _lists(doc_ids, pa.int64()), _lists(texts, pa.int64()),
        _lists(sets, pa.int64()), _lists(sizes, pa.int32()), pa.array(tokens, pa.binary()),
        pa.array(counts, pa.binary()), pa.array(runs, pa.binary())],
        names=["kind", "slot", "doc_ids", "texts", "sets", "sizes", "tokens", "counts", "runs"])


def _counting(slots: int):
    """For a range of hashes: its tokens that two or more sets hold, with that number, a row for each
    ``slots``-th part of the sets.  Documents (kind 0) pass through."""

    def task(table: pa.Table) -> pa.Table:
        out = [[] for _ in range(9)]

        def emit(*row):
            for column, value in zip(out, row):
                column.append(value)

        none = np.zeros(0, np.int64)
        sets, sizes, tokens, owners, offset = [], [], [], [], 0
        for batch in table.to_batches():
            for row in range(batch.num_rows):
                own = batch.column("sets")[row].values.to_numpy()
                own_sizes = batch.column("sizes")[row].values.to_numpy()
                if batch.column("kind")[row].as_py() == 0:
                    emit(0, 0, batch.column("doc_ids")[row].values.to_numpy(),
                         batch.column("texts")[row].values.to_numpy(), own, own_sizes, b"", b"", b"")
                    continue
                sets.append(own)
                sizes.append(own_sizes)
                tokens.append(unpack(batch.column("tokens")[row].as_py(), NARROW))
                runs = unpack(batch.column("runs")[row].as_py(), 4).astype(np.int64)
                owners.append(np.repeat(np.arange(offset, offset + len(own), dtype=np.int32), runs))
                offset += len(own)
        if tokens:
            salt = np.array([table.column("slot")[0].as_py() + 1], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            # The same set in several blocks is one.
            sets, first, same = np.unique(np.concatenate(sets), return_index=True, return_inverse=True)
            sizes = np.concatenate(sizes)[first]
            token, owner = np.concatenate(tokens), same.astype(np.int32)[np.concatenate(owners)]
            tokens.clear()
            owners.clear()
            order = np.lexsort((owner, token))
            token, owner = token[order], owner[order]
            fresh = np.ones(len(token), bool)
            fresh[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
            token, owner = token[fresh], owner[fresh]
            edge = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1], [True]]))
            count = np.diff(edge).astype(np.uint32)
            count = np.repeat(count, count)
            kept = count > 1
            token, owner, count = token[kept], owner[kept], count[kept]
            token = mix(token ^ salt) >> np.uint64(64 - 8 * WIDE)
            part = (mix(sets.view(np.uint64)) % np.uint64(slots)).astype(np.int32)[owner]
            order = np.lexsort((owner, part))
            token, owner, count, part = token[order], owner[order], count[order], part[order]
            cuts = np.searchsorted(part, np.arange(slots + 1))
            for k in np.flatnonzero(np.diff(cuts)):
                a, b = cuts[k], cuts[k + 1]
                here, run = np.unique(owner[a:b], return_counts=True)
                emit(1, k, none, none, sets[here], sizes[here], pack(token[a:b], WIDE), pack(count[a:b], 4), pack(run, 4))
            del token, owner, count, part, order
        release()
        return _shared_rows(*out)

    return task


LISTS = "set long, size int, shared int, tokens binary, marks binary"


def _listing(percent: int):
    """For a part of the sets: those with a shared token in their prefix, with their shared tokens
    (sorted); bit k of a token's mark says that it is in the prefix under order k + 1."""

    def task(table: pa.Table) -> pa.Table:
        sets, sizes, tokens, counts, owners, offset = [], [], [], [], [], 0
        for batch in table.to_batches():
            for row in range(batch.num_rows):
                own = batch.column("sets")[row].values.to_numpy()
                sets.append(own)
                sizes.append(batch.column("sizes")[row].values.to_numpy())
                tokens.append(unpack(batch.column("tokens")[row].as_py(), WIDE))
                counts.append(unpack(batch.column("counts")[row].as_py(), 4).astype(np.uint32))
                runs = unpack(batch.column("runs")[row].as_py(), 4).astype(np.int64)
                owners.append(np.repeat(np.arange(offset, offset + len(own)), runs))
                offset += len(own)
        sets, first, same = np.unique(np.concatenate(sets), return_index=True, return_inverse=True)
        sizes = np.concatenate(sizes)[first].astype(np.int64)
        token, count = np.concatenate(tokens), np.concatenate(counts)
        owner = same[np.concatenate(owners)]
        shared = np.bincount(owner, minlength=len(sets))
        room = prefix_length(sizes, percent) - (sizes - shared)  # places of a prefix that shared tokens take
        kept = (room > 0)[owner]
        token, count, owner = token[kept], count[kept], owner[kept]
        order = np.lexsort((token, owner))
        token, count, owner = token[order], count[order], owner[order]
        begins = np.searchsorted(owner, np.arange(len(sets)))
        ends = np.searchsorted(owner, np.arange(len(sets)), "right")
        place = np.arange(len(token)) - begins[owner]
        marks = np.zeros(len(token), np.uint8)
        orders = (
            np.lexsort((token, count, owner)),
            np.lexsort((mix(token ^ np.uint64(0xA24BAED4963EE407)), np.log2(count).astype(np.int32), owner)),
            np.lexsort((mix(token ^ np.uint64(0x9FB21C651E98DF25)), owner)),
        )
        for k, order in enumerate(orders):
            marks[order[place < room[owner]]] |= 1 << k
        chosen = np.flatnonzero((room > 0) & (begins < ends))
        out = pa.Table.from_arrays([
            pa.array(sets[chosen]), pa.array(sizes[chosen].astype(np.int32)), pa.array(shared[chosen].astype(np.int32)),
            pa.array([pack(token[begins[k] : ends[k]], WIDE) for k in chosen], pa.binary()),
            pa.array([marks[begins[k] : ends[k]].tobytes() for k in chosen], pa.binary()),
        ], names=["set", "size", "shared", "tokens", "marks"])
        del token, count, owner, orders, order
        release()
        return out

    return task


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each token in a set's prefix under the first order."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            found = [unpack(t.as_py(), WIDE)[np.frombuffer(m.as_py(), np.uint8) & 1 == 1]
                     for t, m in zip(part.column(3), part.column(4))]
            rows = np.repeat(np.arange(part.num_rows), [len(x) for x in found])
            yield pa.RecordBatch.from_arrays(
                [*[part.column(k).take(pa.array(rows)) for k in range(3)], pa.array(np.concatenate(found).view(np.int64))],
                names=["set", "size", "shared", "token"])


def _verify(percent: int):
    """Of candidate pairs that share a prefix token under the first order: those that do under the others
    too and whose Jaccard similarity is high enough."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, kept = batch.to_pydict(), []
            for k in range(batch.num_rows):
                _, i, j = np.intersect1d(unpack(rows["tokens_a"][k], WIDE), unpack(rows["tokens_b"][k], WIDE),
                                         assume_unique=True, return_indices=True)
                met = np.frombuffer(rows["marks_a"][k], np.uint8)[i] & np.frombuffer(rows["marks_b"][k], np.uint8)[j]
                if np.bitwise_or.reduce(met, initial=0) != 7:
                    continue
                if 100 * len(i) >= percent * (rows["size_a"][k] + rows["size_b"][k] - len(i)):
                    kept.append(k)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return task


class Lists:
    """Token lists of some sets, one after another, each token with the place of its set."""

    def __init__(self, tokens: list[np.ndarray]):
        self.n = len(tokens)
        self.token = np.concatenate([np.zeros(0, np.uint64), *tokens])
        self.owner = np.repeat(np.arange(self.n), [len(x) for x in tokens])

    def where(self, kept: np.ndarray) -> Lists:
        out = Lists([])
        out.n, out.token, out.owner = self.n, self.token[kept], self.owner[kept]
        return out

    def among(self, common: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the tokens in ``common``, sorted by it: which one it is, and whose."""
        at = np.minimum(np.searchsorted(common, self.token), len(common) - 1)
        hit = np.flatnonzero(common[at] == self.token)
        order = np.argsort(at[hit], kind="stable")
        return at[hit][order], self.owner[hit][order]


def _overlaps(a: Lists, b: Lists, dense: int = 4096, columns: int = 256, most: int = 1 << 20) -> np.ndarray:
    """How many tokens each list of a has in common with each of b.

    Tokens that many sets on both sides hold are counted by products of 0/1 matrices, ``columns`` tokens at a
    time, the others pair by pair, at most ``most`` at a time.
    """
    out = np.zeros((a.n, b.n), np.int32)
    common = np.intersect1d(a.token, b.token)
    if not len(common):
        return out
    (ka, ia), (kb, ib) = a.among(common), b.among(common)
    edges = np.arange(len(common) + 1)
    cuts_a, cuts_b = np.searchsorted(ka, edges), np.searchsorted(kb, edges)
    pairs = np.diff(cuts_a) * np.diff(cuts_b)

    frequent = np.flatnonzero(pairs >= dense)
    column = np.full(len(common), -1)
    column[frequent] = np.arange(len(frequent))
    for first in range(0, len(frequent), columns):
        sides = []
        for k, i, n in ((ka, ia, a.n), (kb, ib, b.n)):
            here = np.flatnonzero((column[k] >= first) & (column[k] < first + columns))
            side = np.zeros((n, columns), np.float32)
            side[i[here], column[k[here]] - first] = 1
            sides.append(side)
        out += (sides[0] @ sides[1].T).astype(np.int32)

    hit = np.flatnonzero(pairs[ka] < dense)
    width, low = np.diff(cuts_b)[ka[hit]], cuts_b[ka[hit]]
    upto, done = np.cumsum(width), 0
    while done < len(hit):
        take = max(1, int(np.searchsorted(upto, (upto[done - 1] if done else 0) + most, "right")) - done)
        n, begin = width[done : done + take], low[done : done + take]
        at = np.arange(n.sum()) + np.repeat(begin - np.concatenate([[0], np.cumsum(n)[:-1]]), n)
        flat = np.repeat(ia[hit[done : done + take]], n) * b.n + ib[at]
        out += np.bincount(flat, minlength=a.n * b.n).astype(np.int32).reshape(a.n, b.n)
        done += take
    return out


def _possible(a: pa.Table, b: pa.Table, percent: int, both: np.ndarray | None = None) -> np.ndarray:
    """Pairs of sets of different components that can be similar, or are, if ``both`` holds what they share."""
    size_a, size_b = (t["size"].to_numpy().astype(np.int64) for t in (a, b))
    if both is None:
        both = np.minimum(a["shared"].to_numpy().astype(np.int64)[:, None], b["shared"].to_numpy().astype(np.int64)[None, :])
        both = np.minimum(both, np.minimum(size_a[:, None], size_b[None, :]))
    similar = 100 * both.astype(np.int64) >= percent * (size_a[:, None] + size_b[None, :] - both)
    return similar & (a["label"].to_numpy()[:, None] != b["label"].to_numpy()[None, :])


def _tiles(table: pa.Table) -> list[pa.Table]:
    """Parts of a block: TILE_SETS sets and TILE_TOKENS tokens at most, or one set."""
    weight = np.maximum(table["shared"].to_numpy().astype(np.int64), -(-TILE_TOKENS // TILE_SETS))
    tile = (np.cumsum(weight) - weight) // TILE_TOKENS
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(tile)) + 1, [len(tile)]])
    return [table.slice(x, y - x) for x, y in zip(cuts[:-1], cuts[1:])]


TILES = "tile string, side int, set long, label long"


def _open_tiles(percent: int):
    """Two blocks of sets with their prefixes: the tiles that have a pair which passes every order, each with
    the sets of its open rows (side 0) and columns (side 1)."""

    def prefixes(tile: pa.Table) -> list[Lists]:
        whole = Lists([unpack(x.as_py(), WIDE) for x in tile["tokens"]])
        marks = np.frombuffer(b"".join(tile["marks"].to_pylist()), np.uint8)
        return [whole.where(marks >> k & 1 == 1) for k in range(3)]

    def task(table: pa.Table) -> pa.Table:
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        block = table["block"].to_numpy()
        sides = [_tiles(table.filter(pa.array(block == x)).sort_by("set")) for x in ((low,) if low == high else (low, high))]
        out = []
        for i, a in enumerate(sides[0]):
            own = prefixes(a)
            for j, b in enumerate(sides[-1]):
                if low == high and j < i:
                    continue
                open_ = _possible(a, b, percent)
                other = prefixes(b) if open_.any() else own
                for x, y in zip(own, other):
                    if open_.any():
                        open_ &= _overlaps(x, y) > 0
                for side, tile, axis in ((0, a, 1), (1, b, 0)):
                    found = tile.filter(pa.array(open_.any(axis)))
                    if found.num_rows:
                        out.append(pa.table({
                            "tile": [f"{low}-{high}-{i}-{j}"] * found.num_rows,
                            "side": pa.array([side] * found.num_rows, pa.int32()),
                            "set": found["set"], "label": found["label"]}))
        release()
        none = pa.table({"tile": pa.array([], pa.string()), "side": pa.array([], pa.int32()),
                         "set": pa.array([], pa.int64()), "label": pa.array([], pa.int64())})
        return pa.concat_tables([none, *out])

    return task


def _forest(a: np.ndarray, b: np.ndarray, hit_a: np.ndarray, hit_b: np.ndarray) -> list[int]:
    """Of the pairs (hit_a of labels a, hit_b of labels b): enough to join all labels that they join."""
    labels, of = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = np.arange(len(labels))
    left, right, kept, rows = of[: len(a)][hit_a], of[len(a) :][hit_b], [], np.arange(len(hit_a))
    while len(rows):
        _, first = np.unique(left[rows], return_index=True)
        for k in rows[first]:  # one pair for each label at a time
            p, q = parent[left[k]], parent[right[k]]
            if p != q:
                kept.append(int(k))
                parent[parent == q] = p
        left, right = parent[left], parent[right]
        rows = rows[left[rows] != right[rows]]
    return kept


def _compare(percent: int):
    """A tile with whole lists: a forest of the links between sets of different components."""

    def task(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        a, b = (table.filter(pa.array(side == k)) for k in (0, 1))
        both = _overlaps(*[Lists([unpack(x.as_py(), WIDE) for x in t["tokens"]]) for t in (a, b)])
        hit_a, hit_b = np.nonzero(_possible(a, b, percent, both))
        kept = _forest(a["label"].to_numpy(), b["label"].to_numpy(), hit_a, hit_b)
        out = pa.table({"a": a["set"].to_numpy()[hit_a[kept]], "b": b["set"].to_numpy()[hit_b[kept]]})
        del both, hit_a, hit_b
        release()
        return out

    return task


def _star_links(lists: DataFrame, postings: DataFrame, percent: int) -> DataFrame:
    """Links between one member of each token's group and the others."""
    own = (1 - F.col("shared") / F.col("size")).alias("own")
    pivots = postings.groupBy("token").agg(
        F.min(F.struct(own, "set", "size", "shared")).alias("pivot"), F.count(F.lit(1)).alias("n")).where("n > 1")
    most = F.least("shared", "pivot.shared", "size", "pivot.size")
    pairs = (
        postings.join(pivots.select("token", "pivot"), "token")
        .where((F.col("set") != F.col("pivot.set"))
               & (100 * most >= percent * (F.col("size") + F.col("pivot.size") - most)))
        .select(F.col("pivot.set").alias("a"), F.col("set").alias("b")).distinct()
    )
    side = lambda s: lists.select(F.col("set").alias(s), *[
        F.col(c).alias(f"{c}_{s}") for c in ("size", "tokens", "marks")])
    rows = store(pairs, "pairs").join(side("a"), "a").join(side("b"), "b")
    return rows.mapInArrow(_verify(percent), "a long, b long")


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists cut down to the tokens of some prefix."""
    for batch in batches:
        tokens, marks = [], []
        for t, m in zip(batch.column("tokens"), batch.column("marks")):
            mark = np.frombuffer(m.as_py(), np.uint8)
            tokens.append(pack(unpack(t.as_py(), WIDE)[mark > 0], WIDE))
            marks.append(mark[mark > 0].tobytes())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:5], pa.array(tokens, pa.binary()), pa.array(marks, pa.binary())], names=batch.schema.names)


def _block_links(lists: DataFrame, postings: DataFrame, labels: DataFrame, percent: int) -> DataFrame | None:
    """The links still missing: between sets of different components that share a prefix token."""
    known = labels.select(F.col("node").alias("set"), "label")
    placed = postings.join(known, "set", "left").withColumn("label", F.coalesce("label", "set"))
    # Two sets share at most their shared tokens, so one of them must have few tokens of its own.
    strong = F.max(F.col("shared") / F.col("size")) >= 2 * percent / (100 + percent) - 1e-9
    split = placed.groupBy("token").agg(
        F.min("label").alias("x"), F.max("label").alias("y"), strong.alias("strong")).where("x <> y AND strong")
    rest = store(placed.join(split.select("token", "x"), "token"), "unresolved")
    if not rest.take(1):
        return None
    # Sets that share tokens mostly see the same smallest component beside them: they come to lie together.
    # A prefix has as many tokens under each order.
    members = rest.groupBy("set").agg(F.first("label").alias("label"), F.min("x").alias("near"), F.first("size").alias("size"),
                                      F.first("shared").alias("shared"))
    room = F.col("shared") - F.floor((F.col("size").cast("long") * percent + 99) / 100) + 1
    members = members.withColumn("weight", F.greatest(3 * room, F.lit(-(-BLOCK_TOKENS // BLOCK_SETS))).cast("long"))
    laid = running_sums(members, [F.col("near").asc(), F.col("set").asc()], ["weight"])
    laid = store(laid.select("set", "label", F.floor(F.col("weight_before") / BLOCK_TOKENS).alias("block")), "blocks")
    at = rest.select("token", "set").join(laid.select("set", "block"), "set").select("token", "block").distinct()
    sides = at.groupBy("token").agg(F.array_sort(F.collect_set("block")).alias("blocks")).select("blocks").distinct()
    meet = sides.select(F.explode("blocks").alias("low"), "blocks").select(
        "low", F.explode(F.filter("blocks", lambda b: b >= F.col("low"))).alias("high")).distinct()
    meet = store(meet, "meetings")
    heads = laid.join(lists, "set").select("set", "label", "block", "size", "shared", "tokens", "marks").mapInArrow(
        _heads, "set long, label long, block long, size int, shared int, tokens binary, marks binary")
    heads = store(heads, "heads")
    by_low = meet.join(heads, F.col("low") == F.col("block"))
    by_high = meet.where("low <> high").join(heads, F.col("high") == F.col("block"))
    tiles = store(by_low.unionByName(by_high).groupBy("low", "high").applyInArrow(_open_tiles(percent), TILES), "tiles")
    whole = tiles.join(lists.select("set", "size", "shared", "tokens"), "set")
    return whole.groupBy("tile").applyInArrow(_compare(percent), "a long, b long")


def ngram_components(
    docs: DataFrame,
    percent: int = 75,
    width: int = 5,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    Two documents link when 100 * |A and B| >= ``percent`` * |A or B| for their sets of distinct
    shingles of ``width`` words (A-Z lower-cased); a shorter text is one shingle, one without words has an
    empty set and links with nothing.  ``component_id`` is the smallest doc_id that links lead to,
    the document's own included.

    NULL texts count as empty.  Rows with a NULL id link like others but give no id: their
    component is the smallest id of their group, NULL if no member has one.  Repeated rows are repeated
    in the result.  No rows give an empty result.  Sets are told apart by 64-bit hashes, shingles by 40 bits
    within a range of hashes: of two sets of 1,000 shingles one in about ten million pairs seems to share one
    more than it does.  Runs several jobs; what lies between them is in the shared work folder.
    """
    rows, of_set = _components(docs, percent, width, id, text)
    return rows.join(of_set, "set", "left").select(
        F.explode("docs").alias("doc"), "size", "component_id").select(
        F.col("doc.doc_id"), F.col("size").cast("long").alias("n_shingles"),
        F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc.doc_id")).alias("component_id"))


def _components(docs: DataFrame, percent: int, width: int, id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """A row for each set of a block (set, size, docs: doc_id and hash of the text) and a row for each set
    that isn't empty (set, component_id, label: the same for all sets of a component)."""
    spark = docs.sparkSession
    volume = docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
    slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-volume // (6 * RANGE_TOKENS)))
    # As many tasks as ranges: what a task reads doesn't grow with the corpus.
    blocks = _blocks(docs, id, text, width, slots).repartition(slots, "slot")
    shared = store(blocks.groupBy("slot").applyInArrow(_counting(slots), SHARED), "shared")

    # A set's documents in a block stay together: a set that a third of all documents have is a row per block.
    entry = F.explode(F.transform(F.sequence(F.lit(0), F.size("sets") - 1), lambda k: F.struct(
        F.get("sets", k).alias("set"), F.get("sizes", k).alias("size"),
        F.get("sizes", F.size("sets") + k).alias("begin"), F.get("sizes", F.size("sets") + k + 1).alias("end"))))
    rows = shared.where("kind = 0").select(entry.alias("e"), "doc_ids", "texts").select(
        F.col("e.set"), F.col("e.size"), *[
            F.slice(c, F.col("e.begin") + 1, F.col("e.end") - F.col("e.begin")).alias(c) for c in ("doc_ids", "texts")])
    rows = rows.select("set", "size", F.transform(F.arrays_zip("doc_ids", "texts"), lambda d: F.struct(
        F.nullif(d["doc_ids"], F.lit(NONE)).alias("doc_id"), d["texts"].alias("hash"))).alias("docs"))
    parts = shared.where("kind = 1").select("slot", "sets", "sizes", "tokens", "counts", "runs").repartition(slots, "slot")
    lists = store(parts.groupBy("slot").applyInArrow(_listing(percent), LISTS), "lists")

    postings = lists.select("set", "size", "shared", "tokens", "marks").mapInArrow(
        _postings, "set long, size int, shared int, token long")
    links = store(_star_links(lists, postings, percent), "links")
    labels = components(links)
    more = _block_links(lists, postings, labels, percent)
    if more is not None:
        more = store(more, "links")
        if more.take(1):
            labels = components(links.unionByName(more))

    least = rows.where("size > 0").groupBy("set").agg(
        F.min(F.array_min(F.transform("docs", lambda d: d["doc_id"]))).alias("least"))
    linked = labels.join(least, F.col("node") == F.col("set")).select("node", "label", "least")
    group = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    of = linked.join(group, "label").select("node", "label", "component_id")
    of_set = least.join(of, F.col("set") == F.col("node"), "left").select(
        "set", F.when(F.col("node").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("label", "set").alias("label"))
    return rows, of_set


def drop_near_copies(docs: DataFrame, percent: int = 75, width: int = 5, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked ones, equal texts included.

    The row with the smallest id stays (NULL after all others), then that with the smallest hash of the text,
    then of the whole row.  Rows link by their texts, whatever their ids: of rows that repeat an id
    and link with nothing, each stays.  NULL and empty texts and texts without words link with nothing
    and all stay.  No rows give an empty result; extra columns stay as they are.
    """
    rows, of_set = _components(docs, percent, width, id, text)
    best = F.array_min(F.transform("docs", lambda d: F.struct(
        d["doc_id"].isNull().alias("no_id"), d["doc_id"].alias("doc_id"), d["hash"].alias("hash")))).alias("best")
    first = rows.where("size > 0").select("set", best).groupBy("set").agg(F.min("best").alias("best"))
    chosen = first.join(of_set, "set").groupBy("label").agg(F.min("best").alias("best")).select(
        F.struct(F.col("best.doc_id").alias("doc_id"), F.col("best.hash").alias("hash")).alias("key"))

    wordless = ~F.coalesce(F.col(text).cast("string").rlike(WORD), F.lit(False))
    keyed = docs.where(~wordless).select(
        F.struct("*").alias("row"), F.struct(F.col(id).cast("long").alias("doc_id"), text_hash(text).alias("hash")).alias("key"))
    same = W.partitionBy("key").orderBy(F.xxhash64(F.to_json("row")))
    kept = keyed.join(chosen, "key", "left_semi").withColumn("place", F.row_number().over(same)).where("place = 1")
    return kept.select("row.*").unionByName(docs.where(wordless))
