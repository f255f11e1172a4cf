"""Conversation structure repair by Wagner-Fischer alignment with the alternating grammar (s?(ua)+)?.

A conversation's turns are aligned with target strings u a u a ..., behind an s that is kept or not: one
dynamic program holds every feasible length of a target, because the targets of one last letter
are suffixes of each other.  Cells are kept only inside Ukkonen's band: a greedy repair gives the incumbent
cost, deletions cost 4 and insertions 3, so a cell farther from the diagonal than the incumbent pays for
can't be on a cheapest path.  For the lengths that cost the least, audits (D delete, I insert, K keep,
R change of role) are traced back and compared; the ASCII-least is taken.

A conversation may be as long as it likes.  Turns are range-partitioned by (conversation, turn), so a long one
spreads over many tasks, and every WINDOW consecutive turns are aligned by themselves, from each state in
which the grammar can be (nothing yet, after s, after u, after a) to each state after them.  An insertion
belongs to the turn it precedes; so two audits of one window never begin each other, and the least
audit of a whole conversation is made of least audits of its windows.  Windows of a conversation are joined
pairwise by (cost, rank of the audit) tables of 4 x 4 numbers, FAN at a time and level by level, and the states
chosen at the top go back down.  Only the digest of the repaired text reads a conversation's rows in
one stream, because SHA-256 can't be split; it holds one row at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from millrace.llm.common import bounded_batches, store, worker_cache

# Costs of an edit, what separates words, what ends a sentence.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
SEEN, ENDED = r"[^\x20\x09-\x0D]", r"[.!?][\x20\x09-\x0D]*\z"
#: Turns that are aligned together, windows that are joined at a time.
WINDOW, FAN = 256, 256
#: States of the grammar: nothing yet, after s, after u, after a; and what closing a text costs in them.
STATES = 4
CLOSE = ("", "II", "I", "")
FAR = 1 << 40


# Alignment of one window.  A code letter per turn: the role's initial (s, u, a, or x for any other),
# upper-case if the turn is truncated; d if it has to go.

def _next_letter(state: int) -> int:
    """0 (u) or 1 (a): what the grammar wants after a state."""
    return 1 if state == 2 else 0


def _incumbent(code: str) -> int:
    """What a simple repair costs at most from any state: drop what must go, turn the others into the next letter."""
    most = 0
    for want in (0, 1):
        cost = 0
        for c in code:
            if c == "d":
                cost += DELETE
                continue
            cost += (0 if c.lower() == "ua"[want] else REROLE) + (TRUNCATED if c.isupper() else 0)
            want = 1 - want
        most = max(most, cost)
    return most


def _tables(code: str, limit: int) -> np.ndarray:
    """cost[last, i, r]: turns from i on as the last r letters of a target that ends in u (0) or a (1).

    Nothing is inserted behind the last turn.  Cells outside the band of ``limit`` are FAR.
    """
    n = len(code)
    wide = n + limit // INSERT + 1
    r = np.arange(wide)
    first = np.arange(2)[:, None] ^ ((r[None, :] - 1) & 1)  # the letter that r letters begin with
    cost = np.full((2, n + 1, wide), FAR, np.int64)
    cost[:, n, 0] = 0
    for i in range(n - 1, -1, -1):
        c = code[i]
        here = cost[:, i + 1] + DELETE
        if c != "d":
            fits = "ua".find(c.lower())
            take = np.where(first == fits, 0, REROLE) + (TRUNCATED if c.isupper() else 0)
            here[:, 1:] = np.minimum(here[:, 1:], cost[:, i + 1, :-1] + take[:, 1:])
        here = np.minimum.accumulate(here - INSERT * r, axis=1) + INSERT * r
        left = n - i
        here[:, : max(0, left - limit // DELETE)] = FAR
        here[:, left + limit // INSERT + 1 :] = FAR
        cost[:, i] = np.minimum(here, FAR)
    return cost


def _trace(code: str, cost: np.ndarray, last: int, i: int, r: int) -> str:
    """The ASCII-least audit of a cheapest alignment of the turns from i on with r letters."""
    out, n = [], len(code)
    table = cost[last].tolist() if n * cost.shape[2] < 4096 else cost[last]
    while i < n:
        c, here = code[i], table[i][r]
        if table[i + 1][r] + DELETE == here:
            out.append("D")
            i += 1
        elif r and table[i][r - 1] + INSERT == here:
            out.append("I")
            r -= 1
        else:
            out.append("K" if c.lower() == "ua"[last ^ ((r - 1) & 1)] else "R")
            i, r = i + 1, r - 1
    return "".join(out)


def align(code: str) -> list[tuple[int, str] | None]:
    """For each pair of states (before, after; the latter counts up first): least cost and audit, None if there is none
    or it can't be part of a cheapest whole.  What two states cost later differs by at most 7."""
    n = len(code)
    limit = _incumbent(code) + DELETE + INSERT
    cost = _tables(code, limit)
    found: list[tuple[int, str] | None] = [None] * (STATES * STATES)

    def offer(before: int, after: int, price: int, audits) -> None:
        if price > limit:
            return
        held = found[STATES * before + after]
        if held is not None and held[0] < price:
            return
        audit = min(audits())
        if held is None or (price, audit) < held:
            found[STATES * before + after] = (price, audit)

    for before in range(STATES):
        want = _next_letter(before)
        for last in (0, 1):
            # Lengths of targets that begin with the letter wanted and end with this one.
            lengths = np.arange((want ^ last) + 1, cost.shape[2], 2)
            prices = cost[last, 0, lengths] if len(lengths) else np.zeros(0, np.int64)
            if len(prices) and prices.min() < FAR:
                least = int(prices.min())
                offer(before, 2 + last, least,
                      lambda: [_trace(code, cost, last, 0, int(r)) for r in lengths[prices == least]])
        offer(before, before, DELETE * n, lambda: ["D" * n])
    # From the first state an s may be kept, with all turns before it deleted.
    for i, c in enumerate(code):
        if c not in "sS":
            continue
        paid = DELETE * i + (TRUNCATED if c == "S" else 0)
        if paid > limit:
            break
        if paid + DELETE * (n - i - 1) <= limit:
            offer(0, 1, paid + DELETE * (n - i - 1), lambda: ["D" * i + "K" + "D" * (n - i - 1)])
        for last in (0, 1):
            lengths = np.arange(last + 1, cost.shape[2], 2)
            prices = cost[last, i + 1, lengths] if len(lengths) else np.zeros(0, np.int64)
            if len(prices) and prices.min() < FAR:
                least = int(prices.min())
                offer(0, 2 + last, paid + least, lambda: [
                    "D" * i + "K" + _trace(code, cost, last, i + 1, int(r)) for r in lengths[prices == least]])
    return found


def ranks(audits: list[str | None]) -> list[int]:
    """For each state before: the place of each audit among those of the states after."""
    out = []
    for before in range(STATES):
        row = audits[STATES * before : STATES * before + STATES]
        order = sorted(x for x in row if x is not None)
        out += [order.index(x) if x is not None else STATES for x in row]
    return out


def join(a: tuple[list[int], list[int]], b: tuple[list[int], list[int]]) -> tuple[list[int], list[int], list[int]]:
    """Costs and ranks of two stretches behind each other, and the state between them for each pair of states."""
    costs, rank, between = [FAR] * 16, [STATES] * 16, [0] * 16
    for before in range(STATES):
        keys = {}
        for after in range(STATES):
            ways = [
                (a[0][4 * before + m] + b[0][4 * m + after], a[1][4 * before + m], b[1][4 * m + after], m)
                for m in range(STATES)
                if a[0][4 * before + m] < FAR and b[0][4 * m + after] < FAR]
            if ways:
                costs[4 * before + after], *keys[after], between[4 * before + after] = min(ways)
        for place, after in enumerate(sorted(keys, key=keys.get)):
            rank[4 * before + after] = place
    return costs, rank, between


def ending(costs: list[int], rank: list[int]) -> int:
    """The state a whole conversation should end in, before it is closed."""
    return min((costs[k] + INSERT * len(CLOSE[k]), rank[k], k) for k in range(STATES) if costs[k] < FAR)[2]


# Jobs.

WINDOWS = "costs array<long>, ranks array<int>, audits array<string>, alone int"


def _align_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window's least costs and audits; short conversations repeat, so results are kept for a while."""
    known: dict[str, tuple] = worker_cache("turn repair", dict)
    for batch in batches:
        rows = []
        for code in batch.column(batch.num_columns - 1).to_pylist():
            if code not in known:
                found = align(code)
                costs = [x[0] if x else FAR for x in found]
                audits = [x[1] if x else None for x in found]
                rank = ranks(audits)
                entry = costs, rank, audits, ending(costs, rank)
                if len(code) > 32:
                    rows.append(entry)
                    continue
                if len(known) >= 20_000:
                    known.clear()
                known[code] = entry
            rows.append(known[code])
        kinds = (pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *[pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]],
            names=[*batch.schema.names[:-1], "costs", "ranks", "audits", "alone"])


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[list[dict]]:
    """Runs of rows with equal keys, from batches sorted by them."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and any(held[0][k] != row[k] for k in keys):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each group of at most FAN neighbours."""
    for group in _groups(batches, ["conv", "parent"]):
        costs, rank = group[0]["costs"], group[0]["ranks"]
        for row in group[1:]:
            costs, rank, _ = join((costs, rank), (row["costs"], row["ranks"]))
        yield pa.RecordBatch.from_pydict({
            "conv": [group[0]["conv"]], "seg": pa.array([group[0]["parent"]], pa.int64()),
            "costs": pa.array([costs], pa.list_(pa.int64())), "ranks": pa.array([rank], pa.list_(pa.int32()))})


def _unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The states before and after each of a group's rows, given those of the group (its first row)."""
    for group in _groups(batches, ["conv", "parent"]):
        rows, before, after = group[1:], group[0]["before"], group[0]["after"]
        # Costs from each row to the end of the group, then a walk from the front.
        tails = [(rows[-1]["costs"], rows[-1]["ranks"])]
        for row in rows[-2::-1]:
            tails.append(join((row["costs"], row["ranks"]), tails[-1])[:2])
        states = [before]
        for row, tail in zip(rows[:-1], tails[-2::-1]):
            between = join((row["costs"], row["ranks"]), tail)[2]
            states.append(between[4 * states[-1] + after])
        states.append(after)
        yield pa.RecordBatch.from_pydict({
            "conv": [r["conv"] for r in rows], "seg": pa.array([r["seg"] for r in rows], pa.int64()),
            "before": pa.array(states[:-1], pa.int32()), "after": pa.array(states[1:], pa.int32())})


def _end_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ends = [ending(c, r) for c, r in zip(batch["costs"].to_pylist(), batch["ranks"].to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [batch["conv"], batch["seg"], pa.array([0] * len(ends), pa.int32()), pa.array(ends, pa.int32())],
            names=["conv", "seg", "before", "after"])


def _states(windows: DataFrame) -> DataFrame:
    """conv, seg, before, after for the windows of conversations that have several."""
    decided = "conv string, seg long, before int, after int"
    level, levels, roots = windows.select("conv", "seg", "costs", "ranks"), [], []
    while True:
        several = level.groupBy("conv").agg(F.count(F.lit(1)).alias("n"))
        counted = level.join(several, "conv")
        if levels:
            roots.append(counted.where("n = 1").select("conv", "seg", "costs", "ranks").mapInArrow(_end_states, decided))
        parent = F.when(F.col("n") <= FAN, F.lit(0).cast("long")).otherwise(F.floor(F.col("seg") / FAN)).cast("long").alias("parent")
        open_ = store(counted.where("n > 1").select("conv", "seg", "costs", "ranks", parent), "window-groups")
        if not open_.take(1):
            break
        levels.append(open_)
        sorted_ = open_.repartition("conv", "parent").sortWithinPartitions("conv", "parent", "seg")
        level = store(sorted_.mapInArrow(_fold, "conv string, seg long, costs array<long>, ranks array<int>"), "window-sums")
    states = windows.sparkSession.createDataFrame([], decided)
    for open_, root in zip(reversed(levels), reversed(roots)):
        above = states.unionByName(root).select("conv", F.col("seg").alias("parent"), F.lit(-1).cast("long").alias("seg"),
                                                "before", "after")
        both = open_.unionByName(above, allowMissingColumns=True)
        both = both.repartition("conv", "parent").sortWithinPartitions("conv", "parent", "seg")
        states = store(both.mapInArrow(_unfold, decided), "window-states")
    return states


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv, turn, role, text after damage by crc32("conv:turn") % 20, one space for NULL: 0 drops a row, 1 empties its text,
    2 takes out . ! ?, 3 repeats it, 4 makes it the user's.

    ``conv`` is the id as a string behind "=", or "" for NULL.
    """
    space = F.lit(" ")
    id = F.col(conv).cast("string")
    fate = F.crc32(F.concat(F.coalesce(id, space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))) % 20
    rows = turns.select(
        F.coalesce(F.concat(F.lit("="), id), F.lit("")).alias("conv"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), space).alias("role"), F.coalesce(F.col(text).cast("string"), space).alias("text"),
        fate.alias("fate")).where("fate <> 0")
    changed = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
                       changed.alias("text"), F.explode(times).alias("copy")).drop("copy")


ORDER = ("conv", "turn", "role", "digest")
FACTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def _hash_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's first row holds its facts, the others follow in order: one digest for each, from a stream."""
    facts, digest, places, state, first = None, None, None, 0, True
    names = [f.split()[0] for f in FACTS.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.string()]

    def write(role: str, text: str) -> None:
        nonlocal first
        if not first:
            digest.update(b"\n")
        first = False
        digest.update(role.encode() + b":" + text.encode())

    def insert() -> None:
        nonlocal state
        state = 2 + _next_letter(state)
        write("user" if state == 2 else "assistant", "")

    def closed() -> list:
        for _ in places:  # insertions at the end
            insert()
        return [facts["conv"], *[facts[n] for n in names], digest.hexdigest()]

    def batch_of(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, [pa.string(), *kinds, pa.string()])],
            names=["conv", *names, "repaired_sha256"])

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["audit"] is not None:
                if facts is not None:
                    out.append(closed())
                facts, digest, places, state, first = row, hashlib.sha256(), iter(row["audit"]), 0, True
                continue
            edit = next(places)
            while edit == "I":
                insert()
                edit = next(places)
            if edit == "K":
                state = {"s": 1, "u": 2, "a": 3}[row["role"][0]]
                write(row["role"], row["text"])
            elif edit == "R":
                state = 2 + _next_letter(state)
                write("user" if state == 2 else "assistant", row["text"])
        if out:
            yield batch_of(out)
    if facts is not None:
        yield batch_of([closed()])


def repair_turns(turns: DataFrame, rows: DataFrame) -> DataFrame:
    """conv, the facts and repaired_sha256 of every conversation in ``turns`` (a column conv), whose rows are
    ``rows`` (conv, turn, role, text, none of them NULL but turn).

    Rows come by turn, NULL first; those of one turn by role, then by the digest of their text, so equal rows lie
    together.  A row is blank without a character that isn't white space, else duplicate if role and text
    were there before, else truncated if its last such character isn't one of . ! ?.  Keeping a turn costs nothing,
    another role (user or assistant) 3, deletion 4, an empty turn 3; a truncated turn that stays 3 more; blank
    and duplicate turns must go.  What is left reads (s?(ua)+)? in initials of roles; of the cheapest
    audits the ASCII-least is taken.  Conversations without rows have zeros, no audit and the empty text's hash.
    Runs several jobs; what lies between them is in the shared work folder.
    """
    rows = rows.withColumn("digest", _digest(F.col("text")))
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    narrow = rows.select(
        "conv", "turn", "role", "digest", initial.alias("initial"), (~F.col("text").rlike(SEEN)).alias("blank"),
        (~F.col("text").rlike(ENDED)).alias("open"))
    # A number for each row, in order: the range it is in, then its place there.  Stored, so that it stays.
    placed = narrow.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER).withColumn("pos", F.monotonically_increasing_id())
    placed = store(placed, "turns")
    firsts = placed.groupBy("conv", "role", "digest").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    faults = placed.join(firsts.drop("n"), ["conv", "role", "digest"], "left")
    fault = F.when(F.col("blank"), "b").when(F.col("pos") > F.col("first"), "d").when(F.col("open"), "t").otherwise("-")
    code = F.when(F.col("fault").isin("b", "d"), "d").when(F.col("fault") == "t", F.upper("initial")).otherwise(F.col("initial"))
    # Windows don't cross ranges; the numbers of a range's windows begin where those of the range before can't reach.
    most = placed.agg(F.max(F.col("pos").bitwiseAND((1 << 33) - 1))).first()[0] or 0
    seg = F.shiftright("pos", 33) * (most // WINDOW + 1) + F.floor(F.col("pos").bitwiseAND((1 << 33) - 1) / WINDOW)
    letters = faults.withColumn("fault", fault).select("conv", seg.alias("seg"), "pos", "initial", "fault", code.alias("code"))
    line = F.array_sort(F.collect_list(F.struct("pos", "code", "initial")))  # at most WINDOW
    packed = letters.groupBy("conv", "seg").agg(
        line.alias("line"), *[F.count_if(F.col("fault") == f).alias(n) for n, f in (("blank", "b"), ("duplicate", "d"), ("truncated", "t"))])
    packed = packed.select("conv", "seg", "blank", "duplicate", "truncated", F.array_join("line.initial", "").alias("initials"),
                           F.array_join("line.code", "").alias("code"))
    kept = "conv string, seg long, blank long, duplicate long, truncated long, initials string"
    windows = store(packed.mapInArrow(_align_windows, f"{kept}, {WINDOWS}"), "windows")

    chosen = windows.join(_states(windows), ["conv", "seg"], "left").select(
        "*", F.coalesce(F.col("before") * STATES + F.col("after"), F.col("alone")).alias("way"))
    part = F.struct(
        "seg", F.get("audits", F.col("way")).alias("audit"), (F.col("way") % STATES).alias("end"),
        F.substring("initials", 1, 1).alias("head"), F.substring("initials", -1, 1).alias("tail"))
    legal = F.regexp_count("initials", F.lit("s(?=u)|u(?=a)|a(?=u)"))
    parts = chosen.groupBy("conv").agg(
        F.array_sort(F.collect_list(part)).alias("parts"), F.sum(F.get("costs", F.col("way"))).alias("cost"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")], F.sum(F.length("initials")).alias("n"),
        F.sum(legal).alias("legal"))
    close = F.get(F.array(*[F.lit(x) for x in CLOSE]), F.element_at("parts.end", -1))
    seams = F.zip_with(F.slice("parts.tail", 1, F.greatest(F.size("parts") - 1, F.lit(0))), F.expr("slice(parts.head, 2, size(parts))"), lambda x, y: F.concat(x, y))
    seam = F.size(F.filter(seams, lambda s: s.isin("su", "ua", "au")))
    facts = parts.select(
        "conv", "blank", "duplicate", "truncated", (F.col("n") - 1 - F.col("legal") - seam).alias("illegal"),
        (F.col("cost") + INSERT * F.length(close)).alias("cost"), F.concat(F.array_join("parts.audit", ""), close).alias("audit"))
    spans = placed.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    every = turns.select("conv").distinct().join(spans, "conv", "left").join(facts, "conv", "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    heads = every.select("conv", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
                         F.coalesce("audit", F.lit("")).alias("audit"), F.lit(0).alias("kind"))
    both = bounded_batches(heads.unionByName(rows.withColumn("kind", F.lit(1)), allowMissingColumns=True))
    stream = both.repartition("conv").sortWithinPartitions("conv", "kind", *ORDER[1:]).select("conv", *numbers, "audit", "role", "text")
    return stream.mapInArrow(_hash_texts, f"conv string, {FACTS}, repaired_sha256 string")


def repair_conversations(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """Damage and repair of every conversation: ``conv``, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256.

    NULL roles and texts count as one space; NULL turns come first and don't count for gaps; rows with a NULL
    id are one conversation.  Repeated rows are duplicates.  Other columns, whatever their names, play no
    part.  No rows give an empty result.
    """
    kind = turns.schema[conv].dataType
    every = turns.select(F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit("")).alias("conv"))
    found = repair_turns(every, damage(turns, conv, turn, role, text))
    id = F.when(F.col("conv") != "", F.substring("conv", 2, 1 << 30))
    return found.select((id if isinstance(kind, StringType) else id.cast(kind)).alias(conv), *found.columns[1:])
