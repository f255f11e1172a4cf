"""Conversation repair beside an exhaustive search, with windows of every size."""

import hashlib
import random
import zlib
from functools import cache

import pytest

from millrace.llm import turn_repair
from millrace.llm.registry import QUERIES
from millrace.session import load

WHITE = " \t\n\v\f\r"


def damaged(rows):
    """Rows (conv, turn, role, text) of each conversation after damage, in order."""
    out = {}
    for conv, turn, role, text in rows:
        out.setdefault(conv, [])
        shown = lambda x: " " if x is None else str(x)
        fate = zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if fate == 0:
            continue
        if fate == 1:
            text = ""
        if fate == 2:
            text = "".join(c for c in text if c not in ".!?")
        if fate == 4:
            role = "user"
        out[conv] += [(turn, role, text)] * (2 if fate == 3 else 1)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest())
    return {c: sorted(r, key=key) for c, r in out.items()}


def repaired(turns):
    """Everything about one conversation, with the cheapest audit by search over (place, last letter)."""
    seen, faults = set(), []
    for _, role, text in turns:
        bare = text.strip(WHITE)
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "-")
        seen.add((role, text))
    follows = {("", "u"), ("", "s"), ("s", "u"), ("u", "a"), ("a", "u")}

    @cache
    def best(i, last, inserted):
        options = [(0, "", ())] if i == len(turns) and last in ("", "a") else []
        if inserted < 3:
            for c in "ua":
                if (last, c) in follows:
                    cost, audit, text = best(i, c, inserted + 1)
                    options.append((cost + 3, "I" + audit, (("user:" if c == "u" else "assistant:"), *text)))
        if i < len(turns):
            _, role, text = turns[i]
            cost, audit, rest = best(i + 1, last, 0)
            options.append((cost + 4, "D" + audit, rest))
            if faults[i] not in "bd":
                more = 3 if faults[i] == "t" else 0
                for edit, price, as_ in (("K", 0, role), ("R", 3, "user"), ("R", 3, "assistant")):
                    if (last, as_[:1]) in follows:
                        cost, audit, rest = best(i + 1, as_[:1], 0)
                        options.append((cost + price + more, edit + audit, (f"{as_}:{text}", *rest)))
        return min(options) if options else (10**9, "", ())

    cost, audit, text = best(0, "", 0)
    numbers = [t for t, *_ in turns if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(turns, turns[1:])]
    return (
        max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0,
        faults.count("b"), faults.count("d"), faults.count("t"), sum(p not in ("su", "ua", "au") for p in pairs),
        cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest())


def brute(rows):
    return sorted(((c, *repaired(turns)) for c, turns in damaged(rows).items()), key=repr)


def result(df):
    return sorted(map(tuple, df.collect()), key=repr)


def conversations(seed, n):
    rng = random.Random(seed)
    texts = ["Fine.", "Why?", "no end", "", " \t", "Good! ", "x", "Done.\n", "é?"]
    rows = []
    for conv in range(n):
        for turn in range(rng.choice([1, 2, 3, 5, 8, 13])):
            if rng.random() < 0.1:
                continue
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv if conv % 17 else None, turn if rng.random() < 0.9 else None, role, rng.choice([*texts, None])))
            if rng.random() < 0.1:
                rows.append(rows[-1])
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def test_align_against_search():
    """One window, every pair of states, all codes of up to four turns."""
    from itertools import product

    letters = {"u": ("user", "-"), "a": ("assistant", "-"), "s": ("system", "-"), "x": ("tool", "-"), "U": ("user", "t"), "d": ("user", "b")}
    for n in range(1, 5):
        for code in product(letters, repeat=n):
            found = turn_repair.align("".join(code))
            costs = [x[0] if x else turn_repair.FAR for x in found]
            rank = turn_repair.ranks([x[1] if x else None for x in found])
            end = turn_repair.ending(costs, rank)
            got = (costs[end] + 3 * len(turn_repair.CLOSE[end]), found[end][1] + turn_repair.CLOSE[end])
            turns = [(k, letters[c][0], {"-": f"{k}.", "t": f"{k}", "b": ""}[letters[c][1]]) for k, c in enumerate(code)]
            assert got == repaired(turns)[5:7], code


@pytest.mark.parametrize("window,fan,parts", [(256, 256, 3), (3, 2, 3), (1, 3, 8)])
def test_against_search(spark, monkeypatch, window, fan, parts):
    monkeypatch.setattr(turn_repair, "WINDOW", window)
    monkeypatch.setattr(turn_repair, "FAN", fan)
    rows = conversations(window, 150)
    rows += [(10_001, k, random.Random(k).choice(["user", "assistant", "system"]), f"turn {k % 50}.") for k in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    assert result(turn_repair.repair_conversations(df)) == brute(rows)


def test_query_over_the_table(spark, data):
    rows = [tuple(r) for r in load(spark, data, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert result(QUERIES["op13_turn_repair"](spark, data)) == brute(rows)


def test_odd_rows(spark):
    """NULLs in every column, long texts, extra columns with names used inside, ids that are strings, no rows."""
    rows = [(None, None, None, None), ("a", 1, "user", "x" * 300_000), ("a", None, "assistant", "?" + " " * 100_000), ("=", 1, "user", "Hi."),
            ("", 7, "system", "S."), ("b", 2, "user", "Ok.\x00."), ("b", 2, "assistant", "Ok."), ("b", 2, "user", "Ok.\x00.")]
    clash = "pos long, seg long, digest string, audit string, conv string, kind int"
    df = spark.createDataFrame([(*r, 1, 2, "d", "K", "c", 0) for r in rows], f"conv_id string, turn long, role string, text string, {clash}")
    assert result(turn_repair.repair_conversations(df)) == brute(rows)
    empty = turn_repair.repair_conversations(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert empty.count() == 0
