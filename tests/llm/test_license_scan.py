"""Licence scan beside a plain search of every template at every place."""

import math
import random
import re
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from frames import no_documents, odd_documents, prose  # noqa: E402

from millrace.llm import license_scan  # noqa: E402
from millrace.llm.registry import QUERIES  # noqa: E402
from millrace.session import load  # noqa: E402

UPPER = {ord(a): a.lower() for a in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def places(words, phrase):
    parts = phrase.split()
    return [i for i in range(len(words) - len(parts) + 1) if words[i : i + len(parts)] == parts]


def brute(docs, templates=license_scan.TEMPLATES, base=license_scan.BASE, need=0.75, slack=2):
    texts = [(i, words_of(t)) for i, t in docs]
    held = [set(w) for _, w in texts]
    known = {}

    def weight(word):
        if word not in known:
            known[word] = math.log((len(docs) + 1) / (sum(word in h for h in held) + 1)) + 1
        return known[word]

    out = []
    for (i, words), has in zip(texts, held):
        base_at = [(p, label) for phrase, label in base for p in places(words, phrase)]
        own, share = {label for _, label in base_at}, 0.0
        labels = set(own)
        for t in templates:
            content = [(k, w) for k, w in enumerate(t.text.split()) if w not in license_scan.STOP]
            mass = sum(weight(w) for _, w in content)
            if sum(weight(w) for _, w in content if w in has) < need * mass * (1 - 1e-9):
                continue
            for at in range(-len(t.text), len(words) + slack + 1):
                found = sum(weight(w) for k, w in content if w in words[max(0, at + k - slack) : max(0, at + k + 1)])
                if found < need * mass * (1 - 1e-9):
                    continue
                end = at + len(t.text.split()) + slack
                if all(any(at - slack - 1 <= p <= end for p in places(words, phrase)) for phrase in t.key):
                    labels.add(t.label)
                    share = max(share, min(1.0, found / mass))
        at = [p for p, _ in base_at]
        out.append((i, len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(own)),
                    ",".join(sorted(labels)), 1.0 if own else round(share, 6)))
    return sorted(out, key=repr)


def result(df):
    return sorted(((*r[:-1], round(r[-1], 6)) for r in df.collect()), key=repr)


def planted(seed):
    rng = random.Random(seed)
    docs = []
    for k in range(160):
        parts = [prose(rng, rng.randint(0, 30))]
        for _ in range(rng.randint(0, 2)):
            t = rng.choice(license_scan.TEMPLATES)
            words = t.text.split()
            for _ in range(rng.choice([0, 0, 0, 1, 2, 4])):
                at = rng.randrange(len(words))
                if rng.random() < 0.5:
                    words.insert(at, rng.choice(["very", "license", "software"]))
                else:
                    words[at] = "other"
            parts.append(rng.choice([" ", "-", ", ", "\n"]).join(words))
            parts.append(prose(rng, rng.randint(0, 10)))
        docs.append((k, "\n".join(parts)))
    docs += [(900, "All Rights Reserved. all rights, reserved; CC-BY cc by"), (901, "general public licenses"), (902, "all rights"),
             (903, "license " * 300), (904, "mit licenKe mit LICENSE released under"), (905, "ccé by"), (906, "İ all rights reserved")]
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_search(spark, seed):
    docs = planted(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = license_scan.scan_licenses(df)
    assert got.columns == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    want = brute(docs)
    assert result(got) == want
    assert len({r[6] for r in want}) > 10


def test_query_over_the_table(spark, data):
    docs = [tuple(r) for r in load(spark, data, "documents").select("doc_id", "text").collect()]
    got = result(QUERIES["op11_license_scan"](spark, data))
    assert got == brute(docs)
    found = {label for r in got for label in r[6].split(",")}
    assert {"mit", "apache-2.0", "cc-by-nc"} <= found


def test_odd_rows(spark):
    df = odd_documents(spark)
    docs = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert result(license_scan.scan_licenses(df)) == brute(docs)
    assert result(license_scan.scan_licenses(no_documents(spark))) == []


def test_no_python_in_the_plan(spark, data):
    plan = QUERIES["op11_license_scan"](spark, data)._jdf.queryExecution().toString()
    assert not re.search(r"Python|Pandas|Arrow", plan)
