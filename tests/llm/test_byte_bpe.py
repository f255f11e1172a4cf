"""Byte-level BPE beside the library over whole texts and beside merges done by hand."""

import base64
import sys
from pathlib import Path

import public_tokenizers
import pytest
import regex

sys.path.insert(0, str(Path(__file__).parent))
from frames import no_documents, odd_documents  # noqa: E402

from millrace.llm import byte_bpe  # noqa: E402
from millrace.llm.registry import QUERIES  # noqa: E402
from millrace.session import load  # noqa: E402

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.encoding(RANKS, PATTERN)


def by_hand(text):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    out = []
    for piece in regex.findall(PATTERN, text):
        parts = [bytes([b]) for b in piece.encode()]
        while len(parts) > 1:
            pairs = [(ranks.get(a + b, 1 << 60), k) for k, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, k = min(pairs)
            if rank == 1 << 60:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        out += [ranks[p] for p in parts]
    return out


@pytest.mark.parametrize("text", [
    "", " ", "Hello world, it's 2024!  Two  spaces\n\n and lines", "  \n x\t\ty ", "ünï日本🙂 x" * 20, "we'll 'S don't",
    "<|endoftext|>", "word " * 300, "\u00a0\u2003 x  \r\n y",
])
def test_pieces_and_merges(encoder, text):
    want = by_hand(text)
    assert encoder.encode_ordinary(text) == want
    for most in (1, 7, 50):
        assert "".join(byte_bpe.pieces(text, most)) == text
        assert byte_bpe.encode_text(encoder, text, most).tolist() == want


def test_query_over_the_table(spark, data, encoder):
    import hashlib

    docs = {r["doc_id"]: r["text"] for r in load(spark, data, "documents").collect()}
    rows = QUERIES["op7_byte_bpe"](spark, data).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        text = docs[r["doc_id"]] or ""
        ids = encoder.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_odd_rows(spark):
    docs = odd_documents(spark)
    coded = byte_bpe.decode(byte_bpe.encode(docs, RANKS, PATTERN, piece_chars=500), RANKS, PATTERN)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    got = sorted(((r["doc_id"], bytes(r["bytes"])) for r in coded.collect()), key=key)
    assert got == sorted(((r["doc_id"], (r["text"] or "").encode()) for r in docs.collect()), key=key)
    assert byte_bpe.decode(byte_bpe.encode(no_documents(spark), RANKS, PATTERN), RANKS, PATTERN).count() == 0


def test_raw_bytes(spark):
    half = spark.createDataFrame([(1, [232, 98]), (2, None), (3, [])], "doc_id long, ids array<int>")
    ranks = {int(b): base64.b64decode(a) for a, b in map(bytes.split, open(RANKS, "rb"))}
    rows = {r["doc_id"]: bytes(r["bytes"]) for r in byte_bpe.decode(half, RANKS, PATTERN).collect()}
    assert rows == {1: ranks[232] + ranks[98], 2: b"", 3: b""}


def test_white_space_past_the_pattern(encoder):
    """Runs that go around the pattern give what the pattern gives, wherever they are."""
    import random

    rng = random.Random(4)
    for _ in range(400):
        text = "".join(rng.choice(["a", "Wort", "'s", "1", "%%", " ", " ", "  ", "\n", "\t", " ", " ", "\x1c", "　　"])
                       for _ in range(rng.randint(0, 25)))
        for white in (2, 3, 6):
            assert byte_bpe.encode_text(encoder, text, 20, white).tolist() == encoder.encode_ordinary(text), repr(text)


@pytest.mark.parametrize("run", [" " * 3_000_000, "\n" * 3_000_000, " \n\t" * 1_000_000])
@pytest.mark.parametrize("text", ["a{}b", "{}b", "a{}", "a{} b  c"])
def test_very_long_white_space(encoder, run, text):
    whole = text.format(run)
    ids = byte_bpe.encode_text(encoder, whole, 100_000)
    assert encoder.decode_bytes(ids.tolist()) == whole.encode()
    short = text.format(run[: 3 * 40])
    assert byte_bpe.encode_text(encoder, short, 100_000, 50).tolist() == encoder.encode_ordinary(short)
