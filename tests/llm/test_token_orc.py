"""Token ids in ORC beside a whole-text encoding by the library."""

import random
import sys
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from frames import no_documents, odd_documents  # noqa: E402

from millrace.llm import token_orc  # noqa: E402
from millrace.llm.registry import QUERIES  # noqa: E402
from millrace.session import load, work_path  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def whole(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_words_give_the_ids_of_whole_texts(tokenizer):
    rng = random.Random(5)
    alphabet = "aZ é\u0301ßİſΣς.,'!?s1٣ \n\t\u00a0日🙂ÀÿØ×÷<|>endoftxŉ"
    words = token_orc.WordIds(PATH, most=50)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    texts += ["<|endoftext|>", "a<|endoftext|>b", "<|ENDOFTEXT|>", "don't. I'LL, we're! it's.", "Élan. Ça, ÀÉ!", "..", "a.", "é."]
    ids, ends = words.encode([t.encode() for t in texts], 1)
    for text, a, b in zip(texts, ends[:-1], ends[1:]):
        assert ids[a:b].tolist() == whole(tokenizer, text), text


def test_query_over_the_table(spark, data, tokenizer):
    got = QUERIES["op1_token_orc"](spark, data).orderBy("doc_id").collect()
    docs = load(spark, data, "documents").orderBy("doc_id").collect()
    start = 0
    assert len(got) == len(docs)
    for row, doc in zip(got, docs):
        ids = whole(tokenizer, doc["text"])
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (doc["doc_id"], start, len(ids), crc(ids))
        start += len(ids)


def test_odd_rows(spark, tokenizer):
    out = work_path(spark, "tokens")
    token_orc.write_tokens(odd_documents(spark), out, PATH)
    rows = token_orc.with_starts(token_orc.read_tokens(spark, out)).collect()
    docs = odd_documents(spark).collect()
    assert len(rows) == len(docs)
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    want = sorted(((d["doc_id"], whole(tokenizer, d["text"])) for d in docs), key=key)
    got = sorted(((r["doc_id"], list(r["ids"])) for r in rows), key=key)
    assert got == want
    in_order = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] is not None for r in in_order] == sorted(r["doc_id"] is not None for r in rows)
    numbered = [r["doc_id"] for r in in_order if r["doc_id"] is not None]
    assert numbered == sorted(numbered)
    ends = np.cumsum([r["n_tokens"] for r in in_order])
    assert [r["start"] for r in in_order] == [0, *ends[:-1].tolist()]


def test_filters_on_ids_reach_the_files(spark, data):
    out = work_path(spark, "tokens")
    token_orc.write_tokens(load(spark, data, "documents"), out, PATH)
    one = token_orc.read_tokens(spark, out).where("doc_id = 17").select("n_tokens")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,17)" in plan and "ids" not in plan.split("ReadSchema")[1].split("\n")[0]
    assert one.count() == 1


def test_no_rows(spark):
    out = work_path(spark, "tokens")
    token_orc.write_tokens(no_documents(spark), out, PATH)
    assert token_orc.with_starts(token_orc.read_tokens(spark, out)).count() == 0
