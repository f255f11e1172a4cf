"""The stages of the pipeline, each beside its operator, and their effect on planted documents."""

import random
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
from frames import no_documents, odd_documents, prose  # noqa: E402

import corpus_pipeline  # noqa: E402
from millrace.session import load, work_path  # noqa: E402


def test_order_of_the_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "ngram_join", "mixing", "byte_bpe"]


def test_run(spark, data):
    rows = corpus_pipeline.run(spark, data).collect()
    texts = {r["doc_id"]: r["text"] for r in load(spark, data, "documents").collect()}
    import hashlib

    assert rows
    for r in rows:
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
        assert r["n_tokens"] == len(r["ids"])


def test_planted_documents(spark, data):
    """Junk and near copies go, clean documents reach the mix."""
    rng = random.Random(12)
    clean = [(10_000 + k, prose(rng, rng.randint(60, 200)), "en", "plants", 0) for k in range(60)]
    copies = [(20_000 + k, t + " end", "en", "plants", 0) for k, (_, t, *_) in enumerate(clean[:20])]
    junk = [(30_000 + k, " ".join(w + "%%%" for w in prose(rng, 80).split()), "en", "plants", 0) for k in range(5)]
    junk += [(31_000 + k, (prose(rng, 12) + " ") * 12, "en", "plants", 0) for k in range(5)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = load(spark, data, "documents").select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        spark.createDataFrame([*clean, *copies, *junk], schema))
    for name, stage in corpus_pipeline.STAGES[:3]:
        path = work_path(spark, name)
        stage(spark, docs, data).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.dtypes == docs.dtypes and 0 < kept.count() < docs.count(), name
        assert kept.exceptAll(docs).isEmpty(), name
        docs = kept
    mixed = corpus_pipeline.STAGES[3][1](spark, docs, data)
    assert mixed.dtypes == docs.dtypes and mixed.subtract(docs).isEmpty()
    assert mixed.groupBy("doc_id").count().where("count > 3").isEmpty()
    left = {r["doc_id"] for r in docs.where("doc_id >= 10000").select("doc_id").collect()}
    assert not left & {j[0] for j in junk} and not left & {c[0] for c in copies}
    assert len(left & {c[0] for c in clean}) >= 58


def test_odd_rows(spark, data):
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns, name
        out.collect()
        assert stage(spark, no_documents(spark), data).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, data).count() == docs.count()
    assert corpus_pipeline.STAGES[-1][1](spark, no_documents(spark), data).count() == 0
