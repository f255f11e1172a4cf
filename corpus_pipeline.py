"""From raw documents to token ids: the stages of a training-data pipeline, each an operator of millrace.llm.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read
again as the next one's ``docs``.  All but the last return the columns of documents.

Defined results: NULL and empty texts fail the plain rules and go in the first stage; a NULL language or source is a
group of its own; repeated rows are judged alike by the first two stages and leave one row in the third; in the third
ties go by id (NULL last), then by hashes of text and row; extra columns, whatever their names, stay as they are until
the last stage.  Texts are read whole, however long.  No rows give an empty result in every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import byte_bpe, mixing, ngram_join, outliers, site_quality
from millrace.llm.common import store
from millrace.session import load, prepare


def _wrapped(docs: DataFrame) -> DataFrame:
    """Rows in one column beside those that an operator reads, so that results can't clash with them."""
    return docs.select(F.struct("*").alias("whole"), "doc_id", "text", "lang", "source")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the plain rules nor lie outside what their language and source have."""
    judged = outliers.reject_outliers(_wrapped(docs), keep=["whole"], store_rows=False)
    return judged.where("kept").select("whole.*")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are probably of good quality and not toxic, given their text, source and language."""
    labels = load(spark, sf_dir, "labels")
    judged = site_quality.classify(_wrapped(docs), labels, keep=["whole"], store_rows=False)
    return judged.where("kept").select("whole.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that with the smallest id, of each group that 0.75 similar 5-word shingles link; rows without words stay."""
    return ngram_join.drop_near_copies(docs, percent=75, width=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 5, 2, 1, repeating: a row for every copy of a document."""
    return mixing.apply_mix(docs, mixing.mix_sources(docs, weights=(5, 2, 1), cap=3))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id and the byte-level BPE ids of every row, checked by decoding them again."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    coded = byte_bpe.decode(byte_bpe.encode(docs, ranks, pattern), ranks, pattern)
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_rules", quality_rules), ("quality_classifier", quality_classifier), ("ngram_join", near_copies),
    ("mixing", mix), ("byte_bpe", encode),
]

#: No SQL expresses robust covariances, model fits and Newton iterations; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the table documents."""
    docs = load(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
