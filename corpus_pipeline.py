"""Corpus pipeline: language ID, near-dedup, secret redaction, mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet and read again as the next stage's documents.  All but
the last return the columns of ``documents``.

1. language: documents that the language classifier rejects go.
2. near_dedup: one document of each class of near copies stays.
3. secrets: spans that a rule finds are replaced by a mark; all rows stay.
4. mixing: every document is repeated as often as its fitted rate says
   (0 times for what the targets leave out); clean text keeps a rate of
   about 1 or more under the targets.
5. bpe: token ids, and the text they decode to.

Edge cases.  Every stage accepts NULLs in any column, empty tables and
repeated rows, and behaves as its operator's module says; a NULL or
letterless text is rejected by stage 1.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortalloc.llm import bpe_chunks, language_id, order_minhash, secret_scan, soft_mixing
from cohortalloc.llm.common import materialise, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_known(docs, language_id.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return order_minhash.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labelled = soft_mixing.label_domain(table(spark, sf_dir, "labels"))
    return soft_mixing.mix(docs, labelled, soft_mixing.TARGETS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    files = [public_tokenizers.path(f"byte_bpe_50k.{kind}") for kind in ("json", "tiktoken")]
    encoded = bpe_chunks.encode_texts(docs, *files, decode=True)
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("secrets", secrets),
    ("mixing", mixing),
    ("bpe", bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


#: Classifiers, alignment and iterative fits have no SQL form; tests compare with brute force.
ORACLE_SQL = None
