"""A training corpus from ``documents``: quality, near-duplicates, personal data, mixture, packing.

Each stage takes all rows that the one before kept, is written as Parquet and read again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import mixing, packing, pii, quality, simhash
from ledgerline.llm.base import prepare, table, unused
from ledgerline.llm.queries import KEEP_SCORE, labelled_languages, tokenizer_path
from ledgerline.session import ensure_checkpoint_dir


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier doesn't reject."""
    prepare(spark)
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    out = unused(docs, "_score")
    return quality.score_quality(docs, model, out=out).where(f"{out} >= {KEEP_SCORE}").drop(out)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-copies."""
    prepare(spark)
    return simhash.keep_one_per_component(docs, shingle=3, max_bits=3)


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind."""
    prepare(spark)
    return pii.mask_pii(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated to the target language shares; no document is lost (rates of 1 or more)."""
    prepare(spark)
    mix, _ = mixing.fit_mixture(docs, labelled_languages(spark, sf_dir, docs), keep_all=True)
    return mixing.mix_rows(docs, mix)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all rows in sequences of at most 4096 tokens."""
    prepare(spark)
    return packing.pack(docs, tokenizer_path(), capacity=4096)


STAGES = [("quality", good_quality), ("near_dedup", one_of_each), ("pii", without_pii), ("mixing", mixed),
          ("packing", packed)]

#: SQL can't express the classifier, the field or the packing: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; what each returns is a Parquet folder under the shared
    checkpoint folder, left there for the caller to reread or remove."""
    prepare(spark)
    root = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex[:12]}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
