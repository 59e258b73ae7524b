"""From raw documents to packed training sequences.

Each stage works on all that its predecessor kept and is written and read again
before the next. All but the last return the columns of ``documents``.

Odd rows: a repeated row is a document of its own until near-duplicate detection,
which keeps one document of a group; rows without id count as one group's member
like any other. Missing texts are empty; an empty table stays empty through all
stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverload.llm import decontaminate, line_dedup, packing, quality, simhash
from riverload.llm.queries import GOOD_FROM, bpe_path, table
from riverload.stages import Stages


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field takes for good; it learns from the labels of those at hand."""
    field = quality.fit_field(docs, quality.train_rows(table(spark, sf_dir, "labels")))
    return docs.where(quality.quality_score("text", field) >= GOOD_FROM)


def shared_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten sites share; ``n_chars`` follows the text.

    Documents that are shared lines for their greater part are copies: the next stage
    keeps one of each group, so their text has to be there still. Lines of less than
    20 characters say too little to be taken for boilerplate.
    """
    cleaned = line_dedup.drop_shared_lines(docs, min_chars=20, copy_share=0.5)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("removed_lines") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cleaned.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest id."""
    return simhash.keep_one(docs, words=3, bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no test item stands."""
    return docs.where(F.size(decontaminate.leaks("text", table(spark, sf_dir, "benchmark"))) == 0)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces of all documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, packing.Encoder, bpe_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", shared_line_dedup),
    ("simhash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: A fitted field, fingerprints and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next."""
    stages = Stages(spark, "corpus")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stages.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
