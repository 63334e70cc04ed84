"""Corpus pipeline: toxic documents go, then exact copies, then near copies; sources are mixed and texts encoded.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept, and returns a DataFrame. Rows meet the
decisions of an operator by id and hashes of the text; a decision table goes to all tasks only if a count shows that it is
small.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import exact_dedup, mixing, pieces, simhash, toxicity
from tarmac.plans.shipping import ship_package
from tarmac.plans.storage import stage_path

def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows predicted toxic go. The model learns from the labelled rows of the stage's own input."""
    ship_package(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays, by the rule of the operator."""
    ship_package(spark)
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the row with the smallest id stays."""
    ship_package(spark)
    return simhash.without_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents as often as the mix takes them, in the order of their positions in training."""
    ship_package(spark)
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every row, as digests beside the id."""
    ship_package(spark)
    return pieces.encode_decode_digest(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

#: The stages hold a fitted model and 64-bit hashes that the checking engine lacks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = stage_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
