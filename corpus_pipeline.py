"""Corpus pipeline: quality rules, toxicity, near-dedup, secret scans, packing over `documents`.

Every stage reads all that its predecessor kept and returns the columns of documents, but for the last, which
returns packed pieces. Quality and toxicity drop what they reject, near-dedup keeps one document of each
group, secret scans mask credentials that are no widely copied examples, packing fills windows with token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftline.llm import neardup, packing, quality, secrets, toxicity
from driftline.llm.common import documents, stored

#: Hundredths of the 5-word shingles of two documents from which on they are near copies; op3 has its own contract.
NEAR = 80


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current quality policy keeps."""
    return quality.keep_good(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier fitted on the labelled ones among them does not call toxic."""
    model = toxicity.train(docs.select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_clean(docs, model)


def neardup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies, alike to NEAR hundredths or more."""
    return neardup.keep_one(docs, numerator=NEAR)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking credentials masked and n_chars brought up to date."""
    masked = secrets.masked(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, with the digest of their ids beside them."""
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", quality_stage),
    ("toxicity", toxicity_stage),
    ("neardup", neardup_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]

#: Tokenizers, the classifier and the signatures have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
