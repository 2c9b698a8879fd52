"""A corpus from raw documents to packed sequences, in five stages.

Each stage reads what the one before has kept, as a table, and returns the columns of documents,
except the last, which returns the packed pieces. ``run`` writes each stage to the shared folder
named by ``spark.checkpoint.dir`` and reads it again, so a lost executor costs no earlier stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import mixing, packing, pii, simhash, toxicity
from ledgerlens.llm.common import shared_folder, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, trained on the labelled ones, does not reject."""
    return toxicity.keep_harmless(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (fingerprints linked at 4 bits or fewer, shingles of four words)
    the document with the smallest id."""
    return simhash.keep_one(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the mask of its kind."""
    return pii.redact(docs, pii.fit(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that mixes their sources to the target weights."""
    return mixing.in_mixed_order(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in the sequences, which follow the mixed order."""
    return packing.pack(docs, packing.tokenizer_path(), in_order=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_copies),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Models, similarity groups and tokens: no stage but the mixing order could be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = f"{folder}/{name}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
