"""From raw documents to packed training sequences, in five stages.

Every stage is written as Parquet and read again by the next. All but the last return the columns of
`documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import exact_dedup, packing, pii, quality, simhash
from holdfast.runtime import scratch, scratch_path

END_ID = 1
LENGTH = 2048


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking does not reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near fingerprints."""
    return simhash.keep_one(docs, words=3, radius=3)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked, and n_chars of the masked text."""
    masked = pii.mask(docs, pii.train(docs))
    if "n_chars" not in masked.columns:
        return masked
    length = F.coalesce(F.char_length("text").cast(masked.schema["n_chars"].dataType), "n_chars")
    return masked.withColumn("n_chars", length)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, with their ids as little-endian unsigned 32-bit integers."""
    pieces = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID, LENGTH)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality", drop_poor),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: Trained and hashed stages cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
