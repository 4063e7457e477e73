"""Token files: Parquet with a list column of token ids, in the order of the documents.

Ids and texts: one row per document, sorted by `doc_id` across and within files. Token ids are
dictionary-encoded (bit-packed indices), document ids and sizes delta-encoded, row groups bounded, and page
indexes written, so a reader that wants a few documents or only the sizes reads a few pages.

Null texts are empty and give the end id only. Repeated rows and repeated ids are kept, each as a
row. Empty tables give files without rows. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import arrow_rows, map_batches, materialize, partitions, running_total
from holdfast.llm.words import encoder

#: Documents that a task encodes or checks at once.
ROWS = 1500

SCHEMA = "doc_id long, n_tokens long, tokens array<int>"

LAYOUT = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "1",  # bit-packed ids hardly gain from more
    "parquet.writer.version": "v2",  # delta encoding where a column has no dictionary
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(doc_id, n_tokens, tokens): the ids of each whole text, and `end_id` after them."""

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, ends = encoder(tokenizer).encode(batch.column("text"))
        ids = np.insert(ids, ends, end_id)
        ends = ends + np.arange(1, len(ends) + 1)
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        tokens = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.view(np.int32)))
        sizes = pa.array(np.diff(offsets).astype(np.int64))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), sizes, tokens], ["doc_id", "n_tokens", "tokens"])

    return map_batches(docs.select("doc_id", "text"), encode, SCHEMA, rows=ROWS)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Encode `docs` (doc_id, text) into token files below `path`.

    The texts are range-partitioned and sorted by doc_id first (the sampling pass reads that column
    alone), and each task encodes its range as a stream of batches. Rows that share an id, or have none, are dealt on
    by their number in the scan, so that they fill several ranges if they are many.
    """
    n, order = partitions(docs.sparkSession), ["doc_id", "_at"]
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("_at"))
    ordered = rows.repartitionByRange(n, *order).sortWithinPartitions(*order)
    with arrow_rows(docs.sparkSession, ROWS):
        encode_documents(ordered, tokenizer, end_id).write.options(**LAYOUT).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, n_tokens, tokens). Select only what is needed: columns and pages are read selectively."""
    return spark.read.schema(SCHEMA).parquet(path)


def token_checksums(files: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32) from the stored ids as little-endian unsigned 32-bit integers."""

    def checksum(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens = batch.column("tokens")
        raw = memoryview(tokens.values.to_numpy().astype("<u4")).cast("B")
        bounds = (tokens.offsets.to_numpy().astype(np.int64) * 4).tolist()
        sums = [zlib.crc32(raw[a:b]) for a, b in zip(bounds, bounds[1:])]
        columns = [batch.column("doc_id"), pa.array(np.diff(bounds) // 4, pa.int64()), pa.array(sums, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_crc32"])

    return map_batches(files.select("doc_id", "tokens"), checksum, "doc_id long, n_tokens long, ids_crc32 long", rows=ROWS)


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) read back from token files.

    `start` counts the ids of all documents before. Rows that share a doc_id follow by checksum.
    """
    with arrow_rows(spark, ROWS):
        sums = materialize(token_checksums(read_token_files(spark, path)))
    return running_total(sums, ["doc_id", "ids_crc32"], "n_tokens", "start").select(
        "doc_id", "start", "n_tokens", "ids_crc32"
    )
