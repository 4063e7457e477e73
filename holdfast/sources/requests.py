"""Scoring requests and responses as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast import values

REQUEST_SCHEMA = "request_id bigint, content_type string, value string"

#: Where a line comes from, as columns of a text scan or stream.
FILE, BLOCK = "_file", "_block"


def with_places(lines: DataFrame) -> DataFrame:
    """Lines of a text scan or stream with their file and the block of it that they were read from."""
    return lines.select("value", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))


def number_lines(lines: DataFrame) -> DataFrame:
    """Requests from text lines: JSON by contract, with ids that depend on file and line alone.

    An id is a hash of the file's path, the line and, where a file has a line several times, the number of the copy;
    copies are alike, so any order of them gives the same requests. How files are split, or dealt to the
    batches of a stream, changes nothing. Only lines that occur again are numbered, block by block, the others stay
    where they are. Two of n lines share an id by chance with n * n / 2**65, and then get an answer each.
    """
    placed = lines if FILE in lines.columns else lines.withColumns({FILE: F.lit(""), BLOCK: F.spark_partition_id()})
    hashed = placed.withColumn("_hash", F.xxhash64(FILE, "value"))
    counts = hashed.groupBy("_hash", BLOCK).agg(F.count(F.lit(1)).alias("n"))
    blocks = Window.partitionBy("_hash")  # as many rows as a file has blocks
    earlier = blocks.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    repeated = counts.select(
        "_hash", BLOCK, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"), F.sum("n").over(blocks).alias("all")
    ).where(F.col("all") > 1)
    single = hashed.join(repeated.select("_hash"), "_hash", "left_anti").withColumn("copy", F.lit(1).cast("bigint"))
    within = F.row_number().over(Window.partitionBy("_hash", BLOCK).orderBy(F.lit(0)))
    again = hashed.join(repeated, ["_hash", BLOCK]).withColumn("copy", F.col("before") + within)
    numbered = single.select("_hash", "copy", "value").unionByName(again.select("_hash", "copy", "value"))
    return numbered.select(
        F.xxhash64("_hash", "copy").alias("request_id"),
        F.lit(values.JSON_TYPE).alias("content_type"),
        "value",
    )


def scan_requests(spark: SparkSession, path: str, format: str = "text") -> DataFrame:
    """(request_id, content_type, value), from text lines or from files with those columns."""
    if format == "text":
        return number_lines(with_places(spark.read.text(path)))
    return spark.read.schema(REQUEST_SCHEMA).format(format).load(path)


def stream_requests(
    spark: SparkSession, path: str, format: str = "text", files_per_batch: int = 1000
) -> DataFrame:
    """New request files as a stream. Text lines keep their places, of which `score_stream` makes their ids."""
    reader = spark.readStream.option("maxFilesPerTrigger", files_per_batch)
    if format == "text":
        return with_places(reader.text(path))
    return reader.schema(REQUEST_SCHEMA).format(format).load(path)


def write_responses(responses: DataFrame, path: str) -> None:
    """One JSON text per response."""
    text = F.to_json(F.struct("request_id", "status", "body"))
    responses.select(text.alias("value")).write.mode("overwrite").text(path)
