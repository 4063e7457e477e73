"""Exact duplicates by a content sort, in DataFrame operations only.

Texts are equal when they are the same after each run of white space became one space. Rows are
range-partitioned by the first bytes of that text, its hash and a salt, with splitters that Spark
samples; sorted within partitions, so that equal texts are neighbours; and compared whole with
their neighbours, where the smallest doc_id of a run stays.

A text that many rows share is salted by the number of the row, so that no task gets more than about a quarter of a
partition's rows of it, whatever their ids. Its runs are joined up by an aggregate over its rows alone, with map-side combine; at
most four texts per partition can be that frequent, which bounds the broadcast.

Null texts equal empty ones. Of rows that repeat the smallest doc_id the first one stays; a null doc_id
stays only where no other is in the group. Row numbers are those of a scan, so `docs` must be read in the same order
each time, as a stored table is. An empty table gives an empty one. Other columns are
carried along, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import partitions

WHITE = r"[\x20\x09-\x0D]+"
PREFIX = 32


def normalized(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " ")


def sorted_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row: the input row, keep_id, group_size, kept, text_sha256), one per row of `docs`."""
    n = partitions(docs.sparkSession)
    frequent = max(50, docs.count() // (4 * n))
    rows = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("at"))
    # Rows of a group stay in the order of this: ids first, then the row's number.
    rank = F.struct(F.col("row")[id].isNull().alias("absent"), F.col("row")[id].alias("id"), "at")
    content = normalized(F.col("row")[text])
    hashed = rows.withColumn("hash", F.xxhash64(content))
    counts = hashed.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > frequent)
    salts = F.broadcast(counts.select("hash", F.ceil(F.col("n") / frequent).cast("int").alias("salts")))

    # Frequent texts: their runs come together in one row each.
    totals = (
        hashed.join(salts, "hash")
        .groupBy(content.alias("content"))
        .agg(F.min(rank).alias("least"), F.count(F.lit(1)).alias("rows"))
        .select(F.sha2("content", 256).alias("text_sha256"), "least", "rows")
    )

    salt = F.pmod(F.xxhash64("at"), F.coalesce("salts", F.lit(1)))
    ranged = (
        hashed.join(salts, "hash", "left")
        .select("row", "at", F.substring(content, 1, PREFIX).alias("prefix"), "hash", salt.alias("salt"))
        .repartitionByRange(n, "prefix", "hash", "salt")
        .withColumn("content", content)
    )
    whole = Window.partitionBy("prefix", "hash", "salt", "content")
    runs = ranged.select(
        "row",
        "at",
        F.min(rank).over(whole).alias("run_least"),
        F.count(F.lit(1)).over(whole).alias("run_rows"),
        F.sha2("content", 256).alias("text_sha256"),
    )
    keep = F.coalesce("least", "run_least")
    return runs.join(F.broadcast(totals), "text_sha256", "left").select(
        "row",
        keep["id"].alias("keep_id"),
        F.coalesce("rows", "run_rows").alias("group_size"),
        (F.col("at") == keep["at"]).alias("kept"),
        "text_sha256",
    )


def exact_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row."""
    found = sorted_groups(docs.select("doc_id", "text"))
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_copies(docs: DataFrame) -> DataFrame:
    """`docs` with one row of each group of equal texts."""
    return sorted_groups(docs).where("kept").select("row.*")
