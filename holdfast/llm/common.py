"""What the operators share: shipping the package, lineage cuts, running totals, components."""

from __future__ import annotations

import io
import os
import zipfile
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast import runtime

BATCH_BYTES = 64 << 20
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application, from the shared folder."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as package:
        for folder, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    package.write(full, os.path.relpath(full, os.path.dirname(PACKAGE)))
    path = os.path.join(runtime.shared_dir(spark), "holdfast", application, "holdfast.zip")
    runtime.write_bytes(spark, path, archive.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` below the shared folder and go on from there; lost executors lose nothing of it."""
    path = runtime.scratch_path(df.sparkSession, "table")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame) -> DataFrame:
    """`docs` materialized as (row, doc): a number of each row, and its columns, whose names may be any."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    return materialize(rows.withColumn("row", F.monotonically_increasing_id()))


def spread_join(rows: DataFrame, groups: DataFrame, key: Sequence[str], size: str, total: int) -> DataFrame:
    """`rows` with the row of `groups` that has their `key`; `groups` has each key once, nulls being equal, and its number of
    rows in `size`. There are at most `total` rows.

    Keys that more than a quarter of a partition's share of `total` have are joined by broadcast: there are at
    most four of them to a partition. The rest is joined by a shuffle that no key can skew.
    """
    frequent = max(50, total // (4 * partitions(rows.sparkSession)))
    names = {column: f"_{column}" for column in key}

    def matched(rows: DataFrame, groups: DataFrame, how: str) -> DataFrame:
        other = groups.withColumnsRenamed(names)
        same = [rows[column].eqNullSafe(other[names[column]]) for column in key]
        return rows.join(other, same, how).drop(*names.values())

    hot = F.broadcast(groups.where(F.col(size) > frequent))
    rest = matched(rows, hot.select(*key), "left_anti")
    return matched(rows, hot, "inner").unionByName(matched(rest, groups.where(F.col(size) <= frequent), "inner"))


def discard(df: DataFrame) -> None:
    """Remove the files of a materialized table that nothing reads any more."""
    for folder in {os.path.dirname(file) for file in df.inputFiles()}:
        runtime.remove(df.sparkSession, folder)


def map_batches(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]],
    schema: str,
    rows: int = 256,
) -> DataFrame:
    """`function` over batches of at most `rows` rows and about `BATCH_BYTES` bytes (or one row),
    whatever the session's batch size is, so a task's Python memory does not grow with its partition."""
    ship(df.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pa.set_memory_pool(pa.system_memory_pool())  # which returns what is free
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, rows)
                while part.num_rows > 1 and part.nbytes > BATCH_BYTES:
                    part = part.slice(0, part.num_rows // 2)
                start += part.num_rows
                made = function(part)
                if isinstance(made, pa.RecordBatch):
                    yield made
                else:
                    yield from made

    return df.mapInArrow(each, schema)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Batches of at most `rows` rows to Python for the jobs within: their buffers are off the heap."""
    before = spark.conf.get(ARROW_ROWS)
    spark.conf.set(ARROW_ROWS, str(rows))
    try:
        yield
    finally:
        spark.conf.set(ARROW_ROWS, before)


def lowest_hashes(rows: DataFrame, id: str, n: int) -> DataFrame:
    """At most `n` distinct ids of `rows`, those whose hash is lowest: the same ones in any layout.

    Ids are cut down to a few times `n` by a bound on the hash before tasks send their lowest.
    """
    share = min(1.0, 4 * n / max(1, rows.count()))
    bound = min((1 << 63) - 1, int(-(1 << 63) + share * (1 << 64)))
    low = rows.select(id).where(F.col(id).isNotNull() & (F.xxhash64(id) <= bound)).distinct()
    return low.orderBy(F.xxhash64(id), id).limit(n)


def running_total(rows: DataFrame, order: Sequence[str], value: str, out: str) -> DataFrame:
    """(order columns, value, out): the sum of `value` over all rows that sort before.

    The rows are range-partitioned by `order`, which must be unique. One total per partition is
    summed up in a table of as many rows as partitions; the rest stays within partitions.
    """
    spark = rows.sparkSession
    ranged = materialize(
        rows.select(*order, value)
        .repartitionByRange(partitions(spark), *order)
        .withColumn("_part", F.spark_partition_id())
    )
    totals = ranged.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = ranged.withColumn("_within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    total = (F.col("_within") + F.col("_before")).cast("long").alias(out)
    return summed.join(F.broadcast(offsets), "_part").select(*order, value, total)


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component) for the nodes of `edges` (a, b: long) that reach a smaller one: the smallest.

    Large-star and small-star steps alternate until all edges lead to centres, and it is an error if
    `rounds` of them do not get there; each step is one aggregation
    (with map-side combine) and one join per node, so that a hub's edges are never collected in
    one place. Lineage is cut after each round in the shared folder.
    """
    current = materialize(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    if current.isEmpty():
        return current.select(F.col("a").alias("node"), F.col("b").alias("component"))
    for _ in range(rounds):
        # Large star: every larger neighbour of u points to the smallest of u and its neighbours.
        both = current.select("a", "b").unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: every smaller neighbour of u, and u itself, point to the smallest neighbour.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        older, current = current, materialize(small)
        discard(older)
        edge_count, leaves = current.agg(F.count(F.lit(1)), F.countDistinct("a")).first()
        if edge_count == leaves and _is_star(current):
            break
    else:
        raise RuntimeError(f"components are not settled after {rounds} rounds")
    return current.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _is_star(edges: DataFrame) -> bool:
    """Whether no centre is itself a leaf."""
    return edges.select(F.col("b").alias("a")).distinct().join(edges.select("a"), "a", "left_semi").isEmpty()


def with_components(nodes: DataFrame, node: str, edges: DataFrame, out: str = "component_id") -> DataFrame:
    """`nodes` with the component of each; a node without edges is its own."""
    found = connected_components(edges).select(F.col("node").alias("_node"), "component")
    joined = nodes.join(found, F.col(node) == F.col("_node"), "left")
    return joined.withColumn(out, F.coalesce("component", node)).drop("_node", "component")
