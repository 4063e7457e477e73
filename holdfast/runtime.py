"""Session, shared scratch folder and lineage cuts."""

from __future__ import annotations

import io
import math
import os
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_named: list[str] = []  # scratch paths in the order of their making


def local_session(cores: str | int = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on this machine, for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("holdfast")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or else the session's warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    unique = f"{spark.sparkContext.applicationId}-{uuid.uuid4().hex[:12]}"
    path = os.path.join(shared_dir(spark), "holdfast", unique, name)
    _named.append(path)
    return path


def use_checkpoints(spark: SparkSession) -> None:
    """Point the context at the shared folder unless the cluster already did."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def materialize(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and go on from there, so that a result that is read
    several times is computed once and outlives the executors that made it."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that are too few to part, and the most that a task of `spread` gets where cores are few.
FEW_ROWS, MOST_ROWS = 20_000, 1_000_000


def spread(df: DataFrame) -> DataFrame:
    """`df` dealt out evenly to the cores. Rows of a packed file come in as many tasks as it has row groups, which
    may be one whatever their number, and Spark joins small shuffled partitions into one: too few for work that
    costs much more per row than a shuffle does. Tables of few rows stay as they are."""
    rows = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = min(math.ceil(rows / FEW_ROWS), max(cores, math.ceil(rows / MOST_ROWS)))
    return df.repartition(tasks) if tasks > 1 else df


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A file below the shared folder, whatever kind of store that is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    try:
        stream.write(content)
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, content: bytes) -> None:
    """Put `content` at `path` in one step: readers find the older file or the new one, never a part of it."""
    fs = spark._jvm.org.apache.hadoop.fs
    aside, place = fs.Path(f"{path}.{uuid.uuid4().hex}"), fs.Path(path)
    write_bytes(spark, aside.toString(), content)
    overwrite = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 1)
    overwrite[0] = getattr(fs, "Options$Rename").OVERWRITE
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    context = fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(aside, place, overwrite)


def read_bytes(spark: SparkSession, path: str) -> bytes | None:
    """What a small file holds, or None where there is none."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder below the shared one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


_shipped: set[str] = set()
_PACKAGE = os.path.dirname(os.path.abspath(__file__))


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package, once per application, from the shared folder."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    archive = io.BytesIO()
    with zipfile.ZipFile(archive, "w") as package:
        for folder, _, names in os.walk(_PACKAGE):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    package.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    path = os.path.join(shared_dir(spark), "holdfast", application, "package.zip")
    write_bytes(spark, path, archive.getvalue())
    spark.sparkContext.addPyFile(path)
    _shipped.add(application)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, the folders that `scratch_path` named within; results must be written by then."""
    before = len(_named)
    yield
    while len(_named) > before:
        remove(spark, os.path.dirname(_named.pop()))
