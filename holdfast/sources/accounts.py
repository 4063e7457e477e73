"""Account tables in files."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from holdfast import values
from holdfast.functions.numbers import quoted
from holdfast.operators.cleaning import missing_texts_to_null

CORRUPT = "_corrupt_record"


#: Files whose first line the driver reads at a time.
READERS = 32


def _first_line(spark: SparkSession, path: str) -> str:
    """The first line of a file, unpacked where its name says that it is packed."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        plain = codec.createInputStream(stream) if codec else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8"))
        return (reader.readLine() or "").removeprefix("\ufeff")
    finally:
        stream.close()


def headers(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The different headers of the CSV files at `path`, and the files that have each; empty files have none.

    Only first lines are read, on the driver, which holds a path per file as Spark's own listing does.
    """
    files = sorted(unquote(file) for file in spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(READERS) as pool:
        lines = list(pool.map(lambda file: _first_line(spark, file), files))
    found: dict[tuple[str, ...], list[str]] = {}
    for file, line in zip(files, lines):
        if line:
            found.setdefault(tuple(next(csv.reader([line]))), []).append(file)
    return found


def _read_csv(spark: SparkSession, path: str, declared: T.StructType, optional: Sequence[str] = ()) -> DataFrame:
    """The declared columns that the files have, by name.

    Files may have different headers: there is one read per header, and their union by name, in which a file without
    an optional column has nulls. An absent column that is not optional is an error, and so is a name that a header has twice.
    Other columns are left out.
    """
    kinds = {field.name: field.dataType for field in declared.fields}
    extra = [T.StructField(CORRUPT, T.StringType())] if CORRUPT in declared.names else []
    tables = []
    groups = headers(spark, path) or {tuple(n for n in declared.names if n not in optional): [path]}
    for found, files in groups.items():
        absent = [name for name in declared.names if name not in found and name not in optional]
        if absent:
            raise ValueError(f"{files[0]} has no column {', '.join(absent)}")
        twice = [name for name in declared.names if found.count(name) > 1]
        if twice:
            raise ValueError(f"{files[0]} has column {', '.join(twice)} more than once")
        # Of other columns, those that share a name need one of their own.
        folded = [name.lower() for name in found]
        names = [name if name in kinds or folded.count(name.lower()) == 1 else f"_other{i}" for i, name in enumerate(found)]
        fields = [T.StructField(name, kinds.get(name, T.StringType())) for name in names]
        table = (
            spark.read.schema(T.StructType(fields + extra))
            .option("header", True)
            .option("enforceSchema", tuple(names) != found)  # else files must keep to the header that was read
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .csv(path if len(groups) == 1 else files)
        )
        tables.append(table.select(*[quoted(name) for name in declared.names if name in table.columns]))
    union = tables[0]
    for table in tables[1:]:
        union = union.unionByName(table, allowMissingColumns=True)
    return union.select(*[quoted(name) for name in declared.names if name in union.columns])


def scan_accounts(spark: SparkSession, path: str, corrupt: bool = False) -> DataFrame:
    """Raw accounts from CSV with a header, by the declared types: no inference pass.

    Columns are found by name. Rows that do not fit keep what can be read; `corrupt` adds their
    text as a column.
    """
    schema = values.RAW_SCHEMA
    if corrupt:
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return _read_csv(spark, path, schema, [CORRUPT])


def write_table(df: DataFrame, path: str, format: str = "parquet") -> None:
    """Replace the table at `path`, one file per task."""
    writer = df.write.mode("overwrite").format(format)
    if format == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def scan_clean(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """The cleaned table, all files of the directory, with the identifier if it is there.

    CSV has no nulls of its own: texts that its reader takes as missing become null.
    """
    if format == "parquet":
        return spark.read.parquet(path)
    return missing_texts_to_null(_read_csv(spark, path, values.CLEAN_SCHEMA, [values.ID]))
