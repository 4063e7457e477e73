"""What lies below a path."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.numbers import rounded


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """(path, size_kb at one decimal) of the files below `path`. Contents are not read.

    Spark's file source leaves out files without bytes and names that start with `_` or `.`, and so
    does this. Nothing there gives no rows and a warning.
    """
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "path string, length bigint")
    if files.isEmpty():
        warnings.warn(f"no files found below {path}", stacklevel=2)
    return files.select("path", rounded(F.col("length") / 1024, 1, ties="even").alias("size_kb"))
