"""One-hot features, and the manifest that fixes their names, order and levels."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast import values
from holdfast.functions.numbers import known, quoted
from holdfast.runtime import materialize

Levels = dict[str, list[str]]

MANIFEST_SCHEMA = "position int, name string, source string, level string, missing boolean"


def level_table(df: DataFrame, columns: Sequence[str] = values.CATEGORICAL) -> DataFrame:
    """(column, position, level): distinct non-null levels of each column in code point order.

    Each row is unpivoted and counted down to its (column, level) pairs before the shuffle. Pairs are
    range-partitioned and numbered within partitions; a table of one row per column and partition
    holds what lies before. Nothing goes through the driver, and no column's levels through one task.
    """
    spark = df.sparkSession
    pairs = F.array(
        *[F.struct(F.lit(i).alias("i"), quoted(c).cast("string").alias("level")) for i, c in enumerate(columns)]
    )
    distinct = df.select(F.inline(pairs)).where("level is not null").distinct()
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(distinct.repartitionByRange(tasks, "i", "level").withColumn("part", F.spark_partition_id()))
    counts = ranged.groupBy("i", "part").count()
    earlier = Window.partitionBy("i").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("i", "part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("i", "part").orderBy("level")) - 1
    names = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("i") + 1)
    return (
        ranged.withColumn("within", within)
        .join(before, ["i", "part"])
        .select(names.alias("column"), (F.col("before") + F.col("within")).cast("int").alias("position"), "level")
    )


def category_levels(
    df: DataFrame, columns: Sequence[str] = values.CATEGORICAL, max_levels: int | None = None
) -> Levels:
    """The `level_table` as names, which columns are made from. With `max_levels`, a column with more
    is an error, found by a count before any level reaches the driver."""
    if not columns:
        return {}
    table = level_table(df, columns)
    if max_levels is not None:
        for row in table.groupBy("column").count().where(F.col("count") > max_levels).collect():
            raise ValueError(f"column {row['column']!r} has more than {max_levels} levels")
    levels: Levels = {c: [] for c in columns}
    for row in sorted(table.collect(), key=lambda row: row.position):
        levels[row["column"]].append(row.level)
    return levels


def columns_with_missing(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Of the number columns, those with a null or NaN."""
    if not columns:
        return []
    missing = [F.count_if(known(quoted(c).cast("double")).isNull()).alias(str(i)) for i, c in enumerate(columns)]
    counts = df.agg(*missing).first()
    return [c for i, c in enumerate(columns) if counts[i]]


@dataclass(frozen=True)
class Feature:
    """One feature: a passed-through column, or an indicator of `source`: of one `level`, or of
    numbers that are missing."""

    name: str
    source: str
    level: str | None = None
    missing: bool = False

    def value(self) -> Column:
        if self.missing:
            return known(quoted(self.source).cast("double")).isNull().cast("int")
        if self.level is None:
            return quoted(self.source)
        return indicator(self.source, self.level)


def indicator(source: str, level: str) -> Column:
    return F.coalesce((quoted(source) == level).cast("int"), F.lit(0))


def indicators(levels: Levels) -> list[Feature]:
    """One indicator per level but the first, column by column."""
    return [
        Feature(f"{column}_{level}", column, level) for column, found in levels.items() for level in found[1:]
    ]


def one_hot(df: DataFrame, levels: Levels) -> DataFrame:
    """The encoded columns give way to their indicators, which follow all other columns."""
    return df.select(
        *[quoted(c) for c in df.columns if c not in levels],
        *[f.value().alias(f.name) for f in indicators(levels)],
    )


def manifest(
    columns: Sequence[str],
    levels: Levels,
    label: str = values.TARGET,
    key: str | None = values.ID,
    missing: Sequence[str] = (),
):
    """The ordered features for a table with these columns; number columns in `missing` get an
    indicator of their missing values."""
    apart = {label, key, *levels}
    passed = [Feature(c, c) for c in columns if c not in apart]
    return passed + indicators(levels) + [Feature(f"{c}_missing", c, missing=True) for c in missing]


def manifest_frame(spark: SparkSession, features: Sequence[Feature]) -> DataFrame:
    rows = [(i, f.name, f.source, f.level, f.missing) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def read_manifest(df: DataFrame) -> list[Feature]:
    rows = sorted(df.collect(), key=lambda row: row.position)
    return [Feature(row["name"], row.source, row.level, row.missing) for row in rows]


def align_columns(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exactly `names`, in order: absent columns are 0, others pass as they are, nulls included."""
    present = set(df.columns)
    return df.select(
        *[quoted(c) for c in keep],
        *[quoted(name) if name in present else F.lit(0).alias(name) for name in names],
    )


def encode_align(df: DataFrame, features: Sequence[Feature], keep: Sequence[str] = ()) -> DataFrame:
    """Features of a new table by the stored manifest. Levels it does not know are all 0.

    Indicators that the table already has are taken when their source is absent.
    """
    present = set(df.columns)

    def value(f: Feature) -> Column:
        if f.source in present:
            return f.value()
        return quoted(f.name) if f.name in present else F.lit(0)

    return df.select(*[quoted(c) for c in keep], *[value(f).alias(f.name) for f in features])


def feature_values(df: DataFrame, features: Sequence[Feature], keep: Sequence[str] = ()) -> DataFrame:
    """(kept columns, values): the named features in order, null where null or NaN.

    One array rather than a column per feature: the code that Spark generates per row stays
    small enough to be compiled, however many levels there are.
    """
    numbers = F.array(*[quoted(f.name).cast("double") for f in features])
    return df.select(*[quoted(c) for c in keep], F.transform(numbers, known).alias("values"))


def filled(values: Column, fill: float) -> Column:
    return F.transform(values, lambda v: F.coalesce(v, F.lit(float(fill))))


def is_complete(values: Column) -> Column:
    return ~F.exists(values, lambda v: v.isNull())


def assemble_features(
    df: DataFrame, features: Sequence[Feature], keep: Sequence[str] = (), fill: float | None = values.STAND_IN
) -> DataFrame:
    """(kept columns, feature vector). Missing values count as `fill`; with None they fail the job."""
    values = F.col("values")
    if fill is None:
        missing = F.raise_error(F.lit("a feature value is missing: give a fill"))
        values = F.when(is_complete(values), values).otherwise(missing)
    else:
        values = filled(values, fill)
    rows = feature_values(df, features, keep)
    return rows.select(*[quoted(c) for c in keep], array_to_vector(values).alias("features"))
