"""Manifests as tables, and features as (size, indices, values): for thousands of levels.

Work and plan follow the columns of a table and the keys of a request, never the number of features: every level finds
its position by a join, which is a broadcast where the levels are known to be small and a shuffle beyond. Positions are
those of `encoding.manifest`. Indices ascend; what is not listed is 0, and NaN is a missing number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast import values
from holdfast.functions.numbers import known, quoted
from holdfast.operators.encoding import MANIFEST_SCHEMA
from holdfast.runtime import materialize

#: Levels of up to so many bytes are broadcast.
BROADCAST_BYTES = 32 << 20
#: What a level takes besides its text.
ROW_BYTES = 64


def manifest_table(
    columns: Sequence[str],
    categorical: Sequence[str],
    levels: DataFrame,
    label: str = values.TARGET,
    key: str | None = values.ID,
    missing: Sequence[str] = (),
) -> DataFrame:
    """(position, name, source, level, missing) of a table's features, from its `level_table`; no level reaches the driver."""
    spark = levels.sparkSession
    passed = [c for c in columns if c not in {label, key, *categorical}]
    first = [(i, c, c, None, False) for i, c in enumerate(passed)]
    order = spark.createDataFrame([(c, i) for i, c in enumerate(categorical)], "column string, i int")
    counts = order.join(levels.groupBy("column").agg(F.max("position").alias("n")), "column", "left")
    earlier = Window.partitionBy(F.lit(0)).orderBy("i").rowsBetween(Window.unboundedPreceding, -1)  # one row a column
    n, start = F.coalesce("n", F.lit(0)), F.coalesce(F.sum("n").over(earlier), F.lit(0))
    starts = materialize(counts.select("column", n.alias("n"), start.alias("start")))
    indicators = levels.where("position > 0").join(F.broadcast(starts), "column").select(
        (F.lit(len(passed) - 1) + F.col("start") + F.col("position")).cast("int").alias("position"),
        F.concat_ws("_", "column", "level").alias("name"),
        F.col("column").alias("source"),
        "level",
        F.lit(False).alias("missing"),
    )
    gaps = spark.createDataFrame([(i, c) for i, c in enumerate(missing)], "i int, source string")
    after = starts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    flags = gaps.join(F.broadcast(after)).select(
        (F.lit(len(passed)) + F.col("n") + F.col("i")).cast("int").alias("position"),
        F.concat("source", F.lit("_missing")).alias("name"),
        "source",
        F.lit(None).cast("string").alias("level"),
        F.lit(True).alias("missing"),
    )
    return spark.createDataFrame(first, MANIFEST_SCHEMA).unionByName(indicators).unionByName(flags)


def _checked(levels: DataFrame, n: int, size: int) -> DataFrame:
    """`levels` to join with, as a broadcast where `n` rows of `size` bytes of text are small."""
    return F.broadcast(levels) if n * ROW_BYTES + size <= BROADCAST_BYTES else levels


def _size(manifest: DataFrame) -> int:
    last = manifest.agg(F.max("position")).first()[0]
    return 0 if last is None else last + 1


def vector(entries: Column, size: int) -> Column:
    """The vector of an array of (position, value), of which nulls and zeros are left out."""
    listed = F.array_sort(F.filter(entries, lambda e: e.isNotNull() & e["value"].isNotNull() & (e["value"] != 0)))
    return F.struct(F.lit(size).alias("size"), listed["position"].alias("indices"), listed["value"].alias("values"))


def encode_sparse(df: DataFrame, manifest: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(kept columns, features) of each row by a stored manifest, which should be a materialized table.

    Levels that it does not know have no index. As in `encode_align`, a source's indicators are taken from
    the table where it has them and lacks the source, and absent numbers are 0.
    """
    present = sorted(df.columns)
    size = _size(manifest)
    about = manifest.groupBy("source").agg(
        F.count("level").alias("n"),
        F.coalesce(F.sum(F.octet_length("level")), F.lit(0)).alias("bytes"),
        F.min(F.when(F.col("level").isNull() & ~F.col("missing"), F.col("position"))).alias("passed"),
        F.min(F.when(F.col("missing"), F.col("position"))).alias("flag"),
    )
    # At most as many rows as the table has columns, and names.
    sources = about.where(F.col("source").isin(present)).collect()
    lacking = F.col("level").isNotNull() & ~F.col("source").isin(present)
    direct = manifest.where(lacking & F.col("name").isin(present)).select("name", "position").collect()

    def number(name: str) -> Column:
        return known(quoted(name).cast("double"))

    def entry(position: Column, value: Column) -> Column:
        return F.struct(position.cast("int").alias("position"), value.cast("double").alias("value"))

    entries, rows = [], df
    for i, row in enumerate(sorted(sources, key=lambda row: row.source)):
        if row.passed is not None:
            entries.append(entry(F.lit(row.passed), F.coalesce(number(row.source), F.lit(float("nan")))))
        if row.flag is not None:
            entries.append(entry(F.lit(row.flag), number(row.source).isNull().cast("double")))
        if row.n:
            levels = manifest.where((F.col("source") == row.source) & F.col("level").isNotNull())
            levels = levels.select(F.col("level").alias(f"_level{i}"), F.col("position").alias(f"_at{i}"))
            hit = quoted(row.source).cast("string") == F.col(f"_level{i}")
            rows = rows.join(_checked(levels, row.n, row.bytes), hit, "left")
            entries.append(F.when(F.col(f"_at{i}").isNotNull(), entry(F.col(f"_at{i}"), F.lit(1.0))))
    for row in direct:
        entries.append(entry(F.lit(row.position), F.coalesce(number(row.name), F.lit(float("nan")))))
    listed = F.array(*entries) if entries else F.array().cast("array<struct<position:int,value:double>>")
    return rows.select(*[quoted(c) for c in keep], vector(listed, size).alias("features"))


def dense(features: Column) -> Column:
    """All values of a vector of moderate size, missing ones as null."""

    def at(i: Column) -> Column:
        place = F.array_position(features["indices"], i)
        return known(F.when(place == 0, 0.0).otherwise(F.get(features["values"], (place - 1).cast("int"))))

    every = F.filter(F.sequence(F.lit(0), features["size"]), lambda i: i < features["size"])
    return F.transform(every, at)


ENTRIES = "array<struct<position:int,value:double,unless:string>>"


def align_sparse(parsed: DataFrame, manifest: DataFrame) -> DataFrame:
    """(request_id, position, error, features): one row per record, one per request with an error.

    `parsed` is of `envelope.parse_requests(requests, None)`. Each record's keys, and those that other records of its
    request have, are looked up in the manifest. What they mean is as in `envelope.align_requests`, mode `encoded`:
    a key that no record has is 0, one that some lack, or that is null, is missing; known texts of a source decide its
    indicators, else their own names do; the first text or infinite number in a number's place is the record's error.
    """
    size = _size(manifest)
    indicator = F.col("level").isNotNull()
    kind = F.when(indicator, "direct").otherwise("number")
    by_name = manifest.where("not missing").select(F.col("name").alias("key"), "position", kind.alias("kind"), "source")
    flags = manifest.where("missing").select(F.col("source").alias("key"), "position", F.lit("flag").alias("kind"), "source")
    meanings = F.sort_array(F.collect_list(F.struct("position", "kind", "source"))).alias("found")
    names = by_name.unionByName(flags).groupBy("key").agg(meanings)
    levels = manifest.where(indicator).select(F.col("source").alias("_source"), F.col("level").alias("_level"), F.col("position").alias("hit"))
    n, size_of_levels = manifest.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("name")), F.lit(0))).first()
    sources = manifest.where(indicator).select(F.col("source").alias("key")).distinct().withColumn("is_source", F.lit(True))

    given_keys = F.when(F.size("records") > 1, F.array_distinct(F.flatten(F.transform("records", lambda r: F.map_keys(r)))))
    numbered = parsed.withColumn("row", F.monotonically_increasing_id())
    records = numbered.select("row", "request_id", "error", given_keys.alias("keys"), F.posexplode_outer("records").alias("position", "record"))
    given = F.transform(F.coalesce("keys", F.map_keys("record")), lambda k: F.struct(k.alias("key"), F.col("record")[k].alias("value")))
    pairs = records.select("row", "request_id", "error", "position", F.explode_outer(given).alias("pair"))
    value, raw = F.col("pair.value"), F.expr("try_variant_get(pair.value, '$', 'double')")
    there = value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(False))
    odd = there & ((F.schema_of_variant(value) == "STRING") | raw.isNull() | (F.abs(raw) == float("inf")))
    text = F.trim(F.expr("try_variant_get(pair.value, '$', 'string')"))
    rows = pairs.select(
        "row", "request_id", "error", "position", F.col("pair.key").alias("key"), known(raw).alias("number"),
        F.coalesce(odd, F.lit(False)).alias("odd"), F.when(there & ~text.isin(values.MISSING_TEXTS), text).alias("text"),
    )
    looked = (
        rows.join(_checked(names, n, size_of_levels), "key", "left")
        .join(_checked(sources, n, size_of_levels), "key", "left")
        .join(_checked(levels, n, size_of_levels), (F.col("key") == F.col("_source")) & (F.col("text") == F.col("_level")), "left")
    )

    def meant(found: Column) -> Column:
        missing = F.coalesce("number", F.lit(float("nan")))
        worth = F.when(found["kind"] == "flag", F.col("number").isNull().cast("double")).otherwise(missing)
        unless = F.when(found["kind"] == "direct", found["source"])
        return F.struct(found["position"].alias("position"), worth.alias("value"), unless.alias("unless"))

    hit = F.struct(F.col("hit").alias("position"), F.lit(1.0).alias("value"), F.lit(None).cast("string").alias("unless"))
    entries = F.concat(
        F.coalesce(F.transform("found", meant), F.array().cast(ENTRIES)),
        F.when(F.col("hit").isNotNull(), F.array(hit)).otherwise(F.array().cast(ENTRIES)),
    )
    numbers = F.filter("found", lambda f: f["kind"] == "number")
    wrong = F.when(F.col("odd") & (F.size(numbers) > 0), F.struct(F.get(numbers, F.lit(0))["position"].alias("position"), "key"))
    told = F.when(F.col("is_source") & F.col("text").isNotNull(), F.col("key"))
    # The keys of a record come from one row and meet in one map task unless a lookup was a shuffle.
    grouped = (
        looked.select("row", "request_id", "error", "position", entries.alias("entries"), wrong.alias("wrong"), told.alias("told"))
        .groupBy("row", "request_id", "position", "error")
        .agg(F.flatten(F.collect_list("entries")).alias("entries"), F.min("wrong").alias("wrong"), F.collect_set("told").alias("told"))
    )
    kept = F.filter("entries", lambda e: e["unless"].isNull() | ~F.array_contains(F.col("told"), F.coalesce(e["unless"], F.lit(""))))
    plain = F.transform(kept, lambda e: F.struct(e["position"].alias("position"), e["value"].alias("value")))
    error = F.coalesce("error", F.concat(F.lit("not a number: "), F.col("wrong.key")))
    features = F.when(F.col("position").isNotNull(), vector(plain, size))
    return grouped.select("request_id", "position", error.alias("error"), features.alias("features"))
