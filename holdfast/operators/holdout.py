"""Exact stratified holdout in narrow scans, whatever the size or number of classes.

Rows are ordered by a seeded digest of their key. A histogram over the first digest digits tells in
which small range each class reaches its quota; what is left there is counted by digest, and cut by further
digits in the same way until no class has more than 65,536 digests, which are looked at one by one to
find the cutoff. So no window is longer than that. Quotas, histograms and cutoffs are tables. Marking a row is a lookup of the
cutoff of its class. A table of so many classes that their cutoffs would have to be shuffled with it is shuffled by class
instead, once and without digests, and its classes of up to 65,536 rows are ordered there.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.numbers import quoted
from holdfast.runtime import materialize

DIGITS = 4  # hex digits of a histogram: at most 65,536 ranges per class
DIGEST = 32  # hex digits of a digest
COPIES_PER_TASK_ROW = 100_000
FEW_CLASSES = 10_000  # whose cutoffs are small enough to look up

TRAIN, TEST = "train", "test"


def train_quotas(counts: DataFrame, test_size: float) -> DataFrame:
    """(label, needed): training rows per class of `counts` (label, n), for a materialized table.

    Shares are proportional; what rounding leaves goes to the largest remainders, ties by label.
    The classes are ranked by ranges of the remainder, so their number may be large.
    """
    spark = counts.sparkSession
    total = counts.agg(
        F.sum("n").cast("decimal(38,0)").alias("n"),
        F.count("*").alias("classes"),
        F.min("n").alias("least"),
        F.count_if(F.col("label").isNull()).alias("nulls"),
    ).first()
    if total.nulls:
        raise ValueError("the label must not be null")
    if total.least < 2:
        raise ValueError("each class needs at least two rows")
    n = int(total.n)
    n_test = math.ceil(test_size * n)
    n_train = n - n_test
    if min(n_train, n_test) < total.classes:
        raise ValueError(f"{n_train} training and {n_test} test rows cannot cover {total.classes} classes")
    product = f"CAST(n AS DECIMAL(19,0)) * CAST({n_train} AS DECIMAL(18,0))"
    shares = counts.selectExpr(
        "label",
        f"({product}) % CAST({n} AS DECIMAL(18,0)) AS rest",
        f"({product}) div CAST({n} AS DECIMAL(18,0)) AS whole",
    )
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("rest").desc(), F.col("label").asc()]
    ranged = materialize(shares.repartitionByRange(tasks, *order).withColumn("part", F.spark_partition_id()))
    left = n_train - ranged.agg(F.sum("whole")).first()[0]
    sizes = ranged.groupBy("part").count()
    earlier = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("before"))
    place = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))
    placed = ranged.join(before, "part").withColumn("place", place)
    extra = F.when(F.col("place") <= left, 1).otherwise(0)
    return placed.select("label", (F.col("whole") + extra).alias("needed"))


def _reached(table: DataFrame, position: str) -> DataFrame:
    """Per label the row of `table` (label, position, n, needed) in which the sum of n reaches `needed`,
    which becomes what is needed of that row."""
    upto = F.sum("n").over(Window.partitionBy("label").orderBy(position))
    found = table.withColumn("upto", upto)
    short = F.col("needed") - (F.col("upto") - F.col("n"))
    return found.where((F.col("upto") >= F.col("needed")) & (short > 0)).select(
        "label", position, short.alias("needed"), "n"
    )


def _cutoffs(rows: DataFrame, needed: DataFrame) -> DataFrame:
    """(label, cut, taken, n): the last digest of each label of `needed` (label, needed > 0) that gets
    training rows: `taken` of the n rows (label, digest) that share it."""
    inside, digits = rows.withColumn("n", F.lit(1).cast("bigint")), 0
    while True:
        digits = min(DIGEST, digits + DIGITS)
        prefix = F.substring("digest", 1, digits)
        counts = inside.groupBy("label", prefix.alias("prefix")).agg(F.sum("n").alias("n"))
        ranges = materialize(_reached(counts.join(needed, "label"), "prefix")).drop("n")
        within = inside.withColumn("prefix", prefix).join(ranges, ["label", "prefix"])
        tally = materialize(within.groupBy("label", "digest", "needed").agg(F.sum("n").alias("n")))
        longest = tally.groupBy("label").count().agg(F.max("count")).first()[0] or 0
        if longest <= 16**DIGITS or digits == DIGEST:
            break
        inside, needed = tally.select("label", "digest", "n"), ranges.select("label", "needed")
    found = _reached(tally, "digest")
    return materialize(found.select("label", F.col("digest").alias("cut"), F.col("needed").alias("taken"), "n"))


def _row_digest(columns: Sequence[str], seed: int) -> Column:
    """Digest of all columns; lengths and a null mark keep different rows apart."""
    texts = [quoted(c).cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def _expand(copies: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Equal rows as one row with their number, back to single rows: `taken` to train, the rest to test.
    The numbers are cut into chunks and spread, so many copies do not end up in one task."""
    spread = int(copies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last_chunk = F.floor((F.col("copies") - 1) / COPIES_PER_TASK_ROW).cast("bigint")
    start = F.col("chunk") * COPIES_PER_TASK_ROW
    numbers = F.sequence(start + 1, F.least(F.col("copies"), start + COPIES_PER_TASK_ROW))
    return (
        copies.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk)))
        .repartition(spread, "chunk")
        .withColumn("number", F.explode(numbers))
        .select(
            *[F.col("row")[c].alias(c) for c in columns],
            F.when(F.col("number") <= F.col("taken"), TRAIN).otherwise(TEST).alias(out),
        )
    )


def stratified_split(
    df: DataFrame,
    label: str,
    key: str | Sequence[str] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    out: str = "split",
) -> DataFrame:
    """`df` with a column `out` of 'train' or 'test', exact class by class.

    The same key and seed always give the same side. Without a key the whole row is one. Rows
    with equal keys are told apart by all their columns; equal rows are counted, not ordered. `df` is
    read several times, by label and digests: give it as a columnar table, as CSV is parsed each time.
    """
    columns = df.columns
    if key is None:
        digest = _row_digest(columns, seed)
    else:
        keys = [key] if isinstance(key, str) else list(key)
        digest = F.md5(F.concat_ws("|", *[quoted(k).cast("string") for k in keys], F.lit(str(seed))))
    second = _row_digest(columns, seed + 1)

    counts = materialize(df.groupBy(quoted(label).alias("label")).agg(F.count("*").alias("n")))
    if counts.isEmpty():
        return df.withColumn(out, F.lit(None).cast("string"))
    needed = train_quotas(counts, test_size).where("needed > 0")
    if counts.count() <= FEW_CLASSES:
        return _by_cutoffs(df, label, digest, second, needed, out)

    # At most one large class per 65,536 rows.
    large = counts.where(F.col("n") > 16**DIGITS).select("label")
    if large.isEmpty():
        return _by_order(df, label, digest, second, needed, out)
    rows = df.select(F.struct(*[quoted(c) for c in columns]).alias("row"), quoted(label).alias("label"))
    parts = [rows.join(F.broadcast(large), "label", how) for how in ("left_semi", "left_anti")]
    big, small = (part.select(*[F.col("row")[c].alias(c) for c in columns]) for part in parts)
    needed = materialize(needed)
    of_large = needed.join(F.broadcast(large), "label", "left_semi")
    cut = _by_cutoffs(big, label, digest, second, of_large, out)
    return cut.unionByName(_by_order(small, label, digest, second, needed, out))


def _by_order(df: DataFrame, label: str, digest: Column, second: Column, needed: DataFrame, out: str) -> DataFrame:
    """`df` with its sides, each class ordered in one window, in which equal rows may come in any order. Digests
    are made where the rows of a class have met, so only the table's own columns are shuffled."""
    mark = "_" * max(map(len, df.columns))  # longer names than the table's
    ours, theirs, quota = f"{mark}_label", f"{mark}_of", f"{mark}_needed"
    quotas = needed.select(F.col("label").alias(theirs), F.col("needed").alias(quota))
    met = df.withColumn(ours, quoted(label)).join(quotas, F.col(ours) == F.col(theirs), "left")
    place = F.row_number().over(Window.partitionBy(ours).orderBy(F.unhex(digest), F.unhex(second)))
    return met.withColumn(out, F.when(place <= F.col(quota), TRAIN).otherwise(TEST)).select(
        *[quoted(c) for c in df.columns], quoted(out)
    )


def _by_cutoffs(df: DataFrame, label: str, digest: Column, second: Column, needed: DataFrame, out: str) -> DataFrame:
    """`df` with its sides, by the cutoff of each class."""
    columns = df.columns
    source = df.select(quoted(label).alias("label"), digest.alias("digest"), second.alias("second"))
    cuts = _cutoffs(source.select("label", "digest"), needed)

    # Classes whose cutoff falls between rows of one key: order those rows by the second digest.
    tied = cuts.where("taken < n").select("label", "cut", F.col("taken").alias("needed"))
    if tied.isEmpty():
        second_cuts = cuts.where("false")
    else:
        at_cut = source.join(tied.select("label", F.col("cut").alias("digest")), ["label", "digest"])
        second_cuts = _cutoffs(at_cut.select("label", F.col("second").alias("digest")), tied.select("label", "needed"))
    limits = cuts.select("label", "cut", (F.col("taken") < F.col("n")).alias("is_tied")).join(
        second_cuts.select("label", F.col("cut").alias("second_cut"), "taken", F.col("n").alias("rows")), "label", "left"
    )

    # The cutoffs are one row per class: Spark broadcasts them when they are found to be small.
    rows = df.select(
        F.struct(*[quoted(c) for c in columns]).alias("row"),
        quoted(label).alias("label"),
        digest.alias("digest"),
        second.alias("second"),
    ).join(limits, "label", "left")
    at_cut = F.col("is_tied") & (F.col("digest") == F.col("cut"))
    at_second = at_cut & (F.col("second") == F.col("second_cut"))
    copied = F.coalesce(at_second & (F.col("taken") < F.col("rows")), F.lit(False))
    below = F.when(at_cut, F.col("second") <= F.col("second_cut")).otherwise(F.col("digest") <= F.col("cut"))
    marked = rows.where(~copied).select(
        *[F.col("row")[c].alias(c) for c in columns],
        F.when(below, TRAIN).otherwise(TEST).alias(out),
    )
    if second_cuts.where("taken < n").isEmpty():
        return marked
    equal = rows.where(copied).groupBy("row", "taken").agg(F.count("*").alias("copies"))
    return marked.unionByName(_expand(equal, columns, out))
