"""The trie of shared beginnings of conversations, by van Emde Boas recursion over its depth.

Depths are cut in halves: all prefixes that end at the cut are named first, then the trie above the cut and the
forest below each named prefix are treated in the same way, all of one size at once. A cut at depth d with
`d = odd * 2**v` closes the block of `2**v` turns from depth `d - 2**v` on, whose prefix is named by then, so a
name is found from the pair (name at the start of the block, digest of the block). Each depth of a conversation is
cut once, and a trie of depth D takes log2(D) steps. A prefix is named by the smallest conversation that has it,
which with its depth tells it from all others.

Totals of subtrees go the same way back: the trees of `2**v` levels are complete from the smallest v on, and
their totals are grafted onto the node at the top of the next larger one; then from the largest v down every
node gets what lies below its own tree, from the nodes at the next cut.

Every step handles rows of (conversation, depth), never a whole conversation, except that blocks are digested in
segments of at most `SEGMENT` turns. A name that many conversations share joins by broadcast, of which there are
a bounded number; sums are combined before they are shuffled. The one thing that is gathered whole is the list
of ids that `ends_sha256` is a digest of (8 bytes a conversation, at most 2 GB).

Turns are ordered by turn (null first), then by their digest; equal rows are turns of their own. Null roles and texts
are empty. Rows without a conv_id belong to no conversation and are left out. An empty table has no node at all.
Turns are told apart by SHA-256. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.llm.common import discard, materialize, partitions, spread_join
from holdfast.runtime import scratch_path

#: Turns of a conversation whose digests one task holds at once; a power of two.
SEGMENT = 1024


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 0, digest, bytes) of every turn.

    The rows are range-partitioned and numbered within partitions; a conversation that lies in several ones is
    numbered on from there, so that none is gathered in one task.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat_ws(":", F.char_length(role).cast("string"), F.concat(role, text)), 256)
    ranged = materialize(
        conversations.where("conv_id is not null")
        .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
        .repartitionByRange(partitions(conversations.sparkSession), "conv_id", "turn", "digest")
        .withColumn("part", F.spark_partition_id())
    )
    spans = ranged.groupBy("conv_id").agg(F.min("part").alias("first"), F.max("part").alias("last")).where("first < last")
    # A partition starts and ends within one conversation each, so there are at most two rows a partition.
    pieces = ranged.join(F.broadcast(spans), "conv_id").groupBy("conv_id", "part").agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = pieces.select("conv_id", "part", F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("part", "conv_id").orderBy("turn", "digest")
    numbered = ranged.withColumn("at", F.row_number().over(within) - 1)
    place = (F.col("at") + F.coalesce("before", F.lit(0))).cast("long")
    return materialize(
        numbered.join(F.broadcast(before), ["conv_id", "part"], "left").select("conv_id", place.alias("place"), "digest", "bytes")
    )


def borrowed_start(turns: DataFrame, every: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like another: the first h turns of conversation `c - c % every`, then c's own turns after
    its first h, where h is the CRC-32 of the decimal c modulo `most`.

    Gives (conv_id, depth from 1, digest, bytes, last) of every turn, and (conv_id, length) of every conversation.
    """
    convs, total = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), turns.count()
    hash = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("long")
    base = F.col("conv_id") - F.col("conv_id") % every
    starts = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    lead = materialize(
        convs.select("conv_id", "n", base.alias("base"), hash.alias("h"))
        .join(starts, "base", "left")
        .withColumn("got", F.least("h", F.coalesce("base_n", F.lit(0))))
        .withColumn("length", F.col("got") + F.greatest(F.lit(0), F.col("n") - F.col("h")))
        .select("conv_id", "n", "base", "h", "got", "length")
    )
    first = turns.where((F.col("place") < most - 1) & (F.col("conv_id") % every == 0)).withColumnRenamed("conv_id", "base")
    borrowed = first.join(lead, "base").where("place < h").withColumn("depth", F.col("place") + 1)
    own = spread_join(turns, lead, ["conv_id"], "n", total).where("place >= h").withColumn("depth", F.col("place") - F.col("h") + F.col("got") + 1)
    columns = ["conv_id", "depth", "digest", "bytes", (F.col("depth") == F.col("length")).alias("last")]
    return materialize(borrowed.select(*columns).unionByName(own.select(*columns))), lead.select("conv_id", "length")


def power(depth: Column) -> Column:
    """The v of `depth = odd * 2**v`."""
    return F.round(F.log2(depth.bitwiseAND(-depth).cast("double"))).cast("int")


def blocks(turns: DataFrame, deepest: int) -> DataFrame:
    """(conv_id, depth, v, digest of the 2**v turns that end at depth, bytes, last), stored by v.

    Segments of turns are digested; whole ones are the turns of a sequence `SEGMENT` times shorter.
    """
    spark, path, unit = turns.sparkSession, scratch_path(turns.sparkSession, "blocks"), 1
    level = turns.select("conv_id", "depth", "digest", "bytes", "last")
    while level is not None:
        segment = ((F.col("depth") - 1) / SEGMENT).cast("long")
        row = F.struct("depth", "digest", "bytes", "last")
        rows = level.groupBy("conv_id", segment.alias("segment")).agg(F.sort_array(F.collect_list(row)).alias("rows"))

        def closed(row: Column, at: Column) -> Column:
            size = (at + 1).bitwiseAND(-(at + 1))
            part = F.slice(F.col("rows.digest"), at + 2 - size, size)
            digest = F.when(size == 1, row["digest"]).otherwise(F.sha2(F.array_join(part, ""), 256))
            return F.struct(row["depth"].alias("depth"), digest.alias("digest"), row["bytes"].alias("bytes"), row["last"].alias("last"))

        found = rows.select("conv_id", F.explode(F.transform("rows", closed)).alias("row")).select("conv_id", "row.*")
        whole = F.col("depth") % SEGMENT == 0
        more = deepest // unit >= SEGMENT
        found = materialize(found) if more else found
        (
            found.where(~whole)
            .select("conv_id", (F.col("depth") * unit).alias("depth"), "digest", "bytes", "last")
            .withColumn("v", power(F.col("depth")))
            .repartition(partitions(spark), "v", "conv_id")
            .write.mode("append").partitionBy("v").parquet(path)
        )
        level = found.where(whole).withColumn("depth", F.expr(f"depth div {SEGMENT}")) if more else None
        unit *= SEGMENT
    return spark.read.schema("conv_id long, depth long, digest string, bytes long, last boolean, v int").parquet(path)


class Levels:
    """Rows of each v, written one v at a time below one folder, so that one scan reads any range of them."""

    def __init__(self, spark: SparkSession, schema: str):
        self.spark, self.schema, self.path = spark, schema, scratch_path(spark, "levels")

    def put(self, v: int, rows: DataFrame) -> None:
        columns = [column.split()[0] for column in self.schema.split(", ")]
        rows.select(*columns).write.option("compression", "zstd").parquet(f"{self.path}/v={v}")

    def where(self, condition: str) -> DataFrame:
        return self.spark.read.schema(f"{self.schema}, v int").parquet(self.path).where(condition).drop("v")


def named_levels(blocks: DataFrame, steps: int, root: int, total: int) -> tuple[Levels, Levels]:
    """By v: (conv_id, depth, name, last), the name of each prefix, and (depth, name, top, n_convs, bytes), the nodes;
    `top` is the name of the node `2**v` above."""
    names = Levels(blocks.sparkSession, "conv_id long, depth long, name long, last boolean")
    nodes = Levels(blocks.sparkSession, "depth long, name long, top long, n_convs long, bytes long")
    key = ["depth", "top", "digest"]
    for v in reversed(range(steps)):
        cut = blocks.where(F.col("v") == v).drop("v").withColumn("start", F.col("depth") - (1 << v))
        keyed = cut.where("start = 0").withColumn("top", F.lit(root).cast("long"))
        if v + 1 < steps:
            above = names.where(f"v > {v}").select("conv_id", F.col("depth").alias("start"), F.col("name").alias("top"))
            keyed = keyed.unionByName(cut.where("start > 0").join(above, ["conv_id", "start"]))
        keyed = materialize(keyed.select("conv_id", *key, "bytes", "last"))
        groups = materialize(
            keyed.groupBy(*key).agg(F.min("conv_id").alias("name"), F.count(F.lit(1)).alias("n_convs"), F.min("bytes").alias("node_bytes"))
        )
        names.put(v, spread_join(keyed, groups, key, "n_convs", total))
        nodes.put(v, groups.withColumnRenamed("node_bytes", "bytes"))
        discard(keyed)
        discard(groups)
    return names, nodes


def prefix_trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes (depth, conv_id, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends: sorted conv_ids) of the
    conversations of `lengths` (conv_id, length) with `turns` (conv_id, depth, digest, bytes, last)."""
    root, n_convs, deepest = lengths.agg(F.min("conv_id"), F.count(F.lit(1)), F.max("length")).first()
    spark, steps = turns.sparkSession, max(1, int(deepest or 0).bit_length())
    names, nodes = named_levels(blocks(turns, deepest or 0), steps, root or 0, turns.count())

    # Parents: of an odd depth the top, else the name that the node's conversation has a depth above.
    above = names.where("v = 0").select(F.col("conv_id").alias("name"), (F.col("depth") + 1).alias("depth"), F.col("name").alias("parent"))
    odd = nodes.where("v = 0").withColumn("parent", F.col("top"))
    tree = materialize(odd.unionByName(nodes.where("v > 0").join(above, ["name", "depth"])))
    children = materialize(tree.groupBy((F.col("depth") - 1).alias("depth"), F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children")))
    tree = materialize(
        tree.join(children, ["depth", "name"], "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("leaves", (F.col("n_children") == 0).cast("long"))
        .withColumn("saved", (F.col("n_convs") - 1) * F.col("bytes"))
    )

    # Upwards: a tree of 2**v levels, complete by then, is grafted onto the node at its top.
    totals = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    columns = ["depth", "name", "leaves", "saved"]
    within = Levels(spark, "depth long, name long, top long, leaves long, saved long")
    grafts = Levels(spark, "depth long, name long, leaves long, saved long")
    for v in range(steps):
        rows = tree.where(power(F.col("depth")) == v).select(*columns, "top")
        if v:
            mine = grafts.where(f"v < {v}").where((F.col("depth") > 0) & (power(F.col("depth")) == v))
            rows = rows.unionByName(mine, allowMissingColumns=True).groupBy("depth", "name").agg(*totals, F.max("top").alias("top"))
        within.put(v, rows)
        top = [(F.col("depth") - (1 << v)).alias("depth"), F.col("top").alias("name")]
        grafts.put(v, within.where(f"v = {v}").groupBy(*top).agg(*totals))
    whole_root = grafts.where("depth = 0").agg(*totals)

    # Downwards: what lies below a node's own tree hangs on the nodes at its next cut, which are whole by then.
    full = Levels(spark, "depth long, name long, leaves long, saved long")
    for v in reversed(range(steps)):
        rows = within.where(f"v = {v}").select(*columns)
        if v + 1 < steps:
            cut = full.where(f"v > {v}").select(F.col("name").alias("conv_id"), (F.col("depth") - (1 << v)).alias("depth"), "leaves", "saved")
            below = cut.join(names.where(f"v = {v}"), ["conv_id", "depth"]).select(*columns)
            rows = rows.unionByName(below).groupBy("depth", "name").agg(*totals)
        full.put(v, rows)

    ends = names.where("last").select("conv_id", "depth", "name")
    ends = ends.unionByName(lengths.where("length = 0").select("conv_id", F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("name")))
    ends = ends.groupBy("depth", "name").agg(F.sort_array(F.collect_list("conv_id")).alias("ends"))

    top = (
        lengths.agg(F.min("conv_id").alias("name"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
        .select(F.lit(0).cast("long").alias("depth"), "name", F.lit(None).cast("long").alias("parent"), "n_convs")
        .join(children.where("depth = 0").select("depth", "n_children"), "depth", "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .crossJoin(F.broadcast(whole_root))
        .withColumn("leaves", F.coalesce("leaves", F.lit(1)))
        .withColumn("saved", F.coalesce("saved", F.lit(0)))
    )
    columns = ["depth", "name", "parent", "n_convs", "n_children", "leaves", "saved"]
    every = tree.drop("leaves", "saved").join(full.where("true"), ["depth", "name"]).select(*columns).unionByName(top.select(*columns))
    return every.join(ends, ["depth", "name"], "left").select(
        F.col("name").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.array().cast("array<long>")).alias("ends"),
    )
