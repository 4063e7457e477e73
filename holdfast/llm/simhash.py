"""Near-duplicates by SimHash fingerprints of word shingles, compared bit-sliced.

Fingerprints that differ in few bits agree on some blocks of their bits (pigeonhole), so distinct
fingerprints are grouped by those blocks, in enough blocks that groups stay small as the corpus grows.
Within groups they are compared at every distance of the sorted order: bit planes are stored
vertically, 64 fingerprints to a word, the differing bits of 64 pairs are added at once to carry-save
counters, and a block of pairs is abandoned when all of them exceed the radius. Groups of more than
`TILE` fingerprints are cut into chunks that meet pairwise in tiles, so that no task holds a whole one.

Equal fingerprints are one class before anything is compared. Each tile hands on the edges of a
spanning forest, which have the same components as all its links.

Null and empty texts have the fingerprint zero and link like any other. Rows without a doc_id get
their fingerprint, and the component of the class that others form; by themselves none. Repeated
rows share their class. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import connected_components, map_batches, materialize, numbered, ship

SEED = 42
BITS = 64
#: Distinct fingerprints of a group that are compared in one tile.
TILE = 1024
#: Expected size of a group, for fingerprints with independent bits, that calls for finer blocks.
CROWD = 16
#: Words of 64 pairs in a block.
BLOCK = 256


def fingerprint(text: str, words: int) -> int:
    """The majority of each hash bit over all shingles, as an unsigned integer."""
    split = text.encode("utf-8", "surrogatepass").lower().split()
    if not split:
        return 0
    joined = b" ".join(split)
    if len(split) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum([len(word) + 1 for word in split]) - 1
    starts = np.concatenate([[0], ends[: -words] + 1]).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :].tolist())]
    bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = np.zeros(BITS, dtype=np.int64)
    for part in range(0, len(bits), 255):  # sums of bytes stay within a byte
        ones += np.add.reduce(bits[part : part + 255], axis=0, dtype=np.uint8)
    return int.from_bytes(np.packbits(ones * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = 3, row: Sequence[str] = ()) -> DataFrame:
    """(doc_id, print): the fingerprint of each whole text as a signed long, and the columns `row` (long) before."""

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = [fingerprint(text or "", words) for text in batch.column("text").to_pylist()]
        signed = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
        columns = [*[batch.column(c) for c in row], batch.column("doc_id"), signed]
        return pa.RecordBatch.from_arrays(columns, [*row, "doc_id", "print"])

    schema = ", ".join([*[f"`{c}` long" for c in row], "doc_id long, print long"])
    return map_batches(docs.select(*row, "doc_id", "text"), each, schema, rows=500)


def block_masks(distinct: int, radius: int) -> list[int]:
    """One mask per table: fingerprints within the radius agree on the bits of at least one."""
    for blocks in range(radius + 1, 2 * radius + 2):
        agree = blocks - radius
        if distinct >> (BITS * agree // blocks) < CROWD:
            break
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
    return [sum(chosen) for chosen in combinations(parts, agree)]


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """(64, words): bit i of word w of plane b is bit b of fingerprint 64 w + i."""
    n = -(-len(prints) // 64) * 64
    padded = np.zeros(n, dtype=np.uint64)
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def shifted(planes: np.ndarray, distance: int, words: int, start: int = 0) -> np.ndarray:
    """The planes' words from `start` on, each bit from `distance` places further."""
    skip, bit = divmod(distance, 64)
    span = planes[..., start + skip : start + skip + words + 1]
    missing = words + 1 - span.shape[-1]
    if missing:
        span = np.concatenate([span, np.zeros((*span.shape[:-1], missing), np.uint64)], axis=-1)
    if not bit:
        return span[..., :words]
    return span[..., :words] >> np.uint64(bit) | span[..., 1:] << np.uint64(64 - bit)


def within_radius(planes: np.ndarray, live: np.ndarray, distance: int, radius: int) -> np.ndarray:
    """Of the pairs (i, i + distance) whose bit is set in `live`, those that differ in few bits."""
    out = np.zeros_like(live)
    depth = (radius + 1).bit_length()
    for start in range(0, len(live), BLOCK):
        left = live[start : start + BLOCK].copy()
        counters = [np.zeros_like(left) for _ in range(depth)]
        over = np.zeros_like(left)
        for first in range(0, BITS, 8):
            if not left.any():
                break
            here = planes[first : first + 8, start : start + len(left)]
            differ = here ^ shifted(planes[first : first + 8], distance, len(left), start)
            for carry in differ:
                for counter in counters:
                    carry, counter[:] = carry & counter, carry ^ counter
                over |= carry
            left &= ~(over | _exceeds(counters, radius))
        out[start : start + BLOCK] = left
    return out


def _exceeds(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Where the number in the counters, lowest bit first, is over the radius."""
    more, equal = np.zeros_like(counters[0]), ~np.zeros_like(counters[0])
    for place in range(len(counters) - 1, -1, -1):
        if radius >> place & 1:
            equal &= counters[place]
        else:
            more |= equal & counters[place]
            equal &= ~counters[place]
    return more


def forest(groups: np.ndarray, prints: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Index pairs that join what lies within the radius in each group (equal numbers, contiguous)."""
    sizes = np.diff(np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1], [True]])))
    size = np.repeat(sizes, sizes)
    order = np.argsort(-size, kind="stable")  # what is active at a distance is a prefix
    groups, size = groups[order], size[order]
    planes = bit_planes(prints[order])
    root = np.arange(len(groups))
    parent = list(range(len(groups)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    joined = []
    for distance in range(1, int(size[0]) if len(size) else 0):
        active = int(np.searchsorted(-size, -distance, side="left"))  # in groups larger than the distance
        rows = min(active, len(groups) - distance)
        open_pair = (groups[:rows] == groups[distance : distance + rows]) & (root[:rows] != root[distance : distance + rows])
        if not open_pair.any():
            continue
        live = np.zeros(-(-rows // 64) * 64, dtype=bool)
        live[:rows] = open_pair
        near = within_radius(planes, np.packbits(live, bitorder="little").view(np.uint64), distance, radius)
        found = np.flatnonzero(np.unpackbits(near.view(np.uint8), bitorder="little"))
        for i in found.tolist():
            a, b = find(i), find(i + distance)
            if a != b:
                parent[max(a, b)] = min(a, b)
                joined.append((int(order[i]), int(order[i + distance])))
        if len(found):
            for i in np.unique(np.concatenate([found, found + distance])).tolist():
                root[i] = find(i)
    return joined


def links(classes: DataFrame, radius: int = 3) -> DataFrame:
    """Edges (a, b) of representatives that connect all classes (print, representative) within the radius."""
    spark = classes.sparkSession
    ship(spark)
    masks = block_masks(classes.count(), radius)
    signed = [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in masks]
    keys = F.array(
        *[F.struct(F.lit(i).alias("t"), F.col("print").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)]
    )
    rows = classes.select("print", "representative", F.inline(keys))
    crowded = (
        rows.groupBy("t", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > TILE)
        .select("t", "key", F.ceil(F.col("n") / (TILE // 2)).cast("int").alias("chunks"))
    )
    chunk = F.pmod(F.xxhash64("print"), "chunks").cast("int")
    other = F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("chunks") - 1)))
    tiles = (
        rows.join(crowded, ["t", "key"], "left")
        .select("t", "key", "print", "representative", F.coalesce(chunk, F.lit(0)).alias("mine"), other.alias("other"))
        .select(
            F.xxhash64("t", "key", F.least("mine", "other"), F.greatest("mine", "other")).alias("tile"),
            "print",
            "representative",
        )
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= 65536:
                table = pa.Table.from_batches(held)
                tile = table.column("tile").to_numpy()
                whole = int(np.searchsorted(tile, tile[-1]))  # the last tile may go on
                if whole:
                    yield from compare(table.slice(0, whole))
                held = table.slice(whole).combine_chunks().to_batches()
        if held:
            yield from compare(pa.Table.from_batches(held))

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        prints = table.column("print").to_numpy().view(np.uint64)
        nodes = table.column("representative").to_numpy()
        pairs = np.array(forest(table.column("tile").to_numpy(), prints, radius), dtype=np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[pairs[:, 0]]), pa.array(nodes[pairs[:, 1]])], ["a", "b"])

    # Tiles of one fingerprint have nothing to compare; a tile's equal hash with another's only adds comparisons.
    return tiles.repartition("tile").sortWithinPartitions("tile").mapInArrow(each, "a long, b long")


def near_groups(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, print, component_id) of every row."""
    prints = materialize(fingerprints(docs, words))
    classes = materialize(
        prints.where("doc_id is not null").groupBy("print").agg(F.min("doc_id").alias("representative"))
    )
    components = connected_components(links(classes, radius))
    named = classes.join(components, F.col("representative") == F.col("node"), "left").select(
        "print", F.coalesce("component", "representative").alias("component_id")
    )
    return prints.join(named, "print", "left").select("doc_id", "print", "component_id")


def keep_one(docs: DataFrame, words: int = 3, radius: int = 3) -> DataFrame:
    """`docs` with one row of each component of fingerprints, that of the smallest doc_id.

    Rows that share a doc_id are rows of their own; rows without one stay.
    """
    rows = numbered(docs)
    prints = materialize(fingerprints(rows.select("row", "doc.doc_id", "doc.text"), words, ["row"]))
    known = prints.where("doc_id is not null")
    # The nodes are the fingerprints themselves, as different texts may share a doc_id.
    classes = materialize(known.select("print").distinct().select("print", F.col("print").alias("representative")))
    components = connected_components(links(classes, radius))
    groups = known.join(components, F.col("print") == F.col("node"), "left").select(
        "row", "doc_id", F.coalesce("component", "print").alias("component")
    )
    first = groups.groupBy("component").agg(F.min(F.struct("doc_id", "row")).alias("first")).select("first.row")
    dropped = groups.select("row").join(first, "row", "left_anti")
    return rows.join(dropped, "row", "left_anti").select("doc.*")
