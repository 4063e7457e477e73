"""Vectors as short codes: one index into a codebook for each of several equal parts, trained by Lloyd's rounds.

Components are integers, `floor(256 * x)`, and so is all arithmetic, so that results depend on no order of addition.
Blocks of vectors are written once with a cover tree per part: a node covers its points within a power of two, its
children within half of that, and siblings are further apart than that half; its points lie next to each other, so that
running sums over all points give the sum of any subtree. To assign points a task walks the trees: where the
nearest entry is nearer to a node's centre than the second by more than twice the node's radius, the triangle inequality
gives it the whole subtree, whose sum and count are looked up; otherwise its children are asked, and the points of
an undecided leaf are compared one by one. Ties, which no strict inequality decides, always end there and go to
the lower index. Only sums per (part, entry) are shuffled, and the codebooks are all that the driver holds.

Vectors that are null, or hold a null or a component that is not finite, are left out. Shorter vectors are filled up with
zeros to the longest, and all to a multiple of the parts. A codebook starts from the smallest ids, repeated rows counting
as rows, nulls last, ties by vector; with fewer vectors than entries it is shorter. Null labels are one label. Components beyond
2**20 in size are an error, as squared distances could leave the range of a long. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import map_batches, materialize, spread_join

SCALE = 256
LARGEST = 1 << 28
#: Points of a node that is not split any more.
LEAF = 12
#: Vectors of a block, and the number of components that makes a block smaller.
BLOCK, BLOCK_COMPONENTS = 2048, 1 << 20


@dataclass
class CoverTrees:
    """Trees over `points` (one to each part and vector, those of a node side by side), and their nodes."""

    points: np.ndarray  # (points, width)
    vector: np.ndarray  # row of each point in the block
    part: np.ndarray  # part of each node
    start: np.ndarray  # a node's points are start to end; the first is its centre
    end: np.ndarray
    far: np.ndarray  # greatest squared distance of a node's points from its centre
    child: np.ndarray  # a node's children are child to child + children
    children: np.ndarray


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    difference = a - b
    return np.einsum("ij,ij->i", difference, difference)


def cover_trees(parts: np.ndarray) -> CoverTrees:
    """Trees over parts (part, vector, width), all built level by level."""
    n_parts, n, width = parts.shape
    points, vector = parts.reshape(-1, width), np.tile(np.arange(n), n_parts)
    start = np.arange(n_parts) * n
    end = start + n
    far = np.maximum.reduceat(squared(points, np.repeat(points[start], n, axis=0)), start)
    levels = [[np.arange(n_parts), start, end, far]]
    links, made = [], n_parts
    while True:
        part, start, end, far = levels[-1]
        split = np.flatnonzero((far > 0) & (end - start > LEAF))
        child, children = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
        links.append([child, children])
        if not len(split):
            break
        # A node within 2**l of its centre is covered anew within half of that; all is compared as 4 * distance**2.
        bits = np.ceil(np.log2(far[split].astype(np.float64)) / 2).astype(np.int64)
        bits += (np.int64(1) << (2 * bits)) < far[split]
        reach = np.int64(1) << (2 * bits)
        sizes = end[split] - start[split]
        owner = np.repeat(np.arange(len(split)), sizes)
        place = np.arange(len(owner)) + np.repeat(start[split] - (np.cumsum(sizes) - sizes), sizes)
        number, distance = np.zeros(len(owner), np.int64), np.zeros(len(owner), np.int64)
        left, round = np.arange(len(owner)), 0
        while len(left):
            # The first point of each node that no child covers is the centre of the next child.
            first = np.flatnonzero(np.r_[True, owner[left][1:] != owner[left][:-1]])
            centre = place[left[first]][np.cumsum(np.isin(np.arange(len(left)), first)) - 1]
            away = squared(points[place[left]], points[centre])
            near = 4 * away <= reach[owner[left]]
            number[left[near]], distance[left[near]] = round, away[near]
            left, round = left[~near], round + 1
        order = np.lexsort((number, owner))
        points, vector = points.copy(), vector.copy()
        points[place], vector[place] = points[place[order]], vector[place[order]]
        key = owner * round + number
        edge = np.flatnonzero(np.r_[True, key[order][1:] != key[order][:-1]])
        begins = place[edge]
        parent = owner[order][edge]
        ends = np.r_[begins[1:], 0]
        final = np.r_[parent[1:] != parent[:-1], True]
        ends[final] = end[split][parent[final]]
        children[split] = np.bincount(parent, minlength=len(split))
        child[split] = made + np.cumsum(children[split]) - children[split]
        levels.append([part[split][parent], begins, ends, np.maximum.reduceat(distance[order], edge)])
        made += len(begins)
    part, start, end, far = (np.concatenate(column) for column in zip(*levels))
    child, children = (np.concatenate(column) for column in zip(*links))
    return CoverTrees(points, vector, part, start, end, far, child, children)


def nearest(points: np.ndarray, part: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the nearest entry, squared distance to it and to the second nearest) of each point, from the codebooks
    (part, entry, width); the lower index on ties."""
    distance = np.zeros((len(points), books.shape[1]), np.int64)
    for at in range(books.shape[2]):
        difference = points[:, at, None] - books[part, :, at]
        difference *= difference
        distance += difference
    best = distance.argmin(axis=1)
    rows = np.arange(len(points))
    least = distance[rows, best]
    distance[rows, best] = np.iinfo(np.int64).max
    return best, least, distance.min(axis=1)


def assign(trees: CoverTrees, books: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, start, end, entry) of ranges of points that go to an entry together; together they are all points."""
    nodes = np.arange(len(books))  # the roots
    while len(nodes):
        part, start, end = trees.part[nodes], trees.start[nodes], trees.end[nodes]
        best, least, second = nearest(trees.points[start], part, books)
        radius = np.sqrt(trees.far[nodes].astype(np.float64))
        # With a margin for rounding, below which a subtree is not decided as a whole.
        sure = (np.sqrt(least.astype(np.float64)) + 2 * radius) * (1 + 1e-9) < np.sqrt(second.astype(np.float64))
        sure |= trees.far[nodes] == 0
        yield part[sure], start[sure], end[sure], best[sure]
        inner = ~sure & (trees.children[nodes] > 0)
        leaf = ~sure & ~inner
        if leaf.any():
            sizes = end[leaf] - start[leaf]
            place = np.arange(sizes.sum()) + np.repeat(start[leaf] - (np.cumsum(sizes) - sizes), sizes)
            of = np.repeat(part[leaf], sizes)
            yield of, place, place + 1, nearest(trees.points[place], of, books)[0]
        counts = trees.children[nodes[inner]]
        nodes = np.arange(counts.sum()) + np.repeat(trees.child[nodes[inner]] - (np.cumsum(counts) - counts), counts)


ARRAYS = ("vector", "part", "start", "end", "far", "child", "children")
BLOCKS = "ids array<long>, labels array<{label}>, points binary, " + ", ".join(f"{name} binary" for name in ARRAYS)


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return vector.isNotNull() & F.coalesce(F.forall(vector, number), F.lit(False))


def integers(vector: Column, width: int) -> Column:
    """The components as integers, filled up with zeros to `width`."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return F.concat(whole, F.array_repeat(F.lit(0).cast("long"), F.greatest(F.lit(0), F.lit(width) - F.size(vector))))


def _trees(batch: pa.RecordBatch, row: int) -> CoverTrees:
    column = {name: np.frombuffer(batch.column(name)[row].as_buffer(), np.int64) for name in (*ARRAYS, "points")}
    points = column.pop("points")
    return CoverTrees(points=points.reshape(len(column["vector"]), -1), **column)


@dataclass(frozen=True)
class Codebooks:
    """`entries` (part, entry, width) as nested lists."""

    entries: list

    @property
    def array(self) -> np.ndarray:
        return np.array(self.entries, np.int64)


class VectorBlocks:
    """The vectors of a table (vec_id, embedding, label) in blocks with their trees, in the shared folder."""

    def __init__(self, embeddings: DataFrame, parts: int = 16):
        self.parts = parts
        self.label = embeddings.schema["label"].dataType.simpleString()
        kept = embeddings.select("vec_id", "embedding", "label").where(usable(F.col("embedding")))
        longest, largest, self.rows = kept.agg(
            F.max(F.size("embedding")), F.max(F.array_max(F.transform("embedding", F.abs))), F.count(F.lit(1))
        ).first()
        if (largest or 0) * SCALE > LARGEST:
            raise ValueError(f"components of up to {largest} are beyond {LARGEST // SCALE}")
        self.width = max(1, -(-(longest or 0) // parts))
        self.vectors = kept.select("vec_id", "label", integers(F.col("embedding"), self.width * parts).alias("vector"))
        self.blocks = materialize(self._blocks())

    def _blocks(self) -> DataFrame:
        parts, width = self.parts, self.width

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            vectors = batch.column("vector").flatten().to_numpy().reshape(batch.num_rows, parts, width)
            trees = cover_trees(np.ascontiguousarray(vectors.transpose(1, 0, 2)))
            lists = [pa.array([batch.column(name).to_pylist()], pa.list_(batch.schema.field(name).type)) for name in ("vec_id", "label")]
            arrays = [pa.array([np.ascontiguousarray(getattr(trees, name), np.int64).tobytes()], pa.binary()) for name in ("points", *ARRAYS)]
            return pa.RecordBatch.from_arrays([*lists, *arrays], ["ids", "labels", "points", *ARRAYS])

        rows = max(1, min(BLOCK, BLOCK_COMPONENTS // (parts * width)))
        return map_batches(self.vectors, each, BLOCKS.format(label=self.label), rows=rows)

    def first_entries(self, entries: int) -> Codebooks:
        first = self.vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
        rows = np.array([row.vector for row in first], np.int64).reshape(len(first), self.parts, self.width)
        return Codebooks(rows.transpose(1, 0, 2).tolist())

    def improved(self, books: Codebooks) -> Codebooks:
        """One round: every part to its nearest entry, every entry to the floor of the mean of its parts."""
        width = self.width

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            entries = books.array
            sums, counts = np.zeros(entries.shape, np.int64), np.zeros(entries.shape[:2], np.int64)
            for row in range(batch.num_rows):
                trees = _trees(batch, row)
                running = np.concatenate([np.zeros((1, width), np.int64), np.cumsum(trees.points, axis=0)])
                for part, start, end, entry in assign(trees, entries):
                    np.add.at(sums, (part, entry), running[end] - running[start])
                    np.add.at(counts, (part, entry), end - start)
            part, entry = np.nonzero(counts)
            columns = [pa.array(part), pa.array(entry), pa.array(counts[part, entry]), pa.array(list(sums[part, entry]), pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "sums"])

        found = map_batches(self.blocks, each, "part long, entry long, n long, sums array<long>", rows=8)
        total = [F.sum(F.col("sums")[at]).alias(f"s{at}") for at in range(width)]
        rows = found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *total).collect()
        entries = books.array
        for row in rows:
            entries[row.part, row.entry] = [row[f"s{at}"] // row.n for at in range(width)]
        return Codebooks(entries.tolist())

    def encoded(self, books: Codebooks) -> DataFrame:
        """(vec_id, label, code: binary, error: long) of every vector."""
        parts = self.parts

        def each(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            entries = books.array
            for row in range(batch.num_rows):
                trees = _trees(batch, row)
                ids, labels = batch.column("ids")[row].values, batch.column("labels")[row].values
                of = np.empty(len(trees.points), np.int64)
                for part, start, end, entry in assign(trees, entries):
                    sizes = end - start
                    place = np.arange(sizes.sum()) + np.repeat(start - (np.cumsum(sizes) - sizes), sizes)
                    of[place] = np.repeat(entry, sizes)
                part = np.repeat(np.arange(parts), len(ids))
                away = squared(trees.points, entries[part, of])
                codes, error = np.empty((len(ids), parts), np.uint8), np.zeros(len(ids), np.int64)
                codes[trees.vector, part] = of
                np.add.at(error, trees.vector, away)
                packed = pa.array([code.tobytes() for code in codes], pa.binary())
                yield pa.RecordBatch.from_arrays([ids, labels, packed, pa.array(error)], ["vec_id", "label", "code", "error"])

        return map_batches(self.blocks, each, f"vec_id long, label {self.label}, code binary, error long", rows=8)


def fit(blocks: VectorBlocks, entries: int = 64, rounds: int = 2) -> Codebooks:
    """Codebooks of at most 256 `entries`, from those of the smallest ids by `rounds` rounds over all vectors."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte to a part")
    books = blocks.first_entries(entries)
    for _ in range(rounds if blocks.rows else 0):
        books = blocks.improved(books)
    return books


def with_label_errors(encoded: DataFrame, rows: int) -> DataFrame:
    """`encoded`, of `rows` rows, with label_error: the sum of the errors of all vectors of its label."""
    stored = materialize(encoded)
    totals = materialize(stored.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("_rows")))
    return spread_join(stored, totals, ["label"], "_rows", rows).drop("_rows")
