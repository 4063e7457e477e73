"""Near-duplicate vectors by binary codes of a random rotation.

Each unit vector is rotated at random and kept as the signs of its coordinates, with a correction factor:
the inner product of the vector and its code. The code of one vector and the coordinates of
another give an unbiased estimate of their inner product, and the factor a bound of its error.
Pairs whose bounds exclude the threshold are dropped; all others are recomputed exactly, in double
precision.

Equal vectors of a label are one class: only its first row is coded and compared, with the number of its copies, so
n copies cost n rows and not the pairs between them. Copies link with each other.

Labels of up to `TILE` different vectors are compared in full. In larger ones the pairs to estimate come from tables
keyed by signs of random projections. Vectors at the threshold differ in a sign with a known chance, and
no sign serves two tables, so tables miss a pair independently: the number of signs per key (from
the size of the label) and of tables (from the miss rate) follow from the data. A pair is counted in
the first table where its keys agree. Groups of more than `TILE` vectors are cut into chunks that meet
pairwise in tiles.

Vectors link only when their labels are equal and not null, and their lengths are equal. Vectors that are null,
zero, empty, or hold null or non-finite components link with nothing, and neither do rows without a
vec_id. Rows that repeat a vec_id are vectors of their own with one component. An empty table gives
an empty one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import connected_components, map_batches, materialize, ship, spread_join

SEED = 42
#: Coordinates of a code at least.
CODE_BITS = 64
TILE = 2048
#: Vectors of a label that share a key by chance, about.
CROWD = 48
#: Chance that a pair at the threshold agrees in no table.
MISS = 0.01
#: Width of the error bound of estimates, in standard deviations or more.
CONFIDENCE = 4.0
#: Pairs that are recomputed at once.
PAIRS = 1 << 16

COLUMNS = ["row", "vec_id", "copies", "label", "dim", "keys", "factor", "code", "vector"]
CODED = "row long, vec_id long, copies long, label long, dim int, keys array<int>, factor double, code binary, vector binary"


@functools.cache
def rotation(dim: int) -> np.ndarray:
    """A random orthogonal matrix for vectors padded to `dim` coordinates."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def padded(dim: int) -> int:
    return max(CODE_BITS, -(-dim // 8) * 8)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in double precision, scaled first so that squares do not overflow."""
    wide = vectors.astype(np.float64)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def rotated(units: np.ndarray) -> np.ndarray:
    size = padded(units.shape[1])
    full = np.zeros((len(units), size))
    full[:, : units.shape[1]] = units
    return full @ rotation(size)


def key_tables(width: int, threshold: float) -> int:
    """How many tables of independent keys miss a pair at the threshold with a chance of MISS."""
    if not width:
        return 1
    differ = np.arccos(threshold) / np.pi
    return int(np.ceil(np.log(MISS) / np.log(1 - (1 - differ) ** width)))


@functools.cache
def directions(dim: int, n: int) -> np.ndarray:
    """(dim, n): independent random directions, which are not those of the rotation."""
    return np.random.default_rng([SEED, 1]).standard_normal((n, dim)).T


def table_keys(units: np.ndarray, width: int, tables: int) -> np.ndarray:
    """(n, tables): the key of each vector in each table, all 0 for keys without signs."""
    if not width:
        return np.zeros((len(units), tables), dtype=np.int32)
    signs = (units @ directions(units.shape[1], width * tables) > 0).reshape(len(units), tables, width)
    return (signs @ (1 << np.arange(width))).astype(np.int32)


def usable(rows: DataFrame) -> DataFrame:
    """The rows that can link."""

    def odd(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    there = rows.where("vec_id is not null and label is not null and embedding is not null")
    sound = there.where(~F.exists("embedding", odd) & F.exists("embedding", lambda x: x != 0))
    return sound.withColumn("label", F.col("label").cast("long"))


def classes(rows: DataFrame) -> DataFrame:
    """(label, embedding, row, vec_id, copies): each different vector of a label once, with the first row and id that have it."""
    first = [F.min(c).alias(c) for c in ("row", "vec_id")]
    return rows.groupBy("label", "embedding").agg(*first, F.count(F.lit(1)).alias("copies"))


def coded(vectors: DataFrame, threshold: float) -> DataFrame:
    """Codes, factors, keys and vectors of `classes`."""
    precise = vectors.schema["embedding"].dataType.elementType.typeName() != "float"
    kind = np.float64 if precise else np.float32

    def encode(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        rows, ids, copies, labels = (batch.column(c).to_numpy() for c in ("row", "vec_id", "copies", "label"))
        found = [np.array(v, dtype=kind) for v in batch.column("embedding").to_pylist()]
        sizes = np.array([len(v) for v in found])
        widths = batch.column("width").to_numpy()
        for dim, width in np.unique(np.stack([sizes, widths]), axis=1).T.tolist():
            at = np.flatnonzero((sizes == dim) & (widths == width))
            stacked = np.stack([found[i] for i in at])
            units = unit_rows(stacked)
            turned = rotated(units)
            codes = np.packbits(turned > 0, axis=1, bitorder="little")
            keys = table_keys(units, width, key_tables(width, threshold))
            factors = np.abs(turned).sum(axis=1) / np.sqrt(turned.shape[1])
            columns = [
                pa.array(rows[at].astype(np.int64)),
                pa.array(ids[at].astype(np.int64)),
                pa.array(copies[at].astype(np.int64)),
                pa.array(labels[at].astype(np.int64)),
                pa.array(np.full(len(at), dim, np.int32)),
                pa.ListArray.from_arrays(
                    pa.array(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)), pa.array(keys.ravel())
                ),
                pa.array(factors),
                pa.array([code.tobytes() for code in codes], pa.binary()),
                pa.array([vector.tobytes() for vector in stacked], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, COLUMNS)

    rows = vectors.withColumn("dim", F.size("embedding"))
    # Labels of more than a tile, so the table has fewer rows than there are tiles.
    large = rows.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > TILE)
    exact = F.round(F.log2(F.col("n") / F.lit(float(CROWD)))).cast("int")
    width = F.greatest(F.lit(4), F.least(F.lit(24), exact))
    widths = large.select("label", "dim", width.alias("width"))
    placed = rows.join(F.broadcast(widths), ["label", "dim"], "left").withColumn("width", F.coalesce("width", F.lit(0)))
    return map_batches(placed.drop("dim"), encode, CODED, rows=2000)


def may_link(turned: np.ndarray, signs: np.ndarray, factors: np.ndarray, threshold: float) -> np.ndarray:
    """(n, n): whether the bounds of the estimates allow a cosine of `threshold`, both ways."""
    size = turned.shape[1]
    estimates = (signs @ turned.T) / (np.sqrt(size) * factors)[:, None]
    bounds = CONFIDENCE * np.sqrt((1 - factors**2).clip(0) / (factors**2 * (size - 1)))
    upper = estimates + bounds[:, None] >= threshold
    return upper & upper.T


def tile_links(tile: dict[str, np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of one tile with cosines of `threshold` or more whose keys agree in no earlier table."""
    units = unit_rows(tile["vector"])
    turned = rotated(units)
    signs = np.unpackbits(tile["code"], axis=1, bitorder="little").astype(np.float64) * 2 - 1
    allowed = np.triu(may_link(turned, signs, tile["factor"], threshold), 1)
    chunks = tile["mine"]
    if chunks.min() != chunks.max():
        allowed &= chunks[:, None] != chunks
    i, j = np.nonzero(allowed)
    for keys in tile["earlier"].T:
        apart = keys[i] != keys[j]
        i, j = i[apart], j[apart]
    close = [
        np.einsum("nd,nd->n", units[i[a : a + PAIRS]], units[j[a : a + PAIRS]]) >= threshold
        for a in range(0, len(i), PAIRS)
    ]
    near = np.concatenate(close) if close else np.zeros(0, dtype=bool)
    return i[near], j[near]


def spanning(i: np.ndarray, j: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Pairs that join what (i, j) join."""
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for a, b in zip(i.tolist(), j.tolist()):
        x, y = find(a), find(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


TILE_KEY = ["label", "dim", "t", "key", "low", "high"]


def tiles(rows: DataFrame) -> DataFrame:
    """`rows` once per table and tile, with their place (label, dim, t, key, low, high), chunk and keys of
    earlier tables."""
    keyed = rows.select("*", F.posexplode("keys").alias("t", "key"))
    keyed = keyed.withColumn("earlier", F.slice("keys", 1, F.col("t"))).drop("keys")
    crowded = (
        keyed.groupBy("label", "dim", "t", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > TILE)
        .select("label", "dim", "t", "key", F.ceil(F.col("n") / (TILE // 2)).cast("int").alias("chunks"))
    )
    mine = F.coalesce(F.pmod(F.xxhash64("row"), "chunks").cast("int"), F.lit(0)).alias("mine")
    others = F.sequence(F.lit(0), F.coalesce(F.col("chunks") - 1, F.lit(0)))
    return (
        keyed.join(crowded, ["label", "dim", "t", "key"], "left")
        .select("*", mine, F.explode(others).alias("other"))
        .withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})
        .drop("chunks", "other")
    )


def links(rows: DataFrame, threshold: float) -> DataFrame:
    """(row, n) counts of links per tile to vectors of other classes, and edges (a, b) of vec_ids that connect all
    linked classes."""
    ship(rows.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            if held.num_rows < 4 * TILE:
                continue
            bounds = starts(held)
            yield from compare(held.slice(0, bounds[-1]), bounds)
            held = held.slice(bounds[-1]).combine_chunks()
        if held is not None and held.num_rows:
            yield from compare(held, [*starts(held), held.num_rows])

    def starts(table: pa.Table) -> list[int]:
        new = np.zeros(table.num_rows, dtype=bool)
        new[0] = True
        for name in TILE_KEY:
            values = table.column(name).to_numpy()
            new[1:] |= values[1:] != values[:-1]
        return np.flatnonzero(new).tolist()

    def compare(table: pa.Table, bounds: list[int]) -> Iterator[pa.RecordBatch]:
        numbers = {c: table.column(c).to_numpy() for c in ("row", "vec_id", "copies", "dim", "factor", "t", "mine")}
        raw = {c: table.column(c) for c in ("code", "vector", "earlier")}
        out: list[list] = [[], [], [], []]
        for a, b in zip(bounds, bounds[1:]):
            if b - a < 2:
                continue
            tile = {c: values[a:b] for c, values in numbers.items()}
            for name, kind in (("code", np.uint8), ("vector", None)):
                joined = b"".join(raw[name].slice(a, b - a).to_pylist())
                if kind is None:
                    kind = np.float32 if len(joined) == 4 * (b - a) * int(tile["dim"][0]) else np.float64
                tile[name] = np.frombuffer(joined, kind).reshape(b - a, -1)
            earlier = raw["earlier"].slice(a, b - a).combine_chunks().flatten()
            tile["earlier"] = earlier.to_numpy().reshape(b - a, int(tile["t"][0]))
            i, j = tile_links(tile, threshold)
            if not len(i):
                continue
            counts = np.zeros(b - a, np.int64)
            np.add.at(counts, i, tile["copies"][j])
            np.add.at(counts, j, tile["copies"][i])
            linked = np.flatnonzero(counts)
            edges = [(tile["vec_id"][x], tile["vec_id"][y]) for x, y in spanning(i, j, b - a)]
            none = [None]
            for column, values in zip(
                out,
                (
                    tile["row"][linked].tolist() + none * len(edges),
                    counts[linked].tolist() + none * len(edges),
                    none * len(linked) + [int(x) for x, _ in edges],
                    none * len(linked) + [int(y) for _, y in edges],
                ),
            ):
                column.extend(values)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["row", "n", "a", "b"])

    placed = tiles(rows).repartition(*TILE_KEY).sortWithinPartitions(*TILE_KEY)
    wanted = [*TILE_KEY, "mine", "row", "vec_id", "copies", "earlier", "factor", "code", "vector"]
    return placed.select(*wanted).mapInArrow(each, "row long, n long, a long, b long")


def near_vectors(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of `vectors` (vec_id, embedding, label)."""
    rows = materialize(
        vectors.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "embedding")
    )
    sound = usable(rows)
    total = rows.count()
    groups = materialize(classes(sound))
    found = materialize(links(materialize(coded(groups, threshold)), threshold))
    named = groups.select("label", "embedding", "copies", F.col("row").alias("class"), F.col("vec_id").alias("first"))
    members = materialize(
        spread_join(sound, named, ["label", "embedding"], "copies", total).select("row", "vec_id", "class", "first")
    )
    # An id that stands in several classes joins them.
    several = members.groupBy("vec_id").agg(F.min("first").alias("least"), F.max("first").alias("most")).where("least < most")
    shared = members.join(several, "vec_id", "left_semi").select(F.col("vec_id").alias("a"), F.col("first").alias("b"))
    components = connected_components(found.where("a is not null").select("a", "b").unionByName(shared))
    counts = found.where("row is not null").groupBy("row").agg(F.sum("n").alias("n"))
    known = materialize(
        named.drop("label", "embedding")
        .join(counts, F.col("class") == F.col("row"), "left")
        .join(components, F.col("first") == F.col("node"), "left")
        .select(
            "class",
            "copies",
            (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"),
            F.coalesce("component", "first").alias("component"),
        )
    )
    linked = spread_join(members, known, ["class"], "copies", total).select("row", "vec_id", "n_links", "component")
    # Rows that cannot link have the component of their id too.
    ids = linked.groupBy("vec_id").agg(F.min("component").alias("component"))
    component = F.coalesce("component", "vec_id")
    return (
        rows.select("row", "vec_id")
        .join(linked.select("row", "n_links"), "row", "left")
        .join(ids, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).alias("n_links"),
            component.alias("component_id"),
            F.col("vec_id").eqNullSafe(component).alias("kept"),
        )
    )
