"""Second-order boosting: trees grown on sums of gradients and hessians, level by level.

Values are cut into bins by `quantile_cuts`, a byte to a value, with a bin of its own for missing ones. For
each level of a tree tasks add up the log loss's gradients and hessians by (node, feature, bin) and Spark adds up
the tasks' sums, a feature at a time. A split is worth
`GL²/(HL+l2) + GR²/(HR+l2) - G²/(H+l2)`, halved, less `gamma`; missing values are tried on both sides and go where
that is worth more. A leaf is worth `-G/(H+l2)` times the step size. Sums are of integers, gradients and hessians
being rounded to a power of two, so a fit does not depend on how rows are spread over tasks.

A task holds (nodes of a level) x features x bins x 16 bytes, the driver one split to a node and feature. Rows are read
once a level and written anew, with their margins, every `CUT` trees, which cuts the lineage too.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.operators.quantiles import matrix, quantile_cuts
from holdfast.operators.trees import TreeModel
from holdfast.runtime import materialize, remove, ship

#: Trees between two writings of the margins, and tasks whose sums are added up at a time.
CUT = 10
FAN_IN = 64
#: Values of rows and features that a task has, at least.
TASK_CELLS = 1 << 20
#: A split must be worth more than this.
LEAST_GAIN = 1e-6


class Growing:
    """A tree of bins under way: nodes as lists, of which the open ones may be split."""

    def __init__(self):
        self.feature, self.bin, self.missing_left, self.left, self.right, self.sums = [-1], [0], [True], [0], [0], [(0.0, 0.0)]

    def split(self, node: int, feature: int, bin: int, missing_left: bool, left: tuple, right: tuple) -> list[int]:
        children = [len(self.feature), len(self.feature) + 1]
        self.feature[node], self.bin[node], self.missing_left[node] = feature, bin, missing_left
        self.left[node], self.right[node] = children
        for child, sums in zip(children, (left, right)):
            self.feature.append(-1)
            self.bin.append(0)
            self.missing_left.append(True)
            self.left.append(child)
            self.right.append(child)
            self.sums.append(sums)
        return children


class Binned:
    """The arrays that a task needs to send binned rows down a tree."""

    def __init__(self, tree: Growing, values: np.ndarray | None = None):
        self.feature, self.bin = np.array(tree.feature), np.array(tree.bin)
        self.missing_left, self.left, self.right = np.array(tree.missing_left), np.array(tree.left), np.array(tree.right)
        self.values = values

    def walk(self, bins: np.ndarray, depth: int) -> np.ndarray:
        at, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        for _ in range(depth):
            value = bins[rows, np.maximum(self.feature[at], 0)]
            left = np.where(value == 0, self.missing_left[at], value <= self.bin[at])
            at = np.where(left, self.left[at], self.right[at])
        return at


def binned_rows(rows: DataFrame, cuts: dict[int, list[float]], max_bins: int) -> DataFrame:
    """(label: byte, bins: binary, margin 0) of rows (label, values); bin 0 is missing, bin i + 1 begins at cut i."""
    kind = np.uint8 if max_bins < 256 else np.uint16

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            values = matrix(batch.column(1))
            bins = np.empty(values.shape, kind)
            for feature in range(values.shape[1]):
                place = np.searchsorted(cuts.get(feature, []), values[:, feature], "right") + 1
                bins[:, feature] = np.where(np.isnan(values[:, feature]), 0, place)
            packed = pa.array([row.tobytes() for row in bins], pa.binary())
            columns = [batch.column(0), packed, pa.array(np.zeros(len(bins)))]
            yield pa.RecordBatch.from_arrays(columns, ["label", "bins", "margin"])

    return rows.select(F.col("label").cast("byte").alias("label"), "values").mapInArrow(each, "label byte, bins binary, margin double")


def _unpacked(batch: pa.RecordBatch, width: int, kind) -> np.ndarray:
    column = batch.column("bins")
    data = np.frombuffer(column.buffers()[2], np.uint8)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    return data[offsets[0] : offsets[-1]].view(kind).reshape(len(column), width)


def _margins(batch: pa.RecordBatch, bins: np.ndarray, since: list[Binned], depth: int) -> np.ndarray:
    margin = batch.column("margin").to_numpy().copy()
    for tree in since:
        margin += tree.values[tree.walk(bins, depth)]
    return margin


class Fit:
    """What stays the same during a fit."""

    def __init__(self, width: int, n: int, max_bins: int, depth: int, l2: float, gamma: float, least_weight: float):
        self.width, self.depth, self.l2, self.gamma, self.least_weight = width, depth, l2, gamma, least_weight
        self.kind = np.uint8 if max_bins < 256 else np.uint16
        self.cells = max_bins + 1
        # Gradients are at most 1, so n of them fit a long, and those of a batch a double's 53 bits.
        self.scale = 2.0 ** min(36, 62 - max(1, n).bit_length())

    def sums(self, state: DataFrame, since: list[Binned], tree: Binned, open_nodes: list[int], level: int) -> DataFrame:
        """(feature, part, sums: binary of longs (node, bin, gradient and hessian)), one row per feature and task."""
        width, cells, depth, scale, kind = self.width, self.cells, self.depth, self.scale, self.kind

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place = np.full(len(tree.feature), -1)
            place[open_nodes] = np.arange(len(open_nodes))
            total = np.zeros((len(open_nodes), width, cells, 2), np.int64)
            seen = 0
            for batch in batches:
                if not batch.num_rows:
                    continue
                bins = _unpacked(batch, width, kind)
                chance = 1 / (1 + np.exp(-_margins(batch, bins, since, depth)))
                node = place[tree.walk(bins, level)]
                mine = node >= 0
                seen += int(mine.sum())
                slope = np.rint((chance - batch.column("label").to_numpy()) * scale)[mine]
                curve = np.rint(np.maximum(chance * (1 - chance), 1e-16) * scale)[mine]
                for feature in range(width):
                    cell = node[mine] * cells + bins[mine, feature]
                    for which, weights in enumerate((slope, curve)):
                        counted = np.bincount(cell, weights, len(open_nodes) * cells)
                        total[:, feature, :, which] += counted.astype(np.int64).reshape(-1, cells)
            if seen:
                part = TaskContext.get().partitionId() % FAN_IN
                packed = pa.array([np.ascontiguousarray(total[:, feature]).tobytes() for feature in range(width)], pa.binary())
                columns = [pa.array(np.arange(width, dtype=np.int32)), pa.array(np.full(width, part, np.int32)), packed]
                yield pa.RecordBatch.from_arrays(columns, ["feature", "part", "sums"])

        return state.mapInArrow(each, "feature int, part int, sums binary")

    def best_splits(self, sums: DataFrame, n_nodes: int, many: bool) -> list:
        """The best split of each open node by each feature, and the node's sums, from the sums of all tasks."""
        cells, scale, l2, least_weight = self.cells, self.scale, self.l2, self.least_weight
        shape = (n_nodes, cells, 2)

        def added(batches: Iterator[pa.RecordBatch], *key: str) -> dict:
            total: dict = {}
            for batch in batches:
                for *at, packed in zip(*[batch.column(name).to_pylist() for name in key], batch.column("sums")):
                    mine = total.setdefault(tuple(at), np.zeros(shape, np.int64))
                    mine += np.frombuffer(packed.as_buffer(), np.int64).reshape(shape)
            return total

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (feature, part), total in added(batches, "feature", "part").items():
                columns = [pa.array([feature], pa.int32()), pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["feature", "part", "sums"])

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            node = pa.array(np.arange(n_nodes, dtype=np.int32))
            for (feature,), total in added(batches, "feature").items():
                found = split_of_feature(total / scale, l2, least_weight)
                named = {"feature": pa.array(np.full(n_nodes, feature, np.int32)), "node": node} | found
                yield pa.RecordBatch.from_arrays([pa.array(column) for column in named.values()], list(named))

        tasks = -(-self.width * n_nodes * cells // TASK_CELLS)
        if many:
            sums = sums.repartition(FAN_IN * tasks, "feature", "part").mapInArrow(partial, "feature int, part int, sums binary")
        schema = "feature int, node int, gain double, bin int, missing_left boolean, gl double, hl double, g double, h double"
        return sums.repartition(tasks, "feature").mapInArrow(best, schema).collect()


def split_of_feature(sums: np.ndarray, l2: float, least_weight: float) -> dict[str, np.ndarray]:
    """The best split of each node by one feature, from sums (node, bin, gradient and hessian): values up to `bin` go
    left. Of equal ones the one with missing values on the right, then the lower bin."""
    missing, whole = sums[:, 0], sums.sum(axis=1)
    below = np.cumsum(sums[:, 1:], axis=1)  # all values to the left at last, missing ones to the right
    sides = np.stack([below, below + missing[:, None]])
    rest = whole[:, None] - sides

    def worth(part: np.ndarray) -> np.ndarray:
        return part[..., 0] ** 2 / (part[..., 1] + l2)

    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (worth(sides) + worth(rest) - worth(whole)[:, None]) / 2
    fine = (sides[..., 1] >= least_weight) & (rest[..., 1] >= least_weight)
    gain = np.where(fine & np.isfinite(gain), gain, -np.inf)
    flat = gain.transpose(1, 0, 2).reshape(len(sums), -1)
    at = flat.argmax(axis=1)
    side, bin = at // below.shape[1], at % below.shape[1]
    nodes = np.arange(len(sums))
    left = sides[side, nodes, bin]
    return {
        "gain": flat[nodes, at], "bin": (bin + 1).astype(np.int32), "missing_left": side == 1,
        "gl": left[:, 0], "hl": left[:, 1], "g": whole[:, 0], "h": whole[:, 1],
    }


def fit_second_order(
    rows: DataFrame,
    max_iter: int,
    max_depth: int,
    step_size: float,
    l2: float = 1.0,
    gamma: float = 0.0,
    least_weight: float = 1.0,
    max_bins: int = 255,
) -> TreeModel:
    """Fit on rows (label 0/1, values: array of numbers; null or NaN where missing).

    `least_weight` is the least sum of hessians of a child, `gamma` what a split must be worth.
    """
    spark = rows.sparkSession
    ship(spark)
    table = materialize(rows.select(F.col("label").cast("byte").alias("label"), "values"))
    n, width = table.agg(F.count(F.lit(1)), F.max(F.size("values"))).first()
    if not n or not width:
        raise ValueError("no rows or no features to learn from")
    cuts = quantile_cuts(table, max_bins)
    tasks = -(-n * width // TASK_CELLS)  # few enough that starting a task does not outweigh its work
    state = materialize(binned_rows(table, cuts, max_bins).coalesce(tasks))
    _discard(table)
    many = len(state.inputFiles()) > FAN_IN
    fit = Fit(width, n, max_bins, max_depth, l2, gamma, least_weight)
    grown: list[Growing] = []
    since: list[Binned] = []
    for number in range(max_iter):
        tree, open_nodes = Growing(), [0]
        for level in range(max_depth):
            if not open_nodes:
                break
            found = fit.best_splits(fit.sums(state, since, Binned(tree), open_nodes, level), len(open_nodes), many)
            best = {}
            for row in sorted(found, key=lambda row: row.feature):
                if row.node not in best or row.gain > best[row.node].gain:
                    best[row.node] = row
            children = []
            for place, node in enumerate(open_nodes):
                row = best[place]
                tree.sums[node] = row.g, row.h
                if row.gain - gamma > LEAST_GAIN:
                    left, right = (row.gl, row.hl), (row.g - row.gl, row.h - row.hl)
                    children += tree.split(node, row.feature, row.bin, row.missing_left, left, right)
            open_nodes = [child for child in children if tree.sums[child][1] >= 2 * least_weight]
        values = np.array([-g / (h + l2) * step_size if h + l2 else 0.0 for g, h in tree.sums])
        grown.append(tree)
        since.append(Binned(tree, values))
        if len(since) == CUT and number + 1 < max_iter:
            state = _with_margins(state, fit, since)
            since = []
    _discard(state)
    return _model(grown, cuts, l2, step_size)


def _discard(table: DataFrame) -> None:
    for folder in {os.path.dirname(file) for file in table.inputFiles()}:
        remove(table.sparkSession, folder)


def _with_margins(state: DataFrame, fit: Fit, since: list[Binned]) -> DataFrame:
    width, kind, depth = fit.width, fit.kind, fit.depth

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                margin = pa.array(_margins(batch, _unpacked(batch, width, kind), since, depth))
                yield pa.RecordBatch.from_arrays([batch.column("label"), batch.column("bins"), margin], ["label", "bins", "margin"])

    older, state = state, materialize(state.mapInArrow(each, state.schema))
    _discard(older)
    return state


def _model(grown: list[Growing], cuts: dict[int, list[float]], l2: float, step_size: float) -> TreeModel:
    start = np.cumsum([0] + [len(tree.feature) for tree in grown])

    def threshold(feature: int, bin: int) -> float:
        # Values of bins up to `bin` are below the cut at which the next begins; after the last all values are.
        mine = cuts.get(feature, [])
        return mine[bin - 1] if 0 < bin <= len(mine) else float("inf")

    every = [
        (f, threshold(f, b) if f >= 0 else 0.0, m, s + left, s + right, -g / (h + l2) * step_size if f < 0 and h + l2 else 0.0)
        for tree, s in zip(grown, start)
        for f, b, m, left, right, (g, h) in zip(tree.feature, tree.bin, tree.missing_left, tree.left, tree.right, tree.sums)
    ]
    feature, cut, missing_left, left, right, value = zip(*every)
    return TreeModel(
        start[:-1], np.array(feature), np.array(cut), np.array(missing_left), np.array(left), np.array(right), np.array(value)
    )
