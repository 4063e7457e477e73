"""Cut points of number columns, from a mergeable summary of all rows.

A summary counts the values of a feature in cells. The first cells are equal parts of the range between its
least and greatest value; a cell that holds too much is cut in the same way, between the least and greatest value
that it holds, in the next pass, until none does or it holds a single value. Counts, least and greatest values of
cells add up in any order, so the summary depends on the values and weights alone and not on their layout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.runtime import materialize, ship

#: Parts of a cell, and entries that a task holds before it adds equal ones up.
PARTS = 4096
PENDING = 1 << 20

#: Number of cells of one bin's weight, at least: a bin is off by at most one cell, a quarter of its weight.
FINENESS = 4

CELLS = "feature int, cell long, weight long, least double, most double"


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows, with NaN for nulls; infinite values as the greatest finite ones."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    largest = np.finfo(np.float64).max
    return np.clip(values, -largest, largest).reshape(len(column), -1)


def _added(keys: np.ndarray, weights: np.ndarray, least: np.ndarray, most: np.ndarray):
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return (
        keys[first],
        np.add.reduceat(weights[order], first),
        np.minimum.reduceat(least[order], first),
        np.maximum.reduceat(most[order], first),
    )


def _cells(rows: DataFrame, weight: str | None, open_cells: dict[int, np.ndarray] | None) -> DataFrame:
    """The cells within each open cell (least, most; sorted, disjoint) of each feature; all as one cell at first."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        pending = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            found = matrix(batch.column(0))
            weights = np.ones(len(found), np.int64) if weight is None else batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for feature in range(found.shape[1]) if open_cells is None else open_cells:
                values = found[:, feature]
                there = ~np.isnan(values) & (weights > 0)
                values, heavy = values[there], weights[there]
                cell = np.zeros(len(values), np.int64)
                if open_cells is not None:
                    least, most = open_cells[feature]
                    at = np.searchsorted(least, values, "right") - 1
                    inside = (at >= 0) & (values <= most[at])
                    values, heavy, at = values[inside], heavy[inside], at[inside]
                    span = np.maximum(most[at] / 2 - least[at] / 2, np.finfo(np.float64).tiny)
                    part = np.clip((values / 2 - least[at] / 2) / span * PARTS, 0, PARTS - 1).astype(np.int64)
                    # The ends part even where the range is too small to divide.
                    part[values == most[at]] = PARTS - 1
                    part[values == least[at]] = 0
                    cell = at * PARTS + part
                if len(values):
                    keys, *rest = _added(cell, heavy, values, values)
                    held.append((np.full(len(keys), feature, np.int32), keys, *rest))
                    pending += len(keys)
            if pending > PENDING:
                held = [_merged(held)]
                pending = len(held[0][0])
        if held:
            columns = _merged(held)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["feature", "cell", "weight", "least", "most"])

    ship(rows.sparkSession)
    columns = ["values"] if weight is None else ["values", F.col(weight).cast("long").alias("weight")]
    return (
        rows.select(*columns)
        .mapInArrow(each, CELLS)
        .groupBy("feature", "cell")
        .agg(F.sum("weight").alias("weight"), F.min("least").alias("least"), F.max("most").alias("most"))
    )


def _merged(held: list) -> tuple:
    feature, cell, weight, least, most = (np.concatenate(column) for column in zip(*held))
    width = int(cell.max()) + 1
    keys, weight, least, most = _added(feature.astype(np.int64) * width + cell, weight, least, most)
    return (keys // width).astype(np.int32), keys % width, weight, least, most


def summary(rows: DataFrame, max_bins: int, weight: str | None = None) -> DataFrame:
    """(feature, weight, least, most): disjoint cells of the values of `rows` (values: array of numbers), which are light or
    hold a single value; of features with at most `max_bins` cells all do.

    Nulls and NaN are left out; `weight` names a column of whole numbers. What the driver holds is
    the cells still open, which are at most `FINENESS * max_bins` to a feature.
    """
    whole = _cells(rows, weight, None).collect()
    limits = {row.feature: row.weight / (FINENESS * max_bins) for row in whole}
    opened = {row.feature: (np.array([row.least]), np.array([row.most])) for row in whole if row.least < row.most}
    single = [(row.feature, row.weight, row.least, row.most) for row in whole if row.least == row.most]
    spark = rows.sparkSession
    found = spark.createDataFrame(single, "feature int, weight long, least double, most double")
    n_cells = {row.feature: 0 for row in whole}
    while opened:
        cells = materialize(_cells(rows, weight, opened))
        limit = spark.createDataFrame([(k, v) for k, v in limits.items()], "feature int, limit double")
        counted = cells.groupBy("feature").count().collect()
        for row in counted:
            n_cells[row.feature] += row["count"] - len(opened[row.feature][0])
        few = [k for k, n in n_cells.items() if n + 1 <= max_bins]
        heavy = (F.col("least") < F.col("most")) & ((F.col("weight") > F.col("limit")) | F.col("feature").isin(few))
        judged = cells.join(F.broadcast(limit), "feature").withColumn("heavy", heavy)
        found = found.unionByName(judged.where("not heavy").select("feature", "weight", "least", "most"))
        opened = {}
        rest = judged.where("heavy").select("feature", "least", "most").toPandas().sort_values(["feature", "least"])
        for feature, part in rest.groupby("feature"):
            opened[int(feature)] = (part.least.to_numpy(), part.most.to_numpy())
    return found


def quantile_cuts(rows: DataFrame, max_bins: int, weight: str | None = None) -> dict[int, list[float]]:
    """By feature, the ascending values at which a new bin begins: every value but the least where there are at
    most `max_bins` different ones, else one for each `1 / max_bins` of the weight, at a rank that is off by at most
    `1 / (FINENESS * max_bins)` of it or the weight of one value."""
    order = Window.partitionBy("feature").orderBy("least")
    all_of = Window.partitionBy("feature")
    before = F.coalesce(F.sum("weight").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = summary(rows, max_bins, weight).select(
        "feature",
        "least",
        F.row_number().over(order).alias("place"),
        F.count(F.lit(1)).over(all_of).alias("cells"),
        F.floor(before * max_bins / F.sum("weight").over(all_of)).alias("share"),
    )
    bin = F.when(F.col("cells") <= max_bins, F.col("place") - 1).otherwise(F.col("share"))
    cuts = ranked.groupBy("feature", bin.alias("bin")).agg(F.min("least").alias("cut"), F.min("place").alias("place"))
    found: dict[int, list[float]] = {}
    for row in cuts.where("place > 1").select("feature", "cut").orderBy("feature", "cut").collect():
        found.setdefault(row.feature, []).append(row.cut)
    return found
