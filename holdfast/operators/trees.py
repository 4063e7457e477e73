"""Trees as a table of nodes: what a node table holds, how it is walked, and where one comes from."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.quantiles import matrix
from holdfast.runtime import ship

NODES = (
    "tree int, node int, feature int, threshold double, missing_left boolean, left_node int, right_node int, value double"
)


@dataclass(frozen=True)
class TreeModel:
    """Trees as flat arrays, one entry a node, the nodes of a tree in one piece.

    A node sends a value below its `threshold` to `left`, another one to `right`, and a missing one as
    `missing_left` says. A leaf has feature -1 and leads to itself. The margin of a row is `base` plus the values of its
    leaves, and the probability of class 1 is 1 / (1 + exp(-link * margin)).
    """

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float = 0.0
    link: float = 1.0

    @property
    def depth(self) -> int:
        """Steps from a root to its farthest leaf."""
        at, steps = self.roots, 0
        while (self.feature[at] >= 0).any():
            at = np.unique(np.concatenate([self.left[at], self.right[at]]))
            at, steps = at[self.feature[at] >= 0], steps + 1
        return steps

    def margins(self, values: np.ndarray) -> np.ndarray:
        """The margins of rows of feature values, in which NaN is missing."""
        total = np.full(len(values), self.base)
        rows, depth = np.arange(len(values)), self.depth
        for root in self.roots:
            at = np.full(len(values), root)
            for _ in range(depth):
                value = values[rows, np.maximum(self.feature[at], 0)]
                left = np.where(np.isnan(value), self.missing_left[at], value < self.threshold[at])
                at = np.where(left, self.left[at], self.right[at])
            total += self.value[at]
        return total

    def margin(self, values: Column) -> Column:
        """The margin of an array of feature values, whose nulls are missing."""

        @F.arrow_udf("double")
        def walk(batch: pa.Array) -> pa.Array:
            return pa.array(self.margins(matrix(batch)) if len(batch) else np.empty(0))

        return walk(values)

    def nodes(self) -> list[tuple]:
        """The rows of the node table; nodes are numbered from 0 in each tree."""
        tree = np.searchsorted(self.roots, np.arange(len(self.feature)), "right") - 1
        start = self.roots[tree]
        rows = []
        for i in range(len(self.feature)):
            inner = self.feature[i] >= 0
            place = int(tree[i]), int(i - start[i])
            if inner:
                split = int(self.feature[i]), float(self.threshold[i]), bool(self.missing_left[i])
                rows.append((*place, *split, int(self.left[i] - start[i]), int(self.right[i] - start[i]), None))
            else:
                rows.append((*place, None, None, None, None, None, float(self.value[i])))
        return rows


def node_table(spark: SparkSession, model: TreeModel) -> DataFrame:
    """(tree, node, feature, threshold, missing_left, left_node, right_node, value), as bounded as the model."""
    return spark.createDataFrame(model.nodes(), NODES)


def from_nodes(rows: Sequence, base: float, link: float) -> TreeModel:
    """The model of the rows of a node table, whose nodes may be numbered with gaps."""
    rows = sorted(rows, key=lambda row: (row.tree, row.node))
    place = {(row.tree, row.node): i for i, row in enumerate(rows)}
    roots = [i for i, row in enumerate(rows) if i == 0 or rows[i - 1].tree != row.tree]

    def column(kind, pick):
        return np.array([pick(i, row) for i, row in enumerate(rows)], kind)

    def inner(pick, leaf):
        return lambda i, row: leaf(i) if row.feature is None else pick(row)

    return TreeModel(
        roots=np.array(roots, np.int64),
        feature=column(np.int64, inner(lambda row: row.feature, lambda i: -1)),
        threshold=column(np.float64, inner(lambda row: row.threshold, lambda i: 0.0)),
        missing_left=column(bool, inner(lambda row: row.missing_left, lambda i: True)),
        left=column(np.int64, inner(lambda row: place[row.tree, row.left_node], lambda i: i)),
        right=column(np.int64, inner(lambda row: place[row.tree, row.right_node], lambda i: i)),
        value=column(np.float64, lambda i, row: row.value or 0.0),
        base=base,
        link=link,
    )


def from_pipeline(model: PipelineModel, path: str) -> TreeModel:
    """The boosted trees of a fitted pipeline's last stage, from the files that it saves below `path`.

    Its trees send values up to a threshold left, so thresholds move to the next number; they weigh
    each tree, and their margin counts twice.
    """
    spark, stage = SparkSession.active(), model.stages[-1]
    stage.write().overwrite().save(path)
    weights = stage.treeWeights
    data = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    rows = data.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"),
        F.when(F.col("leftChild") >= 0, F.col("split.featureIndex")).alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.lit(True).alias("missing_left"), F.col("leftChild").alias("left_node"), F.col("rightChild").alias("right_node"),
        F.col("prediction").alias("value"),
    ).collect()
    found = from_nodes(rows, 0.0, 2.0)
    tree = np.searchsorted(found.roots, np.arange(len(found.feature)), "right") - 1
    return TreeModel(
        **{
            **found.__dict__,
            "threshold": np.nextafter(found.threshold, np.inf),
            "value": np.where(found.feature < 0, found.value * np.array(weights)[tree], 0.0),
        }
    )


def predict_trees(rows: DataFrame, model: TreeModel, keep: Sequence[Column] = ()) -> DataFrame:
    """(kept columns, prediction 0/1, probability of class 1) for rows of feature `values`; nulls are missing."""
    ship(rows.sparkSession)
    margin = rows.select(*keep, model.margin(F.col("values")).alias("_margin"))
    probability = 1 / (1 + F.exp(-model.link * F.col("_margin")))
    kept = [column for column in margin.columns if column != "_margin"]
    return margin.select(
        *[F.col("`" + column.replace("`", "``") + "`") for column in kept],
        (F.col("_margin") > 0).cast("int").alias("prediction"),
        probability.alias("probability"),
    )
