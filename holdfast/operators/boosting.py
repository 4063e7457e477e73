"""Boosted trees: fit, predict, score tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import values
from holdfast.functions.numbers import quoted
from holdfast.operators.cleaning import missing_texts_to_null
from holdfast.operators.encoding import (
    Feature,
    align_columns,
    assemble_features,
    encode_align,
    feature_values,
    filled,
    is_complete,
)
from holdfast.operators.second_order import fit_second_order
from holdfast.operators.trees import TreeModel, predict_trees
from holdfast.runtime import spread, use_checkpoints

ENCODED, REFERENCE_PARITY = "encoded", "reference_parity"


def fit_trees(
    train: DataFrame,
    features: Sequence[Feature],
    label: str = values.TARGET,
    max_iter: int = values.TREES,
    max_depth: int = values.DEPTH,
    step_size: float = values.LEARNING_RATE,
    seed: int = values.SEED,
    max_bins: int = 256,
    layout: tuple[int, str] | None = None,
    fill: float | None = values.STAND_IN,
) -> PipelineModel:
    """Fit on a table that has the named features and a 0/1 label.

    Missing feature values count as `fill`, which is below all others unless given; with None they
    fail the job.

    Spark picks split candidates from a sample beyond 10,000 rows, so results may move with the
    partitioning; `layout=(partitions, key)` fixes it at the price of one shuffle. Without it a table of many
    rows is dealt out to the cores. Lineage is cut
    every ten trees in the shared checkpoint folder, so a lost executor does not replay them all.
    """
    use_checkpoints(train.sparkSession)
    keep = [label] if layout is None else [label, layout[1]]
    rows = assemble_features(train, features, keep, fill)
    if layout is not None:
        rows = rows.repartition(layout[0], quoted(layout[1])).sortWithinPartitions(quoted(layout[1]))
    else:
        rows = spread(rows)  # each tree reads them once a level
    trees = GBTClassifier(
        labelCol=label,
        featuresCol="features",
        maxIter=max_iter,
        maxDepth=max_depth,
        stepSize=step_size,
        maxBins=max_bins,
        seed=seed,
        checkpointInterval=10,
    )
    return Pipeline(stages=[trees]).fit(rows)


def fit_regularised(
    train: DataFrame,
    features: Sequence[Feature],
    label: str = values.TARGET,
    max_iter: int = values.TREES,
    max_depth: int = values.DEPTH,
    step_size: float = values.LEARNING_RATE,
    **options,
) -> TreeModel:
    """Second-order trees with L2-regularised leaves on the same table; missing values stay missing and each
    split learns where they go. `options` go to `fit_second_order`."""
    rows = feature_values(train.withColumn("label", quoted(label).cast("int")), features, ["label"])
    return fit_second_order(rows, max_iter, max_depth, step_size, **options)


def predict_values(
    rows: DataFrame, model: PipelineModel | TreeModel, keep: Sequence[str] = (), fill: float | None = values.STAND_IN
) -> DataFrame:
    """(kept columns, prediction 0/1, probability of class 1) for rows of feature `values`.

    Spark's trees need every value. A missing one counts as `fill`; with None its row gets a null
    prediction and probability. A `TreeModel` knows where missing ones go, whatever `fill` is.
    """
    if isinstance(model, TreeModel):
        return predict_trees(rows, model, [quoted(c) for c in keep])
    complete = F.lit(True) if fill is not None else is_complete(F.col("values"))
    vector = array_to_vector(filled(F.col("values"), fill or 0.0))
    scored = model.transform(
        rows.select(*[quoted(c) for c in keep], complete.alias("_complete"), vector.alias("features"))
    )
    return scored.select(
        *[quoted(c) for c in keep],
        F.when(F.col("_complete"), F.col("prediction").cast("int")).alias("prediction"),
        F.when(F.col("_complete"), vector_to_array("probability")[1]).alias("probability"),
    )


def predict(
    df: DataFrame,
    model: PipelineModel | TreeModel,
    features: Sequence[Feature],
    keep: Sequence[str] = (),
    fill: float | None = values.STAND_IN,
) -> DataFrame:
    """The same for a table of named features."""
    return predict_values(feature_values(df, features, keep), model, keep, fill)


def scoring_features(
    df: DataFrame, features: Sequence[Feature], mode: str = ENCODED, keep: Sequence[str] = ()
) -> DataFrame:
    """The features that scoring sees, by mode.

    `encoded` encodes categorical columns with the levels of the manifest, trimmed and without
    missing-value texts, as the fit sees them. `reference_parity`
    only looks feature names up in the table, so raw categorical columns are ignored and all
    their indicators are 0: every account is scored as if it had the first level of each.
    """
    if mode == ENCODED:
        sources = {f.source for f in features if f.level is not None}
        rows = missing_texts_to_null(df, [c for c in df.columns if c in sources])
        return encode_align(rows, features, keep)
    if mode == REFERENCE_PARITY:
        flagged = df.withColumns({f.name: f.value() for f in features if f.missing and f.source in df.columns})
        return align_columns(flagged, [f.name for f in features], keep)
    raise ValueError(f"unknown scoring mode {mode!r}")


def score_table(
    df: DataFrame,
    model: PipelineModel | TreeModel,
    features: Sequence[Feature],
    mode: str = ENCODED,
    keep: Sequence[str] = (),
    fill: float | None = values.STAND_IN,
) -> DataFrame:
    """Score cleaned accounts: a narrow job, the model goes along with the plan."""
    return predict(scoring_features(df, features, mode, keep), model, features, keep, fill)
