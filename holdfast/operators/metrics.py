"""Evaluation of a scored table: confusion counts, rates and the exact ROC area."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.numbers import quoted, rounded
from holdfast.runtime import materialize

SCORES_PER_BUCKET = 100_000


def _outcomes(label: Column, prediction: Column) -> dict[str, Column]:
    """Counts that partial aggregation adds up before any shuffle."""
    return {
        "tp": F.count_if((label == 1) & (prediction == 1)),
        "fp": F.count_if((label == 0) & (prediction == 1)),
        "tn": F.count_if((label == 0) & (prediction == 0)),
        "fn": F.count_if((label == 1) & (prediction == 0)),
    }


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: tp, fp, tn, fn."""
    counts = _outcomes(quoted(label), quoted(prediction))
    return df.agg(*[count.alias(name) for name, count in counts.items()])


def _ratio(part: Column, whole: Column, undefined: float | None = 0.0) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(undefined).cast("double"))


def _by_score(df: DataFrame, label: Column, score: Column, extra: dict[str, Column]) -> DataFrame:
    """One row per distinct score. A score that most rows share is one row here."""
    return df.groupBy(score.cast("double").alias("score")).agg(
        F.count_if(label == 1).alias("pos"),
        F.count_if(label == 0).alias("neg"),
        F.count_if(label.isNull() | ~label.isin(0, 1)).alias("odd"),
        *[count.alias(name) for name, count in extra.items()],
    )


def _evaluate(scores: DataFrame, extra: Sequence[str], per_bucket: int) -> DataFrame:
    """One row: `auc` and the sums of the `extra` counts, over a table of distinct scores.

    A positive beats each negative with a lower score and half of those with its own. Scores are
    range-partitioned, about `per_bucket` to a range. The negatives below a score are those of
    lower ranges plus those before it in its own (a window per range). The sums of ranges are
    summed up in two levels, by blocks of `per_bucket` ranges, so no window grows with the data.
    """
    unusable = F.col("score").isNull() | F.isnan("score")
    rows = F.col("pos") + F.col("neg") + F.col("odd")
    table = scores.select(
        F.when(unusable, 0.0).otherwise(F.col("score")).alias("score"),
        F.when(unusable, 0).otherwise(F.col("pos")).alias("pos"),
        F.when(unusable, 0).otherwise(F.col("neg")).alias("neg"),
        F.when(unusable, rows).otherwise(F.col("odd")).alias("unusable"),
        *extra,
    )
    ranges = max(1, math.ceil(table.count() / per_bucket))
    ranked = materialize(table.repartitionByRange(ranges, "score").withColumn("bucket", F.spark_partition_id()))
    sums = ranked.groupBy("bucket").agg(F.sum("neg").alias("neg"))
    sums = sums.withColumn("block", F.floor(F.col("bucket") / per_bucket))
    in_block = _lower(sums, "bucket", "lower_buckets", "block")
    blocks = _lower(sums.groupBy("block").agg(F.sum("neg").alias("neg")), "block", "lower_blocks")
    lower = in_block.join(blocks, "block").select("bucket", (F.col("lower_buckets") + F.col("lower_blocks")).alias("below"))
    placed = _lower(ranked, "score", "lower", "bucket").join(lower, "bucket")
    beaten = F.col("pos") * (F.col("lower") + F.col("below") + F.col("neg") / 2)
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    auc = F.when(F.sum("unusable") == 0, _ratio(F.sum(beaten), pairs, undefined=None))
    return placed.agg(auc.alias("auc"), *[F.sum(name).alias(name) for name in extra])


def _lower(table: DataFrame, order: str, out: str, within: str | None = None) -> DataFrame:
    """`table` with the sum of `neg` over the rows that come before (in the same `within`)."""
    group = F.col(within) if within else F.lit(0)
    before = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return table.withColumn(out, F.coalesce(F.sum("neg").over(before), F.lit(0)))


def roc_auc(
    df: DataFrame, label: str = "label", score: str = "probability", per_bucket: int = SCORES_PER_BUCKET
) -> DataFrame:
    """One row, `auc`. Null when a class is missing, or a label or score is not usable."""
    scores = materialize(_by_score(df, quoted(label), quoted(score), {}))
    return _evaluate(scores, [], per_bucket)


def metrics_report(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    score: str = "probability",
    per_bucket: int = SCORES_PER_BUCKET,
) -> DataFrame:
    """(metric, value): accuracy, precision, recall and auc at 4 decimals, from one pass."""
    outcomes = _outcomes(quoted(label), quoted(prediction))
    scores = materialize(_by_score(df, quoted(label), quoted(score), outcomes))
    tp, fp, tn, fn = (F.col(name) for name in outcomes)
    values = {
        "accuracy": _ratio(tp + tn, tp + fp + tn + fn, undefined=None),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "auc": F.col("auc"),
    }
    lines = [
        F.struct(F.lit(name).alias("metric"), rounded(value, 4, ties="even").alias("value"))
        for name, value in values.items()
    ]
    return _evaluate(scores, list(outcomes), per_bucket).select(F.inline(F.array(*lines)))
