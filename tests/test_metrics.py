import random

import pytest

from holdfast.operators import metrics
from holdfast.plans import fixtures
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

SCHEMA = "label int, prediction int, probability double"


def brute_auc(rows):
    pos = [s for y, _, s in rows if y == 1]
    neg = [s for y, _, s in rows if y == 0]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def some_rows(n, distinct, seed=1):
    rng = random.Random(seed)
    rows = [(int(rng.random() < 0.4), rng.randrange(distinct) / distinct - 0.3) for _ in range(n)]
    return [(y, int(s > 0.5), s) for y, s in rows]


@pytest.mark.parametrize("distinct", [2, 50, 10_000])
@pytest.mark.parametrize("per_bucket", [1_000_000, 40])
def test_auc_is_the_pair_statistic(spark, distinct, per_bucket):
    rows = some_rows(600, distinct)
    df = spark.createDataFrame(rows, SCHEMA)
    assert metrics.roc_auc(df, per_bucket=per_bucket).first().auc == pytest.approx(brute_auc(rows), abs=1e-12)


def test_auc_with_one_hot_score(spark):
    rows = [(i % 2, 1, 0.5) for i in range(400)] + some_rows(200, 90)
    df = spark.createDataFrame(rows, SCHEMA)
    assert metrics.roc_auc(df, per_bucket=10).first().auc == pytest.approx(brute_auc(rows), abs=1e-12)


def test_auc_equals_the_unbinned_evaluator(spark, sf_dir):
    scored = fixtures.scored(spark, sf_dir)
    vectors = scored.withColumn("raw", array_to_vector(F.array(1 - F.col("probability"), "probability")))
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="raw", numBins=0)
    assert metrics.roc_auc(scored).first().auc == pytest.approx(evaluator.evaluate(vectors), abs=1e-12)


@pytest.mark.parametrize(
    "rows",
    [
        [(1, 1, 0.9), (1, 0, 0.1)],
        [(1, 1, 0.9), (0, 0, None)],
        [(1, 1, 0.9), (0, 0, 0.1), (0, 0, float("nan"))],
        [(1, 1, 0.9), (0, 0, 0.1), (None, 0, 0.2)],
        [],
    ],
)
def test_auc_is_null_where_undefined(spark, rows):
    assert metrics.roc_auc(spark.createDataFrame(rows, SCHEMA)).first().auc is None


def test_undefined_rates_are_zero(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], SCHEMA)
    report = {r.metric: r.value for r in metrics.metrics_report(df).collect()}
    assert report == {"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "auc": None}


def test_report(spark):
    rows = [(1, 1, 0.9), (0, 1, 0.8), (1, 0, 0.4), (0, 0, 0.1), (1, 1, 0.7), (0, 0, 0.3), (0, 0, 0.2)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert tuple(metrics.confusion(df).first()) == (2, 1, 3, 1)
    report = {r.metric: r.value for r in metrics.metrics_report(df).collect()}
    assert report == {"accuracy": 0.7143, "precision": 0.6667, "recall": 0.6667, "auc": round(brute_auc(rows), 4)}


def test_scores_are_ranked_by_range(spark, sf_dir):
    """No task ranks all scores, and ranges meet their offsets by an equi-join."""
    area = metrics.roc_auc(fixtures.scored(spark, sf_dir), per_bucket=10)
    plan = area._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    windows = [line for line in lines if "+- Window" in line and "score" in line]
    assert len(windows) == 1 and "[bucket#" in windows[0]
    assert "HashJoin [bucket#" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_hot_scores_are_counted_before_the_shuffle(spark, sf_dir):
    scores = metrics._by_score(fixtures.scored(spark, sf_dir), F.col("label"), F.col("probability"), {})
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and plan.count("Exchange") == 1
