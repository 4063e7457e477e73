import hashlib
import math
from collections import Counter

import pytest

from holdfast.operators import holdout
from holdfast.operators.holdout import stratified_split, train_quotas
from holdfast.plans import fixtures
from pyspark.sql import functions as F


def plain_quotas(counts, test_size):
    n = sum(counts.values())
    n_train = n - math.ceil(test_size * n)
    quotas = {label: k * n_train // n for label, k in counts.items()}
    by_rest = sorted(sorted(counts), key=lambda label: -(counts[label] * n_train % n))
    for label in by_rest[: n_train - sum(quotas.values())]:
        quotas[label] += 1
    return quotas


def quotas_of(spark, counts, test_size):
    table = spark.createDataFrame(list(counts.items()), "label string, n bigint")
    return {r.label: r.needed for r in train_quotas(table, test_size).collect()}


def expected_train(rows, seed=42, test_size=0.2):
    """Plain form over (key, label) rows: rank each class by digest."""
    counts = Counter(label for _, label in rows)
    quotas = plain_quotas(counts, test_size)
    train = set()
    for label in counts:
        keys = sorted((hashlib.md5(f"{k}|{seed}".encode()).hexdigest(), k) for k, y in rows if y == label)
        train |= {k for _, k in keys[: quotas[label]]}
    return train


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    return fixtures.accounts_raw(spark, sf_dir).select("customerID", "Churn")


def sides(df, key="customerID"):
    return {r[key]: r.split for r in df.collect()}


def test_quotas(spark):
    assert quotas_of(spark, {"a": 5, "b": 5}, 0.2) == {"a": 4, "b": 4}
    assert quotas_of(spark, {"a": 3, "b": 3, "c": 5}, 0.25) == {"a": 2, "b": 2, "c": 4}
    assert quotas_of(spark, {"0": 7, "1": 3}, 0.2) == {"0": 6, "1": 2}  # remainders 0.6 and 0.4
    many = {f"{i:03}": 2 + i * i % 17 for i in range(300)}
    assert quotas_of(spark, many, 0.3) == plain_quotas(many, 0.3)
    huge = {"a": 10**17, "b": 3 * 10**17 + 1}
    assert quotas_of(spark, huge, 0.2) == plain_quotas(huge, 0.2)


@pytest.mark.parametrize("counts", [{"0": 10, "1": 1}, {"0": 2, "1": 2, "2": 2}])
def test_impossible_splits(spark, counts):
    with pytest.raises(ValueError):
        quotas_of(spark, counts, 0.2)


@pytest.mark.parametrize("partitions", [1, 13])
def test_equals_the_plain_form(table, partitions):
    rows = [tuple(r) for r in table.collect()]
    found = sides(stratified_split(table.repartition(partitions), "Churn", "customerID"))
    assert len(found) == len(rows)
    assert {k for k, side in found.items() if side == "train"} == expected_train(rows)
    assert sum(side == "test" for side in found.values()) == math.ceil(0.2 * len(rows))


def test_seed_and_size(table):
    rows = [tuple(r) for r in table.collect()]
    found = sides(stratified_split(table, "Churn", "customerID", test_size=0.35, seed=7))
    assert {k for k, side in found.items() if side == "train"} == expected_train(rows, 7, 0.35)


def test_null_label_is_an_error(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)] * 5, "k int, y string")
    with pytest.raises(ValueError, match="null"):
        stratified_split(df, "y", "k")


def test_a_third_of_all_rows_share_a_key(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 2).alias("y"),
        F.col("id").alias("other"),
    )
    found = stratified_split(df, "y", "k")
    assert Counter((r.y, r.split) for r in found.collect()) == {
        (0, "train"): 1200, (0, "test"): 300, (1, "train"): 1200, (1, "test"): 300,
    }
    again = stratified_split(df.repartition(7), "y", "k")
    assert {tuple(r) for r in found.collect()} == {tuple(r) for r in again.collect()}


@pytest.mark.parametrize("key", ["k", None])
def test_copies_are_counted(spark, key):
    """All rows of a class equal but a few: exact counts, no row lost."""
    rows = [("same", 0, 1.5)] * 500 + [(f"k{i}", 0, None) for i in range(30)] + [("same", 1, 1.5)] * 470
    df = spark.createDataFrame(rows, "k string, y int, x double")
    found = stratified_split(df, "y", key).collect()
    assert Counter((r.y, r.split) for r in found) == {
        (0, "train"): 424, (0, "test"): 106, (1, "train"): 376, (1, "test"): 94,
    }
    assert Counter((r.k, r.y, r.x) for r in found) == Counter(rows)


def test_marking_looks_a_few_cutoffs_up(table):
    plan = stratified_split(table, "Churn", "customerID")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hash" not in plan and "Window" not in plan and plan.count("SortMergeJoin") == 0
    assert "BroadcastHashJoin [label" in plan


@pytest.mark.parametrize("digits", [1, 2])
def test_small_windows_give_the_same_sides(spark, sf_dir, monkeypatch, digits):
    """Ranges are cut by further digits until each has at most 16**digits digests; a key that a third of the rows has too."""
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"), "id", (F.col("id") % 5 == 0).cast("int").alias("y"))
    whole = sorted(holdout.stratified_split(rows, "y", "key").collect())
    monkeypatch.setattr(holdout, "DIGITS", digits)
    lengths = []
    reached = holdout._reached
    monkeypatch.setattr(holdout, "_reached", lambda table, position: lengths.append(table.groupBy("label").count().agg(F.max("count")).first()[0] or 0) or reached(table, position))
    assert sorted(holdout.stratified_split(rows, "y", "key").collect()) == whole
    assert max(lengths) <= 16**digits


@pytest.mark.parametrize("label", ["y", "label", "needed"])
def test_many_classes_are_ordered_where_they_meet(spark, monkeypatch, label):
    """The same sides as by cutoffs: keys that repeat or are null, equal rows, classes beyond a window."""
    rows = spark.range(6000).select(
        F.when(F.col("id") % 5 == 0, -1).when(F.col("id") % 7 > 0, F.col("id") % 2900).alias("key"),
        F.when(F.col("id") % 3 == 0, F.lit(3)).otherwise(F.col("id") % 211).alias(label),
        (F.col("id") % 4).alias("other"),
    )
    whole = sorted(stratified_split(rows, label, "key").collect(), key=str)
    monkeypatch.setattr(holdout, "FEW_CLASSES", 100)
    assert sorted(stratified_split(rows, label, "key").collect(), key=str) == whole
    monkeypatch.setattr(holdout, "DIGITS", 2)  # two classes are larger
    assert sorted(stratified_split(rows, label, "key").collect(), key=str) == whole


def test_many_classes_shuffle_rows_once_and_no_digests(spark, monkeypatch):
    """By class, and once for the counts; of cutoffs there are none to look up."""
    rows = spark.range(6000).select("id", (F.col("id") % 211).alias("y"))
    monkeypatch.setattr(holdout, "FEW_CLASSES", 100)
    monkeypatch.setattr(holdout, "_cutoffs", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stratified_split(rows, "y", "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    above = plan[: plan.index("SortMergeJoin")]
    assert "Exchange" not in above and above.count("Window") == 1
    assert "md5" not in plan[plan.index("SortMergeJoin") :]
