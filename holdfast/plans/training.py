"""From a raw account table to a stored, evaluated model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from holdfast import values
from holdfast.operators.boosting import fit_regularised, fit_trees, predict
from holdfast.operators.cleaning import clean_accounts, missing_texts_to_null
from holdfast.operators.encoding import category_levels, columns_with_missing, encode_align, manifest
from holdfast.operators.holdout import TEST, TRAIN, stratified_split
from holdfast.operators.metrics import metrics_report
from holdfast.runtime import scratch_path
from holdfast.sources.accounts import write_table
from holdfast.sources.models import StoredModel, save_model


@dataclass(frozen=True)
class Trained:
    stored: StoredModel
    holdout: DataFrame  # (key if any, label, prediction, probability)
    split: DataFrame  # clean table with its side

    def report(self, label: str = values.TARGET) -> DataFrame:
        return metrics_report(self.holdout, label)


def train(
    clean: DataFrame,
    key: str | None = values.ID,
    label: str = values.TARGET,
    categorical: Sequence[str] = values.CATEGORICAL,
    test_size: float = values.TEST_SIZE,
    seed: int = values.SEED,
    fill: float | None = values.STAND_IN,
    second_order: bool = False,
    **options,
) -> Trained:
    """Levels over the whole table, exact split, fit on one side, scores of the other.

    `clean` is read a few times, by few columns each: give it as a columnar table. Number columns
    with missing values get an indicator of them, and those values count as `fill`, below all
    others unless given; with None they fail the fit. With `second_order` they stay missing instead, without
    an indicator, and the trees are those of `fit_regularised`. Without a `key` the whole row decides
    its side. `options` go to the fit.
    """
    rows = missing_texts_to_null(clean, categorical)
    levels = category_levels(rows, categorical)
    numbers = [c for c in rows.columns if c not in {label, key, *levels}]
    missing = [] if fill is None or second_order else columns_with_missing(rows, numbers)
    features = manifest(rows.columns, levels, label, key, missing)
    split = stratified_split(rows, label, key, test_size, seed)
    kept = [label] if key is None else [key, label]
    encoded = encode_align(split, features, keep=[*kept, "split"])
    known = encoded.where(encoded.split == TRAIN)
    if second_order:
        model = fit_regularised(known, features, label, **options)
    else:
        model = fit_trees(known, features, label, seed=seed, fill=fill, **options)
    holdout = predict(encoded.where(encoded.split == TEST), model, features, kept, fill)
    return Trained(StoredModel(model, features), holdout, split)


def run(spark: SparkSession, raw: DataFrame, model_path: str, clean_path: str | None = None, **options) -> Trained:
    """Clean, store, train and save. Returns the result with its holdout scores."""
    clean_path = clean_path or scratch_path(spark, "clean")
    write_table(clean_accounts(raw, keep_id=True), clean_path)
    trained = train(spark.read.parquet(clean_path), **options)
    save_model(spark, trained.stored, model_path)
    return trained
