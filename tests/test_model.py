import json

import pytest

from holdfast import values
from holdfast.functions.readout import readout
from holdfast.operators import boosting
from holdfast.operators.encoding import encode_align
from holdfast.plans import catalog, fixtures, serving, training
from holdfast.sources.files import file_inventory
from holdfast.sources.models import load_model, save_model
from pyspark.sql import functions as F


def test_holdout_beats_chance(spark, sf_dir):
    trained = catalog.trained(spark, sf_dir)
    report = {r.metric: r.value for r in trained.report().collect()}
    assert report["auc"] > 0.7 and report["accuracy"] > 0.6
    assert trained.holdout.count() == 300
    assert trained.split.groupBy("Churn", "split").count().count() == 4


def test_the_key_is_no_feature(stored):
    names = [f.name for f in stored.features]
    assert len(names) == 30 and values.ID not in names and values.TARGET not in names
    assert names == catalog.FEATURES


def test_reload_scores_the_same(spark, sf_dir, stored, tmp_path):
    save_model(spark, stored, str(tmp_path / "m"))
    loaded = load_model(spark, str(tmp_path / "m"))
    clean = catalog._clean(spark, sf_dir)
    first, again = (
        boosting.score_table(clean, s.model, s.features, keep=[values.ID]).orderBy(values.ID).collect()
        for s in (stored, loaded)
    )
    assert first == again


def test_layout_makes_the_fit_repeatable(spark, sf_dir, stored):
    clean = catalog._clean(spark, sf_dir)
    rows = encode_align(clean, stored.features, keep=[values.ID, values.TARGET])
    fits = [
        boosting.fit_trees(rows.repartition(n), stored.features, max_iter=2, layout=(4, values.ID)) for n in (2, 5)
    ]
    first, again = (
        boosting.predict(rows, m, stored.features, [values.ID]).orderBy(values.ID).collect() for m in fits
    )
    assert first == again


def test_missing_numbers(spark, sf_dir, stored):
    clean = catalog._clean(spark, sf_dir).limit(20)
    zero = clean.withColumn("tenure", F.lit(0))
    missing = clean.withColumn("tenure", F.lit(None).cast("int"))

    def scores(df, **options):
        scored = boosting.score_table(df, stored.model, stored.features, keep=[values.ID], **options)
        return {r.customerID: (r.prediction, r.probability) for r in scored.collect()}

    assert set(scores(missing, fill=None).values()) == {(None, None)}
    assert scores(missing, fill=0.0) == scores(zero)
    assert scores(missing) == scores(clean.withColumn("tenure", F.lit(values.STAND_IN)))
    rows = encode_align(missing.union(zero), stored.features, keep=[values.TARGET])
    with pytest.raises(Exception, match="missing"):
        boosting.fit_trees(rows, stored.features, max_iter=1, fill=None)
    boosting.fit_trees(rows, stored.features, max_iter=1)


def test_fit_with_missing_numbers(spark, sf_dir):
    """Missing numbers get an indicator; the trees may treat them unlike any number."""
    clean = catalog._clean(spark, sf_dir).where("tenure <> 40")
    gaps = clean.withColumn("tenure", F.when(F.col("Churn") == 0, F.col("tenure")).otherwise(F.lit(None).cast("int")))
    trained = training.train(gaps, max_iter=2)
    assert [f.name for f in trained.stored.features if f.missing] == ["tenure_missing"]
    report = {r.metric: r.value for r in trained.report().collect()}
    assert report["accuracy"] == 1.0  # only churners lack the number
    request = spark.createDataFrame(
        [(0, values.JSON_TYPE, '[{"tenure":5},{"tenure":null}]')], "request_id bigint, content_type string, value string"
    )
    body = json.loads(serving.score_requests(request, trained.stored).first().body)
    assert body["predictions"] == [0, 1]


def test_fit_and_table_scoring_treat_texts_alike(spark, sf_dir):
    clean = catalog._clean(spark, sf_dir)
    padded = clean.withColumn("Contract", F.when(F.col("tenure") % 2 == 0, F.concat("Contract", F.lit(" "))).otherwise("n/a"))
    trained = training.train(padded, max_iter=2)
    held = {r.customerID: r.probability for r in trained.holdout.collect()}
    scored = boosting.score_table(padded, trained.stored.model, trained.stored.features, keep=[values.ID])
    assert all(held.get(r.customerID, r.probability) == r.probability for r in scored.collect())


def test_unknown_mode(spark, sf_dir, stored):
    with pytest.raises(ValueError):
        boosting.scoring_features(catalog._clean(spark, sf_dir), stored.features, "other")


def test_readout_rules(spark):
    df = spark.createDataFrame(
        [(0, 0.35), (0, 0.36), (1, 0.55), (1, 0.6), (1, 0.61), (0, 0.0), (1, 1.0)],
        "prediction int, probability double",
    )
    rows = readout(df).collect()
    assert [r.tier for r in rows] == ["low", "med", "med", "med", "high", "low", "high"]
    assert [r.bars for r in rows] == [3, 3, 2, 2, 2, 5, 0]
    assert rows[2].verdict == "Weak signal. This profile is predicted to churn — 55.0% churn probability."
    assert rows[0].verdict == "Signal holding. This profile is predicted to stay — 35.0% churn probability."


def test_inventory(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_bytes(b"x" * 256)
    (tmp_path / "sub" / "b.csv").write_bytes(b"x" * 3000)
    found = {r.path.rsplit("/", 1)[1]: r.size_kb for r in file_inventory(spark, str(tmp_path)).collect()}
    assert found == {"a.csv": 0.2, "b.csv": 2.9}
    plan = file_inventory(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_inventory_of_nothing_warns(spark, tmp_path):
    with pytest.warns(UserWarning, match="no files"):
        assert file_inventory(spark, str(tmp_path / "none")).count() == 0


def test_run_stores_the_model(spark, sf_dir, tmp_path):
    raw = fixtures.accounts_raw(spark, sf_dir)
    trained = training.run(spark, raw, str(tmp_path / "model"), str(tmp_path / "clean"), max_iter=1)
    assert load_model(spark, str(tmp_path / "model")).features == trained.stored.features
    assert spark.read.parquet(str(tmp_path / "clean")).count() == 1500
