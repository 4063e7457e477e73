"""Quantile cuts, second-order trees, node tables and the model store, against plain code on the same rows."""

import json

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast import values
from holdfast.operators import boosting, encoding, second_order, trees
from holdfast.operators.quantiles import quantile_cuts
from holdfast.plans import catalog, serving, training
from holdfast.sources import models


@pytest.fixture(scope="module")
def table(spark):
    """(label, values): numbers with few and many values, missing ones, one constant and one always missing."""
    rng = np.random.default_rng(7)
    x = np.column_stack([
        rng.integers(0, 6, 3000), rng.normal(size=3000).round(2), np.exp(rng.normal(0, 6, 3000)), np.ones(3000), np.full(3000, np.nan),
    ])
    x[rng.random(3000) < 0.2, 1] = np.nan
    x[rng.random(3000) < 0.1, 0] = np.nan
    chance = 1 / (1 + np.exp(-(np.where(np.isnan(x[:, 0]), 2.0, x[:, 0] - 3) + np.nan_to_num(x[:, 1]))))
    y = (rng.random(3000) < chance).astype(int)
    rows = [(int(l), [None if np.isnan(v) else float(v) for v in row]) for l, row in zip(y, x)]
    return spark.createDataFrame(rows, "label int, values array<double>"), x, y


def plain_trees(x, y, cuts, n_trees, depth, step, l2=1.0, least_weight=1.0):
    """Margins after second-order boosting with these cuts, one node and candidate after the other."""
    margin = np.zeros(len(y))
    bins = np.column_stack([np.where(np.isnan(c), 0, np.searchsorted(cuts.get(f, []), c, "right") + 1) for f, c in enumerate(x.T)])
    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        nodes = [np.arange(len(y))]
        for level in range(depth + 1):
            following = []
            for mine in nodes:
                worth = lambda m: g[m].sum() ** 2 / (h[m].sum() + l2)
                best = (second_order.LEAST_GAIN, None)
                for f in range(x.shape[1]) if level < depth and h[mine].sum() >= 2 * least_weight or level == 0 else []:
                    for missing_left in (False, True):
                        for b in range(1, len(cuts.get(f, [])) + 2):
                            v = bins[mine, f]
                            left = np.where(v == 0, missing_left, v <= b)
                            a, c = mine[left], mine[~left]
                            if h[a].sum() >= least_weight and h[c].sum() >= least_weight:
                                gain = (worth(a) + worth(c) - worth(mine)) / 2
                                if gain > best[0] + 1e-9:
                                    best = (gain, (a, c))
                if best[1] is None:
                    margin[mine] += -g[mine].sum() / (h[mine].sum() + l2) * step
                else:
                    following += best[1]
            nodes = following
    return margin


def test_second_order_equals_plain_code(spark, table):
    rows, x, y = table
    model = second_order.fit_second_order(rows, 4, 3, 0.5, max_bins=20)
    cuts = quantile_cuts(rows, 20)
    expected = plain_trees(x, y, cuts, 4, 3, 0.5)
    assert np.abs(model.margins(x) - expected).max() < 1e-6
    scored = trees.predict_trees(rows, model, [F.col("label")]).collect()
    assert np.mean([r.prediction == r.label for r in scored]) > 0.75
    assert all(r.prediction == int(r.probability > 0.5) for r in scored)


def test_second_order_does_not_depend_on_the_layout(spark, table, monkeypatch):
    rows = table[0]
    monkeypatch.setattr(second_order, "TASK_CELLS", 1 << 11)
    monkeypatch.setattr(second_order, "FAN_IN", 2)  # sums are added up in two steps
    first, again = (second_order.fit_second_order(rows.repartition(n), 3, 3, 0.3, max_bins=300) for n in (1, 5))
    assert first.nodes() == again.nodes() and len(first.feature) > 20


def test_odd_fits(spark):
    schema = "label int, values array<double>"
    pure = second_order.fit_second_order(spark.createDataFrame([(1, [1.0]), (1, [None])], schema), 2, 3, 0.1)
    assert pure.depth == 0 and (pure.value > 0).all()
    with pytest.raises(ValueError):
        second_order.fit_second_order(spark.createDataFrame([], schema), 2, 3, 0.1)


@pytest.fixture(scope="module")
def million(spark):
    id = F.col("id")
    spread = F.exp(F.pmod(F.xxhash64("id"), F.lit(100_000)) / 5000.0)
    gaps = F.when(id % 3 != 0, F.pmod(F.xxhash64("id", F.lit(1)), F.lit(90)).cast("double"))
    outlier = F.when(id == 7, 1e300).otherwise(F.pmod(F.xxhash64("id", F.lit(2)), F.lit(1000)).cast("double"))
    return spark.range(1_000_000).select(F.array(spread, gaps, outlier, F.lit(None).cast("double"), F.when(id > 5, float("nan")).otherwise(float("inf"))).alias("values"), (id % 4).alias("weight"))


def test_cuts_are_the_same_in_any_layout_and_at_their_ranks(spark, million, tmp_path):
    found = [quantile_cuts(million.repartition(n), 100) for n in (1, 4, 13)]
    assert found[0] == found[1] == found[2]
    cuts = found[0]
    assert 3 not in cuts and 4 not in cuts  # no value, and one value
    assert cuts[1] == list(range(1, 90))
    path = str(tmp_path / "values")
    million.select(F.col("values")[0].alias("a"), F.col("values")[2].alias("b")).write.parquet(path)
    for feature, name in ((0, "a"), (2, "b")):
        ranks = [duckdb.sql(f"SELECT count(*) FROM '{path}/*.parquet' WHERE {name} < {cut!r}").fetchall()[0][0] / 1e6 for cut in cuts[feature]]
        # Each cut is at a multiple of 1/100 of the rows, or off by a quarter of that and one value.
        assert max(abs(rank * 100 - round(rank * 100)) for rank in ranks) <= 0.25 + 0.1
        assert max(np.diff([0, *ranks, 1])) <= 0.0126


def test_weights_move_the_cuts(spark, million):
    some = million.limit(50_000)
    copies = some.where("weight > 0").select("values", F.explode(F.sequence(F.lit(1), F.col("weight").cast("int"))))
    assert quantile_cuts(some, 50, "weight") == quantile_cuts(copies, 50)


def test_node_table_walked_in_sql(spark, table, tmp_path):
    """A recursive walk over the stored table gives each row the margin that the model gives it."""
    rows, x, y = table
    model = second_order.fit_second_order(rows, 5, 3, 0.3, max_bins=20)
    trees.node_table(spark, model).write.parquet(str(tmp_path / "nodes"))
    rows.select(F.monotonically_increasing_id().alias("id"), "values").coalesce(1).write.parquet(str(tmp_path / "rows"))
    margins = duckdb.sql(f"""
        WITH RECURSIVE nodes AS (FROM '{tmp_path}/nodes/*.parquet'), points AS (FROM '{tmp_path}/rows/*.parquet'), walk AS (
            SELECT id, values, tree, 0 AS node FROM points, (SELECT DISTINCT tree FROM nodes)
            UNION ALL
            SELECT id, values, tree, CASE WHEN coalesce(values[feature + 1] < threshold, missing_left) THEN left_node ELSE right_node END
            FROM walk JOIN nodes USING (tree, node) WHERE feature IS NOT NULL
        ) SELECT id, sum(value) AS margin, any_value(values) AS values FROM walk JOIN nodes USING (tree, node) WHERE feature IS NULL GROUP BY id
    """).fetchall()
    assert len(margins) == len(x)
    found = model.margins(np.array([[np.nan if v is None else v for v in row[2]] for row in margins]))
    assert np.abs(found - [row[1] for row in margins]).max() < 1e-9


def test_missing_tenure_needs_no_stand_in(spark, sf_dir, tmp_path):
    clean = catalog._clean(spark, sf_dir)
    gaps = clean.withColumn("tenure", F.when(F.col("Churn") == 0, F.col("tenure")).otherwise(F.lit(None).cast("int")))
    trained = training.train(gaps, second_order=True, max_iter=3)
    assert not [f.name for f in trained.stored.features if f.missing]
    assert {r.metric: r.value for r in trained.report().collect()}["accuracy"] == 1.0  # only churners lack the number
    models.save_model(spark, trained.stored, str(tmp_path / "m"))
    loaded = models.load_model(spark, str(tmp_path / "m"))
    assert loaded.model.nodes() == trained.stored.model.nodes() and loaded.features == trained.stored.features
    request = spark.createDataFrame(
        [(0, values.JSON_TYPE, '[{"tenure":5},{"tenure":null}]')], "request_id bigint, content_type string, value string"
    )
    body = json.loads(serving.score_requests(request, loaded).first().body)
    assert body["predictions"] == [0, 1]
    features = boosting.scoring_features(gaps, loaded.features, keep=[values.ID])
    again = {r[0]: r.probability for r in boosting.predict(features, loaded.model, loaded.features, [values.ID]).collect()}
    assert all(abs(again[r[values.ID]] - r.probability) < 1e-12 for r in trained.holdout.collect())


def test_a_save_that_fails_halfway_leaves_the_older_version(spark, stored, tmp_path, monkeypatch):
    path = str(tmp_path / "store")
    with pytest.raises(FileNotFoundError):
        models.load_model(spark, path)
    small = encoding.Feature("a", "a")
    leaf = trees.TreeModel(*[np.array([v]) for v in (0, -1, 0.0, True, 0, 0, 0.5)])
    first = models.save_model(spark, models.StoredModel(leaf, [small]), path)

    def fails(*_):
        raise OSError("disk full")

    monkeypatch.setattr(models, "manifest_frame", fails)
    with pytest.raises(OSError):
        models.save_model(spark, stored, path)
    loaded = models.load_model(spark, path)
    assert loaded.features == [small] and loaded.model.value.tolist() == [0.5]
    monkeypatch.undo()
    second = models.save_model(spark, models.StoredModel(leaf, [small, small]), path, keep_older=False)
    assert first != second and len(models.load_model(spark, path).features) == 2
    assert first not in [p.name for p in (tmp_path / "store" / "versions").iterdir()]
