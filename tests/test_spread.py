"""Rows that come in one piece, and the work that is dealt out."""

import os

from pyspark.sql import functions as F

from holdfast import runtime
from holdfast.operators import boosting
from holdfast.operators.encoding import Feature
from holdfast.plans import catalog, fixtures
from holdfast.runtime import FEW_ROWS, spread


def tasks(df):
    return df.rdd.getNumPartitions()


def test_many_rows_in_one_piece_are_dealt_out(spark):
    rows = spark.range(0, 3 * FEW_ROWS, 1, 1)
    dealt = spread(rows)
    assert tasks(dealt) == min(3, spark.sparkContext.defaultParallelism)
    assert dealt.agg(F.count("*"), F.countDistinct("id"), F.sum("id")).first()[:] == rows.agg(
        F.count("*"), F.countDistinct("id"), F.sum("id")
    ).first()[:]
    assert tasks(spread(spark.range(0, FEW_ROWS, 1, 1))) == 1
    assert spread(spark.range(0, 0, 1, 1)).isEmpty()


def test_accounts_of_one_row_group_are_dealt_out(spark, tmp_path):
    keys = F.when(F.col("id") % 1000 != 0, F.col("id")).alias("c_custkey")  # nulls too
    spark.range(0, 2 * FEW_ROWS, 1, 1).select(keys).write.parquet(f"{tmp_path}/customer.parquet")
    assert tasks(spark.read.parquet(f"{tmp_path}/customer.parquet")) == 1
    for derived in (fixtures.accounts_raw, fixtures.requests_raw, fixtures.scored):
        assert tasks(derived(spark, str(tmp_path))) == 2
    found = fixtures.accounts_wide(spark, str(tmp_path)).agg(F.count("*"), F.countDistinct("k")).first()
    assert found[:] == (2 * FEW_ROWS, 2 * FEW_ROWS - 40)


def test_fit_deals_out_many_rows(spark, monkeypatch):
    seen = []

    class Seen(boosting.Pipeline):
        def fit(self, rows):
            seen.append(tasks(rows))
            return super().fit(rows)

    monkeypatch.setattr(boosting, "Pipeline", Seen)
    for n in (2 * FEW_ROWS, 100):
        table = spark.range(0, n, 1, 1).selectExpr("id % 7 AS x", "CAST(id % 7 > 3 AS INT) AS y")
        model = boosting.fit_trees(table, [Feature("x", "x")], "y", max_iter=1, max_depth=1)
        found = boosting.predict(table, model, [Feature("x", "x")], ["y"])
        assert found.where("y != prediction").isEmpty()
    assert seen == [2, 1]


def test_scoring_queries_deal_out_one_row_group(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalog, "CATALOG_TREES", 1)
    folder, n = str(tmp_path), 2 * FEW_ROWS
    spark.range(0, n, 1, 1).withColumnRenamed("id", "c_custkey").write.parquet(f"{folder}/customer.parquet")
    for name in ("node_table_scores", "model_roundtrip"):
        scored = catalog.QUERIES[name](spark, folder)
        assert tasks(scored) == 2
        assert scored.where("same = 1").agg(F.countDistinct("customerID")).first()[0] == n
    whole = catalog.score_requests(spark, folder)
    assert whole.agg(F.count("*"), F.countDistinct("request_id")).first()[:] == (n, n)
    for stream in (catalog.score_stream, catalog.predict_stream):
        found = stream(spark, folder)
        files = [path for path in runtime._named if path.endswith("/request_files")][-1]
        assert len(spark.read.text(files).inputFiles()) == 2
        assert found.agg(F.countDistinct("request_id")).first()[0] == n
    answers = catalog.score_stream(spark, folder).select(whole.columns)
    assert answers.exceptAll(whole).isEmpty() and whole.exceptAll(answers).isEmpty()


def test_splits_of_repeated_lines_do_not_grow_with_the_file(spark, tmp_path):
    path = tmp_path / "lines"
    for size in (1_000, 60_000_000, 600_000_000):
        with path.open("wb") as file:
            os.truncate(file.fileno(), size)
        split = catalog._other_split(spark, str(path), "16m")
        assert 50_000 <= split <= 8 << 20
        assert size / split <= 33 * spark.sparkContext.defaultParallelism or split == 8 << 20
    assert catalog._other_split(spark, str(path), str(1 << 40)) == 600_000_000 // (32 * spark.sparkContext.defaultParallelism)
