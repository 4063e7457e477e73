import pytest

from holdfast import values
from holdfast.operators import encoding


@pytest.fixture(scope="module")
def table(spark):
    rows = [(1, "b", "x", 5), (0, "a", "x", 6), (1, None, "x", 7), (0, "c.d (e)", "x", None)]
    return spark.createDataFrame(rows, "Churn int, kind string, lone string, n int")


def test_levels_are_sorted_without_nulls(table):
    assert encoding.category_levels(table, ["kind", "lone"]) == {"kind": ["a", "b", "c.d (e)"], "lone": ["x"]}


def test_too_many_levels_is_an_error(table):
    with pytest.raises(ValueError, match="kind"):
        encoding.category_levels(table, ["kind", "lone"], max_levels=2)


def test_one_hot(table):
    levels = encoding.category_levels(table, ["kind", "lone"])
    found = encoding.one_hot(table, levels)
    assert found.columns == ["Churn", "n", "kind_b", "kind_c.d (e)"]
    assert [tuple(r) for r in found.collect()] == [(1, 5, 1, 0), (0, 6, 0, 0), (1, 7, 0, 0), (0, None, 0, 1)]


def test_align(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b int, extra string")
    aligned = encoding.align_columns(df, ["b", "new", "a"])
    assert aligned.columns == ["b", "new", "a"]
    assert tuple(aligned.first()) == (None, 0, 1)
    again = encoding.align_columns(aligned, ["b", "new", "a"])
    assert again.columns == aligned.columns and again.collect() == aligned.collect()


def test_encode_align_on_training_rows_is_one_hot(table):
    levels = encoding.category_levels(table, ["kind", "lone"])
    features = encoding.manifest(table.columns, levels, "Churn", None)
    names = [f.name for f in features]
    assert names == ["n", "kind_b", "kind_c.d (e)"]
    direct = encoding.align_columns(encoding.one_hot(table, levels), names)
    assert encoding.encode_align(table, features).collect() == direct.collect()


def test_unseen_level_and_absent_column_are_zero(spark, table):
    features = encoding.manifest(table.columns, encoding.category_levels(table, ["kind", "lone"]), "Churn", None)
    new = spark.createDataFrame([("zzz",)], "kind string")
    assert tuple(encoding.encode_align(new, features).first()) == (0, 0, 0)
    ready = spark.createDataFrame([(3, 1)], "n int, kind_b int")
    assert tuple(encoding.encode_align(ready, features).first()) == (3, 1, 0)


def test_manifest_survives_storage(spark, table, tmp_path):
    features = encoding.manifest(table.columns, encoding.category_levels(table, ["kind", "lone"]), "Churn", None)
    encoding.manifest_frame(spark, features).repartition(3).write.parquet(str(tmp_path / "m"))
    assert encoding.read_manifest(spark.read.parquet(str(tmp_path / "m"))) == features


def test_assemble_takes_any_name(table):
    features = encoding.manifest(table.columns, encoding.category_levels(table, ["kind", "lone"]), "Churn", None)
    rows = encoding.encode_align(table.na.fill({"n": 0}), features, ["Churn"])
    vectors = encoding.assemble_features(rows, features, ["Churn"]).collect()
    assert [list(r.features) for r in vectors] == [[5, 1, 0], [6, 0, 0], [7, 0, 0], [0, 0, 1]]


def test_levels_need_one_shuffle(spark, sf_dir):
    from holdfast.plans import fixtures

    raw = fixtures.accounts_raw(spark, sf_dir)
    features = encoding.manifest(
        values.CLEAN_SCHEMA.names, {c: sorted(values.LEVELS[c]) for c in values.CATEGORICAL}
    )
    plan = encoding.encode_align(raw, features)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_missing_indicators(spark):
    df = spark.createDataFrame([(1, 2.0), (None, 3.0), (4, float("nan"))], "a int, b double")
    assert encoding.columns_with_missing(df, ["a", "b"]) == ["a", "b"]
    assert encoding.columns_with_missing(df.na.drop(), ["a", "b"]) == []
    features = encoding.manifest(["a", "b"], {}, None, None, ["a", "b"])
    assert [tuple(r)[2:] for r in encoding.encode_align(df, features).collect()] == [(0, 0), (1, 0), (0, 1)]


def test_level_positions_in_many_ranges(spark):
    df = spark.range(3000).selectExpr("CAST(id % 700 AS STRING) AS a", "CAST(id % 3 AS STRING) AS b")
    found = sorted(tuple(r) for r in encoding.level_table(df, ["a", "b"]).collect())
    expected = [("a", i, x) for i, x in enumerate(sorted(map(str, range(700))))]
    assert found == expected + [("b", i, x) for i, x in enumerate("012")]
