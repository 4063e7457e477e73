import random
from decimal import ROUND_HALF_EVEN, ROUND_HALF_UP, Decimal

import pytest

from holdfast import values
from holdfast.functions.numbers import leading_float, leading_int, one_decimal_text, rounded
from holdfast.operators import cleaning
from holdfast.operators.domain import domain_violations
from holdfast.sources.accounts import scan_accounts, scan_clean, write_table
from pyspark.sql import functions as F


def raw_row(**changes):
    row = dict(
        customerID="A1", gender="Male", SeniorCitizen=1, Partner="Yes", Dependents="No", tenure=3,
        PhoneService="Yes", MultipleLines="No", InternetService="DSL", OnlineSecurity="No",
        OnlineBackup="Yes", DeviceProtection="No", TechSupport="No", StreamingTV="No",
        StreamingMovies="No", Contract="One year", PaperlessBilling="Yes",
        PaymentMethod="Mailed check", MonthlyCharges=20.5, TotalCharges="61.5", Churn="No",
    )
    return {**row, **changes}


def raw(spark, *changes):
    return spark.createDataFrame([tuple(raw_row(**c).values()) for c in changes], values.RAW_SCHEMA)


@pytest.mark.parametrize(
    "text, number",
    [("61.5", 61.5), (" 61.5 ", 61.5), (" ", 0.0), ("", 0.0), (None, 0.0), ("n/a", 0.0), ("NaN", 0.0), ("1e2", 100.0)],
)
def test_charges(spark, text, number):
    assert cleaning.clean_accounts(raw(spark, {"TotalCharges": text})).first().TotalCharges == number


@pytest.mark.parametrize("text, flag", [("Yes", 1), ("No", 0), ("yes", 0), ("Yes ", 0), (None, 0)])
def test_flags(spark, text, flag):
    row = cleaning.clean_accounts(raw(spark, {"Partner": text, "Churn": text})).first()
    assert (row.Partner, row.Churn) == (flag, flag)


def test_columns_and_types(spark):
    clean = cleaning.clean_accounts(raw(spark, {}))
    assert values.ID not in clean.columns
    kept = cleaning.clean_accounts(raw(spark, {}), keep_id=True)
    assert [(f.name, f.dataType) for f in kept.schema] == [(f.name, f.dataType) for f in values.CLEAN_SCHEMA]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    rows = raw(spark, {"Partner": "Yes", "Dependents": "No"})
    turned = rows.select(F.lit("x").alias("other"), *reversed(rows.columns))
    turned.write.option("header", True).csv(str(tmp_path / "turned"))
    assert scan_accounts(spark, str(tmp_path / "turned")).collect() == rows.collect()
    turned.drop("tenure").write.option("header", True).csv(str(tmp_path / "short"))
    with pytest.raises(ValueError, match="tenure"):
        scan_accounts(spark, str(tmp_path / "short"))


@pytest.mark.parametrize("keep_id", [True, False])
def test_clean_csv_with_or_without_id(spark, tmp_path, keep_id):
    clean = cleaning.clean_accounts(raw(spark, {}), keep_id=keep_id)
    write_table(clean, str(tmp_path / "clean"), "csv")
    assert scan_clean(spark, str(tmp_path / "clean"), "csv").collect() == clean.collect()


def test_nan_is_outside_the_domain(spark):
    found = domain_violations(raw(spark, {"MonthlyCharges": float("nan")}, {})).collect()
    assert [tuple(r) for r in found] == [("MonthlyCharges", "NaN", 1)]


def test_csv_scan_keeps_blanks_nulls_and_broken_rows(spark, tmp_path):
    header = ",".join(values.RAW_SCHEMA.names)
    good = "A1,Male,1,Yes,No,3,Yes,No,DSL,No,No,No,No,No,No,One year,Yes,Mailed check,20.5, ,No"
    empty = good.replace(", ,", ",,")
    broken = good.replace(",3,", ",many,")
    (tmp_path / "a.csv").write_text("\n".join([header, good, empty]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([header, broken]) + "\n")
    rows = scan_accounts(spark, str(tmp_path), corrupt=True).collect()
    assert {(r.TotalCharges, r.tenure) for r in rows} == {(" ", 3), (None, 3), (" ", None)}
    assert [r._corrupt_record for r in rows if r.tenure is None] == [broken]


def test_clean_csv_takes_missing_texts_as_null(spark, tmp_path):
    clean = cleaning.clean_accounts(raw(spark, {"gender": "NA"}, {"gender": " Male "}, {"gender": ""}))
    write_table(clean, str(tmp_path / "clean"), "csv")
    found = [r.gender for r in scan_clean(spark, str(tmp_path / "clean"), "csv").collect()]
    assert sorted(found, key=str) == ["Male", None, None]


def test_clean_plan_is_one_narrow_stage(spark, sf_dir):
    from holdfast.plans import catalog

    plan = catalog.QUERIES["clean_accounts"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_domain_violations(spark):
    table = raw(spark, {}, {"gender": "X"}, {"gender": "X"}, {"tenure": -1}, {"Partner": None}, {"TotalCharges": " "})
    found = {(r["column"], r["value"]): r["count"] for r in domain_violations(table).collect()}
    assert found == {("gender", "X"): 2, ("tenure", "-1"): 1, ("Partner", None): 1, ("TotalCharges", " "): 1}


def test_leading_numbers(spark):
    texts = ["12", " 7 months", "-3.9", "+4", "abc", "", "1e3", ".5", "5.", "2.5e1x", "Infinity", "0x1F", "- 2", "\u00a0 7"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(leading_int(F.col("t")).alias("i"), leading_float(F.col("t")).alias("f")).collect()
    assert [r.i for r in rows] == [12, 7, -3, 4, None, None, 1, None, 5, 2, None, 0, None, 7]
    assert [r.f for r in rows] == [
        12.0, 7.0, -3.9, 4.0, None, None, 1000.0, 0.5, 5.0, 25.0, float("inf"), 0.0, None, 7.0,
    ]


def test_rounding_decides_on_the_binary_value(spark):
    numbers = [1.45, 0.25, 0.75, 57.0, 56.99999999999999, 8.35, 1.005, 0.0, 100.0, 99.95, 0.05]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    rows = df.select(
        one_decimal_text(F.col("x")).alias("one"),
        rounded(F.col("x"), 1, ties="even").alias("even"),
        rounded(F.col("x"), 2).alias("two"),
    ).collect()
    even = [float(f"{x:.1f}") for x in numbers]
    assert [r.even for r in rows] == even
    ties_up = {0.25: "0.3", 0.75: "0.8"}
    assert [r.one for r in rows] == [ties_up.get(x, f"{x:.1f}") for x in numbers]
    assert [r.two for r in rows] == [{0.25: 0.25, 0.75: 0.75}.get(x, float(f"{x:.2f}")) for x in numbers]


def test_rounding_equals_exact_decimals(spark):
    rng = random.Random(3)
    numbers = [rng.random() * 100 for _ in range(2000)]
    numbers += [rng.randrange(2001) / 20 for _ in range(500)]  # near or on a tie at one decimal
    numbers += [100 - rng.randrange(100_000) / 1000 for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in numbers], "x double")
    found = df.select("x", rounded(F.col("x"), 1).alias("up"), rounded(F.col("x"), 4, "even").alias("even")).collect()
    for row in found:
        exact = Decimal(row.x)
        assert row.up == float(exact.quantize(Decimal("0.1"), ROUND_HALF_UP))
        assert row.even == float(exact.quantize(Decimal("0.0001"), ROUND_HALF_EVEN)) == float(f"{row.x:.4f}")
