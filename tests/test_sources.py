"""Folders of mixed CSV headers, ids of request lines."""

import gzip

import pytest

from holdfast import values
from holdfast.runtime import scratch_path
from holdfast.sources import accounts, requests
from holdfast.streaming import scorer

HEADER = values.RAW_SCHEMA.names


def write(folder, name, header, *rows):
    text = "\n".join([",".join(header), *[",".join(row) for row in rows]]) + "\n"
    (gzip.open(folder / name, "wt") if name.endswith(".gz") else open(folder / name, "w")).write(text)


def row(id, order):
    known = {name: "Yes" for name in HEADER} | {"customerID": id, "tenure": "3", "SeniorCitizen": "1", "MonthlyCharges": "2.5", "TotalCharges": " "}
    return [known.get(name, "?") for name in order]


def test_headers_in_any_order(spark, tmp_path):
    other = ["x", *HEADER[::-1], "x", "X"]
    write(tmp_path, "a.csv", HEADER, row("A", HEADER), row("B", HEADER))
    write(tmp_path, "b b.csv.gz", other, row("C", other))
    write(tmp_path, "c.csv", ["\ufeff" + HEADER[0], *HEADER[1:]], row("D", HEADER))
    (tmp_path / "empty.csv").write_text("")
    assert sorted(len(files) for files in accounts.headers(spark, str(tmp_path)).values()) == [1, 2]
    found = accounts.scan_accounts(spark, str(tmp_path), corrupt=True).orderBy("customerID").collect()
    assert [r.customerID for r in found] == ["A", "B", "C", "D"]
    assert all((r.tenure, r.MonthlyCharges, r.Churn) == (3, 2.5, "Yes") for r in found)


def test_headers_that_cannot_be_read(spark, tmp_path):
    write(tmp_path, "a.csv", HEADER, row("A", HEADER))
    short = HEADER[:-1]
    write(tmp_path, "b.csv", short, row("B", short))
    with pytest.raises(ValueError, match="b.csv has no column Churn"):
        accounts.scan_accounts(spark, str(tmp_path))
    (tmp_path / "b.csv").write_text(",".join([*HEADER, "tenure"]) + "\n")
    with pytest.raises(ValueError, match="more than once"):
        accounts.scan_accounts(spark, str(tmp_path))


def test_clean_files_with_and_without_ids(spark, tmp_path):
    names = values.CLEAN_SCHEMA.names
    line = ["1" if name not in values.CATEGORICAL else "No" for name in names]
    write(tmp_path, "a.csv", names, line)
    without = [i for i, name in enumerate(names) if name != values.ID]
    write(tmp_path, "b.csv", [names[i] for i in without], [line[i] for i in without])
    assert sorted(str(r[values.ID]) for r in accounts.scan_clean(spark, str(tmp_path), "csv").collect()) == ["1", "None"]


@pytest.fixture(scope="module")
def line_files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("lines")
    for name in "ab":
        lines = [f'{{"k":{i % 700}}}' for i in range(1500)] + ["{}"] * 2000
        (folder / f"{name}.txt").write_text("\n".join(lines) + "\n")
    return str(folder)


def ids(requests_):
    return sorted((r.request_id, r.value) for r in requests_.collect())


def test_line_ids_do_not_depend_on_splits(spark, line_files):
    first = ids(requests.scan_requests(spark, line_files))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    again = requests.scan_requests(spark, line_files)
    assert spark.read.text(line_files).rdd.getNumPartitions() > 8
    assert ids(again) == first
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len({id for id, _ in first}) == len(first) == 7000


def test_line_ids_of_a_stream_are_those_of_a_table(spark, stored, line_files):
    out = scratch_path(spark, "line_responses")
    lines = requests.stream_requests(spark, line_files, files_per_batch=1)
    scorer.score_stream(lines, stored, out, scratch_path(spark, "line_state")).awaitTermination()
    found = spark.read.parquet(out)
    assert found.select("batch").distinct().count() == 2
    assert sorted(r.request_id for r in found.collect()) == [id for id, _ in ids(requests.scan_requests(spark, line_files))]


def test_bare_lines(spark):
    found = requests.number_lines(spark.createDataFrame([("a",), ("a",), ("b",)], "value string")).collect()
    assert len({r.request_id for r in found}) == 3
