import json

import pytest

from holdfast.__main__ import main
from holdfast.plans import catalog
from holdfast.sources.models import load_model


@pytest.mark.parametrize("format, options", [("csv", []), ("parquet", ["--keep-id"])])
def test_raw_files_to_responses(spark, sf_dir, tmp_path, format, options):
    raw = catalog.raw_csv(spark, sf_dir)
    clean, model, out = (str(tmp_path / name) for name in ("clean", "model", "out"))
    main(["clean", raw, clean, "--format", format, *options])
    main(["train", clean, model, "--format", format, "--trees", "2"])
    assert [f.name for f in load_model(spark, model).features] == catalog.FEATURES

    (tmp_path / "in").mkdir()
    lines = ['{"tenure":3,"Contract":"One year"}', '[{"tenure":3},{"tenure":40}]', "[]"]
    (tmp_path / "in" / "a.txt").write_text("\n".join(lines) + "\n")
    main(["score", str(tmp_path / "in"), model, out])
    found = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert sorted(r["status"] for r in found) == [200, 200, 500]

    main(["stream", str(tmp_path / "in"), model, str(tmp_path / "streamed"), str(tmp_path / "state")])
    streamed = spark.read.parquet(str(tmp_path / "streamed")).collect()
    assert sorted(r.body for r in streamed) == sorted(r["body"] for r in found)


def test_reports(spark, sf_dir, tmp_path):
    raw = catalog.raw_csv(spark, sf_dir)
    main(["violations", raw, str(tmp_path / "bad")])
    assert {r["column"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()} == {"TotalCharges"}
    main(["inventory", raw, str(tmp_path / "files")])
    assert all(".csv" in r.path for r in spark.read.parquet(str(tmp_path / "files")).collect())
