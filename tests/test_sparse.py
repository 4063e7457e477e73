"""Encoding and alignment by lookup against the forms that name every feature."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from holdfast import values
from holdfast.operators import encoding, envelope, sparse
from holdfast.operators.encoding import Feature
from holdfast.runtime import materialize


def requests(spark, texts):
    rows = [(i, values.JSON_TYPE, text) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "request_id bigint, content_type string, value string")


def plan(df):
    """The plan without the numbers of its columns and without paths."""
    return re.sub(r"\d+", "", df._jdf.queryExecution().optimizedPlan().toString())


FEATURES = [
    Feature("a", "a"), Feature("b", "b"), Feature("c_x", "c", "x"), Feature("c_y z", "c", "y z"), Feature("d_1", "d", "1"),
    Feature("a_missing", "a", missing=True),
]
ODD = [
    '{"a":1,"b":2.5,"c":"x","d":"1"}', "{}", "[{},{}]", '{"a":null}', '{"a":"7"}', '{"b":[1]}', '{"a":"7","b":"8"}', '{"a":true,"b":false}',
    '[{"a":1},{"b":2}]', '[{"c":"y z"},{"d":"1"}]', '{"c":" x "}', '{"c":"n/a","c_x":1}', '{"c":"x","c_x":0,"c_y z":1}', '{"c":"other","c_x":1}',
    '{"c_x":3}', '{"c_x":"1"}', '[{"c":"x"},{"c_x":1}]', '{"c":null,"c_y z":1}', '{"unknown":1,"e":{"a":1}}', '{"a":1e999}', "nonsense", "[]", "[1]",
    '{"a":1} x', '{"d":1}', '{"d":"2"}', '{"":1}', '{"body":"{\\"a\\":4}"}', '[{"a":1},{"a":null},{"b":1}]', '{"a":-0.0,"b":0}',
]


def both(spark, texts, features):
    rows = requests(spark, texts)
    named = envelope.align_requests(envelope.parse_requests(rows, *envelope.wanted_keys(features)), features)
    table = materialize(encoding.manifest_frame(spark, features))
    looked = sparse.align_sparse(envelope.parse_requests(rows, None), table)
    looked = looked.select("request_id", "position", "error", sparse.dense(F.col("features")).alias("values"))
    return ({(r.request_id, r.position): (r.error, None if r.error else r["values"]) for r in df.collect()} for df in (named, looked))


@pytest.mark.parametrize("limit", [sparse.BROADCAST_BYTES, 0])
def test_alignment_by_keys_equals_that_by_name(spark, monkeypatch, limit):
    monkeypatch.setattr(sparse, "BROADCAST_BYTES", limit)
    named, looked = both(spark, ODD, FEATURES)
    assert looked == named


def test_random_requests(spark):
    random.seed(5)
    keys, found = ["a", "b", "c", "d", "c_x", "c_y z", "d_1", "other"], [1, 0, -2.5, "x", "y z", "1", None, "", " x", True]
    texts = [json.dumps([{k: random.choice(found) for k in random.sample(keys, random.randrange(5))} for _ in range(random.randrange(1, 4))]) for _ in range(400)]
    named, looked = both(spark, texts, FEATURES)
    assert looked == named


def test_plans_do_not_grow_with_the_manifest(spark):
    texts, plans = ['{"s":"l7","n":3}', '[{"s":"l1999"},{"n":1}]'], []
    for n in (20, 2000):
        features = [Feature("n", "n"), *[Feature(f"s_l{i}", "s", f"l{i}") for i in range(1, n)]]
        table = materialize(encoding.manifest_frame(spark, features))
        aligned = sparse.align_sparse(envelope.parse_requests(requests(spark, texts), None), table)
        encoded = sparse.encode_sparse(spark.createDataFrame([("l3", 1.0)], "s string, n double"), table)
        plans.append([plan(aligned), plan(encoded)])
        rows = {(r.request_id, r.position): r.features for r in aligned.collect()}
        assert (rows[0, 0]["size"], rows[0, 0].indices, rows[0, 0]["values"]) == (n, [0, 7], [3.0, 1.0])
        assert rows[1, 0].indices[1:] == ([] if n == 20 else [1999])
        assert encoded.first().features.indices == [0, 3]
    assert plans[0] == plans[1]


@pytest.mark.parametrize("limit", [sparse.BROADCAST_BYTES, 1000])
def test_many_levels(spark, monkeypatch, limit):
    monkeypatch.setattr(sparse, "BROADCAST_BYTES", limit)
    if limit == 1000:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    n = 150_000
    rows = spark.range(n).select(F.col("id"), F.concat(F.lit("k"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("k"), F.lit(None).cast("double").alias("x"))
    table = materialize(sparse.manifest_table(["id", "k", "x"], ["k"], encoding.level_table(rows, ["k"]), "label", "id", ["x"]))
    assert table.agg(F.count(F.lit(1)), F.max("position"), F.countDistinct("position")).first() == (n + 1, n, n + 1)
    found = sparse.encode_sparse(rows, table, ["id"])
    wrong = F.when(F.col("id") > 0, F.array_contains("features.indices", F.col("id").cast("int"))).otherwise(F.size("features.indices") == 2)
    assert found.where(~wrong | (F.col("features.size") != n + 1)).count() == 0
    assert ("BroadcastHashJoin" in found._jdf.queryExecution().executedPlan().toString()) == (limit > 1000)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_encoding_by_lookup_of_odd_tables(spark):
    table = materialize(encoding.manifest_frame(spark, FEATURES))
    schema = "b double, c string, d_1 int, position int, level string, source string"
    rows = spark.createDataFrame([(None, "x", 1, 5, "l", "s"), (2.0, None, None, 6, "l", "s"), (0.0, "none", 0, 7, "l", "s")], schema)
    named = encoding.encode_align(rows, FEATURES, ["position"])
    expected = {r["values"] and r.position: r["values"] for r in encoding.feature_values(named.drop("a_missing").withColumn("a_missing", F.lit(0)), FEATURES, ["position"]).collect()}
    found = {r.position: r.v for r in sparse.encode_sparse(rows, table, ["position"]).select("position", sparse.dense(F.col("features")).alias("v")).collect()}
    assert found == expected
    assert sparse.encode_sparse(rows.limit(0), table).collect() == []
    assert sparse.encode_sparse(rows, table.limit(0), ["b"]).first().features["size"] == 0
