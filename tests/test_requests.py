import json

import pytest
from pyspark.sql import functions as F

from holdfast.operators import boosting, envelope
from holdfast.operators.encoding import Feature
from holdfast.plans.serving import score_records, score_requests
from holdfast.sources.requests import scan_requests, write_responses

# A sample request.
SAMPLE = {
    "gender": "Female", "SeniorCitizen": 0, "Partner": 1, "Dependents": 0, "tenure": 1, "PhoneService": 0,
    "MultipleLines": "No phone service", "InternetService": "DSL", "OnlineSecurity": "No",
    "OnlineBackup": "Yes", "DeviceProtection": "No", "TechSupport": "No", "StreamingTV": "No",
    "StreamingMovies": "No", "Contract": "Month-to-month", "PaperlessBilling": 1,
    "PaymentMethod": "Electronic check", "MonthlyCharges": 29.85, "TotalCharges": 29.85,
}

FEATURES = [Feature("a", "a"), Feature("b", "b"), Feature("c_x.y (z)", "c", "x.y (z)"), Feature("c_w", "c", "w")]


def frame(spark, *texts, content_type="application/json"):
    return spark.createDataFrame(
        [(i, content_type, t) for i, t in enumerate(texts)], "request_id bigint, content_type string, value string"
    )


def aligned(spark, text, mode=boosting.ENCODED):
    parsed = envelope.parse_requests(frame(spark, text), *envelope.wanted_keys(FEATURES, mode))
    rows = envelope.align_requests(parsed, FEATURES, mode).orderBy("position").collect()
    return [r["values"] for r in rows], [r.error for r in rows]


@pytest.mark.parametrize(
    "text, error",
    [
        ('{"a":1}', None),
        (' \n {"a":1} ', None),
        ('[{"a":1},{"a":2}]', None),
        ("{}", None),
        ('{"body":"{\\"a\\":1}"}', None),
        ('{"body":"[{\\"a\\":1}]"}', None),
        ('{"\\u0062ody":"{\\"a\\":1}"}', None),
        ('{"\\u0062ody":null}', envelope.BODY_NOT_TEXT),
        ('{"a":"some body"}', None),
        ('[{"body":"x"}]', None),
        ("[]", envelope.NO_RECORDS),
        ('{"body":"[]"}', envelope.NO_RECORDS),
        ('{"a":1', envelope.MALFORMED),
        ('{"a":1} x', envelope.MALFORMED),
        ('{"a":1}]', envelope.MALFORMED),
        ('{"a":1},{"a":2}', envelope.MALFORMED),
        ('[{"a":1}] {"a":2}', envelope.MALFORMED),
        ('[{"a":1}],[{"a":2}]', envelope.MALFORMED),
        ('[{"a":1}],[{"_end":"0"}]]', envelope.MALFORMED),
        ("{'a':1}", envelope.MALFORMED),
        ("", envelope.MALFORMED),
        ("   ", envelope.MALFORMED),
        (None, envelope.MALFORMED),
        ("5", envelope.MALFORMED),
        ('"text"', envelope.MALFORMED),
        ("[null]", envelope.NOT_AN_OBJECT),
        ('{"body":null}', envelope.BODY_NOT_TEXT),
        ('{"body":{"a":1}}', envelope.BODY_NOT_TEXT),
        ('{"body":7}', envelope.BODY_NOT_TEXT),
        ('{"body":"{"}', envelope.MALFORMED),
        ('{"body":"{\\"a\\":1}"', envelope.MALFORMED),
    ],
)
def test_request_kinds(spark, text, error):
    assert envelope.parse_requests(frame(spark, text), ["a"]).first().error == error


@pytest.mark.parametrize("kind", ["text/csv", "application/json; charset=utf-8", None])
def test_content_type(spark, kind):
    row = envelope.parse_requests(frame(spark, '{"a":1}', content_type=kind), ["a"]).first()
    assert row.error == f"Unsupported content type: {kind}" and row.records is None


def test_absent_from_the_request_is_zero_absent_from_a_record_is_missing(spark):
    assert aligned(spark, '{"b":2}')[0] == [[0.0, 2.0, 0.0, 0.0]]
    assert aligned(spark, '[{"a":1,"b":2},{"b":3}]')[0] == [[1.0, 2.0, 0.0, 0.0], [None, 3.0, 0.0, 0.0]]
    assert aligned(spark, '[{"b":2},{"b":3}]')[0] == [[0.0, 2.0, 0.0, 0.0], [0.0, 3.0, 0.0, 0.0]]
    assert aligned(spark, '{"a":null}')[0] == [[None, 0.0, 0.0, 0.0]]
    assert aligned(spark, "[{},{}]")[0] == [[0.0] * 4] * 2


def test_values(spark):
    assert aligned(spark, '{"a":true,"b":1.5e1}')[0] == [[1.0, 15.0, 0.0, 0.0]]
    assert aligned(spark, '{"a":NaN,"b":7}')[0] == [[None, 7.0, 0.0, 0.0]]
    for odd in ('"7"', "Infinity", "-Infinity"):
        assert aligned(spark, f'{{"a":1,"b":{odd}}}')[1] == ["not a number: b"]
    assert aligned(spark, '{"a":1,"a":2}')[0] == [[2.0, 0.0, 0.0, 0.0]]
    assert aligned(spark, '{"a":1,"b":"many"}')[1] == ["not a number: b"]
    assert aligned(spark, '{"b":[1]}')[1] == ["not a number: b"]


def test_categories_are_read_as_in_the_fit(spark):
    assert aligned(spark, '{"c":" w "}')[0] == [[0.0, 0.0, 0.0, 1.0]]
    assert aligned(spark, '{"c":"N/A"}')[0] == [[0.0] * 4]


def test_requests_that_share_an_id_get_an_answer_each(spark, stored):
    same = frame(spark, json.dumps(SAMPLE), "{", json.dumps([SAMPLE, SAMPLE])).withColumn("request_id", F.lit(1))
    rows = score_requests(same, stored).collect()
    assert sorted((r.request_id, r.status) for r in rows) == [(1, 200), (1, 200), (1, 500)]


def test_modes(spark):
    assert aligned(spark, '{"c":"w"}')[0] == [[0.0, 0.0, 0.0, 1.0]]
    assert aligned(spark, '{"c":"x.y (z)"}')[0] == [[0.0, 0.0, 1.0, 0.0]]
    assert aligned(spark, '{"c":"new"}')[0] == [[0.0] * 4]
    assert aligned(spark, '{"c":"w"}', boosting.REFERENCE_PARITY)[0] == [[0.0] * 4]
    for mode in (boosting.ENCODED, boosting.REFERENCE_PARITY):
        assert aligned(spark, '{"c_w":1}', mode)[0] == [[0.0, 0.0, 0.0, 1.0]]


def test_features_without_numbers(spark):
    features = [Feature("c_it's `x`", "c", "it's `x`")]
    parsed = envelope.parse_requests(frame(spark, json.dumps({"c": "it's `x`"})), *envelope.wanted_keys(features))
    assert envelope.align_requests(parsed, features).first()["values"] == [1.0]


def body(row):
    return json.loads(row.body)


def test_sample_request(spark, stored):
    row = score_requests(frame(spark, json.dumps(SAMPLE)), stored).first()
    assert row.status == 200 and row.error is None
    answer = body(row)
    assert answer["predictions"] in ([0], [1]) and 0 < answer["probabilities"][0] < 1
    assert answer["predictions"][0] == int(answer["probabilities"][0] > 0.5)


def test_envelope_and_list_score_as_the_bare_object(spark, stored):
    bare = json.dumps(SAMPLE)
    other = {**SAMPLE, "tenure": 60, "Contract": "Two year"}
    texts = [bare, json.dumps({"body": bare}), json.dumps(other), json.dumps([other, SAMPLE, other])]
    rows = {r.request_id: body(r) for r in score_requests(frame(spark, *texts), stored).collect()}
    assert rows[0] == rows[1]
    one, two = rows[0]["probabilities"][0], rows[2]["probabilities"][0]
    assert one != two and rows[3]["probabilities"] == [two, one, two]


def test_missing_value_policy(spark, stored):
    lacking = {k: v for k, v in SAMPLE.items() if k != "tenure"}
    text = json.dumps([SAMPLE, lacking])
    row = score_requests(frame(spark, text), stored).first()
    assert row.status == 200 and len(body(row)["predictions"]) == 2
    row = score_requests(frame(spark, text), stored, fill=None).first()
    assert (row.status, body(row)) == (500, {"error": "missing value: tenure"})
    filled = score_requests(frame(spark, text, json.dumps(lacking)), stored, fill=0.0).collect()
    filled = {r.request_id: body(r)["probabilities"] for r in filled}
    assert filled[0][1] == filled[1][0]


def test_any_error_fails_the_whole_request_and_no_other(spark, stored):
    texts = [json.dumps([SAMPLE, {**SAMPLE, "tenure": "long"}]), json.dumps(SAMPLE), "{", None]
    rows = {r.request_id: r for r in score_requests(frame(spark, *texts), stored).collect()}
    assert [rows[i].status for i in range(4)] == [500, 200, 500, 500]
    assert body(rows[0]) == {"error": "not a number: tenure"}
    records = score_records(frame(spark, *texts), stored).where("error is not null").collect()
    assert all(r.prediction is None and r.probability is None for r in records)


def test_long_list_keeps_its_order(spark, stored):
    records = [{**SAMPLE, "tenure": i % 73, "MonthlyCharges": 20 + i / 10} for i in range(2000)]
    singles = {
        r.request_id: body(r)["probabilities"][0]
        for r in score_requests(frame(spark, *[json.dumps(r) for r in records]), stored).collect()
    }
    row = score_requests(frame(spark, json.dumps(records)), stored).first()
    assert body(row)["probabilities"] == [singles[i] for i in range(2000)]


def test_parity_equals_encoded_on_baseline_levels_only(spark, stored):
    baseline = {
        **SAMPLE, "gender": "Female", "MultipleLines": "No", "InternetService": "DSL", "OnlineBackup": "No",
        "Contract": "Month-to-month", "PaymentMethod": "Bank transfer (automatic)",
    }
    other = {**baseline, "Contract": "Two year"}
    texts = [json.dumps(baseline), json.dumps(other)]
    encoded = {r.request_id: body(r) for r in score_requests(frame(spark, *texts), stored).collect()}
    parity = score_requests(frame(spark, *texts), stored, boosting.REFERENCE_PARITY).collect()
    parity = {r.request_id: body(r) for r in parity}
    assert parity[0] == encoded[0] == parity[1]
    assert encoded[1] != parity[1]


def test_text_lines_in_text_lines_out(spark, stored, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(json.dumps(SAMPLE) + "\n{\n")
    responses = score_requests(scan_requests(spark, str(tmp_path / "in")), stored)
    write_responses(responses, str(tmp_path / "out"))
    found = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert sorted(r["status"] for r in found) == [200, 500]


def test_form_typing(spark):
    names = ["tenure", "gender", "MonthlyCharges", "Partner"]
    form = spark.createDataFrame([("12 months", "x", " 29.85", "")], names)
    assert tuple(envelope.type_fields(form).first()) == (12, "x", 29.85, None)


def test_one_shuffle_and_one_parse(spark, stored):
    plan = score_requests(frame(spark, "{}"), stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Python" not in plan
    assert plan.count("from_json") <= 2  # the envelope and the records
