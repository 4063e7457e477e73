import json

from holdfast.plans import fixtures
from holdfast.plans.serving import score_records, score_requests
from holdfast.sources.requests import stream_requests
from holdfast.streaming.scorer import predict_stream, score_stream


def answers(df):
    return sorted((r.request_id, r.status, r.body, r.error) for r in df.collect())


def test_stream_equals_batch_and_restarts_add_nothing(spark, sf_dir, stored, tmp_path):
    requests = fixtures.requests_raw(spark, sf_dir).limit(300)
    first, second = requests.where("request_id < 150"), requests.where("request_id >= 150")
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    first.repartition(3).write.json(source)

    def run():
        stream = stream_requests(spark, source, "json", files_per_batch=2)
        score_stream(stream, stored, out, state).awaitTermination()
        return answers(spark.read.parquet(out))

    assert run() == answers(score_requests(first, stored))
    assert run() == answers(score_requests(first, stored))  # restart, nothing new
    second.write.mode("append").json(source)
    assert run() == answers(score_requests(requests, stored))


def test_text_lines(spark, stored, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text('{"tenure":1}\n[]\n')
    stream = stream_requests(spark, str(tmp_path / "in"))
    score_stream(stream, stored, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.status for r in rows) == [200, 500]
    assert all(json.loads(r.body) for r in rows)


def test_record_stream_equals_batch(spark, sf_dir, stored, tmp_path):
    requests = fixtures.requests_raw(spark, sf_dir).limit(200)
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    requests.write.json(source)
    for _ in range(2):
        predict_stream(stream_requests(spark, source, "json"), stored, out, state).awaitTermination()
    key = lambda r: (r.request_id, -1 if r.position is None else r.position)
    columns = ["request_id", "position", "error", "prediction", "probability"]
    found = sorted(spark.read.parquet(out).select(columns).collect(), key=key)
    assert found == sorted(score_records(requests, stored).select(columns).collect(), key=key)
