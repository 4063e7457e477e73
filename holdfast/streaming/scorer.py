"""The always-on scoring route as a stream of request files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from holdfast import values
from holdfast.operators.boosting import ENCODED
from holdfast.plans.serving import score_records, score_requests
from holdfast.sources.models import StoredModel
from holdfast.sources.requests import number_lines


def score_stream(
    requests: DataFrame,
    stored: StoredModel,
    out: str,
    checkpoint: str,
    mode: str = ENCODED,
    fill: float | None = values.STAND_IN,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write whole responses, batch by batch, below `out` (columns as in `score_requests`).

    Each batch replaces its own folder, so a batch that runs again after a failure adds nothing.
    Stateless: the rows of a request never leave its batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch if "request_id" in batch.columns else number_lines(batch)
        responses = score_requests(rows, stored, mode, fill)
        responses.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        requests.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def predict_stream(
    requests: DataFrame,
    stored: StoredModel,
    out: str,
    checkpoint: str,
    mode: str = ENCODED,
    fill: float | None = values.STAND_IN,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append one row per record (columns as in `score_records`): no shuffle, no grouping.
    For requests that bring their ids."""
    return (
        score_records(requests, stored, mode, fill)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .outputMode("append")
        .start()
    )
