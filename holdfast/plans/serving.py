"""Request text in, response text out."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import values
from holdfast.operators.boosting import ENCODED, predict_values
from holdfast.operators.envelope import (
    align_requests,
    build_responses,
    parse_requests,
    settle_missing,
    wanted_keys,
)
from holdfast.operators.trees import TreeModel
from holdfast.sources.models import StoredModel

RECORD = ["request_id", "position", "error"]


def score_records(
    requests: DataFrame, stored: StoredModel, mode: str = ENCODED, fill: float | None = values.STAND_IN
) -> DataFrame:
    """(request_id, position, error, prediction, probability): one row per record, no shuffle.

    Rows with an error pass through the model as zeros, so the requests are read once, and
    lose their result right after it.
    """
    parsed = parse_requests(requests, *wanted_keys(stored.features, mode))
    aligned = align_requests(parsed, stored.features, mode)
    if isinstance(stored.model, TreeModel):
        fill = math.nan  # which its trees take as missing
    settled = settle_missing(aligned, stored.features, fill)
    scored = predict_values(settled, stored.model, RECORD, fill=0.0)
    return scored.selectExpr(
        *RECORD,
        "if(error is null, prediction, null) as prediction",
        "if(error is null, probability, null) as probability",
    )


def score_requests(
    requests: DataFrame, stored: StoredModel, mode: str = ENCODED, fill: float | None = values.STAND_IN
) -> DataFrame:
    """(request_id, status, body, error): one response per request.

    Each request is followed by a key of its own, so requests that share an id get an answer each,
    and an id that many share is no hot group.
    """
    own = F.struct("request_id", F.monotonically_increasing_id().alias("row"))
    responses = build_responses(score_records(requests.withColumn("request_id", own), stored, mode, fill))
    return responses.withColumn("request_id", F.col("request_id.request_id"))
