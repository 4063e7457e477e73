"""JSON scoring requests to feature rows, and scored rows back to JSON responses.

Requests are (request_id, content_type, value) with unique ids. A request that cannot be
scored carries its reason in `error` from the step that finds it up to the response.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import values
from holdfast.functions.numbers import leading_float, leading_int, quoted
from holdfast.operators.boosting import ENCODED, REFERENCE_PARITY
from holdfast.operators.encoding import Feature, filled

_END = "_end"

MALFORMED = "malformed JSON"
BODY_NOT_TEXT = "the body is not a JSON text"
NO_RECORDS = "the request has no records"
NOT_AN_OBJECT = "a record is not an object"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often `use` mentions it. Without this,
    filters that Catalyst pushes down would repeat the JSON parsing for each mention."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _is_list(text: Column) -> Column:
    return text.rlike(r"^\s*\[")


def _marker(text: Column) -> Column:
    return F.hex(F.xxhash64(text))


def _parse(text: Column, names: Sequence[str] | None, texts: Sequence[str] = ()) -> Column:
    """A JSON list of objects, or one object as a list of one, framed as [[objects], [marker]].

    The keys `names` become variants, which tell absent, null, number and text apart; the keys
    `texts` become strings, for which absent and null are one. Other keys are skipped.
    Without `names` an object is a map of all its keys to variants.
    Spark's parser stops at the end of the first value; the marker, which holds the text's own
    hash, only comes out again when nothing in the text closed the frame early.
    """
    end = F.concat(F.lit(f',[{{"{_END}":"'), _marker(text), F.lit('"}]]'))
    objects = F.when(_is_list(text), text).otherwise(F.concat(F.lit("["), text, F.lit("]")))
    if names is None:
        record = T.MapType(T.StringType(), T.VariantType())
    else:
        fields = [T.StructField(n, T.VariantType()) for n in names]
        record = T.StructType(fields + [T.StructField(n, T.StringType()) for n in [*texts, _END]])
    frame = T.ArrayType(T.ArrayType(record))
    return F.from_json(F.concat(F.lit("["), objects, end), frame, {"allowSingleQuotes": "false"})


def _objects(text: Column, names: Sequence[str] | None, texts: Sequence[str] = ()) -> Column:
    """The objects of a text as structs, or maps; null when it is malformed."""

    def checked(parsed: Column) -> Column:
        last = F.get(F.get(parsed, F.lit(1)), F.lit(0))
        return F.when((F.size(parsed) == 2) & (last[_END].cast("string") == _marker(text)), F.get(parsed, F.lit(0)))

    return _let(_parse(text, names, texts), checked)


def _payload(value: Column) -> Column:
    def unwrapped(objects: Column) -> Column:
        body = F.get(objects, F.lit(0))["body"]
        wrapped = (F.size(objects) == 1) & body.isNotNull()
        text = F.when(F.schema_of_variant(body) == "STRING", body.cast("string"))
        return F.when(wrapped, text).otherwise(value)

    # The key may be written with escapes.
    may_wrap = (value.contains("body") | value.contains("\\u")) & ~_is_list(value)
    return F.when(may_wrap, _let(_objects(value, ["body"]), unwrapped)).otherwise(value)


def unwrap_body(requests: DataFrame) -> DataFrame:
    """`payload`: the text under the top-level key "body" if there is one, else the whole text.

    A body that is not a text (null, object, number) leaves the payload null.
    """
    return requests.withColumn("payload", _payload(F.col("value")))


def parse_requests(requests: DataFrame, names: Sequence[str] | None, texts: Sequence[str] = ()) -> DataFrame:
    """(request_id, records, error): records are structs of the wanted keys, `names` as variants
    and `texts` as strings, null where a key is absent; or, with `names` None, maps of all keys
    to variants. There are none after an error."""
    kind = F.col("content_type")
    foreign = F.concat(F.lit("Unsupported content type: "), F.coalesce(kind, F.lit("None")))

    def result(payload: Column) -> Column:
        def judged(found: Column) -> Column:
            error = (
                F.when(F.col("value").isNotNull() & payload.isNull(), BODY_NOT_TEXT)
                .when(found.isNull() | (~_is_list(payload) & (F.size(found) != 1)), MALFORMED)
                .when(F.size(found) == 0, NO_RECORDS)
                .when(F.exists(found, lambda record: record.isNull()), NOT_AN_OBJECT)
            )
            return F.struct(F.when(error.isNull(), found).alias("records"), error.alias("error"))

        return _let(_objects(payload, names, texts), judged)

    found = F.when(kind.eqNullSafe(values.JSON_TYPE), _let(_payload(F.col("value")), result))
    judged = requests.select("request_id", "content_type", found.alias("_found"))
    error = F.when(F.col("_found").isNull(), foreign).otherwise(F.col("_found.error"))
    return judged.select("request_id", F.col("_found.records").alias("records"), error.alias("error"))


def request_records(parsed: DataFrame) -> DataFrame:
    """(request_id, position, record): one row per record of the requests without error."""
    rows = parsed.select("request_id", F.posexplode_outer("records").alias("position", "record"))
    return rows.where("position is not null")


def _text_sql(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _field_sql(name: str) -> str:
    """A key of the record in hand."""
    return "record.`" + name.replace("`", "``") + "`"


def _number_sql(field: str) -> str:
    """A JSON value as a number: booleans are 1 and 0."""
    return f"try_variant_get({field}, '$', 'double')"


def _known_text_sql(text: str) -> str:
    """A category as the fit sees it: trimmed, missing-value texts as null."""
    missing = ", ".join(_text_sql(t) for t in values.MISSING_TEXTS)
    return f"(CASE WHEN trim({text}) NOT IN ({missing}) THEN trim({text}) END)"


def _first_name_sql(names: Sequence[str], conditions: str) -> str:
    """The name that belongs to the first true condition of an array, or null."""
    if not names:
        return "CAST(NULL AS STRING)"
    array = ", ".join(_text_sql(n) for n in names)
    return f"try_element_at(array({array}), nullif(CAST(array_position({conditions}, true) AS INT), 0))"


def wanted_keys(features: Sequence[Feature], mode: str = ENCODED) -> tuple[list[str], list[str]]:
    """The keys that the features are made from: those read as values, those read as texts."""
    if mode not in (ENCODED, REFERENCE_PARITY):
        raise ValueError(f"unknown scoring mode {mode!r}")
    sources = [f.source for f in features if f.level is not None and mode == ENCODED]
    return [f.name for f in features], list(dict.fromkeys(sources))


def align_requests(parsed: DataFrame, features: Sequence[Feature], mode: str = ENCODED) -> DataFrame:
    """(request_id, position, error, values): one row per record, one per request with an error.

    `values` are the features in order. A key that no record of the request has is 0; one that
    only some records lack, or that is null, is missing (null). The modes are those of
    `scoring_features`; parse with the `wanted_keys` of the mode.
    """
    names, sources = wanted_keys(features, mode)

    def number(i: int) -> str:
        field = _field_sql(names[i])
        return (
            f"CASE WHEN {field} IS NOT NULL THEN nanvl({_number_sql(field)}, CAST(NULL AS DOUBLE)) "
            f"WHEN get(_given, {i}) THEN NULL ELSE 0.0D END"
        )

    def value(i: int, f: Feature) -> str:
        if f.missing:
            return f"CASE WHEN {number(names.index(f.source))} IS NULL THEN 1.0D ELSE 0.0D END"
        if f.source not in sources:
            return number(i)
        text = _known_text_sql(_field_sql(f.source))
        hit = f"CASE WHEN {text} = {_text_sql(f.level)} THEN 1.0D ELSE 0.0D END"
        return f"CASE WHEN {text} IS NOT NULL THEN {hit} ELSE {number(i)} END"

    def is_odd(name: str) -> str:
        field = _field_sql(name)
        return (
            f"coalesce({field} IS NOT NULL AND NOT is_variant_null({field}) AND (schema_of_variant({field}) = 'STRING' "
            f"OR {_number_sql(field)} IS NULL OR abs({_number_sql(field)}) = double('Infinity')), false)"
        )

    # A single record has what its request has, so only lists need the comparison.
    in_any_record = ", ".join(f"exists(records, record -> {_field_sql(n)} IS NOT NULL)" for n in names)
    given = f"CASE WHEN size(records) > 1 THEN array({in_any_record}) END"

    numbers = [f.name for f in features if f.source not in sources and not f.missing]
    odd = _first_name_sql(numbers, f"array({', '.join(is_odd(n) for n in numbers)})")
    aligned = (
        "transform(records, (record, position) -> named_struct('position', position, "
        f"'record_error', concat('not a number: ', {odd}), "
        f"'values', array({', '.join(value(i, f) for i, f in enumerate(features))})))"
    )
    # The rows are complete before they are unnested, so no later filter repeats this work.
    staged = parsed.selectExpr("request_id", "error", "records", f"{given} AS _given")
    rows = staged.select("request_id", "error", F.inline_outer(F.expr(aligned)))
    return rows.select("request_id", "position", F.coalesce("error", "record_error").alias("error"), "values")


def settle_missing(
    aligned: DataFrame, features: Sequence[Feature], fill: float | None = values.STAND_IN
) -> DataFrame:
    """No nulls among the values: missing ones become `fill`, or with None an error.
    Rows with an error get zeros; their scores are never shown."""
    error = F.col("error")
    if fill is None:
        missing = _first_name_sql([f.name for f in features], "transform(values, v -> v IS NULL)")
        error = F.expr(f"coalesce(error, concat('missing value: ', {missing}))")
    zeros = F.array_repeat(F.lit(0.0), len(features))
    settled = F.when(F.col("values").isNull(), zeros).otherwise(filled(F.col("values"), fill or 0.0))
    return aligned.select("request_id", "position", error.alias("error"), settled.alias("values"))


def spread_values(rows: DataFrame, features: Sequence[Feature]) -> DataFrame:
    """The values as named feature columns."""
    named = [F.get("values", F.lit(i)).alias(f.name) for i, f in enumerate(features)]
    return rows.select("request_id", "position", "error", *named)


def _error_body(error: Column) -> Column:
    return F.to_json(F.struct(error.alias("error")))


def request_errors(settled: DataFrame) -> DataFrame:
    """(request_id, status 500, body, error) of the requests that cannot be scored.
    Only rows with an error are shuffled."""
    order = F.coalesce("position", F.lit(-1))
    errors = (
        settled.where("error is not null").groupBy("request_id").agg(F.min_by("error", order).alias("error"))
    )
    return errors.select(
        "request_id", F.lit(500).alias("status"), _error_body(F.col("error")).alias("body"), "error"
    )


def build_responses(scored: DataFrame) -> DataFrame:
    """(request_id, status, body, error): one response per request, results in input order.

    The rows of a request come from one text and meet in one map task, so each request sends a
    single row through the shuffle. Any error makes the whole response an error.
    """
    if "error" not in scored.columns:
        scored = scored.withColumn("error", F.lit(None).cast("string"))
    order = F.coalesce("position", F.lit(-1))
    result = F.struct(order.alias("position"), "prediction", "probability", "error")
    collected = scored.groupBy("request_id").agg(F.array_sort(F.collect_list(result)).alias("results"))
    errors = F.filter(F.col("results.error"), lambda e: e.isNotNull())
    error = F.get(errors, F.lit(0))
    success = F.to_json(
        F.struct(F.col("results.prediction").alias("predictions"), F.col("results.probability").alias("probabilities"))
    )
    return collected.select(
        "request_id",
        F.when(error.isNull(), 200).otherwise(500).alias("status"),
        F.when(error.isNull(), success).otherwise(_error_body(error)).alias("body"),
        error.alias("error"),
    )


def type_fields(form: DataFrame) -> DataFrame:
    """Form texts to values: whole numbers, decimal numbers, all else as it is."""
    kinds = {name: leading_int for name in values.INT_FIELDS} | {name: leading_float for name in values.FLOAT_FIELDS}

    def typed(name: str) -> Column:
        return kinds[name](quoted(name)).alias(name) if name in kinds else quoted(name)

    return form.select(*[typed(name) for name in form.columns])
