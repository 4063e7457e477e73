"""Values outside their allowed levels or ranges."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast import values
from holdfast.functions.numbers import known, lenient_number, quoted


def domain_violations(raw: DataFrame) -> DataFrame:
    """(column, value, count) of each raw value that the input form would not offer.

    Rows without any violation are filtered out first, so clean data adds nothing to the shuffle.
    """
    checks = []
    for name, levels in values.LEVELS.items():
        text = quoted(name).cast("string")
        checks.append((name, text, ~F.coalesce(text.isin(levels), F.lit(False))))
    for name in values.NON_NEGATIVE:
        is_text = isinstance(raw.schema[name].dataType, T.StringType)
        number = known(lenient_number(quoted(name)) if is_text else quoted(name).cast("double"))
        checks.append((name, quoted(name).cast("string"), ~F.coalesce(number >= 0, F.lit(False))))
    found = F.array(
        *[F.when(bad, F.struct(F.lit(name).alias("column"), text.alias("value"))) for name, text, bad in checks]
    )
    any_bad = reduce(or_, [bad for _, _, bad in checks])
    return (
        raw.where(any_bad)
        .select(F.inline(F.array_compact(found)))
        .groupBy("column", "value")
        .agg(F.count("*").alias("count"))
    )
