"""Raw account table to clean account table: one narrow projection, no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast import values
from holdfast.functions.numbers import blank_to_null, lenient_number, quoted, yes_flag


def drop_identifier(df: DataFrame, name: str = values.ID) -> DataFrame:
    return df.drop(name)


def trim_blank(df: DataFrame, name: str = "TotalCharges") -> DataFrame:
    """Text without outer spaces; nothing left means null."""
    return df.withColumn(name, blank_to_null(quoted(name)))


def cast_lenient(df: DataFrame, name: str = "TotalCharges") -> DataFrame:
    return df.withColumn(name, lenient_number(quoted(name)))


def fill_missing(df: DataFrame, fills: dict[str, float] | None = None) -> DataFrame:
    """Null and NaN become the given number."""
    return df.na.fill(fills or {"TotalCharges": 0.0})


def encode_flags(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({name: yes_flag(quoted(name)) for name in names})


def encode_target(df: DataFrame) -> DataFrame:
    return encode_flags(df, [values.TARGET])


def encode_binary(df: DataFrame) -> DataFrame:
    """The Yes/No columns become 1/0; flags that are numbers already pass through."""
    return encode_flags(df, values.YES_NO)


def clean_accounts(raw: DataFrame, keep_id: bool = False) -> DataFrame:
    """All cleaning steps. `keep_id` leaves the identifier in, as the key of a later split;
    it never becomes a feature."""
    rows = raw if keep_id else drop_identifier(raw)
    charges = fill_missing(cast_lenient(trim_blank(rows)))
    return encode_binary(encode_target(charges))


def missing_texts_to_null(df: DataFrame, names: Sequence[str] = values.CATEGORICAL) -> DataFrame:
    """What text columns hold after a trip through CSV: trimmed, with the
    reader's missing-value texts as null."""
    trimmed = {name: F.trim(quoted(name)) for name in names}
    return df.withColumns(
        {name: F.when(~text.isin(values.MISSING_TEXTS), text) for name, text in trimmed.items()}
    )
