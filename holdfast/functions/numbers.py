"""Text-to-number and display expressions. Nothing here fails under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What numbers in texts may start with: white space of any kind.
BLANK = r"^[\s\u00A0\uFEFF\p{Z}]*"


def quoted(name: str) -> Column:
    """A column by its exact name: levels may put dots, spaces or brackets into it."""
    return F.col("`" + name.replace("`", "``") + "`")


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def lenient_number(text: Column) -> Column:
    """Malformed text gives null, as the non-ANSI cast does."""
    return text.try_cast("double")


def yes_flag(answer: Column) -> Column:
    """1 for exactly 'Yes', 0 for all else including null."""
    return F.when(answer == "Yes", 1).otherwise(0)


def known(number: Column) -> Column:
    """NaN becomes null."""
    return F.nanvl(number, F.lit(None).cast("double"))


def leading_int(text: Column) -> Column:
    """The whole number a text starts with, null when there is none."""
    digits = F.regexp_extract(text, BLANK + r"([+-]?\d+)", 1)
    return digits.try_cast("bigint")


def leading_float(text: Column) -> Column:
    """The decimal number a text starts with, null when there is none."""
    number = F.regexp_extract(text, BLANK + r"([+-]?(?:Infinity|(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?))", 1)
    return number.try_cast("double")


def rounded(number: Column, digits: int, ties: str = "up") -> Column:
    """`number` at `digits` decimals, decided on its exact binary value.

    `number * 10^digits` is formed together with its rounding error (the factors are split so
    that the partial products are exact), so 1.45 goes to 1.4 as its binary value is below the tie.
    Real ties go up or, with ties="even", to the even neighbour.
    """
    scale = F.lit(float(10**digits))
    spread = number * F.lit(float(2**27 + 1))
    high = spread - (spread - number)
    scaled = number * scale
    error = (high * scale - scaled) + (number - high) * scale
    below = F.floor(scaled)
    past_half = scaled - below - F.lit(0.5)
    tie_up = F.lit(True) if ties == "up" else below % 2 != 0
    up = (past_half > 0) | ((past_half == 0) & ((error > 0) | ((error == 0) & tie_up)))
    return (below + F.when(up, 1).otherwise(0)) / scale


def one_decimal_text(number: Column) -> Column:
    """A number with exactly one decimal, as text."""
    return rounded(number, 1).cast("decimal(20,1)").cast("string")
