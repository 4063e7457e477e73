"""What a viewer sees for one scored account."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import values
from holdfast.functions.numbers import rounded, one_decimal_text


def churn_percent(probability: Column) -> Column:
    return probability * 100


def retention_percent(probability: Column) -> Column:
    return F.lit(100) - churn_percent(probability)


def risk_tier(retention: Column) -> Column:
    return (
        F.when(retention >= values.LOW_RISK_FROM, "low")
        .when(retention >= values.MEDIUM_RISK_FROM, "med")
        .when(retention.isNotNull(), "high")
    )


def signal_bars(retention: Column) -> Column:
    return F.floor(retention / 100 * values.BARS + F.lit(0.5)).cast("int")


def verdict(prediction: Column, probability: Column) -> Column:
    """The sentence follows the predicted class, which may disagree with the tier."""
    percent = one_decimal_text(churn_percent(probability))

    def sentence(template: str) -> Column:
        before, after = template.split("{}")
        return F.concat(F.lit(before), percent, F.lit(after))

    return F.when(prediction == 1, sentence(values.CHURN_VERDICT)).otherwise(sentence(values.STAY_VERDICT))


def readout(df: DataFrame, prediction: str = "prediction", probability: str = "probability") -> DataFrame:
    """`df` plus percentages, tier, bars and verdict."""
    p = F.col(probability)
    retention = retention_percent(p)
    return df.select(
        "*",
        rounded(churn_percent(p), 1).alias("churn_pct"),
        rounded(retention, 1).alias("retention_pct"),
        risk_tier(retention).alias("tier"),
        signal_bars(retention).alias("bars"),
        verdict(F.col(prediction), p).alias("verdict"),
    )
