"""Time, number and label expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hours_between(start: Column, end: Column) -> Column:
    """Elapsed hours with microsecond resolution, for timestamps with or without a zone."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(3.6e9)


def clipped_or_zero(value: Column) -> Column:
    """Negative values and nulls become 0."""
    return F.greatest(value, F.lit(0.0))


def nan_to_null(value: Column) -> Column:
    """Spark orders NaN above every number, so a missing value must be null before any comparison."""
    return F.nanvl(value, F.lit(None).cast("double"))


def integral_id(value: Column) -> Column:
    """Read an id that may be written as ``1.0``; anything else than a whole number is null.

    Plain integers keep all 64 bits: only the decimal form goes through a double.
    """
    text = F.trim(value.cast("string"))
    return F.coalesce(
        F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint")),
        F.when(text.rlike(r"^[+-]?\d+\.0*$"), F.regexp_replace(text, r"\..*$", "").try_cast("bigint")),
    )


def parse_timestamp(text: Column, on_error: str = "raise") -> Column:
    """``on_error`` is ``raise`` (the job fails on bad text) or ``null``."""
    if on_error not in ("raise", "null"):
        raise ValueError("on_error must be 'raise' or 'null'")
    parsed = text.try_cast("timestamp")
    if on_error == "null":
        return parsed
    complaint = F.raise_error(F.concat(F.lit("not a timestamp: "), text))
    return F.when(text.isNotNull() & parsed.isNull(), complaint).otherwise(parsed)


def fixed1(value: Column) -> Column:
    """One decimal place, rounded from the exact binary value with ties to even.

    ``format_string`` rounds the shortest decimal form half up and so turns 12.25
    into 12.3. Here ``10 * value`` is split into its rounded product and the exact
    rounding error (8x and 2x are exact), which settles which side of a tie it is on.
    """
    high, low = value * 8.0, value * 2.0
    product = high + low
    carried = product - high
    error = (high - (product - carried)) + (low - carried)
    floor = F.floor(product)
    on_tie = (product - floor) == 0.5
    tenths = (
        F.when(on_tie & (error > 0), floor + 1)
        .when(on_tie & (error < 0), floor)
        .otherwise(F.rint(product))
        .cast("bigint")
    )
    size = F.abs(tenths)
    sign = F.when((tenths < 0) | ((tenths == 0) & (value < 0)), F.lit("-")).otherwise(F.lit(""))
    return F.concat(sign, F.floor(size / 10).cast("string"), F.lit("."), (size % 10).cast("string"))


def percent1(value: Column) -> Column:
    return F.concat(fixed1(value * 100.0), F.lit("%"))


# Wording of outcome and risk in rendered text.
DIED, SURVIVED = "DIED", "SURVIVED"
HIGH_RISK, LOW_RISK = "HIGH MORTALITY RISK", "LOW MORTALITY RISK"


def outcome_label(flag: Column) -> Column:
    return F.when(flag == 1, F.lit(DIED)).otherwise(F.lit(SURVIVED))


def risk_label(prob: Column) -> Column:
    """Risk class at 0.5 and the probability of death as a percentage."""
    name = F.when(prob >= 0.5, F.lit(HIGH_RISK)).otherwise(F.lit(LOW_RISK))
    return F.concat(name, F.lit(" (confidence: "), percent1(prob), F.lit(")"))


def softmax2(logit0: Column, logit1: Column) -> Column:
    """Probability of class 1 from two logits."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(logit0 - logit1))


def argmax2(logit0: Column, logit1: Column) -> Column:
    return (logit1 > logit0).cast("int")
