"""Number parsing, rounding and scores as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accordant import policy
from accordant.functions.text import choose, strip


#: Decimal text with an optional exponent; type suffixes of programming languages are not numbers.
NUMBER = r"(?i)^[+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?$|^[+-]?inf(inity)?$"


def as_double(text: Column) -> Column:
    """Double of a decimal text; anything else is null."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def nan_to_null(df: DataFrame) -> DataFrame:
    """``df`` in which NaN counts as missing, like null."""
    floating = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.nanvl(c, F.lit(None).cast("double")) for c in floating}) if floating else df


def parse_number(c: Column) -> Column:
    """Text or number to double: thousands commas dropped, anything unreadable or NaN is null."""
    return as_double(F.replace(strip(c), F.lit(","), F.lit("")))


def to_number(c: Column) -> Column:
    """Lenient conversion without comma handling; unreadable or NaN is null."""
    return as_double(strip(c))


def abs_difference(a: Column, b: Column) -> Column:
    """|a - b|, and 0 when either side is missing or unreadable."""
    return F.coalesce(F.abs(to_number(a) - to_number(b)), F.lit(0.0))


def round_dp(c: Column, digits: int) -> Column:
    """Round half up on the decimal value, so that equal inputs round equally in every engine."""
    return F.round(c.cast("decimal(28,10)"), digits).cast("double")


def fixed_text(c: Column, digits: int) -> Column:
    """Fixed number of decimals as text."""
    return F.round(c.cast("decimal(28,10)"), digits).cast(f"decimal(28,{digits})").cast("string")


def ratio(part: Column, whole: Column, digits: int | None = None) -> Column:
    """part / whole, null when whole is 0."""
    value = F.try_divide(part.cast("double"), F.nullif(whole.cast("double"), F.lit(0.0)))
    return value if digits is None else round_dp(value, digits)


def uncertainty(probability: Column) -> Column:
    return round_dp(F.lit(0.5) - F.abs(probability - 0.5), 4)


def route(probability: Column, auto: float = policy.AUTO_MATCH,
          low: float = policy.MANUAL_REVIEW_LOW) -> Column:
    return (F.when(probability >= auto, "AUTO_MATCH")
            .when(probability < low, "NON_MATCH").otherwise("MANUAL_REVIEW"))


def priority_score(severity: Column, uncertain: Column, age_days: Column,
                   weights: dict = policy.PRIORITY_WEIGHTS) -> Column:
    bounded = F.least(F.greatest(F.coalesce(uncertain, F.lit(0.0)), F.lit(0.0)), F.lit(1.0))
    age = F.greatest(F.coalesce(age_days, F.lit(0.0)), F.lit(0.0))
    severity_points = choose(severity, policy.SEVERITY_SCORE, 0)
    return round_dp(weights["severity"] * severity_points + weights["uncertainty"] * bounded
                    + weights["age_days"] * age, 2)
