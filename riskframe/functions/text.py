"""Column expressions for text that carries numbers, terms and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal number; keeps out literals such as nan, inf or 1.5d that a cast would accept.
NUMBER = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"


def to_number(text: Column) -> Column:
    """Text as a double, null when it is not a plain number."""
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def first_digits(text: Column) -> Column:
    """The first run of digits; empty text when there is none."""
    return F.regexp_extract(text, r"(\d+)", 1)


def employment_years(text: Column) -> Column:
    """Years from texts such as ``10+ years``, ``< 1 year`` or ``n/a`` (both 0); plain numbers pass."""
    lower = F.lower(text)
    return (
        F.when(lower.contains("< 1 year") | lower.contains("n/a"), F.lit(0.0))
        .when(lower.contains("year"), first_digits(text).try_cast("double"))
        .otherwise(to_number(text))
    )


def number_from_text(text: Column) -> Column:
    """Rates, amounts and employment lengths given as text."""
    return employment_years(F.replace(text, F.lit("%"), F.lit("")))


def issue_month(text: Column) -> Column:
    """``Dec-2015`` → 2015-12-01, null when the text has another form."""
    return F.try_to_timestamp(text, F.lit("MMM-yyyy"))


def null_tokens(text: Column, tokens: list[str]) -> Column:
    return F.when(~text.isin(tokens), text)
