"""Salary display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlake.functions.text import clean


def thousands(amount: Column) -> Column:
    return F.format_number(amount.cast("bigint"), 0)


def span(low: Column, high: Column, prefix: Column, *, repeat_prefix: bool, suffix: Column | None = None) -> Column:
    """``P a - b`` / ``From P a`` / ``Up to P b``; NULL when both bounds are missing."""
    end = F.lit("") if suffix is None else suffix
    money = lambda n: F.concat(prefix, thousands(n))
    upper = money(high) if repeat_prefix else thousands(high)
    return (
        F.when(low.isNotNull() & high.isNotNull(), F.concat(money(low), F.lit(" - "), upper, end))
        .when(low.isNotNull(), F.concat(F.lit("From "), money(low), end))
        .when(high.isNotNull(), F.concat(F.lit("Up to "), money(high), end))
    )


def plus_span(low: Column, high: Column) -> Column:
    """``Rp a - Rp b`` / ``Rp a+`` / ``Up to Rp b`` over positive bounds."""
    rp = lambda n: F.concat(F.lit("Rp "), thousands(n))
    return (
        F.when((low > 0) & (high > 0), F.concat(rp(low), F.lit(" - "), rp(high)))
        .when(low > 0, F.concat(rp(low), F.lit("+")))
        .when(high > 0, F.concat(F.lit("Up to "), rp(high)))
    )


def currency_label(code: Column) -> Column:
    """``Rp`` for rupiah or nothing, else the upper-cased code."""
    cleaned = clean(code)
    return F.when(cleaned.isNull() | F.upper(cleaned).isin("IDR", "RP"), "Rp").otherwise(F.upper(cleaned))


def lenient_int_text(text: Column) -> Column:
    """Whole number written as text (sign, inner underscores and blanks allowed)."""
    digits = F.regexp_replace(clean(text), "_", "")
    return F.when(clean(text).rlike(r"^[+-]?\d+(?:_\d+)*$"), digits.try_cast("bigint"))
