"""Salary parsing and exact averages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rolecall.functions.text import BLANK
from rolecall.schemas import MONEY, SALARY_SIGNS

_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = (
    rf"(?i)^{BLANK}*("
    rf"[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?|inf(?:inity)?)"
    rf"){BLANK}*\z"
)


def normalize_salary(value: Column) -> Column:
    """Salary text as double; NULL when it is missing or not a number."""
    bare = F.regexp_extract(F.translate(value.cast("string"), SALARY_SIGNS, ""), _NUMBER, 1)
    # Casting an empty text would raise and catch an error for each such row.
    number = F.nullif(bare, F.lit(""))
    return F.replace(number, F.lit("_"), F.lit("")).try_cast("double")


def to_money(amount: Column) -> Column:
    """Two decimals, half away from zero; NULL when the amount does not fit the column."""
    return amount.try_cast(MONEY)


def avg_money(amount: Column) -> Column:
    """Average with 16 decimals, to be rounded once.

    `avg` of a decimal(10,2) keeps six decimals, and rounding those again can be off by a
    cent. The wide input type also leaves 26 digits for the sum, so it cannot overflow.
    """
    return F.avg(amount.cast("decimal(28,12)"))


def percentage(part: Column, whole: Column, scale: int) -> Column:
    """`part` in percent of `whole`, half-up; NULL when `whole` is zero."""
    total = F.nullif(whole, F.lit(0)).cast("decimal(20,0)")
    return F.round((part * 100).cast("decimal(22,0)") / total, scale)
