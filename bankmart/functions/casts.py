"""Text-to-type conversion and date arithmetic, all as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from bankmart.schemas import DAY, FLAG, MONEY, RATE, TEXT, WHOLE

PLAIN_NUMBER = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c: Column | str) -> Column:
    """True for NULL and for the empty text a CSV load leaves behind."""
    return col(c).isNull() | (col(c) == "")


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def as_decimal(c: Column | str, kind: str = RATE, strict: bool = False) -> Column:
    """Decimal or NULL. ``strict`` also rejects exponent notation such as ``1e3``."""
    value = col(c).try_cast(kind)
    if strict:
        return F.when(col(c).rlike(PLAIN_NUMBER), value)
    return value


def as_money(c: Column | str) -> Column:
    return as_decimal(c, MONEY)


def as_rate(c: Column | str) -> Column:
    return as_decimal(c, RATE)


def as_whole(c: Column | str) -> Column:
    """Integer or NULL. ``12.00`` is 12; ``12.5`` is not an integer and gives NULL.

    Plain digits take the integer parser; only what it rejects is tried as a decimal.
    """
    value = col(c).try_cast("decimal(20,4)")
    from_decimal = F.when(value == F.floor(value), value.try_cast("int"))
    return F.coalesce(col(c).try_cast("int"), from_decimal)


def as_day(c: Column | str) -> Column:
    return col(c).try_cast("date")


def as_boolean(c: Column | str) -> Column:
    """Bit flag: zero is false, any other number is true, anything else NULL."""
    return col(c).try_cast("decimal(18,2)") != 0


def as_double(c: Column | str) -> Column:
    return col(c).cast("double")


def as_type(c: Column | str, kind: str) -> Column:
    """Convert text to one of the types named in ``bankmart.schemas``."""
    if kind == TEXT:
        return col(c)
    if kind == WHOLE:
        return as_whole(c)
    if kind == DAY:
        return as_day(c)
    if kind == FLAG:
        return as_boolean(c)
    return as_decimal(c, kind)


def month_index(c: Column | str) -> Column:
    """Months since year zero; differences count calendar-month boundaries."""
    return F.year(col(c)) * 12 + F.month(col(c))


def month_gap(start: Column | str, end: Column | str) -> Column:
    return month_index(end) - month_index(start)


def ratio(top: Column | str, bottom: Column | str, alternative=None) -> Column:
    """Division that is NULL (or the alternative) when the divisor is zero or missing."""
    value = F.try_divide(as_double(top), as_double(bottom))
    return value if alternative is None else F.coalesce(value, F.lit(alternative))
