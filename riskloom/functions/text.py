"""Text standardising."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def upper_trimmed(value: Column) -> Column:
    return F.upper(F.trim(value))


def lower_trimmed(value: Column) -> Column:
    return F.lower(F.trim(value))


def digits_only(value: Column) -> Column:
    return F.regexp_replace(value, r"\D", "")


def joined(*values: Column) -> Column:
    """Words with one blank between them; nulls are left out."""
    return F.concat_ws(" ", *values)


def grouped_number(value: Column, digits: int = 0) -> Column:
    """Number with thousands separators, for display."""
    return F.format_number(value, digits)


def money_text(value: Column) -> Column:
    return F.concat(F.lit("R$ "), F.format_number(value, 2))


def year_month(year: Column, month: Column) -> Column:
    """Period label such as 2024-03; null where either part is."""
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))
