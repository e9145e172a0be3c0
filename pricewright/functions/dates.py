"""Date helpers (Column -> Column). The reference date is always a parameter."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from pricewright.functions.numbers import column


def as_of_date(as_of: Column | date | str) -> Column:
    return as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")


def parse_date(c: Column | str, fmt: str) -> Column:
    """Date from text; '-' and '.' count as '/', a time part is ignored, bad text -> null."""
    text = F.substring(F.translate(F.trim(column(c)), "-.", "//"), 1, len(fmt))
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def parse_time(c: Column | str, fmt: str = "yyyy/MM/dd") -> Column:
    """Time from text, with or without its time of day ('-' and '.' count as '/'); bad text -> null."""
    text = F.replace(F.translate(F.trim(column(c).cast("string")), "-.", "//"), F.lit("T"), F.lit(" "))
    day = F.try_to_timestamp(F.substring(text, 1, len(fmt)), F.lit(fmt))
    timed = F.try_to_timestamp(F.substring(text, 1, len(fmt) + 9), F.lit(f"{fmt} HH:mm:ss"))
    return F.coalesce(timed, day)


def month_start(d: Column | str) -> Column:
    return F.trunc(column(d).cast("date"), "month")


def month_label(d: Column | str, fmt: str = "MM-yyyy") -> Column:
    """Zero-padded month key: MM-yyyy, yyyyMM, MM/yyyy."""
    return F.date_format(column(d), fmt)


def month_from_label(c: Column | str, fmt: str = "yyyyMM") -> Column:
    return F.try_to_timestamp(column(c), F.lit(fmt)).cast("date")


def iso_year(d: Column | str) -> Column:
    """The year the ISO week belongs to."""
    return F.extract(F.lit("YEAROFWEEK"), column(d))


def iso_week(d: Column | str) -> Column:
    return F.weekofyear(column(d))


def same_month(d: Column | str, as_of: Column | date | str) -> Column:
    return month_start(d) == F.trunc(as_of_date(as_of), "month")


def days_elapsed(d: Column | str, as_of: Column | date | str) -> Column:
    """Days gone in the row's month: up to ``as_of`` in the current month, else the whole month."""
    d = column(d).cast("date")
    return F.when(
        same_month(d, as_of), F.datediff(as_of_date(as_of), F.trunc(d, "month"))
    ).otherwise(F.dayofmonth(F.last_day(d)))


def days_remaining(d: Column | str, as_of: Column | date | str) -> Column:
    """Days left in the current month, ``as_of`` included; 0 for other months."""
    d = column(d).cast("date")
    return F.when(
        same_month(d, as_of), F.datediff(F.last_day(d), F.date_add(as_of_date(as_of), -1))
    ).otherwise(F.lit(0))


def fiscal_period(c: Column | str) -> Column:
    """Fiscal period yyyyPPP as a number, from the first seven characters."""
    return F.substring(column(c), 1, 7).try_cast("int")
