"""Row filters."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pricewright.functions.dates import as_of_date
from pricewright.functions.numbers import column
from pricewright.functions.text import contains_any


def scope_filter(
    df: DataFrame,
    col: Column | str,
    terms: list[str],
    keep_null: bool = False,
    exact: bool = False,
) -> DataFrame:
    """Rows whose code contains any term; ``exact`` compares whole codes, which reaches the scan."""
    test = column(col).isin(terms) if exact else contains_any(col, terms)
    if keep_null:
        test = test | column(col).isNull()
    return df.where(test)


def exclude_terms(
    df: DataFrame, col: Column | str, terms: list[str], keep_null: bool = True, only_if_all: bool = False
) -> DataFrame:
    """Rows whose text contains none of the terms; with ``only_if_all`` a row goes only when it holds
    every one of them (a chain of "not this or not that")."""
    if only_if_all:
        hit = reduce(lambda a, b: a & b, [column(col).contains(t) for t in terms])
    else:
        hit = contains_any(col, terms)
    return df.where(F.coalesce(~hit, F.lit(keep_null)))


def horizon(
    df: DataFrame,
    col: Column | str,
    as_of: Column | date | str,
    back: int,
    fwd: int = 0,
    month_aligned: bool = True,
    closed: bool = False,
    month: str | None = None,
) -> DataFrame:
    """Rows of the rolling month window around ``as_of`` (see ``in_horizon``).

    ``month`` names the column of a fact laid out by month that holds the first of the month of ``col``. The window implies a
    range of it, which is stated as well: folders outside are not read.
    """
    rows = df.where(in_horizon(col, as_of, back, fwd, month_aligned, closed))
    if month is None:
        return rows
    lower, upper = window_bounds(as_of, back, fwd, month_aligned, closed)
    return rows.where((F.col(month) >= F.trunc(lower, "month")) & (F.col(month) <= F.trunc(upper, "month")))


def window_bounds(
    as_of: Column | date | str, back: int, fwd: int = 0, month_aligned: bool = True, closed: bool = False
) -> tuple[Column, Column]:
    """First day of the window and the day it ends at."""
    day = as_of_date(as_of)
    first = F.trunc(day, "month")
    lower = F.add_months(first if month_aligned else day, -back)
    return lower, F.add_months(first if month_aligned and not closed else day, fwd)


def in_horizon(
    col: Column | str,
    as_of: Column | date | str,
    back: int,
    fwd: int = 0,
    month_aligned: bool = True,
    closed: bool = False,
) -> Column:
    """Test for the rolling month window around ``as_of``.

    Month-aligned bounds start at the first of the month; ``closed`` keeps the
    upper bound itself. With ``month_aligned`` and ``closed`` the window runs
    from the first of the month ``back`` months ago up to and with ``as_of``.
    """
    lower, upper = window_bounds(as_of, back, fwd, month_aligned, closed)
    value = column(col)
    return (value >= lower) & ((value <= upper) if closed else (value < upper))


def since(df: DataFrame, col: Column | str, floor: str | int) -> DataFrame:
    """Rows on or after a fixed date or period."""
    return df.where(column(col) >= F.lit(floor))


def _complete(required: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])


def quarantine(df: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """Split into (rows with every required column, rows missing one)."""
    return df.where(_complete(required)), df.where(~_complete(required))
