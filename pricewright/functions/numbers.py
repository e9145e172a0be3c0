"""Number helpers (Column -> Column).

Money is a double. ``total`` adds it in whole millionths, cut into a high and a low part that are
both added as whole numbers and joined as a decimal at the end: sums are exact at every size, and
no total depends on the order in which tasks deliver their rows. That costs two whole-number additions per
row, where a wide decimal sum costs a big-integer operation. Ratios are null where the divisor is 0.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, WindowSpec, functions as F

MONEY_DIGITS = 6
# Low parts are below 2**24, so 2**39 rows add up; high parts of totals below 2**87 units do.
LOW_UNITS = 2**24


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str) -> Column:
    return column(c).cast("double")


def ratio(part: Column | str, whole: Column | str) -> Column:
    """part / whole as double; null when whole is 0 or either side is null."""
    return F.try_divide(number(part), number(whole))


def snap(c: Column | str, digits: int = MONEY_DIGITS) -> Column:
    """Round half up to ``digits`` decimals by plain double arithmetic (no decimal detour)."""
    scale = float(10**digits)
    return F.floor(number(c) * scale + 0.5) / scale


def limbs(c: Column | str, digits: int = MONEY_DIGITS) -> tuple[Column, Column]:
    """High and low whole-number part of a number in units of 10**-digits; both add up on their own. NaN counts as null."""
    units = F.rint(F.nanvl(number(c), F.lit(None).cast("double")) * float(10**digits))
    high = F.floor(units / float(LOW_UNITS))
    return high, (units - high * float(LOW_UNITS)).cast("bigint")


def joined(high: Column | str, low: Column | str, digits: int = MONEY_DIGITS) -> Column:
    """The number whose summed parts these are, as the double nearest to the exact sum.

    Sums below 2**62 units are joined as one whole number, only larger ones as a decimal, which costs a big-integer operation.
    """
    high, low = column(high), column(low)
    fits = (F.abs(high) < 2**37) & (low < 2**61)
    wide = high.cast("decimal(20,0)") * F.lit(Decimal(LOW_UNITS)) + low.cast("decimal(20,0)")
    return F.when(fits, (high * F.lit(LOW_UNITS).cast("bigint") + low).cast("double")).otherwise(wide.cast("double")) / float(10**digits)


def narrowed(high: Column | str, low: Column | str) -> tuple[Column, Column]:
    """Summed parts in one whole number, and beside it the high part where they do not fit one, else 0: for a shuffle, which packs the zeros well."""
    high, low = column(high), column(low)
    fits = (F.abs(high) < 2**37) & (low < 2**61)
    return F.when(fits, high * F.lit(LOW_UNITS).cast("bigint") + low).otherwise(low), F.when(fits, F.lit(0).cast("bigint")).otherwise(high)


def widened(whole: Column | str, rest: Column | str) -> tuple[Column, Column]:
    """The high and low part of what ``narrowed`` made: the same sum, its low part below LOW_UNITS."""
    whole, rest = column(whole), column(rest)
    return F.shiftright(whole, LOW_UNITS.bit_length() - 1) + rest, whole.bitwiseAND(F.lit(LOW_UNITS - 1).cast("bigint"))


def total(c: Column | str, digits: int = MONEY_DIGITS, over: WindowSpec | None = None) -> Column:
    """Exact sum of a number column in whole units of 10**-digits; NaN counts as null."""
    if isinstance(c, str) and c.isidentifier() and over is None:
        return F.expr(_total_sql(c, digits))
    high, low = [F.sum(p) if over is None else F.sum(p).over(over) for p in limbs(c, digits)]
    return joined(high, low, digits)


def _total_sql(name: str, digits: int) -> str:
    """``total`` of a named column as one expression: marts have dozens, and each Column call is a trip to the JVM."""
    units = f"rint(nanvl(CAST(`{name}` AS DOUBLE), CAST(NULL AS DOUBLE)) * {float(10**digits)}D)"
    part = f"floor({units} / {float(LOW_UNITS)}D)"
    high, low = f"sum({part})", f"sum(CAST({units} - {part} * {float(LOW_UNITS)}D AS BIGINT))"
    wide = f"CAST({high} AS DECIMAL(20,0)) * {LOW_UNITS}BD + CAST({low} AS DECIMAL(20,0))"
    fits = f"abs({high}) < {2**37}L AND {low} < {2**61}L"
    return f"CASE WHEN {fits} THEN CAST({high} * {LOW_UNITS}L + {low} AS DOUBLE) ELSE CAST({wide} AS DOUBLE) END / {float(10**digits)}D"


def whole_units(c: Column | str, digits: int = MONEY_DIGITS) -> Column:
    """A number in whole units of 10**-digits; NaN counts as null."""
    return F.rint(F.nanvl(number(c), F.lit(None).cast("double")) * float(10**digits)).cast("decimal(19,0)")


def moments(c: Column | str, digits: int = MONEY_DIGITS) -> dict[str, Column]:
    """Aggregates n, s1 and s2 of a number column: count, exact sum and exact sum of squares in whole units.

    Whole numbers merge to the same bits in any order. Squares add up to 38 digits: prices up to a million fill them after
    10**14 rows.
    """
    units = whole_units(c, digits)
    return {"n": F.count(units), "s1": F.sum(units.cast("decimal(38,0)")), "s2": F.sum((units * units).cast("decimal(38,0)"))}


def sample_deviation(n: str, s1: str, s2: str, digits: int = MONEY_DIGITS) -> Column:
    """Sample deviation from ``moments``; null for fewer than two values.

    Squares are centred on the whole number q next to the mean before anything is rounded: with s1 = q*n + r the
    squared distances to q add up to s2 - q*(s1 + r), a whole number, and their mean differs from q by r / n, at most a half.
    """
    many = f"CAST({n} AS DECIMAL(18,0))"
    q = f"CAST((2 * {s1} + IF({s1} < 0, -{many}, {many})) div (2 * {many}) AS DECIMAL(19,0))"
    r = f"CAST({s1} - {q} * {many} AS DECIMAL(38,0))"
    squares = f"CAST({s2} - CAST({q} * CAST({s1} + {r} AS DECIMAL(38,0)) AS DECIMAL(38,0)) AS DOUBLE)"
    variance = f"({squares} - CAST({r} AS DOUBLE) * CAST({r} AS DOUBLE) / {n}) / ({n} - 1)"
    return F.expr(f"CASE WHEN {n} > 1 THEN sqrt(greatest({variance}, 0.0D)) / {float(10**digits)}D END")


def exact_mean(c: Column | str, digits: int = MONEY_DIGITS) -> Column:
    """Mean over the non-null values, from the total."""
    return F.try_divide(total(c, digits), F.count(column(c)).cast("double"))


def parse_number(c: Column | str, to: str = "double") -> Column:
    """Number from source text: blanks dropped, decimal comma accepted, bad text -> null."""
    return F.translate(column(c), ", ", ".").try_cast(to)


def signed_sum(spec: str, of: Callable[[str], Column] = F.col) -> Column:
    """Sum of the columns in a "+a -b" list; null when any of them is null. ``of`` makes the number of a column."""
    terms = spec.split()
    total = None
    for term in terms:
        value = of(term[1:])
        if total is None:
            total = -value if term[0] == "-" else value
        else:
            total = total - value if term[0] == "-" else total + value
    return total


def add(*columns: Column | str) -> Column:
    total = column(columns[0])
    for c in columns[1:]:
        total = total + column(c)
    return total
