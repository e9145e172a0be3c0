"""Prices: waterfall, discount cascade, policy, terms and units, approval."""

from __future__ import annotations

from dataclasses import dataclass
from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewright import values
from pricewright.functions.numbers import add, column, exact_mean, number, parse_number, ratio, total
from pricewright.operators.joins import lookup, with_group

# --- Fixed values: conditions that lead from one price of the waterfall to the next ---
SEGMENT_STEP = ["zd02", "zd03"]
CUSTOMER_STEP = ["zd01", "zd04", "zd05", "zeaf", "zeb1", "zeb2"]
GROSS_STEP = ["zd13", "zd14", "zd06", "zsu2"]
TAXES = ["icms", "cofins", "pis", "other_taxes", "bx95"]
EXTRA_SUMS = ["ipi", "bx41", "rbv", "rlv"]


COSTS = ["gross_profit", "freight", "op_cost"]


def own_costs(lines: DataFrame) -> list[str]:
    """The cost columns, where the lines carry them themselves."""
    return COSTS if set(COSTS) <= set(lines.columns) else []


def with_costs(items: DataFrame, margin: DataFrame | None, keys: list[str], own: list[str]) -> DataFrame:
    """Costs of the items: their own summed over ``keys``, or those of the profit fact; 0 where there are none."""
    if own:
        # A group is the few items that share an order item.
        found = {c: total(c, over=Window.partitionBy(*keys)) for c in own}
    elif margin is None:
        found = {c: F.lit(None).cast("double") for c in COSTS}
    else:
        items = lookup(items, margin, keys, COSTS)
        found = {c: number(c) for c in COSTS}
    return items.withColumns({c: F.coalesce(value, F.lit(0.0)) for c, value in found.items()})


def price_waterfall(
    lines: DataFrame, keys: list[str], margin: DataFrame | None = None, margin_keys: list[str] | None = None
) -> DataFrame:
    """List price down to profit per order item, in money per ton.

    Conditions, taxes and quantity are summed per key and the list price averaged; the
    profit fact (``gross_profit``, ``freight``, ``op_cost``) is joined on ``margin_keys``
    with 0 where it has no row. Lines that carry these three columns themselves need no fact: they are
    summed with the conditions, then over ``margin_keys``, in the same scan. Every step is then divided by
    the quantity.
    """
    present = [c for c in [*EXTRA_SUMS] if c in lines.columns]
    sums = [*SEGMENT_STEP, *CUSTOMER_STEP, *GROSS_STEP, *TAXES, *present, "quantity_ton"]
    items = lines.groupBy(*keys).agg(
        exact_mean("list_price").alias("list_price"),
        *[total(c).alias(c) for c in [*sums, *own_costs(lines)]],
    )
    items = with_costs(items, margin, margin_keys or keys, own_costs(lines))
    steps = (
        items.withColumn("calculated_taxes", add(*TAXES))
        .withColumn("segment_price", add("list_price", *SEGMENT_STEP))
        .withColumn("full_customer_price", add("segment_price", *CUSTOMER_STEP))
        .withColumn("rbv_waterfall", add("full_customer_price", *GROSS_STEP))
        .withColumn("rlv_waterfall", F.col("rbv_waterfall") - F.abs("calculated_taxes"))
        .withColumn(
            "gross_profit_waterfall",
            F.col("rlv_waterfall") - F.abs("op_cost") - F.abs("freight"),
        )
    )
    signed = ["gross_profit_waterfall", "gross_profit", "calculated_taxes", "other_taxes"]
    absolute = [
        "list_price", *SEGMENT_STEP, *CUSTOMER_STEP, *GROSS_STEP, "icms", "cofins", "pis", "bx95",
        *present, "segment_price", "full_customer_price", "rbv_waterfall", "rlv_waterfall",
        "freight", "op_cost",
    ]
    per_ton = {c: ratio(c, "quantity_ton") for c in signed}
    per_ton.update({c: F.abs(ratio(c, "quantity_ton")) for c in absolute})
    return steps.select(
        *keys,
        F.abs("quantity_ton").alias("quantity_ton"),
        F.col("gross_profit").alias("gross_profit_original"),
        *[c.alias(n) for n, c in per_ton.items()],
    )


@dataclass(frozen=True)
class Step:
    """One discount step: a rate on the running price, or an amount in money."""

    name: str
    source: str
    absolute: bool = False


# Order of the discount steps; zd38 and zd14 are amounts.
CASCADE = [
    Step("zd01", "zd01_rate"), Step("zd02", "zd02_rate"), Step("zd03", "zd03_rate"),
    Step("zd04", "zd04_rate"), Step("zd05", "zd05_rate"), Step("zd06", "zd06_rate"),
    Step("zd38", "zd38_amount", absolute=True), Step("zd13", "zd13_rate"),
    Step("zd14", "zd14_amount", absolute=True), Step("zsu2", "zsu2_rate"), Step("zeaf", "zeaf_rate"),
]


def discount_cascade(df: DataFrame, list_price: str, steps: list[Step] | None = None) -> DataFrame:
    """Apply the steps in turn to the running price.

    Adds the money amount of each step and the price after it (``price_<step>``), plus the
    rate an absolute step amounts to (``<step>_share``).
    """
    out = df
    running = list_price
    for step in steps or CASCADE:
        amount = number(step.source) if step.absolute else number(running) * number(step.source)
        new = {step.name: amount, f"price_{step.name}": number(running) + amount}
        if step.absolute:
            new[f"{step.name}_share"] = ratio(step.source, running)
        out = out.withColumns(new)
        running = f"price_{step.name}"
    return out


def strategic_price(org: str = "org") -> Column:
    """List price with the segment conditions; BX41 belongs to the distribution organisation."""
    base = add("list_price", "zd02", "zd03", "zeb2")
    return F.when(F.col(org) == values.DISTRIBUTION_ORG, base + F.col("bx41")).otherwise(base)


def normal_price(price: str = "practiced_price", org: str = "org", absolute: bool = False) -> Column:
    """Practised price without the customer and finance conditions (open orders take amounts unsigned)."""
    finance, extra = (F.abs("zeaf"), F.abs("bx41")) if absolute else (F.col("zeaf"), F.col("bx41"))
    base = F.col(price) + F.abs("zd05") - finance
    return F.when(F.col(org) == values.DISTRIBUTION_ORG, base + extra).otherwise(base)


def price_per_kg(price: Column | str, tons: Column | str) -> Column:
    return ratio(price, number(tons) * 1000.0)


def billed_order_price() -> Column:
    """Gross value without manual conditions; finance terms only count without zd13 / zd14."""
    core = F.col("rbv") - F.abs("zsu2") + F.abs("zd13") + F.abs("zd06") + F.abs("zd14")
    return F.when((F.col("zd13") < 0) | (F.col("zd14") < 0), core).otherwise(
        core - F.abs("zeaf") - F.abs("zeb1")
    )


def open_order_price() -> Column:
    core = F.col("rbv") - F.abs("zsu2") + F.abs("zd13") + F.abs("zd06") + F.abs("zd14")
    return core + F.abs("zd38")


def policy_price(limit: Column | str, org: str = "org") -> Column:
    """List price less the policy discounts and the limit."""
    base = F.col("list_price") - F.abs("zd01") - F.abs("zd02") - F.abs("zd03")
    base = F.when(F.col(org) == values.DISTRIBUTION_ORG, base + F.abs("bx41")).otherwise(base)
    return base - F.abs(column(limit))


def with_limit(
    df: DataFrame, limits: DataFrame, on: dict[str, str] | list[str], limit: str, default: float, name: str
) -> DataFrame:
    """Policy limit of each row, the default where none is set."""
    found = lookup(df, limits.withColumnRenamed(limit, name), on, [name])
    return found.withColumn(name, F.coalesce(number(name), F.lit(default)))


def policy_deviation(
    rates: list[str], limit: Column | str, value: Column | str, threshold: float = 4.0
) -> dict[str, Column]:
    """Deviation beyond the limit once the summed rates pass the threshold, and its money value."""
    total = F.abs(add(*rates))
    deviation = F.when(total > threshold, total - column(limit)).otherwise(F.lit(0.0))
    return {"policy_deviation": deviation, "policy_deviation_value": column(value) * deviation}


def limit_deviation(total: Column | str, limit: Column | str, order_price: Column | str) -> Column:
    """Money value of the part of a discount beyond the limit."""
    over = column(total) - column(limit)
    return F.when(over > 0, column(order_price) * over).otherwise(F.lit(0.0))


def price_at_terms(price: Column | str, pct: Column | str) -> Column:
    """Price brought to the reference payment term; the rate may be text with a decimal comma."""
    return F.round(ratio(price, F.lit(1.0) + parse_number(column(pct).cast("string"))), 3)


def unit_price(
    price: Column | str, unit: Column | str, labels: list[tuple[str, str]] | None = None
) -> Column:
    """Price per kg: the first unit label contained in the text names the factor to divide by."""
    chain = F
    for label, factor in labels or values.SURVEY_UNITS:
        chain = chain.when(column(unit).contains(label), ratio(price, factor))
    return chain.otherwise(number(price))


def approve_band(
    df: DataFrame,
    keys: list[str],
    price: str,
    lo: float = 2.0,
    hi: float = 10.0,
    tol: float = 0.1,
    null_approved: bool = False,
) -> DataFrame:
    """Approve prices near the mean of their sample.

    A price within [lo, hi] is pre-approved; the mean of the pre-approved prices of the
    sample, rounded to 3, sets a band of +-tol; a price is approved when it is pre-approved and
    strictly inside. ``null_approved`` lets a missing price through.
    """
    value = F.col(price)
    sane = F.coalesce(value.between(lo, hi), F.lit(null_approved))
    flagged = df.withColumn("pre_approved", sane)
    kept = F.when(value.between(lo, hi), value)
    with_mean = with_group(flagged, keys, sample_mean=F.round(exact_mean(kept), 3))
    half = F.round(F.col("sample_mean") * F.lit(tol), 3)
    banded = with_mean.withColumns(
        {"band_low": F.col("sample_mean") - half, "band_high": F.col("sample_mean") + half}
    )
    inside = (value > F.col("band_low")) & (value < F.col("band_high"))
    return banded.withColumn(
        "approved", F.col("pre_approved") & F.coalesce(inside, F.lit(null_approved))
    )


def requested_quantity(quantity: Column | str, numerator: Column | str, denominator: Column | str) -> Column:
    return ratio(number(quantity) * number(numerator), denominator)


def wallet_backlog(
    requested: Column | str, delivered: Column | str, converted: Column | str, revenue: Column | str
) -> dict[str, Column]:
    """Open quantity of an order item and the revenue it stands for."""
    open_qty = F.abs(number(requested)) - F.abs(
        ratio(number(delivered) * number(requested), converted)
    )
    return {"open_quantity": open_qty, "open_revenue": ratio(revenue, requested) * open_qty}
