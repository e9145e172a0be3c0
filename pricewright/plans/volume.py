"""Open orders, the volume fact, the allocated forecast and the slicer catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricewright import values
from pricewright.functions.codes import customer_group, price_type, remap_codes
from pricewright.functions.dates import parse_date
from pricewright.functions.numbers import number, parse_number, ratio
from pricewright.functions.text import code_int
from pricewright.operators.catalog import filter_catalog, volume_fact
from pricewright.operators.filters import horizon, scope_filter
from pricewright.operators.forecast import allocate_forecast, splice_forecast
from pricewright.operators.joins import lookup, one_per_key, shuffled, splittable
from pricewright.operators.margin import share_of_parent
from pricewright.operators.price import (
    billed_order_price, discount_cascade, normal_price, open_order_price, policy_deviation, policy_price,
    price_per_kg, requested_quantity, wallet_backlog, with_limit,
)
from pricewright.plans.dimensions import key_columns, product_groups, with_branch
from pricewright.plans.marts import scoped_billing, with_products

DEFAULT_LIMIT = 4.0  # fixed value: policy limit in percent where none is set

# Column of the open-order extract -> column here.
WALLET_TEXT = {
    "salesorg": "SALES_ORG_COD", "custregionship": "ISSUING_STATE", "customer": "CUSTOMER_COD", "custname": "CUSTOMER_DESC",
    "corporategroupname": "CUSTOMER_GROUP", "item": "SALES_ORDER_ITEM", "salesoffice": "SALES_OFFICE_COD",
    "custcitynameship": "ISSUING_CITY", "material": "MATERIAL_COD", "materialgroup1": "GPD_COD", "salesgroup": "SALES_GROUP_COD",
    "statusoverall": "ORDER_STATUS", "order": "SALES_ORDER_NUMBER", "salesgroupdesc": "SALES_GROUP_DESC", "ordertype": "ORDER_TYPE",
}
WALLET_DATES = {"ordercreationdate": "SALES_ORDER_DATE", "confirmeddate": "CONFIRMED_ORDER_DATE"}
WALLET_NUMBERS = {
    "deliveredquantity": "delivered", "reqqttconv": "converted", "quantitywdelivery": "quantity_with_delivery",
    "zd01": "zd01_rate", "zd02": "zd02_rate", "zd03": "zd03_rate", "zd04": "zd04_rate", "zd05": "zd05_rate", "zd06": "zd06_rate",
    "zd13": "zd13_rate", "zd14": "zd14_amount", "manualextra": "zsu2_rate", "brfinanceextra": "zeaf_rate", "zp01baseprice": "zp01",
}


def _order_key(number_col: str, item_col: str) -> dict[str, Column]:
    return {"_order": code_int(number_col), "_item": code_int(item_col)}


def order_items(vbap: DataFrame) -> DataFrame:
    """Net, gross and tax value and the requested quantity of an order item, one row each, placed by the item."""
    rows = vbap.select(
        code_int("VBELN").alias("_order"), code_int("POSNR").alias("_item"),
        number("NETWR").alias("rlv"), number("ZZICMS_IPI_T").alias("rbv"), number("MWSBP").alias("total_taxes"),
        requested_quantity("KWMENG", "UMVKZ", "UMVKN").alias("requested"),
    )
    return one_per_key(rows, ["_order", "_item"], split=False)


def limits_of(policy: DataFrame) -> DataFrame:
    """Policy limit in percent per organisation, material and state; of several the lowest."""
    rows = policy.select(
        F.trim("sales_org_cod").alias("ORG_KEY"), code_int("material_cod").alias("MATERIAL_KEY"),
        F.trim("ibge_uf_acronyms").alias("STATE_KEY"), number("ALCADA").alias("limit_pct"),
    )
    return one_per_key(rows, ["ORG_KEY", "MATERIAL_KEY", "STATE_KEY"])


def _with_policy_limit(df: DataFrame, policy: DataFrame, name: str) -> DataFrame:
    keyed = df.withColumns({**key_columns("SALES_ORG_COD", "MATERIAL_COD"), "STATE_KEY": F.trim("ISSUING_STATE")})
    keys = ["ORG_KEY", "MATERIAL_KEY", "STATE_KEY"]
    return with_limit(keyed, shuffled(limits_of(policy)), keys, "limit_pct", DEFAULT_LIMIT, name).drop(*keys)


def open_orders(wallet: DataFrame, vbap: DataFrame, order_types: list[str] | None = None) -> DataFrame:
    """Open order items in scope with their values; items without values are left out."""
    rows = scope_filter(wallet, "salesorg", values.SALES_ORGS)
    if order_types:
        rows = scope_filter(rows, "ordertype", order_types)
    rows = rows.select(
        *[F.col(f"`{c}`").alias(n) for c, n in WALLET_TEXT.items()],
        *[parse_date(c, "yyyy/MM/dd").alias(n) for c, n in WALLET_DATES.items()],
        *[number(c).alias(n) for c, n in WALLET_NUMBERS.items()],
    )
    rows = rows.withColumns(
        {
            **_order_key("SALES_ORDER_NUMBER", "SALES_ORDER_ITEM"),
            "SALES_ORG_COD": remap_codes(F.trim("SALES_ORG_COD")),
            "CUSTOMER_GROUP": customer_group("CUSTOMER_GROUP", "CUSTOMER_DESC"),
        }
    )
    return rows.join(order_items(vbap), ["_order", "_item"])


def wallet_fact(
    wallet: DataFrame, vbap: DataFrame, conditions: DataFrame, policy: DataFrame, region: DataFrame, product: DataFrame
) -> DataFrame:
    """Open orders with the discount cascade, the policy price, the backlog and its branch."""
    terms = conditions.select(
        code_int("VBAK_VBELN").alias("_order"), code_int("VBAP_POSNR").alias("_item"),
        number("ICMI").alias("list_price"), number("ZD38").alias("zd38_amount"), number("ZEB1").alias("zeb1"),
        number("BX41").alias("bx41"), number("BX23").alias("ipi"),
    )
    rows = lookup(open_orders(wallet, vbap), one_per_key(terms, ["_order", "_item"], split=False), ["_order", "_item"])
    # The lookups that shuffle the rows come first: the prices made from few numbers of a row would widen each of these shuffles.
    rows = _with_policy_limit(rows, policy, "limit_pct")
    rows = with_branch(rows, region, "ISSUING_CITY", "ISSUING_STATE")
    rows = rows.withColumns(key_columns("SALES_ORG_COD", "MATERIAL_COD"))
    rows = lookup(rows, shuffled(product_groups(product)), ["ORG_KEY", "MATERIAL_KEY"], ["DESC_GPD", "DESC_GPM"])
    rows = discount_cascade(rows, "list_price").withColumn("practiced_price", F.col("rbv"))
    backlog = wallet_backlog("requested", "delivered", "converted", "rlv")
    rows = rows.withColumns(
        {
            "order_price": open_order_price(),
            "own_limit": F.col("price_zd05") * 0.02,
            "norm_practiced_price": normal_price("rbv", "SALES_ORG_COD", absolute=True),
            "zd_total_rate": F.col("zd06_rate") + F.col("zd13_rate") + F.col("zd14_share"),
            "zd_total": F.col("zd06") + F.col("zd13") + F.col("zd14"),
            "total_wallet": backlog["open_quantity"],
            "rlv": backlog["open_revenue"],
            "channel": price_type("SALES_ORG_COD"),
        }
    ).withColumn("policy_price", policy_price("own_limit", "SALES_ORG_COD"))
    rows = rows.withColumns(
        {
            "norm_practiced_price_kg": ratio("norm_practiced_price", "requested"),
            "policy_price_kg": ratio("policy_price", "requested"),
        }
    )
    found = ["verge", "BRANCH", "DESC_GPD", "DESC_GPM"]
    rows = rows.withColumn("verge", F.col("limit_pct") / 100.0).drop("ORG_KEY", "MATERIAL_KEY", "limit_pct", "own_limit", "_order", "_item")
    return rows.select(*[c for c in rows.columns if c not in found], *found)


FACT_TEXT = [
    "SALES_ORG_COD", "CUSTOMER_COD", "CUSTOMER_DESC", "CUSTOMER_GROUP", "BILLING_NUMBER", "BILLING_ITEM", "BILLING_DATE",
    "SALES_ORDER_DATE", "CONFIRMED_ORDER_DATE", "ISSUING_CITY", "ISSUING_STATE", "BRANCH", "GPD_COD", "GPD_DESC", "GPM_DESC",
    "MATERIAL_COD", "ORDER_TYPE", "SALES_OFFICE_COD", "maker", "order_status",
]
FACT_NUMBERS = [
    "quantity_ton", "practiced_price", "rbv", "rlv", "order_price", "verge", "policy_deviation", "policy_deviation_value",
    "zd06", "zd13", "zd14", "open_quantity",
]


def billed_volume(billing: DataFrame, policy: DataFrame, region: DataFrame, product: DataFrame, as_of: str) -> DataFrame:
    """Billed items of the last twelve months with order price, limit and branch."""
    rows = horizon(scoped_billing(billing), "BILLING_DATE", as_of, 12, closed=True)
    rows = with_products(rows, product)
    rows = rows.withColumns(
        {
            "order_price": billed_order_price(),
            "practiced_price": price_per_kg(normal_price(org="SALES_ORG_COD"), "quantity_ton"),
            "SALES_ORDER_DATE": parse_date(F.col("SALES_ORDER_DATE").cast("string"), "yyyyMMdd"),
        }
    )
    rows = _with_policy_limit(rows, policy, "limit_pct").withColumns(
        {
            "verge": F.when(F.col("verge") == 0, F.col("order_price") * F.col("limit_pct") / 100.0).otherwise(F.col("verge")),
            "policy_deviation_value": F.col("policy_deviation"),
            **{c: F.abs(c) for c in ["zd06", "zd13", "zd14"]},
        }
    )
    rows = with_branch(rows, region, "ISSUING_CITY", "ISSUING_STATE")
    return rows.withColumnsRenamed(
        {"CLIENT_COD": "CUSTOMER_COD", "CLIENT_DESC": "CUSTOMER_DESC", "CLIENT_GROUP_DESC": "CUSTOMER_GROUP"}
    ).distinct()


def open_volume(wallet: DataFrame, vbap: DataFrame, policy: DataFrame, region: DataFrame, product: DataFrame) -> DataFrame:
    """Open orders in the columns of the volume fact, quantities in tons."""
    rows = open_orders(wallet, vbap, values.ORDER_TYPES)
    part = F.abs(ratio("requested", "converted")) / 100.0
    rows = rows.withColumns(
        {
            "zd06": F.col("zd06_rate") * part, "zd13": F.col("zd13_rate") * part, "zd14": F.col("zd14_amount") * part,
            "zsu2": F.col("zsu2_rate") * part, "zd38": F.lit(0.0), "practiced_price": F.col("rbv"),
            "open_quantity": wallet_backlog("requested", "delivered", "converted", "rlv")["open_quantity"] / 1000.0,
            "quantity_ton": F.col("requested") / 1000.0,
            "BILLING_NUMBER": F.col("SALES_ORDER_NUMBER"), "BILLING_ITEM": F.col("SALES_ORDER_ITEM"),
            "order_status": F.col("ORDER_STATUS"),
        }
    ).withColumn("order_price", open_order_price())
    rows = _with_policy_limit(rows, policy, "verge")
    rows = rows.withColumns(policy_deviation(["zd06", "zd13", "zd14"], "verge", "rbv", DEFAULT_LIMIT))
    keyed = rows.withColumns(key_columns("SALES_ORG_COD", "MATERIAL_COD"))
    found = lookup(keyed, product_groups(product), ["ORG_KEY", "MATERIAL_KEY"]).withColumns(
        {"GPD_COD": F.coalesce("COD_GPD", "GPD_COD"), "GPD_DESC": F.col("DESC_GPD"), "GPM_DESC": F.col("DESC_GPM")}
    )
    rows = with_branch(found, region, "ISSUING_CITY", "ISSUING_STATE")
    # Beside each open order the volume of its branch and of its state, and the branch's part.
    state = ["SALES_ORG_COD", "GPD_COD", "ISSUING_STATE"]
    parts = share_of_parent(rows, [*state, "BRANCH"], state, "quantity_ton", "branch_share")
    named = parts.withColumnsRenamed({"quantity_ton_child": "branch_ton", "quantity_ton_parent": "state_ton"})
    return lookup(rows, splittable(named), [*state, "BRANCH"])


def volume_mart(billed: DataFrame, waiting: DataFrame, order_type_texts: DataFrame, makers: tuple[str, str]) -> DataFrame:
    """Billed and open volume as one fact, with group default and order-type text."""
    fact = volume_fact(billed, waiting, [*FACT_TEXT, *FACT_NUMBERS], makers, "quantity_ton")
    fact = fact.withColumns(
        {"GPM_DESC": F.coalesce("GPM_DESC", F.lit(values.UNKNOWN_GROUP)), "COUNTRY": F.lit("Brazil")}
    )
    texts = order_type_texts.where(F.col("spras") == "P").select("auart", F.col("bezei").alias("ORDER_TYPE_DESC"))
    return lookup(fact, one_per_key(texts, ["auart"]), {"ORDER_TYPE": "auart"})


ALLOCATION_PARENT = ["OV_AJUST", "ISSUING_STATE", "GPD_COD", "GPM_DESC"]


def forecast_of_month(forecast: DataFrame, year_month: str) -> DataFrame:
    """Forecast rows of one month, organisations merged, text volume parsed."""
    return forecast.where(F.col("MONTH_YEAR") == year_month).select(
        remap_codes("SALES_ORG_COD").alias("OV_AJUST"), F.upper(F.trim("STATE")).alias("ISSUING_STATE"), "GPD_COD",
        F.col("DESC_GPD").alias("GPD_DESC"), F.col("DESC_GPM").alias("GPM_DESC"), F.col("SALES_OFFICE").alias("SALES_OFFICE_COD"),
        parse_number("VOLUME").alias("PV_BUDGET"),
    )


def allocated_forecast(forecast: DataFrame, billed: DataFrame, region: DataFrame, year_month: str) -> DataFrame:
    """State forecast of a month spread over branches by the billed volume.

    Plan and sales meet by organisation, state, group code and marketing group. The text of the group is
    carried, not joined on: the plan's where it has one, else that of the sales.
    """
    sites = region.select(F.upper(F.trim("IBGE_UF_ACRONYMS")).alias("ISSUING_STATE"), "BRANCH")
    actual = billed.withColumn("OV_AJUST", F.col("SALES_ORG_COD"))
    plan = forecast_of_month(forecast, year_month)
    out = allocate_forecast(
        plan, actual, sites, ALLOCATION_PARENT, "ISSUING_STATE", "BRANCH", "PV_BUDGET", "quantity_ton", text="GPD_DESC"
    )
    return out.withColumns(
        {
            "YEAR_MONTH": F.lit(year_month), "GPM_DESC": F.coalesce("GPM_DESC", F.lit(values.UNKNOWN_GROUP)),
            "COUNTRY": F.lit("Brazil"),
        }
    )


SLICERS = ["OV_AJUST", "ISSUING_STATE", "BRANCH", "GPD_COD", "GPD_DESC", "GPM_DESC", "SALES_OFFICE_COD"]


def slicer_catalog(volume: DataFrame, forecast: DataFrame, budget: DataFrame, region: DataFrame, year_month: str) -> DataFrame:
    """Distinct slicer values of the fact, of the month's forecast per branch and of the budget."""
    sites = region.select(F.upper(F.trim("IBGE_UF_ACRONYMS")).alias("ISSUING_STATE"), "BRANCH").where(
        F.col("BRANCH").isNotNull()
    ).distinct()
    planned = forecast_of_month(forecast, year_month).drop("PV_BUDGET").distinct().join(sites, "ISSUING_STATE")
    goals = budget.select(
        F.col("SALES_ORG_COD").alias("OV_AJUST"), F.col("STATE").alias("ISSUING_STATE"), F.lit("").alias("BRANCH"), "GPD_COD",
        F.col("DESC_GPD").alias("GPD_DESC"), F.col("DESC_GPM").alias("GPM_DESC"), F.col("SALES_OFFICE").alias("SALES_OFFICE_COD"),
    )
    return filter_catalog(
        [volume.withColumn("OV_AJUST", F.col("SALES_ORG_COD")), planned, goals], SLICERS, {"COUNTRY": F.lit("Brazil")}
    )


FORECAST_COLUMNS = ["MEASURE_UNIT", "MONTH_YEAR", "STATE", "GPD_COD", "SALES_ORG_COD", "SALES_OFFICE", "VOLUME"]


def spliced_forecast(past: DataFrame, view: DataFrame, future: DataFrame, product: DataFrame, current: str) -> DataFrame:
    """Past, current and future forecast in one table with the groups of the product dimension."""
    parts = [f.select(*FORECAST_COLUMNS).withColumn("VOLUME", parse_number(F.col("VOLUME").cast("string"))) for f in (past, view, future)]
    parts[1] = parts[1].withColumn("STATE", F.coalesce("STATE", F.lit("NA")))
    return _with_group_texts(splice_forecast(*parts, "MONTH_YEAR", current), product)


def budget_table(budget: DataFrame, product: DataFrame) -> DataFrame:
    typed = budget.withColumns({c: parse_number(F.col(c).cast("string")) for c in ["VOLUME", "VALUE_BRL"]})
    return _with_group_texts(typed, product)


def _with_group_texts(df: DataFrame, product: DataFrame) -> DataFrame:
    groups = product.where(F.col("DESC_GPD").isNotNull() & F.col("COD_GPM").isNotNull()).groupBy(
        F.col("COD_GPD").alias("GPD_COD"), "SALES_ORG_COD"
    ).agg(F.min(F.struct("DESC_GPD", F.col("COD_GPM").alias("DESC_GPM"))).alias("g"))
    texts = groups.select("GPD_COD", "SALES_ORG_COD", "g.DESC_GPD", "g.DESC_GPM")
    return lookup(df, splittable(texts), ["GPD_COD", "SALES_ORG_COD"])
