"""Price marts over the billing fact: waterfall, dispersion, policy alert, margin grains."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from pricewright import values
from pricewright.functions.codes import customer_group, region_label, remap_codes
from pricewright.functions.dates import month_label
from pricewright.functions.numbers import number
from pricewright.functions.text import code_int, display_key
from pricewright.operators.filters import horizon, scope_filter
from pricewright.operators.joins import lookup, overlay, splittable
from pricewright.operators.margin import dispersion_map, margin_rollup, trailing_means
from pricewright.operators.price import normal_price, price_waterfall, strategic_price
from pricewright.plans.dimensions import key_columns, product_groups, with_branch
from pricewright.plans.facts import margin_columns

# Column of the billing fact -> column of the marts.
BILLING_TEXT = {
    "SoldToCustomer": "CLIENT_COD", "SoldToCustomerName": "CLIENT_DESC", "CorporateGroupName": "CLIENT_GROUP_DESC",
    "BILDOCDATE": "BILLING_DATE", "BilDocNumber": "BILLING_NUMBER", "BilDocItem": "BILLING_ITEM",
    "SalesDocNumber": "SALES_DOC_COD", "SalesDocItem": "SALES_DOC_ITEM_COD", "SalesOrg": "SALES_ORG_COD",
    "SalesDocType": "ORDER_TYPE", "SalesOffice": "SALES_OFFICE_COD", "SalesOrderDate": "SALES_ORDER_DATE",
    "SoldToCity": "ISSUING_CITY", "SoldToState": "ISSUING_STATE", "GPD": "GPD_COD", "GPDName": "GPD_DESC",
    "GPM": "GPM_DESC", "Material": "MATERIAL_COD", "MaterialName": "MATERIAL_DESC",
}
BILLING_NUMBERS = {
    "MA_BillingQuantity_P": "quantity_ton", "DP_CM_PRECOPRATICADO_D": "practiced_price", "MA_CM_PRECOLISTA_D": "list_price",
    "MA_CM_RBV_D": "rbv", "MA_CM_RLV_D": "rlv", "MA_CM_PRECOBASE_ALCADA_P": "verge",
    "MA_CM_DESVIOPOLITICAALCADA_D": "policy_deviation",
    "DA_CM_CD_ZD01_D": "zd01", "DA_CM_CD_ZD02_D": "zd02", "DA_CM_CD_ZD03_D": "zd03", "DA_CM_CD_ZD04_D": "zd04",
    "DA_CM_CD_ZD05_D": "zd05", "DA_CM_CD_ZD06_D": "zd06", "DM_CM_CD_ZD13_D": "zd13", "DM_CM_CD_ZD14_D": "zd14",
    "AA_CM_CD_ZEB1_D": "zeb1", "AA_CM_CD_ZEB2_D": "zeb2", "AA_CM_CD_ZEAF_D": "zeaf", "AM_CM_CD_ZSU2_D": "zsu2",
    "MA_CM_CD_BX41_D": "bx41", "IM_CM_CD_BX95_D": "bx95", "IM_CM_CD_ICMS_D": "icms", "IM_CM_CD_PIS_D": "pis",
    "IM_CM_CD_COFINS_D": "cofins", "MA_CM_CD_IPI_D": "ipi", "IM_OUTROS_D": "other_taxes",
}


def scoped_billing(billing: DataFrame, gpm_null: bool = True) -> DataFrame:
    """Billed items in scope, renamed and typed, organisations merged, groups corrected.

    Scope is organisation, billing type, product group and marketing group. Organisations and billing types are
    codes of four letters, compared whole, so that the tests reach the files; only the columns a mart selects
    later are read.
    """
    rows = scope_filter(billing, "SalesOrg", values.SALES_ORGS, exact=True)
    rows = scope_filter(rows, "BillingType", values.BILLING_TYPES, exact=True)
    rows = scope_filter(rows, "GPDName", values.PRODUCT_GROUPS)
    rows = scope_filter(rows, "GPM", values.MARKETING_GROUPS, keep_null=gpm_null)
    present = {c.lower() for c in billing.columns}
    rows = rows.select(
        *[F.col(c).alias(n) for c, n in BILLING_TEXT.items() if c.lower() in present],
        *[number(F.col(c)).alias(n) for c, n in BILLING_NUMBERS.items() if c.lower() in present],
    ).where(F.col("quantity_ton") > 0)
    return rows.withColumns(
        {
            "SALES_ORG_COD": remap_codes(F.trim("SALES_ORG_COD")),
            "CLIENT_GROUP_DESC": customer_group("CLIENT_GROUP_DESC", "CLIENT_DESC"),
        }
    )


def with_products(df: DataFrame, product: DataFrame) -> DataFrame:
    """Demand and marketing group of the product dimension where it has the material."""
    keyed = df.withColumns(key_columns("SALES_ORG_COD", "MATERIAL_COD"))
    return overlay(
        keyed, product_groups(product), ["ORG_KEY", "MATERIAL_KEY"],
        {"GPM_DESC": "DESC_GPM", "GPD_COD": "COD_GPD", "GPD_DESC": "DESC_GPD"},
    ).drop("ORG_KEY", "MATERIAL_KEY")


ITEM = ["MONTH", "SALES_NUMBER", "SALES_ITEM"]
MART_KEYS = [
    *ITEM, "SALES_ORG_COD", "ISSUING_STATE", "CLIENT_COD", "CLIENT_DESC", "CLIENT_GROUP_DESC", "GPD_COD", "GPD_DESC",
    "MATERIAL_COD", "MATERIAL_DESC", "GPM_DESC", "BRANCH",
]


def billed_items(billing: DataFrame, region: DataFrame, product: DataFrame, as_of: str, fwd: int, gpm_null: bool) -> DataFrame:
    """Recent billed items with their order item (``ITEM``); a full repeat of a row counts once."""
    rows = horizon(scoped_billing(billing, gpm_null), "BILLING_DATE", as_of, 6, fwd=fwd).distinct()
    rows = with_branch(with_products(rows, product), region, "ISSUING_CITY", "ISSUING_STATE")
    return rows.withColumns(
        {
            "MONTH": F.trunc("BILLING_DATE", "month"),
            "SALES_NUMBER": code_int("SALES_DOC_COD"),
            "SALES_ITEM": code_int("SALES_DOC_ITEM_COD"),
        }
    )


WATERFALL_KEYS = [*MART_KEYS, "ISSUING_CITY", "BILLING_DATE"]


def waterfall_of(items: DataFrame, costs: DataFrame) -> DataFrame:
    """The waterfall of billed items beside the costs of their order item.

    Both may be stored facts bucketed by ``ITEM`` (``sources.writers.write_bucketed``): neither is shuffled then.
    """
    return price_waterfall(items, WATERFALL_KEYS, costs, ITEM).withColumns(
        {"MONTH_YEAR": month_label("MONTH"), "COUNTRY": F.lit("Brazil")}
    )


def waterfall_mart(billing: DataFrame, region: DataFrame, product: DataFrame, profit: DataFrame, as_of: str) -> DataFrame:
    """Price waterfall per order item, city and billing date: six months and the current one."""
    return waterfall_of(billed_items(billing, region, product, as_of, fwd=1, gpm_null=True), margin_columns(profit))


def dispersion_mart(billing: DataFrame, region: DataFrame, product: DataFrame, profit: DataFrame, as_of: str) -> DataFrame:
    """Price per kg and margin per order item over six full months."""
    rows = billed_items(billing, region, product, as_of, fwd=0, gpm_null=False)
    rows = rows.withColumn("practiced_price", normal_price(org="SALES_ORG_COD"))
    return dispersion_map(rows, MART_KEYS, margin_columns(profit), ITEM).withColumn("MONTH_YEAR", month_label("MONTH"))


def alert_mart(billing: DataFrame, region: DataFrame) -> DataFrame:
    """Strategic against practised price of every billed item with a known branch."""
    rows = scoped_billing(billing, gpm_null=False).withColumns(
        {"STRATEGIC_PRICE": strategic_price("SALES_ORG_COD"), "PRACTICED_PRICE_NORMAL": normal_price(org="SALES_ORG_COD")}
    )
    found = with_branch(rows, region, "ISSUING_CITY", "ISSUING_STATE", label=False).where(F.col("BRANCH").isNotNull())
    return found.withColumn("REGION", region_label("BRANCH")).distinct()


# The grains of the gross-profit marts.
MARGIN_GRAINS = {
    "order_item_month": [
        "month", "sales_order_date", "gpm", "gpd_cod", "gpd_desc", "material_desc", "material_cod", "sales_number",
        "sales_item", "sales_org_cod", "receiving_customer_cod", "branch", "issuing_state",
    ],
    "order_item": [
        "sales_order_date", "gpm", "gpd_cod", "gpd_desc", "material_desc", "material_cod", "sales_number", "sales_item",
    ],
    "sku_org_branch_client": [
        "month", "gpm", "gpd_cod", "gpd_desc", "material_desc", "material_cod", "receiving_customer_cod", "branch", "sales_org_cod",
    ],
    "sku_org": ["month", "gpm", "gpd_cod", "gpd_desc", "material_desc", "material_cod", "sales_org_cod"],
    "group_org": ["month", "gpm", "gpd_cod", "gpd_desc", "sales_org_cod"],
    "group": ["month", "gpm", "gpd_cod", "gpd_desc"],
    "month_sku_state": ["month", "gpm", "gpd_cod", "gpd_desc", "material_desc", "material_cod", "sales_org_cod", "issuing_state"],
}
MARGIN_SUMS = ["quantity_ton", "rbv", "rlv", "cogs_total", "quantity_ton_bw", "freight_full", "gross_profit_bw", "net_sales"]


def order_item_margin(view: DataFrame, profit: DataFrame) -> DataFrame:
    """Billed order items of a month beside their gross profit; items without one are left out.

    The profit is looked up before the view is summed, so that rows without one are left out early, and it is one of the keys of the sum:
    the profit of an item is counted once. A profit that is there several times is so in the result.
    """
    keys = [c for c in MARGIN_GRAINS["order_item_month"] if c != "month"]
    base = view.withColumns(
        {
            "month": F.trunc("billing_date", "month"),
            "sales_number": _code(view, "sales_number"),
            "sales_item": _code(view, "sales_item"),
            **{c: number(c) for c in ["quantity_ton", "rbv", "rlv", "practiced_price", "norm_practiced_price"]},
        }
    )
    costs = profit.select(
        F.col("MONTH").alias("month"), F.col("SALES_NUMBER").alias("sales_number"), F.col("SALES_ITEM").alias("sales_item"),
        F.col("COGS_TOTAL").alias("cogs_total"), F.col("QUANTITY_TON").alias("quantity_ton_bw"),
        F.col("FREIGHT_FULL").alias("freight_full"), F.col("GROSS_PROFIT_BW").alias("gross_profit_bw"),
        F.col("NET_SALES").alias("net_sales"),
    ).where(F.col("gross_profit_bw").isNotNull())
    figures = [c for c in costs.columns if c not in ("month", "sales_number", "sales_item")]
    costs = costs.groupBy("sales_number", "sales_item", "month", *figures).agg(F.count(F.lit(1)).alias("_copies"))
    # Order numbers first: the sort of the join then seldom looks beyond them.
    found = base.join(costs, ["sales_number", "sales_item", "month"])
    items = margin_rollup(
        found, {"item": ["month", *keys, *figures, "_copies"]}, ["quantity_ton", "rbv", "rlv"],
        {"practiced_price": ("practiced_price", "quantity_ton"), "norm_price": ("norm_practiced_price", "quantity_ton")},
    ).drop("grain")
    return items.withColumn("_copies", F.explode(F.sequence(F.lit(1).cast("bigint"), "_copies"))).drop("_copies")


def _code(df: DataFrame, name: str) -> Column:
    """A code as a number; a whole number is one already, and its rows stay placed by it."""
    whole = isinstance(df.select(name).schema[0].dataType, IntegralType)
    return F.col(name).cast("bigint") if whole else code_int(F.col(name).cast("string"))


def strategic_margin(profit: DataFrame, view: DataFrame) -> DataFrame:
    """Gross-profit fact of the organisations in scope with the group of the view where its own is missing."""
    rows = scope_filter(profit, "SALES_ORG_COD", values.SALES_ORGS, exact=True).withColumns(
        {"SALES_ORG_COD": remap_codes("SALES_ORG_COD"), "_material": code_int("MATERIAL_COD")}
    )
    groups = view.groupBy(code_int("material_cod").alias("_material"), F.col("sales_org_cod").alias("SALES_ORG_COD")).agg(
        F.min(F.struct(code_int("gpd_cod").alias("cod"), F.col("gpd_desc").alias("text"))).alias("_g")
    ).select("_material", "SALES_ORG_COD", F.col("_g.cod").alias("_gpd"), F.col("_g.text").alias("GPD_DESC"))
    found = lookup(rows, splittable(groups), ["_material", "SALES_ORG_COD"], ["_gpd", "GPD_DESC"])
    return found.withColumns(
        {
            "GPD_COD": F.coalesce(code_int("GPD_COD"), "_gpd"),
            "YEAR": F.year("SALES_ORDER_DATE"),
            "MONTH_NO": F.month("SALES_ORDER_DATE"),
            "KEY_LB": display_key("SALES_NUMBER", "SALES_ITEM"),
            "UF": F.concat(F.lit("BR/"), F.col("ISSUING_STATE")),
        }
    ).drop("_gpd", "_material")


def margin_marts(view: DataFrame, profit: DataFrame) -> DataFrame:
    """All margin grains in one frame, told apart by ``grain``."""
    return margin_rollup(
        order_item_margin(view, profit), MARGIN_GRAINS, MARGIN_SUMS,
        {
            "practiced_price_mean": ("practiced_price", "quantity_ton"),
            "norm_price_mean": ("norm_price", "quantity_ton"),
        },
        one_pass=True,
    )


def sales_force_margin(view: DataFrame, profit: DataFrame, last: list[int], year: list[int], year_divisor: int) -> DataFrame:
    """Net revenue, cost and profit per material, organisation and state with their trailing means."""
    keys = ["gpm", "gpd_cod", "gpd_desc", "material_desc", "material_cod", "sales_org_cod", "issuing_state"]
    rows = order_item_margin(view, profit).withColumn("month_no", F.month("month"))
    return trailing_means(
        rows, keys, "month_no", ["rlv", "cogs_total", "gross_profit_bw"],
        {"last_3": (last, len(last)), "year": (year, year_divisor)},
    )
