"""Billing, profitability and gross-profit facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricewright import values
from pricewright.functions.dates import fiscal_period, parse_date, parse_time
from pricewright.functions.numbers import number
from pricewright.functions.text import code_int, norm_key
from pricewright.operators.filters import exclude_terms, horizon, scope_filter, window_bounds
from pricewright.operators.joins import lookup, overlay, splittable
from pricewright.operators.latest import latest_per_key, newest, union_extracts
from pricewright.operators.margin import apportion_cost, cost_rates, gross_profit, profit_columns
from pricewright.plans.dimensions import region_keys

# Fields that identify a billing item and a profitability item.
BILLING_KEY = [
    "SALESORG", "SALESDOCITEM", "SALESDOCNUMBER", "SALESDOCTYPE", "DATEYEARMONTH", "BILDOCITEM", "BILDOCNUMBER",
]
PROFIT_KEY = ["GTC100257", "GTC101667", "GTC101671", "GTC100137", "GTC100511", "GTC100255", "GTC100504", "0FISCPER"]


def _newest_master(df: DataFrame, key: str, country: str, columns: list[str]) -> DataFrame:
    """Newest domestic row per numeric code of a master table."""
    rows = df.where(F.col(country).contains("BR")).withColumn("_code", code_int(key)).where(F.col("_code").isNotNull())
    rows = latest_per_key(rows, ["_code"], [newest("DATA_LOAD_TIMESTAMP_PARQUET"), *[F.col(c) for c in columns]])
    return splittable(rows.select("_code", *columns))


def billing_fact(
    extracts: list[DataFrame], clients: DataFrame, addresses: DataFrame, region: DataFrame, as_of: str, months: int = 24
) -> DataFrame:
    """Billing items of the last months, newest load per item, with the client's current address.

    The horizon is applied before the dedup, so old rows are never shuffled.
    """
    recent = []
    for extract in extracts:
        typed = extract.withColumns(
            {
                "BILDOCDATE": parse_date("BILDOCDATE", "yyyy/MM/dd"),
                "DATA_LOAD_TIMESTAMP_RAW": parse_time("DATA_LOAD_TIMESTAMP_RAW"),
            }
        )
        recent.append(horizon(typed, "BILDOCDATE", as_of, months, month_aligned=False, closed=True))
    whole = union_extracts(recent, BILLING_KEY, [newest("DATA_LOAD_TIMESTAMP_RAW"), F.col("SOLDTOCUSTOMER")])

    known = _newest_master(clients, "KUNNR", "LAND1", ["KUNNR", "ADRNR"])
    sites = _newest_master(addresses, "ADDRNUMBER", "COUNTRY", ["CITY1", "REGION"])
    rows = whole.withColumn("_code", code_int("SOLDTOCUSTOMER"))
    rows = lookup(rows, known, ["_code"], ["KUNNR", "ADRNR"])
    rows = rows.withColumns(
        {"SOLDTOCUSTOMER": F.coalesce("KUNNR", "SOLDTOCUSTOMER"), "_code": code_int("ADRNR")}
    ).drop("KUNNR")
    rows = overlay(rows, sites, ["_code"], {"SOLDTOCITY": "CITY1", "SOLDTOSTATE": "REGION"}, null_wins=True)
    rows = rows.withColumns({"CITY_KEY": norm_key("SOLDTOCITY"), "STATE_KEY": norm_key("SOLDTOSTATE")})
    return lookup(
        rows, region_keys(region).withColumnRenamed("BRANCH", "BRANCH_REGION"), ["CITY_KEY", "STATE_KEY"], ["BRANCH_REGION"]
    ).drop("CITY_KEY", "STATE_KEY", "_code")


def profitability_fact(extracts: list[DataFrame], as_of: str, months: int = 24, stacked: bool = False) -> DataFrame:
    """Profitability items in local currency, newest extract per item; with ``stacked`` their stacks stand beside the accounts."""
    recent = []
    for extract in extracts:
        typed = extract.where(F.col("`0CURRENCY`") == "BRL").withColumns(
            {
                "DI_EXTRACT_TIME": parse_time("DI_EXTRACT_TIME"),
                "GTC100025": parse_date("GTC100025", "yyyy/MM/dd"),
            }
        )
        recent.append(horizon(typed, "GTC100025", as_of, months, month_aligned=False, closed=True))
    figures = profit_columns(of=_account) if stacked else None
    return union_extracts(recent, PROFIT_KEY, [newest("DI_EXTRACT_TIME"), F.col(values.PROFIT_QUANTITY)], figures=figures)


def _account(name: str) -> Column:
    return F.col(name).cast("string").try_cast("double")


def account_columns() -> list[str]:
    """All accounts that the stacks are made of, and the quantity."""
    names = [term[1:] for spec in values.PROFIT_STACKS.values() for term in spec.split()]
    return sorted({*names, values.PROFIT_QUANTITY})


def expedition_rates(profit: DataFrame, ledger: DataFrame, first_period: int = 2019001) -> DataFrame:
    """Shipping expense of a profit corporation per unit of volume of each material."""
    corporate = F.substring(F.trim("GTC100450"), 1, 8).try_cast("int")
    keys = {"period": fiscal_period("`0FISCPER`"), "corporate": corporate}
    numeric = F.col("corporate").isNotNull() & F.substring(F.trim("GTC100450"), 5, 10).try_cast("int").isNotNull()
    valid = numeric & (F.col("period") >= first_period) & (F.trim("GTC100202") == "10")

    # Country marks that rule a profit centre out.
    foreign = ["BR", "GP", "US", "SS", "MX", "EX", "CA"]
    volume = scope_filter(
        exclude_terms(profit, "GTC100450", foreign, keep_null=False), "GTC100511", values.SALES_ORGS_WITH_EXPORT
    ).withColumns(keys).where(valid).select(
        "period", "corporate", F.trim("GTC100020").alias("material"),
        F.coalesce(F.trim(values.PROFIT_QUANTITY).try_cast("double"), F.lit(0.0)).alias("volume"),
    )
    # Fixed value: the account of the shipping expense.
    cost = ledger.where(F.col("GTC100316") == "6250059900").withColumns(keys).where(valid).select(
        "period", "corporate", F.trim("GTK100676").try_cast("double").alias("cost")
    )
    return cost_rates(cost, volume, ["period", "corporate"], ["material"], "cost", "volume")


def gross_profit_fact(
    profit: DataFrame, client_state: DataFrame, expense_ledger: DataFrame | None = None, by_month: bool = True, stacked: bool = False,
    as_of: str | None = None, months: int = 24,
) -> DataFrame:
    """Cost stacks and gross profit per order item and month.

    With ``expense_ledger`` the commission stack is the apportioned shipping expense. A missing
    state is taken from the client's newest registration. ``stacked`` says that the rows carry their stacks.

    ``as_of`` and ``months`` are those of ``profitability_fact``. The horizon implies a range of the fact's month, which is stated as well: a
    join on the month then leaves out the other side's months before its shuffle.
    """
    rows = profit
    commission: Column | None = None
    if expense_ledger is not None:
        rates = expedition_rates(profit, expense_ledger)
        rows = rows.withColumns(
            {
                "period": fiscal_period("`0FISCPER`"),
                "corporate": F.substring(F.trim("GTC100450"), 1, 8).try_cast("int"),
                "material": F.trim("GTC100020"),
                "_volume": F.trim(values.PROFIT_QUANTITY).try_cast("double"),
            }
        )
        rows = apportion_cost(rows, rates, ["period", "corporate", "material"], "_volume", "_commission")
        commission = F.col("_commission")
    rows = rows.withColumns({c: _account(c) for c in ([values.PROFIT_QUANTITY] if stacked else account_columns())})

    state = client_state.select(
        F.col("COD_CLIENT").alias("_client"), F.col("ORGANIZATION_SALES_COD").alias("_org"), F.col("STATE").alias("_state")
    )
    rows = rows.withColumns({"_client": code_int("GTC100209"), "_org": F.col("GTC100511")})
    rows = lookup(rows, state, ["_client", "_org"], ["_state"])
    blank = F.coalesce(F.trim("GTC101018"), F.lit("")) == ""
    rows = rows.withColumns(
        {
            "SALES_ORG_COD": F.col("GTC100511"),
            "MATERIAL_COD": F.col("GTC100020"),
            "GPD_COD": F.col("GTC100362"),
            "ISSUING_STATE": F.when(blank, F.col("_state")).otherwise(F.col("GTC101018")),
            "SALES_NUMBER": code_int("GTC100255"),
            "SALES_ITEM": code_int("GTC100504"),
            "MONTH": F.trunc("GTC100025", "month"),
            "SALES_ORDER_DATE": F.col("GTC100025"),
        }
    )
    keys = ["MONTH", "SALES_NUMBER", "SALES_ITEM"] if by_month else ["SALES_NUMBER", "SALES_ITEM"]
    carry = ["SALES_ORG_COD", "MATERIAL_COD", "GPD_COD", "ISSUING_STATE", "SALES_ORDER_DATE"]
    facts = gross_profit(rows, keys, carry, commission=commission, stacked=stacked)
    if as_of is not None and by_month:
        lower, upper = window_bounds(as_of, months, month_aligned=False, closed=True)
        facts = facts.where((F.col("MONTH") >= F.trunc(lower, "month")) & (F.col("MONTH") <= F.trunc(upper, "month")))
    return facts.withColumn(
        "FREIGHT_FULL", F.col("SHIP_DEL_LOAD_C_C") + F.col("PORT_EXPENSES") + F.col("FREIGHT") + F.col("COGS_ADJUSTMENTS")
    )


def margin_columns(fact: DataFrame) -> DataFrame:
    """Gross-profit fact as the price marts join it."""
    return fact.select(
        "MONTH", "SALES_NUMBER", "SALES_ITEM", number("GROSS_PROFIT_BW").alias("gross_profit"),
        number("FREIGHT_FULL").alias("freight"), number("COGS_TOTAL").alias("op_cost"),
    )
