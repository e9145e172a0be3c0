"""Competitor premium and forecast against actuals for the strategic report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricewright.functions.dates import month_from_label, month_start
from pricewright.functions.numbers import add, number, parse_number, ratio
from pricewright.functions.text import norm_key
from pricewright.operators.forecast import forecast_vs_actual
from pricewright.operators.joins import lookup, one_per_key
from pricewright.operators.kpi import business_days, premium
from pricewright.operators.price import limit_deviation
from pricewright.plans.support import calendar as typed_calendar

NUMBERS = [
    "quantity_ton", "list_price", "zd01", "zd02", "zd03", "zd04", "zd05", "zeb1", "zeb2", "zeaf", "zp30", "zsu2", "zp20", "verge",
    "rbv", "rlv", "norm_pract_price", "norm_pract_price_kg", "zd_total_d", "zd_total_p", "confirmed_ton",
]


def premium_report(view: DataFrame, calendar: DataFrame, targets: DataFrame, own_makers: list[str]) -> DataFrame:
    """Strategy view with business days, premium, mark-up and limit deviation.

    ``own_makers`` are the maker labels of own rows, billed and open; the others are competitors.
    """
    rows = view.withColumns({c: number(c) for c in NUMBERS if c in view.columns}).withColumns(
        {"month": month_start("sales_order_date"), "is_own": F.col("maker").isin(own_makers)}
    )
    days = business_days(typed_calendar(calendar), "CURRENT_DATE", F.col("IS_WEEKEND"))
    rows = lookup(rows, days, ["month"])
    base = add("list_price", "zeb2", "zeaf", "zp30", "zsu2", "zp20") - add("zd01", "zd02", "zd03", "zd04", "zd05", "zeb1")
    rows = rows.withColumns(
        {"po": base, "rlv_per_ton": ratio("rlv", "quantity_ton"), "zd13_floor": F.coalesce(base * 0.02, F.lit(0.0))}
    )
    tons = F.when(F.col("maker") == own_makers[-1], F.col("confirmed_ton")).otherwise(F.col("quantity_ton"))
    rows = rows.withColumns(
        {
            "adj_policy_price": ratio(F.col("norm_pract_price") + F.col("zd_total_d") - F.col("zd13_floor"), tons) / 1000.0,
            "adj_verge_deviation": limit_deviation("zd_total_p", "verge", "po"),
        }
    )
    goals = targets.select(
        F.trim("issuing_state").alias("issuing_state"), F.trim("gpd_desc").alias("gpd_desc"), parse_number(F.col("target_premium").cast("string")).alias("target_premium")
    )
    goals = one_per_key(goals, ["issuing_state", "gpd_desc"])
    return premium(
        rows, ["issuing_state", "branch", "gpd_desc", "month", "material_cod"], "sales_org_cod", F.col("is_own"),
        "norm_pract_price_kg", "adj_policy_price", "rlv_per_ton", goals, ["issuing_state", "gpd_desc"],
    )


def plan_report(plan: DataFrame, view: DataFrame, budget: DataFrame, own_maker: str) -> DataFrame:
    """Forecast, actual sales and budget per group, state, organisation and month."""
    keys = ["gpm", "gpd_cod", "state", "sales_org_cod"]

    def keyed(df: DataFrame, gpm: str, state: str) -> DataFrame:
        return df.withColumns(
            {
                "gpm": F.coalesce(norm_key(gpm), F.lit("NA")), "gpd_cod": F.coalesce(F.col("gpd_cod").cast("string"), F.lit("NA")),
                "state": F.coalesce(norm_key(state), F.lit("NA")), "sales_org_cod": F.coalesce(norm_key("sales_org_cod"), F.lit("")),
            }
        )

    plans = keyed(plan, "desc_gpm", "state").select(
        *keys, month_from_label("month_year").alias("month"), F.coalesce(parse_number(F.col("volume").cast("string")), F.lit(0.0)).alias("volume")
    )
    sold = keyed(view.where(F.col("maker") == own_maker), "gpm", "issuing_state").select(
        *keys, month_start("sales_order_date").alias("month"), number("quantity_ton").alias("qty"), number("rbv").alias("rbv"), number("rlv").alias("rlv")
    )
    goals = keyed(budget, "gpm_cod", "state").select(
        *keys, month_from_label("month_year").alias("month"), parse_number(F.col("volume").cast("string")).alias("volume"),
        parse_number(F.col("rlv").cast("string")).alias("rlv"),
    )
    return forecast_vs_actual(plans, sold, goals, keys, "month")
