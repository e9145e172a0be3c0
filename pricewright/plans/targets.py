"""Agent targets, their capacity and what was realised."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricewright import values
from pricewright.functions.text import norm_key
from pricewright.operators.forecast import backfill_zero_targets, freeze_history
from pricewright.operators.joins import overlay
from pricewright.operators.kpi import branch_capacity, home_branch, realised_vs_target
from pricewright.operators.reshape import parse_target_key, target_key, unpivot_measures

TARGET_KEYS = ["seller_cod", "org", "branch", "state", "gpd", "month_year"]


def target_sheet(wide: DataFrame, agent: str, org: str, state: str, groups: list[str], branch: str | None = None) -> DataFrame:
    """A wide target sheet as one row per agent and product group."""
    key = target_key(F.col(agent), F.col(org), F.col(state), F.col(branch) if branch else None)
    typed = wide.select(key.alias("key"), *[F.col(f"`{g}`").cast("string").try_cast("double").alias(g) for g in groups])
    tall = unpivot_measures(typed, ["key"], groups, "gpd", "target")
    parsed = parse_target_key(tall, "key", with_branch=branch is not None).drop("key")
    return parsed.withColumnsRenamed({"agent_cod": "seller_cod", "org_short": "org"}).distinct()


def agent_targets(
    sheets: list[DataFrame],
    history: DataFrame,
    collects: DataFrame,
    product: DataFrame,
    sellers: DataFrame,
    month_year: str,
) -> DataFrame:
    """Targets per agent, branch and product group: the stored months, the current sheets, and 0 for
    collects without a target.

    A target whose product group the organisation does not sell is left out.
    """
    sheet = sheets[0]
    for other in sheets[1:]:
        sheet = sheet.unionByName(other)
    sold = product.select(
        F.substring(F.trim("SALES_ORG_COD"), 3, 2).alias("org"), norm_key("DESC_GPD").alias("_key"), F.trim("DESC_GPD").alias("_gpd")
    ).groupBy("org", "_key").agg(F.min("_gpd").alias("_gpd"))
    current = sheet.withColumn("_key", norm_key("gpd")).join(sold, ["org", "_key"]).select(
        F.upper(F.trim("seller_cod")).alias("seller_cod"), "org", "branch", F.upper(F.trim("state")).alias("state"),
        F.upper("_gpd").alias("gpd"), F.lit(month_year).alias("month_year"), "target",
    )
    stored = history.select(*TARGET_KEYS, F.col("target").cast("double").alias("target"))
    whole = backfill_zero_targets(freeze_history(stored, current, "month_year", month_year), collects, TARGET_KEYS)
    names = sellers.groupBy(norm_key("seller_cod").alias("_seller")).agg(F.min("seller").alias("seller"))
    named = overlay(
        whole.withColumns({"_seller": norm_key("seller_cod"), "seller": F.lit(values.UNKNOWN_SELLER)}),
        names.withColumnRenamed("seller", "_name"), ["_seller"], {"seller": "_name"},
    ).drop("_seller")
    local = F.col("org") == "CG"
    return named.withColumn("branch", F.when(local, F.col("branch")).otherwise(F.concat(F.lit("Vendas "), F.col("state"))))


def capacity(targets: DataFrame) -> DataFrame:
    """Target rows with the capacity of their month and branch."""
    return branch_capacity(targets, ["month_year", "branch"])


def home_branches(targets: DataFrame, month_year: str) -> DataFrame:
    """Branch of greatest capacity per agent in one month."""
    rows = capacity(targets).where(F.col("month_year") == month_year)
    return home_branch(rows, ["seller_cod"], "branch", "branch_capacity").drop("branch_capacity")


def realised_marks(targets: DataFrame, collects: DataFrame) -> DataFrame:
    """Approved collects against the summed target per organisation, branch, month and product group."""
    keys = ["org", "branch", "month_year", "gpd"]
    local = F.col("org").contains("CG")
    counted = collects.where(F.col("approved")).withColumn(
        "branch", F.when(local, F.col("branch")).otherwise(F.concat(F.lit("Vendas "), F.col("state")))
    )
    return realised_vs_target(targets, counted, keys)
