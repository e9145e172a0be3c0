"""Targets, run rate, own prices and competitor premium."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewright import values
from pricewright.functions.dates import (
    days_elapsed, days_remaining, iso_week, iso_year, month_start, same_month,
)
from pricewright.functions.numbers import exact_mean, moments, number, ratio, sample_deviation, total
from pricewright.operators.joins import lookup, splittable, with_group


def month_progress(df: DataFrame, day: str, as_of: Column | date | str) -> DataFrame:
    return df.withColumns(
        {"days_elapsed": days_elapsed(day, as_of), "days_remaining": days_remaining(day, as_of)}
    )


def branch_capacity(targets: DataFrame, keys: list[str], target: str = "target") -> DataFrame:
    """Each target row with the summed target of its (month, region)."""
    return with_group(targets, keys, branch_capacity=total(target))


def home_branch(targets: DataFrame, agent: list[str], branch: str, capacity: str) -> DataFrame:
    """The branch of greatest capacity per agent; ties are all kept, agents without any capacity left out.

    An agent has at most as many rows as there are branches, and each task keeps only its best ones before the shuffle.
    """
    per_branch = targets.groupBy(*agent, branch).agg(F.max(capacity).alias(capacity)).where(F.col(capacity).isNotNull())
    best = Window.partitionBy(*agent).orderBy(F.col(capacity).desc())
    return per_branch.withColumn("_rank", F.rank().over(best)).where("_rank = 1").drop("_rank")


def run_rate(
    collects: DataFrame,
    capacity: DataFrame,
    branch: str,
    day: str,
    approved: str,
    as_of: Column | date | str,
) -> DataFrame:
    """Collection pace per branch and month against its capacity.

    The current month is projected: approved count / days gone x days left + approved count;
    past months count as they are. Both are divided by the capacity of (branch, month) and
    put in a bucket; a missing or zero capacity leaves ratio and bucket as "between".
    """
    month = month_start(day)
    counted = collects.groupBy(F.col(branch), month.alias("month")).agg(
        F.count(F.when(F.col(approved), F.lit(1))).alias("n_approved")
    )
    joined = lookup(counted, capacity, [branch, "month"], ["capacity"])
    gone, left = days_elapsed("month", as_of), days_remaining("month", as_of)
    pace = ratio("n_approved", gone)
    projected = pace * left + F.col("n_approved")
    running = F.when(same_month("month", as_of), ratio(projected, "capacity")).otherwise(
        ratio("n_approved", "capacity")
    )
    status = (
        F.when(F.col("running") < 0.8, values.STATUS_LOW)
        .when(F.col("running") >= 1.0, values.STATUS_HIGH)
        .otherwise(values.STATUS_MID)
    )
    return joined.withColumn("running", running).withColumn("status", status)


def price_std(df: DataFrame, keys: list[str], price: str, approved: str) -> DataFrame:
    """Each row with the sample deviation of the approved prices of its group, 0 for one price.

    Moments are added exactly, so the deviation does not depend on how the rows are dealt out.
    """
    kept = F.when(F.col(approved), number(price))
    grouped = with_group(df, keys, **{f"_{name}": agg for name, agg in moments(kept).items()})
    std = F.when(F.col("_n") == 1, F.lit(0.0)).otherwise(sample_deviation("_n", "_s1", "_s2"))
    return grouped.withColumn("price_std", F.round(std, 3)).drop("_n", "_s1", "_s2")


def own_price_ref(
    billing: DataFrame,
    collects: DataFrame,
    keys: list[str],
    price: str,
    billing_date: str,
    order_date: str,
    by_order: Column,
) -> DataFrame:
    """Own price per key and day with its count, and per key and ISO week; zeros for collects alone.

    ``by_order`` marks rows dated by their order instead of their bill. The week mean is the
    plain row mean.

    Billing and collects are each scanned once: a collect is a row without a price, and one
    aggregation brings both to (key, day, billing date). The windows then run over that grain,
    where a group is at most the days of a week times the billing dates of the horizon, however
    many rows the key has.
    """
    rows = billing.select(
        *keys,
        F.col(billing_date).alias("billing_date"),
        F.when(by_order, F.col(order_date)).otherwise(F.col(billing_date)).alias("ref_date"),
        number(price).alias("_price"),
        F.lit(True).alias("_own"),
    ).unionByName(
        collects.select(
            *keys,
            F.col("ref_date").alias("billing_date"),
            "ref_date",
            F.lit(None).cast("double").alias("_price"),
            F.lit(False).alias("_own"),
        )
    )
    days = (
        rows.groupBy(*keys, "ref_date", "billing_date")
        .agg(
            total("_price").alias("_sum"),
            F.count("_price").alias("_n"),
            F.max("_own").alias("_own"),
        )
        .withColumns({"iso_year": iso_year("ref_date"), "iso_week": iso_week("ref_date")})
    )
    week = Window.partitionBy(*keys, "iso_year", "iso_week")
    day = Window.partitionBy(*keys, "iso_year", "iso_week", "ref_date")

    def mean(window) -> Column:
        return F.coalesce(ratio(total("_sum", over=window), F.sum("_n").over(window)), F.lit(0.0))

    out = days.withColumns(
        {
            "week_mean": mean(week),
            "day_mean": mean(day),
            "day_count": F.sum("_n").over(day),
            "_sold": F.max("_own").over(day),
        }
    ).where(F.col("_own") | ~F.col("_sold"))
    return out.withColumn("week_mean", F.when(F.col("_sold"), F.col("week_mean")).otherwise(F.lit(0.0))).select(
        *keys, "ref_date", "billing_date", "iso_year", "iso_week", "day_count", "day_mean", "week_mean"
    )


def realised_vs_target(
    targets: DataFrame, collects: DataFrame, keys: list[str], target: str = "target"
) -> DataFrame:
    """Approved collects per key against the summed target; ratio, its text and a 0/1 flag."""
    goals = targets.groupBy(*keys).agg(F.sum(target).alias("target"))
    counts = collects.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_collects"))
    share = ratio("n_collects", "target")
    return (
        goals.join(counts, keys, "left")
        .withColumn("n_collects", F.coalesce("n_collects", F.lit(0)))
        .withColumn("realised", share)
        .withColumn(
            "realised_text",
            F.coalesce(F.translate(F.round("realised", 6).cast("string"), ".", ","), F.lit(values.NO_PRICE)),
        )
        .withColumn("realised_flag", (F.col("realised") >= 1).cast("int"))
    )


def business_days(calendar: DataFrame, day: str, is_weekend: Column) -> DataFrame:
    """Distinct working dates per month."""
    return (
        calendar.where(~is_weekend)
        .groupBy(month_start(day).alias("month"))
        .agg(F.count_distinct(F.col(day).cast("date")).alias("business_days"))
    )


def premium(
    df: DataFrame,
    keys: list[str],
    org: str,
    own: Column,
    price: str,
    policy: str,
    net_price: str,
    targets: DataFrame | None = None,
    target_on: list[str] | None = None,
    default_target: float = 0.03,
    sample_floor: int = 10,
    markup_orgs: tuple[str, str] = (values.DISTRIBUTION_ORG, values.RESALE_ORG),
) -> DataFrame:
    """Own price over competitor price per (``keys``, ``org``), and the mark-up between two channels.

    Above ``sample_floor`` competitor prices the practised premium counts, otherwise the policy
    premium; columns that do not apply are null.
    """
    flagged = df.withColumn("_own", own)
    mine, theirs = F.col("_own"), ~F.col("_own")
    first, second = markup_orgs

    # One aggregation of the detail; the channel means are read off its few rows per key, one per organisation.
    by_org = flagged.groupBy(org, *keys).agg(
        F.count(F.when(theirs, F.lit(1))).alias("n_competitor"),
        exact_mean(F.when(theirs, F.col(price))).alias("competitor_price"),
        exact_mean(F.when(mine, F.col(price))).alias("own_price"),
        exact_mean(F.when(mine, F.col(policy))).alias("policy_mean"),
        exact_mean(F.when(mine, F.col(net_price))).alias("_net_mean"),
    )
    per_key = Window.partitionBy(*keys)
    stats = by_org.withColumns(
        {
            "channel_price": F.max(F.when(F.col(org) == first, F.col("_net_mean"))).over(per_key),
            "base_price": F.max(F.when(F.col(org) == second, F.col("_net_mean"))).over(per_key),
        }
    ).drop("_net_mean")
    out = flagged.join(splittable(stats), [org, *keys], "left").withColumn(
        "n_competitor", F.coalesce("n_competitor", F.lit(0))
    )
    if targets is None:
        out = out.withColumn("target_premium", F.lit(default_target))
    else:
        out = lookup(out, targets, target_on, ["target_premium"]).withColumn(
            "target_premium", F.coalesce(number("target_premium"), F.lit(default_target))
        )
    enough = F.col("n_competitor") > sample_floor
    policy_premium = ratio("policy_mean", "competitor_price") - 1
    floor_price = F.nullif(F.col("policy_mean"), F.lit(0.0))
    return (
        out.withColumns(
            {
                "practiced_premium": ratio("own_price", "competitor_price") - 1,
                "mark_up": ratio("channel_price", "base_price") - 1,
                "policy_premium": F.when(~enough, policy_premium),
                "deviation_policy_premium": F.when(enough, ratio(floor_price, "competitor_price") - 1),
            }
        )
        .withColumn("practiced_premium_sample", F.when(enough, F.col("practiced_premium")))
        .withColumn("premium_deviation", F.col("practiced_premium_sample") - F.col("target_premium"))
        .drop("_own")
    )
