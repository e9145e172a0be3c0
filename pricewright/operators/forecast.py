"""Forecasts and targets: splicing, allocation, backfill, variance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pricewright import values
from pricewright.functions.numbers import column, joined, limbs, number, ratio, total
from pricewright.operators.joins import backfill


def splice_forecast(
    past: DataFrame, view: DataFrame, future: DataFrame, month: str, current: Column | str
) -> DataFrame:
    """Months before ``current`` from the stored past, the rest from the view, plus future months
    from the manual forecast; exact repeats dropped."""
    now = F.lit(current) if isinstance(current, str) else current
    return (
        past.where(F.col(month) < now)
        .unionByName(view.where(F.col(month) >= now).select(*past.columns))
        .unionByName(future.where(F.col(month) > now).select(*past.columns))
        .distinct()
    )


def freeze_history(
    history: DataFrame, current: DataFrame, month: str, this_month: Column | str
) -> DataFrame:
    """Stored months stay as they are; only the current month is regenerated."""
    now = F.lit(this_month) if isinstance(this_month, str) else this_month
    return history.where(F.col(month) != now).unionByName(
        current.where(F.col(month) == now).select(*history.columns)
    )


def backfill_zero_targets(
    targets: DataFrame, collects: DataFrame, keys: list[str], target: str = "target"
) -> DataFrame:
    """Every collected key has a target, 0 where none was set; then one row per key."""
    wanted = collects.select(*keys).distinct()
    whole = backfill(
        targets.select(*keys, target), wanted, keys, {target: F.lit(0).cast(targets.schema[target].dataType)}
    )
    return whole.groupBy(*keys).agg(F.sum(F.coalesce(F.col(target), F.lit(0))).alias(target))


def allocate_forecast(
    forecast: DataFrame,
    actuals: DataFrame,
    branches: DataFrame,
    parent: list[str],
    state: str,
    branch: str,
    plan: str,
    volume: str,
    unknown: str = values.UNKNOWN_BRANCH,
    text: str | None = None,
) -> DataFrame:
    """Spread a state-level forecast over the branches of the state.

    ``parent`` is the forecast grain (organisation, group, state, ...) and holds ``state``;
    ``branches`` lists (state, branch). Three cases:

    * the group sold in the state: plan x the branch's part of the state volume; a branch
      of the state without sales gets 0;
    * the group did not sell in the state: the plan is split equally over its branches;
    * sales of an unknown branch are carried with a zero plan.

    Known branches add up to the plan again, per parent. ``text`` names a description of the parent that both inputs have: it
    goes along with the sums, the smallest one of the plan or, where the plan has none, of the sales. Each input is scanned once,
    and the sales are combined before their only shuffle.
    """
    texts = [text] if text else []
    sites = branches.select(state, branch).where(F.col(branch).isNotNull()).distinct()
    # The group of a state is its branches.
    sites = sites.withColumn("n_branches", F.count(F.lit(1)).over(Window.partitionBy(state)))

    # Sales per branch and plans per branch of their state, which are rows of the result, side by side. A plan without
    # any branch stays for its text alone. The text is a key here, as it hardly divides a group, and an aggregate below.
    high, low = limbs(volume)
    sold = actuals.select(*parent, branch, *texts, high.alias("_h"), low.alias("_l")).groupBy(*parent, branch, *texts).agg(
        F.sum("_h").alias("_h"), F.sum("_l").alias("_l")
    )
    sold = sold.select(
        *parent, branch, "_h", "_l", F.lit(None).cast("double").alias("plan"), F.lit(None).cast("bigint").alias("n_branches"),
        F.lit(True).alias("_is_sold"), F.lit(None).cast("string").alias("_planned"), F.col(text or branch).cast("string").alias("_sold"),
    )
    plans = forecast.groupBy(*parent).agg(total(plan).alias("plan"), F.min(F.col(text or plan).cast("string")).alias("_planned"))
    planned = plans.join(sites, state, "left").select(
        *parent, branch, *[F.lit(None).cast("bigint").alias(c) for c in ("_h", "_l")], "plan", "n_branches", F.lit(False).alias("_is_sold"),
        "_planned", F.lit(None).cast("string").alias("_sold"),
    )
    rows = (
        planned.unionByName(sold)
        .groupBy(*parent, branch)
        .agg(
            F.sum("_h").alias("_h"), F.sum("_l").alias("_l"), F.max("plan").alias("plan"), F.max("n_branches").alias("n_branches"),
            F.max("_is_sold").alias("_is_sold"), F.min("_planned").alias("_planned"), F.min("_sold").alias("_sold"),
        )
        .withColumn("qty", joined("_h", "_l"))
    )
    # The group of a parent is now at most the branches of one state.
    known = F.col(branch) != unknown
    group = Window.partitionBy(*parent)
    whole = joined(*[F.sum(F.when(known, F.col(c))).over(group) for c in ("_h", "_l")])
    described = F.coalesce(F.min("_planned").over(group), F.min("_sold").over(group))
    rows = rows.withColumns({"state_qty": whole, "_text": described}).where(F.col(branch).isNotNull() | F.col("_is_sold"))

    has_sales, has_plan = F.col("qty").isNotNull(), F.col("plan").isNotNull()
    state_sold = F.col("state_qty").isNotNull()
    share = F.coalesce(ratio("qty", "state_qty"), F.lit(0.0))

    def where_known(test: Column, value: Column) -> Column:
        return F.when(known & test, value).otherwise(F.lit(0.0))

    return rows.select(
        *parent,
        branch,
        where_known(has_plan & (has_sales | ~state_sold), F.col("plan")).alias("pv_budget"),
        where_known(has_sales, F.col("qty")).alias("qty_branch"),
        where_known(has_sales, F.col("state_qty")).alias("qty_state"),
        where_known(has_sales, share).alias("perc_vol"),
        where_known(
            has_plan,
            F.when(state_sold, F.col("plan") * share).otherwise(ratio("plan", "n_branches")),
        ).alias("pv_done"),
        *[F.col("_text").alias(c) for c in texts],
    )


def forecast_vs_actual(
    plan: DataFrame,
    actual: DataFrame,
    budget: DataFrame,
    keys: list[str],
    month: str,
    volume: str = "volume",
    sales: tuple[str, ...] = ("qty", "rbv", "rlv"),
    budget_cols: tuple[str, ...] = ("volume", "rlv"),
) -> DataFrame:
    """Monthly plan beside actual sales, the next month's figures and the budget.

    ``volume_diff`` is next month's plan less this month's, ``rlv_diff`` this month's net
    revenue less next month's, ``rlv_diff_mean`` its mean per key. Keys and months only in the
    budget or only in the plan are left out (inner join on the budget).
    """
    measures = {
        "plan": {"volume": volume},
        "sold": {f"{c}_sold": c for c in sales},
        "budget": {f"{c}_budget": c for c in budget_cols},
    }
    frames = {"plan": plan, "sold": actual, "budget": budget}
    names = [n for cols in measures.values() for n in cols]
    rows = None
    for source, frame in frames.items():
        part = frame.select(
            *keys,
            month,
            *[number(c).alias(n) for n, c in measures[source].items()],
            F.lit(True).alias(f"_{source}"),
        )
        rows = part if rows is None else rows.unionByName(part, allowMissingColumns=True)
    # One aggregation of the three sources in place of joins and a self join.
    months = rows.groupBy(*keys, month).agg(
        *[total(n).alias(n) for n in names], F.max("_plan").alias("_plan"), F.max("_budget").alias("_budget")
    ).where(F.col("_plan"))

    # The row exactly one month on: null in a gap. A group is the months of one key.
    number_of_month = F.year(month) * 12 + F.month(month)
    following = Window.partitionBy(*keys).orderBy(number_of_month).rangeBetween(1, 1)
    carried = ["volume", *measures["sold"]]
    months = months.withColumns({f"{c}_next": F.sum(c).over(following) for c in carried}).withColumns(
        {
            "volume_diff": F.col("volume_next") - F.col("volume"),
            "rlv_diff": F.col("rlv_sold") - F.col("rlv_sold_next"),
        }
    )
    per_key = Window.partitionBy(*keys)
    mean = ratio(total("rlv_diff", over=per_key), F.count("rlv_diff").over(per_key))
    return (
        months.withColumn("rlv_diff_mean", mean)
        .where(F.col("_budget"))
        .drop("_plan", "_budget")
    )


def previous_day_month(as_of: Column | str, fmt: str = "yyyyMM") -> Column:
    """Month key of the day before ``as_of``: on the first of a month the old month still counts."""
    return F.date_format(F.date_add(column(as_of), -1), fmt)
