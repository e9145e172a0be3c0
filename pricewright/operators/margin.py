"""Margins: profit stacks, multi-grain rollups, trailing means, shares and apportionment."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from pricewright import values
from pricewright.functions.numbers import add, joined, limbs, narrowed, number, ratio, signed_sum, total, widened
from pricewright.operators.joins import lookup, splittable
from pricewright.operators.price import own_costs, with_costs


def profit_columns(stacks: dict[str, str] | None = None, of: Callable[[str], Column] = F.col) -> dict[str, Column]:
    """Cost and sales stacks of one profitability row as signed sums of its accounts."""
    return {name: signed_sum(spec, of) for name, spec in (stacks or values.PROFIT_STACKS).items()}


def net_and_profit() -> dict[str, Column]:
    """Net sales and gross profit from the stacks (two steps: profit uses net)."""
    net = add("GROSS_SALES", "SALES_TAX_DISCOUNT")
    profit = net + add(
        "COGS_TOTAL", "FREIGHT", "SHIP_DEL_LOAD_C_C", "PORT_EXPENSES", "COGS_ADJUSTMENTS",
        "COMISSION_TO_AGENTS",
    )
    return {"NET_SALES": net, "GROSS_PROFIT_BW": profit}


def gross_profit(
    df: DataFrame,
    keys: list[str],
    carry: list[str],
    stacks: dict[str, str] | None = None,
    quantity: str = values.PROFIT_QUANTITY,
    commission: Column | None = None,
    stacked: bool = False,
) -> DataFrame:
    """Stacks, net sales and gross profit summed per key; quantity goes from kg to tons.

    ``carry`` columns describe the key; their smallest value is kept, which does not depend
    on row order. ``commission`` replaces the commission stack (apportioned cost). Rows that are ``stacked`` carry their stacks already.
    """
    out = df if stacked else df.withColumns(profit_columns(stacks))
    if commission is not None:
        out = out.withColumn("COMISSION_TO_AGENTS", commission)
    out = out.withColumns(net_and_profit())
    measures = [*(stacks or values.PROFIT_STACKS), "NET_SALES", "GROSS_PROFIT_BW"]
    if "COMISSION_TO_AGENTS" not in measures:
        measures.append("COMISSION_TO_AGENTS")
    return out.groupBy(*keys).agg(
        *[F.min(c).alias(c) for c in carry],
        (total(quantity) / 1000.0).alias("QUANTITY_TON"),
        *[total(c).alias(c) for c in measures],
    )


def margin_rollup(
    df: DataFrame,
    grains: dict[str, list[str]],
    sums: list[str],
    weighted: dict[str, tuple[str, str]] | None = None,
    label: str = "grain",
    one_pass: bool = False,
    placed_by: list[str] | None = None,
) -> DataFrame:
    """The same measures at several grains, each summed from the nearest finer one.

    ``weighted`` maps an output to (price, weight): the weighted mean sum(price*weight) /
    sum(weight) and, as ``<output>_reciprocal``, sum(price) / sum(price*weight). Columns
    outside a grain are null; ``label`` names the grain, so a null key in the data is never
    mistaken for a rolled-up one.

    The detail is shuffled once, to the finest grain (``lattice``). Partial sums stay in whole-number parts that add up exactly,
    so a grain is the same from whichever finer one it comes, and every sum is combined before its shuffle. Grains
    that read the same finer one share its shuffle.

    ``placed_by`` names columns with about as many values as the detail has rows (an order item): the grains that hold them all are placed by
    them alone, so that one shuffle of these fine grains serves all of them, where each would shuffle nearly every row again.

    Detail that comes placed by columns of the finest grain, as out of a join, would be summed to it without a shuffle, and each grain
    would then do all that stands before it again. With ``one_pass`` each row is copied per grain instead and all copies are summed at once.
    """
    dims = list(dict.fromkeys(c for cols in grains.values() for c in cols))
    weighted = weighted or {}
    # Every number that is summed, once: (column,) or (price, weight) for their product.
    sources = [*[(c,) for c in sums], *[x for p, w in weighted.values() for x in ((p,), (w,), (p, w))]]
    place = {source: n for n, source in enumerate(dict.fromkeys(sources))}
    parts = [limbs(reduce(lambda x, y: x * y, map(F.col, source))) for source in place]
    state = [f"{side}_{n}" for n in place.values() for side in "hl"]
    detail = df.select(*dims, *[part.alias(name) for name, part in zip(state, [x for pair in parts for x in pair])])
    own = {source: joined(f"h_{n}", f"l_{n}") for source, n in place.items()}
    rolled = _one_pass(detail, grains, dims, state, label) if one_pass else _by_lattice(detail, grains, dims, state, label, placed_by)
    return rolled.select(
        label,
        *dims,
        *[own[(c,)].alias(c) for c in sums],
        *[ratio(own[(p, w)], own[(w,)]).alias(n) for n, (p, w) in weighted.items()],
        *[ratio(own[(p,)], own[(p, w)]).alias(f"{n}_reciprocal") for n, (p, w) in weighted.items()],
    )


def _by_lattice(
    detail: DataFrame, grains: dict[str, list[str]], dims: list[str], state: list[str], label: str, placed_by: list[str] | None = None
) -> DataFrame:
    """Each grain summed from the nearest finer one."""
    frames: dict[tuple[str, ...], DataFrame] = {}
    placed: set[tuple[str, ...]] = set()
    for cols, source in lattice(list(grains.values())):
        above = detail if source is None else frames[source]
        if placed_by and source is not None and set(placed_by) <= set(cols):
            above = above if source in placed else _placed(above, cols, state, placed_by)
            placed.add(cols)
        frames[cols] = above.groupBy(*cols).agg(*[F.sum(c).alias(c) for c in state])
    kinds = {c: detail.schema[c].dataType.simpleString() for c in dims}
    each = [
        frames[tuple(sorted(set(cols)))].selectExpr(
            f"'{name}' AS `{label}`", *[f"`{c}`" if c in cols else f"CAST(NULL AS {kinds[c]}) AS `{c}`" for c in dims], *state
        )
        for name, cols in grains.items()
    ]
    return reduce(DataFrame.unionAll, each)


def _placed(df: DataFrame, cols: tuple[str, ...], state: list[str], by: list[str]) -> DataFrame:
    """Rows of a grain placed by some of its columns, their sums in narrow form on the way."""
    pairs = list(zip(state[::2], state[1::2]))
    slim = df.select(*cols, *[c.alias(name) for high, low in pairs for name, c in zip((high, low), narrowed(high, low))])
    return slim.repartition(*by).select(*cols, *[c.alias(name) for high, low in pairs for name, c in zip((high, low), widened(high, low))])


def _one_pass(detail: DataFrame, grains: dict[str, list[str]], dims: list[str], state: list[str], label: str) -> DataFrame:
    """All grains as grouping sets; grains of the same columns share a set."""
    sets = list(dict.fromkeys(tuple(c for c in dims if c in cols) for cols in grains.values()))
    names = F
    for cols in sets:
        mark = sum(1 << n for n, c in enumerate(reversed(dims)) if c not in cols)
        names = names.when(F.col("_set") == mark, F.array(*[F.lit(name) for name, own in grains.items() if set(own) == set(cols)]))
    rolled = detail.groupingSets([[F.col(c) for c in cols] for cols in sets], *dims).agg(
        F.grouping_id().alias("_set"), *[F.sum(c).alias(c) for c in state]
    )
    return rolled.withColumn(label, F.explode(names) if len(sets) < len(grains) else names[0])


def lattice(grains: list[list[str]]) -> list[tuple[tuple[str, ...], tuple[str, ...] | None]]:
    """(grain, the grain it is summed from) in an order that makes each from one made before; None is the detail.

    A grain comes from the one with the fewest columns among those that hold all of its own. Where several grains have no
    finer one, all their columns together make a grain of their own that is summed first.
    """
    made = sorted({tuple(sorted(set(g))) for g in grains}, key=lambda g: (-len(g), g))
    finer = {g: [f for f in made if set(g) < set(f)] for g in made}
    roots = [g for g in made if not finer[g]]
    if len(roots) > 1:
        whole = tuple(sorted({c for g in roots for c in g}))
        made, finer = [whole, *made], {whole: [], **{g: [*fs, whole] for g, fs in finer.items()}}
    return [(g, min(finer[g], key=lambda f: (len(f), f)) if finer[g] else None) for g in made]


def trailing_means(
    df: DataFrame,
    keys: list[str],
    month: str,
    measures: list[str],
    windows: dict[str, tuple[list[int], int]],
) -> DataFrame:
    """Totals per key over the widest window, and per window the sum over its months / a constant.

    ``windows`` maps a suffix to (months, divisor). One scan: every window is a conditional sum.
    """
    months = sorted({m for ms, _ in windows.values() for m in ms})
    return (
        df.where(F.col(month).isin(months))
        .groupBy(*keys)
        .agg(
            *[total(c).alias(c) for c in measures],
            *[
                (total(F.when(F.col(month).isin(ms), F.col(c))) / float(n)).alias(
                    f"avg_{c}_{suffix}"
                )
                for suffix, (ms, n) in windows.items()
                for c in measures
            ],
        )
    )


def share_of_parent(
    df: DataFrame, child: list[str], parent: list[str], measure: str, name: str = "share", guard: bool = False
) -> DataFrame:
    """Child total, parent total and their ratio.

    The detail is summed to the child grain first; the parent total is then summed from the
    child rows and joined back. With ``guard`` a parent total of 0 or less gives share 0.
    """
    children = df.groupBy(*child).agg(total(measure).alias(f"{measure}_child"))
    parents = children.groupBy(*parent).agg(total(f"{measure}_child").alias(f"{measure}_parent"))
    share = ratio(f"{measure}_child", f"{measure}_parent")
    if guard:
        share = F.when(F.col(f"{measure}_parent") > 0, share).otherwise(F.lit(0.0))
    return children.join(splittable(parents), parent).withColumn(name, share)


def cost_rates(
    cost: DataFrame, volume: DataFrame, parent: list[str], item: list[str], cost_col: str, volume_col: str
) -> DataFrame:
    """Parent cost spread over items by volume: share, item cost and cost per unit of volume."""
    shares = share_of_parent(volume, [*parent, *item], parent, volume_col, guard=True)
    pools = cost.groupBy(*parent).agg(F.coalesce(total(cost_col), F.lit(0.0)).alias("pool"))
    return (
        shares.join(splittable(pools), parent)
        .withColumn("item_cost", number("pool") * F.col("share"))
        .withColumn("unit_cost", ratio("item_cost", f"{volume_col}_child"))
    )


def cost_rates_of(rows: DataFrame, parent: list[str], item: list[str], cost_col: str, volume_col: str) -> DataFrame:
    """``cost_rates`` where cost and volume stand in the same rows.

    Parents are few: they are summed from the rows, combined in the map tasks, so that the shuffle of the items carries the volume alone.
    A parent without any cost (all null) has no rates.
    """
    children = rows.groupBy(*parent, *item).agg(total(volume_col).alias("child"))
    parents = rows.groupBy(*parent).agg(total(volume_col).alias("whole"), total(cost_col).alias("pool")).where("pool IS NOT NULL")
    share = F.when(F.col("whole") > 0, ratio("child", "whole")).otherwise(F.lit(0.0))
    return (
        children.join(splittable(parents), parent)
        .withColumn("item_cost", F.col("pool") * share)
        .select(*parent, *item, "item_cost", ratio("item_cost", "child").alias("unit_cost"))
    )


def apportion_cost(
    df: DataFrame, rates: DataFrame, keys: list[str], quantity: str, name: str = "apportioned_cost"
) -> DataFrame:
    """Each row's part of the pool: -quantity x unit cost, 0 where the item has no rate.

    Rates are as many as items and come from a join on fewer keys, so the lookup places them by an exchange of its own;
    rebalancing them before would shuffle them twice.
    """
    found = lookup(df, rates, keys, ["unit_cost"])
    return found.withColumn(
        name, F.coalesce(-number(quantity) * F.col("unit_cost"), F.lit(0.0))
    ).drop("unit_cost")


# The sums of the dispersion map.
DISPERSION_SUMS = ["zd05", "zeaf", "bx41", "rlv", "rbv", "icms", "pis", "cofins", "other_taxes", "bx95"]


def dispersion_map(
    lines: DataFrame, keys: list[str], margin: DataFrame | None = None, margin_keys: list[str] | None = None
) -> DataFrame:
    """Order-item price per kg with margin and taxes, all per kg, the unscaled figures kept beside.

    Margin figures come from the lines themselves where they carry them, else from the fact ``margin``.
    """
    items = lines.groupBy(*keys).agg(
        total(F.col("practiced_price") * F.col("quantity_ton")).alias("_price_volume"),
        *[total(c).alias(c) for c in [*DISPERSION_SUMS, "quantity_ton", *own_costs(lines)]],
    )
    items = with_costs(items, margin, margin_keys or keys, own_costs(lines))
    items = items.withColumns(
        {
            "practiced_price": ratio("_price_volume", "quantity_ton"),
            "calculated_taxes": add("icms", "cofins", "pis", "other_taxes", "bx95"),
        }
    )
    scaled = ["gross_profit", "practiced_price", "calculated_taxes", *DISPERSION_SUMS, "freight", "op_cost"]
    kept = ["gross_profit", "freight", "op_cost", "practiced_price", "rlv"]
    return items.select(
        *keys,
        "quantity_ton",
        *[F.col(c).alias(f"{c}_original") for c in kept],
        *[(ratio(c, "quantity_ton") / 1000.0).alias(c) for c in scaled],
    )
