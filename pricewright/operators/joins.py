"""Lookups and joins.

No side is broadcast by hint: Spark broadcasts a side only when its measured
size is under ``spark.sql.autoBroadcastJoinThreshold``, and past it the join
shuffles, with hot keys split by AQE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def splittable(side: DataFrame) -> DataFrame:
    """The small, keyed side of a join, made to arrive by an exchange of its own.

    AQE splits a hot key only where both sides of the join come straight from an exchange. A side
    that was just grouped or deduplicated by the join keys is already placed by them and would
    bring none. Rebalancing it costs one shuffle of the small side.
    """
    return side.hint("rebalance")


def shuffled(side: DataFrame) -> DataFrame:
    """The keyed side of a join that grows with the tables: both sides are shuffled, it is never broadcast.

    Spark estimates a side by its files, which hold a row in a few bytes; rows that lists are exploded to, and texts made beside them, do not
    count. By such an estimate a side of many million rows is broadcast, through the driver, and once its rows are counted AQE does not take that back.
    """
    return side.hint("merge")


def one_per_key(dim: DataFrame, keys: list[str], split: bool = True) -> DataFrame:
    """One row per key of a table to look up: the smallest by its other columns, in their order.

    An ambiguous key then cannot multiply the rows that look it up. Repeats are combined in the map tasks. Without ``split`` the rows stay
    where they were grouped and are not shuffled once more: for keys that the rows looking them up have about once each.
    """
    rest = [c for c in dim.columns if c not in keys]
    rows = dim.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    rows = rows.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])
    return splittable(rows) if split else rows


def with_group(df: DataFrame, keys: list[str], **aggs: Column) -> DataFrame:
    """Detail rows with aggregates of their group.

    The group is aggregated (combined inside the map tasks) and joined back, so no task ever
    holds all the detail of one key: few groups are broadcast by their measured size, many are
    joined with the hot keys split. Rows with a null key keep null aggregates.
    """
    stats = df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in aggs.items()])
    return df.join(splittable(stats), keys, "left")


def lookup(
    df: DataFrame, dim: DataFrame, on: dict[str, str] | list[str], columns: list[str] | None = None
) -> DataFrame:
    """Left lookup on one or more keys; ``on`` maps a column of ``df`` to one of ``dim``."""
    pairs = dict.fromkeys(on) if isinstance(on, list) else on
    pairs = {left: right or left for left, right in pairs.items()}
    wanted = columns if columns is not None else [c for c in dim.columns if c not in pairs.values()]
    renamed = dim.select(
        *[F.col(right).alias(left) for left, right in pairs.items()], *[F.col(c) for c in wanted]
    )
    return df.join(renamed, list(pairs), "left")


def overlay(
    df: DataFrame,
    dim: DataFrame,
    on: dict[str, str] | list[str],
    replace: dict[str, str],
    null_wins: bool = False,
) -> DataFrame:
    """Left lookup whose value replaces the row's own value where the key matches.

    ``replace`` maps a column of ``df`` to a column of ``dim``. With ``null_wins`` a
    matched null replaces the value too, otherwise only a non-null value does.
    """
    sources = {src: f"_new_{i}" for i, src in enumerate(dict.fromkeys(replace.values()))}
    keys = on if isinstance(on, list) else list(on.values())
    slim = dim.select(
        *keys, *[F.col(s).alias(a) for s, a in sources.items()], F.lit(True).alias("_hit")
    )
    joined = lookup(df, slim, on, [*sources.values(), "_hit"])
    changed = {}
    for target, src in replace.items():
        new = F.col(sources[src])
        changed[target] = (
            F.when(F.col("_hit"), new).otherwise(F.col(target))
            if null_wins
            else F.coalesce(new, F.col(target))
        )
    return joined.withColumns(changed).drop(*sources.values(), "_hit")


def full_coalesce(
    left: DataFrame, right: DataFrame, key: str, merged: list[str]
) -> DataFrame:
    """Full join on one key; the left value wins in the merged columns.

    Rows without a key can match nothing, so they bypass the join instead of
    meeting in one task.
    """
    l_only = [c for c in left.columns if c != key and c not in merged]
    r_only = [c for c in right.columns if c != key and c not in merged]
    a = left.select(key, *l_only, *[F.col(c).alias(f"_l_{c}") for c in merged])
    b = right.select(key, *r_only, *[F.col(c).alias(f"_r_{c}") for c in merged])
    joined = a.where(F.col(key).isNotNull()).join(b.where(F.col(key).isNotNull()), key, "full")
    whole = joined.unionByName(
        a.where(F.col(key).isNull()), allowMissingColumns=True
    ).unionByName(b.where(F.col(key).isNull()), allowMissingColumns=True)
    return whole.select(
        key,
        *l_only,
        *r_only,
        *[F.coalesce(F.col(f"_l_{c}"), F.col(f"_r_{c}")).alias(c) for c in merged],
    )


def two_pass_lookup(
    df: DataFrame,
    dim: DataFrame,
    first: dict[str, str],
    second: dict[str, str],
    value: str,
    name: str,
) -> DataFrame:
    """Look up on the first key, then on the second where the first finds nothing."""
    one = lookup(df, dim.withColumnRenamed(value, "_first"), first, ["_first"])
    two = lookup(one, dim.withColumnRenamed(value, "_second"), second, ["_second"])
    return two.withColumn(name, F.coalesce("_first", "_second")).drop("_first", "_second")


def missing_rows(df: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the other frame does not hold."""
    return df.join(splittable(present.select(*keys).distinct()), keys, "left_anti")


def backfill(df: DataFrame, wanted: DataFrame, keys: list[str], fill: dict[str, Column]) -> DataFrame:
    """Add a row with the fill values for every wanted key the frame lacks."""
    extra = missing_rows(wanted, df, keys).withColumns(fill)
    return df.unionByName(extra.select(*df.columns))
