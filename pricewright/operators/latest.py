"""Dedup and newest-record selection.

``row_number() = 1`` is cut down inside each map task before the shuffle
(WindowGroupLimit), so a hot key sends one row per task, not all its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(
    df: DataFrame, keys: list[str], order: list[Column], keep: int = 1
) -> DataFrame:
    """First ``keep`` rows of each key in the stated order; the order must end in a unique column."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .where(F.col("_rank") <= keep)
        .drop("_rank")
    )


def newest(col: str) -> Column:
    return F.col(col).desc_nulls_last()


def latest_with_ties(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Every row holding the key's greatest value (the join on a max subquery)."""
    top = df.groupBy(*keys).agg(F.max(value).alias(value))
    return df.join(top, [*keys, value], "left_semi")


def latest_snapshot(df: DataFrame, load_col: str) -> DataFrame:
    """Rows of the newest load only; the newest load is one scalar, read as a subquery."""
    top = df.agg(F.max(load_col))
    return df.where(F.col(load_col) == top.scalar())


def last_load(df: DataFrame, load_col: str, name: str = "last_load", by: list[str] | None = None) -> DataFrame:
    """Watermark of the last load, of each source with ``by``."""
    return df.groupBy(*(by or [])).agg(F.max(load_col).alias(name))


def mode_per_key(
    df: DataFrame, keys: list[str], value: str, name: str = "n_rows", weight: str | None = None
) -> DataFrame:
    """Most frequent value per key; the smaller value wins a tie.

    ``weight`` names a column that says how many rows a row stands for.
    """
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(rows.alias(name))
    return latest_per_key(counts, keys, [F.col(name).desc(), F.col(value).asc()])


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def union_extracts(
    extracts: list[DataFrame],
    keys: list[str],
    order: list[Column],
    drop: tuple[str, ...] = ("year", "month", "day"),
    figures: dict[str, Column] | None = None,
) -> DataFrame:
    """Union overlapping extracts by name (upper-cased) and keep the newest row per key.

    ``figures`` are computed for every row beside its columns, before the newest is looked for: of wide rows that only their sums are wanted
    of, the shuffle then carries these alone.
    """
    frames = [upper_names(e.drop(*drop)) for e in extracts]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    # Rows that tie in the stated order are told apart by all of their columns.
    every = F.xxhash64(*[F.col(f"`{c}`") for c in whole.columns])
    return latest_per_key(whole.withColumns(figures or {}), keys, [*order, every])
