"""Facts and slicers assembled from several sources, and sample keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pricewright import values
from pricewright.functions.text import display_key


def union_aligned(frames: list[DataFrame], columns: list[str]) -> DataFrame:
    """Union by name in a stated column order; a column a source lacks is null."""
    whole = None
    for frame in frames:
        part = frame.select(*[c for c in columns if c in frame.columns])
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    return whole.select(*columns)


def volume_fact(
    billed: DataFrame, open_orders: DataFrame, columns: list[str], makers: tuple[str, str], quantity: str
) -> DataFrame:
    """Billed rows of positive quantity and open orders as one fact, told apart by maker label."""
    done = billed.where(F.col(quantity) > 0).withColumns(
        {"maker": F.lit(makers[0]), "order_status": F.lit("Completed"), "open_quantity": F.lit(0.0)}
    )
    waiting = open_orders.withColumn("maker", F.lit(makers[1]))
    return union_aligned([done, waiting], columns)


def volume_fact_of(rows: DataFrame, is_open: Column, columns: list[str], makers: tuple[str, str], quantity: str) -> DataFrame:
    """``volume_fact`` where bills and open orders stand in one frame, so that it is read once.

    Open rows bring their ``order_status`` and ``open_quantity``.
    """
    kept = rows.where(is_open | (F.col(quantity) > 0))
    return kept.withColumns(
        {
            "maker": F.when(is_open, makers[1]).otherwise(makers[0]),
            "order_status": F.when(is_open, F.col("order_status")).otherwise("Completed"),
            "open_quantity": F.when(is_open, F.col("open_quantity")).otherwise(F.lit(0.0)),
        }
    ).select(*columns)


def filter_catalog(sources: list[DataFrame], columns: list[str], constants: dict[str, Column] | None = None) -> DataFrame:
    """Distinct slicer values over several sources.

    Each source is made distinct before the union, so only slicer rows are shuffled.
    """
    slim = [s.select(*columns).distinct() for s in sources]
    whole = slim[0]
    for s in slim[1:]:
        whole = whole.unionByName(s)
    return whole.distinct().withColumns(constants or {})


def sample_keys(df: DataFrame, org: str, product: str, branch: str, channel: str, seller: str, day: str) -> DataFrame:
    """Readable keys of a collected price: sample, invoice, seller and material label.

    Joins use the columns themselves; these texts are for display and export.
    """
    return df.withColumns(
        {
            "sample_key": display_key(org, branch, product),
            "invoice_key": display_key(org, product, branch, channel, F.date_format(day, "yyyy-MM-dd")),
            "seller_key": display_key(org, branch, product, seller, F.date_format(day, "MM-yyyy")),
            "month_key": F.date_format(day, "MM-yyyy"),
        }
    )


def audit_key(day: str, *parts: str) -> Column:
    """Readable key of one collected price for the auditors."""
    return display_key(F.date_format(day, "yyyy-MM-dd"), *parts)


def material_label(code: str, text: str) -> Column:
    return display_key(code, text, sep=" - ")


def analysis_unit(org: str, region: str, material: str) -> Column:
    return F.concat(F.lit("BR"), display_key(org, region, material, sep=" - "))


def branch_of(df: DataFrame, branch: str = "branch") -> DataFrame:
    return df.withColumn(branch, F.coalesce(F.col(branch), F.lit(values.UNKNOWN_BRANCH)))
