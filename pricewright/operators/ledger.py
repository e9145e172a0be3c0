"""The review ledger: daily replacement, review feedback, expiry and worklist."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from pricewright import values
from pricewright.functions.dates import as_of_date
from pricewright.operators.joins import lookup
from pricewright.operators.latest import latest_per_key


def ledger_merge(
    ledger: DataFrame,
    batch: DataFrame,
    reviews: DataFrame,
    day: Column | date | str,
    id_col: str = "id",
    date_col: str = "date",
    window_days: int = 7,
    replace: bool = True,
) -> DataFrame:
    """The ledger after one daily run; running it twice gives the same ledger.

    1. A review sets ``approved_manually`` of its row when the row is at most ``window_days``
       old. With several reviews of one id the newest (``reviewed_at``) counts; a review of
       an unknown id changes nothing.
    2. With ``replace`` the rows of ``day`` give way to the batch, which arrives unreviewed.
    3. Rows older than the window that nobody reviewed are rejected.
    """
    today = as_of_date(day)
    limit = F.date_add(today, -window_days)
    last = latest_per_key(reviews, [id_col], [F.col("reviewed_at").desc_nulls_last(), F.col("verdict")])
    old = lookup(ledger, last.select(id_col, F.col("verdict").alias("_verdict")), [id_col])
    old = old.withColumn(
        "approved_manually",
        F.when(F.col("_verdict").isNotNull() & (F.col(date_col) >= limit), F.col("_verdict")).otherwise(
            F.col("approved_manually")
        ),
    ).drop("_verdict")
    if replace:
        new = batch.withColumns(
            {
                "approved_manually": F.lit(None).cast("string"),
                "approved_automatically": F.lit(values.NO),
            }
        )
        old = old.where(F.col(date_col) != today).unionByName(new.select(*old.columns))
    expired = (F.col(date_col) < limit) & F.col("approved_manually").isNull()
    return old.withColumn(
        "approved_manually",
        F.when(expired, F.lit(values.NO)).otherwise(F.col("approved_manually")),
    )


def worklist(
    ledger: DataFrame, day: Column | date | str, prices: list[str], date_col: str = "date", window_days: int = 7
) -> DataFrame:
    """Open rows of the window, prices rounded for the reviewer (missing ones as 0)."""
    limit = F.date_add(as_of_date(day), -window_days)
    waiting = F.coalesce(F.col("approved_automatically") == values.NO, F.lit(True))
    return ledger.where(
        waiting & F.col("approved_manually").isNull() & (F.col(date_col) >= limit)
    ).withColumns({c: F.round(F.coalesce(F.col(c), F.lit(0)), 2) for c in prices})
