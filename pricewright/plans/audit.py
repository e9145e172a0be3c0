"""The daily price audit: quarantine, ledger, worklist."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewright.functions.dates import as_of_date
from pricewright.operators.filters import quarantine
from pricewright.operators.ledger import ledger_merge, worklist
from pricewright.sources.writers import replace_partitions, settle_partitions

# Columns a collected price must have, and the prices shown to the auditor.
REQUIRED = ["seller_cod", "client_cod", "branch", "price_kg"]
SHOWN_PRICES = ["price_kg", "ref_price_min", "ref_price_max"]


def audit_day(ledger: DataFrame, collects: DataFrame, reviews: DataFrame, day: str) -> dict[str, DataFrame]:
    """New ledger, rejected collects and the auditors' worklist of one day."""
    valid, rejected = quarantine(collects, REQUIRED)
    merged = ledger_merge(ledger, valid, reviews, day)
    shown = [c for c in SHOWN_PRICES if c in ledger.columns]
    return {"ledger": merged, "rejected": rejected, "worklist": worklist(merged, day, shown)}


def merge_day(
    spark: SparkSession, path: str, batch: DataFrame, reviews: DataFrame, day: date | str, since: date | str | None = None,
    date_col: str = "date", id_col: str = "id", window_days: int = 7,
) -> list:
    """One daily run on a stored ledger partitioned by day; returns the days that were written again.

    Only days that the run changes are read and written: the day itself and those of the batch, days of the window with a
    reviewed row, and older days with a row nobody reviewed. What the rows become is ``ledger_merge``. ``since`` is
    the limit of the run before: no day before it has an open row, so none is looked at. A second run with the same arguments leaves
    the same ledger, and a run that dies leaves the old one or, once its rows are complete, the new one.
    """
    settle_partitions(spark, path, date_col)
    stored, day_of = spark.read.parquet(path), F.col(date_col)
    today = as_of_date(day)
    limit = F.date_add(today, -window_days)
    reviewed = stored.where(day_of >= limit).join(reviews.select(id_col), id_col, "left_semi")
    waiting = stored.where((day_of < limit) & F.col("approved_manually").isNull())
    if since is not None:
        waiting = waiting.where(day_of >= as_of_date(since))
    days = [f.select(day_of.cast("date").alias("day")) for f in (reviewed, waiting, batch)]
    found = days[0].unionByName(days[1]).unionByName(days[2]).unionByName(spark.range(1).select(today.alias("day"))).distinct()
    touched = sorted(r.day for r in found.collect())  # one row per day
    old = stored.where(day_of.isin(touched))
    replace_partitions(ledger_merge(old, batch, reviews, day, id_col, date_col, window_days), path, date_col, touched)
    return touched
