"""Consume-once landing of survey exports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pricewright.sources.writers import append_batch, replace_partitions, settle_partitions

# Name of the column by which batches and marts are laid out.
PERIOD = "period"


def land_once(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    target: str,
    checkpoint: str,
    fmt: str = "json",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    options: dict[str, str] | None = None,
) -> StreamingQuery:
    """Append every export file that was not landed before, each exactly once, then stop.

    The checkpoint remembers the files already taken, in place of an acknowledgement to the
    sender; it has to lie in a folder all nodes share.
    """
    raw = spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(source)
    rows = transform(raw) if transform else raw
    return (
        rows.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target)
    )


def land_and_refresh(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    batches: str,
    mart: str,
    checkpoint: str,
    period: Column,
    build: Callable[[DataFrame], DataFrame],
    fmt: str = "json",
    transform: Callable[[DataFrame], DataFrame] | None = None,
    options: dict[str, str] | None = None,
    open_from: Column | str | None = None,
) -> StreamingQuery:
    """Land new export files and bring the periods of a mart up to date that they have rows of, then stop.

    Every micro-batch is one folder of ``batches``, named by its id and laid out by ``period`` (a day or month of the landed rows): a batch
    that is delivered again replaces itself. ``build`` makes the mart's rows from all landed rows of a period; it keeps the
    column ``period`` and may look at no other period. A late row thus recomputes its own period and nothing else, and the mart
    is what one run over all files would give. Periods before ``open_from`` are frozen: their rows land, their mart stays as it is stored.
    """

    def take(rows: DataFrame, batch_id: int) -> None:
        landed = (transform(rows) if transform else rows).withColumn(PERIOD, period)
        name = f"{batch_id:012d}"
        if append_batch(landed, batches, name, [PERIOD]):
            refresh(rows.sparkSession, batches, mart, build, name, open_from)

    raw = spark.readStream.format(fmt).schema(schema).options(**(options or {})).load(source)
    return raw.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def refresh(
    spark: SparkSession, batches: str, mart: str, build: Callable[[DataFrame], DataFrame], batch: str, open_from: Column | str | None = None
) -> list:
    """Recompute the periods of one landed batch from all batches; returns them.

    The periods are read from the batch's folders, the rows from the folders of these periods.
    """
    settle_partitions(spark, mart, PERIOD)
    landed = spark.read.parquet(batches)
    own = landed.where(F.col("batch") == F.lit(batch).cast(landed.schema["batch"].dataType)).select(PERIOD).distinct()
    if open_from is not None:
        own = own.where(F.col(PERIOD) >= (F.lit(open_from) if isinstance(open_from, str) else open_from))
    touched = sorted(r[PERIOD] for r in own.collect())  # one row per period
    if touched:
        replace_partitions(build(landed.where(F.col(PERIOD).isin(touched)).drop("batch")), mart, PERIOD, touched)
    return touched
