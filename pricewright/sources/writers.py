"""Sinks: parquet tables, versioned tables, batches, delimited exports and the review sheet."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

VERSION = "version="
# Spark's writer leaves this file when all tasks of a write have been committed.
COMPLETE = "_SUCCESS"
# Partition column of facts laid out by month.
MONTH = "month_start"
# Spark's readers pass over folders that start with an underscore.
PENDING = "_pending"


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a parquet table; an interrupted run is repeated with the same result."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_compacted(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite with files of the advisory partition size.

    The rebalance hint lets AQE choose the number of files from the measured size, splits a
    partition value that holds too many rows and joins small ones, so no file count is fixed.
    """
    hinted = df.hint("rebalance", *(partition_by or []))
    write_table(hinted, path, partition_by)


def write_by_month(df: DataFrame, path: str, day: str, cluster: list[str] | None = None, month: str = MONTH) -> None:
    """Overwrite a fact laid out for horizons: a folder per month of ``day``, files sorted by day and ``cluster``.

    Rows are dealt out by ranges of (month, day, cluster), so a large month has many files, each with a narrow range that readers
    skip by its statistics, and a small one few. Rows without a day have a folder of their own.
    """
    order = [month, day, *(cluster or [])]
    laid = df.withColumn(month, F.trunc(F.col(day).cast("date"), "month")).repartitionByRange(*order)
    write_table(laid.sortWithinPartitions(*order), path, [month])


def write_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Write a fact by hash of its keys, sorted by them, as an external table of the session's catalog; returns it.

    Tables with the same keys and number of buckets join and group on them, or on more columns, without a shuffle. Every
    bucket is one file, written by one task: choose their number by the size of the fact (``TASK_BYTES`` each).
    """
    dealt = df.repartition(buckets, *keys)
    dealt.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def open_bucketed(spark: SparkSession, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """A bucketed fact that another session wrote: its layout is stated again for this session's catalog."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS `{table}` ({fields}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)


def append_batch(df: DataFrame, path: str, batch: str, partition_by: list[str] | None = None) -> bool:
    """Add a landed batch to a table of batches; says whether it has rows.

    The batch is a folder of its own named by ``batch``, so a repeated run replaces it instead of adding it again.
    The plan runs once; whether there are rows is read from what was written, and an empty batch is taken away.
    """
    spark, folder = df.sparkSession, f"{path}/batch={batch}"
    (write_compacted if partition_by else write_table)(df, folder, partition_by)
    if not spark.read.parquet(folder).isEmpty():
        return True
    _delete(spark, folder)
    return False


def replace_partitions(df: DataFrame, path: str, by: str, touched: list) -> None:
    """Replace some partitions of a table by the rows of ``df``, which may read them; all other files stay as they are.

    ``touched`` lists the values of ``by`` that are replaced; ``df`` holds no others, and one it has no rows of disappears.
    The new rows are first written beside the table. Until that write is complete the table is the old one;
    from then on ``settle_partitions`` brings them in, again if a run died over it.
    """
    spark, pending = df.sparkSession, f"{path}/{PENDING}"
    _delete(spark, pending)
    kind = df.schema[by].dataType.simpleString()
    spark.createDataFrame([(str(v),) for v in touched], "value string").selectExpr(f"CAST(value AS {kind}) AS `{by}`").coalesce(1).write.parquet(
        f"{pending}/touched"
    )
    write_compacted(df, f"{pending}/rows", [by])
    settle_partitions(spark, path, by)


def settle_partitions(spark: SparkSession, path: str, by: str) -> bool:
    """Bring in the partitions a complete ``replace_partitions`` left beside the table; says whether there were any."""
    pending = f"{path}/{PENDING}"
    system, rows = _file_system(spark, f"{pending}/rows")
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    if not system.exists(hadoop(rows, COMPLETE)):
        return False
    touched = spark.read.parquet(f"{pending}/touched").select(F.col(by).cast("string"))
    new = sorted(f.getPath().getName() for f in system.listStatus(rows) if f.isDirectory())
    if new:
        frame = spark.read.option("basePath", str(rows.toString())).parquet(*[f"{rows.toString()}/{name}" for name in new])
        frame.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    # One row per replaced partition.
    for (value,) in touched.collect():
        if f"{by}={value}" not in new:
            _delete(spark, f"{path}/{by}={value}")
    _delete(spark, pending)
    return True


def write_csv(df: DataFrame, path: str, sep: str = ";", encoding: str = "UTF-8", max_rows_per_file: int = 1_000_000) -> None:
    """Delimited export with a header in every file, sharded so that no task writes it all."""
    df.write.mode("overwrite").options(
        header=True, sep=sep, encoding=encoding, maxRecordsPerFile=max_rows_per_file
    ).csv(path)


def write_review_sheet(df: DataFrame, path: str) -> None:
    """Worklist for the auditors (pipe-separated, Western encoding)."""
    write_csv(df, path, sep="|", encoding="ISO-8859-1")


def write_version(df: DataFrame, path: str, partition_by: list[str] | None = None, keep: int = 2) -> str:
    """Write a new version of a table beside the older ones; returns its folder.

    The table may be read by ``df`` itself: nothing it reads is touched. A version counts once its
    write has been committed, which is one step, so readers see the old or the new content and a job that dies
    leaves the old. The newest ``keep`` complete versions stay.
    """
    spark = df.sparkSession
    folder = f"{path}/{VERSION}{time.time_ns() // 1_000_000:015d}-{uuid.uuid4().hex[:8]}"
    write_table(df, folder, partition_by)
    for old in versions(spark, path)[:-keep]:
        _delete(spark, old)
    return folder


def versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of the complete versions of a table, oldest first."""
    system, root = _file_system(spark, path)
    if not system.exists(root):
        return []
    folders = sorted(str(f.getPath().toString()) for f in system.listStatus(root) if f.isDirectory())
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    return [f for f in folders if f"/{VERSION}" in f and system.exists(hadoop(f, COMPLETE))]


def read_version(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of a table."""
    found = versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no complete version in {path}")
    return spark.read.parquet(found[-1])


def _file_system(spark: SparkSession, path: str):
    """The file system a path lies in, by the session's own configuration, and the path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _delete(spark: SparkSession, path: str) -> None:
    system, target = _file_system(spark, path)
    system.delete(target, True)
