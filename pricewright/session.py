"""Session settings the operators rely on."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings; nothing here depends on the size of the cluster.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A key holding a third of the rows is split over many tasks at join time,
    # also when the split costs one more exchange further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The JVM never compiles a method beyond this size; wide aggregates are faster operator
    # by operator than as one generated method that stays interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


MB = 1024 * 1024
# Shuffle data one task should handle, before AQE merges small neighbours.
TASK_BYTES = 128 * MB
# What a task needs in memory goes by unpacked rows and the sums kept for each group, some 20 to 40 times the bytes it reads: while the number of
# tasks allows, shuffles start out finer by this ...
FINE_TASK_BYTES, FINE_TASKS = 64 * MB, 8192
# ... and AQE merges partitions only up to, and a scan reads at once no more than, so many bytes; a partition beyond the last is split in a join.
# A larger number in the session is lowered, a smaller one kept.
FINE_CONF = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 * MB,
    "spark.sql.files.maxPartitionBytes": 8 * MB,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 32 * MB,
}
# A scan makes no more tasks than this because of them.
SCAN_TASKS = 65_536


def tune(spark: SparkSession, shuffle_bytes: int | None = None, scan_bytes: int | None = None) -> SparkSession:
    """Apply the runtime settings to a session the caller already owns.

    ``shuffle_bytes`` is the volume the job is expected to shuffle at once (after pruning);
    it sets how finely shuffles start out, so that no partition outgrows an executor. AQE merges
    what turns out small. The session's own number is never lowered, and stays without it.
    ``scan_bytes`` is the size of the tables; with it, tasks read no more than ``FINE_CONF`` says, for wide sums over rows that
    files hold in a few bytes each.
    """
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    if shuffle_bytes is not None:
        own = int(spark.conf.get("spark.sql.shuffle.partitions"))
        fine = min(-(-shuffle_bytes // FINE_TASK_BYTES), FINE_TASKS)
        parts = max(own, spark.sparkContext.defaultParallelism, -(-shuffle_bytes // TASK_BYTES), fine)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    if scan_bytes is not None:
        for key, most in FINE_CONF.items():
            own = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
            spark.conf.set(key, f"{min(own, max(most, scan_bytes // SCAN_TASKS))}b")
    return spark


def input_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a folder, asked of the file system it lies in."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("pricewright")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # No call site is recorded per column expression; building wide plans is faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    A session that runs in one JVM gets a temporary folder of its own where none is set; on a
    cluster executors could not share one, so the setting is required there.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(current)
    return current


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a frame in the reliable checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
