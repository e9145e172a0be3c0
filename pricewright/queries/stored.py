"""Tables that are kept and changed in place: the ledger by day, a mart refreshed by what lands, a fact laid out by
month, and records that arrive damaged. Each is built below the session's checkpoint folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from pricewright.functions.numbers import total
from pricewright.operators import filters, reshape
from pricewright.plans.audit import merge_day
from pricewright.queries import assembly
from pricewright.queries.tables import AS_OF, SCHEMAS, table, tidy, tidy_sql
from pricewright.session import ensure_checkpoint_dir
from pricewright.sources.writers import MONTH, write_by_month, write_compacted
from pricewright.streaming.landing import PERIOD, land_and_refresh

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def add(fn):
        QUERIES[name] = fn
        ORACLE[name] = sql
        return fn

    return add


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("ledger_by_day", tidy_sql(assembly.LEDGER_SQL, assembly.LEDGER_COLUMNS, ["price"]))
def ledger_by_day(spark, sf):
    old, batch, reviews = assembly.ledger_inputs(spark, sf)
    path = _folder(spark, "ledger")
    write_compacted(old, path, ["date"])
    merge_day(spark, path, batch, reviews, assembly.LEDGER_DAY)
    return tidy(spark.read.parquet(path).select(*assembly.LEDGER_COLUMNS, "price"))


# Files of the landed exports; every file has rows of all days, so all but the first bring late rows.
EXPORTS = 2


def _daily(landed: DataFrame) -> DataFrame:
    return landed.groupBy(PERIOD, "event_type").agg(
        F.count("*").alias("n_events"), F.max("event_id").alias("last_event"), total("value").alias("value")
    )


@query(
    "incremental_mart",
    tidy_sql(
        """
        SELECT CAST(ts AS DATE) AS period, event_type, count(*) AS n_events, max(event_id) AS last_event, sum(CAST(value AS DECIMAL(18,6))) AS value
        FROM events GROUP BY ALL
        """,
        ["period", "event_type", "n_events", "last_event"],
        ["value"],
    ),
)
def incremental_mart(spark, sf):
    path = _folder(spark, "landing")
    table(spark, sf, "events").repartition(EXPORTS, "event_id").write.parquet(f"{path}/in")
    land_and_refresh(
        spark, f"{path}/in", SCHEMAS["events"], f"{path}/batches", f"{path}/mart", f"{path}/offsets", F.col("ts").cast("date"), _daily,
        fmt="parquet", options={"maxFilesPerTrigger": "1"},
    ).awaitTermination()
    return tidy(spark.read.parquet(f"{path}/mart").select(PERIOD, "event_type", "n_events", "last_event", "value"))


@query(
    "month_layout",
    f"""
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date, o_custkey, 'six_and_current' AS window_name FROM orders
      WHERE o_orderdate >= date_trunc('month', DATE '{AS_OF}') - INTERVAL 6 MONTH AND o_orderdate < date_trunc('month', DATE '{AS_OF}') + INTERVAL 1 MONTH
    UNION ALL SELECT o_orderkey, CAST(o_orderdate AS DATE), o_custkey, 'last_24_months' FROM orders
      WHERE CAST(o_orderdate AS DATE) >= DATE '{AS_OF}' - INTERVAL 24 MONTH AND CAST(o_orderdate AS DATE) <= DATE '{AS_OF}'
    """,
)
def month_layout(spark, sf):
    path = _folder(spark, "orders")
    order = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"), "o_custkey")
    write_by_month(order, path, "order_date", ["o_custkey"])
    fact = spark.read.parquet(path)
    recent = filters.horizon(fact, "order_date", AS_OF, 6, fwd=1, month=MONTH).withColumn("window_name", F.lit("six_and_current"))
    years = filters.horizon(fact, "order_date", AS_OF, 24, month_aligned=False, closed=True, month=MONTH)
    return recent.unionByName(years.withColumn("window_name", F.lit("last_24_months"))).drop(MONTH)


@query(
    "damaged_records",
    """
    WITH r AS (
      SELECT event_id, CASE WHEN event_id % 7 = 0 THEN substring(props, 1, length(props) - 1)
                            WHEN event_id % 11 = 0 THEN replace(props, ': ', ': "no number ') || '"'
                            WHEN event_id % 13 = 0 THEN props || props
                            WHEN event_id % 17 <> 0 THEN props END AS record, props,
             event_id % 7 = 0 OR event_id % 11 = 0 OR event_id % 13 = 0 OR event_id % 17 = 0 AS rejected
      FROM events)
    SELECT event_id, CASE WHEN NOT rejected THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, rejected,
           CASE WHEN rejected THEN record END AS raw_record
    FROM r
    """,
)
def damaged_records(spark, sf):
    n, props = F.col("event_id"), F.col("props")
    # Cut short, of another type, two in one, and none at all.
    record = (
        F.when(n % 7 == 0, F.substring(props, F.lit(1), F.length(props) - 1))
        .when(n % 11 == 0, F.concat(F.replace(props, F.lit(": "), F.lit(': "no number ')), F.lit('"')))
        .when(n % 13 == 0, F.concat(props, props))
        .when(n % 17 != 0, props)
    )
    rows = table(spark, sf, "events").select("event_id", record.alias("raw_record"))
    valid, rejected = reshape.split_json(rows, "raw_record", "k bigint", {"k": "k"})
    whole = valid.select("event_id", "k", F.lit(False).alias("rejected"), F.lit(None).cast("string").alias("raw_record"))
    return whole.unionByName(rejected.select("event_id", F.lit(None).cast("bigint").alias("k"), F.lit(True).alias("rejected"), "raw_record"))
