"""Sizes of tasks, and what the joins of large queries shuffle."""

import pytest
from pyspark.sql import functions as F

from pricewright.queries import jobs, margins, pricing
from pricewright.queries.tables import SCHEMAS
from pricewright.session import FINE_CONF, MB, tune

INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture
def own_conf(spark):
    keys = [*FINE_CONF, INITIAL, "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionFactor"]
    old = {k: spark.conf.get(k, None) for k in keys}
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def size(spark, key):
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))


def test_tasks_stay_as_small_as_wide_sums_need(spark, own_conf):
    for key in FINE_CONF:
        spark.conf.set(key, "512MB")
    tune(spark, shuffle_bytes=16 * 2**30)
    assert int(spark.conf.get(INITIAL)) == 256 and all(size(spark, k) == 512 * MB for k in FINE_CONF)
    tune(spark, shuffle_bytes=16 * 2**30, scan_bytes=2**30)
    assert {k: size(spark, k) for k in FINE_CONF} == FINE_CONF
    # A smaller number of the session is kept; a very large scan keeps to a number of tasks.
    key = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(key, "1m")
    tune(spark, scan_bytes=2**30)
    assert size(spark, key) == MB
    spark.conf.set(key, "128m")
    tune(spark, scan_bytes=2**42)
    assert size(spark, key) == 64 * MB


def test_registered_queries_on_tables_ask_for_it(spark, own_conf, sf_dir):
    import __spark_entry__

    for key in FINE_CONF:
        spark.conf.set(key, "512MB")
    __spark_entry__.queries()["unit_price"](spark, sf_dir)
    assert {k: size(spark, k) for k in FINE_CONF} == FINE_CONF


def tables(spark, path, n):
    """Orders of two priorities, one line each; every part is in lines of two centres and months."""
    order = spark.range(n).select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 50).alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit(1.0).alias("o_totalprice"),
        F.lit("2001-01-01").cast("timestamp_ntz").alias("o_orderdate"), F.when(F.col("id") % 20 == 0, "5-LOW").otherwise("2-HIGH").alias("o_orderpriority"),
    )
    item = spark.range(n).select(
        F.col("id").alias("l_orderkey"), (F.col("id") % 40).alias("l_partkey"), (F.col("id") % 2).alias("l_suppkey"), F.lit(1).alias("l_linenumber"),
        (F.col("id") % 9 + 1).cast("double").alias("l_quantity"), F.lit(100.0).alias("l_extendedprice"), F.lit(0.0).alias("l_discount"), F.lit(0.0).alias("l_tax"),
        F.lit("N").alias("l_returnflag"), F.lit("F").alias("l_linestatus"), F.lit("2001-02-01").cast("timestamp_ntz").alias("l_shipdate"),
    )
    for name, df in {"orders": order, "lineitem": item}.items():
        df.selectExpr(*[f"CAST({c.split()[0]} AS {c.split()[1]}) AS {c.split()[0]}" for c in SCHEMAS[name].split(", ")]).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_orders_of_one_term_are_split(spark, own_conf, tmp_path):
    path = tables(spark, tmp_path, 60_000)
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }.items():
        spark.conf.set(key, value)
    got = pricing.price_at_terms(spark, path)
    plan = final_plan(got)
    assert "skew=true" in plan
    # The lines are shuffled once, by their order.
    assert not any("Exchange" in line and "term_key" in line and "l_extendedprice" in line for line in plan.splitlines())
    assert {r[0]: r[1] for r in got.groupBy("price_terms").count().collect()} == {round(100 / 1.06, 3): 60_000}


def test_rates_are_shuffled_once(spark, own_conf, tmp_path):
    path = tables(spark, tmp_path, 2_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    got = margins.apportion_cost(spark, path)
    plan = final_plan(got).splitlines()
    # Only the few parents are rebalanced, and no sum of costs travels with the items.
    assert sum("REBALANCE" in line for line in plan) == 1
    assert not any("keys=[period" in line and "l_partkey" in line and "cost" in line for line in plan)
    assert sum(1 for r in got.collect() if r.apportioned_cost < 0) == 2_000


def test_buckets_go_by_the_size_of_the_tables(spark, sf_dir, monkeypatch):
    assert jobs.buckets(spark, sf_dir) == 8
    monkeypatch.setattr(jobs, "input_bytes", lambda *_: 6 * 2**30)
    assert jobs.buckets(spark, sf_dir) == 384
