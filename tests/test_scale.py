"""What the plans look like: skew, shuffles, pushdown, no Python and no cross joins."""

import re

import pytest
from pyspark.sql import functions as F

from pricewright.operators.joins import lookup, with_group
from pricewright.queries import registry
from pricewright.session import tune


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_no_python_no_cross_join_no_single_task(spark, sf_dir, name):
    plan = plan_of(registry.queries()[name](spark, sf_dir))
    # Two queries end in one maximum over everything, combined in the map tasks.
    one_value = {"latest_snapshot", "last_load"}
    for bad in ["Python", "CartesianProduct", "BroadcastNestedLoop", "SinglePartition"]:
        assert bad not in plan or (bad == "SinglePartition" and name in one_value), bad


def skewed(spark, n=120_000):
    """A third of the rows under one key."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000)
    return spark.range(0, n, numPartitions=12).select(key.alias("k"), (F.col("id") % 97).cast("double").alias("v"), F.lit("x" * 40).alias("pad"))


@pytest.fixture
def small_limits(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_key_is_split_when_the_group_is_joined_back(spark, small_limits):
    df = skewed(spark)
    out = with_group(df, ["k"], n=F.count(F.lit(1)))
    assert "skew=true" in final_plan(out)
    assert out.where("k = 0").select("n").distinct().first()[0] == df.where("k = 0").count()
    assert out.count() == 120_000


def test_hot_key_is_split_in_a_lookup(spark, small_limits):
    dim = spark.range(5000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("w"))
    out = lookup(skewed(spark), dim, {"k": "key"})
    assert "skew=true" in final_plan(out)
    assert out.where("w <> k * 2").count() == 0 and out.count() == 120_000


def test_group_is_combined_before_the_shuffle(spark, sf_dir):
    plan = plan_of(registry.queries()["share_of_parent"](spark, sf_dir))
    assert plan.count("partial_sum") >= 2


def test_filter_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(registry.queries()["scope_filter"](spark, sf_dir))
    assert re.search(r"PushedFilters: \[.*In\(p_brand", plan)
    item = next(line for line in plan.splitlines() if "FileScan" in line and "lineitem" in line)
    schema = item[item.index("ReadSchema") :]
    assert "l_extendedprice" not in schema and "l_shipdate" not in schema


def test_rollup_shuffles_its_detail_once(spark, sf_dir):
    """No detail row is copied per grain; coarse grains read the shuffles of finer ones."""
    plan = final_plan(registry.queries()["gross_profit_rollup"](spark, sf_dir)).split("== Initial Plan ==")[0]
    scans = [line for line in plan.splitlines() if "FileScan" in line and "lineitem" in line]
    assert len(scans) == 1 and "Expand" not in plan and plan.count("ReusedExchange") >= 3


def test_grains_come_from_the_nearest_finer_one():
    from pricewright.operators.margin import lattice
    from pricewright.plans.marts import MARGIN_GRAINS

    assert lattice([["a", "b"], ["b"], ["b", "c"], ["b"]]) == [
        (("a", "b", "c"), None), (("a", "b"), ("a", "b", "c")), (("b", "c"), ("a", "b", "c")), (("b",), ("a", "b")),
    ]
    made = dict(lattice(list(MARGIN_GRAINS.values())))
    assert [g for g, source in made.items() if source is None] == [tuple(sorted(MARGIN_GRAINS["order_item_month"]))]
    assert made[tuple(sorted(MARGIN_GRAINS["group"]))] == tuple(sorted(MARGIN_GRAINS["group_org"]))


def test_hierarchy_reads_its_texts_once(spark, sf_dir):
    plan = plan_of(registry.queries()["prefix_hierarchy"](spark, sf_dir))
    assert sum("FileScan" in line and "r_name" in line for line in plan.splitlines()) == 1


def test_hot_prefix_is_split(spark, small_limits):
    """All codes share their first level."""
    from pricewright.operators.reshape import prefix_hierarchy

    codes = spark.range(60_000).select(F.concat(F.lit("A"), F.lpad(F.col("id").cast("string"), 8, "0")).alias("c"))
    texts = codes.select("c", F.concat(F.lit("t"), "c").alias("t")).unionByName(spark.createDataFrame([("A", "top")], "c string, t string"))
    got = prefix_hierarchy(codes, "c", texts, "c", "t", [1, 5, 9])
    assert "skew=true" in final_plan(got)
    assert got.where("desc_1 = 'top' AND desc_2 IS NULL AND desc_3 = concat('t', c)").count() == 60_000


def test_home_branch_is_one_pass(spark):
    from pricewright.operators.kpi import home_branch

    rows = [(f"a{i % 3}" if i % 2 else "hot", f"b{i % 9}", float(i % 9 // 2)) for i in range(900)] + [("none", "b", None)]
    df = spark.createDataFrame(rows, "agent string, branch string, capacity double")
    got = home_branch(df, ["agent"], "branch", "capacity")
    plan = plan_of(got)
    assert "WindowGroupLimit" in plan and "Join" not in plan
    assert sorted(r.branch for r in got.where("agent = 'hot'").collect()) == ["b8"]
    assert got.where("agent = 'none'").count() == 0


@pytest.mark.parametrize("name", ["own_price_ref", "forecast_allocation", "next_month_variance"])
def test_each_source_role_is_scanned_once(spark, sf_dir, name):
    plan = plan_of(registry.queries()[name](spark, sf_dir))
    fact = "lineitem" if name == "own_price_ref" else "orders"
    scans = [line for line in plan.splitlines() if "FileScan" in line and f"{fact}.parquet" in line]
    assert len(scans) <= {"own_price_ref": 2, "forecast_allocation": 2, "next_month_variance": 3}[name]


def test_shuffles_start_as_fine_as_the_volume_needs(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    try:
        tune(spark, shuffle_bytes=10 * 2**40)
        assert int(spark.conf.get(name)) == 81_920
        tune(spark, shuffle_bytes=1)
        assert int(spark.conf.get(name)) == 8
    finally:
        spark.conf.unset(name)


# Scans of the largest table per query: one, or more where the detail, its aggregate and the aggregate's parent are joined.
FACT_SCANS = {
    "price_waterfall": 1, "dispersion_map": 1, "apportion_cost": 3, "premium_vs_competitor": 2, "gross_profit_rollup": 1, "volume_fact": 1,
    "filter_catalog": 1, "product_dimension": 3,
}


@pytest.mark.parametrize("name", sorted(FACT_SCANS))
def test_fact_is_scanned_once(spark, sf_dir, name):
    """Counted in the executed plan with broadcasts off, the shape large tables get; reused exchanges are not scans."""
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final_plan(registry.queries()[name](spark, sf_dir)).split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    scans = [line for line in plan.splitlines() if "FileScan" in line and "l_orderkey" in line + "l_partkey" and "l_" in line]
    assert len(scans) <= FACT_SCANS[name], len(scans)


def test_orders_are_scanned_once_for_all_windows(spark, sf_dir):
    assert plan_of(registry.queries()["rolling_horizon"](spark, sf_dir)).count("FileScan") == 1


def test_scope_reaches_the_billing_files(spark, tmp_path):
    """Organisation and billing type are pushed to the scan."""
    from pricewright.plans import marts

    names = [*marts.BILLING_TEXT, *marts.BILLING_NUMBERS, "BillingType"]
    spark.createDataFrame([("x",) * len(names)], ", ".join(f"`{n}` string" for n in names)).write.parquet(str(tmp_path / "billing"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = plan_of(marts.scoped_billing(spark.read.parquet(str(tmp_path / "billing"))))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters: ["):]
    assert "In(SalesOrg" in pushed and "EqualTo(BillingType,ZF2B)" in pushed


def test_stored_facts_meet_without_a_shuffle(spark, sf_dir, small_limits):
    got = registry.queries()["waterfall_from_stored_facts"](spark, sf_dir)
    plan = final_plan(got).split("== Initial Plan ==")[0]
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2


def test_bucketed_fact_of_another_session(spark, tmp_path):
    from pricewright.sources.writers import open_bucketed, write_bucketed

    df = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    write_bucketed(df, "fact_written", str(tmp_path / "f"), ["k"], 4)
    other = spark.newSession()
    tune(other)
    sums = open_bucketed(other, "fact_again", str(tmp_path / "f"), ["k"], 4).groupBy("k").agg(F.sum("id").alias("s"))
    assert "Exchange" not in final_plan(sums) and sums.count() == 50


def test_allocation_reads_its_sales_once(spark, tmp_path):
    from pricewright.operators.forecast import allocate_forecast

    sold = [("o", "st", f"b{i % 4}" if i % 5 else "?", f"t{i % 3}", float(i)) for i in range(100)]
    spark.createDataFrame(sold, "org string, st string, br string, txt string, vol double").write.parquet(str(tmp_path / "sold"))
    plan = spark.createDataFrame([("o", "st", "p2", 5.0), ("o", "st", "p1", 6.0), ("o", "none", "p3", 1.0)], "org string, st string, txt string, plan double")
    sites = spark.createDataFrame([("st", f"b{i}") for i in range(5)], "st string, br string")
    got = allocate_forecast(plan, spark.read.parquet(str(tmp_path / "sold")), sites, ["org", "st"], "st", "br", "plan", "vol", unknown="?", text="txt")
    assert {(r.br, r.txt) for r in got.collect()} == {("b0", "p1"), ("b1", "p1"), ("b2", "p1"), ("b3", "p1"), ("b4", "p1"), ("?", "p1")}
    plan = final_plan(got).split("== Initial Plan ==")[0]
    assert sum("FileScan" in line for line in plan.splitlines()) == 1

def shuffled_by(df):
    """The keys of every shuffle that is run, reused ones left out."""
    plan = final_plan(df).split("== Initial Plan ==")[0]
    return [line.split("hashpartitioning(")[1] for line in plan.splitlines() if " Exchange hashpartitioning(" in line and "Reused" not in line]


def test_fine_grains_share_one_shuffle(spark):
    """Grains that hold the placing columns are summed where these place them, to the same sums as without, at any size of number."""
    from pricewright.operators.margin import margin_rollup

    x = F.when(F.col("id") % 7 == 0, F.lit(-9e18)).when(F.col("id") % 11 == 0, F.lit(None)).when(F.col("id") % 13 == 0, F.lit("NaN").cast("double")).otherwise(F.col("id") / 7 - 20)
    rows = spark.range(400).select((F.col("id") % 90).alias("o"), F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("i"), (F.col("id") % 5).alias("m"), (F.col("id") % 3).alias("p"), x.alias("x"), (F.col("id") % 5 + 0.1).alias("w"))
    grains = {"month_item": ["m", "o", "i"], "item": ["o", "i"], "month_part": ["m", "p"]}
    one, other = (margin_rollup(rows, grains, ["x"], {"mean": ("x", "w")}, placed_by=p) for p in (["o", "i"], None))
    assert one.columns == other.columns and sorted(map(str, one.collect())) == sorted(map(str, other.collect()))
    assert [len(shuffled_by(df)) for df in (one, other)] == [3, 4]


def test_rollup_shuffles_order_items_once(spark, sf_dir):
    keys = shuffled_by(registry.queries()["gross_profit_rollup"](spark, sf_dir))
    assert sum("l_linenumber" in k and "l_partkey" not in k for k in keys) == 1, keys


def test_margin_view_is_cut_to_the_months_of_the_profit(spark, sf_dir):
    plan = plan_of(registry.queries()["margin_marts"](spark, sf_dir))
    assert re.search(r"Filter.*trunc\(bill_date#\d+, month\) >= 1999-07-01", plan)


def test_lookups_that_grow_are_not_broadcast(spark, sf_dir):
    """Limits and product groups of every material meet the open orders by a shuffle, whatever their files are estimated at; a few cities are broadcast."""
    plan = plan_of(registry.queries()["wallet_fact"](spark, sf_dir))
    joins = [line for line in plan.splitlines() if "Join [" in line]
    assert sum("SortMergeJoin" in line and "MATERIAL_KEY" in line for line in joins) == 2
    assert sum("BroadcastHashJoin" in line and "CITY_KEY" in line for line in joins) == 1
    assert sum("SortMergeJoin [_order#" in line for line in joins) <= 2 and plan.count("REBALANCE") == 3


def test_shuffled_side_keeps_its_hint_and_splits_hot_keys(spark, small_limits):
    from pricewright.operators.joins import one_per_key, shuffled

    dim = one_per_key(spark.range(5000).select(F.col("id").alias("key"), (F.col("id") * 2).alias("w")), ["key"])
    for limit in ("-1", "100m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        out = lookup(skewed(spark), shuffled(dim), {"k": "key"})
        plan = final_plan(out).split("== Initial Plan ==")[0]
        assert "skew=true" in plan and "BroadcastHashJoin" not in plan
        assert out.where("w <> k * 2").count() == 0 and out.count() == 120_000
