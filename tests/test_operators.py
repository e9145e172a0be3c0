"""Operators on hand-made edge rows."""

from datetime import date, datetime

from conftest import rows
from pyspark.sql import functions as F

from pricewright.functions import dates
from pricewright.operators import (
    catalog, filters, forecast, joins, kpi, latest, ledger, margin, price, reshape,
)


# --- filters ---------------------------------------------------------------------------------

def test_scope_filter_keeps_nulls_only_on_request(spark):
    df = spark.createDataFrame([("XTARUGOX",), ("B_4",), (None,)], "g string")
    assert rows(filters.scope_filter(df, "g", ["TARUGO"])) == [("XTARUGOX",)]
    assert len(rows(filters.scope_filter(df, "g", ["TARUGO"], keep_null=True))) == 2
    assert rows(filters.scope_filter(df, "g", ["B_4"], exact=True)) == [("B_4",)]
    assert rows(filters.exclude_terms(df, "g", ["TARUGO"], keep_null=False)) == [("B_4",)]


def test_exclude_only_if_all(spark):
    df = spark.createDataFrame([("BR x",), ("BR GP",), ("x",), (None,)], "g string")
    assert rows(filters.exclude_terms(df, "g", ["BR", "GP"], keep_null=False)) == [("x",)]
    assert rows(filters.exclude_terms(df, "g", ["BR", "GP"], keep_null=False, only_if_all=True)) == [("BR x",), ("x",)]


def test_horizon_bounds(spark):
    days = [date(2019, 7, 31), date(2019, 8, 1), date(2020, 1, 31), date(2020, 2, 1), date(2020, 2, 29), date(2020, 3, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d date")

    def kept(**kw):
        return [r[0] for r in filters.horizon(df, "d", "2020-02-29", **kw).orderBy("d").collect()]

    assert kept(back=6) == days[1:3]
    assert kept(back=6, fwd=1) == days[1:5]
    assert kept(back=6, closed=True) == days[1:5]
    assert kept(back=6, month_aligned=False, closed=True) == days[2:5]  # from 29 August


def test_quarantine_parts_make_the_whole(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (2, None), (None, None)], "x int, y string")
    good, bad = filters.quarantine(df, ["x", "y"])
    assert rows(good) == [(1, "a")] and bad.count() == 3


# --- latest -------------------------------------------------------------------------------------

def test_latest_puts_null_load_times_last_and_breaks_ties(spark):
    df = spark.createDataFrame([("k", None, 9), ("k", 5, 1), ("k", 5, 2), ("n", None, 3)], "k string, t int, id int")
    got = latest.latest_per_key(df, ["k"], [latest.newest("t"), F.col("id").desc()])
    assert rows(got, "k") == [("k", 5, 2), ("n", None, 3)]


def test_latest_cuts_rows_before_the_shuffle(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    got = latest.latest_per_key(df, ["user_id"], [F.col("event_id").desc()])
    plan = got._jdf.queryExecution().executedPlan().toString()
    limit, shuffle = plan.rindex("WindowGroupLimit"), plan.index("hashpartitioning")
    assert limit > shuffle  # the partial limit stands below the exchange


def test_union_extracts_newest_wins(spark):
    old = spark.createDataFrame([("1", 1, "old"), ("2", 5, "old")], "k string, t int, v string")
    new = spark.createDataFrame([("1", 2, "new", 2020), ("2", 5, "tie", 2020)], "K string, T int, V string, year int")
    got = latest.union_extracts([old, new], ["K"], [latest.newest("T"), F.col("V").desc()])
    assert rows(got.select("K", "V"), "K") == [("1", "new"), ("2", "tie")]


def test_renames_and_last_load(spark):
    df = spark.createDataFrame([(1, 2), (3, 1)], "a int, t int")
    assert latest.upper_names(df).columns == ["A", "T"]
    assert rows(latest.last_load(df, "t")) == [(2,)] and rows(latest.latest_snapshot(df, "t")) == [(1, 2)]


def test_mode_and_ties(spark):
    df = spark.createDataFrame([("m", "a"), ("m", "b"), ("m", "b"), ("t", "y"), ("t", "x"), ("t", None)], "k string, v string")
    assert rows(latest.mode_per_key(df, ["k"], "v"), "k") == [("m", "b", 2), ("t", "x", 1)]
    tied = spark.createDataFrame([("a", 1), ("a", 3), ("a", 3)], "k string, v int")
    assert latest.latest_with_ties(tied, ["k"], "v").count() == 2


# --- joins -----------------------------------------------------------------------------------------

def test_overlay_match_with_null_no_match(spark):
    df = spark.createDataFrame([(1, "own"), (2, "own"), (3, "own"), (None, "own")], "id int, v string")
    dim = spark.createDataFrame([(1, "dim"), (2, None)], "k int, w string")
    keep = joins.overlay(df, dim, {"id": "k"}, {"v": "w"})
    assert [r[1] for r in rows(keep.select("id", "v"), F.col("id").asc_nulls_last())] == ["dim", "own", "own", "own"]
    force = joins.overlay(df, dim, {"id": "k"}, {"v": "w"}, null_wins=True)
    assert [r[1] for r in rows(force.select("id", "v"), F.col("id").asc_nulls_last())] == ["dim", None, "own", "own"]


def test_full_coalesce_keeps_rows_without_key(spark):
    a = spark.createDataFrame([(1, "a"), (None, "na")], "id int, nm string")
    b = spark.createDataFrame([(1, "b", 10), (2, "b2", 20), (None, "nb", 30)], "id int, nm string, x int")
    got = rows(joins.full_coalesce(a, b, "id", ["nm"]))
    assert sorted(got, key=str) == sorted([(1, 10, "a"), (2, 20, "b2"), (None, None, "na"), (None, 30, "nb")], key=str)


def test_two_pass_lookup(spark):
    df = spark.createDataFrame([("x", "y"), ("q", "y"), ("q", "q")], "a string, b string")
    dim = spark.createDataFrame([("x", "one"), ("y", "two")], "k string, v string")
    got = joins.two_pass_lookup(df, dim, {"a": "k"}, {"b": "k"}, "v", "out")
    assert sorted(rows(got.select("a", "b", "out")), key=str) == [("q", "q", None), ("q", "y", "two"), ("x", "y", "one")]


# --- reshape -----------------------------------------------------------------------------------------

def test_prefix_hierarchy_all_lengths(spark):
    code = "A01BCDEF0123456789"
    lengths = [1, 3, 5, 8, 11, 14, 18]
    texts = spark.createDataFrame([(code[:n], f"level {n}") for n in lengths if n != 8], "p string, t string")
    got = reshape.prefix_hierarchy(spark.createDataFrame([(code,)], "c string"), "c", texts, "p", "t").first()
    assert [got[f"desc_{i}"] for i in range(1, 8)] == [None if n == 8 else f"level {n}" for n in lengths]


def test_uom_and_role_pivot(spark):
    units = spark.createDataFrame(
        [("m", "KG", 1.0, 2.0), ("m", "KG", 3.0, 2.0), ("m", "ROL", 5.0, 0.0), ("n", "ZZ", 1.0, 1.0)],
        "matnr string, meinh string, umrez double, umren double",
    )
    got = rows(reshape.uom_pivot(units, labels=["KG", "ROL"]), "matnr")
    assert got == [("m", 1.0, 0.0), ("n", 0.0, 0.0)]
    partners = spark.createDataFrame([(1, "AG", 10), (1, "AG", 21), (1, "XX", 5)], "k int, role string, n int")
    assert rows(reshape.role_pivot(partners, ["k"], "role", "n", {"AG": "A", "RE": "B"})) == [(1, 15, 0)]


def test_unpivot_round_trip(spark):
    wide = spark.createDataFrame([("a_1", 5.0, None, -2.0)], "agent string, G1 double, G2 double, G3 double")
    wide = wide.withColumn("key", reshape.target_key(F.col("agent"), F.lit("CG"), F.lit("SP"), F.lit("Filial Sul")))
    tall = reshape.unpivot_measures(wide.drop("agent"), ["key"], ["G1", "G2", "G3"], "grp", "target")
    got = rows(reshape.parse_target_key(tall, "key", True).drop("key"), "grp")
    assert got == [("G1", 5.0, "A_1", "CG", "SP", "FILIAL SUL"), ("G2", 0.0, "A_1", "CG", "SP", "FILIAL SUL"), ("G3", 0.0, "A_1", "CG", "SP", "FILIAL SUL")]
    flat = spark.createDataFrame([(1.0,)], "G double").withColumn("key", reshape.target_key(F.lit("z9"), F.lit("IN"), F.lit("MG")))
    row = reshape.parse_target_key(flat, "key", False).first()
    assert (row.agent_cod, row.org_short, row.state, row.branch) == ("Z9", "IN", "MG", "Vendas MG")


# --- prices -------------------------------------------------------------------------------------------

def test_unit_price_most_specific_first_and_zero_factor(spark):
    df = spark.createDataFrame(
        [("METRO2",), ("METRO",), ("OUTRO",), ("ROLO",), (None,)], "u string"
    ).selectExpr("u", "12.0D AS p", "3 AS ZBA", "0 AS ROL", "1 AS ST", "1 AS TO", "1 AS KI", "1 AS ZFX", "4 AS M2", "6 AS M", "1 AS ZCT", "1 AS ZUN")
    assert [r[0] for r in df.select(price.unit_price("p", "u")).collect()] == [3.0, 2.0, 12.0, None, 12.0]


def test_price_at_terms(spark):
    df = spark.createDataFrame([(110.0, "0,10"), (100.0, None), (100.0, "x")], "p double, t string")
    assert [r[0] for r in df.select(price.price_at_terms("p", "t")).collect()] == [100.0, None, None]


def test_cascade_runs_on_the_running_price(spark):
    df = spark.createDataFrame([(100.0, -0.1, -5.0, None)], "l double, r double, a double, n double")
    steps = [price.Step("one", "r"), price.Step("two", "a", absolute=True), price.Step("three", "n")]
    row = price.discount_cascade(df, "l", steps).first()
    assert (row.one, row.price_one, row.two, row.price_two, round(row.two_share, 6)) == (-10.0, 90.0, -5.0, 85.0, -0.055556)
    assert row.price_three is None


def test_policy_deviation_threshold(spark):
    df = spark.createDataFrame([(2.0, 2.0), (3.0, 2.0), (-3.0, -3.0)], "a double, b double")
    cols = price.policy_deviation(["a", "b"], F.lit(1.5), F.lit(10.0))
    assert rows(df.select(cols["policy_deviation"], cols["policy_deviation_value"])) == [(0.0, 0.0), (3.5, 35.0), (4.5, 45.0)]


def test_billed_order_price_depends_on_manual_conditions(spark):
    df = spark.createDataFrame(
        [(100.0, 1.0, 0.0, 2.0, 0.0, 4.0, 8.0), (100.0, 1.0, -3.0, 2.0, 0.0, 4.0, 8.0)],
        "rbv double, zsu2 double, zd13 double, zd06 double, zd14 double, zeaf double, zeb1 double",
    )
    assert [r[0] for r in df.select(price.billed_order_price()).collect()] == [89.0, 104.0]


def test_approve_band_edges(spark):
    data = [("k", 2.0), ("k", 2.2), ("k", None), ("k", 50.0), ("none", 1.0), ("edge", 10.0), ("edge", 8.0)]
    got = {
        (r.k, r.p): (r.pre_approved, r.sample_mean, r.approved)
        for r in price.approve_band(spark.createDataFrame(data, "k string, p double"), ["k"], "p").collect()
    }
    assert got[("k", 2.0)] == (True, 2.1, True)  # band 1.89 .. 2.31
    assert got[("k", None)] == (False, 2.1, False)
    assert got[("k", 50.0)][2] is False
    assert got[("none", 1.0)] == (False, None, False)
    assert got[("edge", 10.0)] == (True, 9.0, False)  # band 8.1 .. 9.9
    loose = price.approve_band(spark.createDataFrame(data, "k string, p double"), ["k"], "p", null_approved=True)
    assert loose.where("p IS NULL").first().approved is True


def test_waterfall_without_margin(spark):
    names = ["zd01", "zd02", "zd03", "zd04", "zd05", "zd06", "zd13", "zd14", "zeaf", "zeb1", "zeb2", "zsu2", "icms", "cofins", "pis", "other_taxes", "bx95"]
    base = spark.createDataFrame([("o", 10.0, 100.0), ("o", 10.0, 200.0)], "k string, quantity_ton double, list_price double")
    df = base.withColumns({n: F.lit(-1.0) for n in names})
    row = price.price_waterfall(df, ["k"]).first()
    # 150 - 2*2 - 6*2 - 4*2, taxes 10, per 20 tons
    assert (row.list_price, row.segment_price, row.full_customer_price) == (7.5, 7.3, 6.7)
    assert (row.rbv_waterfall, row.rlv_waterfall, row.gross_profit_waterfall) == (6.3, 5.8, 5.8)


def test_wallet_backlog(spark):
    cols = price.wallet_backlog(F.lit(100.0), F.lit(5.0), F.lit(10.0), F.lit(1000.0))
    assert rows(spark.range(1).select(*cols.values())) == [(50.0, 500.0)]


# --- margins -------------------------------------------------------------------------------------------

def test_every_grain_adds_up_to_the_same_total(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("flag"), "l_linestatus", "l_suppkey", "l_quantity"
    )
    grains = {"all": ["flag", "l_linestatus", "l_suppkey"], "two": ["flag", "l_linestatus"], "one": ["flag"]}
    got = margin.margin_rollup(df, grains, ["l_quantity"])
    totals = {r[0]: r[1] for r in got.groupBy("grain").agg(F.sum("l_quantity")).collect()}
    assert set(totals) == set(grains) and len(set(totals.values())) == 1
    # a null key in the data is a row of its own, not the rolled-up one
    assert got.where("grain = 'one'").count() == 3


def test_share_guard_and_apportioned_pool(spark):
    volume = spark.createDataFrame([("p", "a", 3.0), ("p", "b", 1.0), ("z", "a", 0.0), ("n", "a", -2.0)], "p string, i string, v double")
    cost = spark.createDataFrame([("p", 100.0), ("p", None), ("z", 50.0), ("n", 10.0)], "p string, c double")
    rates = margin.cost_rates(cost, volume, ["p"], ["i"], "c", "v")
    got = {(r.p, r.i): (r.share, r.item_cost, r.unit_cost) for r in rates.collect()}
    assert got[("p", "a")] == (0.75, 75.0, 25.0)
    assert got[("z", "a")] == (0.0, 0.0, None) and got[("n", "a")][0] == 0.0
    spread = margin.apportion_cost(volume, rates, ["p", "i"], "v")
    assert spread.where("p = 'p'").agg(F.sum("apportioned_cost")).first()[0] == -100.0
    assert spread.where("p = 'z'").first().apportioned_cost == 0.0


def test_gross_profit_null_account_gives_null(spark):
    df = spark.createDataFrame([("k", "x", 1000.0, 5.0, None), ("j", "x", 500.0, 5.0, 1.0)], "k string, d string, q double, s double, t double")
    stacks = {
        "GROSS_SALES": "+s", "SALES_TAX_DISCOUNT": "-t", "COGS_TOTAL": "-s", "FREIGHT": "-s", "SHIP_DEL_LOAD_C_C": "-s",
        "PORT_EXPENSES": "+s", "COGS_ADJUSTMENTS": "-s", "COMISSION_TO_AGENTS": "+s",
    }
    got = {r.k: r for r in margin.gross_profit(df, ["k"], ["d"], stacks, quantity="q").collect()}
    assert got["k"].NET_SALES is None and got["j"].NET_SALES == 4.0
    assert got["j"].GROSS_PROFIT_BW == 4.0 - 5 - 5 - 5 + 5 - 5 + 5 and got["j"].QUANTITY_TON == 0.5


def test_trailing_means(spark):
    df = spark.createDataFrame([("k", 7, 3.0), ("k", 8, 6.0), ("k", 1, 9.0), ("k", 12, 99.0)], "k string, m int, v double")
    got = margin.trailing_means(df, ["k"], "m", ["v"], {"3": ([7, 8, 9], 3), "y": ([1, 7, 8, 9], 9)}).first()
    assert (got.v, got.avg_v_3, got.avg_v_y) == (18.0, 3.0, 2.0)


# --- forecasts -------------------------------------------------------------------------------------------

def test_allocation_keeps_the_plan_of_each_state(spark):
    plan = spark.createDataFrame([("o", "S1", 100.0), ("o", "S2", 90.0), ("o", "S3", 10.0), ("o", "S4", 7.0)], "org string, st string, plan double")
    sold = spark.createDataFrame(
        [("o", "S1", "b1", 30.0), ("o", "S1", "b2", 10.0), ("o", "S1", "?", 5.0), ("x", "S1", "b1", 8.0)],
        "org string, st string, br string, vol double",
    )
    sites = spark.createDataFrame([("S1", "b1"), ("S1", "b2"), ("S1", "b3"), ("S2", "c1"), ("S2", "c2"), ("S4", None)], "st string, br string")
    got = forecast.allocate_forecast(plan, sold, sites, ["org", "st"], "st", "br", "plan", "vol", unknown="?")
    result = {(r.org, r.st, r.br): (r.pv_budget, r.perc_vol, r.pv_done) for r in got.collect()}
    assert result == {
        ("o", "S1", "b1"): (100.0, 0.75, 75.0), ("o", "S1", "b2"): (100.0, 0.25, 25.0), ("o", "S1", "b3"): (0.0, 0.0, 0.0),
        ("o", "S1", "?"): (0.0, 0.0, 0.0), ("o", "S2", "c1"): (90.0, 0.0, 45.0), ("o", "S2", "c2"): (90.0, 0.0, 45.0),
        ("x", "S1", "b1"): (0.0, 1.0, 0.0),
    }


def test_next_month_variance_over_the_year_end_and_gap(spark):
    d = [date(2019, 12, 1), date(2020, 1, 1), date(2020, 3, 1)]
    plan = spark.createDataFrame([("k", d[0], 10.0), ("k", d[1], 25.0), ("k", d[2], 5.0)], "k string, m date, volume double")
    actual = spark.createDataFrame([("k", d[0], 1.0, 2.0, 30.0), ("k", d[1], 1.0, 2.0, 10.0)], "k string, m date, qty double, rbv double, rlv double")
    budget = spark.createDataFrame([("k", d[0], 1.0, 1.0), ("k", d[2], 2.0, 2.0), ("only", d[0], 3.0, 3.0)], "k string, m date, volume double, rlv double")
    got = rows(
        forecast.forecast_vs_actual(plan, actual, budget, ["k"], "m").select("m", "volume_next", "volume_diff", "rlv_diff", "rlv_diff_mean", "volume_budget"), "m"
    )
    assert got == [(d[0], 25.0, 15.0, 20.0, 20.0, 1.0), (d[2], None, None, None, 20.0, 2.0)]


def test_freeze_splice_and_backfill(spark):
    old = spark.createDataFrame([("2020-01", 1), ("2020-02", 2)], "m string, v int")
    new = spark.createDataFrame([("2020-01", 9), ("2020-02", 8)], "m string, v int")
    assert rows(forecast.freeze_history(old, new, "m", "2020-02"), "m") == [("2020-01", 1), ("2020-02", 8)]
    future = spark.createDataFrame([("2020-02", 7), ("2020-03", 7)], "m string, v int")
    got = forecast.splice_forecast(old, new, future, "m", "2020-02")
    assert rows(got, "m") == [("2020-01", 1), ("2020-02", 8), ("2020-03", 7)]
    targets = spark.createDataFrame([("a", 5), ("a", 1), ("b", None)], "k string, target int")
    collects = spark.createDataFrame([("a",), ("c",), ("c",)], "k string")
    assert rows(forecast.backfill_zero_targets(targets, collects, ["k"]), "k") == [("a", 6), ("b", 0), ("c", 0)]


# --- indicators ----------------------------------------------------------------------------------------

def test_run_rate_buckets(spark):
    data = [("cur", date(2020, 2, 3), True)] * 4 + [("past", date(2020, 1, 3), True), ("none", date(2020, 1, 3), False)]
    collects = spark.createDataFrame(data, "b string, d date, ok boolean")
    capacity = spark.createDataFrame([("cur", date(2020, 2, 1), 10.0), ("past", date(2020, 1, 1), 0.0)], "b string, month date, capacity double")
    got = {r.b: (r.n_approved, r.running, r.status) for r in kpi.run_rate(collects, capacity, "b", "d", "ok", "2020-02-11").collect()}
    assert got["cur"] == (4, (4 / 10 * 19 + 4) / 10, "Acima ou igual a 100%")
    assert got["past"] == (1, None, "Entre 80% e 100%")
    assert got["none"][0] == 0


def test_home_branch_keeps_ties(spark):
    df = spark.createDataFrame([("a", "x", 5), ("a", "y", 5), ("a", "z", 1)], "a string, b string, c int")
    assert rows(kpi.home_branch(df, ["a"], "b", "c").select("b"), "b") == [("x",), ("y",)]


def test_std_of_one_row_is_zero(spark):
    df = spark.createDataFrame([("a", 3.0, True), ("b", 1.0, True), ("b", 3.0, True), ("b", 99.0, False), ("c", 1.0, False)], "k string, p double, ok boolean")
    got = {r.k: r.price_std for r in kpi.price_std(df, ["k"], "p", "ok").collect()}
    assert got == {"a": 0.0, "b": 1.414, "c": None}


def test_realised_vs_zero_target(spark):
    targets = spark.createDataFrame([("a", 0), ("b", 2), ("c", 4)], "k string, target int")
    collects = spark.createDataFrame([("b",), ("b",), ("c",)], "k string")
    got = rows(kpi.realised_vs_target(targets, collects, ["k"]), "k")
    assert got == [("a", 0, 0, None, "Sem Preço", None), ("b", 2, 2, 1.0, "1,0", 1), ("c", 4, 1, 0.25, "0,25", 0)]


def test_own_price_weeks_and_zero_days(spark):
    billing = spark.createDataFrame(
        [("k", "BRCG", date(2021, 1, 1), date(2020, 6, 1), 10.0), ("k", "BRCG", date(2021, 1, 3), date(2020, 6, 1), 20.0),
         ("k", "BRDI", date(2021, 2, 1), date(2021, 1, 3), 60.0)],
        "k string, org string, billed date, ordered date, p double",
    )
    collects = spark.createDataFrame([("k", date(2021, 1, 1)), ("k", date(2021, 1, 2)), ("k", date(2021, 1, 2))], "k string, ref_date date")
    got = rows(kpi.own_price_ref(billing, collects, ["k"], "p", "billed", "ordered", F.col("org") == "BRDI"), "ref_date", "billing_date")
    assert got == [
        ("k", date(2021, 1, 1), date(2021, 1, 1), 2020, 53, 1, 10.0, 30.0),
        ("k", date(2021, 1, 2), date(2021, 1, 2), 2020, 53, 0, 0.0, 0.0),
        ("k", date(2021, 1, 3), date(2021, 1, 3), 2020, 53, 2, 40.0, 30.0),
        ("k", date(2021, 1, 3), date(2021, 2, 1), 2020, 53, 2, 40.0, 30.0),
    ]


def test_premium_sample_floor(spark):
    def block(key, competitors):
        own = [(key, "BRCG", True, 12.0, 11.0, 6.0), (key, "BRDI", True, 1.0, 1.0, 4.0)]
        return own + [(key, "BRCG", False, 10.0, 0.0, 0.0)] * competitors

    df = spark.createDataFrame(block("ten", 10) + block("eleven", 11) + block("none", 0), "k string, org string, own boolean, p double, pol double, net double")
    got = {r.k: r for r in kpi.premium(df, ["k"], "org", F.col("own"), "p", "pol", "net").where("org = 'BRCG' AND own").collect()}
    assert got["ten"].practiced_premium_sample is None and round(got["ten"].policy_premium, 6) == 0.1
    assert round(got["eleven"].practiced_premium_sample, 6) == 0.2 and got["eleven"].policy_premium is None
    assert round(got["eleven"].premium_deviation, 6) == 0.17 and got["eleven"].mark_up == 0.5
    assert got["none"].n_competitor == 0 and got["none"].practiced_premium is None


# --- ledger and catalog ------------------------------------------------------------------------------------

def test_ledger_is_idempotent_and_expires(spark):
    day = date(2020, 1, 20)
    old = spark.createDataFrame(
        [(1, date(2020, 1, 13), None, "Não"), (2, date(2020, 1, 12), None, "Não"), (3, date(2020, 1, 12), "Sim", "Não"), (9, day, "Sim", "Não")],
        "id int, date date, approved_manually string, approved_automatically string",
    )
    batch = spark.createDataFrame([(10, day), (11, day)], "id int, date date")
    reviews = spark.createDataFrame(
        [(1, "Não", datetime(2020, 1, 14)), (1, "Sim", datetime(2020, 1, 15)), (77, "Sim", datetime(2020, 1, 15)), (3, "Não", datetime(2020, 1, 15))],
        "id int, verdict string, reviewed_at timestamp",
    )
    once = ledger.ledger_merge(old, batch, reviews, day)
    expected = [
        (1, date(2020, 1, 13), "Sim", "Não"),  # exactly 7 days old: the newest review counts
        (2, date(2020, 1, 12), "Não", "Não"),  # older and unreviewed: rejected
        (3, date(2020, 1, 12), "Sim", "Não"),  # older: the late review changes nothing
        (10, day, None, "Não"), (11, day, None, "Não"),
    ]
    columns = ["id", "date", "approved_manually", "approved_automatically"]
    assert rows(once.select(*columns), "id") == expected
    assert rows(ledger.ledger_merge(once, batch, reviews, day).select(*columns), "id") == expected
    assert [r[0] for r in rows(ledger.worklist(once, day, []).select("id"), "id")] == [10, 11]


def test_volume_fact_and_filter_catalog(spark):
    billed = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "k string, q double")
    waiting = spark.createDataFrame([("c", 2.0, 1.0, "Open")], "k string, q double, open_quantity double, order_status string")
    fact = catalog.volume_fact(billed, waiting, ["k", "q", "open_quantity", "order_status", "maker"], ("done", "wait"), "q")
    assert rows(fact, "k") == [("a", 1.0, 0.0, "Completed", "done"), ("c", 2.0, 1.0, "Open", "wait")]
    got = catalog.filter_catalog([fact, spark.createDataFrame([("a",), ("z",)], "k string")], ["k"], {"country": F.lit("Brazil")})
    assert rows(got, "k") == [("a", "Brazil"), ("c", "Brazil"), ("z", "Brazil")]


def test_one_per_key_keeps_the_rows_that_look_up(spark):
    dim = spark.createDataFrame([("a", "x", 2), ("a", "x", 1), ("a", "w", 9), (None, "n", 0)], "k string, t string, n int")
    one = joins.one_per_key(dim, ["k"])
    assert sorted((r.k or "", r.t, r.n) for r in one.collect()) == [("", "n", 0), ("a", "w", 9)]
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert joins.lookup(rows, one, ["k"]).count() == 3


def test_newest_load_of_a_day_wins(spark):
    def extract(*rows):
        return spark.createDataFrame(list(rows), "k int, load string, v string").withColumn("load", dates.parse_time("load"))

    frames = [extract((1, "2020/01/02 08:00:00", "old")), extract((1, "2020/01/02 20:00:00", "new"))]
    for order in (frames, frames[::-1]):
        got = latest.union_extracts(order, ["K"], [latest.newest("LOAD")]).collect()
        assert [r.V for r in got] == ["new"]
    ties = [extract((1, "2020/01/02", "a"), (1, "2020/01/02", "b"))]
    assert len({tuple(r.V for r in latest.union_extracts([t.repartition(n)], ["K"], [latest.newest("LOAD")]).collect()) for t in ties for n in (1, 2, 5)}) == 1
