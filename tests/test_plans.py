"""Whole jobs on tiny inputs with the source schemas."""

from datetime import date

import pytest
from conftest import rows
from pyspark.sql import functions as F

from pricewright import values
from pricewright.operators.reshape import flatten_xml
from pricewright.plans import audit, dimensions, facts, forum, marts, support, survey, targets, volume


def frame(spark, columns, *data, types=None):
    names = columns.split()
    return spark.createDataFrame(list(data), ", ".join(f"`{n}` {(types or {}).get(n, 'string')}" for n in names))


@pytest.fixture(scope="module")
def region(spark):
    city = frame(
        spark, "IBGE_ID IBGE_NAME IBGE_UF_ACRONYMS", (3550308, "São Paulo", "SP"), (3106200, "Belo Horizonte", "MG"),
        types={"IBGE_ID": "bigint"},
    )
    taxes = frame(
        spark, "SPRAS COUNTRY TAXJURCODE TEXT",
        ("P", "BR", "SP 3550308", "SAO PAULO"), ("P", "BR", "ZF13550308", "SAO PAULO ZF"), ("P", "BR", "AM 1302603", "Manaus "),
        ("E", "BR", "RJ 3304557", "RIO"), ("P", "BR", "TAXJURCODE", "TEXT"),
    )
    branches = frame(
        spark, "city branch uf", ("Sao Paulo", "Filial Sao Paulo", "sp "), ("MANAUS", "Filial Norte", "AM"),
    )
    return dimensions.regions(city, taxes, branches).cache()


def test_regions(region):
    got = {r.IBGE_SAP_CITY_ID: r for r in region.collect()}
    assert set(got) == {"3550308", "3106200", "1302603"}
    assert (got["3550308"].IBGE_SAP_CITY_NAME, got["3550308"].CITY_ZF, got["3550308"].BRANCH) == ("SAO PAULO", 1, "Filial Sao Paulo")
    assert (got["3106200"].BRANCH, got["3106200"].CITY_ZF, got["3106200"].IBGE_UF_ACRONYMS) == (None, None, "MG")
    assert (got["1302603"].IBGE_SAP_CITY_NAME, got["1302603"].BRANCH) == ("MANAUS", "Filial Norte")  # found by the tax name


def test_city_records(spark):
    record = (
        '{"id": 7, "nome": "X", "microrregiao": {"id": 1, "nome": "m", "mesorregiao": {"id": 2, "nome": "e", '
        '"UF": {"id": 35, "sigla": "SP", "nome": "S", "regiao": {"id": 3, "sigla": "SE", "nome": "Sudeste"}}}}}'
    )
    raw = spark.createDataFrame([(record,)], "r string").select(F.from_json("r", dimensions.CITY_RECORD).alias("x")).select("x.*")
    row = dimensions.cities(raw).first()
    assert (row.IBGE_ID, row.IBGE_UF_ACRONYMS, row.IBGE_REGION_ACRONYMS, row.IBGE_MESO_ID) == (7, "SP", "SE", 2)


def test_clients(spark):
    key = "KUNNR VKORG VTWEG SPART"
    partners = frame(
        spark, f"{key} PARVW KUNN2 LIFNR PERNR",
        ("0123456789", "BRCG", "10", "00", "AG", "0000000042", None, "0"), ("0123456789", "BRCG", "10", "00", "RG", None, "0000000007", "0"),
        ("0123456789", "XXXX", "10", "00", "AG", "1", None, "0"), ("ABC", "BRCG", "10", "00", "AG", "1", None, "0"),
    )
    sales = frame(
        spark, f"{key} KONDA KVGR1 LPRIO LOEVM VKBUR VKGRP KVGR3 KDGRP", ("123456789", "BRCG", "10", "00", "k", "a", "p", None, "o1", "g1", "083", "z")
    )
    general = frame(spark, "KUNNR LAND1 NAME1 NAME2 ORT01 REGIO INDTYP ERDAT", ("123456789", "BR", "Client", None, "City", "SP", "i", "20200101"))
    texts = {
        "SALES_OFFICE": (frame(spark, "spras vkbur bezei", ("P", "o1", "Office One")), "vkbur", "bezei"),
        "ORGANIZATION_SALES": (frame(spark, "spras vkorg vtext", ("P", "BRCG", "Distribution")), "vkorg", "vtext"),
    }
    got = dimensions.clients(general, sales, partners, texts).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.COD_CLIENT, row.ORDER_ISSUER, row.PAYER, row.SALES_MANAGER) == (123456789, 42, 7, 0)
    assert (row.NAME, row.SALES_OFFICE_DESC, row.ORGANIZATION_SALES_DESC, row.SEGMENTATION_SECTOR) == ("Client", "Office One", "Distribution", "083")
    sector = survey.client_sector(dimensions.clients(general, sales, partners, texts)).first()
    assert sector.IN_SECTOR == values.YES


@pytest.fixture(scope="module")
def product(spark):
    code = "A01BCDEF0123456789"
    material = frame(
        spark, "MATNR spart prdha mtart mstae", ("000000000000000100", "10", code, "ZERT", " "), ("000000000000000200", "10", code, "ZERT", "01"),
        ("000000000000000300", "10", code, "ZERT", None),
    )
    names = frame(spark, "matnr spras maktx", ("100", "P", "VERGALHAO -- CA50"), ("300", "P", "NAO UTILIZAR"), ("100", "E", "REBAR"))
    sectors = frame(spark, "spras spart vtext", ("P", "10", "Longos"))
    sold = frame(
        spark, "matnr mvgr1 vkorg", ("100", "007", "BRCG"), ("100", "007", "BRCG"), ("100", "008", "BRCG"), ("100", "007", "BRDI"), ("100", "007", "ZZZZ")
    )
    groups = frame(spark, "spras mvgr1 bezei", ("P", "007", "BR-CA50 "), ("P", "008", "BR-CA60"))
    texts = frame(spark, "spras prodh vtext", ("P", "A", "one"), ("P", "A01", "two"), ("P", code, "seven"))
    units = spark.createDataFrame(
        [("100", "ZBA", 12.0, 1.0), ("100", "KG", 1.0, 1.0)], "matnr string, meinh string, umrez double, umren double"
    )
    extra = frame(spark, "MATNR MARKETINGPRODUCTGROUP DEMANDBREAKDOWNGROUP", ("100", "VERGALHAO ", "G"), ("100", "VERGALHAO ", "G"), ("100", "PREGOS", None))
    return dimensions.products(material, names, sectors, sold, groups, texts, units, extra).cache()


def test_products(product):
    got = {r.SALES_ORG_COD: r for r in product.collect()}
    assert set(got) == {"BRCG", "BRDI"}
    row = got["BRCG"]
    assert (row.COD_GPD, row.DESC_GPD, row.COD_GPM, row.DESC_GDD) == ("007", "BR-CA50 ", "VERGALHAO", "G")
    assert (row.DESC_MATERIAL, row.ZBA, row.KG, row.ROL) == ("VERGALHAO  CA50", 12.0, 1.0, 0.0)
    assert (row.DESC_HIERARCHY_1, row.DESC_HIERARCHY_2, row.DESC_HIERARCHY_3, row.DESC_HIERARCHY_7) == ("one", "two", None, "seven")


BILL_TEXT = (
    "SalesOrg BillingType SoldToCustomer SoldToCustomerName CorporateGroupName BilDocNumber BilDocItem SalesDocNumber SalesDocItem "
    "SalesDocType SalesOffice SalesOrderDate SoldToCity SoldToState GPD GPDName GPM Material MaterialName DATEYEARMONTH BILDOCDATE "
    "DATA_LOAD_TIMESTAMP_RAW"
)


def bill(spark, **changes):
    base = dict(
        SalesOrg="BRGO", BillingType="ZF2B", SoldToCustomer="0000000042", SoldToCustomerName="Client", CorporateGroupName=None,
        BilDocNumber="9", BilDocItem="1", SalesDocNumber="0000000010", SalesDocItem="000010", SalesDocType="ZORB", SalesOffice="o",
        SalesOrderDate="20200110", SoldToCity="Elsewhere", SoldToState="XX", GPD="1", GPDName="BR-CA50 X", GPM=None, Material="000100",
        MaterialName="m", DATEYEARMONTH="202001", BILDOCDATE="2020.01.15", DATA_LOAD_TIMESTAMP_RAW="2020-01-16 00:00:00",
    )
    return {**base, **changes}


@pytest.fixture(scope="module")
def billing(spark, region):
    old = [bill(spark, SoldToCustomerName="stale", DATA_LOAD_TIMESTAMP_RAW="2020-01-15"), bill(spark, BilDocNumber="8", BILDOCDATE="2010.01.01")]
    new = [bill(spark), bill(spark, BilDocNumber="7", GPDName="OTHER")]

    def extract(data):
        df = frame(spark, BILL_TEXT, *[tuple(d[c] for c in BILL_TEXT.split()) for d in data])
        numbers = {c: F.lit("1.0") for c in marts.BILLING_NUMBERS}
        return df.withColumns({**numbers, "MA_BillingQuantity_P": F.lit("2"), "MA_CM_PRECOLISTA_D": F.lit("100"), "MA_CM_RBV_D": F.lit("90"), "MA_CM_PRECOBASE_ALCADA_P": F.lit("0")})

    clients = frame(spark, "KUNNR ADRNR LAND1 DATA_LOAD_TIMESTAMP_PARQUET", ("42", "5", "BR", "2020-01-01"), ("0042", "6", "BR", "2019-01-01"))
    sites = frame(spark, "ADDRNUMBER CITY1 REGION COUNTRY DATA_LOAD_TIMESTAMP_PARQUET", ("0005", "São Paulo", "SP", "BR", "2020"))
    return facts.billing_fact([extract(old).withColumn("year", F.lit(2020)), extract(new)], clients, sites, region, "2020-02-01").cache()


def test_billing_fact(billing):
    got = {r.BILDOCNUMBER: r for r in billing.collect()}
    assert set(got) == {"9", "7"}  # 2010 is out of the horizon
    row = got["9"]
    assert (row.SOLDTOCUSTOMERNAME, row.SOLDTOCUSTOMER, row.SOLDTOCITY, row.SOLDTOSTATE, row.BRANCH_REGION) == (
        "Client", "42", "São Paulo", "SP", "Filial Sao Paulo",
    )


def profit_frame(spark):
    accounts = facts.account_columns()
    text = "GTC100257 GTC101667 GTC101671 GTC100137 GTC100511 GTC100255 GTC100504 0FISCPER 0CURRENCY GTC100025 DI_EXTRACT_TIME GTC100020 GTC100362 GTC100209 GTC101018 GTC100450 GTC100202"
    base = dict(
        GTC100257="a", GTC101667="b", GTC101671="c", GTC100137="d", GTC100511="BRCG", GTC100255="0000000010", GTC100504="000010", **{"0FISCPER": "2020001"},
        **{"0CURRENCY": "BRL"}, GTC100025="2020-01-20", DI_EXTRACT_TIME="2020-01-21", GTC100020="100", GTC100362="1", GTC100209="42", GTC101018=" ",
        GTC100450="0024240102", GTC100202="10",
    )
    data = [base, {**base, "GTC101671": "c2"}, {**base, "0CURRENCY": "USD", "GTC101671": "c3"}]
    df = frame(spark, text, *[tuple(d[c] for c in text.split()) for d in data])
    return df.withColumns({a: F.lit("2") for a in accounts}).withColumns({values.PROFIT_QUANTITY: F.lit("1500")})


def test_gross_profit_fact_and_apportioned_expense(spark):
    profit = facts.profitability_fact([profit_frame(spark)], "2020-02-01")
    assert profit.count() == 2
    state = spark.createDataFrame([(42, "BRCG", "SP", "20200101"), (42, "BRCG", "MG", "20190101")], "COD_CLIENT bigint, ORGANIZATION_SALES_COD string, STATE string, REGISTRATION_DATE string")
    state = dimensions.latest_client_state(state)
    row = facts.gross_profit_fact(profit, state).first()
    assert (row.SALES_NUMBER, row.SALES_ITEM, row.MONTH, row.QUANTITY_TON, row.ISSUING_STATE) == (10, 10, date(2020, 1, 1), 3.0, "SP")
    # two rows with every account 2: each stack is four times its sum of signs
    signs = {n: sum(1 if t[0] == "+" else -1 for t in s.split()) for n, s in values.PROFIT_STACKS.items()}
    assert row.GROSS_SALES == 4 * signs["GROSS_SALES"] and row.COGS_TOTAL == 4 * signs["COGS_TOTAL"]
    expected = 4 * sum(signs[n] for n in signs if n not in ("CUSTO_OPERACIONAL", "GTPM056"))
    assert row.GROSS_PROFIT_BW == expected
    ledger = frame(spark, "0FISCPER GTC100450 GTC100202 GTC100316 GTK100676", ("2020001", "0024240102", "10", "6250059900", "600"), ("2020001", "0024240102", "10", "1", "900"))
    shared = facts.gross_profit_fact(profit, state, ledger).first()
    assert shared.COMISSION_TO_AGENTS == -600.0


def test_stacked_profit_is_the_same_and_narrow(spark):
    """Stacks made before the newest row is looked for: the same fact, and the accounts stay out of that shuffle."""
    rows = profit_frame(spark)
    account = facts.account_columns()[0]
    odd = rows.withColumns({"GTC100255": F.lit("x9"), account: F.lit("bad")}).unionByName(rows.withColumns({"GTC100504": F.lit("20"), account: F.lit(None).cast("string")}))
    late = rows.withColumns({"DI_EXTRACT_TIME": F.lit("2020-01-22"), account: F.lit("7")})
    extracts, state = [rows.unionByName(odd), rows.unionByName(late)], spark.createDataFrame([], "COD_CLIENT bigint, ORGANIZATION_SALES_COD string, STATE string")
    was = facts.gross_profit_fact(facts.profitability_fact(extracts, "2020-02-01"), state)
    now = facts.gross_profit_fact(facts.profitability_fact(extracts, "2020-02-01", stacked=True), state, stacked=True, as_of="2020-02-01")
    assert was.columns == now.columns and was.count() == 3 and sorted(map(str, was.collect())) == sorted(map(str, now.collect()))

    def ranked(node):
        below = [node.children().apply(i) for i in range(node.children().size())]
        return [child.output().size() for child in below if node.nodeName() == "Window"] + [n for child in below for n in ranked(child)]

    wide, slim = (max(ranked(df._jdf.queryExecution().optimizedPlan())) for df in (was, now))
    assert wide > len(facts.account_columns()) > slim


def test_months_of_the_profit_reach_the_view(spark):
    """The months of the fact's horizon are left out of the view before the join shuffles it."""
    view = margin_view(spark, *[(m, "g", "1", 1, 10, "SP", 1.0, 2.0) for m in range(1, 13)])
    rows = profit_frame(spark).withColumns({"GTC100255": F.lit("1")})
    state = spark.createDataFrame([], "COD_CLIENT bigint, ORGANIZATION_SALES_COD string, STATE string")
    profit = facts.profitability_fact([rows], "2020-02-01", stacked=True)
    was, now = (marts.order_item_margin(view, facts.gross_profit_fact(profit, state, stacked=True, as_of=as_of)) for as_of in (None, "2020-02-01"))
    assert sorted(map(str, was.collect())) == sorted(map(str, now.collect())) and now.count() == 1
    tests = [sum("trunc(billing_date" in line and ">= 2018-02-01" in line for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in line) for df in (was, now)]
    assert tests == [0, 1]


@pytest.fixture(scope="module")
def margin(spark):
    return spark.createDataFrame(
        [(date(2020, 1, 1), 10, 10, -20.0, -4.0, 30.0, 2.0, 50.0, 60.0)],
        "MONTH date, SALES_NUMBER bigint, SALES_ITEM bigint, COGS_TOTAL double, FREIGHT_FULL double, GROSS_PROFIT_BW double, QUANTITY_TON double, NET_SALES double, X double",
    )


def test_price_marts(billing, region, product, margin):
    fall = marts.waterfall_mart(billing, region, product, margin, "2020-02-10").collect()
    assert len(fall) == 1
    row = fall[0]
    assert (row.SALES_ORG_COD, row.BRANCH, row.GPM_DESC, row.GPD_DESC, row.CLIENT_GROUP_DESC, row.MONTH_YEAR) == (
        "BRCG", "Filial Sao Paulo", "VERGALHAO", "BR-CA50", "Client", "01-2020",
    )
    assert (row.quantity_ton, row.list_price, row.segment_price) == (2.0, 50.0, 51.0)
    assert (row.gross_profit_original, row.op_cost, row.freight) == (30.0, 10.0, 2.0)
    assert marts.dispersion_mart(billing, region, product, margin, "2020-02-10").count() == 0  # no marketing group: out of scope there
    alert = marts.alert_mart(billing.withColumn("GPM", F.lit("VERGALHAO")), region).collect()
    assert [(r.STRATEGIC_PRICE, r.PRACTICED_PRICE_NORMAL, r.REGION) for r in alert] == [(104.0, 2.0, " Sao Paulo")]
    spread = marts.dispersion_mart(billing.withColumn("GPM", F.lit("VERGALHAO")), region, product, margin, "2020-02-10").first()
    assert spread.practiced_price_original == 2.0 and spread.practiced_price == 0.001


def test_margin_marts(spark, margin):
    cols = "billing_date sales_order_date sales_org_cod gpm gpd_cod gpd_desc material_cod material_desc sales_number sales_item issuing_state quantity_ton practiced_price norm_practiced_price rbv rlv receiving_customer_cod branch"
    view = frame(
        spark, cols,
        ("2020-01-15", "2020-01-10", "BRCG", "g", "1", "d", "100", "m", "10", "10", "SP", "2", "5", "4", "10", "9", "c", "b"),
        ("2020-01-16", "2020-01-10", "BRCG", "g", "1", "d", "100", "m", "10", "10", "SP", "2", "7", "4", "10", "9", "c", "b"),
        ("2020-01-16", "2020-01-10", "BRCG", "g", "1", "d", "100", "m", "99", "10", "SP", "2", "7", "4", "10", "9", "c", "b"),
    )
    got = marts.margin_marts(view, margin).collect()
    assert {r.grain for r in got} == set(marts.MARGIN_GRAINS) and len(got) == 7
    assert {(r.quantity_ton, r.gross_profit_bw, r.practiced_price_mean) for r in got} == {(4.0, 30.0, 6.0)}
    fact = margin.withColumns(
        {"SALES_ORG_COD": F.lit("BRGO"), "MATERIAL_COD": F.lit("0100"), "GPD_COD": F.lit(None).cast("string"), "ISSUING_STATE": F.lit("SP"), "SALES_ORDER_DATE": F.col("MONTH")}
    )
    full = marts.strategic_margin(fact, view).first()
    assert (full.SALES_ORG_COD, full.GPD_COD, full.GPD_DESC, full.KEY_LB, full.UF, full.YEAR) == ("BRCG", 1, "d", "10_10", "BR/SP", 2020)
    sf = marts.sales_force_margin(view, margin, [1, 2, 3], [1, 2, 3], 9).first()
    assert (sf.rlv, sf.avg_rlv_last_3, sf.avg_gross_profit_bw_year) == (18.0, 6.0, 30.0 / 9.0)


def margin_view(spark, *rows):
    cols = "billing_date date, sales_order_date string, sales_org_cod string, gpm string, gpd_cod string, gpd_desc string, material_cod string, material_desc string, sales_number bigint, sales_item int, issuing_state string, quantity_ton double, practiced_price double, norm_practiced_price double, rbv double, rlv double, receiving_customer_cod string, branch string"
    return spark.createDataFrame([(date(2020, m, 15), "20200110", "BRCG", gpm, "1", "d", part, "m", n, i, state, q, p, p, 10.0, 9.0, "c", "b") for m, gpm, part, n, i, state, q, p in rows], cols)


def margin_profit(spark, *rows):
    cols = "MONTH date, SALES_NUMBER bigint, SALES_ITEM bigint, COGS_TOTAL double, QUANTITY_TON double, FREIGHT_FULL double, GROSS_PROFIT_BW double, NET_SALES double"
    return spark.createDataFrame([(date(2020, m, 1) if m else None, n, i, -2.0, 1.0, -1.0, p, 20.0) for m, n, i, p in rows], cols)


def test_margin_marts_join_and_sum_in_one_pass(spark):
    """Each source is read once: no grain joins again, and the rows of the view meet the profit before they are summed."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        view = margin_view(spark, *[(1 + n % 3, f"g{n % 2}", str(n % 5), n, 10, "SP", 1.0, 2.0) for n in range(60)])
        mart = marts.margin_marts(view, margin_profit(spark, *[(1 + n % 3, n, 10, 3.0) for n in range(0, 60, 2)]))
        assert mart.where("grain = 'order_item'").count() == 30
        plan = mart._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert plan.count("Join [") == 1 and plan.count("Scan ExistingRDD") == 2
    assert "Aggregate" not in plan[plan.index("Join ["):plan.index("sales_order_date", plan.index("Exchange", plan.index("Join [")))]


def test_margin_marts_repeats_and_nulls(spark):
    """A profit that is there twice counts twice, whole numbers match codes, and a null key of the data is no rolled-up one."""
    view = margin_view(spark, (1, "g", "7", 1, 10, None, 2.0, 5.0), (1, "g", "7", 1, 10, None, 2.0, 7.0), (1, None, "7", 2, 10, "SP", 1.0, 4.0), (2, "g", "7", 1, 10, "SP", 1.0, 4.0), (1, "g", "7", None, 10, "SP", 1.0, 4.0))
    profit = margin_profit(spark, (1, 1, 10, 3.0), (1, 1, 10, 3.0), (1, 1, 10, 5.0), (1, 2, 10, 1.0), (2, 1, 10, None), (1, None, 10, 1.0), (None, 2, 10, 1.0))
    items = marts.order_item_margin(view, profit)
    assert sorted((r.sales_number, r.quantity_ton, r.practiced_price, r.gross_profit_bw) for r in items.collect()) == [(1, 4.0, 6.0, 3.0), (1, 4.0, 6.0, 3.0), (1, 4.0, 6.0, 5.0), (2, 1.0, 4.0, 1.0)]
    got = {}
    for r in marts.margin_marts(view, profit).collect():
        got.setdefault(r.grain, set()).add((r.gpm, r.sales_number, r.issuing_state, r.quantity_ton, r.gross_profit_bw, r.cogs_total, r.practiced_price_mean))
    assert set(got) == set(marts.MARGIN_GRAINS)
    assert got["order_item_month"] == {("g", 1, None, 12.0, 11.0, -6.0, 6.0), (None, 2, "SP", 1.0, 1.0, -2.0, 4.0)}
    assert got["group"] == {("g", None, None, 12.0, 11.0, -6.0, 6.0), (None, None, None, 1.0, 1.0, -2.0, 4.0)}
    text = view.withColumns({"sales_number": F.lpad(F.col("sales_number").cast("string"), 10, "0"), "sales_item": F.lit("000010")})
    assert sorted(map(tuple, marts.order_item_margin(text, profit).collect()), key=str) == sorted(map(tuple, items.collect()), key=str)


def test_rollup_in_one_pass_is_the_same(spark):
    from pricewright.operators.margin import margin_rollup

    rows = spark.range(200).select((F.col("id") % 3).alias("a"), F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("b"), (F.col("id") / 7).alias("x"), (F.col("id") % 5 + 0.1).alias("w"))
    grains = {"ab": ["a", "b"], "a": ["a"], "b": ["b"], "again": ["b"]}
    one, other = (margin_rollup(rows, grains, ["x"], {"m": ("x", "w")}, one_pass=p) for p in (True, False))
    assert one.columns == other.columns and sorted(map(str, one.collect())) == sorted(map(str, other.collect()))


@pytest.fixture(scope="module")
def wallet(spark):
    cols = [*volume.WALLET_TEXT, *volume.WALLET_DATES, *volume.WALLET_NUMBERS]
    one = {c: "1" for c in cols}
    one.update(salesorg="BRGO", custregionship="SP", custcitynameship="São Paulo", ordertype="ZORB", material="100", order="10", item="10", deliveredquantity="500", reqqttconv="1000", ordercreationdate="2020.01.05", confirmeddate="2020.01.06", corporategroupname=None, materialgroup1="1")
    data = [one, {**one, "item": "20", "ordertype": "XXXX"}, {**one, "item": "30", "salesorg": "ZZZZ"}]
    return spark.createDataFrame([tuple(d[c] for c in cols) for d in data], ", ".join(f"`{c}` string" for c in cols))


@pytest.fixture(scope="module")
def vbap(spark):
    return spark.createDataFrame(
        [("10", "10", 800.0, 1000.0, 200.0, 1000.0, 2.0, 1.0), ("10", "20", 800.0, 1000.0, 200.0, 1000.0, 2.0, 1.0)],
        "VBELN string, POSNR string, NETWR double, ZZICMS_IPI_T double, MWSBP double, KWMENG double, UMVKZ double, UMVKN double",
    )


@pytest.fixture(scope="module")
def policy(spark):
    return frame(spark, "sales_org_cod material_cod ibge_uf_acronyms ALCADA", ("BRCG ", "0100", "SP", "6"))


def test_wallet(spark, wallet, vbap, policy, region, product):
    terms = spark.createDataFrame([("10", "10", 100.0, 3.0, 0.0, 1.0, 0.0)], "VBAK_VBELN string, VBAP_POSNR string, ICMI double, ZD38 double, ZEB1 double, BX41 double, BX23 double")
    got = {r.SALES_ORDER_ITEM: r for r in volume.wallet_fact(wallet, vbap, terms, policy, region, product).collect()}
    assert set(got) == {"10", "20"}
    row = got["10"]
    assert (row.requested, row.total_wallet, row.rlv, row.verge, row.BRANCH, row.DESC_GPM) == (2000.0, 1000.0, 400.0, 0.06, "Filial Sao Paulo", "VERGALHAO")
    assert (row.zd01, row.price_zd02, row.price_zd06, row.price_zd38) == (100.0, 400.0, 6400.0, 6403.0)
    assert row.CUSTOMER_GROUP == "1" and got["20"].list_price is None


def test_volume_allocation_and_slicers(spark, billing, wallet, vbap, policy, region, product):
    billed = volume.billed_volume(billing, policy, region, product, "2020-02-10")
    waiting = volume.open_volume(wallet, vbap, policy, region, product)
    texts = frame(spark, "spras auart bezei", ("P", "ZORB", "Order"), ("E", "ZORB", "x"))
    fact = volume.volume_mart(billed, waiting, texts, ("own billed", "own open")).cache()
    got = {r.maker: r for r in fact.collect()}
    assert set(got) == {"own billed", "own open"}
    assert (got["own open"].quantity_ton, got["own open"].open_quantity, got["own open"].ORDER_TYPE_DESC) == (2.0, 1.0, "Order")
    done = got["own billed"]
    assert (done.order_status, done.open_quantity, done.GPM_DESC, done.order_price) == ("Completed", 0.0, "VERGALHAO", 90.0)
    assert done.verge == pytest.approx(5.4)
    plan = frame(
        spark, "MONTH_YEAR SALES_ORG_COD STATE GPD_COD DESC_GPD DESC_GPM SALES_OFFICE VOLUME",
        # The plan words the group's text differently; group code and marketing group decide.
        ("202001", "BRGO", "SP", "007", "BR-CA 50", "VERGALHAO", "o", "1 000,5"), ("202002", "BRGO", "SP", "007", "BR-CA50", "VERGALHAO", "o", "9"),
    )
    spread = volume.allocated_forecast(plan, billed, region, "202001").collect()
    assert [(r.BRANCH, r.pv_budget, r.pv_done, r.qty_branch, r.GPD_DESC) for r in spread] == [("Filial Sao Paulo", 1000.5, 1000.5, 2.0, "BR-CA 50")]
    goals = frame(spark, "SALES_ORG_COD STATE GPD_COD DESC_GPD DESC_GPM SALES_OFFICE", ("BRIN", "MG", "1", "d", "g", "o"))
    slicers = volume.slicer_catalog(fact, plan, goals, region, "202001").collect()
    assert {(r.OV_AJUST, r.BRANCH) for r in slicers} == {("BRCG", "Filial Sao Paulo"), ("BRIN", "")}


def test_spliced_forecast_and_budget(spark, product):
    cols = "MEASURE_UNIT MONTH_YEAR STATE GPD_COD SALES_ORG_COD SALES_OFFICE VOLUME"
    past = frame(spark, cols, ("T", "201912", "SP", "007", "BRCG", "o", "1,5"), ("T", "202001", "SP", "007", "BRCG", "o", "9"))
    view = frame(spark, cols, ("T", "202001", None, "007", "BRCG", "o", "2"))
    future = frame(spark, cols, ("T", "202001", "SP", "007", "BRCG", "o", "8"), ("T", "202002", "SP", "XXX", "BRCG", "o", " 3 "))
    got = volume.spliced_forecast(past, view, future, product, "202001")
    assert rows(got.select("MONTH_YEAR", "STATE", "VOLUME", "DESC_GPM"), "MONTH_YEAR") == [
        ("201912", "SP", 1.5, "VERGALHAO"), ("202001", "NA", 2.0, "VERGALHAO"), ("202002", "SP", 3.0, None),
    ]
    goals = volume.budget_table(frame(spark, "GPD_COD SALES_ORG_COD VOLUME VALUE_BRL", ("007", "BRCG", "1,0", "2 000,5")), product)
    assert goals.select("VOLUME", "VALUE_BRL").first()[:] == (1.0, 2000.5)


def test_survey_to_collect_mart(spark, billing, region, product):
    record = "<SurveyBasic><DCreated>2020-01-15T10:00</DCreated><CIDProduct>100</CIDProduct><CIDCity>Sao Paulo</CIDCity><CIDState>SP</CIDState><NValueWithTax>{}</NValueWithTax><XUnitMeasure_DESC>BARRA</XUnitMeasure_DESC><XPaymentTerm_DESC>30</XPaymentTerm_DESC><SalesmanID>s</SalesmanID><XCompeting_DESC>m</XCompeting_DESC></SurveyBasic>"
    raw = spark.createDataFrame([(record.format(p),) for p in ("66,00", "67,20", "900,00")], "record string")
    flat = flatten_xml(raw, "record", survey.SURVEY_SCHEMA, survey.SURVEY_FIELDS)
    terms = frame(spark, "term pct", ("30 ", "0,10"))
    got = survey.collected_prices(survey.survey_rows(flat), terms, product, region, "2020-01-20")
    checked = rows(got.select("price_kg", "sample_mean", "approved", "branch", "days_elapsed", "days_remaining"), "price_kg")
    assert checked == [
        (5.0, 5.045, True, "Filial Sao Paulo", 19, 12), (pytest.approx(5.0909166667), 5.045, True, "Filial Sao Paulo", 19, 12),
        (pytest.approx(68.1818333), 5.045, False, "Filial Sao Paulo", 19, 12),
    ]
    own = survey.own_price_reference(billing, region, got)
    # the billed channel is the distribution one, priced 2.0 per 2 tons
    mart_capacity = spark.createDataFrame([("Filial Sao Paulo", date(2020, 1, 1), 4.0)], "branch string, month date, capacity double")
    form = survey.form_rows(frame(spark, "org maker branch price_kg", ("IN", "form", "Filial X", "4,5")))
    mart = survey.collect_mart([got, form], own, mart_capacity, product, "2020-01-20").collect()
    assert len(mart) == 4 and [r.price_kg for r in mart if r.maker == "form"] == [4.5]
    row = next(r for r in mart if r.maker == "m")
    assert (row.day_mean, row.day_count, row.status, row.gpm) == (0.001, 1, "Entre 80% e 100%", "VERGALHAO")
    assert row.channel_label == "Sell-in 2: Distribuição-Revenda" and row.price_std == 0.064


def test_crm_rows(spark):
    prices = frame(spark, "share_id price price_type unit term competitor created org_code", ("s1", "10,5", "Usina-Mercado", "KG", "30", "c", "2020/01/05", "BRDO-1"), ("s1", None, "x", "KG", "30", "c", "2020/01/05", "BRDO"))
    shares = frame(spark, "id account_id owner_id product_id", ("s1", "a1", "u1", "p1"))
    accounts = frame(spark, "id client_cod client city state office", ("a1", "123", "n", "c", "SP", "o"))
    users = frame(spark, "id seller_cod seller", ("u1", "s", "n"))
    goods = frame(spark, "id product_cod product gpm gpd", ("p1", "000000100", "p", "g", "d"))
    row = survey.crm_rows(prices, accounts, users, goods, shares).collect()
    assert [(r.org, r.product_cod, r.client_cod, r.price_with_taxes, r.day) for r in row] == [("DI", "100", "0123", 10.5, date(2020, 1, 5))]


def test_agent_targets_and_marks(spark, product):
    wide_cg = spark.createDataFrame([("s1", "CG", "SP", "Filial Sul", "3", None)], "`Cod. Vendedor` string, OV string, Estado string, Filial string, `BR-CA50` string, `BR-XX` string")
    wide_vd = spark.createDataFrame([("s2", "DI", "MG", "7", "1")], "`Cod. Vendedor` string, OV string, Estado string, `BR-CA50` string, `BR-XX` string")
    groups = ["BR-CA50", "BR-XX"]
    sheets = [
        targets.target_sheet(wide_cg, "`Cod. Vendedor`", "OV", "Estado", groups, "Filial"),
        targets.target_sheet(wide_vd, "`Cod. Vendedor`", "OV", "Estado", groups),
    ]
    history = spark.createDataFrame([("S1", "CG", "FILIAL SUL", "SP", "BR-CA50", "12-2019", 5.0), ("S1", "CG", "FILIAL SUL", "SP", "BR-CA50", "01-2020", 99.0)], "seller_cod string, org string, branch string, state string, gpd string, month_year string, target double")
    collects = spark.createDataFrame([("S9", "CG", "FILIAL SUL", "SP", "BR-CA50", "01-2020", True), ("S1", "CG", "FILIAL SUL", "SP", "BR-CA50", "01-2020", True)], "seller_cod string, org string, branch string, state string, gpd string, month_year string, approved boolean")
    sellers = frame(spark, "seller_cod seller", ("s1", "Seller One"))
    got = targets.agent_targets(sheets, history, collects, product, sellers, "01-2020")
    assert rows(got.select("seller_cod", "branch", "month_year", "target", "seller"), "seller_cod", "month_year") == [
        ("S1", "FILIAL SUL", "01-2020", 3.0, "Seller One"), ("S1", "FILIAL SUL", "12-2019", 5.0, "Seller One"),
        ("S2", "Vendas MG", "01-2020", 7.0, "Vendedor Não Identificado"), ("S9", "FILIAL SUL", "01-2020", 0.0, "Vendedor Não Identificado"),
    ]
    marks = {(r.branch, r.month_year): (r.target, r.n_collects, r.realised_flag) for r in targets.realised_marks(got, collects).collect()}
    assert marks == {("FILIAL SUL", "01-2020"): (3.0, 2, 0), ("FILIAL SUL", "12-2019"): (5.0, 0, 0), ("Vendas MG", "01-2020"): (7.0, 0, 0)}
    assert rows(targets.home_branches(got, "01-2020").select("seller_cod", "branch"), "seller_cod")[0] == ("S1", "FILIAL SUL")


def test_support_tables(spark):
    share = support.share(frame(spark, "MES SHARE", ("01/07/2019", "0,35"), ("x", "y")), "2020-01-01")
    assert rows(share, F.col("DT_SHARE").asc_nulls_last())[0] == (date(2019, 7, 1), 0.35, "07/2019", 2019, 7, date(2020, 1, 1))
    scrap = support.scrap(spark.createDataFrame([("01/07/2019", "1,25")], "`Ano civil/mês` string, `Resultado global` string"), "2020-01-01")
    assert scrap.first()[:3] == (date(2019, 7, 1), 1.25, "07/2019")
    budget = spark.createDataFrame([("01/07/2019", "g", "0012", "d", "BRCG", "SP", "1,5", " 2 000,0")], "DATA string, GPM string, GPD string, `GPD Desc` string, OV string, `UF Recebedor ` string, Volume string, RLV string")
    assert support.budget(budget).first()[:] == ("g", 12, "d", "BRCG", "SP", 1.5, 2000.0, "201907")
    cal = support.calendar(frame(spark, "CURRENT_DATE CURRENT_WEEKEND", ("01-07-2019", "FALSE"), ("06-07-2019", "TRUE")))
    assert rows(cal.select("CURRENT_DATE", "IS_WEEKEND"), "CURRENT_DATE") == [(date(2019, 7, 1), False), (date(2019, 7, 6), True)]
    limits = support.typed(frame(spark, "org ALCADA", ("BRCG", "4,5"), ("BRCG", "4,5")), ["ALCADA"])
    assert rows(limits) == [("BRCG", 4.5)]
    traits = spark.createDataFrame([tuple("x" for _ in support.PRODUCT_TRAITS)], ", ".join(f"`{c}` string" for c in support.PRODUCT_TRAITS))
    assert support.product_traits(traits).columns == list(support.PRODUCT_TRAITS.values())


def test_forum_reports(spark):
    names = "sales_order_date maker sales_org_cod issuing_state branch gpd_desc gpd_cod gpm material_cod".split()
    base = {c: 1.0 for c in forum.NUMBERS}

    def row(maker, price, org="BRCG", day=date(2020, 1, 6), **kw):
        return (day, maker, org, "SP", "b", "d", "1", "g", "100", *{**base, "norm_pract_price_kg": price, **kw}.values())

    schema = "sales_order_date date, " + ", ".join(f"{n} string" for n in names[1:]) + ", " + ", ".join(f"{n} double" for n in forum.NUMBERS)
    view = spark.createDataFrame([row("own", 12.0)] + [row("other", 10.0)] * 11 + [row("own", 1.0, org="BRDI", rlv=2.0), row("own", 9.0, day=date(2020, 2, 3), rlv=5.0)], schema)
    cal = frame(spark, "CURRENT_DATE CURRENT_WEEKEND", ("06-01-2020", "FALSE"), ("07-01-2020", "FALSE"), ("11-01-2020", "TRUE"))
    goal = frame(spark, "issuing_state gpd_desc target_premium", ("SP ", "d", "0,05"))
    got = forum.premium_report(view, cal, goal, ["own", "own open"]).where("is_own AND sales_org_cod = 'BRCG' AND month = '2020-01-01'").first()
    assert (got.business_days, got.n_competitor, round(got.practiced_premium_sample, 6), round(got.premium_deviation, 6)) == (2, 11, 0.2, 0.15)
    assert got.mark_up == -0.5 and got.po == 0.0
    plan = frame(spark, "desc_gpm gpd_cod state sales_org_cod month_year volume", ("g", "1", "sp", "BRCG", "202001", "10"), ("G", "1", "SP", "BRCG", "202002", "30"))
    budget = frame(spark, "gpm_cod gpd_cod state sales_org_cod month_year volume rlv", ("G", "1", "SP", "BRCG", "202001", "1", "2"))
    out = forum.plan_report(plan, view, budget, "own").collect()
    assert [(r.volume, r.volume_next, r.volume_diff, r.rlv_sold, r.rlv_diff, r.rlv_diff_mean, r.volume_budget) for r in out] == [(10.0, 30.0, 20.0, 1.0, -4.0, -4.0, 1.0)]


def test_audit_day(spark):
    columns = "id int, date date, seller_cod string, client_cod string, branch string, price_kg double, approved_manually string, approved_automatically string"
    ledger = spark.createDataFrame([(1, date(2020, 1, 18), "s", "c", "b", 3.456, None, "Não")], columns)
    collects = spark.createDataFrame([(2, date(2020, 1, 20), "s", "c", "b", 5.0), (3, date(2020, 1, 20), None, "c", "b", 5.0)], ", ".join(columns.split(", ")[:6]))
    reviews = spark.createDataFrame([], "id int, verdict string, reviewed_at timestamp")
    out = audit.audit_day(ledger, collects, reviews, "2020-01-20")
    assert [r.id for r in out["rejected"].collect()] == [3]
    assert rows(out["worklist"].select("id", "price_kg"), "id") == [(1, 3.46), (2, 5.0)]
