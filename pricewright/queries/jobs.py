"""Whole jobs on the test tables, their columns renamed to those of the sources."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from pricewright import values
from pricewright.plans import dimensions, facts, marts, support, targets, volume
from pricewright.queries.tables import AS_OF, org_of, org_sql, table, tidy, tidy_sql
from pricewright.session import MB, ensure_checkpoint_dir, input_bytes
from pricewright.sources.writers import write_bucketed

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def add(fn):
        QUERIES[name] = fn
        ORACLE[name] = sql
        return fn

    return add


# --- billing fact: order items as bills, loaded twice a day ------------------------------------------------

# The second load of a day, of every third order, doubles the quantity: by date alone the two would tie.
BILLS_SQL = f"""
SELECT l_orderkey, l_linenumber, o_custkey, {org_sql()} AS org, min(l_partkey) AS part, sum(CAST(l_quantity AS DECIMAL(12,2))) AS qty,
       sum(CAST(l_extendedprice AS DECIMAL(14,2))) AS ext, min(CAST(l_shipdate AS DATE)) AS bill_date
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL
"""


def bills(spark, sf):
    order = table(spark, sf, "orders")
    item = table(spark, sf, "lineitem")
    return (
        item.join(order, item["l_orderkey"] == order["o_orderkey"])
        .groupBy("l_orderkey", "l_linenumber", "o_custkey", org_of().alias("org"))
        .agg(
            F.min("l_partkey").alias("part"), F.sum(F.col("l_quantity").cast("decimal(12,2)")).alias("qty"),
            F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).alias("ext"), F.min(F.col("l_shipdate").cast("date")).alias("bill_date"),
        )
    )


# Every condition of a bill has its own constant; quantity and gross revenue come from the lines.
VALUES = {n: i for i, n in enumerate(marts.BILLING_NUMBERS.values(), start=1)}


def billing_extract(rows, load_time, factor):
    day = F.date_format("bill_date", "yyyy/MM/dd")
    text = {
        "SalesOrg": F.col("org"), "BillingType": F.when(F.col("l_linenumber") % 5 == 0, "ZRE").otherwise("ZF2B"),
        "SoldToCustomer": F.concat(F.lit("00"), F.col("o_custkey").cast("string")),
        "SoldToCustomerName": F.concat(F.lit("Client "), F.col("o_custkey").cast("string")),
        "CorporateGroupName": F.when(F.col("o_custkey") % 2 == 0, values.GENERIC_CUSTOMER_GROUP).otherwise("Group"),
        "BilDocNumber": F.col("l_orderkey").cast("string"), "BilDocItem": F.col("l_linenumber").cast("string"),
        "SalesDocNumber": F.col("l_orderkey").cast("string"), "SalesDocItem": F.col("l_linenumber").cast("string"),
        "SalesDocType": F.lit("ZORB"), "SalesOffice": F.lit("o"), "SalesOrderDate": F.date_format("bill_date", "yyyyMMdd"),
        "SoldToCity": F.lit("Elsewhere"), "SoldToState": F.lit("XX"), "GPD": (F.col("part") % 7).cast("string"),
        "GPDName": group_name(), "GPM": F.when(F.col("part") % 4 != 0, F.lit("VERGALHAO")).when(F.col("part") % 8 == 0, F.lit("OTHER")),
        "Material": F.col("part").cast("string"), "MaterialName": F.lit("m"), "DATEYEARMONTH": F.date_format("bill_date", "yyyyMM"),
        "BILDOCDATE": day, "DATA_LOAD_TIMESTAMP_RAW": F.concat(day, F.lit(f" {load_time}")),
    }
    numbers = {c: F.lit(str(VALUES[n])) for c, n in marts.BILLING_NUMBERS.items()}
    numbers["MA_BillingQuantity_P"] = (F.col("qty") * factor).cast("string")
    numbers["MA_CM_RBV_D"] = F.col("ext").cast("string")
    return rows.select(*[c.alias(n) for n, c in {**text, **numbers}.items()])


def group_name():
    """The product groups in turn, with a suffix; every tenth part has one out of scope."""
    listed = F.array(*[F.lit(g) for g in values.PRODUCT_GROUPS])
    inside = F.concat(F.get(listed, (F.col("part") % len(values.PRODUCT_GROUPS)).cast("int")), F.lit(" X"))
    return F.when(F.col("part") % 10 == 9, F.lit("out of scope")).otherwise(inside)


def _group_sql():
    listed = ", ".join("'" + g.replace("'", "''") + "'" for g in values.PRODUCT_GROUPS)
    return f"CASE WHEN part % 10 = 9 THEN 'out of scope' ELSE ([{listed}])[part % {len(values.PRODUCT_GROUPS)} + 1] || ' X' END"


def billing(spark, sf):
    rows = bills(spark, sf)
    extracts = [
        billing_extract(rows, "08:00:00", 1).withColumn("year", F.substring("DATEYEARMONTH", 1, 4)),
        billing_extract(rows.where(F.col("l_orderkey") % 3 == 0), "20:00:00", 2),
    ]
    customer, nation = table(spark, sf, "customer"), table(spark, sf, "nation")
    clients = customer.where(F.col("c_custkey") % 13 != 0).select(
        F.col("c_custkey").cast("string").alias("KUNNR"), (F.col("c_nationkey") + 1).cast("string").alias("ADRNR"), F.lit("BR").alias("LAND1"),
        F.lit("2020-01-01").alias("DATA_LOAD_TIMESTAMP_PARQUET"),
    )
    addresses = nation.where(F.col("n_nationkey") % 5 != 0).select(
        F.concat(F.lit("000"), (F.col("n_nationkey") + 1).cast("string")).alias("ADDRNUMBER"), F.col("n_name").alias("CITY1"),
        F.concat(F.lit("U"), F.col("n_regionkey").cast("string")).alias("REGION"), F.lit("BR").alias("COUNTRY"), F.lit("2020").alias("DATA_LOAD_TIMESTAMP_PARQUET"),
    )
    return facts.billing_fact(extracts, clients, addresses, region_of(nation), AS_OF)


def region_of(nation):
    """Two branches for each city: a lookup must not double a bill."""
    names = [F.concat(F.lit(f"Filial {b}"), F.col("n_nationkey").cast("string")) for b in "BA"]
    return nation.select(
        F.col("n_name").alias("IBGE_SAP_CITY_NAME"), F.concat(F.lit("U"), F.col("n_regionkey").cast("string")).alias("IBGE_UF_ACRONYMS"),
        F.explode(F.array(*names)).alias("BRANCH"),
    )


BILLING_SQL = f"""
SELECT b.*, CASE WHEN l_orderkey % 3 = 0 THEN 2 * qty ELSE qty END AS quantity,
       CASE WHEN c_custkey IS NULL THEN '00' || CAST(o_custkey AS VARCHAR) ELSE CAST(c_custkey AS VARCHAR) END AS customer,
       coalesce(n_name, 'Elsewhere') AS city, CASE WHEN n_name IS NULL THEN 'XX' ELSE 'U' || CAST(n_regionkey AS VARCHAR) END AS state,
       'Filial A' || CAST(n_nationkey AS VARCHAR) AS branch
FROM ({BILLS_SQL}) AS b LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 13 <> 0) AS c ON o_custkey = c_custkey
     LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 5 <> 0) AS n ON c_nationkey = n_nationkey
WHERE bill_date >= CAST(DATE '{AS_OF}' - INTERVAL 24 MONTH AS DATE) AND bill_date <= DATE '{AS_OF}'
"""


@query(
    "billing_fact",
    tidy_sql(
        f"""SELECT CAST(l_orderkey AS VARCHAR) AS order_no, CAST(l_linenumber AS VARCHAR) AS item_no, customer, city, state, branch, quantity
            FROM ({BILLING_SQL}) AS f""",
        ["order_no", "item_no", "customer", "city", "state", "branch"],
        ["quantity"],
    ),
)
def billing_fact(spark, sf):
    return tidy(
        billing(spark, sf).select(
            F.col("SALESDOCNUMBER").alias("order_no"), F.col("SALESDOCITEM").alias("item_no"), F.col("SOLDTOCUSTOMER").alias("customer"),
            F.col("SOLDTOCITY").alias("city"), F.col("SOLDTOSTATE").alias("state"), F.col("BRANCH_REGION").alias("branch"),
            F.col("MA_BILLINGQUANTITY_P").cast("double").alias("quantity"),
        )
    )


SCOPED_SQL = f"""
SELECT *, CASE org {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in values.SALES_ORG_MERGE.items())} ELSE org END AS merged, {_group_sql()} AS group_name,
       CASE WHEN part % 4 <> 0 THEN 'VERGALHAO' WHEN part % 8 = 0 THEN 'OTHER' END AS gpm
FROM ({BILLING_SQL}) AS f
WHERE l_linenumber % 5 <> 0 AND org IN ({', '.join(f"'{o}'" for o in values.SALES_ORGS)}) AND part % 10 <> 9
  AND (part % 4 <> 0 OR part % 8 <> 0) AND quantity > 0
"""


@query(
    "scoped_billing",
    tidy_sql(
        f"""SELECT CAST(l_orderkey AS VARCHAR) AS order_no, CAST(l_linenumber AS VARCHAR) AS item_no, merged AS org, group_name, gpm,
                   CASE WHEN o_custkey % 2 = 0 THEN 'Client ' || CAST(o_custkey AS VARCHAR) ELSE 'Group' END AS client_group, quantity, ext AS rbv
            FROM ({SCOPED_SQL}) AS s""",
        ["order_no", "item_no", "org", "group_name", "gpm", "client_group"],
        ["quantity", "rbv"],
    ),
)
def scoped_billing(spark, sf):
    rows = marts.scoped_billing(billing(spark, sf))
    return tidy(
        rows.select(
            F.col("SALES_DOC_COD").alias("order_no"), F.col("SALES_DOC_ITEM_COD").alias("item_no"), F.col("SALES_ORG_COD").alias("org"),
            F.col("GPD_DESC").alias("group_name"), F.col("GPM_DESC").alias("gpm"), F.col("CLIENT_GROUP_DESC").alias("client_group"),
            F.col("quantity_ton").alias("quantity"), "rbv",
        )
    )


# --- allocated forecast: the plan words its groups differently from the bills ------------------------------------

SOLD_SQL = f"""
SELECT merged, state, CAST(part % 7 AS VARCHAR) AS gpd, coalesce(gpm, '{values.UNKNOWN_GROUP}') AS gpm, coalesce(branch, '{values.UNKNOWN_BRANCH}') AS branch, quantity, group_name FROM ({SCOPED_SQL}) AS s
"""
PLAN_ORGS = ["BRCG", "BRDI", "BRIN"]


@query(
    "allocated_forecast",
    tidy_sql(
        f"""
        WITH sold AS (SELECT merged AS org, state, gpd, gpm, branch, sum(quantity) AS qb, min(group_name) AS sold_text FROM ({SOLD_SQL}) AS x GROUP BY ALL),
        plans AS (SELECT o AS org, 'U' || CAST(n_regionkey AS VARCHAR) AS state, CAST(g AS VARCHAR) AS gpd, 'VERGALHAO' AS gpm,
                         sum(CAST(100.5 * (n_nationkey + 1) AS DECIMAL(12,2))) AS plan, 'plan of ' || CAST(g AS VARCHAR) AS plan_text
                  FROM nation, (VALUES ('BRCG'), ('BRDI'), ('BRIN')) AS orgs(o), (SELECT unnest(range(9)) AS g) GROUP BY ALL),
        sites AS (SELECT DISTINCT 'U' || CAST(n_regionkey AS VARCHAR) AS state, 'Filial ' || b || CAST(n_nationkey AS VARCHAR) AS branch
                  FROM nation, (VALUES ('A'), ('B')) AS v(b)),
        n_sites AS (SELECT state, count(*) AS n FROM sites GROUP BY 1),
        known AS (SELECT * FROM sold WHERE branch <> '{values.UNKNOWN_BRANCH}'),
        st AS (SELECT org, state, gpd, gpm, sum(qb) AS qs FROM known GROUP BY ALL),
        rows AS (SELECT org, state, gpd, gpm, branch FROM plans JOIN sites USING (state) UNION
                 SELECT org, state, gpd, gpm, branch FROM sold),
        texts AS (SELECT org, state, gpd, gpm, min(sold_text) AS sold_text FROM sold GROUP BY ALL)
        SELECT r.org, r.state, r.gpd, coalesce(r.gpm, '{values.UNKNOWN_GROUP}') AS gpm, r.branch, coalesce(plan_text, texts.sold_text) AS group_text,
               CASE WHEN r.branch = '{values.UNKNOWN_BRANCH}' THEN 0 WHEN plan IS NULL OR site IS NULL THEN 0
                    WHEN qs IS NULL THEN CAST(plan AS DOUBLE) / n ELSE CAST(plan AS DOUBLE) * coalesce(CAST(qb AS DOUBLE) / CAST(qs AS DOUBLE), 0) END AS pv_done,
               CASE WHEN r.branch = '{values.UNKNOWN_BRANCH}' THEN 0 ELSE coalesce(CAST(qb AS DOUBLE), 0) END AS qty_branch
        FROM rows r LEFT JOIN (SELECT *, 1 AS site FROM sites) AS s2 ON r.state = s2.state AND r.branch = s2.branch
             LEFT JOIN n_sites ns ON r.state = ns.state
             LEFT JOIN plans p ON r.org = p.org AND r.state = p.state AND r.gpd = p.gpd AND r.gpm IS NOT DISTINCT FROM p.gpm
             LEFT JOIN st ON r.org = st.org AND r.state = st.state AND r.gpd = st.gpd AND r.gpm = st.gpm
             LEFT JOIN known k ON r.org = k.org AND r.state = k.state AND r.gpd = k.gpd AND r.gpm = k.gpm AND r.branch = k.branch
             LEFT JOIN texts ON r.org = texts.org AND r.state = texts.state AND r.gpd = texts.gpd AND r.gpm IS NOT DISTINCT FROM texts.gpm
        """,
        ["org", "state", "gpd", "gpm", "branch", "group_text"],
        ["pv_done", "qty_branch"],
    ),
)
def allocated_forecast(spark, sf):
    nation = table(spark, sf, "nation")
    region = region_of(nation)
    rows = marts.scoped_billing(billing(spark, sf)).withColumn("GPM_DESC", F.coalesce("GPM_DESC", F.lit(values.UNKNOWN_GROUP)))
    sold = dimensions.with_branch(rows, region, "ISSUING_CITY", "ISSUING_STATE")
    plan = nation.select(
        F.lit("200107").alias("MONTH_YEAR"), F.explode(F.array(*map(F.lit, PLAN_ORGS))).alias("SALES_ORG_COD"), "n_nationkey",
        F.concat(F.lit(" u"), F.col("n_regionkey").cast("string")).alias("STATE"), F.lit("VERGALHAO").alias("DESC_GPM"), F.lit("o").alias("SALES_OFFICE"),
    ).withColumn("GPD_COD", F.explode(F.array(*[F.lit(str(g)) for g in range(9)]))).withColumns(
        {
            "DESC_GPD": F.concat(F.lit("plan of "), F.col("GPD_COD")),
            "VOLUME": F.translate(((F.col("n_nationkey") + 1) * F.lit(100.5)).cast("decimal(12,2)").cast("string"), ".", ","),
        }
    )
    out = volume.allocated_forecast(plan, sold, region, "200107")
    return tidy(
        out.select(
            F.col("OV_AJUST").alias("org"), F.col("ISSUING_STATE").alias("state"), F.col("GPD_COD").alias("gpd"), F.col("GPM_DESC").alias("gpm"),
            F.col("BRANCH").alias("branch"), F.col("GPD_DESC").alias("group_text"), "pv_done", "qty_branch",
        )
    )


# --- gross profit: every account is a multiple of the quantity ------------------------------------------------------

ACCOUNTS = {name: i for i, name in enumerate(facts.account_columns(), start=1)}
GROSS = ["QUANTITY_TON", *values.PROFIT_STACKS, "NET_SALES", "GROSS_PROFIT_BW", "FREIGHT_FULL"]


def _units(names):
    """Multiple of the quantity that a sum of stacks comes to."""
    terms = [t for n in names for t in values.PROFIT_STACKS[n].split()]
    return sum(ACCOUNTS[t[1:]] * (1 if t[0] == "+" else -1) for t in terms)


NET_STACKS = ["GROSS_SALES", "SALES_TAX_DISCOUNT"]
FREIGHT_STACKS = ["SHIP_DEL_LOAD_C_C", "PORT_EXPENSES", "FREIGHT", "COGS_ADJUSTMENTS"]
GROSS_UNITS = {n: _units([n]) for n in values.PROFIT_STACKS} | {
    "NET_SALES": _units(NET_STACKS), "FREIGHT_FULL": _units(FREIGHT_STACKS),
    "GROSS_PROFIT_BW": _units([*NET_STACKS, *FREIGHT_STACKS, "COGS_TOTAL", "COMISSION_TO_AGENTS"]),
}


def profit_extract(rows, load_time, factor):
    day = F.date_format("bill_date", "yyyy/MM/dd")
    text = {
        "GTC100257": F.lit("a"), "GTC101667": F.lit("b"), "GTC101671": F.lit("c"), "GTC100137": F.lit("d"), "GTC100511": F.col("org"),
        "GTC100255": F.concat(F.lit("00"), F.col("l_orderkey").cast("string")), "GTC100504": F.concat(F.lit("0"), F.col("l_linenumber").cast("string")),
        "0FISCPER": F.date_format("bill_date", "yyyy'0'MM"), "0CURRENCY": F.when(F.col("l_linenumber") % 6 == 0, "USD").otherwise("BRL"),
        "GTC100025": day, "DI_EXTRACT_TIME": F.concat(day, F.lit(f" {load_time}")), "GTC100020": F.col("part").cast("string"),
        "GTC100362": (F.col("part") % 7).cast("string"), "GTC100209": F.col("o_custkey").cast("string"),
        "GTC101018": F.when(F.col("part") % 2 == 0, F.lit(" ")).otherwise("XX"),
    }
    amounts = {name: (F.col("qty") * factor * n).cast("string") for name, n in ACCOUNTS.items()}
    return rows.select(*[c.alias(n) for n, c in {**text, **amounts}.items()])


GROSS_FACT_SQL = f"""
SELECT l_orderkey AS order_no, CAST(l_linenumber AS BIGINT) AS item_no, CAST(date_trunc('month', bill_date) AS DATE) AS month, org, CAST(part AS VARCHAR) AS material,
       CASE WHEN part % 2 <> 0 THEN 'XX' WHEN o_custkey % 3 <> 0 THEN 'S' || CAST(c_nationkey AS VARCHAR) END AS state,
       CAST(q * {ACCOUNTS[values.PROFIT_QUANTITY]} AS DOUBLE) / 1000.0 AS "QUANTITY_TON",
       {', '.join(f'q * {n} AS "{name}"' for name, n in GROSS_UNITS.items())}
FROM (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 2 * qty ELSE qty END AS q FROM ({BILLS_SQL}) AS b) AS b JOIN customer ON o_custkey = c_custkey
WHERE bill_date >= CAST(DATE '{AS_OF}' - INTERVAL 24 MONTH AS DATE) AND bill_date <= DATE '{AS_OF}' AND l_linenumber % 6 <> 0
"""


@query(
    "gross_profit_fact",
    tidy_sql(
        GROSS_FACT_SQL,
        ["order_no", "item_no", "month", "org", "material", "state"],
        [f'"{n}"' for n in GROSS],
    ),
)
def gross_profit_fact(spark, sf):
    return tidy(
        profit(spark, sf).select(
            F.col("SALES_NUMBER").alias("order_no"), F.col("SALES_ITEM").alias("item_no"), F.col("MONTH").alias("month"), F.col("SALES_ORG_COD").alias("org"),
            F.col("MATERIAL_COD").alias("material"), F.col("ISSUING_STATE").alias("state"), *GROSS,
        )
    )


def profit(spark, sf):
    rows = bills(spark, sf)
    extracts = [profit_extract(rows, "08:00:00", 1), profit_extract(rows.where(F.col("l_orderkey") % 3 == 0), "20:00:00", 2)]
    # The newest registration of a client counts; every third client has none.
    client = table(spark, sf, "customer").where(F.col("c_custkey") % 3 != 0).select(
        F.col("c_custkey").alias("COD_CLIENT"), F.explode(F.array(*map(F.lit, ["BRCG", "BRDI", "BRCC", "BRIN", "BRCO"]))).alias("ORGANIZATION_SALES_COD"),
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("STATE"),
    )
    dated = [client.withColumn("REGISTRATION_DATE", F.lit("20200101")), client.withColumns({"REGISTRATION_DATE": F.lit("20100101"), "STATE": F.lit("old")})]
    state = dimensions.latest_client_state(dated[0].unionByName(dated[1]))
    return facts.gross_profit_fact(facts.profitability_fact(extracts, AS_OF, stacked=True), state, stacked=True, as_of=AS_OF)


# --- waterfall mart: billing, profit, products and branches in one job -------------------------------------------------

def _value(*names):
    return sum(VALUES[n] for n in names)


SEGMENT = _value("list_price", "zd02", "zd03")
CUSTOMER = SEGMENT + _value("zd01", "zd04", "zd05", "zeaf", "zeb1", "zeb2")
GROSS_PRICE = CUSTOMER + _value("zd13", "zd14", "zd06", "zsu2")
NET_PRICE = GROSS_PRICE - _value("icms", "cofins", "pis", "other_taxes", "bx95")
MART_NUMBERS = [
    "quantity_ton", "list_price", "rbv", "segment_price", "full_customer_price", "rbv_waterfall", "rlv_waterfall", "gross_profit", "gross_profit_waterfall",
]


@query(
    "waterfall_mart",
    tidy_sql(
        f"""
        WITH b AS (SELECT *, CAST(quantity AS DOUBLE) AS q, l_linenumber % 6 <> 0 AS has_profit FROM ({SCOPED_SQL}) AS s
                   WHERE bill_date >= CAST(date_trunc('month', DATE '{AS_OF}') - INTERVAL 6 MONTH AS DATE)
                     AND bill_date < CAST(date_trunc('month', DATE '{AS_OF}') + INTERVAL 1 MONTH AS DATE)),
        c AS (SELECT *, CASE WHEN has_profit THEN q * {GROSS_UNITS['GROSS_PROFIT_BW']} ELSE 0 END AS profit,
                     CASE WHEN has_profit THEN q * {GROSS_UNITS['COGS_TOTAL']} ELSE 0 END AS cost,
                     CASE WHEN has_profit THEN q * {GROSS_UNITS['FREIGHT_FULL']} ELSE 0 END AS freight FROM b)
        SELECT l_orderkey AS order_no, CAST(l_linenumber AS BIGINT) AS item_no, coalesce(branch, '{values.UNKNOWN_BRANCH}') AS branch,
               CASE WHEN part % 3 = 0 THEN 'PG' || CAST(part % 5 AS VARCHAR) ELSE gpm END AS gpm, strftime(bill_date, '%m-%Y') AS month_year,
               abs(q) AS quantity_ton, {VALUES['list_price']} / q AS list_price, CAST(ext AS DOUBLE) / q AS rbv, {SEGMENT} / q AS segment_price,
               {CUSTOMER} / q AS full_customer_price, {GROSS_PRICE} / q AS rbv_waterfall, {NET_PRICE} / q AS rlv_waterfall, profit / q AS gross_profit,
               ({NET_PRICE} - abs(cost) - abs(freight)) / q AS gross_profit_waterfall
        FROM c
        """,
        ["order_no", "item_no", "branch", "gpm", "month_year"],
        MART_NUMBERS,
    ),
)
def waterfall_mart(spark, sf):
    product = waterfall_products(spark, sf)
    return _waterfall(marts.waterfall_mart(billing(spark, sf), region_of(table(spark, sf, "nation")), product, profit(spark, sf), AS_OF))


def waterfall_products(spark, sf):
    part = table(spark, sf, "part").where(F.col("p_partkey") % 3 == 0)
    return part.select(
        F.concat(F.lit("000"), F.col("p_partkey").cast("string")).alias("COD_MATERIAL"),
        F.explode(F.array(*map(F.lit, ["BRCG", "BRDI", "BRCC", "BRIN"]))).alias("SALES_ORG_COD"), F.lit("7").alias("COD_GPD"), F.lit("d").alias("DESC_GPD"),
        F.concat(F.lit("PG"), (F.col("p_partkey") % 5).cast("string")).alias("COD_GPM"),
    )


def _waterfall(mart):
    return tidy(
        mart.select(
            F.col("SALES_NUMBER").alias("order_no"), F.col("SALES_ITEM").alias("item_no"), F.col("BRANCH").alias("branch"), F.col("GPM_DESC").alias("gpm"),
            F.col("MONTH_YEAR").alias("month_year"), *MART_NUMBERS,
        )
    )


# The number must be the same for both facts; it goes by the size of the tables they are made of.
BUCKETS, BUCKET_INPUT, MOST_BUCKETS = 8, 16 * MB, 65_536


def buckets(spark, sf):
    return min(max(BUCKETS, -(-input_bytes(spark, sf) // BUCKET_INPUT)), MOST_BUCKETS)


@query("waterfall_from_stored_facts", ORACLE["waterfall_mart"])
def waterfall_from_stored_facts(spark, sf):
    folder, name = f"{ensure_checkpoint_dir(spark)}/facts-{uuid.uuid4().hex}", uuid.uuid4().hex
    items = marts.billed_items(billing(spark, sf), region_of(table(spark, sf, "nation")), waterfall_products(spark, sf), AS_OF, fwd=1, gpm_null=True)
    number = buckets(spark, sf)
    items = write_bucketed(items, f"items_{name}", f"{folder}/items", marts.ITEM, number)
    costs = write_bucketed(facts.margin_columns(profit(spark, sf)), f"costs_{name}", f"{folder}/costs", marts.ITEM, number)
    return _waterfall(marts.waterfall_of(items, costs))


# --- dispersion and alert marts: prices without customer and finance conditions ------------------------------------------

def _normal_sql(price, *more):
    """The price with its conditions; one organisation has another on top."""
    return f"{price + sum(more)} + CASE WHEN merged = '{values.DISTRIBUTION_ORG}' THEN {VALUES['bx41']} ELSE 0 END"


NORMAL_SQL = _normal_sql(VALUES["practiced_price"], VALUES["zd05"], -VALUES["zeaf"])
DISPERSION_NUMBERS = ["quantity_ton", "rlv_original", "practiced_price_original", "practiced_price", "calculated_taxes", "gross_profit", "op_cost"]


@query(
    "dispersion_mart",
    tidy_sql(
        f"""
        WITH b AS (SELECT *, CAST(quantity AS DOUBLE) AS q, l_linenumber % 6 <> 0 AS has_profit FROM ({SCOPED_SQL}) AS s
                   WHERE bill_date >= CAST(date_trunc('month', DATE '{AS_OF}') - INTERVAL 6 MONTH AS DATE)
                     AND bill_date < CAST(date_trunc('month', DATE '{AS_OF}') AS DATE) AND gpm IS NOT NULL)
        SELECT l_orderkey AS order_no, CAST(l_linenumber AS BIGINT) AS item_no, merged AS org, coalesce(branch, '{values.UNKNOWN_BRANCH}') AS branch,
               CASE WHEN part % 3 = 0 THEN 'PG' || CAST(part % 5 AS VARCHAR) ELSE gpm END AS gpm, strftime(bill_date, '%m-%Y') AS month_year,
               q AS quantity_ton, CAST({VALUES['rlv']} AS DOUBLE) AS rlv_original, CAST({NORMAL_SQL} AS DOUBLE) AS practiced_price_original,
               ({NORMAL_SQL}) / q / 1000.0 AS practiced_price, {_value('icms', 'cofins', 'pis', 'other_taxes', 'bx95')} / q / 1000.0 AS calculated_taxes,
               CASE WHEN has_profit THEN q * {GROSS_UNITS['GROSS_PROFIT_BW']} ELSE 0 END / q / 1000.0 AS gross_profit,
               CASE WHEN has_profit THEN q * {GROSS_UNITS['COGS_TOTAL']} ELSE 0 END / q / 1000.0 AS op_cost
        FROM b
        """,
        ["order_no", "item_no", "org", "branch", "gpm", "month_year"],
        DISPERSION_NUMBERS,
    ),
)
def dispersion_mart(spark, sf):
    region = region_of(table(spark, sf, "nation"))
    mart = marts.dispersion_mart(billing(spark, sf), region, waterfall_products(spark, sf), profit(spark, sf), AS_OF)
    return tidy(
        mart.select(
            F.col("SALES_NUMBER").alias("order_no"), F.col("SALES_ITEM").alias("item_no"), F.col("SALES_ORG_COD").alias("org"), F.col("BRANCH").alias("branch"),
            F.col("GPM_DESC").alias("gpm"), F.col("MONTH_YEAR").alias("month_year"), *DISPERSION_NUMBERS,
        )
    )


@query(
    "alert_mart",
    tidy_sql(
        f"""
        SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS order_no, CAST(l_linenumber AS VARCHAR) AS item_no, merged AS org, branch, substring(branch, 7) AS region,
               quantity AS quantity_ton, CAST({_normal_sql(_value('list_price', 'zd02', 'zd03', 'zeb2'))} AS DOUBLE) AS strategic_price,
               CAST({NORMAL_SQL} AS DOUBLE) AS practiced_price_normal
        FROM ({SCOPED_SQL}) AS s WHERE gpm IS NOT NULL AND branch IS NOT NULL
        """,
        ["order_no", "item_no", "org", "branch", "region"],
        ["quantity_ton", "strategic_price", "practiced_price_normal"],
    ),
)
def alert_mart(spark, sf):
    mart = marts.alert_mart(billing(spark, sf), region_of(table(spark, sf, "nation")))
    return tidy(
        mart.select(
            F.col("SALES_DOC_COD").alias("order_no"), F.col("SALES_DOC_ITEM_COD").alias("item_no"), F.col("SALES_ORG_COD").alias("org"),
            F.col("BRANCH").alias("branch"), F.col("REGION").alias("region"), "quantity_ton",
            F.col("STRATEGIC_PRICE").alias("strategic_price"), F.col("PRACTICED_PRICE_NORMAL").alias("practiced_price_normal"),
        )
    )


# --- margin marts: billed items beside their gross profit at seven grains ---------------------------------------------------

MARGIN_DIMS = list(dict.fromkeys(c for g in marts.MARGIN_GRAINS.values() for c in g))
MARGIN_TEXTS = {
    "sales_order_date": "strftime(bill_date, '%Y%m%d')", "gpm": "'GPM' || CAST(part % 5 AS VARCHAR)", "gpd_cod": "CAST(part % 7 AS VARCHAR)",
    "gpd_desc": "'group ' || CAST(part % 7 AS VARCHAR)", "material_desc": "'material ' || CAST(part AS VARCHAR)", "material_cod": "CAST(part AS VARCHAR)",
    "sales_org_cod": "org", "receiving_customer_cod": "CAST(o_custkey AS VARCHAR)", "branch": "'B' || CAST(o_custkey % 25 AS VARCHAR)",
    "issuing_state": "CASE WHEN o_custkey % 27 <> 0 THEN 'U' || CAST(o_custkey % 27 AS VARCHAR) END",
}
MARGIN_MEANS = ["practiced_price_mean", "norm_price_mean"]
# Both lines of an item that was billed twice, the second of double quantity and half price.
MARGIN_SQL = f"""
WITH v AS (SELECT *, qty AS q, CAST(ext AS DOUBLE) AS price, CAST(ext AS DOUBLE) + 1 AS norm FROM ({BILLS_SQL}) AS b
           UNION ALL SELECT *, 2 * qty, CAST(ext AS DOUBLE) / 2, CAST(ext AS DOUBLE) / 2 + 1 FROM ({BILLS_SQL}) AS b WHERE l_orderkey % 3 = 0),
i AS (SELECT CAST(date_trunc('month', bill_date) AS DATE) AS month, l_orderkey AS sales_number, CAST(l_linenumber AS BIGINT) AS sales_item,
             {', '.join(f'{e} AS {n}' for n, e in MARGIN_TEXTS.items())}, sum(q) AS quantity_ton, sum(ext) AS rbv, sum(CAST(ext * 0.75 AS DECIMAL(18,6))) AS rlv,
             CAST(sum(CAST(price * CAST(q AS DOUBLE) AS DECIMAL(30,6))) AS DOUBLE) / CAST(sum(q) AS DOUBLE) AS price,
             CAST(sum(CAST(norm * CAST(q AS DOUBLE) AS DECIMAL(30,6))) AS DOUBLE) / CAST(sum(q) AS DOUBLE) AS norm
      FROM v GROUP BY ALL),
f AS (SELECT order_no AS sales_number, item_no AS sales_item, month, "COGS_TOTAL" AS cogs_total, "QUANTITY_TON" AS quantity_ton_bw, "FREIGHT_FULL" AS freight_full,
             "GROSS_PROFIT_BW" AS gross_profit_bw, "NET_SALES" AS net_sales FROM ({GROSS_FACT_SQL}) AS p),
g AS (SELECT GROUPING_ID({', '.join(MARGIN_DIMS)}) AS gid, {', '.join(MARGIN_DIMS)},
             {', '.join(f'sum(CAST({c} AS DECIMAL(30,6))) AS {c}' for c in marts.MARGIN_SUMS)},
             {', '.join(f'CAST(sum(CAST({c} * CAST(quantity_ton AS DOUBLE) AS DECIMAL(30,6))) AS DOUBLE) / CAST(sum(quantity_ton) AS DOUBLE) AS {n}' for c, n in zip(('price', 'norm'), MARGIN_MEANS))}
      FROM i JOIN f USING (sales_number, sales_item, month)
      GROUP BY GROUPING SETS ({', '.join('(' + ', '.join(g) + ')' for g in marts.MARGIN_GRAINS.values())}))
SELECT CASE gid {' '.join(
    f"WHEN {sum(1 << (len(MARGIN_DIMS) - 1 - n) for n, c in enumerate(MARGIN_DIMS) if c not in g)} THEN '{name}'" for name, g in marts.MARGIN_GRAINS.items())} END AS grain,
       {', '.join(MARGIN_DIMS)}, {', '.join(marts.MARGIN_SUMS)}, {', '.join(MARGIN_MEANS)}
FROM g
"""


@query("margin_marts", tidy_sql(MARGIN_SQL, ["grain", *MARGIN_DIMS], [*marts.MARGIN_SUMS, *MARGIN_MEANS]))
def margin_marts(spark, sf):
    part, customer = F.col("part"), F.col("o_custkey")
    texts = {
        "sales_order_date": F.date_format("bill_date", "yyyyMMdd"), "gpm": F.concat(F.lit("GPM"), (part % 5).cast("string")),
        "gpd_cod": (part % 7).cast("string"), "gpd_desc": F.concat(F.lit("group "), (part % 7).cast("string")),
        "material_desc": F.concat(F.lit("material "), part.cast("string")), "material_cod": part.cast("string"), "sales_org_cod": F.col("org"),
        "receiving_customer_cod": customer.cast("string"), "branch": F.concat(F.lit("B"), (customer % 25).cast("string")),
        "issuing_state": F.when(customer % 27 != 0, F.concat(F.lit("U"), (customer % 27).cast("string"))),
    }
    # One pass makes both lines of an item.
    factors = F.when(F.col("l_orderkey") % 3 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    rows, factor, ext = bills(spark, sf).withColumn("factor", F.explode(factors)), F.col("factor"), F.col("ext").cast("double")
    price = ext / factor
    view = rows.select(
        F.col("bill_date").alias("billing_date"), F.col("l_orderkey").alias("sales_number"), F.col("l_linenumber").alias("sales_item"),
        *[c.alias(n) for n, c in texts.items()], (F.col("qty") * factor).alias("quantity_ton"), F.col("ext").alias("rbv"), (ext * 0.75).alias("rlv"),
        price.alias("practiced_price"), (price + 1).alias("norm_practiced_price"),
    )
    mart = marts.margin_marts(view, profit(spark, sf))
    return tidy(mart.select("grain", *MARGIN_DIMS, *marts.MARGIN_SUMS, *MARGIN_MEANS))


# --- agent targets: sheets of two channels, stored months and collects -------------------------------------------------

MONTH = "06-2001"
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
SOLD_SEGMENTS = SEGMENTS[:3]  # what the first channel sells; the second sells one, spelled otherwise
AGENT_SQL = """
SELECT o.*, c_mktsegment AS seg, lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state, upper(replace(n_name, '_', '-')) AS site
FROM orders AS o JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


@query(
    "agent_targets",
    f"""
    WITH o AS ({AGENT_SQL}),
    local AS (SELECT DISTINCT o_custkey % 300 AS a, state, site FROM o),
    away AS (SELECT DISTINCT o_custkey % 300 AS a, state FROM o WHERE o_orderstatus = 'P'),
    cur AS (
      SELECT 'AG' || CAST(a AS VARCHAR) AS seller_cod, 'CG' AS org, site AS branch, state, seg AS gpd, '{MONTH}' AS month_year, CAST(coalesce(v, 0) AS DOUBLE) AS target
      FROM local CROSS JOIN (SELECT unnest({SOLD_SEGMENTS}) AS seg) LEFT JOIN (
        SELECT o_custkey % 300 AS a, state, site, seg, sum(o_orderkey % 11) AS v FROM o GROUP BY ALL) USING (a, state, site, seg)
      UNION ALL
      SELECT 'AG' || CAST(a AS VARCHAR), 'DI', 'Vendas ' || state, state, 'AUTO MOBILE', '{MONTH}', CAST(coalesce(v, 0) AS DOUBLE)
      FROM away LEFT JOIN (
        SELECT o_custkey % 300 AS a, state, sum(o_orderkey % 7) AS v FROM o WHERE o_orderstatus = 'P' AND seg = 'AUTOMOBILE' GROUP BY ALL) USING (a, state)
      UNION ALL
      SELECT 'AG' || CAST(o_custkey % 300 AS VARCHAR), 'CG', site, state, seg, '05-2001', CAST(count(*) AS DOUBLE) FROM o WHERE o_orderstatus = 'F' GROUP BY ALL),
    wanted AS (SELECT DISTINCT 'AG' || CAST(o_custkey % 400 AS VARCHAR) AS seller_cod, 'CG' AS org, site AS branch, state, seg AS gpd, '{MONTH}' AS month_year
               FROM o WHERE o_orderstatus = 'O'),
    whole AS (SELECT * FROM cur UNION ALL SELECT w.*, 0 FROM wanted w WHERE NOT EXISTS (
      SELECT 1 FROM cur WHERE {' AND '.join(f'cur.{c} = w.{c}' for c in targets.TARGET_KEYS)}))
    SELECT {', '.join(targets.TARGET_KEYS)}, sum(target) AS target,
           CASE WHEN CAST(substring(seller_cod, 3) AS BIGINT) % 2 = 0 THEN 'Seller ' || substring(seller_cod, 3) ELSE '{values.UNKNOWN_SELLER}' END AS seller
    FROM whole GROUP BY {', '.join(targets.TARGET_KEYS)}
    """,
)
def agent_targets(spark, sf):
    place = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("gpd"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("state"),
        F.replace(F.col("n_name"), F.lit("_"), F.lit("-")).alias("branch"),
    )
    order = table(spark, sf, "orders").join(place, "o_custkey")

    def agent(mark, among=300):
        return F.concat(F.lit(mark), (F.col("o_custkey") % among).cast("string"))

    def sheet(rows, keys, value):
        sums = [F.sum(F.when(F.col("gpd") == g, value)).cast("string").alias(g) for g in SEGMENTS]
        return rows.groupBy(agent(" ag").alias("agent"), *keys).agg(*sums)

    local = sheet(order, ["state", "branch"], F.col("o_orderkey") % 11).withColumn("org", F.lit("CG"))
    away = sheet(order.where(F.col("o_orderstatus") == "P"), ["state"], F.col("o_orderkey") % 7).withColumn("org", F.lit("DI"))
    sheets = [
        targets.target_sheet(local, "agent", "org", "state", SEGMENTS, "branch"),
        targets.target_sheet(away, "agent", "org", "state", SEGMENTS),
    ]
    keyed = order.select(
        agent("AG").alias("seller_cod"), agent("AG", 400).alias("collector"), F.lit("CG").alias("org"), F.upper("branch").alias("branch"), "state", "gpd",
        "o_orderstatus",
    )
    stored = keyed.where(F.col("o_orderstatus") == "F").groupBy("seller_cod", "org", "branch", "state", "gpd").agg(F.count(F.lit(1)).cast("double").alias("target"))
    # The stored current month is replaced by the sheets.
    history = stored.withColumn("month_year", F.explode(F.array(F.lit("05-2001"), F.lit(MONTH))))
    collects = keyed.where(F.col("o_orderstatus") == "O").withColumns({"seller_cod": F.col("collector"), "month_year": F.lit(MONTH)})
    segments = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("DESC_GPD")).distinct()
    product = segments.where(F.col("DESC_GPD").isin(SOLD_SEGMENTS)).withColumn("SALES_ORG_COD", F.lit("BRCG")).unionByName(
        segments.where(F.col("DESC_GPD") == "AUTOMOBILE").select(F.lit("Auto mobile ").alias("DESC_GPD"), F.lit("BRDI").alias("SALES_ORG_COD"))
    )
    named = table(spark, sf, "customer").where(F.col("c_custkey") % 2 == 0).select(
        F.concat(F.lit("ag"), (F.col("c_custkey") % 400).cast("string")).alias("seller_cod"),
        F.concat(F.lit("Seller "), (F.col("c_custkey") % 400).cast("string")).alias("seller"),
    ).distinct()
    return targets.agent_targets(sheets, history, collects, product, named, MONTH).select(*targets.TARGET_KEYS, "target", "seller")


# --- open orders: order lines with values, conditions and limits that stand more than once ------------------------------

WALLET_NUMBERS = ["list_price", "price_zd01", "price_zd02", "total_wallet", "open_revenue", "verge"]


@query(
    "wallet_fact",
    tidy_sql(
        f"""
        WITH b AS (SELECT b.*, CAST(qty AS DOUBLE) AS q, CAST(qty AS DOUBLE) * 12.0::DOUBLE / 10.0::DOUBLE AS requested, c_nationkey, n_name, n_regionkey
                   FROM ({BILLS_SQL}) AS b JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE l_linenumber % 4 <> 0)
        SELECT CAST(l_orderkey AS VARCHAR) AS order_no, CAST(l_linenumber AS VARCHAR) AS item_no,
               CASE org {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in values.SALES_ORG_MERGE.items())} ELSE org END AS org,
               CASE WHEN c_nationkey % 5 <> 0 THEN 'Filial A' || CAST(c_nationkey AS VARCHAR) ELSE '{values.UNKNOWN_BRANCH}' END AS branch,
               CAST(ext AS DOUBLE) AS list_price, CAST(ext AS DOUBLE) + CAST(ext AS DOUBLE) * -0.25::DOUBLE AS price_zd01,
               (CAST(ext AS DOUBLE) + CAST(ext AS DOUBLE) * -0.25::DOUBLE) + (CAST(ext AS DOUBLE) + CAST(ext AS DOUBLE) * -0.25::DOUBLE) * -0.5::DOUBLE AS price_zd02,
               abs(requested) - abs(floor(q / 3) * requested / (q * 2)) AS total_wallet,
               CAST(ext AS DOUBLE) / requested * (abs(requested) - abs(floor(q / 3) * requested / (q * 2))) AS open_revenue,
               CASE WHEN part % 3 = 0 AND org IN ('BRCG', 'BRDI') THEN (1 + part % 7) / 100.0::DOUBLE ELSE {volume.DEFAULT_LIMIT} / 100.0::DOUBLE END AS verge
        FROM b
        """,
        ["order_no", "item_no", "org", "branch"],
        WALLET_NUMBERS,
    ),
)
def wallet_fact(spark, sf):
    nation = table(spark, sf, "nation")
    place = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("o_custkey"), "n_name", F.concat(F.lit("U"), F.col("n_regionkey").cast("string")).alias("uf")
    )
    rows = bills(spark, sf).join(place, "o_custkey")
    number, item = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    text = {c: F.lit("x") for c in volume.WALLET_TEXT} | {
        "salesorg": F.col("org"), "custregionship": F.col("uf"), "custcitynameship": F.col("n_name"), "item": item, "order": number,
        "material": F.col("part").cast("string"),
    }
    dates = {c: F.date_format("bill_date", "yyyy/MM/dd") for c in volume.WALLET_DATES}
    rates = {c: F.lit("0") for c in volume.WALLET_NUMBERS} | {
        "deliveredquantity": F.floor(F.col("qty").cast("double") / 3).cast("string"), "reqqttconv": (F.col("qty").cast("double") * 2).cast("string"),
        "zd01": F.lit("-0.25"), "zd02": F.lit("-0.5"),
    }
    wallet = rows.select(*[c.alias(n) for n, c in {**text, **dates, **rates}.items()])
    # Values and conditions stand twice, the second time larger; every fourth item has none and is left out.
    valued = rows.where(F.col("l_linenumber") % 4 != 0).withColumn("factor", F.explode(F.array(F.lit(1), F.lit(3))))
    amount = F.col("ext").cast("double") * F.col("factor")
    vbap = valued.select(
        F.concat(F.lit("00"), number).alias("VBELN"), F.concat(F.lit("0"), item).alias("POSNR"), amount.alias("NETWR"), amount.alias("ZZICMS_IPI_T"),
        F.lit(0.0).alias("MWSBP"), F.col("qty").cast("double").alias("KWMENG"), F.lit(12).alias("UMVKZ"), F.lit(10).alias("UMVKN"),
    )
    zero = [F.lit(0.0).alias(c) for c in ["ZD38", "ZEB1", "BX41", "BX23"]]
    conditions = valued.select(number.alias("VBAK_VBELN"), item.alias("VBAP_POSNR"), amount.alias("ICMI"), *zero)
    part = table(spark, sf, "part")
    limits = part.where(F.col("p_partkey") % 3 == 0).select("p_partkey", F.explode(F.array(F.lit("BRCG"), F.lit("BRDI"))).alias("sales_org_cod"))
    states = F.array(*[F.lit(f"U{i}") for i in range(5)])
    policy = limits.select(
        "sales_org_cod", F.col("p_partkey").cast("string").alias("material_cod"), F.explode(states).alias("ibge_uf_acronyms"),
        (1 + F.col("p_partkey") % 7).alias("low"),
    ).withColumn("ALCADA", F.explode(F.array(F.col("low"), F.col("low") + 5)))
    product = part.select(
        F.col("p_partkey").cast("string").alias("COD_MATERIAL"), F.lit("BRCG").alias("SALES_ORG_COD"), F.lit("1").alias("COD_GPD"), F.lit("d").alias("DESC_GPD"),
        F.lit("g").alias("COD_GPM"),
    )
    sites = region_of(nation.where(F.col("n_nationkey") % 5 != 0))
    fact = volume.wallet_fact(wallet, vbap, conditions, policy, sites, product)
    return tidy(
        fact.select(
            F.col("SALES_ORDER_NUMBER").alias("order_no"), F.col("SALES_ORDER_ITEM").alias("item_no"), F.col("SALES_ORG_COD").alias("org"),
            F.col("BRANCH").alias("branch"), "list_price", "price_zd01", "price_zd02", "total_wallet", F.col("rlv").alias("open_revenue"), "verge",
        )
    )


# --- support tables: lines of ';' files through the job ---------------------------------------------------------------

@query(
    "support_tables",
    f"""
    SELECT DISTINCT CAST(o_orderdate AS DATE) AS share_date, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS share,
           strftime(o_orderdate, '%m/%Y') AS civil_month, CAST(year(o_orderdate) AS INTEGER) AS share_year,
           CAST(month(o_orderdate) AS INTEGER) AS share_month, DATE '{AS_OF}' AS updated, kind
    FROM orders, (VALUES ('share'), ('scrap')) AS k(kind)
    """,
)
def support_tables(spark, sf):
    # The lines of a ';' file: dd/MM/yyyy date and a number with decimal comma.
    line = F.to_csv(
        F.struct(
            F.date_format("o_orderdate", "dd/MM/yyyy").alias("a"),
            F.translate(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), ".", ",").alias("b"),
        ),
        {"sep": ";"},
    )
    raw = table(spark, sf, "orders").select(F.from_csv(line, "a string, b string", {"sep": ";"}).alias("r")).select("r.*")
    names = ["share_date", "share", "civil_month", "share_year", "share_month", "updated"]
    share = support.share(raw.toDF("MES", "SHARE"), AS_OF).toDF(*names).withColumn("kind", F.lit("share"))
    scrap = support.scrap(raw.toDF("Ano civil/mês", "Resultado global"), AS_OF).toDF(*names).withColumn("kind", F.lit("scrap"))
    return share.unionByName(scrap)
