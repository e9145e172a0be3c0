"""Pivots, hierarchies, records, ledger, facts and dimensions on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.functions import codes
from pricewright.functions.numbers import parse_number
from pricewright.operators import catalog, filters, ledger, price, reshape
from pricewright.queries.tables import LINES_SQL, lines, org_of, org_sql, table, tidy, tidy_sql

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


# --- pivots ------------------------------------------------------------------------------------

ROLES = {"1-URGENT": "PAYER", "2-HIGH": "ORDER_ISSUER", "3-MEDIUM": "SALES_MANAGER", "5-LOW": "SALES_DIRECTOR"}


@query(
    "role_pivot",
    f"""
    SELECT o_custkey, o_orderstatus,
           {', '.join(f'''CAST(trunc(coalesce(CAST(sum(CASE WHEN o_orderpriority = '{r}' THEN o_orderkey + 10 END) AS DOUBLE)
             / nullif(count(CASE WHEN o_orderpriority = '{r}' THEN 1 END), 0), 0)) AS BIGINT) AS "{n}"''' for r, n in ROLES.items())}
    FROM orders GROUP BY o_custkey, o_orderstatus
    """,
)
def role_pivot(spark, sf):
    partners = table(spark, sf, "orders").withColumn("number", F.col("o_orderkey") + 10)
    return reshape.role_pivot(partners, ["o_custkey", "o_orderstatus"], "o_orderpriority", "number", ROLES)


UNITS = ["R", "A", "N", "X"]


@query(
    "uom_pivot",
    tidy_sql(
        f"""
        WITH f AS (SELECT l_partkey, l_returnflag, CAST(CAST(l_quantity AS DECIMAL(12,2)) AS DOUBLE) / nullif(CAST(l_linenumber - 1 AS DOUBLE), 0) AS factor FROM lineitem)
        SELECT l_partkey, {', '.join(f'''coalesce(CAST(sum(CASE WHEN l_returnflag = '{u}' THEN CAST(factor AS DECIMAL(28,10)) END) AS DOUBLE)
               / nullif(count(CASE WHEN l_returnflag = '{u}' THEN factor END), 0), 0) AS "{u}"''' for u in UNITS)}
        FROM f GROUP BY l_partkey
        """,
        ["l_partkey"],
        [f'"{u}"' for u in UNITS],
    ),
)
def uom_pivot(spark, sf):
    units = table(spark, sf, "lineitem").select(
        "l_partkey", "l_returnflag", F.col("l_quantity").alias("num"), (F.col("l_linenumber") - 1).alias("den")
    )
    return tidy(reshape.uom_pivot(units, "l_partkey", "l_returnflag", "num", "den", UNITS))


CODE_SQL = "CAST(n_regionkey AS VARCHAR) || lpad(CAST(n_nationkey AS VARCHAR), 2, '0')"


@query(
    "prefix_hierarchy",
    f"""
    WITH d AS (SELECT CAST(r_regionkey AS VARCHAR) AS code, r_name AS txt FROM region
               UNION ALL SELECT {CODE_SQL}, n_name FROM nation WHERE n_nationkey % 4 <> 1),
    c AS (SELECT c_custkey, c_name, {CODE_SQL} || lpad(CAST(c_custkey AS VARCHAR), 19, '0') AS code FROM customer JOIN nation ON c_nationkey = n_nationkey)
    SELECT c_custkey, c.code, substring(c.code, 1, 1) AS code_1, a.txt AS desc_1, substring(c.code, 1, 3) AS code_2, b.txt AS desc_2,
           {', '.join(f"substring(c.code, 1, {n}) AS code_{i}, {'CASE WHEN c_custkey % 5 <> 0 THEN c_name END' if n == 22 else 'CAST(NULL AS VARCHAR)'} AS desc_{i}"
                      for i, n in enumerate([5, 8, 12, 17, 22], start=3))}
    FROM c LEFT JOIN d a ON a.code = substring(c.code, 1, 1) AND length(a.code) = 1
           LEFT JOIN d b ON b.code = substring(c.code, 1, 3) AND length(b.code) = 3
    """,
)
def prefix_hierarchy(spark, sf):
    code = F.concat(F.col("n_regionkey").cast("string"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
    nation = table(spark, sf, "nation")
    texts = table(spark, sf, "region").select(
        F.col("r_regionkey").cast("string").alias("prodh"), F.col("r_name").alias("vtext")
    ).unionByName(nation.where(F.col("n_nationkey") % 4 != 1).select(code.alias("prodh"), F.col("n_name").alias("vtext")))
    # Nineteen digits hold every customer key; the deepest level is the whole code.
    customer = table(spark, sf, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "c_custkey", "c_name", F.concat(code, F.lpad(F.col("c_custkey").cast("string"), 19, "0")).alias("code")
    )
    named = customer.where(F.col("c_custkey") % 5 != 0).select(F.col("code").alias("prodh"), F.col("c_name").alias("vtext"))
    texts = texts.unionByName(named)
    return reshape.prefix_hierarchy(customer.drop("c_name"), "code", texts, "prodh", "vtext", [1, 3, 5, 8, 12, 17, 22])


MEASURES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "unpivot_targets",
    f"""
    WITH w AS (SELECT o_custkey % 300 AS a, {org_sql()} AS org, n_name,
                      lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS state,
                      {', '.join(f"CAST(sum(CASE WHEN c_mktsegment = '{m}' THEN o_orderkey % 11 - 4 END) AS BIGINT) AS {m}" for m in MEASURES)}
               FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
    t AS (SELECT * FROM w UNPIVOT INCLUDE NULLS (target FOR product_group IN ({', '.join(MEASURES)})))
    SELECT 'AG_' || CAST(a AS VARCHAR) AS agent_cod, substring(org, 3, 2) AS org_short, state, replace(n_name, '_', '-') AS branch, product_group,
           greatest(coalesce(target, 0), 0) AS target
    FROM t
    """,
)
def unpivot_targets(spark, sf):
    place = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "n_name", F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("state"))
    order = table(spark, sf, "orders")
    key = reshape.target_key(
        F.concat(F.lit("ag_"), (F.col("o_custkey") % 300).cast("string")), F.substring(org_of(), 3, 2), F.col("state"),
        F.replace(F.col("n_name"), F.lit("_"), F.lit("-")),
    )
    wide = order.join(place, "o_custkey").withColumn("key_sellers", key).groupBy("key_sellers").agg(
        *[F.sum(F.when(F.col("c_mktsegment") == m, F.col("o_orderkey") % 11 - 4)).alias(m) for m in MEASURES]
    )
    tall = reshape.unpivot_measures(wide, ["key_sellers"], MEASURES, "product_group", "target")
    return reshape.parse_target_key(tall, "key_sellers", with_branch=True).drop("key_sellers")


# --- records ---------------------------------------------------------------------------------------

@query(
    "json_records",
    """
    SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           event_type AS micro_name, CAST(user_id % 27 AS BIGINT) AS uf_id
    FROM events
    """,
)
def json_records(spark, sf):
    # The record of the cities service: names nested two levels deep.
    city = F.to_json(
        F.struct(
            F.get_json_object("props", "$.k").alias("id"),
            F.struct(
                F.col("event_type").alias("nome"), F.struct((F.col("user_id") % 27).alias("id")).alias("UF")
            ).alias("microrregiao"),
        )
    )
    records = table(spark, sf, "events").select("event_id", "user_id", city.alias("record"))
    return reshape.flatten_json(
        records,
        "record",
        "id string, microrregiao struct<nome: string, UF: struct<id: bigint>>",
        {"id": "id_text", "microrregiao.nome": "micro_name", "microrregiao.UF.id": "uf_id"},
    ).select("event_id", "user_id", F.col("id_text").try_cast("bigint").alias("k"), "micro_name", "uf_id")


@query(
    "xml_records",
    """
    SELECT o_orderkey, o_custkey AS "Client_Cod", o_orderpriority AS "Unit_Measure",
           CAST(o_totalprice AS DECIMAL(18,2))::DOUBLE AS "Price_with_taxes"
    FROM orders
    """,
)
def xml_records(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey",
        F.to_xml(
            F.struct(
                F.col("o_custkey").alias("CIDCustomer"),
                F.col("o_orderpriority").alias("XUnitMeasure_DESC"),
                F.col("o_totalprice").cast("decimal(18,2)").alias("NValueWithTax"),
                F.lit("x").alias("Envelope"),
            ),
            {"rowTag": "SurveyBasic"},
        ).alias("record"),
    )
    flat = reshape.flatten_xml(
        rows,
        "record",
        "CIDCustomer bigint, XUnitMeasure_DESC string, NValueWithTax string",
        {"CIDCustomer": "Client_Cod", "XUnitMeasure_DESC": "Unit_Measure", "NValueWithTax": "price_text"},
    )
    return flat.withColumn("Price_with_taxes", parse_number("price_text")).drop("price_text")


# --- quarantine and ledger -----------------------------------------------------------------------------

def collected(spark, sf):
    """Events as collected prices with holes in the required columns."""
    n = F.col("event_id")
    return table(spark, sf, "events").select(
        n.alias("id"),
        F.col("ts").cast("date").alias("date"),
        F.when(n % 11 != 0, F.col("user_id")).alias("seller"),
        F.when(n % 13 != 0, F.col("event_type")).alias("branch"),
        F.when(n % 17 != 0, F.col("value")).alias("price"),
        F.when(n % 4 == 0, F.lit("Sim")).when(n % 4 == 1, F.lit("Não")).alias("approved_manually"),
        F.when(n % 3 == 0, F.lit("Sim")).when(n % 3 == 1, F.lit("Não")).alias("approved_automatically"),
    )


COLLECTED_SQL = """
SELECT event_id AS id, CAST(ts AS DATE) AS date, CASE WHEN event_id % 11 <> 0 THEN user_id END AS seller,
       CASE WHEN event_id % 13 <> 0 THEN event_type END AS branch,
       CASE WHEN event_id % 17 <> 0 THEN CAST(value AS DECIMAL(14,4)) END AS price,
       CASE event_id % 4 WHEN 0 THEN 'Sim' WHEN 1 THEN 'Não' END AS approved_manually,
       CASE event_id % 3 WHEN 0 THEN 'Sim' WHEN 1 THEN 'Não' END AS approved_automatically
FROM events
"""
REQUIRED = ["seller", "branch", "price"]


@query(
    "quarantine_split",
    tidy_sql(
        f"""
        SELECT id, seller, branch, price, seller IS NULL OR branch IS NULL OR price IS NULL AS rejected FROM ({COLLECTED_SQL}) AS c
        """,
        ["id", "seller", "branch", "rejected"],
        ["price"],
    ),
)
def quarantine_split(spark, sf):
    valid, rejected = filters.quarantine(collected(spark, sf), REQUIRED)
    both = valid.withColumn("rejected", F.lit(False)).unionByName(rejected.withColumn("rejected", F.lit(True)))
    return tidy(both.select("id", "seller", "branch", "price", "rejected"))


LEDGER_DAY = "2024-01-20"
LEDGER_COLUMNS = ["id", "date", "seller", "branch", "approved_manually", "approved_automatically"]


def ledger_inputs(spark, sf):
    day = F.lit(LEDGER_DAY).cast("date")
    rows = collected(spark, sf)
    valid, _ = filters.quarantine(rows, REQUIRED)
    old = valid.where(F.col("date") <= day)
    batch = valid.where(F.col("date") == day).withColumn("id", -F.col("id") - 1).select(
        "id", "date", "seller", "branch", "price"
    )
    event = table(spark, sf, "events")
    reviews = event.where(F.col("event_type") == "click").select(
        (F.col("event_id") - F.col("event_id") % 2).alias("id"),
        F.when(F.col("value") > 25, F.lit("Sim")).otherwise(F.lit("Não")).alias("verdict"),
        F.col("ts").alias("reviewed_at"),
    )
    return old, batch, reviews


LEDGER_SQL = f"""
WITH c AS (SELECT * FROM ({COLLECTED_SQL}) AS x WHERE seller IS NOT NULL AND branch IS NOT NULL AND price IS NOT NULL),
rev AS (SELECT event_id - event_id % 2 AS id, arg_max(CASE WHEN value > 25 THEN 'Sim' ELSE 'Não' END, ts) AS verdict
        FROM events WHERE event_type = 'click' GROUP BY 1),
old AS (SELECT c.id, date, seller, branch, price,
               CASE WHEN verdict IS NOT NULL AND date >= DATE '{LEDGER_DAY}' - 7 THEN verdict ELSE approved_manually END AS approved_manually,
               approved_automatically
        FROM c LEFT JOIN rev ON c.id = rev.id WHERE date < DATE '{LEDGER_DAY}'),
new AS (SELECT -id - 1 AS id, date, seller, branch, price, NULL AS approved_manually, 'Não' AS approved_automatically
        FROM c WHERE date = DATE '{LEDGER_DAY}'),
whole AS (SELECT * FROM old UNION ALL SELECT * FROM new)
SELECT id, date, seller, branch, price,
       CASE WHEN date < DATE '{LEDGER_DAY}' - 7 AND approved_manually IS NULL THEN 'Não' ELSE approved_manually END AS approved_manually,
       approved_automatically
FROM whole
"""


@query("ledger_merge", tidy_sql(LEDGER_SQL, LEDGER_COLUMNS, ["price"]))
def ledger_merge(spark, sf):
    old, batch, reviews = ledger_inputs(spark, sf)
    return tidy(ledger.ledger_merge(old, batch, reviews, LEDGER_DAY).select(*LEDGER_COLUMNS, "price"))


@query(
    "review_worklist",
    f"""
    SELECT id, date, seller, branch, approved_automatically,
           CAST(CAST(coalesce(price, 0) AS DECIMAL(14,2)) AS DOUBLE) AS price
    FROM ({LEDGER_SQL}) AS l
    WHERE approved_manually IS NULL AND coalesce(approved_automatically = 'Não', true) AND date >= DATE '{LEDGER_DAY}' - 7
    """,
)
def review_worklist(spark, sf):
    old, batch, reviews = ledger_inputs(spark, sf)
    merged = ledger.ledger_merge(old, batch, reviews, LEDGER_DAY)
    return tidy(ledger.worklist(merged, LEDGER_DAY, ["price"]).drop("approved_manually"))


# --- volume fact and slicers ---------------------------------------------------------------------------------

FACT = ["org", "order_no", "item_no", "part_no", "branch", "p_type", "order_type", "maker", "order_status"]
FACT_NUMBERS = ["quantity", "open_quantity", "revenue"]
FACT_SQL = f"""
WITH l AS (SELECT l.*, p_type, n_name FROM ({LINES_SQL}) AS l JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
           LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 5 <> 0) AS n ON s_nationkey = n_nationkey),
f AS (SELECT CASE WHEN org = 'BRCO' THEN 'BRCC' ELSE org END AS org, l_orderkey AS order_no, l_linenumber AS item_no, l_partkey AS part_no,
             coalesce(n_name, 'Filial Não Encontrada') AS branch, p_type, l_returnflag AS order_type, l_linestatus, qty, ext FROM l)
SELECT org, order_no, item_no, part_no, branch, p_type, order_type, 'billed' AS maker, 'Completed' AS order_status, qty AS quantity, 0 AS open_quantity, ext AS revenue
FROM f WHERE l_linestatus = 'F' AND order_type IN ('R', 'A') AND qty > 0
UNION ALL
SELECT org, order_no, item_no, part_no, branch, p_type, order_type, 'open', 'Open', qty,
       CAST(qty AS DOUBLE) - abs(CAST(CAST(item_no AS DECIMAL(12,2)) AS DOUBLE) * CAST(qty AS DOUBLE) / (CAST(qty AS DOUBLE) + 1)), ext
FROM f WHERE l_linestatus = 'O' AND order_type IN ('N', 'A')
"""


def _sold(spark, sf):
    """Lines that are billed or open by status and type."""
    kind, status = F.col("l_returnflag"), F.col("l_linestatus")
    billed = (status == "F") & kind.isin("R", "A") & (F.col("qty") > 0)
    return lines(spark, sf).where(billed | ((status == "O") & kind.isin("N", "A")))


def _named(rows, spark, sf):
    """Branch of the seller and type of the part beside rows that hold their keys."""
    nation = table(spark, sf, "nation").where(F.col("n_nationkey") % 5 != 0)
    seller = table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("branch")
    )
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    return catalog.branch_of(rows.join(part, "l_partkey").join(seller, "l_suppkey")).withColumn("org", codes.remap_codes("org"))


def _fact(spark, sf):
    rows = _named(_sold(spark, sf), spark, sf).select(
        "org", F.col("l_orderkey").alias("order_no"), F.col("l_linenumber").alias("item_no"), F.col("l_partkey").alias("part_no"), "branch",
        "p_type", F.col("l_returnflag").alias("order_type"), "l_linestatus", F.col("qty").alias("quantity"), F.col("ext").alias("revenue"),
    )
    backlog = price.wallet_backlog("quantity", "item_no", F.col("quantity").cast("double") + 1, "revenue")
    rows = rows.withColumns({"open_quantity": backlog["open_quantity"], "order_status": F.lit("Open")})
    return catalog.volume_fact_of(rows, F.col("l_linestatus") == "O", [*FACT, *FACT_NUMBERS], ("billed", "open"), "quantity")


@query("volume_fact", tidy_sql(FACT_SQL, FACT, FACT_NUMBERS))
def volume_fact(spark, sf):
    return tidy(_fact(spark, sf))


@query(
    "filter_catalog",
    f"""
    SELECT DISTINCT org, branch, p_type, 'Brazil' AS country FROM (
      SELECT org, branch, p_type FROM ({FACT_SQL}) AS f
      UNION ALL SELECT 'BRCG', n_name, p_type FROM part JOIN nation ON p_size % 25 = n_nationkey
      UNION ALL SELECT 'BRIN', '', p_type FROM part)
    """,
)
def filter_catalog(spark, sf):
    # The slicer columns are made distinct on keys before the names are joined.
    sold = _named(_sold(spark, sf).select("org", "l_partkey", "l_suppkey").distinct(), spark, sf)
    part = table(spark, sf, "part")
    forecast = part.join(table(spark, sf, "nation"), F.col("p_size") % 25 == F.col("n_nationkey")).select(
        F.lit("BRCG").alias("org"), F.col("n_name").alias("branch"), "p_type"
    )
    budget = part.select(F.lit("BRIN").alias("org"), F.lit("").alias("branch"), "p_type")
    return catalog.filter_catalog(
        [sold, forecast, budget], ["org", "branch", "p_type"], {"country": F.lit("Brazil")}
    )
