"""Smaller whole jobs on the test tables: CRM prices, spliced forecast, budget, the audit day."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.plans import audit, survey, volume
from pricewright.queries import assembly
from pricewright.queries.tables import org_of, org_sql, table, tidy, tidy_sql

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def add(fn):
        QUERIES[name] = fn
        ORACLE[name] = sql
        return fn

    return add


def _text(number, prefix=""):
    return F.concat(F.lit(prefix), number.cast("string"))


# --- CRM prices: a price knows its market share, which knows account, owner and product ----------------------------------

@query(
    "crm_rows",
    tidy_sql(
        f"""
        WITH p AS (SELECT l.*, {org_sql()} AS org4, o_custkey FROM lineitem AS l JOIN orders ON l_orderkey = o_orderkey WHERE l_linenumber % 5 <> 0)
        SELECT l_orderkey AS order_no, CAST(l_shipdate AS DATE) AS day, CASE WHEN org4 IN ('BRCC', 'BRCO') THEN 'CC' WHEN org4 = 'BRDI' THEN 'DI' ELSE 'IN' END AS org, p_brand AS gpm, p_type AS gpd,
               CAST(p_partkey AS VARCHAR) AS product_cod, p_name AS product,
               CASE WHEN has_share THEN 'u' || CAST(o_custkey % 100 AS VARCHAR) END AS seller_cod,
               CASE WHEN has_share AND o_custkey % 100 < 90 THEN 'Seller ' || CAST(o_custkey % 100 AS VARCHAR) END AS seller,
               '0' || CAST(c_custkey AS VARCHAR) AS client_cod, c_name AS client,
               n_name AS city, 'M' || CAST(l_suppkey % 9 AS VARCHAR) AS maker, l_returnflag AS channel, CAST(l_extendedprice AS DECIMAL(14,2)) AS price_with_taxes
        FROM (SELECT *, l_orderkey % 7 <> 0 AS has_share FROM p) AS p
             LEFT JOIN customer ON has_share AND o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
             LEFT JOIN part ON has_share AND l_orderkey % 150 + 1 = p_partkey
        """,
        ["order_no", "day", "org", "gpm", "gpd", "product_cod", "product", "seller_cod", "seller", "client_cod", "client", "city", "maker", "channel"],
        ["price_with_taxes"],
    ),
)
def crm_rows(spark, sf):
    order, item = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    shares = order.where(F.col("o_orderkey") % 7 != 0).select(
        _text(F.col("o_orderkey"), "s").alias("id"), _text(F.col("o_custkey"), "a").alias("account_id"),
        _text(F.col("o_custkey") % 100, "u").alias("owner_id"), _text(F.col("o_orderkey") % 150 + 1, "p").alias("product_id"),
    )
    lines = item.join(order, item["l_orderkey"] == order["o_orderkey"])
    prices = lines.select(
        _text(F.col("l_orderkey"), "s").alias("share_id"), F.col("l_returnflag").alias("price_type"), _text(F.col("l_orderkey")).alias("unit"),
        F.when(F.col("l_linenumber") % 5 != 0, F.translate(F.col("l_extendedprice").cast("decimal(14,2)").cast("string"), ".", ",")).alias("price"),
        F.lit("30").alias("term"), _text(F.col("l_suppkey") % 9, "M").alias("competitor"), F.date_format("l_shipdate", "yyyy/MM/dd").alias("created"),
        F.concat(org_of(), F.lit("-1")).alias("org_code"),
    )
    accounts = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        _text(F.col("c_custkey"), "a").alias("id"), _text(F.col("c_custkey")).alias("client_cod"), F.col("c_name").alias("client"),
        F.col("n_name").alias("city"), _text(F.col("n_regionkey"), "U").alias("state"), F.lit("o").alias("office"),
    )
    users = order.select((F.col("o_custkey") % 100).alias("u")).distinct().select(
        _text(F.col("u"), "u").alias("id"), _text(F.col("u"), "u").alias("seller_cod"), F.when(F.col("u") < 90, _text(F.col("u"), "Seller ")).alias("seller")
    )
    goods = table(spark, sf, "part").select(
        _text(F.col("p_partkey"), "p").alias("id"), F.lpad(_text(F.col("p_partkey")), 9, "0").alias("product_cod"), F.col("p_name").alias("product"),
        F.col("p_brand").alias("gpm"), F.col("p_type").alias("gpd"),
    )
    rows = survey.crm_rows(prices, accounts, users, goods, shares)
    return tidy(
        rows.select(
            F.col("unit").cast("bigint").alias("order_no"), "day", "org", "gpm", "gpd", "product_cod", "product", "seller_cod", "seller", "client_cod",
            "client", "city", "maker", "channel", "price_with_taxes",
        )
    )


# --- forecast and budget with the groups of the product dimension ---------------------------------------------------------

MONTH = "199806"
GROUP_SQL = """
SELECT CAST(p_partkey % 40 AS VARCHAR) AS gpd_cod, 'BRCG' AS org, min(struct_pack(a := p_type, b := p_brand)) AS g FROM part WHERE p_partkey % 40 < 35 GROUP BY ALL
"""


def _products(spark, sf):
    key = F.col("p_partkey") % 40
    return table(spark, sf, "part").where(key < 35).select(
        _text(key).alias("COD_GPD"), F.lit("BRCG").alias("SALES_ORG_COD"), F.col("p_type").alias("DESC_GPD"), F.col("p_brand").alias("COD_GPM")
    )


@query(
    "spliced_forecast",
    tidy_sql(
        f"""
        WITH o AS (SELECT strftime(o_orderdate, '%Y%m') AS month_year, o_custkey % 27 AS s, CAST(o_orderkey % 40 AS VARCHAR) AS gpd_cod,
                          CASE WHEN o_orderkey % 3 = 0 THEN 'BRCG' ELSE 'BRDI' END AS org, CAST(o_totalprice AS DECIMAL(14,2)) AS v FROM orders),
        parts AS (
          SELECT month_year, CASE WHEN s > 0 THEN 'U' || CAST(s AS VARCHAR) END AS state, gpd_cod, org, v FROM o WHERE month_year < '{MONTH}'
          UNION SELECT month_year, CASE WHEN s > 0 THEN 'U' || CAST(s AS VARCHAR) ELSE 'NA' END, gpd_cod, org, v * 2 FROM o WHERE month_year >= '{MONTH}'
          UNION SELECT month_year, 'F', gpd_cod, org, v * 3 FROM o WHERE month_year > '{MONTH}')
        SELECT month_year, state, p.gpd_cod, p.org, g.a AS gpd, g.b AS gpm, v AS volume FROM parts AS p LEFT JOIN ({GROUP_SQL}) AS x ON p.gpd_cod = x.gpd_cod AND p.org = x.org
        """,
        ["month_year", "state", "gpd_cod", "org", "gpd", "gpm"],
        ["volume"],
    ),
)
def spliced_forecast(spark, sf):
    order, state = table(spark, sf, "orders"), F.col("o_custkey") % 27

    def source(named, factor):
        value = (F.col("o_totalprice").cast("decimal(14,2)") * factor).cast("decimal(18,2)").cast("string")
        return order.select(
            F.lit("T").alias("MEASURE_UNIT"), F.date_format("o_orderdate", "yyyyMM").alias("MONTH_YEAR"), named.alias("STATE"),
            _text(F.col("o_orderkey") % 40).alias("GPD_COD"), F.when(F.col("o_orderkey") % 3 == 0, "BRCG").otherwise("BRDI").alias("SALES_ORG_COD"),
            F.lit("o").alias("SALES_OFFICE"), F.translate(value, ".", ",").alias("VOLUME"),
        )

    known = F.when(state > 0, _text(state, "U"))
    out = volume.spliced_forecast(source(known, 1), source(known, 2), source(F.lit("F"), 3), _products(spark, sf), MONTH)
    return tidy(
        out.select(
            F.col("MONTH_YEAR").alias("month_year"), F.col("STATE").alias("state"), F.col("GPD_COD").alias("gpd_cod"), F.col("SALES_ORG_COD").alias("org"),
            F.col("DESC_GPD").alias("gpd"), F.col("DESC_GPM").alias("gpm"), F.col("VOLUME").alias("volume"),
        )
    )


@query(
    "budget_table",
    tidy_sql(
        f"""
        SELECT o_orderkey AS line, CAST(o_orderkey % 40 AS VARCHAR) AS gpd_cod, g.a AS gpd, g.b AS gpm, CAST(o_totalprice AS DECIMAL(14,2)) AS value_brl,
               CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey END AS volume
        FROM orders LEFT JOIN ({GROUP_SQL}) AS x ON CAST(o_orderkey % 40 AS VARCHAR) = x.gpd_cod
        """,
        ["line", "gpd_cod", "gpd", "gpm"],
        ["value_brl", "volume"],
    ),
)
def budget_table(spark, sf):
    budget = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("line"), _text(F.col("o_orderkey") % 40).alias("GPD_COD"), F.lit("BRCG").alias("SALES_ORG_COD"),
        F.translate(F.col("o_totalprice").cast("decimal(14,2)").cast("string"), ".", ",").alias("VALUE_BRL"),
        # A volume nobody could read.
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("n/a")).otherwise(_text(F.col("o_custkey"), " ")).alias("VOLUME"),
    )
    out = volume.budget_table(budget, _products(spark, sf))
    return tidy(
        out.select(
            "line", F.col("GPD_COD").alias("gpd_cod"), F.col("DESC_GPD").alias("gpd"), F.col("DESC_GPM").alias("gpm"),
            F.col("VALUE_BRL").alias("value_brl"), F.col("VOLUME").alias("volume"),
        )
    )


# --- the audit day: what is collected goes to the ledger or to the rejected, the open rows to the auditors -------------------

DAY = assembly.LEDGER_DAY
AUDIT_SQL = f"""
WITH c AS (SELECT *, seller IS NULL OR branch IS NULL OR price IS NULL AS bad FROM ({assembly.COLLECTED_SQL}) AS x),
old AS (SELECT * FROM c WHERE NOT bad AND date < DATE '{DAY}'),
rev AS (SELECT event_id - event_id % 2 AS id, arg_max(CASE WHEN value > 25 THEN 'Sim' ELSE 'Não' END, ts) AS verdict
        FROM events WHERE event_type = 'click' GROUP BY 1),
merged AS (
  SELECT old.id, date, price, approved_automatically,
         CASE WHEN verdict IS NOT NULL AND date >= DATE '{DAY}' - 7 THEN verdict ELSE approved_manually END AS approved_manually
  FROM old LEFT JOIN rev ON old.id = rev.id
  UNION ALL SELECT -id - 1, date, price, 'Não', NULL FROM c WHERE NOT bad AND date = DATE '{DAY}'),
ledger AS (SELECT * REPLACE (CASE WHEN date < DATE '{DAY}' - 7 AND approved_manually IS NULL THEN 'Não' ELSE approved_manually END AS approved_manually) FROM merged)
SELECT 'ledger' AS part, id, date, approved_manually, price FROM ledger
UNION ALL SELECT 'rejected', -id - 1, date, NULL, price FROM c WHERE bad AND date = DATE '{DAY}'
UNION ALL SELECT 'worklist', id, date, approved_manually, CAST(coalesce(price, 0) AS DECIMAL(14,2)) FROM ledger
  WHERE approved_manually IS NULL AND coalesce(approved_automatically = 'Não', true) AND date >= DATE '{DAY}' - 7
"""


@query("audit_day", tidy_sql(AUDIT_SQL, ["part", "id", "date", "approved_manually"], ["price"]))
def audit_day(spark, sf):
    old, _, reviews = assembly.ledger_inputs(spark, sf)
    names = {"seller": "seller_cod", "price": "price_kg"}
    today = assembly.collected(spark, sf).where(F.col("date") == F.lit(DAY).cast("date")).select(
        (-F.col("id") - 1).alias("id"), "date", "seller", "branch", "price", F.lit("c").alias("client_cod")
    )
    parts = audit.audit_day(old.withColumn("client_cod", F.lit("c")).withColumnsRenamed(names), today.withColumnsRenamed(names), reviews, DAY)
    whole = None
    for name, frame in parts.items():
        manual = F.col("approved_manually") if "approved_manually" in frame.columns else F.lit(None).cast("string")
        rows = frame.select(F.lit(name).alias("part"), "id", "date", manual.alias("approved_manually"), F.col("price_kg").cast("double").alias("price"))
        whole = rows if whole is None else whole.unionByName(rows)
    return tidy(whole)
