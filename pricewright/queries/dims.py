"""The dimension jobs on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.plans import dimensions
from pricewright.queries.tables import lines, org_of, org_sql, table, tidy, tidy_sql

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


# --- regions: a customer is a city, its nation the state ----------------------------------------

REGION_SQL = """
WITH c AS (SELECT c_custkey AS k, 4 * c_custkey AS id, c_name, lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS uf, n_name
           FROM customer JOIN nation ON c_nationkey = n_nationkey),
city AS (SELECT id + CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS id, 'Á ' || c_name AS nm, uf FROM c),
tax AS (SELECT lpad(CAST(id + CASE WHEN k % 4 = 0 THEN 2 ELSE 0 END AS VARCHAR), 19, '0') AS cod, 'S' || uf AS reg, upper('sap-' || c_name) AS nm,
               CASE WHEN k % 5 = 0 THEN 1 ELSE 0 END AS zf FROM c),
br AS (SELECT 'A' || replace(upper(c_name), ' ', '') AS bk, uf AS bu, n_name AS branch FROM c WHERE k % 2 = 0
       UNION ALL SELECT 'SAP' || upper(c_name), 'S' || uf, 'Sap ' || n_name FROM c WHERE k % 7 = 0),
j AS (SELECT coalesce(CAST(city.id AS VARCHAR), cod) AS "IBGE_SAP_CITY_ID", city.nm AS "IBGE_CITY_NAME", tax.nm AS "SAP_NAME", zf AS "CITY_ZF",
             coalesce(city.nm, tax.nm) AS whole, coalesce(city.uf, reg) AS "IBGE_UF_ACRONYMS"
      FROM city FULL JOIN tax ON city.id = CAST(cod AS BIGINT))
SELECT j."IBGE_SAP_CITY_ID", j."IBGE_CITY_NAME", j."SAP_NAME", CAST(j."CITY_ZF" AS INTEGER) AS "CITY_ZF", translate(upper(whole), 'Á', 'A') AS "IBGE_SAP_CITY_NAME",
       j."IBGE_UF_ACRONYMS", coalesce(a.branch, b.branch) AS "BRANCH"
FROM j LEFT JOIN br a ON a.bk = translate(upper(trim(j."IBGE_CITY_NAME")), 'Á -', 'A') AND a.bu = j."IBGE_UF_ACRONYMS"
       LEFT JOIN br b ON b.bk = replace(j."SAP_NAME", '-', '') AND b.bu = j."IBGE_UF_ACRONYMS"
"""
ID_WIDTH = 19  # digits of any bigint key
REGION_COLUMNS = [
    "IBGE_SAP_CITY_ID", "IBGE_CITY_NAME", "SAP_NAME", "CITY_ZF", "IBGE_SAP_CITY_NAME", "IBGE_UF_ACRONYMS", "BRANCH",
]


@query("region_dimension", REGION_SQL)
def region_dimension(spark, sf):
    place = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("c_custkey").alias("k"), (4 * F.col("c_custkey")).alias("id"), "c_name", "n_name",
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("uf"),
    )
    # Every customer is a city on both sides; shifted ids meet nothing on the other one.
    city = place.select(
        (F.col("id") + F.when(F.col("k") % 3 == 0, 1).otherwise(0)).alias("IBGE_ID"), F.concat(F.lit("Á "), F.col("c_name")).alias("IBGE_NAME"), F.col("uf").alias("IBGE_UF_ACRONYMS")
    )
    taxed = place
    base = {"SPRAS": F.lit("P"), "COUNTRY": F.lit("BR"), "TEXT": F.concat(F.lit("sap-"), F.col("c_name"))}
    code = F.lpad((F.col("id") + F.when(F.col("k") % 4 == 0, 2).otherwise(0)).cast("string"), ID_WIDTH, "0")
    jurisdictions = taxed.withColumns({**base, "TAXJURCODE": F.concat(F.lit("S"), F.col("uf"), code, F.lit(" "))}).unionByName(
        taxed.where(F.col("k") % 5 == 0).withColumns({**base, "TAXJURCODE": F.concat(F.lit("ZF1"), code)})
    ).select("SPRAS", "COUNTRY", "TAXJURCODE", "TEXT")
    branches = place.where(F.col("k") % 2 == 0).select(
        F.concat(F.lit("a-"), F.col("c_name")).alias("city"), F.col("n_name").alias("branch"), "uf"
    ).unionByName(
        place.where(F.col("k") % 7 == 0).select(
            F.concat(F.lit("Sap "), F.col("c_name")).alias("city"), F.concat(F.lit("Sap "), F.col("n_name")).alias("branch"),
            F.concat(F.lit("s"), F.col("uf")).alias("uf"),
        )
    )
    return dimensions.regions(city, jurisdictions, branches, ID_WIDTH).select(*REGION_COLUMNS)


# --- clients: orders are partner records, the status is the activity sector -------------------------

ROLE_OF_STATUS = {"F": "AG", "O": "RE", "P": "WE"}
CLIENT_COLUMNS = [
    "COD_CLIENT", "ORGANIZATION_SALES_COD", "DISTRIBUTION_CHANNEL_COD", "ACTIVITY_SECTOR_COD", "ORDER_ISSUER", "INVOICE_RECEIVER",
    "MERCHANT_RECEIVER", "PAYER", "NAME", "STATE", "SEGMENTATION_GROUP_COD", "SEGMENTATION_GROUP_DESC", "ORGANIZATION_SALES_DESC",
]
ROLE_SQL = ", ".join(
    f"""CAST(trunc(coalesce(CAST(sum(CASE WHEN o_orderstatus = '{s}' THEN o_orderkey + 3 END) AS DOUBLE)
        / nullif(count(CASE WHEN o_orderstatus = '{s}' THEN 1 END), 0), 0)) AS BIGINT) AS "{dimensions.values.PARTNER_ROLES[r]}" """
    for s, r in ROLE_OF_STATUS.items()
)


@query(
    "client_dimension",
    f"""
    WITH p AS (SELECT 1000000000000000000 + o_custkey AS client, {org_sql()} AS org, CAST(o_custkey % 3 AS VARCHAR) AS sector, {ROLE_SQL}
               FROM orders WHERE o_custkey % 11 <> 0 GROUP BY 1, 2, 3),
    s AS (SELECT 1000000000000000000 + c_custkey AS client, c_mktsegment AS seg FROM customer WHERE c_custkey % 6 <> 0)
    SELECT p.client AS "COD_CLIENT", org AS "ORGANIZATION_SALES_COD", '10' AS "DISTRIBUTION_CHANNEL_COD", sector AS "ACTIVITY_SECTOR_COD",
           "ORDER_ISSUER", "INVOICE_RECEIVER", "MERCHANT_RECEIVER", CAST(0 AS BIGINT) AS "PAYER", c_name AS "NAME",
           CAST(c_nationkey AS VARCHAR) AS "STATE", CASE WHEN org = 'BRCG' THEN seg END AS "SEGMENTATION_GROUP_COD",
           CASE WHEN org = 'BRCG' AND seg <> 'BUILDING' THEN 'text ' || seg END AS "SEGMENTATION_GROUP_DESC",
           CASE WHEN org <> 'BRDI' THEN 'Org ' || org END AS "ORGANIZATION_SALES_DESC"
    FROM p LEFT JOIN s ON p.client = s.client LEFT JOIN customer ON p.client = 1000000000000000000 + c_custkey AND c_custkey % 13 <> 0
    """,
)
def client_dimension(spark, sf):
    def code(col):
        return F.concat(F.lit("0"), (F.col(col) + 10**18).cast("string"))

    order = table(spark, sf, "orders")
    role = F
    for status, name in ROLE_OF_STATUS.items():
        role = role.when(F.col("o_orderstatus") == status, name)
    partners = order.select(
        F.when(F.col("o_custkey") % 11 == 0, F.lit("AB12")).otherwise(code("o_custkey")).alias("KUNNR"), org_of().alias("VKORG"),
        F.lit("10").alias("VTWEG"), (F.col("o_custkey") % 3).cast("string").alias("SPART"), role.alias("PARVW"),
        F.col("o_orderkey").cast("string").alias("KUNN2"), F.lit("0003").alias("LIFNR"), F.lit(None).cast("string").alias("PERNR"),
    )
    customer = table(spark, sf, "customer")
    sector = F.explode(F.array(*[F.lit(str(i)) for i in range(3)]))
    empty = {c: F.lit(None).cast("string") for c in dimensions.CLIENT_SALES if c != "KDGRP"}
    sales = customer.where(F.col("c_custkey") % 6 != 0).select(
        code("c_custkey").alias("KUNNR"), F.lit("BRCG").alias("VKORG"), F.lit("10").alias("VTWEG"), sector.alias("SPART"),
        F.col("c_mktsegment").alias("KDGRP"),
    ).withColumns(empty)
    general = customer.where(F.col("c_custkey") % 13 != 0).select(
        code("c_custkey").alias("KUNNR"), F.lit("BR").alias("LAND1"), F.col("c_name").alias("NAME1"), F.col("c_nationkey").cast("string").alias("REGIO"),
        *[F.lit(None).cast("string").alias(c) for c in ["NAME2", "ORT01", "INDTYP", "ERDAT"]],
    )
    segments = customer.where(F.col("c_mktsegment") != "BUILDING").select(
        "c_mktsegment", F.concat(F.lit("text "), F.col("c_mktsegment")).alias("text")
    )
    orgs = order.select(org_of().alias("vkorg")).where(F.col("vkorg") != "BRDI").distinct().withColumn(
        "vtext", F.concat(F.lit("Org "), F.col("vkorg"))
    )
    texts = {"SEGMENTATION_GROUP": (segments, "c_mktsegment", "text"), "ORGANIZATION_SALES": (orgs, "vkorg", "vtext")}
    return dimensions.clients(general, sales, partners, texts, digits=19).select(*CLIENT_COLUMNS)


# --- products: parts, sold under several organisations ----------------------------------------------------

PRODUCT_SQL = f"""
WITH l AS (SELECT l_partkey, l_returnflag, l_suppkey, l_quantity, l_linenumber, {org_sql()} AS org FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
mode1 AS (SELECT l_partkey, org, l_returnflag AS gpd FROM (
            SELECT *, row_number() OVER (PARTITION BY l_partkey, org ORDER BY n DESC, l_returnflag) AS r
            FROM (SELECT l_partkey, org, l_returnflag, count(*) AS n FROM l GROUP BY ALL)) WHERE r = 1),
mode2 AS (SELECT l_partkey, gpm FROM (
            SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, gpm) AS r
            FROM (SELECT l_partkey, 'M' || CAST(l_suppkey % 4 AS VARCHAR) AS gpm, count(*) AS n FROM l GROUP BY ALL)) WHERE r = 1),
u AS (SELECT l_partkey, sum(CAST(l_quantity AS DECIMAL(12,2))) FILTER (l_returnflag = 'A') AS qa, count(*) FILTER (l_returnflag = 'A') AS na FROM l GROUP BY 1)
SELECT lpad(CAST(p_partkey AS VARCHAR), 18, '0') AS "COD_MATERIAL", org AS "SALES_ORG_COD", gpd AS "COD_GPD",
       CASE WHEN gpd <> 'N' THEN 'Group ' || gpd END AS "DESC_GPD", gpm AS "COD_GPM", p_type AS "DESC_GDD", p_name AS "DESC_MATERIAL",
       coalesce(CAST(qa AS DOUBLE) / nullif(na, 0), 0) AS "KG", substring(p_type, 1, 1) AS "COD_HIERARCHY_1",
       CASE WHEN p_type <> 'PROMO' THEN 'H ' || substring(p_type, 1, 1) END AS "DESC_HIERARCHY_1", substring(p_type, 1, 3) AS "COD_HIERARCHY_2"
FROM part JOIN mode1 ON mode1.l_partkey = p_partkey JOIN mode2 ON mode2.l_partkey = p_partkey LEFT JOIN u ON u.l_partkey = p_partkey
WHERE p_name NOT LIKE '%ring%' AND p_size % 5 <> 0
"""
PRODUCT_PLAIN = [
    "COD_MATERIAL", "SALES_ORG_COD", "COD_GPD", "DESC_GPD", "COD_GPM", "DESC_GDD", "DESC_MATERIAL", "COD_HIERARCHY_1",
    "DESC_HIERARCHY_1", "COD_HIERARCHY_2",
]


@query("product_dimension", tidy_sql(PRODUCT_SQL, [f'"{c}"' for c in PRODUCT_PLAIN], ['"KG"']))
def product_dimension(spark, sf):
    part = table(spark, sf, "part")
    matnr = F.lpad(F.col("p_partkey").cast("string"), 18, "0")
    sector = (F.col("p_size") % 3).cast("string")
    material = part.select(
        matnr.alias("MATNR"), sector.alias("spart"), F.col("p_type").alias("prdha"), F.lit("ZERT ").alias("mtart"),
        F.when(F.col("p_size") % 5 == 0, F.lit("01")).otherwise(F.lit(" ")).alias("mstae"),
    )
    name = F.regexp_replace("p_name", "ring", "NAO UTILIZAR")
    names = part.select(F.col("p_partkey").cast("string").alias("matnr"), F.lit("P").alias("spras"), name.alias("maktx"))
    line = lines(spark, sf).select(
        F.col("l_partkey").cast("string").alias("matnr"), F.col("l_returnflag").alias("mvgr1"), F.col("org").alias("vkorg"),
        F.concat(F.lit("M"), (F.col("l_suppkey") % 4).cast("string")).alias("gpm"), "qty",
    )
    # The lines are counted once; groups, sales and marketing are read off the counts.
    sold = line.groupBy("matnr", "mvgr1", "vkorg", "gpm").agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 0")

    def texts(code, text):
        return part.select(F.lit("P").alias("spras"), code, text).distinct()

    groups = sold.where(F.col("mvgr1") != "N").select(
        F.lit("P").alias("spras"), "mvgr1", F.concat(F.lit("Group "), F.col("mvgr1")).alias("bezei")
    ).distinct()
    first = F.substring("p_type", 1, 1)
    # The level-1 texts leave out the promotional types; no other type begins with P.
    hierarchy = texts(first.alias("prodh"), F.concat(F.lit("H "), first).alias("vtext")).where(F.col("prodh") != "P")
    units = table(spark, sf, "lineitem").select(
        F.col("l_partkey").cast("string").alias("matnr"), F.col("l_returnflag").alias("mvgr1"), F.col("l_quantity").alias("qty")
    ).select("matnr", F.when(F.col("mvgr1") == "A", "KG").alias("meinh"), F.col("qty").alias("umrez"), F.lit(1.0).alias("umren"))
    marketing = sold.select(
        F.col("matnr").alias("MATNR"), F.col("gpm").alias("MARKETINGPRODUCTGROUP"),
        F.lit(None).cast("string").alias("DEMANDBREAKDOWNGROUP"), "n_rows",
    ).unionByName(
        part.select(
            F.col("p_partkey").cast("string").alias("MATNR"), F.lit(None).cast("string").alias("MARKETINGPRODUCTGROUP"),
            F.col("p_type").alias("DEMANDBREAKDOWNGROUP"), F.lit(1).cast("bigint").alias("n_rows"),
        )
    )
    sectors = texts(sector.alias("spart"), F.concat(F.lit("Sector "), sector).alias("vtext"))
    out = dimensions.products(material, names, sectors, sold.select("matnr", "mvgr1", "vkorg", "n_rows"), groups, hierarchy, units, marketing)
    return tidy(out.select(*PRODUCT_PLAIN, "KG"))
