"""Prices on the test tables: waterfall, cascade, policy, terms, approval, open orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.functions import codes, dates
from pricewright.functions.numbers import number, ratio
from pricewright.operators import catalog, price
from pricewright.operators.joins import lookup, splittable
from pricewright.queries.tables import (
    COLLECTS_SQL, CONDITIONS_SQL, LINES_SQL, MARGIN_SUMS_SQL, PRICED_SQL, collects, conditions, half_up, lines, margin_columns,
    priced_conditions, table, tidy, tidy_sql,
)

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


# --- waterfall ------------------------------------------------------------------------------

ITEM_KEYS = ["l_orderkey", "l_linenumber", "ship_month"]
WATERFALL_KEYS = ["org", *ITEM_KEYS, "p_type"]
WATERFALL_SUMS = [
    "quantity_ton", "zd01", "zd02", "zd03", "zd04", "zd05", "zd06", "zd13", "zd14", "zeaf", "zeb1", "zeb2",
    "zsu2", "icms", "cofins", "pis", "other_taxes", "bx95", "ipi", "bx41", "rbv", "rlv",
]
PER_TON_ABS = [
    "list_price", "zd01", "zd02", "zd03", "zd04", "zd05", "zd06", "zd13", "zd14", "zeaf", "zeb1", "zeb2",
    "zsu2", "icms", "cofins", "pis", "bx95", "ipi", "bx41", "rbv", "rlv", "segment_price",
    "full_customer_price", "rbv_waterfall", "rlv_waterfall", "freight", "op_cost",
]
PER_TON_SIGNED = ["gross_profit_waterfall", "gross_profit", "calculated_taxes", "other_taxes"]


def _monthly(df):
    merged = codes.remap_codes("org")
    return df.withColumns({"ship_month": F.trunc("ship_date", "month"), "org": merged})


MONTHLY_SQL = f"""
SELECT * REPLACE (CASE WHEN org = 'BRCO' THEN 'BRCC' ELSE org END AS org),
       strftime(ship_date, '%m-%Y') AS ship_month
FROM ({CONDITIONS_SQL}) AS c
"""

WATERFALL_SQL = f"""
WITH m AS ({MONTHLY_SQL}),
items AS (
  SELECT {', '.join(WATERFALL_KEYS)}, CAST(sum(list_price) AS DOUBLE) / count(list_price) AS list_price,
         {', '.join(f'CAST(sum({c}) AS DOUBLE) AS {c}' for c in WATERFALL_SUMS)}
  FROM m GROUP BY ALL),
costs AS (SELECT {', '.join(ITEM_KEYS)}, {MARGIN_SUMS_SQL}
          FROM (SELECT m.*, CAST(p_retailprice AS DECIMAL(10,2)) AS retail FROM m JOIN part ON l_partkey = p_partkey
                WHERE l_returnflag <> 'R') AS x GROUP BY ALL),
j AS (SELECT items.*, coalesce(CAST(gross_profit AS DOUBLE), 0) AS gross_profit,
             coalesce(CAST(freight AS DOUBLE), 0) AS freight, coalesce(CAST(op_cost AS DOUBLE), 0) AS op_cost
      FROM items LEFT JOIN costs USING ({', '.join(ITEM_KEYS)})),
s1 AS (SELECT *, icms + cofins + pis + other_taxes + bx95 AS calculated_taxes, list_price + zd02 + zd03 AS segment_price FROM j),
s2 AS (SELECT *, segment_price + zd01 + zd04 + zd05 + zeaf + zeb1 + zeb2 AS full_customer_price FROM s1),
s3 AS (SELECT *, full_customer_price + zd13 + zd14 + zd06 + zsu2 AS rbv_waterfall FROM s2),
s4 AS (SELECT *, rbv_waterfall - abs(calculated_taxes) AS rlv_waterfall FROM s3),
s5 AS (SELECT *, rlv_waterfall - abs(op_cost) - abs(freight) AS gross_profit_waterfall FROM s4)
SELECT {', '.join(WATERFALL_KEYS)}, abs(quantity_ton) AS quantity_ton, gross_profit AS gross_profit_original,
       {', '.join(f'{c} / quantity_ton AS {c}' for c in PER_TON_SIGNED)},
       {', '.join(f'abs({c} / quantity_ton) AS {c}' for c in PER_TON_ABS)}
FROM s5
"""


@query(
    "price_waterfall",
    tidy_sql(
        WATERFALL_SQL, WATERFALL_KEYS, ["quantity_ton", "gross_profit_original", *PER_TON_SIGNED, *PER_TON_ABS]
    ),
)
def price_waterfall(spark, sf):
    # Returned lines have no costs.
    rows = _monthly(margin_columns(conditions(spark, sf), F.col("l_returnflag") != "R"))
    items = price.price_waterfall(rows, WATERFALL_KEYS, margin_keys=ITEM_KEYS)
    return tidy(items.withColumn("ship_month", dates.month_label("ship_month")))


# --- cascade ---------------------------------------------------------------------------------

RATES = {
    "zd01_rate": "-0.01", "zd02_rate": "-l_discount", "zd03_rate": "-0.02", "zd04_rate": "l_tax / 2.0",
    "zd05_rate": "-0.005", "zd06_rate": "-l_discount / 4.0", "zd38_amount": "-l_quantity * 0.25",
    "zd13_rate": "-0.015", "zd14_amount": "-l_quantity * 0.5", "zsu2_rate": "0.01", "zeaf_rate": "l_tax / 3.0",
}


def _cascade_sql() -> tuple[str, list[str]]:
    ctes = ["s0 AS (SELECT l_orderkey, l_linenumber, l_extendedprice AS list_price, "
            + ", ".join(f"CAST({e} AS DOUBLE) AS {n}" for n, e in RATES.items()) + " FROM lineitem)"]
    names, running = ["list_price"], "list_price"
    for i, step in enumerate(price.CASCADE, start=1):
        amount = step.source if step.absolute else f"{running} * {step.source}"
        share = f", {step.source} / nullif({running}, 0) AS {step.name}_share" if step.absolute else ""
        ctes.append(
            f"s{i} AS (SELECT *, {amount} AS {step.name}, {running} + {amount} AS price_{step.name}{share} FROM s{i - 1})"
        )
        names += [step.name, f"price_{step.name}"] + ([f"{step.name}_share"] if step.absolute else [])
        running = f"price_{step.name}"
    return f"WITH {', '.join(ctes)} SELECT l_orderkey, l_linenumber, {', '.join(names)} FROM s{len(price.CASCADE)}", names


CASCADE_SQL, CASCADE_NAMES = _cascade_sql()


@query("discount_cascade", tidy_sql(CASCADE_SQL, ["l_orderkey", "l_linenumber"], CASCADE_NAMES))
def discount_cascade(spark, sf):
    source = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("list_price"),
        *[F.expr(e).cast("double").alias(n) for n, e in RATES.items()],
    )
    return tidy(
        price.discount_cascade(source, "list_price").select("l_orderkey", "l_linenumber", *CASCADE_NAMES)
    )


# --- policy ------------------------------------------------------------------------------------

ALERT_NAMES = ["strategic_price", "normal_price", "normal_price_kg", "gap"]


@query(
    "strategic_price_alert",
    tidy_sql(
        f"""
        WITH c AS ({PRICED_SQL}),
        p AS (SELECT *, CASE WHEN org = 'BRCG' THEN list_price + zd02 + zd03 + zeb2 + bx41
                             ELSE list_price + zd02 + zd03 + zeb2 END AS strategic_price,
                     CASE WHEN org = 'BRCG' THEN practiced_price + abs(zd05) - zeaf + bx41
                          ELSE practiced_price + abs(zd05) - zeaf END AS normal_price FROM c)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, org, strategic_price, normal_price,
               CAST(normal_price AS DOUBLE) / (CAST(quantity_ton AS DOUBLE) * 1000.0) AS normal_price_kg,
               strategic_price - normal_price AS gap
        FROM p
        """,
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "org"],
        ALERT_NAMES,
    ),
)
def strategic_price_alert(spark, sf):
    priced = priced_conditions(spark, sf).withColumns(
        {"strategic_price": price.strategic_price(), "normal_price": price.normal_price()}
    )
    return tidy(
        priced.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "org", "strategic_price", "normal_price",
            price.price_per_kg("normal_price", "quantity_ton").alias("normal_price_kg"),
            (F.col("strategic_price") - F.col("normal_price")).alias("gap"),
        )
    )


LIMITS_SQL = """
SELECT p_partkey AS part_no, o AS org_code, CAST(p_size AS DOUBLE) / 10.0 AS verge
FROM part, (VALUES ('BRCG'), ('BRDI'), ('BRIN')) AS orgs(o) WHERE p_size % 2 = 0
"""


@query(
    "policy_deviation",
    tidy_sql(
        f"""
        WITH lim AS ({LIMITS_SQL}), c AS ({PRICED_SQL}),
        j AS (SELECT c.*, coalesce(verge, 4.0) AS limit_pct, coalesce(verge / 100.0, 0.04) AS limit_rate
              FROM c LEFT JOIN lim ON l_partkey = part_no AND org = org_code),
        k AS (SELECT *, CAST(zd06 AS DOUBLE) / CAST(qty AS DOUBLE) AS r06, CAST(zd13 AS DOUBLE) / CAST(qty AS DOUBLE) AS r13,
                     CAST(zd14 AS DOUBLE) / CAST(qty AS DOUBLE) AS r14,
                     CAST(CASE WHEN zd13 < 0 OR zd14 < 0 THEN rbv - abs(zsu2) + abs(zd13) + abs(zd06) + abs(zd14)
                          ELSE rbv - abs(zsu2) + abs(zd13) + abs(zd06) + abs(zd14) - abs(zeaf) - abs(zeb1) END AS DOUBLE) AS order_price
              FROM j),
        d AS (SELECT *, CASE WHEN abs(r06 + r13 + r14) > 4.0 THEN abs(r06 + r13 + r14) - limit_pct ELSE 0.0 END AS policy_deviation,
                     CAST(CASE WHEN org = 'BRCG' THEN list_price - abs(zd01) - abs(zd02) - abs(zd03) + abs(bx41)
                          ELSE list_price - abs(zd01) - abs(zd02) - abs(zd03) END AS DOUBLE) - abs(order_price * limit_rate) AS policy_price
              FROM k)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, org, limit_pct, order_price, policy_deviation,
               CAST(rbv AS DOUBLE) * policy_deviation AS policy_deviation_value, policy_price,
               CASE WHEN abs(r06) - limit_rate > 0 THEN order_price * (abs(r06) - limit_rate) ELSE 0.0 END AS limit_excess
        FROM d
        """,
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "org"],
        ["limit_pct", "order_price", "policy_deviation", "policy_deviation_value", "policy_price", "limit_excess"],
    ),
)
def policy_deviation(spark, sf):
    limits = table(spark, sf, "part").where(F.col("p_size") % 2 == 0).select(
        F.col("p_partkey").alias("part_no"),
        F.explode(F.array(*[F.lit(o) for o in ("BRCG", "BRDI", "BRIN")])).alias("org_code"),
        (F.col("p_size").cast("double") / 10.0).alias("verge"),
    )
    on = {"l_partkey": "part_no", "org": "org_code"}
    rows = priced_conditions(spark, sf)
    rows = price.with_limit(rows, limits, on, "verge", 4.0, "limit_pct")
    rows = rows.withColumn(
        "limit_rate", F.when(F.col("limit_pct") == 4.0, F.lit(0.04)).otherwise(F.col("limit_pct") / 100.0)
    )
    rows = rows.withColumns(
        {
            "r06": ratio("zd06", "qty"), "r13": ratio("zd13", "qty"), "r14": ratio("zd14", "qty"),
            "order_price": number(price.billed_order_price()),
        }
    )
    rows = rows.withColumns(price.policy_deviation(["r06", "r13", "r14"], "limit_pct", number("rbv")))
    return tidy(
        rows.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "org", "limit_pct", "order_price",
            "policy_deviation", "policy_deviation_value",
            (number(price.policy_price(F.lit(0))) - F.abs(F.col("order_price") * F.col("limit_rate"))).alias("policy_price"),
            price.limit_deviation(F.abs("r06"), "limit_rate", "order_price").alias("limit_excess"),
        )
    )


# --- terms, units, approval -----------------------------------------------------------------------

@query(
    "price_at_terms",
    f"""
    WITH terms AS (SELECT 'Nova ' || o_orderpriority AS term, max(CAST(o_custkey % 7 AS DOUBLE)) / 100.0 AS pct
                   FROM orders WHERE o_orderpriority <> '3-MEDIUM' GROUP BY 1)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           {half_up('l_extendedprice / (1.0::DOUBLE + pct)', 3)} AS price_terms
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN terms ON 'Nova ' || o_orderpriority = term
    """,
)
def price_at_terms(spark, sf):
    order = table(spark, sf, "orders").withColumn("term", F.concat(F.lit(" Nova "), F.col("o_orderpriority"), F.lit(" ")))
    # The rate arrives as text with a decimal comma.
    terms = (
        order.where(F.col("o_orderpriority") != "3-MEDIUM")
        .groupBy(F.trim("term").alias("term_key"))
        .agg(F.max(F.col("o_custkey") % 7).alias("n"))
        .select("term_key", F.concat(F.lit("0,0"), F.col("n").cast("string")).alias("pct"))
    )
    # A handful of terms: the orders look theirs up before the lines do, and a term's orders are split over tasks where the lookup shuffles.
    rated = lookup(order.select(F.col("o_orderkey").alias("l_orderkey"), F.trim("term").alias("term_key")), splittable(terms), ["term_key"], ["pct"])
    return table(spark, sf, "lineitem").join(rated, "l_orderkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        price.price_at_terms("l_extendedprice", "pct").alias("price_terms"),
    )


UNIT_TEXT = {
    0: "POR BARRA", 1: "ROLO 10", 2: "PEÇA", 3: "TONELADA", 4: "CAIXA", 5: "FEIXE", 6: "METRO2", 7: "METRO",
    8: "CENTO", 9: "UNIDADE", 10: "KG", 11: "OUTRO",
}
FACTORS = {"ZBA": 3, "ROL": 5, "ST": 7, "TO": 1000, "KI": 11, "ZFX": 13, "M2": 17, "M": 19, "ZCT": 100, "ZUN": 0}


@query(
    "unit_price",
    tidy_sql(f"""
    WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS p,
                      CASE l_partkey % 12 {' '.join(f"WHEN {k} THEN '{v}'" for k, v in UNIT_TEXT.items())} END AS unit FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, unit,
           CASE WHEN unit LIKE '%BARRA%' THEN p / 3 WHEN unit LIKE '%ROLO%' THEN p / 5 WHEN unit LIKE '%PEÇA%' THEN p / 7
                WHEN unit LIKE '%TONELADA%' THEN p / 1000 WHEN unit LIKE '%CAIXA%' THEN p / 11 WHEN unit LIKE '%FEIXE%' THEN p / 13
                WHEN unit LIKE '%METRO2%' THEN p / 17 WHEN unit LIKE '%METRO%' THEN p / 19 WHEN unit LIKE '%CENTO%' THEN p / 100
                WHEN unit LIKE '%UNIDADE%' THEN NULL ELSE p END AS price_kg
    FROM r
    """, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "unit"], ["price_kg"]),
)
def unit_price(spark, sf):
    unit = codes.case_of((F.col("l_partkey") % 12).cast("string"), {str(k): v for k, v in UNIT_TEXT.items()})
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", unit.alias("unit"),
        *[F.lit(v).alias(k) for k, v in FACTORS.items()],
    )
    return tidy(
        rows.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "unit",
            price.unit_price("l_extendedprice", "unit").alias("price_kg"),
        )
    )


@query(
    "approve_band",
    tidy_sql(
        f"""
        WITH c AS ({COLLECTS_SQL}),
        a AS (SELECT l_returnflag, branch, l_partkey % 50 AS product, {half_up('CAST(sum(CAST(price_kg AS DECIMAL(18,4))) AS DOUBLE) / count(price_kg)', 3)} AS sample_mean
              FROM c WHERE price_kg BETWEEN 2 AND 10 GROUP BY ALL),
        j AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, price_kg, sample_mean,
                     price_kg BETWEEN 2 AND 10 AS pre_approved,
                     sample_mean - {half_up('sample_mean * 0.1::DOUBLE', 3)} AS band_low,
                     sample_mean + {half_up('sample_mean * 0.1::DOUBLE', 3)} AS band_high
              FROM c LEFT JOIN a ON c.l_returnflag = a.l_returnflag AND c.branch = a.branch AND c.l_partkey % 50 = a.product)
        SELECT *, pre_approved AND coalesce(CAST(price_kg AS DOUBLE) > band_low AND CAST(price_kg AS DOUBLE) < band_high, false) AS approved FROM j
        """,
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "pre_approved", "approved"],
        ["price_kg", "sample_mean", "band_low", "band_high"],
    ),
)
def approve_band(spark, sf):
    rows = collects(spark, sf).withColumn("product", F.col("l_partkey") % 50)
    banded = price.approve_band(rows, ["l_returnflag", "branch", "product"], "price_kg")
    return tidy(
        banded.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "pre_approved", "approved", "price_kg",
            "sample_mean", "band_low", "band_high",
        )
    )


@query(
    "wallet_backlog",
    tidy_sql(
        """
        WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS revenue,
                          l_quantity * 12.0 / 10.0 AS requested, floor(l_quantity / 3) AS delivered, l_quantity * 0.9 AS converted
                   FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, requested,
               abs(requested) - abs(delivered * requested / converted) AS open_quantity,
               revenue / requested * (abs(requested) - abs(delivered * requested / converted)) AS open_revenue
        FROM r
        """,
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
        ["requested", "open_quantity", "open_revenue"],
    ),
)
def wallet_backlog(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_extendedprice").alias("revenue"),
        price.requested_quantity("l_quantity", F.lit(12), F.lit(10)).alias("requested"),
        F.floor(F.col("l_quantity") / 3).alias("delivered"),
        (F.col("l_quantity") * 0.9).alias("converted"),
    )
    open_rows = rows.withColumns(price.wallet_backlog("requested", "delivered", "converted", "revenue"))
    return tidy(
        open_rows.select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "requested", "open_quantity", "open_revenue"
        )
    )


@query(
    "sample_keys",
    f"""
    WITH l AS ({LINES_SQL})
    SELECT l_orderkey, l_linenumber,
           org || '_' || l_returnflag || '_' || CAST(l_partkey AS VARCHAR) AS sample_key,
           org || '_' || CAST(l_partkey AS VARCHAR) || '_' || l_returnflag || '_' || l_linestatus || '_' || strftime(ship_date, '%Y-%m-%d') AS invoice_key,
           org || '_' || l_returnflag || '_' || CAST(l_partkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR) || '_' || strftime(ship_date, '%m-%Y') AS seller_key,
           strftime(ship_date, '%m-%Y') AS month_key,
           CAST(l_partkey AS VARCHAR) || ' - ' || p_name AS material,
           'BR' || org || ' - ' || l_returnflag || ' - ' || p_name AS analysis_unit,
           strftime(ship_date, '%Y-%m-%d') || '_' || CAST(o_custkey AS VARCHAR) || '_' || CAST(l_suppkey AS VARCHAR) || '_' || org AS audit_key
    FROM l JOIN part ON l_partkey = p_partkey
    """,
)
def sample_keys(spark, sf):
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    rows = lines(spark, sf).join(part, "l_partkey")
    keyed = catalog.sample_keys(rows, "org", "l_partkey", "l_returnflag", "l_linestatus", "l_suppkey", "ship_date")
    return keyed.select(
        "l_orderkey", "l_linenumber", "sample_key", "invoice_key", "seller_key", "month_key",
        catalog.material_label("l_partkey", "p_name").alias("material"),
        catalog.analysis_unit("org", "l_returnflag", "p_name").alias("analysis_unit"),
        catalog.audit_key("ship_date", "o_custkey", "l_suppkey", "org").alias("audit_key"),
    )
