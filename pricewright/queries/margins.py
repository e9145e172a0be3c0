"""Margins on the test tables: profit stacks, rollups, trailing means, shares, apportionment."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.functions.dates import fiscal_period, month_label
from pricewright.functions.numbers import snap
from pricewright.operators import margin as ops
from pricewright.queries.tables import (
    CONDITIONS_SQL, LINES_SQL, MARGIN_SUMS_SQL, as_double, conditions, lines, margin_columns, table, tidy, tidy_sql,
)

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


# --- gross profit: accounts derived from the line, summed into stacks --------------------------

ACCOUNTS = {
    "acc_sales": "ext",
    "acc_extra": "qty * 0.10",
    "acc_tax": "ext * tax",
    "acc_discount": "ext * disc",
    "acc_material": "qty * 12.50",
    "acc_energy": "qty * 1.75",
    "acc_freight": "qty * 2.20",
    "acc_return_freight": "qty * 0.20",
    "acc_loading": "qty * 0.30",
    "acc_port": "qty * 0.05",
    "acc_adjust": "ext * 0.002",
    "acc_commission": "-ext * 0.01",
}
STACKS = {
    "GROSS_SALES": "+acc_sales +acc_extra",
    "SALES_TAX_DISCOUNT": "-acc_tax -acc_discount",
    "COGS_TOTAL": "-acc_material -acc_energy",
    "CUSTO_OPERACIONAL": "+acc_material +acc_energy",
    "FREIGHT": "-acc_freight +acc_return_freight",
    "SHIP_DEL_LOAD_C_C": "-acc_loading",
    "PORT_EXPENSES": "+acc_port",
    "COGS_ADJUSTMENTS": "-acc_adjust",
    "COMISSION_TO_AGENTS": "+acc_commission",
}
PROFIT_KEYS = ["l_orderkey", "l_linenumber", "ship_month"]
PROFIT_NUMBERS = ["QUANTITY_TON", *STACKS, "NET_SALES", "GROSS_PROFIT_BW"]


def _accounts(df):
    return df.withColumns(
        {
            "ship_month": F.trunc("ship_date", "month"),
            **{n: F.expr(as_double(e)) for n, e in ACCOUNTS.items()},
        }
    )


ACCOUNTS_SQL = f"""
SELECT *, strftime(ship_date, '%Y-%m') AS ship_month,
       {', '.join(f'CAST({e} AS DECIMAL(18,6)) AS {n}' for n, e in ACCOUNTS.items())}
FROM ({LINES_SQL}) AS l
"""
NET = "acc_sales + acc_extra - acc_tax - acc_discount"
PROFIT = (
    f"{NET} - acc_material - acc_energy - acc_freight + acc_return_freight - acc_loading + acc_port "
    "- acc_adjust + acc_commission"
)


@query(
    "gross_profit",
    tidy_sql(
        f"""
        SELECT l_orderkey, l_linenumber, ship_month, min(org) AS org, min(l_partkey) AS l_partkey,
               CAST(sum(qty) AS DOUBLE) / 1000.0 AS "QUANTITY_TON", sum(acc_sales + acc_extra) AS "GROSS_SALES",
               sum(-acc_tax - acc_discount) AS "SALES_TAX_DISCOUNT", sum(-acc_material - acc_energy) AS "COGS_TOTAL",
               sum(acc_material + acc_energy) AS "CUSTO_OPERACIONAL", sum(-acc_freight + acc_return_freight) AS "FREIGHT",
               sum(-acc_loading) AS "SHIP_DEL_LOAD_C_C", sum(acc_port) AS "PORT_EXPENSES", sum(-acc_adjust) AS "COGS_ADJUSTMENTS",
               sum(acc_commission) AS "COMISSION_TO_AGENTS", sum({NET}) AS "NET_SALES", sum({PROFIT}) AS "GROSS_PROFIT_BW"
        FROM ({ACCOUNTS_SQL}) AS a GROUP BY l_orderkey, l_linenumber, ship_month
        """,
        ["l_orderkey", "l_linenumber", "ship_month", "org", "l_partkey"],
        PROFIT_NUMBERS,
    ),
)
def gross_profit(spark, sf):
    facts = ops.gross_profit(
        _accounts(lines(spark, sf)), PROFIT_KEYS, ["org", "l_partkey"], STACKS, quantity="qty"
    )
    return tidy(facts.withColumn("ship_month", month_label("ship_month", "yyyy-MM")))


# --- rollup --------------------------------------------------------------------------------------

GRAINS = {
    "order_item_month": ["ship_month", "l_orderkey", "l_linenumber"],
    "order_item": ["l_orderkey", "l_linenumber"],
    "sku_org_branch_client": ["ship_month", "l_partkey", "org", "l_suppkey", "o_custkey"],
    "sku_org": ["ship_month", "l_partkey", "org"],
    "group_org": ["ship_month", "p_type", "org"],
    "group": ["ship_month", "p_type"],
    "month_sku_state": ["ship_month", "l_partkey", "l_returnflag"],
}
ROLLUP_DIMS = list(dict.fromkeys(c for g in GRAINS.values() for c in g))
ROLLUP_SUMS = ["qty", "ext", "cost", "freight", "profit"]
ROLLUP_SQL = f"""
WITH r AS (
  SELECT *, strftime(ship_date, '%Y-%m') AS ship_month, CAST(qty * 12.50 AS DECIMAL(18,4)) AS cost,
         CAST(qty * 2.20 AS DECIMAL(18,4)) AS freight,
         CAST(ext * (1.00 - disc) - qty * 14.70 AS DECIMAL(18,4)) AS profit,
         CAST(practiced_price AS DECIMAL(14,4)) AS pp
  FROM ({CONDITIONS_SQL}) AS c),
g AS (
  SELECT GROUPING_ID({', '.join(ROLLUP_DIMS)}) AS gid, {', '.join(ROLLUP_DIMS)},
         {', '.join(f'sum({c}) AS {c}' for c in ROLLUP_SUMS)}, sum(pp) AS sp, sum(qty) AS sw, sum(pp * qty) AS spw
  FROM r GROUP BY GROUPING SETS ({', '.join('(' + ', '.join(g) + ')' for g in GRAINS.values())}))
SELECT CASE gid {' '.join(
    f"WHEN {sum(1 << (len(ROLLUP_DIMS) - 1 - i) for i, c in enumerate(ROLLUP_DIMS) if c not in g)} THEN '{n}'"
    for n, g in GRAINS.items())} END AS grain,
       {', '.join(ROLLUP_DIMS)}, {', '.join(ROLLUP_SUMS)}, CAST(spw AS DOUBLE) / CAST(sw AS DOUBLE) AS pp,
       CAST(sp AS DOUBLE) / CAST(spw AS DOUBLE) AS pp_reciprocal
FROM g
"""


@query(
    "gross_profit_rollup",
    tidy_sql(ROLLUP_SQL, ["grain", *ROLLUP_DIMS], [*ROLLUP_SUMS, "pp", "pp_reciprocal"]),
)
def gross_profit_rollup(spark, sf):
    rows = conditions(spark, sf).select(
        F.trunc("ship_date", "month").alias("ship_month"), "l_orderkey", "l_linenumber", "l_partkey", "org",
        "l_suppkey", "o_custkey", "p_type", "l_returnflag", "qty", "ext",
        F.expr("qty * 12.50D").alias("cost"),
        F.expr("qty * 2.20D").alias("freight"),
        F.expr("ext * (1 - disc) - qty * 14.70D").alias("profit"),
        F.col("practiced_price").alias("unit_price"),
    )
    rolled = ops.margin_rollup(rows, GRAINS, ROLLUP_SUMS, {"pp": ("unit_price", "qty")}, placed_by=GRAINS["order_item"])
    return tidy(rolled.withColumn("ship_month", month_label("ship_month", "yyyy-MM")))


# --- trailing means ---------------------------------------------------------------------------------

WINDOWS = {"last_3": ([7, 8, 9], 3), "year": ([1, 2, 3, 4, 5, 7, 8, 9], 9)}


def _in(months):
    return ", ".join(str(m) for m in months)


@query(
    "trailing_averages",
    tidy_sql(
        f"""
        SELECT l_partkey, org, y, sum(ext) AS revenue, sum(qty) AS volume,
               CAST(sum(CASE WHEN m IN ({_in(WINDOWS['last_3'][0])}) THEN ext END) AS DOUBLE) / 3.0 AS avg_revenue_last_3,
               CAST(sum(CASE WHEN m IN ({_in(WINDOWS['last_3'][0])}) THEN qty END) AS DOUBLE) / 3.0 AS avg_volume_last_3,
               CAST(sum(CASE WHEN m IN ({_in(WINDOWS['year'][0])}) THEN ext END) AS DOUBLE) / 9.0 AS avg_revenue_year,
               CAST(sum(CASE WHEN m IN ({_in(WINDOWS['year'][0])}) THEN qty END) AS DOUBLE) / 9.0 AS avg_volume_year
        FROM (SELECT *, month(order_date) AS m, CAST(year(order_date) AS INTEGER) AS y FROM ({LINES_SQL}) AS l) AS x
        WHERE m IN ({_in(WINDOWS['year'][0])}) GROUP BY l_partkey, org, y
        """,
        ["l_partkey", "org", "y"],
        ["revenue", "volume", "avg_revenue_last_3", "avg_volume_last_3", "avg_revenue_year", "avg_volume_year"],
    ),
)
def trailing_averages(spark, sf):
    rows = lines(spark, sf).select(
        "l_partkey", "org", F.year("order_date").alias("y"), F.month("order_date").alias("m"), F.col("ext").alias("revenue"), F.col("qty").alias("volume")
    )
    return tidy(ops.trailing_means(rows, ["l_partkey", "org", "y"], "m", ["revenue", "volume"], WINDOWS))


# --- shares and apportionment -------------------------------------------------------------------------

@query(
    "share_of_parent",
    tidy_sql(
        f"""
        WITH c AS (SELECT org, n_regionkey, n_name, sum(qty) AS qty_child
                   FROM ({LINES_SQL}) AS l JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
                   GROUP BY ALL)
        SELECT org, n_regionkey, n_name, qty_child, sum(qty_child) OVER (PARTITION BY org, n_regionkey) AS qty_parent,
               CAST(qty_child AS DOUBLE) / CAST(sum(qty_child) OVER (PARTITION BY org, n_regionkey) AS DOUBLE) AS share
        FROM c
        """,
        ["org", "n_regionkey", "n_name"],
        ["qty_child", "qty_parent", "share"],
    ),
)
def share_of_parent(spark, sf):
    where = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("c_custkey").alias("o_custkey"), "n_regionkey", "n_name")
    rows = lines(spark, sf).join(where, "o_custkey")
    return tidy(ops.share_of_parent(rows, ["org", "n_regionkey", "n_name"], ["org", "n_regionkey"], "qty"))


@query(
    "apportion_cost",
    tidy_sql(
        f"""
        WITH l AS (SELECT *, CAST(strftime(ship_date, '%Y') || '0' || strftime(ship_date, '%m') AS INTEGER) AS period,
                          l_suppkey % 10 AS centre FROM ({LINES_SQL}) AS x),
        v AS (SELECT period, centre, l_partkey, sum(CASE WHEN l_returnflag = 'R' THEN -qty ELSE qty END) AS v FROM l GROUP BY ALL),
        p AS (SELECT period, centre, sum(v) AS pv FROM v GROUP BY ALL),
        cost AS (SELECT period, centre, sum(CAST(ext * 0.03 AS DECIMAL(18,4))) AS pool FROM l WHERE l_linestatus = 'F' AND period >= 1996001 GROUP BY ALL),
        r AS (SELECT period, centre, l_partkey,
                     (CAST(pool AS DOUBLE) * CASE WHEN pv > 0 THEN CAST(v AS DOUBLE) / CAST(pv AS DOUBLE) ELSE 0.0 END) / nullif(CAST(v AS DOUBLE), 0) AS unit_cost
              FROM v JOIN p USING (period, centre) JOIN cost USING (period, centre))
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, period,
               coalesce(-CAST(qty AS DOUBLE) * unit_cost, 0.0) AS apportioned_cost
        FROM l LEFT JOIN r USING (period, centre, l_partkey)
        """,
        ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "period"],
        ["apportioned_cost"],
    ),
)
def apportion_cost(spark, sf):
    rows = lines(spark, sf).withColumns(
        {"period": fiscal_period(F.date_format("ship_date", "yyyy'0'MM")), "centre": F.col("l_suppkey") % 10}
    )
    booked = (F.col("l_linestatus") == "F") & (F.col("period") >= 1996001)
    figures = rows.withColumns(
        {
            "volume": F.when(F.col("l_returnflag") == "R", -F.col("qty")).otherwise(F.col("qty")),
            "cost": F.when(booked, F.col("ext") * 0.03),
        }
    )
    rates = ops.cost_rates_of(figures, ["period", "centre"], ["l_partkey"], "cost", "volume")
    out = ops.apportion_cost(rows, rates, ["period", "centre", "l_partkey"], "qty")
    return tidy(out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "period", "apportioned_cost"))


# --- dispersion map -------------------------------------------------------------------------------------

DISP_KEYS = ["org", "l_orderkey", "l_linenumber", "ship_month", "p_type"]
DISP_ITEM = ["l_orderkey", "l_linenumber", "ship_month"]
DISP_KEPT = ["gross_profit", "freight", "op_cost", "practiced_price", "rlv"]
DISP_SCALED = ["gross_profit", "practiced_price", "calculated_taxes", *ops.DISPERSION_SUMS, "freight", "op_cost"]
DISP_NUMBERS = ["quantity_ton", *[f"{c}_original" for c in DISP_KEPT], *DISP_SCALED]
DISP_SQL = f"""
WITH c AS (SELECT *, strftime(ship_date, '%m-%Y') AS ship_month, CAST(practiced_price AS DECIMAL(14,4)) AS pp4 FROM ({CONDITIONS_SQL}) AS x),
items AS (SELECT {', '.join(DISP_KEYS)}, CAST(sum(pp4 * qty) AS DOUBLE) AS pv, CAST(sum(qty) AS DOUBLE) AS quantity_ton,
          {', '.join(f'CAST(sum({s}) AS DOUBLE) AS {s}' for s in ops.DISPERSION_SUMS)} FROM c GROUP BY ALL),
costs AS (SELECT {', '.join(DISP_ITEM)}, {MARGIN_SUMS_SQL}
          FROM (SELECT c.*, CAST(p_retailprice AS DECIMAL(10,2)) AS retail FROM c JOIN part ON l_partkey = p_partkey) AS y GROUP BY ALL),
j AS (SELECT items.*, pv / quantity_ton AS practiced_price, icms + cofins + pis + other_taxes + bx95 AS calculated_taxes,
             coalesce(CAST(gross_profit AS DOUBLE), 0) AS gross_profit, coalesce(CAST(freight AS DOUBLE), 0) AS freight,
             coalesce(CAST(op_cost AS DOUBLE), 0) AS op_cost
      FROM items LEFT JOIN costs USING ({', '.join(DISP_ITEM)}))
SELECT {', '.join(DISP_KEYS)}, quantity_ton, {', '.join(f'{c} AS {c}_original' for c in DISP_KEPT)},
       {', '.join(f'{c} / quantity_ton / 1000.0 AS {c}' for c in DISP_SCALED)} FROM j
"""


@query(
    "dispersion_map",
    f"SELECT * FROM ({tidy_sql(DISP_SQL, DISP_KEYS, DISP_NUMBERS[: -len(DISP_SCALED)])}) AS a"
    f" JOIN ({tidy_sql(DISP_SQL, DISP_KEYS, DISP_SCALED, digits=12)}) AS b USING ({', '.join(DISP_KEYS)})",
)
def dispersion_map(spark, sf):
    month = {"ship_month": F.trunc("ship_date", "month")}
    rows = margin_columns(conditions(spark, sf)).withColumns(month)
    items = ops.dispersion_map(rows, DISP_KEYS, margin_keys=DISP_ITEM)
    labelled = items.withColumn("ship_month", month_label("ship_month"))
    # Figures per kg are small: they are compared to twelve decimals.
    return labelled.withColumns({c: snap(c, 12 if c in DISP_SCALED else 6) for c in DISP_NUMBERS})
