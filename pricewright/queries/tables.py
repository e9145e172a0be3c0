"""The test tables seen as billing, order and target data, for Spark and for the SQL oracle.

Each ``*_SQL`` text is the oracle's version of the frame of the same name.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, DoubleType

from pricewright.functions.numbers import snap
from pricewright.sources.readers import read_table

AS_OF = "2001-07-15"

ORG_BY_PRIORITY = {
    "1-URGENT": "BRCG", "2-HIGH": "BRDI", "3-MEDIUM": "BRCC", "4-NOT SPECIFIED": "BRIN", "5-LOW": "BRCO",
}


SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", schema=SCHEMAS[name])


def org_of(col: str = "o_orderpriority"):
    chain = F
    for priority, org in ORG_BY_PRIORITY.items():
        chain = chain.when(F.col(col) == priority, org)
    return chain


def org_sql(col: str = "o_orderpriority") -> str:
    whens = " ".join(f"WHEN '{p}' THEN '{o}'" for p, o in ORG_BY_PRIORITY.items())
    return f"CASE {col} {whens} END"


def merged_org_sql(col: str = "o_orderpriority") -> str:
    return f"CASE WHEN {col} = '5-LOW' THEN 'BRCC' ELSE {org_sql(col)} END"


def tidy(df: DataFrame, digits: int = 6) -> DataFrame:
    """Numbers as doubles, rounded by plain arithmetic that is the same in both engines."""
    kinds = (DecimalType, DoubleType)
    changed = {f.name: snap(f.name, digits) for f in df.schema.fields if isinstance(f.dataType, kinds)}
    return df.withColumns(changed) if changed else df


def tidy_sql(sql: str, plain: list[str], numbers: list[str], digits: int = 6) -> str:
    scale = f"1e{digits}"
    cols = [
        *plain,
        *[
            f"CAST(floor(CAST({c} AS DOUBLE) * {scale} + 0.5::DOUBLE) AS BIGINT) / {scale} AS {c}"
            for c in numbers
        ],
    ]
    return f"SELECT {', '.join(cols)} FROM ({sql}) AS t"


def half_up(expr: str, digits: int) -> str:
    """SQL text of Spark's round(): half up on the printed digits of the double."""
    return f"CAST(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(30,{digits})) AS DOUBLE)"


# --- lines: one row per line item with its order -------------------------------------------

def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = table(spark, sf_dir, "lineitem")
    order = table(spark, sf_dir, "orders")
    return item.join(order, item["l_orderkey"] == order["o_orderkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "o_custkey",
        F.col("l_shipdate").cast("date").alias("ship_date"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        org_of().alias("org"),
        F.col("l_quantity").alias("qty"),
        F.col("l_extendedprice").alias("ext"),
        F.col("l_discount").alias("disc"),
        F.col("l_tax").alias("tax"),
    )


LINES_SQL = f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus, o_custkey,
       CAST(l_shipdate AS DATE) AS ship_date, CAST(o_orderdate AS DATE) AS order_date,
       {org_sql()} AS org,
       CAST(l_quantity AS DECIMAL(12,2)) AS qty, CAST(l_extendedprice AS DECIMAL(12,2)) AS ext,
       CAST(l_discount AS DECIMAL(4,2)) AS disc, CAST(l_tax AS DECIMAL(4,2)) AS tax
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""

# --- conditions: price conditions of a line --------------------------------------------------

CONDITIONS = {
    "list_price": "qty * retail",
    "quantity_ton": "qty",
    "rbv": "ext",
    "rlv": "ext * (1.00 - tax)",
    "practiced_price": "ext * (1.00 - disc)",
    "zd01": "-ext * 0.02",
    "zd02": "-ext * disc",
    "zd03": "-ext * 0.01",
    "zd04": "-qty * 0.10",
    "zd05": "-qty * 0.25",
    "zd06": "-ext * 0.003",
    "zd13": "CASE WHEN l_returnflag = 'R' THEN -ext * 0.02 ELSE ext * 0.000 END",
    "zd14": "CASE WHEN l_returnflag = 'A' THEN -qty * 0.50 ELSE qty * 0.00 END",
    "zd38": "qty * 0.30",
    "zeaf": "ext * 0.004",
    "zeb1": "qty * 0.05",
    "zeb2": "-qty * 0.02",
    "zsu2": "qty * 0.15",
    "bx41": "ext * 0.015",
    "bx95": "qty * 0.01",
    "icms": "-ext * tax",
    "cofins": "-ext * 0.03",
    "pis": "-ext * 0.0065",
    "other_taxes": "-qty * 0.01",
    "ipi": "ext * 0.05",
}


def as_double(expr: str) -> str:
    """The decimal literals of an expression as doubles (``0.02`` -> ``0.02D``)."""
    return re.sub(r"(\d+\.\d+)", r"\1D", expr)


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_name",
        F.col("p_retailprice").alias("retail"),
    )
    return lines(spark, sf_dir).join(part, "l_partkey").select(
        "*", *[F.expr(as_double(e)).alias(n) for n, e in CONDITIONS.items()]
    )


def priced_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditions as whole millionths, for arithmetic on single rows."""
    return conditions(spark, sf_dir).withColumns({c: snap(c) for c in CONDITIONS})


CONDITIONS_SQL = f"""
SELECT t.*, p_brand, p_type, p_name,
       {', '.join(f'CAST({e} AS DECIMAL(18,6)) AS {n}' for n, e in CONDITIONS.items())}
FROM (SELECT l.*, p_brand, p_type, p_name, CAST(p_retailprice AS DECIMAL(10,2)) AS retail
      FROM ({LINES_SQL}) AS l JOIN part ON l_partkey = p_partkey) AS t
"""

PRICED_SQL = f"""
SELECT * REPLACE ({', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in [*CONDITIONS, 'qty', 'ext'])}) FROM ({CONDITIONS_SQL}) AS c0
"""

# --- margin: profit, freight and operating cost per order item and shipping month --------------

MARGIN = {
    "op_cost": "qty * retail * 0.60",
    "freight": "qty * 1.50",
    "gross_profit": "ext * (1.00 - disc) - qty * retail * 0.60 - qty * 1.50",
}


def margin_columns(df: DataFrame, where=None) -> DataFrame:
    """Margin figures beside the conditions of a line, in rows that pass the test."""
    figures = {n: F.expr(as_double(e)) for n, e in MARGIN.items()}
    return df.withColumns(figures if where is None else {n: F.when(where, e) for n, e in figures.items()})


MARGIN_SUMS_SQL = ", ".join(f"sum(CAST({e} AS DECIMAL(18,6))) AS {n}" for n, e in MARGIN.items())

# --- collects: surveyed prices, one per line ----------------------------------------------------

def collects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line as a collected price: seller = supplier, branch = the supplier's nation."""
    item = table(spark, sf_dir, "lineitem")
    seller = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("branch")
    )
    return item.join(seller, "l_suppkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "branch", "l_returnflag", "l_linestatus",
        F.col("l_shipdate").cast("date").alias("ship_date"),
        # Prices of a few units of money per kg, as in a survey.
        snap(F.col("l_extendedprice") / F.col("l_quantity") / 397.0, 4).alias("price_kg"),
    )


COLLECTS_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, s_nationkey AS branch, l_returnflag, l_linestatus,
       CAST(l_shipdate AS DATE) AS ship_date,
       CAST(floor(l_extendedprice / l_quantity / 397.0::DOUBLE * 1e4 + 0.5::DOUBLE) AS BIGINT) / 1e4 AS price_kg
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
"""

