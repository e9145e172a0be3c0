"""Scope, codes, lookups, dedup and joins on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.functions import codes, dates, text
from pricewright.functions.numbers import parse_number, ratio, total
from pricewright.operators import filters, joins, latest
from pricewright.queries.tables import (
    AS_OF, merged_org_sql, org_of, org_sql, table, tidy, tidy_sql,
)

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


TYPE_TERMS = ["ECON", "PROM", "ECONOMY"]
NAME_TERMS = ["ring", "widget", "bolt"]


@query(
    "scope_filter",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, p_type, p_brand
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE (p_type LIKE '%ECON%' OR p_type LIKE '%PROM%' OR p_type LIKE '%ECONOMY%')
      AND p_brand IN ('Brand#1', 'Brand#7', 'Brand#21')
      AND (p_name LIKE '%ring%' OR p_name LIKE '%widget%' OR p_name LIKE '%bolt%' OR p_name IS NULL)
      AND NOT p_name LIKE '%red%'
      AND l_returnflag <> 'R' AND l_quantity > 0
    """,
)
def scope_filter(spark, sf):
    part = table(spark, sf, "part")
    part = filters.scope_filter(part, "p_type", TYPE_TERMS)
    part = filters.scope_filter(part, "p_brand", ["Brand#1", "Brand#7", "Brand#21"], exact=True)
    part = filters.scope_filter(part, "p_name", NAME_TERMS, keep_null=True)
    part = filters.exclude_terms(part, "p_name", ["red"], keep_null=False)
    item = table(spark, sf, "lineitem").where((F.col("l_returnflag") != "R") & (F.col("l_quantity") > 0))
    return item.join(part, item["l_partkey"] == part["p_partkey"]).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "p_type", "p_brand"
    )


FOLD_SQL = "translate(upper(trim({0})), 'ÁÃÀÂÄÉÈÊËÍÌÎÏÓÕÒÔÖÚÙÛÜÇ`''-/ ', 'AAAAAEEEEIIIIOOOOOUUUUC')"


@query(
    "normalized_key_join",
    f"""
    WITH dim AS (
      SELECT DISTINCT {FOLD_SQL.format("' Ná' || 'tion-' || CAST(n_nationkey AS VARCHAR) || ' '")} AS city_key,
             CAST(n_nationkey AS BIGINT) AS state_code, n_name AS branch
      FROM nation)
    SELECT c_custkey, branch
    FROM customer
    LEFT JOIN dim ON {FOLD_SQL.format("'nÃ''tion ' || CAST(c_nationkey AS VARCHAR)")} = city_key
                 AND CAST('00' || CAST(c_nationkey AS VARCHAR) AS BIGINT) = state_code
    """,
)
def normalized_key_join(spark, sf):
    dim = table(spark, sf, "nation").select(
        text.norm_key(F.concat(F.lit(" Ná"), F.lit("tion-"), F.col("n_nationkey").cast("string"), F.lit(" "))).alias("city_key"),
        text.code_int(F.col("n_nationkey").cast("string")).alias("state_code"),
        F.col("n_name").alias("branch"),
    ).distinct()
    customer = table(spark, sf, "customer").select(
        "c_custkey",
        text.norm_key(F.concat(F.lit("nÃ'tion "), F.col("c_nationkey").cast("string"))).alias("city_key"),
        text.code_int(F.concat(F.lit("00"), F.col("c_nationkey").cast("string"))).alias("state_code"),
    )
    return joins.lookup(customer, dim, ["city_key", "state_code"]).select("c_custkey", "branch")


@query(
    "remap_codes",
    f"""
    SELECT o_orderkey, {org_sql()} AS org, {merged_org_sql()} AS merged_org,
           CASE WHEN {merged_org_sql()} LIKE '%CC%' THEN 'Usina-Mercado'
                WHEN {merged_org_sql()} LIKE '%CG%' THEN 'Distribuição-Mercado'
                ELSE 'Usina-Distribuição' END AS channel,
           CASE WHEN {merged_org_sql()} LIKE '%CC%' THEN 'Sell-in 1: Usina-Construtora/Industria'
                WHEN {merged_org_sql()} LIKE '%CG%' THEN 'Sell-in 2: Distribuição-Revenda'
                ELSE 'Sell-in 1: Usina-Distribuição' END AS channel_label
    FROM orders
    """,
)
def remap_codes(spark, sf):
    return (
        table(spark, sf, "orders")
        .select("o_orderkey", org_of().alias("org"))
        .withColumn("merged_org", codes.remap_codes("org"))
        .withColumn("channel", codes.price_type("merged_org"))
        .withColumn("channel_label", codes.channel_label("channel"))
    )


@query(
    "overlay_lookup",
    """
    WITH dim AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS seg,
                        CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS nm
                 FROM customer WHERE c_custkey % 3 <> 0)
    SELECT o_orderkey, o_custkey, coalesce(seg, o_orderpriority) AS segment,
           CASE WHEN k IS NOT NULL THEN nm ELSE o_orderstatus END AS customer
    FROM orders LEFT JOIN dim ON o_custkey = k
    """,
)
def overlay_lookup(spark, sf):
    key = F.col("c_custkey")
    dim = table(spark, sf, "customer").where(key % 3 != 0).select(
        key.alias("k"),
        F.when(key % 5 != 0, F.col("c_mktsegment")).alias("seg"),
        F.when(key % 7 != 0, F.col("c_name")).alias("nm"),
    )
    order = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderpriority").alias("segment"), F.col("o_orderstatus").alias("customer")
    )
    some = joins.overlay(order, dim, {"o_custkey": "k"}, {"segment": "seg"})
    return joins.overlay(some, dim, {"o_custkey": "k"}, {"customer": "nm"}, null_wins=True)


@query(
    "default_label",
    """
    SELECT c_custkey, coalesce(n_name, 'Filial Não Encontrada') AS branch,
           CASE WHEN c_mktsegment = 'BUILDING' OR c_mktsegment IS NULL THEN c_name ELSE c_mktsegment END AS customer_group
    FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) AS n ON c_nationkey = n_nationkey
    """,
)
def default_label(spark, sf):
    nation = table(spark, sf, "nation").where(F.col("n_regionkey") != 2)
    return joins.lookup(
        table(spark, sf, "customer"), nation, {"c_nationkey": "n_nationkey"}, ["n_name"]
    ).select(
        "c_custkey",
        codes.default_label("n_name", "Filial Não Encontrada").alias("branch"),
        codes.customer_group("c_mktsegment", "c_name", generic="BUILDING").alias("customer_group"),
    )


@query(
    "rolling_horizon",
    f"""
    WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT o_orderkey, d AS order_date, 'six_full_months' AS window_name FROM o
      WHERE d >= date_trunc('month', DATE '{AS_OF}') - INTERVAL 6 MONTH AND d < date_trunc('month', DATE '{AS_OF}')
    UNION ALL SELECT o_orderkey, d, 'six_and_current' FROM o
      WHERE d >= date_trunc('month', DATE '{AS_OF}') - INTERVAL 6 MONTH
        AND d < date_trunc('month', DATE '{AS_OF}') + INTERVAL 1 MONTH
    UNION ALL SELECT o_orderkey, d, 'twelve_to_today' FROM o
      WHERE d >= date_trunc('month', DATE '{AS_OF}') - INTERVAL 12 MONTH AND d <= DATE '{AS_OF}'
    UNION ALL SELECT o_orderkey, d, 'last_24_months' FROM o WHERE d >= DATE '{AS_OF}' - INTERVAL 24 MONTH AND d <= DATE '{AS_OF}'
    UNION ALL SELECT o_orderkey, d, 'since_floor' FROM o WHERE d >= DATE '2001-05-13'
    """,
)
def rolling_horizon(spark, sf):
    order = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    windows = {
        "six_full_months": filters.in_horizon("order_date", AS_OF, 6),
        "six_and_current": filters.in_horizon("order_date", AS_OF, 6, fwd=1),
        "twelve_to_today": filters.in_horizon("order_date", AS_OF, 12, closed=True),
        "last_24_months": filters.in_horizon("order_date", AS_OF, 24, month_aligned=False, closed=True),
        "since_floor": F.col("order_date") >= F.lit("2001-05-13").cast("date"),
    }
    inside = F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in windows.items()]))
    return order.select("o_orderkey", "order_date", F.explode(inside).alias("window_name"))


@query(
    "latest_per_key",
    """
    SELECT user_id, event_type, event_id, ts, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY CAST(ts AS DATE) DESC, event_id DESC) AS r
      FROM events) WHERE r = 1
    """,
)
def latest_per_key(spark, sf):
    event = table(spark, sf, "events").withColumn("load_day", F.col("ts").cast("date"))
    return latest.latest_per_key(
        event, ["user_id", "event_type"], [latest.newest("load_day"), F.col("event_id").desc()]
    ).select("user_id", "event_type", "event_id", "ts", "value")


@query(
    "latest_snapshot",
    """
    SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS load_day FROM events
    JOIN (SELECT max(CAST(ts AS DATE)) AS m FROM events) ON CAST(ts AS DATE) = m
    WHERE event_type LIKE '%c%'
    """,
)
def latest_snapshot(spark, sf):
    event = table(spark, sf, "events").withColumn("load_day", F.col("ts").cast("date"))
    return latest.latest_snapshot(event, "load_day").where(F.col("event_type").like("%c%")).select(
        "event_id", "user_id", "event_type", "load_day"
    )


@query(
    "latest_state_with_ties",
    """
    SELECT DISTINCT o.o_custkey, o.o_orderpriority, CAST(o.o_orderdate AS DATE) AS order_date, o.o_orderstatus
    FROM orders o JOIN (SELECT o_custkey, o_orderpriority, max(o_orderdate) AS m FROM orders GROUP BY ALL) s
      ON s.o_custkey = o.o_custkey AND s.o_orderpriority = o.o_orderpriority AND s.m = o.o_orderdate
    """,
)
def latest_state_with_ties(spark, sf):
    order = table(spark, sf, "orders").select(
        "o_custkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("order_date"), "o_orderstatus"
    )
    return latest.latest_with_ties(order, ["o_custkey", "o_orderpriority"], "order_date").distinct()


@query(
    "last_load",
    "SELECT event_type, max(ts) AS last_load FROM events GROUP BY event_type UNION ALL SELECT NULL, max(ts) FROM events",
)
def last_load(spark, sf):
    event = table(spark, sf, "events")
    whole = latest.last_load(event, "ts").select(F.lit(None).cast("string").alias("event_type"), "last_load")
    return latest.last_load(event, "ts", by=["event_type"]).unionByName(whole)


@query(
    "mode_per_key",
    """
    SELECT l_partkey, l_suppkey, n_rows FROM (
      SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY n_rows DESC, l_suppkey) AS r
      FROM (SELECT l_partkey, l_suppkey, count(*) AS n_rows FROM lineitem GROUP BY ALL)) WHERE r = 1
    """,
)
def mode_per_key(spark, sf):
    return latest.mode_per_key(table(spark, sf, "lineitem"), ["l_partkey"], "l_suppkey")


@query(
    "union_extracts",
    """
    WITH u AS (
      SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice,
             CAST(o_orderdate AS DATE) AS load_day, 1 AS extract_no
      FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 2 = 1
      UNION ALL
      SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER) - 2, 2
      FROM orders WHERE o_orderkey % 2 = 0)
    SELECT o_orderkey AS "O_ORDERKEY", o_custkey AS "O_CUSTKEY", o_orderstatus AS "O_ORDERSTATUS",
           o_totalprice AS "O_TOTALPRICE", load_day AS "LOAD_DAY", extract_no AS "EXTRACT_NO"
    FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY load_day DESC, extract_no DESC) AS r FROM u)
    WHERE r = 1
    """,
)
def union_extracts(spark, sf):
    day = F.col("o_orderdate").cast("date")
    order = table(spark, sf, "orders")
    # Odd keys are only in the old extract, even multiples of three only in the new one.
    old = order.where((F.col("o_orderkey") % 3 != 0) | (F.col("o_orderkey") % 2 == 1)).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", day.alias("load_day"), F.lit(1).alias("extract_no"),
        F.year(day).alias("year"),
    )
    new = order.where(F.col("o_orderkey") % 2 == 0).select(
        "o_orderkey", "o_custkey", "o_orderstatus", (F.col("o_totalprice") * 2).alias("o_totalprice"),
        F.date_add(day, (F.col("o_orderkey") % 5 - 2).cast("int")).alias("load_day"), F.lit(2).alias("extract_no"),
        F.month(day).alias("month"),
    )
    return latest.union_extracts(
        [old, new], ["O_ORDERKEY"], [latest.newest("LOAD_DAY"), F.col("EXTRACT_NO").desc()]
    )


@query(
    "full_join_coalesce",
    """
    WITH a AS (SELECT 4 * c_custkey + CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS id, c_name AS nm, c_mktsegment AS segment FROM customer),
         b AS (SELECT 4 * o_custkey + CASE WHEN o_custkey % 4 = 0 THEN 2 ELSE 0 END AS id, max(o_orderpriority) AS nm, count(*) AS n_orders
               FROM orders GROUP BY 1)
    SELECT coalesce(a.id, b.id) AS id, segment, n_orders, coalesce(a.nm, b.nm) AS nm
    FROM a FULL JOIN b ON a.id = b.id
    """,
)
def full_join_coalesce(spark, sf):
    # Shifted keys meet nothing on the other side, so both sides have rows of their own.
    shifted = lambda key, by, shift: 4 * F.col(key) + F.when(F.col(key) % by == 0, shift).otherwise(0)
    a = table(spark, sf, "customer").select(
        shifted("c_custkey", 3, 1).alias("id"), F.col("c_name").alias("nm"), F.col("c_mktsegment").alias("segment")
    )
    b = table(spark, sf, "orders").groupBy(shifted("o_custkey", 4, 2).alias("id")).agg(
        F.max("o_orderpriority").alias("nm"), F.count(F.lit(1)).alias("n_orders")
    )
    return joins.full_coalesce(a, b, "id", ["nm"])


@query(
    "two_pass_lookup",
    """
    WITH site AS (SELECT n_nationkey AS k, n_name AS site FROM nation WHERE n_nationkey % 2 = 0)
    SELECT s_suppkey, coalesce(a.site, b.site) AS branch
    FROM supplier LEFT JOIN site a ON s_nationkey = a.k
                  LEFT JOIN site b ON (s_nationkey + s_suppkey) % 25 = b.k
    """,
)
def two_pass_lookup(spark, sf):
    site = table(spark, sf, "nation").where(F.col("n_nationkey") % 2 == 0).select(
        F.col("n_nationkey").alias("k"), F.col("n_name").alias("site")
    )
    supplier = table(spark, sf, "supplier").select(
        "s_suppkey", "s_nationkey", ((F.col("s_nationkey") + F.col("s_suppkey")) % 25).alias("other")
    )
    return joins.two_pass_lookup(
        supplier, site, {"s_nationkey": "k"}, {"other": "k"}, "site", "branch"
    ).select("s_suppkey", "branch")


@query(
    "anti_join_backfill",
    tidy_sql("""
    WITH t AS (SELECT CASE WHEN o_totalprice > 400000 THEN o_custkey ELSE -o_custkey END AS k, CAST(year(o_orderdate) AS INTEGER) AS y,
                      sum(CAST(o_totalprice AS DECIMAL(18,4))) AS target FROM orders GROUP BY ALL),
         w AS (SELECT DISTINCT o_custkey AS k, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)
    SELECT k, y, target FROM t
    UNION ALL
    SELECT k, y, 0 FROM w WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.k = w.k AND t.y = w.y)
    """, ["k", "y"], ["target"]),
)
def anti_join_backfill(spark, sf):
    order = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("k"), F.year("o_orderdate").alias("y"), F.col("o_totalprice").alias("v")
    )
    # Targets of smaller orders stand under a key that nobody wants.
    own = F.when(F.col("v") > 400000, F.col("k")).otherwise(-F.col("k"))
    targets = order.withColumn("k", own).groupBy("k", "y").agg(total("v").alias("target"))
    wanted = order.select("k", "y").distinct()
    return tidy(joins.backfill(targets, wanted, ["k", "y"], {"target": F.lit(0.0)}))


@query(
    "calendar_horizon",
    f"""
    WITH cal AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem
                 WHERE l_shipdate >= TIMESTAMP '2000-07-01' AND l_shipdate <= TIMESTAMP '{AS_OF}')
    SELECT o_orderkey, d AS order_date, CAST(d - INTERVAL 1 MONTH AS DATE) AS last_month, CAST(d - INTERVAL 2 MONTH AS DATE) AS two_months,
           CAST(d - INTERVAL 1 YEAR AS DATE) AS last_year
    FROM orders JOIN cal ON CAST(o_orderdate AS DATE) = d
    """,
)
def calendar_horizon(spark, sf):
    ship = table(spark, sf, "lineitem").select(F.col("l_shipdate").cast("date").alias("order_date"))
    calendar = filters.horizon(ship, "order_date", AS_OF, 12, closed=True).distinct().withColumns(
        {
            "last_month": F.add_months("order_date", -1),
            "two_months": F.add_months("order_date", -2),
            "last_year": F.add_months("order_date", -12),
        }
    )
    order = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return order.join(calendar, "order_date")


@query(
    "view_filter",
    """
    SELECT o_orderkey, o_orderpriority, round(coalesce(o_totalprice, 0), 2) AS total
    FROM orders
    WHERE (CAST(o_orderdate AS DATE) >= DATE '2000-01-01' OR o_totalprice >= 450000)
      AND o_orderpriority LIKE '%I%' AND o_orderpriority NOT LIKE '%SPECIFIED%'
    """,
)
def view_filter(spark, sf):
    # SQL text over a named view, as the view scans of the reports are written.
    view = table(spark, sf, "orders")
    return spark.sql(
        """
        SELECT o_orderkey, o_orderpriority, round(coalesce(o_totalprice, 0), 2) AS total
        FROM {view}
        WHERE (CAST(o_orderdate AS DATE) >= DATE '2000-01-01' OR o_totalprice >= 450000)
          AND o_orderpriority LIKE '%I%' AND o_orderpriority NOT LIKE '%SPECIFIED%'
        """,
        view=view,
    )


@query(
    "typed_distinct_items",
    tidy_sql("""
    SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS order_number, CAST(l_linenumber AS VARCHAR) AS item_number,
           CAST(l_extendedprice AS DECIMAL(19,6)) AS net_value,
           CAST(l_quantity AS DECIMAL(19,6)) AS quantity
    FROM lineitem
    """, ["order_number", "item_number"], ["net_value", "quantity"]),
)
def typed_distinct_items(spark, sf):
    view = table(spark, sf, "lineitem")
    return tidy(
        spark.sql(
            """
            SELECT DISTINCT CAST(l_orderkey AS STRING) AS order_number, CAST(l_linenumber AS STRING) AS item_number,
                   CAST(l_extendedprice AS DECIMAL(19,6)) AS net_value, CAST(l_quantity AS DECIMAL(19,6)) AS quantity
            FROM {view}
            """,
            view=view,
        )
    )


@query(
    "text_functions",
    """
    SELECT p_partkey, substring(p_name, 1, 3) AS head, right(p_name, 4) AS tail,
           split_part(p_brand, '#', 2) AS brand_no,
           substring(p_brand, 7, length(p_brand)) AS brand_rest,
           length(p_name) AS name_length, replace(p_name, ' ', '') AS squeezed,
           right('0' || CAST(CASE WHEN p_partkey % 3 = 0 THEN p_partkey + 98765000000 ELSE p_partkey END AS VARCHAR), 10) AS padded, p_type || '_' || p_brand AS both_codes,
           p_name LIKE '%ring' AS ends_ring, regexp_matches(p_brand, '[0-9]{2}') AS two_digits,
           CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS extracted,
           rtrim(ltrim('  ' || p_type || ' ')) AS trimmed
    FROM part
    """,
)
def text_functions(spark, sf):
    brand = F.col("p_brand")
    return table(spark, sf, "part").select(
        "p_partkey",
        F.substring("p_name", 0, 3).alias("head"),  # a start of 0 counts as 1
        F.substring("p_name", -4, 4).alias("tail"),
        F.substring_index(brand, "#", -1).alias("brand_no"),
        F.expr("substring(p_brand, 7, length(p_brand))").alias("brand_rest"),
        F.length("p_name").cast("bigint").alias("name_length"),
        text.drop_chars("p_name", " ").alias("squeezed"),
        text.pad_code(
            F.when(F.col("p_partkey") % 3 == 0, F.col("p_partkey") + 98765000000).otherwise(F.col("p_partkey")).cast("string")
        ).alias("padded"),
        text.display_key("p_type", "p_brand").alias("both_codes"),
        F.col("p_name").endswith("ring").alias("ends_ring"),
        brand.rlike("[0-9]{2}").alias("two_digits"),
        F.regexp_extract(brand, "([0-9]+)", 1).try_cast("int").alias("extracted"),
        F.rtrim(F.ltrim(F.concat(F.lit("  "), F.col("p_type"), F.lit(" ")))).alias("trimmed"),
    )


@query(
    "date_functions",
    """
    WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
    SELECT o_orderkey, d AS order_date, CAST(year(d) AS INTEGER) AS y, CAST(month(d) AS INTEGER) AS m,
           strftime(d, '%m-%Y') AS month_label, strftime(d, '%Y%m') AS month_key, strftime(d, '%m/%Y') AS civil_month,
           CAST(date_trunc('month', d) AS DATE) AS month_start, last_day(d) AS month_end,
           CAST(isoyear(d) AS INTEGER) AS iso_year, CAST(weekofyear(d) AS INTEGER) AS iso_week,
           CAST(strftime(d, '%Y') || '0' || strftime(d, '%m') AS INTEGER) AS fiscal_period,
           CAST(datediff('day', date_trunc('month', d), d) AS INTEGER) AS days_in
    FROM o
    """,
)
def date_functions(spark, sf):
    # Dates arrive as text in three layouts and are parsed back.
    source = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy.MM.dd").alias("dotted"),
        F.date_format("o_orderdate", "dd-MM-yyyy").alias("dashed"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("packed"),
        F.concat(F.date_format("o_orderdate", "yyyy'0'MM"), F.lit("X")).alias("period"),
    )
    day = F.coalesce(
        dates.parse_date("dotted", "dd/MM/yyyy"),  # wrong layout: null, not an error
        dates.parse_date("dashed", "dd/MM/yyyy"),
        dates.parse_date("packed", "yyyyMMdd"),
    )
    return source.withColumn("order_date", day).select(
        "o_orderkey",
        "order_date",
        F.year("order_date").alias("y"),
        F.month("order_date").alias("m"),
        dates.month_label("order_date").alias("month_label"),
        dates.month_label("order_date", "yyyyMM").alias("month_key"),
        dates.month_label("order_date", "MM/yyyy").alias("civil_month"),
        dates.month_start("order_date").alias("month_start"),
        F.last_day("order_date").alias("month_end"),
        dates.iso_year("order_date").alias("iso_year"),
        dates.iso_week("order_date").alias("iso_week"),
        dates.fiscal_period("period").alias("fiscal_period"),
        F.datediff("order_date", dates.month_start("order_date")).alias("days_in"),
    )


@query(
    "number_parsing",
    tidy_sql(
        """
        SELECT l_orderkey, l_linenumber, l_extendedprice AS price, CAST(NULL AS DOUBLE) AS bad,
               CASE WHEN l_discount = 0 THEN NULL ELSE l_tax / l_discount END AS tax_over_discount,
               abs(-l_quantity) AS qty
        FROM lineitem
        """,
        ["l_orderkey", "l_linenumber"],
        ["price", "bad", "tax_over_discount", "qty"],
    ),
)
def number_parsing(spark, sf):
    source = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_tax", "l_discount",
        F.concat(F.lit(" "), F.translate(F.col("l_extendedprice").cast("decimal(12,2)").cast("string"), ".", ","), F.lit(" ")).alias("price_text"),
        F.concat(F.col("l_returnflag"), F.lit("?")).alias("bad_text"),
        (-F.col("l_quantity")).alias("negative"),
    )
    return tidy(
        source.select(
            "l_orderkey",
            "l_linenumber",
            parse_number("price_text").alias("price"),
            parse_number("bad_text").alias("bad"),
            ratio("l_tax", "l_discount").alias("tax_over_discount"),
            F.abs("negative").alias("qty"),
        )
    )
