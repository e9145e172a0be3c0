"""Forecasts, targets and indicators on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pricewright.operators import forecast, kpi
from pricewright.queries.tables import (
    AS_OF, COLLECTS_SQL, CONDITIONS_SQL, LINES_SQL, collects, conditions, half_up, lines, org_of,
    table, tidy, tidy_sql,
)

QUERIES, ORACLE = {}, {}


def query(name, sql):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


# --- orders by place ----------------------------------------------------------------------------

def placed_orders(spark, sf):
    """Orders with organisation, segment, region, nation and month start."""
    place = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "n_regionkey", "n_nationkey", "n_name")
    return table(spark, sf, "orders").join(place, "o_custkey").select(
        "o_orderkey", "o_custkey", "c_mktsegment", "n_regionkey", "n_nationkey", "n_name", "o_orderstatus",
        org_of().alias("org"), F.col("o_orderdate").cast("date").alias("order_date"),
        F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"),
        F.col("o_totalprice").alias("total"),
    )


PLACED_SQL = f"""
SELECT o_orderkey, o_custkey, c_mktsegment, n_regionkey, n_nationkey, n_name, o_orderstatus,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'BRCG' WHEN '2-HIGH' THEN 'BRDI' WHEN '3-MEDIUM' THEN 'BRCC'
            WHEN '4-NOT SPECIFIED' THEN 'BRIN' WHEN '5-LOW' THEN 'BRCO' END AS org,
       CAST(o_orderdate AS DATE) AS order_date, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
       CAST(o_totalprice AS DECIMAL(18,4)) AS total
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

# --- forecast allocation ------------------------------------------------------------------------------

PARENT = ["org", "c_mktsegment", "n_regionkey", "month"]
ALLOCATION_SQL = f"""
WITH o AS ({PLACED_SQL}),
plans AS (SELECT {', '.join(PARENT)}, sum(CAST(total * 1.10 AS DECIMAL(18,4))) AS plan FROM o GROUP BY ALL),
sites AS (SELECT DISTINCT n_regionkey, n_name AS branch FROM nation WHERE n_nationkey % 7 <> 3),
n_sites AS (SELECT n_regionkey, count(*) AS n FROM sites GROUP BY 1),
sold AS (SELECT CASE WHEN total > 400000 THEN org ELSE 'Z' || org END AS org, c_mktsegment, n_regionkey, month,
                CASE WHEN n_nationkey % 7 = 3 THEN 'Filial Não Encontrada' ELSE n_name END AS branch, sum(total) AS qb FROM o GROUP BY ALL),
known AS (SELECT * FROM sold WHERE branch <> 'Filial Não Encontrada'),
st AS (SELECT {', '.join(PARENT)}, sum(qb) AS qs FROM known GROUP BY ALL),
spread AS (SELECT plans.*, branch, n, qs, qb FROM plans JOIN sites USING (n_regionkey) JOIN n_sites USING (n_regionkey)
           LEFT JOIN st USING ({', '.join(PARENT)}) LEFT JOIN known USING ({', '.join(PARENT)}, branch))
-- 1: the branch sold
SELECT {', '.join(PARENT)}, branch, CAST(plan AS DOUBLE) AS pv_budget, CAST(qb AS DOUBLE) AS qty_branch, CAST(qs AS DOUBLE) AS qty_state,
       CAST(qb AS DOUBLE) / CAST(qs AS DOUBLE) AS perc_vol, CAST(plan AS DOUBLE) * (CAST(qb AS DOUBLE) / CAST(qs AS DOUBLE)) AS pv_done
FROM spread WHERE qb IS NOT NULL
UNION ALL -- 2: other branches sold, this one did not
SELECT {', '.join(PARENT)}, branch, 0, 0, 0, 0, 0 FROM spread WHERE qb IS NULL AND qs IS NOT NULL
UNION ALL -- 3: nobody in the state sold: equal parts
SELECT {', '.join(PARENT)}, branch, CAST(plan AS DOUBLE), 0, 0, 0, CAST(plan AS DOUBLE) / n FROM spread WHERE qs IS NULL
UNION ALL -- sold without a plan
SELECT {', '.join(PARENT)}, branch, 0, CAST(qb AS DOUBLE), CAST(qs AS DOUBLE), CAST(qb AS DOUBLE) / CAST(qs AS DOUBLE), 0
FROM known JOIN st USING ({', '.join(PARENT)})
WHERE NOT EXISTS (SELECT 1 FROM plans p WHERE {' AND '.join(f'p.{c} = known.{c}' for c in PARENT)})
UNION ALL -- unknown branch
SELECT {', '.join(PARENT)}, branch, 0, 0, 0, 0, 0 FROM sold WHERE branch = 'Filial Não Encontrada'
"""
ALLOCATED = ["pv_budget", "qty_branch", "qty_state", "perc_vol", "pv_done"]


@query("forecast_allocation", tidy_sql(ALLOCATION_SQL, [*PARENT, "branch"], ALLOCATED))
def forecast_allocation(spark, sf):
    order = placed_orders(spark, sf)
    lost = F.col("n_nationkey") % 7 == 3
    plan = order.withColumn("plan_value", F.col("total") * 1.10)
    # Smaller sales stand under an organisation without a plan.
    sold = order.withColumns(
        {
            "org": F.when(F.col("total") > 400000, F.col("org")).otherwise(F.concat(F.lit("Z"), F.col("org"))),
            "branch": F.when(lost, "Filial Não Encontrada").otherwise(F.col("n_name")),
        }
    )
    sites = table(spark, sf, "nation").where(~lost).select("n_regionkey", F.col("n_name").alias("branch"))
    return tidy(
        forecast.allocate_forecast(plan, sold, sites, PARENT, "n_regionkey", "branch", "plan_value", "total")
    )


# --- forecast against actuals -----------------------------------------------------------------------------

FVA_KEYS = ["org", "c_mktsegment", "n_regionkey"]


@query(
    "next_month_variance",
    tidy_sql(
        f"""
        WITH o AS ({PLACED_SQL}),
        p AS (SELECT org, CASE WHEN o_orderkey % 3 = 0 THEN 'plan ' || c_mktsegment ELSE c_mktsegment END AS c_mktsegment, n_regionkey, month,
                     sum(CAST(total * 1.05 AS DECIMAL(18,4))) AS volume FROM o GROUP BY ALL),
        a AS (SELECT org, CASE WHEN o_orderstatus = 'P' THEN 'sold ' || c_mktsegment ELSE c_mktsegment END AS c_mktsegment, n_regionkey, month,
                     sum(CAST(1 AS DECIMAL(18,4))) AS qty_sold, sum(total) AS rbv_sold, sum(CAST(total * 0.80 AS DECIMAL(18,4))) AS rlv_sold FROM o GROUP BY ALL),
        b AS (SELECT org, CASE WHEN o_orderkey % 2 = 1 THEN 'plan ' || c_mktsegment ELSE c_mktsegment END AS c_mktsegment, n_regionkey, month,
                     sum(total) AS volume_budget, sum(CAST(total * 0.70 AS DECIMAL(18,4))) AS rlv_budget FROM o GROUP BY ALL),
        j AS (SELECT p.*, qty_sold, rbv_sold, rlv_sold FROM p LEFT JOIN a USING ({', '.join(FVA_KEYS)}, month)),
        n AS (SELECT j.*, k.volume AS volume_next, k.qty_sold AS qty_sold_next, k.rbv_sold AS rbv_sold_next, k.rlv_sold AS rlv_sold_next,
                     k.volume - j.volume AS volume_diff, j.rlv_sold - k.rlv_sold AS rlv_diff
              FROM j LEFT JOIN j AS k ON {' AND '.join(f'j.{c} = k.{c}' for c in FVA_KEYS)} AND k.month = j.month + INTERVAL 1 MONTH),
        t AS (SELECT {', '.join(FVA_KEYS)}, CAST(sum(rlv_diff) AS DOUBLE) / nullif(count(rlv_diff), 0) AS rlv_diff_mean FROM n GROUP BY ALL)
        SELECT n.*, rlv_diff_mean, volume_budget, rlv_budget FROM n JOIN t USING ({', '.join(FVA_KEYS)}) JOIN b USING ({', '.join(FVA_KEYS)}, month)
        """,
        [*FVA_KEYS, "month"],
        ["volume", "qty_sold", "rbv_sold", "rlv_sold", "volume_next", "qty_sold_next", "rbv_sold_next", "rlv_sold_next",
         "volume_diff", "rlv_diff", "rlv_diff_mean", "volume_budget", "rlv_budget"],
    ),
)
def next_month_variance(spark, sf):
    order = placed_orders(spark, sf)

    def scaled(rate):
        return F.col("total") * rate

    def apart(test, mark):
        """The rows of a test under a segment of their own, which other sources may lack."""
        segment = F.col("c_mktsegment")
        return order.withColumn("c_mktsegment", F.when(test, F.concat(F.lit(mark), segment)).otherwise(segment))

    plan = apart(F.col("o_orderkey") % 3 == 0, "plan ").select(*FVA_KEYS, "month", scaled(1.05).alias("volume"))
    actual = apart(F.col("o_orderstatus") == "P", "sold ").select(
        *FVA_KEYS, "month", F.lit(1.0).alias("qty"), F.col("total").alias("rbv"), scaled(0.80).alias("rlv")
    )
    budget = apart(F.col("o_orderkey") % 2 == 1, "plan ").select(
        *FVA_KEYS, "month", F.col("total").alias("volume"), scaled(0.70).alias("rlv")
    )
    return tidy(forecast.forecast_vs_actual(plan, actual, budget, FVA_KEYS, "month"))


@query(
    "splice_forecast",
    tidy_sql(
        f"""
        WITH o AS (SELECT strftime(order_date, '%Y%m') AS month, org, c_mktsegment, total, o_orderstatus FROM ({PLACED_SQL}) AS x)
        SELECT DISTINCT * FROM (
          SELECT month, org, c_mktsegment, total FROM o WHERE o_orderstatus = 'F' AND month < '199807'
          UNION ALL SELECT month, org, c_mktsegment, total FROM o WHERE o_orderstatus = 'O' AND month >= '199807'
          UNION ALL SELECT month, org, c_mktsegment, total FROM o WHERE o_orderstatus <> 'F' AND month > '199807')
        """,
        ["month", "org", "c_mktsegment"],
        ["total"],
    ),
)
def splice_forecast(spark, sf):
    order = placed_orders(spark, sf)
    rows = order.select(F.date_format("order_date", "yyyyMM").alias("month"), "org", "c_mktsegment", "total", "o_orderstatus")

    def part(test):
        return rows.where(test).drop("o_orderstatus")

    status = F.col("o_orderstatus")
    current = forecast.previous_day_month(F.lit("1998-08-01").cast("date"))  # the day before is still July
    return tidy(forecast.splice_forecast(part(status == "F"), part(status == "O"), part(status != "F"), "month", current))


@query(
    "freeze_history",
    """
    WITH o AS (SELECT o_custkey % 100 AS agent, strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus FROM orders)
    SELECT agent, month, count(*) AS target FROM o WHERE o_orderstatus = 'F' AND month <> '2001-06' GROUP BY ALL
    UNION ALL SELECT agent, month, count(*) + 1 FROM o WHERE o_orderstatus <> 'F' AND month = '2001-06' GROUP BY ALL
    """,
)
def freeze_history(spark, sf):
    order = table(spark, sf, "orders").select(
        (F.col("o_custkey") % 100).alias("agent"), F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderstatus"
    )

    def targets(test, extra):
        return order.where(test).groupBy("agent", "month").agg((F.count(F.lit(1)) + extra).alias("target"))

    stored = targets(F.col("o_orderstatus") == "F", 0)
    fresh = targets(F.col("o_orderstatus") != "F", 1)
    return forecast.freeze_history(stored, fresh, "month", "2001-06")


@query(
    "backfill_zero_targets",
    f"""
    WITH o AS ({PLACED_SQL}),
    t AS (SELECT org, n_name, month, CAST(count(*) AS BIGINT) AS target FROM o WHERE total > 300000 GROUP BY ALL),
    c AS (SELECT DISTINCT org, n_name, month FROM o WHERE total <= 300000)
    SELECT org, n_name, month, CAST(sum(target) AS BIGINT) AS target FROM (
      SELECT * FROM t UNION ALL
      SELECT *, 0 FROM c WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.org = c.org AND t.n_name = c.n_name AND t.month = c.month))
    GROUP BY ALL
    """,
)
def backfill_zero_targets(spark, sf):
    order = placed_orders(spark, sf)
    keys = ["org", "n_name", "month"]
    targets = order.where(F.col("total") > 300000).groupBy(*keys).agg(F.count(F.lit(1)).alias("target"))
    return forecast.backfill_zero_targets(targets, order.where(F.col("total") <= 300000), keys)


# --- progress, capacity, run rate ----------------------------------------------------------------------------

PROGRESS_SQL = f"""
CAST(CASE WHEN date_trunc('month', {{d}}) = date_trunc('month', DATE '{AS_OF}')
     THEN datediff('day', date_trunc('month', {{d}}), DATE '{AS_OF}') ELSE day(last_day({{d}})) END AS INTEGER) AS days_elapsed,
CAST(CASE WHEN date_trunc('month', {{d}}) = date_trunc('month', DATE '{AS_OF}')
     THEN datediff('day', DATE '{AS_OF}' - 1, last_day({{d}})) ELSE 0 END AS INTEGER) AS days_remaining
"""


@query(
    "month_progress",
    f"""
    SELECT o_orderkey, d AS order_date, {PROGRESS_SQL.format(d='d')}
    FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders) AS o
    """,
)
def month_progress(spark, sf):
    order = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return kpi.month_progress(order, "order_date", AS_OF)


@query(
    "branch_capacity",
    tidy_sql(
        f"""
        SELECT o_orderkey, month, n_regionkey, agent, total,
               sum(total) OVER (PARTITION BY month, n_regionkey) AS branch_capacity
        FROM (SELECT o_orderkey, month, n_regionkey, o_custkey % 40 AS agent, total FROM ({PLACED_SQL}) AS x) AS p
        """,
        ["o_orderkey", "month", "n_regionkey", "agent"],
        ["total", "branch_capacity"],
    ),
)
def branch_capacity(spark, sf):
    rows = placed_orders(spark, sf).select(
        "o_orderkey", "month", "n_regionkey", (F.col("o_custkey") % 40).alias("agent"), "total"
    )
    return tidy(kpi.branch_capacity(rows, ["month", "n_regionkey"], "total"))


@query(
    "home_branch",
    f"""
    SELECT agent, branch, CAST(capacity AS BIGINT) AS capacity FROM (
      SELECT *, rank() OVER (PARTITION BY agent ORDER BY capacity DESC) AS r FROM (
        SELECT l_suppkey AS agent, l_returnflag || l_linestatus AS branch, CAST(count(*) / 4 AS BIGINT) AS capacity
        FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-06-01' AND l_shipdate < TIMESTAMP '2000-07-01' GROUP BY ALL)) WHERE r = 1
    """.replace("count(*) / 4", "count(*) // 4"),
)
def home_branch(spark, sf):
    ship = F.col("l_shipdate").cast("date")
    rows = table(spark, sf, "lineitem").where((ship >= "2000-06-01") & (ship < "2000-07-01"))
    capacity = rows.groupBy(
        F.col("l_suppkey").alias("agent"), F.concat("l_returnflag", "l_linestatus").alias("branch")
    ).agg(F.floor(F.count(F.lit(1)) / 4).alias("capacity"))
    return kpi.home_branch(capacity, ["agent"], "branch", "capacity")


@query(
    "collect_runrate",
    tidy_sql(
        f"""
        WITH o AS ({PLACED_SQL}),
        c AS (SELECT n_name, month, count(CASE WHEN o_orderstatus <> 'P' THEN 1 END) AS n_approved FROM o GROUP BY ALL),
        t AS (SELECT n_name, month, count(*) * 0.7::DOUBLE AS capacity FROM o WHERE n_nationkey % 6 <> 0 GROUP BY ALL),
        j AS (SELECT c.*, capacity, {PROGRESS_SQL.format(d='month')} FROM c LEFT JOIN t USING (n_name, month)),
        r AS (SELECT *, CASE WHEN month = date_trunc('month', DATE '{AS_OF}')
              THEN (CAST(n_approved AS DOUBLE) / CAST(days_elapsed AS DOUBLE) * days_remaining + n_approved) / capacity
              ELSE CAST(n_approved AS DOUBLE) / capacity END AS running FROM j)
        SELECT n_name, month, n_approved, capacity, running,
               CASE WHEN running < 0.8 THEN 'Abaixo 80%' WHEN running >= 1.0 THEN 'Acima ou igual a 100%' ELSE 'Entre 80% e 100%' END AS status
        FROM r
        """,
        ["n_name", "month", "n_approved", "status"],
        ["capacity", "running"],
    ),
)
def collect_runrate(spark, sf):
    order = placed_orders(spark, sf).withColumn("approved", F.col("o_orderstatus") != "P")
    capacity = order.where(F.col("n_nationkey") % 6 != 0).groupBy("n_name", "month").agg(
        (F.count(F.lit(1)) * 0.7).alias("capacity")
    )
    return tidy(kpi.run_rate(order, capacity, "n_name", "order_date", "approved", AS_OF))


@query(
    "dispersion_std",
    f"""
    WITH c AS ({COLLECTS_SQL}),
    g AS (SELECT l_returnflag, branch, l_linestatus, stddev_samp(CAST(price_kg AS DOUBLE)) AS s, count(price_kg) AS n
          FROM c WHERE price_kg BETWEEN 2 AND 10 AND branch % 4 <> 1 GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {half_up('CASE WHEN n = 1 THEN 0.0 ELSE s END', 3)} AS price_std
    FROM c LEFT JOIN g ON c.l_returnflag = g.l_returnflag AND c.branch = g.branch AND c.l_linestatus = g.l_linestatus
    """,
)
def dispersion_std(spark, sf):
    rows = collects(spark, sf).withColumn(
        "approved", F.col("price_kg").between(2, 10) & (F.col("branch") % 4 != 1)
    )
    return kpi.price_std(rows, ["l_returnflag", "branch", "l_linestatus"], "price_kg", "approved").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "price_std"
    )


# --- own price and premium -----------------------------------------------------------------------------------------

OWN_KEYS = ["org", "l_suppkey", "l_returnflag"]


@query(
    "own_price_ref",
    tidy_sql(
        f"""
        WITH b AS (SELECT org, l_suppkey, l_returnflag, ship_date AS billing_date,
                          CASE WHEN org = 'BRDI' THEN order_date ELSE ship_date END AS ref_date,
                          CAST(ext * (1.00 - disc) AS DECIMAL(18,4)) AS price, l_linenumber
                   FROM ({LINES_SQL}) AS l),
        own AS (SELECT * FROM b WHERE l_linenumber <= 4),
        d AS (SELECT {', '.join(OWN_KEYS)}, ref_date, count(price) AS day_count, CAST(sum(price) AS DOUBLE) / count(price) AS day_mean FROM own GROUP BY ALL),
        w AS (SELECT {', '.join(OWN_KEYS)}, isoyear(ref_date) AS iso_year, weekofyear(ref_date) AS iso_week,
                     CAST(sum(price) AS DOUBLE) / count(price) AS week_mean FROM own GROUP BY ALL),
        x AS (SELECT DISTINCT {', '.join(OWN_KEYS)}, ref_date, billing_date, isoyear(ref_date) AS iso_year, weekofyear(ref_date) AS iso_week FROM own)
        SELECT {', '.join(OWN_KEYS)}, ref_date, billing_date, CAST(iso_year AS INTEGER) AS iso_year, CAST(iso_week AS INTEGER) AS iso_week,
               day_count, day_mean, week_mean
        FROM x JOIN d USING ({', '.join(OWN_KEYS)}, ref_date) JOIN w USING ({', '.join(OWN_KEYS)}, iso_year, iso_week)
        UNION ALL
        SELECT DISTINCT {', '.join(OWN_KEYS)}, ref_date, ref_date, CAST(isoyear(ref_date) AS INTEGER), CAST(weekofyear(ref_date) AS INTEGER), 0, 0, 0
        FROM b WHERE l_linenumber > 4 AND NOT EXISTS (SELECT 1 FROM d WHERE {' AND '.join(f'd.{c} = b.{c}' for c in [*OWN_KEYS, 'ref_date'])})
        """,
        [*OWN_KEYS, "ref_date", "billing_date", "iso_year", "iso_week", "day_count"],
        ["day_mean", "week_mean"],
    ),
)
def own_price_ref(spark, sf):
    rows = lines(spark, sf).withColumn("price", F.expr("ext * (1 - disc)"))
    by_order = F.col("org") == "BRDI"
    surveyed = rows.where(F.col("l_linenumber") > 4).withColumn(
        "ref_date", F.when(by_order, F.col("order_date")).otherwise(F.col("ship_date"))
    )
    return tidy(
        kpi.own_price_ref(
            rows.where(F.col("l_linenumber") <= 4), surveyed, OWN_KEYS, "price", "ship_date", "order_date", by_order
        )
    )


PREMIUM_KEYS = ["nation", "p_type", "year"]
PREMIUM_OUT = [
    "competitor_price", "own_price", "policy_mean", "channel_price", "base_price", "target_premium", "practiced_premium",
    "mark_up", "policy_premium", "deviation_policy_premium", "practiced_premium_sample", "premium_deviation",
]
PREMIUM_SQL = f"""
WITH c AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, org, s_nationkey AS nation, p_type,
                  CAST(year(ship_date) AS INTEGER) AS year, l_returnflag = 'N' AS own,
                  CAST(ext / qty AS DECIMAL(18,4)) AS price0, ext, qty, disc, tax FROM ({CONDITIONS_SQL}) AS x JOIN supplier ON l_suppkey = s_suppkey),
p AS (SELECT *, CAST(ext * (1.00 - disc) AS DECIMAL(18,4)) AS price, CAST(ext * (1.00 - disc) - qty * 0.50 AS DECIMAL(18,4)) AS policy,
             CAST(ext * (1.00 - tax) AS DECIMAL(18,4)) AS net FROM c),
g AS (SELECT org, {', '.join(PREMIUM_KEYS)}, count(*) FILTER (NOT own) AS n_competitor,
             CAST(sum(price) FILTER (NOT own) AS DOUBLE) / nullif(count(price) FILTER (NOT own), 0) AS competitor_price,
             CAST(sum(price) FILTER (own) AS DOUBLE) / nullif(count(price) FILTER (own), 0) AS own_price,
             CAST(sum(policy) FILTER (own) AS DOUBLE) / nullif(count(policy) FILTER (own), 0) AS policy_mean FROM p GROUP BY ALL),
h AS (SELECT {', '.join(PREMIUM_KEYS)},
             CAST(sum(net) FILTER (own AND org = 'BRCG') AS DOUBLE) / nullif(count(net) FILTER (own AND org = 'BRCG'), 0) AS channel_price,
             CAST(sum(net) FILTER (own AND org = 'BRDI') AS DOUBLE) / nullif(count(net) FILTER (own AND org = 'BRDI'), 0) AS base_price FROM p GROUP BY ALL),
t AS (SELECT n_nationkey AS nation, 0.01::DOUBLE * n_regionkey AS target FROM nation WHERE n_nationkey % 2 = 0),
j AS (SELECT p.*, n_competitor, competitor_price, own_price, policy_mean, channel_price, base_price, coalesce(target, 0.03::DOUBLE) AS target_premium
      FROM p JOIN g USING (org, {', '.join(PREMIUM_KEYS)}) JOIN h USING ({', '.join(PREMIUM_KEYS)}) LEFT JOIN t USING (nation))
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n_competitor, competitor_price, own_price, policy_mean, channel_price, base_price, target_premium,
       own_price / competitor_price - 1 AS practiced_premium, channel_price / base_price - 1 AS mark_up,
       CASE WHEN n_competitor <= 10 THEN policy_mean / competitor_price - 1 END AS policy_premium,
       CASE WHEN n_competitor > 10 THEN nullif(policy_mean, 0) / competitor_price - 1 END AS deviation_policy_premium,
       CASE WHEN n_competitor > 10 THEN own_price / competitor_price - 1 END AS practiced_premium_sample,
       CASE WHEN n_competitor > 10 THEN own_price / competitor_price - 1 - target_premium END AS premium_deviation
FROM j
"""


@query(
    "premium_vs_competitor",
    tidy_sql(PREMIUM_SQL, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "n_competitor"], PREMIUM_OUT),
)
def premium_vs_competitor(spark, sf):
    seller = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation")
    )
    rows = conditions(spark, sf).join(seller, "l_suppkey").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "org", "nation", "p_type", "l_returnflag",
        F.year("ship_date").alias("year"),
        F.expr("ext * (1 - disc)").alias("price"),
        F.expr("ext * (1 - disc) - qty * 0.50D").alias("policy"),
        F.expr("ext * (1 - tax)").alias("net"),
    )
    goals = table(spark, sf, "nation").where(F.col("n_nationkey") % 2 == 0).select(
        F.col("n_nationkey").alias("nation"), (F.col("n_regionkey") * 0.01).alias("target_premium")
    )
    out = kpi.premium(
        rows, PREMIUM_KEYS, "org", F.col("l_returnflag") == "N", "price", "policy", "net", goals, ["nation"]
    )
    return tidy(out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "n_competitor", *PREMIUM_OUT))


# --- realised targets and calendar -----------------------------------------------------------------------------------

@query(
    "realised_vs_target",
    """
    WITH t AS (SELECT user_id, event_type, CAST(sum(k) AS BIGINT) AS target FROM (
                 SELECT user_id, CASE WHEN event_id % 4 = 0 THEN event_type ELSE 'goal ' || event_type END AS event_type,
                        CAST(event_id % 3 AS BIGINT) AS k FROM events) GROUP BY ALL),
    c AS (SELECT user_id, CASE WHEN value > 20 THEN event_type ELSE 'low ' || event_type END AS event_type, count(*) AS n FROM events GROUP BY ALL),
    j AS (SELECT user_id, event_type, target, coalesce(n, 0) AS n_collects,
                 CASE WHEN target <> 0 THEN CAST(coalesce(n, 0) AS DOUBLE) / target END AS realised
          FROM t LEFT JOIN c USING (user_id, event_type))
    SELECT user_id, event_type, target, n_collects, CAST(floor(realised * 1e6 + 0.5::DOUBLE) AS BIGINT) / 1e6 AS realised,
           realised IS NOT NULL AS has_price, CAST(CASE WHEN realised IS NULL THEN NULL WHEN realised >= 1 THEN 1 ELSE 0 END AS INTEGER) AS realised_flag
    FROM j
    """,
)
def realised_vs_target(spark, sf):
    event = table(spark, sf, "events")

    def apart(test, mark):
        kind = F.col("event_type")
        return event.withColumn("event_type", F.when(test, kind).otherwise(F.concat(F.lit(mark), kind)))

    targets = apart(F.col("event_id") % 4 == 0, "goal ").withColumn("target", F.col("event_id") % 3)
    out = kpi.realised_vs_target(targets, apart(F.col("value") > 20, "low "), ["user_id", "event_type"])
    return tidy(out.withColumn("has_price", F.col("realised_text") != "Sem Preço").drop("realised_text"))


@query(
    "business_days",
    """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(DISTINCT CAST(o_orderdate AS DATE)) AS business_days
    FROM orders WHERE isodow(o_orderdate) < 6 GROUP BY 1
    """,
)
def business_days(spark, sf):
    order = table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return kpi.business_days(order, "day", F.dayofweek("day").isin(1, 7))
