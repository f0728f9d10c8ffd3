"""Join queries: equi, default, as-of, interval, snapshot, keyword and grid joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelspark.functions.dates import month_start
from panelspark.operators import joins as J
from panelspark.operators.windows import latest_per_key, period_index
from panelspark.plans.registry import query
from panelspark.plans.shapes import (
    bars,
    customer_days,
    daily_bars,
    index_bars,
    pit_series,
    r,
    rnd,
    statements,
    supplier_region,
    table,
    validity,
    with_ctes,
)


@query(
    "E1",
    with_ctes(
        "bars",
        f"""SELECT b.entity, b.period, {rnd('close', 2)} AS close, days, {rnd('max_discount')} AS max_discount
 FROM bars b LEFT JOIN (SELECT l_suppkey AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS period,
  count(DISTINCT l_shipdate) AS days, max(l_discount) AS max_discount FROM lineitem GROUP BY 1, 2) m USING (entity, period)""",
    ),
)
def join_entity_time(spark, sf_dir):
    metrics = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("entity"), month_start(F.col("l_shipdate").cast("date")).alias("period"))
        .agg(F.count_distinct("l_shipdate").alias("days"), F.max("l_discount").alias("max_discount"))
    )
    return (
        bars(spark, sf_dir)
        .join(metrics, ["entity", "period"], "left")
        .select("entity", "period", r("close", 2).alias("close"), "days", r("max_discount").alias("max_discount"))
    )


@query(
    "E2 E3",
    """SELECT o_orderkey, coalesce(urgent, 0) AS urgent, coalesce(n_lines, 0) AS n_lines FROM orders
 LEFT JOIN (SELECT l_orderkey, CAST(max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INTEGER) AS urgent,
  count(*) AS n_lines FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey""",
)
def join_flag_with_default(spark, sf_dir):
    flags = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.max(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("urgent"),
            F.count("*").alias("n_lines"),
        )
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return J.left_join_default(orders, flags, ["o_orderkey"], {"urgent": 0, "n_lines": 0})


@query(
    "E4",
    f"""SELECT s_suppkey, n_name, r_name, {rnd('s_acctbal', 2)} AS s_acctbal FROM supplier
 LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def join_dimensions(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    places = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return (
        table(spark, sf_dir, "supplier")
        .join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select("s_suppkey", "n_name", "r_name", r("s_acctbal", 2).alias("s_acctbal"))
    )


# Ship days of a customer's orders look up the label valid on that day.
SQL_ASKED = """SELECT DISTINCT o_custkey AS entity, CAST(l_shipdate AS DATE) AS d
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def asked_days(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").alias("d"))
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("entity"))
    return lines.join(orders, "l_orderkey").select("entity", "d").distinct()


@query(
    "E5",
    with_ctes(
        "validity",
        """SELECT a.entity, a.d, CASE WHEN v.out_date IS NULL OR a.d < v.out_date THEN v.label END AS label
 FROM asked a ASOF LEFT JOIN validity v ON a.entity = v.entity AND a.d >= v.in_date""",
        asked=SQL_ASKED,
    ),
)
def join_asof_with_validity(spark, sf_dir):
    return J.asof_valid_join(
        asked_days(spark, sf_dir), validity(spark, sf_dir), ["entity"], "d", "in_date", "out_date", ["label"]
    ).select("entity", "d", "label")


SQL_EVENTS = """SELECT event_id, user_id AS entity, CAST(ts AS DATE) AS d FROM events"""


@query(
    "E7",
    with_ctes(
        "pit",
        f"""SELECT e.event_id, e.entity, e.d,
  CASE WHEN e.d - p.t <= 5 THEN {rnd('p.value', 2)} END AS value, CASE WHEN e.d - p.t <= 5 THEN p.t END AS known
 FROM ev e ASOF LEFT JOIN pit p ON e.entity = p.entity AND e.d >= p.t""",
        ev=SQL_EVENTS,
    ),
)
def join_point_in_time_bounded(spark, sf_dir):
    views = (
        table(spark, sf_dir, "events")
        .select("event_id", F.col("user_id").alias("entity"), F.col("ts").cast("date").alias("d"))
    )
    return J.asof_join(
        views, pit_series(spark, sf_dir), ["entity"], "d", "t", ["value"], bucket="week", max_days=5, keep_time="known"
    ).select("event_id", "entity", "d", r("value", 2).alias("value"), "known")


# Membership lists that are published twice a year.
SQL_MEMBERS = "SELECT grp, period AS month, entity, vol FROM bars WHERE month(period) IN (2, 7)"


def members(spark, sf_dir):
    return bars(spark, sf_dir).where(F.month("period").isin(2, 7)).select("grp", F.col("period").alias("month"), "entity", "vol")


@query(
    "E8 P5",
    with_ctes(
        "bars",
        """SELECT m.grp, t.month, m.entity, m.vol FROM (
  SELECT g.grp, mo.month, max(s.month) AS snap FROM (SELECT DISTINCT grp FROM mem) g
  CROSS JOIN (SELECT DISTINCT period AS month FROM bars) mo
  JOIN (SELECT DISTINCT grp, month FROM mem) s ON s.grp = g.grp AND s.month <= mo.month GROUP BY 1, 2) t
 JOIN mem m ON m.grp = t.grp AND m.month = t.snap""",
        mem=SQL_MEMBERS,
    ),
)
def join_snapshot_forward_fill(spark, sf_dir):
    months = bars(spark, sf_dir).select(F.col("period").alias("month"))
    return J.snapshot_forward_fill(members(spark, sf_dir), months, "grp", "month", ["entity", "vol"])


@query(
    "E6 F16",
    with_ctes(
        "bars",
        """SELECT b.entity, b.period, """
        + ", ".join(f"CAST(coalesce(max(CASE WHEN f.grp = {g} THEN 1 END), 0) AS INTEGER) AS is_g{g}" for g in range(5))
        + """ FROM bars b LEFT JOIN filled f ON f.entity = b.entity AND f.month = b.period GROUP BY 1, 2""",
        mem=SQL_MEMBERS,
        filled="""SELECT m.grp, t.month, m.entity FROM (
  SELECT g.grp, mo.month, max(s.month) AS snap FROM (SELECT DISTINCT grp FROM mem) g
  CROSS JOIN (SELECT DISTINCT period AS month FROM bars) mo
  JOIN (SELECT DISTINCT grp, month FROM mem) s ON s.grp = g.grp AND s.month <= mo.month GROUP BY 1, 2) t
 JOIN mem m ON m.grp = t.grp AND m.month = t.snap""",
    ),
)
def join_membership_flags(spark, sf_dir):
    b = bars(spark, sf_dir)
    filled = J.snapshot_forward_fill(
        members(spark, sf_dir), b.select(F.col("period").alias("month")), "grp", "month", ["entity"]
    )
    flags = (
        filled.groupBy("entity", F.col("month").alias("period"))
        .pivot("grp", list(range(5)))
        .agg(F.lit(1))
        .select("entity", "period", *[F.col(f"`{g}`").alias(f"is_g{g}") for g in range(5)])
    )
    return J.left_join_default(
        b.select("entity", "period"), flags, ["entity", "period"], {f"is_g{g}": 0 for g in range(5)}
    )


@query(
    "E9",
    with_ctes(
        "bars",
        f"""SELECT o_orderkey, b.entity, {rnd('b.amount', 2)} AS amount FROM orders JOIN lineitem ON o_orderkey = l_orderkey
 JOIN bars b ON b.entity = l_suppkey AND b.period = CAST(date_trunc('month', o_orderdate) AS DATE)""",
    ),
)
def join_on_derived_month(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", month_start(F.col("o_orderdate").cast("date")).alias("period")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("entity")
    )
    return (
        orders.join(lines, "o_orderkey")
        .join(bars(spark, sf_dir).select("entity", "period", "amount"), ["entity", "period"])
        .select("o_orderkey", "entity", r("amount", 2).alias("amount"))
    )


@query(
    "E10",
    f"""SELECT c_custkey, {rnd('coalesce(total, 0)', 2)} AS total, CAST(o.k IS NOT NULL AS INTEGER) AS has_orders,
 CAST(e.k IS NOT NULL AS INTEGER) AS has_events, CAST(f.k IS NOT NULL AS INTEGER) AS has_returns FROM customer
 LEFT JOIN (SELECT o_custkey AS k, sum(o_totalprice) AS total FROM orders GROUP BY 1) o ON o.k = c_custkey
 LEFT JOIN (SELECT user_id AS k FROM events GROUP BY 1) e ON e.k = c_custkey
 LEFT JOIN (SELECT o_custkey AS k FROM orders JOIN lineitem ON o_orderkey = l_orderkey
   WHERE l_returnflag = 'R' GROUP BY 1) f ON f.k = c_custkey""",
)
def join_sources_with_presence(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    totals = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum("o_totalprice").alias("total"), F.count("*").alias("_o")
    )
    users = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("_e"))
    returned = (
        table(spark, sf_dir, "lineitem")
        .where("l_returnflag = 'R'")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count("*").alias("_f"))
    )
    merged = J.presence_merge(
        table(spark, sf_dir, "customer").select("c_custkey"),
        {"orders": (totals, "_o"), "events": (users, "_e"), "returns": (returned, "_f")},
        ["c_custkey"],
    )
    return merged.select(
        "c_custkey", r(F.coalesce("total", F.lit(0.0)), 2).alias("total"), "has_orders", "has_events", "has_returns"
    )


@query(
    "E11",
    with_ctes(
        "bars",
        f"""SELECT b.entity, b.period, {rnd('b.close / g.mean_close - 1')} AS relative FROM bars b
 LEFT JOIN (SELECT grp, period, avg(close) AS mean_close FROM bars GROUP BY 1, 2) g
 ON g.grp = b.grp AND g.period = b.period""",
    ),
)
def join_group_series(spark, sf_dir):
    b = bars(spark, sf_dir)
    series = b.groupBy("grp", "period").agg(F.avg("close").alias("mean_close"))
    return b.join(series, ["grp", "period"], "left").select(
        "entity", "period", r(F.col("close") / F.nullif("mean_close", F.lit(0.0)) - 1).alias("relative")
    )


@query(
    "E12",
    with_ctes(
        "bars",
        f"""SELECT entity, period, {rnd('close', 2)} AS close FROM bars b WHERE EXISTS (
  SELECT 1 FROM mem m WHERE m.entity = b.entity AND m.month = b.period)""",
        mem=SQL_MEMBERS,
    ),
)
def join_membership_restriction(spark, sf_dir):
    m = members(spark, sf_dir).select("entity", F.col("month").alias("period"))
    return bars(spark, sf_dir).join(m, ["entity", "period"], "left_semi").select("entity", "period", r("close", 2).alias("close"))


@query(
    "E13",
    with_ctes(
        "cal",
        """SELECT cal_date, coalesce(n, 0) AS n, CAST(n IS NULL AS INTEGER) AS missing FROM cal
 LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
 ON cal_date = d WHERE is_open = 1""",
    ),
)
def join_expected_with_actual(spark, sf_dir):
    from panelspark.plans.shapes import calendar

    counts = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderdate").cast("date").alias("cal_date"))
        .agg(F.count("*").alias("_n"))
    )
    grid = calendar(spark, sf_dir).where("is_open = 1").select("cal_date")
    return grid.join(counts, "cal_date", "left").select(
        "cal_date", F.coalesce("_n", F.lit(0)).alias("n"), F.col("_n").isNull().cast("int").alias("missing")
    )


@query(
    "E14 J9",
    """SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'HIGH' WHEN '2-HIGH' THEN 'HIGH' WHEN '5-LOW' THEN 'LOW'
  ELSE o_orderpriority END AS code, count(*) AS n FROM orders GROUP BY 1""",
)
def join_canonical_codes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("code"))
    mapped = J.canonical_codes(orders, "code", {"1-URGENT": "HIGH", "2-HIGH": "HIGH", "5-LOW": "LOW"})
    return mapped.groupBy("code").agg(F.count("*").alias("n"))


KEYWORDS = [
    ("ring", "metal", "large"),
    ("red", "paint", "mid"),
    ("widget", "device", "mid"),
    ("bolt", "metal", "small"),
    ("g", "other device", "small"),
]


@query(
    "E15 J1 L5",
    "SELECT p_name, CASE "
    + " ".join(f"WHEN contains(p_name, '{k}') THEN '{s}'" for k, s, _ in KEYWORDS)
    + " ELSE 'none' END AS sector, CASE "
    + " ".join(f"WHEN contains(p_name, '{k}') THEN '{c}'" for k, _, c in KEYWORDS)
    + " ELSE 'unknown' END AS cap, count(*) AS n FROM part GROUP BY ALL",
)
def join_keyword_rules(spark, sf_dir):
    names = table(spark, sf_dir, "part").groupBy("p_name").agg(F.count("*").alias("n"))
    hit = J.first_match(F.col("p_name"), KEYWORDS)
    return names.withColumn("_m", hit).select(
        "p_name",
        F.coalesce("_m._2", F.lit("none")).alias("sector"),
        F.coalesce("_m._3", F.lit("unknown")).alias("cap"),
        "n",
    )


@query(
    "E16",
    with_ctes(
        "validity",
        """SELECT a.entity, a.d, v.label FROM asked a JOIN validity v ON a.entity = v.entity
 AND a.d >= v.in_date AND a.d <= coalesce(v.out_date, DATE '2099-12-31')""",
        asked=SQL_ASKED,
    ),
)
def join_interval_containment(spark, sf_dir):
    return J.interval_join(
        asked_days(spark, sf_dir), validity(spark, sf_dir), ["entity"], "d", "in_date", "out_date", ["label"]
    ).select("entity", "d", "label")


@query(
    "E17 G13",
    with_ctes(
        "bars",
        f"""SELECT entity, period, {rnd('last_value(close IGNORE NULLS) OVER (PARTITION BY entity ORDER BY period)', 2)}
  AS close, CAST(close IS NULL AS INTEGER) AS filled FROM (
 SELECT g.entity, m.period, b.close FROM (SELECT entity, min(period) AS a, max(period) AS z FROM bars GROUP BY 1) g
 JOIN (SELECT DISTINCT period FROM bars) m ON m.period BETWEEN a AND z
 LEFT JOIN bars b ON b.entity = g.entity AND b.period = m.period)""",
    ),
)
def join_life_span_grid(spark, sf_dir):
    b = bars(spark, sf_dir).select("entity", "period", "close")
    grid = J.life_span_grid(b, "entity", "period", period_index(b, "period").drop("last_idx"))
    w = Window.partitionBy("entity").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    return grid.select(
        "entity",
        "period",
        r(F.last("close", ignorenulls=True).over(w), 2).alias("close"),
        F.col("close").isNull().cast("int").alias("filled"),
    )


@query(
    "E18",
    with_ctes(
        "statements",
        f"""SELECT g.entity, g.period, {rnd('s.revenue', 2)} AS revenue FROM (
 SELECT entity, CAST(date_trunc('quarter', x) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS period FROM (
  SELECT entity, unnest(generate_series(date_trunc('quarter', min(period)), date_trunc('quarter', max(period)),
   INTERVAL 3 MONTH)) AS x FROM statements GROUP BY entity)) g
 LEFT JOIN statements s ON s.entity = g.entity AND s.period = g.period""",
    ),
)
def join_quarter_grid(spark, sf_dir):
    return J.quarter_grid(statements(spark, sf_dir), "entity", "period").select(
        "entity", "period", r("revenue", 2).alias("revenue")
    )


@query(
    "E19",
    with_ctes(
        "dbars",
        f"""SELECT a.entity, a.period, {rnd('a.v1')} AS v1, {rnd('b.v2')} AS v2, {rnd('c.v3')} AS v3 FROM
 (SELECT entity, period, close / open - 1 AS v1 FROM dbars) a
 LEFT JOIN (SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS period, max(l_tax) AS v2 FROM lineitem
   WHERE l_returnflag = 'R' GROUP BY 1, 2) b USING (entity, period)
 LEFT JOIN (SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS period, max(l_discount) AS v3 FROM lineitem
   WHERE l_returnflag = 'A' GROUP BY 1, 2) c USING (entity, period)""",
    ),
)
def join_many_factors(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    keys = [F.col("l_suppkey").alias("entity"), F.col("l_shipdate").cast("date").alias("period")]
    v2 = lines.where("l_returnflag = 'R'").groupBy(*keys).agg(F.max("l_tax").alias("v2"))
    v3 = lines.where("l_returnflag = 'A'").groupBy(*keys).agg(F.max("l_discount").alias("v3"))
    v1 = daily_bars(spark, sf_dir).select("entity", "period", (F.try_divide("close", "open") - 1).alias("v1"))
    out = v1.join(v2, ["entity", "period"], "left").join(v3, ["entity", "period"], "left")
    return out.select("entity", "period", *[r(c).alias(c) for c in ("v1", "v2", "v3")])


@query(
    "D10 N1",
    with_ctes(
        "region_of",
        """SELECT s_suppkey, coalesce(r_name, 'OTHER') AS category FROM supplier JOIN region_of ON s_suppkey = entity
 LEFT JOIN region ON r_regionkey = grp AND r_name <> 'ASIA' WHERE coalesce(r_name, 'OTHER') IN ('OTHER', 'EUROPE', 'AFRICA')""",
    ),
)
def universe_by_category(spark, sf_dir):
    region = table(spark, sf_dir, "region").where("r_name <> 'ASIA'").select(F.col("r_regionkey").alias("grp"), "r_name")
    return (
        supplier_region(spark, sf_dir)
        .join(F.broadcast(region), "grp", "left")
        .select(F.col("entity").alias("s_suppkey"), F.coalesce("r_name", F.lit("OTHER")).alias("category"))
        .where(F.col("category").isin("OTHER", "EUROPE", "AFRICA"))
    )


@query(
    "E5 E7",
    f"""WITH v AS (SELECT o_orderpriority AS p, CAST(o_orderdate AS DATE) AS d, {rnd('max(o_totalprice)', 2)} AS best FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
SELECT o.o_orderkey, v.best, v.d AS known_at FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders) o ASOF LEFT JOIN v ON v.p = o.o_orderpriority AND o.d >= v.d""",
)
def join_asof_hot_keys(spark, sf_dir):
    """Five keys hold all rows; each year of a key is cut into pieces of some hundred rows."""
    orders = table(spark, sf_dir, "orders").withColumn("d", F.col("o_orderdate").cast("date"))
    values = orders.where("o_orderstatus = 'F'").groupBy("o_orderpriority", "d").agg(r(F.max("o_totalprice"), 2).alias("best"))
    out = J.asof_join(orders.drop("best"), values, ["o_orderpriority"], "d", "d", ["best"], bucket="year", keep_time="known_at", split=300)
    return out.select("o_orderkey", "best", "known_at")
