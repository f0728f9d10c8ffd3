"""Data-quality and schema queries."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.operators import calendar as C
from panelspark.operators import quality as Q
from panelspark.operators import schema as S
from panelspark.functions.dates import quarter_end
from panelspark.plans.registry import query
from panelspark.plans.shapes import calendar, r, rcols, rnd, table, with_ctes


@query(
    "O1 P14",
    with_ctes(
        "cal",
        """SELECT e.source, e.biz_date, e.row_count, coalesce(m.med, 0) AS year_median,
 CASE WHEN e.row_count = 0 THEN 'MISSING' WHEN coalesce(m.med, 0) > 0 AND e.row_count < m.med * 0.5 THEN 'PARTIAL' ELSE 'OK' END
 AS status FROM e LEFT JOIN (SELECT source, year(biz_date) AS y, CAST(round_even(median(row_count), 0) AS BIGINT) AS med
  FROM e WHERE row_count > 0 GROUP BY 1, 2) m ON m.source = e.source AND m.y = year(e.biz_date)""",
        counts="""SELECT 'orders' AS source, CAST(o_orderdate AS DATE) AS biz_date, count(*) AS row_count FROM orders GROUP BY 2 UNION ALL SELECT 'lineitem', CAST(l_shipdate AS DATE), count(*) FROM lineitem GROUP BY 2""",
        e="""SELECT s.source, c.cal_date AS biz_date, coalesce(n.row_count, 0) AS row_count FROM cal c
  JOIN (SELECT 'orders' AS source UNION ALL SELECT 'lineitem') s ON c.is_open = 1
  LEFT JOIN counts n ON n.source = s.source AND n.biz_date = c.cal_date""",
    ),
)
def quality_coverage(spark, sf_dir):
    days = calendar(spark, sf_dir).where("is_open = 1").select(F.col("cal_date").alias("biz_date"))
    expected = days.withColumn("source", F.explode(F.array(F.lit("orders"), F.lit("lineitem"))))
    counts = [
        table(spark, sf_dir, t)
        .groupBy(F.lit(t).alias("source"), F.col(c).cast("date").alias("biz_date"))
        .agg(F.count("*").alias("row_count"))
        for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"))
    ]
    return Q.coverage(expected, counts[0].unionByName(counts[1])).select(
        "source", "biz_date", "row_count", "year_median", "status"
    )


SOURCES = (
    ("order_days", "trade_day", date(1995, 3, 1), True),
    ("ship_days", "trade_day", date(1996, 1, 1), False),
    ("order_weeks", "week_end", date(1997, 6, 4), True),
    ("ship_months", "month_end", date(1995, 1, 15), False),
    ("order_quarters", "quarter_end", date(1998, 5, 5), True),
)
COVERED = (date(1995, 1, 1), date(2000, 11, 20))
_SOURCES_SQL = ", ".join(f"('{s}', '{g}', DATE '{d}', {str(p).lower()})" for s, g, d, p in SOURCES)
_OPEN_SQL = f"SELECT cal_date AS d FROM cal WHERE is_open = 1 AND cal_date BETWEEN DATE '{COVERED[0]}' AND DATE '{COVERED[1]}'"


@query(
    "O1",
    with_ctes(
        "cal",
        """SELECT e.source, e.grain, e.biz_date, e.row_count, coalesce(m.med, 0) AS year_median,
 CASE WHEN e.row_count = 0 THEN 'MISSING' WHEN e.check_partial AND coalesce(m.med, 0) > 0 AND e.row_count < m.med * 0.5 THEN 'PARTIAL' ELSE 'OK' END
 AS status FROM e LEFT JOIN (SELECT source, year(biz_date) AS y, CAST(round_even(median(row_count), 0) AS BIGINT) AS med
  FROM e WHERE row_count > 0 GROUP BY 1, 2) m ON m.source = e.source AND m.y = year(e.biz_date)""",
        counts="""SELECT s.source, x.d AS biz_date, count(*) AS row_count FROM (
  SELECT 'orders' AS t, CAST(o_orderdate AS DATE) AS d FROM orders UNION ALL SELECT 'lineitem', CAST(l_shipdate AS DATE) FROM lineitem
  UNION ALL SELECT 'quarters', CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) FROM orders) x
  JOIN (VALUES ('orders', 'order_days'), ('orders', 'order_weeks'), ('lineitem', 'ship_days'), ('lineitem', 'ship_months'), ('quarters', 'order_quarters')) s(t, source)
  ON s.t = x.t GROUP BY 1, 2""",
        grid=f"""SELECT 'trade_day' AS grain, d FROM ({_OPEN_SQL}) UNION ALL SELECT 'week_end', max(d) FROM ({_OPEN_SQL}) GROUP BY date_trunc('week', d)
  UNION ALL SELECT 'month_end', max(d) FROM ({_OPEN_SQL}) GROUP BY date_trunc('month', d)
  UNION ALL SELECT 'quarter_end', CAST(q + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) FROM range(DATE '{COVERED[0]}', DATE '{COVERED[1]}', INTERVAL 3 MONTH) r(q)
   WHERE q + INTERVAL 3 MONTH - INTERVAL 1 DAY <= DATE '{COVERED[1]}'""",
        e=f"""SELECT s.source, s.grain, s.check_partial, g.d AS biz_date, coalesce(n.row_count, 0) AS row_count
  FROM (VALUES {_SOURCES_SQL}) s(source, grain, first_date, check_partial) JOIN grid g ON g.grain = s.grain AND g.d >= s.first_date
  LEFT JOIN counts n ON n.source = s.source AND n.biz_date = g.d""",
    ),
)
def quality_coverage_by_source(spark, sf_dir):
    """Daily, weekly, monthly and quarterly sources, each with its own start and its own partial flag."""
    sources = spark.createDataFrame(SOURCES, "source string, grain string, first_date date, check_partial boolean")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("biz_date"))
    ships = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("biz_date"))
    by = lambda df, *names: df.groupBy("biz_date").agg(F.count("*").alias("row_count")).withColumn("source", F.explode(F.array(*map(F.lit, names))))
    quarters = orders.select(quarter_end("biz_date").alias("biz_date"))
    counts = reduce(DataFrame.unionByName, [by(orders, "order_days", "order_weeks"), by(ships, "ship_days", "ship_months"), by(quarters, "order_quarters")])
    expected = Q.expected_by_source(calendar(spark, sf_dir), sources, *COVERED)
    return Q.coverage(expected, counts, check_partial="check_partial").select("source", "grain", "biz_date", "row_count", "year_median", "status")


@query(
    "O2",
    f"""SELECT year(d) AS year, count(*) AS days, CAST(sum(n) AS BIGINT) AS rows, {rnd('avg(n)', 4)} AS rows_per_day,
 CAST(count(*) < 300 AS INTEGER) AS thin FROM (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) GROUP BY 1""",
)
def quality_year_coverage(spark, sf_dir):
    out = Q.year_coverage(table(spark, sf_dir, "orders"), "o_orderdate", least_days=300)
    return out.select("year", "days", "rows", r("rows_per_day", 4).alias("rows_per_day"), "thin")


@query(
    "O3",
    """SELECT unnest(['cheap', 'high_discount', 'bulk', 'no_date']) AS rule, unnest([count(*) FILTER (WHERE l_extendedprice < 2000),
 count(*) FILTER (WHERE l_discount > 0.09), count(*) FILTER (WHERE l_quantity >= 50), count(*) FILTER (WHERE l_shipdate IS NULL)])
 AS violations FROM lineitem""",
)
def quality_rules(spark, sf_dir):
    return Q.rule_counts(
        table(spark, sf_dir, "lineitem"),
        {
            "cheap": F.col("l_extendedprice") < 2000,
            "high_discount": F.col("l_discount") > 0.09,
            "bulk": F.col("l_quantity") >= 50,
            "no_date": F.col("l_shipdate").isNull(),
        },
    )


@query(
    "O4",
    f"""SELECT c AS "column", {rnd('x')} AS null_ratio, CAST(x > 0.05 AS INTEGER) AS flagged FROM (
 SELECT unnest(['quality', 'toxic', 'lang']) AS c, unnest([avg(CASE WHEN quality IS NULL THEN 1.0 ELSE 0 END),
  avg(CASE WHEN toxic IS NULL THEN 1.0 ELSE 0 END), avg(CASE WHEN lang IS NULL THEN 1.0 ELSE 0 END)]) AS x
 FROM documents LEFT JOIN labels USING (doc_id))""",
)
def quality_null_ratios(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    rows = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    out = Q.null_ratios(rows, ["quality", "toxic", "lang"])
    return out.select("column", r("null_ratio").alias("null_ratio"), "flagged")


@query(
    "O5",
    """SELECT CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS period, count(*) AS rows,
 CAST(quarter(any_value(o_orderdate)) = 4 AND count(*) < 560 AS INTEGER) AS flagged FROM orders GROUP BY 1""",
)
def quality_period_counts(spark, sf_dir):
    period = quarter_end(F.col("o_orderdate").cast("date"))
    return Q.period_counts(table(spark, sf_dir, "orders"), period, least=560, annual=F.quarter("period") == 4)


@query(
    "O6",
    f"""SELECT {rnd('min(s_acctbal)', 2)} AS low, {rnd('max(s_acctbal)', 2)} AS high, {rnd('avg(s_acctbal)', 4)} AS mean,
 count(*) FILTER (WHERE s_acctbal <= 0) AS not_positive FROM supplier""",
)
def quality_range(spark, sf_dir):
    out = Q.range_check(table(spark, sf_dir, "supplier"), "s_acctbal")
    return out.select(r("low", 2).alias("low"), r("high", 2).alias("high"), r("mean", 4).alias("mean"), "not_positive")


@query(
    "O8",
    """SELECT count(*) AS rows, CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last,
 CAST(count(*) = 0 AS INTEGER) AS empty FROM orders WHERE year(o_orderdate) = 1998""",
)
def quality_year_check(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    return Q.year_check(orders, "d", 1998)


@query(
    "O9",
    """SELECT 'orders' AS source, CAST(count(*) > 0 AS INTEGER) AS ready FROM orders UNION ALL
 SELECT 'future_orders', CAST(count(*) > 0 AS INTEGER) FROM orders WHERE o_orderdate > TIMESTAMP '2030-01-01' UNION ALL
 SELECT 'labels', CAST(count(*) > 0 AS INTEGER) FROM labels""",
)
def quality_readiness(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return Q.readiness(
        {
            "orders": orders,
            "future_orders": orders.where("o_orderdate > timestamp_ntz '2030-01-01 00:00:00'"),
            "labels": table(spark, sf_dir, "labels"),
        }
    )


@query(
    "O11",
    f"""SELECT r_name, {rnd('avg(CASE WHEN n IS NULL THEN 0.0 ELSE 1 END)')} AS joined_rate, CAST(count(n) = 0 AS INTEGER) AS all_empty
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
 LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) ON user_id = c_custkey GROUP BY 1""",
)
def quality_joined_rate(spark, sf_dir):
    users = table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("c_custkey")).agg(F.count("*").alias("n"))
    places = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        table(spark, sf_dir, "customer")
        .join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(users, "c_custkey", "left")
        .groupBy("r_name")
        .agg(r(F.avg(F.col("n").isNotNull().cast("double"))).alias("joined_rate"), (F.count("n") == 0).cast("int").alias("all_empty"))
    )


@query(
    "B1",
    """WITH p AS (SELECT count(*) FILTER (WHERE TRY_CAST(o_orderstatus AS DOUBLE) IS NULL) AS a,
 count(*) FILTER (WHERE TRY_CAST(CAST(o_totalprice AS VARCHAR) AS DOUBLE) IS NULL) AS b FROM orders)
SELECT unnest(range(1, 7)) AS position, unnest(['o_orderkey', 'cust_code', 'o_orderstatus', 'price_text', 'order_date', 'empty']) AS "column",
 unnest(['bigint', 'string', CASE WHEN a = 0 THEN 'double' ELSE 'string' END, CASE WHEN b = 0 THEN 'double' ELSE 'string' END,
 'date', 'double']) AS type FROM p""",
)
def schema_inference(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_custkey").cast("string").alias("cust_code"),
        "o_orderstatus",
        F.col("o_totalprice").cast("string").alias("price_text"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("order_date"),
        F.lit(None).cast("string").alias("empty"),
    )
    return S.infer_schema(orders).select(F.col("position").cast("long").alias("position"), "column", "type")


@query(
    "B3 B8 B6 I4",
    f"""SELECT o_orderkey AS order_id, NULL::DOUBLE AS weight, CAST(o_orderdate AS DATE) AS order_date, {rnd('o_totalprice', 2)} AS price FROM orders
 WHERE o_orderstatus = 'F' UNION ALL
 SELECT o_orderkey, {rnd('o_totalprice / 1000', 4)}, NULL, NULL FROM orders WHERE o_orderstatus <> 'F'""",
)
def schema_evolution(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    old = S.conform(
        orders.where("o_orderstatus = 'F'").select(
            F.col("o_orderkey").alias("order_id"), F.date_format("o_orderdate", "yyyyMMdd").alias("order_date"), r("o_totalprice", 2).alias("price")
        ),
        S.declared_schema({"order_id": "int", "order_date": "string", "price": "float"}),
    )
    new = orders.where("o_orderstatus <> 'F'").select(
        F.col("o_orderkey").cast("string").alias("order_id"), r(F.col("o_totalprice") / 1000, 4).alias("weight")
    )
    return S.evolve(old, new)


@query(
    "B2 B8",
    """SELECT unnest(['l_shipdate', 'l_comment', 'l_tax', 'ship_date']) AS "column",
 unnest(['type_mismatch', 'added', 'missing', 'added']) AS change, count(*) AS rows FROM lineitem""",
)
def schema_difference(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    declared = {f.name: f for f in lines.schema.fields if f.name not in ("l_tax",)}
    wanted = T.StructType(
        [T.StructField(n, T.DateType() if n == "l_shipdate" else f.dataType) for n, f in declared.items()]
        + S.declared_schema({"l_comment": "string", "ship_date": "string"}).fields
    )
    changes = S.schema_diff(lines.schema, wanted)
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("change")) for c, k, _, _ in changes])
    return lines.agg(F.count("*").alias("rows")).select(F.explode(items).alias("_c"), "rows").select("_c.*", "rows")
