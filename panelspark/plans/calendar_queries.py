"""Trading-calendar queries on the calendar spanned by the ship days."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from panelspark.functions.dates import month_end, month_start
from panelspark.operators import calendar as C
from panelspark.plans.registry import query
from panelspark.plans.shapes import calendar, table, with_ctes

DAYS = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders"
ENDS = "SELECT min(cal_date) AS f, max(cal_date) AS l FROM cal WHERE is_open = 1"
POS = """SELECT d.d, f, l, (SELECT count(*) FROM open_days o WHERE o.cal_date <= d.d) AS i,
 (SELECT max(is_open) FROM cal WHERE cal_date = d.d) AS o FROM days d, ends"""
START, STOP = "1996-02-10", "1999-11-20"


def order_days(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()


@query(
    "C1",
    with_ctes(
        "cal",
        """SELECT d, CAST(coalesce(is_open, CAST(isodow(d) < 6 AS INTEGER)) AS INTEGER) AS is_trading
 FROM days LEFT JOIN cal ON d = cal_date""",
        days=DAYS,
    ),
)
def calendar_is_trading_day(spark, sf_dir):
    return C.is_trading_day(order_days(spark, sf_dir), calendar(spark, sf_dir)).select("d", "is_trading")


@query(
    "C2",
    with_ctes(
        "cal",
        f"""SELECT cal_date FROM cal WHERE is_open = 1 AND cal_date BETWEEN DATE '{START}' AND DATE '{STOP}'
 ORDER BY cal_date""",
    ),
)
def calendar_days_between(spark, sf_dir):
    from datetime import date

    return C.trading_days_between(calendar(spark, sf_dir), date.fromisoformat(START), date.fromisoformat(STOP))


@query(
    "C3",
    with_ctes(
        "cal",
        """SELECT d, CASE WHEN d < f THEN f WHEN d > l THEN l
  ELSE (SELECT max(cal_date) FROM cal WHERE is_open = 1 AND cal_date <= d) END AS backward,
 CASE WHEN d < f THEN f WHEN d > l THEN l
  ELSE (SELECT min(cal_date) FROM cal WHERE is_open = 1 AND cal_date >= d) END AS forward
 FROM days, ends""",
        days=DAYS,
        ends=ENDS,
    ),
)
def calendar_nearest_day(spark, sf_dir):
    cal = calendar(spark, sf_dir)
    out = C.nearest_trading_day(order_days(spark, sf_dir), cal, out="backward")
    return C.nearest_trading_day(out, cal, out="forward", backward=False).select("d", "backward", "forward")


@query(
    "C4 A3",
    with_ctes(
        "cal open_days",
        """SELECT d, CASE WHEN d < f THEN f WHEN d > l THEN l ELSE
  coalesce((SELECT cal_date FROM open_days o WHERE o.trade_idx = i - (CASE WHEN p.o = 1 THEN 20 ELSE 19 END)), f) END
  AS shifted FROM pos p""",
        days=DAYS,
        ends=ENDS,
        pos=POS,
    ),
)
def calendar_previous_n(spark, sf_dir):
    return C.shift_trading_days(order_days(spark, sf_dir), calendar(spark, sf_dir), -20).select("d", "shifted")


@query(
    "C5 A4",
    with_ctes(
        "cal open_days",
        """SELECT d, CASE WHEN d < f THEN f WHEN d > l THEN l ELSE
  coalesce((SELECT cal_date FROM open_days o WHERE o.trade_idx = i + 70), l) END AS shifted FROM pos p""",
        days=DAYS,
        ends=ENDS,
        pos=POS,
    ),
)
def calendar_next_n(spark, sf_dir):
    return C.shift_trading_days(order_days(spark, sf_dir), calendar(spark, sf_dir), 70).select("d", "shifted")


def _sql_last(unit):
    return with_ctes(
        "cal",
        f"""SELECT d, CASE WHEN d < f THEN f WHEN d > l THEN l ELSE
  coalesce((SELECT max(x) FROM (SELECT max(cal_date) AS x FROM cal WHERE is_open = 1
   GROUP BY date_trunc('{unit}', cal_date)) WHERE x <= d), l) END AS last_day FROM days, ends""",
        days=DAYS,
        ends=ENDS,
    )


@query("C6", _sql_last("week"))
def calendar_last_of_week(spark, sf_dir):
    return C.last_day_of_period(order_days(spark, sf_dir), calendar(spark, sf_dir), "week").select("d", "last_day")


@query("C7", _sql_last("month"))
def calendar_last_of_month(spark, sf_dir):
    return C.last_day_of_period(order_days(spark, sf_dir), calendar(spark, sf_dir), "month").select("d", "last_day")


@query(
    "C8",
    with_ctes(
        "cal",
        """SELECT CAST(date_trunc('month', cal_date) AS DATE) AS grain_start, max(cal_date) AS last_day
 FROM cal WHERE is_open = 1 GROUP BY 1""",
    ),
)
def calendar_month_ends(spark, sf_dir):
    return C.period_last_days(calendar(spark, sf_dir), "month")


@query(
    "C9",
    """WITH days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders),
q AS (SELECT DISTINCT CAST(date_trunc('quarter', x) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS e
 FROM (SELECT unnest(generate_series(min(d) - INTERVAL 3 YEAR, max(d), INTERVAL 1 MONTH)) AS x FROM days))
SELECT d, e AS quarter_end FROM (SELECT d, e, row_number() OVER (PARTITION BY d ORDER BY e DESC) AS rn
 FROM days JOIN q ON e <= d) WHERE rn <= 4""",
)
def calendar_recent_quarter_ends(spark, sf_dir):
    return order_days(spark, sf_dir).select(
        "d", F.explode(C.recent_quarter_ends(F.col("d"), 4)).alias("quarter_end")
    )


@query(
    "C10",
    """SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, last_day(o_orderdate) AS month_end,
 count(*) AS n FROM orders GROUP BY 1, 2""",
)
def calendar_month_bounds(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").groupBy(
        month_start(d).alias("month_start"), month_end(d).alias("month_end")
    ).agg(F.count("*").alias("n"))


def _sql_expected():
    span = f"cal_date BETWEEN DATE '{START}' AND DATE '{STOP}' AND is_open = 1"
    return with_ctes(
        "cal",
        f"""SELECT 'trade_day' AS grain, cal_date AS biz_date FROM cal WHERE {span}
 UNION ALL SELECT 'week_end', max(cal_date) FROM cal WHERE {span} GROUP BY date_trunc('week', cal_date)
 UNION ALL SELECT 'month_end', max(cal_date) FROM cal WHERE {span} GROUP BY date_trunc('month', cal_date)
 UNION ALL SELECT 'quarter_end', x FROM (SELECT DISTINCT
   CAST(date_trunc('quarter', cal_date) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS x FROM cal)
  WHERE x BETWEEN DATE '{START}' AND DATE '{STOP}'""",
    )


@query("C11 A15", _sql_expected())
def calendar_expected_dates(spark, sf_dir):
    cal = calendar(spark, sf_dir)
    parts = [
        C.expected_dates(cal, g, START, STOP).select(F.lit(g).alias("grain"), "biz_date")
        for g in ("trade_day", "week_end", "month_end", "quarter_end")
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query(
    "C12",
    with_ctes(
        "open_days",
        """SELECT cal_date, CAST(coalesce(weekofyear(cal_date) <> weekofyear(lag(cal_date) OVER (ORDER BY cal_date)),
  true) AS INTEGER) AS weekly,
 CAST(coalesce(month(cal_date) <> month(lag(cal_date) OVER (ORDER BY cal_date)), true) AS INTEGER) AS monthly
 FROM open_days""",
    ),
)
def calendar_rebalance_days(spark, sf_dir):
    cal = calendar(spark, sf_dir)
    week = C.rebalance_days(cal, "W").withColumnRenamed("is_rebalance", "weekly")
    month = C.rebalance_days(cal, "M").withColumnRenamed("is_rebalance", "monthly")
    return week.join(F.broadcast(month), "cal_date")


@query(
    "C13",
    with_ctes(
        "cal",
        f"""SELECT CAST(date_trunc('month', cal_date) AS DATE) AS grain_start, max(cal_date) AS last_day
 FROM cal WHERE is_open = 1 AND cal_date BETWEEN DATE '{START}' AND DATE '{STOP}' GROUP BY 1""",
    ),
)
def calendar_month_to_date_ends(spark, sf_dir):
    return C.period_last_days(calendar(spark, sf_dir).where(F.col("cal_date").between(START, STOP)), "month")


@query(
    "C14",
    """SELECT month, lag(month, 3) OVER (ORDER BY month) AS earlier FROM
 (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders)""",
)
def calendar_earlier_month(spark, sf_dir):
    months = table(spark, sf_dir, "orders").select(month_start(F.col("o_orderdate").cast("date")).alias("month"))
    return C.earlier_month(months.distinct(), 3)
