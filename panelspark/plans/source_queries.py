"""Scan, landing and sink queries. Sinks write to a new scratch folder and read back what a user would see."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.dates import revision_start
from panelspark.operators import windows as W
from panelspark.operators.calendar import period_last_days
from panelspark.operators.schema import DatasetSpec
from panelspark.plans.registry import query
from panelspark.plans.shapes import bars, calendar, daily_bars, index_bars, r, rcols, rnd, table, with_ctes
from panelspark.sources import landing as L
from panelspark.sources import readers as R
from panelspark.sources import sinks as K
from panelspark.sources.contract import ContractViolation, write_dataset

START, STOP = date(1997, 3, 10), date(1999, 8, 20)
BETWEEN = f"BETWEEN DATE '{START}' AND DATE '{STOP}'"
BY = "PARTITION BY entity ORDER BY period"


@query(
    "A1 A2",
    f"SELECT l_orderkey, l_suppkey, CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_shipdate >= TIMESTAMP '{START} 00:00:00' AND l_shipdate <= TIMESTAMP '{STOP} 00:00:00'",
)
def scan_date_range(spark, sf_dir):
    lo, hi = (F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in (START, STOP))
    lines = table(spark, sf_dir, "lineitem")
    out = lines.where((F.col("l_shipdate") >= lo) & (F.col("l_shipdate") <= hi))
    return out.select("l_orderkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("d"))


@query(
    "A3 D15",
    with_ctes(
        "ibars",
        f"""SELECT entity, period, ma20 FROM (SELECT entity, period, {rnd(f'avg(close) OVER ({BY} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)', 3)}
 AS ma20 FROM ibars) WHERE period {BETWEEN}""",
    ),
)
def scan_look_back(spark, sf_dir):
    """Windows are warmed by 60 open days before the range and trimmed afterwards."""
    cal = calendar(spark, sf_dir)
    rows = R.look_back_range(spark, index_bars(spark, sf_dir), cal, "period", START, STOP, 60)
    w = W.trailing(W.by_time("entity", "period"), 20)
    return rows.select("entity", "period", r(F.avg("close").over(w), 3).alias("ma20")).where(F.col("period").between(START, STOP))


@query(
    "A4",
    with_ctes(
        "ibars",
        f"""SELECT entity, period, ahead FROM (SELECT entity, period, {rnd(f'lead(close, 20) OVER ({BY})', 2)} AS ahead FROM ibars)
 WHERE period {BETWEEN}""",
    ),
)
def scan_look_ahead(spark, sf_dir):
    cal = calendar(spark, sf_dir)
    rows = R.look_ahead_range(spark, index_bars(spark, sf_dir), cal, "period", START, STOP, 70)
    out = rows.select("entity", "period", r(F.lead("close", 20).over(W.by_time("entity", "period")), 2).alias("ahead"))
    return out.where(F.col("period").between(START, STOP))


@query(
    "A5",
    f"""SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders
 WHERE CAST(o_orderdate AS DATE) BETWEEN CAST(DATE '{START}' - INTERVAL 40 DAY - INTERVAL 12 MONTH AS DATE) AND DATE '{STOP}' GROUP BY 1""",
)
def scan_calendar_buffer(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    return R.buffered_range(orders, "d", START, STOP, days=40, months=12).groupBy("d").agg(F.count("*").alias("n"))


@query(
    "A6",
    with_ctes(
        "dbars cal",
        f"""SELECT entity, period, {rnd('close', 2)} AS close FROM dbars WHERE period IN (
 SELECT max(cal_date) FROM cal WHERE is_open = 1 GROUP BY date_trunc('month', cal_date))""",
    ),
)
def scan_month_ends(spark, sf_dir):
    ends = period_last_days(calendar(spark, sf_dir), "month")
    out = R.on_dates(daily_bars(spark, sf_dir), "period", ends, "last_day")
    return out.select("entity", "period", r("close", 2).alias("close"))


def monthly_orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"), r("o_totalprice", 2).alias("price"),
        F.date_format("o_orderdate", "yyyy-MM").alias("month"),
    )


OLD = f"SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, {rnd('o_totalprice', 2)} AS price, strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus AS st FROM orders"


@query(
    "A7",
    f"""WITH o AS ({OLD}) SELECT o_orderkey, o_custkey, d, price, month FROM o WHERE month < '1999-01'
 UNION ALL SELECT o_orderkey, o_custkey, d, {rnd('price * 2', 2)}, month FROM o WHERE month >= '1999-01' AND price > 100000""",
)
def sink_overwrite_partitions(spark, sf_dir):
    """Full load, then the months from 1999 on are replaced; running the second batch twice changes nothing."""
    path = K.scratch_path(spark, "orders")
    o = monthly_orders(spark, sf_dir)
    K.overwrite_partitions(o, path, ["month"])
    batch = o.where("month >= '1999-01' and price > 100000").withColumn("price", r(F.col("price") * 2, 2))
    for _ in range(2):
        K.overwrite_partitions(batch, path, ["month"])
    return spark.read.parquet(path).withColumn("month", F.date_format("d", "yyyy-MM")).select(*o.columns)


@query(
    "A8 A9 A20",
    f"""WITH o AS ({OLD}) SELECT o_orderkey, price FROM o WHERE st = 'F' UNION ALL SELECT o_orderkey, price FROM o WHERE st = 'O'""",
)
def sink_truncate_and_append(spark, sf_dir):
    path = K.scratch_path(spark, "refresh")
    o = table(spark, sf_dir, "orders").select("o_orderkey", r("o_totalprice", 2).alias("price"), "o_orderstatus")
    K.truncate_write(o.where("o_orderstatus = 'P'").drop("o_orderstatus"), path)
    K.empty_table(spark, path)
    K.truncate_write(o.where("o_orderstatus = 'F'").drop("o_orderstatus"), path)
    K.append(o.where("o_orderstatus = 'O'").drop("o_orderstatus"), path)
    return spark.read.parquet(path)


@query(
    "A10",
    f"""WITH o AS ({OLD}) SELECT o_orderkey, CASE WHEN st = 'F' THEN {rnd('price + 1', 2)} ELSE price END AS price, month FROM o
 WHERE NOT (st = 'P' AND month >= '2000-01')""",
)
def sink_upsert(spark, sf_dir):
    """Stored rows, then newer versions of some keys together with keys not seen before."""
    path = K.scratch_path(spark, "upsert")
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", r("o_totalprice", 2).alias("price"), F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderstatus"
    )
    o = o.where("not (o_orderstatus = 'P' and month >= '2000-01')")
    first = o.where("o_orderstatus <> 'O'").drop("o_orderstatus")
    second = o.where("o_orderstatus in ('F', 'O')").withColumn(
        "price", F.when(F.col("o_orderstatus") == "F", r(F.col("price") + 1, 2)).otherwise(F.col("price"))
    )
    K.upsert(first, path, ["o_orderkey"], ["month"])
    K.upsert(second.drop("o_orderstatus"), path, ["o_orderkey"], ["month"])
    return spark.read.parquet(path).select("o_orderkey", "price", F.col("month").cast("string").alias("month"))


@query(
    "A11",
    f"""SELECT l_orderkey, l_linenumber, {rnd('l_tax', 2)} AS flag, {rnd('l_extendedprice', 2)} AS price FROM (
 SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_tax DESC, l_extendedprice DESC, l_partkey DESC) AS rn
 FROM lineitem) WHERE rn = 1""",
)
def sink_dedupe_by_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_tax").cast("string").alias("update_flag"), "l_extendedprice", "l_partkey"
    )
    out = K.dedupe_by_key(lines, ["l_orderkey", "l_linenumber"], order=[F.desc("l_extendedprice"), F.desc("l_partkey")])
    return out.select(
        "l_orderkey", "l_linenumber", r(F.col("update_flag").cast("double"), 2).alias("flag"), r("l_extendedprice", 2).alias("price")
    )


@query(
    "A12",
    f"""WITH o AS ({OLD}) SELECT o_orderkey, d, price FROM o""",
)
def sink_watermark_increment(spark, sf_dir):
    """First run up to a day, second run from the stored date on, done twice as after a failure before its mark was kept.

    Increments are upserts, so a repeated one leaves every row once.
    """
    path, state = K.scratch_path(spark, "increment"), K.scratch_path(spark, "state")
    o = monthly_orders(spark, sf_dir)
    first = o.where(F.col("d") <= F.lit(STOP))
    K.upsert(first, path, ["o_orderkey", "month"], ["month"])
    K.write_watermark(first, state, "orders", "d")
    start = K.increment_start(K.read_watermark(spark, state, "orders"), STOP)
    rest = R.date_range(o, "d", start)
    for _ in range(2):
        K.upsert(rest, path, ["o_orderkey", "month"], ["month"])
    K.write_watermark(rest, state, "orders", "d")
    return spark.read.parquet(path).select("o_orderkey", "d", "price")


@query(
    "A13",
    """SELECT o_custkey, least(max(CAST(o_orderdate AS DATE)), DATE '2001-08-01' - 365) AS by_days,
 least(max(CAST(o_orderdate AS DATE)), CAST(date_trunc('quarter', DATE '2001-08-01') - INTERVAL 12 MONTH AS DATE)) AS by_periods
 FROM orders GROUP BY 1""",
)
def scan_revision_window(spark, sf_dir):
    marks = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.max(F.col("o_orderdate").cast("date")).alias("mark"))
    today = F.lit(date(2001, 8, 1))
    return marks.select(
        "o_custkey",
        revision_start("mark", today, days=365).alias("by_days"),
        revision_start("mark", today, quarters=4).alias("by_periods"),
    )


@query(
    "A14",
    """WITH x AS (SELECT o_custkey, CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT o_custkey, d, n FROM x WHERE d IN (SELECT max(d) FROM x GROUP BY date_trunc('month', d))""",
)
def sink_month_replace(spark, sf_dir):
    """Month-to-date rows of the middle of a month are replaced when the month ends."""
    path = K.scratch_path(spark, "months")
    x = table(spark, sf_dir, "orders").groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("d")).agg(F.count("*").alias("n"))
    K.month_replace(x.where(F.dayofmonth("d") <= 15), path, "d")
    K.month_replace(x, path, "d")
    return spark.read.parquet(path).select("o_custkey", "d", "n")


@query(
    "A16 B6",
    f"""SELECT l_orderkey, l_linenumber, {rnd('max(l_extendedprice)', 2)} AS price, max(CAST(l_shipdate AS DATE)) AS ship_date FROM (
 SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC) AS rn FROM lineitem)
 WHERE rn = 1 GROUP BY 1, 2""",
)
def land_text_files(spark, sf_dir):
    """Text files with dates in yyyyMMdd are typed, deduplicated and written by month."""
    raw, target = K.scratch_path(spark, "raw"), K.scratch_path(spark, "landed")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.date_format("l_shipdate", "yyyyMMdd").alias("ship_date"), "l_extendedprice"
    )
    K.write_csv(lines, raw)
    schema = T.StructType(
        [
            T.StructField("l_orderkey", T.LongType()),
            T.StructField("l_linenumber", T.IntegerType()),
            T.StructField("ship_date", T.DateType()),
            T.StructField("l_extendedprice", T.DoubleType()),
        ]
    )
    # one version per key: the latest ship date, then the higher price
    R.land(spark, raw, target, schema, keys=["l_orderkey", "l_linenumber"], partition="ship_date")
    return spark.read.parquet(target).select("l_orderkey", "l_linenumber", r("l_extendedprice", 2).alias("price"), "ship_date")


@query(
    "A17",
    """SELECT DISTINCT l_suppkey, CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE (l_suppkey, CAST(l_shipdate AS DATE)) IN (
 SELECT (l_suppkey, max(CAST(l_shipdate AS DATE))) FROM lineitem GROUP BY l_suppkey, date_trunc('month', l_shipdate))""",
)
def scan_last_slice_of_month(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_shipdate").cast("date").alias("d")).distinct()
    return K.last_slice_of_month(lines, "d", ["l_suppkey"]).select("l_suppkey", "d")


@query("A18", f"SELECT s_suppkey, s_name, {rnd('s_acctbal', 2)} AS s_acctbal FROM supplier")
def sink_csv(spark, sf_dir):
    path = K.scratch_path(spark, "csv")
    K.write_csv(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", r("s_acctbal", 2).alias("s_acctbal")), path)
    return spark.read.schema("s_suppkey bigint, s_name string, s_acctbal double").csv(path, header=True)


@query(
    "A20",
    """SELECT unnest(range(1, 7)) AS position, unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate', 'o_orderpriority'])
 AS "column", unnest(['bigint', 'bigint', 'string', 'double', 'timestamp_ntz', 'string']) AS type, count(*) AS row_count FROM orders""",
)
def scan_table_info(spark, sf_dir):
    out = K.table_info(table(spark, sf_dir, "orders"))
    return out.select(F.col("position").cast("long").alias("position"), "column", "type", "row_count")


_DAY_KEYS = f"""SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, count(*) AS n, {rnd('max(l_extendedprice)', 2)} AS price FROM lineitem GROUP BY 1, 2"""


@query(
    "A11 H5",
    f"""WITH g AS (SELECT *, substr(md5('{{"l_suppkey":' || l_suppkey || ',"d":"' || d || '"}}'), 1, 1) AS c FROM ({_DAY_KEYS})),
 ends AS (SELECT c, unnest([min((l_suppkey, d)), max((l_suppkey, d))]) AS k FROM g WHERE n > 1 GROUP BY c),
 sample AS (SELECT k, row_number() OVER (ORDER BY k) AS i FROM (SELECT DISTINCT k FROM ends))
SELECT 'rows_in' AS name, NULL::BIGINT AS l_suppkey, NULL::VARCHAR AS d, CAST(sum(n) AS BIGINT) AS n FROM g
UNION ALL SELECT 'rows_out', NULL, NULL, count(*) FROM g
UNION ALL SELECT 'repeated_rows', NULL, NULL, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) FROM g
UNION ALL SELECT 'repeated_keys', NULL, NULL, count(*) FILTER (WHERE n > 1) FROM g
UNION ALL SELECT 'sample', k[1], CAST(k[2] AS VARCHAR), i FROM sample WHERE i <= 20""",
)
def sink_duplicate_report(spark, sf_dir):
    """What a write with keys reports of repeated ones, measured while it runs: counts and twenty keys."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_shipdate").cast("date").alias("d"), "l_extendedprice")
    report = K.truncate_write(lines, K.scratch_path(spark, "reported"), keys=["l_suppkey", "d"])
    counts = [(n, None, None, getattr(report, n)) for n in ("rows_in", "rows_out", "repeated_rows", "repeated_keys")]
    sample = [("sample", k["l_suppkey"], k["d"], i) for i, k in enumerate(report.sample, 1)]
    return spark.createDataFrame(counts + sample, "name string, l_suppkey bigint, d string, n bigint")


@query(
    "A16 I2",
    f"""WITH s AS (SELECT s_suppkey, s_suppkey % 29 = 0 AS no_key, s_suppkey % 17 = 0 AS no_date, DATE '1990-01-01' + CAST(s_suppkey AS INTEGER) AS listed,
  {rnd('s_acctbal', 2)} AS weight, f.part FROM supplier JOIN (VALUES ('L'), ('D')) f(part)
  ON (s_acctbal >= 4000 AND f.part = 'L') OR (s_acctbal < 4000 AND f.part = 'D') OR (s_suppkey % 10 = 0)),
 b AS ({_DAY_KEYS}), bad AS (SELECT *, l_suppkey % 13 = 0 AND day(d) = 1 AS no_number FROM b),
 kept AS (SELECT l_suppkey, d, price, FALSE AS again FROM bad WHERE NOT no_number
  UNION ALL SELECT l_suppkey, d, {rnd('price + 1', 2)}, TRUE FROM bad WHERE NOT no_number AND d >= DATE '1999-01-01' AND l_suppkey % 2 = 0)
SELECT 'stock_basic' AS dataset, 'rows_read' AS name, count(*) AS n, NULL::DOUBLE AS total FROM s
UNION ALL SELECT 'stock_basic', 'rejected', count(*) FILTER (WHERE no_key OR no_date), NULL FROM s
UNION ALL SELECT 'stock_basic', 'no key: ts_code', count(*) FILTER (WHERE no_key), NULL FROM s
UNION ALL SELECT 'stock_basic', 'no date: list_date', count(*) FILTER (WHERE no_date), NULL FROM s
UNION ALL SELECT 'stock_basic', 'repeated_keys', count(*), NULL FROM (SELECT s_suppkey FROM s WHERE NOT (no_key OR no_date) GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'stock_basic', 'stored', count(*), {rnd('sum(weight)', 2)} FROM (SELECT s_suppkey, max(weight) AS weight FROM s WHERE NOT (no_key OR no_date) GROUP BY 1)
UNION ALL SELECT 'stock_daily', 'rows_read', count(*) FILTER (WHERE d >= DATE '1999-01-01' AND l_suppkey % 2 = 0), NULL FROM bad
UNION ALL SELECT 'stock_daily', 'rejected', count(*) FILTER (WHERE d >= DATE '1999-01-01' AND l_suppkey % 2 = 0 AND no_number), NULL FROM bad
UNION ALL SELECT 'stock_daily', 'no double: close', count(*) FILTER (WHERE d >= DATE '1999-01-01' AND l_suppkey % 2 = 0 AND no_number), NULL FROM bad
UNION ALL SELECT 'stock_daily', 'repeated_keys', 0, NULL
UNION ALL SELECT 'stock_daily', 'stored', count(*), {rnd('sum(price)', 2)} FROM kept k WHERE again
  OR d NOT IN (SELECT d FROM kept WHERE again)
  """,
)
def land_catalogue(spark, sf_dir):
    """Two datasets of the catalogue from text files: a union of two fetches, and a daily one whose dates from 1999 on come again.

    Of both the rows read, the rejects by reason, the repeated keys and what is stored in the end.
    """
    root = K.scratch_path(spark, "catalogue")

    def file(rows):
        path = K.scratch_path(spark, "fetch")
        K.write_csv(rows, path)
        return path

    key = F.col("s_suppkey")
    listed = F.when(key % 17 == 0, "1990-13-01").otherwise(F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), key.cast("int")), "yyyyMMdd"))
    basic = table(spark, sf_dir, "supplier").select(
        F.when(key % 29 != 0, key.cast("string")).alias("ts_code"), "s_name", listed.alias("list_date"), r("s_acctbal", 2).alias("weight"), "s_acctbal", key
    )
    both = key % 10 == 0
    fetches = {n: file(basic.where(c | both).select("ts_code", "s_name", "list_date", "weight")) for n, c in (("L", F.col("s_acctbal") >= 4000), ("D", F.col("s_acctbal") < 4000))}
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_shipdate").cast("date").alias("d"), "l_extendedprice")
    days = lines.groupBy("l_suppkey", "d").agg(r(F.max("l_extendedprice"), 2).alias("price"))
    shown = lambda c: F.when((F.col("l_suppkey") % 13 == 0) & (F.dayofmonth("d") == 1), "n/a").otherwise(c.cast("string")).alias("close")
    daily = lambda df, c: file(df.select(F.col("l_suppkey").alias("ts_code"), F.date_format("d", "yyyyMMdd").alias("trade_date"), shown(c)))
    late = (F.col("d") >= F.lit("1999-01-01").cast("date")) & (F.col("l_suppkey") % 2 == 0)
    schemas = {
        "stock_basic": R.landing_schema(["ts_code", "s_name", "list_date", "weight"], numbers=["weight"]),
        "stock_daily": R.landing_schema(["ts_code", "trade_date", "close"], numbers=["close"]),
    }
    L.land_dataset(spark, "stock_daily", {"all": daily(days, F.col("price"))}, root, schemas["stock_daily"])
    files = {"stock_basic": fetches, "stock_daily": {"late": daily(days.where(late), r(F.col("price") + 1, 2))}}
    counts, parts = [], []
    for report in L.land_catalogue(spark, files, root, schemas):
        found = {"rows_read": report.rows_read, "rejected": report.rejected, "repeated_keys": report.written.repeated_keys} | report.reasons
        counts += [(report.dataset, name, n, None) for name, n in found.items()]
        value = {"stock_basic": "weight", "stock_daily": "close"}[report.dataset]
        stored = spark.read.parquet(f"{root}/{report.dataset}").agg(F.count("*").alias("n"), r(F.sum(value), 2).alias("total"))
        parts.append(stored.select(F.lit(report.dataset).alias("dataset"), F.lit("stored").alias("name"), "n", "total"))
    return spark.createDataFrame(counts, "dataset string, name string, n bigint, total double").unionByName(parts[0]).unionByName(parts[1])


@query(
    "L1 B8",
    """WITH o AS (SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1, 2)
SELECT 'NULL in entity' AS rule, count(*) FILTER (WHERE o_custkey % 50 = 0) AS n FROM orders
UNION ALL SELECT 'month does not follow from day', count(*) FILTER (WHERE day(o_orderdate) = 31) FROM orders
UNION ALL SELECT 'repeated keys', count(*) FILTER (WHERE n > 1) FROM (SELECT CASE WHEN entity % 50 <> 0 THEN entity END AS entity, day, sum(n) AS n FROM o GROUP BY 1, 2)
UNION ALL SELECT 'undeclared column priority', 1
UNION ALL SELECT 'stored', count(*) FROM (SELECT DISTINCT CASE WHEN entity % 50 <> 0 THEN entity END, day FROM o)
UNION ALL SELECT 'refused', 0""",
)
def dataset_contract(spark, sf_dir):
    """What a write by contract finds in orders that break it; the same rows are refused by a strict write."""
    spec = DatasetSpec("orders", ("entity", "day"), "day", "month", {"entity": "int", "day": "date", "price": "double", "month": "string"}, "yyyy-MM")
    day = F.col("o_orderdate").cast("date")
    month = F.date_format(F.when(F.dayofmonth(day) == 31, F.date_add(day, 1)).otherwise(day), "yyyy-MM")
    orders = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_custkey") % 50 != 0, F.col("o_custkey")).cast("bigint").alias("entity"), day.alias("day"),
        F.col("o_totalprice").alias("price"), month.alias("month"), F.col("o_orderpriority").alias("priority"),
    )
    path, strict = K.scratch_path(spark, "contract"), K.scratch_path(spark, "contract")
    found = write_dataset(orders, path, spec, strict=False).violations
    try:
        write_dataset(orders.drop("priority"), strict, spec)
    except ContractViolation:
        refused = int(K.table_exists(spark, strict))
    counts = spark.createDataFrame([*found.items(), ("refused", refused)], "rule string, n bigint")
    return counts.unionByName(spark.read.parquet(path).agg(F.count("*").alias("n")).select(F.lit("stored").alias("rule"), "n"))
