"""Grouped statistics, limits, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelspark.functions.dates import month_start, parse_date, quarter_end
from panelspark.functions.numeric import compound, finite, guarded_ratio, ratio, safe_corr, to_number
from panelspark.operators import aggregates as A
from panelspark.operators import windows as W
from panelspark.operators.order_stats import group_quantiles
from panelspark.plans.registry import query
from panelspark.plans.shapes import FLOW_VOLS, bars, daily_bars, index_bars, r, rcols, rnd, sql_rcols, table, with_ctes
from panelspark.sources.sinks import staged

BY = "PARTITION BY entity ORDER BY period"
SQL_RET = f"""
 SELECT *, close / nullif(lag(close) OVER ({BY}), 0) - 1 AS ret, CAST(date_trunc('year', period) AS DATE) AS yr FROM bars"""


def returns(spark, sf_dir):
    w = W.by_time("entity", "period")
    return bars(spark, sf_dir).withColumns({"ret": W.change("close", w), "yr": F.trunc("period", "year")})


@query(
    "F2 F15",
    with_ctes(
        "bars",
        f"""SELECT grp, yr, {rnd('exp(sum(ln(1 + ret / 20))) - 1')} AS compounded,
 {rnd('stddev_samp(ret) * sqrt(12)')} AS yearly_vol FROM x GROUP BY 1, 2""",
        x=SQL_RET,
    ),
)
def agg_compounding(spark, sf_dir):
    return returns(spark, sf_dir).groupBy("grp", "yr").agg(
        r(compound(F.col("ret") / 20)).alias("compounded"),
        r(F.stddev_samp("ret") * F.lit(12.0**0.5)).alias("yearly_vol"),
    )


@query(
    "F3",
    with_ctes(
        "dbars",
        f"""SELECT entity, CAST(date_trunc('month', period) AS DATE) AS month, {rnd('arg_min(close, period)', 2)} AS close_first,
 {rnd('arg_max(close, period)', 2)} AS close_last FROM dbars GROUP BY 1, 2""",
    ),
)
def agg_first_last(spark, sf_dir):
    b = daily_bars(spark, sf_dir).withColumn("month", month_start("period"))
    return rcols(A.first_last(b, ["entity", "month"], "period", "close"), ["entity", "month"], ["close_first", "close_last"], 2)


@query(
    "F4 F9",
    """WITH g AS (SELECT l_returnflag AS flag, l_linestatus AS status, median(l_extendedprice) AS med,
 quantile_cont(l_extendedprice, [0.1, 0.25, 0.75, 0.9]) AS q FROM lineitem GROUP BY 1, 2)
SELECT flag, status, """
    + f"{rnd('med', 3)} AS med, {rnd('q[1]', 3)} AS p10, {rnd('q[4]', 3)} AS p90, {rnd('q[3] / q[2]')} AS dispersion FROM g",
)
def agg_exact_quantiles(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), F.col("l_extendedprice").alias("p")
    )
    q = group_quantiles(lines, ["flag", "status"], ["p"], [(1, 2), (1, 10), (9, 10), (3, 4), (1, 4)])
    return q.select(
        "flag", "status", r("p_q0", 3).alias("med"), r("p_q1", 3).alias("p10"), r("p_q2", 3).alias("p90"),
        r(ratio("p_q3", "p_q4")).alias("dispersion"),
    )


@query(
    "F5",
    with_ctes(
        "bars",
        f"""SELECT grp, period, up, down, {rnd('up / nullif(up + down, 0)')} AS profit_ratio,
 {rnd('up / nullif(down, 0)')} AS up_down_ratio FROM (SELECT grp, period, count(*) FILTER (WHERE ret > 0) AS up,
 count(*) FILTER (WHERE ret < 0) AS down FROM x GROUP BY 1, 2)""",
        x=SQL_RET,
    ),
)
def agg_breadth(spark, sf_dir):
    out = A.breadth(returns(spark, sf_dir), ["grp", "period"], "ret")
    return out.select("grp", "period", "up", "down", r("profit_ratio").alias("profit_ratio"), r("up_down_ratio").alias("up_down_ratio"))


@query(
    "F6",
    with_ctes(
        "bars",
        f"""SELECT period, CASE WHEN n >= 5 AND s > 0 THEN {rnd('2 * rs / (n * s) - (n + 1) / n')} END AS gini FROM (
 SELECT period, CAST(count(*) AS DOUBLE) AS n, sum(amount) AS s, sum(rn * amount) AS rs FROM (
  SELECT period, amount, row_number() OVER (PARTITION BY period ORDER BY amount) AS rn FROM bars) GROUP BY 1)""",
    ),
)
def agg_gini(spark, sf_dir):
    b = staged(bars(spark, sf_dir).select("period", "amount"), "bars")
    return rcols(A.gini(b, ["period"], "amount"), ["period"], ["gini"])


@query(
    "F7 L4",
    with_ctes(
        "bars",
        f"""SELECT a.grp, a.yr, CASE WHEN a.n >= 20 AND b.s > 0 THEN {rnd('a.v / (b.s * b.s)')} END AS avg_correlation FROM (
 SELECT grp, yr, var_samp(m) AS v, sum(c) AS n FROM (SELECT grp, yr, period, avg(ret) AS m, count(*) AS c FROM x
  WHERE ret IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2) a
 JOIN (SELECT grp, yr, avg(s) AS s FROM (SELECT grp, yr, entity, stddev_samp(ret) AS s FROM x WHERE ret IS NOT NULL
  GROUP BY 1, 2, 3) GROUP BY 1, 2) b ON a.grp = b.grp AND a.yr = b.yr""",
        x=SQL_RET,
    ),
)
def agg_average_correlation(spark, sf_dir):
    out = A.average_correlation(returns(spark, sf_dir), ["grp", "yr"], "entity", "period", "ret")
    return rcols(out, ["grp", "yr"], ["avg_correlation"])


SQL_MONTHLY = "SELECT grp, period, sum(amount) AS amount FROM bars GROUP BY 1, 2"


@query(
    "F8",
    with_ctes(
        "bars",
        f"""SELECT a.grp, a.period, CASE WHEN count(*) >= 3 THEN
 {rnd('sum(CASE WHEN b.amount < a.amount THEN 1.0 ELSE 0 END) / count(*)')} END AS pct FROM m a JOIN m b
 ON a.grp = b.grp AND b.period <= a.period AND b.period > a.period - INTERVAL 12 MONTH GROUP BY 1, 2""",
        m=SQL_MONTHLY,
    ),
)
def agg_share_below_current(spark, sf_dir):
    m = bars(spark, sf_dir).groupBy("grp", "period").agg(F.sum("amount").alias("amount"))
    return rcols(A.share_below_current(m, ["grp"], "period", "amount", 12, "pct", least=3), ["grp", "period"], ["pct"])


@query(
    "F11 F12",
    with_ctes(
        "ibars",
        f"""SELECT entity, month, CASE WHEN count(*) >= 10 AND count(*) FILTER (WHERE d < 0) >= 3
  AND count(*) FILTER (WHERE d > 0) >= 3 THEN {rnd('stddev_samp(d) FILTER (WHERE d < 0) / nullif(stddev_samp(d) FILTER (WHERE d > 0), 0)')} END
  AS downside, {rnd('avg(vol) / nullif(stddev_samp(vol), 0)')} AS stability,
 {rnd('avg(CASE WHEN d > 0 THEN 1.0 ELSE 0 END)')} AS up_days FROM (
 SELECT entity, vol, CAST(date_trunc('month', period) AS DATE) AS month, close / open - 1 AS d FROM ibars) GROUP BY 1, 2""",
    ),
)
def agg_downside_and_stability(spark, sf_dir):
    b = index_bars(spark, sf_dir).select(
        "entity", "vol", month_start("period").alias("month"), (ratio("close", "open") - 1).alias("d")
    )
    return b.groupBy("entity", "month").agg(
        r(A.downside_ratio("d")).alias("downside"),
        r(ratio(F.avg("vol"), F.stddev_samp("vol"))).alias("stability"),
        r(F.avg((F.col("d") > 0).cast("double"))).alias("up_days"),
    )


@query(
    "F17",
    f"""SELECT coalesce(l_returnflag, 'all') AS flag, coalesce(l_linestatus, 'all') AS status, count(*) AS n,
 {rnd('avg(l_extendedprice)', 4)} AS mean_price, {rnd('median(l_extendedprice)', 3)} AS median_price
 FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)""",
)
def agg_margins(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), F.col("l_extendedprice").alias("p")
    )
    means = A.margins(lines, "flag", "status", [F.count("*").alias("n"), r(F.avg("p"), 4).alias("mean_price")])
    means = means.select(F.coalesce("flag", F.lit("all")).alias("flag"), F.coalesce("status", F.lit("all")).alias("status"), "n", "mean_price")
    cells = lines.select(
        F.explode(F.array(F.col("flag"), F.lit("all"))).alias("flag"), "status", "p"
    ).select("flag", F.explode(F.array(F.col("status"), F.lit("all"))).alias("status"), "p")
    med = group_quantiles(cells, ["flag", "status"], ["p"], [(1, 2)])
    return means.join(med.select("flag", "status", r("p_q0", 3).alias("median_price")), ["flag", "status"])


@query(
    "F18",
    with_ctes(
        "ibars",
        f"""SELECT entity, year, {rnd('mean', 3)} AS mean, {rnd('lo', 2)} AS lo, {rnd('hi', 2)} AS hi, {rnd('last', 2)} AS last,
 CAST(mean = max(mean) OVER (PARTITION BY entity) AS INTEGER) AS is_best FROM (
 SELECT entity, year(period) AS year, avg(close) AS mean, min(close) AS lo, max(close) AS hi, arg_max(close, period) AS last
 FROM ibars GROUP BY 1, 2)""",
    ),
)
def agg_year_profile(spark, sf_dir):
    out = A.year_profile(index_bars(spark, sf_dir), "period", "close", ["entity"])
    shown = {"min": "lo", "max": "hi", "last": "last"}
    return out.select("entity", "year", r("mean", 3).alias("mean"), *[r(c, 2).alias(n) for c, n in shown.items()], "is_best")


@query(
    "F18",
    with_ctes(
        "ibars",
        f"""SELECT entity, year, {rnd('mean', 3)} AS mean, CAST(mean = max(mean) OVER w AS INTEGER) AS is_best, CAST(mean = min(mean) OVER w AS INTEGER) AS is_worst,
 CAST(year > max(year) OVER w - 3 AS INTEGER) AS is_recent FROM (SELECT entity, year(period) AS year, avg(vol) AS mean FROM ibars WHERE vol > 20 GROUP BY 1, 2)
 WINDOW w AS (PARTITION BY entity)
 UNION ALL SELECT NULL, year, {rnd('mean', 3)}, CAST(mean = max(mean) OVER () AS INTEGER), CAST(mean = min(mean) OVER () AS INTEGER), CAST(year > max(year) OVER () - 3 AS INTEGER)
 FROM (SELECT year(period) AS year, avg(vol) AS mean FROM ibars GROUP BY 1)""",
    ),
)
def agg_year_marks(spark, sf_dir):
    """Best, worst and last three years of each entity's larger volumes, and of all volumes."""
    b = index_bars(spark, sf_dir)
    columns = ["year", r("mean", 3).alias("mean"), "is_best", "is_worst", "is_recent"]
    each = A.year_profile(b.withColumn("large", F.when(F.col("vol") > 20, F.col("vol"))), "period", "large", ["entity"])
    whole = A.year_profile(b, "period", "vol").withColumn("entity", F.lit(None).cast(each.schema["entity"].dataType))
    return each.select("entity", *columns).unionByName(whole.select("entity", *columns))


@query(
    "F9",
    f"""SELECT l_suppkey, CASE WHEN count(*) >= 10 THEN {rnd('quantile_cont(l_extendedprice, 0.75) / nullif(quantile_cont(l_extendedprice, 0.25), 0)')} END AS dispersion
 FROM lineitem GROUP BY 1""",
)
def agg_quantile_dispersion(spark, sf_dir):
    """Upper over lower quartile of prices, where there are ten of them."""
    out = A.quantile_dispersion(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice", "dispersion")
    return out.select("l_suppkey", r("dispersion").alias("dispersion"))


@query(
    "F19",
    """SELECT count(*) AS n, CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last,
 count(DISTINCT o_orderdate) AS days FROM orders""",
)
def agg_table_profile(spark, sf_dir):
    daily = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(F.count("*").alias("c"))
    return daily.agg(F.sum("c").alias("n"), F.min("d").alias("first"), F.max("d").alias("last"), F.count("*").alias("days"))


@query(
    "F20 O4",
    with_ctes(
        "bars",
        f"SELECT yr, {rnd('avg(CASE WHEN ret IS NULL THEN 1.0 ELSE 0 END)')} AS ret, {rnd('avg(CASE WHEN vol IS NULL THEN 1.0 ELSE 0 END)')} AS vol FROM x GROUP BY 1",
        x=SQL_RET,
    ),
)
def agg_missing_rates(spark, sf_dir):
    return rcols(A.missing_rates(returns(spark, sf_dir), ["yr"], ["ret", "vol"]), ["yr"], ["ret", "vol"])


PROFILED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "F21",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, {rnd(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0 END)')} AS null_share,
 count(DISTINCT {c}) AS n_distinct, """
        + ", ".join(f"{rnd(f'quantile_cont({c}, {p})', 3)} AS {n}" for n, p in (("p1", 0.01), ("p25", 0.25), ("p50", 0.5), ("p75", 0.75), ("p99", 0.99)))
        + " FROM lineitem"
        for c in PROFILED
    ),
)
def agg_column_profile(spark, sf_dir):
    out = A.column_profile(table(spark, sf_dir, "lineitem").select(*PROFILED), PROFILED)
    return out.select("column", "rows", r("null_share").alias("null_share"), "n_distinct", *[r(c, 3).alias(c) for c in ("p1", "p25", "p50", "p75", "p99")])


@query(
    "F22",
    "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2",
)
def agg_value_counts(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query(
    "F23 O7",
    "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
)
def agg_duplicate_keys(spark, sf_dir):
    from panelspark.operators.quality import duplicate_keys

    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "F24",
    with_ctes(
        "bars",
        " UNION ALL ".join(
            f"SELECT '{a}' AS a, '{b}' AS b, {rnd(f'corr({a}, {b})')} AS corr FROM x"
            for a, b in (("ret", "vol"), ("ret", "amount"), ("vol", "amount"))
        ),
        x=SQL_RET,
    ),
)
def agg_correlation_matrix(spark, sf_dir):
    return rcols(A.correlation_matrix(returns(spark, sf_dir), ["ret", "vol", "amount"]), ["a", "b"], ["corr"])


@query(
    "F25",
    with_ctes(
        "ibars",
        "SELECT entity, year(period) AS year, "
        + ", ".join(f"{rnd(f'arg_max(close, period) FILTER (WHERE month(period) = {m})', 2)} AS m{m:02d}" for m in range(1, 13))
        + " FROM ibars GROUP BY 1, 2",
    ),
)
def agg_year_month_table(spark, sf_dir):
    out = A.year_month_table(index_bars(spark, sf_dir), "period", "close", ["entity"])
    return out.select("entity", "year", *[r(f"m{m:02d}", 2).alias(f"m{m:02d}") for m in range(1, 13)])


@query(
    "F26",
    with_ctes(
        "ibars",
        f"""SELECT entity, year(period) AS year, CAST(round_even(median(vol) FILTER (WHERE vol > 0), 0) AS BIGINT) AS year_median
 FROM ibars GROUP BY 1, 2""",
    ),
)
def agg_year_median(spark, sf_dir):
    b = index_bars(spark, sf_dir).where("vol > 0").select("entity", F.year("period").alias("year"), "vol")
    q = group_quantiles(staged(b, "vols"), ["entity", "year"], ["vol"], [(1, 2)])
    return q.select("entity", "year", F.bround("vol_q0", 0).cast("long").alias("year_median"))


@query("H1 H5", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_global(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
    )


@query("H2", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def sort_top_k(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query(
    "H3",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
 ORDER BY o_totalprice DESC, o_orderkey) AS rn FROM orders) WHERE rn <= 3""",
)
def sort_top_k_per_group(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return W.top_rows_per_key(rows, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 3)


@query(
    "I1 I2",
    f"""SELECT 'order' AS kind, CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 2
 UNION ALL SELECT 'ship', CAST(l_shipdate AS DATE), count(*) FROM lineitem GROUP BY 2
 UNION ALL SELECT 'event', CAST(ts AS DATE), count(*) FROM events GROUP BY 2""",
)
def set_union_tagged(spark, sf_dir):
    parts = [
        table(spark, sf_dir, t).groupBy(F.lit(kind).alias("kind"), F.col(c).cast("date").alias("d")).agg(F.count("*").alias("n"))
        for kind, t, c in (("order", "orders", "o_orderdate"), ("ship", "lineitem", "l_shipdate"), ("event", "events", "ts"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("I3", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def set_distinct(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority").distinct()


@query("I4", "SELECT DISTINCT l_orderkey FROM lineitem EXCEPT SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def set_key_difference(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").select("l_orderkey").distinct()
    finished = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return keys.join(finished, "l_orderkey", "left_anti")


@query(
    "J1 J2",
    """SELECT page_id, lower(left(url, 12)) AS head, CAST(contains(url, 'https') AS INTEGER) AS secure,
 replace(url, '://', '|') AS marked, nullif(trim(regexp_replace(regexp_replace(url, '^[a-z]+://', ''), '[/?#].*$', '')), '')
  AS host FROM pages""",
)
def scalar_text(spark, sf_dir):
    bare = F.regexp_replace(F.regexp_replace("url", "^[a-z]+://", ""), "[/?#].*$", "")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.lower(F.left("url", F.lit(12))).alias("head"),
        F.contains("url", F.lit("https")).cast("int").alias("secure"),
        F.replace("url", F.lit("://"), F.lit("|")).alias("marked"),
        F.nullif(F.trim(bare), F.lit("")).alias("host"),
    )


@query(
    "J3 J4 J5",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS ymd, year(o_orderdate) AS y, month(o_orderdate) AS m,
 week(o_orderdate) AS iso_week, isodow(o_orderdate) - 1 AS weekday, quarter(o_orderdate) AS q,
 CAST(CAST(o_orderdate AS DATE) + INTERVAL 40 DAY AS DATE) AS later, CAST(CAST(o_orderdate AS DATE) - INTERVAL 3 MONTH AS DATE) AS before,
 CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
 CAST(o_orderdate AS DATE) - DATE '1995-01-01' AS age FROM orders""",
)
def scalar_dates(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.date_format(d, "yyyyMMdd").alias("ymd"),
        F.year(d).cast("long").alias("y"),
        F.month(d).cast("long").alias("m"),
        F.weekofyear(d).cast("long").alias("iso_week"),
        F.weekday(d).cast("long").alias("weekday"),
        F.quarter(d).cast("long").alias("q"),
        F.date_add(d, 40).alias("later"),
        F.add_months(d, -3).alias("before"),
        quarter_end(d).alias("quarter_end"),
        F.datediff(d, F.lit("1995-01-01")).cast("long").alias("age"),
    )


@query(
    "J6 J7 J10 B5 B7",
    f"""SELECT l_orderkey, l_linenumber, l_extendedprice, {rnd('ln(l_quantity)')} AS a, {rnd('ln(1 + l_discount)')} AS b,
 {rnd('log10(l_extendedprice)')} AS c, {rnd('sqrt(l_quantity)')} AS d, {rnd('pow(l_quantity, 1.5)', 4)} AS e,
 {rnd('greatest(l_discount, l_tax)')} AS f, CASE WHEN abs(l_tax) > 0.01 THEN {rnd('l_discount / l_tax')} END AS g,
 {rnd('least(greatest(l_quantity, 10), 40)')} AS h, {rnd("TRY_CAST(CASE WHEN l_tax > 0.05 THEN 'n/a' ELSE CAST(l_tax AS VARCHAR) END AS DOUBLE)")} AS i,
 CASE WHEN l_discount > 0 THEN {rnd('l_quantity / l_discount', 4)} END AS j FROM lineitem""",
)
def scalar_math(spark, sf_dir):
    q, d, t = F.col("l_quantity"), F.col("l_discount"), F.col("l_tax")
    text = F.when(t > 0.05, "n/a").otherwise(t.cast("string"))
    infinite = F.when(d > 0, q / F.nullif(d, F.lit(0.0))).otherwise(F.lit(float("inf")))
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        r(F.log(q)).alias("a"),
        r(F.log1p(d)).alias("b"),
        r(F.log10("l_extendedprice")).alias("c"),
        r(F.sqrt(q)).alias("d"),
        r(F.pow(q, F.lit(1.5)), 4).alias("e"),
        r(F.greatest(d, t)).alias("f"),
        r(guarded_ratio(d, t, 0.01)).alias("g"),
        r(F.least(F.greatest(q, F.lit(10.0)), F.lit(40.0))).alias("h"),
        r(to_number(text)).alias("i"),
        r(finite(infinite), 4).alias("j"),
    )


@query(
    "B4 J3",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d FROM orders""",
)
def scalar_tolerant_dates(spark, sf_dir):
    d = F.col("o_orderdate").cast("date")
    text = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.date_format(d, "yyyyMMdd"))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.date_format(d, "yyyy"), F.lit("-99-99")))
        .otherwise(F.date_format(d, "yyyy-MM-dd"))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_date(text).alias("d"))


@query(
    "D1 D2 D5",
    with_ctes(
        "fbars",
        f"""SELECT entity, period, {rnd('ln(1 + ret / 20)')} AS log_return, {rnd('amount / vol', 3)} AS vwap,
 {rnd('(high - low) / pre')} AS amplitude, {rnd('greatest(high - low, abs(high - pre), abs(low - pre)) / pre')} AS true_range,
 {rnd('abs(close - open) / pre')} AS body, {rnd('(least(open, close) - low - high + greatest(open, close)) / pre')} AS shadow_diff,
 {rnd('(2 * close - high - low) / pre')} AS plus,
 {rnd('(buy_sm_vol - sell_sm_vol) / nullif(buy_sm_vol + sell_sm_vol, 0)')} AS sm_imba,
 {rnd('abs(ret) / (amount / 10000)')} AS illiq
 FROM (SELECT *, lag(close) OVER ({BY}) AS pre, close / lag(close) OVER ({BY}) - 1 AS ret FROM fbars) WHERE pre IS NOT NULL""",
    ),
)
def project_bar_features(spark, sf_dir):
    from panelspark.datasets.stock_factors import bar_features

    w = W.by_time("entity", "period")
    b = bars(spark, sf_dir, flow=True).withColumn("pre_close", F.lag("close").over(w)).where("pre_close is not null")
    b = b.withColumn("pct_chg", (ratio("close", "pre_close") - 1) * 100)
    out = bar_features(b).withColumns({"log_return": F.log1p(F.col("ret") / 20), "vwap": ratio("amount", "vol")})
    cols = ["log_return", "amplitude", "true_range", "body", "shadow_diff", "plus", "sm_imba", "illiq"]
    return out.select("entity", "period", r("vwap", 3).alias("vwap"), *[r(c).alias(c) for c in cols])


@query(
    "D3 D15",
    f"""SELECT o_orderkey, {rnd("CASE WHEN o_orderdate >= TIMESTAMP '1998-08-19' THEN o_totalprice / 10000 ELSE o_totalprice END", 4)}
 AS price FROM orders""",
)
def project_unit_break(spark, sf_dir):
    from panelspark.datasets.market_state import normalize_unit

    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"), "o_totalprice")
    return orders.select("o_orderkey", r(normalize_unit("o_totalprice", "d", "1998-08-19", 1e4), 4).alias("price"))


@query(
    "D8 D10",
    """SELECT l_suppkey, count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 WHERE date_diff('day', o_orderdate, l_shipdate) >= 30 AND coalesce(CASE WHEN l_returnflag = 'R' THEN 1 END, 0) = 0
 AND o_orderpriority <> '5-LOW' GROUP BY 1""",
)
def filter_eligibility(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_shipdate", "l_returnflag")
    orders = table(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW'").select("o_orderkey", "o_orderdate")
    flagged = F.when(F.col("l_returnflag") == "R", 1)
    return (
        lines.where(F.coalesce(flagged, F.lit(0)) == 0)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .where(F.datediff("l_shipdate", "o_orderdate") >= 30)
        .groupBy("l_suppkey")
        .agg(F.count("*").alias("n"))
    )


@query("D13", "SELECT p_partkey, p_type, p_size FROM part WHERE p_type = 'ECONOMY' AND p_brand IN ('Brand#2', 'Brand#17', 'Brand#3')")
def filter_keywords(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.where((F.col("p_type") == "ECONOMY") & F.col("p_brand").isin("Brand#2", "Brand#17", "Brand#3")).select(
        "p_partkey", "p_type", "p_size"
    )
