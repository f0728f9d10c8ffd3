"""Composite datasets on shapes derived from the supplied tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelspark.datasets import entity_panel as EP
from panelspark.datasets import index_factors as IX
from panelspark.datasets import market_signals as MS
from panelspark.datasets import market_state as ST
from panelspark.datasets import statements as FS
from panelspark.datasets import stock_factors as SF
from panelspark.datasets.fund_panel import fund_panel
from panelspark.datasets.fund_rules import LABELS
from panelspark.datasets.labels import HORIZONS, forward_labels
from panelspark.datasets.valuation import NON_NEGATIVE, SIGNED, valuation_history
from panelspark.functions.dates import month_start
from panelspark.functions.numeric import ratio
from panelspark.operators import windows as W
from panelspark.operators.cross_section import as_is
from panelspark.plans.registry import query
from panelspark.plans.shapes import (
    bars,
    daily_bars,
    index_bars,
    r,
    rcols,
    rnd,
    sql_rcols,
    supplier_region,
    table,
    with_ctes,
)
from panelspark.plans.window_queries import _sql_slices, over
from panelspark.sources.sinks import staged

BY = "PARTITION BY entity ORDER BY period"


# ---- index factors (Q1-Q4) -------------------------------------------------------------------


@query(
    "Q1",
    with_ctes(
        "ibars",
        f"""SELECT entity, period, {sql_rcols([], ['ret_1', 'ret_20', 'std_20'])}, {rnd('ret_20 / nullif(std_20, 0)')} AS ret_vol_ratio FROM (
 SELECT *, CASE WHEN count(ret_1) {over(20)} = 20 THEN stddev_samp(ret_1) {over(20)} * sqrt(252) END AS std_20 FROM (
 SELECT entity, period, ln(close / lag(close) OVER ({BY})) AS ret_1, ln(close / lag(close, 20) OVER ({BY})) AS ret_20 FROM ibars))""",
    ),
)
def dataset_return_volatility(spark, sf_dir):
    out = IX.return_volatility(index_bars(spark, sf_dir))
    return rcols(out, ["entity", "period"], ["ret_1", "ret_20", "std_20", "ret_vol_ratio"])


SQL_YX = {
    "y": f"SELECT entity, period, ln(close / lag(close) OVER ({BY})) AS y FROM ibars",
    "yx": "SELECT a.*, b.y AS x FROM y a LEFT JOIN (SELECT period, y FROM y WHERE entity = 0) b USING (period)",
}


@query(
    "Q2",
    with_ctes(
        "ibars",
        f"""SELECT entity, period, {sql_rcols([], ['beta_up', 'beta_down', 'r2'], 5)}, {rnd(f'beta_down - lag(beta_down, 20) OVER ({BY})', 5)}
 AS beta_down_change FROM (SELECT entity, period,
 CASE WHEN n = 60 AND count(CASE WHEN x > 0 THEN 1 END) {over(60)} >= 10 THEN regr_slope(y, CASE WHEN x > 0 THEN x END) {over(60)} END AS beta_up,
 CASE WHEN n = 60 AND count(CASE WHEN x < 0 THEN 1 END) {over(60)} >= 10 THEN regr_slope(y, CASE WHEN x < 0 THEN x END) {over(60)} END AS beta_down,
 CASE WHEN n = 60 THEN regr_r2(y, x) {over(60)} END AS r2 FROM (
 SELECT *, count(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 1 END) {over(60)} AS n FROM yx))""",
        **SQL_YX,
    ),
)
def dataset_asymmetric_beta(spark, sf_dir):
    b = index_bars(spark, sf_dir)
    out = IX.asymmetric_beta(b, b.where("entity = 0").select("period", "close"))
    return rcols(out, ["entity", "period"], ["beta_up", "beta_down", "r2", "beta_down_change"], 5)


@query(
    "Q3",
    with_ctes(
        "ibars",
        f"""SELECT entity, period, {sql_rcols([], ['beta', 'alpha', 'cum_excess'], 5)},
 CASE WHEN count(cum_excess) OVER (PARTITION BY period) > 2 THEN
 {rnd('(cum_excess - avg(cum_excess) OVER (PARTITION BY period)) / nullif(stddev_samp(cum_excess) OVER (PARTITION BY period), 0)', 4)} END AS z_residual
 FROM (SELECT *, CASE WHEN count(e) {over(60)} = 60 THEN sum(e) {over(60)} END AS cum_excess FROM (
 SELECT *, y - alpha - beta * x AS e FROM (SELECT *, CASE WHEN n = 60 THEN regr_slope(y, x) {over(60)} END AS beta,
  CASE WHEN n = 60 THEN regr_intercept(y, x) {over(60)} END AS alpha FROM (
 SELECT *, count(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 1 END) {over(60)} AS n FROM yx))))""",
        **SQL_YX,
    ),
)
def dataset_residual_momentum(spark, sf_dir):
    b = index_bars(spark, sf_dir)
    out = IX.residual_momentum(b, b.where("entity = 0").select("period", "close"))
    return out.select("entity", "period", *[r(c, 5).alias(c) for c in ("beta", "alpha", "cum_excess")], r("z_residual", 4).alias("z_residual"))


@query(
    "Q4",
    with_ctes(
        "ibars",
        f"""SELECT period, {rnd('speed')} AS rotation_speed, {rnd("CASE WHEN peak = 0 THEN 1 ELSE 1 - speed / nullif(peak, 0) END")} AS momentum_discount
 FROM (SELECT *, max(speed) OVER (ORDER BY period ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) AS peak FROM (
 SELECT period, CASE WHEN count(step) >= 2 THEN avg(step) END AS speed FROM (
 SELECT period, abs(rk - lag(rk) OVER ({BY})) AS step FROM (SELECT entity, period, CASE WHEN ret IS NOT NULL THEN
  rank() OVER (PARTITION BY period ORDER BY ret NULLS LAST) + (count(*) OVER (PARTITION BY period, ret) - 1) / 2.0 END AS rk FROM (
 SELECT entity, period, ln(close / lag(close, 20) OVER ({BY})) AS ret FROM ibars))) GROUP BY period))""",
    ),
)
def dataset_rotation_speed(spark, sf_dir):
    return rcols(IX.rotation_speed(staged(index_bars(spark, sf_dir), "index")), ["period"], ["rotation_speed", "momentum_discount"])


@query(
    "Q4",
    with_ctes(
        "ibars",
        f"""SELECT entity, period, {rnd('wap', 3)} AS wap, {sql_rcols([], ['wap_deviation', 'vol_ratio'])},
 CASE WHEN vol_ratio IS NOT NULL THEN {rnd('wap_deviation * least(vol_ratio, 2)')} END AS score FROM (SELECT *, (close - wap) / wap AS wap_deviation FROM (
 SELECT entity, period, close, amount / vol AS wap, CASE WHEN count(vol) {over(20)} = 20 THEN vol / avg(vol) {over(20)} END AS vol_ratio FROM ibars))
 """,
    ),
)
def dataset_price_volume_deviation(spark, sf_dir):
    out = IX.price_volume_deviation(index_bars(spark, sf_dir))
    return out.select("entity", "period", r("wap", 3).alias("wap"), *[r(c).alias(c) for c in ("wap_deviation", "vol_ratio", "score")])


# ---- entity panel (P1, P3, P4) ---------------------------------------------------------------

# Lines behind the monthly bars of one partition, at most as many bars; counting them reads only Parquet footers.
LINES_A_PART = 400_000
FLAGS = {"is_g0": "0", "is_g1": "1", "is_g2": "2", "is_g3": "3", "is_g4": "4"}


def panel_rows(spark, sf_dir):
    """Monthly bars as the fact table; side tables come from the same lines, suppliers and returns."""
    w = W.by_time("entity", "period")
    b = bars(spark, sf_dir, flow=True)
    pre = F.lag("close").over(w)
    facts = b.select(
        "entity", "period", "open", "high", "low", "close", pre.alias("pre_close"), (F.col("close") - pre).alias("change"),
        ((ratio("close", pre) - 1) * 5).alias("pct_chg"), "vol", "amount",
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("entity"), month_start(F.col("l_shipdate").cast("date")).alias("period"), "l_returnflag", "l_tax", "l_discount"
    )
    keys = ["entity", "period"]
    adjust = lines.groupBy(*keys).agg((F.max("l_tax") + 1).alias("adj_factor"))
    special = lines.where("l_discount >= 0.1").select(*keys, F.lit("S").alias("type"))
    suspended = lines.where("l_returnflag = 'R'").select(*keys, F.when(F.col("l_tax") > 0.06, "S").otherwise("R").alias("suspend_type"))
    metrics = b.select(*keys, ratio("amount", "vol").alias("pe"), ratio("high", "low").alias("pb"), F.col("amount").alias("circ_mv"))
    flow = b.select(*keys, *[c for c in b.columns if c.startswith(("buy_", "sell_"))]).withColumn(
        "net_mf_vol", F.col("buy_sm_vol") - F.col("sell_sm_vol")
    )
    static = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("entity"), F.col("s_name").alias("market"), F.lit("1995-03-01").cast("date").alias("list_date")
    )
    sizes = b.where(F.month("period").isin(2, 7)).select("entity", F.col("period").alias("in_date"), "amount")
    big = F.when(F.col("amount") > 200000, "big").otherwise("small")
    groups = sizes.select(
        "entity", "in_date", F.when(big == "big", F.add_months("in_date", 4)).alias("out_date"),
        big.alias("l1_code"), big.alias("l1_name"), F.lit("x").alias("l2_code"), F.lit("y").alias("l2_name"),
    )
    top = b.where(F.month("period") == 6).withColumn(
        "_rn", F.row_number().over(Window.partitionBy("grp", "period").orderBy(F.desc("vol"), "entity"))
    )
    membership = top.where("_rn <= 6").select("period", "entity", F.col("grp").cast("string").alias("index_code"))
    parts = max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "lineitem").count() // LINES_A_PART))
    return EP.entity_panel(
        facts, adjust=adjust, special=special, suspended=suspended, metrics=metrics, flow=flow, static=static,
        groups=groups, membership=membership, flags=FLAGS, amount_unit=10.0, lot=100.0, parts=parts,
    )


@query(
    "P1 E1 E2 E3 E4 E5 E6",
    with_ctes(
        "fbars",
        f"""SELECT b.entity, b.period, {rnd('b.amount / 10', 3)} AS amount, {rnd('ln(1 + b.pct / 100)')} AS log_return,
 {rnd('b.amount / 10 * 10000 / (b.vol * 100)', 3)} AS vwap, {rnd('l.adj', 2)} AS adj_factor, CAST(coalesce(l.st, 0) AS INTEGER) AS is_st,
 CAST(coalesce(l.sus, 0) AS INTEGER) AS is_suspend, {rnd('b.amount / b.vol', 3)} AS pe, {rnd('b.buy_sm_vol - b.sell_sm_vol', 2)} AS net_mf_vol,
 s.s_name AS market, CAST(b.period - DATE '1995-03-01' AS INTEGER) AS list_days,
 CASE WHEN g.out_date IS NULL OR b.period < g.out_date THEN g.code END AS l1_code, """
        + ", ".join(f"CAST(coalesce((SELECT 1 FROM mem m WHERE m.entity = b.entity AND m.grp = {g} AND m.period = b.snap), 0) AS INTEGER) AS is_g{g}" for g in range(5))
        + f""" FROM (SELECT x.*, (close / nullif(lag(close) OVER ({BY}), 0) - 1) * 5 AS pct,
  (SELECT max(period) FROM mem WHERE mem.period <= x.period) AS snap FROM fbars x) b
 LEFT JOIN lines l USING (entity, period) LEFT JOIN supplier s ON s.s_suppkey = b.entity
 ASOF LEFT JOIN grps g ON g.entity = b.entity AND b.period >= g.in_date""",
        lines="""SELECT l_suppkey AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS period, max(l_tax) + 1 AS adj,
  max(CASE WHEN l_discount >= 0.1 THEN 1 ELSE 0 END) AS st, max(CASE WHEN l_returnflag = 'R' AND l_tax > 0.06 THEN 1 ELSE 0 END) AS sus
  FROM lineitem GROUP BY 1, 2""",
        grps="""SELECT entity, period AS in_date, CASE WHEN amount > 200000 THEN 'big' ELSE 'small' END AS code,
  CASE WHEN amount > 200000 THEN CAST(period + INTERVAL 4 MONTH AS DATE) END AS out_date FROM fbars WHERE month(period) IN (2, 7)""",
        mem="""SELECT entity, period, grp FROM (SELECT *, row_number() OVER (PARTITION BY grp, period ORDER BY vol DESC, entity) AS rn
  FROM fbars WHERE month(period) = 6) WHERE rn <= 6""",
    ),
)
def dataset_entity_panel(spark, sf_dir):
    p = panel_rows(spark, sf_dir)
    return p.select(
        "entity", "period", r("amount", 3).alias("amount"), r("log_return").alias("log_return"), r("vwap", 3).alias("vwap"),
        r("adj_factor", 2).alias("adj_factor"), "is_st", "is_suspend", r("pe", 3).alias("pe"), r("net_mf_vol", 2).alias("net_mf_vol"),
        "market", "list_days", "l1_code", *FLAGS,
    )


_WINDOWS = {"1y": 250, "3y": 750, "5y": 1250}
_RANKED = {"price": "close", "pe": "pe", "pe_ttm": "pe_ttm", "pb": "pb"}


def _sql_tech(n):
    return f"""CASE WHEN count(close) {over(n)} = {n} THEN avg(close) {over(n)} END AS ma{n},
  CASE WHEN count(pct_chg) {over(n)} = {n} THEN stddev_samp(pct_chg) {over(n)} END AS volatility_{n}"""


def _sql_rank(v, n):
    """Place among the n rows up to the own one; b are the rows before."""
    inside = f"b.i > a.i - {n}"
    below, ties = (f"count(*) FILTER (WHERE {inside} AND b.{v} {op} a.{v})" for op in "<=")
    seen = f"count(b.{v}) FILTER (WHERE {inside})"
    return f"CASE WHEN {seen} >= 120 AND a.{v} IS NOT NULL THEN ({below} + ({ties} - 1) / 2.0) / nullif({seen} - 1, 0) END"


_RAW = {"close": 2, "pe": 6, "pe_ttm": 6, "pb": 2, "turnover_rate": 2, "pct_chg": 6}
_MOVING = {n: [f"{n}{k}" for k in (20, 60, 250)] for n in ("ma", "above_ma", "volatility_")}


@query(
    "P3 A2 G4",
    with_ctes(
        "dbars",
        f"""SELECT entity, period, {", ".join(f"{rnd(c, d)} AS {c}" for c, d in _RAW.items())}, {sql_rcols([], _MOVING["ma"], 3)}, """
        + ", ".join(f"CAST(coalesce(close > ma{n}, false) AS DOUBLE) AS above_ma{n}" for n in (20, 60, 250))
        + f", {sql_rcols([], _MOVING['volatility_'], 3)}, {sql_rcols([], [f'{v}_tsrank_{w}' for v in _RANKED for w in _WINDOWS])} FROM tech JOIN ranks USING (entity, i)",
        t=f"""SELECT *, row_number() OVER ({BY}) AS i, close / vol AS pe, amount / vol AS pe_ttm, vol AS pb, vol AS turnover_rate, (close / open - 1) * 100 AS pct_chg
 FROM dbars""",
        tech=f"SELECT *, {', '.join(_sql_tech(n) for n in (20, 60, 250))} FROM t",
        ranks=f"SELECT a.entity, a.i, {', '.join(f'{_sql_rank(c, n)} AS {v}_tsrank_{w}' for v, c in _RANKED.items() for w, n in _WINDOWS.items())}"
        + " FROM t a JOIN t b ON a.entity = b.entity AND b.i <= a.i AND b.i > a.i - 1250 GROUP BY a.entity, a.i, a.close, a.pe, a.pe_ttm, a.pb",
    ),
)
def dataset_percentile_panel(spark, sf_dir):
    """All 29 columns: three windows of averages and deviations, ranks of four values over one, three and five years."""
    b = daily_bars(spark, sf_dir).select(
        "entity", "period", "close", ratio("close", "vol").alias("pe"), ratio("amount", "vol").alias("pe_ttm"), F.col("vol").alias("pb"),
        F.col("vol").alias("turnover_rate"), ((ratio("close", "open") - 1) * 100).alias("pct_chg"), F.lit(1.0).alias("adj_factor"),
    )
    out = EP.percentile_panel(b)
    ranks = [f"{v}_tsrank_{w}" for v in _RANKED for w in _WINDOWS]
    return out.select(
        "entity", "period", *[r(c, d).alias(c) for c, d in _RAW.items()], *[r(c, 3).alias(c) for c in _MOVING["ma"]], *_MOVING["above_ma"],
        *[r(c, 3).alias(c) for c in _MOVING["volatility_"]], *[r(c).alias(c) for c in ranks],
    )


@query(
    "P4 G10",
    with_ctes(
        "dbars",
        f"""SELECT entity, CAST(date_trunc('month', period) AS DATE) AS month, max(period) AS period,
 {rnd('arg_max(amount, period)', 2)} AS total_mv, {rnd('arg_max(vol, period)', 2)} AS circ_mv FROM dbars GROUP BY 1, 2""",
    ),
)
def dataset_month_end_size(spark, sf_dir):
    b = daily_bars(spark, sf_dir).select("entity", "period", F.col("amount").alias("total_mv"), F.col("vol").alias("circ_mv"))
    out = EP.month_end_size(b, ["total_mv", "circ_mv"])
    return out.select("entity", "month", "period", r("total_mv", 2).alias("total_mv"), r("circ_mv", 2).alias("circ_mv"))


# ---- fund panel (P2) -------------------------------------------------------------------------

NAMES = ["华夏上证50ETF", "易方达医药ETF", "南方中证500ETF(QDII)", "广发成长芯片LOF", "恒生红利精选A"]
# Labels that the rules give to these names.
WANTED = [
    ("", "", "large", "blend", ""),
    ("801150.SI", "医药生物", "mid", "blend", "消费"),
    ("", "", "mid", "blend", ""),
    ("801080.SI", "电子", "mid", "growth", "成长"),
    ("", "", "large", "dividend", ""),
]


@query(
    "P2 E7 E15 J2 D4 G16",
    with_ctes(
        "dbars region_of",
        f"""SELECT x.entity, x.period, g.grp, {rnd('unit_nav', 2)} AS unit_nav, {rnd('fd_share', 2)} AS fd_share,
 {rnd('discount_rate', 4)} AS discount_rate, {rnd('fund_size', 4)} AS fund_size, {rnd('vwap', 3)} AS vwap, """
        + ", ".join("CASE g.grp " + " ".join(f"WHEN {i} THEN '{w[k]}'" for i, w in enumerate(WANTED)) + f" END AS {c}" for k, c in enumerate(LABELS))
        + f""", {rnd("(rank() OVER (PARTITION BY x.period ORDER BY x.amount) + (count(*) OVER (PARTITION BY x.period, x.amount) - 1) / 2.0) / count(x.amount) OVER (PARTITION BY x.period)")} AS amount_rank
 FROM (SELECT b.*, n.unit_nav, s.fd_share, close / n.unit_nav - 1 AS discount_rate, close * s.fd_share / 1e4 AS fund_size,
  amount * 1000 / (vol * 100) AS vwap FROM dbars b
  ASOF LEFT JOIN nav n ON n.entity = b.entity AND b.period >= n.nav_date
  ASOF LEFT JOIN shr s ON s.entity = b.entity AND b.period >= s.share_date) x JOIN region_of g USING (entity)""",
        nav="SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS nav_date, max(l_extendedprice) AS unit_nav FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1, 2",
        shr="SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS share_date, sum(l_quantity) AS fd_share FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2",
    ),
)
def dataset_fund_panel(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("entity"), F.col("l_shipdate").cast("date").alias("d"), "l_returnflag", "l_extendedprice", "l_quantity"
    )
    price = F.max("l_extendedprice")
    nav = lines.where("l_returnflag = 'A'").groupBy("entity", F.col("d").alias("nav_date")).agg(
        price.alias("unit_nav"), price.alias("accum_nav"), price.alias("adj_nav")
    )
    shares = lines.where("l_returnflag = 'R'").groupBy("entity", F.col("d").alias("share_date")).agg(F.sum("l_quantity").alias("fd_share"))
    name = F.element_at(F.array(*[F.lit(n) for n in NAMES]), F.col("grp") + 1)
    basic = supplier_region(spark, sf_dir).select(
        "entity", name.alias("name"), F.lit("股票型").alias("fund_type"), F.lit("被动指数型").alias("invest_type"), F.lit("1995-01-01").cast("date").alias("list_date")
    )
    b = daily_bars(spark, sf_dir).withColumns(
        {"pre_close": F.col("open"), "change": F.col("close") - F.col("open"), "pct_chg": (ratio("close", "open") - 1)}
    )
    out = fund_panel(b, nav, shares, basic, stage=staged).join(supplier_region(spark, sf_dir), "entity")
    return out.select(
        "entity", "period", "grp", r("unit_nav", 2).alias("unit_nav"), r("fd_share", 2).alias("fd_share"), r("discount_rate", 4).alias("discount_rate"),
        r("fund_size", 4).alias("fund_size"), r("vwap", 3).alias("vwap"), *LABELS, r("amount_rank").alias("amount_rank"),
    )


# ---- statements (P6, P7, P12) ----------------------------------------------------------------

# Orders behind the statements of one partition; counting them reads only Parquet footers.
ORDERS_A_PART = 40_000


def statement_parts(spark, sf_dir) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "orders").count() // ORDERS_A_PART))


SQL_FIN = {
    "inc": """SELECT entity, period AS end_date, known_at AS f_ann_date, revenue, cost, qno FROM statements
  UNION ALL SELECT entity, period, CAST(known_at + INTERVAL 200 DAY AS DATE), revenue * 1.1, cost, qno FROM statements WHERE qno <> 2""",
    "snaps": """SELECT CAST(x AS DATE) AS s FROM (SELECT unnest([TIMESTAMP '1996-12-31', TIMESTAMP '1998-12-31', TIMESTAMP '2000-12-29']) AS x)""",
    "known": """SELECT s, entity, period AS end_date FROM statements JOIN snaps ON period <= s AND known_at <= s
  AND period >= CAST(s - INTERVAL 4 YEAR AS DATE)""",
    "grid": """SELECT s, entity, CAST(date_trunc('quarter', q) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS end_date FROM (
  SELECT s, entity, unnest(generate_series(date_trunc('quarter', min(end_date)), date_trunc('quarter', max(end_date)), INTERVAL 3 MONTH)) AS q
  FROM known GROUP BY 1, 2)""",
    "ver": """SELECT * FROM (SELECT snaps.s, i.*, row_number() OVER (PARTITION BY snaps.s, entity, end_date ORDER BY f_ann_date DESC) AS rn
  FROM inc i JOIN snaps ON f_ann_date <= s AND end_date <= s AND end_date >= CAST(s - INTERVAL 4 YEAR AS DATE)) WHERE rn = 1""",
    "fin": """SELECT g.s, g.entity, g.end_date, CAST(v.f_ann_date IS NOT NULL AS INTEGER) AS has_inc, v.f_ann_date, v.revenue / 10000 AS revenue,
  v.cost / 10000 AS oper_cost, coalesce(v.revenue / 10000, 0) - coalesce(v.cost / 10000, 0) AS gp, z.amount AS total_mv
  FROM grid g LEFT JOIN ver v ON v.s = g.s AND v.entity = g.entity AND v.end_date = g.end_date
  LEFT JOIN statements d ON d.entity = g.entity AND d.period = g.end_date
  LEFT JOIN (SELECT o_custkey AS entity, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, sum(o_totalprice) AS amount FROM orders GROUP BY 1, 2) z
   ON z.entity = g.entity AND z.m = date_trunc('month', d.known_at)""",
}


def financial_snapshot(spark, sf_dir):
    from panelspark.plans.shapes import statements

    st = statements(spark, sf_dir).withColumnRenamed("period", "end_date")
    base = st.select(
        "entity", "end_date", F.col("known_at").alias("ann_date"), F.col("known_at").alias("f_ann_date"), F.lit("0").alias("update_flag"),
        "revenue", F.col("cost").alias("oper_cost"), "qno",
    )
    later = base.where("qno <> 2").withColumns({"f_ann_date": F.date_add("f_ann_date", 200), "revenue": F.col("revenue") * 1.1})
    income = base.unionByName(later).drop("qno")
    none = income.select("entity", "end_date", "ann_date", "f_ann_date", "update_flag").where("end_date is null")
    disclosure = st.select(
        "entity", "end_date", F.col("known_at").alias("ann_date"), F.col("known_at").alias("pre_date"), F.col("known_at").alias("actual_date"),
        F.lit(None).cast("date").alias("modify_date"),
    )
    dividends = none.select(
        "entity", "end_date", F.col("ann_date").alias("ex_date"), F.lit("实施").alias("div_proc"), "update_flag",
        F.lit(1.0).alias("cash_div"), F.lit(1.0).alias("base_share"),
    )
    size = table(spark, sf_dir, "orders").groupBy(
        F.col("o_custkey").alias("entity"), month_start(F.col("o_orderdate").cast("date")).alias("period")
    ).agg(F.sum("o_totalprice").alias("total_mv"))
    size = size.withColumns({c: F.col("total_mv") for c in ("total_share", "float_share", "circ_mv")})
    span = table(spark, sf_dir, "orders").agg(F.count("*").alias("_n"))
    days = F.array(*[F.lit(d).cast("date") for d in ("1996-12-31", "1998-12-31", "2000-12-29")])
    snaps = span.select(F.explode(days).alias("snapshot_date"))
    return FS.statements_snapshot(disclosure, none, income, none, dividends, size, snaps, parts=statement_parts(spark, sf_dir))


@query(
    "P6 A13 E9 E10 E18 G12 G14 D6",
    with_ctes(
        "statements",
        f"""SELECT s AS snapshot_date, entity, end_date, has_inc, f_ann_date AS inc_f_ann_date, {sql_rcols([], ['revenue', 'gp'], 4)},
 {rnd('total_mv', 2)} AS total_mv FROM fin""",
        **SQL_FIN,
    ),
)
def dataset_statements_snapshot(spark, sf_dir):
    out = financial_snapshot(spark, sf_dir)
    return out.select(
        "snapshot_date", "entity", "end_date", "has_inc", "inc_f_ann_date", r("revenue", 4).alias("revenue"), r("gp", 4).alias("gp"),
        r("total_mv", 2).alias("total_mv"),
    )


@query(
    "P7 G6 G7 G8 G9 D2",
    with_ctes(
        "statements",
        f"""SELECT snapshot_date, entity, end_date, {sql_rcols([], ['revenue_q', 'revenue_ttm'], 4)}, {rnd('CASE WHEN abs(total_mv) > 100 THEN revenue_q / total_mv END')} AS sp_q,
 {rnd('CASE WHEN abs(total_mv) > 100 THEN gp_ttm / total_mv END')} AS gpp_ttm,
 {rnd('CASE WHEN abs(revenue_q) > 100 THEN gp_q / revenue_q END', 5)} AS gpm_q FROM (
 SELECT *, CASE WHEN count(revenue_q) OVER w4 = 4 THEN sum(revenue_q) OVER w4 END AS revenue_ttm,
  CASE WHEN count(gp_q) OVER w4 = 4 THEN sum(gp_q) OVER w4 END AS gp_ttm FROM (
 SELECT s AS snapshot_date, entity, end_date, total_mv, CASE WHEN quarter(end_date) = 1 THEN revenue ELSE revenue - lag(revenue) OVER w END AS revenue_q,
  CASE WHEN quarter(end_date) = 1 THEN gp ELSE gp - lag(gp) OVER w END AS gp_q FROM fin WINDOW w AS (PARTITION BY s, entity ORDER BY end_date))
 WINDOW w4 AS (PARTITION BY snapshot_date, entity ORDER BY end_date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))""",
        **SQL_FIN,
    ),
)
def dataset_indicators_snapshot(spark, sf_dir):
    out = FS.indicators_snapshot(staged(financial_snapshot(spark, sf_dir), "statements"))
    return out.select(
        "snapshot_date", "entity", "end_date", r("revenue_q", 4).alias("revenue_q"), r("revenue_ttm", 4).alias("revenue_ttm"),
        r("sp_q").alias("sp_q"), r("gpp_ttm").alias("gpp_ttm"), r("gpm_q", 5).alias("gpm_q"),
    )


@query(
    "P12 G34 D7",
    with_ctes(
        "bars",
        f"""SELECT entity, period AS snapshot_date, CAST(cnt AS BIGINT) AS report_cnt, {rnd('bp')} AS bp, {rnd('list_avg(h)')} AS bp_mean,
 {rnd('list_stddev_pop(h)')} AS bp_std, {rnd('len(list_filter(h[1:len(h) - 1], lambda x: x <= h[-1])) / nullif(len(h) - 1, 0)')} AS bp_tsrank,
 {rnd('list_avg(a)')} AS arp_q_mean, CAST(len(list_filter(g, lambda x: x < 0)) AS INTEGER) AS gpp_q_neg_cnt FROM (
 SELECT entity, period, bp, count(*) {over(36)} AS cnt, list(bp) {over(36)} AS h, list(arp) {over(36)} AS a, list(chg) {over(36)} AS g FROM (
 SELECT entity, period, vol / amount * 1000 AS bp, coalesce(open / high, 0) + coalesce(low / high, 0) AS arp, close / open - 1 AS chg FROM bars))
 WHERE cnt >= 4""",
    ),
)
def dataset_valuation_history(spark, sf_dir):
    b = bars(spark, sf_dir).select(
        "entity", F.col("period").alias("snapshot_date"), F.col("period").alias("end_date"), (ratio("vol", "amount") * 1000).alias("bp"),
        ratio("open", "high").alias("admp_q"), ratio("low", "high").alias("rdp_q"), F.lit(None).cast("double").alias("taxp_q"),
        (ratio("close", "open") - 1).alias("gpp_q"),
    )
    out = valuation_history(b, base=["bp", "gpp_q", "arp_q"])
    return out.select(
        "entity", "snapshot_date", "report_cnt", *[r(c).alias(c) for c in ("bp", "bp_mean", "bp_std", "bp_tsrank", "arp_q_mean")], "gpp_q_neg_cnt"
    )


# ---- entity factors (P9, P10) and labels (P13) -----------------------------------------------


def factor_panel(spark, sf_dir, stage=staged):
    """Monthly bars in the layout of the entity-day panel."""
    w = W.by_time("entity", "period")
    pre = F.lag("close").over(w)
    b = bars(spark, sf_dir, flow=True).withColumn("pre_close", pre)
    out = b.withColumns(
        {
            "pct_chg": (ratio("close", "pre_close") - 1) * 100,
            "log_return": F.log(ratio("close", "pre_close")),
            "turnover": F.col("vol") / 50,
            "size": F.col("amount"),
        }
    )
    return stage(out, "panel")


SQL_PANEL = f"""
 SELECT *, close / nullif(pre, 0) - 1 AS ret, (high - low) / pre AS amp, (2 * close - high - low) / pre AS plus,
  (least(open, close) - low - high + greatest(open, close)) / pre AS shadow, vol / 50 AS tvr, buy_sm_vol - sell_sm_vol AS net,
  buy_sm_vol / vol AS buy_sm, (buy_elg_vol - sell_elg_vol) / nullif(buy_elg_vol + sell_elg_vol, 0) AS elg_imba
 FROM (SELECT *, lag(close) OVER ({BY}) AS pre FROM fbars)"""


def _mean_std(out: str, c: str) -> str:
    m, s = f"avg({c}) {over(20)}", f"stddev_samp({c}) {over(20)}"
    return f"{rnd(m)} AS {out}_mean_20, {rnd(s)} AS {out}_std_20"


@query(
    "P9 G40 F1",
    with_ctes(
        "fbars",
        f"""SELECT * EXCLUDE (c) FROM (SELECT entity, period, count(*) {over(20)} AS c, {rnd(f'exp(sum(ln(1 + ret)) {over(20)}) - 1', 4)} AS ret_20,
 {_mean_std('ret', 'ret')}, {_mean_std('tvr', 'tvr')}, {_mean_std('amp', 'amp')}, {_mean_std('plus', 'plus')}, {_mean_std('shadow_diff', 'shadow')},
 {rnd(f'sum(ret * vol) {over(20)} / sum(vol) {over(20)}')} AS vw_ret_20,
 {rnd(f'sum(net) {over(20)} / nullif(sum(abs(net)) {over(20)}, 0)')} AS sm_imba_norm FROM p) WHERE c = 20""",
        p=SQL_PANEL,
    ),
)
def dataset_price_volume_pack(spark, sf_dir):
    out = SF.price_volume_pack(factor_panel(spark, sf_dir, as_is), stage=staged)  # read once
    names = [f"{n}_{k}_20" for n in ("ret", "tvr", "amp", "plus", "shadow_diff") for k in ("mean", "std")]
    return out.select(
        "entity", "period", r("ret_20", 4).alias("ret_20"), *[r(c).alias(c) for c in [*names, "vw_ret_20", "sm_imba_norm"]]
    )


def _sql_framed(key: str, values: list[str]) -> str:
    fields = ", ".join(f"'{v}': {v}" for v in values)
    return f"list_sort(list({{'m': CAST({key} IS NULL AS INTEGER), 'k': -({key}), 't': -(period - DATE '1970-01-01'), {fields}}}) {over(20)})"


def _sql_traded(history: list[str], keys: dict[str, list[str]], select: str, source: str = "p") -> str:
    counts = ", ".join(f"count({h}) {over(40)} AS h{i}" for i, h in enumerate(history))
    arrays = ", ".join(f"{_sql_framed(k, v)} AS a_{k}" for k, v in keys.items())
    enough = " AND ".join(f"h{i} >= 20" for i in range(len(history)))
    return f"""SELECT entity, period, {select} FROM (SELECT *, {arrays} FROM (SELECT *, {counts} FROM {source}) WHERE {enough})
 WHERE len(a_{next(iter(keys))}) = 20"""


@query(
    "P10 G31",
    with_ctes(
        "fbars",
        _sql_traded(
            ["ret", "buy_sm_vol"], {"ret": ["buy_sm"], "vm": ["buy_sm"]},
            _sql_slices("a_ret", {"buy_sm": "ret_{slice}_buy_sm"}, [5, 10]) + ", " + _sql_slices("a_vm", {"buy_sm": "vm_ret_{slice}_buy_sm"}, [5, 10]),
        ),
        p=f"SELECT *, ret * vol AS vm FROM ({SQL_PANEL})",
    ),
)
def dataset_flow_imbalance(spark, sf_dir):
    out = SF.flow_imbalance(factor_panel(spark, sf_dir))
    return rcols(out, ["entity", "period"], [c for c in out.columns if c.endswith(("_buy_sm", "_buy_sm_ld", "_buy_sm_exp"))])


@query(
    "P10 G32",
    with_ctes(
        "fbars",
        _sql_traded(
            ["ret", "buy_sm_vol"], {"buy_sm": ["ret"]},
            _sql_slices("a_buy_sm", {"ret": "buy_sm_{slice}"}, [5, 10]) + ", " + ", ".join(f"{rnd(f'a_buy_sm[{i + 1}].ret')} AS buy_sm_{i}_ret" for i in range(20)),
        ),
        p=SQL_PANEL,
    ),
)
def dataset_trader_structure(spark, sf_dir):
    out = SF.trader_structure(factor_panel(spark, sf_dir))
    return rcols(out, ["entity", "period"], [c for c in out.columns if c.startswith("buy_sm_")])


@query(
    "P10 D11",
    with_ctes(
        "fbars",
        _sql_traded(
            ["ret"], {"close": ["tvr", "plus"]},
            _sql_slices("a_close", {"tvr": "close_{slice}_tvr", "plus": "close_{slice}_plus"}, [5, 10]) + f", {rnd('tm', 5)} AS tvr_mean_20",
            source=f"(SELECT *, avg(tvr) {over(20)} AS tm FROM p)",
        ),
        p=SQL_PANEL,
    ),
)
def dataset_high_low_spread(spark, sf_dir):
    out = SF.high_low_spread(factor_panel(spark, sf_dir))
    names = [f"close_{s}{n}_{v}{t}" for v in ("tvr", "plus") for n in (5, 10) for s in ("top", "bottom") for t in ("", "_ld", "_exp")]
    return out.select("entity", "period", *[r(c).alias(c) for c in names], r("tvr_mean_20", 5).alias("tvr_mean_20"))


@query(
    "P10 E11",
    with_ctes(
        "fbars",
        _sql_traded(
            ["ret", "gret"], {"vm": ["gret"], "gret": ["ret"]},
            _sql_slices("a_vm", {"gret": "vm_ret_{slice}_ind_ret"}, [5, 10, 15]) + ", " + ", ".join(f"{rnd(f'a_gret[{i + 1}].ret')} AS ind_ret_{i}_ret" for i in range(20)),
        ),
        q=SQL_PANEL,
        p="SELECT q.*, ret * vol AS vm, g.gret FROM q LEFT JOIN (SELECT grp, period, max(ret) AS gret FROM q GROUP BY 1, 2) g ON g.grp = q.grp AND g.period = q.period",
    ),
)
def dataset_industry_resonance(spark, sf_dir):
    p = factor_panel(spark, sf_dir)
    groups = p.groupBy("grp", "period").agg((F.max("pct_chg") / 100).alias("group_ret"))
    out = SF.industry_resonance(p, groups)
    return rcols(out, ["entity", "period"], [c for c in out.columns if c.startswith(("vm_ret_top", "vm_ret_bottom", "ind_ret_"))])


@query(
    "P13 G15 I1",
    with_ctes(
        "bars ibars",
        f"""SELECT entity, period, asset_type, {rnd('CASE WHEN i + 2 <= last_i THEN c2.price END / nullif(CASE WHEN i + 1 <= last_i THEN c1.price END, 0) - 1')} AS fwd_ret_1d,
 {rnd('CASE WHEN i + 6 <= last_i THEN c6.price END / nullif(CASE WHEN i + 1 <= last_i THEN c1.price END, 0) - 1')} AS fwd_ret_5d
 FROM r ASOF LEFT JOIN k c1 ON c1.e = r.entity AND r.i + 1 >= c1.j ASOF LEFT JOIN k c2 ON c2.e = r.entity AND r.i + 2 >= c2.j
 ASOF LEFT JOIN k c6 ON c6.e = r.entity AND r.i + 6 >= c6.j""",
        u="""SELECT 'S' || entity AS entity, period, close AS price, 'stock' AS asset_type FROM bars UNION ALL
  SELECT 'I' || entity, CAST(date_trunc('month', period) AS DATE), arg_max(close, period), 'index' FROM ibars GROUP BY 1, 2""",
        days="SELECT period, row_number() OVER (ORDER BY period) AS i, count(*) OVER () AS last_i FROM (SELECT DISTINCT period FROM u)",
        r="SELECT u.*, i, last_i FROM u JOIN days USING (period)",
        k="SELECT entity AS e, i AS j, price FROM r",
    ),
)
def dataset_forward_labels(spark, sf_dir):
    stock = bars(spark, sf_dir).select(F.concat(F.lit("S"), "entity").alias("entity"), "period", "close")
    index = index_bars(spark, sf_dir).groupBy(F.concat(F.lit("I"), "entity").alias("entity"), month_start("period").alias("month")).agg(
        F.max_by("close", "period").alias("close")
    )
    out = forward_labels({"stock": stock, "index": index.withColumnRenamed("month", "period")}, horizons=[1, 5])
    return out.select("entity", "period", "asset_type", r("fwd_ret_1d").alias("fwd_ret_1d"), r("fwd_ret_5d").alias("fwd_ret_5d"))


def _sql_labels() -> str:
    picked, joins, cols = [], [], []
    for n in [0, *HORIZONS]:
        joins.append(f"ASOF LEFT JOIN placed x{n} ON x{n}.entity = b.entity AND b.i + {n + 1} >= x{n}.i")
        picked += [f"CASE WHEN b.i + {n + 1} <= b.last_i THEN x{n}.price END AS p{n}", f"CASE WHEN b.i + {n + 1} <= b.last_i THEN x{n}.halted END AS h{n}"]
    cols += [f"{rnd(f'p{n} / nullif(p0, 0) - 1')} AS fwd_ret_{n}d" for n in HORIZONS]
    cols += [f"CAST(coalesce(h0, 1) = 1 OR coalesce(h{n}, 1) = 1 AS INTEGER) AS is_suspend_{n}d" for n in HORIZONS]
    return f"SELECT entity, period, asset_type, {', '.join(cols)} FROM (SELECT b.entity, b.period, b.asset_type, {', '.join(picked)} FROM placed b {' '.join(joins)}) WHERE period BETWEEN DATE '{LABELLED[0]}' AND DATE '{LABELLED[1]}'"


LABELLED = (date(1996, 2, 1), date(2001, 6, 30))


@query(
    "P13 G15",
    with_ctes(
        "dbars ibars",
        _sql_labels(),
        assets="""SELECT 's' || entity AS entity, period, 'stock' AS asset_type, close * (1 + entity % 5) AS price, CAST(vol <= 3 AS INTEGER) AS halted FROM dbars
 UNION ALL SELECT 'f' || o_custkey, CAST(o_orderdate AS DATE), 'fund', max(o_totalprice) * 0.5, CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE CAST(min(o_orderstatus) = 'P' AS INTEGER) END
  FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE)
 UNION ALL SELECT 'i' || entity, period, 'index', close, 0 FROM ibars""",
        days="SELECT period, row_number() OVER (ORDER BY period) AS i, count(*) OVER () AS last_i FROM (SELECT DISTINCT period FROM assets)",
        placed="SELECT a.*, d.i, d.last_i FROM assets a JOIN days d USING (period)",
    ),
)
def dataset_label_table(spark, sf_dir):
    """Labels of stocks (adjusted, halted by volume), funds (halted by status, unknown counts as open) and indices, on the calendar of all."""
    name = lambda kind: F.concat(F.lit(kind), F.col("entity").cast("string")).alias("entity")
    stock = daily_bars(spark, sf_dir).select(name("s"), "period", "close", (F.lit(1) + F.col("entity") % 5).cast("double").alias("adj_factor"), (F.col("vol") <= 3).cast("int").alias("is_suspend"))
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("entity"), F.col("o_orderdate").cast("date").alias("period"))
    fund = orders.agg(F.max("o_totalprice").alias("close"), F.lit(0.5).alias("adj_factor"), (F.min("o_orderstatus") == "P").cast("int").alias("_halted"))
    fund = fund.select(name("f"), "period", "close", "adj_factor", F.when(F.col("entity") % 3 != 0, F.col("_halted")).alias("is_suspend"))
    index = index_bars(spark, sf_dir).select(name("i"), "period", "close")
    out = forward_labels({"stock": stock, "fund": fund, "index": index}, start=LABELLED[0], end=LABELLED[1])
    return out.select("entity", "period", "asset_type", *[r(f"fwd_ret_{n}d").alias(f"fwd_ret_{n}d") for n in HORIZONS], *[f"is_suspend_{n}d" for n in HORIZONS])


# ---- the same datasets with every column that has a closed SQL form ---------------------------

RATIOS = {
    "bp": "vol / amount * 1000", "rep": "open / close", "sp_q": "low / high", "sp_ttm": "close / amount * 100",
    "divp_ttm": "CASE WHEN vol > 10 THEN high / close END", "gpp_q": "close / open - 1", "ep_q": "(close - open) / high",
    "ocfp_q": "CASE WHEN vol > 15 THEN low / open - 0.9 END", "ebitp_q": "(high + low - 2 * close) / close", "gpp_ttm": "(open - low) / high - 0.3",
    "ep_ttm": "close / high - 0.8", "ocfp_ttm": "low / close - 0.7", "ebitp_ttm": "(close - low) / nullif(high - low, 0) - 0.5",
    "admp_q": "open / high", "rdp_q": "CASE WHEN vol > 12 THEN low / high END", "taxp_q": "CASE WHEN vol > 20 THEN open / close / 10 END",
}
PACKED = [*NON_NEGATIVE, *SIGNED, "arp_q", "artp_q"]


def _sql_history(c: str) -> str:
    h, n = f"h_{c}", f"len(h_{c})"
    enough, flat = f"{n} >= 4", f"list_min({h}) = list_max({h})"
    stats = {
        "mean": f"list_avg({h})",
        "std": f"list_stddev_pop({h})",
        "zscore": f"CASE WHEN NOT {flat} THEN ({h}[-1] - list_avg({h})) / list_stddev_pop({h}) END",
        "tsrank": f"len(list_filter({h}[1:{n} - 1], lambda x: x <= {h}[-1])) / nullif({n} - 1, 0)",
        "momentum": f"CASE WHEN {n} > 12 AND abs({h}[{n} - 12]) > 1e-12 THEN ({h}[-1] - {h}[{n} - 12]) / abs({h}[{n} - 12]) END",
    }
    out = [f"{rnd(c)} AS {c}", *[f"{rnd(f'CASE WHEN {enough} THEN {e} END')} AS {c}_{k}" for k, e in stats.items()]]
    if c in SIGNED:
        out.append(f"CASE WHEN {enough} THEN CAST(len(list_filter({h}, lambda x: x < 0)) AS INTEGER) END AS {c}_neg_cnt")
    return ", ".join(out)


@query(
    "P12 G34 D7",
    with_ctes(
        "bars",
        f"""SELECT entity, period AS snapshot_date, report_cnt, {", ".join(map(_sql_history, PACKED))} FROM (
 SELECT *, count(*) {over(36)} AS report_cnt, {", ".join(f"list({c}) FILTER (WHERE {c} IS NOT NULL) {over(36)} AS h_{c}" for c in PACKED)} FROM r) WHERE report_cnt >= 4""",
        q=f"SELECT entity, period, {', '.join(f'{e} AS {c}' for c, e in RATIOS.items())} FROM bars",
        r="SELECT *, coalesce(admp_q, 0) + coalesce(rdp_q, 0) AS arp_q, coalesce(admp_q, 0) + coalesce(rdp_q, 0) + coalesce(taxp_q, 0) AS artp_q FROM q",
    ),
)
def dataset_valuation_pack(spark, sf_dir):
    """All fifteen ratios with their statistics over 36 snapshots."""
    b = bars(spark, sf_dir).select("entity", F.col("period").alias("snapshot_date"), F.col("period").alias("end_date"), *[F.expr(e).alias(c) for c, e in RATIOS.items()])
    out = valuation_history(b)
    counts = [c for c in out.columns if c.endswith("_neg_cnt")]
    values = [c for c in out.columns if c not in ("entity", "snapshot_date", "report_cnt", *counts)]
    return out.select("entity", "snapshot_date", "report_cnt", *[r(c).alias(c) for c in values], *counts)


SQL_FLOWS = f"""SELECT *, ret * vol AS vm, buy_elg_vol / vol AS buy_elg, (buy_sm_vol - sell_sm_vol) / nullif(buy_sm_vol + sell_sm_vol, 0) AS sm_imba,
 close / nullif(open, 0) - 1 AS intra, open / nullif(pre, 0) - 1 AS night, buy_elg_vol - sell_elg_vol AS net_elg, abs(ret) / nullif(amount / 10000, 0) AS illiq,
 CASE WHEN pre IS NOT NULL THEN greatest(high - low, abs(high - pre), abs(low - pre)) / nullif(pre, 0) END AS tr,
 tvr / nullif(lag(tvr) OVER ({BY}), 0) - 1 AS tvr_chg FROM ({SQL_PANEL})"""


def _mean_std_ratio(out: str, c: str) -> str:
    m, s = f"avg({c}) {over(20)}", f"stddev_samp({c}) {over(20)}"
    return f"{_mean_std(out, c)}, {rnd(f'{m} / nullif({s}, 0)', 3)} AS {out}_msr_20"


MEASURES = {"ret": "ret", "tvr": "tvr", "tvr_chg": "tvr_chg", "amp": "amp", "shadow_diff": "shadow", "plus": "plus", "illiq": "illiq"}
MEANS = {"intraday_ret_20": "intra", "overnight_ret_20": "night", "abs_overnight_ret_20": "abs(night)"}
NORMED = {"sm_imba_norm": "net", "elg_imba_norm": "net_elg"}


@query(
    "P9 G40 F1 F13 F14",
    with_ctes(
        "fbars",
        f"""SELECT * EXCLUDE (c) FROM (SELECT entity, period, count(*) {over(20)} AS c, {rnd(f'exp(sum(ln(1 + ret)) {over(20)}) - 1', 4)} AS ret_20,
 {", ".join(_mean_std_ratio(n, c) for n, c in MEASURES.items())},
 {", ".join(f"{rnd(f'avg({e}) {over(20)}')} AS {n}" for n, e in MEANS.items())},
 {rnd(f'sum(ret * vol) {over(20)} / nullif(sum(vol) {over(20)}, 0)')} AS vw_ret_20, {rnd(f'sum(intra * vol) {over(20)} / nullif(sum(vol) {over(20)}, 0)')} AS vw_intraday_ret_20,
 {", ".join(f"{rnd(f'sum({e}) {over(20)} / nullif(sum(abs({e})) {over(20)}, 0)')} AS {n}" for n, e in NORMED.items())} FROM p) WHERE c = 20""",
        p=SQL_FLOWS,
    ),
)
def dataset_price_volume_windows(spark, sf_dir):
    """All columns of the 20-row pack that are made from one entity's window."""
    out = SF.price_volume_pack(factor_panel(spark, sf_dir, as_is), stage=staged)  # read once
    ratios = [f"{n}_msr_20" for n in MEASURES]
    names = [*[f"{n}_{k}_20" for n in MEASURES for k in ("mean", "std")], *MEANS, "vw_ret_20", "vw_intraday_ret_20", *NORMED]
    return out.select("entity", "period", r("ret_20", 4).alias("ret_20"), *[r(c, 3).alias(c) for c in ratios], *[r(c).alias(c) for c in names])


_FLOW_NAMES = {"buy_sm": "buy_sm", "buy_elg": "buy_elg", "sm_imba": "sm_imba", "elg_imba": "elg_imba"}


@query(
    "P10 G31",
    with_ctes(
        "fbars",
        _sql_traded(
            ["ret", "buy_sm_vol"], {"ret": list(_FLOW_NAMES), "vm": list(_FLOW_NAMES)},
            ", ".join(_sql_slices(f"a_{k}", {v: f"{n}_{{slice}}_{v}" for v in _FLOW_NAMES}, [5, 10]) for k, n in (("ret", "ret"), ("vm", "vm_ret"))),
        ),
        p=SQL_FLOWS,
    ),
)
def dataset_flow_imbalance_columns(spark, sf_dir):
    """All four flow ratios on the days of the highest and lowest returns."""
    out = SF.flow_imbalance(factor_panel(spark, sf_dir))
    return rcols(out, ["entity", "period"], [c for c in out.columns if c not in ("entity", "period")])


@query(
    "P10 G32",
    with_ctes(
        "fbars",
        _sql_traded(
            ["ret", "buy_sm_vol"], {k: ["ret"] for k in _FLOW_NAMES},
            ", ".join([_sql_slices(f"a_{k}", {"ret": f"{k}_{{slice}}"}, [5, 10]) for k in _FLOW_NAMES] + [f"{rnd(f'a_{k}[{i + 1}].ret')} AS {k}_{i}_ret" for k in _FLOW_NAMES for i in range(20)]),
        ),
        p=SQL_FLOWS,
    ),
)
def dataset_trader_structure_columns(spark, sf_dir):
    """Returns on the days of the highest and lowest values of all four flow ratios."""
    out = SF.trader_structure(factor_panel(spark, sf_dir))
    return rcols(out, ["entity", "period"], [c for c in out.columns if c not in ("entity", "period")])


_SPREAD = {"tvr": "tvr", "amp": "amp", "tr": "tr", "plus": "plus"}


@query(
    "P10 D11",
    with_ctes(
        "fbars",
        _sql_traded(
            ["ret"], {"close": list(_SPREAD)},
            _sql_slices("a_close", {v: f"close_{{slice}}_{v}" for v in _SPREAD}, [5, 10])
            + ", " + ", ".join(f"{rnd(f'a_close[{i + 1}].{v}')} AS close_{i}_{v}" for v in _SPREAD for i in range(20))
            + ", " + ", ".join(f"{rnd(f'm_{v}', 5)} AS {v}_mean_20, {rnd(f's_{v}', 5)} AS {v}_std_20" for v in _SPREAD),
            source=f"(SELECT *, {', '.join(f'avg({v}) {over(20)} AS m_{v}, stddev_samp({v}) {over(20)} AS s_{v}' for v in _SPREAD)} FROM p)",
        ),
        p=SQL_FLOWS,
    ),
)
def dataset_high_low_spread_columns(spark, sf_dir):
    """Turnover, amplitude, range and close location on the highest and lowest closes, with their means and deviations."""
    out = SF.high_low_spread(factor_panel(spark, sf_dir))
    wide = [c for c in out.columns if c.endswith(("_mean_20", "_std_20"))]
    rest = [c for c in out.columns if c not in ("entity", "period", *wide)]
    return out.select("entity", "period", *[r(c).alias(c) for c in rest], *[r(c, 5).alias(c) for c in wide])


_OTHER_ITEMS = "total_mv ev evnoa retained_earnings ebitda cip da total_cur_liab st_interest_bearing_liab total_div".split()


def _indicator_inputs() -> dict[str, str]:
    """Every input of the indicators as another mix of cumulative revenue and cost; some are missing in third quarters."""
    out = {}
    for i, c in enumerate([*FS.FLOW_ITEMS, *FS.LEVEL_ITEMS, *_OTHER_ITEMS]):
        mix = f"revenue * {5 + i * 7 % 11} / 10 + cost * {i * 5 % 7 - 3} / 10"
        out[c] = f"CASE WHEN qno <> 3 THEN {mix} END" if i % 6 == 4 else mix
    return out


_RATIO_PARTS = FS.valuation_ratios() | FS._ratios(FS.PROFIT) | FS._ratios(FS.QUALITY)
_INNER = [*FS._ratios(FS.PROFIT), *FS._ratios(FS.QUALITY)]
_W, _W4 = "OVER (PARTITION BY entity ORDER BY end_date)", "OVER (PARTITION BY entity ORDER BY end_date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)"


def _sql_indicators() -> dict[str, str]:
    flows, levels = FS.FLOW_ITEMS, FS.LEVEL_ITEMS
    q = ", ".join(f"CASE WHEN report_type = 1 THEN {c} ELSE {c} - lag({c}) {_W} END AS {c}_q" for c in flows)
    ttm = [f"CASE WHEN count({c}_q) {_W4} = 4 THEN sum({c}_q) {_W4} END AS {c}_ttm" for c in flows]
    ttm += [f"CASE WHEN count({c}) {_W4} >= 1 THEN avg({c}) {_W4} END AS {c}_ttm_avg" for c in levels]
    ratios = ", ".join(f"CASE WHEN abs({b}) > 100 THEN {a} / {b} END AS {n}" for n, (a, b) in _RATIO_PARTS.items())
    return {
        "i0": f"SELECT entity, period AS end_date, qno AS report_type, {', '.join(f'{e} AS {c}' for c, e in _indicator_inputs().items())} FROM statements",
        "i1": f"SELECT *, {q} FROM i0",
        "i2": f"SELECT *, {', '.join(ttm)}, sum(coalesce(total_div, 0)) {_W4} AS total_div_ttm FROM i1",
        "i3": f"SELECT *, {ratios} FROM i2",
    }


def _sql_yoy(name: str, column: str, guard: float) -> str:
    before = f"lag({column}, 4) {_W}"
    return f"{rnd(f'CASE WHEN abs({before}) > {guard} THEN ({column} - {before}) / abs({before}) END', 3)} AS {name}_yoy"


@query(
    "P7 G6 G7 G8 G9 D2",
    with_ctes(
        "statements",
        "SELECT entity, end_date, "
        + ", ".join([
            sql_rcols([], ["total_mv", *[f"{c}_{s}" for s in ("q", "ttm") for c in FS.FLOW_ITEMS], *FS.LEVEL_ITEMS], 2),
            sql_rcols([], list(_RATIO_PARTS), 4),
            *[_sql_yoy(c, f"{c}_q", FS.LEVEL_GUARD) for c in FS.FLOW_ITEMS],
            *[_sql_yoy(c, c, FS.LEVEL_GUARD) for c in FS.LEVEL_ITEMS],
            *[_sql_yoy(c, c, FS.RATIO_GUARD) for c in _INNER],
        ])
        + " FROM i3",
        **_sql_indicators(),
    ),
)
def dataset_indicator_columns(spark, sf_dir):
    """All flows, trailing years, levels, 102 ratios and 81 yearly changes of the indicators, on inputs that are all filled."""
    from panelspark.plans.shapes import statements

    inputs = [F.expr(e).cast("double").alias(c) for c, e in _indicator_inputs().items()]
    dates = [F.col("known_at").alias(c) for c in ("ann_date", "pre_date", "actual_date", "modify_date")]
    rows = statements(spark, sf_dir).select("entity", F.col("period").alias("end_date"), F.col("qno").alias("report_type"), F.lit("2002-12-31").cast("date").alias("snapshot_date"), *dates, *inputs)
    out = FS.indicators_snapshot(staged(rows, "statements"))
    levels = ["total_mv", *[f"{c}_{s}" for s in ("q", "ttm") for c in FS.FLOW_ITEMS], *FS.LEVEL_ITEMS]
    yearly = [c for c in out.columns if c.endswith("_yoy")]
    return out.select("entity", "end_date", *[r(c, 2).alias(c) for c in levels], *[r(c, 4).alias(c) for c in _RATIO_PARTS], *[r(c, 3).alias(c) for c in yearly])


_PARTS = {"bs": (FS.BALANCE, 5), "inc": (FS.INCOME, 0), "cf": (FS.CASH, 10)}
_CONTENT = [*FS.BALANCE, *FS.INCOME, *FS.CASH]


def _content(columns: list[str], factor: str = "1") -> dict[str, str]:
    """Every statement column as another mix of revenue and cost; some are missing in third quarters."""
    out = {}
    for c in columns:
        i = _CONTENT.index(c)
        mix = f"revenue * {factor} * {3 + i * 7 % 13} / 10 + cost * {i * 5 % 7 - 3} / 10"
        out[c] = f"CASE WHEN qno <> 3 THEN {mix} END" if i % 6 == 4 else mix
    return out


def _sql_statement_columns() -> dict[str, str]:
    out = {k: SQL_FIN[k] for k in ("snaps", "known", "grid")}
    for name, (columns, days) in _PARTS.items():
        rows = f"SELECT entity, period AS end_date, CAST(known_at + INTERVAL {days} DAY AS DATE) AS f, {', '.join(f'{e} AS {c}' for c, e in _content(columns).items())} FROM statements"
        if name == "inc":
            later = ", ".join(f"{e} AS {c}" for c, e in _content(columns, "1.1").items())
            rows += f" UNION ALL SELECT entity, period, CAST(known_at + INTERVAL 200 DAY AS DATE), {later} FROM statements WHERE qno <> 2"
        out[f"{name}_rows"] = rows
        out[f"{name}_at"] = f"""SELECT * FROM (SELECT snaps.s, i.*, row_number() OVER (PARTITION BY snaps.s, entity, end_date ORDER BY f DESC) AS rn
  FROM {name}_rows i JOIN snaps ON f <= s AND end_date <= s AND end_date >= CAST(s - INTERVAL 4 YEAR AS DATE)) WHERE rn = 1"""
    out["paid"] = """SELECT entity, period AS end_date, CAST(known_at + INTERVAL 40 DAY AS DATE) AS x, 0 AS flag, 1 + qno / 10 AS cash_div, revenue / 1000 AS base_share FROM statements WHERE qno IN (2, 4)
  UNION ALL SELECT entity, period, CAST(known_at + INTERVAL 90 DAY AS DATE), 1, 2.0, revenue / 1000 FROM statements WHERE qno = 4"""
    out["div_at"] = """SELECT * FROM (SELECT snaps.s, i.*, row_number() OVER (PARTITION BY snaps.s, entity, end_date ORDER BY flag DESC, x DESC) AS rn
  FROM paid i JOIN snaps ON x <= s AND end_date <= s AND end_date >= CAST(s - INTERVAL 4 YEAR AS DATE)) WHERE rn = 1"""
    scaled = ", ".join(f"{n}_at.{c} / 10000 AS {c}" for n, (columns, _) in _PARTS.items() for c in columns)
    flags = ", ".join(f"CAST({n}_at.f IS NOT NULL AS INTEGER) AS has_{n}" for n in _PARTS)
    joins = " ".join(f"LEFT JOIN {n}_at ON {n}_at.s = g.s AND {n}_at.entity = g.entity AND {n}_at.end_date = g.end_date" for n in [*_PARTS, "div"])
    out["joined"] = f"""SELECT g.s, g.entity, g.end_date, quarter(g.end_date) AS rt, {flags}, CAST(div_at.x IS NOT NULL AS INTEGER) AS has_div, div_at.cash_div * div_at.base_share AS total_div,
  {scaled}, z.amount AS total_mv FROM grid g {joins} LEFT JOIN statements d ON d.entity = g.entity AND d.period = g.end_date AND d.known_at <= g.s
  LEFT JOIN (SELECT o_custkey AS entity, CAST(date_trunc('month', o_orderdate) AS DATE) AS m, sum(o_totalprice) AS amount FROM orders GROUP BY 1, 2) z
   ON z.entity = g.entity AND z.m = date_trunc('month', d.known_at)"""
    rows = lambda n: f"OVER (PARTITION BY s, entity ORDER BY end_date ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"
    fills = [f"last_value({c} IGNORE NULLS) {rows(1)} AS {c}" for c in FS.QUARTER_FILL]
    fills += [f"last_value(CASE WHEN rt = 4 THEN {c} END IGNORE NULLS) {rows(3)} AS {c}" for c in FS.ANNUAL_FILL]
    out["filled"] = f"SELECT * REPLACE ({', '.join(fills)}) FROM joined"
    texts: dict[str, str] = {}
    for line in FS.DERIVED.strip().splitlines():
        name, formula = (x.strip() for x in line.split("=", 1))
        texts[name] = "(" + " ".join(x if x in "+-" else texts.get(x, f"coalesce({x}, 0)") for x in formula.split()) + ")"
    out["made"] = f"SELECT *, {', '.join(f'{t} AS {n}' for n, t in texts.items())} FROM filled"
    out["valued"] = "SELECT *, total_mv + interest_bearing_liab - cash_assets AS ev, total_mv + interest_bearing_liab - cash_assets - non_operating_assets - non_operating_liab AS evnoa FROM made"
    return out


_SHOWN = [*_CONTENT, *[line.split("=")[0].strip() for line in FS.DERIVED.strip().splitlines()], "total_div", "ev", "evnoa"]


@query(
    "P6 A13 E9 E10 E18 G12 G14 D6",
    with_ctes(
        "statements",
        f"SELECT s AS snapshot_date, entity, end_date, has_bs, has_inc, has_cf, has_div, {sql_rcols([], _SHOWN, 6)} FROM valued",
        **_sql_statement_columns(),
    ),
)
def dataset_statement_columns(spark, sf_dir):
    """All columns of balance, income, cash flow and dividends as known at the snapshots, all four inputs filled, and everything derived from them."""
    from panelspark.plans.shapes import statements

    st = statements(spark, sf_dir)
    keys = ["entity", F.col("period").alias("end_date"), F.col("known_at").alias("ann_date")]

    def part(columns, days, rows=st, factor="1"):
        made = [F.expr(e).cast("double").alias(c) for c, e in _content(columns, factor).items()]
        return rows.select(*keys, F.date_add("known_at", days).alias("f_ann_date"), F.lit("0").alias("update_flag"), *made)

    parts = {n: part(columns, days) for n, (columns, days) in _PARTS.items()}
    income = parts["inc"].unionByName(part(FS.INCOME, 200, st.where("qno <> 2"), "1.1"))
    disclosure = st.select(*keys, F.col("known_at").alias("pre_date"), F.col("known_at").alias("actual_date"), F.lit(None).cast("date").alias("modify_date"))

    def dividend(rows, days, flag, cash, state="实施"):
        return rows.select(*keys[:2], F.date_add("known_at", days).alias("ex_date"), F.lit(state).alias("div_proc"), F.lit(flag).alias("update_flag"), cash.alias("cash_div"), (F.col("revenue") / 1000).alias("base_share"))

    half, year = st.where("qno in (2, 4)"), st.where("qno = 4")
    first = dividend(half, 40, "0", 1 + F.col("qno") / 10)
    dividends = first.unionByName(dividend(year, 90, "1", F.lit(2.0))).unionByName(dividend(half, 20, "2", F.lit(9.0), "预案"))
    size = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("entity"), month_start(F.col("o_orderdate").cast("date")).alias("period"))
    size = size.agg(F.sum("o_totalprice").alias("total_mv")).withColumns({c: F.col("total_mv") for c in ("total_share", "float_share", "circ_mv")})
    days = F.array(*[F.lit(d).cast("date") for d in ("1996-12-31", "1998-12-31", "2000-12-29")])
    snaps = table(spark, sf_dir, "orders").agg(F.count("*").alias("_n")).select(F.explode(days).alias("snapshot_date"))
    out = FS.statements_snapshot(disclosure, parts["bs"], income, parts["cf"], dividends, size, snaps, parts=statement_parts(spark, sf_dir))
    return out.select("snapshot_date", "entity", "end_date", "has_bs", "has_inc", "has_cf", "has_div", *[r(c, 6).alias(c) for c in _SHOWN])
