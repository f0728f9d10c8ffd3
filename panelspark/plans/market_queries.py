"""Market state, daily signals, alarms, regimes and crowding on the daily bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.datasets import market_signals as MS
from panelspark.datasets import market_state as ST
from panelspark.functions.dates import month_start
from panelspark.functions.numeric import ratio
from panelspark.plans.registry import query
from panelspark.plans.shapes import FLOW_AMOUNTS, daily_bars, index_bars, r, rnd, sql_rcols, supplier_region, table, with_ctes
from panelspark.plans.window_queries import over
from panelspark.sources.sinks import staged

BY = "PARTITION BY entity ORDER BY period"

STATE = [c for c in ST.MEASURES if c not in ("ma250", "pct_above_ma250", "idx_ret_3m", "idx_volatility_60", "dv_ttm_median", "pb_pct_5y", "pb_pe_divergence")]
DIGITS = {"idx_close": 2, "ma60": 3, "idx_amount": 2, "north_money": 2, "margin_balance": 2, "pe_ttm_median": 4, "pb_median": 4, "turnover_rate_median": 3}


def _rounded_sql(cols):
    return ", ".join(f"{rnd(c, DIGITS.get(c, 5))} AS {c}" for c in cols)


_TOTAL = " + ".join(FLOW_AMOUNTS)
_BIG = "buy_elg_amount + sell_elg_amount + buy_lg_amount + sell_lg_amount"

STATE_CTES = {
    "fd": """SELECT l_suppkey AS entity, CAST(l_shipdate AS DATE) AS period, """
    + ", ".join(
        f"sum(CASE WHEN l_returnflag = '{f}' AND {cond} THEN l_extendedprice ELSE 0 END) AS {side}_{band}_amount"
        for side, f in (("buy", "N"), ("sell", "R"))
        for band, cond in (("sm", "l_quantity <= 12"), ("md", "l_quantity > 12 AND l_quantity <= 25"), ("lg", "l_quantity > 25 AND l_quantity <= 38"), ("elg", "l_quantity > 38"))
    )
    + " FROM lineitem GROUP BY 1, 2",
    "pan": f"""SELECT d.*, CAST(date_trunc('month', period) AS DATE) AS month, close / vol AS pe, amount / vol / 100 AS pb,
  {_TOTAL} AS total, {_BIG} AS big, buy_sm_amount + buy_md_amount + buy_lg_amount + buy_elg_amount
   - sell_sm_amount - sell_md_amount - sell_lg_amount - sell_elg_amount AS net
  FROM dbars d JOIN fd USING (entity, period)""",
    "px": f"""SELECT *, CASE WHEN date_trunc('month', lag(period) OVER ({BY})) = month THEN close / lag(close) OVER ({BY}) - 1 END AS ret,
  CASE WHEN count(close) {over(60)} = 60 THEN avg(close) {over(60)} END AS ma60 FROM pan""",
    "mem": """SELECT DISTINCT month, 'all' AS dim, entity FROM pan UNION ALL
  SELECT DISTINCT month, 'g' || grp, p.entity FROM pan p JOIN region_of USING (entity) WHERE grp < 2""",
    "held": "SELECT m.dim, x.* FROM px x JOIN mem m ON m.month = x.month AND m.entity = x.entity",
    "one": """SELECT month, dim, entity, arg_min(close, period) AS a, arg_max(close, period) AS z, arg_max(ma60, period) AS arg60,
  last(ma60 ORDER BY period) AS ma60, sum(amount) AS amount, sum(net) AS net, exp(sum(ln(1 + ret))) - 1 AS mret FROM held GROUP BY 1, 2, 3""",
    "per": """SELECT month, dim, count(*) FILTER (WHERE z > a) AS up, count(*) FILTER (WHERE z < a) AS dn,
  avg(CASE WHEN ma60 IS NOT NULL THEN CAST(z > ma60 AS DOUBLE) END) AS pct_above_ma60,
  CASE WHEN count(mret) >= 5 THEN stddev_samp(mret) END AS cross_sectional_vol,
  CASE WHEN count(*) >= 5 THEN avg(CAST(net > 0 AS DOUBLE)) END AS breadth FROM one GROUP BY 1, 2""",
    "gin": """SELECT month, dim, CASE WHEN n >= 5 AND s > 0 THEN 2 * rs / (n * s) - (n + 1) / n END AS amount_gini FROM (
  SELECT month, dim, CAST(count(*) AS DOUBLE) AS n, sum(amount) AS s, sum(rn * amount) AS rs FROM (
   SELECT *, row_number() OVER (PARTITION BY month, dim ORDER BY amount) AS rn FROM one) GROUP BY 1, 2)""",
    "flo": """SELECT month, dim, sum(n) AS n, CASE WHEN sum(total) > 0 THEN sum(net) / sum(total) END AS net_inflow_ratio,
  CASE WHEN count(*) >= 5 THEN avg(CAST(net > 0 AS DOUBLE)) END AS inflow_direction_pct,
  CASE WHEN count(*) >= 5 AND stddev_samp(net) > 0 THEN avg(net) / stddev_samp(net) END AS inflow_stability,
  CASE WHEN sum(total) > 0 THEN sum(big) / sum(total) END AS institutional_pct FROM (
   SELECT month, dim, period, sum(net) AS net, sum(total) AS total, sum(big) AS big, count(*) AS n FROM held GROUP BY 1, 2, 3) GROUP BY 1, 2""",
    "valu": """SELECT month, dim, median(pe) AS pe_ttm_median, median(pb) AS pb_median, median(vol) AS turnover_rate_median,
  CASE WHEN count(pe) >= 10 THEN quantile_cont(pe, 0.75) / nullif(quantile_cont(pe, 0.25), 0) END AS pe_dispersion FROM held GROUP BY 1, 2""",
    "cor": """SELECT a.month, a.dim, CASE WHEN a.n >= 20 AND b.s > 0 THEN a.v / (b.s * b.s) END AS avg_correlation FROM (
   SELECT month, dim, var_samp(m) AS v, sum(c) AS n FROM (SELECT month, dim, period, avg(ret) AS m, count(*) AS c FROM held
    WHERE ret IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2) a JOIN (
   SELECT month, dim, avg(s) AS s FROM (SELECT month, dim, entity, stddev_samp(ret) AS s FROM held WHERE ret IS NOT NULL
    GROUP BY 1, 2, 3) GROUP BY 1, 2) b ON a.month = b.month AND a.dim = b.dim""",
    "snap": "SELECT month, entity, arg_max(pe, period) AS pe FROM pan GROUP BY 1, 2",
    "hist": """SELECT m.month, m.dim, s.month AS past, median(s.pe) AS v FROM mem m JOIN snap s ON s.entity = m.entity
  AND s.month <= m.month AND s.month >= m.month - INTERVAL 59 MONTH GROUP BY 1, 2, 3""",
    "pct": """SELECT h.month, h.dim, avg(CAST(h.v < u.pe_ttm_median AS DOUBLE)) AS pe_pct_5y FROM hist h
  JOIN valu u ON u.month = h.month AND u.dim = h.dim GROUP BY 1, 2""",
    "ix": f"""SELECT entity, period, close, amount, CAST(date_trunc('month', period) AS DATE) AS month, row_number() OVER ({BY}) AS rn,
  close / lag(close) OVER ({BY}) - 1 AS ret,
  CASE WHEN date_trunc('month', lag(period) OVER ({BY})) = date_trunc('month', period) THEN close / lag(close) OVER ({BY}) - 1 END AS iret,
  CASE WHEN count(close) {over(60)} = 60 THEN avg(close) {over(60)} END AS ma60 FROM ibars""",
    "ix2": f"""SELECT *, CASE WHEN rn >= 20 THEN stddev_samp(ret) {over(19)} * sqrt(252) END AS vol20,
  list(close) OVER ({BY} RANGE BETWEEN INTERVAL 364 DAY PRECEDING AND CURRENT ROW) AS p FROM ix""",
    "im0": """SELECT entity, month, max(period) AS period, arg_max(close, period) AS idx_close, last(ma60 ORDER BY period) AS ma60,
  last(vol20 ORDER BY period) AS idx_volatility_20, last(p ORDER BY period) AS p, sum(amount) AS idx_amount,
  CASE WHEN count(*) >= 10 AND count(*) FILTER (WHERE iret < 0) >= 3 AND count(*) FILTER (WHERE iret > 0) >= 3
   THEN stddev_samp(iret) FILTER (WHERE iret < 0) / stddev_samp(iret) FILTER (WHERE iret > 0) END AS downside_vol_ratio
  FROM ix2 GROUP BY 1, 2""",
    "im": """SELECT *, CASE WHEN len(p) >= 2 THEN list_min(list_transform(list_zip(p, range(1, len(p) + 1)), lambda s: s[1] / list_max(p[1:s[2]]) - 1)) END
   AS max_drawdown_1y, idx_close / lag(idx_close) OVER (PARTITION BY entity ORDER BY month) - 1 AS idx_ret_1m,
  idx_close / lag(idx_close, 12) OVER (PARTITION BY entity ORDER BY month) - 1 AS idx_ret_12m,
  (SELECT CASE WHEN count(*) >= 3 THEN avg(CAST(o.idx_amount < im0.idx_amount AS DOUBLE)) END FROM im0 o WHERE o.entity = im0.entity
   AND o.month <= im0.month AND o.month > im0.month - INTERVAL 3 MONTH) AS amount_pct_3m,
  (SELECT CASE WHEN count(*) >= 3 THEN avg(CAST(o.idx_amount < im0.idx_amount AS DOUBLE)) END FROM im0 o WHERE o.entity = im0.entity
   AND o.month <= im0.month AND o.month > im0.month - INTERVAL 12 MONTH) AS amount_pct_1y FROM im0""",
    "ext": """SELECT month, sum(north) AS north_money, arg_max(bal, d) AS margin_balance FROM (
   SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(o_orderdate AS DATE) AS d,
    sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS north, sum(o_totalprice) AS bal FROM orders GROUP BY 1, 2) GROUP BY 1""",
    "lim": """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(count(*) AS DOUBLE) AS limit_up_count FROM lineitem
  WHERE l_discount >= 0.09 GROUP BY 1""",
}


@query(
    "P8 E12 F3 F5 F6 F7 F8 F9 F10 F11 F12 G1 G39 D3 C13",
    with_ctes(
        "dbars ibars",
        f"""SELECT i.month, i.dim, {_rounded_sql(STATE)} FROM (SELECT im.*, CASE im.entity WHEN 4 THEN 'all' WHEN 0 THEN 'g0' ELSE 'g1' END AS dim
  FROM im WHERE entity IN (0, 1, 4)) i LEFT JOIN (SELECT per.*, up / nullif(up + dn, 0) AS profit_ratio, up / nullif(dn, 0) AS up_down_ratio FROM per) per
  USING (month, dim) LEFT JOIN gin USING (month, dim)
 LEFT JOIN (SELECT month, dim, CASE WHEN n >= 100 THEN net_inflow_ratio END AS net_inflow_ratio, CASE WHEN n >= 100 THEN inflow_direction_pct END
   AS inflow_direction_pct, CASE WHEN n >= 100 THEN inflow_stability END AS inflow_stability, CASE WHEN n >= 100 THEN institutional_pct END AS institutional_pct,
   CASE WHEN n >= 100 THEN breadth END AS inflow_breadth FROM flo JOIN per USING (month, dim)) flo USING (month, dim)
 LEFT JOIN valu USING (month, dim) LEFT JOIN cor USING (month, dim) LEFT JOIN pct USING (month, dim)
 LEFT JOIN (SELECT 'all' AS dim, * FROM ext) ext USING (month, dim) LEFT JOIN (SELECT 'all' AS dim, * FROM lim) lim USING (month, dim)""",
        **STATE_CTES,
    ),
)
def dataset_market_state(spark, sf_dir):
    d = daily_bars(spark, sf_dir, flow=True)
    buys, sells = [sum((F.col(c) for c in FLOW_AMOUNTS if c.startswith(s)), F.lit(0.0)) for s in ("buy", "sell")]
    panel = d.select(
        "entity", "period", "close", "amount", ratio("close", "vol").alias("pe"), (ratio("amount", "vol") / 100).alias("pb"), F.col("vol").alias("dv"),
        F.col("vol").alias("turnover"), (buys - sells).alias("net_amount"), *FLOW_AMOUNTS,
    )
    # the entities and months of the panel, read from the lines: the panel itself is made once
    seen = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("entity"), month_start(F.col("l_shipdate").cast("date")).alias("month")).distinct()
    regions = seen.join(supplier_region(spark, sf_dir).where("grp < 2"), "entity")
    members = seen.select("month", F.lit("all").alias("dim"), "entity").unionByName(
        regions.select("month", F.concat(F.lit("g"), "grp").alias("dim"), "entity")
    )
    index = index_bars(spark, sf_dir).withColumnRenamed("entity", "index_key")
    mapping = table(spark, sf_dir, "region").where("r_regionkey in (0, 1, 4)").select(
        F.col("r_regionkey").alias("index_key"),
        F.when(F.col("r_regionkey") == 4, "all").otherwise(F.concat(F.lit("g"), "r_regionkey")).alias("dim"),
    )
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("period"), "o_orderstatus", "o_totalprice")
    north = o.where("o_orderstatus = 'O'").select("period", F.col("o_totalprice").alias("north_money"))
    margin = o.select("period", F.col("o_totalprice").alias("balance"))
    limits = table(spark, sf_dir, "lineitem").where("l_discount >= 0.09").select(F.col("l_shipdate").cast("date").alias("period"))
    out = ST.market_state(index, panel, members, mapping, north=north, margin=margin, limits=limits, stage=staged)
    return out.select("month", "dim", *[r(c, DIGITS.get(c, 5)).alias(c) for c in STATE])


# ---- daily signals, alarms, regimes, crowding ------------------------------------------------

D = "ORDER BY period"


def dover(n: int) -> str:
    return f"OVER ({D} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


SIGNAL_CTES = {
    "pr": f"""SELECT *, close / lag(close) OVER ({BY}) - 1 AS ret, CASE WHEN count(close) {over(20)} = 20 THEN avg(close) {over(20)} END AS ma,
  CASE WHEN count(close) {over(20)} = 20 THEN max(close) {over(20)} END AS hi FROM dbars""",
    "ps": f"SELECT *, CASE WHEN count(ret) {over(20)} = 20 THEN stddev_samp(ret) {over(20)} END AS sd FROM pr",
    "mk": """SELECT period, avg(CASE WHEN ma IS NOT NULL THEN CAST(close > ma AS DOUBLE) END) AS above_ma_20d_pct,
  avg(CASE WHEN hi IS NOT NULL THEN CAST(close >= hi AS DOUBLE) END) AS new_high_20d_pct, sum(amount) AS total_turnover,
  sum(CASE WHEN ret > 0 THEN vol ELSE 0 END) / sum(vol) AS up_vol_ratio, avg(CAST(ret > 0 AS DOUBLE)) AS up_ratio,
  avg(sd) * sqrt(252) AS average_volatility FROM ps GROUP BY 1""",
    "mg": """SELECT CAST(o_orderdate AS DATE) AS period, sum(o_totalprice) AS margin_balance,
  sum(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice ELSE 0 END) AS bought,
  sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE -o_totalprice END) / 1e4 AS north_money FROM orders GROUP BY 1""",
    "lm": """SELECT CAST(l_shipdate AS DATE) AS period, count(*) FILTER (WHERE l_discount >= 0.09) AS limit_up_count,
  count(*) FILTER (WHERE l_discount < 0.09 AND l_tax >= 0.05) AS limit_down_count FROM lineitem WHERE l_discount >= 0.09 OR l_tax >= 0.05 GROUP BY 1""",
    "sg0": f"""SELECT i.period, i.close AS index_close, i.close / i.vol AS pe_ttm, mk.* EXCLUDE (period), margin_balance, bought, north_money,
  limit_up_count, limit_down_count, i.close / lag(i.close) OVER (ORDER BY i.period) - 1 AS index_pct_chg
  FROM ibars i LEFT JOIN mk USING (period) LEFT JOIN mg USING (period) LEFT JOIN lm USING (period) WHERE i.entity = 0""",
    "sg": f"""SELECT *, CASE WHEN count(total_turnover) {dover(20)} = 20 THEN total_turnover / avg(total_turnover) {dover(20)} END AS turnover_ma_ratio,
  bought / nullif(total_turnover, 0) AS margin_buy_ratio,
  CASE WHEN count(index_pct_chg) {dover(20)} = 20 THEN stddev_samp(index_pct_chg) {dover(20)} * sqrt(252) END AS index_vol_20d,
  CASE WHEN len(list(pe_ttm) {dover(750)}) >= 2 THEN len(list_filter(list(pe_ttm) {dover(750)}, lambda x: x < pe_ttm)) / (len(list(pe_ttm) {dover(750)}) - 1) END
   AS pe_percentile_3y, 1 / nullif(pe_ttm, 0) - 0.03 AS erp_5y FROM sg0""",
}
SIGNALS = [
    "index_close", "index_pct_chg", "above_ma_20d_pct", "new_high_20d_pct", "total_turnover", "turnover_ma_ratio", "up_vol_ratio",
    "margin_balance", "margin_buy_ratio", "index_vol_20d", "average_volatility", "pe_ttm", "pe_percentile_3y", "erp_5y", "north_money",
]
SDIG = {"index_close": 2, "total_turnover": 2, "margin_balance": 2, "pe_ttm": 4, "north_money": 4}


def signals(spark, sf_dir):
    index = index_bars(spark, sf_dir).where("entity = 0").select("period", "close", ratio("close", "vol").alias("pe"))
    o = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("period"), "o_orderstatus", "o_orderpriority", "o_totalprice")
    margin = o.select(
        "period", F.col("o_totalprice").alias("balance"), F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")).otherwise(0.0).alias("bought")
    )
    north = o.select("period", (F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).otherwise(-F.col("o_totalprice")) / 1e4).alias("net"))
    kind = F.when(F.col("l_discount") >= 0.09, "U").when(F.col("l_tax") >= 0.05, "D")
    limits = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("period"), kind.alias("kind")).where("kind is not null")
    return staged(MS.daily_signals(daily_bars(spark, sf_dir), index, margin=margin, north=north, limits=limits), "signals")


@query(
    "Q5 P15",
    with_ctes(
        "dbars ibars",
        f"SELECT period, {', '.join(f'{rnd(c, SDIG.get(c, 5))} AS {c}' for c in SIGNALS)}, limit_up_count, limit_down_count FROM sg",
        **SIGNAL_CTES,
    ),
)
def dataset_daily_signals(spark, sf_dir):
    out = signals(spark, sf_dir)
    return out.select("period", *[r(c, SDIG.get(c, 5)).alias(c) for c in SIGNALS], "limit_up_count", "limit_down_count")


ALARM_CTES = {
    **SIGNAL_CTES,
    "al0": f"""SELECT *, max(index_close) {dover(60)} AS peak, quantile_cont(index_vol_20d, 0.95) {dover(750)} AS volhi,
  margin_balance / nullif(lag(margin_balance, 5) OVER ({D}), 0) AS mchg, row_number() OVER ({D}) AS rn,
  coalesce(index_pct_chg < 0, false) AS fall FROM sg""",
    "al1": f"SELECT *, rn - coalesce(max(CASE WHEN NOT fall THEN rn END) OVER ({D}), 0) AS run FROM al0",
    "al": """SELECT period, CAST(coalesce(limit_down_count / nullif(limit_up_count, 0) > 5, false) AS INTEGER) AS limit_down_ratio_hi,
  CAST(coalesce(limit_down_count > 100, false) AS INTEGER) AS limit_down_count_hi, CAST(coalesce(turnover_ma_ratio > 2.5, false) AS INTEGER) AS turnover_spike,
  CAST(coalesce(index_vol_20d > volhi, false) AS INTEGER) AS vol_spike, CAST(coalesce(up_ratio < 0.1, false) AS INTEGER) AS breadth_crash,
  CAST(coalesce(mchg < 0.95, false) AS INTEGER) AS margin_call, CAST(coalesce(north_money < -100, false) AS INTEGER) AS north_flight,
  CAST(coalesce(index_close / peak - 1 < -0.2, false) AS INTEGER) AS drawdown_20pct, CAST(run > 5 AS INTEGER) AS consecutive_down,
  CAST(coalesce(pe_percentile_3y < 0.1, false) AS INTEGER) AS pe_below_10pct FROM al1""",
    "alarm": f"SELECT *, {' + '.join(MS.ALARMS)} AS alarm_count FROM al",
}


@query(
    "Q6",
    with_ctes(
        "dbars ibars",
        f"""SELECT period, {', '.join(MS.ALARMS)}, CAST(alarm_count AS INTEGER) AS alarm_count,
 CAST(CASE WHEN alarm_count >= 5 THEN 3 WHEN alarm_count >= 3 THEN 2 WHEN alarm_count >= 1 THEN 1 ELSE 0 END AS INTEGER) AS panic_level FROM alarm""",
        **ALARM_CTES,
    ),
)
def dataset_alarms(spark, sf_dir):
    return MS.alarms(signals(spark, sf_dir))


@query(
    "Q7",
    with_ctes(
        "dbars ibars",
        f"""SELECT month, period, {rnd('s')} AS direction_score, dl AS direction_label, {rnd('b')} AS breadth_score, bl AS breadth_label,
 CASE WHEN reason IN ('volatility', 'alarm') THEN 'CHAOS' WHEN reason = 'valuation' THEN 'SIDEWAYS' ELSE base END AS regime, reason AS override_reason FROM (
 SELECT *, CASE WHEN base IS NULL THEN NULL WHEN wild THEN 'volatility' WHEN alarms >= 3 AND base = 'BULL' THEN 'alarm'
  WHEN cheap AND base = 'BEAR' THEN 'valuation' END AS reason FROM (
 SELECT *, CASE WHEN dl = 'UP' AND bl = 'BROAD' THEN 'BULL' WHEN dl = 'UP' THEN 'CHAOS' WHEN dl = 'DOWN' AND bl = 'BROAD' THEN 'BEAR'
  WHEN dl IS NOT NULL THEN 'SIDEWAYS' END AS base FROM (
 SELECT *, CASE WHEN s IS NOT NULL THEN coalesce(last_value(sure IGNORE NULLS) OVER (ORDER BY month ROWS UNBOUNDED PRECEDING),
   CASE WHEN s > 0.02 THEN 'UP' WHEN s < -0.02 THEN 'DOWN' ELSE 'FLAT' END) END AS dl,
  CASE WHEN b >= 0.5 THEN 'BROAD' WHEN b IS NOT NULL THEN 'NARROW' END AS bl FROM (
 SELECT *, CASE WHEN s > 0.03 THEN 'UP' WHEN s < -0.03 THEN 'DOWN' WHEN abs(s) < 0.01 THEN 'FLAT' END AS sure FROM (
 SELECT month, period, c / lag(c) OVER (ORDER BY month) - 1 AS s, b, coalesce(cheap, false) AS cheap, coalesce(wild, false) AS wild, alarms FROM (
 SELECT date_trunc('month', period)::DATE AS month, max(period) AS period, arg_max(index_close, period) AS c,
  last(above_ma_20d_pct ORDER BY period) AS b, last(cheap ORDER BY period) AS cheap, last(wild ORDER BY period) AS wild, max(alarm_count) AS alarms FROM (
 SELECT sg.*, alarm_count, pe_percentile_3y < 0.1 AND erp_5y > quantile_cont(erp_5y, 0.9) {dover(1250).replace('ORDER BY period', 'ORDER BY sg.period')} AS cheap,
  index_vol_20d > quantile_cont(index_vol_20d, 0.95) {dover(750).replace('ORDER BY period', 'ORDER BY sg.period')} AS wild FROM sg LEFT JOIN alarm USING (period))
 GROUP BY 1)))))) """,
        **ALARM_CTES,
    ),
)
def dataset_regime_labels(spark, sf_dir):
    s = signals(spark, sf_dir)
    out = MS.regime_labels(s, staged(MS.alarms(s), "alarms"))
    return out.withColumns({c: r(c) for c in ("direction_score", "breadth_score")})


@query(
    "Q8 F6",
    with_ctes(
        "ibars",
        f"""SELECT week, period, {sql_rcols([], ['hhi_weekly', 'pe_percentile_cap', 'gini_weekly', 'ret_dispersion', 'crowding_score'], 5)},
 CASE WHEN crowding_score < 0.3 THEN 1.0 WHEN crowding_score < 0.5 THEN 0.8 WHEN crowding_score < 0.7 THEN 0.5 ELSE 0.0 END AS narrative_multiplier FROM (
 SELECT *, 0.3 * coalesce((hhi_weekly - min(hhi_weekly) OVER s) / nullif(max(hhi_weekly) OVER s - min(hhi_weekly) OVER s, 0), 0)
  + 0.25 * coalesce(pe_percentile_cap, 0) + 0.25 * coalesce(gini_weekly, 0)
  + 0.2 * coalesce((ret_dispersion - min(ret_dispersion) OVER s) / nullif(max(ret_dispersion) OVER s - min(ret_dispersion) OVER s, 0), 0) AS crowding_score
 FROM wk LEFT JOIN gi USING (week) WINDOW s AS (ORDER BY week ROWS UNBOUNDED PRECEDING))""",
        sx=f"""SELECT entity, period, close, amount, date_trunc('week', period)::DATE AS week, close / lag(close, 20) OVER ({BY}) - 1 AS r20,
  CASE WHEN len(list(pe) {over(750)}) > 1 THEN len(list_filter(list(pe) {over(750)}, lambda x: x < pe)) / (len(list(pe) {over(750)}) - 1) END AS pct
  FROM (SELECT *, close / vol AS pe FROM ibars)""",
        dy="SELECT week, period, sum(amount * amount) / (sum(amount) * sum(amount)) AS hhi, max(pct) AS cap, stddev_samp(r20) AS disp FROM sx GROUP BY 1, 2",
        wk="""SELECT week, max(period) AS period, avg(hhi) AS hhi_weekly, last(cap ORDER BY period) AS pe_percentile_cap,
  last(disp ORDER BY period) AS ret_dispersion FROM dy GROUP BY 1""",
        en="""SELECT entity, week, abs(c / lag(c) OVER (PARTITION BY entity ORDER BY week) - 1) AS wr FROM (
  SELECT entity, week, arg_max(close, period) AS c FROM sx GROUP BY 1, 2)""",
        gi="""SELECT week, CASE WHEN n >= 2 AND s > 0 THEN 2 * rs / (n * s) - (n + 1) / n END AS gini_weekly FROM (
  SELECT week, CAST(count(*) AS DOUBLE) AS n, sum(wr) AS s, sum(rn * wr) AS rs FROM (
   SELECT *, row_number() OVER (PARTITION BY week ORDER BY wr) AS rn FROM en WHERE wr IS NOT NULL) GROUP BY 1)""",
    ),
)
def dataset_weekly_crowding(spark, sf_dir):
    sectors = staged(
        index_bars(spark, sf_dir).select(F.col("entity").alias("sector"), "period", "close", "amount", ratio("close", "vol").alias("pe")), "sectors"
    )
    out = MS.weekly_crowding(sectors)
    cols = ["hhi_weekly", "pe_percentile_cap", "gini_weekly", "ret_dispersion", "crowding_score"]
    return out.select("week", "period", *[r(c, 5).alias(c) for c in cols], "narrative_multiplier")
