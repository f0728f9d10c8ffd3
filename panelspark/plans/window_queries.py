"""Per-entity window queries on monthly, daily and index bars."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from panelspark.functions.numeric import guarded_ratio, ratio
from panelspark.operators import slices as S
from panelspark.operators import windows as W
from panelspark.plans.registry import query
from panelspark.plans.shapes import (
    bars,
    daily_bars,
    index_bars,
    r,
    rcols,
    rnd,
    sql_rcols,
    statements,
    table,
    with_ctes,
)

BY = "PARTITION BY entity ORDER BY period"


def over(n: int) -> str:
    return f"OVER ({BY} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(agg: str, col: str, n: int, least: int | None = None) -> str:
    return f"CASE WHEN count({col}) {over(n)} >= {least or n} THEN {agg}({col}) {over(n)} END"


def w():
    return W.by_time("entity", "period")


@query(
    "G1 G2 G3",
    with_ctes(
        "bars",
        f"""SELECT entity, period, {sql_rcols([], ['ma20', 'sd20'], 4)},
 CAST(coalesce(close > ma20, false) AS DOUBLE) AS above FROM (
 SELECT entity, period, close, {full('avg', 'close', 20)} AS ma20, {full('stddev_samp', 'close', 20)} AS sd20 FROM bars)""",
    ),
)
def window_moving_average(spark, sf_dir):
    b = bars(spark, sf_dir).withColumns(
        {"ma20": W.moving_average("close", w(), 20), "sd20": W.moving_std("close", w(), 20)}
    )
    return b.withColumn("above", W.above_average_flag("close", "ma20")).select(
        "entity", "period", r("ma20", 4).alias("ma20"), r("sd20", 4).alias("sd20"), "above"
    )


def _sql_share(v: str, n: int, least: int) -> str:
    frame = over(n)
    return f"""CASE WHEN cnt_{v}_{n} >= {least} THEN {rnd(
        f"(len(list_filter(l_{v}_{n}, lambda x: x < {v})) + (len(list_filter(l_{v}_{n}, lambda x: x = {v})) - 1) / 2.0)"
        f" / nullif(cnt_{v}_{n} - 1, 0)")} END"""


@query(
    "G4 L3",
    with_ctes(
        "dbars",
        "SELECT entity, period, "
        + ", ".join(f"{_sql_share(v, n, 120)} AS {v}_tsrank_{lab}" for v in ("close", "vol") for lab, n in (("1y", 250), ("2y", 500)))
        + " FROM (SELECT entity, period, close, vol, "
        + ", ".join(
            f"list({v}) {over(n)} AS l_{v}_{n}, count({v}) {over(n)} AS cnt_{v}_{n}" for v in ("close", "vol") for n in (250, 500)
        )
        + " FROM dbars)",
    ),
)
def window_rolling_rank_share(spark, sf_dir):
    out = W.rolling_rank_share(
        daily_bars(spark, sf_dir).select("entity", "period", "close", "vol"),
        "entity",
        "period",
        ["close", "vol"],
        {"1y": 250, "2y": 500},
    )
    return rcols(out, ["entity", "period"], [c for c in out.columns if "tsrank" in c])


@query(
    "G5",
    with_ctes(
        "bars",
        f"""SELECT entity, period, {rnd('close / lag(close) OVER w - 1')} AS ret,
 {rnd('vol / nullif(lag(vol, 2) OVER w, 0) - 1')} AS vol_chg, {rnd('lead(close, 2) OVER w', 2)} AS close_ahead
 FROM bars WINDOW w AS ({BY})""",
    ),
)
def window_lag_lead(spark, sf_dir):
    return bars(spark, sf_dir).select(
        "entity",
        "period",
        r(W.change("close", w())).alias("ret"),
        r(W.change("vol", w(), 2)).alias("vol_chg"),
        r(F.lead("close", 2).over(w()), 2).alias("close_ahead"),
    )


SQL_TTM = f"""
 SELECT entity, period, qno, revenue, revenue_q, {full('sum', 'revenue_q', 4)} AS revenue_ttm,
  avg(revenue) {over(4)} AS revenue_avg FROM (
 SELECT *, CASE WHEN qno = 1 THEN revenue ELSE revenue - lag(revenue) OVER ({BY}) END AS revenue_q FROM statements)"""


def trailing_statements(spark, sf_dir):
    s = statements(spark, sf_dir).withColumn("revenue_q", W.single_period("revenue", F.col("qno") == 1, w()))
    return s.withColumns(
        {
            "revenue_ttm": W.rolling(F.sum, "revenue_q", w(), 4),
            "revenue_avg": W.rolling(F.avg, "revenue", w(), 4, 1),
        }
    )


@query(
    "G6 G7 G8",
    with_ctes("statements", f"SELECT {sql_rcols(['entity', 'period'], ['revenue_q', 'revenue_ttm', 'revenue_avg'], 3)} FROM t", t=SQL_TTM),
)
def window_trailing_quarters(spark, sf_dir):
    return rcols(trailing_statements(spark, sf_dir), ["entity", "period"], ["revenue_q", "revenue_ttm", "revenue_avg"], 3)


@query(
    "G9",
    with_ctes(
        "statements",
        f"""SELECT entity, period, CASE WHEN abs(lag(revenue_q, 4) OVER w) > 100
 THEN {rnd('(revenue_q - lag(revenue_q, 4) OVER w) / abs(lag(revenue_q, 4) OVER w)')} END AS yoy FROM t
 WINDOW w AS ({BY})""",
        t=SQL_TTM,
    ),
)
def window_year_over_year(spark, sf_dir):
    t = trailing_statements(spark, sf_dir)
    return t.select("entity", "period", r(W.year_over_year("revenue_q", w(), 1e2)).alias("yoy"))


@query(
    "G10",
    """SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM (
 SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
 WHERE rn = 1""",
)
def window_latest_per_key(spark, sf_dir):
    latest = W.latest_per_key(
        table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]
    )
    return latest.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")


@query(
    "G11",
    """SELECT o_custkey, o_orderkey FROM (
 SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
 WHERE rn <= 5""",
)
def window_last_rows_per_key(spark, sf_dir):
    last = W.top_rows_per_key(
        table(spark, sf_dir, "orders"), ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")], 5
    )
    return last.select("o_custkey", "o_orderkey")


SQL_HOLES = "SELECT entity, period, qno, CASE WHEN qno <> 2 AND revenue < 200000 THEN revenue END AS v FROM statements"


@query(
    "G12 G13 G14",
    with_ctes(
        "statements",
        f"""SELECT entity, period, {rnd(f'last_value(v IGNORE NULLS) OVER ({BY} ROWS BETWEEN 1 PRECEDING AND CURRENT ROW)', 2)} AS fill1,
 {rnd(f'last_value(v IGNORE NULLS) OVER ({BY} ROWS UNBOUNDED PRECEDING)', 2)} AS fill_all,
 {rnd(f'last_value(CASE WHEN qno = 4 THEN v END IGNORE NULLS) OVER ({BY} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)', 2)}
  AS annual FROM h""",
        h=SQL_HOLES,
    ),
)
def window_forward_fill(spark, sf_dir):
    h = statements(spark, sf_dir).withColumn(
        "v", F.when((F.col("qno") != 2) & (F.col("revenue") < 200000), F.col("revenue"))
    )
    return h.select(
        "entity",
        "period",
        r(W.forward_fill("v", w(), 1), 2).alias("fill1"),
        r(W.forward_fill("v", w()), 2).alias("fill_all"),
        r(W.annual_hold("v", F.col("qno") == 4, w()), 2).alias("annual"),
    )


def _sql_forward(horizons):
    cols = []
    for n in horizons:
        cols.append(f"{rnd(f'p{n} / nullif(p0, 0) - 1')} AS fwd_ret_{n}")
        cols.append(f"CAST(coalesce(h0, 1) = 1 OR coalesce(h{n}, 1) = 1 AS INTEGER) AS is_halted_{n}")
    looks = []
    for n in horizons:
        looks.append((n, n + 1))
    joins = " ".join(
        f"ASOF LEFT JOIN idx_bars x{n} ON x{n}.entity = b.entity AND b.i + {k} >= x{n}.i"
        for n, k in [(0, 1), *looks]
    )
    pick = ", ".join(
        f"CASE WHEN b.i + {k} <= b.last_i THEN x{n}.close END AS p{n}, CASE WHEN b.i + {k} <= b.last_i THEN x{n}.halted END AS h{n}"
        for n, k in [(0, 1), *looks]
    )
    return f"SELECT entity, period, {', '.join(cols)} FROM (SELECT b.entity, b.period, {pick} FROM idx_bars b {joins})"


@query(
    "G15 P13 A4",
    with_ctes(
        "dbars",
        _sql_forward((1, 5, 20)),
        days="SELECT period, row_number() OVER (ORDER BY period) AS i, count(*) OVER () AS last_i FROM (SELECT DISTINCT period FROM dbars)",
        idx_bars="SELECT b.*, d.i, d.last_i, CAST(vol <= 3 AS INTEGER) AS halted FROM dbars b JOIN days d USING (period)",
    ),
)
def window_forward_returns(spark, sf_dir):
    b = daily_bars(spark, sf_dir).select("entity", "period", "close", (F.col("vol") <= 3).cast("int").alias("halted"))
    out = W.forward_returns(b, "entity", "period", "close", [1, 5, 20], halted="halted")
    flags = [f"is_halted_{n}" for n in (1, 5, 20)]
    return out.select("entity", "period", *[r(f"fwd_ret_{n}").alias(f"fwd_ret_{n}") for n in (1, 5, 20)], *flags)


@query(
    "G27 G28 P11",
    with_ctes(
        "ibars",
        f"""SELECT entity, period, {', '.join(
            f"{rnd(f'ret_{n}')} AS ret_{n}, {rnd(f'r2_{n}')} AS r2_{n}, {rnd(f'beta_{n}', 3)} AS beta_{n}, {rnd(f'sign(ret_{n}) * abs(ret_{n}) * r2_{n}')} AS score_{n}" for n in (20, 60))}
 FROM (SELECT entity, period, rn, {', '.join(
            f"CASE WHEN rn >= {n} THEN ln(close / lag(close, {n - 1}) OVER ({BY})) END AS ret_{n},"
            f"CASE WHEN rn >= {n} THEN regr_r2(close, rn) {over(n)} END AS r2_{n},"
            f"CASE WHEN rn >= {n} THEN regr_slope(close, rn) {over(n)} END AS beta_{n}" for n in (20, 60))}
 FROM (SELECT *, CAST(row_number() OVER ({BY}) AS DOUBLE) AS rn FROM ibars)) WHERE rn >= 70""",
    ),
)
def window_trend_momentum(spark, sf_dir):
    from panelspark.datasets.index_factors import trend_momentum

    out = trend_momentum(index_bars(spark, sf_dir))
    keep = [f"{k}_{n}" for n in (20, 60) for k in ("ret", "r2", "beta", "score")]
    return out.select("entity", "period", *[r(c, 3 if c.startswith("beta") else 6).alias(c) for c in keep])


@query(
    "G29 P11",
    with_ctes(
        "ibars",
        f"""SELECT entity, period, {sql_rcols([], ['ret_20', 'ret_60'])}, {rnd('ret_20 - ret_60')} AS diff,
 {rnd('ret_20 / nullif(ret_60, 0)', 4)} AS share, CASE WHEN ret_20 IS NOT NULL AND ret_60 IS NOT NULL
 THEN CAST(ret_20 > 0 AND ret_60 > 0 AS INTEGER) END AS trend_ok,
 CASE WHEN ret_20 IS NOT NULL AND ret_60 IS NOT NULL THEN
 {rnd('coalesce(ret_20 / nullif(ret_60, 0) * CAST(ret_20 > 0 AND ret_60 > 0 AS INTEGER), 0)', 4)} END AS score
 FROM (SELECT entity, period, row_number() OVER w AS rn, ln(close / lag(close, 20) OVER w) AS ret_20,
  ln(close / lag(close, 60) OVER w) AS ret_60 FROM ibars WINDOW w AS ({BY})) WHERE rn >= 70""",
    ),
)
def window_term_structure(spark, sf_dir):
    from panelspark.datasets.index_factors import term_structure

    out = term_structure(index_bars(spark, sf_dir))
    return out.select(
        "entity", "period", *[r(c).alias(c) for c in ("ret_20", "ret_60", "diff")],
        r("share", 4).alias("share"), "trend_ok", r("score", 4).alias("score"),
    )


@query(
    "G30 P11",
    with_ctes(
        "ibars",
        f"""SELECT entity, period, {sql_rcols([], ['overnight_ret', 'intraday_ret', 'on_mom', 'id_mom'])},
 CAST(CASE WHEN on_mom IS NULL OR id_mom IS NULL THEN NULL WHEN on_mom > 0 AND id_mom > 0 THEN 1
  WHEN on_mom > 0 AND id_mom < 0 THEN 2 WHEN on_mom < 0 AND id_mom > 0 THEN -2 WHEN on_mom < 0 AND id_mom < 0 THEN -1
  ELSE 0 END AS INTEGER) AS score FROM (
 SELECT entity, period, rn, overnight_ret, intraday_ret, {full('sum', 'overnight_ret', 20)} AS on_mom,
  {full('sum', 'intraday_ret', 20)} AS id_mom FROM (
  SELECT entity, period, row_number() OVER w AS rn, ln(open / lag(close) OVER w) AS overnight_ret,
   ln(close / open) AS intraday_ret FROM ibars WINDOW w AS ({BY}))) WHERE rn >= 30""",
    ),
)
def window_overnight_intraday(spark, sf_dir):
    from panelspark.datasets.index_factors import overnight_intraday

    out = overnight_intraday(index_bars(spark, sf_dir))
    cols = ["overnight_ret", "intraday_ret", "on_mom", "id_mom"]
    return out.select("entity", "period", *[r(c).alias(c) for c in cols], "score")


def _sql_slice(v, arr, n, side):
    seg = f"{arr}[1:{n}]" if side == "top" else f"{arr}[{21 - n}:20]"
    lin = [1.0 - i / n for i in range(n)]
    exp = [2.0 ** (-i / (n - 1)) for i in range(n)]
    if side == "bottom":
        lin, exp = lin[::-1], exp[::-1]
    vals = f"list_transform({seg}, lambda s: s.{v})"
    plain = f"coalesce(list_sum({vals}), 0)"
    dot = lambda ws: " + ".join(f"{seg}[{i + 1}].{v} * {x!r}" for i, x in enumerate(ws))
    return {"": plain, "_ld": dot(lin), "_exp": dot(exp)}


def _sql_slices(arr, values, tops):
    cols = []
    for v, name in values.items():
        for n in tops:
            for side in ("top", "bottom"):
                for tag, e in _sql_slice(v, arr, n, side).items():
                    cols.append(f"{rnd(e)} AS {name.format(slice=f'{side}{n}')}{tag}")
    return ", ".join(cols)


@query(
    "G31 H4 D11",
    with_ctes(
        "bars",
        f"""SELECT entity, period, {_sql_slices('a', {'ret': 'vol_{slice}'}, [5, 10])} FROM (
 SELECT entity, period, h, list_sort(list({{'k': -vol, 't': -(period - DATE '1970-01-01'), 'ret': ret}}) {over(20)}) AS a
 FROM (SELECT *, count(ret) {over(40)} AS h FROM (
  SELECT entity, period, vol, close / lag(close) OVER ({BY}) - 1 AS ret FROM bars))
 ) WHERE h >= 20 AND len(a) = 20""",
    ),
)
def window_ordered_slices(spark, sf_dir):
    b = bars(spark, sf_dir).withColumn("ret", W.change("close", w()))
    framed = S.with_sorted_frame(b, "entity", "period", "vol", ["ret"], "a")
    framed = S.enough_history(framed, "entity", "period", ["ret"], lookback=40, least=20)
    cols = S.slice_columns("a", {"ret": "vol_{slice}"}, [5, 10])
    out = framed.where(F.size("a") == 20).select("entity", "period", *[c.alias(n) for n, c in cols.items()])
    return rcols(out, ["entity", "period"], list(cols))


@query(
    "G32",
    with_ctes(
        "bars",
        f"""SELECT entity, period, {', '.join(f"{rnd(f'a[{i + 1}].vol', 2)} AS close_{i}_vol" for i in range(20))} FROM (
 SELECT entity, period, list_sort(list({{'k': -close, 't': -(period - DATE '1970-01-01'), 'vol': vol}}) {over(20)}) AS a
 FROM bars) WHERE len(a) = 20""",
    ),
)
def window_nth_ordered_values(spark, sf_dir):
    framed = S.with_sorted_frame(bars(spark, sf_dir), "entity", "period", "close", ["vol"], "a")
    cols = S.nth_columns("a", "vol", "close_{i}_vol")
    return framed.where(F.size("a") == 20).select("entity", "period", *[r(c, 2).alias(n) for n, c in cols.items()])


@query(
    "G34 J8",
    with_ctes(
        "bars",
        f"""SELECT entity, period, {rnd('list_avg(h)')} AS chg_mean,
 {rnd('list_stddev_pop(h)')} AS chg_std, {rnd('(h[-1] - list_avg(h)) / nullif(list_stddev_pop(h), 0)')} AS chg_zscore,
 {rnd('len(list_filter(h[1:len(h) - 1], lambda x: x <= h[-1])) / nullif(len(h) - 1, 0)')} AS chg_tsrank,
 CASE WHEN len(h) > 12 AND abs(h[len(h) - 12]) > 1e-12 THEN {rnd('(h[-1] - h[len(h) - 12]) / abs(h[len(h) - 12])', 4)} END
  AS chg_momentum, CAST(len(list_filter(h, lambda x: x < 0)) AS INTEGER) AS chg_neg_cnt
 FROM (SELECT entity, period, list_filter(list(chg) {over(36)}, lambda x: x IS NOT NULL) AS h FROM (
  SELECT entity, period, vol / nullif(lag(vol) OVER ({BY}), 0) - 1 AS chg FROM bars)) WHERE len(h) >= 4""",
    ),
)
def window_history_pack(spark, sf_dir):
    b = bars(spark, sf_dir).select("entity", "period", W.change("vol", w()).alias("chg"))
    out = S.history_pack(b, "entity", "period", ["chg"], window=36, negatives=["chg"])
    return out.where("chg_neg_cnt is not null").select(
        "entity",
        "period",
        *[r(c).alias(c) for c in ("chg_mean", "chg_std", "chg_zscore", "chg_tsrank")],
        r("chg_momentum", 4).alias("chg_momentum"),
        "chg_neg_cnt",
    )


@query(
    "G35 G36",
    with_ctes(
        "bars",
        f"""SELECT entity, period, {rnd('vol / nullif(m, 0)')} AS to_mean, {rnd('s / nullif(m, 0)')} AS spread,
 {rnd('(vol - m) / nullif(s, 0)')} AS z,
 {rnd('(vol - l3) / CASE WHEN abs(l3) > 1e-4 THEN abs(l3) END')} AS chg3,
 CASE WHEN l3 > 0 THEN {rnd('-(vol - l3) / CASE WHEN abs(l3) > 1e-4 THEN abs(l3) END')} END AS reversal3 FROM (
 SELECT entity, period, vol, {full('avg', 'vol', 12, 6)} AS m, {full('stddev_samp', 'vol', 12, 6)} AS s,
  lag(vol, 3) OVER ({BY}) AS l3 FROM bars)""",
    ),
)
def window_rolling_ratios(spark, sf_dir):
    mean, std = W.rolling(F.avg, "vol", w(), 12, 6), W.rolling(F.stddev_samp, "vol", w(), 12, 6)
    b = bars(spark, sf_dir).withColumns({"m": mean, "s": std, "l3": F.lag("vol", 3).over(w())})
    chg = guarded_ratio(F.col("vol") - F.col("l3"), F.abs("l3"), 1e-4)
    return b.select(
        "entity",
        "period",
        r(ratio("vol", "m")).alias("to_mean"),
        r(ratio("s", "m")).alias("spread"),
        r(ratio(F.col("vol") - F.col("m"), "s")).alias("z"),
        r(chg).alias("chg3"),
        r(F.when(F.col("l3") > 0, -chg)).alias("reversal3"),
    )


@query(
    "G37 F2",
    with_ctes(
        "ibars",
        f"""SELECT entity, period, {rnd('exp(sum(ln(1 + d)) OVER (PARTITION BY entity ORDER BY period)) - 1')} AS cum FROM (
 SELECT entity, period, ln(close / open) / 50 AS d FROM ibars)""",
    ),
)
def window_cumulative_return(spark, sf_dir):
    b = index_bars(spark, sf_dir).withColumn("d", F.log(ratio("close", "open")) / 50)
    return b.select("entity", "period", r(W.cumulative_return("d", w())).alias("cum"))


@query(
    "G38 O10",
    with_ctes(
        "bars",
        f"""SELECT entity, period, {rnd('amount', 2)} AS amount, CAST(coalesce(jump, false) AS INTEGER) AS jump FROM (
 SELECT *, bool_or(jump) OVER ({BY} ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS near FROM (
 SELECT entity, period, amount, abs(log10(abs(amount)) - lag(log10(abs(amount))) OVER ({BY})) > 1.2 AS jump
 FROM bars)) WHERE near""",
    ),
)
def window_scale_jumps(spark, sf_dir):
    from panelspark.operators.quality import scale_jumps

    out = scale_jumps(bars(spark, sf_dir), "entity", "period", "amount", threshold=1.2, context=3)
    return out.select("entity", "period", r("amount", 2).alias("amount"), "jump")


@query(
    "G38",
    with_ctes(
        "bars",
        "SELECT entity, min(period) AS first_period FROM bars WHERE abs(amount) > 400000 GROUP BY 1",
    ),
)
def window_first_above(spark, sf_dir):
    """First month in which an amount passes the threshold."""
    from panelspark.operators.quality import first_above

    return first_above(bars(spark, sf_dir), "entity", "period", "amount", 400_000)


@query(
    "G39 F3",
    with_ctes(
        "ibars",
        f"""SELECT entity, month, {rnd('last_close', 2)} AS last_close, {', '.join(
            f"{rnd(f'last_close / lag(last_close, {k}) OVER (PARTITION BY entity ORDER BY month) - 1')} AS ret_{k}m" for k in (1, 3, 12))}
 FROM (SELECT entity, CAST(date_trunc('month', period) AS DATE) AS month, arg_max(close, period) AS last_close
  FROM ibars GROUP BY 1, 2)""",
    ),
)
def window_month_aligned_returns(spark, sf_dir):
    from panelspark.operators.aggregates import month_aligned_returns

    out = month_aligned_returns(index_bars(spark, sf_dir), "entity", "period", "close", [1, 3, 12])
    return out.select(
        "entity", "month", r("last_close", 2).alias("last_close"), *[r(f"ret_{k}m").alias(f"ret_{k}m") for k in (1, 3, 12)]
    )


@query(
    "F10 F15 Q4",
    with_ctes(
        "ibars",
        f"""SELECT entity, period, {rnd('vol_20')} AS vol_20, CASE WHEN rn >= 60 THEN {rnd(
            "list_min(list_transform(list_zip(p, range(1, 61)), lambda s: (s[1] - list_max(p[1:s[2]])) / list_max(p[1:s[2]])))")} END
  AS max_drawdown_60 FROM (
 SELECT entity, period, rn, list(close) {over(60)} AS p, CASE WHEN rn >= 20 THEN stddev_samp(ret) {over(19)} * sqrt(252) END
  AS vol_20 FROM (SELECT entity, period, close, row_number() OVER ({BY}) AS rn,
  close / lag(close) OVER ({BY}) - 1 AS ret FROM ibars))""",
    ),
)
def window_volatility_drawdown(spark, sf_dir):
    b = index_bars(spark, sf_dir).withColumns({"ret": W.change("close", w()), "rn": F.row_number().over(w())})
    vol = F.when(F.col("rn") >= 20, F.stddev_samp("ret").over(W.trailing(w(), 19)) * F.lit(252.0**0.5))
    return b.select(
        "entity", "period", r(vol).alias("vol_20"), r(W.rolling_max_drawdown("close", w(), 60)).alias("max_drawdown_60")
    )


@query(
    "D12 F1 F13 F14",
    with_ctes(
        "fbars",
        f"""SELECT entity, period, {rnd('m')} AS ret_mean, {rnd('s')} AS ret_std, {rnd('m / nullif(s, 0)')} AS ret_msr,
 {rnd('vw')} AS vw_ret, {rnd('nn')} AS imbalance FROM (
 SELECT entity, period, count(*) {over(20)} AS c, avg(ret) {over(20)} AS m, stddev_samp(ret) {over(20)} AS s,
  sum(ret * vol) {over(20)} / nullif(sum(vol) {over(20)}, 0) AS vw,
  sum(net) {over(20)} / nullif(sum(abs(net)) {over(20)}, 0) AS nn FROM (
 SELECT *, close / lag(close) OVER ({BY}) - 1 AS ret, buy_sm_vol - sell_sm_vol AS net FROM fbars)) WHERE c = 20""",
    ),
)
def window_complete_window_stats(spark, sf_dir):
    b = bars(spark, sf_dir, flow=True).withColumns(
        {"ret": W.change("close", w()), "net": F.col("buy_sm_vol") - F.col("sell_sm_vol")}
    )
    f = W.trailing(w(), 20)
    m, s = F.avg("ret").over(f), F.stddev_samp("ret").over(f)
    out = b.select(
        "entity",
        "period",
        F.count("*").over(f).alias("c"),
        r(m).alias("ret_mean"),
        r(s).alias("ret_std"),
        r(ratio(m, s)).alias("ret_msr"),
        r(ratio(F.sum(F.col("ret") * F.col("vol")).over(f), F.sum("vol").over(f))).alias("vw_ret"),
        r(ratio(F.sum("net").over(f), F.sum(F.abs("net")).over(f))).alias("imbalance"),
    )
    return out.where("c = 20").drop("c")
