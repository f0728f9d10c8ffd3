"""Factor evaluation and portfolio queries on monthly bars."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators import evaluation as E
from panelspark.operators import portfolio as P
from panelspark.operators import windows as W
from panelspark.plans.registry import query
from panelspark.plans.section_queries import SQL_F, factors, sql_bucket
from panelspark.plans.shapes import bars, r, rcols, rnd, sql_rcols, with_ctes
from panelspark.sources.sinks import staged

FACTORS = ["mom", "volchg", "spread"]
KEYS = "factor, ret, scope"


def sql_long(names: dict[str, str], grouped: bool) -> str:
    parts = []
    for name, expr in names.items():
        base = f"SELECT '{name}' AS factor, 'fwd' AS ret, {{}} AS scope, period, entity, {expr} AS value, fwd AS y FROM f"
        parts.append(base.format("'total'"))
        if grouped:
            parts.append(base.format("CAST(grp AS VARCHAR)"))
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE value IS NOT NULL AND y IS NOT NULL"


def _rank(col: str) -> str:
    by = f"PARTITION BY {KEYS}, period"
    return f"rank() OVER ({by} ORDER BY {col}) + (count(*) OVER ({by}, {col}) - 1) / 2.0"


def sql_evaluation(names: dict[str, str], buckets: int, grouped: bool = False) -> dict[str, str]:
    """CTEs from long rows to the scan table."""
    return {
        "f": SQL_F,
        "long": sql_long(names, grouped),
        "ic": f"""SELECT {KEYS}, period, CASE WHEN stddev_pop(a) > 0 AND stddev_pop(b) > 0 THEN round(corr(a, b), 12) + 0.0 END AS ic
  FROM (SELECT {KEYS}, period, {_rank('value')} AS a, {_rank('y')} AS b FROM long) GROUP BY ALL""",
        "s": f"""SELECT {KEYS}, avg(ic) AS ic_mean, avg(ic) / nullif(stddev_samp(ic), 0) * sqrt(12) AS icir_annual,
  CASE WHEN avg(ic) > 0 THEN avg(CASE WHEN ic > 0 THEN 1.0 WHEN ic <= 0 THEN 0 END)
   ELSE avg(CASE WHEN ic < 0 THEN 1.0 WHEN ic >= 0 THEN 0 END) END AS ic_hit_ratio FROM ic GROUP BY ALL""",
        "bk": sql_bucket("value", f"{KEYS}, period", buckets, "long", "bucket"),
        "cells": f"""SELECT {KEYS}, period, bucket, avg(y) AS mean_ret, sum(sum(y)) OVER p / sum(count(*)) OVER p AS market
  FROM bk WHERE bucket IS NOT NULL GROUP BY {KEYS}, period, bucket WINDOW p AS (PARTITION BY {KEYS}, period)""",
        "mono": f"""SELECT {KEYS}, corr(rk, bucket) AS c, count(*) AS b FROM (
  SELECT {KEYS}, bucket, rank() OVER (PARTITION BY {KEYS} ORDER BY m) + (count(*) OVER (PARTITION BY {KEYS}, m) - 1) / 2.0 AS rk
  FROM (SELECT {KEYS}, bucket, avg(mean_ret) AS m FROM cells GROUP BY ALL)) GROUP BY ALL""",
        "ends": f"SELECT {KEYS}, min(bucket) AS lo, max(bucket) AS hi FROM cells GROUP BY ALL",
        "ser": f"""SELECT {KEYS}, period, max(mean_ret) FILTER (WHERE bucket = CASE WHEN ic_mean > 0 THEN hi ELSE lo END) AS l,
  max(mean_ret) FILTER (WHERE bucket = CASE WHEN ic_mean > 0 THEN lo ELSE hi END) AS s, max(market) AS m
  FROM cells JOIN ends USING ({KEYS}) JOIN s USING ({KEYS}) GROUP BY {KEYS}, period""",
        "met": f"""SELECT {KEYS}, avg(l - s) * 12 AS long_short_annual,
  (avg(l - s) * 12 - 0.02) / nullif(stddev_samp(l - s) * sqrt(12), 0) AS long_short_sharpe, avg(l) * 12 AS long_annual,
  (avg(l) * 12 - 0.02) / nullif(stddev_samp(l) * sqrt(12), 0) AS long_sharpe, avg(l - m) * 12 AS long_excess_annual,
  avg(s - m) * 12 AS short_excess_annual, avg(l - m) * 12 / nullif(stddev_samp(l - m) * sqrt(12), 0) AS long_excess_ir
  FROM ser GROUP BY ALL""",
        "scan": f"""SELECT {KEYS}, ic_mean, icir_annual, ic_hit_ratio,
  CASE WHEN b >= 2 THEN CASE WHEN ic_mean > 0 THEN c ELSE -c END END AS ic_monotonicity, long_short_annual,
  long_short_sharpe, long_annual, long_sharpe, long_excess_annual, short_excess_annual, long_excess_ir
  FROM s LEFT JOIN mono USING ({KEYS}) LEFT JOIN met USING ({KEYS})""",
    }


SINGLE = {f: f for f in FACTORS}


def long_rows(spark, sf_dir, group=None):
    f = factors(spark, sf_dir)
    return staged(E.stack_factors(f, "period", "entity", FACTORS, ["fwd"], group=group), "long")


@query("M1 M2", with_ctes("bars", f"SELECT factor, period, {rnd('ic')} AS ic FROM ic", **sql_evaluation(SINGLE, 5)))
def evaluate_ic_series(spark, sf_dir):
    return E.information_coefficients(long_rows(spark, sf_dir)).select("factor", "period", r("ic").alias("ic"))


@query(
    "M3 M5 M6 M7 M8 M9 L2",
    with_ctes("bars", f"SELECT {sql_rcols(KEYS.split(', '), E.SCAN_COLUMNS)} FROM scan", **sql_evaluation(SINGLE, 5, True)),
)
def evaluate_factor_scan(spark, sf_dir):
    scan = E.factor_scan(long_rows(spark, sf_dir, "grp"), buckets=5, stage=staged)
    return rcols(scan, E.CASE, E.SCAN_COLUMNS)


@query(
    "M4",
    with_ctes(
        "bars",
        f"SELECT factor, period, bucket, {rnd('mean_ret')} AS mean_ret, {rnd('market')} AS market_ret FROM cells",
        **sql_evaluation(SINGLE, 5),
    ),
)
def evaluate_bucket_returns(spark, sf_dir):
    cells = E.bucket_returns(long_rows(spark, sf_dir), 5)
    return cells.select("factor", "period", "bucket", r("mean_ret").alias("mean_ret"), r("market_ret").alias("market_ret"))


@query(
    "M10 D14",
    with_ctes(
        "bars",
        """SELECT factor FROM scan WHERE (abs(ic_mean) > 0.04 AND abs(icir_annual) > 2
  AND (ic_hit_ratio > 0.75 OR ic_hit_ratio < 0.25)) OR (long_sharpe > 0.6 AND long_excess_annual > 0.05)
  OR short_excess_annual < -0.15""",
        **sql_evaluation(SINGLE, 5),
    ),
)
def evaluate_factor_screen(spark, sf_dir):
    return E.factor_screen(E.factor_scan(long_rows(spark, sf_dir), buckets=5, stage=staged)).select("factor")


def _sql_cells(first_cte: dict[str, str], last: str) -> str:
    return with_ctes(
        "bars",
        f"""SELECT coalesce(bucket1, 0) AS bucket1, coalesce(bucket2, 0) AS bucket2, {rnd('avg(excess)')} AS excess_mean,
 {rnd('count(*) / max(total)')} AS sample_share, {rnd('median(mom)', 5)} AS mom_median, {rnd('median(spread)', 5)} AS spread_median
 FROM (SELECT bucket1, bucket2, mom, spread, fwd - avg(fwd) OVER (PARTITION BY period) AS excess, count(*) OVER () AS total
  FROM {last} WHERE bucket1 IS NOT NULL AND bucket2 IS NOT NULL) GROUP BY CUBE (bucket1, bucket2)""",
        f=SQL_F,
        g="SELECT entity, period, mom, spread, fwd FROM f WHERE mom IS NOT NULL AND spread IS NOT NULL AND fwd IS NOT NULL",
        **first_cte,
    )


def _two(spark, sf_dir, **kw):
    f = factors(spark, sf_dir).select("entity", "period", "mom", "spread", "fwd")
    out = E.two_factor_cells(f, "period", "mom", "spread", "fwd", **kw)
    return out.select(
        "bucket1", "bucket2", r("excess_mean").alias("excess_mean"), r("sample_share").alias("sample_share"),
        r("mom_median", 5).alias("mom_median"), r("spread_median", 5).alias("spread_median"),
    )


@query(
    "M11",
    _sql_cells(
        {
            "a": sql_bucket("mom", "period", 3, "g", "bucket1"),
            "b": sql_bucket("spread", "period", 3, "g", "bucket2"),
            "ab": "SELECT a.*, b.bucket2 FROM a JOIN (SELECT entity, period, bucket2 FROM b) b USING (entity, period)",
        },
        "ab",
    ),
)
def evaluate_two_factor_independent(spark, sf_dir):
    return _two(spark, sf_dir, q1=3, q2=3)


@query(
    "M11 G25",
    _sql_cells(
        {
            "a": sql_bucket("mom", "period", 3, "g", "bucket1"),
            "b": sql_bucket("spread", "period, bucket1", 3, "a", "bucket2"),
        },
        "b",
    ),
)
def evaluate_two_factor_sequential(spark, sf_dir):
    return _two(spark, sf_dir, q1=3, q2=3, sequential=True)


def _cut(col, bins):
    return f"CASE WHEN {col} < {bins[0]} THEN NULL " + " ".join(f"WHEN {col} <= {b} THEN {i}" for i, b in enumerate(bins[1:], 1)) + " END"


BINS1, BINS2 = [-1.0, -0.2, 0.2, 5.0], [0.0, 2.0, 6.0, 50.0]


@query(
    "M12",
    _sql_cells({"a": f"SELECT *, {_cut('mom', BINS1)} AS bucket1, {_cut('spread', BINS2)} AS bucket2 FROM g"}, "a"),
)
def evaluate_two_factor_fixed_bins(spark, sf_dir):
    return _two(spark, sf_dir, bins1=BINS1, bins2=BINS2)


COMBOS = {
    "mom,volchg": "(coalesce(mom, 0) + coalesce(volchg, 0)) / nullif(CAST(mom IS NOT NULL AS INTEGER) + CAST(volchg IS NOT NULL AS INTEGER), 0)",
    "mom,spread": "(coalesce(mom, 0) + coalesce(spread, 0)) / nullif(CAST(mom IS NOT NULL AS INTEGER) + CAST(spread IS NOT NULL AS INTEGER), 0)",
    "volchg,spread": "(coalesce(volchg, 0) + coalesce(spread, 0)) / nullif(CAST(volchg IS NOT NULL AS INTEGER) + CAST(spread IS NOT NULL AS INTEGER), 0)",
}


def combo_scan(spark, sf_dir):
    long = E.combine_factors(factors(spark, sf_dir), "period", "entity", FACTORS, ["fwd"], 2)
    return E.factor_scan(staged(long, "combos"), buckets=5, stage=staged)


@query(
    "M14",
    with_ctes("bars", f"SELECT {sql_rcols(['factor'], E.SCAN_COLUMNS)} FROM scan", **sql_evaluation(COMBOS, 5)),
)
def evaluate_combinations(spark, sf_dir):
    return rcols(combo_scan(spark, sf_dir), ["factor"], E.SCAN_COLUMNS)


@query(
    "M15",
    with_ctes(
        "bars",
        "SELECT period, " + ", ".join(f"{rnd(f'''max(ic) FILTER (WHERE factor = '{f}')''')} AS {f}" for f in FACTORS) + " FROM ic GROUP BY 1",
        **sql_evaluation(SINGLE, 5),
    ),
)
def evaluate_ic_matrix(spark, sf_dir):
    ic = E.information_coefficients(long_rows(spark, sf_dir))
    return rcols(E.ic_matrix(ic, FACTORS), ["period"], FACTORS)


@query(
    "M16 H2",
    with_ctes(
        "bars",
        """SELECT member, count(*) AS n FROM (SELECT unnest(string_split(factor, ',')) AS member FROM (
  SELECT factor FROM s ORDER BY ic_mean DESC, factor LIMIT 2)) GROUP BY 1""",
        **sql_evaluation(COMBOS, 5),
    ),
)
def evaluate_member_frequency(spark, sf_dir):
    long = E.combine_factors(factors(spark, sf_dir), "period", "entity", FACTORS, ["fwd"], 2)
    summary = E.ic_summary(E.information_coefficients(staged(long, "combos")))
    return E.member_frequency(summary, 2)


# ---- portfolio -------------------------------------------------------------------------------

CONFIGS = [
    P.Config("fast", lookback=3, vol_window=6, vol_limit=30.0, positions=5, cap=0.3),
    P.Config("slow", lookback=6, vol_window=6, vol_limit=20.0, positions=3, cap=0.25),
]
MOST = max(c.positions for c in CONFIGS)
QUARTERLY = "month(period) IN (1, 4, 7, 10)"


def _sql_signal() -> str:
    by = "PARTITION BY entity ORDER BY period"
    frame = f"({by} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"
    parts = [
        f"""SELECT '{c.name}' AS config, entity, period, close / nullif(lag(close, {c.lookback}) OVER ({by}), 0) - 1 AS momentum,
  CASE WHEN count(ret) OVER {frame} = 6 THEN stddev_samp(ret) OVER {frame} * sqrt(252) END AS volatility,
  {c.vol_limit} AS vol_limit, {c.positions} AS positions, {c.cap} AS cap
  FROM (SELECT *, close / nullif(lag(close) OVER ({by}), 0) - 1 AS ret FROM bars)"""
        for c in CONFIGS
    ]
    return " UNION ALL ".join(parts)


PORT = {
    "sig": _sql_signal(),
    "sel": f"""SELECT config, period, entity, count(*) OVER (PARTITION BY config, period) AS n, cap FROM (
  SELECT *, row_number() OVER (PARTITION BY config, period ORDER BY momentum DESC, entity) AS rn FROM sig
  WHERE momentum IS NOT NULL AND volatility <= vol_limit AND {QUARTERLY}) WHERE rn <= positions""",
    "wts": """SELECT config, period, entity, round(least(1.0 / n, cap) + least(greatest(1 - least(1.0 / n, cap) * n, 0) / n,
  cap - least(1.0 / n, cap)), 4) AS weight FROM sel""",
    "rets": "SELECT entity, period, (close / nullif(lag(close) OVER (PARTITION BY entity ORDER BY period), 0) - 1) / 20 AS ret FROM bars",
    "act": """SELECT c.config, d.period, (SELECT max(w.period) FROM wts w WHERE w.config = c.config AND w.period < d.period) AS r
  FROM (SELECT config, min(period) AS a FROM wts GROUP BY 1) c JOIN (SELECT DISTINCT period FROM bars) d ON d.period >= c.a""",
    "daily": """SELECT a.config, a.period, coalesce(sum(w.weight * coalesce(x.ret, 0)), 0) AS ret FROM act a
  LEFT JOIN wts w ON w.config = a.config AND w.period = a.r LEFT JOIN rets x ON x.entity = w.entity AND x.period = a.period
  GROUP BY 1, 2""",
    "seq": "SELECT DISTINCT config, period, dense_rank() OVER (PARTITION BY config ORDER BY period) AS k FROM wts",
    "turn": """SELECT config, period, sum(abs(d)) AS turnover FROM (SELECT s.config, s.period, e.entity,
   coalesce(max(w.weight), 0) - coalesce(max(v.weight), 0) AS d FROM seq s
   JOIN (SELECT DISTINCT config, entity FROM wts) e ON e.config = s.config
   LEFT JOIN seq q ON q.config = s.config AND q.k = s.k - 1
   LEFT JOIN wts w ON w.config = s.config AND w.period = s.period AND w.entity = e.entity
   LEFT JOIN wts v ON v.config = s.config AND v.period = q.period AND v.entity = e.entity GROUP BY 1, 2, 3) GROUP BY 1, 2""",
}


def signal_rows(spark, sf_dir):
    return P.signals(bars(spark, sf_dir), "entity", "period", "close", CONFIGS)


def weight_rows(spark, sf_dir):
    return staged(P.select_top(signal_rows(spark, sf_dir).where(QUARTERLY), MOST), "weights")


def return_rows(spark, sf_dir):
    w = W.by_time("entity", "period")
    return bars(spark, sf_dir).select("entity", "period", (W.change("close", w) / 20).alias("ret"))


@query(
    "N2 N3 N11",
    with_ctes("bars", f"SELECT config, entity, period, {rnd('momentum')} AS momentum, {rnd('volatility', 5)} AS volatility FROM sig", **PORT),
)
def portfolio_signals(spark, sf_dir):
    return signal_rows(spark, sf_dir).select(
        "config", "entity", "period", r("momentum").alias("momentum"), r("volatility", 5).alias("volatility")
    )


@query("N4", with_ctes("bars", f"SELECT config, period, entity, {rnd('weight')} AS weight FROM wts", **PORT))
def portfolio_weights(spark, sf_dir):
    return rcols(weight_rows(spark, sf_dir), ["config", "period", "entity"], ["weight"])


@query(
    "N5",
    with_ctes(
        "bars",
        f"""SELECT config, period, entity, {rnd('least(weight, 0.22) / sum(least(weight, 0.22)) OVER (PARTITION BY config, period)', 4)}
 AS weight FROM wts""",
        **PORT,
    ),
)
def portfolio_renormalized(spark, sf_dir):
    return rcols(P.renormalize(weight_rows(spark, sf_dir), 0.22), ["config", "period", "entity"], ["weight"], 4)


@query(
    "N6",
    with_ctes(
        "bars",
        f"""SELECT config, period, entity, {rnd('weight')} AS weight FROM (
 SELECT *, CASE WHEN bool_or(halted) OVER p THEN w0 / sum(w0) FILTER (WHERE NOT halted) OVER p ELSE w0 END AS weight FROM (
  SELECT w.config, w.period, w.entity, w.weight AS w0, b.vol < 90 AS halted FROM wts w JOIN bars b USING (entity, period))
 WINDOW p AS (PARTITION BY config, period)) WHERE NOT halted""",
        **PORT,
    ),
)
def portfolio_without_halted(spark, sf_dir):
    halted = bars(spark, sf_dir).where("vol < 90").select("entity", "period")
    return rcols(P.drop_halted(weight_rows(spark, sf_dir), halted), ["config", "period", "entity"], ["weight"])


@query("N7", with_ctes("bars", f"SELECT config, period, {rnd('ret')} AS ret FROM daily", **PORT))
def portfolio_daily_returns(spark, sf_dir):
    out = P.portfolio_returns(weight_rows(spark, sf_dir), return_rows(spark, sf_dir))
    return rcols(out, ["config", "period"], ["ret"])


@query(
    "N8",
    with_ctes(
        "bars",
        f"""SELECT config, period, {rnd('turnover')} AS turnover, {rnd("CASE WHEN turnover > 0 THEN greatest(turnover * 1e6 * 0.00025, 5) + turnover * 1e6 * 0.001 ELSE 0 END", 3)}
 AS cost FROM turn""",
        **PORT,
    ),
)
def portfolio_turnover_cost(spark, sf_dir):
    out = P.rebalance_cost(P.turnover(weight_rows(spark, sf_dir)), 1e6)
    return out.select("config", "period", r("turnover").alias("turnover"), r("cost", 3).alias("cost"))


@query(
    "N9",
    with_ctes(
        "bars",
        f"""SELECT config, period, {rnd("exp(sum(ln(1 + ret) + ln(1 - coalesce(turnover, 0) * 0.00125)) OVER (PARTITION BY config ORDER BY period))")}
 AS nav FROM daily LEFT JOIN turn USING (config, period)""",
        **PORT,
    ),
)
def portfolio_equity_curve(spark, sf_dir):
    weights = weight_rows(spark, sf_dir)
    daily = P.portfolio_returns(weights, return_rows(spark, sf_dir))
    return rcols(P.equity_curve(daily, P.turnover(weights)), ["config", "period"], ["nav"])


@query(
    "N10 F10",
    with_ctes(
        "bars",
        f"""SELECT config, {rnd('total', 4)} AS total_return, {rnd('ann', 4)} AS annual_return, {rnd('vol', 4)} AS annual_volatility,
 {rnd('ann / nullif(vol, 0)', 4)} AS sharpe, {rnd('dd', 4)} AS max_drawdown, {rnd('ann / abs(nullif(dd, 0))', 4)} AS calmar,
 {rnd('win', 4)} AS win_rate FROM (
 SELECT config, exp(sum(ln(1 + ret))) - 1 AS total, pow(exp(sum(ln(1 + ret))), 252.0 / count(*)) - 1 AS ann,
  stddev_samp(ret) * sqrt(252) AS vol, min(nav / peak - 1) AS dd, avg(CASE WHEN ret > 0 THEN 1.0 ELSE 0 END) AS win FROM (
  SELECT *, max(nav) OVER (PARTITION BY config ORDER BY period) AS peak FROM (
   SELECT *, exp(sum(ln(1 + ret)) OVER (PARTITION BY config ORDER BY period)) AS nav FROM daily)) GROUP BY 1)""",
        **PORT,
    ),
)
def portfolio_performance(spark, sf_dir):
    return P.performance(P.portfolio_returns(weight_rows(spark, sf_dir), return_rows(spark, sf_dir)))
