"""Daily market signals, alarms, monthly regime labels and weekly crowding.

The daily tables have one row per calendar day, so their windows run over one
calendar-sized partition; everything per entity is aggregated before that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.numeric import ratio
from panelspark.operators.aggregates import gini
from panelspark.operators.windows import by_time, moving_average, rolling, run_length, trailing

YEARS = {"3y": 750, "5y": 1250}


def _daily(period: str = "period"):
    return Window.partitionBy(F.lit(0)).orderBy(period)


def share_below(c: str, n: int, least: int = 2) -> Column:
    """Share of earlier values of the last n rows strictly below the current one."""
    frame = F.collect_list(c).over(trailing(_daily(), n))
    below = F.size(F.filter(frame, lambda x: x < F.col(c)))
    return F.when(F.col(c).isNotNull() & (F.size(frame) >= least), ratio(below, F.size(frame) - 1))


def daily_signals(
    panel: DataFrame,
    index: DataFrame,
    *,
    margin: DataFrame | None = None,
    north: DataFrame | None = None,
    limits: DataFrame | None = None,
    risk_free: float = 0.03,
    lookbacks: dict[str, int] = YEARS,
) -> DataFrame:
    """17 signals per day.

    panel   entity, period, close, vol, amount
    index   period, close, pe
    margin  period, balance, bought;  north  period, net;  limits  period, kind (U or D)
    """
    w = by_time("entity", "period")
    before = F.lag("close").over(w)
    rows = panel.withColumns(
        {
            "_ret": ratio("close", before) - 1,
            "_ma": moving_average("close", w, 20),
            "_high": rolling(F.max, "close", w, 20),
        }
    )
    rows = rows.withColumn("_sd", rolling(F.stddev_samp, "_ret", w, 20))
    market = rows.groupBy("period").agg(
        F.avg(F.when(F.col("_ma").isNotNull(), (F.col("close") > F.col("_ma")).cast("double"))).alias("above_ma_20d_pct"),
        F.avg(F.when(F.col("_high").isNotNull(), (F.col("close") >= F.col("_high")).cast("double"))).alias("new_high_20d_pct"),
        F.sum("amount").alias("total_turnover"),
        ratio(F.sum(F.when(F.col("_ret") > 0, F.col("vol")).otherwise(0.0)), F.sum("vol")).alias("up_vol_ratio"),
        F.avg((F.col("_ret") > 0).cast("double")).alias("up_ratio"),
        (F.avg("_sd") * F.lit(252.0**0.5)).alias("average_volatility"),
    )
    d = _daily()
    out = index.select("period", F.col("close").alias("index_close"), F.col("pe").alias("pe_ttm")).join(market, "period", "left")
    parts = (
        (margin, [F.sum("balance").alias("margin_balance"), F.sum("bought").alias("_bought")], ["margin_balance", "_bought"]),
        (north, [F.sum("net").alias("north_money")], ["north_money"]),
        (
            limits,
            [F.count_if(F.col("kind") == "U").alias("limit_up_count"), F.count_if(F.col("kind") == "D").alias("limit_down_count")],
            ["limit_up_count", "limit_down_count"],
        ),
    )
    for df, aggs, names in parts:
        if df is None:
            out = out.withColumns({n: F.lit(None).cast("double") for n in names})
        else:
            out = out.join(F.broadcast(df.groupBy("period").agg(*aggs)), "period", "left")
    out = out.withColumn("index_pct_chg", ratio("index_close", F.lag("index_close").over(d)) - 1)
    out = out.withColumns(
        {
            "turnover_ma_ratio": ratio("total_turnover", moving_average("total_turnover", d, 20)),
            "margin_buy_ratio": ratio("_bought", "total_turnover"),
            "index_vol_20d": rolling(F.stddev_samp, "index_pct_chg", d, 20) * F.lit(252.0**0.5),
            "pe_percentile_3y": share_below("pe_ttm", lookbacks["3y"]),
            "erp_5y": ratio(F.lit(1.0), "pe_ttm") - F.lit(risk_free),
        }
    )
    return out.drop("_bought")


ALARMS = [
    "limit_down_ratio_hi", "limit_down_count_hi", "turnover_spike", "vol_spike", "breadth_crash", "margin_call",
    "north_flight", "drawdown_20pct", "consecutive_down", "pe_below_10pct",
]


def alarms(signals: DataFrame, *, outflow: float = 100.0, lookbacks: dict[str, int] = YEARS, levels=(1, 3, 5)) -> DataFrame:
    """Ten daily flags, their count and a level from 0 to 3; a missing input raises no flag."""
    d = _daily()
    peak = F.max("index_close").over(trailing(d, 60))
    vol_high = F.expr("percentile(index_vol_20d, 0.95)").over(trailing(d, lookbacks["3y"]))
    falls = run_length(F.col("index_pct_chg") < 0, d)
    rules = {
        "limit_down_ratio_hi": ratio("limit_down_count", "limit_up_count") > 5,
        "limit_down_count_hi": F.col("limit_down_count") > 100,
        "turnover_spike": F.col("turnover_ma_ratio") > 2.5,
        "vol_spike": F.col("index_vol_20d") > vol_high,
        "breadth_crash": F.col("up_ratio") < 0.1,
        "margin_call": ratio("margin_balance", F.lag("margin_balance", 5).over(d)) < 0.95,
        "north_flight": F.col("north_money") < -outflow,
        "drawdown_20pct": ratio("index_close", peak) - 1 < -0.2,
        "consecutive_down": falls > 5,
        "pe_below_10pct": F.col("pe_percentile_3y") < 0.1,
    }
    flags = signals.withColumns({n: F.coalesce(c, F.lit(False)).cast("int") for n, c in rules.items()})
    count = sum((F.col(a) for a in ALARMS[1:]), F.col(ALARMS[0]))
    level = F.lit(0)
    for i, n in enumerate(levels, 1):
        level = F.when(F.col("alarm_count") >= n, i).otherwise(level)
    return flags.withColumn("alarm_count", count).withColumn("panic_level", level).select(
        "period", *ALARMS, "alarm_count", "panic_level"
    )


def regime_labels(
    signals: DataFrame, alarm: DataFrame, *, band: float = 0.02, broad: float = 0.5, hysteresis: float = 0.02,
    lookbacks: dict[str, int] = YEARS,
) -> DataFrame:
    """Direction x breadth per month end, three overrides, and a band that keeps the last direction near its border.

    UP+BROAD BULL, UP+NARROW CHAOS, DOWN+BROAD BEAR, DOWN+NARROW SIDEWAYS, FLAT SIDEWAYS.
    """
    if hysteresis >= 2 * band:
        raise ValueError("the hysteresis has to be narrower than both sides of the band, or FLAT could not be entered")
    d = _daily()
    erp_high = F.expr("percentile(erp_5y, 0.9)").over(trailing(d, lookbacks["5y"]))
    vol_high = F.expr("percentile(index_vol_20d, 0.95)").over(trailing(d, lookbacks["3y"]))
    daily = signals.join(alarm.select("period", "alarm_count"), "period", "left").withColumns(
        {
            "_cheap": (F.col("pe_percentile_3y") < 0.1) & (F.col("erp_5y") > erp_high),
            "_wild": F.col("index_vol_20d") > vol_high,
        }
    )
    fields = ["index_close", "above_ma_20d_pct", "_cheap", "_wild"]
    monthly = daily.groupBy(F.trunc("period", "month").alias("month")).agg(
        F.max("period").alias("period"),
        F.max_by(F.struct(*fields), "period").alias("_l"),
        F.max("alarm_count").alias("_alarms"),
    ).select("month", "period", "_l.*", "_alarms")
    m = Window.partitionBy(F.lit(0)).orderBy("month")
    score = ratio("index_close", F.lag("index_close").over(m)) - 1
    monthly = monthly.withColumns({"direction_score": score, "breadth_score": F.col("above_ma_20d_pct")})
    s = F.col("direction_score")
    # certain months fix the label; months inside the band around a border repeat the last certain one
    certain = (
        F.when(s > band + hysteresis / 2, "UP").when(s < -band - hysteresis / 2, "DOWN").when(F.abs("direction_score") < band - hysteresis / 2, "FLAT")
    )
    plain = F.when(s > band, "UP").when(s < -band, "DOWN").when(s.isNotNull(), "FLAT")
    held = F.last(certain, ignorenulls=True).over(m.rowsBetween(Window.unboundedPreceding, 0))
    monthly = monthly.withColumns(
        {
            "direction_label": F.when(s.isNotNull(), F.coalesce(held, plain)),
            "breadth_label": F.when(F.col("breadth_score") >= broad, "BROAD").when(F.col("breadth_score").isNotNull(), "NARROW"),
        }
    )
    up, down = F.col("direction_label") == "UP", F.col("direction_label") == "DOWN"
    wide = F.col("breadth_label") == "BROAD"
    base = F.when(up & wide, "BULL").when(up, "CHAOS").when(down & wide, "BEAR").when(F.col("direction_label").isNotNull(), "SIDEWAYS")
    monthly = monthly.withColumn("_base", base)
    wild, cheap, alarmed = F.coalesce("_wild", F.lit(False)), F.coalesce("_cheap", F.lit(False)), F.coalesce("_alarms", F.lit(0)) >= 3
    reason = (
        F.when(F.col("_base").isNull(), F.lit(None).cast("string"))
        .when(wild, "volatility")
        .when(alarmed & (F.col("_base") == "BULL"), "alarm")
        .when(cheap & (F.col("_base") == "BEAR"), "valuation")
    )
    monthly = monthly.withColumn("override_reason", reason)
    final = (
        F.when(F.col("override_reason").isin("volatility", "alarm"), "CHAOS")
        .when(F.col("override_reason") == "valuation", "SIDEWAYS")
        .otherwise(F.col("_base"))
    )
    return monthly.withColumn("regime", final).select(
        "month", "period", "direction_score", "direction_label", "breadth_score", "breadth_label", "regime", "override_reason"
    )


def weekly_crowding(sectors: DataFrame, *, lookback: int = 750) -> DataFrame:
    """Concentration of amounts, valuation, week returns and return dispersion across sectors.

    sectors holds sector, period, close, amount, pe: tens of sectors, so the
    daily and weekly tables are calendar-sized.
    """
    w = by_time("sector", "period")
    frame = F.collect_list("pe").over(trailing(w, lookback))
    below = F.size(F.filter(frame, lambda x: x < F.col("pe")))
    rows = sectors.withColumns(
        {
            "_pct": F.when(F.col("pe").isNotNull() & (F.size(frame) > 1), ratio(below, F.size(frame) - 1)),
            "_r20": ratio("close", F.lag("close", 20).over(w)) - 1,
            "week": F.trunc("period", "week"),
        }
    )
    total = rows.groupBy("week", "period").agg(
        ratio(F.sum(F.col("amount") * F.col("amount")), F.sum("amount") * F.sum("amount")).alias("_hhi"),
        F.max("_pct").alias("_cap"),
        F.stddev_samp("_r20").alias("_disp"),
    )
    weekly = total.groupBy("week").agg(
        F.max("period").alias("period"),
        F.avg("_hhi").alias("hhi_weekly"),
        F.max_by("_cap", "period").alias("pe_percentile_cap"),
        F.max_by("_disp", "period").alias("ret_dispersion"),
    )
    ends = rows.groupBy("sector", "week").agg(F.max_by("close", "period").alias("_c"))
    ends = ends.withColumn("_wr", F.abs(ratio("_c", F.lag("_c").over(by_time("sector", "week"))) - 1)).where("_wr is not null")
    spread = gini(ends, ["week"], "_wr", "gini_weekly", least=2)
    out = weekly.join(spread, "week", "left")
    seen = Window.partitionBy(F.lit(0)).orderBy("week").rowsBetween(Window.unboundedPreceding, 0)

    def scaled(c: str) -> Column:
        """Position between the lowest and highest value so far."""
        low, high = F.min(c).over(seen), F.max(c).over(seen)
        return F.coalesce(ratio(F.col(c) - low, high - low), F.lit(0.0))

    score = (
        0.3 * scaled("hhi_weekly") + 0.25 * F.coalesce("pe_percentile_cap", F.lit(0.0)) + 0.25 * F.coalesce("gini_weekly", F.lit(0.0))
        + 0.2 * scaled("ret_dispersion")
    )
    out = out.withColumn("crowding_score", score)
    c = F.col("crowding_score")
    steps = F.when(c < 0.3, 1.0).when(c < 0.5, 0.8).when(c < 0.7, 0.5).otherwise(0.0)
    return out.withColumn("narrative_multiplier", steps).select(
        "week", "period", "hhi_weekly", "pe_percentile_cap", "gini_weekly", "ret_dispersion", "crowding_score", "narrative_multiplier"
    )
