"""Factors of index series: input one row per (entity, period) with open, close, vol, amount."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.numeric import ratio
from panelspark.operators.windows import by_time, change, moving_average, rolling, row_index, rolling_trend, trailing

SHORT, LONG, SPARE = 20, 60, 10


def trend_momentum(df: DataFrame) -> DataFrame:
    """Log return over n prices, fit of the price line, and sign(ret) * |ret| * R squared."""
    w = by_time("entity", "period")
    rows = df.select("entity", "period", "close").withColumn("_i", row_index(w))
    cols = {}
    for n in (SHORT, LONG):
        r2, slope = rolling_trend("close", "_i", w, n)
        cols[f"ret_{n}"] = F.log(ratio("close", F.lag("close", n - 1).over(w)))
        cols[f"r2_{n}"], cols[f"beta_{n}"] = r2, slope
    rows = rows.withColumns(cols)
    scores = {f"score_{n}": F.signum(f"ret_{n}") * F.abs(f"ret_{n}") * F.col(f"r2_{n}") for n in (SHORT, LONG)}
    return rows.withColumns(scores).where(F.col("_i") >= LONG + SPARE).drop("_i", "close")


def term_structure(df: DataFrame) -> DataFrame:
    """Short against long log return; the score counts only when both are positive."""
    w = by_time("entity", "period")
    rows = df.select("entity", "period", "close").withColumns(
        {
            "_i": F.row_number().over(w),
            "ret_20": F.log(ratio("close", F.lag("close", SHORT).over(w))),
            "ret_60": F.log(ratio("close", F.lag("close", LONG).over(w))),
        }
    )
    both = F.col("ret_20").isNotNull() & F.col("ret_60").isNotNull()
    up = ((F.col("ret_20") > 0) & (F.col("ret_60") > 0)).cast("int")
    return (
        rows.withColumns(
            {
                "diff": F.col("ret_20") - F.col("ret_60"),
                "share": ratio("ret_20", "ret_60"),
                "trend_ok": F.when(both, up),
            }
        )
        .withColumn("score", F.when(both, F.coalesce(F.col("share") * F.col("trend_ok"), F.lit(0.0))))
        .where(F.col("_i") >= LONG + SPARE)
        .drop("_i", "close")
    )


def overnight_intraday(df: DataFrame, previous_close: str | None = None) -> DataFrame:
    """Log return split at the open, 20-row sums and a quadrant score from -2 to 2."""
    w = by_time("entity", "period")
    before = F.col(previous_close) if previous_close else F.lag("close").over(w)
    rows = df.withColumns(
        {
            "_i": F.row_number().over(w),
            "overnight_ret": F.log(ratio("open", before)),
            "intraday_ret": F.log(ratio("close", "open")),
        }
    )
    rows = rows.withColumns(
        {
            "on_mom": rolling(F.sum, "overnight_ret", w, SHORT),
            "id_mom": rolling(F.sum, "intraday_ret", w, SHORT),
        }
    )
    on, day = F.col("on_mom"), F.col("id_mom")
    score = (
        F.when(on.isNull() | day.isNull(), F.lit(None).cast("int"))
        .when((on > 0) & (day > 0), 1)
        .when((on > 0) & (day < 0), 2)
        .when((on < 0) & (day > 0), -2)
        .when((on < 0) & (day < 0), -1)
        .otherwise(0)
    )
    return rows.withColumn("score", score).where(F.col("_i") >= SHORT + SPARE).select(
        "entity", "period", "overnight_ret", "intraday_ret", "on_mom", "id_mom", "score"
    )


def return_volatility(df: DataFrame) -> DataFrame:
    """20-row log return over annualised deviation of daily log returns."""
    w = by_time("entity", "period")
    rows = df.select("entity", "period", "close").withColumns(
        {
            "ret_20": F.log(ratio("close", F.lag("close", SHORT).over(w))),
            "ret_1": F.log(ratio("close", F.lag("close").over(w))),
        }
    )
    std = rolling(F.stddev_samp, "ret_1", w, SHORT) * F.lit(252.0**0.5)
    return rows.withColumn("std_20", std).withColumn("ret_vol_ratio", ratio("ret_20", "std_20")).drop("close")


def _with_market(df: DataFrame, market: DataFrame) -> DataFrame:
    """Daily log return of every series beside the market's; the market table is calendar-sized."""
    w = by_time("entity", "period")
    rows = df.select("entity", "period", F.log(ratio("close", F.lag("close").over(w))).alias("y"))
    m = market.withColumn("_m", F.lit(1))
    x = m.select("period", F.log(ratio("close", F.lag("close").over(by_time("_m", "period")))).alias("x"))
    return rows.join(F.broadcast(x), "period", "left")


def asymmetric_beta(df: DataFrame, market: DataFrame, *, window: int = LONG, least: int = 10) -> DataFrame:
    """Betas on rising and falling market days, the change of the latter and capture."""
    w = by_time("entity", "period")
    f = trailing(w, window)
    rows = _with_market(df, market)
    full = F.count(F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), 1)).over(f) == window

    def beta(side):
        x = F.when(side, F.col("x"))
        return F.when(full & (F.count(x).over(f) >= least), F.regr_slope(F.col("y"), x).over(f))

    rows = rows.withColumns(
        {
            "beta_up": beta(F.col("x") > 0),
            "beta_down": beta(F.col("x") < 0),
            "r2": F.when(full, F.regr_r2("y", "x").over(f)),
        }
    )
    return rows.withColumns(
        {
            "beta_down_change": F.col("beta_down") - F.lag("beta_down", SHORT).over(w),
            "capture_ratio": ratio("beta_up", "beta_down"),
        }
    ).drop("x", "y")


def residual_momentum(df: DataFrame, market: DataFrame, *, window: int = LONG) -> DataFrame:
    """Each day's residual against its own trailing market fit, summed over the window and z-scored per day.

    The residuals of one fit add up to zero, so the sum runs over the daily residuals.
    """
    w = by_time("entity", "period")
    f = trailing(w, window)
    rows = _with_market(df, market)
    full = F.count(F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), 1)).over(f) == window
    rows = rows.withColumns(
        {
            "beta": F.when(full, F.regr_slope("y", "x").over(f)),
            "alpha": F.when(full, F.regr_intercept("y", "x").over(f)),
        }
    )
    rows = rows.withColumn("_e", F.col("y") - F.col("alpha") - F.col("beta") * F.col("x"))
    rows = rows.withColumn("cum_excess", rolling(F.sum, "_e", w, window)).drop("_e", "x", "y")
    stats = rows.groupBy("period").agg(
        F.count("cum_excess").alias("_n"), F.avg("cum_excess").alias("_m"), F.stddev_samp("cum_excess").alias("_s")
    )
    z = F.when(F.col("_n") > 2, ratio(F.col("cum_excess") - F.col("_m"), "_s"))
    return rows.join(F.broadcast(stats), "period").withColumn("z_residual", z).drop("_n", "_m", "_s")


def rotation_speed(df: DataFrame) -> DataFrame:
    """Mean absolute change of the 20-row return rank between days, and a discount by its 60-row peak.

    Index pools hold tens of series, and the daily table is calendar-sized.
    """
    from panelspark.operators.order_stats import with_average_rank

    w = by_time("entity", "period")
    rows = df.select("entity", "period", F.log(ratio("close", F.lag("close", SHORT).over(w))).alias("ret_20"))
    ranked = with_average_rank(rows, ["period"], "ret_20", "_rank")
    step = F.abs(F.col("_rank") - F.lag("_rank").over(w))
    daily = (
        ranked.withColumn("_step", step)
        .groupBy("period")
        .agg(F.avg("_step").alias("rotation_speed"), F.count("_step").alias("_n"))
        .withColumn("rotation_speed", F.when(F.col("_n") >= 2, F.col("rotation_speed")))
        .withColumn("_one", F.lit(1))
    )
    peak = F.max("rotation_speed").over(trailing(by_time("_one", "period"), LONG))
    discount = F.when(peak == 0, F.lit(1.0)).otherwise(F.lit(1.0) - ratio("rotation_speed", peak))
    return daily.withColumn("momentum_discount", discount).select("period", "rotation_speed", "momentum_discount")


def price_volume_deviation(df: DataFrame) -> DataFrame:
    """Close against the traded average price, times the volume ratio capped at 2."""
    w = by_time("entity", "period")
    rows = df.withColumns({"wap": ratio("amount", "vol"), "vol_ratio": ratio("vol", moving_average("vol", w, SHORT))})
    rows = rows.withColumn("wap_deviation", ratio(F.col("close") - F.col("wap"), "wap"))
    score = F.when(F.col("vol_ratio").isNotNull(), F.col("wap_deviation") * F.least("vol_ratio", F.lit(2.0)))
    return rows.withColumn("score", score).select("entity", "period", "wap", "wap_deviation", "vol_ratio", "score")
