"""Set-based portfolio construction and measurement.

Signals are computed for all dates at once, weights are rows (config, period,
entity, weight), and weights set at a rebalance act from the next day on.
Tables per (config, period) are calendar-sized for each config.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.numeric import compound, ratio
from panelspark.operators.windows import by_time, change, trailing

YEAR_DAYS = 252


@dataclass(frozen=True)
class Costs:
    """Rates per traded amount; min_commission is per rebalance."""

    commission: float = 0.00025
    slippage: float = 0.001
    min_commission: float = 5.0


@dataclass(frozen=True)
class Config:
    name: str
    lookback: int = 20
    vol_window: int = 20
    vol_limit: float = 0.4
    positions: int = 5
    cap: float = 0.3


def signals(prices: DataFrame, entity: str, period: str, price: str, configs: Sequence[Config]) -> DataFrame:
    """Momentum and annualised volatility per config for every row, long over configs."""
    rows = prices.select(F.col(entity).alias("entity"), F.col(period).alias("period"), F.col(price).alias("price"))
    w = by_time("entity", "period")
    rows = rows.withColumn("ret", change("price", w))
    cols = {}
    for c in configs:
        cols[f"_m{c.lookback}"] = change("price", w, c.lookback)
        f = trailing(w, c.vol_window)
        cols[f"_v{c.vol_window}"] = F.when(
            F.count("ret").over(f) == c.vol_window, F.stddev_samp("ret").over(f) * F.lit(float(YEAR_DAYS) ** 0.5)
        )
    items = ", ".join(
        f"struct('{c.name}' as config, _m{c.lookback} as momentum, _v{c.vol_window} as volatility, "
        f"{float(c.vol_limit)}D as vol_limit, {c.positions} as positions, {float(c.cap)}D as cap)"
        for c in configs
    )
    return rows.withColumns(cols).select("entity", "period", F.expr(f"inline(array({items}))"))


def capped_equal_weight(n: Column, cap: Column) -> Column:
    """min(1/n, cap), topped up towards full investment but never above the cap."""
    start = F.least(F.lit(1.0) / n, cap)
    rest = F.greatest(F.lit(1.0) - start * n, F.lit(0.0))
    return F.round(start + F.least(rest / n, cap - start), 4)


def select_top(signal: DataFrame, most: int) -> DataFrame:
    """Volatility filter, then the strongest ``positions`` per config and date, equally weighted up to the cap.

    ``most`` is the largest number of positions of all configs: as a literal
    limit it lets every task drop all but ``most`` rows per date before the shuffle.
    """
    ok = signal.where("momentum is not null and volatility is not null and volatility <= vol_limit")
    w = Window.partitionBy("config", "period").orderBy(F.desc("momentum"), "entity")
    best = ok.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= most)
    best = best.where(F.col("_rn") <= F.col("positions"))
    n = F.count("*").over(Window.partitionBy("config", "period"))
    return best.withColumn("weight", capped_equal_weight(n, F.col("cap"))).select("config", "period", "entity", "weight")


def renormalize(weights: DataFrame, cap: float | None = None) -> DataFrame:
    """Cap single weights, then scale every date to 1."""
    capped = F.least("weight", F.lit(cap)) if cap is not None else F.col("weight")
    rows = weights.withColumn("weight", capped)
    total = F.sum("weight").over(Window.partitionBy("config", "period"))
    return rows.withColumn("weight", F.round(ratio("weight", total), 4))


def drop_halted(weights: DataFrame, halted: DataFrame) -> DataFrame:
    """Remove (entity, period) pairs that are halted and scale the rest to 1 where anything was removed."""
    marked = weights.join(halted.select("entity", "period").distinct().withColumn("_h", F.lit(1)), ["entity", "period"], "left")
    w = Window.partitionBy("config", "period")
    open_weight = F.sum(F.when(F.col("_h").isNull(), F.col("weight"))).over(w)
    scaled = F.when(F.max("_h").over(w) == 1, ratio("weight", open_weight)).otherwise(F.col("weight"))
    return marked.withColumn("weight", scaled).where("_h is null").select(*weights.columns)


def portfolio_returns(weights: DataFrame, returns: DataFrame) -> DataFrame:
    """Daily return per config: weights of the last rebalance strictly before the day.

    The day -> rebalance mapping is made on a calendar-sized table; holdings
    then meet returns by equality.
    """
    days = returns.select("period").distinct()
    dates = weights.select("config", F.col("period").alias("_r")).distinct()
    first = dates.groupBy("config").agg(F.min("_r").alias("_first"))
    names = weights.agg(F.sort_array(F.collect_set("config"))).scalar()
    grid = days.withColumn("_names", names).select("period", F.explode("_names").alias("config"))
    grid = grid.join(F.broadcast(first), "config").where(F.col("period") >= F.col("_first")).select("config", "period")
    w = Window.partitionBy("config").orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    active = (
        grid.join(dates.withColumnRenamed("_r", "period").withColumn("_is", F.lit(1)), ["config", "period"], "left")
        .withColumn("_r", F.max(F.when(F.col("_is") == 1, F.col("period"))).over(w))
        .select("config", "period", "_r")
    )
    held = active.join(weights.withColumnRenamed("period", "_r"), ["config", "_r"])
    daily = (
        held.join(returns.select("entity", "period", "ret"), ["entity", "period"], "left")
        .groupBy("config", "period")
        .agg(F.sum(F.col("weight") * F.coalesce("ret", F.lit(0.0))).alias("_ret"))
    )
    return active.join(daily, ["config", "period"], "left").select(
        "config", "period", F.coalesce("_ret", F.lit(0.0)).alias("ret")
    )


def turnover(weights: DataFrame) -> DataFrame:
    """Sum of absolute weight changes at every rebalance; the first one counts in full.

    Each holding enters its own rebalance with + and the next one with -, so
    one aggregation replaces a full outer join of consecutive rebalances.
    """
    dates = weights.select("config", "period").distinct()
    nxt = dates.withColumn("_next", F.lead("period").over(Window.partitionBy("config").orderBy("period")))
    moves = weights.join(nxt, ["config", "period"]).select(
        "config", "entity", F.expr("inline(array(struct(period as period, weight as w), struct(_next as period, -weight as w)))")
    )
    net = moves.where("period is not null").groupBy("config", "period", "entity").agg(F.sum("w").alias("w"))
    return net.groupBy("config", "period").agg(F.sum(F.abs("w")).alias("turnover"))


def rebalance_cost(turn: DataFrame, nav: float, costs: Costs = Costs()) -> DataFrame:
    """Cost in money at a fixed value: commission with its minimum, and slippage."""
    traded = F.col("turnover") * F.lit(nav)
    commission = F.greatest(traded * F.lit(costs.commission), F.lit(costs.min_commission))
    total = F.when(F.col("turnover") > 0, commission + traded * F.lit(costs.slippage)).otherwise(F.lit(0.0))
    return turn.withColumn("cost", total)


def equity_curve(daily: DataFrame, turn: DataFrame | None = None, *, capital: float = 1.0, costs: Costs = Costs()) -> DataFrame:
    """Value per config and day: product of (1 + return) and (1 - cost rate) at rebalances."""
    rows = daily
    rate = F.lit(0.0)
    if turn is not None:
        rows = daily.join(turn, ["config", "period"], "left")
        rate = F.coalesce("turnover", F.lit(0.0)) * F.lit(costs.commission + costs.slippage)
    w = Window.partitionBy("config").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    grown = F.sum(F.log1p("ret") + F.log1p(-rate)).over(w)
    return rows.select("config", "period", "ret", (F.exp(grown) * F.lit(capital)).alias("nav"))


def performance(daily: DataFrame, year_days: int = YEAR_DAYS) -> DataFrame:
    """Total, annual, volatility, Sharpe, drawdown, Calmar and win rate per config, rounded to 4 digits."""
    w = Window.partitionBy("config").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    rows = daily.withColumn("_nav", F.exp(F.sum(F.log1p("ret")).over(w)))
    rows = rows.withColumn("_fall", ratio(F.col("_nav"), F.max("_nav").over(w)) - 1)
    stats = rows.groupBy("config").agg(
        compound("ret").alias("total_return"),
        F.count("*").alias("_n"),
        F.coalesce(F.stddev_samp("ret"), F.lit(0.0)).alias("_std"),
        F.least(F.min("_fall"), F.lit(0.0)).alias("max_drawdown"),
        F.avg((F.col("ret") > 0).cast("double")).alias("win_rate"),
    )
    annual = F.pow(F.lit(1.0) + F.col("total_return"), F.lit(float(year_days)) / F.col("_n")) - 1
    stats = stats.withColumns({"annual_return": annual, "annual_volatility": F.col("_std") * F.lit(float(year_days) ** 0.5)})
    stats = stats.withColumns(
        {
            "sharpe": F.when(F.col("annual_volatility") > 0, ratio("annual_return", "annual_volatility")).otherwise(0.0),
            "calmar": F.when(F.col("max_drawdown") < -1e-15, ratio("annual_return", F.abs("max_drawdown"))).otherwise(0.0),
        }
    )
    names = ["total_return", "annual_return", "annual_volatility", "sharpe", "max_drawdown", "calmar", "win_rate"]
    return stats.select("config", *[F.round(c, 4).alias(c) for c in names])
