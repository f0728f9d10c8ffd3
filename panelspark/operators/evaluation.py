"""Factor evaluation. Factors are stacked long, so any number of them runs in one job.

Long rows are (factor, ret, scope, period, entity, value, y): one row per
factor, return column, scope ("total" or one group value), date and entity.
Everything after the rank and bucket step works on tables with one row per
(factor, ret, scope, period[, bucket]).
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.numeric import ratio, safe_corr
from panelspark.operators.aggregates import median_margins
from panelspark.operators.cross_section import (
    Stage,
    as_is,
    excess_over_mean,
    fixed_bucket,
    quantile_bucket,
    sequential_buckets,
)
from panelspark.operators.order_stats import with_average_rank

CASE = ["factor", "ret", "scope"]
RISK_FREE = 0.02


def stack_factors(
    df: DataFrame,
    period: str,
    entity: str,
    factors: Sequence[str],
    returns: Sequence[str],
    *,
    group: str | None = None,
    least_group_rows: int = 10,
) -> DataFrame:
    """Wide factor table to long rows without NULLs; with a group, every row also enters its group's scope."""
    cells = ", ".join(
        f"struct('{f}' as factor, '{y}' as ret, cast({f} as double) as value, cast({y} as double) as y)"
        for f in factors
        for y in returns
    )
    scopes = "array('total')" if group is None else f"filter(array('total', cast({group} as string)), s -> s is not null)"
    rows = df
    if group is not None:
        sizes = df.groupBy(group).agg(F.count("*").alias("_rows"))
        rows = df.join(sizes, group, "left")
        scopes = f"if({group} is null or _rows < {least_group_rows}, array('total'), array('total', cast({group} as string)))"
    return (
        rows.select(F.col(period).alias("period"), F.col(entity).alias("entity"), F.expr(f"explode({scopes}) as scope"), *factors, *returns)
        .select("period", "entity", "scope", F.expr(f"inline(array({cells}))"))
        .where("value is not null and y is not null and not isnan(value) and not isnan(y)")
        .select(*CASE, "period", "entity", "value", "y")
    )


def information_coefficients(long: DataFrame) -> DataFrame:
    """Rank correlation of value and return per case and date.

    Rounded at the 12th digit: the sign is counted later, and a true zero must not get one from the last bit.
    """
    keys = [*CASE, "period"]
    ranked = with_average_rank(long, keys, "value", "_a")
    ranked = with_average_rank(ranked, keys, "y", "_b")
    return ranked.groupBy(*keys).agg(F.round(safe_corr("_a", "_b"), 12).alias("ic"))


def ic_summary(ic: DataFrame, periods_per_year: int = 12) -> DataFrame:
    """Mean, deviation, annualised ratio and hit ratio in the direction of the mean."""
    stats = ic.groupBy(*CASE).agg(
        F.avg("ic").alias("ic_mean"),
        F.stddev_samp("ic").alias("ic_std"),
        F.avg((F.col("ic") > 0).cast("double")).alias("_up"),
        F.avg((F.col("ic") < 0).cast("double")).alias("_down"),
    )
    year = F.lit(float(periods_per_year) ** 0.5)
    return stats.withColumns(
        {
            "icir_annual": F.when(F.col("ic_std") > 0, ratio("ic_mean", "ic_std") * year),
            "ic_hit_ratio": F.when(F.col("ic_mean") > 0, F.col("_up")).otherwise(F.col("_down")),
        }
    ).drop("_up", "_down")


def bucket_returns(long: DataFrame, buckets: int) -> DataFrame:
    """Mean return per case, date and quantile bucket, beside the date's market mean."""
    keys = [*CASE, "period"]
    sorted_rows = quantile_bucket(long, keys, "value", "bucket", buckets=buckets).where("bucket is not null")
    cells = sorted_rows.groupBy(*keys, "bucket").agg(F.avg("y").alias("mean_ret"), F.sum("y").alias("_s"), F.count("*").alias("_n"))
    date_rows = Window.partitionBy(*keys)
    market = ratio(F.sum("_s").over(date_rows), F.sum("_n").over(date_rows))
    return cells.withColumn("market_ret", market).drop("_s", "_n")


def monotonicity(cells: DataFrame, summary: DataFrame) -> DataFrame:
    """Rank correlation of the buckets' mean returns with 1..n, reversed for a negative direction."""
    means = cells.groupBy(*CASE, "bucket").agg(F.avg("mean_ret").alias("_m"))
    w = Window.partitionBy(*CASE).orderBy("_m")
    ties = Window.partitionBy(*CASE, "_m")
    ranked = means.withColumn("_r", F.rank().over(w) + (F.count("*").over(ties) - 1) / F.lit(2.0))
    corr = ranked.groupBy(*CASE).agg(safe_corr("_r", F.col("bucket").cast("double")).alias("_c"), F.count("*").alias("_b"))
    sign = F.when(F.col("ic_mean") > 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    return corr.join(summary.select(*CASE, "ic_mean"), CASE).select(
        *CASE, F.when(F.col("_b") >= 2, F.col("_c") * sign).alias("ic_monotonicity")
    )


def direction_series(cells: DataFrame, summary: DataFrame) -> DataFrame:
    """Long, short, spread and excess return per date; long is the top bucket when the mean rank correlation is positive."""
    case = Window.partitionBy(*CASE)
    edges = cells.join(summary.select(*CASE, "ic_mean"), CASE).withColumns(
        {"_top": F.max("bucket").over(case), "_bottom": F.min("bucket").over(case)}
    )
    up = F.col("ic_mean") > 0
    long_b = F.when(up, F.col("_top")).otherwise(F.col("_bottom"))
    short_b = F.when(up, F.col("_bottom")).otherwise(F.col("_top"))
    wide = edges.groupBy(*CASE, "period").agg(
        F.max(F.when(F.col("bucket") == long_b, F.col("mean_ret"))).alias("long_ret"),
        F.max(F.when(F.col("bucket") == short_b, F.col("mean_ret"))).alias("short_ret"),
        F.max("market_ret").alias("market_ret"),
    )
    return wide.withColumns(
        {
            "spread": F.col("long_ret") - F.col("short_ret"),
            "long_excess": F.col("long_ret") - F.col("market_ret"),
            "short_excess": F.col("short_ret") - F.col("market_ret"),
        }
    )


def _sharpe(c: str, n: int, rate: float) -> Column:
    """Aggregate: annual mean over the rate per annual deviation."""
    enough = (F.count(c) > 1) & (F.stddev_samp(c) > 0)
    return F.when(enough, ratio(F.avg(c) * n - F.lit(rate), F.stddev_samp(c) * F.lit(float(n) ** 0.5)))


def return_metrics(series: DataFrame, n: int = 12) -> DataFrame:
    return series.groupBy(*CASE).agg(
        (F.avg("spread") * n).alias("long_short_annual"),
        _sharpe("spread", n, RISK_FREE).alias("long_short_sharpe"),
        (F.avg("long_ret") * n).alias("long_annual"),
        _sharpe("long_ret", n, RISK_FREE).alias("long_sharpe"),
        (F.avg("long_excess") * n).alias("long_excess_annual"),
        (F.avg("short_excess") * n).alias("short_excess_annual"),
        _sharpe("long_excess", n, 0.0).alias("long_excess_ir"),
    )


SCAN_COLUMNS = [
    "ic_mean", "icir_annual", "ic_hit_ratio", "ic_monotonicity", "long_short_annual", "long_short_sharpe",
    "long_annual", "long_sharpe", "long_excess_annual", "short_excess_annual", "long_excess_ir",
]


def factor_scan(long: DataFrame, *, buckets: int = 10, periods_per_year: int = 12, stage: Stage = as_is) -> DataFrame:
    """One row per factor, return and scope with every measure above.

    The tables per (case, date) are read several times; ``stage`` stores these
    two small tables so that ranks and buckets of the rows are made once.
    """
    summary = ic_summary(stage(information_coefficients(long), "ic"), periods_per_year)
    cells = stage(bucket_returns(long, buckets), "cells")
    return (
        summary.join(monotonicity(cells, summary), CASE, "left")
        .join(return_metrics(direction_series(cells, summary), periods_per_year), CASE, "left")
        .select(*CASE, *SCAN_COLUMNS)
    )


def factor_screen(scan: DataFrame) -> DataFrame:
    """Union of three rules: ordering power, good long side, bad short side."""
    ordering = (
        (F.abs("ic_mean") > 0.04)
        & (F.abs("icir_annual") > 2)
        & ((F.col("ic_hit_ratio") > 0.75) | (F.col("ic_hit_ratio") < 0.25))
    )
    long_side = (F.col("long_sharpe") > 0.6) & (F.col("long_excess_annual") > 0.05)
    short_side = F.col("short_excess_annual") < -0.15
    return scan.where(ordering | long_side | short_side)


def two_factor_cells(
    df: DataFrame,
    period: str,
    first: str,
    second: str,
    ret: str,
    *,
    q1: int = 5,
    q2: int = 5,
    sequential: bool = False,
    bins1: Sequence[float] | None = None,
    bins2: Sequence[float] | None = None,
) -> DataFrame:
    """Mean excess return, factor medians and sample share per bucket pair with margins (0 = margin)."""
    rows = df.where(F.col(first).isNotNull() & F.col(second).isNotNull() & F.col(ret).isNotNull())
    if bins1 is not None and bins2 is not None:
        rows = rows.withColumns({"bucket1": fixed_bucket(first, bins1), "bucket2": fixed_bucket(second, bins2)})
    elif sequential:
        rows = sequential_buckets(rows, period, first, second, q1=q1, q2=q2)
    else:
        rows = quantile_bucket(rows, [period], first, "bucket1", buckets=q1, few_groups=True)
        rows = quantile_bucket(rows, [period], second, "bucket2", buckets=q2, few_groups=True)
    rows = rows.where("bucket1 is not null and bucket2 is not null")
    rows = excess_over_mean(rows, [period], ret, "excess", few_groups=True)
    cells = (
        rows.cube("bucket1", "bucket2")
        .agg(F.avg("excess").alias("excess_mean"), F.count("*").alias("_n"))
        .select(
            F.coalesce("bucket1", F.lit(0)).alias("bucket1"), F.coalesce("bucket2", F.lit(0)).alias("bucket2"), "excess_mean", "_n"
        )
    )
    total = F.max("_n").over(Window.partitionBy(F.lit(0)))
    shares = cells.withColumn("sample_share", ratio("_n", total)).drop("_n")
    medians = median_margins(rows, "bucket1", "bucket2", [first, second])
    return shares.join(medians, ["bucket1", "bucket2"], "left")


def combine_factors(df: DataFrame, period: str, entity: str, factors: Sequence[str], returns: Sequence[str], size: int = 2) -> DataFrame:
    """Long rows of every subset of the given size: the mean of its non-null members."""
    missing = [f for f in factors if f not in df.columns]
    if missing:
        raise ValueError(f"not in the table: {missing}")
    subsets = list(combinations(factors, size))
    cells = ", ".join(
        "struct('{name}' as factor, '{y}' as ret, ({total}) / nullif({count}, 0) as value, cast({y} as double) as y)".format(
            name=",".join(s),
            y=y,
            total=" + ".join(f"coalesce(cast({f} as double), 0D)" for f in s),
            count=" + ".join(f"if({f} is null, 0, 1)" for f in s),
        )
        for s in subsets
        for y in returns
    )
    return (
        df.select(
            F.col(period).alias("period"), F.col(entity).alias("entity"), F.lit("total").alias("scope"),
            F.expr(f"inline(array({cells}))"),
        )
        .where("value is not null and y is not null")
        .select(*CASE, "period", "entity", "value", "y")
    )


def member_frequency(scan: DataFrame, k: int = 5) -> DataFrame:
    """How often each factor is a member of the k best combinations by mean rank correlation."""
    best = scan.orderBy(F.desc("ic_mean"), "factor").limit(k)
    return best.select(F.explode(F.split("factor", ",")).alias("member")).groupBy("member").agg(F.count("*").alias("n"))


def ic_matrix(ic: DataFrame, factors: Sequence[str]) -> DataFrame:
    """Dates in rows, factors in columns."""
    out = ic.groupBy("period").pivot("factor", list(factors)).agg(F.max("ic"))
    return out.select("period", *[F.col(f"`{f}`") for f in factors])
