"""Grouped statistics built from aggregates with map-side combine."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.numeric import ratio, safe_corr
from panelspark.operators.order_stats import group_quantiles, value_ranks
from panelspark.operators.windows import by_time


def month_aligned_returns(df: DataFrame, entity: str, period: str, price: str, lags: Sequence[int]) -> DataFrame:
    """Last price of the month over the last price k listed months before, minus 1."""
    months = df.groupBy(entity, F.trunc(period, "month").alias("month")).agg(
        F.max_by(price, period).alias("last_close")
    )
    w = by_time(entity, "month")
    return months.withColumns(
        {f"ret_{k}m": ratio("last_close", F.lag("last_close", k).over(w)) - F.lit(1.0) for k in lags}
    )


def first_last(df: DataFrame, keys: Sequence[str], period: str, value: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min_by(value, period).alias(f"{value}_first"), F.max_by(value, period).alias(f"{value}_last")
    )


def breadth(df: DataFrame, keys: Sequence[str], ret: str) -> DataFrame:
    """Counts of rising and falling rows, up / (up + down) and up / down."""
    counts = df.groupBy(*keys).agg(
        F.count_if(F.col(ret) > 0).alias("up"), F.count_if(F.col(ret) < 0).alias("down")
    )
    return counts.withColumns(
        {"profit_ratio": ratio("up", F.col("up") + F.col("down")), "up_down_ratio": ratio("up", "down")}
    )


def gini(df: DataFrame, keys: Sequence[str], value: str, out: str = "gini", *, least: int = 5) -> DataFrame:
    """Concentration of a non-negative value over the rows of each group.

    2 * sum(rank * x) / (n * sum(x)) - (n + 1) / n. The ranks of tied values
    add up to ties * average rank, so counted distinct values are enough and
    the rows are never numbered one by one.
    """
    ranks = value_ranks(df, keys, value)
    rank = F.col("_less") + (F.col("_ties") + 1) / F.lit(2.0)
    sums = ranks.groupBy(*keys).agg(
        F.max("_valid").alias("_n"),
        F.sum(F.col(value) * F.col("_ties")).alias("_x"),
        F.sum(F.col(value) * F.col("_ties") * rank).alias("_rx"),
    )
    index = ratio(2 * F.col("_rx"), F.col("_n") * F.col("_x")) - (F.col("_n") + 1) / F.col("_n")
    return sums.select(*keys, F.when((F.col("_n") >= least) & (F.col("_x") > 0), index).alias(out))


def average_correlation(
    df: DataFrame, keys: Sequence[str], entity: str, period: str, ret: str, out: str = "avg_correlation", *, least: int = 20
) -> DataFrame:
    """Variance of the equal-weight return over the squared mean of entity deviations."""
    rows = df.where(F.col(ret).isNotNull())
    pool = rows.groupBy(*keys, period).agg(F.avg(ret).alias("_r"), F.count("*").alias("_c"))
    pool = pool.groupBy(*keys).agg(F.var_samp("_r").alias("_v"), F.sum("_c").alias("_rows"))
    single = rows.groupBy(*keys, entity).agg(F.stddev_samp(ret).alias("_s"))
    single = single.groupBy(*keys).agg(F.avg("_s").alias("_s"))
    joined = pool.join(single, list(keys))
    value = F.when((F.col("_rows") >= least) & (F.col("_s") > 0), ratio("_v", F.col("_s") * F.col("_s")))
    return joined.select(*keys, value.alias(out))


def share_below_current(
    df: DataFrame, keys: Sequence[str], period: str, value: str, months: int, out: str, *, least: int = 1
) -> DataFrame:
    """Share of the last ``months`` calendar months with a value strictly below the current one.

    One row per (keys, month) goes in; the frame is a range over month numbers.
    """
    number = F.year(period) * 12 + F.month(period)
    w = Window.partitionBy(*keys).orderBy("_m").rangeBetween(-(months - 1), 0)
    rows = df.withColumn("_m", number).withColumn("_h", F.collect_list(value).over(w))
    below = F.size(F.filter("_h", lambda x: x < F.col(value)))
    return rows.withColumn(
        out, F.when(F.col(value).isNotNull() & (F.size("_h") >= least), ratio(below, F.size("_h")))
    ).drop("_m", "_h")


def quantile_dispersion(df: DataFrame, keys: Sequence[str], value: str, out: str, *, least: int = 10, few_groups=False) -> DataFrame:
    """Upper quartile over lower quartile."""
    q = group_quantiles(df, keys, [value], [(3, 4), (1, 4)], few_groups=few_groups)
    return q.select(
        *keys, F.when(F.col(f"{value}_n") >= least, ratio(f"{value}_q0", f"{value}_q1")).alias(out)
    )


def downside_ratio(ret: Column | str, *, rows: int = 10, sides: int = 3) -> Column:
    """Aggregate: deviation of falling returns over deviation of rising ones."""
    c = F.col(ret) if isinstance(ret, str) else ret
    down, up = F.when(c < 0, c), F.when(c > 0, c)
    enough = (F.count("*") >= rows) & (F.count(down) >= sides) & (F.count(up) >= sides)
    return F.when(enough, ratio(F.stddev_samp(down), F.stddev_samp(up)))


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All pairwise correlations in one aggregate, as long rows (a, b, corr)."""
    pairs = list(combinations(columns, 2))
    wide = df.agg(*[safe_corr(a, b).alias(f"_{i}") for i, (a, b) in enumerate(pairs)])
    items = F.array(
        *[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"_{i}").alias("corr")) for i, (a, b) in enumerate(pairs)]
    )
    return wide.select(F.explode(items).alias("_e")).select("_e.*")


def margins(df: DataFrame, first: str, second: str, aggs: Sequence[Column]) -> DataFrame:
    """Two-way table with row, column and overall margins; a NULL key marks the margin."""
    return df.cube(first, second).agg(*aggs)


def median_margins(df: DataFrame, first: str, second: str, values: Sequence[str]) -> DataFrame:
    """Medians of every cell and margin of a two-way table; 0 marks the margin.

    Rows are copied to their four cells and each copy is a group of its own, so
    the exact median of the whole table is found without one task seeing it.
    """
    cells = df.select(
        *values,
        F.explode(
            F.array(
                *[
                    F.struct(a.cast("int").alias(first), b.cast("int").alias(second))
                    for a in (F.col(first), F.lit(0))
                    for b in (F.col(second), F.lit(0))
                ]
            )
        ).alias("_cell"),
    ).select(*values, f"_cell.{first}", f"_cell.{second}")
    q = group_quantiles(cells, [first, second], values, [(1, 2)])
    return q.select(first, second, *[F.col(f"{v}_q0").alias(f"{v}_median") for v in values])


def missing_rates(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])


def column_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, NULL share, distinct count and P1/25/50/75/99 per numeric column, long."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(F.explode(pairs).alias("_e")).select("_e.*")
    q = group_quantiles(long, ["column"], ["value"], [(1, 100), (1, 4), (1, 2), (3, 4), (99, 100)])
    base = long.groupBy("column").agg(
        F.count("*").alias("rows"), F.avg(F.col("value").isNull().cast("double")).alias("null_share")
    )
    # Distinct values are counted after they are grouped, so no task holds a set of them.
    distinct = (
        long.where("value is not null").groupBy("column", "value").agg(F.lit(1).alias("_o")).groupBy("column").agg(F.count("*").alias("n_distinct"))
    )
    names = ["p1", "p25", "p50", "p75", "p99"]
    return (
        base.join(distinct, "column", "left")
        .join(q, "column", "left")
        .select("column", "rows", "null_share", "n_distinct", *[F.col(f"value_q{i}").alias(n) for i, n in enumerate(names)])
    )


def year_profile(df: DataFrame, period: str, value: str, by: Sequence[str] = (), *, recent: int = 3) -> DataFrame:
    """Mean, min, max and last value per year, with flags: the best and the worst year by mean, and the last years.

    NULL values count in no measure; years without a value have no row. Years of
    equal mean are all best, or all worst.
    """
    rows = df.where(F.col(value).isNotNull())
    years = rows.groupBy(*by, F.year(period).alias("year")).agg(
        F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"), F.max_by(value, period).alias("last")
    )
    w = Window.partitionBy(*(by or [F.lit(1)]))  # the years of the calendar
    flags = {
        "is_best": F.col("mean") == F.max("mean").over(w),
        "is_worst": F.col("mean") == F.min("mean").over(w),
        "is_recent": F.col("year") > F.max("year").over(w) - recent,
    }
    return years.withColumns({k: v.cast("int") for k, v in flags.items()})


def year_month_table(df: DataFrame, period: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per year, one column per month, the last value in the month."""
    rows = df.select(*by, F.year(period).alias("year"), F.month(period).alias("_month"), F.col(period).alias("_at"), F.col(value).alias("_v"))
    out = rows.groupBy(*by, "year").pivot("_month", list(range(1, 13))).agg(F.max_by("_v", "_at"))
    return out.select(*by, "year", *[F.col(f"`{m}`").alias(f"m{m:02d}") for m in range(1, 13)])
