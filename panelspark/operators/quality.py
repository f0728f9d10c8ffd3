"""Data-quality operators: coverage, rules, ranges, duplicates and scale jumps."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.operators.calendar import expected_dates
from panelspark.operators.order_stats import group_quantiles
from panelspark.operators.windows import by_time

PARTIAL_RATIO = 0.5


GRAINS = ("trade_day", "week_end", "month_end", "quarter_end")


def expected_by_source(calendar: DataFrame, sources: DataFrame, start: date, end: date) -> DataFrame:
    """The days on which each source should have rows, beside the source's own columns.

    sources: source, grain (one of GRAINS), first_date, check_partial, one row each.
    A source begins at its first date and not before `start`; all end at `end`. The
    days of a grain are made once, whatever the number of sources.
    """
    days = [expected_dates(calendar, g, start, end).select(F.lit(g).alias("grain"), "biz_date") for g in GRAINS]
    grid = reduce(DataFrame.unionByName, days)
    return sources.join(grid, "grain").where(F.col("biz_date") >= F.coalesce("first_date", F.lit(start)))


def coverage(expected: DataFrame, counts: DataFrame, *, check_partial: bool | str = True) -> DataFrame:
    """Expected days (source, biz_date) against counted rows: OK, MISSING or PARTIAL.

    A day is PARTIAL below half of the year's median of non-empty days, where
    partial days are looked for: everywhere, nowhere, or where a column of the
    expected days says so. Other columns of the expected days are kept.
    """
    by_source = isinstance(check_partial, str)
    looked_for = F.coalesce(F.col(check_partial), F.lit(False)) if by_source else F.lit(check_partial)
    more = [c for c in expected.columns if c not in ("source", "biz_date", "row_count")]
    rows = expected.join(counts, ["source", "biz_date"], "left").select(
        "source", "biz_date", *more, F.coalesce("row_count", F.lit(0)).alias("row_count"), F.year("biz_date").alias("_year")
    )
    filled = rows.where("row_count > 0")
    median = group_quantiles(filled, ["source", "_year"], ["row_count"], [(1, 2)])
    median = median.select("source", "_year", F.bround("row_count_q0", 0).cast("long").alias("year_median"))
    joined = rows.join(median, ["source", "_year"], "left").withColumn(
        "year_median", F.coalesce("year_median", F.lit(0))
    )
    partial = looked_for & (F.col("year_median") > 0) & (
        F.col("row_count") < F.col("year_median") * F.lit(PARTIAL_RATIO)
    )
    status = F.when(F.col("row_count") == 0, "MISSING").when(partial, "PARTIAL").otherwise("OK")
    return joined.withColumn("status", status).drop("_year")


def rule_counts(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violations per rule in one pass, long: rule, violations."""
    wide = df.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    return wide.unpivot([], list(rules), "rule", "violations")


def null_ratios(df: DataFrame, columns: Sequence[str], threshold: float = 0.05) -> DataFrame:
    wide = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    out = wide.unpivot([], list(columns), "column", "null_ratio")
    return out.withColumn("flagged", (F.col("null_ratio") > threshold).cast("int"))


def range_check(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        F.min(column).alias("low"), F.max(column).alias("high"), F.avg(column).alias("mean"),
        F.count_if(F.col(column) <= 0).alias("not_positive"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def year_coverage(df: DataFrame, period: str, *, least_days: int = 200) -> DataFrame:
    """Days, rows and mean rows per day by year, with a flag for thin years."""
    daily = df.groupBy(F.col(period).cast("date").alias("_d")).agg(F.count("*").alias("_n"))
    years = daily.groupBy(F.year("_d").alias("year")).agg(
        F.count("*").alias("days"), F.sum("_n").alias("rows"), F.avg("_n").alias("rows_per_day")
    )
    return years.withColumn("thin", (F.col("days") < least_days).cast("int"))


def period_counts(df: DataFrame, period: Column, *, least: int, annual: Column) -> DataFrame:
    """Rows per report period; annual periods below the limit are flagged."""
    counts = df.groupBy(period.alias("period")).agg(F.count("*").alias("rows"))
    return counts.withColumn("flagged", (annual & (F.col("rows") < least)).cast("int"))


def year_check(df: DataFrame, period: str, year: int) -> DataFrame:
    """First and last date inside one year, rows, and whether the year is empty."""
    rows = df.where(F.col(period).between(F.lit(date(year, 1, 1)), F.lit(date(year, 12, 31))))
    return rows.agg(
        F.count("*").alias("rows"), F.min(period).alias("first"), F.max(period).alias("last"),
        (F.count("*") == 0).cast("int").alias("empty"),
    )


def readiness(inputs: dict[str, DataFrame]) -> DataFrame:
    """One row per input: ready is 1 when it holds at least one row; each input stops at its first row."""
    parts = [
        df.limit(1).agg(F.count("*").cast("int").alias("ready")).select(F.lit(name).alias("source"), "ready")
        for name, df in inputs.items()
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def scale_jumps(df: DataFrame, entity: str, period: str, value: str, *, threshold: float = 1.5, context: int = 10) -> DataFrame:
    """Rows within ``context`` rows of a jump of |log10|value|| by more than the threshold."""
    w = by_time(entity, period)
    size = F.log10(F.nullif(F.abs(value), F.lit(0.0)))
    jump = F.coalesce(F.abs(size - F.lag(size).over(w)) > threshold, F.lit(False)).cast("int")
    near = F.max("jump").over(w.rowsBetween(-context, context))
    return df.withColumn("jump", jump).withColumn("_near", near).where("_near = 1").drop("_near")


def first_above(df: DataFrame, entity: str, period: str, value: str, threshold: float) -> DataFrame:
    """First period per entity with |value| above the threshold."""
    return df.where(F.abs(value) > threshold).groupBy(entity).agg(F.min(period).alias("first_period"))
