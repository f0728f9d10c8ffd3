"""Trading-calendar operators. A calendar has columns exchange, cal_date, is_open.

A calendar has one row per natural day (about 36 500 per century), so it is the
one table here that is always safe to broadcast and to order in one task.
Functions that match dates with a calendar use one exchange: the named one, or
the first by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.dates import is_weekday


def day_table(calendar: DataFrame) -> DataFrame:
    """Every natural day with the nearest open day on both sides and dense indexes.

    prev_open / next_open include the day itself; n_before is the number of
    open days up to and including the day.
    """
    back = Window.partitionBy("exchange").orderBy("cal_date").rowsBetween(Window.unboundedPreceding, 0)
    ahead = Window.partitionBy("exchange").orderBy("cal_date").rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy("exchange")
    open_day = F.when(F.col("is_open") == 1, F.col("cal_date"))
    return calendar.withColumns(
        {
            "prev_open": F.max(open_day).over(back),
            "next_open": F.min(open_day).over(ahead),
            "first_open": F.min(open_day).over(everything),
            "last_open": F.max(open_day).over(everything),
            "n_before": F.sum("is_open").over(back),
        }
    )


def of_exchange(calendar: DataFrame, exchange: str | None = None) -> DataFrame:
    """The days of one exchange: the named one, or the first by name."""
    return calendar.where(F.col("exchange") == (F.lit(exchange) if exchange else calendar.agg(F.min("exchange")).scalar()))


def trading_index(calendar: DataFrame) -> DataFrame:
    """Open days with a dense index from 1."""
    w = Window.partitionBy("exchange").orderBy("cal_date")
    return calendar.where("is_open = 1").select(
        "exchange", "cal_date", F.row_number().over(w).alias("trade_idx")
    )


def is_trading_day(dates: DataFrame, calendar: DataFrame, col: str = "d", out: str = "is_trading", *, exchange: str | None = None) -> DataFrame:
    """Calendar flag; a day outside the calendar counts as open from Monday to Friday."""
    calendar = of_exchange(calendar, exchange)
    known = calendar.select(F.col("cal_date").alias(col), F.col("is_open").alias("_open"))
    return (
        dates.join(F.broadcast(known), col, "left")
        .withColumn(out, F.coalesce(F.col("_open"), is_weekday(col).cast("int")))
        .drop("_open")
    )


def trading_days_between(calendar: DataFrame, start, end, *, exchange: str | None = None) -> DataFrame:
    calendar = of_exchange(calendar, exchange)
    return (
        calendar.where((F.col("is_open") == 1) & F.col("cal_date").between(F.lit(start), F.lit(end)))
        .select("cal_date")
        .orderBy("cal_date")
    )


def _bounds(calendar: DataFrame) -> tuple[Column, Column]:
    """First and last open day as scalar subqueries."""
    opened = calendar.where("is_open = 1")
    return opened.agg(F.min("cal_date")).scalar(), opened.agg(F.max("cal_date")).scalar()


def _clamped(dates: DataFrame, calendar: DataFrame, col: str) -> DataFrame:
    first, last = _bounds(calendar)
    return dates.withColumn("_d", F.greatest(F.least(F.col(col), last), first)).withColumns(
        {"_early": F.col(col) < first, "_late": F.col(col) > last, "_first": first, "_last": last}
    )


_HELPERS = ["_d", "_early", "_late", "_first", "_last"]


def nearest_trading_day(
    dates: DataFrame, calendar: DataFrame, col: str = "d", out: str = "trading_day", *, backward: bool = True, exchange: str | None = None
) -> DataFrame:
    """Latest open day up to the date (or first one from it), clamped to the calendar."""
    calendar = of_exchange(calendar, exchange)
    days = day_table(calendar).select(
        F.col("cal_date").alias("_d"), F.col("prev_open" if backward else "next_open").alias(out)
    )
    return _clamped(dates, calendar, col).join(F.broadcast(days), "_d", "left").drop(*_HELPERS)


def shift_trading_days(
    dates: DataFrame, calendar: DataFrame, n: int, col: str = "d", out: str = "shifted", *, exchange: str | None = None
) -> DataFrame:
    """n open days earlier (n < 0) or later (n > 0), clamped to the calendar ends.

    From a closed day the first step lands on the neighbouring open day.
    """
    calendar = of_exchange(calendar, exchange)
    k = abs(n)
    days = day_table(calendar).where("prev_open is not null").select(
        F.col("cal_date").alias("_d"), F.col("n_before").alias("_i"), F.col("is_open").alias("_is")
    )
    target = (
        F.col("_i") - F.when(F.col("_is") == 1, F.lit(k)).otherwise(F.lit(k - 1))
        if n <= 0
        else F.col("_i") + F.lit(k)
    )
    index = trading_index(calendar).select(F.col("trade_idx").alias("_target"), F.col("cal_date").alias("_hit"))
    found = (
        _clamped(dates, calendar, col)
        .join(F.broadcast(days), "_d", "left")
        .withColumn("_target", target.cast("int"))
        .join(F.broadcast(index), "_target", "left")
    )
    limit = F.col("_first") if n <= 0 else F.col("_last")
    outside = F.when(F.col("_early"), F.col("_first")).when(F.col("_late"), F.col("_last"))
    return found.withColumn(out, F.coalesce(outside, F.col("_hit"), limit)).drop(
        *_HELPERS, "_i", "_is", "_target", "_hit"
    )


def period_last_days(calendar: DataFrame, grain: str, *, exchange: str | None = None) -> DataFrame:
    """Last open day of every week or month: columns grain_start, last_day."""
    calendar = of_exchange(calendar, exchange)
    key = F.trunc("cal_date", grain)
    return calendar.where("is_open = 1").groupBy(key.alias("grain_start")).agg(F.max("cal_date").alias("last_day"))


def last_day_of_period(
    dates: DataFrame, calendar: DataFrame, grain: str, col: str = "d", out: str = "last_day", *, exchange: str | None = None
) -> DataFrame:
    """Last open day of the week or month, if not after the date; otherwise of an earlier period."""
    calendar = of_exchange(calendar, exchange)
    ends = period_last_days(calendar, grain).select(F.col("last_day").alias("cal_date"), F.lit(1).alias("_end"))
    back = Window.partitionBy("exchange").orderBy("cal_date").rowsBetween(Window.unboundedPreceding, 0)
    days = (
        calendar.join(F.broadcast(ends), "cal_date", "left")
        .select(F.col("cal_date").alias("_d"), F.max(F.when(F.col("_end") == 1, F.col("cal_date"))).over(back).alias("_hit"))
    )
    outside = F.when(F.col("_early"), F.col("_first")).when(F.col("_late"), F.col("_last"))
    return (
        _clamped(dates, calendar, col)
        .join(F.broadcast(days), "_d", "left")
        .withColumn(out, F.coalesce(outside, F.col("_hit"), F.col("_last")))
        .drop(*_HELPERS, "_hit")
    )


def quarter_ends_between(start: Column, end: Column) -> Column:
    """Array of quarter ends inside the closed range."""
    first = F.last_day(F.add_months(F.trunc(start, "quarter"), 2))
    last = F.last_day(F.add_months(F.trunc(end, "quarter"), 2))
    steps = F.sequence(F.trunc(first, "quarter"), F.trunc(last, "quarter"), F.expr("interval 3 month"))
    return F.filter(
        F.transform(steps, lambda q: F.last_day(F.add_months(q, 2))), lambda d: (d >= start) & (d <= end)
    )


def recent_quarter_ends(date: Column, n: int) -> Column:
    """The last n quarter ends up to the date, oldest first."""
    return F.slice(quarter_ends_between(F.add_months(date, -3 * n - 3), date), -n, n)


def expected_dates(calendar: DataFrame, grain: str, start, end, *, exchange: str | None = None) -> DataFrame:
    """Days on which a source should have rows: trade_day, week_end, month_end or quarter_end."""
    calendar = of_exchange(calendar, exchange)
    start, end = F.lit(start).cast("date"), F.lit(end).cast("date")
    if grain == "quarter_end":
        one = calendar.select("exchange").distinct()
        return one.select(F.explode(quarter_ends_between(start, end)).alias("biz_date"))
    opened = calendar.where(F.col("cal_date").between(start, end))
    if grain == "trade_day":
        return opened.where("is_open = 1").select(F.col("cal_date").alias("biz_date"))
    unit = {"week_end": "week", "month_end": "month"}[grain]
    return period_last_days(opened, unit).select(F.col("last_day").alias("biz_date"))


def rebalance_days(calendar: DataFrame, frequency: str, *, exchange: str | None = None) -> DataFrame:
    """Open days with a flag: first day, or a new week / month; D flags every day."""
    calendar = of_exchange(calendar, exchange)
    w = Window.partitionBy("exchange").orderBy("cal_date")
    part = {"W": F.weekofyear("cal_date"), "M": F.month("cal_date"), "D": F.unix_date("cal_date")}[frequency]
    opened = calendar.where("is_open = 1").withColumn("_p", part)
    before = F.lag("_p").over(w)
    return opened.select("cal_date", (before.isNull() | (F.col("_p") != before)).cast("int").alias("is_rebalance"))


def earlier_month(months: DataFrame, k: int, col: str = "month", out: str = "earlier") -> DataFrame:
    """The k-th earlier month that is present in the list."""
    w = Window.partitionBy(F.lit(1)).orderBy(col)
    return months.withColumn(out, F.lag(col, k).over(w))
