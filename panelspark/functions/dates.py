"""Date helpers. Everything inside the library is DateType."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelspark.functions.numeric import as_col


def parse_date(c: Column | str) -> Column:
    """Accept yyyyMMdd and yyyy-MM-dd text, anything else is NULL."""
    c = as_col(c).cast("string")
    return F.coalesce(
        F.try_to_timestamp(F.when(F.length(c) == 8, c), F.lit("yyyyMMdd")).cast("date"),
        F.try_to_timestamp(F.when(F.length(c) == 10, c), F.lit("yyyy-MM-dd")).cast("date"),
    )


def month_start(c: Column | str) -> Column:
    return F.trunc(as_col(c), "month")


def month_end(c: Column | str) -> Column:
    return F.last_day(as_col(c))


def quarter_end(c: Column | str) -> Column:
    """Last natural day of the quarter that holds the date."""
    return F.last_day(F.add_months(F.trunc(as_col(c), "quarter"), 2))


def is_weekday(c: Column | str) -> Column:
    return F.weekday(as_col(c)) < F.lit(5)


def revision_start(watermark: Column | str, today: Column | str, *, days: int = 0, quarters: int = 0) -> Column:
    """Re-read from the watermark or from the revision window, whichever is earlier."""
    today = as_col(today)
    window = F.date_sub(today, days) if days else F.add_months(F.trunc(today, "quarter"), -3 * quarters)
    return F.least(as_col(watermark), window)
