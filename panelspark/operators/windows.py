"""Per-entity time windows.

The input is a panel: one row per entity and period (see ``dedupe_by_key``), so
a window partition is at most as long as the calendar, however many raw rows
the entity had. All columns over one (entity, period) order share one shuffle
and one sort.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from panelspark.functions.numeric import as_col, guarded_ratio, ratio


def by_time(entity: str | Sequence[str], period: str) -> WindowSpec:
    keys = [entity] if isinstance(entity, str) else list(entity)
    return Window.partitionBy(*keys).orderBy(period)


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    """The current row and the n - 1 rows before it."""
    return w.rowsBetween(-(n - 1), 0)


def to_date_rows(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def rolling(agg, c: Column | str, w: WindowSpec, n: int, min_rows: int | None = None) -> Column:
    """Aggregate over n rows, NULL until min_rows (default n) values are present."""
    c = as_col(c)
    frame = trailing(w, n)
    return F.when(F.count(c).over(frame) >= (n if min_rows is None else min_rows), agg(c).over(frame))


def moving_average(c, w, n):
    return rolling(F.avg, c, w, n)


def moving_std(c, w, n):
    return rolling(F.stddev_samp, c, w, n)


def above_average_flag(c: Column | str, ma: Column | str) -> Column:
    """1.0 above the average, 0.0 below it or while the average is missing."""
    return F.coalesce(as_col(c) > as_col(ma), F.lit(False)).cast("double")


def change(c: Column | str, w: WindowSpec, k: int = 1) -> Column:
    """c / c k rows earlier - 1."""
    return ratio(c, F.lag(as_col(c), k).over(w)) - F.lit(1.0)


def single_period(c: Column | str, first_period: Column, w: WindowSpec) -> Column:
    """Cumulative figure to period figure; the first period of a year keeps its value."""
    c = as_col(c)
    return F.when(first_period, c).otherwise(c - F.lag(c).over(w))


def year_over_year(c: Column | str, w: WindowSpec, threshold: float, lag: int = 4) -> Column:
    c = as_col(c)
    before = F.lag(c, lag).over(w)
    return guarded_ratio(c - before, F.abs(before), threshold)


def forward_fill(c: Column | str, w: WindowSpec, limit: int | None = None) -> Column:
    """Last non-null value, at most ``limit`` rows back when given."""
    start = Window.unboundedPreceding if limit is None else -limit
    return F.last(as_col(c), ignorenulls=True).over(w.rowsBetween(start, 0))


def annual_hold(c: Column | str, is_annual: Column, w: WindowSpec, limit: int = 3) -> Column:
    """Keep annual values and hold them for the following ``limit`` rows."""
    return forward_fill(F.when(is_annual, as_col(c)), w, limit)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order; a row_number filter, pre-limited per task by Spark."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def top_rows_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def trailing_blocks(df: DataFrame, entity: str | Sequence[str], period: str, values: Sequence[str], window: int, types: dict[str, str], make, *, undated_last: bool = False) -> DataFrame:
    """Add columns that numpy makes from the last ``window`` rows of each row of its entity.

    df is a panel. Spark sorts the rows of each entity, those without a period first unless ``undated_last``; numpy walks over blocks of
    them, in which many entities lie side by side, and keeps the last window - 1
    rows of a block for the next one. ``make(x, null, place)`` gets the values as
    doubles and their missing ones by column, and the number of each new row in its
    entity, from 1; rows before the new ones belong to the blocks before. It
    returns the columns named in types.
    """
    at = F.asc_nulls_last(period) if undated_last else F.asc(period)
    numbered = df.withColumns({v: F.col(v).cast("double") for v in values}).withColumn("_i", F.row_number().over(Window.partitionBy(*([entity] if isinstance(entity, str) else entity)).orderBy(at)))
    kept = [f.name for f in numbered.schema.fields if f.name != "_i"]
    schema = ", ".join([*[f"`{c}` {numbered.schema[c].dataType.simpleString()}" for c in kept], *[f"`{c}` {t}" for c, t in types.items()]])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, null = {v: np.zeros(0) for v in values}, {v: np.zeros(0, bool) for v in values}
        for batch in batches:
            column = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
            for v in values:
                tail = max(0, len(x[v]) - window + 1)
                x[v] = np.concatenate([x[v][tail:], column[v].fill_null(0.0).to_numpy(zero_copy_only=False)])
                null[v] = np.concatenate([null[v][tail:], column[v].is_null().to_numpy(zero_copy_only=False)])
            with np.errstate(all="ignore"):
                made = make(x, null, column["_i"].to_numpy())
            yield pa.RecordBatch.from_arrays([*[column[c] for c in kept], *[made[c] for c in types]], names=[*kept, *types])

    return numbered.mapInArrow(blocks, schema)


def earlier_rows(x: np.ndarray, rows: int, k: int) -> np.ndarray:
    """The values k rows before each of the last ``rows``; before the first value stand zeros."""
    at = len(x) - rows - k
    return x[at : at + rows] if at >= 0 else np.concatenate([np.zeros(min(-at, rows), x.dtype), x[: max(0, at + rows)]])


def rank_share_columns(x: np.ndarray, missing: np.ndarray, place: np.ndarray, windows: Sequence[int], min_rows: int) -> dict[int, pa.Array]:
    """(average rank - 1) / (count - 1) of the last value in each window; missing values and NaN have no part, infinite ones count but have no rank."""
    rows, out = len(place), {}
    there = ~missing & ~np.isnan(x)
    ranked = there & np.isfinite(x)
    now, known = earlier_rows(x, rows, 0), earlier_rows(ranked, rows, 0)
    count, finite, twice = np.zeros(rows, np.int32), np.zeros(rows, np.int32), np.zeros(rows, np.int32)
    deepest = int(place.max()) if rows else 0
    for k in range(max(windows)):
        if k < deepest:  # no row of the block has a row further back
            old, inside = earlier_rows(x, rows, k), place > k
            valid = earlier_rows(ranked, rows, k) & inside
            count += earlier_rows(there, rows, k) & inside
            finite += valid
            twice += ((old < now) & valid).view(np.int8) + ((old <= now) & valid).view(np.int8)
        if k + 1 in windows:
            out[k + 1] = pa.array((twice - 1) / 2.0 / (count - 1), mask=~(known & (finite >= min_rows) & (count > 1)))
    return out


def moving_columns(x: np.ndarray, missing: np.ndarray, place: np.ndarray, n: int, deviation: bool) -> pa.Array:
    """Mean or sample deviation of n values, NULL until all n are present."""
    rows = len(place)
    full = place >= n
    total = np.zeros(rows)
    for k in range(n - 1, -1, -1):
        full &= ~earlier_rows(missing, rows, k)
        total += earlier_rows(x, rows, k)
    mean = total / n
    if not deviation:
        return pa.array(mean, mask=~full)
    squares = np.zeros(rows)
    for k in range(n - 1, -1, -1):
        off = earlier_rows(x, rows, k) - mean
        squares += off * off
    return pa.array(np.sqrt(squares / (n - 1)), mask=~full | (n < 2))


def rolling_rank_share(
    df: DataFrame,
    entity: str,
    period: str,
    values: Sequence[str],
    windows: dict[str, int],
    *,
    min_rows: int = 120,
    name: str = "{value}_tsrank_{window}",
) -> DataFrame:
    """(average rank - 1) / (count - 1) of the current value in its trailing window.

    Windows reach 1 250 rows; numpy compares blocks of rows with the rows before them.
    """
    names = {(v, w): name.format(value=v, window=w) for v in values for w in windows}

    def make(x, null, place):
        shares = {v: rank_share_columns(x[v], null[v], place, list(windows.values()), min_rows) for v in values}
        return {c: shares[v][windows[w]] for (v, w), c in names.items()}

    slim = df.select(entity, period, *values)
    out = trailing_blocks(slim, entity, period, values, max(windows.values()), dict.fromkeys(names.values(), "double"), make, undated_last=True)
    return out.select(entity, period, *names.values())


def period_index(df: DataFrame, period: str) -> DataFrame:
    """Distinct periods with a dense index from 1 and the last index; calendar-sized."""
    days = df.select(period).distinct().withColumn("_one", F.lit(1))
    return days.select(
        period,
        F.row_number().over(Window.partitionBy("_one").orderBy(period)).alias("trade_idx"),
        F.count("*").over(Window.partitionBy("_one")).alias("last_idx"),
    )


def forward_returns(
    df: DataFrame,
    entity: str,
    period: str,
    price: str,
    horizons: Sequence[int],
    *,
    halted: str | None = None,
    ret_name: str = "fwd_ret_{n}",
    halt_name: str = "is_halted_{n}",
) -> DataFrame:
    """price[t+1+n] / price[t+1] - 1 counted on the shared calendar of all entities.

    Missing days carry the last price forward. A range frame over the shared
    day index that ends k days ahead finds that price directly, so no date x
    entity grid is built. Flags are 1 when entry or exit is halted or beyond
    the calendar.
    """
    rows = df.join(F.broadcast(period_index(df, period)), period)
    w = Window.partitionBy(entity).orderBy("trade_idx")

    def ahead(c: str, k: int) -> Column:
        value = F.last(c, ignorenulls=True).over(w.rangeBetween(Window.unboundedPreceding, k))
        return F.when(F.col("trade_idx") + k <= F.col("last_idx"), value)

    cols = {}
    entry = ahead(price, 1)
    for n in horizons:
        cols[ret_name.format(n=n)] = ratio(ahead(price, n + 1), entry) - F.lit(1.0)
        if halted:
            closed = (F.coalesce(ahead(halted, 1), F.lit(1)) == 1) | (F.coalesce(ahead(halted, n + 1), F.lit(1)) == 1)
            cols[halt_name.format(n=n)] = closed.cast("int")
    return rows.withColumns(cols).drop("trade_idx", "last_idx")


def rolling_trend(price: Column | str, idx: Column | str, w: WindowSpec, n: int) -> tuple[Column, Column]:
    """(R squared, slope) of price on the row index over n rows; flat prices give (0, 0)."""
    price, idx = as_col(price), as_col(idx)
    frame = trailing(w, n)
    full = F.count(price).over(frame) == n
    flat = F.max(price).over(frame) == F.min(price).over(frame)
    r2 = F.when(full, F.when(flat, F.lit(0.0)).otherwise(F.regr_r2(price, idx).over(frame)))
    slope = F.when(full, F.when(flat, F.lit(0.0)).otherwise(F.regr_slope(price, idx).over(frame)))
    return r2, slope


def row_index(w: WindowSpec) -> Column:
    return F.row_number().over(w).cast("double")


def cumulative_return(r: Column | str, w: WindowSpec) -> Column:
    return F.exp(F.sum(F.log1p(as_col(r))).over(to_date_rows(w))) - F.lit(1.0)


def rolling_max_drawdown(price: Column | str, w: WindowSpec, n: int, *, full: bool = True) -> Column:
    """Largest fall from an earlier peak inside the last n rows, as a negative share.

    The frame is collected (n values at most) and folded once: state is the
    running peak and the deepest fall.
    """
    price = as_col(price)
    frame = trailing(w, n)
    start = F.struct(F.lit(None).cast("double").alias("peak"), F.lit(0.0).alias("fall"))

    def step(acc: Column, p: Column) -> Column:
        peak = F.greatest(acc["peak"], p)
        return F.struct(peak.alias("peak"), F.least(acc["fall"], ratio(p - peak, peak)).alias("fall"))

    deepest = F.aggregate(F.collect_list(price).over(frame), start, step, lambda acc: acc["fall"])
    return F.when(F.count(price).over(frame) == n, deepest) if full else deepest


def run_length(flag: Column | str, w: WindowSpec) -> Column:
    """Length of the current run of true rows, 0 on a false row."""
    flag = F.coalesce(as_col(flag).cast("boolean"), F.lit(False))
    here = F.row_number().over(w)
    last_false = F.max(F.when(~flag, here)).over(to_date_rows(w))
    return here - F.coalesce(last_false, F.lit(0))
