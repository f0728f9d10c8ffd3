"""Aggregates over an ordered slice of a short trailing window.

"Sort the last 20 rows by a key, then weigh the first or last n values": the
frame is collected as (key, time, value) structs, at most 20 per row, and all
slices of one key read the same sorted array.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.operators.windows import trailing_blocks


def linear_weights(n: int) -> list[float]:
    """1, 1 - 1/n, ... down to 1/n."""
    return [1.0 - i / n for i in range(n)]


def exponential_weights(n: int) -> list[float]:
    """From 1 down to one half over n values."""
    return [2.0 ** (-i / (n - 1)) for i in range(n)]


def with_sorted_frame(
    df: DataFrame, entity: str, period: str, key: str, values: Sequence[str], out: str, *, window: int = 20
) -> DataFrame:
    """Array of the last ``window`` rows by key descending, later rows first among equal keys.

    Rows with a NULL key go last, as in a descending sort.
    """
    item = F.struct(
        F.when(F.col(key).isNull(), F.lit(1)).otherwise(F.lit(0)).alias("_m"),
        (-F.col(key)).alias("_k"),
        (-F.unix_date(F.col(period))).alias("_t"),
        *[F.col(v).cast("double").alias(v) for v in values],
    )
    frame = Window.partitionBy(entity).orderBy(period).rowsBetween(-(window - 1), 0)
    return df.withColumn(out, F.array_sort(F.collect_list(item).over(frame)))


def slice_columns(
    arr: str, values: dict[str, str], tops: Sequence[int], *, window: int = 20
) -> dict[str, Column]:
    """Top and bottom sums, linear and exponential weights for every value.

    values maps the column inside the array to a name with ``{slice}``. Only
    complete windows give a result.
    """
    out = {}
    for v, name in values.items():
        for n in tops:
            for side, start in (("top", 0), ("bottom", window - n)):
                weights = {"_ld": linear_weights(n), "_exp": exponential_weights(n)}
                items = [f"get({arr}, {start + i}).{v}" for i in range(n)]
                base = name.format(slice=f"{side}{n}")
                # a missing value is skipped in the sum and makes a weighted sum NULL
                sums = {"": " + ".join(f"coalesce({x}, 0D)" for x in items)}
                for tag, w in weights.items():
                    w = w if side == "top" else w[::-1]
                    sums[tag] = " + ".join(f"{x} * {k!r}D" for x, k in zip(items, w))
                for tag, text in sums.items():
                    out[base + tag] = F.expr(f"if(size({arr}) = {window}, {text}, null)")
    return out


def nth_columns(arr: str, value: str, name: str, *, window: int = 20) -> dict[str, Column]:
    """The i-th value of the sorted window, i from 0; name holds ``{i}``."""
    full = F.size(arr) == window
    return {name.format(i=i): F.when(full, F.get(F.col(arr), i)[value]) for i in range(window)}


def enough_history(df: DataFrame, entity: str, period: str, values: Sequence[str], *, lookback: int, least: int) -> DataFrame:
    """Keep rows whose last ``lookback`` rows hold at least ``least`` non-null values of every column."""
    frame = Window.partitionBy(entity).orderBy(period).rowsBetween(-(lookback - 1), 0)
    flags = {f"_h{i}": F.count(v).over(frame) for i, v in enumerate(values)}
    kept = df.withColumns(flags)
    for f in flags:
        kept = kept.where(F.col(f) >= least)
    return kept.drop(*flags)


PACK = ("mean", "std", "zscore", "tsrank", "momentum")


def history_pack(
    df: DataFrame, entity: str, period: str, values: Sequence[str], *, window: int, min_rows: int = 4,
    momentum_lag: int = 12, negatives: Sequence[str] = (),
) -> DataFrame:
    """Mean, population deviation, z, rank share, momentum and negative count over the non-null values of a trailing window.

    df has one row per (entity, period). Columns are named ``{value}_mean`` and so
    on; all columns of df stay. Numpy takes one step per row of the window over
    blocks of rows, see ``trailing_blocks``.
    """
    types = {c: "double" for v in values for c in (f"{v}_{k}" for k in PACK)} | {f"{v}_neg_cnt": "int" for v in values if v in negatives}

    def make(x, null, place):
        out = {}
        for v in values:
            found = _history(x[v], null[v], place, window, min_rows, momentum_lag)
            out |= {f"{v}_{k}": found[k] for k in [*PACK, "neg_cnt"]}
        return out

    return trailing_blocks(df, entity, period, values, window, types, make)


def _history(x: np.ndarray, null: np.ndarray, place: np.ndarray, window: int, min_rows: int, lag: int) -> dict[str, pa.Array]:
    """The pack of the last len(place) values; place is a row's number in its entity, from 1. NaN counts as above every number."""
    first, steps = len(x) - len(place), []
    for back in range(window - 1, -1, -1):  # oldest first
        m = np.flatnonzero(place > back)
        m = m[~null[first + m - back]]
        steps.append((m, x[first + m - back]))
    n, total, latest = np.zeros(len(place), np.int64), np.zeros(len(place)), np.zeros(len(place))
    low, high = np.full(len(place), np.nan), np.full(len(place), -np.inf)
    for m, v in steps:
        n[m] += 1
        total[m] += v
        latest[m] = v
        low[m], high[m] = np.fmin(low[m], v), np.maximum(high[m], v)
    mean = total / n
    squares, not_above, negative, seen, lagged = np.zeros(len(place)), n * 0, n * 0, n * 0, np.zeros(len(place))
    for m, v in steps:
        off = v - mean[m]
        squares[m] += off * off
        not_above[m] += (v <= latest[m]) | np.isnan(latest[m])
        negative[m] += v < 0
        asked = seen[m] == n[m] - 1 - lag
        lagged[m[asked]] = v[asked]
        seen[m] += 1
    enough = n >= min_rows
    flat = (low == high) | (np.isnan(low) & np.isnan(high))
    std = np.where(flat, 0.0, np.sqrt(squares / n))
    moved = enough & (n > lag) & ~(np.abs(lagged) <= 1e-12)
    columns = {
        "mean": (mean, enough),
        "std": (std, enough),
        "zscore": ((latest - mean) / std, enough & ~flat & (std != 0)),
        "tsrank": ((not_above - 1) / (n - 1), enough & (n > 1)),
        "momentum": ((latest - lagged) / np.abs(lagged), moved),
        "neg_cnt": (negative.astype(np.int32), enough),
    }
    return {k: pa.array(v, mask=~there) for k, (v, there) in columns.items()}
