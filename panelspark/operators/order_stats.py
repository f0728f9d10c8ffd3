"""Exact ranks and quantiles per group that never put a whole group in one task.

A group (usually one date) may hold a large share of all rows. Values are cut
into slices by a fixed increasing function, so slice order is value order, and
rows are counted per (group, slice) with map-side combine. The running count
over slices gives every slice its offset; only the slices that contain a wanted
position are looked at in detail. A slice with many values (narrow data: times,
ids, prices around one level) is cut again, evenly between its own least and
largest value. A tie, however large, is one counted row.
Slices depend on the values alone, so a recomputed task always finds the same
ones, and they only steer the split: results are exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# About 0.1 percent of relative width per slice; at most ~100k slices a group.
SLICES_PER_E_FOLD = 1024.0
SMALLEST_SCALE = 1e6
# Fine slices that quantiles count as one; fewer cells are shuffled, and only the slices of the wanted positions are read closely.
WIDE = 16
# Pieces of about equal size into which the values of a group of `listed_medians` are dealt.
PIECES = 64
# Values of a slice above which it is cut again into pieces of about so many.
FEW = 2000


def value_slice(v: Column) -> Column:
    """Increasing integer function of the value."""
    scaled = F.signum(v) * F.log1p(F.abs(v) * F.lit(SMALLEST_SCALE)) * F.lit(SLICES_PER_E_FOLD)
    return F.floor(scaled).cast("long")


def _piece(v: Column, lo: Column, hi: Column, n: Column) -> Column:
    """Increasing number of the piece of a slice [lo, hi] of n values; 0 where the slice is not cut."""
    pieces = F.ceil(n / F.lit(FEW))
    at = F.least(F.floor((v - lo) / (hi - lo) * pieces), pieces - 1)
    return F.coalesce(F.when((n > FEW) & (hi > lo), at), F.lit(0)).cast("long")


def _offsets(counts: DataFrame, by: Sequence[str], order: Sequence[str] = ("_s",)) -> DataFrame:
    """counts(by, order, _cnt) -> + _below (rows in lower slices) and _n (rows in the group)."""
    group = Window.partitionBy(*by)
    before = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumns(
        {
            "_below": F.coalesce(F.sum("_cnt").over(before), F.lit(0)),
            "_n": F.sum("_cnt").over(group),
        }
    )


def attach(df: DataFrame, stats: DataFrame, by: Sequence[str], few_groups: bool) -> DataFrame:
    """Left join per-group values to rows.

    few_groups says that the table has one row per calendar period: it is broadcast,
    and the rows stay where they are. Other joins are left to adaptive execution,
    which checks the real size but only after the rows have been shuffled.
    """
    return df.join(F.broadcast(stats) if few_groups else stats, list(by), "left")


def group_quantiles(
    df: DataFrame,
    by: Sequence[str],
    values: Sequence[str],
    probs: Sequence[tuple[int, int]],
    *,
    few_groups: bool = False,
) -> DataFrame:
    """Linear-interpolated quantiles of several columns, one row per group.

    probs are fractions (1, 2) = median. Columns are named ``{value}_q{i}`` in
    the order of probs, plus ``{value}_n``, the count of non-null values. With
    few_groups (calendar periods) the wanted slices are broadcast and the rows are
    not shuffled, but for those in such a slice.
    """
    by = list(by)
    small = F.broadcast if few_groups else (lambda df: df)
    keys = [*by, "_c"]
    pairs = ", ".join(f"struct({i} as _c, cast({v} as double) as _v)" for i, v in enumerate(values))
    rows = (
        df.select(*by, F.expr(f"inline(array({pairs}))"))
        .where("_v is not null and not isnan(_v)")
        .withColumn("_s", F.floor(value_slice(F.col("_v")) / F.lit(WIDE)).cast("long"))
    )
    sizes = [F.count("*").alias("_cnt"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")]
    hist = _offsets(rows.groupBy(*keys, "_s").agg(*sizes), keys)

    # Zero-based positions around each quantile, in whole numbers.
    low = [f"(((_n - 1) * {a}L) div {b}L)" for a, b in probs]
    rest = [f"(((_n - 1) * {a}L) % {b}L)" for a, b in probs]
    high = [f"({lo} + if({re} > 0, 1, 0))" for lo, re in zip(low, rest)]
    positions = dict.fromkeys([*low, *high])
    wanted = " or ".join(f"({p} >= _below and {p} < _below + _cnt)" for p in positions)
    targets = hist.where(wanted).select(*keys, "_s", "_below", "_n", "_lo", "_hi", F.col("_cnt").alias("_k"))
    picked = rows.join(small(targets), [*keys, "_s"]).withColumn("_f", _piece(F.col("_v"), F.col("_lo"), F.col("_hi"), F.col("_k")))
    ties = picked.groupBy(*keys, "_s", "_f", "_v", "_below", "_n").agg(F.count("*").alias("_ties"))
    # pieces that hold a wanted position, with the rows below them
    pieces = picked.groupBy(*keys, "_s", "_f", "_n", F.col("_below").alias("_start")).agg(F.count("*").alias("_cnt"))
    lower = Window.partitionBy(*keys, "_s").orderBy("_f").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("_below", F.col("_start") + F.coalesce(F.sum("_cnt").over(lower), F.lit(0))).where(wanted)
    ties = ties.drop("_below", "_n").join(small(pieces.drop("_start", "_cnt")), [*keys, "_s", "_f"])
    before = Window.partitionBy(*keys, "_s", "_f").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ties.withColumn("_less", F.col("_below") + F.coalesce(F.sum("_ties").over(before), F.lit(0)))

    aggs, outputs = [], []
    for c, v in enumerate(values):
        aggs.append(f"max(if(_c = {c}, _n, null)) as {v}_n")
        outputs.append(f"{v}_n")
        for i, (_, b) in enumerate(probs):
            for tag, p in (("lo", low[i]), ("hi", high[i])):
                aggs.append(f"max(if(_c = {c} and {p} >= _less and {p} < _less + _ties, _v, null)) as _{c}_{i}_{tag}")
            aggs.append(f"max(if(_c = {c}, {rest[i]}, null)) as _{c}_{i}_r")
            outputs.append(f"_{c}_{i}_lo + (_{c}_{i}_hi - _{c}_{i}_lo) * (_{c}_{i}_r / {float(b)}D) as {v}_q{i}")
    return ranked.groupBy(*by).agg(*[F.expr(a) for a in aggs]).selectExpr(*by, *outputs)


def _piece_bounds(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per group: the least values of about PIECES runs of equal size, in order.

    Runs end at slices; a slice with more values than a run is cut evenly between its
    own least and largest value. The bounds follow from counts and extremes alone.
    """
    sliced = df.groupBy(*by, value_slice(F.col("_v")).alias("_s"))
    cells = _offsets(sliced.agg(F.count("*").alias("_cnt"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")), by)
    bounds = f"""if(_cnt * {PIECES} > _n and _hi > _lo,
      transform(sequence(0L, (_cnt * {PIECES}L) div _n), i -> _lo + (_hi - _lo) * (i / ((_cnt * {PIECES}L) div _n + 1))),
      if((_below * {PIECES}L) div _n < ((_below + _cnt) * {PIECES}L) div _n, array(_lo), array()))"""
    return cells.groupBy(*by).agg(F.sort_array(F.flatten(F.collect_list(F.expr(bounds)))).alias("_bounds"))


def listed_medians(df: DataFrame, by: Sequence[str], ids: str, values: Sequence[str]) -> DataFrame:
    """Exact medians of several columns per (id, group) for rows that count for every id of a list.

    One row per (id, group) with ``{value}_q0``, as ``group_quantiles`` gives for the
    rows copied to the ids of their list. The copies are never shuffled: the lists of a
    group are dealt by runs of values, copies are counted where they lie, and only the
    runs in the middle of an id are looked at closely, in the same place. ``by`` is
    bounded by the calendar, like the bounds that are broadcast; an id is a number.
    """
    by = list(by)
    keys, place = [*by, "_c"], [*by, "_c", "_p"]
    pairs = ", ".join(f"struct({i} as _c, cast({v} as double) as _v)" for i, v in enumerate(values))
    rows = df.select(*by, F.col(ids).alias("_ids"), F.expr(f"inline(array({pairs}))")).where("_v is not null and not isnan(_v)")
    bounds = F.broadcast(_piece_bounds(rows.drop("_ids"), keys))
    dealt = rows.where(F.size("_ids") > 0).join(bounds, keys).withColumn("_p", F.size(F.filter("_bounds", lambda b: b <= F.col("_v"))))
    dealt = dealt.drop("_bounds").repartition(*place)
    # both passes read the same columns, so that the rows are dealt once
    cells = dealt.select(*place, "_v", F.explode("_ids").alias("_id")).groupBy(*place, "_id").agg(F.count("_v").alias("_cnt"))
    wanted = " or ".join(f"({p} >= _below and {p} < _below + _cnt)" for p in ("((_n - 1) div 2)", "(_n div 2)"))
    middle = _offsets(cells, [*keys, "_id"], ("_p",)).where(wanted)
    middle = middle.groupBy(*place).agg(F.map_from_entries(F.collect_list(F.struct("_id", F.struct("_below", "_n")))).alias("_want"))
    near = dealt.join(middle.hint("shuffle_hash"), place).select(*place, "_v", "_want", F.explode("_ids").alias("_id"))
    near = near.select(*place, "_id", "_v", F.try_element_at("_want", F.col("_id")).alias("_at")).where("_at is not null")
    ties = near.select(*place, "_id", "_v", "_at.*").groupBy(*place, "_id", "_v", "_below", "_n").agg(F.count("*").alias("_ties"))
    before = Window.partitionBy(*place, "_id").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = ties.withColumn("_less", F.col("_below") + F.coalesce(F.sum("_ties").over(before), F.lit(0)))
    at = lambda c, p: f"max(if(_c = {c} and {p} >= _less and {p} < _less + _ties, _v, null))"
    aggs = [F.expr(f"{at(c, p)} as _{c}_{tag}") for c in range(len(values)) for tag, p in (("lo", "((_n - 1) div 2)"), ("hi", "(_n div 2)"))]
    found = ranked.groupBy(F.col("_id").alias(ids), *by).agg(*aggs)
    return found.selectExpr(ids, *by, *[f"_{c}_lo + (_{c}_hi - _{c}_lo) * 0.5D as {v}_q0" for c, v in enumerate(values)])


def value_ranks(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """One row per (group, distinct value): rows strictly below, ties and group size."""
    by = list(by)
    counts = (
        df.where(F.col(value).isNotNull() & ~F.isnan(value))
        .groupBy(*by, value)
        .agg(F.count("*").alias("_ties"))
        .withColumn("_s", value_slice(F.col(value)))
    )
    v = F.col(value)
    full = counts.groupBy(*by, "_s").agg(F.count("*").alias("_k"), F.min(v).alias("_lo"), F.max(v).alias("_hi")).where(F.col("_k") > FEW)
    counts = counts.join(full, [*by, "_s"], "left").withColumn("_f", _piece(v, F.col("_lo"), F.col("_hi"), F.col("_k"))).drop("_k", "_lo", "_hi")
    place = [*by, "_s", "_f"]
    offsets = _offsets(counts.groupBy(*place).agg(F.sum("_ties").alias("_cnt")), by, ("_s", "_f")).drop("_cnt")
    before = Window.partitionBy(*place).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (
        counts.repartition(*place)  # the pieces of a slice go to different tasks
        .withColumn("_in", F.coalesce(F.sum("_ties").over(before), F.lit(0)))
        .join(offsets, place)
        .select(
            *by,
            value,
            (F.col("_below") + F.col("_in")).alias("_less"),
            F.col("_ties"),
            F.col("_n").alias("_valid"),
        )
    )


def with_average_rank(df: DataFrame, by: Sequence[str], value: str, out: str, *, valid: str | None = None) -> DataFrame:
    """Add the 1-based rank with ties averaged; NULL values get no rank.

    Rows meet their rank in an equi-join on (group, value); adaptive execution
    splits a value shared by very many rows because the other side has one row.
    """
    ranks = value_ranks(df, by, value).select(
        *by,
        value,
        (F.col("_less") + (F.col("_ties") + 1) / F.lit(2.0)).alias(out),
        *([F.col("_valid").alias(valid)] if valid else []),
    )
    return df.join(ranks, [*by, value], "left").select(
        *df.columns, out, *([valid] if valid else [])
    )
