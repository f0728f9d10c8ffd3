"""As-of, interval, snapshot and keyword joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.dates import quarter_end


def _bucket(time: str, bucket: str) -> Column:
    """The start of the calendar bucket."""
    if bucket in ("year", "quarter", "month", "week"):
        return F.trunc(time, bucket)
    if bucket in ("day", "hour"):
        return F.date_trunc(bucket, time)
    raise ValueError(f"bucket {bucket!r} is not one of year, quarter, month, week, day, hour")


# Cells that an overfull bucket is measured in before it is cut.
CELLS = 4096


def _micros(df: DataFrame, time: str) -> Column:
    """A time as whole microseconds, in its own order."""
    if isinstance(df.schema[time].dataType, T.TimestampType):
        return F.unix_micros(time)
    zero = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", zero, F.col(time).cast("timestamp_ntz"))


def _cut_buckets(sides: Sequence[DataFrame], keys: Sequence[str], split: int) -> list[DataFrame]:
    """Each side with the piece `_p` of its (key, bucket): 0 where the bucket holds at most `split` rows of all sides.

    An overfull bucket is measured in CELLS equal spans of time; its pieces end where
    the running count passes a multiple of `split`, so they are cut at quantiles and
    later pieces hold later times. Counts are combined map-side, and the tables of
    overfull buckets have CELLS rows a bucket at most, whatever the rows.
    """
    place = [*keys, "_b"]
    timed = [df.withColumn("_at", _micros(df, "_t")) for df in sides]
    every = reduce(DataFrame.unionByName, [df.select(*place, "_at") for df in timed])
    sizes = every.groupBy(*place).agg(F.count("*").alias("_rows"), F.min("_at").alias("_from"), F.max("_at").alias("_to"))
    full = sizes.where((F.col("_rows") > split) & (F.col("_from") < F.col("_to"))).drop("_rows")
    cell = F.floor((F.col("_at") - F.col("_from")) / (F.col("_to") - F.col("_from")) * (CELLS - 1)).alias("_cell")
    counts = every.join(full, place).groupBy(*place, cell).agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*place).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    pieces = counts.select(*place, "_cell", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / split).cast("int").alias("_p"))
    out = []
    for df in timed:
        placed = df.join(full, place, "left").withColumn("_cell", cell).join(pieces, [*place, "_cell"], "left")
        out.append(placed.withColumn("_p", F.coalesce("_p", F.lit(0))).drop("_at", "_from", "_to", "_cell"))
    return out


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    *,
    bucket: str = "month",
    max_days: int | None = None,
    keep_time: str | None = None,
    tied: bool = False,
    split: int | None = None,
    parts: int | None = None,
) -> DataFrame:
    """Latest right row per key with right_time <= left_time.

    The right side has one row per key and time, or `tied` is set: then equal
    times are decided by the largest values, in the order of `values`.

    Rows are split by (key, time bucket), so a key that holds a large share of
    all rows is spread over its buckets. A bucket starts from the last right
    row of the buckets before it: one carried row per (key, bucket), found on a
    table with at most one row per calendar bucket and key. No inequality join.
    With `split`, a bucket of a key with more rows than that is cut again at
    quantiles of its times, and its pieces carry on like buckets; that costs a
    count of both sides first. `parts` sets the number of partitions in which the
    rows of both sides meet, for callers who know how many they are.
    """
    keys = list(keys)
    payload = F.struct(F.col(right_time).alias("_rt"), *[F.col(v).alias(v) for v in values])
    facts = right.where(F.col(right_time).isNotNull()).select(
        *keys, F.col(right_time).alias("_t"), _bucket(right_time, bucket).alias("_b"), payload.alias("_v")
    )
    asked = left.withColumns({"_t": F.col(left_time), "_b": _bucket(left_time, bucket)})
    part = ["_b"]
    if split is not None:
        asked, facts = _cut_buckets([asked, facts], keys, split)
        part.append("_p")
    order = F.col("_v") if tied else F.col("_t")
    # column by column, so that fixed-width values stay in a hash aggregation
    last = [F.max_by(F.col(f"_v.{v}"), order).alias(f"_last{i}") for i, v in enumerate(values)]
    closing = facts.groupBy(*keys, *part).agg(F.max("_t").alias("_rt"), *last)
    rebuilt = F.struct("_rt", *[F.col(f"_last{i}").alias(v) for i, v in enumerate(values)])
    closing = closing.select(*keys, *part, rebuilt.alias("_v"))
    opened = asked.select(*keys, *part).distinct()
    earlier = Window.partitionBy(*keys).orderBy(*part).rowsBetween(Window.unboundedPreceding, -1)
    marks = (
        closing.withColumn("_left", F.lit(0))
        .unionByName(opened.withColumn("_left", F.lit(1)), allowMissingColumns=True)
        .groupBy(*keys, *part)
        .agg(F.max("_v").alias("_v"), F.max("_left").alias("_left"))
    )
    carried = (
        marks.withColumn("_v", F.last("_v", ignorenulls=True).over(earlier))
        .where("_left = 1 and _v is not null")
        .select(*keys, *part, F.col("_v._rt").alias("_t"), "_v", F.lit(0).alias("_side"))
    )
    here = facts.withColumn("_side", F.lit(1))
    asked = asked.withColumn("_side", F.lit(2))
    everything = asked.unionByName(carried, allowMissingColumns=True).unionByName(here, allowMissingColumns=True)
    if parts is not None:
        everything = everything.repartition(parts, *keys, *part)
    order = Window.partitionBy(*keys, *part).orderBy("_t", "_side", *(["_v"] if tied else [])).rowsBetween(Window.unboundedPreceding, 0)
    matched = everything.withColumn("_v", F.last("_v", ignorenulls=True).over(order)).where("_side = 2")
    hit = F.col("_v")
    if max_days is not None:
        hit = F.when(F.datediff(F.col("_t"), F.col("_v._rt")) <= max_days, F.col("_v"))
    out = matched.withColumn("_v", hit)
    extra = [F.col("_v._rt").alias(keep_time)] if keep_time else []
    return out.select(*left.columns, *[F.col(f"_v.{v}").alias(v) for v in values], *extra)


def asof_valid_join(
    left: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    left_time: str,
    start: str,
    end: str,
    values: Sequence[str],
    *,
    bucket: str = "month",
    parts: int | None = None,
) -> DataFrame:
    """As-of on the start date, blank once the end date is reached (end day excluded)."""
    joined = asof_join(left, intervals, keys, left_time, start, [*values, end], bucket=bucket, parts=parts)
    gone = F.col(end).isNotNull() & (F.col(left_time) >= F.col(end))
    return joined.withColumns({v: F.when(~gone, F.col(v)) for v in values}).drop(end)


def interval_join(
    left: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    left_time: str,
    start: str,
    end: str,
    values: Sequence[str] = (),
    *,
    bucket: str = "month",
    how: str = "inner",
) -> DataFrame:
    """start <= time <= end per key; an open end reaches to the last left date.

    Intervals are copied to every calendar bucket they touch and joined by
    equality on (key, bucket); the range test runs inside the bucket. ``how``
    may be inner, left_semi or left_anti.
    """
    keys = list(keys)
    last = left.agg(F.max(left_time)).scalar()
    until = F.least(F.coalesce(F.col(end), last), last)
    spans = (
        intervals.withColumn("_until", until)
        .where(F.col(start) <= F.col("_until"))
        .select(
            *keys,
            F.col(start).alias("_from"),
            "_until",
            *values,
            F.explode(
                F.sequence(_bucket(start, bucket), _bucket("_until", bucket), F.expr(f"interval 1 {bucket}"))
            ).alias("_b"),
        )
    )
    rows = left.withColumn("_b", _bucket(left_time, bucket))
    l, s = rows.alias("l"), spans.alias("s")
    on = [F.col(f"l.{k}") == F.col(f"s.{k}") for k in [*keys, "_b"]]
    on += [F.col(f"l.{left_time}") >= F.col("s._from"), F.col(f"l.{left_time}") <= F.col("s._until")]
    joined = l.join(s, on, how)
    if how == "inner":
        return joined.select(*[F.col(f"l.{c}") for c in left.columns], *[F.col(f"s.{v}") for v in values])
    return joined.select(*left.columns)


def left_join_default(left: DataFrame, right: DataFrame, keys: Sequence[str], defaults: dict[str, object]) -> DataFrame:
    """Left equi-join; missing right values take the default."""
    joined = left.join(right.select(*keys, *defaults), list(keys), "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(d)) for c, d in defaults.items()})


def presence_merge(base: DataFrame, parts: dict[str, tuple[DataFrame, str]], keys: Sequence[str]) -> DataFrame:
    """Left-join several sources and flag each with has_<name> by its marker column."""
    out = base
    for name, (part, marker) in parts.items():
        out = out.join(part, list(keys), "left").withColumn(f"has_{name}", F.col(marker).isNotNull().cast("int"))
    return out


def canonical_codes(df: DataFrame, col: str, aliases: dict[str, str]) -> DataFrame:
    """Replace alias codes by the canonical one; unknown codes stay."""
    pairs = [F.lit(x) for kv in aliases.items() for x in kv]
    mapped = F.try_element_at(F.create_map(*pairs), F.col(col))
    return df.withColumn(col, F.coalesce(mapped, F.col(col)))


def snapshot_forward_fill(
    snapshots: DataFrame, months: DataFrame, group: str, month: str, values: Sequence[str]
) -> DataFrame:
    """Rows of the latest snapshot month <= every target month, per group.

    Months are first-of-month dates. Every snapshot month is valid until the
    month before the next one; that span is unfolded on a table with one row
    per (group, snapshot month), and members then join by equality.
    """
    grid = months.select(F.col(month).alias("_out")).distinct()
    last = grid.agg(F.max("_out")).scalar()
    w = Window.partitionBy(group).orderBy(month)
    spans = snapshots.select(group, month).distinct().withColumn("_next", F.lead(month).over(w))
    until = F.least(F.coalesce(F.add_months("_next", -1), last), last)
    resolved = (
        spans.withColumn("_until", until)
        .where(F.col("_until") >= F.col(month))
        .select(group, month, F.explode(F.sequence(month, "_until", F.expr("interval 1 month"))).alias("_out"))
        .join(F.broadcast(grid), "_out", "left_semi")
    )
    return resolved.join(snapshots, [group, month]).select(group, F.col("_out").alias(month), *values)


def quarter_grid(df: DataFrame, entity: str, period: str) -> DataFrame:
    """Every quarter end between the first and last period of the entity, left-joined to the rows."""
    span = df.groupBy(entity).agg(F.min(period).alias("_a"), F.max(period).alias("_b"))
    steps = F.sequence(F.trunc("_a", "quarter"), F.trunc("_b", "quarter"), F.expr("interval 3 month"))
    grid = span.select(entity, F.explode(steps).alias("_q")).select(entity, quarter_end("_q").alias(period))
    return grid.join(df, [entity, period], "left")


def life_span_grid(df: DataFrame, entity: str, period: str, index: DataFrame) -> DataFrame:
    """Every calendar period between first and last sight of the entity, left-joined to the rows.

    index holds (period, trade_idx) and is calendar-sized.
    """
    dated = df.select(entity, period).join(F.broadcast(index), period)
    span = dated.groupBy(entity).agg(F.min("trade_idx").alias("_a"), F.max("trade_idx").alias("_b"))
    grid = (
        span.select(entity, F.explode(F.sequence("_a", "_b")).alias("trade_idx"))
        .join(F.broadcast(index), "trade_idx")
        .select(entity, period)
    )
    return grid.join(df, [entity, period], "left")


def first_match(text: Column, rules: Sequence[tuple]) -> Column:
    """First rule (keyword, label, ...) in order whose keyword the text contains, as a struct.

    Fields are _1 (keyword), _2, ... The rule list is a literal array, so this
    is a projection: no join and no copy of the rows per rule.
    """
    items = F.array(*[F.struct(*[F.lit(x).alias(f"_{i}") for i, x in enumerate(rule, 1)]) for rule in rules])
    return F.get(F.filter(items, lambda s: F.contains(text, s["_1"])), F.lit(0))


def contains_any(text: Column, words: Sequence[str]) -> Column:
    found = F.lit(False)
    for w in words:
        found = found | F.contains(text, F.lit(w))
    return found
