"""Fund-day panel: bars, adjustment, published value and shares, labels, and daily ranks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.datasets.fund_rules import LABELS, fund_labels, index_name
from panelspark.functions.numeric import nullify_non_finite, ratio
from panelspark.operators.cross_section import percentile_rank
from panelspark.operators.joins import asof_join

COLUMNS = [
    "entity", "period", "name", "open", "high", "low", "close", "pre_close", "change", "pct_chg", "vol", "amount",
    "log_return", "vwap", "adj_factor", "unit_nav", "accum_nav", "adj_nav", "discount_rate", "fd_share", "fund_size",
    "list_date", "list_days", "is_suspend", "fund_type", "invest_type", *LABELS, "amount_rank", "size_rank",
]

NAV = ["unit_nav", "accum_nav", "adj_nav"]


def last_published(parts: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """One row per entity and day on which any part was published, with the last values of every part up to it.

    Each part has one row per entity and day, so an entity has no more rows than the calendar. The panel then meets
    all parts in one as-of join; a published NULL replaces the value before it.
    """
    rows = [
        df.where(F.col(day).isNotNull()).select("entity", F.col(day).alias("_published"), *values, F.lit(1).alias(f"_{name}"))
        for name, (df, day, values) in parts.items()
    ]
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows).repartition("entity")
    # column by column, so that fixed-width values stay in a hash aggregation
    day = every.groupBy("entity", "_published").agg(*[F.max(c).alias(c) for name, (_, _, values) in parts.items() for c in (*values, f"_{name}")])
    known = Window.partitionBy("entity").orderBy("_published").rowsBetween(Window.unboundedPreceding, 0)
    last = day.withColumns({f"_{name}": F.last(F.when(F.col(f"_{name}") == 1, F.struct(*values)), ignorenulls=True).over(known) for name, (_, _, values) in parts.items()})
    return last.select("entity", "_published", *[F.col(f"_{name}.{v}") for name, (_, _, values) in parts.items() for v in values])


def fund_panel(
    bars: DataFrame, nav: DataFrame, shares: DataFrame, basic: DataFrame, adjust: DataFrame | None = None, *, stage=None
) -> DataFrame:
    """33 columns per (entity, period).

    nav is (entity, nav_date, unit_nav, accum_nav, adj_nav), shares is (entity,
    share_date, fd_share); both are taken as last published up to the day.
    Labels are made once per fund, on the dimension table.
    """
    stage = stage or (lambda d, name: d)
    key = ["entity", "period"]
    lots = F.col("vol") * 100
    out = bars.join(adjust.select(*key, "adj_factor"), key, "left") if adjust is not None else bars.withColumn("adj_factor", F.lit(1.0))
    out = out.withColumns(
        {
            "log_return": F.log1p(F.coalesce("pct_chg", F.lit(0.0)) / 100),
            "vwap": F.when(lots > 1, ratio(F.coalesce("amount", F.lit(0.0)) * 1000, lots)).otherwise(F.coalesce("close", F.lit(0.0))),
        }
    )
    published = last_published({"nav": (nav, "nav_date", NAV), "shares": (shares, "share_date", ["fd_share"])})
    out = asof_join(out, published, ["entity"], "period", "_published", [*NAV, "fd_share"])
    # inline keeps the five labels one expression; fields read from a struct column would each make it again
    labels = F.inline(F.array(fund_labels(index_name(F.col("name")))))
    labelled = basic.select("entity", "name", "fund_type", "invest_type", "list_date", labels)
    out = out.join(labelled, "entity", "left")
    priced = F.coalesce("close", F.lit(0.0)) > 0
    out = out.withColumns(
        {
            "discount_rate": F.when(priced & (F.coalesce("unit_nav", F.lit(0.0)) > 0), ratio("close", "unit_nav") - 1),
            "fund_size": F.when(priced & (F.coalesce("fd_share", F.lit(0.0)) > 0), F.col("close") * F.col("fd_share") / 1e4),
            "list_days": F.coalesce(F.datediff("period", "list_date"), F.lit(-1)),
            "is_suspend": F.coalesce(((F.col("vol") == 0) & (F.col("pct_chg") == 0)), F.lit(False)).cast("int"),
        }
    )
    out = stage(nullify_non_finite(out), "funds")
    out = percentile_rank(out, ["period"], "amount", "amount_rank")
    out = percentile_rank(out, ["period"], "fund_size", "size_rank")
    return out.select(*COLUMNS)
