"""Market state per month and dimension: price, volume, volatility, valuation, flow.

Inputs
  index     index_key, period, close, amount
  panel     entity, period, close, amount, pe, pb, dv, turnover, net_amount and the eight
            {buy,sell}_{elg,lg,md,sm}_amount columns
  members   month, dim, entity: the entities that belong to a dimension in a month
  mapping   dim -> index_key
Every measure of all months and dimensions comes from one pass per kind; there
is no loop over months or dimensions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.numeric import as_col, compound, ratio
from panelspark.operators.aggregates import average_correlation, downside_ratio, gini
from panelspark.operators.order_stats import group_quantiles, listed_medians
from panelspark.operators.windows import by_time, moving_average, rolling, trailing

UNIT_BREAK, UNIT_SCALE = "2024-08-19", 1e4  # fixed values: day and factor of a source's unit change
FLOW_COLUMNS = [f"{s}_{b}_amount" for b in ("elg", "lg", "md", "sm") for s in ("buy", "sell")]


def normalize_unit(value: Column | str, date: Column | str, since: str = UNIT_BREAK, scale: float = UNIT_SCALE) -> Column:
    """Divide by the scale from a given day on."""
    value = as_col(value)
    return F.when(as_col(date) >= F.lit(since).cast("date"), value / F.lit(float(scale))).otherwise(value)


def _month(c: str = "period") -> Column:
    return F.trunc(c, "month").alias("month")


def index_measures(index: DataFrame) -> DataFrame:
    """Close, averages, aligned returns, amounts, volatility and drawdown at every month's last row."""
    w = by_time("index_key", "period")
    daily = index.withColumns(
        {
            "ret": ratio("close", F.lag("close").over(w)) - 1,
            "ma60": moving_average("close", w, 60),
            "ma250": moving_average("close", w, 250),
            "month": F.trunc("period", "month"),
            "_rows": F.row_number().over(w),
        }
    )
    daily = daily.withColumns(
        {
            "vol20": F.when(F.col("_rows") >= 20, F.stddev_samp("ret").over(trailing(w, 19))) * F.lit(252.0**0.5),
            "vol60": F.when(F.col("_rows") >= 60, F.stddev_samp("ret").over(trailing(w, 59))) * F.lit(252.0**0.5),
            # closes of the last 365 natural days, oldest first
            "_year": F.collect_list("close").over(
                Window.partitionBy("index_key").orderBy(F.unix_date("period")).rangeBetween(-364, 0)
            ),
            # a return inside the month needs both its days in the month
            "_in": F.when(F.trunc(F.lag("period").over(w), "month") == F.trunc("period", "month"), F.col("ret")),
        }
    )
    last = daily.groupBy("index_key", "month").agg(
        F.max("period").alias("period"),
        F.max_by(F.struct("close", "ma60", "ma250", "vol20", "vol60", "_year"), "period").alias("_l"),
        F.sum("amount").alias("idx_amount"),
        downside_ratio("_in", rows=10).alias("downside_vol_ratio"),
    )
    m = Window.partitionBy("index_key").orderBy("month")
    fold = """aggregate(_l._year, named_struct('peak', cast(null as double), 'fall', 0D),
      (a, p) -> named_struct('peak', greatest(a.peak, p), 'fall', least(a.fall, try_divide(p, greatest(a.peak, p)) - 1)),
      a -> a.fall)"""
    out = last.select(
        "index_key",
        "month",
        "period",
        F.col("_l.close").alias("idx_close"),
        F.col("_l.ma60").alias("ma60"),
        F.col("_l.ma250").alias("ma250"),
        "idx_amount",
        F.col("_l.vol20").alias("idx_volatility_20"),
        F.col("_l.vol60").alias("idx_volatility_60"),
        F.when(F.size("_l._year") >= 2, F.expr(fold)).alias("max_drawdown_1y"),
        "downside_vol_ratio",
        (F.year("month") * 12 + F.month("month")).alias("_m"),
    )
    number = Window.partitionBy("index_key").orderBy("_m")
    out = out.withColumns(
        {f"_h{n}": F.collect_list("idx_amount").over(number.rangeBetween(1 - n, 0)) for n in (3, 12)}
    )
    cols = {f"idx_ret_{k}m": ratio("idx_close", F.lag("idx_close", k).over(m)) - 1 for k in (1, 3, 12)}
    for n, name in ((3, "amount_pct_3m"), (12, "amount_pct_1y")):
        cols[name] = F.expr(f"if(size(_h{n}) >= 3, size(filter(_h{n}, x -> x < idx_amount)) / cast(size(_h{n}) as double), null)")
    return out.withColumns(cols).drop("_m", "_h3", "_h12")


def member_rows(panel: DataFrame, members: DataFrame) -> DataFrame:
    """Rows of all entities that are members at any time, with returns, averages and `dims`, the dimensions of their month.

    The members of an entity meet its rows as one map, by entity, so the rows keep
    the partitioning of their windows. A repeated member is repeated in `dims`.
    """
    w = by_time("entity", "period")
    same = F.trunc(F.lag("period").over(w), "month") == F.trunc("period", "month")
    rows = panel.withColumns(
        {
            "ret": F.when(same, ratio("close", F.lag("close").over(w)) - 1),
            "ma60": moving_average("close", w, 60),
            "ma250": moving_average("close", w, 250),
            "month": F.trunc("period", "month"),
            "_total": sum((F.coalesce(c, F.lit(0.0)) for c in FLOW_COLUMNS[1:]), F.coalesce(FLOW_COLUMNS[0], F.lit(0.0))),
            "_big": sum((F.coalesce(c, F.lit(0.0)) for c in FLOW_COLUMNS[1:4]), F.coalesce(FLOW_COLUMNS[0], F.lit(0.0))),
        }
    ).drop(*FLOW_COLUMNS)
    lists = members.where("month is not null and entity is not null").repartition("entity")
    lists = lists.groupBy("entity", "month").agg(F.collect_list(F.struct("dim")).alias("_d"))
    lists = lists.groupBy("entity").agg(F.map_from_entries(F.collect_list(F.struct("month", "_d"))).alias("_dims"))
    # stored members look small: their files are packed
    met = rows.join(lists.hint("merge"), "entity")
    return met.withColumn("dims", F.try_element_at("_dims", F.col("month"))).drop("_dims")


def member_measures(rows: DataFrame) -> DataFrame:
    """Breadth, turnover, concentration, correlation, dispersion, valuation and flow per (month, dim), from `member_rows`."""
    held = rows.withColumn("dim", F.explode("dims.dim")).drop("dims")
    keys = ["month", "dim"]
    total, big = F.col("_total"), F.col("_big")

    single = held.groupBy(*keys, "entity").agg(
        F.min_by("close", "period").alias("first"),
        F.max_by("close", "period").alias("last"),
        F.max_by("ma60", "period").alias("ma60"),
        F.max_by("ma250", "period").alias("ma250"),
        F.sum("amount").alias("amount"),
        F.sum("net_amount").alias("net"),
        compound("ret").alias("month_ret"),
    )
    up, down = F.col("last") > F.col("first"), F.col("last") < F.col("first")
    per_dim = single.groupBy(*keys).agg(
        ratio(F.count_if(up), F.count_if(up | down)).alias("profit_ratio"),
        ratio(F.count_if(up), F.count_if(down)).alias("up_down_ratio"),
        F.avg(F.when(F.col("ma60").isNotNull(), (F.col("last") > F.col("ma60")).cast("double"))).alias("pct_above_ma60"),
        F.avg(F.when(F.col("ma250").isNotNull(), (F.col("last") > F.col("ma250")).cast("double"))).alias("pct_above_ma250"),
        F.when(F.count("month_ret") >= 5, F.stddev_samp("month_ret")).alias("cross_sectional_vol"),
        F.when(F.count("*") >= 5, F.avg((F.col("net") > 0).cast("double"))).alias("_breadth"),
    )
    daily = held.groupBy(*keys, "period").agg(
        F.sum("net_amount").alias("net"), F.sum(total).alias("total"), F.sum(big).alias("big"), F.count("*").alias("n")
    )
    flow = daily.groupBy(*keys).agg(
        F.sum("n").alias("_n"),
        F.when(F.sum("total") > 0, ratio(F.sum("net"), F.sum("total"))).alias("net_inflow_ratio"),
        F.when(F.count("*") >= 5, F.avg((F.col("net") > 0).cast("double"))).alias("inflow_direction_pct"),
        F.when((F.count("*") >= 5) & (F.stddev_samp("net") > 0), ratio(F.avg("net"), F.stddev_samp("net"))).alias("inflow_stability"),
        F.when(F.sum("total") > 0, ratio(F.sum("big"), F.sum("total"))).alias("institutional_pct"),
    )
    names = ["net_inflow_ratio", "inflow_direction_pct", "inflow_stability", "institutional_pct"]
    flow = flow.select(*keys, *[F.when(F.col("_n") >= 100, F.col(c)).alias(c) for c in names], (F.col("_n") >= 100).alias("_enough"))
    values = ["pe", "pb", "dv", "turnover"]
    q = group_quantiles(held, keys, values, [(1, 2), (1, 4), (3, 4)], few_groups=True)
    valuation = q.select(
        *keys,
        F.col("turnover_q0").alias("turnover_rate_median"),
        F.col("pe_q0").alias("pe_ttm_median"),
        F.col("pb_q0").alias("pb_median"),
        F.col("dv_q0").alias("dv_ttm_median"),
        F.when(F.col("pe_n") >= 10, ratio("pe_q2", "pe_q1")).alias("pe_dispersion"),
    )
    concentration = gini(single, keys, "amount", "amount_gini")
    correlation = average_correlation(held, keys, "entity", "period", "ret")
    out = per_dim
    for part in (valuation, concentration, correlation, flow):
        out = out.join(part, keys, "left")
    return out.withColumn("inflow_breadth", F.when(F.col("_enough"), F.col("_breadth"))).drop("_breadth", "_enough")


def valuation_history_share(month_panel: DataFrame, members: DataFrame, current: DataFrame, months: int = 60) -> DataFrame:
    """Share of past month-end medians of today's members below the current median.

    Every month looks back with its own member list: a row of an entity carries the
    numbers of the (month, dim) that use it, and medians are taken over these lists.
    Members are never broadcast: the size of their files says little about them.
    """
    snaps = month_panel.withColumn("month", F.trunc("period", "month")).groupBy("month", "entity").agg(
        F.max_by("pe", "period").alias("pe"), F.max_by("pb", "period").alias("pb")
    )
    # numbers of (month, dim); a table of the calendar and the dimensions
    numbers = current.select("month", "dim").where("month is not null and dim is not null").distinct()
    numbers = numbers.withColumn("_id", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("month", "dim")))
    lists = members.join(F.broadcast(numbers), ["month", "dim"]).repartition("entity")
    lists = lists.groupBy("entity").agg(F.collect_list(F.struct("month", "_id")).alias("_months"))
    inside = F.filter("_months", lambda m: (F.col("past") <= m["month"]) & (m["month"] <= F.col("_last")))
    past = snaps.select("entity", F.col("month").alias("past"), F.add_months("month", months - 1).alias("_last"), "pe", "pb")
    used = past.join(lists.hint("merge"), "entity").select("past", inside["_id"].alias("_id"), "pe", "pb")
    med = listed_medians(used, ["past"], "_id", ["pe", "pb"]).join(F.broadcast(numbers), "_id")
    rows = med.join(current.select("month", "dim", "pe_ttm_median", "pb_median"), ["month", "dim"])
    shares = rows.groupBy("month", "dim").agg(
        F.avg((F.col("pe_q0") < F.col("pe_ttm_median")).cast("double")).alias("pe_pct_5y"),
        F.avg((F.col("pb_q0") < F.col("pb_median")).cast("double")).alias("pb_pct_5y"),
    )
    return shares.withColumn("pb_pe_divergence", F.col("pe_pct_5y") - F.col("pb_pct_5y"))


PRICE = ["idx_close", "ma60", "ma250", "idx_ret_1m", "idx_ret_3m", "idx_ret_12m", "profit_ratio", "up_down_ratio", "pct_above_ma60", "pct_above_ma250", "limit_up_count"]
VOLUME = ["idx_amount", "turnover_rate_median", "amount_pct_3m", "amount_pct_1y", "amount_gini"]
VOLATILITY = ["idx_volatility_20", "idx_volatility_60", "max_drawdown_1y", "avg_correlation", "cross_sectional_vol", "downside_vol_ratio"]
VALUATION = ["pe_ttm_median", "pb_median", "dv_ttm_median", "pe_pct_5y", "pb_pct_5y", "pe_dispersion", "pb_pe_divergence"]
FLOW = ["north_money", "margin_balance", "net_inflow_ratio", "inflow_direction_pct", "inflow_stability", "inflow_breadth", "institutional_pct"]
MEASURES = PRICE + VOLUME + VOLATILITY + VALUATION + FLOW


def market_state(
    index: DataFrame,
    panel: DataFrame,
    members: DataFrame,
    mapping: DataFrame,
    *,
    north: DataFrame | None = None,
    margin: DataFrame | None = None,
    limits: DataFrame | None = None,
    whole_market: str = "all",
    stage=None,
) -> DataFrame:
    """36 measures per (month, dim). north, margin and limits feed the whole-market row only."""
    stage = stage or (lambda d, name: d)
    members = stage(members, "members")
    rows = stage(member_rows(panel, members), "rows")
    idx = index_measures(index).join(F.broadcast(mapping), "index_key")
    mem = stage(member_measures(rows), "measures")
    val = valuation_history_share(rows, members, mem)
    out = idx.join(mem, ["month", "dim"], "left").join(val, ["month", "dim"], "left")
    single = F.col("dim") == whole_market

    def monthly(df: DataFrame | None, agg: Column, name: str) -> DataFrame:
        if df is None:
            return out.withColumn(name, F.lit(None).cast("double"))
        part = df.groupBy(F.trunc("period", "month").alias("month")).agg(agg.alias("_x"))
        return out.join(F.broadcast(part), "month", "left").withColumn(name, F.when(single, F.col("_x"))).drop("_x")

    out = monthly(north, F.sum(normalize_unit("north_money", "period")), "north_money")
    if margin is not None:
        # several exchanges report per day: add them up, then take the month's last day
        margin = margin.groupBy("period").agg(F.sum("balance").alias("balance"))
    out = monthly(margin, F.max_by("balance", "period"), "margin_balance")
    out = monthly(limits, F.count("*").cast("double"), "limit_up_count")
    return out.select("month", "period", "dim", *MEASURES)
