"""Panel shapes derived from the supplied tables, in Spark and in SQL.

Every SQL_* constant is the body of a common table expression; ``with_ctes``
puts the named ones in front of a statement.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelspark.functions.dates import month_start, quarter_end


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _off_tie(digits: int) -> float:
    """Shift applied before rounding: short decimals that end in 5 would round by their last bit."""
    return 1.7 * 10.0 ** -(digits + 2)


def r(c: Column | str, digits: int = 6) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) + F.lit(_off_tie(digits)), digits)


def rnd(expr: str, digits: int = 6) -> str:
    """SQL text of a rounded double without negative zero."""
    return f"(round(({expr}) + {_off_tie(digits):.1e}, {digits}) + 0.0)"


def rcols(df: DataFrame, keys: list[str], values: list[str], digits: int = 6) -> DataFrame:
    return df.select(*keys, *[r(v, digits).alias(v) for v in values])


def sql_rcols(keys: list[str], values: list[str], digits: int = 6) -> str:
    return ", ".join([*keys, *[f"{rnd(v, digits)} AS {v}" for v in values]])


def tick_order(key: Column, price: Column) -> Column:
    """One fixed-width number that orders rows by a whole-number key and then by price in cents.

    A fixed-width key keeps min_by/max_by in a hash aggregation; a struct key
    would make Spark sort every task's input first.
    """
    cents = F.round(price * 100).cast("decimal(18,0)")
    return (key.cast("decimal(19,0)") * F.expr("1000000000000000000BD") + cents).cast("decimal(38,0)")


def day_order(day: Column, price: Column) -> Column:
    """The same for a day number; prices below 10^12 and days up to 92 000 fit into a long."""
    return day.cast("bigint") * F.lit(100_000_000_000_000) + F.round(price * 100).cast("bigint")


LINE_KEY = "l_orderkey * 10 + l_linenumber"


def _flow_aggs() -> list[Column]:
    """Buy and sell volume and amount by size class of the trade."""
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    bands = {"sm": q <= 12, "md": (q > 12) & (q <= 25), "lg": (q > 25) & (q <= 38), "elg": q > 38}
    sides = {"buy": F.col("l_returnflag") == "N", "sell": F.col("l_returnflag") == "R"}
    out = []
    for side, s in sides.items():
        for band, b in bands.items():
            out.append(F.sum(F.when(s & b, q).otherwise(0.0)).alias(f"{side}_{band}_vol"))
            out.append(F.sum(F.when(s & b, p).otherwise(0.0)).alias(f"{side}_{band}_amount"))
    return out


FLOW_VOLS = [f"{s}_{b}_vol" for s in ("buy", "sell") for b in ("sm", "md", "lg", "elg")]
FLOW_AMOUNTS = [f"{s}_{b}_amount" for s in ("buy", "sell") for b in ("sm", "md", "lg", "elg")]


def _bars(lines: DataFrame, keys: list[str], flow: bool = False) -> DataFrame:
    p = F.col("l_extendedprice")
    return lines.groupBy(*keys).agg(
        F.min_by(p, F.col("_order")).alias("open"),
        F.max(p).alias("high"),
        F.min(p).alias("low"),
        F.max_by(p, F.col("_order")).alias("close"),
        F.sum("l_quantity").alias("vol"),
        F.sum(p).alias("amount"),
        *(_flow_aggs() if flow else []),
    )


def supplier_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """entity -> grp. nation has 25 rows by definition; supplier grows and is not hinted."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_regionkey").alias("grp"))
    return (
        table(spark, sf_dir, "supplier")
        .join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("entity"), "grp")
    )


def bars(spark: SparkSession, sf_dir: str, *, flow: bool = False) -> DataFrame:
    """Monthly bars: entity (supplier), grp (region), period (month)."""
    day = F.col("l_shipdate").cast("date")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("entity"),
        month_start(day).alias("period"),
        "l_quantity",
        "l_extendedprice",
        day_order(F.unix_date(day), F.col("l_extendedprice")).alias("_order"),
        *(["l_returnflag"] if flow else []),
    )
    return _bars(lines, ["entity", "period"], flow).join(supplier_region(spark, sf_dir), "entity")


def daily_bars(spark: SparkSession, sf_dir: str, *, flow: bool = False) -> DataFrame:
    """Daily bars: entity (supplier), period (day); the order key is the tick order."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("entity"),
        F.col("l_shipdate").cast("date").alias("period"),
        "l_quantity",
        "l_extendedprice",
        tick_order(F.expr(LINE_KEY), F.col("l_extendedprice")).alias("_order"),
        *(["l_returnflag"] if flow else []),
    )
    return _bars(lines, ["entity", "period"], flow)


def index_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars per region: entity (region), period (day)."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .select(
            F.col("l_suppkey").alias("entity"),
            F.col("l_shipdate").cast("date").alias("period"),
            "l_quantity",
            "l_extendedprice",
            tick_order(F.expr(LINE_KEY), F.col("l_extendedprice")).alias("_order"),
        )
        .join(supplier_region(spark, sf_dir), "entity")
        .drop("entity")
        .withColumnRenamed("grp", "entity")
    )
    return _bars(lines, ["entity", "period"])


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural days between first and last ship day; weekdays are open."""
    span = table(spark, sf_dir, "lineitem").agg(
        F.min("l_shipdate").cast("date").alias("a"), F.max("l_shipdate").cast("date").alias("b")
    )
    return span.select(F.explode(F.sequence("a", "b")).alias("cal_date")).select(
        F.lit("X").alias("exchange"), "cal_date", (F.weekday("cal_date") < 5).cast("int").alias("is_open")
    )


def customer_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer and order day: entity, t, label, amount."""
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("entity"), F.col("o_orderdate").cast("date").alias("t"))
        .agg(F.min("o_orderpriority").alias("label"), F.sum("o_totalprice").alias("amount"))
    )


def validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer label intervals: in_date, out_date (next order day, open at the end)."""
    w = Window.partitionBy("entity").orderBy("t")
    nxt = F.lead("t").over(w)
    return customer_days(spark, sf_dir).select(
        "entity",
        F.col("t").alias("in_date"),
        F.when(F.datediff(nxt, F.col("t")) > 90, F.date_add("t", 90)).otherwise(nxt).alias("out_date"),
        "label",
    )


def pit_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irregular published values: entity (user), t (day), value."""
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "purchase")
        .groupBy(F.col("user_id").alias("entity"), F.col("ts").cast("date").alias("t"))
        .agg(F.max("value").alias("value"))
    )


def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarterly cumulative figures per customer: entity, period, known_at, qno, revenue, cost."""
    q = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("entity"), quarter_end(F.col("o_orderdate").cast("date")).alias("period"))
        .agg(
            F.max(F.col("o_orderdate").cast("date")).alias("known_at"),
            F.sum("o_totalprice").alias("amount_q"),
            F.sum(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).otherwise(0.0)).alias("cost_q"),
        )
    )
    year = Window.partitionBy("entity", F.year("period")).orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    return q.select(
        "entity",
        "period",
        "known_at",
        F.quarter("period").alias("qno"),
        F.sum("amount_q").over(year).alias("revenue"),
        F.sum("cost_q").over(year).alias("cost"),
    )


SQL_REGION = """
 SELECT s_suppkey AS entity, n_regionkey AS grp FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

_SQL_FLOW = ",\n".join(
    f" sum(CASE WHEN l_returnflag = '{f}' AND {cond} THEN {v} ELSE 0 END) AS {side}_{band}_{what}"
    for side, f in (("buy", "N"), ("sell", "R"))
    for band, cond in (
        ("sm", "l_quantity <= 12"),
        ("md", "l_quantity > 12 AND l_quantity <= 25"),
        ("lg", "l_quantity > 25 AND l_quantity <= 38"),
        ("elg", "l_quantity > 38"),
    )
    for what, v in (("vol", "l_quantity"), ("amount", "l_extendedprice"))
)


def _sql_bars(entity: str, period: str, order: str, source: str, flow: bool = False) -> str:
    return f"""
 SELECT {entity} AS entity, {period} AS period,
  arg_min(l_extendedprice, row({order}, l_extendedprice)) AS open, max(l_extendedprice) AS high,
  min(l_extendedprice) AS low, arg_max(l_extendedprice, row({order}, l_extendedprice)) AS close,
  sum(l_quantity) AS vol, sum(l_extendedprice) AS amount{"," + _SQL_FLOW if flow else ""}
 FROM {source} GROUP BY 1, 2"""


_MONTH = "CAST(date_trunc('month', l_shipdate) AS DATE)"
_DAY = "CAST(l_shipdate AS DATE)"
_TICK = "l_orderkey, l_linenumber"

CTES = {
    "region_of": SQL_REGION,
    "bars0": _sql_bars("l_suppkey", _MONTH, _DAY, "lineitem"),
    "bars": " SELECT b.*, g.grp FROM bars0 b JOIN region_of g USING (entity)",
    "flow0": _sql_bars("l_suppkey", _MONTH, _DAY, "lineitem", True),
    "fbars": " SELECT b.*, g.grp FROM flow0 b JOIN region_of g USING (entity)",
    "dbars": _sql_bars("l_suppkey", _DAY, _TICK, "lineitem"),
    "ibars": _sql_bars("g.grp", _DAY, _TICK, "lineitem JOIN region_of g ON l_suppkey = g.entity"),
    "cal": """
 SELECT 'X' AS exchange, CAST(d AS DATE) AS cal_date, CAST(isodow(d) < 6 AS INTEGER) AS is_open FROM (
  SELECT unnest(generate_series(min(l_shipdate), max(l_shipdate), INTERVAL 1 DAY)) AS d FROM lineitem)""",
    "open_days": """
 SELECT cal_date, row_number() OVER (ORDER BY cal_date) AS trade_idx FROM cal WHERE is_open = 1""",
    "cdays": """
 SELECT o_custkey AS entity, CAST(o_orderdate AS DATE) AS t, min(o_orderpriority) AS label, sum(o_totalprice) AS amount
 FROM orders GROUP BY 1, 2""",
    "validity": """
 SELECT entity, t AS in_date, CASE WHEN nt - t > 90 THEN t + 90 ELSE nt END AS out_date, label
 FROM (SELECT *, lead(t) OVER (PARTITION BY entity ORDER BY t) AS nt FROM cdays)""",
    "pit": """
 SELECT user_id AS entity, CAST(ts AS DATE) AS t, max(value) AS value FROM events
 WHERE event_type = 'purchase' GROUP BY 1, 2""",
    "stq": """
 SELECT o_custkey AS entity,
  CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS period,
  max(CAST(o_orderdate AS DATE)) AS known_at, sum(o_totalprice) AS amount_q,
  sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS cost_q
 FROM orders GROUP BY 1, 2""",
    "statements": """
 SELECT entity, period, known_at, quarter(period) AS qno,
  sum(amount_q) OVER (PARTITION BY entity, year(period) ORDER BY period ROWS UNBOUNDED PRECEDING) AS revenue,
  sum(cost_q) OVER (PARTITION BY entity, year(period) ORDER BY period ROWS UNBOUNDED PRECEDING) AS cost
 FROM stq""",
}

_NEEDS = {
    "bars": ["region_of", "bars0"],
    "fbars": ["region_of", "flow0"],
    "ibars": ["region_of"],
    "open_days": ["cal"],
    "validity": ["cdays"],
    "statements": ["stq"],
}


def with_ctes(names: str, body: str, **extra: str) -> str:
    """WITH clause of the named shapes, then extra ones in order, then the body."""
    order: list[str] = []
    for name in names.split():
        for n in [*_NEEDS.get(name, []), name]:
            if n not in order:
                order.append(n)
    parts = [f"{n} AS ({CTES[n]})" for n in order]
    parts += [f"{n} AS ({sql})" for n, sql in extra.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body
