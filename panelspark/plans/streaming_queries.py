"""Streams over the supplied tables, run to completion and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.plans.registry import query
from panelspark.plans.shapes import r, rnd, table
from panelspark.sources.sinks import scratch_path
from panelspark.streaming import ingest as I


def stream_of(spark, sf_dir, name):
    schema = table(spark, sf_dir, name).schema
    return I.file_stream(spark, f"{sf_dir}/{name}*.parquet", schema)


@query("K1", "SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders")
def stream_land_increment(spark, sf_dir):
    """Two runs over the same checkpoint: the second one finds nothing new."""
    target, mark = scratch_path(spark, "stream"), scratch_path(spark, "mark")
    rows = stream_of(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM").alias("month")
    )
    for _ in range(2):
        I.land_increment(rows, target, mark, partition=["month"]).awaitTermination()
    return spark.read.parquet(target).select("o_orderkey", "o_custkey", F.date_format("month", "yyyy-MM").alias("month"))


@query(
    "K2",
    f"""SELECT l_orderkey, l_linenumber, {rnd('l_extendedprice', 2)} AS price, year FROM (
 SELECT *, year(l_shipdate) AS year, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, year(l_shipdate)
  ORDER BY l_extendedprice DESC) AS rn FROM lineitem) WHERE rn = 1""",
)
def stream_upsert_increment(spark, sf_dir):
    target, mark = scratch_path(spark, "stream"), scratch_path(spark, "mark")
    rows = stream_of(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", r("l_extendedprice", 2).alias("price"), F.year("l_shipdate").cast("long").alias("year")
    )
    keys = ["l_orderkey", "l_linenumber", "year"]
    I.upsert_increment(rows, target, mark, keys, ["year"]).awaitTermination()
    return spark.read.parquet(target).select("l_orderkey", "l_linenumber", "price", F.col("year").cast("long").alias("year"))


@query("K3", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS d FROM events")
def stream_drop_repeats(spark, sf_dir):
    target, mark = scratch_path(spark, "stream"), scratch_path(spark, "mark")
    rows = stream_of(spark, sf_dir, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"), F.col("ts").cast("date").alias("d"))
    unique = I.drop_repeats(rows, "ts", ["user_id", "event_type", "d"], "2 days").drop("ts")
    I.land_increment(unique, target, mark).awaitTermination()
    return spark.read.parquet(target)


@query(
    "K4",
    f"""WITH w AS (SELECT date_trunc('day', ts) AS s, user_id, arg_min(value, row(ts, value)) AS open, max(value) AS high, min(value) AS low,
 arg_max(value, row(ts, value)) AS close, sum(value) AS total, count(*) AS n FROM events GROUP BY 1, 2)
SELECT CAST(s AS DATE) AS d, user_id, {rnd('open', 2)} AS open, {rnd('high', 2)} AS high, {rnd('low', 2)} AS low,
 {rnd('close', 2)} AS close, {rnd('total', 2)} AS total, n FROM w
 WHERE s + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
)
def stream_event_time_bars(spark, sf_dir):
    """Closed windows only: those that end before the last event time minus the delay."""
    target, mark = scratch_path(spark, "stream"), scratch_path(spark, "mark")
    rows = stream_of(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "value")
    bars = I.event_time_bars(rows, "ts", "user_id", "value", "1 day", "1 hour")
    I.land_increment(bars, target, mark).awaitTermination()
    out = spark.read.parquet(target)
    cols = ("open", "high", "low", "close", "total")
    return out.select(F.col("start").cast("date").alias("d"), "user_id", *[r(c, 2).alias(c) for c in cols], "n")
