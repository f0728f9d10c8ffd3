"""Runs that are repeated, split or cut short give the same rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from panelspark.datasets.index_factors import trend_momentum
from panelspark.operators import windows as W
from panelspark.sources import sinks as K
from panelspark.streaming import ingest as I


def series(spark, n=120, entities=3):
    return spark.range(n * entities).select(
        (F.col("id") % entities).cast("int").alias("entity"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / entities).cast("int")).alias("period"),
        (F.lit(50) + F.sin(F.col("id").cast("double")) * 10 + F.col("id") * 0.01).alias("close"),
    )


def as_set(df):
    return sorted(tuple(r) for r in df.collect())


def test_no_look_ahead(spark):
    df = series(spark)
    cut = date(2020, 4, 1)
    full = trend_momentum(df).where(F.col("period") <= F.lit(cut))
    short = trend_momentum(df.where(F.col("period") <= F.lit(cut)))
    assert as_set(full) == as_set(short)


def test_full_run_equals_incremental_runs(spark):
    df = series(spark)

    def build(rows):
        w = W.by_time("entity", "period")
        return rows.withColumn("ma", W.moving_average("close", w, 20)).withColumn("month", F.date_format("period", "yyyy-MM"))

    whole, steps = K.scratch_path(spark, "whole"), K.scratch_path(spark, "steps")
    K.overwrite_partitions(build(df), whole, ["month"])
    for month, start in (("2020-01", "2020-01-01"), ("2020-02", "2020-01-05"), ("2020-03", "2020-02-01"), ("2020-04", "2020-03-01")):
        warm = df.where(F.col("period") >= start)
        K.overwrite_partitions(build(warm).where(F.col("month") == month), steps, ["month"])
    cols = ["entity", "period", "ma"]
    near = lambda p: {(r.entity, r.period): r.ma for r in spark.read.parquet(p).select(*cols).collect()}
    a, b = near(whole), near(steps)
    assert a.keys() == b.keys()
    assert all((a[k] is None and b[k] is None) or a[k] == pytest.approx(b[k]) for k in a)


def test_overwrite_is_idempotent_and_local(spark):
    path = K.scratch_path(spark, "t")
    K.overwrite_partitions(spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    for _ in range(2):
        K.overwrite_partitions(spark.createDataFrame([(3, "b")], "v int, p string"), path, ["p"])
    assert as_set(spark.read.parquet(path).select("v", "p")) == [(1, "a"), (3, "b")]


def test_upsert_twice(spark):
    path = K.scratch_path(spark, "u")
    K.upsert(spark.createDataFrame([(1, "x", 2019), (2, "y", 2020)], "k int, v string, p int"), path, ["k"], ["p"])
    new = spark.createDataFrame([(2, "z", 2020), (3, "w", 2020)], "k int, v string, p int")
    for _ in range(2):
        K.upsert(new, path, ["k"], ["p"])
    assert as_set(spark.read.parquet(path).select("k", "v")) == [(1, "x"), (2, "z"), (3, "w")]


def test_watermark_round_trip(spark):
    state = K.scratch_path(spark, "state")
    assert K.read_watermark(spark, state, "a") is None
    assert K.increment_start(None, date(2020, 1, 10)) == date(2020, 1, 7)
    K.write_watermark(spark.createDataFrame([(date(2020, 1, 5),), (date(2020, 1, 3),)], "d date"), state, "a", "d")
    K.write_watermark(spark.createDataFrame([(date(2020, 2, 5),)], "d date"), state, "b", "d")
    assert K.increment_start(K.read_watermark(spark, state, "a"), date(2021, 1, 1)) == date(2020, 1, 6)


def test_stream_takes_only_new_files(spark):
    src, out, mark = (K.scratch_path(spark, n) for n in ("src", "out", "mark"))
    schema = "k int, v string"
    spark.createDataFrame([(1, "a")], schema).write.mode("append").parquet(src)
    typed = spark.createDataFrame([], schema).schema
    for batch in ([(2, "b")], [(3, "c")]):
        I.land_increment(I.file_stream(spark, src, typed), out, mark).awaitTermination()
        spark.createDataFrame(batch, schema).write.mode("append").parquet(src)
    I.land_increment(I.file_stream(spark, src, typed), out, mark).awaitTermination()
    assert as_set(spark.read.parquet(out)) == [(1, "a"), (2, "b"), (3, "c")]


def test_stream_revisions_replace_rows(spark):
    src, out, mark = (K.scratch_path(spark, n) for n in ("src", "out", "mark"))
    schema = "k int, v string, p int"
    typed = spark.createDataFrame([], schema).schema
    for batch in ([(1, "a", 1), (2, "b", 1)], [(2, "B", 1)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(src)
        I.upsert_increment(I.file_stream(spark, src, typed), out, mark, ["k"], ["p"]).awaitTermination()
    assert as_set(spark.read.parquet(out).select("k", "v")) == [(1, "a"), (2, "B")]
