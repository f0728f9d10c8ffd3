"""Rows and keys at the edges: no partition, moved keys, several exchanges, fine buckets, ties, order keys."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from panelspark.datasets.market_signals import regime_labels
from panelspark.operators import calendar as C
from panelspark.operators.joins import asof_join, interval_join
from panelspark.plans.shapes import day_order, tick_order
from panelspark.session import scratch_dir
from panelspark.sources.sinks import overwrite_partitions, scratch_path, upsert


def test_rows_without_partition_value_stay(spark, rows):
    path = scratch_path(spark, "nulls")
    overwrite_partitions(rows([(1, "a"), (2, None)], "k int, p string"), path, ["p"])
    overwrite_partitions(rows([(3, "b"), (4, None)], "k int, p string"), path, ["p"])
    assert {(r.k, r.p) for r in spark.read.parquet(path).collect()} == {(1, "a"), (3, "b"), (4, None)}


def test_upsert_moves_a_key_and_keeps_the_rest(spark, rows):
    path, schema = scratch_path(spark, "moved"), "k int, v string, month string"
    upsert(rows([(1, "old", "2000-01"), (2, "old", "2000-01"), (3, "old", "2000-03")], schema), path, ["k"], ["month"])
    upsert(rows([(1, "new", "2000-02")], schema), path, ["k"], ["month"])
    get = lambda: {(r.k, r.v, str(r.month)[:7]) for r in spark.read.schema(schema).parquet(path).collect()}
    assert get() == {(1, "new", "2000-02"), (2, "old", "2000-01"), (3, "old", "2000-03")}
    upsert(rows([(3, "new", None)], schema), path, ["k"], ["month"])  # empties 2000-03
    assert {x[:2] for x in get()} == {(1, "new"), (2, "old"), (3, "new")}


def test_upsert_reads_only_touched_partitions(spark, rows):
    path, schema = scratch_path(spark, "pruned"), "k int, v string, month string"
    upsert(rows([(i, "old", f"2000-{i:02d}") for i in range(1, 10)], schema), path, ["k", "month"], ["month"])
    from panelspark.sources.sinks import _in_partitions

    plan = spark.read.schema(schema).parquet(path).where(_in_partitions(spark.read.schema(schema).parquet(path), ["month"], [("2000-02",)]))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in text and "2000-02" in text.split("PartitionFilters")[1].split("]")[0]


def test_calendar_with_two_exchanges(rows):
    days = [(x, date(2024, 1, d), int(d not in ((1, 2) if x == "A" else (3,)) and date(2024, 1, d).weekday() < 5)) for x in "AB" for d in range(1, 13)]
    cal = rows(days, "exchange string, cal_date date, is_open int")
    one = rows([(date(2024, 1, 3),)], "d date")
    assert [r.trading_day for r in C.nearest_trading_day(one, cal, exchange="B").collect()] == [date(2024, 1, 2)]
    assert [r.trading_day for r in C.nearest_trading_day(one, cal).collect()] == [date(2024, 1, 3)]
    assert [r.is_trading for r in C.is_trading_day(one, cal, exchange="B").collect()] == [0]
    assert [r.shifted for r in C.shift_trading_days(one, cal, 1, exchange="B").collect()] == [date(2024, 1, 4)]
    assert C.trading_days_between(cal, "2024-01-01", "2024-01-05", exchange="A").count() == 3
    assert C.expected_dates(cal, "trade_day", "2024-01-01", "2024-01-05", exchange="B").count() == 4
    assert C.rebalance_days(cal, "D", exchange="A").count() == 8


@pytest.mark.parametrize("bucket", ["hour", "day", "week", "month", "year"])
def test_interval_join_in_any_bucket(rows, bucket):
    left = rows([(1, datetime(2024, 1, 5, 10)), (1, datetime(2024, 1, 7, 10)), (2, datetime(2024, 1, 5, 10))], "k int, t timestamp")
    spans = rows([(1, datetime(2024, 1, 5, 9), datetime(2024, 1, 6, 9), "x")], "k int, a timestamp, b timestamp, v string")
    got = interval_join(left, spans, ["k"], "t", "a", "b", ["v"], bucket=bucket).collect()
    assert [(r.k, r.t.day, r.v) for r in got] == [(1, 5, "x")]


def test_unknown_bucket_is_refused(rows):
    left = rows([(1, date(2024, 1, 5))], "k int, t date")
    with pytest.raises(ValueError, match="bucket"):
        asof_join(left, left.withColumn("v", F.lit(1)), ["k"], "t", "t", ["v"], bucket="fortnight")


@pytest.mark.parametrize("bucket", ["day", "month"])
def test_asof_ties_take_the_largest_values(rows, bucket):
    right = rows([(1, date(2024, 1, 5), v) for v in (3, 9, 4)], "k int, u date, v int")
    left = rows([(1, date(2024, 1, 5)), (1, date(2024, 3, 1))], "k int, t date")
    got = asof_join(left, right, ["k"], "t", "u", ["v"], bucket=bucket, tied=True).collect()
    assert [r.v for r in got] == [9, 9]


def test_order_keys_tell_cents_apart(rows):
    df = rows([(1, 0.28), (1, 0.29), (1, 12_345_678_901.01), (2, 0.01)], "d int, p double")
    for key in (day_order(F.col("d"), F.col("p")), tick_order(F.col("d"), F.col("p"))):
        assert [r.p for r in df.orderBy(key).collect()] == [0.28, 0.29, 12_345_678_901.01, 0.01]


def test_flat_regime_is_reached(rows):
    closes = [100, 110, 110.2, 110.4, 110.3, 100]
    days = [(date(2020, m + 1, 28), float(c), 0.6, 0.5, 0.01, 0.1) for m, c in enumerate(closes)]
    signals = rows(days, "period date, index_close double, above_ma_20d_pct double, pe_percentile_3y double, erp_5y double, index_vol_20d double")
    alarms = rows([(d[0], 0) for d in days], "period date, alarm_count int")
    got = [r.direction_label for r in regime_labels(signals, alarms).orderBy("month").collect()]
    assert got == [None, "UP", "FLAT", "FLAT", "FLAT", "DOWN"]
    with pytest.raises(ValueError, match="hysteresis"):
        regime_labels(signals, alarms, band=0.02, hysteresis=0.04)


def test_cluster_without_shared_folder_is_refused():
    class Session:
        class conf:
            get = staticmethod(lambda k, d=None: d)

        class sparkContext:
            master, applicationId = "spark://host:7077", "x"

    with pytest.raises(ValueError, match="checkpoint"):
        scratch_dir(Session())
