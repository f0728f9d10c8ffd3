"""Physical plans: filters reach the scan, bars stay hash aggregates, no nested loops."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from panelspark.operators import cross_section as X
from panelspark.operators import joins as J
from panelspark.sources import readers as R
from panelspark.sources.sinks import scratch_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark):
    path = scratch_path(spark, "plans")
    spark.range(100).select(
        (F.col("id") % 7).alias("e"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).alias("d"),
        F.col("id").cast("double").alias("v"), F.lit("x").alias("unused"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_range_and_columns_reach_the_scan(stored):
    p = plan(R.date_range(stored, "d", date(2020, 1, 5), date(2020, 2, 1), entity="e", entities=[1, 2], columns=["e", "v"]))
    assert "GreaterThanOrEqual(d,2020-01-05)" in p and "In(e, [1,2])" in p
    assert "unused" not in p


def test_asof_is_equality_and_hash(stored):
    right = stored.select("e", F.col("d").alias("u"), F.col("v").alias("w"))
    p = plan(J.asof_join(stored.select("e", "d"), right, ["e"], "d", "u", ["w"]))
    assert "NestedLoop" not in p and "Cartesian" not in p


def test_dates_are_never_one_window_partition(stored):
    for df in (
        X.quantile_bucket(stored, ["d"], "v", "b", few_groups=True),
        X.percentile_rank(stored, ["d"], "v", "p"),
        X.winsorize_mad(stored, ["d"], ["v"], few_groups=True),
    ):
        text = df._jdf.queryExecution().optimizedPlan().toString()
        for line in text.splitlines():
            if "+- Window [" in line or line.startswith("Window ["):
                # windows see counted slices only, never the rows themselves
                assert "_cnt" in line or "_ties" in line, line
        assert "Cartesian" not in text


def test_bars_use_hash_aggregation(spark):
    from panelspark.plans.shapes import bars, daily_bars

    for make in (bars, daily_bars):
        assert "SortAggregate" not in plan(make(spark, "/root/testdata/sf0.001"))
