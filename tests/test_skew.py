"""Hot groups: one date, key or value that holds a large share of all rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelspark.operators import joins as J
from panelspark.operators.cross_section import quantile_bucket
from panelspark.operators.order_stats import group_quantiles, value_ranks, value_slice, with_average_rank
from panelspark.sources.sinks import dedupe_by_key


def hot(spark, n=60000):
    """Date 0 has half of the rows, and half of its values are one number."""
    df = spark.range(n).select(
        F.when(F.col("id") < n / 2, 0).otherwise((F.col("id") % 50) + 1).alias("d"),
        F.when(F.col("id") < n / 4, F.lit(0.25)).otherwise(F.round(F.sin(F.col("id").cast("double")) * 100, 3)).alias("v"),
        F.col("id").alias("i"),
    )
    return df


def test_exact_on_hot_group(spark):
    df = hot(spark)
    pdf = df.toPandas()
    q = group_quantiles(df, ["d"], ["v"], [(1, 2), (1, 3)]).toPandas().set_index("d").sort_index()
    np.testing.assert_allclose(q["v_q0"], pdf.groupby("d")["v"].median())
    np.testing.assert_allclose(q["v_q1"], pdf.groupby("d")["v"].quantile(1 / 3))
    ranks = with_average_rank(df, ["d"], "v", "r").select("i", "r").toPandas().sort_values("i")
    np.testing.assert_allclose(ranks["r"], pdf.groupby("d")["v"].rank())


def test_buckets_keep_every_row(spark):
    df = hot(spark)
    out = quantile_bucket(df, ["d"], "v", "b", buckets=4)
    assert out.count() == df.count()
    assert out.where("b is null").count() == 0


def test_ties_are_one_row_and_slices_are_many(spark):
    df = hot(spark)
    ranks = value_ranks(df, ["d"], "v").where("d = 0")
    assert ranks.count() == df.where("d = 0").select("v").distinct().count()
    slices = df.where("d = 0").groupBy(value_slice(F.col("v")).alias("s")).agg(F.count_distinct("v").alias("n"))
    biggest = slices.agg(F.max("n")).first()[0]
    assert biggest < 200  # of about 15 000 different values


def test_slice_order_is_value_order(spark):
    values = [-1e12, -3.5, -1e-9, 0.0, 1e-12, 1e-3, 0.5, 0.5000001, 7.0, 1e15]
    rows = spark.createDataFrame([(v,) for v in values], "v double").withColumn("s", value_slice(F.col("v"))).orderBy("v").collect()
    s = [r.s for r in rows]
    assert s == sorted(s)


def test_asof_on_hot_key_equals_pandas(spark):
    rng = np.random.default_rng(3)
    days = pd.date_range("2018-01-01", periods=900)
    left = pd.DataFrame({"k": np.where(rng.random(5000) < 0.6, 0, rng.integers(1, 30, 5000)), "t": rng.choice(days, 5000), "i": range(5000)})
    right = pd.DataFrame({"k": rng.integers(0, 30, 800), "u": rng.choice(days, 800), "v": rng.random(800)}).drop_duplicates(["k", "u"])
    l = spark.createDataFrame(left).withColumn("t", F.col("t").cast("date"))
    r = spark.createDataFrame(right).withColumn("u", F.col("u").cast("date"))
    got = J.asof_join(l, r, ["k"], "t", "u", ["v"]).select("i", "v").toPandas().sort_values("i")
    want = pd.merge_asof(left.sort_values("t"), right.sort_values("u"), left_on="t", right_on="u", by="k").sort_values("i")
    np.testing.assert_allclose(got["v"].to_numpy(dtype=float), want["v"].to_numpy())


def test_dedupe_limits_copies_before_the_shuffle(spark):
    df = spark.range(20000).select(F.expr("id div 100000").alias("k"), F.col("id").cast("string").alias("update_flag"), F.col("id").alias("v"))
    out = dedupe_by_key(df, ["k"])
    assert out.first().v == 19999
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("kind", ["epoch", "id", "level"])
def test_narrow_values_are_cut_again(spark, kind, monkeypatch):
    """A hot group of values that share one relative slice: exact ranks and quantiles from many small pieces."""
    import panelspark.operators.order_stats as O

    monkeypatch.setattr(O, "FEW", 100)
    rng = np.random.default_rng(11)
    base = {"epoch": 1.7e9 + rng.integers(0, 40_000, 12_000), "id": 5e8 + rng.permutation(12_000), "level": np.round(1e6 * (1 + 1e-5 * rng.standard_normal(12_000)), 3)}[kind]
    pdf = pd.DataFrame({"d": np.where(np.arange(12_000) % 10 == 0, 1, 0), "v": base.astype(float), "i": range(12_000)})
    df = spark.createDataFrame(pdf)
    ranks = with_average_rank(df, ["d"], "v", "r").select("i", "r").toPandas().sort_values("i")
    np.testing.assert_allclose(ranks["r"], pdf.groupby("d")["v"].rank())
    q = group_quantiles(df, ["d"], ["v"], [(1, 2), (9, 10), (0, 1), (1, 1)]).toPandas().set_index("d").sort_index()
    for k, p in enumerate((0.5, 0.9, 0.0, 1.0)):
        np.testing.assert_allclose(q[f"v_q{k}"], pdf.groupby("d")["v"].quantile(p), rtol=1e-12)
    sizes = df.where("d = 0").select("v").distinct().withColumn("s", value_slice(F.col("v")))
    sizes = sizes.join(sizes.groupBy("s").agg(F.count("*").alias("k"), F.min("v").alias("lo"), F.max("v").alias("hi")), "s")
    most = sizes.groupBy("s", O._piece(F.col("v"), F.col("lo"), F.col("hi"), F.col("k")).alias("f")).count().agg(F.max("count")).first()[0]
    assert most < 1500  # of about 10 000 different values


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_asof_join_of_a_hot_bucket_equals_pandas(spark, kind):
    """One key holds most rows of one month; its bucket is cut at quantiles, ties and quiet spans included."""
    from panelspark.operators import joins

    rng = np.random.default_rng(8)
    start = pd.Timestamp("2024-03-01")
    clock = np.concatenate([rng.integers(0, 86_400, 1500), rng.integers(86_400, 29 * 86_400, 500), np.full(200, 500_000), rng.integers(-90 * 86_400, 0, 100)])
    left = pd.DataFrame({"k": np.where(rng.random(len(clock)) < 0.8, 7, rng.integers(0, 5, len(clock))), "t": start + pd.to_timedelta(clock, "s"), "i": range(len(clock))})
    right = pd.DataFrame({"k": np.where(rng.random(900) < 0.7, 7, rng.integers(0, 5, 900)), "u": start + pd.to_timedelta(rng.integers(-100 * 86_400, 29 * 86_400, 900), "s")})
    if kind == "date":
        left["t"], right["u"] = left["t"].dt.normalize(), right["u"].dt.normalize()
    right = right.drop_duplicates(["k", "u"]).assign(v=lambda d: rng.random(len(d)))
    want = pd.merge_asof(left.sort_values("t"), right.sort_values("u"), left_on="t", right_on="u", by="k").set_index("i")["v"].sort_index()
    lt = spark.createDataFrame(left).withColumn("t", F.col("t").cast(kind))
    rt = spark.createDataFrame(right).withColumn("u", F.col("u").cast(kind))
    for split in (None, 100, 1):
        got = joins.asof_join(lt, rt, ["k"], "t", "u", ["v"], split=split).toPandas().set_index("i")["v"].sort_index()
        pd.testing.assert_series_equal(got, want, check_names=False)
    asked = lt.withColumns({"_t": F.col("t"), "_b": joins._bucket("t", "month")})
    (cut,) = joins._cut_buckets([asked], ["k"], 100)
    sizes = cut.groupBy("k", "_b", "_p").agg(F.count("*").alias("n"), F.min("t").alias("a"), F.max("t").alias("z")).orderBy("k", "_b", "_p").toPandas()
    hot = sizes[sizes["k"] == 7]
    assert len(hot) > (5 if kind != "date" else 3)
    for _, month in hot.groupby("_b"):
        assert (month["z"].to_numpy()[:-1] < month["a"].to_numpy()[1:]).all()
