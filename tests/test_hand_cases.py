"""Small cases worked out by hand."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from panelspark.operators import calendar as C
from panelspark.operators import cross_section as X
from panelspark.operators import joins as J
from panelspark.operators import portfolio as P
from panelspark.operators import quality as Q
from panelspark.operators import slices as S
from panelspark.operators import windows as W
from panelspark.operators.aggregates import gini
from panelspark.sources.sinks import dedupe_by_key, duplicate_report


def column(df, key, col):
    return [r[col] for r in df.orderBy(key).collect()]


def section(rows, values, schema="d int, i int, v double"):
    return rows([(1, i, v) for i, v in enumerate(values)], schema)


def near(a, b, tol=1e-12):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert (x is None and y is None) or x == pytest.approx(y, abs=tol), (a, b)


def test_rank_factor_ties(rows):
    out = X.rank_factor(section(rows, [10.0, 20.0, 20.0, 40.0]), ["d"], "v", "r")
    near(column(out, "i", "r"), [0, 0.5, 0.5, 1])


def test_rank_factor_single_row(rows):
    near(column(X.rank_factor(section(rows, [7.0]), ["d"], "v", "r"), "i", "r"), [0.5])


def test_rank_factor_counts_null_rows(rows):
    out = X.rank_factor(section(rows, [1.0, None, 3.0]), ["d"], "v", "r")
    near(column(out, "i", "r"), [0, None, 0.5])


def test_percentile_rank(rows):
    out = X.percentile_rank(section(rows, [10.0, 20.0, 20.0, None]), ["d"], "v", "p")
    near(column(out, "i", "p"), [1 / 3, 2.5 / 3, 2.5 / 3, None])


def test_winsorize_without_spread(rows):
    out = X.winsorize_mad(section(rows, [1.0, 1.0, 1.0, 9.0]), ["d"], ["v"])
    near(column(out, "i", "v_clean"), [1, 1, 1, 9])


def test_zscore_flat(rows):
    near(column(X.standardize(section(rows, [5.0, 5.0]), ["d"], "v", "z"), "i", "z"), [0, 0])


def test_bucket_one_to_ten(rows):
    out = X.quantile_bucket(section(rows, [float(i) for i in range(1, 11)]), ["d"], "v", "b", buckets=5)
    assert column(out, "i", "b") == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_bucket_small_group_and_flat_group(rows):
    assert column(X.quantile_bucket(section(rows, [1.0, 2.0, 3.0]), ["d"], "v", "b", buckets=5), "i", "b") == [None] * 3
    assert column(X.quantile_bucket(section(rows, [4.0] * 6), ["d"], "v", "b", buckets=3), "i", "b") == [None] * 6


def test_fixed_bucket_edges(rows):
    df = section(rows, [-0.1, 0.0, 1.0, 1.5, 2.0, 2.1]).withColumn("b", X.fixed_bucket("v", [0, 1, 2]))
    assert column(df, "i", "b") == [None, 1, 1, 2, 2, None]


def test_asof_validity_excludes_out_day(rows):
    left = rows([(1, date(2020, 5, 31)), (1, date(2020, 6, 1)), (1, date(2019, 12, 31)), (2, date(2020, 3, 1))], "k int, t date")
    iv = rows([(1, date(2020, 1, 1), date(2020, 6, 1), "a")], "k int, a date, b date, label string")
    out = J.asof_valid_join(left, iv, ["k"], "t", "a", "b", ["label"])
    got = {(r.k, r.t): r.label for r in out.collect()}
    assert got == {(1, date(2020, 5, 31)): "a", (1, date(2020, 6, 1)): None, (1, date(2019, 12, 31)): None, (2, date(2020, 3, 1)): None}


def test_asof_exact_match_and_bound(rows):
    left = rows([(1, date(2020, 3, 1)), (1, date(2020, 3, 9))], "k int, t date")
    right = rows([(1, date(2020, 3, 1), 1.0), (1, date(2020, 2, 1), 2.0)], "k int, u date, v double")
    out = J.asof_join(left, right, ["k"], "t", "u", ["v"], max_days=5)
    assert column(out, "t", "v") == [1.0, None]


def test_interval_join_closed_and_open_end(rows):
    left = rows([(1, date(2020, 1, d)) for d in (1, 2, 3, 4)] + [(1, date(2021, 7, 1))], "k int, t date")
    iv = rows([(1, date(2020, 1, 2), date(2020, 1, 3)), (1, date(2020, 1, 4), None)], "k int, a date, b date")
    hit = J.interval_join(left, iv, ["k"], "t", "a", "b", how="left_semi")
    assert [r.t for r in hit.orderBy("t").collect()] == [date(2020, 1, 2), date(2020, 1, 3), date(2020, 1, 4), date(2021, 7, 1)]
    miss = J.interval_join(left, iv, ["k"], "t", "a", "b", how="left_anti")
    assert [r.t for r in miss.collect()] == [date(2020, 1, 1)]


def test_single_quarter_and_trailing_sum(rows):
    data = [(1, date(2020, 3, 31), 1, 10.0), (1, date(2020, 6, 30), 2, 25.0), (1, date(2020, 9, 30), 3, 45.0),
            (1, date(2020, 12, 31), 4, 70.0), (1, date(2021, 3, 31), 1, 12.0)]
    w = W.by_time("e", "p")
    df = rows(data, "e int, p date, q int, v double").withColumn("s", W.single_period("v", F.col("q") == 1, w))
    df = df.withColumn("t", W.rolling(F.sum, "s", w, 4))
    assert column(df, "p", "s") == [10, 15, 20, 25, 12]
    assert column(df, "p", "t") == [None, None, None, 70, 72]


def test_bounded_forward_fill(rows):
    df = rows([(1, i, v) for i, v in enumerate([1.0, None, None, 4.0])], "e int, p int, v double")
    assert column(df.withColumn("f", W.forward_fill("v", W.by_time("e", "p"), 1)), "p", "f") == [1, 1, None, 4]


def test_gini(rows):
    near(column(gini(section(rows, [2.0] * 5), ["d"], "v"), "d", "gini"), [0])
    near(column(gini(section(rows, [0.0, 0.0, 0.0, 0.0, 9.0]), ["d"], "v"), "d", "gini"), [0.8])
    assert column(gini(section(rows, [1.0] * 4), ["d"], "v"), "d", "gini") == [None]


def test_flat_trend(rows):
    w = W.by_time("e", "p")
    df = rows([(1, i, 7.0) for i in range(25)], "e int, p int, v double").withColumn("i", W.row_index(w))
    r2, slope = W.rolling_trend("v", "i", w, 20)
    last = df.withColumns({"r2": r2, "s": slope}).orderBy(F.desc("p")).first()
    assert (last.r2, last.s) == (0.0, 0.0)


def test_ordered_slice_weights(rows):
    values = [0.3, 0.1, 0.9, 0.5, 0.7] * 4
    data = [(1, date(2020, 1, i + 1), float(i), v) for i, v in enumerate(values)]
    df = S.with_sorted_frame(rows(data, "e int, p date, k double, v double"), "e", "p", "k", ["v"], "a")
    cols = S.slice_columns("a", {"v": "{slice}"}, [5])
    last = df.select("p", *[c.alias(n) for n, c in cols.items()]).orderBy(F.desc("p")).first()
    desc = values[::-1]
    lin, exp = [1, 0.8, 0.6, 0.4, 0.2], [2 ** (-i / 4) for i in range(5)]
    near([last.top5, last.top5_ld, last.top5_exp], [sum(desc[:5]), sum(a * b for a, b in zip(desc, lin)), sum(a * b for a, b in zip(desc, exp))])
    tail = desc[15:]
    near([last.bottom5, last.bottom5_ld, last.bottom5_exp],
         [sum(tail), sum(a * b for a, b in zip(tail, lin[::-1])), sum(a * b for a, b in zip(tail, exp[::-1]))])


def test_forward_return_next_day_entry(rows):
    data = [(1, date(2020, 1, d), p) for d, p in ((1, 10.0), (2, 11.0), (3, 12.1), (4, 12.1))]
    out = W.forward_returns(rows(data, "e int, p date, c double"), "e", "p", "c", [1])
    near(column(out, "p", "fwd_ret_1"), [0.1, 0.0, None, None])


def test_coverage_status(rows):
    days = [date(2020, 1, d) for d in (1, 2, 3, 4)]
    expected = rows([("s", d) for d in days], "source string, biz_date date")
    counts = rows([("s", days[0], 100), ("s", days[1], 100), ("s", days[2], 40)], "source string, biz_date date, row_count long")
    assert column(Q.coverage(expected, counts), "biz_date", "status") == ["OK", "OK", "PARTIAL", "MISSING"]


def weekdays(spark):
    days = spark.sql("select explode(sequence(date'2020-01-06', date'2020-02-28')) as cal_date")
    return days.select(F.lit("X").alias("exchange"), "cal_date", (F.weekday("cal_date") < 5).cast("int").alias("is_open"))


def test_nearest_trading_day(spark, rows):
    d = rows([(date(2020, 1, 12),), (date(2019, 6, 1),), (date(2021, 1, 1),)], "d date")
    out = C.nearest_trading_day(d, weekdays(spark))
    assert column(out, "d", "trading_day") == [date(2020, 1, 6), date(2020, 1, 10), date(2020, 2, 28)]


def test_shift_from_open_and_closed_day(spark, rows):
    d = rows([(date(2020, 1, 15),), (date(2020, 1, 18),), (date(2020, 1, 7),)], "d date")
    back = C.shift_trading_days(d, weekdays(spark), -2)
    assert column(back, "d", "shifted") == [date(2020, 1, 6), date(2020, 1, 13), date(2020, 1, 16)]
    ahead = C.shift_trading_days(d, weekdays(spark), 2)
    assert column(ahead, "d", "shifted") == [date(2020, 1, 9), date(2020, 1, 17), date(2020, 1, 21)]


def test_dedupe_keeps_highest_flag(rows):
    df = rows([("a", "0", 1.0), ("a", "1", 2.0), ("b", "x", 3.0)], "k string, update_flag string, v double")
    assert column(dedupe_by_key(df, ["k"]), "k", "v") == [2.0, 3.0]
    assert [(r.k, r.copies) for r in duplicate_report(df, ["k"]).collect()] == [("a", 2)]


def test_capped_weights(rows):
    def weights(k, cap):
        data = [("c", 1, f"e{i}", 1.0 + i, 0.1, 0.4, k, cap) for i in range(6)]
        sig = rows(data, "config string, period int, entity string, momentum double, volatility double, vol_limit double, positions int, cap double")
        return sorted(r.weight for r in P.select_top(sig, k).collect())

    assert weights(2, 0.3) == [0.3, 0.3]
    assert weights(5, 0.3) == [0.2] * 5


def test_turnover_cost(rows):
    w = rows([("c", 1, "a", 1.0), ("c", 2, "b", 1.0)], "config string, period int, entity string, weight double")
    out = P.rebalance_cost(P.turnover(w), 1e6)
    near(column(out, "period", "turnover"), [1, 2])
    near(column(out, "period", "cost"), [1250, 2500], 1e-6)


def test_performance(rows):
    data = [("c", i, x) for i, x in enumerate([0.01, -0.02, 0.03, 0.01, -0.01])] + [("one", 0, 0.01)]
    out = {r.config: r for r in P.performance(rows(data, "config string, period int, ret double")).collect()}
    assert out["c"].win_rate == 0.6
    assert len(out["c"].asDict()) == 8
    assert out["c"].max_drawdown == pytest.approx(-0.02)
    assert out["one"].annual_volatility == 0.0 and out["one"].sharpe == 0.0


def test_quadrant_scores(rows):
    from panelspark.datasets.index_factors import overnight_intraday

    def score(on, day):
        data, close = [], 100.0
        for i in range(32):
            opened = close * (1 + on)
            new = opened * (1 + day)
            data.append((1, date.fromordinal(737000 + i), opened, new, close))
            close = new
        df = rows(data, "entity int, period date, open double, close double, pre double")
        return overnight_intraday(df, "pre").orderBy(F.desc("period")).first().score

    assert [score(0.01, -0.02), score(-0.01, 0.02), score(0.0, 0.02), score(0.01, 0.01), score(-0.01, -0.01)] == [2, -2, 0, 1, -1]


def test_run_length(rows):
    df = rows([(1, i, f) for i, f in enumerate([True, True, False, True, None, True])], "e int, p int, f boolean")
    assert column(df.withColumn("n", W.run_length("f", W.by_time("e", "p"))), "p", "n") == [1, 2, 0, 1, 0, 1]


def test_max_drawdown(rows):
    df = rows([(1, i, p) for i, p in enumerate([10.0, 12.0, 9.0, 11.0])], "e int, p int, c double")
    out = df.withColumn("d", W.rolling_max_drawdown("c", W.by_time("e", "p"), 4))
    near(column(out, "p", "d"), [None, None, None, -0.25])
