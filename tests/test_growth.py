"""Steps that grew faster than their tables, or met a limit on larger ones, on rows made here."""

import contextlib
import io
import math
from datetime import date

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from panelspark.datasets import entity_panel as EP
from panelspark.datasets import market_state as ST
from panelspark.datasets import statements as FS
from panelspark.datasets import stock_factors as SF
from panelspark.datasets.valuation import valuation_history
from panelspark.operators import windows as W
from panelspark.operators.order_stats import group_quantiles, listed_medians
from panelspark.sources.sinks import staged


def plan_of(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_members_of_past_months_are_not_broadcast(spark):
    months = [date(2020 + m // 12, m % 12 + 1, 1) for m in range(24)]
    panel = spark.createDataFrame([(e, m, float(e + i), float(e)) for e in range(4) for i, m in enumerate(months)], "entity long, period date, pe double, pb double")
    members = staged(spark.createDataFrame([(m, "all", e) for m in months for e in (0, 1, 3, None)], "month date, dim string, entity long"), "members")
    current = members.select("month", "dim").distinct().withColumns({"pe_ttm_median": F.lit(10.0), "pb_median": F.lit(1.5)})
    shares = ST.valuation_history_share(panel, members, current, months=3)
    found = {r["month"]: (r["pe_pct_5y"], r["pb_pct_5y"]) for r in shares.collect()}
    # medians of members 0, 1, 3 are i + 1 and 1; months 8 to 10 have medians 9, 10 and 11
    assert found[months[10]] == (1 / 3, 1.0) and len(found) == 24
    joins = plan_of(shares).split("_q0")[0]
    assert "explode" not in joins and "SortMergeJoin [entity" in plan_of(shares)


def test_history_pack_keeps_no_window_arrays(spark):
    nan, inf = math.nan, math.inf
    series = {1: [float(i * i % 17) - 5 for i in range(90)], 2: [2.0] * 20, 3: [1.0, None, nan, 4.0, inf, 5.0, 1.0, None], None: [3.0, 1.0, 2.0, 5.0, 4.0]}
    rows = [(e, i, v) for e, vs in series.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "entity long, i int, gpp_q double").select(
        "entity", F.date_add(F.lit("2020-01-01").cast("date"), F.col("i")).alias("snapshot_date"), F.col("i").alias("end_date"), "gpp_q",
        *[F.lit(None).cast("double").alias(c) for c in ("admp_q", "rdp_q", "taxp_q")],
    )
    out = valuation_history(df, base=["gpp_q"])
    assert "collect_list" not in plan_of(out)
    found = {(r["entity"], r["snapshot_date"].timetuple().tm_yday - 1): r for r in out.collect()}
    assert len(found) == sum(len(v) - 3 for v in series.values())
    for (e, i), r in found.items():
        h = [x for x in series[e][max(0, i - 35) : i + 1] if x is not None]
        assert r["report_cnt"] == min(i + 1, 36)
        if len(h) < 4:
            assert r["gpp_q_mean"] is None and r["gpp_q_neg_cnt"] is None
            continue
        above = lambda x, y: math.isnan(y) or x <= y
        assert r["gpp_q_tsrank"] == sum(above(x, h[-1]) for x in h[:-1]) / (len(h) - 1) and r["gpp_q_neg_cnt"] == sum(x < 0 for x in h)
        if not all(map(math.isfinite, h)):
            assert r["gpp_q_mean"] is None and r["gpp_q_std"] is None
            continue
        mean, flat = sum(h) / len(h), min(h) == max(h)
        std = 0.0 if flat else math.sqrt(sum((x - mean) ** 2 for x in h) / len(h))
        assert math.isclose(r["gpp_q_mean"], mean) and math.isclose(r["gpp_q_std"], std)
        assert r["gpp_q_zscore"] is None if flat else math.isclose(r["gpp_q_zscore"], (h[-1] - mean) / std, abs_tol=1e-12)
        before = h[-13] if len(h) > 12 else 0.0
        assert r["gpp_q_momentum"] is None if before == 0 else math.isclose(r["gpp_q_momentum"], (h[-1] - before) / abs(before), abs_tol=1e-12)


def test_statements_take_one_shuffle(spark):
    day = date.fromisoformat
    rows = [
        (1, day("2019-12-31"), day("2020-03-01"), day("2020-03-01"), "0", 10_000.0),
        (1, day("2019-12-31"), day("2020-03-01"), day("2020-03-01"), "1", 20_000.0),  # the same day, a later flag
        (1, day("2019-12-31"), day("2020-05-01"), day("2020-05-01"), "0", 30_000.0),
        (1, day("2020-03-31"), day("2020-04-20"), day("2020-04-20"), "0", 40_000.0),
        (1, day("2020-03-31"), day("2020-04-20"), None, "0", 50_000.0),  # known at its end, then replaced
        (None, day("2019-12-31"), day("2020-03-01"), day("2020-03-01"), "0", 60_000.0),
    ]
    kinds = "entity long, end_date date, ann_date date, f_ann_date date, update_flag string"
    income = spark.createDataFrame(rows, f"{kinds}, revenue double")
    balance = spark.createDataFrame(rows[3:4], f"{kinds}, cip double")
    cash = income.where("false").drop("revenue")
    shown = [(e, d, day(a), day(a), day(a), None) for e, d, a in [(1, rows[0][1], "2020-03-01"), (1, rows[3][1], "2020-04-20"), (None, rows[0][1], "2020-03-01")]]
    disclosure = spark.createDataFrame(shown, "entity long, end_date date, ann_date date, pre_date date, actual_date date, modify_date date")
    dividends = spark.createDataFrame([], "entity long, end_date date, ex_date date, div_proc string, update_flag string, cash_div double, base_share double")
    size = spark.createDataFrame([(1, day("2020-04-30"), 5.0), (1, day("2020-04-15"), 6.0)], "entity long, period date, total_mv double")
    size = size.withColumns({c: F.col("total_mv") for c in ("total_share", "float_share", "circ_mv")})
    snaps = spark.createDataFrame([(day("2020-03-31"),), (day("2020-04-30"),), (day("2020-05-29"),)], "snapshot_date date")
    out = FS.statements_snapshot(disclosure, balance, income, cash, dividends, size, snaps)
    found = sorted(
        (r["snapshot_date"].month, r["entity"] or 0, r["end_date"].month, r["has_inc"], r["revenue"], r["cip"], r["total_mv"]) for r in out.collect()
    )
    assert found == [
        (3, 0, 12, 0, None, None, None),
        (3, 1, 12, 1, 2.0, None, None),
        (4, 0, 12, 0, None, None, None),
        (4, 1, 3, 1, 4.0, 4.0, 5.0),
        (4, 1, 3, 1, 4.0, 4.0, 6.0),
        (4, 1, 12, 1, 2.0, None, None),
        (5, 0, 12, 0, None, None, None),
        (5, 1, 3, 1, 4.0, 4.0, 5.0),
        (5, 1, 3, 1, 4.0, 4.0, 6.0),
        (5, 1, 12, 1, 3.0, None, None),
    ]
    after = plan_of(out).split("REPARTITION_BY_COL")[0].rpartition("\n")[0]
    assert "Exchange hashpartitioning" not in after and "SortMergeJoin" not in after


def test_percentile_panel_is_one_pass(spark):
    rng = np.random.default_rng(5)
    frames = []
    for e, n in ((1, 40), (2, 7), (3, 25)):
        values = {c: np.round(rng.normal(10, 3, n), 1) for c in ("close", "pe", "pe_ttm", "pb", "turnover_rate", "pct_chg")}
        frames.append(pd.DataFrame({"entity": e, "period": pd.date_range("2020-01-01", periods=n).date, **values, "adj_factor": 2.0}))
    frames[0].loc[12, "pe"] = np.inf
    frames[2].loc[3, "pe"] = np.nan
    df = spark.createDataFrame(pd.concat(frames)).withColumn("close", F.when(~((F.col("entity") == 3) & (F.col("pb") < 8)), F.col("close")))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        out = EP.percentile_panel(df, windows=[3, 5], rank_windows={"s": 6, "l": 11}, min_rows=4)
        plan, found = plan_of(out), out.toPandas().sort_values(["entity", "period"])
        given = df.toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert "Join" not in plan and "FlatMapGroups" not in plan and len(found) == 72
    for e, mine in found.groupby("entity"):
        src = given[given.entity == e].sort_values("period")
        for c, want in {
            **{f"ma{n}": src.close.rolling(n).mean() for n in (3, 5)},
            **{f"volatility_{n}": src.pct_chg.rolling(n).std() for n in (3, 5)},
            **{f"{v}_tsrank_{k}": (src[c].rolling(n, min_periods=4).rank() - 1) / (src[c].rolling(n, min_periods=4).count() - 1) for v, c in (("price", "close"), ("pe", "pe"), ("pb", "pb")) for k, n in (("s", 6), ("l", 11))},
        }.items():
            np.testing.assert_allclose(mine[c].to_numpy(float), want.to_numpy(float), atol=1e-9, err_msg=f"{e} {c}")


def test_price_volume_pack_stores_what_it_reads(spark):
    rng = np.random.default_rng(3)
    rows = [(e, date(2020, 1, 1 + i), e % 2, *map(float, rng.uniform(1, 9, 12)), "unused") for e in range(6) for i in range(22)]
    flows = [f"{s}_{b}_vol" for s in ("buy", "sell") for b in ("sm", "elg")]
    numbers = ["open", "high", "low", "close", "pre_close", "vol", "amount", "size", *flows]
    df = spark.createDataFrame(rows, f"entity long, period date, grp int, {', '.join(f'{c} double' for c in numbers)}, note string")
    df = df.withColumns({"pct_chg": F.col("close") - 5, "log_return": F.log("close"), "turnover": F.col("vol") / 50})
    stored = {}

    def kept(d, name):
        stored[name] = d.columns
        return staged(d, name)

    assert SF.price_volume_pack(df, stage=kept).count() == 6 * 3
    assert {"entity", "period", "net_sm_vol", "illiq"} <= set(stored["features"])
    assert all(not {"note", "high", "body", *flows} & set(c) for c in stored.values())


def test_rank_share_puts_rows_without_a_period_last(spark):
    rows = [(1, None, 9.0), *[(1, date(2020, 1, d), float(d)) for d in (1, 2, 3)]]
    out = W.rolling_rank_share(spark.createDataFrame(rows, "entity long, period date, v double"), "entity", "period", ["v"], {"w": 3}, min_rows=2)
    found = {r["period"] and r["period"].day: r["v_tsrank_w"] for r in out.collect()}
    assert found == {1: None, 2: 1.0, 3: 1.0, None: 1.0} and "FlatMapGroups" not in plan_of(out)


def test_listed_medians_equal_medians_of_copies(spark, monkeypatch):
    """Rows that count for many groups: nulls, NaN, infinity, ties, narrow values, repeated numbers and empty lists."""
    import panelspark.operators.order_stats as O

    monkeypatch.setattr(O, "PIECES", 8)
    rng = np.random.default_rng(4)
    n = 900
    a = np.where(np.arange(n) < 300, np.round(rng.normal(0, 3, n), 1), 1e6 * (1 + 1e-6 * rng.standard_normal(n)))
    pdf = pd.DataFrame({"past": np.where(np.arange(n) % 3 == 0, 1, 2), "a": a, "b": rng.integers(1, 4, n).astype(float)})
    pdf.loc[5, "a"], pdf.loc[8, "b"] = np.inf, -np.inf
    pdf["ids"] = [[int(x) for x in rng.integers(0, 7, k)] for k in rng.integers(0, 6, n)]
    df = spark.createDataFrame(pdf).withColumns({"a": F.when(F.col("b") == 3, F.lit(math.nan)).when(F.col("b") > 1, F.col("a"))})
    out = listed_medians(df, ["past"], "ids", ["a", "b"])
    found = {(r["ids"], r["past"]): (r["a_q0"], r["b_q0"]) for r in out.collect()}
    copies = df.toPandas().explode("ids").dropna(subset=["ids"])
    want = {k: (g["a"].median(), g["b"].median()) for k, g in copies.groupby(["ids", "past"])}
    assert found.keys() == want.keys()
    for k, pair in want.items():
        np.testing.assert_allclose(found[k], pair, rtol=1e-12)
    # lists are dealt, copies are not: nothing is exploded below the shuffle by runs
    dealt = plan_of(out).split("REPARTITION_BY_COL")
    assert len(dealt) > 1 and not any("explode(_ids" in x.split("Exchange")[0] for x in dealt[1:])


def test_quantiles_of_dates_leave_the_rows_where_they_are(spark):
    df = spark.range(400).selectExpr("id % 4 as d", "cast(id * 7 % 101 as double) as v")
    few, many = (group_quantiles(df, ["d"], ["v"], [(1, 2), (1, 4)], few_groups=k) for k in (True, False))
    assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    assert "BroadcastHashJoin [d" in plan_of(few) and "SortMergeJoin" not in plan_of(few)


def test_market_members_meet_their_rows_by_entity(spark):
    days = [date(2020, 1, 1), date(2020, 1, 2), date(2020, 2, 3)]
    values = [(e, d, float((e or 9) + i), 1.0, *[1.0] * 13) for e in (1, 2, 3, None) for i, d in enumerate(days)]
    names = ["close", "amount", "pe", "pb", "dv", "turnover", "net_amount", *ST.FLOW_COLUMNS]
    panel = spark.createDataFrame(values, "entity long, period date, " + ", ".join(f"{c} double" for c in names)).withColumn("turnover", F.col("close"))
    months = [date(2020, 1, 1), date(2020, 2, 1)]
    held = [(months[0], "all", e) for e in (1, 2, 2, None)] + [(months[1], "all", 3), (months[0], "g", 1), (None, "g", 1)]
    members = staged(spark.createDataFrame(held, "month date, dim string, entity long"), "members")
    rows = ST.member_rows(panel, members)
    plan = plan_of(rows)
    assert "SortMergeJoin [entity" in plan and "month" not in "".join(x for x in plan.splitlines() if "Exchange" in x)
    found = {(r["month"], r["dim"]): r for r in ST.member_measures(rows).collect()}
    assert found.keys() == {(months[0], "all"), (months[0], "g"), (months[1], "all")}
    # closes 1, 2 of entity 1 and twice 2, 3 of entity 2
    assert found[months[0], "all"]["turnover_rate_median"] == 2.0 and found[months[0], "g"]["turnover_rate_median"] == 1.5
    assert found[months[1], "all"]["pct_above_ma60"] is None and found[months[0], "all"]["profit_ratio"] == 1.0


def test_price_volume_pack_stores_rows_twice(spark):
    """The features and the windows; everything else that is stored has one row per date or cell."""
    rng = np.random.default_rng(6)
    rows = [(e, date(2020, 1, 1 + i), e % 2, *map(float, rng.uniform(1, 9, 12))) for e in range(40) for i in range(22)]
    flows = [f"{s}_{b}_vol" for s in ("buy", "sell") for b in ("sm", "elg")]
    numbers = ["open", "high", "low", "close", "pre_close", "vol", "amount", "size", *flows]
    df = spark.createDataFrame(rows, f"entity long, period date, grp int, {', '.join(f'{c} double' for c in numbers)}")
    df = df.withColumns({"pct_chg": F.col("close") - 5, "log_return": F.log("close"), "turnover": F.col("vol") / 50})
    stored = {}

    def kept(d, name):
        out = staged(d, name)
        stored[name] = out.count()
        return out

    out = SF.price_volume_pack(df, stage=kept)
    assert {n for n, rows in stored.items() if rows > 2 * 22} == {"features", "windows"} and out.count() == 40 * 3


def test_u_turn_of_repeated_and_missing_values(spark):
    s = [1.0, 1.0, 2.0, None, 4.0, 3.0, 3.0, math.nan]
    m = [5.0, 5.0, None, 1.0, 2.0, 8.0, 7.0, 3.0]
    df = spark.createDataFrame([(i, date(2020, 1, 1), a, b) for i, (a, b) in enumerate(zip(s, m))], "i int, d date, s double, m double")
    out = SF.u_turn(df, "d", "s", "m", "u")
    found = {r["i"]: r["u"] for r in out.collect()}
    # ranks of s over 8 rows: 1.5 1.5 3 - 6 4.5 4.5 -; the calm half is 0, 1, 2 with m 5 5 -
    sr = {i: (k - 1) / 7 for i, k in enumerate([1.5, 1.5, 3, None, 6, 4.5, 4.5, None]) if k}
    mr = {0: 0.25, 1: 0.25, 4: 0.0, 5: 1.0, 6: 0.5}
    half = {0: (1 - 0.25) * 0.5, 1: (1 - 0.25) * 0.5, 4: 0.0, 5: 0.5, 6: 0.25}
    assert out.columns == ["i", "d", "s", "m", "u"] and len(found) == 8 and found[3] is None and found[7] is None
    for i in mr:
        assert math.isclose(found[i], (sr[i] + half[i]) / 2), i
    assert math.isclose(found[2], sr[2])


def test_statements_that_no_snapshot_sees_stay_out_of_the_shuffle(spark):
    day = date.fromisoformat
    rows = [
        (1, day("2019-12-31"), day("2020-03-01"), day("2020-03-01"), "0", 10_000.0),
        (1, day("2019-12-31"), day("2020-03-01"), day("2020-09-01"), "0", 90_000.0),  # published after the last snapshot
        (1, day("2014-12-31"), day("2015-03-01"), day("2015-03-01"), "0", 80_000.0),  # too old for all of them
        (1, day("2020-03-31"), day("2020-04-20"), day("2020-04-20"), "0", 40_000.0),  # replaced between two snapshots
        (1, day("2020-03-31"), day("2020-04-20"), day("2020-04-25"), "0", 50_000.0),
    ]
    kinds = "entity long, end_date date, ann_date date, f_ann_date date, update_flag string"
    income = spark.createDataFrame(rows, f"{kinds}, revenue double")
    none = income.where("false").drop("revenue")
    shown = [(1, r[1], r[2], r[2], r[2], None) for r in (rows[0], rows[3])]
    disclosure = spark.createDataFrame(shown, "entity long, end_date date, ann_date date, pre_date date, actual_date date, modify_date date")
    dividends = spark.createDataFrame([], "entity long, end_date date, ex_date date, div_proc string, update_flag string, cash_div double, base_share double")
    size = spark.createDataFrame([], "entity long, period date, total_share double, float_share double, total_mv double, circ_mv double")
    snaps = spark.createDataFrame([(day("2020-03-31"),), (day("2020-04-30"),)], "snapshot_date date")
    out = FS.statements_snapshot(disclosure, none, income, none, dividends, size, snaps, parts=3)
    found = sorted((r["snapshot_date"].month, r["end_date"].month, r["revenue"]) for r in out.collect())
    assert found == [(3, 12, 1.0), (4, 3, 5.0), (4, 12, 1.0)]
    plan = plan_of(out)
    assert "hashpartitioning(entity" in plan and "3), REPARTITION_BY_NUM" in plan
    # below the one wide shuffle, versions are asked for a snapshot of their span
    assert "filter(_all" in plan.split("REPARTITION_BY_NUM")[1]


def test_parts_of_statements_follow_the_orders(spark, tmp_path, monkeypatch):
    from panelspark.plans import dataset_queries as Q

    spark.range(1000).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(Q, "ORDERS_A_PART", 10)
    assert Q.statement_parts(spark, str(tmp_path)) == 100
