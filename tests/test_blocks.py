"""Steps whose time or memory grew faster than the input: labels made once, indicators in blocks, parts by size, small batches."""

import datetime as dt
import math
import operator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from panelspark.datasets import entity_panel as EP
from panelspark.datasets import fund_panel as FP
from panelspark.datasets import fund_rules as FR
from panelspark.datasets import statements as FS
from panelspark.llm import phrases


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_fund_labels_make_the_name_and_the_rule_once(rows):
    text = plan(rows([("华夏上证50ETF",)], "n string").select(FR.fund_labels(FR.index_name(F.col("n"))).alias("l")))
    assert text.count("regexp_replace") <= 4 and text.count("filter(") == 1


def test_one_as_of_join_gives_the_last_of_every_part(rows):
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(n)
    nav = rows([(1, day(1), 1.0, 1.0, 1.0), (1, day(40), None, 2.0, 2.0), (None, day(3), 9.0, 9.0, 9.0), (2, None, 5.0, 5.0, 5.0)], "entity long, nav_date date, unit_nav double, accum_nav double, adj_nav double")
    shares = rows([(1, day(1), 7.0), (1, day(20), 8.0), (2, day(2), 3.0)], "entity long, share_date date, fd_share double")
    got = FP.last_published({"nav": (nav, "nav_date", FP.NAV), "shares": (shares, "share_date", ["fd_share"])})
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, day(1), 1.0, 1.0, 1.0, 7.0), (1, day(20), 1.0, 1.0, 1.0, 8.0), (1, day(40), None, 2.0, 2.0, 8.0), (2, day(2), None, None, None, 3.0), (None, day(3), 9.0, 9.0, 9.0, None)], key=str)


def test_entity_panel_takes_its_number_of_partitions(rows):
    days = [dt.date(2020, m, 1) for m in range(1, 7)]
    bars = rows([(e, d, 1.0, 2.0, 1.0, 2.0, 1.0, 1.0, 5.0, 10.0, 100.0) for e in (1, 2, 3, None) for d in days], "entity long, period date, " + ", ".join(f"{c} double" for c in EP.BARS))
    adjust = rows([(e, d, 2.0) for e in (1, 1, 3) for d in days[:2]], "entity long, period date, adj_factor double")
    groups = rows([(1, days[1], days[3], *"abcd"), (2, days[0], None, *"efgh")], "entity long, in_date date, out_date date, l1_code string, l1_name string, l2_code string, l2_name string")
    member = rows([(days[2], 1, "0")], "period date, entity long, index_code string")
    make = lambda parts: EP.entity_panel(bars, adjust=adjust, groups=groups, membership=member, flags={"is_g0": "0"}, parts=parts)
    text = plan(make(7))
    assert text.count("RepartitionByExpression") >= 3 and ", 7" in text
    assert sorted(map(str, make(7).collect())) == sorted(map(str, make(None).collect()))


def test_suffixes_leave_a_task_in_small_batches(rows, monkeypatch):
    r = np.random.default_rng(3)
    texts = [" ".join(r.choice(["a", "b", "c", "d"], 60)) for _ in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(["x"] * 40), pa.array(texts)], names=["_lang", "_text"])
    groups = phrases.vertical_partitioning(np.full(1 << 8, 40, np.int64), 100, lambda g: np.zeros(len(g.piece_parts), np.int64))
    whole = [np.frombuffer(x, np.uint64).reshape(-1, 4) for b in phrases._deal_out(iter([batch]), groups, 1000) for x in b.column(1).to_pylist()]
    monkeypatch.setattr(phrases, "SENT", 8)
    sent = list(phrases._deal_out(iter([batch]), groups, 1000))
    assert all(sum(map(len, b.column(1).to_pylist())) <= 8 * 32 for b in sent) and len(sent) > 1
    small = [np.frombuffer(x, np.uint64).reshape(-1, 4) for b in sent for x in b.column(1).to_pylist()]
    assert sorted(map(tuple, np.concatenate(whole))) == sorted(map(tuple, np.concatenate(small)))


def test_indicators_over_blocks_equal_row_by_row(spark, rows):
    r = np.random.default_rng(5)
    used = {c for pair in FS.valuation_ratios().values() for c in pair} | {c for pair in (FS._ratios(FS.PROFIT) | FS._ratios(FS.QUALITY)).values() for c in pair}
    made = {f"{c}_{s}" for c in FS.FLOW_ITEMS for s in ("q", "ttm")} | {f"{c}_ttm_avg" for c in FS.LEVEL_ITEMS} | {"total_div_ttm"}
    items = sorted((used | set(FS.FLOW_ITEMS) | set(FS.LEVEL_ITEMS) | {"total_mv", "total_div"}) - made)
    quarters = [d.date() for d in pd.date_range("2015-03-31", periods=11, freq="QE")]
    data, day = [], dt.date(2020, 1, 1)
    for entity, n in ((1, 11), (2, 3), (None, 6), (3, 9)):
        for i, q in enumerate(quarters[:n]):
            values = [None if r.random() < 0.1 else math.inf if r.random() < 0.01 else float(r.normal() * 10.0 ** r.integers(1, 5)) for _ in items]
            data.append((day, entity, q, day, day, day, day, i % 4 + 1, *values))
    keys = "snapshot_date date, entity long, end_date date, ann_date date, pre_date date, actual_date date, modify_date date, report_type int"
    df = rows(data, ", ".join([keys, *[f"{c} double" for c in items]]))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        out = FS.indicators_snapshot(df)
        assert "lag(" not in plan(out) and "MapInArrow" in plan(out)
        got = {(x["entity"], x["end_date"]): x for x in out.collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    table = {}
    for row in data:
        table.setdefault(row[1], []).append(dict(zip(items, row[8:], strict=True)) | {"rt": row[7], "end": row[2]})

    def add(values):  # one after the other; sum() of Python 3.12 and later corrects its rounding
        return reduce(operator.add, values, 0.0)

    def sane(x):
        return x if x is not None and math.isfinite(x) else None

    def quarter(h, i, c):
        now, before = h[i][c], h[i - 1][c] if i else None
        return now if h[i]["rt"] == 1 else None if now is None or before is None else now - before

    def share(a, b, guard):
        return None if a is None or b is None or not abs(b) > guard else a / b

    assert len(got) == len(data)
    for entity, h in table.items():
        for i, now in enumerate(h):
            x = got[entity, now["end"]]
            q = [quarter(h, j, "revenue") for j in range(max(0, i - 3), i + 1)]
            ttm = add(q) if len(q) == 4 and None not in q else None
            assert x["revenue_q"] == sane(q[-1]) and x["revenue_ttm"] == sane(ttm)
            assert x["divp_ttm"] == sane(share(add(h[j]["total_div"] or 0.0 for j in range(max(0, i - 3), i + 1)), now["total_mv"], FS.LEVEL_GUARD))
            seen = [h[j]["inventories"] for j in range(max(0, i - 3), i + 1) if h[j]["inventories"] is not None]
            assert x["inv_tvr_ttm2"] == sane(share(ttm, add(seen) / len(seen) if seen else None, FS.LEVEL_GUARD))
            cash = [share(h[j]["cash_assets"], h[j]["total_assets"], FS.LEVEL_GUARD) for j in (i, i - 4)] if i >= 4 else [None, None]
            assert x["cash2a_yoy"] == sane(None if None in cash else share(cash[0] - cash[1], abs(cash[1]), FS.RATIO_GUARD))
