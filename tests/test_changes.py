"""Changes of stored tables: what they keep, what they rewrite, what a lost driver leaves, and what writes report."""

from datetime import date
from pathlib import Path
from urllib.parse import unquote

import pytest

from panelspark.sources import sinks
from panelspark.sources.sinks import append, overwrite_partitions, recover, replace_dates, scratch_path, truncate_write, upsert

ONE, TWO = "k int, v string, month string", "k int, v string, region string, month string"


def stored(spark, path, schema):
    return sorted((tuple(r) for r in spark.read.schema(schema).parquet(path).collect()), key=str)


def files(path):
    return {unquote(str(p)): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_emptied_partition_loses_nothing_else(spark, rows):
    path = scratch_path(spark, "changes")
    upsert(rows([(1, "a", "2000-01"), (2, "b", "2000-02"), (3, "c", None), (4, "d", "2000-03")], ONE), path, ["k"], ["month"])
    before = files(path)
    upsert(rows([(1, "A", "2000-02")], ONE), path, ["k"], ["month"])  # 2000-01 is empty now
    assert stored(spark, path, ONE) == sorted([(1, "A", "2000-02"), (2, "b", "2000-02"), (3, "c", None), (4, "d", "2000-03")], key=str)
    after = files(path)
    untouched = {f for f in before if "2000-03" in f or "HIVE_DEFAULT" in f}
    assert len(untouched) == 2 and all(after[f] == before[f] for f in untouched)
    assert not any("2000-01" in f or "_pending" in f for f in after)
    upsert(rows([(3, "C", "2000-03")], ONE), path, ["k"], ["month"])  # and now the partition of NULL
    upsert(rows([(4, "D", None), (2, "B", None)], ONE), path, ["k"], ["month"])
    assert stored(spark, path, ONE) == sorted([(1, "A", "2000-02"), (2, "B", None), (3, "C", "2000-03"), (4, "D", None)], key=str)


def test_two_partition_columns_and_odd_names(spark, rows):
    path = scratch_path(spark, "changes")
    first = [(1, "a", "EU %/=", "2000-01"), (2, "b", "EU %/=", "2000-02"), (3, "c", None, "2000-01"), (4, "d", "US", None), (5, "e", "US", "2000-01")]
    upsert(rows(first, TWO), path, ["k"], ["region", "month"])
    before = files(path)
    upsert(rows([(1, "A", "US", "2000-01"), (4, "D", None, "2000-01"), (None, "n", "US", "2000-01")], TWO), path, ["k"], ["region", "month"])
    want = [(1, "A", "US", "2000-01"), (2, "b", "EU %/=", "2000-02"), (3, "c", None, "2000-01"), (4, "D", None, "2000-01"), (5, "e", "US", "2000-01"), (None, "n", "US", "2000-01")]
    assert stored(spark, path, TWO) == sorted(want, key=str)
    kept = [f for f in before if "EU" in f and "2000-02" in f]
    assert len(kept) == 1 and files(path)[kept[0]] == before[kept[0]]
    upsert(rows([(None, "N", None, None)], TWO), path, ["k"], ["region", "month"])  # a NULL key is a key
    assert (None, "N", None, None) in stored(spark, path, TWO) and len(stored(spark, path, TWO)) == 6


@pytest.mark.parametrize("step", ["rows", "plan", "overwrite"])
def test_a_lost_driver_loses_no_row(spark, rows, monkeypatch, step):
    path = scratch_path(spark, "changes")
    before = [(1, "a", "2000-01"), (2, "b", "2000-02"), (3, "c", None)]
    after = sorted([(1, "A", "2000-02"), (2, "b", "2000-02"), (3, "c", None)], key=str)
    upsert(rows(before, ONE), path, ["k"], ["month"])

    def lost(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(sinks, {"rows": "_decide_change", "plan": "_finish_change", "overwrite": "_delete"}[step], lost)
        with pytest.raises(KeyboardInterrupt):
            upsert(rows([(1, "A", "2000-02")], ONE), path, ["k"], ["month"])
    now = stored(spark, path, ONE)
    assert set(now) >= {(2, "b", "2000-02"), (3, "c", None)} and now[0][0] == 1
    assert recover(spark, path) == (0 if step == "rows" else 1)
    assert stored(spark, path, ONE) == (sorted(before, key=str) if step == "rows" else after)
    upsert(rows([(1, "A", "2000-02")], ONE), path, ["k"], ["month"])
    assert stored(spark, path, ONE) == after and recover(spark, path) == 0


def test_upsert_scans_only_touched_folders(spark, rows):
    path, seen = scratch_path(spark, "changes"), []
    upsert(rows([(i, "old", f"2000-{i:02d}") for i in range(1, 10)], ONE), path, ["k", "month"], ["month"])
    whole = sinks._publish
    try:
        sinks._publish = lambda s, p, old, *rest: (seen.append(old.select("_metadata.file_path").distinct().collect()), whole(s, p, old, *rest))
        upsert(rows([(4, "new", "2000-04"), (40, "new", "2000-04")], ONE), path, ["k", "month"], ["month"])
    finally:
        sinks._publish = whole
    assert [len(x) for x in seen] == [1] and "2000-04" in seen[0][0][0]
    assert len(stored(spark, path, ONE)) == 10


def test_dates_are_replaced_inside_their_month(spark, rows):
    path, schema = scratch_path(spark, "changes"), "k int, d date, v string, month string"
    row = lambda k, d, v: (k, d and date(2000, 1, d), v, d and "2000-01")
    replace_dates(rows([row(1, 3, "a"), row(2, 3, "a"), row(1, 4, "a"), row(1, None, "a")], schema), path, "d", ["month"])
    report = replace_dates(rows([row(1, 3, "b"), row(3, 3, "b"), row(3, 3, "c")], schema), path, "d", ["month"], keys=["k", "d"])
    assert stored(spark, path, schema) == sorted([row(1, 3, "b"), row(3, 3, "c"), row(1, 4, "a"), row(1, None, "a")], key=str)
    assert (report.rows_in, report.rows_out, report.repeated_rows, report.repeated_keys) == (3, 2, 2, 1)
    replace_dates(rows([row(9, None, "z")], schema), path, "d", ["month"])
    assert stored(spark, path, schema) == sorted([row(1, 3, "b"), row(3, 3, "c"), row(1, 4, "a"), row(9, None, "z")], key=str)


def test_writes_report_repeated_keys(spark, rows):
    path, schema = scratch_path(spark, "changes"), "k int, d string, update_flag string, v int"
    data = [(1, "x", "0", 5), (1, "x", "1", 4), (1, "x", None, 9), (2, "x", "0", 1), (None, "y", "0", 1), (None, "y", "0", 1), (3, None, "a", 1)]
    report = truncate_write(rows(data, schema), path, keys=["k", "d"])
    assert stored(spark, path, schema) == sorted([(1, "x", "1", 4), (2, "x", "0", 1), (None, "y", "0", 1), (3, None, "a", 1)], key=str)
    assert (report.rows_in, report.rows_out, report.repeated_rows, report.repeated_keys) == (7, 4, 5, 2)
    assert report.sample == [{"k": None, "d": "y"}, {"k": 1, "d": "x"}]
    many = append(rows([(i % 500, "x", "0", i) for i in range(1500)] + [(1000 + i, "x", "0", i) for i in range(500)], schema), path, keys=["k", "d"])
    assert (many.rows_in, many.rows_out, many.repeated_keys, len(many.sample)) == (2000, 1000, 500, 20)
    assert all(s["k"] < 500 for s in many.sample) and many.sample == sorted(many.sample, key=lambda s: s["k"])
    assert overwrite_partitions(rows([], schema), path, ["d"], keys=["k"]).sample == []
    assert truncate_write(rows([(1, "x", "0", 1)], schema), path) is None
    hot = truncate_write(rows([(7, "x", str(i % 3), i) for i in range(3000)], schema).select("k", "d"), path, keys=["k", "d"])
    assert (hot.rows_out, hot.repeated_rows, hot.sample) == (1, 3000, [{"k": 7, "d": "x"}])
