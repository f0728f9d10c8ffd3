"""Landing by catalogue and writes by contract."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.operators.schema import DatasetSpec
from panelspark.sources.contract import ContractViolation, write_dataset
from panelspark.sources.landing import land_catalogue, land_dataset
from panelspark.sources.readers import landing_schema
from panelspark.sources.sinks import scratch_path, table_exists

BASIC = landing_schema(["ts_code", "name", "list_date", "weight"], numbers=["weight"])
DAILY = landing_schema(["ts_code", "trade_date", "close"], numbers=["close"])


def csv(spark, lines):
    path = scratch_path(spark, "files")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_union_with_rejects(spark):
    root = scratch_path(spark, "landed")
    head = "ts_code,name,list_date,weight"
    live = csv(spark, [head, "a,A,20200101,1.5", "b,B,2020-13-01,2", ",C,20200101,3", 'd,"D, D",20200102,', "e,E"])
    gone = csv(spark, [head, "x,X,20190101,n/a", "a,AA,20180101,inf", "y,Y,,7"])
    report = land_dataset(spark, "stock_basic", {"L": live, "D": gone}, root, BASIC)
    assert (report.rows_read, report.rejected) == (8, 4)
    assert report.reasons == {"malformed line": 1, "no date: list_date": 1, "no double: weight": 1, "no key: ts_code": 1}
    assert (report.written.rows_in, report.written.rows_out, report.written.sample) == (4, 3, [{"ts_code": "a"}])
    got = sorted(tuple(r) for r in spark.read.parquet(f"{root}/stock_basic").collect())
    assert got == [("a", "AA", date(2018, 1, 1), None), ("d", "D, D", date(2020, 1, 2), None), ("y", "Y", None, 7.0)]
    bad = {(r.dataset, r.fetch, r.reasons) for r in spark.read.parquet(f"{root}/rejects").collect()}
    assert bad == {("stock_basic", "L", "no date: list_date"), ("stock_basic", "L", "no key: ts_code"), ("stock_basic", "L", "malformed line"), ("stock_basic", "D", "no double: weight")}
    clean = csv(spark, [head, "q,Q,20200101,1"])
    assert land_dataset(spark, "stock_basic", {"L": clean, "D": csv(spark, [head])}, root, BASIC).rejected == 0
    assert not table_exists(spark, f"{root}/rejects") and spark.read.parquet(f"{root}/stock_basic").count() == 1
    with pytest.raises(ValueError, match="union of the fetches"):
        land_dataset(spark, "stock_basic", {"L": clean}, root, BASIC)


def test_days_and_month_ends(spark):
    root = scratch_path(spark, "landed")
    head = "ts_code,trade_date,close"
    land_dataset(spark, "stock_daily", {"1": csv(spark, [head, "a,20200102,1", "a,20200103,2", "b,20200103,3"])}, root, DAILY)
    land_dataset(spark, "stock_daily", {"1": csv(spark, [head, "a,20200103,9"])}, root, DAILY)  # b's row of the day was withdrawn
    got = sorted((r.ts_code, r.trade_date.day, r.close) for r in spark.read.parquet(f"{root}/stock_daily").collect())
    assert got == [("a", 2, 1.0), ("a", 3, 9.0)]
    weights = landing_schema(["index_code", "con_code", "trade_date", "weight"], numbers=["weight"])
    head = "index_code,con_code,trade_date,weight"
    fetches = {"i1": csv(spark, [head, "i1,a,20200102,1", "i1,a,20200131,2"]), "i2": csv(spark, [head, "i2,a,20200131,5", "i2,b,20200115,6"])}
    land_dataset(spark, "index_weight", fetches, root, weights)
    got = sorted((r.index_code, r.con_code, r.trade_date.day) for r in spark.read.parquet(f"{root}/index_weight").collect())
    assert got == [("i1", "a", 31), ("i2", "a", 31)]


def test_one_failure_does_not_stop_the_others(spark):
    root, head = scratch_path(spark, "landed"), "ts_code,trade_date,close"
    files = {"stock_basic": {"L": "/none"}, "no_such": {"1": "/none"}, "fund_daily": {"1": "/none/x"}, "stock_daily": {"1": csv(spark, [head, "a,20200102,1"])}}
    reports = land_catalogue(spark, files, root, {"stock_basic": BASIC, "fund_daily": DAILY, "stock_daily": DAILY, "no_such": DAILY})
    assert [r.error is None for r in reports] == [False, False, False, True] and reports[3].written.rows_out == 1


SPEC = DatasetSpec("panel", ("entity", "day"), "day", "month", {"entity": "int", "day": "date", "v": "double", "month": "string"}, "yyyy-MM")
GOOD = "entity bigint, day date, v double, month string"


def panel(rows, data, schema=GOOD):
    return rows([(e, d and date.fromisoformat(d), v, m) for e, d, v, m in data], schema)


RIGHT = [(1, "2020-01-01", 1.0, "2020-01"), (2, "2020-02-01", 2.0, "2020-02")]


@pytest.mark.parametrize(
    ("rule", "change"),
    [
        ("repeated keys", lambda df: df.unionByName(df.where("entity = 1"))),
        ("NULL in entity", lambda df: df.withColumn("entity", F.nullif("entity", F.lit(1)))),
        ("NULL in day", lambda df: df.withColumn("day", F.when(F.col("entity") == 1, F.col("day")))),
        ("NULL in month", lambda df: df.withColumn("month", F.when(F.col("entity") == 1, F.col("month")))),
        ("month does not follow from day", lambda df: df.withColumn("month", F.lit("2020-01"))),
        ("type of v", lambda df: df.withColumn("v", F.col("v").cast("string"))),
        ("order of columns", lambda df: df.select("day", "entity", "v", "month")),
        ("missing column v", lambda df: df.drop("v")),
        ("undeclared column w", lambda df: df.withColumn("w", F.lit(1))),
    ],
)
def test_every_rule_is_refused_or_reported(spark, rows, rule, change):
    path = scratch_path(spark, "contract")
    assert write_dataset(panel(rows, RIGHT), path, SPEC).violations == {}
    before = sorted(map(tuple, spark.read.schema(GOOD).parquet(path).collect()))
    with pytest.raises(ContractViolation) as e:
        write_dataset(change(panel(rows, [(e, d, v and v + 5, m) for e, d, v, m in RIGHT])), path, SPEC)
    assert rule in e.value.report.violations
    assert sorted(map(tuple, spark.read.schema(GOOD).parquet(path).collect())) == before
    report = write_dataset(change(panel(rows, RIGHT)), path, SPEC, strict=False)
    assert rule in report.violations and spark.read.parquet(path).columns == [*T.StructType.fromDDL(GOOD).names]


def test_whole_write_removes_other_partitions(spark, rows):
    path = scratch_path(spark, "contract")
    write_dataset(panel(rows, RIGHT), path, SPEC)
    write_dataset(panel(rows, [(3, "2020-02-09", None, "2020-02")]), path, SPEC)
    assert {r.entity for r in spark.read.parquet(path).collect()} == {1, 3}
    write_dataset(panel(rows, [(4, "2020-03-09", None, "2020-03")]), path, SPEC, whole=True)
    assert {r.entity for r in spark.read.parquet(path).collect()} == {4}
    assert write_dataset(panel(rows, []), path, SPEC).violations == {}
    with pytest.raises(ContractViolation):
        write_dataset(panel(rows, RIGHT).drop("entity"), path, SPEC, strict=False)
