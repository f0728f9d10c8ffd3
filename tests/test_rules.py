"""Fund name rules, schema rules, landing and scan helpers."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.datasets import statements as FS
from panelspark.datasets.entity_panel import ENTITY_PANEL
from panelspark.datasets.fund_rules import fund_labels, index_name
from panelspark.operators import schema as S
from panelspark.sources import readers as R
from panelspark.sources.raw_datasets import RAW_DATASETS
from panelspark.sources.sinks import scratch_path, write_csv


@pytest.mark.parametrize(
    "name,index,labels",
    [
        ("广发沪深300ETF", "沪深300", ("", "", "large", "blend", "")),
        ("南方上证科创板50成份ETF", "上证科创板50成份", ("801080.SI", "电子", "mid", "growth", "成长")),
        ("易方达银行LOF", "银行", ("801780.SI", "银行", "large", "dividend", "金融")),
        ("南方中证1000ETF(QDII)", "中证1000", ("", "", "large", "blend", "")),
        ("广发中证2000价值", "中证2000价值", ("", "", "small", "value", "")),
        ("华安恒生ETF", "恒生", ("", "港股", "large", "blend", "港股")),
        ("国泰纳斯达克100ETF", "纳斯达克100", ("", "跨境", "large", "blend", "跨境")),
        ("华夏长三角一体化C", "长三角一体化", ("", "区域主题", "mid", "blend", "")),
        ("富国自由现金流ETF", "自由现金流", ("", "", "large", "dividend", "")),
        ("华夏ETF", None, ("", "other", "unknown", "unknown", "other")),
        (None, None, ("", "other", "unknown", "unknown", "other")),
    ],
)
def test_fund_names(rows, name, index, labels):
    got = rows([(name,)], "n string").select(index_name(F.col("n")).alias("i"), fund_labels(index_name(F.col("n"))).alias("l")).first()
    assert got.i == index
    assert tuple(got.l) == labels


def test_declared_sizes():
    assert len(ENTITY_PANEL.schema) == 68
    assert (len(FS.BALANCE), len(FS.INCOME), len(FS.CASH)) == (53, 31, 46)
    assert len(FS.derived_columns()) == 31
    assert (len(FS.valuation_ratios()), len(FS._ratios(FS.PROFIT)), len(FS._ratios(FS.QUALITY))) == (51, 25, 26)
    assert len(RAW_DATASETS) == 31


def test_every_ratio_uses_known_columns():
    known = set(FS.BALANCE + FS.INCOME + FS.CASH) | set(FS.derived_columns()) | {"total_mv", "ev", "evnoa", "total_div_ttm"}
    known |= {f"{c}_{s}" for c in FS.FLOW_ITEMS for s in ("q", "ttm")} | {f"{c}_ttm_avg" for c in FS.LEVEL_ITEMS}
    for name, (num, den) in (FS.valuation_ratios() | FS._ratios(FS.PROFIT) | FS._ratios(FS.QUALITY)).items():
        assert num in known and den in known, name


def test_schema_inference_rules(rows):
    df = rows([("a", "1.5", None, 3, "x", "20200101")], "con_code string, num string, gap string, n int, odd string, list_date string")
    got = {r["column"]: r["type"] for r in S.infer_schema(df, {"n": "double"}).collect()}
    assert got == {"con_code": "string", "num": "double", "gap": "double", "n": "double", "odd": "string", "list_date": "date"}


def test_schema_diff_ignores_case():
    old = S.declared_schema({"A": "int", "b": "float", "gone": "string"})
    new = S.declared_schema({"a": "int", "b": "string", "more": "float"})
    assert [(c, k) for c, k, _, _ in S.schema_diff(old, new)] == [("b", "type_mismatch"), ("more", "added"), ("gone", "missing")]


def test_date_named_text_is_a_date():
    assert S.declared_schema({"trade_date": "string"})["trade_date"].dataType == T.DateType()


def test_landing_cleans_and_dedupes(spark, rows):
    raw, target = scratch_path(spark, "raw"), scratch_path(spark, "target")
    data = [("a", "20200131", "1.5", "0"), ("a", "2020-01-31", "2.5", "1"), ("b", "20200201", "inf", "0"), ("c", "bad", "1", "0"), ("d", "20200202", "n/a", "0")]
    write_csv(rows(data, "ts_code string, trade_date string, close string, update_flag string"), raw)
    schema = R.landing_schema(["ts_code", "trade_date", "close", "update_flag"], numbers=["close"])
    spec = RAW_DATASETS["stock_daily"]
    R.land(spark, raw, target, schema, keys=spec.keys, partition=spec.partition)
    got = {(r.ts_code, r.trade_date): r.close for r in spark.read.parquet(target).collect()}
    assert got == {("a", date(2020, 1, 31)): 2.5, ("b", date(2020, 2, 1)): None, ("c", None): 1.0, ("d", date(2020, 2, 2)): None}


def test_date_range_with_entities(rows):
    df = rows([(1, date(2020, 1, 1)), (2, date(2020, 1, 2)), (2, date(2020, 1, 5))], "e int, d date")
    out = R.date_range(df, "d", date(2020, 1, 2), date(2020, 1, 4), entity="e", entities=[2], columns=["e"])
    assert [tuple(r) for r in out.collect()] == [(2,)]


def test_jdbc_reader_splits_by_bounds(spark):
    with pytest.raises(Exception, match="(?i)driver|suitable|jdbc"):
        R.read_jdbc(spark, "jdbc:none://host/db", "t", partition_column="id", lower=0, upper=10, partitions=4)


def test_scratch_folder_comes_from_the_session(spark):
    from panelspark.session import scratch_dir

    named = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch_dir(spark).startswith(named or spark.conf.get("panelspark.local.scratch"))
