"""Queries that once did a part of their job, on tables made here."""

from datetime import date, timedelta

import numpy as np
import pandas as pd
import pytest

from panelspark.plans import load_all


def test_percentile_panel_ranks_over_one_three_and_five_years(spark, tmp_path):
    days = 1300
    rng = np.random.default_rng(8)
    price, quantity = np.round(rng.uniform(100, 900, days), 2), rng.integers(1, 50, days).astype(float)
    lines = pd.DataFrame({
        "l_orderkey": range(days), "l_linenumber": 1, "l_suppkey": 7, "l_shipdate": [date(2015, 1, 1) + timedelta(i) for i in range(days)],
        "l_quantity": quantity, "l_extendedprice": price,
    })
    spark.createDataFrame(lines).write.parquet(f"{tmp_path}/lineitem.parquet")
    out = load_all()["dataset_percentile_panel"].run(spark, str(tmp_path))
    values = {"price": price, "pe": price / quantity, "pe_ttm": price / quantity, "pb": quantity}
    assert len(out.columns) == 29 and {f"{v}_tsrank_{w}" for v in values for w in ("1y", "3y", "5y")} < {*out.columns}
    last = out.orderBy("period").collect()[-1]
    for v, x in values.items():
        for w, n in (("1y", 250), ("3y", 750), ("5y", 1250)):
            h = x[-n:]
            share = ((h < x[-1]).sum() + ((h == x[-1]).sum() - 1) / 2) / (n - 1)
            assert last[f"{v}_tsrank_{w}"] == pytest.approx(share, abs=1e-5), (v, w)
    assert last["ma60"] == pytest.approx(price[-60:].mean(), abs=1e-2) and last["above_ma20"] == float(price[-1] > price[-20:].mean())
