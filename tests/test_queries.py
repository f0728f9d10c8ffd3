"""Registered queries against their SQL in DuckDB.

By default a spread of quick ones on the smallest tables; PANELSPARK_ALL=1 runs
every query.
"""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "scripts"))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from check_queries import compare, connect
from panelspark.plans import load_all

SF = os.environ.get("PANELSPARK_SF", "/root/testdata/sf0.001")
QUICK = (
    "momentum_information_coefficient calendar_nearest_day calendar_previous_n join_asof_with_validity join_interval_containment "
    "join_snapshot_forward_fill window_forward_returns window_ordered_slices section_rank_factor section_neutralize "
    "agg_gini agg_margins evaluate_factor_scan portfolio_equity_curve quality_coverage schema_inference sink_upsert land_text_files "
    "sink_duplicate_report land_catalogue dataset_contract quality_coverage_by_source agg_year_marks agg_quantile_dispersion dataset_label_table "
    "stream_event_time_bars dataset_entity_panel dataset_fund_panel dataset_statements_snapshot dataset_alarms scalar_math"
).split()
NAMES = list(load_all()) if os.environ.get("PANELSPARK_ALL") else QUICK


@pytest.fixture(scope="module")
def duck():
    if not Path(SF).exists():
        pytest.skip("no test tables")
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    verdict, _, _ = compare(spark, duck, load_all()[name], SF)
    assert verdict == "ok", verdict


def test_entry_contract():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 150
