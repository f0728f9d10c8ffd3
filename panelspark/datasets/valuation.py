"""Valuation history pack: latest value and 36-snapshot statistics of 15 ratios per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.numeric import nullify_non_finite
from panelspark.operators.slices import history_pack
from panelspark.operators.windows import by_time, latest_per_key, trailing

NON_NEGATIVE = "bp rep sp_q sp_ttm divp_ttm".split()
SIGNED = "gpp_q ep_q ocfp_q ebitp_q gpp_ttm ep_ttm ocfp_ttm ebitp_ttm".split()
COMPOSED = "arp_q artp_q".split()
LOOKBACK, LEAST = 36, 4


def valuation_history(indicators: DataFrame, *, start=None, end=None, base: list[str] | None = None) -> DataFrame:
    """One row per (snapshot_date, entity); start and end trim the output after the windows."""
    latest = latest_per_key(indicators, ["entity", "snapshot_date"], [F.desc("end_date")])
    fees = F.coalesce("admp_q", F.lit(0.0)) + F.coalesce("rdp_q", F.lit(0.0))
    rows = latest.withColumns({"arp_q": fees, "artp_q": fees + F.coalesce("taxp_q", F.lit(0.0))})
    w = by_time("entity", "snapshot_date")
    f = trailing(w, LOOKBACK)
    names = base or [*NON_NEGATIVE, *SIGNED, *COMPOSED]
    rows = rows.select("snapshot_date", "entity", F.count("*").over(f).alias("report_cnt"), *names)
    rows = history_pack(rows, "entity", "snapshot_date", names, window=LOOKBACK, min_rows=LEAST, negatives=SIGNED)
    rows = rows.where(F.col("report_cnt") >= LEAST)
    if start is not None and end is not None:
        rows = rows.where(F.col("snapshot_date").between(F.lit(start), F.lit(end)))
    return nullify_non_finite(rows)
