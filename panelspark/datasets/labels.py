"""Forward-return labels of several asset types on one shared calendar."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.operators.windows import forward_returns

HORIZONS = [1, 2, 3, 5, 10, 20, 40, 60]


def forward_labels(assets: dict[str, DataFrame], *, horizons=HORIZONS, start=None, end=None) -> DataFrame:
    """assets: type -> (entity, period, close[, adj_factor, is_suspend]).

    Eight returns and eight flags per (entity, period); the caller reads 70
    open days beyond end, and the output is trimmed to [start, end].
    """
    parts = []
    for kind, df in assets.items():
        adj = F.col("adj_factor") if "adj_factor" in df.columns else F.lit(1.0)
        halted = F.coalesce("is_suspend", F.lit(0)) if "is_suspend" in df.columns else F.lit(0)
        parts.append(
            df.select("entity", "period", (F.col("close") * adj).alias("price"), halted.alias("halted"), F.lit(kind).alias("asset_type"))
        )
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    out = forward_returns(
        rows, "entity", "period", "price", horizons, halted="halted", ret_name="fwd_ret_{n}d", halt_name="is_suspend_{n}d"
    )
    if start is not None and end is not None:
        out = out.where(F.col("period").between(F.lit(start), F.lit(end)))
    names = [f"fwd_ret_{n}d" for n in horizons] + [f"is_suspend_{n}d" for n in horizons]
    return out.select("entity", "period", "asset_type", *names)
