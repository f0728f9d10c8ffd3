"""Factors of single entities: 20-row pack, flow, structure, spread and resonance slices.

Input is the entity-day panel: entity, period, open, high, low, close,
pre_close, pct_chg, log_return, vol, amount, turnover, size, grp and the flow
volumes {buy,sell}_{sm,elg}_vol.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.numeric import nullify_non_finite, ratio
from panelspark.operators.cross_section import as_is, neutralize, orthogonalize_pairs, rank_factor, winsorize_mad
from panelspark.operators.slices import enough_history, nth_columns, slice_columns, with_sorted_frame
from panelspark.operators.windows import by_time, trailing

WINDOW, LOOKBACK = 20, 40


def bar_features(df: DataFrame) -> DataFrame:
    """Returns, ranges, shadows and flow ratios of one bar."""
    pre, top, bottom = F.col("pre_close"), F.greatest("open", "close"), F.least("open", "close")
    sm, elg = F.col("buy_sm_vol") + F.col("sell_sm_vol"), F.col("buy_elg_vol") + F.col("sell_elg_vol")
    net_sm, net_elg = F.col("buy_sm_vol") - F.col("sell_sm_vol"), F.col("buy_elg_vol") - F.col("sell_elg_vol")
    true_range = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - pre), F.abs(F.col("low") - pre))
    out = df.withColumns(
        {
            "ret": F.col("pct_chg") / 100,
            "intraday_ret": ratio("close", "open") - 1,
            "overnight_ret": ratio("open", pre) - 1,
            "amplitude": ratio(F.col("high") - F.col("low"), pre),
            "true_range": F.when(pre.isNotNull(), ratio(true_range, pre)),
            "body": ratio(F.abs(F.col("close") - F.col("open")), pre),
            "upper_shadow": ratio(F.col("high") - top, pre),
            "lower_shadow": ratio(bottom - F.col("low"), pre),
            "plus": ratio(2 * F.col("close") - F.col("high") - F.col("low"), pre),
            "net_sm_vol": net_sm,
            "net_elg_vol": net_elg,
            "sm_imba": ratio(net_sm, sm),
            "elg_imba": ratio(net_elg, elg),
            "buy_sm": ratio("buy_sm_vol", "vol"),
            "buy_elg": ratio("buy_elg_vol", "vol"),
            "sm_vol_ratio": ratio(sm, F.col("vol") * 2),
            "elg_vol_ratio": ratio(elg, F.col("vol") * 2),
        }
    )
    return out.withColumns(
        {
            "shadow_diff": F.col("lower_shadow") - F.col("upper_shadow"),
            "vm_ret": F.col("ret") * F.col("vol"),
            "vm_intraday_ret": F.col("intraday_ret") * F.col("vol"),
            "illiq": ratio(F.abs("ret"), F.col("amount") / 10000),
        }
    )


def u_turn(df: DataFrame, period: str, deviation: str, mean: str, out: str) -> DataFrame:
    """Rank of the deviation averaged with half the rank of the mean, reversed in the calm half.

    Ranks are made on the three columns they come from and meet the rows once, however
    wide these are: rows that are alike in them have one result.
    """
    ranked = rank_factor(df.select(period, deviation, mean), [period], deviation, "_sr", few_groups=True)
    halves = ranked.withColumn("_half", F.when(F.col("_sr") < 0.5, 0).when(F.col("_sr") >= 0.5, 1).otherwise(2))
    halves = rank_factor(halves, [period, "_half"], mean, "_mr", few_groups=True)
    part = F.when(F.col("_half") == 0, (1 - F.col("_mr")) * 0.5).when(F.col("_half") == 1, F.col("_mr") * 0.5)
    both = F.when(part.isNull(), F.col("_sr")).when(F.col("_sr").isNull(), part).otherwise((F.col("_sr") + part) / 2)
    keys = {period: "_ud", deviation: "_us", mean: "_um"}
    found = halves.groupBy(*[F.col(c).alias(k) for c, k in keys.items()]).agg(F.first(both).alias(out))
    same = [F.col(c).eqNullSafe(F.col(k)) for c, k in keys.items()]
    return df.join(found, same, "left").drop(*keys.values())


def _stats(name: str, c: str, f, ratio_too: bool = True) -> dict[str, Column]:
    m, s = F.avg(c).over(f), F.stddev_samp(c).over(f)
    out = {f"{name}_mean_20": m, f"{name}_std_20": s}
    if ratio_too:
        out[f"{name}_msr_20"] = ratio(m, s)
    return out


PURE = {
    "tvr_deplus": ("turnover_clean", "plus_clean"),
    "plus_detvr": ("plus_clean", "turnover_clean"),
    "tvr_ne_deplus": ("tvr_ne", "plus_ne"),
    "plus_ne_detvr": ("plus_ne", "tvr_ne"),
}


# What the windows and the per-date regressions read; every stored copy and shuffle carries these columns only.
PACKED = (
    "size grp log_return ret vm_ret vol intraday_ret vm_intraday_ret overnight_ret turnover tvr_chg amplitude shadow_diff plus illiq "
    "net_sm_vol net_elg_vol"
).split()


def price_volume_pack(df: DataFrame, *, stage=None) -> DataFrame:
    """42 features over the last 20 rows, for every date with a complete window.

    ``stage`` may write an intermediate table and read it back (see
    ``sources.sinks.staged``): the features, the windows, and the statistics of
    the dates, which are broadcast to them.
    """
    stage = stage or as_is
    w = by_time("entity", "period")
    rows = bar_features(df).withColumn("tvr_chg", ratio("turnover", F.lag("turnover").over(w)) - 1)
    rows = stage(nullify_non_finite(rows.select("entity", "period", *PACKED)), "features")
    rows = neutralize(rows, "period", {"turnover": "tvr_ne", "plus": "plus_ne"}, "size", "grp", stage=stage)
    rows = winsorize_mad(rows, ["period"], ["turnover", "plus"], few_groups=True, stage=stage)
    rows = orthogonalize_pairs(rows, "period", PURE)
    f = trailing(w, WINDOW)
    cols = {
        "_rows": F.count("*").over(f),
        "ret_20": F.exp(F.sum("log_return").over(f)) - 1,
        **_stats("ret", "ret", f),
        "vw_ret_20": ratio(F.sum("vm_ret").over(f), F.sum("vol").over(f)),
        "intraday_ret_20": F.avg("intraday_ret").over(f),
        "vw_intraday_ret_20": ratio(F.sum("vm_intraday_ret").over(f), F.sum("vol").over(f)),
        "overnight_ret_20": F.avg("overnight_ret").over(f),
        "abs_overnight_ret_20": F.avg(F.abs("overnight_ret")).over(f),
        **_stats("tvr", "turnover", f),
        **_stats("tvr_chg", "tvr_chg", f),
        **_stats("amp", "amplitude", f),
        **_stats("shadow_diff", "shadow_diff", f),
        **_stats("plus", "plus", f),
        **_stats("illiq", "illiq", f),
        **{k: v for p in PURE for k, v in _stats(p, p, f, False).items()},
        "sm_imba_norm": ratio(F.sum("net_sm_vol").over(f), F.sum(F.abs("net_sm_vol")).over(f)),
        "elg_imba_norm": ratio(F.sum("net_elg_vol").over(f), F.sum(F.abs("net_elg_vol")).over(f)),
    }
    out = rows.select("entity", "period", *[c.alias(n) for n, c in cols.items()]).where(F.col("_rows") == WINDOW).drop("_rows")
    out = stage(out, "windows")
    names = out.columns
    pairs = {}
    for side in ("sm", "elg"):
        pairs[f"{side}_imba_deret"] = (f"{side}_imba_norm", "ret_20")
        pairs[f"ret_de_{side}_imba"] = ("ret_20", f"{side}_imba_norm")
    out = u_turn(orthogonalize_pairs(out, "period", pairs), "period", "tvr_std_20", "tvr_mean_20", "utr")
    return nullify_non_finite(out.select(*names, "utr", *pairs))


def _traded(df: DataFrame, history: list[str]) -> DataFrame:
    """Rows with turnover and at least 20 of the last 40 rows filled."""
    rows = bar_features(df).where("turnover > 0")
    return enough_history(rows, "entity", "period", history, lookback=LOOKBACK, least=WINDOW)


def _sliced(rows: DataFrame, keys: dict[str, list[str]], columns) -> DataFrame:
    """Sort the window once per key, then project all slice columns; incomplete windows are dropped."""
    for key, values in keys.items():
        rows = with_sorted_frame(rows, "entity", "period", key, values, f"_by_{key}")
    cols = columns()
    first = next(iter(keys))
    return rows.where(F.size(f"_by_{first}") == WINDOW).select("entity", "period", *[c.alias(n) for n, c in cols.items()])


FLOWS = ["buy_sm", "buy_elg", "sm_imba", "elg_imba"]


def flow_imbalance(df: DataFrame) -> DataFrame:
    """Flow ratios on the days with the highest and lowest (volume-weighted) return: 96 columns."""
    rows = _traded(df, ["ret", "buy_sm_vol"])

    def columns():
        out = {}
        for key in ("ret", "vm_ret"):
            out |= slice_columns(f"_by_{key}", {v: f"{key}_{{slice}}_{v}" for v in FLOWS}, [5, 10])
        return out

    return _sliced(rows, {"ret": FLOWS, "vm_ret": FLOWS}, columns)


def trader_structure(df: DataFrame) -> DataFrame:
    """Returns on the days with the highest and lowest flow ratios: 20 ordered values and slices."""
    rows = _traded(df, ["ret", "buy_sm_vol"])

    def columns():
        out = {}
        for key in FLOWS:
            out |= nth_columns(f"_by_{key}", "ret", f"{key}_{{i}}_ret")
            out |= slice_columns(f"_by_{key}", {"ret": f"{key}_{{slice}}"}, [5, 10])
        return out

    return _sliced(rows, {k: ["ret"] for k in FLOWS}, columns)


def high_low_spread(df: DataFrame) -> DataFrame:
    """Turnover, amplitude, range and close location on the highest and lowest closes."""
    names = {"turnover": "tvr", "amplitude": "amp", "true_range": "tr", "plus": "plus"}
    rows = _traded(df, ["ret"])

    def columns():
        out = {}
        f = trailing(by_time("entity", "period"), WINDOW)
        for v, n in names.items():
            out |= nth_columns("_by_close", v, f"close_{{i}}_{n}")
            out |= slice_columns("_by_close", {v: f"close_{{slice}}_{n}"}, [5, 10])
            out[f"{n}_mean_20"] = F.col(f"_mean_{v}")
            out[f"{n}_std_20"] = F.col(f"_std_{v}")
        return out

    f = trailing(by_time("entity", "period"), WINDOW)
    stats = {f"_mean_{v}": F.avg(v).over(f) for v in names} | {f"_std_{v}": F.stddev_samp(v).over(f) for v in names}
    return _sliced(rows.withColumns(stats), {"close": list(names)}, columns)


def industry_resonance(df: DataFrame, group_returns: DataFrame) -> DataFrame:
    """Own return ordered by the group's return and the reverse; group_returns is (grp, period, group_ret)."""
    rows = df.join(group_returns, ["grp", "period"], "left")
    rows = _traded(rows, ["ret", "group_ret"])

    def columns():
        out = nth_columns("_by_group_ret", "ret", "ind_ret_{i}_ret")
        out |= nth_columns("_by_ret", "group_ret", "ret_{i}_ind_ret")
        out |= nth_columns("_by_vm_ret", "group_ret", "vm_ret_{i}_ind_ret")
        out |= slice_columns("_by_vm_ret", {"group_ret": "vm_ret_{slice}_ind_ret"}, [5, 10, 15])
        return out

    return _sliced(rows, {"group_ret": ["ret"], "ret": ["group_ret"], "vm_ret": ["group_ret"]}, columns)
