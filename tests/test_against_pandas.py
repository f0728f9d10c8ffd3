"""Random panels compared with plain pandas and numpy."""

import numpy as np
import pandas as pd
import pytest

from panelspark.operators import cross_section as X
from panelspark.operators import windows as W
from panelspark.operators.order_stats import group_quantiles, with_average_rank

RNG = np.random.default_rng(7)


def panel(n_dates=4, n_rows=60):
    d = np.repeat(np.arange(n_dates), n_rows)
    pdf = pd.DataFrame(
        {
            "d": d,
            "i": np.arange(len(d)),
            "v": np.round(RNG.normal(size=len(d)), 2),
            "a": RNG.normal(size=len(d)),
            "b": RNG.normal(size=len(d)),
            "mv": np.exp(RNG.normal(10, 1, len(d))),
            "g": RNG.integers(0, 5, len(d)),
        }
    )
    pdf.loc[RNG.integers(0, len(d), 10), "v"] = np.nan
    return pdf


def spark_df(spark, pdf):
    df = spark.createDataFrame(pdf)
    return df.selectExpr(*[f"if(isnan({c}), null, {c}) as {c}" if c in ("v", "a", "b", "mv") else c for c in df.columns])


def values(df, col):
    pdf = df.select("i", col).toPandas().sort_values("i")
    return pdf[col].to_numpy(dtype=float)


def test_average_rank(spark):
    pdf = panel()
    got = values(with_average_rank(spark_df(spark, pdf), ["d"], "v", "r"), "r")
    np.testing.assert_allclose(got, pdf.groupby("d")["v"].rank().to_numpy())


def test_quantiles(spark):
    pdf = panel()
    probs = [(1, 10), (1, 4), (1, 2), (9, 10)]
    got = group_quantiles(spark_df(spark, pdf), ["d"], ["v", "a"], probs).toPandas().set_index("d").sort_index()
    for i, (p, q) in enumerate(probs):
        for c in ("v", "a"):
            np.testing.assert_allclose(got[f"{c}_q{i}"], pdf.groupby("d")[c].quantile(p / q))


@pytest.mark.parametrize("q", [3, 5, 10])
def test_buckets_equal_qcut(spark, q):
    pdf = panel()
    got = values(X.quantile_bucket(spark_df(spark, pdf), ["d"], "v", "k", buckets=q, few_groups=True), "k")
    want = pdf.groupby("d")["v"].transform(lambda x: pd.qcut(x, q, labels=False, duplicates="drop") + 1)
    np.testing.assert_allclose(got, want.to_numpy())


def test_winsorize(spark):
    pdf = panel()

    def clip(x):
        med = x.median()
        mad = (x - med).abs().median()
        return x if mad == 0 else x.clip(med - 2 * mad, med + 2 * mad)

    got = values(X.winsorize_mad(spark_df(spark, pdf), ["d"], ["v"], n=2), "v_clean")
    np.testing.assert_allclose(got, pdf.groupby("d")["v"].transform(clip))


def _neutral(pdf, weight, feature, group):
    out = pd.Series(np.nan, index=pdf.index)
    for _, x in pdf.groupby("d"):
        def clip(s):
            med = s.median()
            mad = (s - med).abs().median()
            return s if mad == 0 else s.clip(med - 5 * mad, med + 5 * mad)

        y, mv = clip(x["v"]), clip(x["mv"])
        f = {"log1p": np.log1p, "log": np.log, "sqrt": np.sqrt}[feature](mv)
        w = {"equal": f * 0 + 1, "mv": mv, "log_mv": f, "sqrt_mv": np.sqrt(mv)}[weight]
        ok = y.notna()
        if ok.sum() < 10:
            out[x.index] = y
            continue
        design = [np.ones(ok.sum()), f[ok]]
        if group:
            design += [(x.loc[ok, "g"] == k).astype(float) for k in sorted(x["g"].unique())[1:]]
        design = np.column_stack(design)
        root = np.sqrt(w[ok].to_numpy())[:, None]
        beta = np.linalg.lstsq(design * root, y[ok].to_numpy() * root[:, 0], rcond=None)[0]
        res = y[ok] - design @ beta
        out[x.index[ok]] = (res - res.mean()) / res.std()
    return out.to_numpy()


@pytest.mark.parametrize("weight,feature,group", [("log_mv", "log1p", "g"), ("equal", "log", "g"), ("mv", "sqrt", None), ("sqrt_mv", "log1p", "g")])
def test_neutralize_equals_dummy_regression(spark, weight, feature, group):
    pdf = panel(3, 50)
    got = values(X.neutralize(spark_df(spark, pdf), "d", {"v": "z"}, "mv", group, weight=weight, feature=feature), "z")
    np.testing.assert_allclose(got, _neutral(pdf, weight, feature, group), atol=1e-8)


def test_neutralize_small_date_keeps_clean_value(spark):
    pdf = panel(1, 6)
    pdf["v"] = [1.0, 2.0, 3.0, 4.0, 5.0, 500.0]
    got = values(X.neutralize(spark_df(spark, pdf), "d", {"v": "z"}, "mv", "g"), "z")
    np.testing.assert_allclose(got, [1, 2, 3, 4, 5, 3.5 + 5 * 1.5])


@pytest.mark.parametrize("method,intercept,residual", [("linear", True, True), ("linear", False, True), ("linear", True, False), ("partial", True, True)])
def test_orthogonalize(spark, method, intercept, residual):
    pdf = panel(2, 40)
    pdf["b"] = pdf["a"] * 0.5 + pdf["b"]
    got = values(
        X.orthogonalize(spark_df(spark, pdf), "d", "v", ["a", "b"], "o", method=method, intercept=intercept, residual=residual), "o"
    )
    want = pdf["v"].copy()
    for _, x in pdf.groupby("d"):
        c = x.dropna(subset=["v"])
        one = [np.ones(len(c))] if intercept else []
        y = c["v"].to_numpy()
        if method == "linear":
            m = np.column_stack([*one, c["a"], c["b"]])
            left = y - m @ np.linalg.lstsq(m, y, rcond=None)[0]
        else:
            left = y
            for k in ("a", "b"):
                m = np.column_stack([*one, c[k]])
                left = left - m @ np.linalg.lstsq(m, left, rcond=None)[0]
        want[c.index] = left if residual else y - left
    np.testing.assert_allclose(got, want.to_numpy(), atol=1e-9)


def test_collinear_controls(spark):
    pdf = panel(1, 30)
    pdf["b"] = pdf["a"] * 3
    got = values(X.orthogonalize(spark_df(spark, pdf), "d", "v", ["a", "b"], "o"), "o")
    one = values(X.orthogonalize_pairs(spark_df(spark, pdf), "d", {"o": ("v", "a")}), "o")
    np.testing.assert_allclose(got, one, atol=1e-9)


def test_rolling_rank_share(spark):
    n = 80
    pdf = pd.DataFrame({"e": 1, "p": np.arange(n), "v": np.round(RNG.normal(size=n), 1)})
    pdf.loc[[5, 30], "v"] = np.nan
    out = W.rolling_rank_share(spark.createDataFrame(pdf), "e", "p", ["v"], {"w": 20}, min_rows=10)
    got = out.toPandas().sort_values("p")["v_tsrank_w"].to_numpy()
    roll = pdf["v"].rolling(20, min_periods=10)
    np.testing.assert_allclose(got, ((roll.rank() - 1) / (roll.count() - 1)).to_numpy())


def test_forward_returns_equal_full_grid(spark):
    dates = pd.date_range("2020-01-01", periods=30)
    parts = []
    for e in range(4):
        keep = np.sort(RNG.choice(30, 20, replace=False))
        parts.append(pd.DataFrame({"e": e, "p": dates[keep], "c": RNG.uniform(5, 20, 20), "h": RNG.integers(0, 2, 20)}))
    pdf = pd.concat(parts, ignore_index=True)
    df = spark.createDataFrame(pdf).selectExpr("e", "cast(p as date) as p", "c", "cast(h as int) as h")
    out = W.forward_returns(df, "e", "p", "c", [1, 5], halted="h").toPandas()
    out["p"] = pd.to_datetime(out["p"])
    all_days = np.sort(pdf["p"].unique())
    price = pdf.pivot(index="p", columns="e", values="c").reindex(all_days).ffill()
    halt = pdf.pivot(index="p", columns="e", values="h").reindex(all_days).ffill()
    for n in (1, 5):
        ret = price.shift(-(n + 1)) / price.shift(-1) - 1
        closed = (halt.shift(-1).fillna(1) == 1) | (halt.shift(-(n + 1)).fillna(1) == 1)
        want = [ret.loc[p, e] for p, e in zip(out["p"], out["e"])]
        np.testing.assert_allclose(out[f"fwd_ret_{n}"].to_numpy(dtype=float), want)
        assert list(out[f"is_halted_{n}"]) == [int(closed.loc[p, e]) for p, e in zip(out["p"], out["e"])]
