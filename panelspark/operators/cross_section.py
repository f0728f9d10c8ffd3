"""Per-date transforms: winsorise, standardise, rank, bucket, neutralise, orthogonalise.

Every function works from grouped statistics (map-side combined) joined back to
the rows, so a date that holds a third of all rows is still spread over tasks.
``by`` is the date, or the date plus a group; ``few_groups`` is passed on where
the key is the date alone, because a calendar bounds the number of dates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.numeric import clip, ratio
from panelspark.operators.order_stats import attach, group_quantiles, with_average_rank

MEDIAN = [(1, 2)]

# Several passes read the same rows. A stage may store them and read them back
# (``sources.sinks.staged``), so that the passes do not repeat the work before.
# Where the statistics of a pass have one row per date, they are stored instead:
# they are broadcast to the rows, which are read again and never shuffled. The
# caller hands over rows that are cheap to read, a stored table for instance.
Stage = Callable[[DataFrame, str], DataFrame]


def as_is(df: DataFrame, name: str) -> DataFrame:
    return df


def percentile_rank(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    """Average rank / count of non-null values."""
    ranked = with_average_rank(df, by, value, "_r", valid="_valid")
    return ranked.withColumn(out, F.col("_r") / F.col("_valid")).drop("_r", "_valid")


def rank_factor(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    out: str,
    *,
    ascending: bool = True,
    pct: bool = True,
    few_groups: bool = False,
) -> DataFrame:
    """(rank - 1) / (rows - 1); NULL rows count in rows; a single row gives 0.5."""
    ranked = with_average_rank(df, by, value, "_r", valid="_valid")
    rank = F.col("_r") if ascending else F.col("_valid") + F.lit(1.0) - F.col("_r")
    if not pct:
        return ranked.withColumn(out, rank).drop("_r", "_valid")
    rows = df.groupBy(*by).agg(F.count("*").alias("_rows"))
    return (
        attach(ranked, rows, by, few_groups)
        .withColumn(
            out,
            F.when(F.col("_rows") > 1, (rank - 1) / (F.col("_rows") - 1)).otherwise(F.lit(0.5)),
        )
        .drop("_r", "_valid", "_rows")
    )


def winsorize_mad(
    df: DataFrame,
    by: Sequence[str],
    values: Sequence[str],
    *,
    n: float = 5.0,
    suffix: str = "_clean",
    few_groups: bool = False,
    stage: Stage = as_is,
) -> DataFrame:
    """Clip to median +- n * MAD; a MAD of 0 leaves the values as they are."""
    centre = group_quantiles(df, by, values, MEDIAN, few_groups=few_groups)
    centre = centre.select(*by, *[F.col(f"{v}_q0").alias(f"_med_{v}") for v in values])
    if few_groups:
        centred = attach(df, stage(centre, "centre"), by, True)
    else:
        centred = stage(attach(df, centre, by, False), "centred")
    gaps = centred.select(*by, *[F.abs(F.col(v) - F.col(f"_med_{v}")).alias(f"_gap_{v}") for v in values])
    spread = group_quantiles(gaps, by, [f"_gap_{v}" for v in values], MEDIAN, few_groups=few_groups)
    spread = spread.select(*by, *[F.col(f"_gap_{v}_q0").alias(f"_mad_{v}") for v in values])
    joined = attach(centred, stage(spread, "spread") if few_groups else spread, by, few_groups)
    out = {}
    for v in values:
        med, mad = F.col(f"_med_{v}"), F.col(f"_mad_{v}")
        clipped = clip(v, med - F.lit(float(n)) * mad, med + F.lit(float(n)) * mad)
        out[v + suffix] = F.when(mad == 0, F.col(v)).otherwise(clipped)
    return joined.withColumns(out).drop(*[f"_{p}_{v}" for v in values for p in ("med", "mad")])


def standardize(
    df: DataFrame, by: Sequence[str], value: str, out: str, *, method: str = "zscore", few_groups: bool = False
) -> DataFrame:
    """zscore (sample deviation) or mad; a degenerate group gives 0."""
    if method == "zscore":
        stats = df.groupBy(*by).agg(
            F.count("*").alias("_rows"), F.avg(value).alias("_mid"), F.stddev_samp(value).alias("_dev")
        )
        joined = attach(df, stats, by, few_groups)
    elif method == "mad":
        mid = group_quantiles(df, by, [value], MEDIAN, few_groups=few_groups)
        mid = mid.select(*by, F.col(f"{value}_q0").alias("_mid"))
        centred = attach(df, mid, by, few_groups)
        gaps = centred.select(*by, F.abs(F.col(value) - F.col("_mid")).alias("_gap"))
        dev = group_quantiles(gaps, by, ["_gap"], MEDIAN, few_groups=few_groups)
        rows = df.groupBy(*by).agg(F.count("*").alias("_rows"))
        stats = rows.join(dev.select(*by, F.col("_gap_q0").alias("_dev")), list(by), "left")
        joined = attach(centred, stats, by, few_groups)
    else:
        raise ValueError("method must be 'zscore' or 'mad'")
    degenerate = (F.col("_dev") == 0) | (F.col("_rows") < 2)
    scaled = (F.col(value) - F.col("_mid")) / F.nullif(F.col("_dev"), F.lit(0.0))
    return joined.withColumn(out, F.when(degenerate, F.lit(0.0)).otherwise(scaled)).drop("_rows", "_mid", "_dev")


def edge_bucket(value: Column, edges: Column) -> Column:
    """1-based bucket of right-closed intervals; the lowest edge belongs to bucket 1.

    Equal edges count once. Fewer than two different edges give no bucket.
    """
    unique = F.array_distinct(edges)
    below = F.size(F.filter(unique, lambda e: e < value))
    return F.when(
        value.isNotNull() & (F.size(unique) > 1), F.greatest(below, F.lit(1)).cast("int")
    )


def quantile_bucket(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    out: str,
    *,
    buckets: int = 5,
    ascending: bool = True,
    few_groups: bool = False,
) -> DataFrame:
    """Equal-count buckets on interpolated quantile edges; small groups get NULL."""
    source = df if ascending else df.withColumn("_neg", -F.col(value))
    v = value if ascending else "_neg"
    edges = group_quantiles(source, by, [v], [(i, buckets) for i in range(buckets + 1)], few_groups=few_groups)
    edges = edges.select(*by, F.array(*[f"{v}_q{i}" for i in range(buckets + 1)]).alias("_edges"))
    # both tables have one row per group; the rows are joined once
    stats = source.groupBy(*by).agg(F.count("*").alias("_rows")).join(edges, list(by), "left")
    joined = attach(source, stats, by, few_groups)
    bucket = F.when(F.col("_rows") >= buckets, edge_bucket(F.col(v), F.col("_edges")))
    return joined.withColumn(out, bucket).drop("_edges", "_rows", "_neg")


def fixed_bucket(value: str, bins: Sequence[float]) -> Column:
    """Bucket by given edges, right-closed, lowest included; outside is NULL."""
    if len(bins) < 2:
        raise ValueError("bins needs at least 2 edges")
    v = F.col(value)
    out = F.when(v < F.lit(float(bins[0])), F.lit(None).cast("int"))
    for i, edge in enumerate(bins[1:], 1):
        out = out.when(v <= F.lit(float(edge)), F.lit(i))
    return out


def sequential_buckets(
    df: DataFrame,
    period: str,
    first: str,
    second: str,
    *,
    q1: int = 5,
    q2: int = 5,
    out1: str = "bucket1",
    out2: str = "bucket2",
) -> DataFrame:
    """Bucket by first, then by second inside every (period, first bucket)."""
    rows = df.where(F.col(first).isNotNull() & F.col(second).isNotNull())
    one = quantile_bucket(rows, [period], first, out1, buckets=q1, few_groups=True)
    one = one.where(F.col(out1).isNotNull())
    two = quantile_bucket(one, [period, out1], second, out2, buckets=q2)
    return two.where(F.col(out2).isNotNull())


def fill_with_group_mean(df: DataFrame, by: Sequence[str], value: str, out: str) -> DataFrame:
    means = df.groupBy(*by).agg(F.avg(value).alias("_mean"))
    return attach(df, means, by, False).withColumn(out, F.coalesce(F.col(value), F.col("_mean"))).drop("_mean")


def excess_over_mean(df: DataFrame, by: Sequence[str], value: str, out: str, *, few_groups: bool = False) -> DataFrame:
    means = df.groupBy(*by).agg(F.avg(value).alias("_mean"))
    return attach(df, means, by, few_groups).withColumn(out, F.col(value) - F.col("_mean")).drop("_mean")


SIZE_FEATURES = {
    "log1p": lambda c: F.log1p(c),
    "log": lambda c: F.log(F.greatest(c, F.lit(1e-6))),
    "sqrt": lambda c: F.sqrt(c),
}


def neutralize(
    df: DataFrame,
    period: str,
    factors: dict[str, str],
    size: str,
    group: str | None,
    *,
    weight: str = "log_mv",
    feature: str = "log1p",
    n: float = 5.0,
    min_rows: int = 10,
    stage: Stage = as_is,
) -> DataFrame:
    """Residuals of weighted regressions on size and group dummies, z-scored per date.

    factors maps each factor to its output column; all of them share the
    passes. The dummies are removed by weighted demeaning inside (date, group),
    which leaves one slope per date; both come from sums, without a design
    matrix. A date with fewer than min_rows usable rows keeps the cleaned value.
    """
    clean = winsorize_mad(df, [period], [*factors, size], n=n, few_groups=True, stage=stage)
    mv = F.col(f"{size}_clean")
    x = SIZE_FEATURES[feature](mv)
    weights = {"equal": F.lit(1.0), "mv": mv, "log_mv": x, "sqrt_mv": F.sqrt(mv)}
    base = {"_x": x, "_w": weights[weight].cast("double"), "_g": F.col(group) if group else F.lit(0)}
    rows = clean.withColumns(base)
    sound = F.col("_x").isNotNull() & F.col("_w").isNotNull() & F.col("_g").isNotNull()
    rows = rows.withColumns({f"_y{i}": F.when(sound, F.col(f"{f}_clean")) for i, f in enumerate(factors)})
    rows = rows.drop(*[f"{c}_clean" for c in [*factors, size]])
    many = range(len(factors))
    sums, centres, totals, slopes, scales = [], [], [], [], []
    for i in many:
        w = f"if(_y{i} is null, null, _w)"
        sums += [
            f"count(_y{i}) as _n{i}", f"sum({w}) as _sw{i}", f"sum({w} * _x) as _sx{i}", f"sum(_w * _y{i}) as _sy{i}",
            f"sum({w} * _x * _x) as _sxx{i}", f"sum(_w * _x * _y{i}) as _sxy{i}",
        ]
        centres += [f"try_divide(_sx{i}, _sw{i}) as _mx{i}", f"try_divide(_sy{i}, _sw{i}) as _my{i}"]
        totals += [
            f"sum(_n{i}) as _rows{i}", f"sum(_sxy{i} - try_divide(_sx{i} * _sy{i}, _sw{i})) as _cxy{i}",
            f"sum(_sxx{i} - try_divide(_sx{i} * _sx{i}, _sw{i})) as _cxx{i}", f"sum(_sxx{i}) as _scale{i}",
        ]
        # size that does not vary inside the groups leaves nothing to fit
        slopes += [f"_rows{i}", f"if(_cxx{i} <= _scale{i} * 1e-12D, 0D, try_divide(_cxy{i}, _cxx{i})) as _slope{i}"]
        scales += [f"avg(_e{i}) as _em{i}", f"stddev_samp(_e{i}) as _es{i}"]
    cells = stage(rows.where("_g is not null").groupBy(period, "_g").agg(*[F.expr(e) for e in sums]), "regression")
    dates = cells.groupBy(period).agg(*[F.expr(e) for e in totals]).selectExpr(period, *slopes)
    joined = attach(attach(rows, dates, [period], True), cells.selectExpr(period, "_g", *centres), [period, "_g"], False)
    residuals = {f"_e{i}": F.expr(f"(_y{i} - _my{i}) - _slope{i} * (_x - _mx{i})") for i in many}
    joined = joined.withColumns(residuals)
    scale = stage(joined.groupBy(period).agg(*[F.expr(e) for e in scales]), "residual")
    outputs = {
        out: F.expr(f"case when _y{i} is null then null when _rows{i} < {min_rows} then _y{i} else try_divide(_e{i} - _em{i}, _es{i}) end")
        for i, out in enumerate(factors.values())
    }
    helper = [f"_{c}{i}" for i in many for c in ("y", "rows", "slope", "mx", "my", "e", "em", "es")]
    return attach(joined, scale, [period], True).withColumns(outputs).drop("_x", "_w", "_g", *helper)


def orthogonalize_pairs(
    df: DataFrame, period: str, pairs: dict[str, tuple[str, str]], *, residual: bool = True, intercept: bool = True
) -> DataFrame:
    """Several one-control regressions per date in one pass: out -> (target, control).

    Rows with a NULL in the pair keep the raw target.
    """
    aggs, outputs = [], {}
    for i, (out, (t, k)) in enumerate(pairs.items()):
        used = F.col(t).isNotNull() & F.col(k).isNotNull()
        y, x = F.when(used, F.col(t)), F.when(used, F.col(k))
        aggs += [
            F.count(y).alias(f"_n{i}"),
            (F.var_pop(x) if intercept else F.avg(x * x)).alias(f"_v{i}"),
            F.avg(x * x).alias(f"_q{i}"),
            (F.covar_pop(y, x) if intercept else F.avg(y * x)).alias(f"_c{i}"),
            (F.avg(x) if intercept else F.lit(0.0)).alias(f"_mx{i}"),
            (F.avg(y) if intercept else F.lit(0.0)).alias(f"_my{i}"),
        ]
        fitted = F.expr(f"if(_v{i} <= _q{i} * 1e-20D, 0D, try_divide(_c{i}, _v{i})) * ({k} - _mx{i}) + _my{i}")
        value = F.col(t) - fitted if residual else fitted
        outputs[out] = F.when(used & (F.col(f"_n{i}") >= 2), value).otherwise(F.col(t))
    helper = [f"_{c}{i}" for i in range(len(pairs)) for c in ("n", "v", "q", "c", "mx", "my")]
    return attach(df, df.groupBy(period).agg(*aggs), [period], True).withColumns(outputs).drop(*helper)


def orthogonalize(
    df: DataFrame,
    period: str,
    target: str,
    controls: Sequence[str],
    out: str,
    *,
    method: str = "linear",
    residual: bool = True,
    intercept: bool = True,
    stage: Stage = as_is,
) -> DataFrame:
    """Remove the controls from the target per date.

    linear: least squares on all controls at once, reached by making the
    controls orthogonal to each other first; partial: one control after the
    other. Rows with a NULL in any used column keep the raw target.
    """
    controls = list(controls)
    if not controls:
        raise ValueError("controls must not be empty")
    if target in controls:
        raise ValueError("the target must not be one of the controls")
    if method not in ("linear", "residual", "partial"):
        raise ValueError(f"unknown method {method}")
    used = F.col(target).isNotNull()
    for c in controls:
        used = used & F.col(c).isNotNull()
    names = ["_t", *[f"_k{i}" for i in range(len(controls))]]
    rows = df.withColumns(
        {n: F.when(used, F.col(c).cast("double")) for n, c in zip(names, [target, *controls])}
    )
    counts = rows.groupBy(period).agg(F.count("_t").alias("_rows"))
    rows = attach(rows, counts, [period], True)
    for i in range(len(controls)):
        k = f"_k{i}"
        rows = stage(rows, f"control{i}") if i else rows
        others = ["_t"] if method == "partial" else ["_t", *[f"_k{j}" for j in range(i + 1, len(controls))]]
        aggs = [F.var_pop(k).alias("_var") if intercept else F.avg(F.col(k) * F.col(k)).alias("_var")]
        # measured against the control as given: what is left of a collinear control is rounding noise
        raw = F.when(F.col("_t").isNotNull(), F.col(controls[i]).cast("double"))
        aggs.append(F.avg(raw * raw).alias("_size"))
        if intercept:
            aggs.append(F.avg(k).alias("_mk"))
        for o in others:
            product = F.covar_pop(o, k) if intercept else F.avg(F.col(o) * F.col(k))
            aggs.append(product.alias(f"_cov{o}"))
            if intercept:
                aggs.append(F.avg(o).alias(f"_m{o}"))
        rows = attach(rows, rows.groupBy(period).agg(*aggs), [period], True)
        flat = F.col("_var") <= F.col("_size") * F.lit(1e-20)
        step = {}
        for o in others:
            beta = F.when(flat, F.lit(0.0)).otherwise(ratio(f"_cov{o}", "_var"))
            fitted = beta * (F.col(k) - F.col("_mk")) + F.col(f"_m{o}") if intercept else beta * F.col(k)
            step[o] = F.col(o) - fitted
        rows = rows.withColumns(step)
        rows = rows.drop("_var", "_size", "_mk", *[f"_cov{o}" for o in others], *[f"_m{o}" for o in others])
    fit = F.col("_t") if residual else F.col(target) - F.col("_t")
    kept = F.when((F.col("_rows") < 2) | F.col("_t").isNull(), F.col(target)).otherwise(fit)
    return rows.withColumn(out, kept).drop(*names, "_rows")
