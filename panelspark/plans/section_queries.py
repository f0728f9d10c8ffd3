"""Cross-section queries on monthly bars: ranks, buckets, cleaning and regressions per date."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.functions.numeric import guarded_ratio, ratio
from panelspark.operators import cross_section as X
from panelspark.operators import windows as W
from panelspark.plans.registry import query
from panelspark.sources.sinks import staged
from panelspark.plans.shapes import bars, r, rcols, rnd, sql_rcols, with_ctes

BY = "PARTITION BY entity ORDER BY period"
SQL_F = f"""
 SELECT entity, grp, period, close, amount, vol, close / nullif(lag(close, 3) OVER ({BY}), 0) - 1 AS mom,
  vol / nullif(lag(vol) OVER ({BY}), 0) - 1 AS volchg, high / low - 1 AS spread,
  lead(close) OVER ({BY}) / nullif(close, 0) - 1 AS fwd FROM bars"""


def factors(spark, sf_dir):
    """Stored once, because every operator below reads its rows several times."""
    w = W.by_time("entity", "period")
    rows = bars(spark, sf_dir).select(
        "entity",
        "grp",
        "period",
        "close",
        "amount",
        "vol",
        W.change("close", w, 3).alias("mom"),
        W.change("vol", w).alias("volchg"),
        (ratio("high", "low") - 1).alias("spread"),
        (ratio(F.lead("close").over(w), "close") - 1).alias("fwd"),
    )
    return staged(rows, "factors")


def avg_rank(col: str, by: str, desc: bool = False) -> str:
    d = " DESC" if desc else ""
    return (
        f"CASE WHEN {col} IS NOT NULL THEN rank() OVER (PARTITION BY {by} ORDER BY {col}{d} NULLS LAST)"
        f" + (count(*) OVER (PARTITION BY {by}, {col}) - 1) / 2.0 END"
    )


@query(
    "G16",
    with_ctes(
        "bars",
        f"""SELECT entity, period, {rnd(f"({avg_rank('vol', 'period')}) / count(vol) OVER (PARTITION BY period)")} AS vol_rank
 FROM bars""",
    ),
)
def section_percentile_rank(spark, sf_dir):
    out = X.percentile_rank(bars(spark, sf_dir).select("entity", "period", "vol"), ["period"], "vol", "vol_rank")
    return rcols(out, ["entity", "period"], ["vol_rank"])


@query(
    "G17",
    with_ctes(
        "bars",
        f"""SELECT entity, period, CASE WHEN n > 1 THEN {rnd('(ra - 1) / (n - 1)')} ELSE 0.5 END AS up,
 CASE WHEN n > 1 THEN {rnd('(rd - 1) / (n - 1)')} ELSE 0.5 END AS down, CAST(rg AS DOUBLE) AS raw_in_group FROM (
 SELECT entity, period, count(*) OVER (PARTITION BY period) AS n, {avg_rank('mom', 'period')} AS ra,
 {avg_rank('mom', 'period', True)} AS rd, {avg_rank('mom', 'period, grp')} AS rg FROM f)""",
        f=SQL_F,
    ),
)
def section_rank_factor(spark, sf_dir):
    f = factors(spark, sf_dir).select("entity", "grp", "period", "mom")
    out = X.rank_factor(f, ["period"], "mom", "up", few_groups=True)
    out = X.rank_factor(out, ["period"], "mom", "down", ascending=False, few_groups=True)
    out = X.rank_factor(out, ["period", "grp"], "mom", "raw_in_group", pct=False)
    return out.select("entity", "period", r("up").alias("up"), r("down").alias("down"), "raw_in_group")


def sql_clip(v: str, by: str, n: float, source: str) -> str:
    return f"""
 SELECT s.*, CASE WHEN mad = 0 OR mad IS NULL THEN {v} WHEN {v} < med - {n} * mad THEN med - {n} * mad
  WHEN {v} > med + {n} * mad THEN med + {n} * mad ELSE {v} END AS {v}_clean
 FROM {source} s JOIN (SELECT {by}, any_value(med) AS med, median(abs({v} - med)) AS mad FROM (
  SELECT {by}, {v}, median({v}) OVER (PARTITION BY {by}) AS med FROM {source}) GROUP BY {by}) USING ({by})"""


@query(
    "G18",
    with_ctes(
        "bars",
        f"""SELECT entity, period, {rnd('mom_clean')} AS by_date, {rnd('g.v')} AS by_group FROM a JOIN (
 SELECT entity, period, mom_clean AS v FROM b) g USING (entity, period)""",
        f=SQL_F,
        a=sql_clip("mom", "period", 2, "f"),
        b=sql_clip("mom", "period, grp", 2, "f"),
    ),
)
def section_winsorize(spark, sf_dir):
    f = factors(spark, sf_dir).select("entity", "grp", "period", "mom")
    out = X.winsorize_mad(f, ["period"], ["mom"], n=2, suffix="_d", few_groups=True)
    out = X.winsorize_mad(out, ["period", "grp"], ["mom"], n=2, suffix="_g")
    return out.select("entity", "period", r("mom_d").alias("by_date"), r("mom_g").alias("by_group"))


@query(
    "G19",
    with_ctes(
        "bars",
        f"""SELECT entity, period, CASE WHEN s = 0 OR n < 2 THEN 0.0 ELSE {rnd('(vol - m) / nullif(s, 0)')} END AS z,
 CASE WHEN mad = 0 OR n < 2 THEN 0.0 ELSE {rnd('(vol - med) / nullif(mad, 0)')} END AS robust FROM (
 SELECT *, median(abs(vol - med)) OVER (PARTITION BY period) AS mad FROM (
  SELECT entity, period, vol, count(*) OVER p AS n, avg(vol) OVER p AS m, stddev_samp(vol) OVER p AS s,
   median(vol) OVER p AS med FROM bars WINDOW p AS (PARTITION BY period)))""",
    ),
)
def section_standardize(spark, sf_dir):
    b = staged(bars(spark, sf_dir).select("entity", "period", "vol"), "bars")
    out = X.standardize(b, ["period"], "vol", "z", few_groups=True)
    out = X.standardize(out, ["period"], "vol", "robust", method="mad", few_groups=True)
    return rcols(out, ["entity", "period"], ["z", "robust"])


def sql_bucket(col: str, by: str, q: int, source: str, out: str) -> str:
    """Bucket by interpolated edges; equal edges count once."""
    probs = ", ".join(repr(i / q) for i in range(q + 1))
    return f"""
 SELECT s.*, CASE WHEN s.{col} IS NOT NULL AND n >= {q} AND len(e) > 1
  THEN CAST(greatest(1, len(list_filter(e, lambda x: x < s.{col}))) AS INTEGER) END AS {out}
 FROM {source} s JOIN (SELECT {by}, count(*) AS n, list_distinct(quantile_cont({col}, [{probs}])) AS e
  FROM {source} GROUP BY {by}) USING ({by})"""


@query(
    "G20",
    with_ctes(
        "bars",
        "SELECT entity, period, b5, b3 FROM a JOIN (SELECT entity, period, b3 FROM b) USING (entity, period)",
        f=SQL_F,
        neg="SELECT *, -volchg AS nv FROM f",
        a=sql_bucket("mom", "period", 5, "f", "b5"),
        b=sql_bucket("nv", "period, grp", 3, "neg", "b3"),
    ),
)
def section_quantile_bucket(spark, sf_dir):
    f = factors(spark, sf_dir).select("entity", "grp", "period", "mom", "volchg")
    out = X.quantile_bucket(f, ["period"], "mom", "b5", buckets=5, few_groups=True)
    out = X.quantile_bucket(out, ["period", "grp"], "volchg", "b3", buckets=3, ascending=False)
    return out.select("entity", "period", "b5", "b3")


SQL_NEUTRAL = {
    "f": SQL_F,
    "c1": sql_clip("mom", "period", 5, "f"),
    "c2": sql_clip("amount", "period", 5, "c1"),
    "u": "SELECT *, ln(1 + amount_clean) AS x, ln(1 + amount_clean) AS w FROM c2 WHERE mom_clean IS NOT NULL",
    "m": """SELECT *, sum(w * x) OVER p / sum(w) OVER p AS mx, sum(w * mom_clean) OVER p / sum(w) OVER p AS my,
  count(*) OVER (PARTITION BY period) AS n FROM u WINDOW p AS (PARTITION BY period, grp)""",
    "sl": """SELECT period, sum(w * (x - mx) * (mom_clean - my)) AS cxy, sum(w * (x - mx) * (x - mx)) AS cxx,
  sum(w * x * x) AS scale FROM m GROUP BY period""",
    "e": """SELECT m.*, (mom_clean - my) - CASE WHEN cxx <= scale * 1e-12 THEN 0 ELSE cxy / cxx END * (x - mx) AS e
  FROM m JOIN sl USING (period)""",
}


@query(
    "G21",
    with_ctes(
        "bars",
        f"""SELECT f.entity, f.period, {rnd('z', 5)} AS neutral FROM f LEFT JOIN (SELECT entity, period,
  CASE WHEN n < 10 THEN mom_clean ELSE (e - avg(e) OVER p) / nullif(stddev_samp(e) OVER p, 0) END AS z
  FROM e WINDOW p AS (PARTITION BY period)) USING (entity, period)""",
        **SQL_NEUTRAL,
    ),
)
def section_neutralize(spark, sf_dir):
    f = factors(spark, sf_dir).select("entity", "grp", "period", "mom", "amount")
    out = X.neutralize(staged(f, "factors"), "period", {"mom": "neutral"}, "amount", "grp", stage=staged)
    return rcols(out, ["entity", "period"], ["neutral"], 5)


@query(
    "G22",
    with_ctes(
        "bars",
        f"""SELECT f.entity, f.period, {rnd('coalesce(k.one, f.mom)')} AS one, {rnd('coalesce(k.two, f.mom)')} AS two,
 {rnd('coalesce(k.part, f.mom)')} AS part FROM f LEFT JOIN s3 k USING (entity, period)""",
        f=SQL_F,
        s0="SELECT entity, period, mom AS y, volchg AS a, spread AS b FROM f WHERE mom IS NOT NULL AND volchg IS NOT NULL AND spread IS NOT NULL",
        s1="""SELECT *, y - (regr_intercept(y, a) OVER p + regr_slope(y, a) OVER p * a) AS one,
  b - (regr_intercept(b, a) OVER p + regr_slope(b, a) OVER p * a) AS bb, count(*) OVER p AS n
  FROM s0 WINDOW p AS (PARTITION BY period)""",
        s2="""SELECT *, one - (regr_intercept(one, bb) OVER p + regr_slope(one, bb) OVER p * bb) AS two,
  one - (regr_intercept(one, b) OVER p + regr_slope(one, b) OVER p * b) AS part FROM s1 WINDOW p AS (PARTITION BY period)""",
        s3="SELECT entity, period, CASE WHEN n >= 2 THEN one END AS one, CASE WHEN n >= 2 THEN two END AS two, CASE WHEN n >= 2 THEN part END AS part FROM s2",
    ),
)
def section_orthogonalize(spark, sf_dir):
    f = factors(spark, sf_dir).select("entity", "period", "mom", "volchg", "spread")
    f = f.withColumn("only", F.when(F.col("spread").isNotNull(), F.col("volchg")))
    out = X.orthogonalize_pairs(f, "period", {"one": ("mom", "only")})
    out = X.orthogonalize(out, "period", "mom", ["volchg", "spread"], "two", stage=staged)
    out = X.orthogonalize(staged(out, "two"), "period", "mom", ["volchg", "spread"], "part", method="partial", stage=staged)
    return rcols(out, ["entity", "period"], ["one", "two", "part"])


@query(
    "G23 G24",
    with_ctes(
        "bars",
        f"""SELECT entity, period, {rnd('coalesce(mom, avg(mom) OVER (PARTITION BY period, grp))')} AS filled,
 {rnd('fwd - avg(fwd) OVER (PARTITION BY period)')} AS excess FROM f""",
        f=SQL_F,
    ),
)
def section_fill_and_excess(spark, sf_dir):
    f = factors(spark, sf_dir).select("entity", "grp", "period", "mom", "fwd")
    out = X.fill_with_group_mean(f, ["period", "grp"], "mom", "filled")
    out = X.excess_over_mean(out, ["period"], "fwd", "excess", few_groups=True)
    return rcols(out, ["entity", "period"], ["filled", "excess"])


@query(
    "G25 M13",
    with_ctes(
        "bars",
        "SELECT entity, period, bucket1, bucket2 FROM b WHERE bucket2 IS NOT NULL",
        f=SQL_F,
        g="SELECT * FROM f WHERE mom IS NOT NULL AND spread IS NOT NULL",
        a=sql_bucket("mom", "period", 4, "g", "bucket1"),
        a2="SELECT * FROM a WHERE bucket1 IS NOT NULL",
        b=sql_bucket("spread", "period, bucket1", 3, "a2", "bucket2"),
    ),
)
def section_sequential_buckets(spark, sf_dir):
    f = factors(spark, sf_dir).select("entity", "period", "mom", "spread")
    out = X.sequential_buckets(f, "period", "mom", "spread", q1=4, q2=3)
    return out.select("entity", "period", "bucket1", "bucket2")


BINS = [-0.5, -0.1, 0.0, 0.25, 1.0]


@query(
    "G26 D9",
    with_ctes(
        "bars",
        "SELECT entity, period, CAST(CASE WHEN mom < -0.5 THEN NULL "
        + " ".join(f"WHEN mom <= {e} THEN {i}" for i, e in enumerate(BINS[1:], 1))
        + " END AS INTEGER) AS bucket, CASE WHEN grp IN (0, 1) THEN 'south' WHEN grp = 2 THEN 'east' ELSE 'other' END AS zone FROM f",
        f=SQL_F,
    ),
)
def section_fixed_bins(spark, sf_dir):
    zone = F.when(F.col("grp").isin(0, 1), "south").when(F.col("grp") == 2, "east").otherwise("other")
    return factors(spark, sf_dir).select("entity", "period", X.fixed_bucket("mom", BINS).alias("bucket"), zone.alias("zone"))


@query(
    "G33 G5",
    with_ctes(
        "bars",
        f"""SELECT entity, period, {rnd('(sr + mo) / 2')} AS u_turn FROM (
 SELECT entity, period, sr, CASE WHEN sr < 0.5 THEN (1 - CASE WHEN n > 1 THEN (mr - 1) / (n - 1) ELSE 0.5 END) / 2
   ELSE CASE WHEN n > 1 THEN (mr - 1) / (n - 1) ELSE 0.5 END / 2 END AS mo FROM (
  SELECT *, count(*) OVER (PARTITION BY period, lo) AS n, {avg_rank('m', 'period, lo')} AS mr FROM (
   SELECT *, sr < 0.5 AS lo FROM (SELECT *, CASE WHEN count(*) OVER (PARTITION BY period) > 1 THEN
     ({avg_rank('s', 'period')} - 1) / (count(*) OVER (PARTITION BY period) - 1) ELSE 0.5 END AS sr FROM (
    SELECT entity, period, avg(vol) OVER q AS m, stddev_samp(vol) OVER q AS s, count(*) OVER q AS c FROM bars
    WINDOW q AS ({BY} ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)) WHERE c = 20))))""",
    ),
)
def section_u_turn(spark, sf_dir):
    from panelspark.datasets.stock_factors import u_turn

    f = W.trailing(W.by_time("entity", "period"), 20)
    b = bars(spark, sf_dir).select(
        "entity", "period", F.avg("vol").over(f).alias("m"), F.stddev_samp("vol").over(f).alias("s"), F.count("*").over(f).alias("c")
    )
    return rcols(u_turn(staged(b.where("c = 20"), "windows"), "period", "s", "m", "u_turn"), ["entity", "period"], ["u_turn"])
