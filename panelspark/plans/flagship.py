"""Does momentum predict the next return? Signal, label, buckets and rank correlation."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelspark.operators.cross_section import quantile_bucket
from panelspark.operators.order_stats import with_average_rank
from panelspark.functions.numeric import ratio, safe_corr
from panelspark.plans.registry import query
from panelspark.plans.shapes import bars, r, rnd, with_ctes

SQL_SIGNAL = """
 SELECT entity, grp, period, close / nullif(lag(close, 3) OVER w, 0) - 1 AS momentum,
  lead(close) OVER w / nullif(close, 0) - 1 AS fwd_ret
 FROM bars WINDOW w AS (PARTITION BY entity ORDER BY period)"""


def signal(spark, sf_dir):
    from pyspark.sql import Window

    w = Window.partitionBy("entity").orderBy("period")
    return bars(spark, sf_dir).select(
        "entity",
        "grp",
        "period",
        (ratio("close", F.lag("close", 3).over(w)) - 1).alias("momentum"),
        (ratio(F.lead("close").over(w), "close") - 1).alias("fwd_ret"),
    )


@query(
    "A1 G5 G15 M2",
    with_ctes(
        "bars",
        f"""SELECT period, count(*) AS n, {rnd('corr(rm, rf)')} AS ic FROM (
 SELECT period, rank() OVER (PARTITION BY period ORDER BY momentum)
   + (count(*) OVER (PARTITION BY period, momentum) - 1) / 2.0 AS rm,
  rank() OVER (PARTITION BY period ORDER BY fwd_ret)
   + (count(*) OVER (PARTITION BY period, fwd_ret) - 1) / 2.0 AS rf
 FROM sig WHERE momentum IS NOT NULL AND fwd_ret IS NOT NULL) GROUP BY period""",
        sig=SQL_SIGNAL,
    ),
)
def momentum_information_coefficient(spark, sf_dir):
    rows = signal(spark, sf_dir).where("momentum is not null and fwd_ret is not null")
    ranked = with_average_rank(rows, ["period"], "momentum", "_a")
    ranked = with_average_rank(ranked, ["period"], "fwd_ret", "_b")
    return ranked.groupBy("period").agg(
        F.count("*").alias("n"), r(safe_corr("_a", "_b")).alias("ic")
    )


@query(
    "G20 M4",
    with_ctes(
        "bars",
        f"""SELECT period, bucket, count(*) AS n, {rnd('avg(fwd_ret)')} AS mean_ret FROM (
 SELECT s.*, 1 + CAST(momentum > e[1] AS INTEGER) + CAST(momentum > e[2] AS INTEGER)
  + CAST(momentum > e[3] AS INTEGER) + CAST(momentum > e[4] AS INTEGER) AS bucket
 FROM sig s JOIN (SELECT period, quantile_cont(momentum, [0.2, 0.4, 0.6, 0.8]) AS e FROM sig
  WHERE momentum IS NOT NULL AND fwd_ret IS NOT NULL GROUP BY period HAVING count(*) >= 5) USING (period)
 WHERE momentum IS NOT NULL AND fwd_ret IS NOT NULL) GROUP BY period, bucket""",
        sig=SQL_SIGNAL,
    ),
)
def momentum_bucket_returns(spark, sf_dir):
    rows = signal(spark, sf_dir).where("momentum is not null and fwd_ret is not null")
    bucketed = quantile_bucket(rows, ["period"], "momentum", "bucket", buckets=5, few_groups=True)
    return (
        bucketed.where("bucket is not null")
        .groupBy("period", "bucket")
        .agg(F.count("*").alias("n"), r(F.avg("fwd_ret")).alias("mean_ret"))
    )
