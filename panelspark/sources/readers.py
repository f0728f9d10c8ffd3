"""Scans: date ranges, look-back, look-ahead, buffers, sampled dates, landing of files."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.dates import parse_date
from panelspark.functions.numeric import nullify_non_finite
from panelspark.operators.calendar import shift_trading_days
from panelspark.operators.schema import is_date_name
from panelspark.sources.sinks import dedupe_by_key, overwrite_partitions, truncate_write


def date_range(
    df: DataFrame,
    col: str,
    start=None,
    end=None,
    *,
    entity: str | None = None,
    entities: Sequence | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Closed range and optional entity list; both reach the parquet scan."""
    out = df
    if start is not None:
        out = out.where(F.col(col) >= F.lit(start))
    if end is not None:
        out = out.where(F.col(col) <= F.lit(end))
    if entity and entities:
        out = out.where(F.col(entity).isin(list(entities)))
    return out.select(*columns) if columns else out


def trading_bound(spark: SparkSession, calendar: DataFrame, day: date, n: int) -> date:
    """The date n open days away; one row is looked up so that the scan gets a literal bound."""
    one = spark.createDataFrame([(day,)], "d date")
    return shift_trading_days(one, calendar, n).first()["shifted"]


def look_back_range(spark: SparkSession, df: DataFrame, calendar: DataFrame, col: str, start: date, end: date, days: int) -> DataFrame:
    """Range that starts ``days`` open days earlier so that windows are warm; trim after the windows."""
    return date_range(df, col, trading_bound(spark, calendar, start, -days), end)


def look_ahead_range(spark: SparkSession, df: DataFrame, calendar: DataFrame, col: str, start: date, end: date, days: int) -> DataFrame:
    return date_range(df, col, start, trading_bound(spark, calendar, end, days))


def buffered_range(df: DataFrame, col: str, start: date, end: date, *, days: int = 0, months: int = 0) -> DataFrame:
    """Range that starts natural days or months earlier; the bound folds to a literal."""
    low = F.add_months(F.date_sub(F.lit(start), days), -months)
    return df.where((F.col(col) >= low) & (F.col(col) <= F.lit(end)))


def on_dates(df: DataFrame, col: str, dates: DataFrame, date_col: str) -> DataFrame:
    """Only the listed dates. The list is calendar-sized and becomes literals, which reach partition and scan filters."""
    wanted = sorted(r[0] for r in dates.select(date_col).where(F.col(date_col).isNotNull()).distinct().collect())
    if not wanted:
        return df.where(F.lit(False))
    return df.where(F.col(col).between(wanted[0], wanted[-1]) & F.col(col).isin(wanted))


def slices(start: date, end: date, grain: str, calendar: DataFrame) -> DataFrame:
    from panelspark.operators.calendar import expected_dates

    return expected_dates(calendar, grain, start, end)


def read_jdbc(
    spark: SparkSession, url: str, table: str, *, partition_column: str | None = None, lower=None, upper=None,
    partitions: int = 1, **options: str,
) -> DataFrame:
    """Table scan of a database, split over a numeric or date column when bounds are given."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column is not None:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=str(lower), upperBound=str(upper), numPartitions=str(partitions)
        )
    return reader.load()


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns to the declared types: tolerant dates, NULL where a number does not parse."""
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DateType):
            out.append(parse_date(c).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(c.cast("string").alias(f.name))
        else:
            out.append(c.try_cast(f.dataType).alias(f.name))
    return nullify_non_finite(df.select(*out))


def land(
    spark: SparkSession,
    source: str | Sequence[str],
    target: str,
    schema: T.StructType,
    *,
    fmt: str = "csv",
    keys: Sequence[str],
    partition: str | None = None,
    month_partition: bool = True,
) -> None:
    """Files to a typed, cleaned, deduplicated table.

    With a partition date the touched months are replaced; without one the
    table is refreshed as a whole.
    """
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    reader = spark.read.schema(text)
    raw = reader.csv(source, header=True) if fmt == "csv" else reader.format(fmt).load(source)
    rows = dedupe_by_key(typed(raw, schema), keys)
    if partition is None:
        truncate_write(rows, target)
    elif month_partition:
        overwrite_partitions(rows.withColumn("month", F.date_format(partition, "yyyy-MM")), target, ["month"])
    else:
        overwrite_partitions(rows, target, [partition])


def landing_schema(columns: Sequence[str], numbers: Sequence[str] = ()) -> T.StructType:
    """Date names become dates, listed columns numbers, the rest text."""
    return T.StructType(
        [
            T.StructField(
                c, T.DateType() if is_date_name(c) else T.DoubleType() if c in numbers else T.StringType()
            )
            for c in columns
        ]
    )
