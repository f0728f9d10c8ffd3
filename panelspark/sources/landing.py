"""Landing by catalogue: named raw datasets from their fetched files to typed tables, with a table of rejected rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.dates import parse_date
from panelspark.functions.numeric import nullify_non_finite
from panelspark.sources.raw_datasets import RAW_DATASETS, RawDataset
from panelspark.sources.sinks import WriteReport, last_slice_of_month, overwrite_partitions, replace_dates, scratch_path, truncate_write

REJECTS = "rejects"
_LINE = "_line"


@dataclass(frozen=True)
class LandingReport:
    """One dataset's landing: rows read and rejected, rejections by reason, and what the write has seen."""

    dataset: str
    rows_read: int = 0
    rejected: int = 0
    reasons: dict[str, int] = field(default_factory=dict)
    written: WriteReport | None = None
    error: str | None = None


def read_fetches(spark: SparkSession, fetches: Mapping[str, str | Sequence[str]], schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """All fetches of a dataset as text columns, with the fetch's name and the raw line where it is malformed."""
    names = [f.name for f in schema.fields]
    text = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _LINE]])
    parts = []
    for name, source in fetches.items():
        if fmt in ("csv", "json"):
            reader = spark.read.schema(text).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE)
            rows = reader.csv(source, header=True) if fmt == "csv" else reader.json(source)
        else:
            stored = spark.read.format(fmt).load(source)
            rows = stored.select(*[(F.col(n) if n in stored.columns else F.lit(None)).cast("string").alias(n) for n in names], F.lit(None).cast("string").alias(_LINE))
        parts.append(rows.withColumn("_fetch", F.lit(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _value(f: T.StructField) -> Column:
    c = F.nullif(F.trim(F.col(f.name)), F.lit(""))
    if isinstance(f.dataType, T.StringType):
        return c
    return parse_date(c) if isinstance(f.dataType, T.DateType) else c.try_cast(f.dataType)


def checked(raw: DataFrame, schema: T.StructType, keys: Sequence[str]) -> DataFrame:
    """Typed columns beside `_reasons`, the list of what is wrong with a row: a malformed line, a text that is no number or date, a missing key.

    Blank text is NULL, and so is a number that is not finite.
    """
    typed = raw.withColumn("_raw", F.coalesce(F.col(_LINE), F.to_json(F.struct(*[f.name for f in schema.fields]))))
    wrong = [F.when(F.col(_LINE).isNotNull(), "malformed line")]
    for f in schema.fields:
        given = F.nullif(F.trim(F.col(f.name)), F.lit("")).isNotNull()
        if not isinstance(f.dataType, T.StringType):
            wrong.append(F.when(F.col(_LINE).isNull() & given & _value(f).isNull(), f"no {f.dataType.simpleString()}: {f.name}"))
        if f.name in keys:
            wrong.append(F.when(F.col(_LINE).isNull() & ~given, f"no key: {f.name}"))
    typed = typed.withColumn("_reasons", F.array_compact(F.array(*wrong)))
    values = nullify_non_finite(typed.select(*[_value(f).alias(f.name) for f in schema.fields], "_fetch", "_raw", "_reasons"))
    return values


def reasons(schema: T.StructType, keys: Sequence[str]) -> list[str]:
    """All reasons that `checked` can give."""
    kinds = [f"no {f.dataType.simpleString()}: {f.name}" for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    return ["malformed line", *kinds, *[f"no key: {k}" for k in keys]]


def _split(rows: DataFrame, why: Sequence[str], spark: SparkSession) -> tuple[DataFrame, DataFrame, Observation]:
    """Text is parsed once: good and rejected rows are written to two folders of one copy and counted on the way."""
    seen, path = Observation(), scratch_path(spark, "landing")
    bad = F.size("_reasons") > 0
    counts = [F.count_if(F.array_contains("_reasons", w)).alias(f"reason_{i}") for i, w in enumerate(why)]
    rows = rows.observe(seen, F.count("*").alias("rows_read"), F.count_if(bad).alias("rejected"), *counts)
    rows.withColumn("_bad", bad).write.partitionBy("_bad").parquet(path)
    both = spark.read.schema(rows.schema.add("_bad", T.BooleanType())).parquet(path)
    return both.where(~F.col("_bad")).drop("_bad"), both.where(F.col("_bad")).drop("_bad"), seen


def _write(rows: DataFrame, dataset: RawDataset, target: str) -> WriteReport | None:
    if dataset.partition is None:
        return truncate_write(rows, target, keys=dataset.keys)
    by_month = lambda df: df.withColumn("month", F.date_format(dataset.partition, "yyyy-MM"))
    if dataset.strategy == "month_end":
        return overwrite_partitions(by_month(last_slice_of_month(rows, dataset.partition)), target, ["month"], keys=dataset.keys)
    return replace_dates(by_month(rows), target, dataset.partition, ["month"], keys=dataset.keys)


def land_dataset(
    spark: SparkSession, name: str, fetches: Mapping[str, str | Sequence[str]], root: str, schema: T.StructType, *, fmt: str = "csv"
) -> LandingReport:
    """Land one dataset of the catalogue under root/name by its strategy.

    full replaces the table; day, period and ex_date replace the dates in the
    files; month_end keeps the last date of every month in the files and replaces
    these months. A dataset that is a union needs all its fetches, because a
    missing one would remove its rows. Rejected rows go to root/rejects with their
    dataset, fetch, reasons and raw text, in the place of the dataset's earlier ones.
    """
    dataset = RAW_DATASETS[name]
    if dataset.fetches and set(fetches) != set(dataset.fetches):
        raise ValueError(f"{name} is the union of the fetches {', '.join(dataset.fetches)}")
    unknown = {*dataset.keys, *filter(None, [dataset.partition])} - set(schema.names)
    if unknown or not fetches:
        raise ValueError(f"{name} needs files and the columns {', '.join(dataset.keys)}")
    why = reasons(schema, dataset.keys)
    good, rejected, seen = _split(checked(read_fetches(spark, fetches, schema, fmt), schema, dataset.keys), why, spark)
    try:
        counts = seen.get
    except Py4JJavaError:  # files without a row are planned away
        counts = {}
    out = rejected.select("_fetch", F.array_join("_reasons", "; ").alias("reasons"), "_raw").withColumnsRenamed({"_fetch": "fetch", "_raw": "raw"})
    if counts.get("rejected"):
        overwrite_partitions(out.withColumn("dataset", F.lit(name)), f"{root}/{REJECTS}", ["dataset"])
    else:
        _clear_rejects(spark, f"{root}/{REJECTS}", name)
    written = _write(good.select(*schema.names), dataset, f"{root}/{name}")
    found = {w: n for i, w in enumerate(why) if (n := counts.get(f"reason_{i}"))}
    return LandingReport(name, counts.get("rows_read") or 0, counts.get("rejected") or 0, found, written)


def _clear_rejects(spark: SparkSession, path: str, name: str) -> None:
    from panelspark.sources.sinks import _delete

    _delete(spark, f"{path}/dataset={name}")


def land_catalogue(
    spark: SparkSession, files: Mapping[str, Mapping[str, str | Sequence[str]]], root: str, schemas: Mapping[str, T.StructType], *, fmt: str = "csv"
) -> list[LandingReport]:
    """Land several datasets, one after the other; one that fails is reported and does not stop the others."""
    out = []
    for name, fetches in files.items():
        try:
            out.append(land_dataset(spark, name, fetches, root, schemas[name], fmt=fmt))
        except (KeyError, ValueError, PySparkException) as e:
            out.append(LandingReport(name, error=f"{type(e).__name__}: {str(e).splitlines()[0]}"))
    return out
