"""Writes that can be repeated: partition overwrite, upsert, month replace, watermarks.

Tables are folders of parquet files partitioned by a month or period column.
Rows are rebalanced by the partition column before a write: adaptive execution
merges small partitions and splits a large one over several tasks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from panelspark.operators.quality import duplicate_keys
from panelspark.operators.windows import latest_per_key
from panelspark.session import scratch_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write the table to the shared scratch folder and read it back.

    Cuts lineage and keeps later passes from repeating the work. The copy is on
    shared storage, so a lost executor does not lose it.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused folder for a table inside the scratch folder."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def dedupe_by_key(
    df: DataFrame, keys: Sequence[str], *, flag: str | None = "update_flag", order: Sequence[Column] = ()
) -> DataFrame:
    """One row per key: the highest numeric flag, then the given order.

    Spark limits each task to one row per key before the shuffle, so many
    copies of one key do not meet in one task.
    """
    by = []
    if flag and flag in df.columns:
        by.append(F.coalesce(F.col(flag).try_cast("double"), F.lit(0.0)).desc())
    by += list(order)
    rest = [F.col(f.name).desc() for f in df.schema.fields if f.name not in keys and f.dataType.simpleString()[:3] not in ("map", "var")]
    return latest_per_key(df, keys, [*by, *rest])


@dataclass(frozen=True)
class WriteReport:
    """What a write with keys has seen, measured while it ran.

    rows_in and rows_out count rows before and after, repeated_rows the rows of keys
    that came more than once, repeated_keys these keys. sample holds at most SAMPLE
    of them in key order: the smallest and the largest of each of sixteen classes
    of keys by hash, so it is bounded however many there are. Dates are shown as text.
    """

    rows_in: int
    rows_out: int
    repeated_rows: int
    repeated_keys: int
    sample: list[dict]


SAMPLE = 20
_CLASSES = "0123456789abcdef"


def watched_dedupe(df: DataFrame, keys: Sequence[str], *, flag: str | None = "update_flag") -> tuple[DataFrame, Callable[[], WriteReport]]:
    """The rows that `dedupe_by_key` keeps, and a function that gives the report after they have been written.

    One aggregate per key, combined in every task before the shuffle, chooses the
    row and counts its copies; the report is observed on its result, so nothing is
    read a second time and many copies of one key stay apart.
    """
    rest = [c for c in df.columns if c not in keys]
    by = [F.coalesce(F.col(flag).try_cast("double"), F.lit(0.0))] if flag and flag in df.columns else []
    by += [F.col(f.name) for f in df.schema.fields if f.name in rest and f.dataType.simpleString()[:3] not in ("map", "var")]
    row = [F.max_by(F.struct(*rest), F.struct(*by)).alias("_row")] if rest else []
    once = df.groupBy(*keys).agg(*row, F.count("*").alias("_copies"))
    repeated = F.col("_copies") > 1
    key = F.struct(*keys)
    kind = F.when(repeated, F.substring(F.md5(F.to_json(key)), 1, 1))
    shown = {"ignoreNullFields": "false"}
    ends = [F.to_json(f(F.when(kind == c, key)), shown).alias(f"{name}_{c}") for c in _CLASSES for name, f in (("low", F.min), ("high", F.max))]
    seen = Observation()
    once = once.observe(
        seen,
        F.sum("_copies").alias("rows_in"),
        F.count("*").alias("rows_out"),
        F.sum(F.when(repeated, F.col("_copies"))).alias("repeated_rows"),
        F.count_if(repeated).alias("repeated_keys"),
        *ends,
    )

    def report() -> WriteReport:
        try:
            got = seen.get
        except Py4JJavaError:  # an empty input is planned away together with what observes it
            got = {}
        found = {v for name in ("low", "high") for c in _CLASSES if (v := got.get(f"{name}_{c}")) is not None}
        sample = sorted(map(json.loads, found), key=lambda k: [(x is not None, x) for x in k.values()])[:SAMPLE]
        counts = {n: got.get(n) or 0 for n in ("rows_in", "rows_out", "repeated_rows", "repeated_keys")}
        return WriteReport(**counts, sample=sample)

    return once.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns]), report


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of copies; as a table, for a report of any size."""
    return duplicate_keys(df, keys)


def _spread(df: DataFrame, partition: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *[F.col(p) for p in partition]) if partition else df


def _write(df: DataFrame, path: str, partition: Sequence[str], keys: Sequence[str], mode: str, overwrite: str) -> WriteReport | None:
    rows, report = watched_dedupe(df, keys) if keys else (df, lambda: None)
    writer = _spread(rows, partition).write.mode(mode).option("partitionOverwriteMode", overwrite)
    (writer.partitionBy(*partition) if partition else writer).parquet(path)
    return report()


def overwrite_partitions(df: DataFrame, path: str, partition: Sequence[str], *, keys: Sequence[str] = ()) -> WriteReport | None:
    """Replace exactly the partitions present in the rows; others stay.

    Rows without a partition value are kept in the partition of NULL. With keys one
    row of each stays, and the write returns what it has seen of repeated ones.
    """
    return _write(df, path, partition, keys, "overwrite", "dynamic")


def truncate_write(df: DataFrame, path: str, partition: Sequence[str] = (), *, keys: Sequence[str] = ()) -> WriteReport | None:
    """Replace the whole table."""
    return _write(df, path, partition, keys, "overwrite", "static")


def append(df: DataFrame, path: str, partition: Sequence[str] = (), *, keys: Sequence[str] = ()) -> WriteReport | None:
    """Add rows; keys are made unique among the new rows only."""
    return _write(df, path, partition, keys, "append", "dynamic")


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds files or partitions that readers see."""
    files, root = _files(spark, path)
    return files.exists(root) and any(not f.getPath().getName().startswith(("_", ".")) for f in files.listStatus(root))


def _partition_values(df: DataFrame, partition: Sequence[str]) -> list[tuple]:
    """The different partition values of a table: as many as it has folders."""
    return [tuple(r) for r in df.select(*partition).distinct().collect()]


def _in_partitions(df: DataFrame, partition: Sequence[str], values: Iterable[tuple]) -> Column:
    """A filter of literals on the partition columns of a table, which prunes folders. Never NULL, so it can be negated."""
    name, rest = partition[0], partition[1:]
    value = lambda v: F.lit(v).cast(df.schema[name].dataType)
    first: dict = {}
    for v in values:
        first.setdefault(v[0], []).append(v[1:])
    if rest:
        found = F.lit(False)
        for v, more in first.items():
            found = found | (F.col(name).eqNullSafe(value(v)) & _in_partitions(df, rest, more))
        return found
    plain = sorted(v for v in first if v is not None)
    found = F.coalesce(F.col(name).isin([value(v) for v in plain]), F.lit(False)) if plain else F.lit(False)
    return found | F.col(name).isNull() if None in first else found


PENDING = "_pending-"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path for it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    files, p = _files(spark, path)
    files.delete(p, True)


def _stage_change(rows: DataFrame, path: str) -> str:
    """Write the new rows beside the table, in a folder that readers skip."""
    pending = f"{path}/{PENDING}{uuid.uuid4().hex}"
    rows.write.parquet(f"{pending}/rows")
    return pending


def _decide_change(spark: SparkSession, pending: str, partition: Sequence[str], emptied: Sequence[str]) -> None:
    """From here on the change happens: a run that dies is finished by the next one."""
    plan = spark.createDataFrame([(list(partition), list(emptied))], "partition array<string>, emptied array<string>")
    plan.coalesce(1).write.parquet(f"{pending}/plan")


def _finish_change(spark: SparkSession, path: str, pending: str) -> None:
    """Overwrite the partitions of the new rows, then remove the folders that lost all theirs. Can be repeated."""
    plan = spark.read.parquet(f"{pending}/plan").first()
    overwrite_partitions(spark.read.parquet(f"{pending}/rows"), path, plan["partition"])
    for folder in plan["emptied"]:
        _delete(spark, spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder)).toString())
    _delete(spark, pending)


def recover(spark: SparkSession, path: str) -> int:
    """Finish changes that a lost driver has decided on, drop those it has not; how many were finished.

    A table has one writer at a time, which calls this before it changes anything.
    """
    files, root = _files(spark, path)
    if not files.exists(root):
        return 0
    done = 0
    for f in files.listStatus(root):
        pending = f.getPath().toString()
        if not f.getPath().getName().startswith(PENDING):
            continue
        if files.exists(_files(spark, f"{pending}/plan/_SUCCESS")[1]):
            _finish_change(spark, path, pending)
            done += 1
        else:
            _delete(spark, pending)
    return done


def _folders(rows: DataFrame) -> list[str]:
    """The folders that rows are stored in, as URIs."""
    return [r[0] for r in rows.select(F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("f")).distinct().collect()]


def _publish(stored: DataFrame, path: str, old: DataFrame, merged: DataFrame, partition: Sequence[str]) -> None:
    """Put the merged rows in the place of the old ones, which are whole partitions of the stored table."""
    spark = stored.sparkSession
    pending = _stage_change(merged, path)
    left = set(_partition_values(spark.read.schema(merged.schema).parquet(f"{pending}/rows"), partition))
    emptied = set(_partition_values(old, partition)) - left
    gone = _folders(stored.where(_in_partitions(stored, partition, emptied))) if emptied else []
    _decide_change(spark, pending, partition, gone)
    _finish_change(spark, path, pending)


def _stored(spark: SparkSession, path: str, like: DataFrame, partition: Sequence[str]) -> DataFrame:
    """The table; partition values are parsed from folder names, so they take the type of the new rows."""
    return spark.read.parquet(path).withColumns({p: F.col(p).cast(like.schema[p].dataType) for p in partition})


def upsert(df: DataFrame, path: str, keys: Sequence[str], partition: Sequence[str]) -> None:
    """New rows win over stored rows with the same key, also where the key has moved to another partition.

    Only partitions that the new rows or the old rows of their keys are in are
    read and rewritten; where partition columns are not part of the key, the old
    places are looked up in a read of keys and partition columns alone. A partition
    that loses its last row loses its folder; nothing else is touched. The change is
    written beside the table first: if the driver is lost on the way, the next
    write (or `recover`) finishes it, and before that the table is as it was, or
    holds some partitions of the change.
    """
    spark = df.sparkSession
    recover(spark, path)
    if not table_exists(spark, path):
        first = dedupe_by_key(df, keys, flag=None)
        overwrite_partitions(first, path, partition)
        return
    stored = _stored(spark, path, df, partition)
    touched = set(_partition_values(df, partition))
    if not set(partition) <= set(keys):
        places = stored.select(*dict.fromkeys([*keys, *partition]))
        new_keys = df.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys]
        touched |= set(_partition_values(places.join(new_keys, same, "left_semi"), partition))
    old = stored.where(_in_partitions(stored, partition, touched))
    rows = df.withColumn("_source", F.lit(1)).unionByName(old.withColumn("_source", F.lit(0)), allowMissingColumns=True)
    _publish(stored, path, old, dedupe_by_key(rows, keys, flag=None, order=[F.desc("_source")]).drop("_source"), partition)


def replace_dates(df: DataFrame, path: str, date_col: str, partition: Sequence[str], *, keys: Sequence[str] = ()) -> WriteReport | None:
    """Replace the rows of exactly the dates in the new rows; other dates stay, also in the same partition.

    The partition is coarser than the date and follows from it (a month). Rows
    without a date replace the stored rows without one.
    """
    spark = df.sparkSession
    recover(spark, path)
    if not table_exists(spark, path):
        return overwrite_partitions(df, path, partition, keys=keys)
    rows, report = watched_dedupe(df, keys) if keys else (df, lambda: None)
    rows = staged(rows, "replace-dates")
    stored = _stored(spark, path, rows, partition)
    old = stored.where(_in_partitions(stored, partition, _partition_values(rows, partition)))
    dates = rows.select(F.col(date_col).alias("_date")).distinct()
    rest = old.join(dates, F.col(date_col).eqNullSafe(F.col("_date")), "left_anti")
    _publish(stored, path, old, rows.unionByName(rest, allowMissingColumns=True), partition)
    return report()


def month_replace(df: DataFrame, path: str, date_col: str, month_col: str = "month") -> None:
    """Keep the last date of every month and replace that month's rows."""
    rows = df.withColumn(month_col, F.date_format(date_col, "yyyy-MM"))
    last = rows.groupBy(month_col).agg(F.max(date_col).alias("_last"))
    kept = rows.join(F.broadcast(last), month_col).where(F.col(date_col) == F.col("_last")).drop("_last")
    overwrite_partitions(kept, path, [month_col])


def last_slice_of_month(df: DataFrame, date_col: str, keys: Sequence[str] = ()) -> DataFrame:
    """Rows of the last date present in every month, per key when keys are given."""
    by = [*keys, "_m"]
    rows = df.withColumn("_m", F.trunc(date_col, "month"))
    last = rows.groupBy(*by).agg(F.max(date_col).alias(date_col))
    return rows.join(last, [*by, date_col], "left_semi").drop("_m")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def empty_table(spark: SparkSession, path: str) -> None:
    """Remove all rows and keep the schema."""
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def table_info(df: DataFrame) -> DataFrame:
    """Column names, types and the row count."""
    fields = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"))
            for i, f in enumerate(df.schema.fields, 1)
        ]
    )
    return df.agg(F.count("*").alias("row_count")).select(F.explode(fields).alias("_f"), "row_count").select("_f.*", "row_count")


def read_watermark(spark: SparkSession, state_path: str, table: str) -> date | None:
    """Last stored business date of one table; the state holds one row per table."""
    if not table_exists(spark, state_path):
        return None
    row = spark.read.parquet(state_path).where(F.col("table_name") == table).agg(F.max("biz_date").alias("d")).first()
    return row["d"]


def write_watermark(df: DataFrame, state_path: str, table: str, date_col: str) -> None:
    """Store the largest business date and the row count of a finished batch."""
    new = df.agg(F.max(date_col).alias("biz_date"), F.count("*").alias("last_rows")).where("biz_date is not null")
    overwrite_partitions(new.withColumn("table_name", F.lit(table)), state_path, ["table_name"])


def increment_start(watermark: date | None, today: date, *, fallback_days: int = 3) -> date:
    """The day after the watermark, or a few days back on the first run."""
    return watermark + timedelta(days=1) if watermark else today - timedelta(days=fallback_days)
