"""Schema rules: inference by name and content, declared types, comparison, conforming."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.dates import parse_date

# Columns that stay text whatever they hold.
CODE_COLUMNS = set(
    "ts_code con_code index_code symbol report_type comp_type end_type div_proc suspend_type type type_name "
    "list_status is_hs is_pub is_new src market exchange curr_type update_flag".split()
)
NAME_COLUMNS = set(
    "name fullname enname cnspell area industry act_name act_ent_type benchmark management custodian invest_type "
    "fund_type publisher category index_type weight_rule l1_name l2_name l3_name industry_name parent_code "
    "industry_code l1_code l2_code l3_code desc suspend_timing".split()
)
SHORTHAND = {
    **dict.fromkeys(["string", "str", "text"], T.StringType()),
    **dict.fromkeys(["int", "integer", "bigint"], T.LongType()),
    **dict.fromkeys(["float", "double", "decimal"], T.DoubleType()),
    **dict.fromkeys(["bool", "boolean"], T.IntegerType()),
    "date": T.DateType(),
    **dict.fromkeys(["datetime", "timestamp"], T.TimestampNTZType()),
}


def is_date_name(name: str) -> bool:
    n = name.lower()
    return "_date" in n or n.startswith("date_")


def is_text_name(name: str) -> bool:
    n = name.lower()
    return n in CODE_COLUMNS or n in NAME_COLUMNS or n.endswith(("_name", "_code", "_flag"))


@dataclass(frozen=True)
class DatasetSpec:
    """What a dataset promises: key columns, time column, partition column and declared types in order.

    `partition_format` says how the partition follows from the time (yyyy-MM);
    without it any partition value is right that is not NULL.
    """

    name: str
    keys: tuple[str, ...]
    time: str
    partition: str
    columns: dict[str, str] = field(default_factory=dict)
    partition_format: str | None = None

    @property
    def schema(self) -> T.StructType:
        return declared_schema(self.columns)


def declared_schema(columns: dict[str, str]) -> T.StructType:
    """Shorthand types to a schema; text columns with a date name become dates."""
    fields = []
    for name, kind in columns.items():
        k = kind.lower().strip()
        dtype = SHORTHAND[k]
        if isinstance(dtype, T.StringType) and is_date_name(name):
            dtype = T.DateType()
        fields.append(T.StructField(name, dtype))
    return T.StructType(fields)


def _declared_type(f: T.StructField) -> str | None:
    d = f.dataType
    if is_date_name(f.name):
        return "date"
    if isinstance(d, (T.IntegralType,)):
        return "bigint"
    if isinstance(d, (T.FractionalType,)):
        return "double"
    if isinstance(d, T.BooleanType):
        return "int"
    if isinstance(d, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp_ntz"
    if isinstance(d, T.DateType):
        return "date"
    return "string" if is_text_name(f.name) else None


def infer_schema(df: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """Long table (position, column, type) by override, name rule, type, and content.

    An unknown text column is double when all its values parse as numbers or it
    is empty, else text. All columns are probed in one aggregate.
    """
    overrides = overrides or {}
    known = {f.name: overrides.get(f.name) or _declared_type(f) for f in df.schema.fields}
    probe = [c for c, t in known.items() if t is None]
    bad = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c) for c in probe]
    counts = df.agg(F.count("*").alias("_rows"), *bad)
    items = []
    for i, (c, t) in enumerate(known.items(), 1):
        kind = F.lit(t) if t else F.when(F.col(c) == 0, "double").otherwise("string")
        items.append(F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"), kind.alias("type")))
    return counts.select(F.explode(F.array(*items)).alias("_f")).select("_f.*")


def schema_diff(existing: T.StructType, new: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, change, old type, new type) with change added, missing or type_mismatch; names ignore case."""
    old = {f.name.lower(): f for f in existing.fields}
    fresh = {f.name.lower(): f for f in new.fields}
    out = []
    for k, f in fresh.items():
        if k not in old:
            out.append((f.name, "added", None, f.dataType.simpleString()))
        elif old[k].dataType != f.dataType:
            out.append((f.name, "type_mismatch", old[k].dataType.simpleString(), f.dataType.simpleString()))
    out += [(f.name, "missing", f.dataType.simpleString(), None) for k, f in old.items() if k not in fresh]
    return out


def evolve(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Stored rows and new rows under one schema: added columns are NULL before, dropped ones are kept."""
    kinds = {f.name: f.dataType for f in existing.schema.fields}
    aligned = new.select(
        *[F.col(c).try_cast(kinds[c]).alias(c) if c in kinds and kinds[c] != new.schema[c].dataType else F.col(c) for c in new.columns]
    )
    return existing.unionByName(aligned, allowMissingColumns=True)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns in declared order and type; missing ones are NULL."""
    out = []
    for f in schema.fields:
        if f.name not in df.columns:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.DateType) and isinstance(df.schema[f.name].dataType, T.StringType):
            out.append(parse_date(f.name).alias(f.name))
        else:
            out.append(F.col(f.name).cast(f.dataType).alias(f.name))
    return df.select(*out)


def declared_against_actual(df: DataFrame, declared: Sequence[str]) -> dict[str, list[str]]:
    actual = set(df.columns)
    return {
        "not_in_table": sorted(set(declared) - actual),
        "not_declared": sorted(actual - set(declared)),
    }
