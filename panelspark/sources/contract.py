"""Writes that hold a dataset to what it declares."""

from __future__ import annotations

from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from panelspark.operators.schema import DatasetSpec, conform, declared_against_actual
from panelspark.sources import sinks
from panelspark.sources.sinks import WriteReport


@dataclass(frozen=True)
class ContractReport:
    """Violations by rule with their number of columns or rows, and what the write has seen of keys."""

    dataset: str
    violations: dict[str, int]
    written: WriteReport | None = None


class ContractViolation(ValueError):
    """A refused write; the stored table is as it was."""

    def __init__(self, report: ContractReport):
        super().__init__(f"{report.dataset}: " + ", ".join(f"{rule} ({n})" for rule, n in report.violations.items()))
        self.report = report


def schema_violations(df: DataFrame, spec: DatasetSpec) -> dict[str, int]:
    """What the columns alone show: missing, undeclared, of another type, in another order."""
    declared = spec.schema
    found = declared_against_actual(df, declared.names)
    types = [f.name for f in declared.fields if f.name in df.columns and df.schema[f.name].dataType != f.dataType]
    shared = [c for c in df.columns if c in declared.names]
    out = {f"missing column {c}": 1 for c in found["not_in_table"]}
    out |= {f"undeclared column {c}": 1 for c in found["not_declared"]}
    out |= {f"type of {c}": 1 for c in types}
    if shared != [c for c in declared.names if c in df.columns]:
        out["order of columns"] = 1
    return out


def write_dataset(df: DataFrame, path: str, spec: DatasetSpec, *, strict: bool = True, whole: bool = False) -> ContractReport:
    """Write a dataset by its declaration and count what breaks it while writing.

    Rules: the declared columns, types and order; no NULL in key, time or
    partition; keys come once; the partition follows from the time. A strict write
    with a violation is refused: rows are first written beside the table, and it
    changes only after they have been counted. Otherwise columns are brought to the
    declaration, one row of each key stays, and the report says what was found.
    The partitions in the rows are replaced; with `whole` all others go.
    """
    spark = df.sparkSession
    sinks.recover(spark, path)
    violations = schema_violations(df, spec)
    lost = [c for c in {*spec.keys, spec.time, spec.partition} if c not in df.columns]
    if lost or (strict and violations):
        raise ContractViolation(ContractReport(spec.name, violations))
    rows = conform(df, spec.schema)
    rules = {f"NULL in {c}": F.col(c).isNull() for c in dict.fromkeys([*spec.keys, spec.time, spec.partition])}
    if spec.partition_format:
        follows = F.col(spec.partition).cast("string").eqNullSafe(F.date_format(spec.time, spec.partition_format))
        rules[f"{spec.partition} does not follow from {spec.time}"] = F.col(spec.time).isNotNull() & ~follows
    seen = Observation()
    rows = rows.observe(seen, *[F.count_if(c).alias(f"rule_{i}") for i, c in enumerate(rules.values())])
    once, report = sinks.watched_dedupe(rows, spec.keys)
    pending = sinks._stage_change(once, path)
    written = report()
    try:
        counts = seen.get
    except Py4JJavaError:  # no rows, no counts
        counts = {}
    violations |= {rule: n for i, rule in enumerate(rules) if (n := counts.get(f"rule_{i}"))}
    if written.repeated_keys:
        violations["repeated keys"] = written.repeated_keys
    result = ContractReport(spec.name, violations, written)
    if strict and violations:
        sinks._delete(spark, pending)
        raise ContractViolation(result)
    gone = []
    if whole and sinks.table_exists(spark, path):
        stored = sinks._stored(spark, path, once, [spec.partition])
        left = set(sinks._partition_values(spark.read.schema(once.schema).parquet(f"{pending}/rows"), [spec.partition]))
        emptied = set(sinks._partition_values(stored, [spec.partition])) - left
        gone = sinks._folders(stored.where(sinks._in_partitions(stored, [spec.partition], emptied))) if emptied else []
    sinks._decide_change(spark, pending, [spec.partition], gone)
    sinks._finish_change(spark, path, pending)
    return result
