"""Intermediate tables of the text operators, written to the shared folder of the cluster."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.session import scratch_dir


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the folder named by spark.checkpoint.dir and read back.

    Lineage ends at the written copy, which survives lost executors.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_documents(spark, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def column(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(docs: DataFrame, **read: str) -> DataFrame:
    """All own columns as one struct `_row` beside those that an operator reads under its own names, so that no name can clash."""
    return docs.select(F.struct(*map(column, docs.columns)).alias("_row"), *[column(c).alias(name) for name, c in read.items()])


def unpacked(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The own columns of `docs` again, under their names."""
    return df.select(*[F.col("_row")[c].alias(c) for c in docs.columns])


def refuse_clash(names, results) -> None:
    """Columns that would bear a result's name twice are an error."""
    clash = {n.lower() for n in names} & {r.lower() for r in results}
    if clash:
        raise ValueError(f"columns have the names of results: {', '.join(sorted(clash))}")


def free_name(df: DataFrame, name: str) -> str:
    """The name with as many underscores as make it new."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
