"""Shards by a hierarchical weighted hash tree, in DataFrame functions only.

A tree of regions, racks and shards is walked from the root. At each level every
child draws ln(u) / weight with u hashed from the document id and the child's
name, and the largest draw wins (the weighted hash draw). A draw depends on
nothing but id, name and weight, so a change of weights below one child moves
rows only into or out of that child's subtree.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.stage import column, free_name, refuse_clash, staged

#: Rows that one numbering bin should hold.
BIN_ROWS = 50_000


@dataclass(frozen=True)
class Shard:
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def tree(shards: int, base: int = 40, racks: int = 2, per_rack: int = 5) -> tuple[Shard, ...]:
    """The default tree of so many equal shards.

    The first `base` shards fill regions of `racks` racks of `per_rack` shards.
    Every further shard stands in a region of its own, so that adding it changes
    one weight at the root and rows move only into the new shard.
    """
    out = []
    for s in range(shards):
        if s < base:
            region = s // (racks * per_rack)
            out.append(Shard(f"g{region}", f"g{region}/k{s // per_rack % racks}", s))
        else:
            out.append(Shard(f"x{s}", f"x{s}/k0", s))
    return tuple(out)


def _child(name: str, weight: float, value: int) -> Column:
    return F.struct(F.lit(name).alias("name"), F.lit(float(weight)).alias("weight"), F.lit(value).alias("value"))


def _descend(key: Column, children: Column) -> Column:
    """The value of the child with the largest draw ln(u)/weight, u from 52 bits of the hash of key and name.

    Equal draws go to the larger value.
    """

    def draw(child: Column) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.concat_ws("|", key, child["name"])), 12)
        u = (bits.cast("double") + 0.5) / F.lit(float(1 << 52))
        return F.struct((F.log(u) / child["weight"]).alias("draw"), child["value"].alias("value"))

    return F.array_max(F.transform(children, draw))["value"]


def _pick(df: DataFrame, key: Column, topology: Sequence[Shard], name: str) -> DataFrame:
    """Add the shard of `key`, one level of the tree after the other. The tree is a constant of the plan."""
    live = [s for s in topology if s.weight > 0]
    if not live:
        raise ValueError("the tree has no shard of positive weight")
    regions, racks = sorted({s.region for s in live}), sorted({s.rack for s in live})
    below = lambda level, x: sum(s.weight for s in live if getattr(s, level) == x)
    top = F.array(*[_child(r, below("region", r), i) for i, r in enumerate(regions)])
    of_region = F.array(*[F.array(*[_child(k, below("rack", k), racks.index(k)) for k in sorted({s.rack for s in live if s.region == r})]) for r in regions])
    of_rack = F.array(*[F.array(*[_child(f"{k}/{s.shard}", s.weight, s.shard) for s in live if s.rack == k]) for k in racks])
    region = free_name(df, "_region")
    out = df.withColumn(region, _descend(key, top))
    rack = free_name(out, "_rack")
    out = out.withColumn(rack, _descend(key, F.get(of_region, column(region))))
    return out.withColumn(name, _descend(key, F.get(of_rack, column(rack))).cast("int")).drop(region, rack)


def place(df: DataFrame, topology: Sequence[Shard], id_col: str = "doc_id", name: str = "shard") -> DataFrame:
    """All rows with their shard in column `name`; no shuffle. A NULL id is a key of its own.

    The result can be written with partitionBy(name). A column that has the
    result's name is an error.
    """
    refuse_clash(df.columns, [name])
    return _pick(df, F.coalesce(F.col(id_col).cast("string"), F.lit("null")), topology, name)


def manifest(
    df: DataFrame, topology: Sequence[Shard], grown: Sequence[Shard] | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id, size (UTF-8 bytes + 16), text_crc32, law 'key', shard, slot, grown_shard.

    Slots number the rows of a shard from 0 without gaps. Equal (id, size, crc)
    rows are counted before the shuffle and numbered as one run, and a shard is
    numbered in bins of about BIN_ROWS rows with offsets from the bins' counts,
    so neither copies of one row nor a whole shard meet in one task.
    NULL text has size 16 and the crc of no bytes; an empty table gives an empty
    result; other columns are not carried (see `place`).
    """
    raw = F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b""))
    rows = df.select(F.col(id_col).alias("doc_id"), (F.octet_length(raw) + F.lit(16)).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    counted = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("_copies"))
    counted = place(counted, topology)
    counted = place(counted, grown, name="grown_shard") if grown else counted.withColumn("grown_shard", F.lit(None).cast("int"))
    counted = staged(counted, "shard-rows")
    total = counted.count()
    bins = max(1, -(-total // (BIN_ROWS * len(topology))))
    binned = counted.withColumn("_bin", F.pmod(F.xxhash64("doc_id", "size", "text_crc32", F.lit(7)), F.lit(bins)))
    by_shard = _window("shard", "_bin")
    # one row per shard and bin: as many as the bins, which hold BIN_ROWS rows each
    ends = binned.groupBy("shard", "_bin").agg(F.sum("_copies").alias("_n"))
    starts = ends.withColumn("_start", F.sum("_n").over(by_shard) - F.col("_n")).drop("_n")
    within = _window(["shard", "_bin"], "doc_id", "size", "text_crc32")
    out = (
        binned.join(starts, ["shard", "_bin"])
        .withColumn("_first", F.col("_start") + F.sum("_copies").over(within) - F.col("_copies"))
        .withColumn("slot", F.explode(F.sequence(F.col("_first"), F.col("_first") + F.col("_copies") - 1)))
    )
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def _window(parts, *order):
    from pyspark.sql import Window

    return Window.partitionBy(parts).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
