"""Exact Jaccard join of whole texts as a join in a metric space, and its components.

The Jaccard distance d = 1 - J is a metric; texts link at d <= r = 1/4. Unrelated
texts all lie at distance 1 from each other, where no pivot can tell them apart,
so the space is first cut into regions in which distances can be below 1: a pair
within r shares one of the first shingles of both in any fixed order (prefix
rule), and one region is kept for each such shingle. Inside the regions pivots
and the triangle inequality do the work:

* the first pivot of a region is compared with all its members; members near
  it form one component, and a region of one component is done;
* a region that is still large is cut into Voronoi cells of several pivots; a
  member is also copied to every cell whose pivot is at most 2r further than
  its nearest one, so that no pair is lost; cells are cut again in the same way;
* what a cut does not make smaller is dealt into cells for each pair of blocks;
* a cell of bounded size is joined inside one task: |d(x, p) - d(y, p)| > r, sizes
  and profiles rule pairs out, members with a pair left get their whole sets, and
  an inverted index of the cell counts what they have in common. A task returns
  the links that join components, fewer than the cell has members, never pairs.

The order of shingles puts frequent ones last. Frequencies come from a fixed
number of counters; a wrong count costs time, not results.
Texts with equal shingle sets are one class from the start. Shingles and classes
are 64-bit hashes (see the README for the odds of a clash).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm import tokens
from panelspark.llm.components import components
from panelspark.llm.stage import packed, staged, unpacked

SHINGLE = 5
COUNTERS = 1 << 20
#: Bins of a set's profile; sets beyond the size have none and are always compared.
BINS = 128
PROFILED = 10_000
#: Members, and shingles of all of them, that a cell joined in one task has at most (one longer text apart).
REGION = 2048
CELL_SHINGLES = 4_000_000
PIVOTS = 8
LEVELS = 6
#: Rows of (class, id) that are broadcast at most; more are joined by a shuffle.
BROADCAST_ROWS = 2_000_000
#: Members of a pivot that are compared with it in one task.
PART = 4096
#: Rows of up to four numbers that are broadcast at most.
SMALL_ROWS = 500_000


def _sets(words: tokens.Words, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one shingle."""
    w = words.hashes
    whole = tokens.folded([w[i : len(w) - size + 1 + i] for i in range(size)]) if len(w) >= size else w[:0]
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(whole[a : b - size + 1])
        elif b > a:
            yield tokens.folded([w[i : i + 1] for i in range(a, b)])
        else:
            yield w[:0]


def _slot(s: np.ndarray) -> np.ndarray:
    """The counter of each shingle."""
    return (s >> np.uint64(44)).astype(np.int64)


def _profile(s: np.ndarray) -> bytes | None:
    """How many shingles of a set fall into each bin. Two sets have at most the sum of the bins' smaller counts in common."""
    if len(s) > PROFILED:
        return None
    return np.minimum(np.bincount((s & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes()


def _digest(s: np.ndarray) -> int:
    """A 64-bit name of a set."""
    if not len(s):
        return 0
    total = np.array([tokens.mixed(s).sum(dtype=np.uint64), len(s)], np.uint64)
    return int(tokens.folded([total[:1], total[1:]]).view(np.int64)[0])


def _describe(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Per row: id, hash of the text, n, class and profile; at the end one row with this task's shingle counters."""
    counts, id_type = np.zeros(COUNTERS, np.int32), None
    names = ["_id", "_hash", "n", "c", "profile", "counts"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32())]
    for batch, data, offsets in tokens.blocks(batches, "_text"):
        sets = list(_sets(tokens.hashed_words(data, offsets, tokens.space_separated()), size))
        slots, n = np.unique(_slot(np.concatenate(sets)), return_counts=True)
        counts[slots] += n.astype(np.int32)
        ids, texts = (batch.column(batch.schema.get_field_index(x)) for x in ("_id", "_hash"))
        id_type = ids.type
        columns = ([len(s) for s in sets], [_digest(s) for s in sets], [_profile(s) for s in sets], [None] * len(sets))
        yield pa.RecordBatch.from_arrays([ids, texts, *map(pa.array, columns, kinds)], names=names)
    if id_type is not None:
        yield pa.RecordBatch.from_arrays([pa.nulls(1, id_type), pa.nulls(1, pa.int64()), *(pa.nulls(1, k) for k in kinds[:3]), pa.array([counts], kinds[3])], names=names)


def prefix_length(n: int) -> int:
    """So many first shingles of a set of n hold one of any partner's with J >= 3/4."""
    return n - (3 * n + 3) // 4 + 1


def _prefixes(batches: Iterator[pa.RecordBatch], size: int, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per class and task: n, class and the first shingles, rare ones first."""
    seen: set[int] = set()
    for _, data, offsets in tokens.blocks(batches, "_text"):
        n, c, firsts = [], [], []
        for s in _sets(tokens.hashed_words(data, offsets, tokens.space_separated()), size):
            name = _digest(s)
            if not len(s) or name in seen:
                continue
            seen.add(name)
            order = np.argsort(counts[_slot(s)], kind="stable")
            n.append(len(s))
            c.append(name)
            firsts.append(s[order[: prefix_length(len(s))]].view(np.int64))
        lengths = np.cumsum([0, *map(len, firsts)])
        flat = pa.array(np.concatenate(firsts) if firsts else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64()), pa.array(c, pa.int64()), pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), flat)], names=["n", "c", "first"])


def _whole_sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Class and shingles, once for each class and task, of the rows whose class is the wanted one."""
    seen: set[int] = set()
    for batch, data, offsets in tokens.blocks(batches, "_text"):
        wanted = batch.column(batch.schema.get_field_index("c")).to_pylist()
        c, sets = [], []
        for want, s in zip(wanted, _sets(tokens.hashed_words(data, offsets, tokens.space_separated()), size), strict=True):
            if want not in seen and _digest(s) == want:
                seen.add(want)
                c.append(want)
                sets.append(s.view(np.int64))
        lengths = np.cumsum([0, *map(len, sets)])
        flat = pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), flat)], names=["c", "shingles"])


def _near_sizes(n: Column, m: Column) -> Column:
    return F.least(n, m) * 4 >= F.greatest(n, m) * 3


def _may_link(n: Column, p: Column, m: Column, q: Column) -> Column:
    """Whether sets of n and m shingles can be within r when their first common one has places p and q."""
    return _near_sizes(n, m) & (F.least(n - p, m - q) * 7 >= (n + m) * 3)


def _link(common: Column, n: Column, m: Column) -> Column:
    """J >= 3/4, in whole numbers."""
    return common * 100 >= (n + m - common) * 75


def _may_reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b, p, q, n, m = (batch.column(batch.schema.get_field_index(x)) for x in ("a", "b", "_pa", "_pb", "_na", "_nb"))
        keep = np.ones(batch.num_rows, bool)
        both = np.flatnonzero(np.array([x and y for x, y in zip(p.is_valid().to_pylist(), q.is_valid().to_pylist(), strict=True)], bool))
        if len(both):
            x, y = (np.frombuffer(b"".join(v.take(pa.array(both)).to_pylist()), np.uint8).reshape(-1, BINS) for v in (p, q))
            most = np.where((x == 255) | (y == 255), 1 << 20, np.minimum(x, y)).sum(axis=1)
            size = n.to_numpy()[both] + m.to_numpy()[both]
            keep[both] = most * 175 >= size * 75
        yield pa.RecordBatch.from_arrays([a.filter(pa.array(keep)), b.filter(pa.array(keep))], names=["a", "b"])


class _Sets:
    """The whole shingle sets of classes, made from their texts when they are asked for."""

    def __init__(self, texts: DataFrame, classes: DataFrame, words: int):
        self.texts, self.classes, self.words = texts, classes, words
        self.profiles = staged(classes.groupBy("c").agg(F.first("profile").alias("profile"), F.first("n").alias("n")), "jaccard-profiles")

    def possible(self, pairs: DataFrame) -> DataFrame:
        """The pairs that can be within r by their profiles."""
        left, right = (self.profiles.select(F.col("c").alias(x), F.col("profile").alias(f"_p{x}"), F.col("n").alias(f"_n{x}")) for x in "ab")
        return pairs.join(left, "a").join(right, "b").select("a", "b", "_pa", "_pb", "_na", "_nb").mapInArrow(_may_reach, "a bigint, b bigint")

    def of(self, pairs: DataFrame) -> DataFrame:
        return self.named(pairs.select("a").union(pairs.select("b")).toDF("c").distinct())

    def named(self, wanted: DataFrame) -> DataFrame:
        named = staged(self.classes.join(wanted, "c", "left_semi").groupBy("c").agg(F.min("_id").alias("_id")), "jaccard-wanted")
        if named.count() <= BROADCAST_ROWS:
            named = F.broadcast(named)
        whole = self.texts.join(named, self.texts["_id"].eqNullSafe(named["_id"])).select("_text", "c")
        words = self.words
        return staged(whole.mapInArrow(lambda b: _whole_sets(b, words), "c bigint, shingles array<bigint>"), "jaccard-sets")


def _common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, common, n, m) from rows (b, part, a, shingles) in order, where a pivot's own set comes before its members'."""
    at, pivot = None, None
    for batch in batches:
        b, part, a = (batch.column(batch.schema.get_field_index(x)).to_numpy() for x in ("b", "part", "a"))
        sets = batch.column(batch.schema.get_field_index("shingles"))
        offsets, flat = sets.offsets.to_numpy(), sets.values.to_numpy()
        out = []
        for i in range(len(a)):
            mine = flat[offsets[i] : offsets[i + 1]]
            if at != (b[i], part[i]):
                at, pivot = (b[i], part[i]), np.sort(mine)
            else:
                found = pivot[np.minimum(np.searchsorted(pivot, mine), len(pivot) - 1)] == mine
                out.append((a[i], b[i], int(found.sum()), len(mine), len(pivot)))
        columns = np.array(out, np.int64).reshape(-1, 5).T
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a", "b", "common", "n", "m"])


def _distances(pairs: DataFrame, source: _Sets, far: bool = False) -> DataFrame:
    """(a, b, common, n, m) with a < b of distinct pairs of a member a and a pivot b, from their whole sets.

    Members' sets go to their pivot, whose own goes to each of its parts of about
    PART members. Pairs that cannot be within r have no row unless `far` asks for them.
    """
    pairs = staged(pairs, "jaccard-tried")
    if not far:
        pairs = staged(source.possible(pairs), "jaccard-pairs")
    sets = source.of(pairs)
    parts = staged(pairs.groupBy("b").agg(F.ceil(F.count("*") / PART).cast("long").alias("_parts")), "jaccard-parts")
    own = parts.select(F.col("b").alias("c"), "b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1)).alias("part"), F.lit(0).alias("_kind"))
    met = pairs.join(_sized(parts), "b").select(F.col("a").alias("c"), "b", F.pmod(F.xxhash64("a", F.lit(3)), F.col("_parts")).alias("part"), F.lit(1).alias("_kind"))
    wanted = staged(own.unionByName(met), "jaccard-met")
    rows = sets.join(_sized(wanted), "c").withColumnRenamed("c", "a").repartition("b", "part").sortWithinPartitions("b", "part", "_kind", "a")
    found = rows.select("b", "part", "a", "shingles").mapInArrow(_common, "a bigint, b bigint, common bigint, n bigint, m bigint")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "common", "n", "m").dropDuplicates(["a", "b"])


def _with_distance(distances: DataFrame) -> DataFrame:
    return distances.withColumn("d", 1 - F.col("common") / (F.col("n") + F.col("m") - F.col("common")))


def _sized(table: DataFrame) -> DataFrame:
    """A written table of a few numbers a row, broadcast when it has few rows; larger ones are joined by a shuffle."""
    return F.broadcast(table) if table.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else table


def _mixed_regions(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of regions that hold more than one component, each with its component k and the region's size.

    The one pair of a region of two has been compared with its pivot.
    """
    out = members.join(_sized(labels.select(F.col("node").alias("c"), F.col("component").alias("k"))), "c", "left")
    out = out.withColumn("k", F.coalesce("k", "c"))
    about = out.groupBy("s").agg(F.min("k").alias("_lo"), F.max("k").alias("_hi"), F.count("*").alias("members"), F.sum("n").alias("shingles"))
    return out.join(_sized(staged(about.where("_lo < _hi and members > 2").drop("_lo", "_hi"), "jaccard-mixed")), "s")


def _fits() -> Column:
    return (F.col("members") <= REGION) & (F.col("shingles") <= CELL_SHINGLES)


def _cells(regions: DataFrame) -> DataFrame:
    """Regions that fit as they are; the others as one cell for each pair of their blocks, about REGION members each."""
    many = F.greatest(F.ceil(F.col("members") * 2 / REGION), F.ceil(F.col("shingles") * 2 / CELL_SHINGLES)).cast("int")
    blocks = F.when(_fits(), 1).otherwise(F.greatest(many, F.lit(2)))
    own = F.pmod(F.xxhash64("c", F.lit(7)), F.col("_blocks").cast("long")).cast("int")
    dealt = regions.withColumn("_blocks", blocks).withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    cell = F.when(F.col("_blocks") == 1, F.col("s")).otherwise(F.xxhash64("s", F.least("_own", "_other"), F.greatest("_own", "_other")))
    return dealt.select(cell.alias("s"), "c", "n", "p", "d", "k")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Whole cells from rows sorted by s: a table and the rows of each cell in it."""
    carried = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if carried is None else pa.concat_tables([carried, table])
        if not table.num_rows:
            continue
        s = table["s"].to_numpy()
        edges = [0, *(np.flatnonzero(s[1:] != s[:-1]) + 1).tolist()]
        carried = table.slice(edges[-1])
        if len(edges) > 1:
            yield table.slice(0, edges[-1]).combine_chunks(), list(zip(edges[:-1], edges[1:], strict=True))
    if carried is not None and carried.num_rows:
        yield carried.combine_chunks(), [(0, carried.num_rows)]


def _in_cells(rows: DataFrame, join, schema: str) -> DataFrame:
    return rows.repartition("s").sortWithinPartitions("s").mapInArrow(join, schema)


def _merged(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels of groups after joining the groups of a and b, the smallest label of each."""
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        apart = low != high
        if not apart.any():
            return label
        to = np.arange(len(label))
        np.minimum.at(to, high[apart], low[apart])
        label = to[label]


def _undecided(n: np.ndarray, p: np.ndarray, d: np.ndarray, k: np.ndarray, profiles: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Groups of a cell's members, such that pairs of two components that nothing rules out are in one group; alone is a member without such a pair."""
    label = np.arange(len(n))
    step = max(1, 200_000 // len(n))
    for at in range(0, len(n), step):
        x = slice(at, at + step)
        small, large = np.minimum(n[x, None], n), np.maximum(n[x, None], n)
        fits = (k[x, None] != k) & (small * 4 >= large * 3) & (np.minimum((n - p)[x, None], n - p) * 7 >= (n[x, None] + n) * 3)
        fits &= ~(np.abs(d[x, None] - d) > 0.25 + 1e-9)  # an unknown distance rules nothing out
        i, j = np.nonzero(fits)
        i, j = i[i + at < j] + at, j[i + at < j]
        for c in range(0, len(i), 50_000):
            a, b = i[c : c + 50_000], j[c : c + 50_000]
            new = label[a] != label[b]
            a, b = a[new], b[new]
            u, v = profiles[a], profiles[b]
            least = np.minimum(u, v).sum(axis=1, dtype=np.int64)
            open_end = ((u == 255) | (v == 255)).any(axis=1) | ~known[a] | ~known[b]
            left = open_end | (least * 175 >= (n[a] + n[b]) * 75)
            label = _merged(label, a[left], b[left])
    return label


def _need_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(s, c, k) of the members that must be compared by their whole sets; s names the group, so regions that leave the same group name it alike."""
    for table, runs in _runs(batches):
        n, p, k, c = (table[x].to_numpy() for x in ("n", "p", "k", "c"))
        d = table["d"].to_numpy(zero_copy_only=False).astype(float)
        given = table["profile"].to_pylist()
        known = np.array([x is not None for x in given])
        profiles = np.frombuffer(b"".join(x if x is not None else bytes(BINS) for x in given), np.uint8).reshape(-1, BINS)
        label = np.concatenate([a + _undecided(n[a:z], p[a:z], d[a:z], k[a:z], profiles[a:z], known[a:z]) for a, z in runs])
        size, total = np.bincount(label, minlength=len(c)), np.zeros(len(c), np.uint64)
        np.add.at(total, label, tokens.mixed(c.view(np.uint64)))
        name = tokens.folded([total, size.astype(np.uint64)]).view(np.int64)
        keep = np.flatnonzero(size[label] > 1)
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (name[label[keep]], c[keep], k[keep])], names=["s", "c", "k"])


def _spanning_links(sets: pa.ListArray, k: np.ndarray) -> list[tuple[int, int]]:
    """Links within r between members of a cell that join its components, each component once."""
    n = np.diff(sets.offsets.to_numpy())
    _, shingle = np.unique(sets.flatten().to_numpy(), return_inverse=True)
    owner = np.repeat(np.arange(len(n)), n)
    order = np.argsort(shingle, kind="stable")
    postings, first = owner[order], np.concatenate([[0], np.cumsum(np.bincount(shingle))])
    at, links, root = np.concatenate([[0], np.cumsum(n)]), [], np.unique(k, return_inverse=True)[1]
    for x in range(len(n)):
        other = root != root[x]
        other[:x] = False
        if not other.any():
            continue
        mine = shingle[at[x] : at[x + 1]]
        lengths = first[mine + 1] - first[mine]
        place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        common = np.bincount(postings[np.repeat(first[mine], lengths) + place], minlength=len(n))
        for y in np.flatnonzero(other & (common * 100 >= (n[x] + n - common) * 75)).tolist():
            if root[x] != root[y]:
                links.append((x, y))
                root[root == root[y]] = root[x]
    return links


def _join_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, runs in _runs(batches):
        c, k, sets = table["c"].to_numpy(), table["k"].to_numpy(), table["shingles"]
        found = [(c[a + x], c[a + y]) for a, z in runs for x, y in _spanning_links(sets.slice(a, z - a).combine_chunks(), k[a:z])]
        u, v = np.array(found, np.int64).reshape(-1, 2).T
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _cell_links(regions: DataFrame, sets: _Sets) -> DataFrame:
    """(u, v): links between the components of each region that bring all its classes within r together."""
    cells = _cells(regions)
    wanted = staged(cells.select("c").distinct(), "jaccard-undecided")
    cells = cells.join(sets.profiles.select("c", "profile").join(_sized(wanted), "c", "left_semi"), "c")
    needed = staged(_in_cells(cells, _need_sets, "s bigint, c bigint, k bigint").distinct(), "jaccard-needed")
    cells = _joined_groups(needed, sets)
    whole = sets.named(cells.select("c").distinct()).join(_sized(cells), "c").select("s", "c", "k", "shingles")
    return _in_cells(whole, _join_cells, "u bigint, v bigint")


def _joined_groups(needed: DataFrame, sets: _Sets) -> DataFrame:
    """(s, c, k) with groups that share members made one cell where it fits, so that a set is sent to one cell and not to every group it is in."""
    first = needed.groupBy("s").agg(F.min("c").alias("v"))
    together = staged(components(needed.join(first, "s").select(F.col("c").alias("u"), "v")), "jaccard-together")
    once = needed.select("c", "k").distinct().join(_sized(together).withColumnRenamed("node", "c"), "c")
    size = once.join(sets.profiles.select("c", "n"), "c").groupBy("component").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    fits = staged(size.where(_fits()).select("component"), "jaccard-fits")
    whole = once.join(_sized(fits), "component", "left_semi").select(F.col("component").alias("s"), "c", "k")
    apart = _sized(together).join(_sized(fits), "component", "left_anti").select(F.col("node").alias("c"))
    return staged(whole.unionByName(needed.join(apart, "c", "left_semi").select("s", "c", "k")), "jaccard-sent")


def _pairs_of(rows: DataFrame, member: str, pivot: str) -> DataFrame:
    return rows.where(F.col(member) != F.col(pivot)).select(F.col(member).alias("a"), F.col(pivot).alias("b")).distinct()


def _cut(large: DataFrame, sets: _Sets, level: int) -> tuple[DataFrame, DataFrame]:
    """Voronoi cells of large regions, and the links found on the way.

    A region's pivots are half its most connected members, half members with the
    smallest hashes, so regions that overlap share pivots and their comparisons.
    """
    pick = F.xxhash64("c", F.lit(level))
    drawn = large.withColumn("_x", F.when(F.pmod(pick, F.lit(2)) == 0, F.col("weight")).otherwise(0))
    rank = F.row_number().over(Window.partitionBy("s").orderBy(F.desc("_x"), pick, "c"))
    pivots = drawn.select("s", "c", rank.alias("_r")).where(F.col("_r") <= PIVOTS).select("s", F.col("c").alias("v"))
    met = large.join(pivots, "s")  # PIVOTS rows for each member
    # cells and windows need the distances beyond r as well
    known = staged(_with_distance(_distances(_pairs_of(met, "c", "v"), sets, far=True)), "jaccard-pivots")
    links = known.where(_link(F.col("common"), F.col("n"), F.col("m"))).select(F.col("a").alias("u"), F.col("b").alias("v"))
    keyed = met.withColumns({"a": F.least("c", "v"), "b": F.greatest("c", "v")}).drop("d")
    far = keyed.join(known.select("a", "b", "d"), ["a", "b"], "left").withColumn("d", F.when(F.col("c") == F.col("v"), 0.0).otherwise(F.col("d")))
    nearest = F.min("d").over(Window.partitionBy("s", "c"))
    cells = far.withColumn("_near", nearest).where("d <= _near + 0.5 + 1e-9")
    cells = cells.withColumn("_parent", F.col("members")).withColumn("s", F.xxhash64("s", "v"))
    return staged(cells.select("s", "c", "n", "p", "d", "weight", "_parent"), "jaccard-cells"), links


def _all_links(members: DataFrame, sets: _Sets) -> DataFrame:
    """Links (u, v) that join all classes within r into the right components."""
    weight = members.groupBy("c").agg(F.sum("met").alias("weight"))  # in how many regions with how many others
    pivot = F.max(F.struct("weight", F.xxhash64("c").alias("h"), "c", "n", "p")).over(Window.partitionBy("s"))
    star = members.join(weight, "c").withColumn("_v", pivot).select("s", "c", "n", "p", "weight", F.col("_v.c").alias("v"), F.col("_v.n").alias("vn"), F.col("_v.p").alias("vp"))
    star = staged(star, "jaccard-members")
    tried = star.where(_may_link(F.col("n"), F.col("p"), F.col("vn"), F.col("vp")))
    known = staged(_with_distance(_distances(_pairs_of(tried, "c", "v"), sets)), "jaccard-stars")
    links = known.where(_link(F.col("common"), F.col("n"), F.col("m"))).select(F.col("a").alias("u"), F.col("b").alias("v"))
    labels = staged(components(links), "jaccard-labels")
    keyed = star.withColumns({"a": F.least("c", "v"), "b": F.greatest("c", "v")})
    rows = keyed.join(_sized(known.select("a", "b", "d")), ["a", "b"], "left").withColumn("d", F.when(F.col("c") == F.col("v"), 0.0).otherwise(F.col("d")))
    left = staged(_mixed_regions(rows.select("s", "c", "n", "p", "d", "weight"), labels), "jaccard-left")
    done, large = [left.where(_fits())], left.where(~_fits())
    for level in range(LEVELS):
        if large.isEmpty():
            break
        cells, more = _cut(large, sets, level)
        links = staged(links.unionByName(more).distinct(), "jaccard-links")
        labels = staged(components(links), "jaccard-labels")
        parents = cells.groupBy("s").agg(F.max("_parent").alias("_parent"))
        left = staged(_mixed_regions(cells.select("s", "c", "n", "p", "d", "weight"), labels).join(parents, "s"), "jaccard-left")
        stuck = (F.col("members") * 10 > F.col("_parent") * 9) | F.lit(level + 1 == LEVELS)
        done.append(left.where(_fits() | stuck).drop("_parent"))
        large = left.where(~(_fits() | stuck)).drop("_parent")
    rest = done[0]
    for r in done[1:]:
        rest = rest.unionByName(r)
    return links.unionByName(_cell_links(rest, sets))


def _rows(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """Per row: _id, _hash of its text, n and the component _k, which is NULL without shingles."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    id_type = texts.schema["_id"].dataType.simpleString()
    hashed = texts.withColumn("_hash", F.xxhash64("_text"))
    base = staged(hashed.mapInArrow(lambda b: _describe(b, words), f"_id {id_type}, _hash bigint, n bigint, c bigint, profile binary, counts array<int>"), "jaccard-classes")
    counters = base.where("counts is not null").select(F.posexplode("counts").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x"))
    table = counters.toArrow()  # COUNTERS rows at most, whatever the input
    counts = np.zeros(COUNTERS, np.int64)
    counts[table["i"].to_numpy()] = table["x"].to_numpy()
    shared = spark.sparkContext.broadcast(counts)
    firsts = texts.select("_text").mapInArrow(lambda b: _prefixes(b, words, shared.value), "n bigint, c bigint, first array<bigint>")
    postings = firsts.select("n", "c", F.posexplode("first").alias("p", "s"))
    by_shingle = Window.partitionBy("s")
    edge = F.min(F.col("p") * 7 - F.col("n"))  # the smaller set of a pair has its first common shingle in the first seventh
    over = {"_lo": F.min("c").over(by_shingle), "_hi": F.max("c").over(by_shingle), "_edge": edge.over(by_shingle)}
    met = postings.withColumns(over).where("_lo < _hi and _edge <= 0")
    once = met.select("s", "c", "n", F.col("p").cast("long").alias("p")).dropDuplicates(["s", "c"])
    members = staged(once.withColumn("met", F.count("*").over(by_shingle) - 1), "jaccard-regions")
    sets = _Sets(texts, base.where("n > 0"), words)
    labels = staged(components(_all_links(members, sets)), "jaccard-components")
    rows = base.where("n is not null").select("_id", "_hash", "n", F.when(F.col("n") > 0, F.col("c")).alias("c"))
    rows = rows.join(labels.withColumnRenamed("node", "c"), "c", "left").withColumn("_k", F.coalesce("component", "c")).select("_id", "_hash", "n", "_k")
    return staged(rows, "jaccard-rows")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """Per row: id, n_shingles and component_id, the smallest id reachable over links of J >= 3/4.

    NULL or empty text has no shingles, links with nothing and is its own
    component; a text of fewer than `words` words is one shingle; repeated rows
    and copies are one class and share their component; a NULL id stays NULL and
    does not name a component unless all its ids are NULL; an empty table gives an
    empty result. Other columns are not read.
    """
    rows = _rows(docs, id_col, text_col, words)
    least = rows.where("_k is not null").groupBy("_k").agg(F.min("_id").alias("_least"))
    out = rows.join(least, "_k", "left")
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("_k").isNull(), F.col("_id")).otherwise(F.col("_least")).alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """The documents with one row of each component left, the one with the smallest id; all own columns.

    A row is named by its id and its text's hash, so rows of one id, or without
    id, are told apart; rows alike in both are one. A NULL id comes after all
    others. Rows without shingles stay, one of each id and text.
    """
    rows = _rows(docs, id_col, text_col, words)
    first = rows.where("_k is not null").groupBy("_k").agg(F.min(F.struct(F.col("_id").isNull().alias("_none"), "_id", "_hash")).alias("_first"))
    copies = rows.join(first, "_k").where(~(F.col("_id").eqNullSafe(F.col("_first._id")) & (F.col("_hash") == F.col("_first._hash"))))
    whole = packed(docs, _id=id_col, _text=text_col).withColumn("_hash", F.xxhash64("_text"))
    row_is = lambda names: F.col("_id").eqNullSafe(F.col(names[0])) & (F.col("_hash") == F.col(names[1]))
    gone = copies.select(F.col("_id").alias("_gone"), F.col("_hash").alias("_gone_text")).distinct()
    again = rows.groupBy("_id", "_hash").count().where("count > 1").select(F.col("_id").alias("_again"), F.col("_hash").alias("_again_text"))
    kept = whole.join(gone, row_is(["_gone", "_gone_text"]), "left_anti")
    once = kept.join(again, row_is(["_again", "_again_text"]), "left_anti")
    more = kept.join(again, row_is(["_again", "_again_text"]), "left_semi").dropDuplicates(["_id", "_text"])
    return unpacked(once.unionByName(more), docs)
