"""Hard negatives by threshold joins with an index cut short by norms, after L2AP.

Every anchor asks for the pairs whose inner product reaches its own threshold:

* a block of rows is indexed dimension by dimension, strong ones first, but a row
  only until the norm of what is left of it is too small to reach any threshold by
  itself. A pair that meets in no indexed dimension cannot reach its threshold;
* the index is read for all anchors of a block, adding up partial scores. A pair is
  dropped as soon as its partial score and the product of the remaining norms stay
  below the threshold (or surely end above all wanted scores);
* what is left is finished with the dimensions that the index left out.

Thresholds begin where a bounded sample of rows (SAMPLE) lets one expect enough
partners. Anchors whose windows do not fill lower theirs and ask again, in the end
down to the lower edge of the window, so the sample decides on time, not on results.
First come the positives, then the negatives in the windows below their scores.

Rows stay where they are; the anchors, a part of the rows that the caller names, go
to them in blocks of at most about ANCHORS. A task sends on only the best rows of
each anchor or window, so what is shuffled does not depend on how many rows qualify.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.stage import staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 3
#: Window of a negative's score in percent of the positive's.
LOW, HIGH = 50, 95
#: Anchors that are broadcast at once, and anchors and rows that a task multiplies at once.
ANCHORS, TILE, ROWS = 16_384, 1024, 4096
#: Rows that starting thresholds are read off, partners that they shall let through, and how much more each lower one.
SAMPLE, WANTED, LOWER = 2048, 24, 8
#: Dimensions that are added up between two looks at the bounds.
STEP = 8
#: Share of surviving pairs from which finishing whole blocks is cheaper than single pairs.
DENSE = 0.1
#: Whole numbers of doubles and of comparisons in 64 bits (scores are multiplied by 20 at most).
EXACT, LARGEST = 2.0**53, 2.0**63 / 20


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of a list column; shorter ones are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), np.int64)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _norms(x: np.ndarray) -> np.ndarray:
    """Per row the norms of what is left from each step on, rounded up."""
    squares = np.add.reduceat(x * x, np.arange(0, x.shape[1], STEP), axis=1) if x.shape[1] else np.zeros((len(x), 0))
    left = np.cumsum(squares[:, ::-1], axis=1)[:, ::-1]
    return np.sqrt(np.concatenate([left, np.zeros((len(x), 1))], axis=1)) * (1 + 1e-9)


@dataclass
class Anchors:
    """A block of anchors with their thresholds and, for negatives, their windows."""

    x: np.ndarray  # components in the order of the index
    row: np.ndarray
    id: np.ndarray
    label: np.ndarray
    least: np.ndarray  # threshold
    most: np.ndarray  # scores above are not wanted
    positive: np.ndarray | None = None  # (anchors, POSITIVES) ids, scores and whether the window is still open
    score: np.ndarray | None = None
    open: np.ndarray | None = None
    norms: np.ndarray = field(init=False)

    def __post_init__(self):
        self.norms = _norms(self.x)


@dataclass
class Space:
    """What all blocks share: dimensions in the order of the index, and whether doubles hold every score."""

    order: np.ndarray
    exact: bool
    slack: float


def _pairs(x: np.ndarray, a: np.ndarray, xn: np.ndarray, an: np.ndarray, least: np.ndarray, most: np.ndarray, wanted: np.ndarray, space: Space) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, score) of the wanted pairs whose score is at least the anchor's threshold."""
    steps = xn.shape[1] - 1
    reach = least - space.slack
    with np.errstate(divide="ignore", invalid="ignore"):
        cover = np.where((reach <= 0).any(), 0.0, np.min(np.where(an[:, :steps] > 0, reach[:, None] / an[:, :steps], np.inf), axis=0, initial=np.inf))
    indexed = (xn[:, :steps] >= cover).sum(axis=1)  # norms fall and covers rise from step to step
    if (reach <= 0).any() and steps == 0:
        indexed[:] = 0
    rows = np.argsort(-indexed, kind="stable")
    if not (reach <= 0).any():
        rows = rows[indexed[rows] > 0]
    depth = indexed[rows]
    partial = np.zeros((len(rows), len(a)))
    for s in range(steps):
        n = int(np.searchsorted(-depth, -s, side="left"))  # rows with an entry in this step's lists
        if not n:
            break
        cut = slice(s * STEP, (s + 1) * STEP)
        partial[:n] += x[rows[:n], cut] @ a[:, cut].T
        left = xn[rows[:n], s + 1, None] * an[:, s + 1]
        alive = ((partial[:n] + left >= reach) & (partial[:n] - left <= most + space.slack) & wanted[rows[:n]]).any(axis=1)
        if alive.sum() < 0.7 * n:
            keep = np.concatenate([alive, np.ones(len(rows) - n, bool)])
            rows, depth, partial = rows[keep], depth[keep], partial[keep]
    left = xn[rows, depth][:, None] * an.T[depth]
    i, j = np.nonzero((partial + left >= reach) & (partial - left <= most + space.slack) & wanted[rows])
    if not len(i):
        return i, j, np.zeros(0, np.int64)
    if not space.exact:
        xi, ai = x.astype(np.int64), a.astype(np.int64)
        score = np.concatenate([(xi[rows[i[k : k + 65536]]] * ai[j[k : k + 65536]]).sum(axis=1) for k in range(0, len(i), 65536)])
    elif len(i) > DENSE * partial.size:
        score = (x[rows] @ a.T)[i, j].astype(np.int64)
    else:
        score = partial[i, j]
        for s in range(int(depth.min()), steps):
            late = np.flatnonzero(depth[i] <= s)
            cut = slice(s * STEP, (s + 1) * STEP)
            score[late] += np.einsum("ij,ij->i", x[rows[i[late]], cut], a[j[late], cut])
            rest = xn[rows[i], np.maximum(depth[i], s + 1)] * an[j, np.maximum(depth[i], s + 1)]
            keep = score + rest >= reach[j]
            i, j, score = i[keep], j[keep], score[keep]
        score = score.astype(np.int64)
    keep = (score >= least[j]) & (score <= most[j])
    return rows[i[keep]], j[keep], score[keep]


def _first(found: np.ndarray, k: int) -> np.ndarray:
    """The first k rows of each key: highest score, then smallest id. Columns: key, score, id."""
    found = found[np.lexsort((found[:, 2], -found[:, 1], found[:, 0]))]
    start = np.flatnonzero(np.diff(found[:, 0], prepend=np.nan))
    rank = np.arange(len(found)) - np.repeat(start, np.diff([*start, len(found)]))
    return found[rank < k]


def _chunks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[np.ndarray, ...]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            column = lambda name: part.column(part.schema.get_field_index(name))  # noqa: E731, B023
            yield _matrix(column("v"), dims), *(column(n).to_numpy() for n in ("row", "id", "label"))


def _search(batches: Iterator[pa.RecordBatch], anchors: Anchors, space: Space) -> Iterator[pa.RecordBatch]:
    """A task's best rows of each anchor (positives) or window (negatives): the number of the anchor or window, score, id."""
    negatives = anchors.positive is not None
    k = NEGATIVES if negatives else POSITIVES
    best = np.zeros((0, 3), np.int64)
    least = anchors.least.copy()
    for v, row, ids, label in _chunks(batches, len(space.order)):
        x = v[:, space.order].astype(float)
        norms, found = _norms(x), [best]
        for at in range(0, len(anchors.id), TILE):
            t = slice(at, at + TILE)
            same = label[:, None] == anchors.label[t]
            wanted = ~same if negatives else same & (row[:, None] != anchors.row[t])
            i, j, score = _pairs(x, anchors.x[t], norms, anchors.norms[t], least[t], anchors.most[t], wanted, space)
            j = j + at
            if not negatives:
                found.append(np.stack([j, score, ids[i]], axis=1))
                continue
            for q in range(POSITIVES):
                p = anchors.score[j, q]
                fits = anchors.open[j, q] & (score * 20 <= p * (HIGH // 5)) & (score * (100 // LOW) >= p)
                found.append(np.stack([j[fits] * POSITIVES + q, score[fits], ids[i[fits]]], axis=1))
        best = _first(np.concatenate(found), k)
        if not negatives and len(best):
            # a task that has enough need not look below them
            key, count = np.unique(best[:, 0], return_counts=True)
            last = best[np.cumsum(count) - 1, 1]
            least[key[count == k]] = np.maximum(least[key[count == k]], last[count == k])
    if len(best):
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.ascontiguousarray(best.T)], names=["key", "score", "id"])


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per dimension the sum of squares; at -1 the largest squared norm."""
    energy, largest = np.zeros(0), 0.0
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("v"))
        dims = int(np.diff(column.offsets.to_numpy()).max(initial=0))
        squares = _matrix(column, dims).astype(float) ** 2
        energy = np.pad(energy, (0, max(0, dims - len(energy))))
        energy[:dims] += squares.sum(axis=0)
        largest = max(largest, squares.sum(axis=1).max(initial=0.0))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, len(energy)), pa.int32()), pa.array(np.concatenate([[largest], energy]))], names=["place", "x"])


def _rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    whole = F.forall(vector_col, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x.cast("double")))
    some = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vector_col).isNotNull() & whole)
    v = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale))
    made = some.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(label_col).alias("label"), v.alias("v"))
    return staged(made.withColumn("row", F.monotonically_increasing_id()), "negatives-rows")


class _Start:
    """Thresholds from a sample of rows: where the wanted number of partners can be expected."""

    def __init__(self, sample: pa.Table, n: int, space: Space):
        self.x = _matrix(sample["v"], len(space.order))[:, space.order].astype(float)
        self.label, self.row, self.share = sample["label"].to_numpy(), sample["row"].to_numpy(), len(self.x) / max(n, 1)

    def _rank(self, level: int) -> int:
        return int(np.ceil(WANTED * LOWER**level * self.share))

    def positives(self, a: Anchors, level: int) -> np.ndarray:
        out = np.full(len(a.id), -np.inf)
        for i in range(len(a.id)):
            scores = np.sort((self.x @ a.x[i])[(self.label == a.label[i]) & (self.row != a.row[i])])[::-1]
            if len(scores) > self._rank(level):
                out[i] = scores[self._rank(level)]
        return out

    def negatives(self, a: Anchors, i: int, high: np.ndarray, level: int) -> np.ndarray:
        """One threshold for each upper edge."""
        scores = np.sort((self.x @ a.x[i])[self.label != a.label[i]])[::-1]
        at = np.searchsorted(-scores, -high.astype(float)) + self._rank(level)
        return np.append(scores, -np.inf)[np.minimum(at, len(scores))]


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), F.asc("id")))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def _window(positive: int) -> tuple[int, int]:
    """The smallest and largest score of a negative."""
    return -(-positive * LOW // 100), positive * HIGH // 100


class _Block:
    """One block of anchors: its positives, then its negatives."""

    def __init__(self, rows: DataFrame, space: Space, start: _Start, table: pa.Table):
        self.rows, self.space, self.start = rows, space, start
        self.x = _matrix(table["v"], len(space.order))[:, space.order].astype(float)
        self.row, self.id, self.label = (table[c].to_numpy() for c in ("row", "id", "label"))

    def _some(self, which: np.ndarray, least: np.ndarray, most: np.ndarray, **windows) -> Anchors:
        return Anchors(self.x[which], self.row[which], self.id[which], self.label[which], least, most, **windows)

    def _ask(self, anchors: Anchors, k: int) -> DataFrame:
        spark, space = self.rows.sparkSession, self.space
        shared = spark.sparkContext.broadcast(anchors)
        found = self.rows.mapInArrow(lambda b: _search(b, shared.value, space), "key bigint, score bigint, id bigint")
        return staged(_best(found, k), "negatives-found")

    def positives(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids and scores of each anchor's positives, and how many there are."""
        m = len(self.id)
        ids, scores, n = np.zeros((m, POSITIVES), np.int64), np.zeros((m, POSITIVES), np.int64), np.zeros(m, np.int64)
        which, level = np.arange(m), 0
        while len(which):
            none = np.full(len(which), -np.inf)
            asked = self._some(which, none, -none)
            asked.least = self.start.positives(asked, level)
            found = self._ask(asked, POSITIVES).toArrow()  # at most POSITIVES rows an anchor
            key, rank = found["key"].to_numpy(), found["rank"].to_numpy() - 1
            ids[which[key], rank], scores[which[key], rank] = found["id"].to_numpy(), found["score"].to_numpy()
            n[which] = np.bincount(key, minlength=len(which))
            which = which[(n[which] < POSITIVES) & (asked.least > -np.inf)]
            level += 1
        return ids, scores, n

    def negatives(self) -> Iterator[DataFrame]:
        ids, scores, n = self.positives()
        is_open = np.arange(POSITIVES) < n[:, None]
        low, high = (np.array([[_window(int(p))[side] for p in line] for line in scores], np.int64).reshape(scores.shape) for side in (0, 1))
        is_open &= low <= high
        level = 0
        while is_open.any():
            which = np.flatnonzero(is_open.any(axis=1))
            most = np.where(is_open[which], high[which], low[which].min(initial=0)).max(axis=1).astype(float)
            least = np.zeros(len(which))
            asked = self._some(which, least, most, positive=ids[which], score=scores[which], open=is_open[which])
            for i, w in enumerate(which):
                q = is_open[w]
                least[i] = np.maximum(low[w, q], self.start.negatives(asked, i, high[w, q], level)).min()
            # down to its threshold a window is complete
            complete = is_open[which] & (least[:, None] <= low[which])
            shared = self.rows.sparkSession.sparkContext.broadcast((asked.id, asked.positive, asked.score, complete.ravel()))
            found = self._ask(asked, NEGATIVES)
            count = F.count("*").over(Window.partitionBy("key"))
            out = staged(found.withColumn("n", count).mapInArrow(lambda b, s=shared: _named(b, *s.value), RESULT + ", key bigint"), "negatives-filled")
            filled = out.select("key").distinct().toArrow()["key"].to_numpy()  # at most POSITIVES an anchor
            closed = complete.ravel().copy()
            closed[filled] = True
            is_open[which] &= ~closed.reshape(complete.shape)
            level += 1
            yield out.drop("key")


RESULT = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _named(batches: Iterator[pa.RecordBatch], ids: np.ndarray, positive: np.ndarray, score: np.ndarray, complete: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of windows that are full or complete, with the anchor's and the positive's ids."""
    for batch in batches:
        key, rank, negative, ns, n = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("key", "rank", "id", "score", "n"))
        at = np.flatnonzero((n == NEGATIVES) | complete[key])
        k = key[at]
        columns = [ids[k // POSITIVES], positive.ravel()[k], rank[at].astype(np.int32), negative[at], score.ravel()[k], ns[at], k]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "key"])


def mine(vectors: DataFrame, is_anchor: Callable[[Column], Column], id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", *, scale: int = SCALE, anchors: int = ANCHORS) -> DataFrame:
    """For each anchor and each of its positives the first negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A component is floor(scale * x); a score is the inner product with the anchor.
    Positives are the anchor's first POSITIVES other rows of its label, negatives the
    first NEGATIVES rows of other labels with LOW to HIGH percent of the positive's
    score; higher scores first, ties by smaller id.

    Rows with a NULL id, label or vector or a NULL or non-finite component take no
    part. Ids are whole numbers. An empty or zero vector scores 0; where vectors
    differ in length, the missing components are 0. Rows of one id are rows of their
    own, so a repeated anchor row has repeated results, and copies of an anchor under
    any id are among its positives. Scores that do not fit into 64 bits (after
    multiplying by 20) are an error. An empty table, or one without anchors, gives
    an empty result. Other columns are not read, so their names cannot clash.
    """
    spark = vectors.sparkSession
    rows = _rows(vectors, id_col, vector_col, label_col, scale)
    stats = rows.mapInArrow(_stats, "place int, x double").groupBy("place").agg(F.sum("x").alias("energy"), F.max("x").alias("largest")).toArrow().to_pylist()
    largest = max((r["largest"] for r in stats if r["place"] < 0), default=0.0)
    if largest >= LARGEST:
        raise ValueError("scores do not fit into 64 bits")
    energy = {r["place"]: r["energy"] for r in stats if r["place"] >= 0}
    order = np.array(sorted(energy, key=lambda k: (-energy[k], k)), np.int64)
    exact = largest * 20 < EXACT
    space = Space(order, exact, 0.0 if exact else largest * 1e-9)
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).toArrow()
    start = _Start(sample, rows.count(), space)
    asking = rows.where(is_anchor(F.col("id")))
    blocks = -(-asking.count() // anchors)
    out = spark.createDataFrame([], RESULT)
    for b in range(blocks):
        table = asking.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).toArrow()  # about `anchors` rows
        if table.num_rows:
            for found in _Block(rows, space, start, table).negatives():
                out = out.unionByName(found)
    return out
