"""Phrases of two and three words that occur together more often than apart, per language.

Counting follows ERA, the elastic-range construction of suffix trees, on words
and cut off at three of them:

* vertical partitioning: suffixes are grouped by prefix so that a group's
  suffixes stay within a memory budget. Prefixes of one word are packed by their
  counts; where one word is too frequent its prefixes of two words are counted and
  packed, and where a pair is too frequent its whole suffixes are dealt out;
* every group then builds its part of the tree by itself: its suffixes in order,
  where a node is a run of equal prefixes and its count the sum of its leaves.

Each task merges equal suffixes before they are moved, so a phrase that fills a
third of the corpus costs one row a task. The tables that steer the grouping have
a fixed number of slots of hashed prefixes; sizes of groups depend on them, counts
do not. Words and suffixes travel as 64-bit hashes (see the README for the odds of
a clash); the words themselves come back from the table of word counts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm import tokens
from panelspark.llm.stage import staged

MIN_COUNT, TOP = 10, 2000
#: A candidate goes when a longer one around it has this share of its occurrences, in percent.
COVERED = 50
#: Suffixes that a group holds at most: 32 bytes each and as much again to sort them.
BUDGET = 2_000_000
SLOT_BITS = 20
#: Rows that a task merges before it sends them on.
MERGED = 1_000_000
#: Suffixes in one batch that a task sends: 1 MB, which Python, Arrow and the JVM each hold a copy of.
SENT = 1 << 15
#: Windows that share the ranking of one language before the last one.
SALTS = 16


def _word_bytes() -> tuple[np.ndarray, np.ndarray]:
    """Byte classes: inside a word, and ends of a piece."""
    ends = np.zeros(256, bool)
    ends[list(b".,;:!?\x0a\x0b\x0c\x0d")] = True
    word = ~ends
    word[[0x20, 0x09]] = False
    return word, ends


WORD, PIECE_END = _word_bytes()


@dataclass
class _Block:
    words: tokens.Words
    langs: pa.Array
    row: np.ndarray  # of each word
    keys: np.ndarray  # one hash of language and word
    last: np.ndarray  # whether a word ends its piece


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[_Block]:
    for batch, data, offsets in tokens.blocks(batches, "_text"):
        w = tokens.hashed_words(data, offsets, WORD)
        langs = batch.column(batch.schema.get_field_index("_lang"))
        names = langs.dictionary_encode()
        hashes = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest()) for x in names.dictionary.to_pylist()], np.uint64)
        row = np.repeat(np.arange(batch.num_rows), np.diff(w.first))
        keys = tokens.folded([hashes[names.indices.to_numpy()][row], w.hashes])
        keys[keys == 0] = 1  # 0 stands for no word
        ends = np.concatenate(([0], np.cumsum(PIECE_END[data])))
        last = np.ones(len(keys), bool)
        last[:-1] = (ends[w.starts[1:]] != ends[w.ends[:-1]]) | (row[1:] != row[:-1])
        yield _Block(w, langs, row, keys, last)


def _strings(w: tokens.Words, which: np.ndarray) -> pa.Array:
    """The lower-cased words of the given numbers, without a Python string each."""
    starts, lengths = w.starts[which], w.ends[which] - w.starts[which]
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], lengths)
    data = tokens.LOWER[w.data[np.repeat(starts, lengths) + place]]
    return pa.LargeStringArray.from_buffers(len(which), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))


class _Merged:
    """Rows of a 64-bit name, other columns and a count, merged by name now and then."""

    def __init__(self, room: int):
        self.room, self.parts, self.rows = room, [], 0

    def add(self, name: np.ndarray, columns: list[pa.Array]) -> list[tuple]:
        """Take rows; the merged ones come back when there is no room for them."""
        name, at, n = np.unique(name, return_index=True, return_counts=True)
        return self._take((name, [c.take(pa.array(at)) for c in columns], n))

    def _take(self, part: tuple) -> list[tuple]:
        self.parts.append(part)
        self.rows += len(part[0])
        if self.rows <= self.room:
            return []
        merged = self.all()
        if len(merged[0]) > self.room // 2:
            self.parts, self.rows = [], 0
            return [merged]
        self.parts, self.rows = [merged], len(merged[0])
        return []

    def all(self) -> tuple:
        if len(self.parts) == 1:
            return self.parts[0]
        name, at, back = np.unique(np.concatenate([p[0] for p in self.parts]), return_index=True, return_inverse=True)
        n = np.bincount(back, weights=np.concatenate([p[2] for p in self.parts]), minlength=len(name)).astype(np.int64)
        return name, [pa.concat_arrays([p[1][i] for p in self.parts]).take(pa.array(at)) for i in range(len(self.parts[0][1]))], n

    def rest(self) -> list[tuple]:
        return [self.all()] if self.rows else []


def _count_words(batches: Iterator[pa.RecordBatch], room: int) -> Iterator[pa.RecordBatch]:
    """(k, lang, word, n) of a task's words."""
    merged = _Merged(room)

    def rows(part):
        return pa.RecordBatch.from_arrays([pa.array(part[0].view(np.int64)), *(c.cast(pa.string()) for c in part[1]), pa.array(part[2])], names=["k", "lang", "word", "n"])

    for b in _read(batches):
        name, at = np.unique(b.keys, return_index=True)
        numbers = np.zeros(len(b.keys), np.int64)
        numbers[at] = np.arange(len(at))
        columns = [b.langs.take(pa.array(b.row[at])).cast(pa.large_string()), _strings(b.words, at)]
        counts = np.bincount(np.searchsorted(name, b.keys), minlength=len(name))
        yield from map(rows, merged._take((name, columns, counts)))
    yield from map(rows, merged.rest())


@dataclass
class Groups:
    """The vertical partitioning: which group a suffix belongs to.

    Slots of one-word prefixes have a group, none (-1) or pieces of two-word
    prefixes; pieces have a first group and the number of groups that share them.
    """

    slots: np.ndarray
    first_piece: np.ndarray
    pieces: np.ndarray
    piece_group: np.ndarray
    piece_parts: np.ndarray
    shared_from: int

    def slot(self, k: np.ndarray) -> np.ndarray:
        """The first bits of a word's hash."""
        return (k >> np.uint64(65 - len(self.slots).bit_length())).astype(np.int64)

    def frequent(self, k: np.ndarray) -> np.ndarray:
        """Whether a word can have the wanted count; false only for words that have not."""
        return self.slots[self.slot(k)] != -1

    def piece(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        """The piece of each two-word prefix, -1 where the one-word prefix has a group."""
        slot = self.slot(k1)
        n = self.pieces[slot]
        return np.where(n > 0, self.first_piece[slot] + (tokens.folded([k1, k2], 1) % np.maximum(n, 1).astype(np.uint64)).astype(np.int64), -1)

    def of(self, k1: np.ndarray, k2: np.ndarray, k3: np.ndarray) -> np.ndarray:
        group = self.slots[self.slot(k1)]
        piece = self.piece(k1, k2)
        far = np.flatnonzero(piece >= 0)
        p = piece[far]
        part = tokens.folded([k1[far], k2[far], k3[far]], 2) % self.piece_parts[p].astype(np.uint64)
        group[far] = self.piece_group[p] + part.astype(np.int64)
        return group


def _packed(weight: np.ndarray, budget: int, first: int) -> tuple[np.ndarray, int]:
    """Neighbours share groups of at most the budget, when none has more than half of it."""
    before = np.cumsum(weight) - weight
    group = before * 2 // budget
    _, group = np.unique(group, return_inverse=True) if len(group) else (None, group)
    return group.astype(np.int64) + first, first + (int(group.max()) + 1 if len(group) else 0)


def vertical_partitioning(weights: np.ndarray, budget: int, count_pieces) -> Groups:
    """Groups from the counts of one-word slots; `count_pieces(groups)` counts pieces if any slot needs them."""
    budget = max(budget, 4 * int(weights.sum()) // len(weights), 2)
    hot = weights * 2 > budget
    slots = np.full(len(weights), -1, np.int64)
    cold = np.flatnonzero((weights > 0) & ~hot)
    slots[cold], groups = _packed(weights[cold], budget, 0)
    pieces = np.where(hot, -(-4 * weights // budget), 0)
    first_piece = np.cumsum(pieces) - pieces
    slots[hot] = -2
    none = np.zeros(0, np.int64)
    out = Groups(slots, first_piece, pieces, none, none, 0)
    n = int(pieces.sum())
    out.piece_group, out.piece_parts = np.zeros(n, np.int64), np.ones(n, np.int64)
    if n:
        counted = count_pieces(out)
        wide = counted * 2 > budget
        out.piece_group[~wide], groups = _packed(counted[~wide], budget, groups)
        out.piece_parts[wide] = -(-2 * counted[wide] // budget)
        out.shared_from = groups
        out.piece_group[wide] = groups + np.cumsum(out.piece_parts[wide]) - out.piece_parts[wide]
    else:
        out.shared_from = groups
    return out


def _suffixes(b: _Block, groups: Groups) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First three words of every suffix whose first two words can be frequent; 0 for a third one that is not there or not frequent."""
    ok = groups.frequent(b.keys)
    at = np.flatnonzero(ok[:-1] & ok[1:] & ~b.last[:-1])
    k1, k2 = b.keys[at], b.keys[at + 1]
    after = np.minimum(at + 2, len(b.keys) - 1)
    third = ~b.last[at + 1] & ok[after]
    return k1, k2, np.where(third, b.keys[after], np.uint64(0))


def _count_pieces(batches: Iterator[pa.RecordBatch], groups: Groups) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(len(groups.piece_parts), np.int64)
    for b in _read(batches):
        k1, k2, _ = _suffixes(b, groups)
        piece = groups.piece(k1, k2)
        counts += np.bincount(piece[piece >= 0], minlength=len(counts))
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["piece", "n"])


def _deal_out(batches: Iterator[pa.RecordBatch], groups: Groups, room: int) -> Iterator[pa.RecordBatch]:
    """Per group, task and batch: its suffixes with their counts, four 64-bit numbers each."""
    merged = _Merged(room)

    def rows(part):
        k1, k2, k3 = (c.to_numpy() for c in part[1])
        group, n = groups.of(k1, k2, k3), part[2].astype(np.uint64)
        order = np.argsort(group, kind="stable")
        for at in range(0, len(order), SENT):
            these = order[at : at + SENT]
            block = np.stack([k1[these], k2[these], k3[these], n[these]], axis=1)
            starts = np.flatnonzero(np.diff(group[these], prepend=-1))
            data = [block[a:z].tobytes() for a, z in zip(starts, [*starts[1:], len(block)], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(group[these[starts]]), pa.array(data, pa.binary())], names=["g", "suffixes"])

    for b in _read(batches):
        if len(b.keys):
            k = _suffixes(b, groups)
            if len(k[0]):
                for part in merged.add(tokens.folded(list(k)), [pa.array(x) for x in k]):
                    yield from rows(part)
    for part in merged.rest():
        yield from rows(part)


NODES = "k1 bigint, k2 bigint, k3 bigint, a bigint"


def _subtree(group: pa.Table, min_count: int, shared_from: int) -> pa.Table:
    """The nodes of depth two (k3 = 0) and three of a group's part of the tree that occur often enough.

    Pairs whose suffixes are spread over several groups have a part of their count
    in each; these come back whatever their size.
    """
    rows = np.concatenate([np.frombuffer(x, np.uint64) for x in group["suffixes"].to_pylist()]).reshape(-1, 4)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new_pair = np.ones(len(rows), bool)
    new_pair[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
    new_leaf = new_pair.copy()
    new_leaf[1:] |= rows[1:, 2] != rows[:-1, 2]
    leaf_at, pair_at = np.flatnonzero(new_leaf), np.flatnonzero(new_pair)
    leaves = np.add.reduceat(rows[:, 3].astype(np.int64), leaf_at)
    pairs = np.add.reduceat(leaves, np.searchsorted(leaf_at, pair_at))
    keep_leaf = (leaves >= min_count) & (rows[leaf_at, 2] != 0)
    keep_pair = pairs >= (1 if group["g"][0].as_py() >= shared_from else min_count)
    top = rows[pair_at[keep_pair]]
    top = np.stack([top[:, 0], top[:, 1], np.zeros(len(top), np.uint64)], axis=1)
    nodes = np.concatenate([top, rows[leaf_at[keep_leaf], :3]]).view(np.int64)
    counts = np.concatenate([pairs[keep_pair], leaves[keep_leaf]])
    return pa.table({"k1": nodes[:, 0], "k2": nodes[:, 1], "k3": nodes[:, 2], "a": counts})


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (l * r)) in decimals of 38 digits."""
    whole = lambda x: x.cast("decimal(19,0)")
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * whole(a) * whole(a), whole(left) * whole(right))


def _word_table(texts: DataFrame, room: int) -> DataFrame:
    """(k, lang, word, f) of all words."""
    counted = texts.mapInArrow(lambda b: _count_words(b, room // 4), "k bigint, lang string, word string, n bigint")
    return staged(counted.groupBy("k", "lang", "word").agg(F.sum("n").alias("f")), "phrases-words")


def _tree_nodes(texts: DataFrame, words: DataFrame, min_count: int, budget: int, room: int, slot_bits: int) -> DataFrame:
    spark = texts.sparkSession
    slot = F.shiftrightunsigned("k", 64 - slot_bits).alias("slot")
    found = words.where(F.col("f") >= min_count).groupBy(slot).agg(F.sum("f").alias("n")).toArrow()  # at most a row a slot
    weights = np.zeros(1 << slot_bits, np.int64)
    weights[found["slot"].to_numpy()] = found["n"].to_numpy()

    def count_pieces(groups: Groups) -> np.ndarray:
        shared = spark.sparkContext.broadcast(groups)
        rows = texts.mapInArrow(lambda b: _count_pieces(b, shared.value), "piece bigint, n bigint")
        table = rows.groupBy("piece").agg(F.sum("n").alias("n")).toArrow()  # at most a row a piece
        counts = np.zeros(len(groups.piece_parts), np.int64)
        counts[table["piece"].to_numpy()] = table["n"].to_numpy()
        return counts

    groups = vertical_partitioning(weights, budget, count_pieces)
    shared, shared_from = spark.sparkContext.broadcast(groups), groups.shared_from
    dealt = texts.mapInArrow(lambda b: _deal_out(b, shared.value, room), "g bigint, suffixes binary")
    return staged(dealt.groupBy("g").applyInArrow(lambda t: _subtree(t, min_count, shared_from), NODES), "phrases-nodes")


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", *, min_count: int = MIN_COUNT, covered: int = COVERED, top: int = TOP, budget: int = BUDGET, room: int = MERGED, slot_bits: int = SLOT_BITS) -> DataFrame:
    """The first `top` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Words are `[^\\x20\\x09]+` between piece ends `[.,;:!?\\x0A-\\x0D]`, A-Z in lower
    case. n counts the language's words, a the phrase, l and r the two parts of its
    lowest-scoring cut (the first such cut); score is floor(1000000 a a / (l r)).
    Phrases below `min_count` and those whose words stand inside a longer one with
    at least `covered` percent of their count are not returned. Order: score and a
    descending, phrase ascending by bytes. `budget` bounds the suffixes of a group and
    `room` the rows that a task merges; results do not depend on either.

    NULL lang is `und`; NULL or empty text has no words; repeated rows count again;
    phrases of equal score and count are ranked by their bytes, so ranks are all
    different; a language without phrases has no row; an empty table gives an empty
    result. Other columns are not read, so their names cannot clash.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("_lang"), F.col(text_col).alias("_text"))
    words = _word_table(texts, room)
    nodes = _tree_nodes(texts, words, min_count, budget, room, slot_bits)
    pairs = nodes.where("k3 = 0").groupBy("k1", "k2").agg(F.sum("a").alias("a")).where(F.col("a") >= min_count)
    pairs = staged(pairs, "phrases-pairs")
    triples = nodes.where("k3 <> 0")
    frequent = staged(words.where(F.col("f") >= min_count), "phrases-frequent")

    def word(i: int) -> DataFrame:
        lang = [F.col("lang")] if i == 1 else []
        return frequent.select(F.col("k").alias(f"k{i}"), *lang, F.col("word").alias(f"w{i}"), F.col("f").alias(f"f{i}"))

    around = triples.select(F.col("k1").alias("x"), F.col("k2").alias("y"), "a").unionByName(triples.select(F.col("k2").alias("x"), F.col("k3").alias("y"), "a"))
    around = around.groupBy("x", "y").agg(F.max("a").alias("_longer")).select(F.col("x").alias("k1"), F.col("y").alias("k2"), "_longer")
    alone = pairs.join(around, ["k1", "k2"], "left").where(F.coalesce(F.col("_longer") * 100 < F.col("a") * covered, F.lit(True)))
    two = alone.join(word(1), "k1").join(word(2), "k2")
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", F.col("f1").alias("l"), F.col("f2").alias("r"), _score(F.col("a"), F.col("f1"), F.col("f2")).alias("score"))
    left = pairs.select("k1", "k2", F.col("a").alias("f12"))
    right = pairs.select(F.col("k1").alias("k2"), F.col("k2").alias("k3"), F.col("a").alias("f23"))
    three = triples.join(left, ["k1", "k2"]).join(right, ["k2", "k3"]).join(word(1), "k1").join(word(2), "k2").join(word(3), "k3")
    three = three.withColumns({"_s1": _score(F.col("a"), F.col("f1"), F.col("f23")), "_s2": _score(F.col("a"), F.col("f12"), F.col("f3"))})
    first = F.col("_s1") <= F.col("_s2")
    three = three.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a",
        F.when(first, F.col("f1")).otherwise(F.col("f12")).alias("l"), F.when(first, F.col("f23")).otherwise(F.col("f3")).alias("r"), F.least("_s1", "_s2").alias("score"),
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    found = two.unionByName(three).withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    found = found.withColumn("_in_part", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*order))).where(F.col("_in_part") <= top)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    total = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return found.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
