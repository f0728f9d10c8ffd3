"""Benchmark passages in documents by Wu-Manber multi-pattern search over words.

A pattern is a window of consecutive item words. For patterns of one length m,
a shift table tells for every block of two words how far the search may move on
when it sees that block; blocks that end no pattern prefix move it by up to m - 1
words. Where the shift is 0, the bucket of the block's hash lists the patterns
that end so, and their words are compared directly, as bytes, with the text.
The search moves over many stretches of text at once in numpy.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import tokens
from panelspark.llm.stage import packed, refuse_clash, staged, unpacked

#: Consecutive words of a window.
WINDOW = 10
#: Benchmark words that one set of search tables holds; larger benchmarks are searched for in several sets.
BLOCK_WORDS = 2_000_000
#: Positions of one stretch of text in the joint search.
STRETCH = 256


@dataclass
class Tables:
    """Search tables for the patterns of one length."""

    length: int
    words: np.ndarray  # patterns x length, word hashes
    text: list[bytes]  # the words of each pattern, joined by a space
    items: list[list[str | None]]  # the items of each pattern
    blocks: np.ndarray  # sorted hashes of the blocks in patterns
    shift: np.ndarray  # by block; 0 where it ends a pattern
    bucket: np.ndarray  # by block: where its patterns begin in `order`
    order: np.ndarray


def _sorted(items: set) -> list[str | None]:
    """Item ids in order, that of items without id last."""
    return sorted(items, key=lambda i: (i is None, i or ""))


def tables(items: list[tuple[str | None, bytes]], window: int = WINDOW) -> list[Tables]:
    """Search tables from (item id, text) pairs, one for each pattern length."""
    by_length: dict[int, dict[bytes, tuple[np.ndarray, set]]] = {}
    for item, raw in items:
        data = np.frombuffer(raw, np.uint8)
        words = tokens.hashed_words(data, np.array([0, len(data)]), tokens.letters_and_digits())
        n = len(words.hashes)
        m = min(window, n)
        for i in range(n - m + 1 if n else 0):
            text = b" ".join(words.text(j) for j in range(i, i + m))
            by_length.setdefault(m, {}).setdefault(text, (words.hashes[i : i + m], set()))[1].add(item)
    return [_tables(m, found) for m, found in sorted(by_length.items())]


def _blocks(words: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    return words[ends] if size == 1 else tokens.folded([words[ends - 1], words[ends]])


def _tables(m: int, found: dict) -> Tables:
    text = list(found)
    words = np.stack([found[t][0] for t in text])
    size = min(2, m)
    flat = words.reshape(-1)
    each = np.arange(len(text)) * m
    blocks, shifts = [], []
    for end in range(size - 1, m):
        blocks.append(_blocks(flat, each + end, size))
        shifts.append(np.full(len(text), m - 1 - end))
    block, shift = np.concatenate(blocks), np.concatenate(shifts)
    order = np.lexsort((shift, block))
    unique, first = np.unique(block[order], return_index=True)
    last = blocks[-1]
    by_last = np.argsort(last, kind="stable")
    bucket = np.append(np.searchsorted(last[by_last], unique), len(text))
    return Tables(m, words, text, [_sorted(found[t][1]) for t in text], unique, shift[order][first], bucket, by_last)


def search(words: tokens.Words, t: Tables) -> Iterator[tuple[int, int]]:
    """(first word, pattern) of every confirmed occurrence in texts laid end to end."""
    m, size = t.length, min(2, t.length)
    far = m - size + 1
    n = np.diff(words.first)
    # stretches: end positions [lo, hi) of possible occurrences, none crossing a text
    docs = np.flatnonzero(n >= m)
    pieces = -(-(n[docs] - m + 1) // STRETCH)
    doc = np.repeat(docs, pieces)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at = words.first[doc] + m - 1 + k * STRETCH
    stop = np.minimum(at + STRETCH, words.first[doc + 1])
    while len(at):
        block = _blocks(words.hashes, at, size)
        i = np.minimum(np.searchsorted(t.blocks, block), len(t.blocks) - 1)
        known = t.blocks[i] == block
        move = np.where(known, t.shift[i], far)
        for end, b in zip(at[move == 0].tolist(), i[move == 0].tolist(), strict=True):
            start = end - m + 1
            for p in t.order[t.bucket[b] : t.bucket[b + 1]].tolist():
                if np.array_equal(words.hashes[start : end + 1], t.words[p]) and b" ".join(words.text(j) for j in range(start, end + 1)) == t.text[p]:
                    yield start, p
        at = at + np.maximum(move, 1)
        live = at < stop
        at, stop = at[live], stop[live]


def _item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items in blocks of a bounded number of bytes, each fetched when it is asked for."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text")).where("text is not null")
    size = items.select(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = int(size // (6 * block_words)) + 1
    items = items.withColumn("_block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    for b in range(blocks):
        yield [(r["item"], r["text"].encode()) for r in items.where(F.col("_block") == b).toLocalIterator()]


def find_items(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS, keep: tuple[str, ...] = (),
) -> DataFrame:
    """Per document: id, n_words, n_hit, n_items, items_sha256, contaminated, spans, and the columns in `keep`.

    `spans` holds the word ranges [start, end) of merged occurrences. Rows are
    handled where they are read; there is no shuffle. The tables of one block of
    items are broadcast, `block_words` words at most. A benchmark beyond that is
    searched for block after block, each pass adding to the found ranges.
    NULL or empty text has no words and no hits; items with text and a NULL id
    are searched for and count as one item in `n_items`, which `items_sha256`
    leaves out; items of fewer words than `window` are one window, items without
    words none; repeated rows are each reported; an empty benchmark finds nothing.
    """
    spark = docs.sparkSession
    names = list(dict.fromkeys([id_col, *keep]))
    refuse_clash(names, ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans", "_text", "_spans", "_items", "_ids"))
    base = docs.select(*[F.col(c) for c in names], F.col(text_col).alias("_text"), F.array().cast("array<array<bigint>>").alias("_spans"), F.array().cast("array<string>").alias("_items"), F.lit(0).cast("long").alias("n_words"))
    schema = base.schema
    for k, block in enumerate(_item_blocks(benchmark, item_col, item_text_col, block_words)):
        if k:  # one block's items and tables at a time
            base = staged(base, "decontamination-block")
        shared = spark.sparkContext.broadcast(tables(block, window))
        base = base.mapInArrow(lambda batches, shared=shared: _search_batches(batches, shared.value), schema)
    merged = base.withColumn("n_hit", F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0]))
    merged = merged.withColumn("_ids", F.array_sort(F.array_distinct("_items")))
    return merged.select(
        *[F.col(c) for c in names],
        "n_words",
        "n_hit",
        F.size("_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "_ids"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.col("_spans").alias("spans"),
    )


def _union(ranges: list) -> list:
    out: list = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _search_batches(batches: Iterator[pa.RecordBatch], all_tables: list[Tables]) -> Iterator[pa.RecordBatch]:
    word = tokens.letters_and_digits()
    for batch, data, offsets in tokens.blocks(batches, "_text"):
        words = tokens.hashed_words(data, offsets, word)
        spans, items = batch.column("_spans").to_pylist(), batch.column("_items").to_pylist()
        found: dict[int, tuple[list, set]] = {}
        for t in all_tables:
            for start, p in search(words, t):
                d = int(np.searchsorted(words.first, start, side="right")) - 1
                at, names = found.setdefault(d, (list(spans[d]), set(items[d])))
                a = start - int(words.first[d])
                if at and at[-1][0] <= a <= at[-1][1]:
                    at[-1] = [at[-1][0], max(at[-1][1], a + t.length)]
                else:
                    at.append([a, a + t.length])
                names.update(t.items[p])
        for d, (at, names) in found.items():
            spans[d], items[d] = _union(at), _sorted(names)
        columns = {"_spans": pa.array(spans, pa.list_(pa.list_(pa.int64()))), "_items": pa.array(items, pa.list_(pa.string())), "n_words": pa.array(np.diff(words.first), pa.int64())}
        yield pa.RecordBatch.from_arrays([columns.get(f.name, batch.column(i)) for i, f in enumerate(batch.schema)], names=batch.schema.names)


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents without any occurrence of a benchmark window, with their own columns, whatever their names.

    Rows are judged one by one, so repeated rows and rows without id stay or go
    by their text; NULL or empty text stays; an empty table stays empty.
    """
    found = find_items(packed(docs, _doc=text_col), benchmark, id_col="_row", text_col="_doc", **options)
    return unpacked(found.where(~F.col("contaminated")), docs)
