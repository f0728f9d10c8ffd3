"""Licences in whole texts by the Dice coefficient of word bigrams with templates.

A text is cut into segments at line ends and after . ! ? ; : and its words are
lower-cased. Every run of whole segments is compared with every template:
Dice = 2 * common bigrams / (bigrams of both), counted with repeats, no bigram
crossing segments. Three size bounds prune without losing a match of Dice >= t:
a run and a template differ in size by a factor of (2 - t) / t at most; at least
t / (2 - t) of a run's bigrams occur in templates, so one of its segments has that
share by itself and all runs are sought around such segments; and a template must
share that many bigrams with the run.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm import tokens
from panelspark.llm.stage import refuse_clash
from panelspark.llm.license_texts import templates

THRESHOLD = 0.8


@dataclass
class Templates:
    ids: list[str]
    grams: list[Counter]
    sizes: np.ndarray
    known: np.ndarray  # sorted hashes of all their bigrams
    by_gram: dict[int, list[int]]


@dataclass
class Segmented:
    """Bigrams of texts laid end to end: segment s has grams[at[s]:at[s+1]]; text i has segments first[i] to first[i+1]."""

    grams: np.ndarray
    at: np.ndarray
    first: np.ndarray
    start: np.ndarray  # byte where the segment's first word begins
    end: np.ndarray


def segmented(data: np.ndarray, offsets: np.ndarray) -> Segmented:
    words = tokens.hashed_words(data, offsets, tokens.letters_and_digits())
    n = len(words.hashes)
    if n == 0:
        return Segmented(words.hashes, np.zeros(1, np.int64), np.zeros(len(offsets), np.int64), words.starts, words.ends)
    lines = np.concatenate(([0], np.cumsum(data == 10)))
    after = np.append(words.starts[1:], len(data))
    mark = np.isin(data[np.minimum(words.ends, len(data) - 1)], np.frombuffer(b".!?;:", np.uint8)) & (words.ends < len(data))
    cut = (lines[after] > lines[words.ends]) | (mark & (after - words.ends >= 2))
    cut[np.maximum(words.first[1:] - 1, 0)[words.first[1:] > words.first[:-1]]] = True
    last = np.flatnonzero(cut)
    begin = np.concatenate(([0], last[:-1] + 1))
    inner = ~cut[:-1]
    grams = tokens.folded([words.hashes[:-1], words.hashes[1:]])[inner]
    before = np.concatenate(([0], np.cumsum(inner)))
    at = np.append(before[begin], len(grams))
    return Segmented(grams, at, np.searchsorted(begin, words.first), words.starts[begin], words.ends[last])


def prepared(texts: list[tuple[str, str]]) -> Templates:
    grams = []
    for _, text in texts:
        raw = np.frombuffer(text.encode(), np.uint8)
        grams.append(Counter(segmented(raw, np.array([0, len(raw)])).grams.tolist()))
    by_gram: dict[int, list[int]] = {}
    for i, g in enumerate(grams):
        for x in g:
            by_gram.setdefault(x, []).append(i)
    return Templates([i for i, _ in texts], grams, np.array([g.total() for g in grams]), np.array(sorted(by_gram), np.uint64), by_gram)


def dice(a: Counter, b: Counter) -> float:
    return 2 * (a & b).total() / (a.total() + b.total())


def _runs(s: Segmented, text: int, hit: np.ndarray, t: Templates, threshold: float) -> Iterator[tuple[float, int, int, int]]:
    """(dice, template, first segment, last segment) of each run of a text that reaches the threshold."""
    share = threshold / (2 - threshold)
    lo, hi = int(s.first[text]), int(s.first[text + 1])
    size = np.diff(s.at[lo : hi + 1])
    seeds = np.flatnonzero((size > 0) & (hit[lo:hi] >= share * size))
    longest, shortest = t.sizes.max() / share, t.sizes.min() * share
    hits = hit[lo:hi]
    total, found = s.at[lo : hi + 1] - s.at[lo], np.concatenate(([0], np.cumsum(hits)))
    ends = np.flatnonzero(hits > 0)  # a run that begins or ends without a known bigram is better without that segment
    done = set()
    for seed in seeds.tolist():
        i = ends[(ends <= seed) & (total[seed + 1] - total[ends] <= longest)]
        j = ends[(ends >= seed) & (total[ends + 1] - total[seed] <= longest)]
        n = total[j + 1][None, :] - total[i][:, None]
        h = found[j + 1][None, :] - found[i][:, None]
        for x, y in np.argwhere((n >= shortest) & (n <= longest) & (h >= share * n)).tolist():
            a, b = int(i[x]), int(j[y])
            if (a, b) in done:
                continue
            done.add((a, b))
            run = Counter(s.grams[s.at[lo + a] : s.at[lo + b + 1]].tolist())
            shared: Counter = Counter()
            for gram, k in run.items():
                for c in t.by_gram.get(gram, ()):
                    shared[c] += min(k, t.grams[c][gram])
            size_of_run = run.total()
            for c, common in shared.items():
                d = 2 * common / (size_of_run + int(t.sizes[c]))
                if d >= threshold:
                    yield d, c, a, b


def scan(data: np.ndarray, offsets: np.ndarray, t: Templates, threshold: float = THRESHOLD) -> list[list[dict]]:
    """The licences of each text: the best runs that do not overlap, in text order.

    Better means the higher Dice, then the longer run, the earlier run and the smaller licence id.
    """
    s = segmented(data, offsets)
    out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
    if not len(s.grams):
        return out
    i = np.minimum(np.searchsorted(t.known, s.grams), len(t.known) - 1)
    before = np.concatenate(([0], np.cumsum(t.known[i] == s.grams)))
    hit = before[s.at[1:]] - before[s.at[:-1]]
    size = np.diff(s.at)
    seeded = np.flatnonzero((size > 0) & (hit >= threshold / (2 - threshold) * size))
    for text in np.unique(np.searchsorted(s.first, seeded, side="right") - 1).tolist():
        lo = int(s.first[text])
        taken: list[tuple[int, int]] = []
        for d, c, a, b in sorted(_runs(s, text, hit, t, threshold), key=lambda r: (-r[0], r[2] - r[3], r[2], t.ids[r[1]])):
            if all(b < x or a > y for x, y in taken):
                taken.append((a, b))
                out[text].append({"license": t.ids[c], "dice": d, "start": int(s.start[lo + a] - offsets[text]), "end": int(s.end[lo + b] - offsets[text])})
        out[text].sort(key=lambda r: r["start"])
    return out


def _scan_batches(batches: Iterator[pa.RecordBatch], t: Templates, threshold: float) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("license", pa.string()), ("dice", pa.float64()), ("start", pa.int64()), ("end", pa.int64())]))
    for batch, data, offsets in tokens.blocks(batches, "_text"):
        at = batch.schema.get_field_index("_text")
        found = pa.array(scan(data, offsets, t, threshold), kind)
        columns = [found if i == at else batch.column(i) for i in range(batch.num_columns)]
        yield pa.RecordBatch.from_arrays(columns, names=["licenses" if n == "_text" else n for n in batch.schema.names])


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), texts: list[tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: id, the columns in `keep`, and licenses (license, dice, start, end), byte offsets into the UTF-8 text.

    The templates are a short fixed list that goes with the task; rows are handled
    where they are read. NULL or empty text has no licences; equal scores are
    decided as `scan` says; repeated rows are each reported; an empty table
    gives an empty result.
    """
    t = prepared(texts or templates())
    shared = docs.sparkSession.sparkContext.broadcast(t)
    names = list(dict.fromkeys([id_col, *keep]))
    refuse_clash(names, ("licenses", "_text"))
    base = docs.select(*names, F.col(text_col).alias("_text"))
    schema = T.StructType(base.schema.fields[:-1]).add("licenses", T.ArrayType(T.StructType.fromDDL("license string, dice double, start bigint, end bigint")))
    return base.mapInArrow(lambda b: _scan_batches(b, shared.value, threshold), schema)
