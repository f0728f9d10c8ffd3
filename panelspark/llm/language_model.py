"""Log probabilities of whole texts under a hashed maximum-entropy model, and under smoothed word counts.

A word's probability is that of its class after the words before it, times that
of the word in its class after them. Frequent words are classes of their own, the
others fall into classes by their last two bytes. A reference comes first. For
classes it is a softmax with hashed features of the classes before: one, n-grams
of two and three, skips over one and two. All training words enter through the
counts of classes after each context, from which every gradient step is summed
over Spark tasks. In a class it is the smoothed counts.

The features of the words themselves stand on top, in both factors. Class and word
are one path of choices among eight: two lead to the class, the others to the
word's cell in its class, with about as many cells as words. Every choice is a
softmax of the reference plus the weights of the word before and of the two words
before at that choice, in hashed rows. Weights come from iterative scaling: a
step adds a share of the log ratio of observed to expected counts. Those counts
are sparse rows, summed by row over all training texts. Scoring is numpy over
blocks of texts.

Word counts cover every training word. The most frequent words, a bounded
number, go to every task; all other words of a text are joined with their counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import tokens
from panelspark.llm.stage import staged

#: Classes: the end of a text, so many frequent words, and the rest by their last bytes.
FREQUENT = 31
ENDINGS = 32
CLASSES = 1 + FREQUENT + ENDINGS
END = np.uint64(1)
#: Rows of the weight table.
BUCKETS = 1 << 13
STEPS = 25
#: Pull of each weight to 0, and the summed gradient below which a weight moves in smaller steps; both in word counts.
PRIOR = 1.0
SLOW = 20.0
RATE = 0.3
#: Most frequent words that are broadcast with their counts.
HEAD = 500_000
#: Words that a task counts before it hands them on.
COUNTED = 400_000
LOG10 = np.log(10.0)
#: Choices at each step of a path, the most steps inside a class, and hashed weight rows of the words before.
WAYS = 8
DEEPEST = 5
ROWS = 1 << 18
#: Steps of iterative scaling; features of words that stand at every choice; count added on both sides of a ratio.
ROUNDS = 1
WORD_FEATURES = 2
PSEUDO = 1.0
#: Words whose paths are worked on at once.
AT_ONCE = 1 << 15
#: A task that sums counts sends up to ROWS rows, so it takes so many words at least, in more tasks than the least number.
TASK_WORDS = 5_000_000
LEAST_TASKS = 8


def _with_ends(words: tokens.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and ending classes of the words of each text with one end after them, and where each text begins."""
    n = np.diff(words.first)
    first = words.first + np.arange(len(words.first))
    place = np.arange(len(words.hashes)) + np.repeat(np.arange(len(n)), n)
    h = np.full(len(words.hashes) + len(n), END, np.uint64)
    h[place] = np.maximum(words.hashes, np.uint64(2))
    ending = np.zeros(len(h), np.int64)
    last = tokens.LOWER[words.data[words.ends - 1]].astype(np.int64) if len(words.hashes) else np.zeros(0, np.int64)
    before = np.where(words.ends - words.starts > 1, tokens.LOWER[words.data[np.maximum(words.ends - 2, 0)]], 0).astype(np.int64) if len(words.hashes) else last
    ending[place] = 1 + FREQUENT + ((last * 31 + before) * 40503 >> 4) % ENDINGS
    return h, ending, first


def _merged(h: np.ndarray, kind: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    u, at, inverse = np.unique(h, return_index=True, return_inverse=True)
    return u, kind[at], np.bincount(inverse, n, minlength=len(u)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words with their ending class and count."""
    kept: list = []
    size = 0

    def out() -> pa.RecordBatch:
        h, kind, n = _merged(*(np.concatenate([k[i] for k in kept]) for i in range(3)))
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(kind), pa.array(n)], names=["h", "ending", "n"])

    for _, data, offsets in tokens.blocks(batches, "_text"):
        h, ending, _ = _with_ends(tokens.hashed_words(data, offsets, tokens.space_separated()))
        kept.append(_merged(h, ending, np.ones(len(h))))
        size += len(kept[-1][0])
        if size > COUNTED:
            merged = _merged(*(np.concatenate([k[i] for k in kept]) for i in range(3)))
            kept, size = [merged], len(merged[0])
            if size > COUNTED * 3 // 4:
                yield out()
                kept, size = [], 0
    if kept:
        yield out()


def _classes(h: np.ndarray, ending: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    if not len(frequent):
        return ending
    i = np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)
    return np.where(frequent[i] == h, rank[i], ending)


def _contexts(c: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The three classes before each word as one number; before a text stand ends."""
    out = np.zeros(len(c), np.int64)
    place = np.arange(len(c)) - np.repeat(first[:-1], np.diff(first))
    for back in (1, 2, 3):
        shifted = np.zeros(len(c), np.int64)
        shifted[back:] = c[:-back]
        out += np.where(place >= back, shifted, 0) * CLASSES ** (back - 1)
    return out


def _features(context: np.ndarray) -> np.ndarray:
    """contexts x features: rows of the weight table; row 0 belongs to every context."""
    a, b, c = context % CLASSES, context // CLASSES % CLASSES, context // CLASSES**2
    one = np.ones_like(a)
    kinds = [(one, a, one * 0, one * 0), (one * 2, a, b, one * 0), (one * 3, one * 0, b, one * 0), (one * 4, one * 0, one * 0, c), (one * 5, a, one * 0, c), (one * 6, a, b, c)]
    hashed = [tokens.folded([x.astype(np.uint64) for x in k]) % np.uint64(BUCKETS - 1) + np.uint64(1) for k in kinds]
    return np.stack([np.zeros(len(context), np.uint64), *hashed], axis=1).astype(np.int64)


def class_logs(context: np.ndarray, w: np.ndarray) -> np.ndarray:
    """contexts x classes: natural logs of the class probabilities."""
    f = _features(context)
    z = w[f[:, 0]].astype(np.float64)
    for k in range(1, f.shape[1]):
        z += w[f[:, k]]
    z -= z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def _statistics(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, rank: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Counts of classes after each context, summed over a task."""
    kept = np.zeros(0, np.int64)
    counts = np.zeros(0, np.int64)

    def merged(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        u, inverse = np.unique(keys, return_inverse=True)
        return u, np.bincount(inverse, n, minlength=len(u)).astype(np.int64)

    for _, data, offsets in tokens.blocks(batches, "_text"):
        h, ending, first = _with_ends(tokens.hashed_words(data, offsets, tokens.space_separated()))
        c = _classes(h, ending, frequent, rank)
        u, n = np.unique(_contexts(c, first) * CLASSES + c, return_counts=True)
        kept, counts = merged(np.concatenate([kept, u]), np.concatenate([counts, n]))
        if len(kept) > COUNTED:
            yield pa.RecordBatch.from_arrays([pa.array(kept // CLASSES), pa.array(kept % CLASSES), pa.array(counts)], names=["context", "c", "n"])
            kept, counts = kept[:0], counts[:0]
    yield pa.RecordBatch.from_arrays([pa.array(kept // CLASSES), pa.array(kept % CLASSES), pa.array(counts)], names=["context", "c", "n"])


def _gradient(batches: Iterator[pa.RecordBatch], w: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row: the gradient of the log likelihood over this task's contexts, and the log likelihood."""
    g, total, any_rows = np.zeros_like(w, dtype=np.float64), 0.0, False
    for whole in batches:
        for at in range(0, whole.num_rows, 4096):
            batch = whole.slice(at, 4096)
            any_rows = True
            lists = batch.column(batch.schema.get_field_index("after"))
            flat = lists.flatten()
            row = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
            seen = np.zeros((len(lists), CLASSES))
            np.add.at(seen, (row, flat.field("c").to_numpy(zero_copy_only=False)), flat.field("n").to_numpy(zero_copy_only=False))
            context = batch.column(batch.schema.get_field_index("context")).to_numpy()
            logs = class_logs(context, w)
            total += float((seen * logs).sum())
            d = seen - seen.sum(axis=1, keepdims=True) * np.exp(logs)
            f = _features(context)
            for k in range(f.shape[1]):
                order = np.argsort(f[:, k], kind="stable")
                key = f[order, k]
                begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
                g[key[begin]] += np.add.reduceat(d[order], begin, axis=0)
    if any_rows:
        yield pa.RecordBatch.from_arrays([pa.array([g.astype(np.float32).tobytes()], pa.binary()), pa.array([total])], names=["g", "total"])


@dataclass
class Model:
    frequent: np.ndarray
    rank: np.ndarray
    w: np.ndarray
    #: steps inside a class
    depth: int
    #: by step inside a class: nodes x WAYS, natural logs of the smoothed shares
    shares: list[np.ndarray]
    #: by class, and by class and cell: natural log of the sum that word shares are divided by
    class_log: np.ndarray
    cell_log: np.ndarray
    #: weight rows x WAYS
    u: np.ndarray
    total_log10: float
    head: np.ndarray
    head_log: np.ndarray
    train_tokens: int
    distinct: int
    #: class shares by context, as far as a process needed them
    tables: list[np.ndarray] = field(default_factory=list)
    #: where the broadcast words of each first bits begin, made in each process
    begins: list[np.ndarray] = field(default_factory=list)

    def known(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each word among the broadcast ones, and whether it is one."""
        if not len(self.head):
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        bits = len(self.head).bit_length() + 1
        if not self.begins:
            sizes = np.bincount((self.head >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
            self.begins.append(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
        (begins,) = self.begins
        slot = (h >> np.uint64(64 - bits)).astype(np.int64)
        i = np.minimum(begins[slot], len(self.head) - 1).astype(np.int64)
        found = self.head[i] == h
        left = np.flatnonzero(~found)
        left = left[begins[slot[left] + 1] - i[left] > 1]
        while len(left):  # hashes are even: a word or two for the same first bits
            i[left] += 1
            found[left] = self.head[i[left]] == h[left]
            left = left[~found[left] & (begins[slot[left] + 1] - i[left] > 1)]
        return i, found

    def reference(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By context: logs of the shares of eight groups of classes, and those of each class inside its group; filled as contexts are met."""
        if not self.tables:
            size = CLASSES**3
            self.tables = [np.zeros(size, bool), np.zeros((size, WAYS), np.float32), np.zeros((size, WAYS, WAYS), np.float32)]
        filled, group, inside = self.tables
        new = np.unique(context[~filled[context]])
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            shares = class_logs(some, self.w).reshape(-1, WAYS, WAYS)
            group[some] = np.log(np.exp(shares).sum(axis=2))
            inside[some] = shares - group[some][:, :, None]
        filled[new] = True
        return group, inside


def cells(h: np.ndarray, found: np.ndarray, depth: int) -> np.ndarray:
    """Cell of each word in its class; words that are not broadcast share cell 0, which no other has."""
    return np.where(found, np.maximum((h >> np.uint64(64 - 3 * depth)).astype(np.int64), 1), 0)


def _before(h: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Hashes of the features of each place: the word before, and the two words before; before a text stand ends."""
    place = np.arange(len(h)) - np.repeat(first[:-1], np.diff(first))
    one, two = np.full(len(h), END), np.full(len(h), END)
    one[1:], two[2:] = h[:-1], h[:-2]
    one[place < 1], two[place < 2] = END, END
    return [tokens.folded([one]), tokens.folded([one, two])]


def _rows(feature: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Weight rows of a feature at nodes."""
    with np.errstate(over="ignore"):
        x = (feature ^ (node.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xD6E8FEB86659FD93)
    return (x >> np.uint64(64 - ROWS.bit_length() + 1)).astype(np.int64)


def choices(model: Model, c: np.ndarray, cell: np.ndarray, context: np.ndarray):
    """The steps of each word's path: places that take the step, their node, the way taken, and logs of the reference."""
    every = np.arange(len(c))
    group, inside = model.reference(context)
    yield every, np.zeros(len(c), np.int64), c // WAYS, np.take(group, context, axis=0)
    yield every, 1 + c // WAYS, c % WAYS, np.take(inside.reshape(-1, WAYS), context * WAYS + c // WAYS, axis=0)
    deep = np.flatnonzero(c > FREQUENT)
    at, base, cell = c[deep] - 1 - FREQUENT, 1 + WAYS, cell[deep]
    for step, shares in enumerate(model.shares):
        way = cell >> 3 * (model.depth - 1 - step) & (WAYS - 1)
        yield deep, base + at, way, np.take(shares, at, axis=0)
        base, at = base + len(shares), at * WAYS + way


def _weighted(z: np.ndarray, u: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Reference logs with the weights of all features; ways without words stay at minus infinity."""
    for r in rows:
        z += np.take(u, r, axis=0)
    return z


def _places(model: Model, batches: Iterator[pa.RecordBatch]):
    """Blocks of texts, with the words, their classes, cells, contexts and features, and whether a word is broadcast."""
    for batch, data, offsets in tokens.blocks(batches, "_text"):
        h, ending, first = _with_ends(tokens.hashed_words(data, offsets, tokens.space_separated()))
        c = _classes(h, ending, model.frequent, model.rank)
        i, found = model.known(h)
        yield batch, h, first, c, i, found, cells(h, found, model.depth), _contexts(c, first), _before(h, first)


def word_logs(model: Model, c: np.ndarray, cell: np.ndarray, context: np.ndarray, features: list[np.ndarray]) -> np.ndarray:
    """Natural logs of the probability of each word's class and cell after the words before it."""
    out = np.zeros(len(c))
    one = np.ones(WAYS, np.float32)
    for at in range(0, len(c), AT_ONCE):
        some = slice(at, at + AT_ONCE)
        for places, node, way, z in choices(model, c[some], cell[some], context[some]):
            z = _weighted(z, model.u, [_rows(f[some][places], node) for f in features])
            out[at + places] += z.reshape(-1)[np.arange(len(z)) * WAYS + way] - np.log(np.exp(z) @ one)
    return out


def _expected(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Weight rows met by a task, with the observed and expected counts of each way."""
    seen, expected = np.zeros(ROWS * WAYS), np.zeros(ROWS * WAYS)
    hits = np.zeros(ROWS * WAYS, np.int32)  # of a block, like the sums
    sums = np.zeros((ROWS, WAYS // 2), np.complex64)  # two ways in one number, for speed
    hit, one, plain = np.int32(1), np.ones(WAYS, np.float32), not model.u.any()
    read = replace(model, shares=[np.exp(x) for x in model.shares]) if plain else model
    for _, _, _, c, _, _, cell, context, features in _places(model, batches):
        for at in range(0, len(c), AT_ONCE):
            some = slice(at, at + AT_ONCE)
            for step, (places, node, way, z) in enumerate(choices(read, c[some], cell[some], context[some])):
                rows = [_rows(f[some][places], node) for f in features]
                if plain:  # inside a class the shares were read as such
                    p = np.exp(z) if step < 2 else z
                else:
                    p = np.exp(_weighted(z, model.u, rows))
                    p /= (p @ one)[:, None]
                p = p.view(np.complex64)
                for r in rows:
                    np.add.at(hits, r * WAYS + way, hit)
                    for pair in range(WAYS // 2):
                        np.add.at(sums[:, pair], r, p[:, pair])
        seen += hits
        expected += sums.view(np.float32).ravel()
        hits[:], sums[:] = 0, 0
    seen, expected = seen.reshape(ROWS, WAYS), expected.reshape(ROWS, WAYS)
    met = np.flatnonzero(expected.sum(axis=1))
    for at in range(0, len(met), 10_000):
        some = met[at : at + 10_000]
        yield pa.RecordBatch.from_arrays([pa.array(some), *[pa.array(x[some, k].astype(np.float32)) for x in (seen, expected) for k in range(WAYS)]], names=["row", *[f"{x}{k}" for x in "oe" for k in range(WAYS)]])


def in_few_tasks(training: DataFrame, words: int) -> DataFrame:
    """The same texts in so few tasks that the rows they send stay a share of the texts."""
    return training.coalesce(max(LEAST_TASKS, words // TASK_WORDS))


def _scaled(training: DataFrame, model: Model, rounds: int) -> Model:
    """The model with weights of words after so many steps of iterative scaling over all training texts."""
    context = training.sparkSession.sparkContext
    training = in_few_tasks(training, model.train_tokens)
    names = [f"{x}{k}" for x in "oe" for k in range(WAYS)]
    schema = "row bigint, " + ", ".join(f"{n} float" for n in names)
    for _ in range(rounds):
        shared = context.broadcast(model)
        counts = training.mapInArrow(lambda b, shared=shared: _expected(b, shared.value), schema).groupBy("row").agg(*[F.sum(n).alias(n) for n in names])
        ratios = [(F.ln((F.col(f"o{k}") + PSEUDO) / (F.col(f"e{k}") + PSEUDO)) / WORD_FEATURES).cast("float").alias(f"s{k}") for k in range(WAYS)]
        steps = staged(counts.select("row", *ratios), "lm-steps").toArrow()  # ROWS at most
        u = model.u.copy()
        for k in range(WAYS):
            u[steps["row"].to_numpy(), k] += steps[f"s{k}"].to_numpy()
        shared.destroy()
        model = replace(model, u=u)
    return model


def _trained(statistics: DataFrame, prior: np.ndarray, steps: int) -> np.ndarray:
    """Weights after so many steps on the gradient over all contexts, each weight with a rate of its own."""
    w = np.zeros((BUCKETS, CLASSES), np.float32)
    w[0] = np.log(prior)
    m, v = np.zeros(w.shape), np.zeros(w.shape)
    context = statistics.sparkSession.sparkContext
    for step in range(1, steps + 1):
        shared = context.broadcast(w)
        parts = statistics.mapInArrow(lambda b, shared=shared: _gradient(b, shared.value), "g binary, total double")
        g = np.zeros(w.shape)
        for r in parts.collect():  # the sums of a few tasks; the contexts are CLASSES ** 3 at most
            g += np.frombuffer(r["g"], np.float32).reshape(w.shape)
        shared.destroy()
        g = g - PRIOR * w
        m, v = 0.9 * m + 0.1 * g, 0.98 * v + 0.02 * g * g
        w = (w + RATE * 0.95**step * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.98**step)) + SLOW)).astype(np.float32)
    return w


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    held = (F.crc32(name) % 5 == 1).alias("held_out")
    text = F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    return docs.select(F.col(id_col).alias("_id"), held, F.xxhash64(F.col(id_col), F.col(text_col)).alias("_key"), text)


def fit(texts: DataFrame, head: int = HEAD, steps: int = STEPS, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model and the table (h, n) of all training words."""
    spark = texts.sparkSession
    training = texts.where(~F.col("held_out")).select("_text")
    counted = training.mapInArrow(_count, "h bigint, ending bigint, n bigint").groupBy("h").agg(F.min("ending").alias("ending"), F.sum("n").alias("n"))
    words = staged(counted, "lm-words")
    sums = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, distinct = int(sums["n"] or 0), int(sums["v"])
    top = words.where(F.col("h") != int(END)).orderBy(F.desc("n"), "h").limit(FREQUENT).collect()
    hashes = np.array([r["h"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    frequent, rank = hashes[order], (1 + np.arange(len(hashes)))[order]
    is_top = F.col("h").isin([int(r["h"]) for r in top]) if top else F.lit(False)
    rest = words.where(~is_top & (F.col("h") != int(END))).groupBy("ending").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    n, v = np.zeros(CLASSES), np.zeros(CLASSES)
    n[0], v[0] = sum(r["n"] for r in words.where(F.col("h") == int(END)).collect()), 1
    for i, r in enumerate(top):
        n[i + 1], v[i + 1] = r["n"], 1
    for r in rest:
        n[r["ending"]], v[r["ending"]] = r["n"], r["v"]
    # a class of one word has no unseen words beside it
    of_class = np.where(np.arange(CLASSES) <= FREQUENT, n + 0.5, n + 0.5 * (v + 1))
    sizes = words.groupBy(F.floor(F.log2("n")).alias("k")).count().orderBy(F.desc("k")).collect()
    least, held = 1 << 62, 0
    for r in sizes:
        held += r["count"]
        if held > head:
            break
        least = 1 << int(r["k"])
    common = words.where(F.col("n") >= least).select("h", "n").toArrow()  # `head` rows at most
    known = common["h"].to_numpy().view(np.uint64)
    by_hash = np.argsort(known)
    stats = training.mapInArrow(lambda b: _statistics(b, frequent, rank), "context bigint, c bigint, n bigint").groupBy("context", "c").agg(F.sum("n").alias("n"))
    grouped = stats.groupBy("context").agg(F.collect_list(F.struct("c", "n")).alias("after"))  # CLASSES entries at most
    statistics = staged(grouped.repartition(3), "lm-contexts")  # each step sends a table of weights for each part
    w = _trained(statistics, (n + 0.5) / (n + 0.5).sum(), steps)
    depth = 1
    while depth < DEEPEST and ENDINGS * WAYS**depth < len(known):
        depth += 1
    # sums of the words of each cell; cell 0 has those that are not broadcast and one unseen word
    is_known = F.col("n") >= least
    of_cell = F.when(is_known, F.greatest(F.shiftrightunsigned("h", 64 - 3 * depth), F.lit(1))).otherwise(0)
    placed = words.where(~is_top & (F.col("h") != int(END))).groupBy("ending", of_cell.cast("bigint").alias("cell")).agg(F.sum(F.col("n") + 0.5).alias("mass")).toArrow()  # as many rows as cells
    mass = np.zeros((ENDINGS, WAYS**depth))
    mass[placed["ending"].to_numpy() - 1 - FREQUENT, placed["cell"].to_numpy()] = placed["mass"].to_numpy()
    mass[:, 0] += 0.5
    shares = []
    with np.errstate(divide="ignore", invalid="ignore"):
        for step in range(depth):
            level = mass.reshape(ENDINGS * WAYS**step, WAYS, -1).sum(axis=2)
            # nobody goes through a node without words
            shares.append(np.where(level.sum(axis=1, keepdims=True) > 0, np.log(level) - np.log(level.sum(axis=1, keepdims=True)), -np.log(WAYS)).astype(np.float32))
        cell_log = np.log(mass)
    known, counts = known[by_hash], np.log10(common["n"].to_numpy()[by_hash] + 0.5)
    u = np.zeros((ROWS, WAYS), np.float32)
    model = Model(frequent, rank, w, depth, shares, np.log(of_class), cell_log, u, float(np.log10(total + 0.5 * (distinct + 1))), known, counts, total, distinct)
    return _scaled(training, model, rounds), words.where(F.col("n") < least).select("h", "n")


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """Per text: its tokens, known words and log sums as far as the frequent words go, and the words still to look up."""
    for batch, h, first, c, i, found, cell, context, features in _places(model, batches):
        logs = word_logs(model, c, cell, context, features)
        among = np.where(c > FREQUENT, model.cell_log[np.maximum(c - 1 - FREQUENT, 0), cell], model.class_log[c])
        count_log = np.where(found, model.head_log[i], 0.0) if len(model.head) else np.zeros(len(h))
        per_text = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  every text has its end
        n = np.diff(first)
        base = per_text(count_log) - n * model.total_log10
        score = per_text(logs - among) / LOG10 + per_text(count_log)
        text_of = np.repeat(np.arange(len(n), dtype=np.int64), n)[~found]
        rest = h[~found]
        order = np.lexsort((rest, text_of))
        text_of, rest = text_of[order], rest[order]
        new = np.concatenate(([True], (rest[1:] != rest[:-1]) | (text_of[1:] != text_of[:-1]))) if len(rest) else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        times = np.diff(np.append(begin, len(rest)))
        starts = pa.array(np.searchsorted(text_of[begin], np.arange(len(n) + 1)), pa.int32())
        lists = [pa.ListArray.from_arrays(starts, pa.array(x)) for x in (rest[begin].view(np.int64), times.astype(np.int64))]
        own = [batch.column(batch.schema.get_field_index(x)) for x in ("_id", "held_out", "_key")]
        yield pa.RecordBatch.from_arrays([*own, pa.array(n), pa.array(per_text(found.astype(np.int64))), pa.array(base), pa.array(score), *lists], names=["_id", "held_out", "_key", "n_tokens", "n_known", "base_score", "score", "rest", "times"])


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD, steps: int = STEPS, rounds: int = ROUNDS) -> DataFrame:
    """Per row: id, held_out, n_tokens, n_known, train_tokens, base_score and score, both log10.

    Training takes the rows whose crc32 of the id as text leaves another remainder
    than 1 by 5; a NULL id counts as the empty text. NULL or empty text is one end
    token; repeated rows each count in training and get equal scores; without
    training rows all words are unknown; an empty table gives an empty result.
    Other columns are not read.
    """
    spark = docs.sparkSession
    texts = _texts(docs, id_col, text_col)
    model, rare = fit(texts, head, steps, rounds)
    shared = spark.sparkContext.broadcast(model)
    id_type = texts.schema["_id"].dataType.simpleString()
    schema = f"_id {id_type}, held_out boolean, _key bigint, n_tokens bigint, n_known bigint, base_score double, score double, rest array<bigint>, times array<bigint>"
    rows = staged(texts.mapInArrow(lambda b: _score(b, shared.value), schema), "lm-scores")
    shared.destroy()
    asked = rows.where(F.size("rest") > 0).dropDuplicates(["_key"]).select("_key", F.explode(F.arrays_zip("rest", "times")).alias("e")).select("_key", F.col("e.rest").alias("h"), F.col("e.times").alias("t"))
    met = asked.join(rare, "h", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    sums = met.groupBy("_key").agg(F.sum(F.col("t") * F.log10(F.col("n") + 0.5)).alias("_log"), F.sum(F.when(F.col("n") > 0, F.col("t")).otherwise(0)).alias("_more"))
    out = rows.drop("rest", "times").join(sums, "_key", "left")
    add = F.coalesce("_log", F.lit(0.0))
    return out.select(
        F.col("_id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("_more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + add).alias("base_score"),
        (F.col("score") + add).alias("score"),
    )
