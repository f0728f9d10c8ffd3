"""Quality of documents from overlapping heuristic labellers, without given labels.

Labellers look at a text's marks, letters, words and repetition and vote good,
bad or nothing. Expectation-maximisation over the counts of vote patterns (a few
thousand at most, counted over all documents) estimates how often each labeller
is right and the share of good documents. The posterior of a document's votes is
the label on which a hashed linear scorer is trained; the scorer then judges
every document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.llm import tokens
from panelspark.llm.stage import packed, refuse_clash, staged, unpacked

#: Documents whose posterior labels train the scorer: those with the smallest hashes, equal ids and texts once.
SAMPLE = 6000
BYTE_FEATURES = 1 << 12
WORD_FEATURES = 1 << 14
#: Whether a word repeats one of so many before it, and how far back.
BACK = 8
FEATURES = BYTE_FEATURES + WORD_FEATURES + BACK + 1
STEPS = 80
#: A document stays if the scorer's probability of good is at least this.
KEEP = 0.5

GOOD, BAD, NONE = 1, 2, 0
LABELLERS = ("symbols", "capitals", "exclaims", "bars", "function_words", "plain_words", "sentences", "repetition", "echoes")

# Frequent function words of English, French, German and Spanish.
FUNCTION_WORDS = (
    "the of and to in is that for it with as was on are be this by from or an at not have which "
    "le la les de des du un une et est que qui dans pour pas au avec sur ce il "
    "der die das und den von zu mit sich auf für ist im dem nicht ein eine als auch es "
    "el los las que en por con para del se una su lo como más pero sus al"
).split()


def _function_words() -> np.ndarray:
    raw = " ".join(FUNCTION_WORDS).encode()
    data = np.frombuffer(raw, np.uint8)
    return np.unique(tokens.hashed_words(data, np.array([0, len(raw)]), tokens.space_separated()).hashes)


def _odd() -> np.ndarray:
    """ASCII marks that do not belong to words or to plain punctuation."""
    out = np.zeros(256, bool)
    out[33:127] = True
    out[[c for c in range(128) if chr(c).isalnum() or chr(c) in ".,;:?'\"()-/@+"]] = False
    return out


_KNOWN, _ODD = _function_words(), _odd()


def _per_text(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(mask)))
    return total[offsets[1:]] - total[offsets[:-1]]


def _vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, NONE))


def _is(data: np.ndarray, characters: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(characters)] = True
    return table[data]


def votes(data: np.ndarray, offsets: np.ndarray, words: tokens.Words) -> np.ndarray:
    """texts x labellers; words are space separated."""
    size = np.maximum(np.diff(offsets), 1)
    n = np.diff(words.first)
    per_word = np.maximum(n, 1)
    symbols = _per_text(_is(data, b"#$%&*<>{}[]\\^~=_"), offsets) / size
    upper = _per_text((data >= 65) & (data <= 90), offsets)
    letters = np.maximum(upper + _per_text((data >= 97) & (data <= 122), offsets), 1)
    exclaims = _per_text(data == 33, offsets) / per_word
    bars = _per_text(data == 124, offsets) / per_word
    known = _per_text(_KNOWN[np.minimum(np.searchsorted(_KNOWN, words.hashes), len(_KNOWN) - 1)] == words.hashes, words.first) / per_word
    stops = _per_text(_is(data, b".,;:?"), offsets) / per_word
    text_of = np.repeat(np.arange(len(n), dtype=np.uint64), n)
    distinct = np.zeros(len(n), np.int64)
    if len(text_of):
        keys = np.unique((text_of << np.uint64(44)) | (words.hashes >> np.uint64(20)))
        distinct = np.bincount((keys >> np.uint64(44)).astype(np.int64), minlength=len(n))
    odd = np.concatenate(([0], np.cumsum(_ODD[data])))
    plain = _per_text(odd[words.ends] == odd[words.starts], words.first) / per_word
    same = np.zeros(len(words.hashes), bool)
    same[1:] = words.hashes[1:] == words.hashes[:-1]
    same[words.first[:-1][n > 0]] = False
    echoes = _per_text(same, words.first) / per_word
    some = n > 0
    return np.stack(
        [
            _vote(some & (symbols < 0.01), symbols > 0.04),
            _vote(some & (upper / letters < 0.15), (upper / letters > 0.35) & (n > 3)),
            _vote(some & (exclaims < 0.1), exclaims > 0.2),
            _vote(some & (bars == 0), bars > 0.15),
            _vote(known > 0.12, (known < 0.04) & (n > 10)),
            _vote(plain > 0.85, some & (plain < 0.6)),
            _vote((stops > 0.03) & (stops < 0.6) & (n > 10), (stops < 0.005) & (n > 20)),
            _vote((n > 40) & (distinct / per_word > 0.25), (n > 40) & (distinct / per_word < 0.15)),
            _vote((n > 10) & (echoes < 0.05), (n > 5) & (echoes > 0.2)),
        ],
        axis=1,
    )


@dataclass
class LabelModel:
    prior: float
    #: labellers x votes: chances of each vote for good and for bad documents
    good: np.ndarray
    bad: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Chance of good for rows of votes."""
        k, voted = np.arange(patterns.shape[1]), patterns != NONE
        up = np.log(self.prior) + (voted * np.log(self.good[k, patterns])).sum(axis=1)
        down = np.log(1 - self.prior) + (voted * np.log(self.bad[k, patterns])).sum(axis=1)
        return 1 / (1 + np.exp(np.clip(down - up, -500, 500)))


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, tolerance: float = 1e-9) -> LabelModel:
    """Expectation-maximisation of independent labellers from the counts of vote patterns.

    Starts from the number of bad votes, so good and bad keep their meaning.
    """
    if not len(counts):
        flat = np.full((len(LABELLERS), 3), 0.5)
        return LabelModel(0.5, flat, flat)
    up, down = (patterns == GOOD).sum(axis=1), (patterns == BAD).sum(axis=1)
    p = np.where(down >= 2, 0.02, np.where(down == 1, 0.7, np.where(up > 0, 0.98, 0.5)))
    for _ in range(rounds):
        weights = counts * p, counts * (1 - p)
        prior = float(np.clip((weights[0].sum() + 1) / (counts.sum() + 2), 1e-4, 1 - 1e-4))
        tables = []
        for w in weights:
            t = np.stack([np.bincount(patterns[:, k], w, minlength=3) for k in range(patterns.shape[1])]) + 0.5
            t[:, NONE] = 0
            t /= t.sum(axis=1, keepdims=True)
            t[:, NONE] = 1  # a labeller that says nothing tells nothing
            tables.append(t)
        model = LabelModel(prior, *tables)
        now = model.posterior(patterns)
        moved = float((np.abs(now - p) * counts).sum() / counts.sum())
        p = now
        if moved < tolerance:
            break
    return model


def _features(data: np.ndarray, offsets: np.ndarray, words: tokens.Words) -> list[tuple[np.ndarray, np.ndarray]]:
    """Features in three ranges, each with the texts' offsets: byte classes in threes, words, and repeats of words."""
    b = _CLASS[data]
    run = b.copy()
    run[1:] += b[:-1] * np.uint32(41)
    run[2:] += b[:-2] * np.uint32(1681)
    by_byte = (run * np.uint32(2654435761)) >> np.uint32(20)
    by_word = (words.hashes >> np.uint64(50)).astype(np.int64)
    repeat = np.zeros(len(words.hashes), np.int64)
    for back in range(BACK, 0, -1):
        repeat[back:][words.hashes[back:] == words.hashes[:-back]] = back
    return [(by_byte.astype(np.int64), offsets), (by_word + BYTE_FEATURES, words.first), (repeat + BYTE_FEATURES + WORD_FEATURES, words.first)]


def _classes() -> np.ndarray:
    """Letters by case, digits, spaces, bytes beyond ASCII; every mark is a class of its own."""
    out = np.arange(256, dtype=np.uint32)
    out[65:91], out[97:123], out[48:58], out[128:] = 1, 2, 3, 4
    out[[9, 11, 12, 13]] = 32
    return out


_CLASS = _classes()


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0.0], np.cumsum(values)))
    return total[at[1:]] - total[at[:-1]]


def train(rows: np.ndarray, columns: np.ndarray, values: np.ndarray, target: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Weights of a logistic scorer on soft labels, by gradient steps with per-weight rates. The last weight is the offset."""
    n = len(target)
    w, seen = np.zeros(FEATURES + 1), np.full(FEATURES + 1, 1e-8)
    for _ in range(steps if n else 0):
        z = np.bincount(rows, values * w[columns], minlength=n) + w[-1]
        r = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - target
        g = np.append(np.bincount(columns, values * r[rows], minlength=len(w) - 1), r.sum()) / n + 1e-6 * w
        seen += g * g
        w -= 0.5 * g / np.sqrt(seen)
    return w


#: Shares of features are small; this makes their weights comparable with the offset.
SCALE = 20.0


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in tokens.blocks(batches, "_text"):
        words = tokens.hashed_words(data, offsets, tokens.space_separated())
        pattern = (votes(data, offsets, words) * 3 ** np.arange(len(LABELLERS))).sum(axis=1)
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("h")), pa.array(pattern, pa.int64())], names=["h", "pattern"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in tokens.blocks(batches, "_text"):
        words = tokens.hashed_words(data, offsets, tokens.space_separated())
        features = _features(data, offsets, words)
        columns, values = [], []
        for i in range(batch.num_rows):
            c, v = [], []
            for f, at in features:
                ids, k = np.unique(f[at[i] : at[i + 1]], return_counts=True)
                c.append(ids)
                v.append(k * (SCALE / max(1, k.sum())))
            columns.append(np.concatenate(c))
            values.append(np.concatenate(v))
        keep = [batch.column(batch.schema.get_field_index(x)) for x in ("h", "pattern")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(columns, pa.list_(pa.int64())), pa.array(values, pa.list_(pa.float64()))], names=["h", "pattern", "columns", "values"])


def _score(batches: Iterator[pa.RecordBatch], w: np.ndarray, model: LabelModel) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in tokens.blocks(batches, "_text"):
        words = tokens.hashed_words(data, offsets, tokens.space_separated())
        z = w[-1] + SCALE * sum(_sums(w[f], at) / np.maximum(np.diff(at), 1) for f, at in _features(data, offsets, words))
        weak = model.posterior(votes(data, offsets, words))
        at = batch.schema.get_field_index("_text")
        columns = [c for i, c in enumerate(batch.columns) if i != at]
        names = [n for n in batch.schema.names if n != "_text"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30)))), pa.array(weak)], names=[*names, "score", "weak_score"])


def unpack(pattern: np.ndarray) -> np.ndarray:
    return pattern[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> tuple[LabelModel, np.ndarray]:
    """The label model from the votes on all documents and the scorer's weights from a bounded sample of them."""
    hashed = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("h"), F.col(text_col).alias("_text"))
    described = staged(hashed.mapInArrow(_describe, "h bigint, pattern bigint"), "quality-votes")
    counted = described.groupBy("pattern").count().collect()  # 3 ** 9 patterns at most
    patterns = unpack(np.array([r["pattern"] for r in counted], np.int64).reshape(-1))
    model = fit_labels(patterns, np.array([r["count"] for r in counted], float))
    chosen = staged(described.groupBy("h").agg(F.min("pattern").alias("pattern")).orderBy("h").limit(sample), "quality-sample")
    rows = hashed.join(F.broadcast(chosen), "h").dropDuplicates(["h"])  # `sample` rows at most
    table = rows.mapInArrow(_sparse, "h bigint, pattern bigint, columns array<bigint>, values array<double>").toArrow().sort_by("h")
    target = model.posterior(unpack(table["pattern"].to_numpy().reshape(-1)))
    columns, values = table["columns"].combine_chunks(), table["values"].combine_chunks()
    lengths = np.array([len(c) for c in columns], np.int64)
    of = np.repeat(np.arange(len(lengths)), lengths)
    return model, train(of, columns.flatten().to_numpy(), values.flatten().to_numpy(), target)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), sample: int = SAMPLE) -> DataFrame:
    """Per row: id, the columns in `keep`, score (chance of good by the scorer) and weak_score (by the votes alone).

    NULL or empty text is judged like any other, from its votes and the offset;
    repeated rows get equal scores; an empty table gives an empty result. Scores do
    not depend on how the rows are dealt out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col, sample))
    names = list(dict.fromkeys([id_col, *keep]))
    refuse_clash(names, ("score", "weak_score", "_text"))
    base = docs.select(*names, F.col(text_col).alias("_text"))
    schema = T.StructType(base.schema.fields[:-1]).add("score", "double").add("weak_score", "double")
    return base.mapInArrow(lambda b: _score(b, shared.value[1], shared.value[0]), schema)


def good_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = KEEP) -> DataFrame:
    """The documents that the scorer does not reject, with their own columns, whatever their names.

    NULL or empty text, a NULL id and repeated rows are judged like any other row;
    an empty table stays empty.
    """
    scored = score(packed(docs, _id=id_col, _doc=text_col), "_id", "_doc", keep=("_row",))
    return unpacked(scored.where(F.col("score") >= threshold), docs)
