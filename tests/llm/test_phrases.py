"""Phrases against plain counting, at budgets that split words, pairs and whole suffixes."""

import collections
import random
import re

import numpy as np
import pytest

from panelspark.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = "doc_id bigint, text string, lang string, k bigint, a bigint, _lang string, rank string"


def by_hand(texts, min_count=10, covered=50, top=2000):
    """texts: (text, lang) pairs."""
    count = collections.defaultdict(collections.Counter)
    for text, lang in texts:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            for k in (1, 2, 3):
                count["und" if lang is None else lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in count.items():
        n, found = sum(c for p, c in f.items() if len(p) == 1), []
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        longer = collections.Counter()
        for p, a in candidates.items():
            if len(p) == 3:
                for q in (p[:2], p[1:]):
                    longer[q] = max(longer[q], a)
        for p, a in candidates.items():
            if len(p) == 2 and p in longer and 100 * longer[p] >= covered * a:
                continue
            score, k = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def mined(rows, texts, **options):
    table = rows([(i, t, lang, 1, 2, "x", "y") for i, (t, lang) in enumerate(texts)], COLUMNS)
    return sorted(tuple(r) for r in phrases.mine(table, **options).collect())


def corpus(seed, n=60):
    draw = random.Random(seed)
    words = ["the", "The", "of", "New", "York", "city", "é", "naïve", " x", "a" * 70, *(f"w{i}" for i in range(40))]
    weights = [30, 10, 20, 6, 6, 4, 3, 3, 3, 2, *[1] * 40]
    texts = []
    for _ in range(n):
        parts = draw.choices(words, weights, k=draw.randrange(400))
        texts.append(("".join(w + draw.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\r\n"]) for w in parts), draw.choice(["en", "en", "de", None, "und"])))
    texts += [("new york city " * 3000, "en"), ("of the " * 2000, "en")] + [("A very common line of words", "de")] * 300
    return texts


@pytest.mark.parametrize("budget", [phrases.BUDGET, 4000, 150, 8])
def test_equals_plain_counting(rows, budget):
    texts = corpus(4)
    assert mined(rows, texts, budget=budget, slot_bits=8, room=500 if budget < 1000 else 1_000_000) == by_hand(texts)


def test_top_and_ties(rows):
    texts = [(". ".join(f"p{i} q{i}" for i in range(40)), "en")] * 12 + [("p1 q1 z", "fr")] * 9
    assert mined(rows, texts, top=7) == by_hand(texts, top=7)
    assert len(mined(rows, texts, top=7)) == 7


def test_odd_rows(rows):
    texts = [(None, "en"), ("", None), (" \t\n", "xx"), ("one", "en"), ("...", ""), ("\x00 \x0b © ü", "en"), ("long " * 30_000, "zz")]
    assert mined(rows, texts) == by_hand(texts)
    assert mined(rows, []) == []


def test_groups_keep_their_budget():
    draw = np.random.default_rng(0)
    weights = draw.zipf(1.3, 1 << 12).clip(max=10**7)
    seen = []

    def count_pieces(groups):
        n = int(groups.pieces.sum())
        counts = draw.zipf(1.5, n).clip(max=10**6)
        seen.append(counts)
        return counts

    groups = phrases.vertical_partitioning(weights, 50_000, count_pieces)
    sizes = collections.Counter()
    for g, w in zip(groups.slots.tolist(), weights.tolist(), strict=True):
        if g >= 0:
            sizes[g] += w
    for g, w, parts in zip(groups.piece_group.tolist(), seen[0].tolist(), groups.piece_parts.tolist(), strict=True):
        for i in range(parts):
            sizes[g + i] += -(-w // parts)
    assert max(sizes.values()) <= max(50_000, 4 * weights.sum() // len(weights))
    assert min(groups.slots[(weights > 0)]) != -1


def test_scores_of_large_counts(spark):
    cases = [(10**12, 10**13, 10**12 + 7), (3 * 10**9, 5 * 10**12, 4 * 10**9), (10, 10, 10), (999_999_937, 10**10, 10**9 + 1)]
    table = spark.createDataFrame(cases, "a bigint, l bigint, r bigint")
    got = [r[0] for r in table.select(phrases._score(table["a"], table["l"], table["r"])).collect()]
    assert got == [1000000 * a * a // (left * right) for a, left, right in cases]
