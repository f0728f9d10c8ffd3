"""Hard negatives against all inner products, with ties, copies, odd rows and thresholds that must be lowered."""

import math

import numpy as np
import pytest

from panelspark.llm import hard_negatives

COLUMNS = "vec_id bigint, embedding array<double>, label int, row bigint, v string, id string, rank int, key int"


def table(rows, data):
    return rows([(i, v, c, 5, "x", "y", 1, 2) for i, v, c in data], COLUMNS)


def by_hand(data, every=50, scale=256):
    ok = [(i, [math.floor(scale * x) for x in v], c) for i, v, c in data if None not in (i, c) and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (a, x, label) in enumerate(ok):
        if a % every:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=False)), i, c) for m, (i, y, c) in enumerate(ok) if m != n)
        for ps, p, _ in [s for s in scored if s[2] == label][:5]:
            window = [(i, -s) for s, i, c in scored if c != label and 50 * -ps <= 100 * -s <= 95 * -ps]
            out += [(a, p, k, i, -ps, s) for k, (i, s) in enumerate(window[:3], 1)]
    return sorted(out)


def mined(rows, data, every=50, **options):
    return sorted(tuple(r) for r in hard_negatives.mine(table(rows, data), lambda i: i % every == 0, **options).collect())


def clustered(n, dims, seed, labels=4, norms=0.0):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(labels, dims))
    label = r.integers(0, labels, n)
    x = (centres[label] * 0.5 + r.normal(size=(n, dims))) * np.exp(norms * r.normal(size=(n, 1))) / dims
    return [(int(i), [float(z) for z in v], int(c)) for i, v, c in zip(r.permutation(n), x, label, strict=True)]


@pytest.mark.parametrize(("n", "dims", "norms"), [(4000, 64, 0.0), (3500, 24, 1.0), (300, 7, 0.3)])
def test_equals_all_products(rows, n, dims, norms):
    data = clustered(n, dims, seed=n, norms=norms)
    assert mined(rows, data, anchors=40) == by_hand(data)


def test_ties_and_copies(rows):
    r = np.random.default_rng(1)
    data = [(i, [float(z) for z in r.integers(-2, 3, 6) / 16], int(r.integers(0, 3))) for i in range(1200)]
    data += [(50, [0.25] * 6, 0)] * 4 + [(2000 + i, [0.25] * 6, i % 3) for i in range(700)]
    assert mined(rows, data) == by_hand(data)


def test_odd_rows(rows):
    inf, nan = float("inf"), float("nan")
    data = [(0, [1.0, 0.5], 1), (1, [0.9, 0.4], 1), (2, [0.7, 0.3], 2), (3, None, 2), (None, [0.7, 0.3], 2), (4, [0.7, 0.3], None), (5, [0.7, None], 2), (6, [inf, 0.1], 2)]
    data += [(7, [0.7, nan], 2), (100, [], 2), (8, [0.0, 0.0], 1), (50, [0.0, 0.0], 2), (9, [0.6], 3), (10, [0.6, 0.2, 9.0], 4), (-50, [-1.0, -0.5], 1), (150, [0.7, 0.3], 9)]
    assert mined(rows, data) == by_hand(data)
    assert mined(rows, []) == [] and mined(rows, [(1, [1.0], 1), (2, [1.0], 2)]) == []


def test_scores_beyond_doubles(rows):
    r = np.random.default_rng(2)
    data = [(i, [float(z) for z in r.integers(-(10**5), 10**5, 4)], int(r.integers(0, 2))) for i in range(400)]
    assert mined(rows, data, scale=1000) == by_hand(data, scale=1000)
    with pytest.raises(ValueError, match="64 bits"):
        mined(rows, [(0, [1e9], 1), (1, [1e9], 2)])


def test_index_leaves_dimensions_out_and_loses_no_pair():
    r = np.random.default_rng(5)
    x = np.floor(r.normal(size=(600, 48)) * 40 * np.exp(-np.arange(48) / 8))
    a = x[::30]
    score = a @ x.T
    xn, an = hard_negatives._norms(x), hard_negatives._norms(a)
    least, most = np.quantile(score, 0.97, axis=1), np.full(len(a), np.inf)
    cover = np.min(least[:, None] / an[:, :-1], axis=0)
    assert 0.05 < (xn[:, :-1] >= cover).mean() < 0.5  # most entries are left out
    space = hard_negatives.Space(np.arange(48), True, 0.0)
    i, j, s = hard_negatives._pairs(x, a, xn, an, least, most, np.ones((600, len(a)), bool), space)
    want = {(int(p), int(q)) for q, p in zip(*np.nonzero(score >= least[:, None]), strict=True)}
    assert set(zip(i.tolist(), j.tolist(), strict=True)) == want and (s == score[j, i]).all()
