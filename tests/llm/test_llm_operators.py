"""Text operators against brute force and on empty, NULL, repeated, tied and oddly named rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from panelspark.llm import (
    boosting,
    components,
    decontamination,
    html_nodes,
    html_pages,
    html_text,
    jaccard,
    language_model,
    license_texts,
    licenses,
    mixing,
    neighbours,
    pii,
    quality_model,
    sharding,
    tokens,
)

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, _source string, c bigint, count bigint"


def docs(rows, texts):
    """Documents with clashing extra columns; texts are (id, text) pairs."""
    return rows([(i, t, "en", f"src{(i or 0) % 3}", len(t or ""), "x", 7, 8) for i, t in texts], DOCS)


def prose(seed, n):
    r = np.random.default_rng(seed)
    return " ".join("".join(r.choice(list("abdeilmnorst"), r.integers(1, 7))) for _ in range(n))


ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "two words"), (6, "Ünï \x00 ©"), (7, "long " * 30_000)]


def test_words_and_hashes_equal_plain_splitting():
    texts = ["A b  cé\nD", "", "x" * 9000 + " y", "\x00z Z", " tail ", "é,è.ç A1b"]
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    for word, pattern in ((tokens.space_separated(), "[^\x20\x09-\x0d]+"), (tokens.letters_and_digits(), "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")):
        w = tokens.hashed_words(np.frombuffer(b"".join(data), np.uint8), offsets, word)
        want = [re.findall(pattern, t.translate(LOWER)) for t in texts]
        got = [[w.text(i).decode() for i in range(w.first[k], w.first[k + 1])] for k in range(len(texts))]
        assert got == want
        by_hash = collections.defaultdict(set)
        for k, ws in enumerate(want):
            for j, x in enumerate(ws):
                by_hash[int(w.hashes[w.first[k] + j])].add(x)
        assert all(len(v) == 1 for v in by_hash.values()) and len(by_hash) == len({x for ws in want for x in ws})


# ---- op1


def test_html_made_pages_held_out():
    pages = html_pages.made_pages(150, seed=909)
    model, exact = html_text.trained(), 0
    for h in pages:
        want = "\n".join(t.replace(html_pages.MARK, "").strip() for t in html_nodes.parse(h).text if html_pages.MARK in t)
        exact += html_text.main_texts([h.replace(html_pages.MARK, "")], model)[0] == want
    assert exact >= 0.9 * len(pages)


def test_html_layout_and_edges(spark, rows):
    article = "<article><h1>A &amp; B</h1><p>One\n two&nbsp;three<br>four.<p>Five <b>six</b></article>"
    noise = "<nav><ul><li><a href=/>Home</a><li><a href=/x>More</a></ul></nav>", '<div class="cookie-banner">We use cookies here.</div>', "<footer>&copy; us</footer>", "<script>var t='<p>no</p>'</script><!-- <p>no</p> -->"
    page = f"<html><head><title>T</title></head><body>{noise[0]}{noise[1]}{article}{noise[2]}{noise[3]}"
    table = rows([(1, "u", page, 5), (2, "v", None, 5), (3, None, "", 5), (4, "w", "<p", 5), (1, "u", page, 5)], "page_id bigint, url string, html string, end bigint")
    got = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in html_text.extract(table).collect()), key=str)
    text = "A & B\nOne two three four.\nFive six"
    assert got == sorted([(1, text, len(text)), (1, text, len(text)), (2, "", 0), (3, "", 0), (4, "", 0)], key=str)
    assert html_text.extract(table.limit(0)).count() == 0


def test_html_decoding_keeps_no_child_of_a_dropped_node():
    r = np.random.default_rng(4)
    for h in html_pages.made_pages(30, seed=5):
        p = html_nodes.parse(h)
        margin = r.normal(size=len(p.tag)) * 3
        kept = html_text.decode(p, margin)
        assert all(not k or q < 0 or kept[q] for k, q in zip(kept, p.parent, strict=True))
        score = lambda c: sum(-np.logaddexp(0, -m) if k else -np.logaddexp(0, m) for k, m in zip(c, margin, strict=True))
        for i in range(1, min(len(kept), 12)):  # no single subtree change is better
            other = list(kept)
            for j in range(i, p.end[i]):
                other[j] = False
            assert score(other) <= score(kept) + 1e-9


def test_boosting_learns_an_interaction():
    r = np.random.default_rng(1)
    x = r.normal(size=(2000, 6))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.2)).astype(float)
    m = boosting.fit(x[:1500], y[:1500], trees=30, depth=3)
    assert ((m.margin(x[1500:].astype(np.float32)) > 0) == (y[1500:] > 0)).mean() > 0.93


# ---- op2


def test_em_recovers_labellers_and_scores_whole_table(spark, rows):
    r = np.random.default_rng(0)
    truth = r.random(6000) < 0.8
    right = [0.95, 0.9, 0.85, 0.8]
    votes = np.stack([np.where(r.random(6000) < 0.3, 0, np.where((r.random(6000) < a) == truth, 1, 2)) for a in right], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_model.fit_labels(patterns, counts.astype(float))
    assert abs(model.prior - 0.8) < 0.05
    assert np.abs(model.good[:, 1] - right).max() < 0.06
    good = [(i, "The cat sat on the mat, and " + prose(i, 40) + ".") for i in range(40)]
    bad = [(100 + i, " ".join(f"{w}%%%" for w in prose(i, 50).split())) for i in range(10)]
    out = {r["doc_id"]: r for r in quality_model.score(docs(rows, good + bad + [(1000 + (i or 0), t) for i, t in ODD[:7]])).collect()}
    assert all(out[i]["weak_score"] > 0.5 for i, _ in good) and all(out[i]["weak_score"] < 0.5 for i, _ in bad)
    assert all(out[i]["score"] > 0.5 for i, _ in good) and all(out[i]["score"] < 0.5 for i, _ in bad)
    kept = quality_model.good_documents(docs(rows, good + bad))
    assert kept.columns == docs(rows, good).columns and {r["doc_id"] for r in kept.collect()} == {i for i, _ in good}
    assert quality_model.score(docs(rows, good).limit(0)).count() == 0


# ---- op3


def shingles(t):
    w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def classes_by_brute_force(texts):
    sets = [shingles(t) for _, t in texts]
    up = list(range(len(texts)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(texts):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(s), least[root(i)] if s else d) for i, ((d, _), s) in enumerate(zip(texts, sets, strict=True)))


def near_copies(seed=3):
    """Groups of near copies with a common passage, copies, and unrelated texts."""
    r = np.random.default_rng(seed)
    passage, out = prose(999, 50), []
    for g in range(6):
        base = prose(g, int(r.integers(12, 120))).split()
        for _ in range(int(r.integers(1, 14))):
            w = list(base)
            for k in r.integers(0, len(w), int(r.integers(0, max(2, len(w) // 14)))):
                w[k] = prose(int(r.integers(1e9)), 1)
            out.append(" ".join(w))
    out += [prose(5000 + i, int(r.integers(8, 30))) + " " + passage for i in range(30)] + out[:5]
    order = r.permutation(len(out))
    return [(int(i), out[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("region,levels", [(64, 6), (4, 6), (2, 2)])
def test_jaccard_classes_equal_brute_force(spark, rows, monkeypatch, region, levels):
    monkeypatch.setattr(jaccard, "REGION", region)
    monkeypatch.setattr(jaccard, "LEVELS", levels)
    monkeypatch.setattr(jaccard, "PIVOTS", 3)
    texts = near_copies()
    got = jaccard.near_duplicates(docs(rows, texts))
    assert sorted(map(tuple, got.collect())) == classes_by_brute_force(texts)


def test_jaccard_edges(spark, rows):
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs(rows, ODD)).collect()}
    assert got == {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (None, 1, None), (6, 1, 6), (7, 1, 7)}
    one = jaccard.one_of_each(docs(rows, [(1, "a b"), (1, "a b"), (2, "a b"), (3, None), (3, None)]))
    assert sorted(r["doc_id"] for r in one.collect()) == [1, 3] and one.columns == docs(rows, ODD).columns
    assert jaccard.near_duplicates(docs(rows, ODD).limit(0)).count() == 0


def test_one_row_of_each_component_stays_whatever_the_ids(spark, rows):
    a, b, c, d = (prose(60_000 + i, 20) for i in range(4))
    table = [(None, a), (None, b), (None, b), (None, c), (1, c), (1, d), (2, d.upper()), (2, None), (2, None), (2, ""), (None, None), (None, None)]
    got = [(r["doc_id"], r["text"]) for r in jaccard.one_of_each(docs(rows, table)).collect()]
    assert sorted(got, key=str) == sorted([(None, a), (None, b), (1, c), (1, d), (2, None), (2, ""), (None, None)], key=str)


def drifting(count=300, seed=11, blocks=12):
    """Variants of one text, each with one block of another's exchanged for the block's other wording; every wording is frequent."""
    r = np.random.default_rng(seed)
    wording = [(prose(20_000 + i, 8), prose(30_000 + i, 8)) for i in range(blocks)]
    made = [tuple(int(x) for x in r.integers(0, 2, blocks))]
    while len(made) < count:
        v = list(made[max(0, len(made) - 1 - int(r.integers(0, 40)))])
        v[int(r.integers(0, blocks))] ^= 1
        if tuple(v) not in made:
            made.append(tuple(v))
    made = [v for i, v in enumerate(made) if i % 5]
    return [(i, " ".join(wording[k][x] for k, x in enumerate(v))) for i, v in enumerate(made)]


def test_jaccard_drifting_variants_equal_brute_force(spark, rows):
    """Distances to pivots above the limit are needed as they are: neighbours on both sides of one lie in its cell."""
    texts = drifting()
    got = jaccard.near_duplicates(docs(rows, texts))
    assert sorted(map(tuple, got.collect())) == classes_by_brute_force(texts)


def test_jaccard_cells_hold_true_distances(spark, rows):
    """Members beyond the limit from a pivot keep their distance, so pairs within it share a cell and pass its window."""
    texts = drifting(40)
    table = docs(rows, texts).selectExpr("doc_id as _id", "xxhash64(text) as _hash", "text as _text").localCheckpoint()
    base = table.mapInArrow(lambda b: jaccard._describe(b, 5), "_id bigint, _hash bigint, n bigint, c bigint, profile binary, counts array<int>").where("n > 0").localCheckpoint()
    text_of = {r["c"]: shingles(dict(texts)[r["_id"]]) for r in base.collect()}
    away = lambda a, b: 1 - len(text_of[a] & text_of[b]) / len(text_of[a] | text_of[b])
    large = base.selectExpr("1L as s", "c", "n", "0L as p", "0D as d", "1L as weight", f"{len(texts)}L as members")
    cells = collections.defaultdict(dict)
    for r in jaccard._cut(large, jaccard._Sets(table, base, 5), 0)[0].collect():
        cells[r["s"]][r["c"]] = r["d"]
    for cell in cells.values():
        (pivot,) = [c for c, d in cell.items() if d == 0]
        assert all(d == pytest.approx(away(c, pivot)) for c, d in cell.items())
    near = [(a, b) for a in text_of for b in text_of if a < b and away(a, b) <= 0.25]
    assert near and all(any({a, b} <= set(cell) and abs(cell[a] - cell[b]) <= 0.25 + 1e-9 for cell in cells.values()) for a, b in near)


def test_jaccard_limit_is_exact(spark, rows):
    """24 of 32 shingles in common link, 23 of 32 do not; the profile bound never prunes a link."""
    a = [f"w{i}" for i in range(32)]
    just = " ".join(a[:28] + ["x0"] * 0), " ".join(a[4:32])  # 24 each, 20 in common
    assert len(shingles(just[0]) & shingles(just[1])) == 20
    wide = [f"v{i}" for i in range(32)]
    p, q = " ".join(wide), " ".join(wide[:28])  # 28 and 24 in common: 24/28
    assert 100 * 24 >= 75 * 28
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_duplicates(docs(rows, [(1, just[0]), (2, just[1]), (3, p), (4, q)])).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 4: 3}


def test_components_of_a_chain_and_a_star(spark, rows):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3)]
    got = dict(map(tuple, components.components(rows(edges, "u bigint, v bigint")).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
    assert components.components(rows([], "u bigint, v bigint")).count() == 0


# ---- op4


def test_licences_found_and_pruning_is_exact():
    t = licenses.prepared(license_texts.templates())
    mit = license_texts.NOTICES["MIT"][0]
    texts = [prose(1, 60) + ".\nReleased under the MIT License.\n" + prose(2, 20), mit.replace(", ", ",\n"), prose(3, 200), "", "Licensed under the Apache License, Version 2.0. Licensed under CC BY-NC 4.0."]
    data = [x.encode() for x in texts]
    raw, offsets = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
    found = licenses.scan(raw, offsets, t)
    assert [sorted(f["license"] for f in x) for x in found] == [["MIT"], ["MIT"], [], [], ["Apache-2.0", "CC-BY-NC-4.0"]]
    span = found[0][0]
    assert data[0][span["start"] : span["end"]].decode() == "Released under the MIT License"
    # the best score of every text equals that over all runs of segments and all templates
    s = licenses.segmented(raw, offsets)
    for i in range(len(texts)):
        best = 0.0
        for a in range(s.first[i], s.first[i + 1]):
            for b in range(a, s.first[i + 1]):
                run = collections.Counter(s.grams[s.at[a] : s.at[b + 1]].tolist())
                best = max([best, *(licenses.dice(run, g) for g in t.grams)])
        assert (max([x["dice"] for x in found[i]], default=0.0) if best >= licenses.THRESHOLD else 0.0) == pytest.approx(best if best >= licenses.THRESHOLD else 0.0)


def test_neighbouring_licences_are_told_apart():
    notice = license_texts.NOTICES["GPL-3.0"][0]
    texts = {
        "AGPL-3.0": notice.replace("GNU General", "GNU Affero General"),
        "LGPL-3.0": notice.replace("GNU General", "GNU Lesser General"),
        "GPL-3.0": notice,
        "CC-BY-3.0": "This work is licensed under a Creative Commons Attribution 3.0 International License.",
        "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
        "Apache-1.1": "Licensed under the Apache License, Version 1.1.",
        "LGPL-2.1": license_texts.NOTICES["GPL-2.0"][0].replace("program", "library").replace("GNU General", "GNU Lesser General").replace("version 2 ", "version 2.1 "),
        "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    }
    data = [x.encode() for x in texts.values()]
    found = licenses.scan(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]), licenses.prepared(license_texts.templates()))
    assert [sorted({f["license"] for f in x}) for x in found] == [[k] for k in texts]


def test_licences_edges(spark, rows):
    got = licenses.find_licenses(docs(rows, [*ODD, (9, "This work is licensed under the GNU General Public License, version 3.")]), keep=("c", "count"))
    by = collections.Counter((r["doc_id"], tuple(x["license"] for x in r["licenses"])) for r in got.collect())
    assert by[9, ("GPL-3.0",)] == 1 and by[5, ()] == 2 and sum(by.values()) == len(ODD) + 1


# ---- op5


def contamination(texts, items):
    words = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (t or "").translate(LOWER))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        k = min(10, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            windows[tuple(w[j : j + k])].add(str(i))
    out = []
    for d, t in texts:
        w, hit, ids = words(t), set(), set()
        for k in {len(x) for x in windows}:
            for j in range(len(w) - k + 1):
                if tuple(w[j : j + k]) in windows:
                    hit |= set(range(j, j + k))
                    ids |= windows[tuple(w[j : j + k])]
        out.append((d, len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("block_words", [2_000_000, 5])
def test_wu_manber_equals_brute_force(spark, rows, block_words):
    r = np.random.default_rng(2)
    small = lambda n: " ".join(r.choice(list("abc"), n))  # noqa: E731  few words: many overlapping occurrences
    texts = [*ODD, *((20 + i, small(int(r.integers(1, 700)))) for i in range(12)), (50, "x " + prose(1, 30) + " y"), (51, prose(1, 9)), (52, "A-B, a.b")]
    items = [(i, small(int(r.integers(1, 24)))) for i in range(6)] + [(70, prose(1, 30)), (71, None), (72, "  "), (73, prose(1, 30)), (10, "one"), (74, "a b")]
    got = decontamination.find_items(docs(rows, texts), rows(items, "item_id bigint, text string"), block_words=block_words)
    assert sorted(map(str, map(tuple, got.drop("spans").collect()))) == sorted(map(str, contamination(texts, items)))


@pytest.mark.parametrize("block_words", [2_000_000, 5])
def test_items_without_id_are_found_as_in_sql(spark, rows, block_words):
    import duckdb

    from panelspark.llm import queries

    texts = [(1, "x " + prose(1, 30) + " y"), (2, prose(2, 12)), (3, prose(1, 15) + " " + prose(2, 12)), (4, prose(4, 20)), (5, None)]
    items = [(None, prose(1, 30)), (None, prose(2, 12)), (7, prose(2, 12)), (None, None), (8, prose(9, 12))]
    table, bench = docs(rows, texts), rows(items, "item_id bigint, text string")
    db = duckdb.connect()
    db.register("documents", table.toArrow())
    db.register("benchmark", bench.toArrow())
    got = decontamination.find_items(table, bench, block_words=block_words).drop("spans")
    want = db.execute(queries.SQL["op5_decontamination"]).fetchall()
    assert [tuple(r) for r in got.orderBy("doc_id").collect()] == sorted(want)
    assert {r["doc_id"] for r in decontamination.clean_documents(table, bench, block_words=block_words).collect()} == {4, 5}


def test_decontamination_edges(spark, rows):
    none = rows([], "item_id bigint, text string")
    assert all(not r["contaminated"] for r in decontamination.find_items(docs(rows, ODD), none).collect())
    clean = decontamination.clean_documents(docs(rows, ODD), rows([(1, "one")], "item_id bigint, text string"))
    assert clean.columns == docs(rows, ODD).columns and clean.count() == len(ODD) - 3
    assert decontamination.find_items(docs(rows, ODD).limit(0), none).count() == 0


# ---- op6


def test_raking_meets_all_marginals(spark, rows):
    r = np.random.default_rng(5)
    data = [(f"={s}", f"={k}", f"={t}", int(r.integers(50, 5000))) for s in range(6) for k in range(3) for t in range(3)]
    table = mixing.rake(rows(data, "_source string, _lang string, _topic string, t bigint"), power=0.5, rounds=10).toPandas()
    for d in ("_source", "_lang", "_topic"):
        actual = table.groupby(d)["t"].sum() ** 0.5
        want = actual / actual.sum() * table["t"].sum()
        got = (table["t"] * table["f"]).groupby(table[d]).sum()
        assert np.allclose(got, want, rtol=1e-4)


def test_mixing_edges_and_given_targets(spark, rows):
    odd = mixing.mix(docs(rows, ODD), rounds=2)
    assert odd.count() == len(ODD) and odd.where("_probability < 0 or _probability > 1 or _kept is null").count() == 0
    nulls = rows([(1, "a b", None, None, 3)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert mixing.mix(nulls, rounds=1, kept=1.0).first()["_kept"] is True and mixing.mix(nulls).first()["_probability"] == pytest.approx(mixing.KEPT)
    many = docs(rows, [(i, prose(i, 20)) for i in range(300)])
    share = rows([("=src0", 0.5), ("=src1", 0.25), ("=src2", 0.25)], "key string, share double")
    out = mixing.mix(many, targets={"source": share}, rounds=3, kept=0.5).groupBy("source").agg({"_probability": "max"}).collect()
    p = {r[0]: r[1] for r in out}
    assert p["src0"] > 1.8 * p["src1"] and p["src1"] == pytest.approx(p["src2"], rel=0.1)
    assert mixing.mix(many.limit(0), rounds=1).count() == 0


def test_a_rare_cell_does_not_set_the_scale(spark, rows):
    """The kept share of tokens is the stated one, with and without one row of a group of its own."""
    many = [(i, prose(i, 30), "en", f"src{int(i > 300)}", 1) for i in range(400)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    for extra in ([], [(1000, "a", None, None, 1)], [(1000, "a", "xx", "rare", 1), (1001, None, "yy", "empty", 0)]):
        out = mixing.mix(rows(many + extra, schema)).toPandas()
        assert (out["_tokens"] * out["_probability"]).sum() == pytest.approx(mixing.KEPT * out["_tokens"].sum(), rel=1e-6)
        assert 240 <= out["_kept"].sum() <= 320 and (not extra or out["_probability"].max() == 1.0)
    with pytest.raises(ValueError, match="names of results"):
        mixing.mix(rows(many, schema).withColumnRenamed("n_chars", "_kept"))


# ---- op7


def test_shards_by_hand_and_slots(spark, rows):
    from hashlib import md5  # noqa: F401  the draw itself is Spark's xxhash64

    texts = [(i, prose(i, 5)) for i in range(400)] + [(5, prose(5, 5))] * 300 + ODD
    got = sharding.manifest(docs(rows, texts), sharding.tree(40), grown=sharding.tree(41)).collect()
    assert len(got) == len(texts)
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 40)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = collections.Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts)
    assert want == collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got)
    assert len({r["shard"] for r in got if r["doc_id"] == 5}) == 1
    assert sharding.manifest(docs(rows, texts).limit(0), sharding.tree(3)).count() == 0


def test_shard_draws_equal_brute_force(spark, rows):
    import xxhash

    topology = [sharding.Shard("a", "a/1", 0, 1.0), sharding.Shard("a", "a/1", 1, 3.0), sharding.Shard("a", "a/2", 2, 2.0), sharding.Shard("b", "b/1", 3, 2.0)]

    def draw(key, name, weight):
        h = xxhash.xxh64_intdigest(f"{key}|{name}".encode(), seed=42)
        return math.log(((h >> 12) + 0.5) / 2**52) / weight

    def pick(key, options):
        return max(options, key=lambda o: draw(key, *o))[0]

    def place(key):
        region = pick(key, [("a", 6.0), ("b", 2.0)])
        rack = pick(key, [("a/1", 4.0), ("a/2", 2.0)]) if region == "a" else "b/1"
        inner = [(f"{s.rack}/{s.shard}", s.weight) for s in topology if s.rack == rack]
        return int(pick(key, inner).split("/")[-1])

    ids = rows([(i,) for i in range(2000)], "doc_id bigint")
    got = {r["doc_id"]: r["shard"] for r in sharding.place(ids, topology).collect()}
    assert got == {i: place(str(i)) for i in range(2000)}
    share = collections.Counter(got.values())
    assert share[1] > 2 * share[0]
    # a new weight inside region a moves nothing within region b, nor from it unless a's weight grows
    changed = [sharding.Shard(s.region, s.rack, s.shard, {0: 3.0, 1: 1.0}.get(s.shard, s.weight)) for s in topology]
    moved = {r["doc_id"]: r["shard"] for r in sharding.place(ids, changed).collect()}
    assert all({got[i], moved[i]} <= {0, 1} for i in got if got[i] != moved[i])


# ---- op8


def test_neighbours_recall_and_edges(spark, rows):
    r = np.random.default_rng(8)
    x = r.normal(size=(700, 16))
    x[300:330] = x[300]
    x *= r.uniform(0.5, 2.0, (700, 1))
    table = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    odd = [(1001, None, 1), (1002, [0.0] * 16, 1), (1003, [None] * 16, 1), (1004, [float("nan")] * 16, 1), (1005, [1.0] * 5, 1), (None, [1.0] * 16, 1), (0, x[0].tolist(), 1)]
    got = neighbours.nearest(rows(table + odd, "vec_id bigint, embedding array<double>, label int"), lambda i: i % 20 == 0).collect()
    by = collections.defaultdict(list)
    for q in sorted(got, key=lambda q: (q["query_id"], q["rank"])):
        by[q["query_id"]].append(q)
        assert q["score"] == pytest.approx(float(x[q["query_id"]] @ x[q["vec_id"]]), abs=1e-12)
    hits = 0
    for q in range(0, 700, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len({n["vec_id"] for n in by[q]} & set(np.argsort(-s)[:20].tolist()))
        assert [n["rank"] for n in by[q]] == list(range(1, 21)) and q not in {n["vec_id"] for n in by[q]}
    assert hits >= 0.9 * 20 * 35 and set(by) == set(range(0, 700, 20))
    few = neighbours.nearest(rows([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])], "vec_id bigint, embedding array<double>"), lambda i: i == 0)
    assert [(n["rank"], n["vec_id"], n["score"]) for n in few.orderBy("rank").collect()] == [(1, 1, 1.0), (2, 2, 0.0)]
    assert neighbours.nearest(rows([], "vec_id bigint, embedding array<double>"), lambda i: i == 0).count() == 0


@pytest.mark.parametrize("spread", [0.0, 1.0, 2.0])
def test_neighbours_recall_with_norms_over_orders_of_magnitude(spark, rows, spread):
    """Norms of 1 with one of 100 among them, or spread log-normally over two and four orders."""
    r = np.random.default_rng(18)
    x = r.normal(size=(1500, 32))
    norm = np.exp(r.normal(size=1500) * spread) if spread else np.where(np.arange(1500) == 777, 100.0, 1.0)
    x *= (norm / np.linalg.norm(x, axis=1))[:, None]
    got = neighbours.nearest(rows([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>"), lambda i: i % 20 == 0).collect()
    by, hits = collections.defaultdict(set), 0
    for q in got:
        by[q["query_id"]].add(q["vec_id"])
    for q in range(0, 1500, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(by[q] & set(np.argsort(-s)[:20].tolist()))
    assert hits >= 0.9 * 20 * 75, hits / 1500


# ---- op9


def plain_by_pattern(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((0, *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and pii.luhn(d):
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((3, *m.span()))
    return out


def test_plain_personal_data_equals_the_patterns():
    r = np.random.default_rng(6)
    for _ in range(1500):
        t = "".join(r.choice(list("a1.@-+ (5)0é%9"), int(r.integers(0, 60))))
        assert pii.plain(t) == plain_by_pattern(t), t
    t = "x 4111 1111 1111 1111 y a@b.c-d.e +x@y.z 1.2.3.4.5 256.1.1.1 +1 (415) 555-2671"
    assert pii.plain(t) == plain_by_pattern(t)


@pytest.mark.parametrize(
    "text,kind,shown",
    [
        ("mail jane (at) example (dot) com now", "email", "jane (at) example (dot) com"),
        ("mail jane dot doe at example dot com now", "email", "jane dot doe at example dot com"),
        ("é jоhn@exаmple.com!", "email", "jоhn@exаmple.com"),
        ("call plus one four one five five five five two six seven one", "phone", "plus one four one five five five five two six seven one"),
        ("four one one one one one one one one one one one one one one one", "card", "four one one one one one one one one one one one one one one one"),
        ("at one nine two dot one six eight dot one dot one ok", "ip", "one nine two dot one six eight dot one dot one"),
        ("１９２．１６８．１．１", "ip", "１９２．１６８．１．１"),
    ],
)
def test_disguises_map_back_to_the_source(text, kind, shown):
    assert [(pii.KINDS[k], text[a:b], p) for k, a, b, p in pii.spans(text)] == [(kind, shown, False)]


@pytest.mark.parametrize(
    "text,kind,shown",
    [
        ("mail anna at firma dot it", "email", "anna at firma dot it"),
        ("mail anna@firma [dot] it", "email", "anna@firma [dot] it"),
        ("x_at_y_dot_be!", "email", "x_at_y_dot_be"),
        ("anna@firma[.]quebec", "email", "anna@firma[.]quebec"),
        ("anna at firma dot co dot za and so on", "email", "anna at firma dot co dot za"),
        ("anna at firma\ndot\nxyz", "email", "anna at firma\ndot\nxyz"),
        ("host 10 dot zero dot zero dot 5 up", "ip", "10 dot zero dot zero dot 5"),
        ("call plus 44 20 7946 0958", "phone", "plus 44 20 7946 0958"),
        ("(four one one one one one one one one one one one one one one one.)", "card", "four one one one one one one one one one one one one one one one"),
        ("plus four four two zero seven nine four six zero.", "phone", "plus four four two zero seven nine four six zero"),
    ],
)
def test_disguises_of_any_ending_and_few_digit_words(text, kind, shown):
    assert [(pii.KINDS[k], text[a:b], p) for k, a, b, p in pii.spans(text)] == [(kind, shown, False)]


@pytest.mark.parametrize("text", ["look at the dot in it", "see you at noon. It was at 5.30 in the morning", "aim at a dot or at the dot is it", "2 plus 3 is 5", "meet @ noon . Then go", "a stay-at-home.The end"])
def test_more_clean_texts_stay_clean(text):
    assert pii.spans(text) == []


@pytest.mark.parametrize("text", ["look at example.com now", "he looked at the dot on it", "one two three four", "meet me at noon. dot com era", "a @ b", "привет мир", "at at at dot dot dot"])
def test_clean_texts_stay_clean(text):
    assert pii.spans(text) == []


def test_personal_data_edges(spark, rows):
    table = docs(rows, [*ODD, (9, "é a@b.co x"), (10, "no")])
    got = [(r["doc_id"], [(s["kind"], s["start"], s["end"], s["plain"]) for s in r["spans"]]) for r in pii.find(table, keep=("c",)).collect()]
    assert (9, [("email", 2, 8, True)]) in got and len(got) == len(ODD) + 2
    red = {r["doc_id"]: r["text"] for r in pii.redacted(table).collect()}
    assert red[9] == "é [email] x" and red[10] == "no" and red[1] is None


# ---- op10


def test_language_model_counts_and_sums(spark, rows):
    texts = [(i, " ".join(np.random.default_rng(i).choice(["the", "cat", "Sat", "on", "a", "mat.", f"w{i}"], 30))) for i in range(60)] + ODD
    got = sorted((tuple(r) for r in language_model.score(docs(rows, texts), head=4, steps=8).collect()), key=str)
    tok = lambda t: [*re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER)), None]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    counts = collections.Counter(w for i, t in texts if not held(i) for w in tok(t))
    n, v = sum(counts.values()), len(counts)
    want = sorted(((i, held(i), len(k), sum(counts[w] > 0 for w in k), n, sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in k)) for i, t in texts for k in [tok(t)]), key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(g[5] == pytest.approx(w[5], rel=1e-9) for g, w in zip(got, want, strict=True))
    assert all(g[6] < 0 for g in got) and sum(g[6] for g in got if g[2] > 5) > sum(g[5] for g in got if g[2] > 5)
    assert language_model.score(docs(rows, texts).limit(0), steps=1).count() == 0


def test_class_probabilities_sum_to_one():
    r = np.random.default_rng(3)
    w = r.normal(size=(language_model.BUCKETS, language_model.CLASSES)).astype(np.float32)
    logs = language_model.class_logs(r.integers(0, language_model.CLASSES**3, 200), w)
    assert np.allclose(np.exp(logs).sum(axis=1), 1)


def test_gradient_equals_differences():
    r = np.random.default_rng(7)
    w = (0.1 * r.normal(size=(language_model.BUCKETS, language_model.CLASSES))).astype(np.float32)
    after = [[{"c": int(c), "n": int(n)} for c, n in zip(r.integers(0, 64, 3), r.integers(1, 9, 3), strict=True)] for _ in range(5)]
    batch = pa.RecordBatch.from_arrays([pa.array(r.integers(0, 64**3, 5)), pa.array(after, pa.list_(pa.struct([("c", pa.int64()), ("n", pa.int64())])))], names=["context", "after"])
    (out,) = language_model._gradient(iter([batch]), w)
    g = np.frombuffer(out.column(0)[0].as_py(), np.float32).reshape(w.shape)
    for i, j in zip(*np.unravel_index(np.argsort(-np.abs(g), axis=None)[:4], g.shape), strict=True):
        up = w.astype(np.float64)
        up[i, j] += 1e-4
        (more,) = language_model._gradient(iter([batch]), up)
        assert (more.column(1)[0].as_py() - out.column(1)[0].as_py()) / 1e-4 == pytest.approx(g[i, j], rel=0.05, abs=0.02)


def test_words_before_decide_among_words_of_one_class(spark, rows):
    """Words of one class swap places: only features of the words themselves tell the texts apart."""
    fill = " ".join(f"f{i:02d}xx " * 8 for i in range(31))
    pairs = [("baring", "coring"), ("during", "string")]
    texts = [(i, fill + " " + " ".join(f"{a} {b}" for a, b in pairs) + " q1 q2") for i in range(200)]
    swapped = " ".join(f"{a} {b}" for a, b in [("baring", "string"), ("during", "coring")])
    held = [i for i in range(200, 400) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    texts += [(held[0], fill + " baring coring during string q1 q2"), (held[1], fill + " " + swapped + " q1 q2")]
    run = lambda rounds: {r["doc_id"]: r["score"] for r in language_model.score(docs(rows, texts), steps=1, rounds=rounds).collect()}
    plain, got = run(0), run(1)
    assert plain[held[0]] == pytest.approx(plain[held[1]])
    assert got[held[0]] > got[held[1]] + 0.2


def test_words_of_all_classes_sum_to_one(spark, rows):
    """All known words and one unseen word of each class share a probability of one, after any words before."""
    vocabulary = [f"w{i}" for i in range(300)]
    r = np.random.default_rng(5)
    texts = [(i, " ".join(r.choice(vocabulary, 40))) for i in range(40)]
    table = language_model._texts(docs(rows, texts), "doc_id", "text")
    for head in (40, 10_000):
        model, rare = language_model.fit(table, head, steps=2)
        seen = {w for i, t in texts if zlib.crc32(str(i).encode()) % 5 != 1 for w in t.split()}
        counts = {x["h"]: x["n"] for x in rare.collect()}
        column = pa.array([f"w1 w2 {w}" for w in sorted(seen)] + ["w1 w2"])
        data, offsets = language_model.tokens.utf8(column)
        h, ending, first = language_model._with_ends(language_model.tokens.hashed_words(data, offsets, language_model.tokens.space_separated()))
        c = language_model._classes(h, ending, model.frequent, model.rank)
        i, found = model.known(h)
        cell = language_model.cells(h, found, model.depth)
        logs = language_model.word_logs(model, c, cell, language_model._contexts(c, first), language_model._before(h, first))
        at = np.append(first[1:-1] - 2, len(h) - 1)  # the third word of a text, and the end after two
        among = np.where(c > language_model.FREQUENT, model.cell_log[np.maximum(c - 1 - language_model.FREQUENT, 0), cell], model.class_log[c])
        n = [10 ** model.head_log[i[k]] if found[k] else counts[int(h[k : k + 1].view(np.int64)[0])] + 0.5 for k in at]
        total = (np.exp(logs - among)[at] * n).sum()
        # one unseen word of each ending class, in cell 0
        classes = np.arange(32, 64)
        place = lambda x: np.full(32, x[at[0]])
        unseen = language_model.word_logs(model, classes, np.zeros(32, np.int64), place(language_model._contexts(c, first)), [place(f) for f in language_model._before(h, first)])
        total += (np.exp(unseen - model.cell_log[:, 0]) * 0.5).sum()
        assert total == pytest.approx(1, abs=1e-4)
        assert model.u.any()


def test_expected_counts_equal_plain_sums(spark, rows):
    """Observed and expected counts of a weight row, word by word; both sum to the words that met it."""
    r = np.random.default_rng(9)
    texts = [(i, " ".join(r.choice([f"w{i}" for i in range(80)], 30))) for i in range(20)]
    table = language_model._texts(docs(rows, texts), "doc_id", "text")
    model, _ = language_model.fit(table, steps=1)
    batch = pa.RecordBatch.from_arrays([pa.array([t for _, t in texts])], names=["_text"])
    seen, expected = np.zeros((language_model.ROWS, 8)), np.zeros((language_model.ROWS, 8))
    for _, _, _, c, _, _, cell, context, features in language_model._places(model, iter([batch])):
        for places, node, way, z in language_model.choices(model, c, cell, context):
            rows_of = [language_model._rows(f[places], node) for f in features]
            for k in range(len(places)):
                p = np.exp(z[k] + sum(model.u[x[k]] for x in rows_of).astype(np.float64))
                for x in rows_of:
                    seen[x[k], way[k]] += 1
                    expected[x[k]] += p / p.sum()
    got = pa.Table.from_batches(language_model._expected(iter([batch]), model)).to_pandas().set_index("row")
    assert sorted(got.index) == list(np.flatnonzero(seen.sum(axis=1)))
    assert np.allclose(got[[f"o{k}" for k in range(8)]], seen[got.index])
    assert np.allclose(got[[f"e{k}" for k in range(8)]], expected[got.index], atol=1e-3)


def test_counts_are_sent_by_few_tasks(spark, rows):
    """A task that sums counts sends almost every weight row, so small texts in many tasks must not each send them."""
    texts = language_model._texts(docs(rows, [(i, "a b c") for i in range(300)]).repartition(100), "doc_id", "text").select("_text")
    assert language_model.in_few_tasks(texts, 900).rdd.getNumPartitions() == language_model.LEAST_TASKS
    assert language_model.in_few_tasks(texts, 20 * language_model.TASK_WORDS).rdd.getNumPartitions() == 20
    assert language_model.in_few_tasks(texts, 900).count() == 300


def test_broadcast_words_are_found_where_they_stand():
    """Also words whose first bits are the same, and words that are not there."""
    r = np.random.default_rng(11)
    near = np.uint64(7) << np.uint64(60)
    for n in (0, 1, 3, 5000):
        head = np.unique(np.concatenate([r.integers(0, 1 << 64, n, dtype=np.uint64), near + np.arange(min(n, 40), dtype=np.uint64)]))
        empty = np.zeros(0)
        model = language_model.Model(empty, empty, empty, 1, [], empty, empty, empty, 0.0, head, empty, 0, 0)
        asked = np.concatenate([head, head + np.uint64(1), r.integers(0, 1 << 64, 500, dtype=np.uint64), np.array([0, (1 << 64) - 1], np.uint64)])
        i, found = model.known(asked)
        assert (found == np.isin(asked, head)).all()
        assert (head[i[found]] == asked[found]).all() and found[: len(head)].all()


def test_word_hashes_equal_plain_sums():
    """Words of all lengths around the bounds of the short and the long way, longest not first."""
    words = ["a", "Bc", "x" * 31, "y" * 32, "z" * 33, "q" * 4096, "r" * 4097, "é" * 40, "b", "w" * 70_000]
    column = pa.array([" ".join(words), "", "one"])
    got = language_model.tokens.hashed_words(*language_model.tokens.utf8(column), language_model.tokens.space_separated()).hashes
    t = language_model.tokens
    for word, h in zip([*words, "one"], got, strict=True):
        v = t.LOWER[np.frombuffer(word.encode(), np.uint8)].astype(np.uint64) + np.uint64(1)
        with np.errstate(over="ignore"):
            s = np.uint64(0)
            if len(v) <= 4096:
                s = (v * t._TABLE[: len(v)]).sum(dtype=np.uint64)
            else:
                for at in range(0, len(v), 1 << 16):
                    part = v[at : at + (1 << 16)]
                    s = t.mixed(np.array([s], np.uint64))[0] + (part * t._TABLE[: len(part)]).sum(dtype=np.uint64)
            assert t.mixed(np.array([s + np.uint64(len(v)) * t._FOLD], np.uint64))[0] == h
