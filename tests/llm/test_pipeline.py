"""The pipeline's stages on a small table, each against a brute-force version over its own input."""

import collections
import hashlib
import re
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import corpus_pipeline
from panelspark.llm import mixing
from test_llm_operators import classes_by_brute_force, contamination, near_copies, prose


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Documents with junk, near copies, benchmark passages and clean texts, and the benchmark."""
    path = tmp_path_factory.mktemp("sf")
    items = [(i, prose(7000 + i, 30)) for i in range(3)]
    texts = [f"The {t}." for _, t in near_copies(8)]
    texts += [f"The cat and {prose(300 + i, 12)} {items[i % 3][1]} of it." for i in range(4)]
    texts += [" ".join(f"{w}%%%" for w in prose(400 + i, 60).split()) for i in range(15)]
    texts += [f"The dog is in the {prose(500 + i, 60)}, and that is it." for i in range(60)]
    n = len(texts)
    table = {"doc_id": range(n), "text": texts, "lang": ["en", "de"] * (n // 2) + ["en"] * (n % 2), "source": [f"s{i % 4}" for i in range(n)], "n_chars": [len(t) for t in texts]}
    pq.write_table(pa.table(table), path / "documents.parquet")
    pq.write_table(pa.table({"item_id": [i for i, _ in items], "text": [t for _, t in items]}), path / "benchmark.parquet")
    return str(path), items


def raked(docs, rounds=mixing.ROUNDS, power=mixing.POWER, kept=mixing.KEPT):
    """Probability of each document by plain loops; lambda by bisection."""
    def topic(t, n):
        marks = lambda cs: sum(t.count(c) for c in cs)
        if marks("|") * 5 > n:
            return "table"
        if marks("#$%&*") > n:
            return "symbols"
        if marks("!") * 2 > n:
            return "shouting"
        return "long" if n >= 300 else "short"

    cell_of, t = {}, collections.Counter()
    for d, text, lang, source in docs:
        n = len(re.findall("[^\x20\x09-\x0d]+", text))
        cell_of[d] = (source, lang, topic(text, n))
        t[cell_of[d]] += n
    f, total = dict.fromkeys(t, 1.0), sum(t.values())
    target = []
    for k in range(3):
        sums = collections.Counter()
        for c, n in t.items():
            sums[c[k]] += n
        raised = {g: n**power for g, n in sums.items()}
        target.append({g: r / sum(raised.values()) * total for g, r in raised.items()})
    for _ in range(rounds):
        moved = 0.0
        for k in range(3):
            now = collections.Counter()
            for c in t:
                now[c[k]] += t[c] * f[c]
            ratio = {c: target[k][c[k]] / now[c[k]] for c in f}
            f = {c: f[c] * ratio[c] for c in f}
            moved = max(moved, *(abs(r - 1) for r in ratio.values()))
        if moved <= mixing.TOLERANCE:
            break
    low, high = 0.0, 1e9
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if sum(n * min(1, mid * f[c]) for c, n in t.items()) < kept * total else (low, mid)
    return {d: min(1, high * f[c]) for d, c in cell_of.items()}


def test_stages_against_brute_force(spark, folder):
    sf_dir, items = folder
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stage(spark, docs, sf_dir)
        assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        rows = out.collect()
        after = {r["doc_id"]: r for r in rows}
        assert len(after) == len(rows) and all(before[d] == r for d, r in after.items())
        seen[name] = set(after)
        texts = [(d, r["text"]) for d, r in before.items()]
        if name == "quality":
            assert {d for d, t in texts if "%%%" in t} == set(before) - set(after)
        if name == "near_duplicates":
            assert set(after) == {d for d, _, k in classes_by_brute_force(texts) if d == k}
        if name == "decontaminate":
            assert set(after) == {r[0] for r in contamination(texts, items) if not r[5]}
        if name == "mix":
            p = raked([(d, r["text"], r["lang"], r["source"]) for d, r in before.items()])
            draw = lambda d: int(hashlib.md5(f"{d}|{mixing.SEED}".encode()).hexdigest()[:13], 16) / 2**52
            assert set(after) == {d for d in before if draw(d) < p[d]}
        docs = spark.createDataFrame(rows, docs.schema)
    got = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r["doc_id"] for r in got} == seen["mix"]
    for r in got:
        t = next(x["text"] for x in rows if x["doc_id"] == r["doc_id"]).encode()
        assert (r["size"], r["text_crc32"]) == (len(t) + 16, zlib.crc32(t))
    for s in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    whole = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted(map(tuple, whole), key=str) == sorted(map(tuple, got), key=str)


def test_empty_documents_pass_all_stages(spark, tmp_path, folder):
    sf_dir, _ = folder
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        assert out.count() == 0
        docs = out if "text" in out.columns else docs


def test_registered_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontaminate", "mix", "shard"]
    assert "pipeline" in names and all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))
    assert {"op3_jaccard_join", "op5_decontamination", "op6_mixing"} <= set(entry.oracle_sql())
    assert np.all([callable(f) for f in names.values()])
