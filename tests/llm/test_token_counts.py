"""Token counts against the tokenizer's own library, on whole tables and odd texts."""

import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from panelspark.llm import token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (4, "one"), (None, "a<|endoftext|>b <|endoftext|>"), (5, "中文" * 20_000), (6, "it's 12³ ٣٤\u0085  x​ÿ\x1c y"), (7, "a " * 400_000), (8, "\U0010ffff͸ x\0")]
COLUMNS = "doc_id bigint, text string, n_tokens string, _id string, _text string, over_limit int"


def library(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_odd_rows_and_clashing_columns(rows):
    got = token_counts.count_tokens(rows([(i, t, "x", "y", "z", 1) for i, t in ODD], COLUMNS), PATH).collect()
    want = [(i, len((t or "").encode()), n, n > 512) for (i, t), n in zip(ODD, library(t for _, t in ODD), strict=True)]
    assert sorted([(r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got], key=str) == sorted(want, key=str)
    assert not rows([], COLUMNS).transform(lambda d: token_counts.count_tokens(d, PATH)).collect()
    with pytest.raises(ValueError, match="name of a result"):
        token_counts.count_tokens(rows([], "n_tokens bigint, text string"), PATH, id_col="n_tokens")


def test_query_on_a_whole_table(spark):
    from panelspark.llm.queries import op12_token_counts

    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in op12_token_counts(spark, sf).collect()}
    table = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(table)
    for r, n in zip(table, library(r["text"] for r in table), strict=True):
        assert (got[r["doc_id"]]["n_bytes"], got[r["doc_id"]]["n_tokens"]) == (len((r["text"] or "").encode()), n)


def test_random_texts_and_parts(monkeypatch):
    monkeypatch.setattr(token_counts, "PART", 40)
    draw, counter = random.Random(3), token_counts.Counter(*token_counts.proved(PATH))
    pool = [*" \n\t'sdaé中😀1²٣!?._\0\u0085　\x1c᠎​", "<|endoftext|>", " word", "'ll"]
    texts = ["".join(draw.choice(pool) if draw.random() < 0.95 else chr(draw.choice([draw.randrange(0xD800), draw.randrange(0xE000, 0x110000)])) for _ in range(draw.randrange(120))) for _ in range(4000)]
    assert [counter.count(t)[0] for t in texts] == library(texts)


def test_whole_tokens_are_proved():
    _, whole, odd = token_counts.proved(PATH)
    tokenizer = Tokenizer.from_file(PATH)
    for t in random.Random(1).sample(sorted(whole), 2000):
        assert [x.value for x in tokenizer.model.tokenize(token_counts.spelled(t))] == [token_counts.spelled(t)]
    assert " the" in whole and "<|endoftext|>" not in whole and len(odd) < 1 << 16


def test_other_tokenizers_are_refused(tmp_path):
    config = json.load(open(PATH)) | {"normalizer": {"type": "Lowercase"}}
    (tmp_path / "t.json").write_text(json.dumps(config))
    with pytest.raises(ValueError, match="plain byte-level"):
        token_counts.proved(str(tmp_path / "t.json"))
