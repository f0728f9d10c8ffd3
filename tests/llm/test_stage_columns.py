"""Stages and operators on documents whose other columns bear the names that the code uses inside."""

import pytest

import corpus_pipeline
from panelspark.llm import decontamination, licenses, mixing, pii, quality_model, sharding
from test_llm_operators import prose

#: Names that the stages use for results, helpers or packed rows.
NAMES = """score weak_score _text _row _id _doc _again _again_text _gone _gone_text _hash n c k s component_id count n_words n_hit n_items items_sha256
contaminated spans _spans _items _ids _probability _kept _tokens _topic_name _topic _source _lang _moved f t _region _rack shard size text_crc32 law slot
grown_shard licenses profile counts a.b with`tick""".split()


def documents(rows, names):
    texts = [f"The cat is in the {prose(i, 40)}, and that is it." for i in range(8)] + ["The end of the " + prose(3, 40) + "."] * 2
    texts += [None, "", "%%% ### " * 30, "word " * 60_000 + prose(9, 30), "The dog of the " + prose(77, 12) + " is here."]
    data = [(None if i % 6 == 5 else i, t, "en", f"s{i % 2}", len(t or ""), *[f"{name}:{i}" for name in names]) for i, t in enumerate(texts)]
    schema = ", ".join(["doc_id bigint, text string, lang string, source string, n_chars bigint", *["`" + n.replace("`", "``") + "` string" for n in names]])
    return rows(data, schema)


@pytest.fixture
def sf_dir(spark, tmp_path):
    spark.createDataFrame([(1, prose(77, 12)), (None, prose(78, 12))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:-1])
def test_stages_keep_columns_of_any_name(spark, rows, sf_dir, name, stage):
    """NULL ids, NULL, empty and long texts, copies; the same rows stay as without the columns, each as it was."""
    plain, wide = documents(rows, []), documents(rows, NAMES)
    out = stage(spark, wide, sf_dir)
    assert out.columns == wide.columns
    got, before = sorted(map(tuple, out.collect()), key=str), sorted(map(tuple, wide.collect()), key=str)
    assert set(got) <= set(before) and (len(got) < len(before) or name == "mix")
    assert sorted((r[:5] for r in got), key=str) == sorted(map(tuple, stage(spark, plain, sf_dir).collect()), key=str)


def test_manifest_of_any_columns(spark, rows, sf_dir):
    stage = corpus_pipeline.STAGES[-1][1]
    wide = stage(spark, documents(rows, [n for n in NAMES if n != "doc_id"]), sf_dir)
    assert sorted(map(tuple, wide.collect()), key=str) == sorted(map(tuple, stage(spark, documents(rows, []), sf_dir).collect()), key=str)
    placed = sharding.place(documents(rows, ["_region", "_rack", "_region_"]), sharding.tree(4))
    assert placed.columns[-4:] == ["_region", "_rack", "_region_", "shard"] and placed.first()["_region"].startswith("_region:")


def test_results_never_replace_a_column(rows):
    for name, run in (
        ("spans", lambda d: pii.find(d, keep=("spans",))),
        ("licenses", lambda d: licenses.find_licenses(d, keep=("licenses",))),
        ("Score", lambda d: quality_model.score(d, keep=("Score",))),
        ("n_hit", lambda d: decontamination.find_items(d, d.selectExpr("doc_id as item_id", "text"), keep=("n_hit",))),
        ("_kept", mixing.mix),
        ("shard", lambda d: sharding.place(d, sharding.tree(4))),
    ):
        with pytest.raises(ValueError, match="names of results"):
            run(documents(rows, [name]))
    red = pii.redacted(rows([(1, "mail a@b.co", "x", "y")], "doc_id bigint, text string, spans string, `_text` string"))
    assert list(map(tuple, red.collect())) == [(1, "mail [email]", "x", "y")]


def test_benchmark_in_blocks_equals_one_block(rows):
    table = documents(rows, []).select("doc_id", "text")
    items = table.selectExpr("doc_id as item_id", "substring(text, 5, 90) as text").where("length(text) > 60")
    one, many = (decontamination.find_items(table, items, block_words=w).drop("spans") for w in (1_000_000, 10))
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, many.collect()), key=str)
