"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions only.

Documents fall into cells of source, language and topic. The cells' token sums are
raked to target marginals of all three, until a round moves no marginal by more
than a tolerance. The ratio f of raked to actual tokens says how much of a cell is
wanted; probabilities are calibrated to a stated share of all tokens: a document is
kept with min(1, lambda f), where lambda makes the expected tokens kept equal the
share. Cells that are wanted beyond what they have are kept whole and the others
fill the rest, so a rare cell does not set the scale. Among cells not kept whole the
kept tokens have the raked proportions in expectation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.llm.stage import packed, refuse_clash, staged, unpacked

DIMENSIONS = ("source", "lang", "topic")
#: Targets are shares of tokens to this power: 1 leaves the mix, 0 makes all groups equal.
POWER = 0.7
#: Rounds of raking at most, and the relative change of any marginal below which it ends before.
ROUNDS, TOLERANCE = 20, 1e-4
#: Share of all tokens that is kept in expectation.
KEPT = 0.7
SEED = "mix-1"


def token_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def _marks(text: Column, characters: str) -> Column:
    text = F.coalesce(text, F.lit(""))
    return sum((F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c), F.lit("")))) for c in characters)


def form_topic(text: Column, tokens: Column) -> Column:
    """The topic where documents name none: the form of the text, by its marks and length."""
    return (
        F.when(_marks(text, "|") * 5 > tokens, "table")
        .when(_marks(text, "#$%&*") > tokens, "symbols")
        .when(_marks(text, "!") * 2 > tokens, "shouting")
        .when(tokens >= 300, "long")
        .otherwise("short")
    )


def _key(value: Column) -> Column:
    """A text key in which NULL differs from every value."""
    return F.coalesce(F.concat(F.lit("="), value.cast("string")), F.lit("null"))


def uniform(id_col: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) fixed by the id: 52 bits of its md5."""
    digest = F.md5(F.concat_ws("|", F.coalesce(id_col.cast("string"), F.lit("null")), F.lit(seed)))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def rake(cells: DataFrame, targets: dict[str, DataFrame] | None = None, power: float = POWER, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Cells (_source, _lang, _topic, t) with their factor f, and the largest relative change of a marginal in the last round as _moved.

    `targets` may give a table (key, share) for a dimension, its key in the form
    of the cell's key; groups without a share get none of the target. Otherwise
    shares are the tokens' shares to `power`. Raking ends after the first round
    that moves no marginal by more than `tolerance`, or after `rounds`: targets that
    no table can meet are met as far as that. Each round is written, so the plan
    stays short; sums are grouped aggregates joined back.
    """
    keys = [f"_{d}" for d in DIMENSIONS]
    total = float(cells.agg(F.sum("t").alias("n")).first()["n"] or 0)
    table = cells.withColumns({"f": F.lit(1.0), "_moved": F.lit(0.0)})
    for d, k in zip(DIMENSIONS, keys, strict=True):
        if targets and d in targets:
            share = targets[d].select(F.col("key").alias(k), F.col("share").cast("double").alias(f"target{k}"))
        else:
            raised = cells.groupBy(k).agg(F.pow(F.sum("t").cast("double"), F.lit(power)).alias("_r"))
            of = raised.agg(F.sum("_r").alias("n")).first()["n"] or 1.0
            share = raised.select(k, (F.col("_r") / F.lit(of)).alias(f"target{k}"))
        table = table.join(share, k, "left").withColumn(f"target{k}", F.coalesce(f"target{k}", F.lit(0.0)) * F.lit(total))
    table = staged(table, "mix-cells")
    for _ in range(rounds):
        table = table.withColumn("_moved", F.lit(0.0))
        for k in keys:
            sums = table.groupBy(k).agg(F.sum(F.col("t") * F.col("f")).alias("_now"))
            ratio = F.when(F.col("_now") > 0, F.col(f"target{k}") / F.col("_now")).otherwise(1.0)
            table = table.join(sums, k).withColumn("_ratio", ratio)
            table = table.withColumns({"f": F.col("f") * F.col("_ratio"), "_moved": F.greatest("_moved", F.abs(F.col("_ratio") - 1))}).drop("_now", "_ratio")
        table = staged(table, "mix-round")
        if (table.agg(F.max("_moved").alias("n")).first()["n"] or 0.0) <= tolerance:
            break
    return table


def calibrated(raked: DataFrame, kept: float = KEPT) -> float | None:
    """The lambda at which min(1, lambda f) keeps the share `kept` of the tokens; None keeps all.

    Cells that saturate are taken out and the others share what is left, until no
    more saturate: a few aggregates over the cells, each of one row.
    """
    total = raked.agg(F.sum("t").alias("n")).first()["n"] or 0
    budget, scale = kept * total, 0.0
    if budget >= total:
        return None
    while True:
        whole = F.col("f") * F.lit(scale) >= 1
        r = raked.agg(F.sum(F.when(whole, F.col("t")).otherwise(0)).alias("full"), F.sum(F.when(whole, 0.0).otherwise(F.col("t") * F.col("f"))).alias("rest")).first()
        found = (budget - r["full"]) / r["rest"] if r["rest"] and r["rest"] > 0 else None
        if found is None or found <= scale:
            return found or scale
        scale = found


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", topic_col: str | None = None,
    targets: dict[str, DataFrame] | None = None, power: float = POWER, rounds: int = ROUNDS, seed: str = SEED, kept: float = KEPT,
) -> DataFrame:
    """All rows and columns of `docs` with _topic_name, _tokens, _probability and _kept.

    NULL source, language or topic is a group of its own; NULL or empty text has
    no tokens and gets its cell's probability; rows of one id share their draw;
    an empty table gives an empty result. Groups that `targets` give no share are
    not kept. Columns that bear a result's name are an error; no other name clashes
    (see `mixed_documents`).
    """
    refuse_clash(docs.columns, RESULTS)
    out = _drawn(docs, id_col, text_col, topic_col, targets, power, rounds, seed, kept)
    return out.select(*[F.col("_row")[c].alias(c) for c in docs.columns], *RESULTS)


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", topic_col: str | None = None, **options) -> DataFrame:
    """The documents drawn, with their own columns, whatever their names."""
    every = {"targets": None, "power": POWER, "rounds": ROUNDS, "seed": SEED, "kept": KEPT} | options
    return unpacked(_drawn(docs, id_col, text_col, topic_col, **every).where("_kept"), docs)


RESULTS = ("_topic_name", "_tokens", "_probability", "_kept")


def _drawn(docs, id_col, text_col, topic_col, targets, power, rounds, seed, kept) -> DataFrame:
    keys = [f"_{d}" for d in DIMENSIONS]
    read = {"_id": id_col, "_text": text_col, "_source": "source", "_lang": "lang"} | ({"_named": topic_col} if topic_col else {})
    out = packed(docs, **read).withColumn("_tokens", token_count(F.col("_text")))
    out = out.withColumn("_topic_name", F.col("_named") if topic_col else form_topic(F.col("_text"), F.col("_tokens")))
    described = out.withColumns({"_source": _key(F.col("_source")), "_lang": _key(F.col("_lang")), "_topic": _key(F.col("_topic_name"))})
    cells = staged(described.groupBy(*keys).agg(F.sum("_tokens").alias("t")), "mix-sums")
    raked = rake(cells, targets, power, rounds)
    scale = calibrated(raked, kept)
    chance = raked.select(*keys, (F.least(F.lit(1.0), F.col("f") * F.lit(scale)) if scale is not None else F.lit(1.0)).alias("_probability"))
    return described.join(chance, keys).withColumn("_kept", uniform(F.col("_id"), seed) < F.col("_probability"))


def sql(rounds: int = ROUNDS, power: float = POWER, seed: str = SEED, kept: float = KEPT, tolerance: float = TOLERANCE) -> str:
    """The same over the table documents; a round after the last one needed changes nothing."""
    low = "coalesce(text, '')"
    marks = lambda c: f"(length({low}) - length(translate({low}, '{c}', '')))"
    steps, last = [], "c0"
    for i in range(rounds):
        steps.append(f"q{i} as (select * replace (done or coalesce(max(moved) over () <= {tolerance}, false) as done, 0.0::double as moved) from {last})")
        last = f"q{i}"
        for d in DIMENSIONS:
            name = f"c{i}_{d}"
            ratio = f"case when not done and sum(t * f) over (partition by {d}) > 0 then target_{d} / sum(t * f) over (partition by {d}) else 1.0 end"
            steps.append(f"{name}_r as (select *, {ratio} as ratio from {last}), {name} as (select * exclude (ratio) replace (f * ratio as f, case when done then 0.0 else greatest(moved, abs(ratio - 1)) end as moved) from {name}_r)")
            last = name
    target = lambda d: f"r_{d} as (select {d}, pow(sum(t), {power}) as r from s group by {d}), g_{d} as (select {d}, r / (select sum(r) from r_{d}) * (select sum(t) from s) as target_{d} from r_{d})"
    joins = " ".join(f"join g_{d} on g_{d}.{d} is not distinct from s.{d}" for d in DIMENSIONS)
    return f"""with n as (select doc_id, source, lang, text, cast(len(regexp_extract_all({low}, '[^\x20\x09-\x0D]+')) as bigint) as tokens from documents),
d as (select doc_id, source, lang, tokens, case when {marks("|")} * 5 > tokens then 'table' when {marks("#$%&*")} > tokens then 'symbols'
  when {marks("!")} * 2 > tokens then 'shouting' when tokens >= 300 then 'long' else 'short' end as topic from n),
s as (select source, lang, topic, cast(sum(tokens) as double) as t from d group by all),
{", ".join(target(d) for d in DIMENSIONS)},
c0 as (select s.source, s.lang, s.topic, t, 1.0::double as f, null::double as moved, false as done, {", ".join(f"target_{d}" for d in DIMENSIONS)} from s {joins}),
{", ".join(steps)},
w as (select source, lang, topic, t, f, {kept} * sum(t) over () as budget,
  sum(t) over (order by f desc) - sum(t) over (partition by f) as above, sum(t * f) over (order by f) as below from {last}),
full_cells as (select *, below > 0 and (budget - above) / below * f >= 1 as full_cell from w),
scale as (select (max(budget) - coalesce(sum(t) filter (where full_cell), 0)) / sum(t * f) filter (where not full_cell) as factor from full_cells),
p as (select source, lang, topic, case when full_cell then 1.0 else least(1.0, f * factor) end as p from full_cells, scale)
select d.doc_id, d.source, d.lang, d.topic, d.tokens, round(p, 6) as probability,
  cast(('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'null') || '|{seed}'), 1, 13)) as bigint) / 4503599627370496.0 < p as kept
from d join p on p.source is not distinct from d.source and p.lang is not distinct from d.lang and p.topic = d.topic"""
