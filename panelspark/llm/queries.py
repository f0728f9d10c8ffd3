"""One query for each text operator over its whole table, with SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from panelspark.llm import decontamination, hard_negatives, html_text, jaccard, language_model, licenses, mixing, neighbours, phrases, pii, quality_model, sharding, token_counts
from panelspark.llm.stage import whole_documents

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return add


@query()
def op7_sharding(spark, sf_dir):
    """Forty shards in a tree of regions and racks; grown_shard adds one shard."""
    return sharding.manifest(whole_documents(spark, sf_dir), sharding.tree(40), grown=sharding.tree(41))


def _words_sql(table: str, key: str) -> str:
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"select {key}, regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from {table}"


@query(
    f"""with d as ({_words_sql("documents", "doc_id")}), i as ({_words_sql("benchmark", "item_id")}),
p as (select distinct item_id, k, array_to_string(w[j:j + k - 1], ' ') as win
  from (select item_id, w, least(10, len(w)) as k, unnest(range(1, len(w) - least(10, len(w)) + 2)) as j from i where len(w) > 0)),
lens as (select distinct k from p),
dw as (select doc_id, k, j, array_to_string(w[j:j + k - 1], ' ') as win
  from (select doc_id, k, w, unnest(range(1, len(w) - k + 2)) as j from d, lens where len(w) >= k)),
hit as (select dw.doc_id, p.item_id, dw.j, p.k from dw join p on p.k = dw.k and p.win = dw.win),
pos as (select doc_id, count(distinct x) as n_hit from (select doc_id, unnest(range(j, j + k)) as x from hit) group by doc_id),
it as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as ids
  from (select distinct doc_id, cast(item_id as varchar) as item from hit) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join pos on pos.doc_id = d.doc_id left join it on it.doc_id = d.doc_id"""
)
def op5_decontamination(spark, sf_dir):
    """Benchmark windows of ten words in all documents."""
    found = decontamination.find_items(whole_documents(spark, sf_dir), whole_documents(spark, sf_dir, "benchmark"))
    return found.drop("spans")


@query(mixing.sql())
def op6_mixing(spark, sf_dir):
    """Raked sampling probabilities of all documents and which are kept."""
    mixed = mixing.mix(whole_documents(spark, sf_dir))
    probability = F.round("_probability", 6).alias("probability")
    return mixed.select("doc_id", "source", "lang", F.col("_topic_name").alias("topic"), F.col("_tokens").alias("tokens"), probability, F.col("_kept").alias("kept"))


@query(
    """with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select distinct doc_id, array_to_string(w[j:j + least(5, len(w)) - 1], ' ') as g
  from (select doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) as j from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
c as (select a.doc_id as x, b.doc_id as y, count(*) as o from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id),
l as (select x, y from c join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * o >= 75 * (nx.n + ny.n - o)),
r(x, k) as (select doc_id, doc_id from d union select l.y, r.k from r join l on l.x = r.x where r.k < l.y)
select d.doc_id, coalesce(n.n, 0) as n_shingles, min(r.k) as component_id
from d left join n on n.doc_id = d.doc_id join r on r.x = d.doc_id group by d.doc_id, n.n"""
)
def op3_jaccard_join(spark, sf_dir):
    """Components of all documents under a Jaccard similarity of 3/4 of five-word shingles."""
    return jaccard.near_duplicates(whole_documents(spark, sf_dir))


def _equal_to(value: str):
    return lambda x: x == value


@query()
def op9_pii(spark, sf_dir):
    """Plain and disguised personal data in all documents."""
    found = pii.find(whole_documents(spark, sf_dir))
    base = F.filter("spans", lambda s: s["plain"])
    counts = [F.size(F.filter(F.transform(base, lambda s: s["kind"]), _equal_to(k))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    added = (F.size("spans") - F.size(base)).cast("long").alias("n_disguised")
    return found.select("doc_id", *counts, F.sha2(pii.digest(base), 256).alias("base_sha256"), pii.digest(F.col("spans")).alias("spans"), added)


@query()
def op4_licenses(spark, sf_dir):
    """Licences named or quoted in all documents."""
    found = licenses.find_licenses(whole_documents(spark, sf_dir))
    names = F.array_join(F.array_sort(F.array_distinct(F.transform("licenses", lambda s: s["license"]))), ",")
    best = F.array_max(F.transform("licenses", lambda s: s["dice"]))
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_found"), names.alias("license_ids"), F.round(F.coalesce(best, F.lit(0.0)), 6).alias("best_dice"))


@query()
def op2_quality(spark, sf_dir):
    """Quality score of all documents and which are kept."""
    scored = quality_model.score(whole_documents(spark, sf_dir))
    return scored.select("doc_id", F.round("score", 6).alias("score"), F.round("weak_score", 6).alias("weak_score"), (F.col("score") >= quality_model.KEEP).alias("kept"))


@query()
def op1_html_text(spark, sf_dir):
    """Main text of all pages."""
    return html_text.extract(whole_documents(spark, sf_dir, "pages"))


@query()
def op8_neighbours(spark, sf_dir):
    """The twenty nearest of every twentieth vector."""
    return neighbours.nearest(whole_documents(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0)


@query()
def op10_language_model(spark, sf_dir):
    """Log probabilities of all documents by word counts and by the trained model."""
    return language_model.score(whole_documents(spark, sf_dir))


@query()
def op12_token_counts(spark, sf_dir):
    """Tokens of all documents as the byte-level BPE of the file counts them."""
    return token_counts.count_tokens(whole_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query(
    """with d as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents),
p as (select lang, row_number() over () as pid, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from d),
w as (select lang, pid, unnest(w) as x, unnest(range(1, len(w) + 1)) as j from p),
g as (select lang, x, lead(x, 1) over (partition by pid order by j) as y, lead(x, 2) over (partition by pid order by j) as z from w),
f as (select lang, x as phrase, 1 as k, count(*) as f from g group by all
  union all select lang, x || ' ' || y, 2, count(*) from g where y is not null group by all
  union all select lang, x || ' ' || y || ' ' || z, 3, count(*) from g where z is not null group by all),
n as (select lang, cast(sum(f) as bigint) as n from f where k = 1 group by lang),
c as (select *, string_split(phrase, ' ') as p from f where k >= 2 and f >= 10),
cuts as (select lang, phrase, k, f, cut, array_to_string(p[:cut], ' ') as lp, array_to_string(p[cut + 1:], ' ') as rp from c, (values (1), (2)) as cs(cut) where cut < k),
scored as (select cuts.lang, cuts.phrase, cuts.k, cuts.f as a, cut, fl.f as l, fr.f as r,
  cast((1000000::hugeint * cuts.f * cuts.f) // (fl.f::hugeint * fr.f) as bigint) as score
  from cuts join f fl on fl.lang = cuts.lang and fl.phrase = lp and fl.k = cut join f fr on fr.lang = cuts.lang and fr.phrase = rp and fr.k = cuts.k - cut),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
longer as (select lang, phrase, max(f) as f from (select lang, f, unnest([array_to_string(p[1:2], ' '), array_to_string(p[2:3], ' ')]) as phrase from c where k = 3) group by all),
kept as (select best.* from best left join longer on longer.lang = best.lang and longer.phrase = best.phrase and best.k = 2 where not coalesce(100 * longer.f >= 50 * a, false)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select ranked.lang, rank, phrase, a, l, r, n, score from ranked join n on n.lang = ranked.lang where rank <= 2000"""
)
def op13_phrases(spark, sf_dir):
    """The first phrases of two and three words of each language."""
    return phrases.mine(whole_documents(spark, sf_dir))


@query(
    """with e as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
  [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as v from embeddings
  where vec_id is not null and label is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(cast(x as double))]) = 0),
r as (select *, row_number() over () as row from e),
s as (select a.row as anchor, a.vec_id as anchor_id, b.vec_id, b.label = a.label as same,
  cast(coalesce(list_sum([z[1] * z[2] for z in list_zip(a.v, b.v)]), 0) as bigint) as score
  from r a join r b on a.row <> b.row where a.vec_id % 50 = 0),
p as (select anchor, anchor_id, vec_id as positive_id, score as positive_score, k from
  (select *, row_number() over (partition by anchor order by score desc, vec_id) as k from s where same) where k <= 5),
n as (select p.*, s.vec_id as negative_id, s.score as negative_score, row_number() over (partition by p.anchor, p.k order by s.score desc, s.vec_id) as rank
  from p join s on s.anchor = p.anchor and not s.same and 50 * p.positive_score <= 100 * s.score and 100 * s.score <= 95 * p.positive_score)
select anchor_id, positive_id, cast(rank as integer) as rank, negative_id, positive_score, negative_score from n where rank <= 3"""
)
def op11_hard_negatives(spark, sf_dir):
    """Hard negatives of every fiftieth vector below its five positives."""
    vectors = whole_documents(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", moved), lambda i: i % 50 == 0)
