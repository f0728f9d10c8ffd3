"""Approximate nearest neighbours: a graph by NN-descent in Spark joins, searched greedily.

Equal vectors are one node. A first graph comes from the leaves of a few random
hyperplane trees. Each round of descent gathers for every node the neighbours it
has and the nodes that have it, compares these with each other, and every node
keeps the best it has seen: neighbours of neighbours become neighbours. A query
starts at its own node and expands the best nodes seen so far until none of the
best is left unexpanded. Both work on vectors of one byte a component with a
scale of their own; the final scores are computed in double precision on the
original vectors.

The measure is the inner product. One more component makes all norms equal, so
that near in the graph means a large inner product also for vectors of
different length. It is kept as a double beside the bytes, which it would
otherwise flatten where one vector is much longer than the others. A search
starts at the longest vectors too, as these have the largest products.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.stage import staged

#: Neighbours of a node, and nodes sampled from those that have it as neighbour.
DEGREE = 20
BACK = 20
ROUNDS = 6
#: Candidates that one comparison offers to a node.
OFFERS = 4
TREES = 4
LEAF = 128
#: Best nodes kept by a search, nodes whose scores are computed exactly, and its steps at most.
BEAM = 160
RESCORED = 60
STEPS = 12
#: Longest vectors at which every search starts.
LONGEST = 64
#: Descent ends when at most this share of the neighbours is new.
CHANGED = 0.01
#: Queries searched together; their vectors are broadcast.
QUERY_BLOCK = 4096


def _packed(x: np.ndarray, last: np.ndarray) -> list[bytes]:
    """Rows of the components as bytes, with their scale and the component that makes norms equal in front, both doubles."""
    scale = np.abs(x).max(axis=1, keepdims=True) / 127
    q = np.rint(x / np.maximum(scale, 1e-300)).astype(np.int8)
    head = np.concatenate([scale, last[:, None]], axis=1)
    return [a + b for a, b in zip(map(bytes, head.view(np.uint8)), map(bytes, q.view(np.uint8)), strict=True)]


def _unpacked(column: pa.Array) -> np.ndarray:
    column = column.cast(pa.large_binary())
    if not len(column):
        return np.zeros((0, 1))
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]].reshape(len(column), -1)
    head = raw[:, :16].copy().view(np.float64)
    return np.concatenate([raw[:, 16:].copy().view(np.int8) * head[:, :1], head[:, 1:]], axis=1)


def _vectors(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def valid_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, x): rows with an id and a vector of finite components, not all zero, of the most frequent length."""
    x = F.transform(F.col(vector_col), lambda e: e.cast("double"))
    rows = table.select(F.col(id_col).alias("id"), x.alias("x")).where("id is not null and size(x) > 0")
    bad = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    rows = rows.where(~bad & F.exists("x", lambda e: e != 0))
    length = rows.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("x") == (length["n"] if length else 0))


def _nodes(vectors: DataFrame) -> DataFrame:
    """(c, b): one row for each distinct vector, named by its smallest id, with its bytes."""
    distinct = staged(vectors.groupBy("x").agg(F.min("id").alias("c")), "ann-classes")
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, e: a + e * e))
    largest = distinct.agg(F.max(norm).alias("m")).first()["m"] or 1.0

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _vectors(batch.column(1)) / largest
            last = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_packed(x, last) if len(x) else [], pa.binary())], names=["c", "b"])

    return staged(distinct.select("c", "x").mapInArrow(pack, "c bigint, b binary"), "ann-nodes")


def _offers(ids: np.ndarray, x: np.ndarray, least: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(u, v, s): for each of the nodes the best others above its least score."""
    _, first = np.unique(ids, return_index=True)  # a neighbour both ways is there twice
    ids, x, least = ids[first], x[first], least[first]
    s = x @ x.T
    s[ids[:, None] == ids[None, :]] = -np.inf
    s[s <= least[:, None]] = -np.inf
    k = min(count, len(ids))
    top = np.argpartition(-s, k - 1, axis=1)[:, :k]
    best = np.take_along_axis(s, top, axis=1)
    a, b = np.nonzero(best > -np.inf)
    return ids[a], ids[top[a, b]], best[a, b]


def _compare(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    """Offers among the members of each group."""
    names = ["u", "v", "s", "old"]
    for batch in batches:
        groups = batch.column(batch.schema.get_field_index("members"))
        flat = groups.flatten()
        ids, least = flat.field("c").to_numpy(zero_copy_only=False), flat.field("least").to_numpy(zero_copy_only=False)
        x = _unpacked(flat.field("b"))
        at = np.concatenate(([0], np.cumsum(groups.value_lengths().to_numpy(zero_copy_only=False))))
        found = [_offers(ids[i:j], x[i:j], least[i:j], count) for i, j in zip(at[:-1], at[1:], strict=True) if j - i > 1]
        cols = [np.concatenate([f[k] for f in found]) if found else np.zeros(0) for k in range(3)]
        yield pa.RecordBatch.from_arrays([pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(np.int64)), pa.array(cols[2].astype(np.float64)), pa.array(np.zeros(len(cols[0]), bool))], names=names)


_EDGE = "u bigint, v bigint, s double, old boolean"


def _best(edges: DataFrame, degree: int) -> DataFrame:
    """(u, near, least): the best neighbours of each node, and the score that a better one has to beat."""
    w = Window.partitionBy("u").orderBy(F.desc("s"), "v")
    once = edges.repartition("u").groupBy("u", "v").agg(F.max("s").alias("s"), F.max("old").alias("old"))  # one shuffle for all three steps
    top = once.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= degree)
    rows = top.groupBy("u").agg(F.collect_list(F.struct("v", "s", "old")).alias("near"), F.min("s").alias("_s"))
    return rows.select("u", "near", F.when(F.size("near") >= degree, F.col("_s")).otherwise(F.lit(float("-inf"))).alias("least"))


def _edges(graph: DataFrame) -> DataFrame:
    return graph.select("u", F.explode("near").alias("e")).select("u", "e.v", "e.s", F.lit(True).alias("old"))


def _leaves(nodes: DataFrame, n: int) -> DataFrame:
    """Groups of nodes that fall on the same sides of random hyperplanes, for several trees; the last tree is dealt by hash."""
    bits = max(0, int(np.ceil(np.log2(max(1, n / LEAF)))))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _unpacked(batch.column(1))
            planes = np.random.default_rng(5).standard_normal((TREES - 1, bits, x.shape[1])).astype(np.float32)
            codes = [((x @ p.T > 0) << np.arange(bits)).sum(axis=1) if bits else np.zeros(len(x), np.int64) for p in planes]
            codes.append((batch.column(0).to_numpy() * 2654435761 >> 7) % (1 << bits))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(np.stack(codes, axis=1).tolist(), pa.list_(pa.int64()))], names=["c", "b", "codes"])

    coded = nodes.mapInArrow(code, "c bigint, b binary, codes array<bigint>")
    rows = staged(coded.select("c", "b", F.posexplode("codes").alias("tree", "leaf")), "ann-leaves")
    sizes = rows.groupBy("tree", "leaf").agg(F.ceil(F.count("*") / (2 * LEAF)).alias("parts"))
    part = F.pmod(F.xxhash64("c", "tree"), F.col("parts")).alias("part")  # an overfull leaf is dealt into several
    dealt = rows.join(sizes, ["tree", "leaf"]).select("tree", "leaf", part, F.struct("c", F.lit(float("-inf")).alias("least"), "b").alias("m"))
    return dealt.groupBy("tree", "leaf", "part").agg(F.collect_list("m").alias("members")).select("members")


def _both_ways(graph: DataFrame, salt: int) -> DataFrame:
    """(u, v): the neighbours of each node and a fixed number of the nodes that have it as neighbour."""
    w = Window.partitionBy("u").orderBy(F.xxhash64("u", "v", F.lit(salt)), "v")
    there = _edges(graph)
    back = there.select(F.col("v").alias("u"), F.col("u").alias("v")).withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= BACK).drop("_r")
    return there.select("u", "v").unionByName(back)


def build_graph(nodes: DataFrame, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """(u, near, least): the neighbours of every node by NN-descent. Ends early when few neighbours are new.

    `nodes` is kept in memory, dealt by c, so that the joins need not move it.
    """
    n = nodes.count()
    graph = staged(_best(_leaves(nodes, n).mapInArrow(lambda b: _compare(b, degree), _EDGE), degree), "ann-graph")
    for r in range(rounds):
        least = graph.select(F.col("u").alias("c"), "least")
        known = nodes.join(least, "c", "left").select(F.col("c").alias("v"), F.struct("c", F.coalesce("least", F.lit(float("-inf"))).alias("least"), "b").alias("m"))
        near = _both_ways(graph, r).join(known, "v").groupBy("u").agg(F.collect_list("m").alias("members"))  # degree + BACK members at most
        offers = near.select("members").mapInArrow(lambda b: _compare(b, OFFERS), _EDGE)
        graph = staged(_best(_edges(graph).unionByName(offers), degree), "ann-graph")
        now = graph.agg(F.sum(F.size("near")).alias("n"), F.sum(F.size(F.filter("near", lambda e: ~e["old"]))).alias("new")).first()
        if (now["new"] or 0) <= CHANGED * (now["n"] or 0):
            break
    return graph


def _scored(batches: Iterator[pa.RecordBatch], x: np.ndarray, least: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        q = batch.column(batch.schema.get_field_index("queries"))
        lengths = q.value_lengths().to_numpy(zero_copy_only=False)
        c = np.repeat(batch.column(batch.schema.get_field_index("c")).to_numpy(), lengths)
        b = _unpacked(batch.column(batch.schema.get_field_index("b")))
        qs = q.flatten().to_numpy(zero_copy_only=False)
        at, out = np.concatenate(([0], np.cumsum(lengths))), np.zeros(len(qs))
        for i in range(len(lengths)):
            out[at[i] : at[i + 1]] = x[qs[at[i] : at[i + 1]]] @ b[i]
        keep = out > least[qs]
        yield pa.RecordBatch.from_arrays([pa.array(qs[keep]), pa.array(c[keep]), pa.array(out[keep])], names=["q", "c", "s"])


def _state(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Per query of this task: how many nodes it holds, the least score, and whether all are expanded."""
    n, least, done = np.zeros(size, np.int64), np.full(size, np.inf), np.ones(size, bool)
    for batch in batches:
        q = batch.column(0).to_numpy()
        n += np.bincount(q, minlength=size)
        np.minimum.at(least, q, batch.column(1).to_numpy())
        done[q[~batch.column(2).to_numpy(zero_copy_only=False)]] = False
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at]), pa.array(least[at]), pa.array(done[at])], names=["q", "n", "s", "done"])


def _search(starts: list[tuple[int, bytes]], longest: list[tuple[int, bytes]], wide: DataFrame, beam: int, steps: int) -> DataFrame:
    """(q, c, s): the best nodes of a block of queries, which start at their own nodes and the longest ones.

    `wide` holds each node's bytes and neighbours, kept in memory and dealt by c.
    """
    spark = wide.sparkSession
    x = _unpacked(pa.array([b for _, b in starts], pa.binary()))
    x[:, -1] = 0  # a query has no part in the component that makes norms equal
    far = x @ _unpacked(pa.array([b for _, b in longest], pa.binary())).T
    own = [{int(c): float(s) for (c, _), s in zip(longest, row, strict=True)} | {int(starts[i][0]): float(x[i] @ x[i])} for i, row in enumerate(far)]
    best = spark.createDataFrame([(i, c, s, False) for i, scores in enumerate(own) for c, s in scores.items()], "q bigint, c bigint, s double, done boolean")
    least = np.full(len(starts), -np.inf)
    shared = spark.sparkContext.broadcast(x)
    size = len(starts)
    w = Window.partitionBy("q").orderBy(F.desc("s"), "c")
    for _ in range(steps):
        bound = spark.sparkContext.broadcast(least)
        reached = best.where("not done").join(wide, "c").select("q", F.explode("near").alias("c"))
        asked = reached.groupBy("c").agg(F.collect_set("q").alias("queries"))  # QUERY_BLOCK queries at most
        seen = asked.join(wide, "c").select("c", "queries", "b").mapInArrow(lambda b, bound=bound: _scored(b, shared.value, bound.value), "q bigint, c bigint, s double")
        all_seen = best.withColumn("done", F.lit(True)).unionByName(seen.withColumn("done", F.lit(False)))
        once = all_seen.repartition("q").groupBy("q", "c").agg(F.max("s").alias("s"), F.max("done").alias("done"))
        best = staged(once.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= beam).drop("_r"), "ann-beam")
        # a few rows for each query of the block
        parts = best.select("q", "s", "done").mapInArrow(lambda b: _state(b, size), "q bigint, n bigint, s double, done boolean").toArrow()
        q, count, lowest = parts["q"].to_numpy(), np.zeros(size, np.int64), np.full(size, np.inf)
        np.add.at(count, q, parts["n"].to_numpy())
        np.minimum.at(lowest, q, parts["s"].to_numpy())
        if parts["done"].to_numpy().all():
            break
        least = np.where(count >= beam, lowest, -np.inf)
    return best.select("q", "c", "s")


def nearest(
    table: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", degree: int = DEGREE, rounds: int = ROUNDS, beam: int = BEAM, steps: int = STEPS
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for each row of `table` that meets `is_query`.

    All rows with a usable vector are indexed. NULL ids, NULL, empty and zero
    vectors, vectors with NULL or non-finite components and vectors of another
    length than most take no part. Equal scores go to the smaller id; repeated
    rows count once; fewer than k others give fewer ranks; an empty table gives an
    empty result. Other columns are not read.
    """
    spark = table.sparkSession
    vectors = staged(valid_vectors(table, id_col, vector_col).dropDuplicates(["id", "x"]), "ann-vectors")
    nodes = _nodes(vectors).repartition("c").persist()
    by_class = Window.partitionBy("c").orderBy("id")
    named = staged(vectors.join(_classes_of(vectors), "x").select("id", "c"), "ann-named")
    members = named.withColumn("_r", F.row_number().over(by_class)).where(F.col("_r") <= k + 1).drop("_r")
    graph = build_graph(nodes, degree, rounds)
    near = staged(_both_ways(graph, -1).groupBy("u").agg(F.collect_set("v").alias("near")).withColumnRenamed("u", "c"), "ann-adjacent")
    wide = nodes.join(near, "c", "left").withColumn("near", F.coalesce("near", F.array().cast("array<bigint>"))).persist()
    by_norm = F.aggregate("x", F.lit(0.0), lambda a, e: a + e * e)
    ends = vectors.join(named, "id").select("c", by_norm.alias("_n")).distinct().orderBy(F.desc("_n"), "c").limit(LONGEST).select("c")
    longest = [(r["c"], bytes(r["b"])) for r in nodes.join(F.broadcast(ends), "c").select("c", "b").collect()]  # LONGEST rows
    queries = staged(named.where(is_query(F.col("id"))), "ann-queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    out = None
    for i in range(blocks):
        block = queries.where(F.pmod(F.xxhash64("c"), F.lit(blocks)) == i)
        starts = [(r["c"], bytes(r["b"])) for r in block.select("c").distinct().join(nodes, "c").orderBy("c").collect()]  # about QUERY_BLOCK queries
        if not starts:
            continue
        found = _search(starts, longest, wide, beam, steps)
        numbered = spark.createDataFrame([(j, int(c)) for j, (c, _) in enumerate(starts)], "q bigint, qc bigint")
        w = Window.partitionBy("q").orderBy(F.desc("s"), "c")
        top = found.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= RESCORED).select("q", "c")
        ids = top.join(members, "c").join(numbered, "q").select("qc", F.col("id").alias("vec_id"))
        pairs = ids.join(block.select(F.col("c").alias("qc"), F.col("id").alias("query_id")), "qc").where("query_id <> vec_id").select("query_id", "vec_id")
        left = vectors.select(F.col("id").alias("query_id"), F.col("x").alias("_x"))
        right = vectors.select(F.col("id").alias("vec_id"), F.col("x").alias("_y"))
        score = F.aggregate(F.zip_with("_x", "_y", lambda a, b: a * b), F.lit(0.0), lambda a, e: a + e)
        scored = pairs.join(right, "vec_id").join(left, "query_id").select("query_id", "vec_id", score.alias("score")).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        part = staged(scored.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"), "ann-result")
        out = part if out is None else out.unionByName(part)
    wide.unpersist()
    nodes.unpersist()
    return out if out is not None else spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")


def _classes_of(vectors: DataFrame) -> DataFrame:
    return vectors.groupBy("x").agg(F.min("id").alias("c"))
