"""Approximate nearest neighbours by inner product: an NN-descent graph and greedy search in it.

Equal vectors are one node (named by the smallest id; their ``members`` with the smallest ids answer for it).
The graph starts from random-projection trees: each tree deals all nodes into leaves, and within a leaf the
``degree`` nearest are found exactly.  The trees' hyperplanes come from a sample of ``SAMPLE`` nodes chosen by
hash; leaves that are larger than ``LEAF`` nodes (the sample bounds their number) are dealt on by hash.  Each
round of NN-descent then joins nodes with their neighbours' neighbours: a node's neighbours, in and out,
meet at it, compare each other, and those that beat the worst neighbour of one are proposed to it.
Vectors travel as bytes with a scale for this; nearness between them is then approximate, but only in
choosing the graph's edges.

Queries are searched in blocks of bounded size, whose vectors are broadcast.  A query's search starts from
its own node's edges; each hop expands the best nodes not yet expanded and scores their neighbours exactly,
in double precision on the original vectors, and keeps the ``beam`` best.

Vectors that are null, zero, hold nulls or non-finite components, or are not of the commonest length take no
part.  Repeated rows, and rows that share an id, are candidates and queries each: a query leaves out its own row
only.  Rows without an id take no part.  Other columns are ignored;
an empty table or query set gives no rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from renewcast.llm.shared import materialise, whole_groups

LEAF, SAMPLE, TREES, DEGREE, ROUNDS = 1024, 1 << 16, 6, 32, 2
BEAM, EXPAND, HOPS, QUERY_BYTES = 256, 64, 4, 32 << 20


def usable(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part, repeated ones each."""
    v = F.col(embedding).cast("array<double>")
    good = rows.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL").where(
        F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    length = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return good.where(F.size("v") == (length["d"] if length else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


class Trees:
    """Random hyperplanes with a sample's medians as thresholds; leaves are numbered across trees."""

    def __init__(self, sample: np.ndarray, trees: int, depth: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.depth = depth
        self.planes = rng.standard_normal((trees, depth, sample.shape[1]))
        self.cuts = np.zeros((trees, max(1, (1 << depth) - 1)))
        for t in range(trees):
            leaf = np.zeros(len(sample), np.int64)
            for level in range(depth):
                x = sample @ self.planes[t, level]
                for k in range(1 << level):
                    mine = x[leaf == k]
                    self.cuts[t, (1 << level) - 1 + k] = np.median(mine) if len(mine) else 0
                leaf = leaf * 2 + (x > self.cuts[t, (1 << level) - 1 + leaf])

    def leaves(self, v: np.ndarray) -> np.ndarray:
        out = np.zeros((len(v), len(self.planes)), np.int64)
        for t in range(len(self.planes)):
            leaf = np.zeros(len(v), np.int64)
            for level in range(self.depth):
                leaf = leaf * 2 + (v @ self.planes[t, level] > self.cuts[t, (1 << level) - 1 + leaf])
            out[:, t] = (t << self.depth) + leaf
        return out


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    k = min(k, scores.shape[1])
    return np.argpartition(-scores, k - 1, axis=1)[:, :k] if k < scores.shape[1] else np.broadcast_to(np.arange(k), scores.shape)


_EDGES = "node long, near long, score float"


def _edges(node, near, score) -> pa.RecordBatch:
    return pa.record_batch([pa.array(node, pa.int64()), pa.array(near, pa.int64()), pa.array(score.astype(np.float32))], names=["node", "near", "score"])


def _best(edges: DataFrame, degree: int) -> DataFrame:
    w = Window.partitionBy("node").orderBy(F.desc("score"), "near")
    return edges.select("*", F.row_number().over(w).alias("place")).where(F.col("place") <= degree)


def _start(nodes: DataFrame, count: int, trees: int, degree: int) -> DataFrame:
    rows = nodes.where(F.pmod(F.xxhash64("node"), F.lit(max(1, count // SAMPLE))) == 0).select("v").toPandas()
    sample = np.array(rows["v"].tolist()) if len(rows) else np.zeros((1, 1))
    depth = max(0, int(np.ceil(np.log2(max(1, min(count, len(sample) * LEAF // 64) / LEAF)))))
    forest = nodes.sparkSession.sparkContext.broadcast(Trees(sample, trees if depth else 1, depth))
    pieces = max(1, -(-count // (LEAF << depth)))

    def deal(batches):
        for batch in batches:
            v = _matrix(batch.column(1))
            if len(v):
                leaf = forest.value.leaves(v)
                for t in range(leaf.shape[1]):
                    yield pa.record_batch([pa.array(leaf[:, t]), batch.column(0), pa.FixedSizeBinaryArray.from_buffers(pa.binary(v.shape[1] * 4), len(v), [None, pa.py_buffer(np.ascontiguousarray(v, np.float32))]).cast(pa.binary())], names=["leaf", "node", "v"])

    dealt = nodes.select("node", "v").mapInArrow(deal, "leaf long, node long, v binary").withColumn("piece", F.pmod(F.xxhash64("node", "leaf"), F.lit(pieces)))

    def within(table: pa.Table) -> pa.Table:
        ids = table["node"].to_numpy()
        v = np.frombuffer(b"".join(table["v"].to_pylist()), np.float32).reshape(len(ids), -1)
        out = []
        for a in range(0, len(ids), 1024):
            s = v[a:a + 1024] @ v.T
            s[np.arange(len(s)), a + np.arange(len(s))] = -np.inf
            top = _top(s, degree)
            score = np.take_along_axis(s, top, 1)
            ok = np.isfinite(score)
            out.append(_edges(np.repeat(ids[a:a + 1024], ok.sum(axis=1)), ids[top][ok], score[ok]))
        return pa.Table.from_batches(out)

    return _best(dealt.groupBy("leaf", "piece").applyInArrow(within, _EDGES).distinct(), degree)


def _round(graph: DataFrame, nodes: DataFrame, degree: int) -> DataFrame:
    """The graph after its nodes have met their neighbours' neighbours."""
    worst = graph.groupBy("node").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("k")).select("node", F.when(F.col("k") >= degree, F.col("least")).otherwise(F.lit(float("-inf"))).cast("float").alias("least"))

    def pack(batches):
        for batch in batches:
            v = _matrix(batch.column(1))
            if len(v):
                scale = np.abs(v).max(axis=1) / 127
                q = np.round(v / scale[:, None]).astype(np.int8)
                yield pa.record_batch([batch.column(0), pa.array(scale.astype(np.float32)), pa.FixedSizeBinaryArray.from_buffers(pa.binary(v.shape[1]), len(v), [None, pa.py_buffer(np.ascontiguousarray(q))]).cast(pa.binary())], names=["node", "scale", "q"])

    packed = nodes.select("node", "v").mapInArrow(pack, "node long, scale float, q binary").join(worst, "node")
    out = graph.select(F.col("node").alias("at"), F.col("near").alias("node"), "score")
    back = graph.select(F.col("near").alias("at"), "node", "score")
    back = back.select("*", F.row_number().over(Window.partitionBy("at").orderBy(F.desc("score"), "node")).alias("place")).where(F.col("place") <= degree).drop("place")
    meet = out.unionByName(back).select("at", "node").distinct().join(packed, "node").select("at", "node", "scale", "least", "q")

    def compare(batches):
        for table in whole_groups(batches):
            at, ids = table["at"].to_numpy(), table["node"].to_numpy()
            least = table["least"].to_numpy()
            v = np.frombuffer(b"".join(table["q"].to_pylist()), np.int8).reshape(len(ids), -1) * table["scale"].to_numpy()[:, None]
            edge = np.append(np.flatnonzero(np.append(True, at[1:] != at[:-1])), len(at))
            found = []
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                s = v[a:b] @ v[a:b].T
                np.fill_diagonal(s, -np.inf)
                i, j = np.nonzero(s > least[a:b, None])
                found.append((ids[a + i], ids[a + j], s[i, j]))
            if found:
                node, near, score = (np.concatenate(x) for x in zip(*found))
                # Each proposal once a task; the best ones are all that can matter.
                order = np.lexsort((-score, near, node))
                node, near, score = node[order], near[order], score[order]
                keep = np.append(True, (node[1:] != node[:-1]) | (near[1:] != near[:-1])) if len(node) else np.zeros(0, bool)
                node, near, score = node[keep], near[keep], score[keep]
                order = np.lexsort((-score, node))
                node, near, score = node[order], near[order], score[order]
                first = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.zeros(0, np.int64)
                rank = np.arange(len(node)) - np.repeat(first, np.diff(np.append(first, len(node))))
                ok = rank < degree
                yield _edges(node[ok], near[ok], score[ok])

    proposed = meet.repartition("at").sortWithinPartitions("at").mapInArrow(compare, _EDGES)
    merged = graph.select("node", "near", "score").unionByName(proposed).groupBy("node", "near").agg(F.max("score").alias("score"))
    return _best(merged, degree)


def build_graph(nodes: DataFrame, trees: int = TREES, degree: int = DEGREE, rounds: int = ROUNDS) -> DataFrame:
    """nodes(node, v) -> (node, near, score, place): each node's nearest as found."""
    count = nodes.count()
    graph = materialise(_start(nodes, count, trees, degree), "graph")
    for _ in range(rounds if count > LEAF else 0):
        graph = materialise(_round(graph, nodes, degree), "graph")
    return graph


def _score(pairs: DataFrame, nodes: DataFrame, ids: np.ndarray, vectors: np.ndarray) -> DataFrame:
    """pairs(q, node) with the exact inner product; q: place in the block."""
    block = nodes.sparkSession.sparkContext.broadcast(vectors)

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 1 << 15):
                part = batch.slice(a, 1 << 15)
                q = part.column(0).to_numpy()
                s = np.einsum("ij,ij->i", block.value[q], _matrix(part.column(2)))
                yield pa.record_batch([part.column(0), part.column(1), pa.array(s)], names=["q", "node", "score"])

    return pairs.join(nodes.select("node", "v"), "node").select("q", "node", "v").mapInArrow(run, "q int, node long, score double")


def search(nodes: DataFrame, graph: DataFrame, queries: list, beam: int = BEAM, expand: int = EXPAND, hops: int = HOPS) -> DataFrame:
    """queries: one block of (query_id, its node or None, vector); -> (q, node, score), the beam of each."""
    spark = nodes.sparkSession
    ids = np.array([q[0] for q in queries])
    vectors = np.array([q[2] for q in queries], float)
    links = graph.select("node", "near").unionByName(graph.where(F.col("place") <= DEGREE // 2).select(F.col("near").alias("node"), F.col("node").alias("near"))).distinct()
    links = materialise(links, "links")
    starts = spark.createDataFrame([(i, q[1]) for i, q in enumerate(queries) if q[1] is not None], "q int, node long")
    own = starts.join(links, "node").select("q", F.col("near").alias("node")).unionByName(starts).distinct()
    w = Window.partitionBy("q").orderBy(F.desc("score"), "node")

    def keep(rows):
        return rows.select("*", F.row_number().over(w).alias("place")).where(F.col("place") <= beam)

    found = materialise(keep(_score(own, nodes, ids, vectors).withColumn("done", F.lit(False))), "beam")
    for _ in range(hops):
        fresh = found.where(~F.col("done")).select("q", "node", F.row_number().over(w).alias("k"), "score").where(F.col("k") <= expand)
        after = found.join(fresh.select("q", "node", F.lit(True).alias("now")), ["q", "node"], "left").select("q", "node", "score", (F.col("done") | F.coalesce("now", F.lit(False))).alias("done"))
        asked = fresh.join(links, "node").select("q", F.col("near").alias("node")).distinct().join(found.select("q", "node"), ["q", "node"], "left_anti")
        scored = _score(asked, nodes, ids, vectors).withColumn("done", F.lit(False))
        found = materialise(keep(after.unionByName(scored)), "beam")
    return found.select("q", "node", "score")


def nearest(rows: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", **how) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row for which is_query (a condition on vec_id)
    holds, without the row itself."""
    spark = rows.sparkSession
    good = materialise(usable(rows, vec_id, embedding).withColumn("row", F.monotonically_increasing_id()), "vectors")
    w = Window.partitionBy("v").orderBy("vec_id", "row")
    members = materialise(good.select("v", "vec_id", "row", F.row_number().over(w).alias("i")).where(F.col("i") <= k + 1), "members")
    nodes = materialise(members.where("i = 1").select(F.col("vec_id").alias("node"), "v"), "nodes")
    # An id with several vectors may name several nodes; the node then is a hash of the vector.
    if nodes.select("node").distinct().count() < nodes.count():
        nodes = materialise(nodes.select(F.xxhash64("v").alias("node"), "v"), "nodes")
    named = materialise(members.join(nodes, "v").select("node", "vec_id", "row"), "named")
    queries = materialise(good.where(is_query).join(nodes, "v").select("vec_id", "node", "v", "row"), "queries")
    graph = build_graph(nodes, **how)
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    blocks = max(1, -(-size["n"] * (size["d"] or 0) * 8 // QUERY_BYTES))
    out = None
    for b in range(blocks if size["n"] else 0):
        block = [(r["vec_id"], r["node"], r["v"], r["row"]) for r in queries.where(F.pmod(F.xxhash64("vec_id", "node"), F.lit(blocks)) == b).collect()]
        if not block:
            continue
        found = search(nodes, graph, block)
        ids = spark.createDataFrame([(i, q[0], q[3]) for i, q in enumerate(block)], "q int, query_id long, query_row long")
        rank = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "row")
        each = found.join(named, "node").join(F.broadcast(ids), "q").where("row <> query_row").select("q", "query_id", "vec_id", "score", F.row_number().over(rank).alias("rank")).where(F.col("rank") <= k)
        part = each.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")


def op8_neighbours(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
