"""Approximate nearest neighbours by a robust-pruned directed graph in each shard.

Equal vectors are one node, which keeps its smallest numbers. Nodes are dealt over shards by hash. In a
shard nodes enter a graph in batches: a greedy beam search from the entries over what is there proposes
neighbours, and pruning keeps a proposal only if no kept one is closer to it by the factor ``ALPHA``, so
edges point in different directions. Edges are added both ways and pruned again where a node has too many.

Inner products become distances by one more coordinate, which brings all vectors to the largest norm;
a query has 0 there, so nearer means a larger product. Results carry products in double precision.

Every query is searched in every shard. The index is sent to the tasks once, shard by shard: in a task a
shard's nodes come first and its queries stream past them in batches, so a task holds one shard and one
batch however many queries there are. A shard's best are merged by query.

Cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
rows without a number. Rows that repeat a number count once, with the smallest vector in Spark's order
of arrays. Vectors of different lengths are not compared. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from accesstally.llm.workers import importable, released
from accesstally.sources.scratch import scratch_path, written

#: Nodes of a shard, about, and queries that are searched together.
SHARD_NODES, TOGETHER = 6000, 256
#: Edges of a node, width of the beam while building and searching, nodes expanded in a step, pruning factor.
DEGREE, BUILD_BEAM, SEARCH_BEAM, EXPANDED, ALPHA = 24, 64, 128, 4, 1.2
#: Nodes a search starts from.
ENTRIES = 32
#: Nodes that enter together.
BATCH = 128
NEAREST = 20
QUERY_EVERY = 20


def nodes_of(vectors: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", keep: int = NEAREST + 1) -> tuple[DataFrame, DataFrame]:
    """Nodes (node, dim, vector, ids) and members (vec_id, node); ``ids`` are a node's smallest numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    usable = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    usable = usable.filter(F.col("vec_id").isNotNull() & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
    rows = usable.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    named = rows.groupBy("vector").agg(F.min("vec_id").alias("node"))
    first = Window.partitionBy("vector").orderBy("vec_id")
    smallest = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= keep)
    ids = smallest.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    nodes = ids.select(F.col("ids")[0].alias("node"), F.size("vector").alias("dim"), "vector", "ids")
    return nodes, rows.join(named, "vector").select("vec_id", "node")


def lifted(vectors: np.ndarray, largest: float) -> np.ndarray:
    """Vectors with one more coordinate that gives them all the same norm."""
    rest = np.sqrt(np.maximum(0, largest - (vectors**2).sum(axis=1)))
    return np.column_stack([vectors, rest]).astype(np.float32)


def beam(points: np.ndarray, edges: np.ndarray, entries: np.ndarray, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest nodes each query's greedy search meets, nearest first: numbers (-1 for none) and distances."""
    n, m = len(queries), len(entries)
    found = np.full((n, width), -1, np.int64)
    far = np.full((n, width), np.inf, np.float32)
    done = np.ones((n, width), bool)
    start = ((queries[:, None, :] - points[entries][None, :, :]) ** 2).sum(axis=2)
    order = np.argsort(start, axis=1, kind="stable")
    found[:, :m], far[:, :m], done[:, :m] = entries[order], np.take_along_axis(start, order, 1), False
    active = np.arange(n)
    while len(active):
        own, open_ = found[active], ~done[active]
        rank = np.cumsum(open_, axis=1)
        turn = open_ & (rank <= EXPANDED)
        row, column = np.nonzero(turn)
        done[active[row], column] = True
        slot = rank[row, column] - 1
        near = np.full((len(active), EXPANDED, edges.shape[1]), -1, np.int64)
        near[row, slot] = edges[own[row, column]]
        near = near.reshape(len(active), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[(near[:, :, None] == own[:, None, :]).any(axis=2)] = -1
        r, c = np.nonzero(near >= 0)
        distance = np.full(near.shape, np.inf, np.float32)
        step = points[near[r, c]] - queries[active[r]]
        distance[r, c] = np.einsum("ij,ij->i", step, step)
        every = np.concatenate([far[active], distance], axis=1)
        order = np.argpartition(every, width - 1, axis=1)[:, :width]
        order = np.take_along_axis(order, np.argsort(np.take_along_axis(every, order, 1), axis=1, kind="stable"), 1)
        far[active] = np.take_along_axis(every, order, 1)
        numbers = np.take_along_axis(np.concatenate([own, near], axis=1), order, 1)
        state = np.take_along_axis(np.concatenate([done[active], near < 0], axis=1), order, 1)
        numbers[np.isinf(far[active])] = -1
        found[active], done[active] = numbers, state | (numbers < 0)
        active = active[(~done[active]).any(axis=1)]
    return found, far


def pruned(points: np.ndarray, at: np.ndarray, proposed: np.ndarray) -> np.ndarray:
    """The kept neighbours of nodes ``at`` out of their proposals (-1 for none)."""
    n, m = proposed.shape
    safe = np.maximum(proposed, 0)
    others = points[safe]
    own = points[at]
    far = ((others - own[:, None, :]) ** 2).sum(axis=2)
    far[(proposed < 0) | (proposed == at[:, None])] = np.inf
    squares = (others**2).sum(axis=2)
    between = squares[:, :, None] + squares[:, None, :] - 2 * np.einsum("nik,njk->nij", others, others, optimize=True)
    kept = np.full((n, DEGREE), -1, np.int64)
    rows = np.arange(n)
    for k in range(DEGREE):
        best = far.argmin(axis=1)
        alive = np.isfinite(far[rows, best])
        if not alive.any():
            break
        kept[alive, k] = proposed[rows, best][alive]
        # a proposal goes if the one just kept is closer to it, by the factor, than the node is
        gone = ALPHA * ALPHA * between[rows, best] <= far
        far[gone & alive[:, None]] = np.inf
        far[rows, best] = np.inf
    return kept


def graph(points: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Edges [node, DEGREE] (-1 for none) and the entries, the first nodes of the random order.

    With one entry a search that starts in a crowd of near copies would not leave it.
    """
    n = len(points)
    edges = np.full((n, DEGREE), -1, np.int64)
    order = np.random.default_rng(seed).permutation(n)
    at, size = min(1, n), 1
    while at < len(order):
        batch = order[at : at + size]
        proposed, _ = beam(points, edges, order[: min(at, ENTRIES)], points[batch], BUILD_BEAM)
        at, size = at + size, min(2 * size, BATCH)
        if len(batch) > 1:  # those that enter together know of each other as well
            mates = np.stack([np.roll(batch, i + 1) for i in range(min(8, len(batch) - 1))], axis=1)
            proposed = np.concatenate([proposed, mates], axis=1)
        edges[batch] = pruned(points, batch, proposed)
        source = np.repeat(batch, DEGREE)
        target = edges[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        back = np.argsort(target, kind="stable")
        source, target = source[back], target[back]
        starts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(target) else np.empty(0, np.int64)
        nodes = target[starts]
        counts = np.diff(np.concatenate([starts, [len(target)]]))
        if not len(nodes):
            continue
        incoming = np.full((len(nodes), counts.max()), -1, np.int64)
        group = np.repeat(np.arange(len(nodes)), counts)
        incoming[group, np.arange(len(target)) - starts[group]] = source
        union = np.concatenate([edges[nodes], incoming], axis=1)
        union.sort(axis=1)
        union[:, 1:][union[:, 1:] == union[:, :-1]] = -1
        known = (union >= 0).sum(axis=1)
        fits = known <= DEGREE
        if fits.any():
            edges[nodes[fits]] = -np.sort(-union[fits], axis=1)[:, :DEGREE]
        over = np.flatnonzero(~fits)
        for start in range(0, len(over), BATCH):
            some = over[start : start + BATCH]
            packed = -np.sort(-union[some], axis=1)[:, : known[some].max()]
            edges[nodes[some]] = pruned(points, nodes[some], packed)
    return edges, order[:ENTRIES]


def build_index(nodes: DataFrame) -> DataFrame:
    """The index table: node, dim, shard, vector, ids, place in its shard, neighbours' places and rank as an entry."""
    spark = importable(nodes.sparkSession)
    nodes = written(nodes, scratch_path(spark, "nodes"))
    norm = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    stats = nodes.agg(F.count("*").alias("n"), F.max(norm).alias("largest")).first()
    shards = max(1, -(-stats["n"] // SHARD_NODES))
    largest = float(stats["largest"] or 0.0)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node").reset_index(drop=True)
        points = lifted(np.stack(rows["vector"].to_numpy()), largest)
        edges, entries = graph(points)
        rank = np.full(len(rows), -1, np.int64)
        rank[entries] = np.arange(len(entries))
        return rows.assign(place=np.arange(len(rows)), neighbours=[e[e >= 0].tolist() for e in edges], entry=rank, shards=shards)

    schema = "node long, dim int, vector array<double>, ids array<long>, shard long, place long, neighbours array<long>, entry long, shards long"
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(shards)))
    return written(dealt.groupBy("dim", "shard").applyInPandas(build, schema).withColumn("largest", F.lit(largest)), scratch_path(spark, "index"))


_FOUND = pa.schema([("query", pa.int64()), ("node", pa.int64()), ("ids", pa.list_(pa.int64())), ("score", pa.float64())])


def _vectors(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
    column = rows.column("vector")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Shard:
    """One shard's graph, made from its rows of the index in the order of their places."""

    def __init__(self, rows: pa.Table, largest: float):
        self.plain = _vectors(rows)
        self.points = lifted(self.plain, largest)
        self.nodes = rows.column("node").to_numpy()
        self.ids = rows.column("ids").combine_chunks()
        self.edges = np.full((len(self.nodes), DEGREE), -1, np.int64)
        for i, own in enumerate(rows.column("neighbours").to_pylist()):
            self.edges[i, : len(own)] = own
        rank = rows.column("entry").to_numpy()
        entries = np.flatnonzero(rank >= 0)
        self.entries = entries[np.argsort(rank[entries])]

    def nearest(self, asked: pa.RecordBatch, nearest: int) -> pa.RecordBatch:
        """The best nodes of this shard for each query, one more than asked for."""
        wanted, numbers = _vectors(asked), asked.column("node").to_numpy()
        lift = np.column_stack([wanted, np.zeros(len(wanted))]).astype(np.float32)
        near, _ = beam(self.points, self.edges, self.entries, lift, SEARCH_BEAM)
        queries, places, scores = [], [], []
        for query, vector, own in zip(numbers, wanted, near[:, : 2 * nearest + 8], strict=True):
            own = own[own >= 0]
            score = self.plain[own] @ vector
            best = np.lexsort((self.nodes[own], -score))[: nearest + 1]
            queries.append(np.full(len(best), query))
            places.append(own[best])
            scores.append(score[best])
        place = np.concatenate(places)
        columns = [pa.array(np.concatenate(queries)), pa.array(self.nodes[place]), self.ids.take(pa.array(place)), pa.array(np.concatenate(scores))]
        return pa.RecordBatch.from_arrays(columns, schema=_FOUND)


def _stretches(batch: pa.RecordBatch):
    """(dim, shard), whether they are queries, and the rows, for each stretch of a sorted batch."""
    marks = np.stack([batch.column(name).to_numpy() for name in ("dim", "shard", "asked")])
    cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(axis=0)) + 1 if batch.num_rows else []
    bounds = [0, *cuts, batch.num_rows]
    for start, end in zip(bounds, bounds[1:], strict=False):
        if end > start:
            yield tuple(marks[:2, start].tolist()), bool(marks[2, start]), batch.slice(start, end - start)


def search(index: DataFrame, queries: DataFrame, nearest: int = NEAREST) -> DataFrame:
    """(query, vec_id, score) of the nearest numbers of each query (query, dim, vector), one more than asked for."""
    importable(index.sparkSession)
    first = index.select("shards", "largest").first()
    shards, largest = (first["shards"], first["largest"]) if first else (1, 0.0)

    def find(batches):
        key, parts, shard = None, [], None
        for batch in batches:
            for own, asked, rows in _stretches(batch):
                if not asked:
                    if own != key:
                        key, parts, shard = own, [], None
                    parts.append(rows)
                elif own == key:
                    if shard is None:
                        shard, parts = Shard(pa.Table.from_batches(parts), largest), []
                    for at in range(0, rows.num_rows, TOGETHER):
                        yield shard.nearest(rows.slice(at, TOGETHER), nearest)

    held = index.select("dim", "shard", F.lit(0).alias("asked"), "place", "node", "vector", "ids", "neighbours", "entry")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard")
    nothing = F.lit(None)
    asked = queries.select(
        "dim", every, F.lit(1).alias("asked"), F.lit(0).cast("long").alias("place"), F.col("query").alias("node"), "vector",
        nothing.cast("array<long>").alias("ids"), nothing.cast("array<long>").alias("neighbours"), nothing.cast("long").alias("entry"),
    )
    dealt = held.unionByName(asked).repartition(2 * shards, "dim", "shard").sortWithinPartitions("dim", "shard", "asked", "place")
    found = dealt.mapInArrow(released(find), "query long, node long, ids array<long>, score double")
    each = found.select("query", F.explode("ids").alias("vec_id"), "score")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= nearest + 1).drop("n")


def op4_neighbours(spark, sf_dir):
    nodes, members = nodes_of(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    index = build_index(nodes)
    queries = written(members.filter(F.col("vec_id") % QUERY_EVERY == 0), scratch_path(spark, "queries"))
    asked = index.select(F.col("node").alias("query"), "dim", "vector").join(queries.select(F.col("node").alias("query")).distinct(), "query")
    found = search(index, asked).withColumnRenamed("query", "node")
    own = queries.withColumnRenamed("vec_id", "query_id").join(found, "node").filter("vec_id != query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = own.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NEAREST)
    return ranked.select("query_id", "rank", "vec_id", "score")
