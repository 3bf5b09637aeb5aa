"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

Rows are dealt by hash into shards of bounded size. In a shard vectors join a
directed graph in growing batches: a greedy beam search from the medoid proposes
neighbours, relaxed pruning keeps an edge only if no kept neighbour is nearer to
its end by the factor ``ALPHA``, so edges point in diverse directions, and reverse
edges are added under the same rule. The graphs are a written table. Queries go
in blocks to every shard, beam search finds candidates there, their cosines are
computed in double precision from the original vectors, and the best of all
shards are ranked.

Equal vectors of a shard are one point of its graph, which lists their ids, so
any number of copies is handled. Vectors that are null, zero or hold null or
non-finite components take no part, nor do rows without an id; vectors of
different lengths are not compared. A row with the query's id is the query's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.staging import bounded_batches, staged

NEIGHBOURS = 5
EVERY = 50
SHARD_ROWS = 8192
QUERY_BLOCK = 4096
DEGREE, BEAM, ALPHA, WIDE = 32, 64, 1.2, 4
BATCH = 512
INDEX_SCHEMA = "dim int, shard int, medoid int, ids binary, group_of binary, vectors binary, graph binary"


def usable(embeddings: DataFrame) -> DataFrame:
    """vec_id and vector of the rows that take part."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    return rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(
        finite & F.exists("vector", lambda x: x != 0)
    )


def beam_search(vectors: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and similarities of the ``beam`` best points found for each query, best first; all queries in step."""
    n = len(queries)
    ids = np.full((n, beam), -1, np.int64)
    near = np.full((n, beam), -np.inf, np.float32)
    done = np.ones((n, beam), bool)
    ids[:, 0], near[:, 0], done[:, 0] = start, queries @ vectors[start], False
    seen = np.zeros((n, len(vectors)), bool)
    seen[:, start] = True
    active = np.arange(n)
    while len(active):
        pick = np.argsort(done[active], axis=1, kind="stable")[:, :WIDE]  # the best not yet expanded
        fresh = ~np.take_along_axis(done[active], pick, 1)
        points = np.where(fresh, np.take_along_axis(ids[active], pick, 1), -1)
        rows = np.repeat(active[:, None], pick.shape[1], 1)
        done[rows, pick] = True
        found = np.where(points[:, :, None] >= 0, graph[points], -1).reshape(len(active), -1)
        found = np.sort(found, axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        found[(found >= 0) & seen[active[:, None], found]] = -1
        at, column = np.nonzero(found >= 0)
        seen[active[at], found[at, column]] = True
        value = np.full(found.shape, -np.inf, np.float32)
        value[at, column] = np.einsum("ij,ij->i", vectors[found[at, column]], queries[active[at]])
        all_ids = np.concatenate((ids[active], found), 1)
        all_near = np.concatenate((near[active], value), 1)
        all_done = np.concatenate((done[active], found < 0), 1)
        best = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        ids[active] = np.take_along_axis(all_ids, best, 1)
        near[active] = np.take_along_axis(all_near, best, 1)
        done[active] = np.take_along_axis(all_done, best, 1)
        active = active[~done[active].all(axis=1)]
    return ids, near


def robust_prune(vectors: np.ndarray, points: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """At most DEGREE diverse neighbours of each point among its candidates (-1: none)."""
    valid = (candidates >= 0) & (candidates != points[:, None])
    far = 1 - np.einsum("ijk,ik->ij", vectors[candidates], vectors[points])
    far[~valid] = np.inf
    order = np.argsort(far, axis=1, kind="stable")
    candidates, far = np.take_along_axis(candidates, order, 1), np.take_along_axis(far, order, 1)
    own = vectors[candidates]
    between = 1 - own @ own.transpose(0, 2, 1)
    alive = np.isfinite(far)
    out = np.full((len(points), DEGREE), -1, np.int64)
    rows = np.arange(len(points))
    for k in range(DEGREE):
        any_left = alive.any(axis=1)
        if not any_left.any():
            break
        pick = alive.argmax(axis=1)
        out[:, k] = np.where(any_left, candidates[rows, pick], -1)
        alive &= ~(ALPHA * between[rows, pick] <= far)
        alive[rows, pick] = False
    return out


def build(vectors: np.ndarray) -> tuple[np.ndarray, int]:
    """The graph over unit vectors, as rows of neighbours, and its medoid."""
    n = len(vectors)
    graph = np.full((n, DEGREE), -1, np.int64)
    medoid = int(np.argmax(vectors @ vectors.mean(axis=0)))
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate(([medoid], order[order != medoid]))
    at = 1
    while at < n:
        batch = order[at : at + min(BATCH, max(1, at // 2))]
        at += len(batch)
        candidates, _ = beam_search(vectors, graph, medoid, vectors[batch], BEAM)
        graph[batch] = robust_prune(vectors, batch, candidates)
        source = np.repeat(batch, DEGREE)
        target = graph[batch].ravel()
        source, target = source[target >= 0], target[target >= 0]
        _link_back(vectors, graph, target, source)
    return graph, medoid


def _link_back(vectors: np.ndarray, graph: np.ndarray, of: np.ndarray, to: np.ndarray) -> None:
    """Adds edges ``of`` -> ``to``; full rows are pruned."""
    near = np.einsum("ij,ij->i", vectors[of], vectors[to])
    order = np.lexsort((-near, of))
    of, to = of[order], to[order]
    points, first, counts = np.unique(of, return_index=True, return_counts=True)
    rank = np.arange(len(of)) - np.repeat(first, counts)
    kept = rank < BEAM
    fresh = np.full((len(points), min(int(counts.max()), BEAM)), -1, np.int64)
    fresh[np.repeat(np.arange(len(points)), counts)[kept], rank[kept]] = to[kept]
    merged = np.concatenate((graph[points], fresh), 1)
    for a in range(0, len(points), 1024):
        graph[points[a : a + 1024]] = robust_prune(vectors, points[a : a + 1024], merged[a : a + 1024])


def _unit(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy().reshape(len(lists), -1).astype(np.float64)


def index_shard(table: pa.Table) -> pa.Table:
    """One row: the shard's ids, distinct vectors and graph."""
    ids = table.column("vec_id").to_numpy()
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    vectors, group_of = np.unique(_matrix(table.column("vector"))[order], axis=0, return_inverse=True)
    graph, medoid = build(_unit(vectors))
    return pa.table(
        {
            "dim": table.column("dim")[:1],
            "shard": table.column("shard")[:1],
            "medoid": pa.array([medoid], pa.int32()),
            "ids": [ids.tobytes()],
            "group_of": [group_of.ravel().astype(np.int64).tobytes()],
            "vectors": [vectors.tobytes()],
            "graph": [graph.astype(np.int32).tobytes()],
        }
    )


def build_index(rows: DataFrame) -> DataFrame:
    """The written table of graphs, one row for each shard."""
    bounded_batches(rows.sparkSession)
    shards = max(1, -(-rows.count() // SHARD_ROWS))
    dealt = rows.select(
        "vec_id", "vector", F.size("vector").alias("dim"), F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard")
    )
    return staged(dealt.groupBy("dim", "shard").applyInArrow(index_shard, INDEX_SCHEMA))


def _block(table: pa.Table) -> pa.Table:
    return pa.table(
        {
            "block_dim": table.column("dim")[:1],
            "query_ids": [table.column("vec_id").to_numpy().tobytes()],
            "query_vectors": [_matrix(table.column("vector")).tobytes()],
        }
    )


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best of one shard for every query of one block."""
    for batch in batches:
        for row in batch.to_pylist():
            dim = row["dim"]
            ids, group_of = (np.frombuffer(row[c], np.int64) for c in ("ids", "group_of"))
            vectors = np.frombuffer(row["vectors"]).reshape(-1, dim)
            graph = np.frombuffer(row["graph"], np.int32).reshape(-1, DEGREE).astype(np.int64)
            query_ids = np.frombuffer(row["query_ids"], np.int64)
            queries = np.frombuffer(row["query_vectors"]).reshape(-1, dim)
            members = np.argsort(group_of, kind="stable")  # ids ascend within each vector
            begins = np.searchsorted(group_of[members], np.arange(len(vectors) + 1))
            norms = np.linalg.norm(vectors, axis=1)
            unit = _unit(vectors)
            out: list[list] = [[], [], []]
            for a in range(0, len(queries), BATCH):
                found, _ = beam_search(unit, graph, row["medoid"], _unit(queries[a : a + BATCH]), BEAM)
                for k, points in enumerate(found):
                    q = queries[a + k]
                    points = points[points >= 0]
                    score = np.clip(vectors[points] @ q / (norms[points] * np.linalg.norm(q)), -1, 1)
                    best = []
                    for p, s in zip(points, score):
                        own = ids[members[begins[p] : begins[p + 1]][: NEIGHBOURS + 1]]
                        best += [(-s, v) for v in own if v != query_ids[a + k]]
                    for s, v in sorted(best)[:NEIGHBOURS]:
                        for column, value in zip(out, (query_ids[a + k], v, -s)):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())],
                names=["query_id", "vec_id", "score"],
            )


def search(index: DataFrame, queries: DataFrame) -> DataFrame:
    """query_id, rank, vec_id and score of each query's nearest rows."""
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    keyed = queries.select(
        "vec_id", "vector", F.size("vector").alias("dim"), F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(blocks)).alias("block")
    )
    asked = keyed.groupBy("dim", "block").applyInArrow(_block, "block_dim int, query_ids binary, query_vectors binary")
    met = index.join(asked, F.col("dim") == F.col("block_dim")).repartition(F.col("shard"), F.xxhash64("query_ids"))
    found = met.mapInArrow(_answer, "query_id long, vec_id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= NEIGHBOURS)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, every: int = EVERY) -> DataFrame:
    """The neighbours of the rows whose id ``every`` divides, among all rows."""
    rows = usable(embeddings)
    return search(build_index(rows), rows.where(F.col("vec_id") % every == 0))
