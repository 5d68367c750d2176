"""Approximate nearest neighbours by inner product: one robust-pruned directed graph per shard.

A shard's graph is built by inserting points in growing batches: a greedy beam search over the graph so far
proposes neighbours, and pruning walks them from near to far and drops those that a kept neighbour covers
(distance to it, relaxed by ``alpha``, not above the distance to the point), so edges stay diverse. Edges are
added both ways and pruned again when a node has too many. A query runs a beam search in every shard; the
shards' answers are ranked by exact inner products in double precision.

Inner products become distances by one extra component, sqrt(max norm^2 - norm^2), which is zero in queries. A shard
holds vectors of one band of norms only (a factor of 16 from end to end), scaled by a power of two: in single
precision, a much longer vector would swamp the others' distances.
Equal vectors are one node with their ids (only the k + 1 smallest ids can ever be an answer; ties go to the
smaller id). Graphs are rows of a written table; a row meets the queries in blocks, so no task holds all of
either.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelkit.llm.common import on_workers, written


def beam_search(x: np.ndarray, graph: np.ndarray, entry: int, queries: np.ndarray, width: int,
                expand: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, squared distances) of the ``width`` nearest nodes seen, nearest first; -1 pads."""
    b, n = len(queries), len(x)
    rows = np.arange(b)[:, None]
    norms = np.einsum("ij,ij->i", x, x)
    ids = np.full((b, width), -1, np.int64)
    dist = np.full((b, width), np.inf, np.float32)
    done = np.ones((b, width), bool)
    seen = np.zeros((b, n), bool)
    ids[:, 0], done[:, 0], seen[:, entry] = entry, False, True
    dist[:, 0] = norms[entry] - 2 * (queries @ x[entry])
    live = np.arange(b)
    while len(live):
        open_ = ~done[live]
        first = np.argsort(~open_, axis=1, kind="stable")[:, :expand]      # the nearest open ones: rows are sorted
        valid = np.take_along_axis(open_, first, 1)
        node = np.where(valid, np.take_along_axis(ids[live], first, 1), -1)
        block = done[live]
        np.put_along_axis(block, first, True, 1)
        done[live] = block
        near = np.where(node[:, :, None] >= 0, graph[node], -1).reshape(len(live), -1)
        near.sort(axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        fresh &= ~seen[live[:, None], near]
        seen[live[:, None], np.where(fresh, near, node[:, :1])] = True
        take = np.where(fresh, near, 0)
        d = norms[take] - 2 * np.einsum("bkd,bd->bk", x[take], queries[live], optimize=False)
        d = np.where(fresh, d, np.inf).astype(np.float32)
        all_d = np.concatenate([dist[live], d], 1)
        all_i = np.concatenate([ids[live], np.where(fresh, near, -1)], 1)
        all_s = np.concatenate([done[live], ~fresh], 1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :width]
        dist[live], ids[live] = np.take_along_axis(all_d, order, 1), np.take_along_axis(all_i, order, 1)
        done[live] = np.take_along_axis(all_s, order, 1)
        live = live[~done[live].all(1)]
    square = np.einsum("ij,ij->i", queries, queries)[:, None]
    return ids, np.where(ids >= 0, np.maximum(dist + square, 0), np.inf)


def robust_prune(x: np.ndarray, points: np.ndarray, near: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours of each point among its candidates ``near`` (rows padded by -1)."""
    near = np.sort(near, axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    near[near == points[:, None]] = -1
    vectors = x[np.maximum(near, 0)]
    own = x[points][:, None, :]
    d = np.where(near >= 0, ((vectors - own) ** 2).sum(2), np.inf)
    square = (vectors ** 2).sum(2)
    among = square[:, :, None] + square[:, None, :] - 2 * np.matmul(vectors, vectors.transpose(0, 2, 1))
    out = np.full((len(points), degree), -1, np.int64)
    left, r = d.copy(), np.arange(len(points))
    for k in range(degree):
        best = left.argmin(1)
        ok = np.isfinite(left[r, best])
        if not ok.any():
            break
        out[ok, k] = near[r, best][ok]
        covered = alpha * alpha * np.maximum(among[r, best], 0) <= d
        left[covered & ok[:, None]] = np.inf
        left[r, best] = np.inf
    return out


def build_graph(x: np.ndarray, degree: int = 32, width: int = 64, alpha: float = 1.2, batch: int = 512,
                seed: int = 5) -> tuple[np.ndarray, int]:
    """(neighbours of each node padded by -1, entry node)."""
    n = len(x)
    entry = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    graph = np.full((n, degree), -1, np.int64)
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    lo = 1
    while lo < n:
        hi = min(n, lo + min(batch, max(1, lo)))                # never more new points than old ones
        points = order[lo:hi]
        found, _ = beam_search(x, graph, entry, x[points], width)
        graph[points] = robust_prune(x, points, found, degree, alpha)
        src = np.repeat(points, degree)
        dst = graph[points].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        by = np.argsort(dst, kind="stable")
        src, dst = src[by], dst[by]
        nodes, start, count = np.unique(dst, return_index=True, return_counts=True)
        most = int(count.max())
        extra = np.full((len(nodes), most), -1, np.int64)
        extra[np.repeat(np.arange(len(nodes)), count), np.arange(len(dst)) - np.repeat(start, count)] = src
        for a in range(0, len(nodes), batch):
            some = nodes[a:a + batch]
            wider = np.concatenate([graph[some], extra[a:a + batch]], 1)
            full = (wider >= 0).sum(1) > degree
            flat = np.sort(np.where(wider < 0, n, wider), axis=1)[:, :degree]
            graph[some] = np.where(flat == n, -1, flat)
            if full.any():
                graph[some[full]] = robust_prune(x, some[full], wider[full], degree, alpha)
        lo = hi
    return _connected(x, graph, entry, width), entry


def _connected(x: np.ndarray, graph: np.ndarray, entry: int, width: int) -> np.ndarray:
    """``graph`` with added columns of edges, so that every node is reached from the entry: a node that pruning has
    cut off gets an edge from the nearest node that a search finds."""
    while True:
        reached = np.zeros(len(x), bool)
        reached[entry], edge = True, np.array([entry])
        while len(edge):
            near = np.unique(graph[edge])
            edge = near[(near >= 0) & ~reached[near]]
            reached[edge] = True
        lost = np.flatnonzero(~reached)
        if not len(lost):
            return graph
        found = np.concatenate([beam_search(x, graph, entry, x[lost[a:a + 512]], width)[0][:, 0]
                                for a in range(0, len(lost), 512)])
        by, first = np.unique(found, return_index=True)        # one new edge per node and round
        column = np.full((len(x), 1), -1, graph.dtype)
        column[by, 0] = lost[first]
        graph = np.concatenate([graph, column], 1)


def _scaled(x: np.ndarray, axis: int | None = None) -> np.ndarray:
    """``x`` times a power of two, so that the largest component is about one; ranks by inner product stay."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=axis, keepdims=True))[1])


def _lifted(x: np.ndarray) -> np.ndarray:
    """Vectors whose distances to (query, 0) rank as inner products do."""
    x = _scaled(x)
    norm = np.einsum("ij,ij->i", x, x)
    return np.concatenate([x, np.sqrt(np.maximum(norm.max() - norm, 0))[:, None]], 1).astype(np.float32)


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    x = F.col(vector_col)
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))) & F.exists(x, lambda v: v != 0)
    return vectors.where(F.col(id_col).isNotNull() & x.isNotNull() & good).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.transform(x, lambda v: v.cast("double")).alias("v"))


def _band(v):
    """Number of the band of norms: 2^-2 to 2^2 is band 0. No square overflows."""
    most = F.array_max(F.transform(v, F.abs))
    square = F.aggregate(F.transform(v, lambda c: (c / most) * (c / most)), F.lit(0.0), lambda a, c: a + c)
    return F.floor((F.log2(most) + F.log2(square) / 2) / 4 + F.lit(0.5)).cast("int")


def build_index(vectors: DataFrame, k: int = 20, shard_size: int = 8192, degree: int = 32, width: int = 64,
                id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The index as a written table with one row per shard: ``shard``, ``dim``, ``band``, ``entry``, ``nodes``, ``vectors``,
    ``graph`` (binary), ``ids`` and ``edges`` (ids of node i: ids[edges[i] : edges[i + 1]])."""
    rows = _valid(vectors, id_col, vector_col)
    same = Window.partitionBy("v").orderBy("vec_id")            # pre-limited before the shuffle: no hot vector
    rows = written(rows.distinct().withColumn("_r", F.row_number().over(same)).where(F.col("_r") <= k + 1).drop("_r"),
                   "vectors")
    rows = rows.withColumn("dim", F.size("v")).withColumn("band", _band(F.col("v")))
    sizes = written(rows.groupBy("dim", "band").count().withColumn(
        "shards", F.ceil(F.col("count") / shard_size)), "sizes")
    total = sizes.agg(F.sum("shards")).first()[0] or 1
    dealt = rows.join(sizes.select("dim", "band", "shards"), ["dim", "band"]).withColumn(
        "shard", F.pmod(F.xxhash64("v"), F.col("shards")))
    dealt = dealt.repartition(2 * total, "dim", "band", "shard")        # few bytes, much work: tasks by number, not by size

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        x, at = np.unique(np.array(pdf["v"].tolist(), np.float64), axis=0, return_inverse=True)
        at = at.ravel()
        order = np.argsort(at, kind="stable")
        edges = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(x)))])
        graph, entry = build_graph(_lifted(x), degree, width) if len(x) > 1 else (np.full((1, degree), -1), 0)
        return pd.DataFrame({
            "shard": [int(pdf["shard"].iloc[0])], "dim": [x.shape[1]], "band": [int(pdf["band"].iloc[0])], "entry": [entry], "nodes": [len(x)],
            "vectors": [x.tobytes()], "graph": [graph.astype(np.int32).tobytes()],
            "ids": [pdf["vec_id"].to_numpy(np.int64)[order].tobytes()], "edges": [edges.astype(np.int64).tobytes()]})

    return written(on_workers(dealt).groupBy("dim", "band", "shard").applyInPandas(
        build, "shard bigint, dim int, band int, entry int, nodes int, vectors binary, graph binary, ids binary, "
        "edges binary"), "index")


def _answers(shard: dict, ids: np.ndarray, queries: np.ndarray, k: int, width: int):
    """(query, id, score) of each query's best k in a shard, exactly scored, own id left out."""
    x = np.frombuffer(shard["vectors"], np.float64).reshape(shard["nodes"], -1)
    graph = np.frombuffer(shard["graph"], np.int32).reshape(shard["nodes"], -1)
    names, edges = np.frombuffer(shard["ids"], np.int64), np.frombuffer(shard["edges"], np.int64)
    n = len(x)
    lifted = _lifted(x)
    out = []
    for lo in range(0, len(ids), 512):
        q = queries[lo:lo + 512]
        if n <= width:                                          # the beam would hold the whole shard
            found = np.tile(np.arange(n), (len(q), 1))
        else:
            found, _ = beam_search(lifted, graph, shard["entry"],
                                   np.concatenate([_scaled(q, 1), np.zeros((len(q), 1))], 1).astype(np.float32), width)
        score = np.where(found >= 0, np.einsum("bkd,bd->bk", x[np.maximum(found, 0)], q, optimize=False), -np.inf)
        for i in range(len(q)):
            nodes, value = found[i], score[i]
            best = np.argsort(-value, kind="stable")
            # every node that ties with the (k + 1)-th best may hold a smaller id
            cut = value[best[min(k, len(best) - 1)]]
            best = best[(value[best] >= cut) & np.isfinite(value[best])]
            count = edges[nodes[best] + 1] - edges[nodes[best]]
            own = np.concatenate([names[edges[j]:edges[j + 1]] for j in nodes[best]]) if len(best) else names[:0]
            value = np.repeat(value[best], count)
            other = own != ids[lo + i]
            own, value = own[other], value[other]
            top = np.lexsort((own, -value))[:k]
            out.append((np.full(len(top), ids[lo + i]), own[top], value[top]))
    return [np.concatenate(c) for c in zip(*out)]


def search(index: DataFrame, queries: DataFrame, k: int = 20, width: int = 128, block: int = 2048,
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score`` of each query's ``k`` best, nearest first, ties to the
    smaller id; the query's own id is no answer. Only shards of the query's dimension are searched.

    Rows with a null id or vector, a zero vector, or null or non-finite components take no part, neither here nor in
    the index. Equal rows count once; an id with several vectors is a candidate by each of them. Fewer than ``k``
    candidates are all returned; without queries or candidates the result is empty."""
    asked = written(_valid(queries, id_col, vector_col).distinct().withColumn("dim", F.size("v")), "queries")
    blocks = max(1, -(-asked.count() // block))

    def bundle(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"dim": [int(pdf["dim"].iloc[0])], "block": [int(pdf["block"].iloc[0])],
                             "q_ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                             "q": [np.array(pdf["v"].tolist(), np.float64).tobytes()]})

    bundled = written(on_workers(asked).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
                      .groupBy("dim", "block").applyInPandas(bundle, "dim int, block int, q_ids binary, q binary"), "blocks")
    met = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).join(bundled, ["dim", "block"])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                q = np.frombuffer(row["q"], np.float64).reshape(-1, row["dim"])
                got = _answers(row, np.frombuffer(row["q_ids"], np.int64), q, k, width)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in got], ["query_id", "vec_id", "score"])

    # one (shard, block) pair is a few MB and seconds of work: tasks by number of pairs
    met = met.repartition(max(1, index.count() * blocks), "shard", "block", "dim", "band")
    found = met.mapInArrow(run, "query_id bigint, vec_id bigint, score double").groupBy("query_id", "vec_id").agg(
        F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
