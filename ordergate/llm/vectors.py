"""Searches of vectors: exact top-k by Fagin's threshold algorithm, and approximate by pruned graphs.

Both deal candidates to shards of at most about ``SHARD`` rows and queries to blocks; every block meets every
shard once, and the k best of each meeting are merged. So no task holds more than one shard and one block, and
nothing is broadcast.

Edge cases, for both: rows with a null id, a null vector, or a null or non-finite component take no part, neither do
vectors of another length than the most common one (the longer on a tie). A query's own row is every row with its
id. Fewer candidates than k: all of them. Equal scores go to the smaller id. Repeated rows are candidates each. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordergate.llm.frames import Scratch, ship

SHARD, BLOCK = 4096, 4096
#: To this depth the threshold algorithm reads all lists first.
FIRST_DEPTH = 8
#: Of the graphs: edges of a node, beam, relaxation of the pruning, nodes expanded at a time, shard rows.
EDGES, BEAM, ALPHA, EXPAND, GRAPH_SHARD = 32, 96, 1.2, 4, 8192
#: Beam of the final search.
SEARCH_BEAM = 192


def usable(vectors: DataFrame, id_: str, vector: str) -> DataFrame:
    """Rows (id, v array<double>) that take part."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col(id_).isNotNull() & F.col(vector).isNotNull() & finite).select(
        F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    sizes = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("v") == (sizes[0]["d"] if sizes else -1))


def _sharded(rows: DataFrame, per_shard: int) -> tuple[DataFrame, int]:
    shards = max(1, -(-rows.count() // per_shard))
    return rows.withColumn("shard", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")), shards


def _everywhere(rows: DataFrame, column: str, n: int) -> DataFrame:
    return rows.withColumn(column, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _top(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of one query but itself, ties to the smaller id."""
    ok = ids != query
    ids, scores = ids[ok], scores[ok]
    if len(ids) > k:
        floor = np.partition(scores, len(scores) - k)[-k]
        ok = scores >= floor
        ids, scores = ids[ok], scores[ok]
    by = np.lexsort((-ids, scores))[::-1][:k]
    return ids[by], scores[by]


def threshold_search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    """The k best inner products of each query by the threshold algorithm; yields (query id, ids, scores, rows scored).

    Each dimension has its list of rows sorted by value, read from the end that favours the query's sign (lists of dimensions
    where the query is 0 aren't read), all to the same depth, which doubles. A row is scored in full when it is met first. The
    depth's bound (the sum of the products at that depth) is the most a row not met can reach: once the kth score exceeds
    it, the search ends. Lists are read to their ends where the bound never falls below it, or where products may wrap.
    """
    n, d = rows.shape
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(queries).max(initial=0)) * d
    bounded = most < 2**62
    kind = np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64  # sums are exact
    rows, queries = rows.astype(kind), queries.astype(kind)
    order = np.argsort(rows, axis=0, kind="stable")
    # how deep each row lies in each list, read from above and (d further on) from below
    deep = np.empty((2 * d, n), np.int16 if n < 2**15 else np.int64)
    np.put_along_axis(deep[d:], order.T, np.arange(n, dtype=deep.dtype)[None], axis=1)
    deep[:d] = n - 1 - deep[d:]
    depths = [min(FIRST_DEPTH, n)] if n else []
    while depths and depths[-1] < n:
        depths.append(min(2 * depths[-1], n))
    high = np.array([rows[order[n - x], np.arange(d)] for x in depths], kind).reshape(len(depths), d)
    low = np.array([rows[order[x - 1], np.arange(d)] for x in depths], kind).reshape(len(depths), d)
    for query, q in zip(query_ids, queries, strict=True):
        used, up = np.flatnonzero(q) if q.any() else np.arange(d), q > 0
        met_at = np.minimum.reduce(deep[np.where(up[used], used, used + d)], axis=0, initial=n)
        turn = np.argsort(met_at, kind="stable")
        cuts = np.searchsorted(met_at[turn], np.array(depths, deep.dtype))
        edges = np.where(up, high, low) @ q
        own, best, met = ids[:0], np.zeros(0, kind), 0
        for cut, edge in zip(cuts.tolist(), edges.tolist(), strict=True):
            new = turn[met:cut]
            met = cut
            scores = rows[new] @ q
            if len(own) == k:
                new, scores = (x[scores >= best[-1]] for x in (new, scores))
            if len(new):
                own, best = _top(query, np.concatenate([own, ids[new]]), np.concatenate([best, scores]), k)
            if bounded and len(own) == k and best[-1] > edge:
                break
        yield query, own, best, met


def _meetings(candidates: DataFrame, queries: DataFrame, shards: int) -> object:
    queries = queries.where("true")
    blocks = max(1, -(-queries.count() // BLOCK))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    return (_everywhere(candidates, "block", blocks).groupBy("shard", "block")
            .cogroup(_everywhere(queries, "shard", shards).groupBy("shard", "block")))


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score long): the k best integer inner products of ``floor(scale * x)`` of
    each row for which ``is_query`` (a column of ``id``) holds. Products beyond 64 bits wrap."""
    ship(vectors.sparkSession)
    rows = usable(vectors, id_, vector)
    whole = rows.select("id", F.transform("v", lambda x: F.floor(x * scale).cast("long")).alias("v"))
    candidates, shards = _sharded(whole, SHARD)

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        if len(left) and len(right):
            for q, own, best, _ in threshold_search(right["id"].to_numpy(), _matrix(right["v"]), left["id"].to_numpy(), _matrix(left["v"]), k):
                out[0].append(np.full(len(own), q))
                out[1].append(own)
                out[2].append(best.astype(np.int64))
        cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
        return pa.table({"query_id": cols[0], "vec_id": cols[1], "score": cols[2]})

    found = _meetings(candidates, whole.where(is_query), shards).applyInArrow(run, "query_id long, vec_id long, score long")
    return _best(found, k)


def beam_search(points: np.ndarray, edges: np.ndarray, entry: int, queries: np.ndarray, beam: int, skip: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nodes of largest inner product that greedy search meets, for all queries in step: ids (-1: none) and products."""
    b, n = len(queries), len(points)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True  # stands for no node
    seen[:, entry] = True
    ids = np.full((b, beam), n)
    sims = np.full((b, beam), -np.inf, np.float32)
    ids[:, 0], sims[:, 0] = entry, queries @ points[entry]
    opened = np.zeros((b, beam), bool)
    live = np.arange(b)
    ends = np.concatenate([edges, np.full((1, edges.shape[1]), n)])
    while len(live):
        open_sims = np.where(opened[live] | (ids[live] == n), -np.inf, sims[live])
        pick = np.argpartition(-open_sims, EXPAND, axis=1)[:, :EXPAND]
        value = np.take_along_axis(open_sims, pick, 1)
        more = (value > -np.inf).any(1)
        live, pick, value = live[more], pick[more], value[more]
        if not len(live):
            break
        good = value > -np.inf
        rows, cols = np.broadcast_to(live[:, None], pick.shape)[good], pick[good]
        opened[rows, cols] = True
        at = np.where(good, np.take_along_axis(ids[live], pick, 1), n)
        new = np.sort(ends[at].reshape(len(live), -1), axis=1)
        fresh = ~seen[live[:, None], new]
        fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
        new = np.where(fresh, new, n)
        seen[live[:, None], new] = True
        got = np.einsum("bkd,bd->bk", points[np.minimum(new, n - 1)], queries[live], optimize=False)
        got = np.where(new < n, got, -np.inf).astype(np.float32)
        all_ids, all_sims = np.concatenate([ids[live], new], 1), np.concatenate([sims[live], got], 1)
        all_open = np.concatenate([opened[live], np.zeros(new.shape, bool)], 1)
        keep = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
        ids[live], sims[live], opened[live] = (np.take_along_axis(x, keep, 1) for x in (all_ids, all_sims, all_open))
    return np.where(sims > -np.inf, ids, -1), sims


def robust_prune(points: np.ndarray, nodes: np.ndarray, near: np.ndarray, limit: int, alpha: float) -> np.ndarray:
    """Of each node's candidates ``near`` (-1: none) at most ``limit``, nearest first, leaving out those that a kept one is
    ``alpha`` times nearer to. Points have equal norms, so distances follow from products."""
    b, c = near.shape
    norm = float((points[0] ** 2).sum())
    there = points[np.maximum(near, 0)]
    own = 2 * norm - 2 * np.einsum("bcd,bd->bc", there, points[nodes])
    between = 2 * norm - 2 * np.matmul(there, there.transpose(0, 2, 1))
    gone = (near < 0) | (near == nodes[:, None])
    out = np.full((b, limit), -1)
    rows = np.arange(b)
    for j in range(limit):
        left = np.where(gone, np.inf, own)
        best = left.argmin(1)
        ok = left[rows, best] < np.inf
        if not ok.any():
            break
        out[:, j] = np.where(ok, near[rows, best], -1)
        gone |= ok[:, None] & ((alpha * alpha * between[rows, best] <= own) | (near == near[rows, best][:, None]))
        gone[rows, best] = True
    return out


def build_graph(points: np.ndarray, seed: int = 0) -> tuple[np.ndarray, int]:
    """A directed graph over ``points`` (equal norms, no two alike): edges (-1: none) and the entry node.

    Nodes join in random order and in growing batches: a greedy search over what is there proposes neighbours, pruning
    keeps diverse ones, and each kept neighbour gets the edge back, pruned anew if it has too many.
    """
    n = len(points)
    edges = np.full((n, EDGES), -1)
    rng = np.random.default_rng(seed)
    entry = int((points @ points.mean(0)).argmax())
    order = rng.permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    done = 1
    while done < n:
        batch = order[done : done + min(max(1, done), 512)]
        graph = np.where(edges < 0, n, edges)
        near, _ = beam_search(points, graph, entry, points[batch], BEAM)
        out = robust_prune(points, batch, near, EDGES, ALPHA)
        edges[batch] = out
        source, target = np.repeat(batch, EDGES), out.reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        # all incoming edges of a node beside its own, in groups of like width
        for low in range(0, len(nodes), 512):
            part = slice(low, low + 512)
            width = int(count[part].max())
            place = first[part][:, None] + np.arange(width)
            incoming = np.where(np.arange(width) < count[part][:, None], source[np.minimum(place, len(source) - 1)], -1)
            both = np.concatenate([edges[nodes[part]], incoming], 1)
            size = (both >= 0).sum(1)
            small = size <= EDGES
            packed = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)[:, :EDGES]
            new = packed
            if (~small).any():
                new[~small] = robust_prune(points, nodes[part][~small], both[~small], EDGES, ALPHA)
            edges[nodes[part]] = new
        done += len(batch)
    return edges, entry


def graph_index(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, int]:
    """One row (shard, ids, starts, points, edges, entry) per shard, and the number of shards. Equal vectors of a shard are one
    node; ``ids`` are sorted within nodes and ``starts`` says where each node's begin. Zero vectors take no part."""
    ship(vectors.sparkSession)
    rows, shards = _sharded(usable(vectors, id_, vector).where(F.exists("v", lambda x: x != 0)), GRAPH_SHARD)

    def run(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
        ids, x = t["id"].to_numpy(), _matrix(t["v"])
        nodes, of = np.unique(x, axis=0, return_inverse=True)
        by = np.lexsort((ids, of.reshape(-1)))
        starts = np.searchsorted(of.reshape(-1)[by], np.arange(len(nodes) + 1))
        # one more component makes norms equal, so that inner products and distances give one order
        norms = (nodes**2).sum(1)
        points = np.concatenate([nodes, np.sqrt(np.maximum(norms.max() - norms, 0))[:, None]], 1) / np.sqrt(norms.max())
        edges, entry = build_graph(points.astype(np.float32))
        pack = lambda a, kind: [np.ascontiguousarray(a, kind).tobytes()]
        return pa.table({"shard": pa.array([int(key[0].as_py())], pa.int32()), "ids": pack(ids[by], "<i8"), "starts": pack(starts, "<i4"), "points": pack(nodes, "<f8"),
                         "edges": pack(edges, "<i4"), "entry": pa.array([entry], pa.int32())})

    return rows.groupBy("shard").applyInArrow(run, "shard int, ids binary, starts binary, points binary, edges binary, entry int"), shards


def approximate_top_k(vectors: DataFrame, is_query: Column, k: int = 20, id_: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows (query_id, rank, vec_id, score double): the k largest inner products found for each row for which
    ``is_query`` (a column of ``id``) holds, by beam search in every shard's graph."""
    index, shards = graph_index(vectors, id_, vector)
    index = Scratch(vectors.sparkSession, "graph").keep(index)
    queries = usable(vectors, id_, vector).where(F.exists("v", lambda x: x != 0)).where(is_query)

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out = ([], [], [])
        if len(left) and len(right):
            row = left.to_pylist()[0]
            ids, starts, edges = (np.frombuffer(row[c], kind) for c, kind in (("ids", "<i8"), ("starts", "<i4"), ("edges", "<i4")))
            nodes = np.frombuffer(row["points"], "<f8").reshape(len(starts) - 1, -1)
            edges = edges.reshape(len(nodes), -1)
            edges = np.where(edges < 0, len(nodes), edges)
            q_ids, q = right["id"].to_numpy(), _matrix(right["v"])
            small = nodes.astype(np.float32)
            for low in range(0, len(q), 512):
                part = q[low : low + 512]
                scaled = (part / np.abs(part).max(1, keepdims=True)).astype(np.float32)
                near, _ = beam_search(small, edges, row["entry"], scaled, SEARCH_BEAM)
                for i, own in enumerate(near):
                    own = own[own >= 0]
                    score = np.einsum("cd,d->c", nodes[own], part[i], optimize=False)
                    # a node's first k + 1 ids are all it can give
                    size = np.minimum(starts[own + 1] - starts[own], k + 1)
                    at = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                    best, scores = _top(q_ids[low + i], ids[at], np.repeat(score, size), k)
                    out[0].append(np.full(len(best), q_ids[low + i]))
                    out[1].append(best)
                    out[2].append(scores)
        kinds = (np.int64, np.int64, np.float64)
        cols = [np.concatenate(c) if c else np.zeros(0, t) for c, t in zip(out, kinds, strict=True)]
        return pa.table({"query_id": cols[0], "vec_id": cols[1], "score": cols[2]})

    found = _meetings(index, queries, shards).applyInArrow(run, "query_id long, vec_id long, score double")
    return _best(found, k)
