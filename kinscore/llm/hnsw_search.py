"""Approximate nearest neighbours by inner product: one navigable small-world graph per shard.

1. Vectors that are null, zero or hold null or non-finite components are left out. Equal vectors are
   merged to one node that carries the ``k + 1`` smallest ids of its class, which is all
   that a result of k can name, so a class of a third of all rows costs one node.
2. Nodes are dealt to shards of about ``SHARD_ROWS`` by a hash. Each shard's graph is built by one
   task and stored as flat arrays: per layer the node numbers and a (nodes x links)
   array of neighbours, -1 where there is none.
   A shard measures its recall against an exact search of a sample of ``SAMPLE`` queries and doubles its beam from
   ``EF_SEARCH`` until it finds ``TARGET_RECALL`` of their nearest: inner products of vectors of
   very different lengths need wider beams than those of unit vectors.
3. Blocks of at most ``QUERY_BLOCK`` queries meet every shard by an equi-join on the shard's number;
   a block descends the layers and runs its beam search for all of its queries at once,
   in numpy. The candidates' scores are computed again in double precision on the original vectors.
4. The shards' results are merged: k rows of each (query, shard), then k of each query.

Inner product is made a metric by one more dimension that brings all nodes of a shard to the same
length; a query has 0 there, so the order by angle is the order by inner product.

The graph: levels are drawn from a hash of the node; nodes enter in batches that at most double the
graph, find their neighbours by the same beam search (and among their batch), keep a
diverse choice of them, and the chosen ones link back and keep a diverse choice too.
All nodes of a shard are indexed. Recall against brute force is measured in the tests (at least 0.9).

Cases: rows without an id are not named by any result; a repeated id counts once for each of its
different vectors; vectors are compared with those of as many components only; queries with fewer candidates than k get them all; shards with
few nodes are searched whole; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinscore.llm.common import require, saved

K = 20
SHARD_ROWS = 8192
QUERY_BLOCK = 1024
#: links per node on upper layers, and on the lowest
LINKS, BASE_LINKS = 16, 32
#: beam width while building, and while searching
EF_BUILD, EF_SEARCH = 64, 96
#: queries on which every shard measures its recall (at most), and the recall that its beam has to reach there
SAMPLE, TARGET_RECALL = 64, 0.95
#: nodes that searches of a layer start from while it is built
ENTRIES = 8
SEED = 10


def beam_search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, start: np.ndarray, ef: int):
    """(scores, nodes), best first, (queries x ef) with -1 for none: best-first search over ``graph``
    (nodes x links, -1 for none) for all queries at once. ``start``: (queries x starts)."""
    n_queries, n = len(queries), len(x)
    seen = np.zeros((n_queries, n + 1), bool)
    seen[:, n] = True  # the place of "none"
    rows = np.arange(n_queries)[:, None]
    nodes = np.where(start < 0, n, start)
    # a node is a start once
    order = np.sort(nodes, axis=1)
    order[:, 1:][order[:, 1:] == order[:, :-1]] = n
    nodes = order
    score = np.where(nodes < n, np.einsum("qd,qsd->qs", queries, x[np.minimum(nodes, n - 1)]), -np.inf)
    seen[rows, nodes] = True
    pad = max(0, ef - nodes.shape[1])
    nodes = np.pad(nodes, ((0, 0), (0, pad)), constant_values=n)
    score = np.pad(score, ((0, 0), (0, pad)), constant_values=-np.inf)
    best = np.argsort(-score, axis=1, kind="stable")[:, :ef]
    nodes, score = np.take_along_axis(nodes, best, 1), np.take_along_axis(score, best, 1)
    done = nodes == n
    live = np.arange(n_queries)
    while len(live):
        open_ = ~done[live]
        has = open_.any(axis=1)
        live = live[has]
        if not len(live):
            break
        first = open_[has].argmax(axis=1)  # kept in order: the first open one is the best
        at = nodes[live, first]
        done[live, first] = True
        near = graph[at]
        near = np.where(near < 0, n, near)
        fresh = ~seen[live[:, None], near]
        near = np.where(fresh, near, n)
        seen[live[:, None], near] = True
        s = np.einsum("qd,qsd->qs", queries[live], x[np.minimum(near, n - 1)])
        s = np.where(near < n, s, -np.inf)
        all_nodes = np.concatenate([nodes[live], near], axis=1)
        all_score = np.concatenate([score[live], s], axis=1)
        all_done = np.concatenate([done[live], near == n], axis=1)
        best = np.argsort(-all_score, axis=1, kind="stable")[:, :ef]
        nodes[live] = np.take_along_axis(all_nodes, best, 1)
        score[live] = np.take_along_axis(all_score, best, 1)
        done[live] = np.take_along_axis(all_done, best, 1)
    return score, np.where(nodes == n, -1, nodes)


def diverse(x: np.ndarray, own: np.ndarray, nodes: np.ndarray, score: np.ndarray, links: int) -> np.ndarray:
    """Per row at most ``links`` of its candidates (best first, -1 for none): a candidate is kept if it
    is closer to the row's node than to every candidate kept before it; free places go to the best of
    the rest. All vectors have one length, so inner products order distances."""
    n, width = nodes.shape
    kept = np.zeros((n, width), bool)
    blocked = (nodes < 0) | (nodes == own[:, None])
    vectors = x[np.maximum(nodes, 0)]
    for _ in range(min(links, width)):
        free = ~kept & ~blocked
        has = free.any(axis=1)
        if not has.any():
            break
        pick = free.argmax(axis=1)
        r = np.flatnonzero(has)
        kept[r, pick[r]] = True
        to_pick = np.einsum("rwd,rd->rw", vectors[r], vectors[r, pick[r]])
        blocked[r] |= (to_pick > score[r]) & ~kept[r]
    rest = ~kept & (nodes >= 0) & (nodes != own[:, None])
    rank = np.where(kept, 0, np.where(rest, 1, 2)) * width + np.arange(width)
    best = np.argsort(rank, axis=1)[:, :links]
    out = np.take_along_axis(np.where(kept | rest, nodes, -1), best, 1)
    return np.pad(out, ((0, 0), (0, links - out.shape[1])), constant_values=-1)


def _link_back(x: np.ndarray, graph: np.ndarray, new: np.ndarray) -> None:
    """Let the neighbours of ``new`` nodes link back, keeping a diverse choice of ``links``."""
    links = graph.shape[1]
    src = np.repeat(new, links)
    dst = graph[new].ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    if not len(dst):
        return
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    edge = np.flatnonzero(np.r_[True, dst[1:] != dst[:-1]])
    size = np.diff(np.r_[edge, len(dst)])
    nodes = dst[edge]
    wide = np.full((len(nodes), int(size.max())), -1, graph.dtype)
    wide[np.repeat(np.arange(len(nodes)), size), np.arange(len(dst)) - np.repeat(edge, size)] = src
    for i in range(0, len(nodes), 512):
        own = nodes[i : i + 512]
        cand = np.concatenate([graph[own], wide[i : i + 512]], axis=1)
        cand = np.sort(cand, axis=1)
        cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
        s = np.einsum("rwd,rd->rw", x[np.maximum(cand, 0)], x[own])
        s = np.where(cand < 0, -np.inf, s)
        best = np.argsort(-s, axis=1, kind="stable")
        cand, s = np.take_along_axis(cand, best, 1), np.take_along_axis(s, best, 1)
        used = int((cand >= 0).sum(axis=1).max())
        graph[own] = diverse(x, own, cand[:, :used], s[:, :used], links)


def _insert(x: np.ndarray, graph: np.ndarray, members: np.ndarray, batch_rows: int = 256) -> None:
    """Build one layer over ``members`` (numbers of nodes in the order of entry) into ``graph``."""
    links = graph.shape[1]
    at = 1
    while at < len(members):
        new = members[at : at + min(batch_rows, at)]
        q = x[new]
        entry = members[: min(ENTRIES, at)]
        score, nodes = beam_search(x, graph, q, np.broadcast_to(entry, (len(new), len(entry))), EF_BUILD)
        among = q @ q.T
        np.fill_diagonal(among, -np.inf)
        cand = np.concatenate([nodes, np.broadcast_to(new, (len(new), len(new)))], axis=1)
        s = np.concatenate([np.where(nodes < 0, -np.inf, score), among], axis=1)
        best = np.argsort(-s, axis=1, kind="stable")[:, :EF_BUILD]
        cand, s = np.take_along_axis(cand, best, 1), np.take_along_axis(s, best, 1)
        cand = np.where(np.isfinite(s), cand, -1)
        graph[new] = diverse(x, new, cand, s, links)
        _link_back(x, graph, new)
        at += len(new)


def same_length(vectors: np.ndarray) -> np.ndarray:
    """One more dimension that brings every vector to the length of the longest."""
    square = np.einsum("nd,nd->n", vectors, vectors)
    more = np.sqrt(np.maximum(square.max(initial=0.0) - square, 0.0))
    return np.concatenate([vectors, more[:, None]], axis=1).astype(np.float32)


def build_graph(vectors: np.ndarray, seed: int = SEED) -> list[tuple[np.ndarray, np.ndarray]]:
    """Layers from the top down: (members, graph over all nodes restricted to them)."""
    n = len(vectors)
    x = same_length(vectors)
    rng = np.random.default_rng(seed)
    order = rng.permutation(n).astype(np.int32)
    level = np.floor(-np.log(rng.random(n)) / np.log(LINKS)).astype(int)
    layers = []
    for h in range(int(level.max(initial=0)), -1, -1):
        members = order[level[order] >= h]
        graph = np.full((n, BASE_LINKS if h == 0 else LINKS), -1, np.int32)
        # nodes of the layer above are hubs of this one: they enter first
        above = level[members] > h
        members = np.concatenate([members[above], members[~above]])
        _insert(x, graph, members)
        layers.append((members, graph))
    return layers


def search_graph(vectors: np.ndarray, layers: list, queries: np.ndarray, k: int, ef: int = EF_SEARCH):
    """(scores, nodes) of the k best nodes found for each query, -1 for none."""
    n = len(vectors)
    ef = max(ef, 2 * k)
    if n <= 2 * ef:
        s = queries @ vectors.T
        best = np.argsort(-s, axis=1, kind="stable")[:, :k]
        return np.take_along_axis(s, best, 1), best
    x = same_length(vectors)
    q = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
    start = np.broadcast_to(layers[0][0][:1], (len(q), 1))
    for i, (_, graph) in enumerate(layers):
        last = i == len(layers) - 1
        _, nodes = beam_search(x, graph, q, start, ef if last else ENTRIES)
        start = nodes
    exact = np.einsum("qd,qsd->qs", queries, vectors[np.maximum(nodes, 0)])
    exact = np.where(nodes < 0, -np.inf, exact)
    best = np.argsort(-exact, axis=1, kind="stable")[:, :k]
    return np.take_along_axis(exact, best, 1), np.take_along_axis(nodes, best, 1)


def fitted_beam(vectors: np.ndarray, layers: list, sample: np.ndarray, k: int, ef: int, target: float):
    """(beam, recall): the narrowest beam, doubled from ``ef``, that finds ``target`` of the true k nearest of the
    sample of queries; a graph where none does is searched whole."""
    if not len(sample) or len(vectors) <= 2 * max(ef, 2 * k):
        return ef, 1.0
    exact = sample @ vectors.T
    least = -np.partition(-exact, min(k, len(vectors)) - 1, axis=1)[:, min(k, len(vectors)) - 1]
    while len(vectors) > 2 * max(ef, 2 * k):
        score, _ = search_graph(vectors, layers, sample, k, ef)
        recall = float((score >= least[:, None]).mean())
        if recall >= target:
            return ef, recall
        ef *= 2
    return ef, 1.0


def _usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    v = F.col(vector).cast("array<double>")
    own = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return own.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda c: c != 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    shard_rows: int = SHARD_ROWS,
    ef: int = EF_SEARCH,
    target: float = TARGET_RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score, measured_recall): the ``k`` nearest found among ``vectors`` for each row of
    ``queries`` (same columns), the row of the same id left out. ``measured_recall`` is the least recall that a
    shard measured on the sample of queries."""
    require(vectors, vec_id, vector)
    known = _usable(vectors, vec_id, vector)
    # classes of equal vectors with their smallest ids: a ranking that keeps k + 1 rows a class, so that
    # Spark cuts large classes before they are shuffled
    by_vector = Window.partitionBy("v").orderBy("vec_id")
    few = known.withColumn("r", F.dense_rank().over(by_vector)).where(F.col("r") <= k + 1)
    classes = few.groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    classes = saved(classes)
    # vectors are compared with those of their own length; a length has shards of its own
    size = F.size("v").alias("dim")
    sizes = classes.groupBy(size).agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).cast("int").alias("shards"))
    shard = F.pmod(F.xxhash64("v"), F.col("shards")).cast("int")
    asked = saved(_usable(queries, vec_id, vector).distinct())
    few = asked.orderBy(F.xxhash64("vec_id", "v"), "vec_id").limit(SAMPLE).select("v").collect()
    sample: dict[int, list] = {}
    for r in few:
        sample.setdefault(len(r.v), []).append(r.v)

    def build(key, t):
        t = t.sort_by("h")
        v = _matrix(t.column("v").combine_chunks())
        layers = build_graph(v)
        own = np.array(sample.get(v.shape[1], []), np.float64).reshape(-1, v.shape[1])
        beam, recall = fitted_beam(v, layers, own, k + 1, ef, target)
        return pa.table({
            "dim": pa.array([v.shape[1]], pa.int32()),
            "shard": pa.array([key[1].as_py()], pa.int32()),
            "ef": pa.array([beam], pa.int32()),
            "recall": pa.array([recall], pa.float64()),
            "v": pa.array([v.tobytes()], pa.binary()),
            "ids": pa.array([t.column("ids").to_pylist()], pa.list_(pa.list_(pa.int64()))),
            "members": pa.array([[m.astype(np.int32).tobytes() for m, _ in layers]], pa.list_(pa.binary())),
            "links": pa.array([[g[m].tobytes() for m, g in layers]], pa.list_(pa.binary())),
        })

    kind = "dim int, shard int, ef int, recall double, v binary, ids array<array<long>>, members array<binary>, links array<binary>"
    dealt = classes.withColumn("dim", size).join(sizes, "dim")
    n_shards = sizes.agg(F.coalesce(F.sum("shards"), F.lit(0))).first()[0]
    graphs = saved(
        dealt.select("dim", shard.alias("shard"), F.xxhash64("v").alias("h"), "v", "ids")
        .repartition(max(1, 2 * n_shards), "dim", "shard")  # few bytes but much work: not to be coalesced
        .groupBy("dim", "shard")
        .applyInArrow(build, kind)
    )
    worst = graphs.agg(F.min("recall")).first()[0]
    n_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).cast("int").alias("block")
    shards = F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard")
    placed = asked.withColumn("dim", size).join(sizes, "dim").select("dim", block, shards, "vec_id", "v")
    blocks = placed.groupBy("dim", "shard", "block").agg(
        F.collect_list("vec_id").alias("q_ids"), F.collect_list("v").alias("q")
    )
    # every (shard, block) pair is one row: a graph and at most about QUERY_BLOCK queries
    pairs = blocks.join(graphs, ["dim", "shard"]).repartition("dim", "shard", "block")

    def search(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                dim, beam = batch.column("dim")[row].as_py(), batch.column("ef")[row].as_py()
                v = np.frombuffer(batch.column("v")[row].as_py(), np.float64).reshape(-1, dim)
                ids = batch.column("ids")[row].as_py()
                layers = []
                for m, g in zip(batch.column("members")[row].as_py(), batch.column("links")[row].as_py(), strict=True):
                    members = np.frombuffer(m, np.int32)
                    own = np.frombuffer(g, np.int32).reshape(len(members), -1)
                    graph = np.full((len(v), own.shape[1]), -1, np.int32)
                    graph[members] = own
                    layers.append((members, graph))
                q_ids = batch.column("q_ids")[row].as_py()
                q = _matrix(batch.column("q")[row].values)
                # one more class than asked for: the query's own may hold no other id
                score, nodes = search_graph(v, layers, q, k + 1, beam)
                out = []
                for i, q_id in enumerate(q_ids):
                    for s, node in zip(score[i].tolist(), nodes[i].tolist(), strict=True):
                        if node >= 0 and s > -np.inf:
                            out += [(q_id, x, s) for x in ids[node] if x != q_id]
                cols = zip(*out, strict=True) if out else ((),) * 3
                kinds = [pa.int64(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["query_id", "vec_id", "score"]
                )

    found = pairs.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", F.lit(worst).cast("double").alias("measured_recall")
    )
