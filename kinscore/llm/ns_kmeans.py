"""Centroid clustering of integer vectors with ns-bounds.

Lloyd's rounds, exact: every round assigns each vector to its nearest centroid (squared Euclidean
distance, ties to the smaller number) and replaces each centroid that has vectors by the floor of
their mean. What a round can skip is decided by bounds that are kept per vector and group of ``GROUP``
centroids:

* the exact squared distance to the assigned centroid, and the round in which it was evaluated;
* per group the least exact squared distance to a centroid other than the assigned one, and its round.

The history of the centroids is retained. A bound of round T is loosened, in round t, by the norm of the
centroid's *total* displacement |c(t) - c(T)| (for a group, the largest one), not by the sum of the
drifts of the rounds between: the norm of a sum is at most the sum of the norms. A group whose loosened
lower bound is not above the loosened upper bound (by more than rounding could be wrong) fails; first
the distance to the assigned centroid is evaluated anew, and where the bound still fails the group is
rescanned exactly. A vector that changes its centroid rescans the group it leaves.

Vectors are packed where they lie into blocks of ``BLOCK`` vectors (16-bit components where they fit,
else 32) with their bounds; a round is one narrow pass that rewrites the blocks in the checkpoint
folder and leaves, per task, at most one partial sum for each centroid. Only those sums are
shuffled; the driver sees k x d sums a round, whatever the size of the table. Integer
arithmetic is exact throughout: products go through floating point only where every sum stays
below 2^53.

Cases: vectors that are null, of another length, or hold a null or non-finite component take no part and
give no row; a null id is kept (as an initial centroid it reads as the empty string); rows with one id, and equal
vectors, are vectors of their own; initial centroids with one hash are ordered by their vectors; fewer vectors than
centroids give as many centroids as vectors; an empty table gives none; extra columns are
ignored; a component beyond 2^26 after scaling fails the job, since distances would not fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinscore.llm.common import named, require, saved

CENTROIDS = 40
ROUNDS = 5
SEED = 2
SCALE = 256
DIM = 64
#: vectors a block (0.8 MB at most with 64 components)
BLOCK = 4096
#: centroids that share a lower bound
GROUP = 10
LARGEST = 1 << 26
_NONE = np.iinfo(np.int64).max
_PACKED = "ids array<{}>, wide boolean, vectors binary, bounds binary, evaluated long, cluster int, n long, total array<long>"


def sq_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer vectors, row by row of x and c."""
    if not len(x) or not len(c):
        return np.zeros((len(x), len(c)), np.int64)
    most = max(int(np.abs(x).max()), int(np.abs(c).max()))
    if 4 * most * most * x.shape[1] < 1 << 53:
        x, c = x.astype(np.float64), c.astype(np.float64)
        return ((x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((x - own) ** 2).sum(1) for own in c.astype(np.int64)], axis=1)


class Bounds:
    """The bounds of one block's vectors, as they travel."""

    def __init__(self, n: int, groups: int, raw: bytes | None = None):
        kind = np.dtype([("a", "<u2"), ("u", "<i8"), ("ut", "u1"), ("l", "<i8", (groups,)), ("lt", "u1", (groups,))])
        self.rows = np.zeros(n, kind) if raw is None else np.frombuffer(raw, kind).copy()
        self.fresh = raw is None

    def assign(self, x: np.ndarray, history: np.ndarray, group: int = GROUP) -> int:
        """Bring the assignment to the last centroids of ``history`` (rounds x k x d); the number of
        exact distances evaluated."""
        now, centroids, k = len(history) - 1, history[-1], history.shape[1]
        member = np.arange(k) // group
        b = self.rows
        groups = b["l"].shape[1]
        if self.fresh:
            d = sq_distances(x, centroids)
            self._settle(np.arange(len(x)), d, np.ones((len(x), groups), bool), member, now)
            self.fresh = False
            return d.size
        # displacement since each earlier round, from exact squares
        moved = np.sqrt(((history - centroids).astype(np.float64) ** 2).sum(2))
        most = np.stack([moved[:, member == g].max(1) for g in range(groups)], axis=1)
        lower, slack = np.sqrt(b["l"].astype(np.float64)), np.arange(groups)
        loosened = lower - most[b["lt"], slack]
        alone = b["l"] == _NONE

        def fails(rows):
            upper = np.sqrt(b["u"][rows].astype(np.float64)) + moved[b["ut"][rows], b["a"][rows]]
            margin = 1e-9 * (lower[rows] + upper[:, None] + most[b["lt"][rows], slack]) + 1e-9
            return (loosened[rows] - upper[:, None] <= margin) & ~alone[rows]

        rows = np.flatnonzero(fails(np.arange(len(x))).any(1))
        b["u"][rows] = ((x[rows] - centroids[b["a"][rows]]) ** 2).sum(1)
        b["ut"][rows] = now
        evaluated = len(rows)
        failed = fails(rows)
        on = failed.any(1)
        rows, failed = rows[on], failed[on]
        if not len(rows):
            return evaluated
        d = np.full((len(rows), k), _NONE, np.int64)
        place = np.arange(len(rows))
        d[place, b["a"][rows]] = b["u"][rows]

        def rescan(which, g):
            own = np.flatnonzero(member == g)
            d[np.ix_(which, own)] = sq_distances(x[rows[which]], centroids[own])
            return len(which) * len(own)

        for g in range(groups):
            if failed[:, g].any():
                evaluated += rescan(np.flatnonzero(failed[:, g]), g)
        best = d.argmin(1)
        # the centroid left behind counts for its group from now on, the one taken no longer for its own
        left = member[b["a"][rows]]
        anew = (best != b["a"][rows]) & ~failed[place, left]
        for g in np.unique(left[anew]):
            evaluated += rescan(np.flatnonzero(anew & (left == g)), g)
        failed[place[anew], left[anew]] = True
        self._settle(rows, d, failed, member, now)
        return evaluated

    def _settle(self, rows, d, exact, member, now) -> None:
        b, place = self.rows, np.arange(len(rows))
        best = d.argmin(1)
        b["a"][rows], b["u"][rows], b["ut"][rows] = best, d[place, best], now
        d[place, best] = _NONE
        for g in range(exact.shape[1]):
            own = exact[:, g]
            b["l"][rows[own], g] = d[own][:, member == g].min(1)
            b["lt"][rows[own], g] = now


def sums_by(cluster: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(cluster, kind="stable")
    n = np.bincount(cluster, minlength=k)
    total = np.zeros((k, x.shape[1]), np.int64)
    full = np.flatnonzero(n)
    total[full] = np.add.reduceat(x[order], np.r_[0, np.cumsum(n)[:-1]][full], axis=0)
    return n, total


def packed(vectors: DataFrame, vec_id: str, embedding: str, dim: int, scale: int, block: int) -> tuple[DataFrame, str]:
    """Blocks of the vectors that take part, as integers."""
    kind = vectors.schema[vec_id].dataType.simpleString()
    schema = _PACKED.format(kind)
    plain = vectors.select(named(vec_id).alias("id"), named(embedding).cast("array<double>").alias("x"))

    def run(batches):
        import pyarrow.compute as pc

        ids, rows, held = [], [], 0

        def flush():
            x = np.concatenate(rows)
            if np.abs(x).max() > LARGEST:
                raise ValueError(f"a component is beyond {LARGEST} after scaling: distances would not fit a long")
            wide = bool(np.abs(x).max() >= 1 << 15)
            own = pa.concat_arrays(ids)
            raw = x.astype(np.int32 if wide else np.int16).tobytes()
            lists = pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own)
            rest = [pa.array([None], t) for t in (pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(
                [lists, pa.array([wide]), pa.array([raw], pa.binary()), *rest],
                ["ids", "wide", "vectors", "bounds", "evaluated", "cluster", "n", "total"],
            )

        for batch in batches:
            full = batch.filter(pc.fill_null(pc.equal(pc.list_value_length(batch.column("x")), dim), False))
            values = full.column("x").flatten()
            x = pc.fill_null(values, float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dim)
            fit = np.isfinite(x).all(1)
            x, own = x[fit], full.column("id").filter(pa.array(fit))
            for at in range(0, len(x), block):  # a batch may hold more than a block
                part, name = x[at : at + block], own.slice(at, block)
                if held and held + len(part) > block:
                    yield flush()
                    ids, rows, held = [], [], 0
                rows.append(np.clip(np.floor(scale * part), -4.0 * LARGEST, 4.0 * LARGEST).astype(np.int64))
                ids.append(name)
                held += len(part)
        if held:
            yield flush()

    return saved(plain.mapInArrow(run, schema)), schema


def unpacked(row) -> np.ndarray:
    raw, wide, n = row["vectors"], row["wide"], len(row["ids"])
    return np.frombuffer(raw, np.int32 if wide else np.int16).reshape(n, -1).astype(np.int64)


def _rows(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            if batch.column("ids")[i].is_valid:
                yield {
                    "ids": batch.column("ids")[i].values,
                    **{c: batch.column(c)[i].as_py() for c in ("wide", "vectors", "bounds")},
                }


def first_centroids(vectors: DataFrame, vec_id: str, embedding: str, k: int, dim: int, scale: int, seed: int) -> np.ndarray:
    x = named(embedding).cast("array<double>")
    fit = (F.size(x) == dim) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(named(vec_id).cast("string"), F.lit("")))
    rows = vectors.where(fit).select(F.sha2(name, 256).alias("h"), x.alias("x")).orderBy("h", "x").limit(k).collect()
    return np.array([np.floor(scale * np.array(r.x)) for r in rows]).astype(np.int64).reshape(len(rows), dim)


def ns_kmeans(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    scale: int = SCALE,
    dim: int = DIM,
    block: int = BLOCK,
    group: int = GROUP,
    report: list | None = None,
) -> DataFrame:
    """One row per vector that takes part: its id, cluster, distance (squared), the inertia of its cluster and
    of all, and ``centroid`` (the components of its final centroid). ``report`` collects, per
    round, the number of exact distances evaluated."""
    require(vectors, vec_id, embedding)
    if rounds > 254 or k > 65_535:
        raise ValueError("at most 254 rounds and 65,535 centroids")
    history = [first_centroids(vectors, vec_id, embedding, k, dim, scale, seed)]
    k = len(history[0])
    groups = max(1, -(-k // group))
    blocks, schema = packed(vectors, vec_id, embedding, dim, scale, block)

    def assign(known: np.ndarray, last: bool):
        def run(batches):
            n_all, total_all, evaluated = np.zeros(k, np.int64), np.zeros((k, 1 if last else dim), np.int64), 0
            kinds = None
            for row in _rows(batches):
                x = unpacked(row)
                bounds = Bounds(len(x), groups, row["bounds"])
                done = bounds.assign(x, known, group)
                a = bounds.rows["a"].astype(np.int64)
                if last:
                    bounds.rows["u"] = ((x - known[-1][a]) ** 2).sum(1)
                n, total = sums_by(a, bounds.rows["u"][:, None].astype(np.int64) if last else x, k)
                n_all += n
                total_all += total
                evaluated += done
                kinds = row["ids"].type
                ids = pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), row["ids"])
                one = [[row["wide"]], [row["vectors"]], [bounds.rows.tobytes()], [done], [None], [None], [None]]
                yield _batch(ids, one)
            for c in np.flatnonzero(n_all).tolist():
                yield _batch(
                    pa.array([None], pa.list_(kinds)), [[None], [None], [None], [None], [c], [int(n_all[c])], [total_all[c].tolist()]]
                )

        return run

    for turn in range(rounds + 1):
        last = turn == rounds
        blocks = saved(blocks.mapInArrow(assign(np.stack(history), last), schema))
        parts = blocks.where("cluster is not null")
        width = 1 if last else dim
        sums = parts.groupBy("cluster").agg(
            F.sum("n").alias("n"), F.array(*(F.sum(F.col("total")[i]) for i in range(width))).alias("total")
        )
        found = sums.collect()  # k rows
        if report is not None:
            report.append(blocks.agg(F.sum("evaluated")).first()[0] or 0)
        if not last:
            new = history[-1].copy()
            for r in found:
                new[r.cluster] = [t // r.n for t in r.total]
            history.append(new)
    inertia = {r.cluster: r.total[0] for r in found}
    final = history[-1]
    names = [",".join(map(str, c)) for c in final.tolist()]
    out = T.StructType(
        [vectors.schema[vec_id]]
        + [T.StructField(n, t) for n, t in (("cluster", T.IntegerType()), ("distance", T.LongType()), ("cluster_inertia", T.LongType()), ("inertia", T.LongType()), ("centroid", T.StringType()))]
    )
    whole = sum(inertia.values())

    def spread(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        fields = to_arrow_schema(out)
        own = np.array([inertia.get(c, 0) for c in range(k)], np.int64)
        for row in _rows(batches):
            bounds = Bounds(len(row["ids"]), groups, row["bounds"]).rows
            a = bounds["a"].astype(np.int32)
            cols = [row["ids"], pa.array(a), pa.array(bounds["u"].astype(np.int64)), pa.array(own[a])]
            cols += [pa.array(np.full(len(a), whole, np.int64)), pa.array(names).take(pa.array(a))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, fields, strict=True)], schema=fields)

    return blocks.mapInArrow(spread, out)


def _batch(ids: pa.Array, values: list[list]) -> pa.RecordBatch:
    kinds = (pa.bool_(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()))
    names = ["ids", "wide", "vectors", "bounds", "evaluated", "cluster", "n", "total"]
    return pa.RecordBatch.from_arrays([ids, *(pa.array(v, t) for v, t in zip(values, kinds, strict=True))], names)
