"""Nearest-positive score, ``1 - min L1 distance`` from each candidate to any positive.

Exact nearest-neighbour search has to look at every (candidate, positive) pair. The pairs of
vectors exist only inside numpy tiles; no vector reaches the driver:

1. positives with a null or NaN component are left out (they have no distance); the distinct
   others are counted, dealt over partitions of about ``wave_blocks`` blocks, packed into blocks
   of at most ``block_cells`` numbers and kept in the shared checkpoint folder. Blocks are cut
   by counting rows in the packing task, so copies or a common hash cannot make one larger;
2. candidates are packed the same way where they lie, into chunks of a quarter of a block, kept
   in the checkpoint folder too and then dealt out, a task a chunk (at most ``MOST_TASKS``): how
   many tasks share the pairs follows from the number of candidates, not from how their table is cut;
3. the product of chunks and blocks (two packed rows a pair) runs in Spark: a task holds one
   partition of blocks and folds it against its chunks. Tiles of ``TILE_CELLS`` distances in single
   precision (they stay in a core's cache) with a bound of their error leave the pairs that can be
   nearest, a few a candidate; ``min over p of Σ_d |c_d - p_d|`` is taken of those, in double
   precision, summed in the order of the dimensions;
4. one ``min`` per candidate row over its (row, distance) results.

The plan is the same for any number of positives; what grows is the number of partitions of
blocks. A candidate with a null or NaN component, or no positive to compare with, has a NULL
distance; vectors of another length than the positives' fail the run. Candidate rows with the
same key stay rows of their own.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# numbers (vectors × dims) of one block or chunk: 4096 × 64 doubles = 2 MB
BLOCK_CELLS = 4096 * 64
# blocks that a task holds: 64 MB
WAVE_BLOCKS = 32
# distances formed at once: 512 KB in single precision
TILE_CELLS = 1 << 17
# numbers of the pairs whose distances are taken exactly at once: 8 MB
EXACT_CELLS = 1 << 20
# of a tile's pairs, one in so many may be taken one by one; with more, the whole tile is formed in double precision
MANY = 32
# vectors with a larger component are compared in double precision only
LARGEST_SINGLE = 1e30
MOST_TASKS = 1024


def vector_of(cols: list[str]) -> Column:
    return F.array(*[F.col(f"`{c}`").cast("double") for c in cols])


def _comparable(vec: str) -> Column:
    return F.col(vec).isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x))


def fold_block(candidates: np.ndarray, block: np.ndarray, best: np.ndarray) -> None:
    """Lower ``best`` to each candidate's smallest L1 distance to the block's rows."""
    largest = np.abs(candidates).max(axis=1)
    if not np.abs(block).max() <= LARGEST_SINGLE:
        _fold_plainly(candidates, block, best)
        return
    single = largest <= LARGEST_SINGLE
    best[np.isnan(largest)] = np.nan
    plain = np.flatnonzero(largest > LARGEST_SINGLE)
    if len(plain):
        lowered = best[plain]
        _fold_plainly(candidates[plain], block, lowered)
        best[plain] = lowered
    own = np.flatnonzero(single)
    dims, width = block.shape[1], len(block)
    # a distance in single precision is off by less: roundings of the components, differences and sums, twice over
    sums = np.abs(candidates[own]).sum(axis=1) + np.abs(block).sum(axis=1).max()
    off = (dims + 8) * 2.0**-23 * sums + dims * 2.0**-140
    cand, pos = candidates[own].T.astype(np.float32), np.ascontiguousarray(block.T, dtype=np.float32)
    rows = max(1, TILE_CELLS // width)
    dist = np.empty((min(rows, len(own)), width), np.float32)
    step = np.empty_like(dist)
    for i in range(0, len(own), rows):
        tile, at = cand[:, i : i + rows, None], own[i : i + rows]
        total, one = dist[: len(at)], step[: len(at)]
        total.fill(0)
        for d in range(dims):
            np.subtract(tile[d], pos[d], out=one)
            np.add(total, np.abs(one, out=one), out=total)
        slack = off[i : i + rows]
        limit = np.minimum(total.min(axis=1) + 2 * slack, best[at] + slack)
        # the limit in single precision is rounded up, never below
        limit = np.nextafter(limit.astype(np.float32), np.float32(np.inf))
        can_be = total <= limit[:, None]
        if np.count_nonzero(can_be) > can_be.size // MANY:  # ties, or components far larger than their differences
            lowered = best[at]
            _fold_plainly(candidates[at], block, lowered)
            best[at] = lowered
            continue
        near, other = np.nonzero(can_be)
        pairs = max(1, EXACT_CELLS // dims)
        for j in range(0, len(near), pairs):
            who, whom = at[near[j : j + pairs]], other[j : j + pairs]
            # accumulate adds from left to right, as sum does not
            exact = np.add.accumulate(np.abs(candidates[who] - block[whom]), axis=1)[:, -1]
            np.minimum.at(best, who, exact)


def _fold_plainly(candidates: np.ndarray, block: np.ndarray, best: np.ndarray) -> None:
    """``fold_block`` without single precision."""
    rows = max(1, TILE_CELLS // max(1, len(block)))
    for i in range(0, len(candidates), rows):
        tile = candidates[i : i + rows]
        dist = np.zeros((len(tile), len(block)))
        step = np.empty_like(dist)
        for d in range(block.shape[1]):
            np.subtract(tile[:, d, None], block[None, :, d], out=step)
            dist += np.abs(step, out=step)
        np.minimum(best[i : i + rows], dist.min(axis=1), out=best[i : i + rows])


def _matrix(column, dims: int) -> np.ndarray:
    """The rows of an Arrow list column; null becomes a row of NaN."""
    import pyarrow as pa

    out = np.full((len(column), dims), np.nan)
    there = column.is_valid().to_numpy(zero_copy_only=False)
    lists = column.filter(pa.array(there))
    if any(n != dims for n in lists.value_lengths().unique().to_pylist()):
        raise ValueError(f"nearest_positive: a vector has not {dims} components like the positives")
    out[there] = lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    return out


def _saved(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def positive_blocks(usable: DataFrame, vec: str, block_rows: int, dims: int, parts: int) -> DataFrame:
    """(block): packed doubles of at most ``block_rows`` vectors a row, on ``parts`` partitions."""

    def pack(batches):
        import pyarrow as pa

        held, n = [], 0
        for batch in batches:
            rows = _matrix(batch.column(0), dims)
            while len(rows):
                held.append(rows[: block_rows - n])
                n += len(held[-1])
                rows = rows[len(held[-1]) :]
                if n == block_rows:
                    yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(held).tobytes()], pa.binary())], ["block"])
                    held, n = [], 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(held).tobytes()], pa.binary())], ["block"])

    return _saved(usable.select(vec).repartition(parts).mapInArrow(pack, "block binary"))


def candidate_chunks(candidates: DataFrame, key: str, vec: str, chunk_rows: int, dims: int) -> DataFrame:
    """(first, keys, cells): consecutive candidates, the row number of the first one, packed doubles."""

    def pack(batches):
        import pyarrow as pa

        for whole in batches:
            for at in range(0, whole.num_rows, chunk_rows):
                batch = whole.slice(at, chunk_rows)
                keys = batch.column("key")
                cells = _matrix(batch.column("vec"), dims).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("row").slice(0, 1),
                        pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
                        pa.array([cells], pa.binary()),
                    ],
                    ["first", "keys", "cells"],
                )

    source = candidates.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.when(_comparable(vec), F.col(vec)).alias("vec")
    )
    kind = candidates.schema[key].dataType.simpleString()
    return source.mapInArrow(pack, f"first long, keys array<{kind}>, cells binary")


def _fold(pairs: DataFrame, dims: int, kind: str) -> DataFrame:
    """(row, key, knn_dist) per candidate and run of pairs with the same chunk."""

    def fold(batches):
        import pyarrow as pa

        def found():
            rows = pa.array(np.arange(first, first + len(best)), pa.int64())
            return pa.RecordBatch.from_arrays([rows, keys, pa.array(best, pa.float64())], ["row", "key", "knn_dist"])

        first = None
        for batch in batches:
            for i, at in enumerate(batch.column("first").to_pylist()):
                if at != first:
                    if first is not None:
                        yield found()
                    first, keys = at, batch.column("keys")[i].values
                    cells = np.frombuffer(batch.column("cells")[i].as_buffer()).reshape(-1, dims)
                    best = np.full(len(cells), np.inf)
                fold_block(cells, np.frombuffer(batch.column("block")[i].as_buffer()).reshape(-1, dims), best)
        if first is not None:
            yield found()

    return pairs.mapInArrow(fold, f"row long, key {kind}, knn_dist double")


def nearest_positive(
    candidates: DataFrame,
    positives: DataFrame,
    key: str = "user_id",
    vec: str = "vec",
    block_cells: int = BLOCK_CELLS,
    wave_blocks: int = WAVE_BLOCKS,
) -> DataFrame:
    """(key, knn_dist, knn_score) for every candidate; both inputs carry ``vec`` as array<double>.

    ``wave_blocks`` blocks make a partition. Distances are NULL where there is nothing to compare
    (the caller's fill decides the score)."""
    usable = _saved(positives.where(_comparable(vec)).select(vec).distinct())
    stats = usable.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(vec)).alias("d")).first()
    n_pos, dims = stats["n"], stats["d"] or 0
    if n_pos == 0 or dims == 0:
        none = F.lit(None).cast("double")
        return candidates.select(key, none.alias("knn_dist"), none.alias("knn_score"))
    rows = max(1, block_cells // dims)
    parts = math.ceil(n_pos / (rows * wave_blocks))
    blocks = positive_blocks(usable, vec, rows, dims, parts)
    chunks = _saved(candidate_chunks(candidates, key, vec, max(1, rows // 4), dims))
    chunks = chunks.repartition(max(1, min(MOST_TASKS, chunks.count())))
    # the hint keeps Spark from broadcasting blocks by an estimate of their size
    pairs = chunks.crossJoin(blocks.hint("shuffle_replicate_nl"))
    found = _fold(pairs, dims, candidates.schema[key].dataType.simpleString())
    found = found.groupBy("row").agg(F.first("key").alias(key), F.min("knn_dist").alias("knn_dist"))
    dist = F.when(F.col("knn_dist") < float("inf"), F.col("knn_dist"))
    return found.select(key, dist.alias("knn_dist"), (F.lit(1.0) - dist).alias("knn_score"))
