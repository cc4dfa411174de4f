"""SimHash near-duplicates by segment popcounts.

A 64-bit fingerprint is embedded as 32 counts: the set bits of each two-bit segment (0, 1, 2).
One differing bit moves one count by one, so the Manhattan distance of two embeddings is at
most the Hamming distance of the fingerprints: a lower bound. Of two fingerprints within
three bits, one half of the embedding (16 counts) is within Manhattan distance 1.

Grid range-join: each half is a point of a 16-dimensional grid with cells of side 1. Every
distinct fingerprint goes to its own cell; points whose counts sum to an even number also go to
the cells one step away (two points at distance 1 differ in parity, so one side is enough).
Fingerprints that meet in a cell are verified exactly on their 64 bits.

Distinct fingerprints are formed by a partial aggregate first, so copies cost nothing further.
Inside a cell only the links of a spanning forest leave the task, never all pairs: a dense group of
n fingerprints gives at most n - 1 links per cell. A cell above ``cell_rows`` fingerprints is cut into
blocks and every two blocks form a group of their own, so memory per task is bounded
and no link is lost. Links are joined into components with checkpointed rounds.

Cases: null, empty and blank texts have the fingerprint zero and are linked to each other; texts of fewer
words than a shingle hash their whole sequence; a null id gets a fingerprint and
the component of the ids it links to (null when it reaches none); repeated rows share a
fingerprint; ties are impossible to see (the smallest id names a component); extra columns
are not read; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinscore.llm.common import require, saved, slices, texts_of
from kinscore.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42
#: fingerprints of one cell that a task compares at once
CELL_ROWS = 4096
_PAIRS = np.uint64(0x5555555555555555)


def fingerprint(text: bytes, size: int = SHINGLE_WORDS) -> int:
    """Majority bits over the XXH64 of all shingles, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= size:
        grams = [b" ".join(words)]
    else:
        # slices of the joined text: shingle i starts with word i and ends with word i+size-1
        joined = b" ".join(words)
        lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lens) - 1
        starts = (ends - lens + 1)[: len(words) - size + 1].tolist()
        grams = [joined[a:b] for a, b in zip(starts, ends[size - 1 :].tolist(), strict=True)]
    digest, seed = xxhash.xxh64_intdigest, SEED
    h = np.array([digest(g, seed) for g in grams], dtype=np.uint64)
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 4096):
        bits = np.unpackbits(h[i : i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.uint16)
    set_bits = np.packbits(2 * ones > len(h), bitorder="little")
    return int(set_bits.view(np.uint64)[0])


def fingerprints(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, marked: bool = False
) -> DataFrame:
    """(doc_id, fp) with the fingerprint's bits as a signed long; ``marked`` adds a hash of the text."""
    require(docs, doc_id, text)
    more = ["mark"] if marked else []
    source = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), *[F.xxhash64(text).alias(m) for m in more]
    )

    def run(batches):
        for batch in slices(batches):
            fps = np.array([fingerprint(t, size) for t in texts_of(batch)], dtype=np.uint64)
            columns = [batch.column("doc_id"), pa.array(fps.view(np.int64)), *[batch.column(m) for m in more]]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", *more])

    return source.mapInArrow(run, "doc_id long, fp long" + ", mark long" * marked)


def _embed(fp: np.ndarray) -> np.ndarray:
    """The 32 two-bit counts of each fingerprint, packed in one word."""
    return (fp & _PAIRS) + ((fp >> np.uint64(1)) & _PAIRS)


def _cells_of(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, fp, home) rows: the own cells of both halves, and the cells a step away."""
    counts = _embed(fp)
    cells, owners, home = [], [], []
    for half in (0, 1):
        point = (counts >> np.uint64(32 * half)) & np.uint64(0xFFFFFFFF)
        side = np.uint64(half << 32)
        cells.append(point | side)
        owners.append(fp)
        home.append(np.ones(len(fp), bool))
        probing = np.bitwise_count(point & np.uint64(0x55555555)) % 2 == 0  # the sum's parity
        p, f = point[probing], fp[probing]
        for k in range(16):
            one = np.uint64(1 << (2 * k))
            value = (p >> np.uint64(2 * k)) & np.uint64(3)
            for moved, fits in ((p + one, value < 2), (p - one, value > 0)):
                cells.append(moved[fits] | side)
                owners.append(f[fits])
                home.append(np.zeros(int(fits.sum()), bool))
    return np.concatenate(cells), np.concatenate(owners), np.concatenate(home)


def _forest(fp: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links (member, smallest of its local component) of one group, by breadth-first search."""
    left = np.sort(fp)
    links = []
    while len(left) > 1:
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            near = np.bitwise_count(left ^ front.pop()) <= bits
            if near.any():
                found = left[near]
                front.extend(found)
                links += [(int(x), int(root)) for x in found.view(np.int64)]
                left = left[~near]
    signed = np.int64
    return [(u, int(np.uint64(v).view(signed))) for u, v in links]


def _group_links(key: np.ndarray, fp: np.ndarray, home: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links of complete groups: ``key`` is sorted; groups without a close pair are passed over
    with vector operations."""
    edge = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    size = np.diff(np.r_[edge, len(key)])
    live = (size > 1) & np.logical_or.reduceat(home, edge)
    small = live & (size <= 32)
    links: list[tuple[int, int]] = []
    close = np.zeros(len(edge), bool)
    of = np.repeat(np.arange(len(edge)), size)
    pick = np.flatnonzero(small[of])
    f, g = fp[pick], of[pick]
    for lag in range(1, min(32, int(size[small].max(initial=1)))):
        hit = (g[lag:] == g[:-lag]) & (np.bitwise_count(f[lag:] ^ f[:-lag]) <= bits)
        close[g[lag:][hit]] = True
    for i in np.flatnonzero(close | (live & ~small)):
        links += _forest(np.unique(fp[edge[i] : edge[i] + size[i]]), bits)
    return links


def links_between(nodes: DataFrame, bits: int = MAX_BITS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(u, v): links that connect every two distinct fingerprints of ``nodes(fp)`` within ``bits``."""
    if bits > 3:
        raise ValueError("the grid covers distances up to 3 bits: halves within Manhattan distance 1")

    def spread(batches):
        for batch in batches:
            fp = batch.column("fp").to_numpy().view(np.uint64)
            cell, owner, home = _cells_of(fp)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.view(np.int64)), pa.array(owner.view(np.int64)), pa.array(home)], ["cell", "fp", "home"]
            )

    cells = nodes.select("fp").mapInArrow(spread, "cell long, fp long, home boolean")
    hot = cells.groupBy("cell").count().where(F.col("count") > cell_rows)
    hot = saved(hot.select("cell", F.ceil(F.col("count") / (cell_rows / 2)).cast("int").alias("n_blocks")))
    plain = cells.withColumn("part", F.lit(0))
    if not hot.isEmpty():
        # every two blocks of a large cell meet once; the blocks number ceil(rows / (cell_rows / 2))
        met = cells.join(hot, "cell").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("n_blocks")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("other")
        met = met.select("cell", "fp", "home", "n_blocks", "block", other)
        part = F.least("block", "other") * F.col("n_blocks") + F.greatest("block", "other") + 1
        plain = plain.join(hot.select("cell"), "cell", "left_anti").unionByName(
            met.select("cell", "fp", "home", part.cast("int").alias("part"))
        )

    def link(batches):
        kept = None  # the last group may go on in the next batch

        def out(rows):
            u, v = zip(*rows, strict=True) if rows else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            got = [t.column(c).to_numpy() for c in ("cell", "part", "fp", "home")]
            if kept is not None:
                got = [np.concatenate(x) for x in zip(kept, got, strict=True)]
            cell, part = got[0], got[1]
            if not len(cell):
                continue
            start = np.flatnonzero((cell != cell[-1]) | (part != part[-1]))
            cut = int(start[-1]) + 1 if len(start) else 0
            kept = [x[cut:] for x in got]
            if cut:
                key = np.cumsum(np.r_[0, (cell[1:cut] != cell[: cut - 1]) | (part[1:cut] != part[: cut - 1])])
                yield out(_group_links(key, got[2][:cut].view(np.uint64), got[3][:cut], bits))
        if kept is not None and len(kept[0]):
            yield out(_group_links(np.zeros(len(kept[0]), np.int64), kept[2].view(np.uint64), kept[3], bits))

    dealt = plain.repartition("cell", "part").sortWithinPartitions("cell", "part")
    return dealt.mapInArrow(link, "u long, v long")


def _with_components(fps: DataFrame, bits: int, cell_rows: int) -> DataFrame:
    """``fps`` with the component's smallest fingerprint (root) and smallest id (component_id)."""
    nodes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    found = saved(components(links_between(nodes.select("fp"), bits, cell_rows)))
    # smallest id of each component, then of each fingerprint
    rooted = nodes.join(found, nodes.fp == found.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    low = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return fps.join(rooted.join(low, "root").select("fp", "root", "component_id"), "fp")


def simhash_components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE_WORDS,
    bits: int = MAX_BITS,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """(doc_id, fp, fingerprint, component_id), one row per input row."""
    found = _with_components(saved(fingerprints(docs, doc_id, text, size)), bits, cell_rows)
    return found.select("doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def first_of_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without near-duplicates: of each component one row stays, that with the
    smallest id. Where an id is repeated, each of its texts belongs to its own component; of several
    in one component the one with the smallest (fingerprint, text hash) stays, and of rows with
    the same id and text the one that sorts first by the other columns. Rows without an id cannot
    be named by a component and stay."""
    same = _with_components(saved(fingerprints(docs, doc_id, text, marked=True)), MAX_BITS, CELL_ROWS)
    low = same.where("doc_id = component_id").groupBy("root", "doc_id").agg(F.min(F.struct("fp", "mark")).alias("low"))
    stays = low.select(F.col("doc_id").alias("__id"), F.col("low.mark").alias("__mark"))
    named = docs.select("*", F.col(f"`{doc_id}`").cast("long").alias("__id"), F.xxhash64(f"`{text}`").alias("__mark"))
    kept = named.join(stays, ["__id", "__mark"], "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    order = [F.col(f"`{f.name}`") for f in docs.schema if f.name != text and f.dataType.typeName() not in ("map", "variant")]
    first = kept.groupBy("__id", "__mark").agg(F.min_by(whole, F.struct(*order)).alias("__row"))
    return first.select("__row.*").unionByName(docs.where(F.col(f"`{doc_id}`").isNull()))
