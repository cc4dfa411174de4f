"""Substring dedup by relative Lempel-Ziv parsing against indexed reference blocks.

A window is ``WINDOW`` consecutive words; a window is a duplicate when the same words also
start in a document with a smaller id. Documents are parsed greedily into factors (longest
matches) of reference blocks; factors of a window or more are duplicate spans, and the windows
that cross the boundary of two factors are looked up one by one.

Which blocks can hold a window of a document? Every window names one *anchor*: of its
``WINDOW - GRAM + 1`` grams of ``GRAM`` words the one with the smallest hash. Equal windows name
equal anchors, so a reference block holds what all documents have around one anchor, and
a document is parsed against the blocks of its anchors; no other block can match.
Neighbouring windows mostly share an anchor: there is about one anchor for five windows.

1. One row per anchor of a document: the anchor's hash, the document, and its *snippet*, the
   run of windows that name the anchor, each as ``KEY_BYTES`` bytes of its hash. One exchange by
   anchor brings a block together. A task sends rows that repeat an id and its text once.
2. A block is streamed in the order of ids. Each snippet is factored against the index of the
   snippets before it (a factor grows while the windows go on as in the reference), then
   its own new windows are indexed. Duplicate windows leave as one bit each. A factor ends with its snippet;
   factors that go on in the next snippet do so in the next block, and their bits meet in step 4.
3. A block need not be whole in one task. A look at one row in ``LOOK`` finds the most crowded anchors,
   whose rows are dealt to as many parts as they need (any other anchor has less than a
   ``CROWDED_ANCHORS``-th of all rows), and a task starts a new part after ``PART_ROWS`` rows. Parts are factored as
   blocks are. Where a block has several, the windows that no smaller id of their part has leave as rows, one for a
   window and document; a second exchange compares them with the other parts. How rows are dealt decides
   nothing about the result, and a task never holds more than a part.
4. The bits are gathered by document, and the documents cut the covered words.

Windows are equal if the 64 bits of their anchors and 56 bits of their own hashes are.

Cases: null, empty and short texts have no window and stay as they are; a null id is neither a
reference nor cut; rows with the same id do not cut each other (no id is smaller) and are each
judged by their own text; text is never truncated, a very long text takes memory in
proportion to itself; extra columns pass through; an empty table gives none.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinscore.llm.common import Shelter, named, require, scratch_path, slices, texts_of, with_text

WINDOW = 13
GRAM = 5
#: bytes of a window's hash that travel beside the 8 bytes of its anchor
KEY_BYTES = 7
#: one row in LOOK is looked at for crowded anchors
LOOK = 8
#: an anchor is crowded if those rows have so many snippets of it
CROWD = 64
#: crowded anchors that are dealt to parts, the most crowded first (16 bytes each, sent to every task)
CROWDED_ANCHORS = 100_000
#: snippets of a block that are factored together
PART_ROWS = 16_384
#: consecutive snippets of a row that are dealt to the same part
TOGETHER = 64
#: rows that a task remembers in order to send repeated ones once
REMEMBERED = 100_000
_MULT = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def gram_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A well-mixed hash of every ``size`` consecutive words."""
    n = len(h) - size + 1
    g = h[:n].copy()
    for j in range(1, size):
        g *= _MULT
        g += h[j : n + j]
    g ^= g >> np.uint64(31)
    g *= np.uint64(0xBF58476D1CE4E5B9)
    g ^= g >> np.uint64(29)
    return g


def anchors(words: list[bytes], window: int = WINDOW, gram: int = GRAM):
    """(anchor hash, first window, one past the last window) of every run of windows that
    names the same anchor, and the hashes of all windows."""
    if len(words) < window:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, np.uint64)
    h = word_hashes(words)
    g = gram_hashes(h, gram)
    width = window - gram + 1
    at = np.lib.stride_tricks.sliding_window_view(g, width).argmin(axis=1) + np.arange(len(g) - width + 1)
    first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    return g[at[first]].view(np.int64), first, np.r_[first[1:], len(at)], gram_hashes(h, window)


def factor_bits(snippets: list[tuple[int, bytes]], size: int = KEY_BYTES) -> list[int]:
    """Parse the snippets of one block, (id, window keys) in the order of ids.

    Per snippet the bits of its windows that a smaller id has. A window's first entry in the index
    has the smallest id, so the index answers for every earlier document."""
    index: dict[bytes, tuple[int, list[bytes], int]] = {}
    found = []
    for own, packed in snippets:
        keys = [packed[i : i + size] for i in range(0, len(packed), size)]
        n, i, bits = len(keys), 0, 0
        new = []
        while i < n:
            hit = index.get(keys[i])
            if hit is None:
                new.append(i)  # a literal
                i += 1
            elif hit[0] == own:
                i += 1
            else:
                # the longest factor from here: every window in it is a duplicate
                _, ref, r = hit
                while i < n and r < len(ref) and keys[i] == ref[r]:
                    bits |= 1 << i
                    i, r = i + 1, r + 1
                # windows behind it cross its boundary until the next factor starts: looked up singly
        for i in new:
            index.setdefault(keys[i], (own, keys, i))
        found.append(bits)
    return found


def crowded_anchors(known: DataFrame, window: int, gram: int, look: int, crowd: int, part_rows: int):
    """The crowded anchors in order, and the number of parts that each is dealt to."""

    def once(batches):
        for batch in slices(batches):
            found = [anchors(t.split(), window, gram)[0] for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found), pa.int64())], ["anchor"])

    sample = known.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(look)) == 0).select("text")
    hot = sample.mapInArrow(once, "anchor long").groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
    hot = hot.where(F.col("n") >= crowd)
    rows = sorted((r.anchor, r.n) for r in hot.orderBy(F.desc("n"), "anchor").limit(CROWDED_ANCHORS).collect())
    anchor, n = np.array(rows, np.int64).reshape(-1, 2).T
    parts = 1 + n * look * 4 // part_rows  # a quarter of a part each, as far as the look can tell
    return anchor[parts > 1], parts[parts > 1]


def duplicate_windows(
    docs: DataFrame,
    window: int = WINDOW,
    gram: int = GRAM,
    look: int = LOOK,
    crowd: int = CROWD,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """(doc_id, at, bits): the duplicate windows of each document that has any. ``at`` holds the
    32-bit hash of the row's text (which tells rows apart that repeat an id) above the number
    of a window, and bit i marks the i-th window from there. ``docs`` has doc_id (long) and text."""
    if window - gram >= 62:
        raise ValueError("a snippet's windows must fit the bits of a long")
    known = docs.where("doc_id is not null").select("doc_id", "text")
    crowded, parts = crowded_anchors(known, window, gram, look, crowd, part_rows)

    def snippets(batches):
        names = ["block", "part", "doc_id", "at", "keys"]
        seen = set()
        for batch in slices(batches):
            block, part, ids, at, sizes, keys = [], [], [], [], [], []
            for doc, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                row = (doc, xxhash.xxh64_intdigest(text))
                if row in seen:  # an equal row has the same windows
                    continue
                if len(seen) >= REMEMBERED:
                    seen.clear()
                seen.add(row)
                key, start, stop, h = anchors(text.split(), window, gram)
                if not len(key):
                    continue
                dealt = np.full(len(key), -1, np.int32)
                if len(crowded):
                    place = np.minimum(np.searchsorted(crowded, key), len(crowded) - 1)
                    apart = np.flatnonzero(crowded[place] == key)
                    # neighbours stay together; a row that repeats an anchor goes on to further parts
                    dealt[apart] = (xxhash.xxh32_intdigest(repr(row)) + apart // TOGETHER) % parts[place[apart]]
                block.append(key)
                part.append(dealt)
                at.append(np.uint64(xxhash.xxh32_intdigest(text) << 32).view(np.int64) + start)
                ids.append(np.full(len(key), doc, np.int64))
                sizes.append((stop - start) * KEY_BYTES)
                keys.append(h.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].ravel())
            if not block:
                continue
            ends = np.r_[0, np.cumsum(np.concatenate(sizes))].astype(np.int32)
            body = np.ascontiguousarray(np.concatenate(keys))
            packed = pa.Array.from_buffers(
                pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(body.tobytes())]
            )
            fixed = [pa.array(np.concatenate(x)) for x in (block, part, ids, at)]
            yield pa.RecordBatch.from_arrays([*fixed, packed], names)

    ats = T.ArrayType(T.LongType())
    found = T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "at", "bits", "block", "tie")])
    found = found.add("ats", ats)

    def factor(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(found)
        held, n_held, several = [], 0, False  # the last block's rows since its last part; whether it had one

        def change(t):
            block, part = t.column("block").to_numpy(), t.column("part").to_numpy()
            return np.flatnonzero(np.r_[True, (block[1:] != block[:-1]) | (part[1:] != part[:-1])])

        def parsed(t, several: bool = False):
            """The duplicate windows of the blocks in ``t``, and what other parts of them must be asked for."""
            block, part, ids = (t.column(c).to_numpy() for c in ("block", "part", "doc_id"))
            at, keys = t.column("at").to_numpy(), t.column("keys")
            edge = np.r_[change(t), t.num_rows]
            rows = []
            work = (ids[edge[:-1]] != ids[edge[1:] - 1]) | (part[edge[:-1]] >= 0) | several
            for i in np.flatnonzero(work).tolist():
                x, y = int(edge[i]), int(edge[i + 1])
                docs, places, packed = ids[x:y].tolist(), at[x:y].tolist(), keys[x:y].to_pylist()
                bits = factor_bits(list(zip(docs, packed, strict=True)))
                rows += [(d, a, m, None, None, None) for d, a, m in zip(docs, places, bits, strict=True) if m]
                if several or part[x] >= 0:
                    open_: dict[tuple[int, int], list[int]] = {}
                    for d, a, m, raw in zip(docs, places, bits, packed, strict=True):
                        for j in range(len(raw) // KEY_BYTES):
                            if not m >> j & 1:
                                w = int.from_bytes(raw[j * KEY_BYTES : (j + 1) * KEY_BYTES], "little")
                                open_.setdefault((w, d), []).append(a + j)
                    rows += [(d, None, None, int(block[x]), w, where) for (w, d), where in open_.items()]
            cols = zip(*rows, strict=True) if rows else ((),) * len(out)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out, strict=True)], schema=out)

        def whole():
            return parsed(pa.concat_batches(held), several)

        for batch in batches:
            if not batch.num_rows:
                continue
            start, t = change(batch), batch
            if held or several:
                same = last == (batch.column("block")[0].as_py(), batch.column("part")[0].as_py())
                more = 0 if not same else int(start[1]) if len(start) > 1 else batch.num_rows
                if more:
                    held.append(batch.slice(0, more))
                    n_held += more
                if more < batch.num_rows:
                    if held:
                        yield whole()
                    held, n_held, several = [], 0, False
                t = batch.slice(more)
            if t.num_rows:
                cut = int(start[-1]) - (batch.num_rows - t.num_rows)
                if cut:
                    yield parsed(t.slice(0, cut))
                held, n_held = [t.slice(cut)], t.num_rows - cut
                last = (t.column("block")[cut].as_py(), t.column("part")[cut].as_py())
            if n_held >= part_rows:
                several = True
                yield whole()
                held, n_held = [], 0
        if held:
            yield whole()

    placed = known.mapInArrow(snippets, "block long, part int, doc_id long, at long, keys binary")
    blocks = placed.repartition("block", "part").sortWithinPartitions("block", "part", "doc_id")
    path = scratch_path(docs.sparkSession, "substring-bits")
    blocks.mapInArrow(factor, found).write.parquet(path)
    bits = docs.sparkSession.read.parquet(path)
    sure = bits.where("tie is null").select("doc_id", "at", "bits")
    ties = bits.where("tie is not null").select("block", "tie", "doc_id", "ats")
    first = ties.groupBy("block", "tie").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    lost = ties.join(first.where("first < last"), ["block", "tie"]).where("doc_id > first")
    return sure.unionByName(lost.select("doc_id", F.explode("ats").alias("at"), F.lit(1).cast("long").alias("bits")))


def _windows_of(at: np.ndarray, bits: np.ndarray, text: bytes, width: int) -> np.ndarray:
    """The windows of this text among those of all rows with its id."""
    own = (at >> 32) & 0xFFFFFFFF == xxhash.xxh32_intdigest(text)
    at, bits = at[own] & 0xFFFFFFFF, bits[own]
    hit = ((bits[:, None] >> np.arange(width)) & 1).astype(bool)
    return np.unique((at[:, None] + np.arange(width))[hit])


def cut(text: bytes, windows: np.ndarray, window: int = WINDOW, clean: bool = True):
    """(words, removed words, kept words, text without the covered words)."""
    words = text.split()
    n = len(words)
    if not len(windows):
        return n, 0, words, text
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, windows, 1)
    np.add.at(step, windows + window, -1)
    gone = np.cumsum(step)[:n] > 0
    kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
    # kept runs keep their own blanks; what was cut leaves one space
    pieces, at, run = [], 0, None
    for w, g in zip(words, gone.tolist(), strict=True) if clean else ():
        a = text.index(w, at)
        at = a + len(w)
        if g:
            if run is not None:
                pieces.append(text[run[0] : run[1]])
            run = None
        else:
            run = (run[0] if run else a, at)
    if run is not None:
        pieces.append(text[run[0] : run[1]])
    return n, int(gone.sum()), kept, b" ".join(pieces)


_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("kept_sha256", T.StringType()),
    T.StructField("clean_text", T.StringType()),
]


def substring_dedup(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    look: int = LOOK,
    crowd: int = CROWD,
    part_rows: int = PART_ROWS,
    prefix: str = "",
    keep_clean: bool = True,
) -> DataFrame:
    """All columns of ``docs`` plus n_words, n_removed, kept_sha256 (kept words joined by one
    space) and ``clean_text``; names led by ``prefix``, which replace columns that clash."""
    require(docs, doc_id, text)
    plain = docs.select(named(doc_id).cast("long").alias("doc_id"), named(text).alias("text"))
    found = duplicate_windows(plain, window, gram, look, crowd, part_rows)
    by_doc = found.groupBy(F.col("doc_id").alias("__id")).agg(
        F.collect_list("at").alias("__at"), F.collect_list("bits").alias("__bits")
    )
    fields = [T.StructField(prefix + f.name, f.dataType) for f in (_FIELDS if keep_clean else _FIELDS[:-1])]
    shelter = Shelter(docs, [f.name for f in fields], doc_id, text)
    needed, own_id, own_text = shelter.source, shelter.names[doc_id], shelter.names[text]
    passed = [f.name for f in shelter.fields]
    # the text crosses the exchange of the join compressed
    slim = T.StructType([T.StructField("__text", T.BinaryType()), *(f for f in needed.schema if f.name != own_text)])

    def shrink(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(slim)
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in slices(batches, own_text):
            raw = batch.column(own_text).cast(pa.binary()).to_pylist()
            own = pa.array([None if t is None else pack(t) for t in raw], pa.binary())
            rest = [batch.column(f.name).cast(f.type) for f in out if f.name != "__text"]
            yield pa.RecordBatch.from_arrays([own, *rest], schema=out)

    joined = (
        needed.mapInArrow(shrink, slim)
        .join(by_doc, F.col(own_id).cast("long") == F.col("__id"), "left")
        .drop("__id")
    )
    schema = T.StructType(shelter.fields + fields)

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        none = np.zeros(0, np.int64)
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches, "__text", 1 << 20):
            rows, texts = [], []
            at, bits = batch.column("__at"), batch.column("__bits")
            for i, t in enumerate(batch.column("__text").to_pylist()):
                t = None if t is None else unpack(t)
                windows = none
                if t and at[i].is_valid:
                    windows = _windows_of(
                        *(np.asarray(x[i].values, np.int64) for x in (at, bits)), t, window - gram + 1
                    )
                n, removed, kept, clean = cut(t or b"", windows, window, keep_clean)
                rows.append((n, removed, hashlib.sha256(b" ".join(kept)).hexdigest()))
                texts.append((t, clean if removed else t))
            own = dict(zip((f.name for f in fields), zip(*rows, strict=True), strict=False))
            own = {f.name: pa.array(own[f.name], out.field(f.name).type) for f in fields[:3]}
            if keep_clean:
                own[fields[3].name] = pa.array([c for _, c in texts], pa.binary()).cast(pa.string())
            if own_text in passed:
                own[own_text] = pa.array([t for t, _ in texts], pa.binary()).cast(pa.string())
            cols = [own[f.name] if f.name in own else batch.column(f.name) for f in out]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, out, strict=True)], schema=out)

    return joined.mapInArrow(run, schema).select(*shelter.restored(), *(f.name for f in fields))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document with its duplicate spans cut out, in the columns of ``docs``; a document
    that consists of repeats only stays as a row with an empty text."""
    found = substring_dedup(docs, doc_id, text, prefix="__sub_")
    return with_text(found, docs, F.col("__sub_clean_text"), text)
