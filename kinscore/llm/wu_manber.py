"""Benchmark decontamination by Wu-Manber multi-pattern search.

Texts are lower-cased (A-Z only) and written as their words between single blanks, a blank at either
end; a window of ``WINDOW`` consecutive words of a benchmark item (all words of a shorter item) is
then a byte string ``" w1 ... wn "`` that occurs in a text exactly where the words do.

Patterns are grouped by length (:data:`LEVELS`); every group has its own tables, with m the
length of its shortest pattern and B the bytes of a block:

* ``shift[hash(block)]``: how far the search may move when ``block`` ends at the current
  position: m - B + 1 if no pattern has it among its first m bytes, else the distance of its last place
  there from byte m;
* shift 0: the *bucket* of patterns whose first m bytes end in this block; a table of the patterns'
  first blocks drops most false ones;
* the words that stand there are looked up in the bucket (sorted by a hash of the whole pattern)
  and compared byte by byte.

The search is sequential by nature; here many cursors, each on its own stretch of a slice of
documents, move in one numpy step.

The benchmark is the stated query set. Its items are cut into overlapping pieces, the pieces are
dealt into blocks of about ``BLOCK_BYTES``, and the documents pass the tables of each block in turn, all
in one narrow stage: no shuffle, no pairs. The driver holds one block at a time; a block is
broadcast only when its counted size is at most twice ``BLOCK_BYTES`` (or it is a single
piece). After ``PASSES`` blocks the documents are written to the checkpoint folder, so that a task
holds few Python workers.

Cases: null and empty texts (or texts without words) have no words and no hit; an item without words has no
window; a null item id reads as the empty string; items with one id count once; repeated
documents are judged row by row; a very long text takes memory in proportion to itself; empty
tables give no rows, or no hits; extra columns pass through, those that clash (in any letter
case) are replaced by the result's.
"""

from __future__ import annotations

import uuid
from array import array
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinscore.llm.common import Shelter, named, require, saved, slices, texts_of, worker_cache

WINDOW = 10
#: words of a benchmark piece; neighbouring pieces share WINDOW - 1
PIECE_WORDS = 16_384
#: bytes of benchmark text whose tables a task holds at once
BLOCK_BYTES = 8 << 20
#: blocks searched in one stage
PASSES = 4
#: (least length of a pattern, bytes of its blocks), longest first
LEVELS = ((24, 8), (8, 4), (3, 3))
#: bytes between two cursors
STRIDE = 512
_PAD = b"\n" * 8
_MULT = np.uint64(0x9E3779B97F4A7C15)
_BLANK = 32

#: ASCII letters to lower case, digits and all bytes of longer characters as they are, the rest to blanks
_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else _BLANK for c in range(256)
)

_FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("spans", T.ArrayType(T.IntegerType(), False)),
    T.StructField("items", T.ArrayType(T.StringType(), False)),
]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def spaced(words: list[bytes]) -> bytes:
    """One blank more than words."""
    return b" " + b" ".join(words) + b" " if words else b" "


def blocks_at(body: bytes, size: int) -> np.ndarray:
    """The ``size`` bytes from every position of a padded text, as a number."""
    kind = np.dtype("<u8") if size > 4 else np.dtype("<u4")
    view = np.ndarray((len(body) - kind.itemsize + 1,), kind, body, strides=(1,))
    return view if size in (4, 8) else _Masked(view, (1 << 8 * size) - 1)


class _Masked:
    def __init__(self, view: np.ndarray, mask: int):
        self.view, self.mask = view, view.dtype.type(mask)

    def __getitem__(self, at):
        return self.view[at] & self.mask


def hashed(blocks: np.ndarray, bits: int) -> np.ndarray:
    return ((blocks.astype(np.uint64) * _MULT) >> np.uint64(64 - bits)).astype(np.int64)


class Level:
    """The tables of the patterns body[start:stop]; ``size`` bytes a block."""

    def __init__(self, body: bytes, start, stop, words, item, size: int):
        self.size, self.m = size, int((stop - start).min())
        self.bits = int(np.clip(np.ceil(np.log2(64 * len(start))), 12, 24))
        view, reach = blocks_at(body, size), self.m - size
        self.shift = np.full(1 << self.bits, min(reach + 1, 255), np.uint8)
        for place in range(reach + 1):  # later places overwrite: the last one counts
            if reach - place < 255:
                self.shift[hashed(view[start + place], self.bits)] = reach - place
        self.first = np.zeros(1 << self.bits, bool)
        self.first[hashed(view[start], self.bits)] = True
        suffix = hashed(view[start + reach], self.bits)
        whole = np.fromiter(
            (xxhash.xxh64_intdigest(body[a:b]) for a, b in zip(start.tolist(), stop.tolist(), strict=True)),
            np.uint64,
            len(start),
        )
        order = np.lexsort((whole, suffix))
        self.suffix, self.whole = suffix[order], array("Q", whole[order].tobytes())
        self.start, self.stop, self.item = start[order], stop[order], item[order]
        self.lengths = np.unique(words).tolist()

    def candidates(self, text: np.ndarray, view) -> np.ndarray:
        """Where a pattern may start: the cursors' search."""
        n, m, size = len(text) - len(_PAD), self.m, self.size
        if n < m:
            return np.zeros(0, np.int64)
        lanes = max(1, (n - m + 1) // STRIDE)
        edge = np.linspace(m - 1, n, lanes + 1).astype(np.int64)
        at, end, found = edge[:-1], edge[1:], []
        while len(at):
            step = self.shift[hashed(view[at - (size - 1)], self.bits)]
            zero = step == 0
            if zero.any():
                found.append(at[zero])
            at = at + np.maximum(step, 1)
            on = at < end
            at, end = at[on], end[on]
        start = np.concatenate(found) - (m - 1) if found else np.zeros(0, np.int64)
        start = start[text[start] == _BLANK]
        start = start[self.first[hashed(view[start], self.bits)]]
        start.sort()
        return start


class Patterns:
    """The search tables of (item, spaced words) pieces."""

    def __init__(self, pieces: list[tuple[str, bytes]], window: int):
        self.items = sorted({i for i, _ in pieces})
        number = {x: i for i, x in enumerate(self.items)}
        self.body = b"\n".join(t for _, t in pieces) + _PAD
        starts, stops, counts, items, at = [], [], [], [], 0
        for item, text in pieces:
            blank = np.flatnonzero(np.frombuffer(text, np.uint8) == _BLANK) + at
            n = min(window, len(blank) - 1)
            if n > 0:
                starts.append(blank[:-n])
                stops.append(blank[n:] + 1)
                counts.append(np.full(len(blank) - n, n, np.int64))
                items.append(np.full(len(blank) - n, number[item], np.int64))
            at += len(text) + 1
        self.levels = []
        if not starts:
            return
        start, stop, words, item = (np.concatenate(x) for x in (starts, stops, counts, items))
        left = np.ones(len(start), bool)
        for least, size in LEVELS:
            own = left & (stop - start >= least)
            if own.any():
                self.levels.append(Level(self.body, start[own], stop[own], words[own], item[own], size))
            left &= ~own

    def find(self, texts: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(text, first word, past the last word, item) of all occurrences, for spaced texts."""
        body = b"\n".join(texts) + _PAD
        text = np.frombuffer(body, np.uint8)
        blank = np.flatnonzero(text == _BLANK)
        ends = np.cumsum([len(t) + 1 for t in texts])
        first = np.searchsorted(blank, np.r_[0, ends[:-1]])  # the number of each text's first blank
        out = []
        for level in self.levels:
            view = blocks_at(body, level.size)
            start = level.candidates(text, view)
            suffix = hashed(view[start + level.m - level.size], level.bits)
            low = np.searchsorted(level.suffix, suffix, "left").tolist()
            high = np.searchsorted(level.suffix, suffix, "right").tolist()
            rank = np.searchsorted(blank, start).tolist()
            owner = np.searchsorted(ends, start, "right").tolist()
            for p, lo, hi, r, d in zip(start.tolist(), low, high, rank, owner, strict=True):
                for n in level.lengths:
                    if r + n >= len(blank):
                        break
                    own = body[p : blank[r + n] + 1]
                    h = xxhash.xxh64_intdigest(own)
                    i = bisect_left(level.whole, h, lo, hi)
                    while i < hi and level.whole[i] == h:
                        if self.body[level.start[i] : level.stop[i]] == own:
                            w = r - int(first[d])
                            out.append((d, w, w + n, int(level.item[i])))
                        i += 1
        return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(set(spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def pieces_of(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item, place, body): the benchmark's pieces, saved."""

    def cut(batches):
        for batch in slices(batches, "text"):
            rows = []
            for item, raw in zip(batch.column("item").to_pylist(), texts_of(batch), strict=True):
                words = words_of(raw)
                for at in range(0, max(1, len(words) - window + 1) if words else 0, PIECE_WORDS - window + 1):
                    rows.append((item, at, spaced(words[at : at + PIECE_WORDS])))
            cols = zip(*rows, strict=True) if rows else ((), (), ())
            kinds = (pa.string(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["item", "place", "body"]
            )

    plain = benchmark.select(
        F.coalesce(named(item_id).cast("string"), F.lit("")).alias("item"), named(text).alias("text")
    )
    return saved(plain.mapInArrow(cut, "item string, place long, body binary"))


def dealt(pieces: DataFrame, limit: int) -> tuple[DataFrame, int]:
    """The pieces with the block that each belongs to, and the number of blocks; no block of more than
    one piece holds over twice ``limit`` bytes."""
    size = F.octet_length("body")
    n, total = pieces.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    blocks = max(1, -(-total // limit))
    while True:
        place = F.pmod(F.xxhash64("item", "place"), F.lit(blocks)).cast("int")
        own = pieces.withColumn("block", place)
        full = own.groupBy("block").agg(F.sum(size).alias("bytes"), F.count(F.lit(1)).alias("n"))
        worst = full.where("n > 1").agg(F.max("bytes")).first()[0] or 0
        if worst <= 2 * limit or blocks >= 8 * n:
            return own, blocks
        blocks *= 2


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    prefix: str = "",
) -> DataFrame:
    """All columns of ``docs`` plus n_words, n_hit (words inside occurrences), ``spans`` (first word
    and word past the last of each run of hit words, one after the other) and ``items`` (ids
    of the items that occur, sorted by code point); names led by ``prefix``."""
    require(docs, text)
    require(benchmark, item_id, item_text)
    fields = [T.StructField(prefix + f.name, f.dataType) for f in _FIELDS]
    n_words, n_hit, spans, items = (f.name for f in fields)
    pieces, blocks = dealt(pieces_of(benchmark, item_id, item_text, window), block_bytes)
    context = docs.sparkSession.sparkContext
    shelter = Shelter(docs, [f.name for f in fields], text)
    own = shelter.names[text]
    schema = T.StructType([T.StructField(own, T.StringType())] + [f for f in shelter.fields if f.name != own] + fields)
    found = shelter.source
    for block in range(blocks):
        rows = pieces.where(F.col("block") == block).select("item", "body").collect()
        sent = context.broadcast([(r.item, bytes(r.body)) for r in rows])
        found = found.mapInArrow(_search(sent, window, block == 0, schema, own, fields), schema)
        if block % PASSES == PASSES - 1 and block + 1 < blocks:
            found = saved(found)
    return found.select(*shelter.restored(), n_words, n_hit, spans, items)


def _search(sent, window: int, first: bool, schema: T.StructType, text: str, fields):
    n_words, n_hit, spans, items = (f.name for f in fields)
    block_id = uuid.uuid4().hex

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        held = worker_cache("wu_manber", dict)  # the tables of one block, for the tasks that this worker runs
        if block_id not in held:
            held.clear()
            held[block_id] = Patterns(sent.value, window)
        tables = held[block_id]
        for batch in slices(batches, text):
            raw = [spaced(words_of(t)) for t in texts_of(batch, text)]
            hits: list[list] = [[] for _ in raw]
            seen: list[set] = [set() for _ in raw]
            if not first:
                for i, (s, x) in enumerate(zip(batch.column(spans).to_pylist(), batch.column(items).to_pylist(), strict=True)):
                    hits[i] = list(zip(s[::2], s[1::2], strict=True))
                    seen[i] = set(x)
            for d, a, b, item in tables.find(raw):
                hits[d].append((a, b))
                seen[d].add(tables.items[item])
            runs = [merged(h) for h in hits]
            own = {
                n_words: [t.count(b" ") - 1 for t in raw],
                n_hit: [sum(b - a for a, b in r) for r in runs],
                spans: [[x for ab in r for x in ab] for r in runs],
                items: [sorted(s) for s in seen],
            }
            cols = [
                pa.array(own[f.name], f.type) if f.name in own else batch.column(f.name).cast(f.type) for f in out
            ]
            yield pa.RecordBatch.from_arrays(cols, schema=out)

    return run


def uncontaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents without any hit, in the columns of ``docs``."""
    found = decontaminate(docs, benchmark, text, prefix="__bench_", **options)
    return found.where("__bench_n_hit = 0").select(*map(named, docs.columns))
