"""Token ids in grammar-compressed binary shards (Re-Pair), with random access.

Writing: documents are dealt by ranges of their id, sorted, encoded and packed into shards of
about ``SHARD_IDS`` ids. In each shard frequent pairs of adjacent symbols are replaced by new
symbols, round after round, until no pair occurs ``MIN_COUNT`` times. One round counts all pairs (in a run
of one symbol those that do not overlap) and accepts pairs from the most frequent down as long as no symbol is the right part of one accepted
pair and the left part of another: accepted pairs then never overlap and all are replaced at once.
Counts are renewed between rounds only. A round looks at its ``PAIRS_A_ROUND`` most frequent pairs; the others
wait for later rounds, so this bounds a round's tables, not the result. A pair never spans two documents, so every
document is a run of whole symbols.

A shard is one binary value in a Parquet table, beside its number
of ids and its place; Parquet is the container because any store that Spark reaches can hold
it. Little-endian, in this order::

    4s  magic "RPG1"            I   first nonterminal (the vocabulary's size)
    I   number of rules         Q   number of symbols
    Q   number of documents     B   bytes of a symbol (2 or 4)
    I[] left symbol of each rule         I[] right symbol of each rule
    Q[] expansion length of each rule    Q[] first symbol of each document, and the end
    Q[] ids of each document             q[] document ids   B[] 1 where the id is not null
    H[] or I[] the symbols

Reading: the number of ids before each shard comes from running sums over the shards' rows (inside a
partition, and over partitions). A document is decoded by expanding its own symbols only;
``decode_range`` uses the expansion lengths to decode ids a..b of one document.

Cases: a null or empty text is the end id alone; null ids come first; rows with the same id keep the
order of their text hash; a very long text is one document of one shard, which then
exceeds ``SHARD_IDS``; extra columns are not read; an empty table gives no shards.
"""

from __future__ import annotations

import os
import struct
import zlib
from array import array
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kinscore.llm.common import require, scratch_path, slices, worker_cache

END_ID = 0
SHARD_IDS = 1 << 20
#: pairs looked at in a round (the others wait for the next), and the count a pair needs
PAIRS_A_ROUND = 2048
MIN_COUNT = 24
#: text encoded together: the longer, the fewer distinct words for each word
SLICE_BYTES = 16 << 20
#: words whose ids a Python worker keeps
CACHE_WORDS = 3_000_000
_HEAD = "<4sIIQQB"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class WordTable:
    """Words and their ids in two Arrow arrays (some 30 bytes a word)."""

    def __init__(self, most: int):
        self.most = most
        self.words, self.ids = pa.array([], pa.string()), pa.array([], pa.binary())

    def make_room(self) -> None:
        if len(self.words) > self.most:  # keep those that came first: the frequent ones
            half = pa.array(np.arange(self.most // 2))
            self.words, self.ids = self.words.take(half), self.ids.take(half)

    def look_up(self, words: pa.Array, encode) -> pa.Array:
        at = pc.index_in(words, value_set=self.words)
        if not at.null_count:
            return self.ids.take(at)
        new = words.filter(pc.is_null(at))
        found = pa.array(encode(new.to_pylist()), pa.binary())
        out = at.to_numpy(zero_copy_only=False)
        missing = np.isnan(out)
        out[missing] = len(self.words) + np.arange(len(new))
        out = pa.array(out.astype(np.int64))
        self.words, self.ids = pa.concat_arrays([self.words, new]), pa.concat_arrays([self.ids, found])
        return self.ids.take(out)


class Encoder:
    """ids by the tokenizers library, each distinct word encoded once per worker.

    The byte-level pre-tokeniser starts a new token at a single blank and at a single line feed, and
    between letters and punctuation. So the ids of a text are those of its words, each with
    the blank in front of it (none at the start of a line), and those of a word that ends in
    punctuation are the ids of its letters and of its punctuation. Texts with any
    other white space, or runs of it, are encoded whole."""

    def __init__(self, path: str, cache: int = CACHE_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.size = self.library.get_vocab_size()
        pre = self.library.pre_tokenizer
        self.cuts = (
            type(pre).__name__ == "ByteLevel"
            and not pre.add_prefix_space
            and pre.use_regex
            and self.library.normalizer is None
            and self.library.post_processor is None
        )
        self.type = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        #: ids of words with a blank in front, and without
        self.inner, self.bare = WordTable(cache), WordTable(cache)
        self.ends: dict[str, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        code, out = "H" if self.type.itemsize == 2 else "I", []
        for i in range(0, len(texts), 10_000):
            found = self.library.encode_batch_fast(texts[i : i + 10_000], add_special_tokens=False)
            out += [array(code, e.ids).tobytes() for e in found]
        return out

    def _ids(self, words: pa.Array, blank: str) -> pa.Array:
        """The ids of distinct words, as binary values. A word of letters with punctuation behind it is
        looked up by its letters; the punctuation has ids of its own."""
        table = self.inner if blank else self.bare
        stems = pc.utf8_rtrim(words, characters=_PUNCT)
        behind = pc.subtract(pc.binary_length(words), pc.binary_length(stems)).to_numpy()
        behind = np.where(pc.utf8_is_alpha(stems).to_numpy(zero_copy_only=False), behind, 0)
        body = pc.if_else(pa.array(behind > 0), stems, words).dictionary_encode()
        ids = table.look_up(body.dictionary, lambda new: self._library([blank + w for w in new])).take(body.indices)
        if not behind.any():
            return ids
        rest = pa.array([b""] * len(words), pa.binary())
        for n in np.unique(behind[behind > 0]).tolist():
            mask = pa.array(behind == n)
            ends = pc.utf8_slice_codeunits(words.filter(mask), -n).dictionary_encode()
            for e in ends.dictionary.to_pylist():
                if e not in self.ends:
                    self.ends[e] = self._library([e])[0]
            known = pa.array([self.ends[e] for e in ends.dictionary.to_pylist()], pa.binary())
            rest = pc.replace_with_mask(rest, mask, known.take(ends.indices))
        return pc.binary_join_element_wise(ids, rest, pa.scalar(b"", pa.binary()))

    def _by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one behind the other, ends of the texts), for texts that may be cut."""
        # line feeds become words of their own; a word behind one, or at the start, has no blank
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " \n "), " ")
        ends = np.cumsum(pc.list_value_length(parts).to_numpy())
        coded = parts.flatten().dictionary_encode()
        code, words = coded.indices.to_numpy(), coded.dictionary
        line = pc.equal(words, "\n").to_numpy(zero_copy_only=False)
        bare = np.zeros(len(code), bool)
        bare[0] = True
        bare[1:] = line[code[:-1]]
        bare[ends[:-1]] = True
        bare |= line[code]
        key = code * 2 + bare
        used = np.flatnonzero(np.bincount(key, minlength=2 * len(words)))
        place = np.zeros(2 * len(words), np.int64)
        found = []
        for odd, blank in ((0, " "), (1, "")):
            own = used[used % 2 == odd]
            place[own] = np.arange(len(own)) + sum(map(len, found))
            found.append(self._ids(words.take(pa.array(own // 2)), blank))
        joined = pa.concat_arrays(found).take(pa.array(place[key]))
        stop = np.frombuffer(joined.buffers()[1], np.int32, len(key) + 1) // self.type.itemsize
        return np.frombuffer(joined.buffers()[2], self.type, int(stop[-1])), stop[ends]

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text (no nulls) as integers of ``self.type``."""
        self.inner.make_room()
        self.bare.make_room()
        words = np.zeros(len(texts), bool)
        if self.cuts and len(texts):
            odd = pc.or_(pc.match_substring_regex(texts, _ODD_BLANKS), pc.equal(pc.binary_length(texts), 0))
            words = ~odd.to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        if words.any():
            flat, ends = self._by_words(texts.filter(pa.array(words)))
            for i, ids in zip(np.flatnonzero(words).tolist(), np.split(flat, ends[:-1]), strict=True):
                out[i] = ids
        rest = np.flatnonzero(~words).tolist()
        for i, raw in zip(rest, self._library(texts.take(pa.array(rest, pa.int64())).to_pylist()), strict=True):
            out[i] = np.frombuffer(raw, self.type)
        return out


_PUNCT = ".,!?;:"
#: white space beside white space or at an end, and any but blanks and line feeds
_ODD_BLANKS = (
    r"[\x09\x0B-\x0D\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
    r"|[ \n][ \n]|\A[ \n]|[ \n]\z"
)


def compress(symbols: np.ndarray, ends: np.ndarray, first: int, rounds: int | None = None) -> tuple:
    """Re-Pair until no pair occurs ``MIN_COUNT`` times (or for some rounds): (symbols, starts, rules).
    ``ends`` are the ends of the documents in ``symbols``; no rule spans two of them. ``first`` is the
    first nonterminal."""
    seq = symbols.astype(np.uint32)
    bounds = np.r_[0, ends].astype(np.int64)
    rules: list[tuple[int, int]] = []
    for _ in range(rounds) if rounds is not None else count():
        if len(seq) < 2:
            break
        left, right = seq[:-1], seq[1:]
        # pairs as one number: 32 bits hold two symbols while there are at most 2^16 of them
        bits = 16 if first + len(rules) + PAIRS_A_ROUND <= 1 << 16 else 32
        wide = np.uint32 if bits == 16 else np.uint64
        keys = (left.astype(wide, copy=False) << wide(bits)) | right.astype(wide, copy=False)
        cuts = bounds[1:-1]
        cuts = np.unique(cuts[(cuts > 0) & (cuts < len(seq))] - 1)
        # in a run of one symbol every other pair overlaps the one before: such pairs do not count, as those across cuts
        same = np.flatnonzero(left == right)
        if len(same):
            same = same[~np.isin(same, cuts, assume_unique=True)]
            start = np.maximum.accumulate(np.where(np.r_[True, np.diff(same) > 1], same, 0)) if len(same) else same
            cuts = np.union1d(cuts, same[(same - start) % 2 == 1])
        across = keys[cuts]
        keys.sort()
        edge = np.flatnonzero(keys[1:] != keys[:-1])
        edge = np.r_[0, edge + 1, len(keys)]
        counts = np.diff(edge)
        # pairs across two documents were counted along: take them off again
        pairs_across, times = np.unique(across, return_counts=True)
        counts[np.searchsorted(keys[edge[:-1]], pairs_across)] -= times
        often = np.flatnonzero(counts >= MIN_COUNT)
        if len(often) > PAIRS_A_ROUND:
            often = often[np.argpartition(counts[often], -PAIRS_A_ROUND)[-PAIRS_A_ROUND:]]
        pairs = keys[edge[often]]
        order = np.lexsort((pairs, -counts[often]))
        lefts: dict[int, int] = {}
        rights: dict[int, int] = {}
        taken = []
        for key in pairs[order].tolist():
            a, b = key >> bits, key & ((1 << bits) - 1)
            if a not in rights and b not in lefts and (a != b or a not in lefts and a not in rights):
                taken.append((lefts.setdefault(a, len(lefts)), rights.setdefault(b, len(rights))))
                rules.append((a, b))
        if not taken:
            break
        base = first + len(rules) - len(taken)
        # symbol -> row or column of a small table of the accepted pairs; 0 means none
        top = first + len(rules)
        row, column = np.zeros(top, np.uint16), np.zeros(top, np.uint16)
        row[list(lefts)] = np.arange(1, len(lefts) + 1)
        column[list(rights)] = np.arange(1, len(rights) + 1)
        made = np.zeros((len(lefts) + 1, len(rights) + 1), np.uint32)
        at = np.array(taken) + 1
        made[at[:, 0], at[:, 1]] = np.arange(base, top)
        r, c = row[left], column[right]
        r[cuts] = 0
        maybe = np.flatnonzero((r > 0) & (c > 0))
        new = made[r[maybe], c[maybe]]
        hit, new = maybe[new > 0], new[new > 0]
        seq[hit] = new
        keep = np.ones(len(seq), bool)
        keep[hit + 1] = False
        bounds = bounds - np.searchsorted(hit + 1, bounds)
        seq = seq[keep]
    return seq, bounds, rules


def expansion_lengths(rules: np.ndarray, first: int) -> np.ndarray:
    out = np.ones(first + len(rules), np.int64)
    for i, (a, b) in enumerate(rules.tolist()):
        out[first + i] = out[a] + out[b]
    return out


def pack_shard(ids: list[int | None], texts: list[np.ndarray], first: int) -> bytes:
    sizes = np.array([len(t) for t in texts], np.uint64)
    flat = np.concatenate(texts)
    seq, bounds, rules = compress(flat, np.cumsum(sizes).astype(np.int64), first)
    table = np.array(rules, np.uint32).reshape(-1, 2)
    lengths = expansion_lengths(table, first)[first:]
    wide = 2 if first + len(rules) <= 1 << 16 else 4
    known = np.array([i is not None for i in ids], np.uint8)
    return b"".join([
        struct.pack(_HEAD, b"RPG1", first, len(rules), len(seq), len(ids), wide),
        table[:, 0].astype("<u4").tobytes(),
        table[:, 1].astype("<u4").tobytes(),
        lengths.astype("<u8").tobytes(),
        bounds.astype("<u8").tobytes(),
        sizes.astype("<u8").tobytes(),
        np.array([i or 0 for i in ids], "<i8").tobytes(),
        known.tobytes(),
        seq.astype(f"<u{wide}").tobytes(),
    ])


class Shard:
    """Random access to the documents of a packed shard."""

    def __init__(self, blob: bytes):
        magic, self.first, n_rules, n_symbols, self.n_docs, wide = struct.unpack_from(_HEAD, blob)
        if magic != b"RPG1":
            raise ValueError("not a shard of this format")
        at = struct.calcsize(_HEAD)

        def read(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(blob, kind, n, at)
            at += out.nbytes
            return out

        left, right = read("<u4", n_rules), read("<u4", n_rules)
        lengths = read("<u8", n_rules).astype(np.int64)
        self.starts, self.sizes = read("<u8", self.n_docs + 1).astype(np.int64), read("<u8", self.n_docs).astype(np.int64)
        ids, known = read("<i8", self.n_docs), read("u1", self.n_docs)
        self.ids = [int(i) if k else None for i, k in zip(ids, known, strict=True)]
        self.symbols = read(f"<u{wide}", n_symbols)
        self.lengths = np.r_[np.ones(self.first, np.int64), lengths]
        # expansions of all rules, one behind the other; terminals stand for themselves
        self.offsets = np.r_[np.arange(self.first), self.first + np.cumsum(np.r_[0, lengths])[:-1]].astype(np.int64)
        pool = np.empty(self.first + int(lengths.sum()), np.uint32)
        pool[: self.first] = np.arange(self.first)
        size, off = self.lengths.tolist(), self.offsets.tolist()
        for i, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True), self.first):
            o, n = off[i], size[a]
            pool[o : o + n] = pool[off[a] : off[a] + n]
            pool[o + n : o + size[i]] = pool[off[b] : off[b] + size[b]]
        self.pool = pool

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        n = self.lengths[symbols]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        step = np.repeat(self.offsets[symbols] - (ends - n), n)
        return self.pool[step + np.arange(total)]

    def document(self, k: int) -> np.ndarray:
        return self.expand(self.symbols[self.starts[k] : self.starts[k + 1]])

    def decode_range(self, k: int, start: int, stop: int) -> np.ndarray:
        """ids ``start`` to ``stop`` of document k, expanding only the symbols that cover them."""
        own = self.symbols[self.starts[k] : self.starts[k + 1]]
        ends = np.cumsum(self.lengths[own])
        a = int(np.searchsorted(ends, start, "right"))
        b = int(np.searchsorted(ends, stop, "left")) + 1
        skipped = int(ends[a - 1]) if a else 0
        return self.expand(own[a:b])[start - skipped : stop - skipped]


def write_shards(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    shard_ids: int = SHARD_IDS,
) -> None:
    """Encode ``docs`` into a Parquet table (part, shard, n_ids, data) of packed shards at ``path``,
    in the order of ids: part by part, and shard by shard inside a part."""
    require(docs, doc_id, text)
    file = vocabulary or default_vocabulary()
    order = ["doc_id", F.xxhash64("text")]
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    dealt = source.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(*order)

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = worker_cache(f"encoder {file}", lambda: Encoder(file))
        end = np.array(END_ID, encoder.type)
        ids, texts, total, shard = [], [], 0, 0

        def out():
            data = pack_shard(ids, texts, encoder.size)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([total], pa.int64()),
                 pa.array([data], pa.binary())],
                ["part", "shard", "n_ids", "data"],
            )

        for batch in slices(batches, limit=SLICE_BYTES):
            coded = encoder.encode(pc.fill_null(batch.column("text"), ""))
            for i, own in zip(batch.column("doc_id").to_pylist(), coded, strict=True):
                own = np.append(own, end)
                if ids and total + len(own) > shard_ids:
                    yield out()
                    ids, texts, total, shard = [], [], 0, shard + 1
                ids.append(i)
                texts.append(own)
                total += len(own)
        if ids:
            yield out()

    dealt.mapInArrow(run, "part int, shard int, n_ids long, data binary").write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, decoded from the shards at ``path``."""
    shards = spark.read.schema("part int, shard int, n_ids long, data binary").parquet(path)
    inside = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    across = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(across), F.lit(0)).alias("base"))
    starts = shards.select("part", "shard", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("own"))
    starts = starts.join(parts, "part").select("part", "shard", (F.col("base") + F.col("own")).alias("base"))
    placed = shards.select("part", "shard", "data").join(starts, ["part", "shard"])

    def run(batches):
        for batch in batches:
            for base, data in zip(batch.column("base").to_pylist(), batch.column("data"), strict=True):
                shard = Shard(data.as_buffer())
                flat = shard.expand(shard.symbols).astype("<u4", copy=False)
                ends = np.cumsum(shard.sizes)
                crc = [zlib.crc32(flat[e - n : e]) for e, n in zip(ends.tolist(), shard.sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.ids, pa.int64()), pa.array(base + ends - shard.sizes), pa.array(shard.sizes),
                     pa.array(crc, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return placed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_shards(docs: DataFrame, **names) -> DataFrame:
    """Write to a fresh folder beside the session's checkpoints, and read back."""
    path = scratch_path(docs.sparkSession, "token-shards")
    write_shards(docs, path, **names)
    return read_shards(docs.sparkSession, path)
