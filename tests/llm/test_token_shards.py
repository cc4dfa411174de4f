from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kinscore.llm.token_shards import (
    MIN_COUNT,
    Encoder,
    Shard,
    compress,
    default_vocabulary,
    expansion_lengths,
    pack_shard,
    read_shards,
    token_shards,
    write_shards,
)

LIBRARY = Tokenizer.from_file(default_vocabulary())
LIBRARY.encode_special_tokens = True
ENCODER = Encoder(default_vocabulary(), cache=60)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


TEXTS = [
    None,
    "",
    " ",
    "a",
    "word, word. word! word?! it's they'll x,y 3.14 a,",
    "line\nnext line.\nlast",
    "line\n\nnext",
    " lead",
    "trail ",
    "two  blanks",
    "tab\tnbsp\xa0x　y",
    "a \nb",
    "a\n b",
    "<|endoftext|> not special",
    "naïve café, ñandú. Straße; 日本語 テスト 🙂",
    "nul\x00byte",
    "ʰa, ªb. ²c! ①d",
    "word " * 4000 + "end",
]


def test_encoder_cuts():
    assert ENCODER.cuts


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("abÉß ,.!'\n\t12;:　\x85²ʰ"), max_size=30) | st.text(max_size=30))
def test_ids_are_the_librarys(text):
    text = text.encode("utf-8", "ignore").decode()
    both = ENCODER.encode(pa.array([text, "next one", text]))
    assert both[0].tolist() == both[2].tolist() == ids_of(text) and both[1].tolist() == ids_of("next one")


def grammar(seed, n=6000, symbols=12):
    rng = random.Random(seed)
    texts = []
    while sum(map(len, texts)) < n:
        texts.append(np.array([min(int(rng.expovariate(0.5)), symbols - 1) for _ in range(rng.randrange(0, 90))] + [0], np.uint16))
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_pairs_are_replaced_and_expand_again(seed):
    texts = grammar(seed)
    flat = np.concatenate(texts)
    seq, bounds, rules = compress(flat, np.cumsum([len(t) for t in texts]), 12)
    assert rules and len(seq) < 0.7 * len(flat)
    lengths = expansion_lengths(np.array(rules), 12)
    assert lengths[seq].sum() == len(flat)
    shard = Shard(pack_shard(list(range(len(texts))), texts, 12))
    rng = random.Random(seed)
    for k, t in enumerate(texts):
        assert shard.document(k).tolist() == t.tolist()
        a = rng.randrange(0, len(t))
        b = rng.randrange(a, len(t)) + 1
        assert shard.decode_range(k, a, b).tolist() == t[a:b].tolist()


def test_first_round_replaces_the_most_frequent_pair():
    texts = [np.array([5, 6] * 2 * MIN_COUNT + [0], np.uint16)]
    seq, bounds, rules = compress(texts[0], np.array([len(texts[0])]), 10, rounds=1)
    assert rules == [(5, 6)] and seq.tolist() == [10] * 2 * MIN_COUNT + [0] and bounds.tolist() == [0, len(seq)]


def test_runs_of_one_symbol_and_short_documents():
    texts = [np.array([7] * 50 + [0], np.uint16), np.array([0], np.uint16), np.array([0], np.uint16)]
    shard = Shard(pack_shard([None, 2, 2], texts, 8))
    assert [shard.document(k).tolist() for k in range(3)] == [t.tolist() for t in texts]
    assert shard.ids == [None, 2, 2]


def brute(rows):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(ids_of(t) + [0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_round_trip_of_documents(spark, docs_of, tmp_path):
    rng = random.Random(7)
    rows = list(enumerate(TEXTS)) + [(100 + i, TEXTS[4]) for i in range(30)]
    rows += [(None, "no id"), (100, TEXTS[4])]
    rng.shuffle(rows)
    docs = docs_of([(*r, None, None, None, 1) for r in rows],
                   "doc_id long, text string, lang string, source string, n_chars long, part int")
    got = sorted(map(tuple, token_shards(docs.repartition(5), shard_ids=200).collect()), key=lambda r: r[1])
    assert got == brute(rows)
    path = str(tmp_path / "shards")
    write_shards(docs, path, shard_ids=500)
    assert sorted(map(tuple, read_shards(spark, path).collect()), key=lambda r: r[1]) == got
    assert spark.read.parquet(path).count() > 1
    assert token_shards(docs.limit(0)).count() == 0


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = sorted(map(tuple, token_shards(docs).collect()), key=lambda r: r[1])
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])


def pair_counts(seq, bounds):
    """Non-overlapping occurrences of every pair inside documents."""
    found = {}
    for a, b in zip(bounds, bounds[1:], strict=False):
        last = {}
        for i in range(a, b - 1):
            p = (int(seq[i]), int(seq[i + 1]))
            if last.get(p, -2) != i - 1 or p[0] != p[1]:
                found[p] = found.get(p, 0) + 1
                last[p] = i
    return found


def naive(texts, first):
    """Re-Pair one pair at a time, counts renewed each time."""
    docs, rules = [t.tolist() for t in texts], []
    while True:
        flat, bounds = [x for d in docs for x in d], np.cumsum([0, *map(len, docs)])
        counts = pair_counts(flat, bounds)
        best = max(counts.items(), key=lambda x: (x[1], x[0]), default=(None, 0))
        if best[1] < MIN_COUNT:
            return sum(map(len, docs)), rules
        rules.append(best[0])
        for k, d in enumerate(docs):
            out, i = [], 0
            while i < len(d):
                hit = tuple(d[i : i + 2]) == best[0]
                out.append(first + len(rules) - 1 if hit else d[i])
                i += 1 + hit
            docs[k] = out


@pytest.mark.parametrize("seed", [1, 5])
def test_no_frequent_pair_is_left_and_sizes_are_those_of_naive_re_pair(seed):
    texts = grammar(seed)
    texts += [np.array([3] * n + [0], np.uint16) for n in (1, 2, 3, 8, 97)]
    seq, bounds, rules = compress(np.concatenate(texts), np.cumsum([len(t) for t in texts]), 12)
    assert max(pair_counts(seq.tolist(), bounds.tolist()).values()) < MIN_COUNT
    size, own = naive(texts, 12)
    assert len(seq) + 2 * len(rules) <= 1.03 * (size + 2 * len(own))
    assert rules[0] == own[0]


def test_a_run_of_one_id_becomes_few_symbols():
    texts = [np.array([7] * 5000 + [0], np.uint16), np.array([7] * 4999 + [0], np.uint16)]
    seq, bounds, rules = compress(np.concatenate(texts), np.cumsum([len(t) for t in texts]), 8)
    assert len(seq) < 2 * MIN_COUNT + 40 and 8 <= len(rules) <= 20
    shard = Shard(pack_shard([0, 1], texts, 8))
    assert [shard.document(k).tolist() for k in range(2)] == [t.tolist() for t in texts]
