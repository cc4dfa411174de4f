from __future__ import annotations

import random
import re

import pytest

from kinscore.llm.wu_manber import Patterns, decontaminate, spaced, uncontaminated, words_of

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = {c: c + 32 for c in range(65, 91)}


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(text, items, window):
    """n_words, n_hit, items from the definitions."""
    own, hit, found = words(text), set(), set()
    for item, t in items:
        w = words(t)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            for j in range(len(own) - n + 1):
                if own[j : j + n] == w[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add("" if item is None else str(item))
    return len(own), len(hit), sorted(found)


def spans(n_hit, flat):
    assert flat == sorted(flat) and sum(b - a for a, b in zip(flat[::2], flat[1::2], strict=True)) == n_hit


def check(found, texts, items, window):
    rows = {r.doc_id: r for r in found.collect()}
    assert len(rows) == len(texts)
    for i, t in enumerate(texts):
        r = rows[i]
        assert (r.n_words, r.n_hit, r["items"]) == brute(t, items, window), t
        spans(r.n_hit, r.spans)


@pytest.fixture(scope="module")
def corpus():
    r = random.Random(4)
    some = ["a", "b", "ab", "Ünder", "日本", "x1", "the"]
    texts = [" ".join(r.choices(some, k=r.randrange(60))) for _ in range(80)]
    items = [(i, " ".join(r.choices(some, k=k))) for i, k in enumerate([0, 1, 2, 3, 4, 5, 7, 12, 30, 30])]
    items += [(7, items[8][1]), (None, texts[3] + " tail"), (99, "A, b; AB"), (100, None), (101, ""), (102, "...")]
    texts += [None, "", "--- !", "a", items[8][1].upper(), "x\x00" + items[9][1].replace(" ", "\n--"), items[8][1] * 3]
    return texts, items


@pytest.mark.parametrize(("window", "block"), [(4, 8 << 20), (10, 8 << 20), (3, 250), (10, 400)])
def test_brute_force_with_one_and_many_blocks(spark, docs_of, corpus, window, block):
    texts, items = corpus
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate(docs_of(list(enumerate(texts))), bench, window=window, block_bytes=block)
    check(found, texts, items, window)


def test_patterns_of_every_length_and_long_shifts():
    r = random.Random(1)
    vocab = [f"{r.choice('xyz')}word{i}" * r.randrange(1, 4) for i in range(60)]
    own = [" ".join(r.choices(vocab, k=400)) for _ in range(6)]
    items = [(str(i), " ".join(own[i].split()[s : s + n])) for i, s, n in [(0, 3, 10), (1, 380, 20), (2, 0, 1), (3, 50, 9), (4, 0, 400)]]
    p = Patterns([(i, spaced(words_of(t.encode()))) for i, t in items], 10)
    hits = p.find([spaced(words_of(t.encode())) for t in own])
    for d, t in enumerate(own):
        _, n_hit, found = brute(t, items, 10)
        mine = [h for h in hits if h[0] == d]
        assert len({j for _, a, b, _ in mine for j in range(a, b)}) == n_hit
        assert sorted({p.items[i] for *_, i in mine}) == found
    assert len(p.levels) >= 2 and max(level.m for level in p.levels) >= 24


def test_hot_passage_and_equal_prefixes():
    """Thousands of patterns in one bucket: they differ behind their first bytes only."""
    items = [(str(i), f"which of the following words is the odd one {i}") for i in range(3000)]
    p = Patterns([(i, spaced(words_of(t.encode()))) for i, t in items], 10)
    texts = [f"so {t} then" for _, t in items[::7]] * 3
    hits = p.find([spaced(words_of(t.encode())) for t in texts])
    assert len(hits) == len(texts)
    assert {p.items[i] for *_, i in hits} == {i for i, _ in items[::7]}


def test_empty_tables_clashing_and_odd_columns(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    bench = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "say one TWO three now", "m", 5), (2, "clean", "m", 6)], ["doc_id", "text", "meta.k", "N_WORDS"])
    assert [r.n_hit for r in decontaminate(docs, none).collect()] == [0, 0]
    assert decontaminate(docs.limit(0), bench).count() == 0
    found = decontaminate(docs, bench)
    assert found.columns == ["doc_id", "text", "meta.k", "n_words", "n_hit", "spans", "items"]
    first = found.where("doc_id = 1").first()
    assert (first.n_words, first.n_hit, first.spans, first["items"]) == (5, 3, [1, 4], ["1"])
    kept = uncontaminated(docs, bench)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "clean", "m", 6)]


def test_very_long_text(spark, docs_of):
    long = " ".join(f"w{i}" for i in range(200_000))
    bench = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(99_000, 99_040))), (2, "w7 w9")], "item_id long, text string")
    r = decontaminate(docs_of([(0, long)]), bench).first()
    assert (r.n_words, r.n_hit, r["items"]) == (200_000, 40, ["1"])
