from __future__ import annotations

import hashlib
import random
import re

import pytest

from kinscore.llm.substring_dedup import KEY_BYTES, duplicate_windows, factor_bits, substring_dedup, without_repeats

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(rows, size=13):
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    low = {}
    for i, w in texts:
        for a in range(len(w) - size + 1):
            key = tuple(w[a : a + size])
            if i is not None:
                low[key] = min(i, low.get(key, i))
    out = []
    for i, w in texts:
        gone = set()
        for a in range(len(w) - size + 1):
            if i is not None and low[tuple(w[a : a + size])] < i:
                gone |= set(range(a, a + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]

    def fresh(k):
        return [rng.choice(vocab) for _ in range(k)]

    passage, other, common = fresh(50), fresh(30), fresh(6)
    rows = []
    for i in range(n):
        w = fresh(rng.randrange(5, 90))
        if i % 2:
            w[3:3] = passage if i % 4 == 1 else passage[5:40]
        if i % 3 == 0:
            w += other[: rng.randrange(10, 30)] + common
        if i % 7 == 0:
            w += other + passage[10:23] + other[4:20]  # factors that meet
        if i % 11 == 0:
            w = w + w  # repeats inside one document
        rows.append((rng.randrange(10**6), " ".join(w)))
    rows += [(10**6 + i, rows[i % 5][1]) for i in range(20)]
    rows += [(-1, " \n" + "a " * 40), (-2, None), (-3, ""), (-4, "a " * 12), (-5, "a " * 13), (None, rows[0][1])]
    rows += [rows[0], rows[1], (rows[2][0], rows[3][1])]
    return rows


@pytest.mark.parametrize(("seed", "crowd", "part_rows"), [(1, 16, 16_384), (2, 2, 16), (1, 10**9, 3), (2, 4, 2)])
def test_matches_brute_force(docs_of, seed, crowd, part_rows):
    """Blocks whole, dealt to parts, and cut while they stream."""
    rows = corpus(seed)
    got = substring_dedup(docs_of(rows), look=1, crowd=crowd, part_rows=part_rows).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows)
    for r in got:  # the cleaned text holds exactly the kept words
        assert hashlib.sha256(" ".join(WORD.findall(r.clean_text or "")).encode()).hexdigest() == r.kept_sha256
        assert r.n_removed or r.clean_text == r.text


def test_few_words_in_the_vocabulary(docs_of):
    """Many equal grams and anchors: runs, ties of the anchor hash and self-overlap."""
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 60)))) for i in range(80)]
    got = substring_dedup(docs_of(rows), look=2, crowd=4, part_rows=12).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows)


def test_factors_and_boundaries():
    def pack(text):
        return b"".join(c.encode().ljust(KEY_BYTES) for c in text)

    # letters are windows: 1 has a-h, 2 has p-w; 4 reads both, with windows between them that only
    # 3 has (the seam), so that factors meet without a gap
    rows = [(1, pack("abcdefgh")), (2, pack("pqrstuvw")), (3, pack("ghXpq")), (4, pack("abcdefghXpqrZ")), (4, pack("Zab"))]
    assert factor_bits(rows) == [0, 0, 0b11011, 0b0111111111111, 0b110]


def test_stage_output(docs_of):
    rows = corpus(4)
    docs = docs_of([(*r, None, None, 7, "x") for r in rows],
                   "doc_id long, text string, lang string, source string, n_chars long, n_words string")
    out = without_repeats(docs)
    assert out.schema == docs.schema and out.count() == len(rows)
    assert all(r.n_chars == len(r.text) and r.n_words == "x" for r in out.collect() if r.text is not None)
    assert without_repeats(docs.limit(0)).count() == 0


def test_very_long_text(docs_of):
    long = " ".join(f"word{i}" for i in range(200_000))
    got = {r.doc_id: r.n_removed for r in substring_dedup(docs_of([(1, long), (2, "x " + long)])).collect()}
    assert got == {1: 0, 2: 200_000}


def test_hot_id_and_repeated_rows(docs_of):
    """One id with many rows, equal and different, beside documents that share its passage."""
    rng = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(50, f"{rng.randrange(9)} {passage} {rng.randrange(10**6)}") for _ in range(60)]
    rows += [(50, passage)] * 40 + [(i, f"x{i} {passage} y{i} {passage}") for i in (7, 60, 61)]
    for part_rows in (4, 16_384):
        got = substring_dedup(docs_of(rows), look=1, crowd=2, part_rows=part_rows).collect()
        assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows)


def test_equal_rows_cross_the_exchange_once_a_task(docs_of):
    rows = [(1, " ".join(f"w{i}" for i in range(40)))] * 200 + [(2, " ".join(f"w{i}" for i in range(40)))]
    found = duplicate_windows(docs_of(rows).coalesce(1)).groupBy("doc_id").count().collect()
    assert [(r.doc_id, r["count"] < 40) for r in found] == [(2, True)]


def test_one_anchor_many_times_in_a_text(docs_of):
    """A common line that documents repeat is dealt to parts inside one document, too."""
    line = " ".join(f"l{i}" for i in range(16))
    rows = [(i, f"a{i} " + f"{line} " * 90 + f"b{i} {line}") for i in range(4)]
    got = substring_dedup(docs_of(rows), look=1, crowd=2, part_rows=40).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute(rows)
