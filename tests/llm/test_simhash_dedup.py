from __future__ import annotations

import random
import re

import pytest
import xxhash

from kinscore.llm.components import components
from kinscore.llm.simhash_dedup import fingerprint, first_of_group, links_between, simhash_components


def brute_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", lower)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, links):
    root = {v: v for v in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {v: find(v) for v in values}


TEXTS = ["", None, "  \n", "One", "one two", "ONE two  three", "Ä Ö é Z a b c", "a b c a b c a b c a b", "x " * 9000]


@pytest.mark.parametrize("text", TEXTS)
def test_fingerprint(text):
    assert fingerprint((text or "").encode()) == brute_fingerprint(text)


def test_xxhash_of_spark_is_the_same_function(spark):
    from pyspark.sql import functions as F

    got = spark.createDataFrame([("one two three",)], "t string").select(F.xxhash64("t")).first()[0]
    assert got % 2**64 == xxhash.xxh64_intdigest(b"one two three", seed=42)


@pytest.mark.parametrize("cell_rows", [4096, 8])
def test_links_lose_no_pair(spark, cell_rows):
    rng = random.Random(5)
    fps = set()
    for _ in range(40):
        f = rng.getrandbits(64)
        fps.add(f)
        for _ in range(6):
            for b in rng.sample(range(64), rng.randint(1, 4)):
                f ^= 1 << b
            fps.add(f)
    dense = rng.getrandbits(64)  # a dense ball: all pairs would be many, the forest is not
    fps |= {dense ^ (1 << a) ^ (1 << b) for a in range(0, 30) for b in range(a)}
    fps = sorted(fps)
    signed = {f: f - 2**64 if f >= 2**63 else f for f in fps}
    nodes = spark.createDataFrame([(signed[f],) for f in fps], "fp long")
    links = links_between(nodes, cell_rows=cell_rows)
    got = {r.node: r.root for r in components(links).collect()}
    near = [(signed[a], signed[b]) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3]
    want = brute_components(signed.values(), near)
    assert {v: got.get(v, v) for v in signed.values()} == want
    assert len({*want.values()}) < len(fps)


def test_components_on_hubs_chains_and_repeats(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(300)] + [(5, 5), (7, 8), (8, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(300))
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def corpus():
    rng = random.Random(3)
    base = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(200)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i % 3]) for i in range(40)]  # a large group of copies
    rows += [(200 + i, base[4] + f" tail{i}") for i in range(10)]
    rows += [(300, ""), (301, None), (302, " \n"), (None, base[5]), (6, base[6])]
    return rows


def test_components_of_documents(docs_of):
    rows = corpus()
    got = simhash_components(docs_of(rows)).collect()
    fps = {t: brute_fingerprint(t) for _, t in rows}
    values = sorted({*fps.values()})
    near = [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3]
    root = brute_components(values, near)
    low = {}
    for i, t in rows:
        if i is not None:
            low[root[fps[t]]] = min(i, low.get(root[fps[t]], i))
    want = sorted((str(i), f"{fps[t]:016x}", low[root[fps[t]]]) for i, t in rows)
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == want
    kept = [r.doc_id for r in first_of_group(docs_of(rows)).collect()]
    assert sorted(k for k in kept if k is not None) == sorted({*low.values()}) and kept.count(None) == 1


def test_repeated_ids_with_different_texts(docs_of):
    rng = random.Random(4)
    a, b, c = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(200)) for _ in range(3))
    rows = [(1, a, "x"), (1, b, "x"), (2, a, "x"), (3, c, "x"), (4, b, "x"), (5, c, "x"), (3, a, "x"), (3, c, "a"), (3, c, None)]
    for order in (rows, rows[::-1]):
        got = first_of_group(docs_of(order).repartition(3)).select("doc_id", "text", "lang").collect()
        assert sorted((tuple(r) for r in got), key=repr) == sorted([(1, a, "x"), (1, b, "x"), (3, c, None)], key=repr)


def test_empty_table_and_extra_columns(docs_of):
    assert simhash_components(docs_of([])).count() == 0
    docs = docs_of([(1, "a b c", 7, 8)], "doc_id long, text string, fp long, component_id long")
    assert first_of_group(docs).schema == docs.schema and first_of_group(docs).count() == 1
