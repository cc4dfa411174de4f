from __future__ import annotations

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from kinscore.llm.source_mixing import _hypergeometric, mix_sources, plan_mix, splitting_tree, targets

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_targets(sizes):
    """Reshare the excess by weight until no target is above three times its size."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    goal, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            goal |= share
            break
        for s in over:
            goal[s] = 3.0 * sizes[s]
            left -= goal[s]
        open_ -= over
    return goal


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 200, "c": 5, None: 10},
        {"src0": 9000, "src1": 10, "src10": 20, "src2": 30, "é": 4, "": 50},
        {"only": 7},
        {"x": 0, "y": 0, None: 0},
        {"x": 0, "y": 9, "z": 1},
        {None: 3},
        {f"s{i}": i * i for i in range(40)},
    ],
)
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in targets(rows).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[s], want[s], rel_tol=1e-9, abs_tol=1e-9) for s in want)


def test_hypergeometric_distribution(spark):
    total, good, draws = 50, 17, 20
    df = spark.range(4000).select(((F.col("id") + 0.5) / 4000).alias("u"))
    got = df.select(_hypergeometric(F.lit(total), F.lit(good), F.lit(draws), F.col("u")).alias("x"))
    seen = {r.x: r["count"] / 4000 for r in got.groupBy("x").count().collect()}
    for x in range(0, 18):
        want = math.comb(good, x) * math.comb(total - good, draws - x) / math.comb(total, draws)
        assert abs(seen.get(x, 0) - want) < 2 / 4000
    edge = [(10, 0, 5), (10, 10, 5), (5, 3, 5), (0, 0, 0), (10**9, 10**8, 5 * 10**8)]
    one = spark.createDataFrame(edge, "n long, k long, m long")
    x = [r[0] for r in one.select(_hypergeometric(F.col("n"), F.col("k"), F.col("m"), F.lit(0.5))).collect()]
    assert x[:4] == [0, 5, 3, 0] and abs(x[4] - 5 * 10**7) < 10**5


def test_tree_splits_quotas_exactly(spark):
    quotas = {0: 1000, 1: 37, 2: 0, 3: 1, 4: 512}
    rows = spark.createDataFrame(list(quotas.items()), "position int, quota long")
    got = splitting_tree(rows, shards=7).collect()
    for p, q in quotas.items():
        assert sum(r.quota for r in got if r.position == p) == q
    per_shard = [sum(r.quota for r in got if r.shard == k) for k in range(7)]
    assert all(r.quota >= 0 for r in got) and max(per_shard) - min(per_shard) <= 3
    assert sorted(map(tuple, got)) == sorted(map(tuple, splitting_tree(rows, shards=7).collect()))


def corpus():
    rng = random.Random(4)
    rows = []
    for i in range(600):
        source = rng.choice(["hot"] * 6 + ["b", "c", "d", None])
        rows.append((i, "w " * rng.randrange(1, 60), "en", source, 1))
    rows += [(600, None, None, "b", None), (601, "", None, "c", None), (None, "a b", None, "d", None)]
    return rows + [rows[0], rows[0], (9999, "long " * 500, None, "tiny", None)]


def test_mix_matches_targets(docs_of):
    rows = corpus()
    docs = docs_of(rows)
    plan = plan_mix(docs, block_words=200, shards=5)
    got = plan.select("doc_id", "source", "__mix.*").collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, _, source, _ in rows:
        sizes[source] = sizes.get(source, 0) + len(WORD.findall(text or ""))
    want = brute_targets(sizes)
    for s in sizes:
        mine = [r for r in got if r.source == s]
        taken = sum(r["size"] * len(r.copies) for r in mine)
        assert all(r.source_size == sizes[s] and math.isclose(r.target, want[s]) for r in mine)
        assert abs(taken - want[s]) <= max(r["size"] for r in mine)
        assert all(len(r.copies) <= 3 and len({c["pass"] for c in r.copies}) == len(r.copies) for r in mine)
        assert all(0 <= c.shard < 5 for r in mine for c in r.copies)
    again = plan_mix(docs.repartition(7), block_words=200, shards=5).select("doc_id", "__mix.*").collect()
    pack = lambda rs: sorted(repr((r.doc_id, r["size"], r.copies)) for r in rs)
    assert pack(again) == pack(got)
    mixed = mix_sources(docs, shards=5, block_words=200)
    assert mixed.schema == docs.schema and mixed.count() == sum(len(r.copies) for r in got)


def shard_words(plan):
    """Words of every (source, shard) of a mix."""
    plan = plan.select("source", "__mix.size", F.explode("__mix.copies.shard").alias("shard"))
    return {(r.source, r.shard): r.words for r in plan.groupBy("source", "shard").agg(F.sum("size").alias("words")).collect()}


def tree_words(spark, sizes, shards):
    """The same out of the tree alone, for sources counted in units of one word."""
    want = brute_targets(sizes)
    names = sorted(sizes)
    rows = spark.createDataFrame([(i, math.floor(want[s] + 1e-9)) for i, s in enumerate(names)], "position int, quota long")
    return {(names[r.position], r.shard): r.quota for r in splitting_tree(rows, shards).collect() if r.quota}


def test_shards_take_the_quotas_of_the_leaves(spark, docs_of):
    sizes = {"s0": 600, "s1": 120, "s2": 180}
    docs = docs_of([(i, "w", None, s, None) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))])
    got = shard_words(plan_mix(docs, block_words=40, shards=8))
    assert got == tree_words(spark, sizes, 8) and len(got) == 24
    other = shard_words(plan_mix(docs, block_words=40, shards=8, seed=9))
    assert other != got and {s: sum(n for (t, _), n in other.items() if t == s) for s in sizes} == {
        s: sum(n for (t, _), n in got.items() if t == s) for s in sizes
    }


def test_only_units_of_a_leaf_are_taken(spark, docs_of, monkeypatch):
    """Without the quotas of some leaves the mix lacks just their documents."""
    from kinscore.llm import source_mixing

    docs = docs_of([(i, "w", None, f"s{i % 3}", None) for i in range(900)])
    whole = shard_words(plan_mix(docs, block_words=40, shards=8))
    monkeypatch.setattr(source_mixing, "splitting_tree", lambda *a, **k: splitting_tree(*a, **k).where("shard < 3"))
    assert shard_words(plan_mix(docs, block_words=40, shards=8)) == {k: n for k, n in whole.items() if k[1] < 3}


def test_tree_over_buckets_of_sources(spark):
    """Buckets split exactly too, and the halves of a quota have the hypergeometric mean."""
    quotas = {i: 40 + i for i in range(60)}
    rows = spark.createDataFrame(list(quotas.items()), "position int, quota long")
    got = splitting_tree(rows, 5, bucket=7).collect()
    for p, q in quotas.items():
        assert sum(r.quota for r in got if r.position == p) == q
    per_shard = [sum(r.quota for r in got if r.shard == k) for k in range(5)]
    assert all(r.quota >= 0 for r in got) and max(per_shard) - min(per_shard) <= 3
    half = [
        [r.quota for r in splitting_tree(rows, 2, seed, bucket=7).collect() if (r.shard, r.position) == (0, 20)][0]
        for seed in range(4)
    ]
    assert len(set(half)) > 1 and abs(sum(half) / 4 - 30) < 9


def test_one_partition_a_shard(docs_of):
    docs = docs_of([(i, "w " * (1 + i % 9), None, f"s{i % 4}", None) for i in range(400)])
    plan = plan_mix(docs, shards=6).select(F.explode("__mix.copies.shard").alias("s")).groupBy("s").count().collect()
    sizes = mix_sources(docs, shards=6).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert {r.p: r["count"] for r in sizes} == {r.s: r["count"] for r in plan} and len(sizes) == 6


def test_repeated_id_and_names_with_dots(docs_of):
    schema = "doc_id long, text string, source string, `meta.k` string, `Block` int"
    rows = [(7, f"a{i % 40} " * (i % 13), "hot", "m", i) for i in range(300)] + [(i, "b c", "s", None, i) for i in range(99)]
    docs = docs_of(rows, schema)
    plan = plan_mix(docs, block_words=50, shards=3)
    assert plan.count() == len(rows) and plan.columns == [*docs.columns, "__mix"]
    got = plan.groupBy("source").agg(F.sum(F.col("__mix.size") * F.size("__mix.copies")).alias("n"), F.max("__mix.target").alias("t"))
    assert all(abs(r.n - r.t) <= 13 for r in got.collect())
    assert mix_sources(docs, shards=3).schema == docs.schema


def test_edges(docs_of):
    assert plan_mix(docs_of([])).count() == 0
    blank = plan_mix(docs_of([(1, None), (2, "")])).select("__mix.*").collect()
    assert [r.target for r in blank] == [0.0, 0.0] and all(r["size"] == 0 for r in blank)
    schema = "doc_id long, text string, source string, target string, block string, position int"
    docs = docs_of([(1, "a b", "s", "t", "b", 5)], schema)
    out = mix_sources(docs)
    assert out.schema == docs.schema and out.first().target == "t"


def test_main_path_is_native(docs_of):
    plan = plan_mix(docs_of(corpus()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
