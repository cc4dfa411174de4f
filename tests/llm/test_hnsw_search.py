from __future__ import annotations

import numpy as np
import pytest

from kinscore.llm.hnsw_search import EF_SEARCH, SHARD_ROWS, TARGET_RECALL, build_graph, fitted_beam, nearest, search_graph

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, v int, shard int"


def clustered(n, dim, seed, normed=True):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    v = centres[rng.integers(0, 12, n)] + 0.6 * rng.normal(size=(n, dim))
    if normed:
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    return v


@pytest.mark.parametrize("normed", [True, False])
def test_recall_of_one_graph(normed):
    v = clustered(3150, 24, 1, normed)
    v, q = v[:3000], v[3000:]
    layers = build_graph(v)
    assert sorted(layers[-1][0].tolist()) == list(range(3000))  # every node is indexed
    exact = np.argsort(-(q @ v.T), axis=1)[:, :20]
    score, found = search_graph(v, layers, q, 20)
    assert np.mean([len({*a} & {*b}) / 20 for a, b in zip(exact, found, strict=True)]) >= 0.9
    assert np.allclose(score, np.take_along_axis(q @ v.T, found, 1)) and (np.diff(score, axis=1) <= 0).all()


def test_beam_follows_the_recall_measured_on_vectors_of_all_lengths():
    """One shard of production size, normal components, lengths as they come: a fixed beam finds 0.8."""
    rng = np.random.default_rng(2)
    v, sample = rng.normal(size=(SHARD_ROWS, 64)), rng.normal(size=(64, 64))
    q = v[::20]
    layers = build_graph(v)
    beam, measured = fitted_beam(v, layers, sample, 21, EF_SEARCH, TARGET_RECALL)
    assert beam > EF_SEARCH and measured >= TARGET_RECALL
    exact = np.argsort(-(q @ v.T), axis=1)[:, :21]
    _, found = search_graph(v, layers, q, 21, beam)
    assert np.mean([len({*a} & {*b}) / 21 for a, b in zip(exact, found, strict=True)]) >= 0.93
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    assert fitted_beam(unit[:3000], build_graph(unit[:3000]), sample[:1], 21, 3000, 0.5)[1] == 1.0  # searched whole


def brute(rows, k):
    good = []
    for r in rows:
        if r[0] is None or r[1] is None or any(x is None or not np.isfinite(x) for x in r[1]) or not any(r[1]):
            continue
        good.append((r[0], np.asarray(r[1], np.float32).astype(np.float64)))
    out = {}
    for q, v in good:
        if q is not None and q % 20 == 0:
            near = [(-float(v @ w), i is None, i or 0) for i, w in good if i != q]
            out[q] = [(None if null else i, -s) for s, null, i in sorted(near)[:k]]
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 0, "x", 1, 2) for r in rows], SCHEMA)
    got = {}
    for r in nearest(df, df.where("vec_id % 20 = 0"), **kw).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: sorted(v) for q, v in got.items()}


def test_edges_and_ties_match_brute_force(spark):
    v = clustered(90, 6, 3, normed=False).astype(np.float32).tolist()
    rows = [(i, x) for i, x in enumerate(v)]
    rows += [(1000 + i, v[3]) for i in range(300)]  # a large class of equal vectors
    rows += [(2000, v[3]), (3000, None), (3001, [0.0] * 6), (3020, [1.0, None, 0.0, 0.0, 0.0, 0.0])]
    rows += [(3040, [float("nan")] * 6), (3060, [float("inf")] + [0.0] * 5), (None, v[5]), (40, v[40])]
    got, want = run(spark, rows), brute(rows[:-1], 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [x[1] for x in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([x[2] for x in got[q]], [s for _, s in want[q]], rtol=1e-12)
        assert [x[0] for x in got[q]] == list(range(1, len(got[q]) + 1))


def test_recall_over_shards(spark):
    v = clustered(2400, 16, 4).astype(np.float32).tolist()
    rows = list(enumerate(v))
    got, want = run(spark, rows, shard_rows=700), brute(rows, 20)
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    hits = [len({i for _, i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.9


def test_few_candidates_and_empty_tables(spark):
    got = run(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, [1.0, 1.0]), (5, [1.0, 1.0, 1.0])])
    assert [x[1] for x in got[0]] == [1, 20] and [x[1] for x in got[20]] == [0, 1]
    assert run(spark, [(0, [1.0, 2.0])]) == {} and run(spark, []) == {}


def test_every_length_is_searched_by_itself(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=3 + i % 3).astype(np.float32).tolist()) for i in range(400)]
    got, want = run(spark, rows, shard_rows=60), {}
    for d in (3, 4, 5):
        want |= brute([r for r in rows if len(r[1]) == d], 20)
    assert got.keys() == want.keys() and all([x[1] for x in got[q]] == [i for i, _ in want[q]] for q in want)
