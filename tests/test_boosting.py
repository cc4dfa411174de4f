"""Second-order trees against a plain numpy version of the same rules."""

from __future__ import annotations

import numpy as np
import pytest

from kinscore.operators import boosting as B

HEAD = "user_id long, label double, half int, fold int, indices array<int>, `values` array<double>"


def frame(spark, x, y):
    rows = []
    for i, v in enumerate(x):
        at = np.flatnonzero(v).tolist()
        label = None if np.isnan(y[i]) else float(y[i])
        rows.append((i, label, i % 2, i % 3, at, v[at].tolist()))
    return spark.createDataFrame(rows, HEAD).repartition(5)


def plain_bins(x, bins):
    """Dense bins by counting, value by value."""
    out = np.zeros(x.shape, int)
    for j in range(x.shape[1]):
        level = np.floor(x[:, j] * 1024)
        own = x[:, j] != 0
        for i in range(len(x)):
            if own[i]:
                out[i, j] = int((level[own] < level[i]).sum()) * bins // own.sum() + (2 if x[i, j] > 0 else 0)
            else:
                out[i, j] = int((x[:, j] < 0).sum()) * bins // max(1, own.sum()) + 1
    return out


def plain_tree(b, g, h, p):
    """{node: (feature, cut, gain)} and each row's leaf weight, by trying every split of every node."""
    score = lambda a, c: max(abs(a) - p.l1, 0) ** 2 / (c + p.l2)
    leaf = lambda a, c: -p.learning_rate * np.sign(a) * max(abs(a) - p.l1, 0) / (c + p.l2)
    splits, weight, todo = {}, np.zeros(len(b)), [(1, np.arange(len(b)), 0)]
    while todo:
        node, rows, level = todo.pop()
        weight[rows] = leaf(g[rows].sum(), h[rows].sum())
        best = None
        for j in range(b.shape[1]) if level < p.depth else ():
            for c in sorted(set(b[rows, j]))[:-1]:
                left = rows[b[rows, j] <= c]
                gl, hl = g[left].sum(), h[left].sum()
                gr, hr = g[rows].sum() - gl, h[rows].sum() - hl
                if min(hl, hr) >= p.min_hessian:
                    gain = score(gl, hl) + score(gr, hr) - score(g[rows].sum(), h[rows].sum())
                    if gain > B.LEAST_GAIN and (best is None or gain > best[0] + 1e-12):
                        best = (gain, j, c)
        if best:
            gain, j, c = best
            splits[node] = (j, c, gain)
            todo += [(2 * node, rows[b[rows, j] <= c], level + 1), (2 * node + 1, rows[b[rows, j] > c], level + 1)]
    return splits, weight


def data(n=160, seed=4):
    r = np.random.default_rng(seed)
    x = np.where(r.random((n, 5)) < 0.6, r.normal(size=(n, 5)), 0.0)
    x[:, 3] = np.where(r.random(n) < 0.5, 0.0, 1.0)
    y = (x[:, 0] + x[:, 3] - 0.7 * x[:, 1] + r.normal(size=n) * 0.5 > 0.4).astype(float)
    return x, y


P = B.TreeParams(rounds=3, depth=4, subsample=1.0, columns=1.0, min_hessian=2.0, bins=12)


def test_bins_and_trees_equal_the_plain_version(spark):
    x, y = data()
    binned = B.bin_rows(frame(spark, x, y), P)
    want = plain_bins(x, P.bins)
    zero = {r["index"]: r.zero for r in binned.zeros.collect()}
    for r in binned.rows.collect():
        own = dict(zip(r.indices, r.bins, strict=True))
        assert [own.get(j, zero[j]) for j in range(5)] == want[r.user_id].tolist()
    parts = [B.Part(), B.Part("half", 0), B.Part("fold", 1, False)]
    got = B.fit_trees(binned, parts, P)
    margins = {r.user_id: r.margins for r in got.rows.collect()}
    member = [np.ones(len(x), bool), np.arange(len(x)) % 2 == 0, np.arange(len(x)) % 3 != 1]
    for k, own in enumerate(member):
        m = np.zeros(own.sum())
        for t in range(P.rounds):
            prob = 1 / (1 + np.exp(-m))
            splits, weight = plain_tree(want[own], prob - y[own], prob * (1 - prob), P)
            found = {s[2]: s[3:6] for s in got.splits if s[:2] == (k, t)}
            assert {n: f[:2] for n, f in found.items()} == {n: (j, int(c)) for n, (j, c, _) in splits.items()}
            assert all(found[n][2] == pytest.approx(s[2]) for n, s in splits.items())
            m += weight
        assert [margins[i][k] for i in np.flatnonzero(own)] == pytest.approx(m.tolist())


def test_least_hessian_and_l1(spark):
    x, y = data()
    binned = B.bin_rows(frame(spark, x, y), P)
    heavy = B.TreeParams(rounds=1, depth=4, subsample=1.0, columns=1.0, min_hessian=15.0, bins=12)
    assert all(min(s[7], s[9]) >= 15.0 for s in B.fit_trees(binned, [B.Part()], heavy).splits)
    strict = B.TreeParams(rounds=1, depth=4, subsample=1.0, columns=1.0, l1=1000.0, bins=12)
    none = B.fit_trees(binned, [B.Part()], strict)
    assert none.splits == [] and {tuple(r.margins) for r in none.rows.collect()} == {(0.0,)}


def test_samples_repeat_and_differ_by_tree(spark):
    x, y = data(400)
    p = B.TreeParams(rounds=2, depth=2, min_hessian=2.0, bins=12)
    binned = B.bin_rows(frame(spark, x, y), p)
    one, two = B.fit_trees(binned, [B.Part()], p), B.fit_trees(binned, [B.Part()], p)
    assert [s[:5] for s in one.splits] == [s[:5] for s in two.splits]
    rows = binned.rows.select("*", B.F.array(B.F.lit(0.0)).alias("margins"))
    sizes = [B.gradients(rows, [B.Part()], [B.Tree()], p, t, 0).count() for t in (0, 1)]
    assert all(230 < n < 330 for n in sizes)


def test_cross_fit_scores_unseen_rows(spark):
    x, y = data(400)
    p = B.TreeParams(rounds=5, depth=3, min_hessian=2.0, learning_rate=0.3)
    scores, halves, folds = B.cross_fit_trees(B.bin_rows(frame(spark, x, y), p), p, 3, "xgb_score")
    assert scores.count() == 400 and scores.where("xgb_score between 0 and 1").count() == 400
    assert min(halves) > 0.5 and len(folds) == 3 and min(folds) > 0.5


def test_empty_tables_null_labels_and_no_features(spark):
    p = B.TreeParams(rounds=1, depth=2, min_hessian=0.5, subsample=1.0, columns=1.0)
    empty = B.bin_rows(spark.createDataFrame([], HEAD), p)
    assert B.fit_trees(empty, [B.Part()], p).rows.count() == 0
    bare = spark.createDataFrame([(i, 1.0, 0, 0, [], []) for i in range(8)], HEAD)
    got = B.fit_trees(B.bin_rows(bare, p), [B.Part()], p)
    assert got.splits == [] and {r.margins[0] > 0 for r in got.rows.collect()} == {True}
    x, y = data(60)
    known = B.fit_trees(B.bin_rows(frame(spark, x, y), p), [B.Part()], p)
    more = np.vstack([x, x[:5]])
    unknown = B.fit_trees(B.bin_rows(frame(spark, more, np.r_[y, [np.nan] * 5]), B.TreeParams(**vars(p))), [B.Part()], p)
    assert unknown.rows.where("label is null").count() == 5 and unknown.rows.where("margins[0] is null").count() == 0
    assert len(known.splits) > 0


def test_the_job_reads_dense_vectors(spark):
    """``tree_engine="second_order"``: the training frame's vectors give the same fits as sparse rows."""
    from pyspark.ml.linalg import Vectors

    from kinscore.config import driver_config
    from kinscore.plans.recommend import second_order_scores

    x, y = data(200)
    rows = [(i, float(y[i]), i % 2, i % 3, Vectors.dense(v.tolist())) for i, v in enumerate(x)]
    small = {"rounds": 2, "depth": 2, "min_hessian": 2.0, "learning_rate": 0.3}
    cfg = driver_config(tree_engine="second_order", tree_params=small)
    folds, fit = second_order_scores(spark.createDataFrame(rows, ["user_id", "label", "half", "fold", "features"]), cfg)
    p = B.TreeParams(**small, seed=cfg.seed)
    want, halves, want_folds = B.cross_fit_trees(B.bin_rows(frame(spark, x, y), p), p, cfg.cv_folds, "xgb_score")
    got = {r.user_id: r.xgb_score for r in fit.scores.collect()}
    assert len(got) == 200 and got == pytest.approx({r.user_id: r.xgb_score for r in want.collect()})
    assert folds == want_folds and [fit.f1_first, fit.f1_second] == halves
