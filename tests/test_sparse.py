"""Sparse features: dictionary ranks, vectors, moments and models without a column per value."""

from __future__ import annotations

import math
import statistics

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from kinscore.operators import logistic as L
from kinscore.operators import models as M
from kinscore.operators.sparse import rank_features, sparse_dataset

USERS = "user_id long, external_id long, is_asd double, was_asd double, asd_others double, f_one double, f_two double"
COUNTS = "user_id long, family int, value string, feature string, cnt double"
FIXED = ["f_one", "f_two"]


def small(spark):
    users = [(i, 100 + i, float(i % 2), 0.0, 0.0, float(i), -0.5 if i == 3 else 0.0) for i in range(6)]
    counts = [(1, 1, "B", "p1_b", 2.0), (1, 1, "A", "p1_a", 1.0), (2, 3, "go", "go_csf", 7.0), (5, 2, "B", "p2_b", 9.0), (5, 1, "B", "p1_b", 4.0), (99, 1, "Z", "p1_z", 1.0)]
    return sparse_dataset(spark.createDataFrame(users, USERS), FIXED, spark.createDataFrame(counts, COUNTS))


def test_dictionary_vectors_and_moments(spark):
    ds = small(spark)
    names = [r.feature for r in ds.dictionary.orderBy("index").collect()]
    assert names == ["f_one", "f_two", "p1_a", "p1_b", "p1_z", "p2_b", "go_csf"]
    assert [r["index"] for r in ds.dictionary.orderBy("index").collect()] == list(range(7))
    assert (ds.n_users, ds.n_features) == (6, 7)
    vectors = {r.user_id: (r.indices, r["values"]) for r in ds.vectors().collect()}
    assert vectors == {
        1: ([0, 2, 3], [1.0, 1.0, 2.0]), 2: ([0, 6], [2.0, 7.0]), 3: ([0, 1], [3.0, -0.5]), 4: ([0], [4.0]), 5: ([0, 3, 5], [5.0, 4.0, 9.0]),
    }
    dense = np.zeros((6, 7))
    for u, (i, v) in vectors.items():
        dense[u, i] = v
    for r in ds.moments().collect():
        own = dense[:, r["index"]].tolist()
        assert r["mean"] == pytest.approx(statistics.fmean(own)) and r["std"] == pytest.approx(statistics.pstdev(own))
    logged = {(r.user_id, r["index"]): r["value"] for r in ds.logged().entries.collect()}
    assert logged[5, 5] == pytest.approx(1.0) and logged[3, 1] == pytest.approx(math.log10(0.5))


def test_colliding_and_empty_names_fail(spark):
    users = spark.createDataFrame([(1, 1, 0.0, 0.0, 0.0, 0.0, 0.0)], USERS)
    for bad in (
        [(1, 1, "a b", "p1_ab", 1.0), (1, 1, "a-b", "p1_ab", 1.0)],
        [(1, 1, "x", "same", 1.0), (1, 2, "x", "same", 1.0)],
        [(1, 1, "x", "f_one", 1.0)],
        [(1, 1, "!", "", 1.0)],
    ):
        with pytest.raises(ValueError, match="not unique"):
            sparse_dataset(users, FIXED, spark.createDataFrame(bad, COUNTS))


def test_empty_counts_and_users(spark):
    none = spark.createDataFrame([], COUNTS)
    ds = sparse_dataset(spark.createDataFrame([], USERS), FIXED, none)
    assert (ds.n_users, ds.n_features, ds.vectors().count()) == (0, 2, 0)
    assert {(r["mean"], r["std"]) for r in ds.moments().collect()} == {(0.0, 0.0)}


def test_a_hundred_thousand_values_and_a_model_of_them(spark):
    """No column, no driver list; the fit finds the two values that matter."""
    n = 100_000
    counts = spark.range(n).selectExpr(
        "id % 3000 as user_id", "1 as family", "concat('v', id) as value", "concat('p1_v', id) as feature", "1.0D as cnt"
    )
    marks = spark.range(3000).where("id % 3 = 0").selectExpr("id", "3", "'m'", "'mark_csf'", "5.0D")
    users = spark.range(3000).selectExpr("id as user_id", "id as external_id", "cast(id % 3 = 0 and id % 30 != 0 as double) as is_asd", "0.0D as was_asd", "0.0D as asd_others", "0.0D as f_one", "0.0D as f_two")
    ds = sparse_dataset(users, FIXED, counts.union(marks))
    assert ds.n_features == n + 3
    index = ds.dictionary.selectExpr("min(index)", "max(index)", "count(distinct index)").first()
    assert tuple(index) == (0, n + 2, n + 3)
    by_name = ds.dictionary.where("family = 1").orderBy("feature").select("index").limit(500).collect()
    assert [r["index"] for r in by_name] == list(range(2, 502))
    rows = ds.users.selectExpr("user_id", "is_asd as label").join(ds.vectors(), "user_id")
    train = M.add_split_columns(rows, "user_id", 1, 3)
    packed = L.pack(train, n_features=ds.n_features)
    fit = L.fit_many(packed, [L.Problem(0.2, 1.0, 1.0, "fold", 9, False)])[0]
    assert fit.kkt <= 1e-6 and np.flatnonzero(fit.coefficients).tolist() == [n + 2] and fit.coefficients[-1] > 0


def test_sparse_and_dense_rows_give_the_same_fits(spark):
    r = np.random.default_rng(5)
    x = np.where(r.random((200, 6)) < 0.4, r.normal(size=(200, 6)), 0.0)
    y = (x[:, 0] - x[:, 3] + r.normal(size=200) > 0).astype(float)
    dense, sparse = [], []
    for i in range(200):
        at = np.flatnonzero(x[i]).tolist()
        dense.append((i, y[i].item(), i % 3, i % 2, Vectors.dense(x[i].tolist())))
        sparse.append((i, y[i].item(), i % 3, i % 2, at, x[i, at].tolist()))
    head = "user_id long, label double, fold int, half int"
    p = [L.Problem(c, 1.0, 1.0, "half", h, True) for c in (0.3, 2.0) for h in (0, 1)]
    one = L.fit_many(L.pack(spark.createDataFrame(dense, ["user_id", "label", "fold", "half", "features"])), p)
    two = L.fit_many(L.pack(spark.createDataFrame(sparse, head + ", indices array<int>, `values` array<double>"), n_features=6), p)
    for a, b in zip(one, two, strict=True):
        assert np.allclose(a.coefficients, b.coefficients, atol=1e-9) and a.intercept == pytest.approx(b.intercept)
    with pytest.raises(ValueError, match="n_features"):
        L.pack(spark.createDataFrame(sparse, head + ", indices array<int>, `values` array<double>"))


def test_ranks_follow_family_place_and_name(spark):
    names = [(1, 0, f"n{i:05d}") for i in range(3000)] + [(0, 1, "a"), (0, 0, "z"), (2, 0, "n00000"), (1, 0, "n00007")]
    got = rank_features(spark.createDataFrame(names, "family int, place int, feature string").repartition(7)).collect()
    want = {k: i for i, k in enumerate(sorted(set(names)))}
    assert {(r.family, r.place, r.feature): r["index"] for r in got} == want
