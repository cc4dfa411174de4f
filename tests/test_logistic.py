"""The batched logistic fits against separate fits, Spark's own solver and the optimality conditions."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from kinscore.operators import logistic as L

C_GRID = (0.1, 1.0, 2.0)
WEIGHTS = ((1.0, 1.0), (10.0, 1.0), (3.0, 0.7))


def frame(spark, x, y, parts=3):
    rows = [(i, float(b), i % 3, i % 2, Vectors.dense(a.tolist())) for i, (a, b) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame(rows, ["user_id", "label", "fold", "half", "features"]).repartition(parts)


def sample(n, d, seed, sparse=0.6):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, d)) * r.choice([0.2, 1.0, 3.0], size=d)
    x[r.random(size=x.shape) < sparse] = 0.0
    beta = np.where(r.random(d) < 0.3, r.normal(size=d), 0.0)
    y = r.random(n) < 1 / (1 + np.exp(-(x @ beta - 1.0)))
    return x, y.astype(float)


def problems(folds=3):
    return [L.Problem(c, *w, "fold", k, False) for c in C_GRID for w in WEIGHTS for k in range(folds)]


def residual(x, y, p, fit, own):
    """The KKT residual from the definition, relative to the penalty."""
    x, y = x[own], y[own]
    w = np.where(y == 1, p.positive, p.negative)
    g = w * (1 / (1 + np.exp(-(x @ fit.coefficients + fit.intercept))) - y)
    slope, b = p.c * (x.T @ g), fit.coefficients
    return max(np.where(b != 0, np.abs(slope + np.sign(b)), np.maximum(np.abs(slope) - 1, 0)).max(), abs(p.c * g.sum()))


@pytest.fixture(scope="module")
def data(spark):
    x, y = sample(500, 12, 1)
    return x, y, frame(spark, x, y)


def test_all_fits_meet_their_optimality_conditions(data):
    x, y, df = data
    rows, every = L.pack(df), problems()
    assert (rows.n_rows, rows.n_features) == (500, 12)
    fits = L.fit_many(rows, every)
    for p, f in zip(every, fits, strict=True):
        own = np.arange(500) % 3 != p.value
        assert f.kkt <= 1e-6 and residual(x, y, p, f, own) == pytest.approx(f.kkt, abs=1e-8)
    # 27 fits share their passes: a ninth of what they take one after the other, or less
    assert max(f.passes for f in fits) * 9 <= sum(f.passes for f in fits)


def test_batched_equals_separate_and_sparks_own(spark, data):
    x, y, df = data
    rows, every = L.pack(df), problems()[::5]
    together = L.fit_many(rows, every)
    for p, f in zip(every, together, strict=True):
        alone = L.fit_many(rows, [p])[0]
        assert np.abs(alone.coefficients - f.coefficients).max() < 1e-4 and abs(alone.intercept - f.intercept) < 1e-4
    for p, f in list(zip(every, together, strict=True))[:3]:
        part = df.where(F.col("fold") != p.value).withColumn("w", F.when(F.col("label") == 1, p.positive).otherwise(p.negative))
        total = part.agg(F.sum("w")).first()[0]
        spark_fit = LogisticRegression(weightCol="w", elasticNetParam=1.0, regParam=1 / (p.c * total), standardization=False, maxIter=2000, tol=1e-13).fit(part)
        assert np.abs(spark_fit.coefficients.toArray() - f.coefficients).max() < 1e-4
        assert spark_fit.intercept == pytest.approx(f.intercept, abs=1e-4)


@pytest.mark.parametrize("largest", [1024, 50])
def test_more_features_than_a_working_set_and_sampled_curvature(spark, monkeypatch, largest):
    monkeypatch.setattr(L, "WORKING_SET", 16)
    monkeypatch.setattr(L, "CURVATURE_ROWS", 200)
    monkeypatch.setattr(L, "DIRECT_PARTS", 2)  # sums go through the tree
    monkeypatch.setattr(L, "LARGEST_SET", largest)
    x, y = sample(600, 60, 2, sparse=0.9)
    p = [L.Problem(0.5, 1.0, 1.0, "half", h, True) for h in (0, 1)]
    rows = L.pack(frame(spark, x, y, 5))
    for h, f in enumerate(L.fit_many(rows, p)):
        own = np.arange(600) % 2 == h
        assert f.kkt <= 1e-6 and residual(x, y, p[h], f, own) <= 2e-6
        assert 0 < (f.coefficients != 0).sum() < 60


def test_scores_and_confusion_are_of_unseen_rows(spark, data):
    x, y, df = data
    rows, p = L.pack(df), [L.Problem(1.0, 1.0, 1.0, "half", h, True) for h in (0, 1)]
    fits = L.fit_many(rows, p)
    got = {r.user_id: r.s for r in L.unseen_scores(rows, p, fits, "user_id", "s").collect()}
    assert len(got) == 500
    for i in range(500):
        f = fits[1 - i % 2]
        assert got[i] == pytest.approx(1 / (1 + np.exp(-(x[i] @ f.coefficients + f.intercept))))
    for h, n in enumerate(L.confusion(rows, p, fits)):
        own = [i for i in range(500) if i % 2 != h]
        said = [got[i] > 0.5 for i in own]
        want = [(s, y[i] == 1) for s, i in zip(said, own, strict=True)]
        assert n == (want.count((True, True)), want.count((True, False)), want.count((False, True)))


def test_one_class_empty_rows_and_constant_columns(spark):
    x, y = sample(60, 4, 3)
    x[:, 1], x[:, 2] = 0.0, 5.0  # nothing, and a second intercept that is penalised
    y[np.arange(60) % 3 != 0] = 0.0
    rows = L.pack(frame(spark, x, y))
    fit = L.fit_many(rows, [L.Problem(1.0, 1.0, 1.0, "fold", 0, False), L.Problem(1.0, 1.0, 1.0, "fold", 0, True), L.Problem(1.0, 1.0, 1.0, "fold", 9, True)])
    assert fit[0].intercept == -np.inf and not fit[0].coefficients.any()
    assert fit[1].kkt <= 1e-6 and fit[1].coefficients[1] == fit[1].coefficients[2] == 0.0
    assert fit[2].intercept == -np.inf  # no row at all
    scores = L.unseen_scores(rows, [L.Problem(1.0, 1.0, 1.0, "fold", 0, False)], fit[:1], "user_id", "s").collect()
    assert {r.s for r in scores} == {0.0}
