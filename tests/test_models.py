"""Models on a separable synthetic set: split stability, weights, grid search, cross-fit."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from kinscore.operators import models as M


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(240):
        y = 1.0 if i % 4 == 0 else 0.0
        x = rng.normal(size=3) + (2.5 if y else 0.0)
        rows.append((i, y, Vectors.dense(x.tolist())))
    df = spark.createDataFrame(rows, ["user_id", "label", "features"])
    split = M.add_split_columns(df, "user_id", 17, 3)
    ten = F.when(F.col("label") == 1, 10.0).otherwise(1.0)
    return split.withColumn("w_none", F.lit(1.0)).withColumn("w_ten_to_one", ten).cache()


def test_split_is_stable_and_balanced(spark, train):
    df = train
    a = {r[0]: r[1] for r in df.select("user_id", "half").collect()}
    b = {r[0]: r[1] for r in M.add_split_columns(df.drop("half", "fold").repartition(7), "user_id", 17, 3).select("user_id", "half").collect()}
    assert a == b
    assert 80 < sum(a.values()) < 160


def test_folds_are_stratified(spark, train):
    counts = {(r["fold"], r["label"]): r["count"] for r in train.groupBy("fold", "label").count().collect()}
    assert counts == {(k, y): n for k in range(3) for y, n in ((1.0, 20), (0.0, 60))}
    few = spark.createDataFrame([(i, 1.0 if i < 7 else 0.0) for i in range(100)], "user_id long, label double")
    split = M.add_split_columns(few, "user_id", 17, 3).where("label = 1")
    assert sorted(r["count"] for r in split.groupBy("fold").count().collect()) == [2, 2, 3]


def test_weights(train):
    _, totals = M.weight_totals(*M.class_counts(train))
    assert totals["none"] == 240.0
    assert totals["ten_to_one"] == 10.0 * 60 + 180
    assert totals["balanced"] == pytest.approx(240.0)  # balanced weights sum to n


def test_grid_and_cross_fit(spark, train):
    df = train
    grid = M.grid_search_logreg(df, (0.1, 1.0), ("none", "balanced"), 3)
    assert len(grid.rows) == 4 and grid.best_f1 > 0.5  # majority baseline F1 of class 1 is 0
    assert all(kkt <= 1e-6 for *_, kkt in grid.rows)
    fit = M.cross_fit_logreg(df, grid.best_c, grid.best_weighting, "s")
    scores = fit.scores
    assert scores.count() == 240 and scores.select("user_id").distinct().count() == 240
    assert fit.f1_first > 0.5 and fit.f1_second > 0.5
    s = scores.join(df.select("user_id", "half"), "user_id")
    assert s.where(F.col("s").isNull()).count() == 0


def test_trees_cross_fit(spark, train):
    df = train
    params = {"maxIter": 5, "maxDepth": 3, "stepSize": 0.1, "subsamplingRate": 0.7,
              "featureSubsetStrategy": "0.5", "minInstancesPerNode": 10}
    fit = M.cross_fit(df, lambda half: M.gbt(params).fit(half), "xgb_score")
    assert fit.scores.count() == 240
    assert fit.f1_first > 0.5
    folds = M.cv_f1(df, lambda: M.gbt(params), 3)
    assert len(folds) == 3 and min(folds) > 0.5


def test_class_weight_table(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (0.0,), (0.0,)], "is_asd double")
    got = {r["label"]: (r["n"], r["balanced_weight"]) for r in M.class_weight_table(df, "is_asd").collect()}
    assert got == {1: (1, 2.0), 0: (3, pytest.approx(4 / 6))}
