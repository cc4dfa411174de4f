"""Learning and scoring operators (L1-L8) on ``pyspark.ml``.

* L1 split and folds come from hashes of the user id, so they are stable across
  partitionings; the folds are stratified by label without a single-task window over a class.
* L2 L1-penalised logistic regression: ``operators/logistic.py``, many fits in shared passes.
* L4 grid search: 9 settings × 3 stratified folds as one batch of fits; balanced weights come from each
  training fold, as in the original's cross-validated search.
* L5 boosted trees are ``GBTClassifier``; it has no L1 leaf penalty, counts rows instead of
  hessian for the child minimum and samples features per node (compare by F1, not score).
* L7 cross-fit: each half is scored by the model trained on the other half.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .logistic import Problem, Rows, confusion, f1_of, fit_many, pack, unseen_scores
from .logistic import class_counts as class_counts_of

WEIGHTINGS = ("none", "ten_to_one", "balanced")


def class_weight_table(df: DataFrame, label: str) -> DataFrame:
    """L3: per-class weights. balanced = n / (2·n_class); ten_to_one = {1: 10, 0: 1}."""
    counts = df.groupBy(F.col(label).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())  # two rows: a global window is bounded
    return counts.select(
        "label",
        "n",
        (total.cast("double") / (F.lit(2.0) * F.col("n"))).alias("balanced_weight"),
        F.when(F.col("label") == 1, 10.0).otherwise(1.0).alias("ten_to_one_weight"),
    )


def hash_bucket(key: str, seed: int, buckets: int):
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(buckets)).cast("int")


STRATUM_BUCKETS = 4096


def add_split_columns(df: DataFrame, key: str, seed: int, folds: int, label: str = "label") -> DataFrame:
    """L1 and the folds of L4/L6: ``half`` in {0, 1} by a hash of the key, and ``fold`` in
    [0, folds) stratified by ``label``: the rows of a class, in the order of a hash, are dealt to the
    folds in turn, so every fold holds its share of each class to within one row.

    The place of a row is the number of rows in the buckets before its own (a small table per
    class and bucket) plus its place in the bucket, so no task ranks a whole class."""
    hashed = df.withColumn("half", hash_bucket(key, seed, 2)).withColumn(
        "stratum_bucket", hash_bucket(key, seed + 1, STRATUM_BUCKETS)
    )
    before = Window.partitionBy(label).orderBy("stratum_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = hashed.groupBy(label, "stratum_bucket").count()
    offsets = sizes.select(label, "stratum_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy(label, "stratum_bucket").orderBy(F.xxhash64(F.col(key), F.lit(seed + 2)), key)
    ranked = hashed.withColumn("place", F.row_number().over(inside) - 1).join(offsets, [label, "stratum_bucket"])
    fold = F.pmod(F.col("place") + F.col("offset"), F.lit(folds)).cast("int")
    return ranked.withColumn("fold", fold).select(*df.columns, "half", "fold")


def class_counts(df: DataFrame, label: str = "label") -> tuple[int, int]:
    """(rows of class 1, rows of class 0)."""
    counts = {int(r[0]): r[1] for r in df.groupBy(F.col(label).cast("int")).count().collect()}
    return counts.get(1, 0), counts.get(0, 0)


def weight_totals(n_pos: int, n_neg: int) -> tuple[tuple[float, float], dict[str, float]]:
    """Balanced weights of class 1 and 0, and the total weight of each weighting (for regParam)."""
    n = n_pos + n_neg
    balanced = (n / (2.0 * n_pos) if n_pos else 0.0, n / (2.0 * n_neg) if n_neg else 0.0)
    totals = {
        "none": float(n),
        "ten_to_one": 10.0 * n_pos + n_neg,
        "balanced": balanced[0] * n_pos + balanced[1] * n_neg,
    }
    return balanced, totals


class PositiveF1(Evaluator):
    """F1 of the positive class, ``2·tp / (2·tp + fp + fn)`` from one aggregate.

    Spark's plain ``f1`` is class-weighted, and ``fMeasureByLabel`` fails when a fold holds
    no row of label 1; this one returns 0 then (as the binary F1 of the original job)."""

    def _evaluate(self, dataset: DataFrame) -> float:
        pos_pred, pos_true = F.col("prediction") == 1.0, F.col("label") == 1.0
        row = dataset.agg(
            F.count(F.when(pos_pred & pos_true, 1)).alias("tp"),
            F.count(F.when(pos_pred & ~pos_true, 1)).alias("fp"),
            F.count(F.when(~pos_pred & pos_true, 1)).alias("fn"),
        ).first()
        denom = 2 * row["tp"] + row["fp"] + row["fn"]
        return 0.0 if denom == 0 else 2.0 * row["tp"] / denom

    def isLargerBetter(self) -> bool:
        return True


def f1_evaluator() -> PositiveF1:
    return PositiveF1()


@dataclass
class GridResult:
    rows: list[tuple[float, str, float, float]]  # (C, weighting, mean F1 over folds, worst KKT residual)
    best_c: float
    best_weighting: str
    best_f1: float
    passes: int  # over the data, shared by all fits


def class_weight(weighting: str, balanced: tuple[float, float]) -> tuple[float, float]:
    return {"none": (1.0, 1.0), "ten_to_one": (10.0, 1.0), "balanced": balanced}[weighting]


def _balanced_by(rows: Rows, part: str, values, inside: bool) -> dict[int, tuple[float, float]]:
    """Balanced class weights of the rows whose ``part`` is (or is not) each value, from one small aggregate."""
    probes = [Problem(1.0, 1.0, 1.0, part, v, inside) for v in values]
    return {v: weight_totals(*n)[0] for v, n in zip(values, class_counts_of(rows, probes), strict=True)}


def grid_search_logreg(train: DataFrame, c_grid, weightings, folds: int, n_features: int | None = None) -> GridResult:
    """L4: mean F1 over ``folds`` stratified folds for every (C, weighting), as a grid search with 3-fold
    cross-validation does it: the balanced weights come from each training fold's own labels. All
    ``len(grid) x folds`` fits share every pass over the packed rows, and one pass scores them;
    ties keep the first setting in grid order (C outer)."""
    rows = pack(train, n_features=n_features)
    balanced = _balanced_by(rows, "fold", range(folds), inside=False)
    settings = [(c, w) for c in c_grid for w in weightings]
    problems = [Problem(c, *class_weight(w, balanced[k]), "fold", k, False) for c, w in settings for k in range(folds)]
    fits = fit_many(rows, problems)
    f1 = [f1_of(*n) for n in confusion(rows, problems, fits)]
    found = [
        (c, w, sum(f1[i * folds : (i + 1) * folds]) / folds, max(f.kkt for f in fits[i * folds : (i + 1) * folds]))
        for i, (c, w) in enumerate(settings)
    ]
    best = max(range(len(found)), key=lambda i: (found[i][2], -i))
    return GridResult(found, *found[best][:3], max(f.passes for f in fits))


def gbt(params: dict, seed: int = 17) -> GBTClassifier:
    return GBTClassifier(featuresCol="features", labelCol="label", seed=seed, **params)


def cv_f1(train: DataFrame, make_estimator, folds: int, parallelism: int = 3) -> list[float]:
    """F1 on each fold for one estimator setting (the tree grid has one point, used only
    for the log); the fold fits run as concurrent Spark jobs."""
    ev = f1_evaluator()

    def run(k):
        model = make_estimator().fit(train.where(F.col("fold") != k))
        return float(ev.evaluate(model.transform(train.where(F.col("fold") == k))))

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(run, range(folds)))


def positive_probability(pred: DataFrame, name: str) -> DataFrame:
    return pred.select("user_id", vector_to_array("probability")[1].alias(name))


@dataclass
class CrossFit:
    scores: DataFrame  # user_id, <name>
    f1_first: float  # model of half 0 on half 1
    f1_second: float  # model of half 1 on half 0


def cross_fit_logreg(
    train: DataFrame, c_value: float, weighting: str, name: str, n_features: int | None = None
) -> CrossFit:
    """L7 for the logistic model: the fits of both halves share their passes, with balanced weights from each
    half's own labels; every row is scored by the fit that did not see it."""
    rows = pack(train, n_features=n_features)
    balanced = _balanced_by(rows, "half", (0, 1), inside=True)
    problems = [Problem(c_value, *class_weight(weighting, balanced[h]), "half", h, True) for h in (0, 1)]
    fits = fit_many(rows, problems)
    f1 = [f1_of(*n) for n in confusion(rows, problems, fits)]
    return CrossFit(unseen_scores(rows, problems, fits, "user_id", name), *f1)


def cross_fit(train: DataFrame, fit_half, name: str) -> CrossFit:
    """Two fits (run as concurrent Spark jobs); every row is scored by the model that
    did not see it. ``fit_half(df)`` returns a model fitted on ``df``."""
    halves = [train.where(F.col("half") == h) for h in (0, 1)]
    with ThreadPoolExecutor(max_workers=2) as pool:
        f0 = pool.submit(fit_half, halves[0])
        f1 = pool.submit(fit_half, halves[1])
        m0, m1 = f0.result(), f1.result()
    p1 = m0.transform(halves[1])  # half 1 scored by the model of half 0
    p0 = m1.transform(halves[0])
    ev = f1_evaluator()
    scores = positive_probability(p0, name).unionByName(positive_probability(p1, name))
    return CrossFit(scores, float(ev.evaluate(p1)), float(ev.evaluate(p0)))
