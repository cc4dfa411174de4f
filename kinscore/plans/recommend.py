"""Score users three ways and select the recommendation list (the second half of the job).

dataset → log10(1+x) of the model features → vector → hash split/folds → checkpoint →
  logistic grid search (CV) → cross-fit logistic scores
  tree CV F1 (log only) → cross-fit tree scores
raw non-click features → population-std scaling → revenue filter → nearest positive
→ merge scores (knn fill −10) → drop recent, ``asd_others`` and ``is_asd`` users →
vote 2 of 3 + per-model fill → 14 output columns.

Only hyper-parameters, class counts, the vote size and log metrics reach the driver.
"""

from __future__ import annotations

import datetime as dt
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig
from ..operators import models as M
from ..operators.boosting import TreeParams, bin_rows, cross_fit_trees
from ..operators.nearest import nearest_positive, vector_of
from ..operators.selection import Selection, exclude_recent, output_rows, select_users
from ..operators.transform import log_domain_violations, log_features, standardize
from ..session import ensure_checkpoint_dir
from .dataset import Dataset


# cells (rows x features) of the training frame per partition: every pass of the fits is a task a partition, and takes
# longer over so many cells than it takes to start the task
TRAIN_CELLS_PER_PARTITION = 400_000


@dataclass
class Recommendation:
    rows: DataFrame  # the 14 output columns
    scored: DataFrame  # every user with the three scores
    log: dict = field(default_factory=dict)


def training_frame(ds: Dataset, cfg: JobConfig) -> tuple[DataFrame, list[str]]:
    """(user_id, label, features, half, fold, class weights) behind a checkpoint.

    The feature plan runs once, into the checkpoint; the row count that sizes the partitions
    reads it back. Every fit runs one task per partition and iteration: a small frame is one
    partition, a larger one is dealt over as many as its cells ask for."""
    feats = ds.spec.model_features(cfg.exclude_features)
    logged = log_features(ds.df.select("user_id", "is_asd", *[F.col(f"`{c}`") for c in feats]), feats)
    assembler = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep")
    vec = assembler.transform(logged).select("user_id", F.col("is_asd").cast("double").alias("label"), "features")
    ensure_checkpoint_dir(vec.sparkSession)
    vec = vec.checkpoint(eager=True)
    parts = max(1, math.ceil(vec.count() * max(1, len(feats)) / TRAIN_CELLS_PER_PARTITION))
    split = M.add_split_columns(vec, "user_id", cfg.seed, cfg.cv_folds)
    split = split.withColumn("w_none", F.lit(1.0)).withColumn("w_ten_to_one", F.when(F.col("label") == 1, 10.0).otherwise(1.0))
    return split.repartition(parts, "user_id").checkpoint(eager=True), feats


def logistic_scores(train: DataFrame, cfg: JobConfig):
    grid = M.grid_search_logreg(train, cfg.logreg_c_grid, cfg.logreg_weightings, cfg.cv_folds)
    return grid, M.cross_fit_logreg(train, grid.best_c, grid.best_weighting, "logreg_score")


def tree_cv(train: DataFrame, cfg: JobConfig) -> list[float]:
    """F1 of the one tree setting on each fold."""
    return M.cv_f1(train, lambda: M.gbt(cfg.gbt_params, cfg.seed), cfg.cv_folds)


def tree_fit(train: DataFrame, cfg: JobConfig) -> M.CrossFit:
    return M.cross_fit(train, lambda half: M.gbt(cfg.gbt_params, cfg.seed).fit(half), "xgb_score")


def second_order_scores(train: DataFrame, cfg: JobConfig) -> tuple[list[float], M.CrossFit]:
    """L5-L7 by ``operators/boosting.py``: (F1 per fold, the cross-fit), all five fits in shared jobs."""
    p = TreeParams(**cfg.tree_params, seed=cfg.seed)
    values = vector_to_array("features")
    sparse = F.filter(F.transform(values, lambda v, i: F.struct(i.cast("int").alias("i"), v.alias("v"))), lambda c: c["v"] != 0)
    rows = train.select("user_id", "label", "half", "fold", sparse.alias("c"))
    rows = rows.select("user_id", "label", "half", "fold", F.col("c.i").alias("indices"), F.col("c.v").alias("values"))
    scores, halves, folds = cross_fit_trees(bin_rows(rows, p), p, cfg.cv_folds, "xgb_score")
    return folds, M.CrossFit(scores, *halves)


def knn_scores(ds: Dataset, cfg: JobConfig) -> DataFrame:
    """L9 + L10: standardise the raw non-click features, keep rows with scaled revenue above
    the floor or a positive label, score candidates by their nearest positive."""
    ex = set(cfg.exclude_features)
    cols = [c for c in ds.spec.non_click_features if c not in ex]
    scaled = standardize(ds.df.select("user_id", "is_asd", *cols), cols)
    keep = scaled.where((F.col(cfg.knn_revenue_feature) > cfg.knn_revenue_floor) | (F.col("is_asd") == 1))
    vec = keep.select("user_id", "is_asd", vector_of(cols).alias("vec"))
    return nearest_positive(vec.where(F.col("is_asd") == 0), vec.where(F.col("is_asd") == 1), key="user_id")


def merge_scores(users: DataFrame, knn: DataFrame, logreg: DataFrame, trees: DataFrame, cfg: JobConfig) -> DataFrame:
    """Every user with the three scores; users without a neighbour score get the fill value,
    users without a model score keep null and pass no threshold."""
    merged = users.join(knn.select("user_id", "knn_score"), "user_id", "left")
    merged = merged.join(logreg, "user_id", "left").join(trees, "user_id", "left")
    return merged.fillna(cfg.knn_fill, subset=["knn_score"])


def choose(
    scored: DataFrame, cfg: JobConfig, history: DataFrame | None, today: dt.date
) -> tuple[DataFrame, Selection]:
    """J9, P20, P21, the vote and fill, J10, P24: the 14 output columns of the chosen users."""
    eligible = scored if history is None else exclude_recent(scored, history, today, cfg.history_days)
    eligible = eligible.where((F.col("asd_others") == 0) & (F.col("is_asd") == 0))
    sel = select_users(eligible, cfg.thresholds, cfg.n_rec)
    return output_rows(eligible, sel.ids), sel


def recommend(
    ds: Dataset,
    cfg: JobConfig,
    history: DataFrame | None = None,
    today: dt.date | None = None,
) -> Recommendation:
    today = today or dt.date.today()
    train, feats = training_frame(ds, cfg)
    # scorers run one after the other: the logistic fits share their passes, the tree fits run concurrently
    grid, lr_fit = logistic_scores(train, cfg)
    if cfg.tree_engine == "second_order":
        tree_f1, gbt_fit = second_order_scores(train, cfg)
    else:
        with ThreadPoolExecutor(max_workers=2) as pool:
            folds, halves = pool.submit(tree_cv, train, cfg), pool.submit(tree_fit, train, cfg)
            tree_f1, gbt_fit = folds.result(), halves.result()
    # written: the selection and the output rows read the scores again
    written = [x.checkpoint(eager=True) for x in (knn_scores(ds, cfg), lr_fit.scores, gbt_fit.scores)]

    scored = merge_scores(ds.df, *written, cfg)
    rows, sel = choose(scored, cfg, history, today)
    log = {
        "logreg": {
            "cv_f1": grid.best_f1,
            "kkt_residual": max(r[3] for r in grid.rows),
            "passes": grid.passes,
            "best_params": {"C": grid.best_c, "class_weight": grid.best_weighting},
            "f1_by_half": [lr_fit.f1_first, lr_fit.f1_second],
        },
        "trees": {"cv_f1": sum(tree_f1) / len(tree_f1), "f1_by_half": [gbt_fit.f1_first, gbt_fit.f1_second]},
        "selection": {"thresholds": cfg.thresholds, "per_model_quota": sel.per_model_quota, **sel.counts},
        "n_features": len(feats),
        "rows_below_minus_one": log_domain_violations(ds.df, feats).first()[0],
    }
    return Recommendation(rows, scored, log)
