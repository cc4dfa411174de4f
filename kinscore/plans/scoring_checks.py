"""Registered queries for the scoring and selection operators.

The model scores of the real job come from fitted models (no SQL equivalent), so the
selection operators are also registered on scores that Spark derives deterministically
from the ``embeddings`` table (whole table): the nearest-positive score of vectors scaled
by 0.13 (label 0 = positive, so part of the candidates pass the threshold), and two
scaled embedding coordinates (×5, +0.5) standing in for the two model probabilities. The
oracle SQL derives the same scores in DuckDB.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.assemble import DatasetSpec
from ..operators.nearest import nearest_positive
from ..operators.selection import exclude_recent, select_users, tagged_top_lists, vote
from ..operators.transform import log_features, standardize
from ..session import ensure_checkpoint_dir
from ..sources.tables import read_driver_table
from .dataset import Dataset, long_form
from .recommend import choose, merge_scores
from .registry import dataset, setup, stored_dataset

# parameters of the selection fixture
FIXTURE_SCALE = 0.13
FIXTURE_N_REC = 100
FIXTURE_THRESHOLDS = {"knn": 0.0, "logreg": 0.5, "xgb": 0.5}
HISTORY_TODAY = dt.date(2024, 1, 30)
HISTORY_DAYS = 14
# the whole list: vector v is user v * LIST_STEP + 1; a short list, so that vote and fill both work
LIST_STEP = 3
LIST_N_REC = 30
LIST_THRESHOLDS = {"knn": 0.0, "logreg": 0.5, "xgb": 0.5}
LIST_HISTORY_DAYS = 2
# logarithms and scaled values are compared after rounding: sums depend on the order of the rows
ROUND_DIGITS = 6


def embedding_vectors(spark, sf_dir: str, scale: float | None = None) -> DataFrame:
    e = read_driver_table(spark, sf_dir, "embeddings")
    v = F.col("embedding").cast("array<double>")
    if scale is not None:
        v = F.transform(v, lambda x: x * F.lit(float(scale)))
    return e.select(F.col("vec_id").alias("user_id"), v.alias("vec"), "label")


def nearest_l1_q(spark, sf_dir):
    e = embedding_vectors(spark, sf_dir)
    pos = e.where(F.col("label") == 0)
    cand = e.where(F.col("label") != 0)
    return nearest_positive(cand, pos, key="user_id").withColumnRenamed("user_id", "vec_id")


def fixture_scores(spark, sf_dir) -> DataFrame:
    """The three scores of every vector, written as the models' scores are: every top list, evaluation and score table
    reads them again, and the nearest positives are looked for once."""
    e = embedding_vectors(spark, sf_dir, FIXTURE_SCALE)
    knn = nearest_positive(e.where(F.col("label") != 0), e.where(F.col("label") == 0), key="user_id")
    ensure_checkpoint_dir(spark)
    return (
        e.join(knn.select("user_id", "knn_score"), "user_id", "left")
        .select(
            "user_id",
            F.coalesce("knn_score", F.lit(-10.0)).alias("knn_score"),
            (F.col("vec")[0] * F.lit(5.0) + F.lit(0.5)).alias("logreg_score"),
            (F.col("vec")[1] * F.lit(5.0) + F.lit(0.5)).alias("xgb_score"),
        )
        .checkpoint(eager=True)
    )


def top_k_q(spark, sf_dir):
    return tagged_top_lists(fixture_scores(spark, sf_dir), FIXTURE_THRESHOLDS, FIXTURE_N_REC)


def vote_q(spark, sf_dir):
    return vote(tagged_top_lists(fixture_scores(spark, sf_dir), FIXTURE_THRESHOLDS, FIXTURE_N_REC))


def quota_fill_q(spark, sf_dir):
    return select_users(fixture_scores(spark, sf_dir), FIXTURE_THRESHOLDS, FIXTURE_N_REC).ids


def list_scores(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Three score tables, each of some users only, from what Spark derives of the embeddings: the vectors stand for the
    users whose id is theirs times ``LIST_STEP``, and each model leaves out other users."""
    s = fixture_scores(spark, sf_dir).withColumn("user_id", F.col("user_id") * LIST_STEP + 1)
    knn = s.where("user_id % 5 != 0").select("user_id", "knn_score")
    logreg = s.where("user_id % 7 != 0").select("user_id", "logreg_score")
    trees = s.where("user_id % 11 != 0").select("user_id", "xgb_score")
    return knn, logreg, trees


def list_from_scores_q(spark, sf_dir):
    """The list from given scores: J8, L11, P16 (merge and fill), J9 (recent users), P20, P21 (eligible), vote and
    fill, J10, P24 (14 columns). The history is the day of each user's events."""
    ds, cfg = stored_dataset(spark, sf_dir)
    cfg = replace(cfg, n_rec=LIST_N_REC, thresholds=LIST_THRESHOLDS, history_days=LIST_HISTORY_DAYS)
    history = read_driver_table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("date_rec"))
    scored = merge_scores(ds.df, *list_scores(spark, sf_dir), cfg)
    return choose(scored, cfg, history, HISTORY_TODAY)[0]


def f1_scores_q(spark, sf_dir):
    """L8 on written predictions: F1 of the positive class of both model columns."""
    from ..operators.models import PositiveF1

    e = embedding_vectors(spark, sf_dir).select("user_id", (F.col("label") == 0).cast("double").alias("label"))
    scored = fixture_scores(spark, sf_dir).join(e, "user_id")
    ev = PositiveF1()
    rows = []
    for m in ("logreg", "xgb"):
        predicted = (F.col(f"{m}_score") > FIXTURE_THRESHOLDS[m]).cast("double").alias("prediction")
        rows.append((m, ev.evaluate(scored.select("label", predicted))))
    return spark.createDataFrame(rows, "model string, f1 double")


def exclude_recent_q(spark, sf_dir):
    pop = setup(spark, sf_dir)[2]
    history = read_driver_table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("date_rec"))
    return exclude_recent(pop.df, history, HISTORY_TODAY, HISTORY_DAYS)


def log_features_q(spark, sf_dir):
    ds, _ = dataset(spark, sf_dir)
    logged = Dataset(log_features(ds.df, ds.spec.features), ds.spec)
    return long_form(logged).select("user_id", "feature", F.round("value", ROUND_DIGITS).alias("value"))


def standardize_q(spark, sf_dir):
    ds, _ = stored_dataset(spark, sf_dir)
    cols = ds.spec.non_click_features
    scaled = standardize(ds.df, cols)
    spec = DatasetSpec(ds.spec.keys, [], cols, [])
    rounded = (F.round("value", ROUND_DIGITS) + F.lit(0.0)).alias("value")
    return long_form(Dataset(scaled, spec)).select("user_id", "feature", rounded)


QUERIES = {
    "nearest_l1": nearest_l1_q,
    "top_k_per_score": top_k_q,
    "vote_two_of_three": vote_q,
    "quota_fill": quota_fill_q,
    "list_from_scores": list_from_scores_q,
    "f1_scores": f1_scores_q,
    "exclude_recent": exclude_recent_q,
    "log_features": log_features_q,
    "standardize": standardize_q,
}
