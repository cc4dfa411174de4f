"""List selection: T2/T3 per-score top-k, U2 two-of-three vote, U4 quota, U3 union,
J9 exclusion of recent recommendations, J10 final rows.

Each top-k is ``filter → orderBy(score desc, user_id) → limit(n)``, which Spark plans as
TakeOrderedAndProject: every partition keeps its best ``n`` rows and only those reach the
final merge, so the cost is one pass over the scores plus ``n × partitions`` rows. The
limit is the feature here (the list size), not a sample.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SCORES = ("knn", "logreg", "xgb")


def top_k(df: DataFrame, score: str, threshold: float, n: int, key: str = "user_id") -> DataFrame:
    """Ids of the ``n`` best rows with ``score > threshold`` (ties by ``key`` ascending)."""
    if n <= 0:
        return df.select(key).where(F.lit(False))
    return df.where(F.col(score) > F.lit(threshold)).orderBy(F.col(score).desc(), F.col(key).asc()).limit(n).select(key)


def tagged_top_lists(df: DataFrame, thresholds: dict, n: int, key: str = "user_id") -> DataFrame:
    """(key, model) for every model's top list."""
    parts = [
        top_k(df, f"{m}_score", thresholds[m], n, key).withColumn("model", F.lit(m)) for m in SCORES
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def vote(tagged: DataFrame, key: str = "user_id", min_votes: int = 2) -> DataFrame:
    """Ids in at least ``min_votes`` of the lists, i.e. (k∩l) ∪ (k∩x) ∪ (x∩l) for 2 of 3."""
    return tagged.groupBy(key).agg(F.countDistinct("model").alias("votes")).where(
        F.col("votes") >= min_votes
    ).select(key)


def quota(n_rec: int, voted: int, parts: int = 3) -> int:
    """U4: ``int((n_rec - voted) / parts)`` truncated toward zero, clamped at 0 (note 11)."""
    return max(0, int((n_rec - voted) / parts))


@dataclass
class Selection:
    ids: DataFrame  # final ids (U3)
    voted: int
    per_model_quota: int
    counts: dict  # list sizes for the run log: voted users, and each model's fill


def select_users(df: DataFrame, thresholds: dict, n_rec: int, key: str = "user_id") -> Selection:
    """Vote, quota, per-model fill on the remaining users, union.

    Six top-k passes read the key and the three scores, so only these four columns are
    checkpointed; the lists hold at most ``2 * n_rec`` rows."""
    ensure_checkpoint_dir(df.sparkSession)
    scores = df.select(key, *[f"{m}_score" for m in SCORES]).checkpoint(eager=True)
    voted_ids = vote(tagged_top_lists(scores, thresholds, n_rec, key), key).checkpoint(eager=True)
    n_voted = voted_ids.count()
    k = quota(n_rec, n_voted)
    rest = scores.join(voted_ids, key, "left_anti")
    ids = voted_ids.withColumn("model", F.lit("voted"))
    for m in SCORES:
        ids = ids.unionByName(top_k(rest, f"{m}_score", thresholds[m], k, key).withColumn("model", F.lit(m)))
    ids = ids.checkpoint(eager=True)
    sizes = {r["model"]: r["count"] for r in ids.groupBy("model").count().collect()}
    counts = {"top_users": n_voted} | {f"{m}_users": sizes.get(m, 0) for m in SCORES}
    return Selection(ids.select(key).distinct(), n_voted, k, counts)


def recent_ids(history: DataFrame, today: dt.date, days: int, key: str = "user_id") -> DataFrame:
    """S3: ids recommended with ``date_rec > today - days`` (strict); prunes date_rec partitions."""
    return history.where(F.col("date_rec") > F.lit(today - dt.timedelta(days=days))).select(key).where(
        F.col(key).isNotNull()
    )


def exclude_recent(df: DataFrame, history: DataFrame, today: dt.date, days: int, key: str = "user_id") -> DataFrame:
    """Drop users recommended recently (left anti join; history ids are non-null)."""
    return df.join(recent_ids(history, today, days, key), key, "left_anti")


OUTPUT_COLUMNS = (
    "user_id",
    "external_id",
    "is_asd",
    "was_asd",
    "asd_others",
    "all_revenue_90",
    "all_revenue_30",
    "activations_30",
    "activations_30_60",
    "activations_60_90",
    "other_vertical_items_end_date",
    "knn_score",
    "logreg_score",
    "xgb_score",
)

OUTPUT_TYPES = {
    "user_id": "long",
    "external_id": "long",
    "is_asd": "int",
    "was_asd": "int",
    "asd_others": "int",
    "other_vertical_items_end_date": "int",
}


def output_rows(scored: DataFrame, ids: DataFrame, key: str = "user_id") -> DataFrame:
    """J10 + P24: rows of the selected ids, the 14 output columns in order."""
    rows = scored.join(ids, key, "left_semi")
    return rows.select(*[F.col(c).cast(OUTPUT_TYPES.get(c, "double")).alias(c) for c in OUTPUT_COLUMNS])
