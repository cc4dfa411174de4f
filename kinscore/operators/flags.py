"""FE1-FE3: account-manager flags (A8: constant 1 per distinct user)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig
from ..functions.predicates import contains_ci, not_contains_ci, on_day, since
from ..sources.tables import Tables
from .population import as_population


FLAGS = ("is_asd", "was_asd", "asd_others")


def manager_flags(t: Tables, cfg: JobConfig, population=None) -> DataFrame:
    """FE1-FE3 in one pass over the snapshot: (user_id, is_asd, was_asd, asd_others), 1.0 where
    some snapshot row satisfies the flag's predicate, else 0.0.

    Restricted to ``population`` where one is given (the dataset's use)."""
    match = contains_ci("team", cfg.team_pattern)
    other = not_contains_ci("team", cfg.team_pattern)
    md = t.manager_days.where(F.col("user_id").isNotNull()).select(
        "user_id",
        F.coalesce(match & on_day("event_date", cfg.as_of), F.lit(False)).alias("f1"),
        F.coalesce(match, F.lit(False)).alias("f2"),
        F.coalesce(other & since("event_date", cfg.as_of), F.lit(False)).alias("f3"),
    )

    def aggregate(d: DataFrame) -> DataFrame:
        # partial aggregation: a user with many snapshot rows is one row per task in the shuffle
        flags = zip(("f1", "f2", "f3"), FLAGS, strict=True)
        return d.groupBy("user_id").agg(*[F.max(F.col(f).cast("double")).alias(name) for f, name in flags])

    return aggregate(md) if population is None else as_population(population).scope(md, aggregate)


def flagged(flags: DataFrame, name: str) -> DataFrame:
    """(user_id, 1.0) for the users that have the flag."""
    return flags.where(F.col(name) == 1).select("user_id", name)
