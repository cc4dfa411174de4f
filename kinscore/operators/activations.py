"""FE6-FE8 paid activations in three buckets, FE9 live items in other verticals on ``as_of``."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig
from ..functions.predicates import days_before, on_day
from ..sources.tables import Tables
from .population import as_population, category_ids_with_cat

BUCKETS = ("activations_30", "activations_30_60", "activations_60_90")


def _bucket_conditions(day, as_of: dt.date):
    """FE6 [as_of-30, as_of] (closed: 31 days), FE7 [as_of-60, as_of-30), FE8 [as_of-90, as_of-60)."""
    return {
        "activations_30": (day >= F.lit(days_before(as_of, 30))) & (day <= F.lit(as_of)),
        "activations_30_60": (day >= F.lit(days_before(as_of, 60))) & (day < F.lit(days_before(as_of, 30))),
        "activations_60_90": (day >= F.lit(days_before(as_of, 90))) & (day < F.lit(days_before(as_of, 60))),
    }


def activation_family(t: Tables, cfg: JobConfig, population) -> DataFrame:
    """Per user: the three bucket counts and ``n_<bucket>`` (0 = no staging row)."""
    pop = as_population(population)
    as_of = cfg.as_of
    # coarse bounds on the raw timestamp reach the parquet scan; the exact buckets use the day
    raw = F.col("activation_time")
    acts = t.activations.where(
        (raw >= F.lit(days_before(as_of, 90)))
        & (raw < F.lit(as_of + dt.timedelta(days=1)))
        & F.col("activation_type").isin(list(cfg.paid_activation_types))
    ).select("item_id", F.to_date(raw).alias("day"))
    # the item dimension is restricted to the population before it meets the fact
    items = pop.semi(
        t.items.select("item_id", "user_id", "category_id")
        .join(category_ids_with_cat(t, [cfg.activation_cat_id]), "category_id", "left_semi")
        .select("item_id", "user_id")
    )
    conds = _bucket_conditions(F.col("day"), as_of)
    # count(ci.item_id) per bucket: item_id is the join key, never null here
    return (
        acts.join(items, "item_id", "inner")
        .groupBy("user_id")
        .agg(*[F.count(F.when(c, F.col("item_id"))).alias(n) for n, c in conds.items()])
    )


def activation_buckets_long(family: DataFrame) -> DataFrame:
    parts = [F.struct(F.lit(b).alias("feature"), F.col(b).alias("cnt")) for b in BUCKETS]
    return (
        family.select("user_id", F.explode(F.array(*parts)).alias("x"))
        .where("x.cnt > 0")
        .select("user_id", "x.feature", F.col("x.cnt").cast("double").alias("cnt"))
    )


def snapshot_other_items(t: Tables, cfg: JobConfig, population) -> DataFrame:
    """FE9 other_vertical_items_end_date: item-day rows on ``as_of`` whose item is outside
    the excluded categories (``NOT IN`` subquery; a null category never qualifies)."""
    pop = as_population(population)
    excluded = category_ids_with_cat(t, cfg.excluded_snapshot_cat_ids)
    items = pop.semi(
        t.items.where(F.col("category_id").isNotNull())
        .select("item_id", "user_id", "category_id")
        .join(excluded, "category_id", "left_anti")
        .select("item_id", "user_id")
    )
    snap = t.item_days.where(on_day(F.to_date("event_date"), cfg.as_of)).select("item_id")
    return (
        snap.join(items, "item_id", "inner")
        .groupBy("user_id")
        .agg(F.count("item_id").cast("double").alias("other_vertical_items_end_date"))
    )
