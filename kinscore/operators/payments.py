"""Payments family: FE4 all_revenue_90, FE5 all_revenue_30, FE10 revenue_180, FE14 tariffs.

One scan of the payments fact (widest window, revenue rows only) and one two-level
aggregate produce all of them:

1. group by (user_id, tariff_fact) where ``tariff_fact`` is the fact id of a row that
   qualifies for some tariff and NULL otherwise: sums are partial sums, tariff flags are
   "this fact id has a qualifying row of subtype s". Non-tariff rows of a user collapse
   into one group during the map-side partial aggregation.
2. group by user_id: add the partial sums, count the fact ids per tariff.

This is an exact ``count(distinct fact_id)`` per tariff without one Expand copy per
distinct aggregate. Money is DECIMAL, so sums are exact and order-independent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig
from ..functions.predicates import closed_window, false_or_null, is_false, is_true, or_rule
from ..functions.text import underscore_spaces
from ..sources.tables import Tables
from .population import as_population

SUM_FEATURES = ("all_revenue_90", "all_revenue_30", "revenue_180")


def tariff_columns(cfg: JobConfig) -> list[str]:
    return [underscore_spaces(s) for s in cfg.tariffs]


def _conditions(cfg: JobConfig) -> dict[str, Column]:
    alive = is_false("is_dead")
    return {
        "all_revenue_90": alive & closed_window("event_time", cfg.as_of, 90),
        "all_revenue_30": alive & closed_window("event_time", cfg.as_of, 30),
        "revenue_180": alive & or_rule(cfg.revenue_rule) & closed_window("event_time", cfg.as_of, cfg.long_days),
    }


def _tariff_base(cfg: JobConfig) -> Column:
    # FE14 uses the null-tolerant spellings (P9) and the second spelling of the rule
    return (
        false_or_null("is_test")
        & false_or_null("is_dead")
        & or_rule(cfg.tariff_rule)
        & closed_window("event_time", cfg.as_of, cfg.long_days)
    )


def payments_family(t: Tables, cfg: JobConfig, population) -> DataFrame:
    """Per population user: the three sums (DECIMAL), ``n_<sum>`` row counts and one count per
    tariff (zero where the user had no qualifying row)."""
    pop = as_population(population)
    conds = _conditions(cfg)
    tariff_base = _tariff_base(cfg)
    tariffs = list(cfg.tariffs)
    tcols = tariff_columns(cfg)
    widest = max(90, 30, cfg.long_days)

    any_cond = tariff_base & F.col("subtype").isin(tariffs) if tariffs else F.lit(False)
    for c in conds.values():
        any_cond = any_cond | c

    fact = (
        t.payments.where(is_true("is_revenue") & closed_window("event_time", cfg.as_of, widest))
        .where(any_cond)
        .select(
            "user_id",
            "amount_net",
            *[c.alias(f"c_{name}") for name, c in conds.items()],
            *[
                F.coalesce(tariff_base & (F.col("subtype") == s), F.lit(False)).alias(f"t_{i}")
                for i, s in enumerate(tariffs)
            ],
            F.when(tariff_base & F.col("subtype").isin(tariffs), F.col("fact_id")).alias("tariff_fact")
            if tariffs
            else F.lit(None).cast("string").alias("tariff_fact"),
        )
    )

    def aggregate(df: DataFrame) -> DataFrame:
        level1 = df.groupBy("user_id", "tariff_fact").agg(
            *[F.sum(F.when(F.col(f"c_{n}"), F.col("amount_net"))).alias(n) for n in conds],
            *[F.count(F.when(F.col(f"c_{n}"), F.lit(1))).alias(f"n_{n}") for n in conds],
            *[F.max(F.col(f"t_{i}").cast("int")).alias(f"t_{i}") for i in range(len(tariffs))],
        )
        return level1.groupBy("user_id").agg(
            *[F.sum(n).alias(n) for n in conds],
            *[F.sum(f"n_{n}").alias(f"n_{n}") for n in conds],
            *[
                F.sum(F.when(F.col("tariff_fact").isNotNull(), F.col(f"t_{i}")).otherwise(0))
                .cast("long")
                .alias(c)
                for i, c in enumerate(tcols)
            ],
        )

    return pop.scope(fact, aggregate)


def payment_features(family: DataFrame, cfg: JobConfig) -> DataFrame:
    """Wide form for the dataset: (user_id, sums as double, tariff counts as double)."""
    return family.select(
        "user_id",
        *[F.col(n).cast("double").alias(n) for n in SUM_FEATURES],
        *[F.col(c).cast("double").alias(c) for c in tariff_columns(cfg)],
    )
