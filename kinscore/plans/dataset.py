"""Build the per-user feature dataset (the first half of the job).

population → every feature family (one scan + aggregate each) → left joins onto the
population → zero fill → columns in a fixed order:

user_id, external_id, is_asd, was_asd, asd_others, all_revenue_90, all_revenue_30,
activations_30, activations_30_60, activations_60_90, other_vertical_items_end_date,
revenue_180, count_items_180, count_payments_180, services, tariffs, attr1 values,
attr2 values, click events, user-defined features.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig
from ..functions.text import assert_unique_names
from ..operators import activations as act
from ..operators import clicks as clk
from ..operators import flags
from ..operators import payment_events as pev
from ..operators import payments as pay
from ..operators.assemble import (
    KEY_COLUMNS,
    LABEL_COLUMNS,
    DatasetSpec,
    FeatureSpec,
    left_join_features,
    zero_fill,
)
from ..operators.population import Population, active_population, as_population
from ..sources.tables import Tables

FIXED_HEAD = (
    "all_revenue_90",
    "all_revenue_30",
    "activations_30",
    "activations_30_60",
    "activations_60_90",
    "other_vertical_items_end_date",
    "revenue_180",
    "count_items_180",
    "count_payments_180",
)


@dataclass
class Dataset:
    df: DataFrame
    spec: DatasetSpec


def long_form(ds: "Dataset") -> DataFrame:
    """(user_id, external_id, feature, value): one row per user and label or feature."""
    pairs = [
        F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("value")) for c in [*ds.spec.labels, *ds.spec.features]
    ]
    return ds.df.select(*KEY_COLUMNS, F.inline(F.array(*pairs)))


def build_dataset(
    t: Tables,
    cfg: JobConfig,
    population: Population | DataFrame | None = None,
    extra: list[FeatureSpec] = (),
    all_click_events: bool = False,
) -> Dataset:
    pop = as_population(population if population is not None else active_population(t, cfg))

    pay_family = pay.payments_family(t, cfg, pop)
    pe_frames, attr1_cols, attr2_cols = pev.payment_event_family(t, cfg, pop)
    clicks_wide, click_cols = clk.click_pivot(t, cfg, pop, all_catalog=all_click_events)

    services = pev.service_columns(cfg)
    tariffs = pay.tariff_columns(cfg)
    extra_names = [e.name for e in extra]
    features = [*FIXED_HEAD, *services, *tariffs, *attr1_cols, *attr2_cols, *click_cols, *extra_names]
    assert_unique_names([*KEY_COLUMNS, *LABEL_COLUMNS, *features])

    frames = [
        flags.manager_flags(t, cfg, pop),
        pay.payment_features(pay_family, cfg),
        act.activation_family(t, cfg, pop),
        act.snapshot_other_items(t, cfg, pop),
        *pe_frames,
        clicks_wide,
        *[e.build(t, cfg, pop) for e in extra],
    ]
    joined = left_join_features(pop.df.select(*KEY_COLUMNS), frames)
    filled = zero_fill(joined, [*LABEL_COLUMNS, *features])
    spec = DatasetSpec(
        keys=list(KEY_COLUMNS), labels=list(LABEL_COLUMNS), features=features, click_features=click_cols
    )
    return Dataset(filled.select(*[F.col(f"`{c}`") for c in spec.columns]), spec)
