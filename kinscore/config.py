"""Job parameters.

One explicit object instead of module globals: every builder takes a ``JobConfig``.
``driver_config()`` returns the parameters that map the pipeline onto the driver's
TPC-H-like tables (see FIXTURES.md); ``production_config()`` holds the business values
of the original job.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class OrRule:
    """Composite business rule P10: ``cat = a`` or (``cat = b`` and ``tx = t``) or ``subtype ilike p``."""

    main_cat_id: int
    second_cat_id: int
    second_tx_type: str
    subtype_pattern: str


@dataclass(frozen=True)
class JobConfig:
    # anchors (F11): commerce facts and clickstream may have their own reference day
    as_of: dt.date
    click_as_of: dt.date

    # population (FE0): "jobs vacancies" category and look-back
    jobs_vertical: str
    jobs_slug: str
    population_days: int = 30

    # manager assignment flags (FE1-FE3)
    team_pattern: str = "%asia%"

    # activations (FE6-FE8) and snapshot (FE9)
    activation_cat_id: int = 6
    paid_activation_types: tuple[str, ...] = ()
    excluded_snapshot_cat_ids: tuple[int, ...] = ()

    # payments family (FE4, FE5, FE10, FE14)
    revenue_rule: OrRule = OrRule(6, 4, "A", "%prom%")
    tariff_rule: OrRule = OrRule(6, 4, "A", "%prom%")
    services: tuple[str, ...] = ()
    tariffs: tuple[str, ...] = ()

    # dynamic families: column prefixes keep Param1/Param2 slugs apart (collisions fail)
    attr1_prefix: str = "p1_"
    attr2_prefix: str = "p2_"
    click_suffix: str = "_csf"
    click_days: int = 90

    # long look-back for the 180-day features
    long_days: int = 180

    # recommendation
    n_rec: int = 1000
    thresholds: dict = field(default_factory=lambda: {"knn": 0.0, "logreg": 0.5, "xgb": 0.5})
    history_days: int = 180
    knn_fill: float = -10.0
    knn_revenue_floor: float = -0.05
    knn_revenue_feature: str = "revenue_180"
    seed: int = 17

    # models
    logreg_c_grid: tuple[float, ...] = (0.1, 1.0, 2.0)
    logreg_weightings: tuple[str, ...] = ("none", "ten_to_one", "balanced")
    cv_folds: int = 3
    gbt_params: dict = field(
        default_factory=lambda: {
            "maxIter": 100,
            "stepSize": 0.1,
            "subsamplingRate": 0.7,
            "maxDepth": 10,
            "featureSubsetStrategy": "0.5",
            "minInstancesPerNode": 10,
        }
    )
    # "spark_ml" (GBTClassifier, the settings above) or "second_order" (operators/boosting.py, the settings below)
    tree_engine: str = "spark_ml"
    tree_params: dict = field(
        default_factory=lambda: {
            "rounds": 100,
            "depth": 10,
            "learning_rate": 0.1,
            "subsample": 0.7,
            "columns": 0.5,
            "l1": 0.5,
            "min_hessian": 10.0,
        }
    )
    # features whose name is in this list are not given to the models (label leakage guard)
    exclude_features: tuple[str, ...] = ()

    def with_(self, **kw) -> "JobConfig":
        return replace(self, **kw)


def driver_config(**overrides) -> JobConfig:
    """Parameters for the driver tables (FIXTURES.md §2)."""
    cfg = JobConfig(
        as_of=dt.date(2001, 6, 30),
        click_as_of=dt.date(2024, 1, 30),
        jobs_vertical="V1",
        jobs_slug="s1",
        team_pattern="%asia%",
        activation_cat_id=6,
        paid_activation_types=("ECONOMY", "STANDARD", "PROMO"),
        excluded_snapshot_cat_ids=(4, 6),
        revenue_rule=OrRule(6, 4, "A", "%prom%"),
        tariff_rule=OrRule(6, 4, "A", "%prom%"),
        services=("PROMO", "ECONOMY", "STANDARD"),
        tariffs=("LARGE", "SMALL", "MEDIUM"),
    )
    return cfg.with_(**overrides) if overrides else cfg


def production_config(as_of: dt.date | None = None, **overrides) -> JobConfig:
    """Business values of the original job; ``as_of`` defaults to today − 2 days."""
    day = as_of or (dt.date.today() - dt.timedelta(days=2))
    # Fixed values that must equal the original job's (category ids, subtype names, activation
    # types, team pattern, rule spellings). Two spellings of the composite rule exist on purpose.
    cfg = JobConfig(
        as_of=day,
        click_as_of=day,
        jobs_vertical="Jobs",
        jobs_slug="vakansii",
        team_pattern="%работа%",
        activation_cat_id=250006,
        paid_activation_types=(
            "Package",
            "Package_subs_afterpaid",
            "Package_subs_prepaid",
            "Single",
            "Single_subs_afterpaid",
        ),
        excluded_snapshot_cat_ids=(250004, 250006),
        revenue_rule=OrRule(250006, 250004, "paid_contact", "%jobs%"),
        tariff_rule=OrRule(250006, 250004, "paid contact", "%job%"),
        services=(
            "Highlight",
            "XL",
            "max single",
            "mid single",
            "x10_1",
            "x10_7",
            "x2_1",
            "x2_7",
            "x5_1",
            "x5_7",
        ),
        tariffs=(
            "tariff ext Job",
            "tariff ext Job ASD",
            "tariff max Job",
            "tariff max Job ASD",
            "tariff lf package",
            "single view",
            "view from package",
        ),
        attr1_prefix="",
        attr2_prefix="",
    )
    return cfg.with_(**overrides) if overrides else cfg
