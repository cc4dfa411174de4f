"""Plan-level invariants: both population strategies agree, feature hook, catalog checks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kinscore.config import driver_config, production_config
from kinscore.operators.assemble import FeatureSpec, duplicate_keys
from kinscore.operators.population import Population, active_population, materialize_population
from kinscore.plans.dataset import build_dataset
from kinscore.sources.adapters import driver_tables
from kinscore.sources.catalog import catalog_problems

SF = "/root/testdata/sf0.001"
CFG = driver_config()


def _sorted(df):
    pdf = df.toPandas()
    return pdf.sort_values("user_id").reset_index(drop=True)


def test_broadcast_and_aggregate_first_paths_agree(spark):
    t = driver_tables(spark, SF)
    pop_df = active_population(t, CFG)
    big = build_dataset(t, CFG, Population(pop_df))  # unknown size: aggregate first
    small = build_dataset(t, CFG, materialize_population(pop_df))  # counted: broadcast ids
    a, b = _sorted(big.df), _sorted(small.df)
    assert list(a.columns) == list(b.columns)
    assert a.equals(b)
    assert duplicate_keys(big.df).count() == 0


def test_feature_hook(spark):
    t = driver_tables(spark, SF)

    def orders_count(tables, cfg, population):
        return tables.items.groupBy("user_id").agg(F.count(F.lit(1)).cast("double").alias("orders_total"))

    ds = build_dataset(t, CFG, extra=[FeatureSpec("orders_total", orders_count)])
    assert ds.spec.features[-1] == "orders_total"
    assert ds.df.where(F.col("orders_total") <= 0).count() == 0  # every active user has orders
    with pytest.raises(ValueError):
        FeatureSpec("", orders_count)
    bad = FeatureSpec("x", lambda tables, cfg, pop: tables.items.select("user_id"))
    with pytest.raises(ValueError):
        build_dataset(t, CFG, extra=[bad])
    twice = FeatureSpec("x", lambda tables, cfg, pop: tables.items.select("user_id", F.lit(1.0).alias("x")))
    with pytest.raises(ValueError, match="more than one row"):
        build_dataset(t, CFG, extra=[twice])


def test_catalog_problems(spark):
    cat = spark.createDataFrame(
        [("a", "d", 1, 10), ("b", "d", 2, 10), ("a", "d", 3, 11), ("c", "d", 4, None)],
        "name string, description string, sort_key long, eid int",
    )
    got = sorted((r["problem"], r["value"]) for r in catalog_problems(cat).collect())
    assert got == [("duplicate eid", "10"), ("duplicate name", "a"), ("null eid", "c")]


def test_production_names_are_unique():
    cfg = production_config()
    names = [s.replace(" ", "_") for s in (*cfg.services, *cfg.tariffs)]
    assert len(set(n.lower() for n in names)) == len(names) == 17
