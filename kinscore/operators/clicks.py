"""FE17: clickstream counts per (user, event), pivoted to one ``<slug>_csf`` column per event.

Plan: the click fact is filtered by day (pushed into the scan), restricted to catalog
events by a broadcast semi join (the catalog's size is bounded by the catalog, not by the
clickstream), counted per (user, eid) with map-side partial aggregation, and only then
given names and pivoted. The pivot gets its value list explicitly (no extra distinct job
inside ``pivot``); by default the list is the events actually seen, as in the original job,
and ``all_catalog=True`` fixes the schema to the whole catalog. The small per-(user, event)
counts are checkpointed, so the discovery does not rescan the clickstream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig
from ..functions.predicates import closed_window
from ..functions.text import assert_unique_names, slug
from ..session import ensure_checkpoint_dir
from ..sources.catalog import MAX_CATALOG_ROWS, checked_catalog
from ..sources.tables import Tables
from .population import as_population


def catalog_names(t: Tables, cfg: JobConfig) -> DataFrame:
    """(eid, feature) with feature = slug(name) + suffix; the CASE of the original as a
    (broadcast, size-checked) join."""
    return t.small("event_catalog", MAX_CATALOG_ROWS).select(
        "eid", F.concat(slug("name"), F.lit(cfg.click_suffix)).alias("feature")
    )


def click_counts(t: Tables, cfg: JobConfig, population) -> DataFrame:
    """(user_id, eid, cnt) for population users, catalog events, last ``click_days`` days."""
    pop = as_population(population)
    # broadcast behind the catalog's row count, checked once per run
    catalog = t.small("event_catalog", MAX_CATALOG_ROWS)
    clicks = (
        t.clicks.where(closed_window("event_date", cfg.click_as_of, cfg.click_days))
        .select("user_id", "eid")
        .join(catalog.select("eid").distinct(), "eid", "left_semi")
    )

    def aggregate(df: DataFrame) -> DataFrame:
        return df.groupBy("user_id", "eid").agg(F.count(F.lit(1)).alias("cnt"))

    return pop.scope(clicks, aggregate)


def named_click_counts(t: Tables, cfg: JobConfig, population) -> DataFrame:
    """(user_id, feature, cnt): counts with the event's column name (P12 via broadcast join)."""
    return click_counts(t, cfg, population).join(catalog_names(t, cfg), "eid", "inner").select(
        "user_id", "feature", F.col("cnt").cast("double").alias("cnt")
    )


def click_feature_names(t: Tables, cfg: JobConfig, counts: DataFrame | None = None) -> list[str]:
    """Pivot values: names of events seen in ``counts`` (or the whole catalog), sorted."""
    src = catalog_names(t, cfg)
    if counts is not None:
        src = src.join(counts.select("eid").distinct(), "eid", "left_semi")
    checked_catalog(t.event_catalog)  # one column per event: a larger catalog fails here, before the collect
    names = sorted(r[0] for r in src.select("feature").distinct().collect())
    assert_unique_names(names)
    return names


def click_pivot(t: Tables, cfg: JobConfig, population, all_catalog: bool = False) -> tuple[DataFrame, list[str]]:
    """The counts per (user, event) are small (users × events seen) and read twice, by the
    name discovery and by the pivot, so they are checkpointed instead of rescanning clicks."""
    counts = click_counts(t, cfg, population)
    ensure_checkpoint_dir(counts.sparkSession)
    counts = counts.checkpoint(eager=True)
    names = click_feature_names(t, cfg, None if all_catalog else counts)
    named = counts.join(catalog_names(t, cfg), "eid", "inner")
    wide = named.groupBy("user_id").pivot("feature", names).agg(F.sum("cnt"))
    return wide.select("user_id", *[F.col(f"`{n}`").cast("double").alias(n) for n in names]), names
