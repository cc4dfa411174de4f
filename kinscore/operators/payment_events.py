"""Payment-event family: FE11 count_items_180, FE12 count_payments_180, FE13 service counts,
FE15 attr1 counts, FE16 attr2 counts.

All of them read payment events of the last ``long_days`` days on live jobs items owned by the
population, at two small grains:

* item grain (FE11, FE15, FE16): the events are counted per item *before* they meet the item
  dimension, so a hot item is one row per task in the shuffle and one row in the join. The
  result (user, item, attr1, attr2, n_rev) is checkpointed: value discovery and both
  branches read it, and it is as small as the population's items.
* operation grain (FE12, FE13): revenue events joined to the items, reduced to one row per
  (user, operation) with a flag per service subtype, then per user: distinct counts, exact and
  without an Expand. The aggregate's keys differ from the join's, so there is an exchange
  between them and adaptive execution may split a hot item's join partition.

FE15/FE16 group by (user, value) and pivot to the values seen; the long form is available
for consumers that do not want columns, and nothing caps the number of values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig
from ..functions.predicates import closed_window
from ..functions.text import assert_unique_names, slug, underscore_spaces
from ..session import ensure_checkpoint_dir
from ..sources.tables import Tables
from .population import as_population, live_jobs_items

ATTRS = ("attr1", "attr2")


def service_columns(cfg: JobConfig) -> list[str]:
    return [underscore_spaces(s) for s in cfg.services]


def _events(t: Tables, cfg: JobConfig) -> DataFrame:
    rev = F.coalesce(F.col("is_revenue") == F.lit(True), F.lit(False))
    window = t.payment_events.where(closed_window("event_time", cfg.as_of, cfg.long_days))
    return window.select("item_id", "operation_id", "subtype", rev.alias("rev"))


def _items(t: Tables, cfg: JobConfig, population) -> DataFrame:
    return as_population(population).semi(live_jobs_items(t, cfg)).select("item_id", "user_id", *ATTRS)


def item_grain(t: Tables, cfg: JobConfig, population) -> DataFrame:
    """(user_id, item_id, attr1, attr2, n_rev) for every item with a payment event."""
    per_item = _events(t, cfg).groupBy("item_id").agg(F.count(F.when(F.col("rev"), 1)).alias("n_rev"))
    grain = per_item.join(_items(t, cfg, population), "item_id", "inner")
    ensure_checkpoint_dir(grain.sparkSession)
    return grain.checkpoint(eager=True)


def item_counts(grain: DataFrame) -> DataFrame:
    """FE11: (user_id, count_items_180)."""
    return grain.groupBy("user_id").agg(F.countDistinct("item_id").alias("count_items_180"))


def attr_counts(grain: DataFrame, cfg: JobConfig, attr: str) -> DataFrame:
    """FE15/FE16 in long form: (user_id, feature, cnt) over revenue rows; null and empty values are
    skipped (semantics note 6), the feature is prefix + slug of the value."""
    prefix = getattr(cfg, f"{attr}_prefix")
    rows = grain.where((F.col("n_rev") > 0) & F.col(attr).isNotNull() & (F.col(attr) != ""))
    counted = rows.groupBy("user_id", F.col(attr).alias("value")).agg(F.sum("n_rev").cast("double").alias("cnt"))
    return counted.select("user_id", F.concat(F.lit(prefix), slug("value")).alias("feature"), "cnt", "value")


def attr_features(counts: DataFrame) -> list[str]:
    """Column names of the values seen, in the order of the values. They become columns, so the
    driver has to know them; two values with one slug fail (they would share a column)."""
    rows = counts.select("value", "feature").distinct().collect()
    names = [r["feature"] for r in sorted(rows, key=lambda r: r["value"])]
    if "" in names:
        raise ValueError("an attribute value has no letters or digits: give the family a prefix")
    assert_unique_names(names)
    return names


def operation_branch(t: Tables, cfg: JobConfig, population) -> DataFrame:
    """FE12, FE13: (user_id, count_payments_180, one column per service)."""
    flags = [(F.col("subtype") == F.lit(s)).cast("int").alias(f"s_{i}") for i, s in enumerate(cfg.services)]
    paid = _events(t, cfg).where("rev and operation_id is not null").select("item_id", "operation_id", *flags)
    per_operation = (
        paid.join(_items(t, cfg, population).select("item_id", "user_id"), "item_id", "inner")
        .groupBy("user_id", "operation_id")
        .agg(F.count(F.lit(1)).alias("n"), *[F.max(f"s_{i}").alias(f"s_{i}") for i in range(len(cfg.services))])
    )
    return per_operation.groupBy("user_id").agg(
        F.count("operation_id").alias("count_payments_180"),
        *[F.sum(F.coalesce(f"s_{i}", F.lit(0))).cast("long").alias(c) for i, c in enumerate(service_columns(cfg))],
    )


def payment_event_family(t: Tables, cfg: JobConfig, population) -> tuple[list[DataFrame], list[str], list[str]]:
    """(frames keyed by user_id, attr1 columns, attr2 columns) for the assembled dataset."""
    grain = item_grain(t, cfg, population)
    frames, columns = [item_counts(grain), operation_branch(t, cfg, population)], []
    for attr in ATTRS:
        counts = attr_counts(grain, cfg, attr)
        names = attr_features(counts)
        columns.append(names)
        if names:
            frames.append(counts.groupBy("user_id").pivot("feature", names).agg(F.sum("cnt")))
    assert_unique_names(["count_items_180", "count_payments_180", *service_columns(cfg), *columns[0], *columns[1]])
    return frames, columns[0], columns[1]


def long_counts(family: DataFrame, columns: list[str]) -> DataFrame:
    """(user_id, feature, cnt) of the columns that are not zero."""
    parts = [F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("cnt")) for c in columns]
    if not parts:
        return family.select("user_id", F.lit("").alias("feature"), F.lit(0.0).alias("cnt")).where(F.lit(False))
    return family.select("user_id", F.inline(F.array(*parts))).where("cnt > 0")
