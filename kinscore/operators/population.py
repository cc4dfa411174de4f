"""FE0: the active population and the shared dimension filters.

Population = distinct (user_id, external_id) of non-test users owning a live item in the
jobs category with a revenue payment event in the last ``population_days`` days.

Plan shape: the payment-event fact is reduced to distinct paid item ids first (partial
aggregation on the map side, so a hot item costs one row per task), semi-joined to the
small set of live jobs items on item_id, then joined to the user dimension. Outer joins in
the original text are written as inner joins (null keys never qualify, semantics note 4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import JobConfig
from ..functions.predicates import closed_window, is_false, is_true
from ..sources.tables import Tables


# a category dimension (hundreds to thousands of rows) is broadcast only below this count
MAX_BROADCAST_CATEGORIES = 1_000_000


def jobs_category_ids(t: Tables, cfg: JobConfig) -> DataFrame:
    """Categories in the jobs vertical/slug (J4 subquery); broadcast behind a checked count."""
    c = t.small("categories", MAX_BROADCAST_CATEGORIES)
    return c.where((F.col("vertical") == cfg.jobs_vertical) & (F.col("slug") == cfg.jobs_slug)).select(
        "category_id"
    )


def category_ids_with_cat(t: Tables, cat_ids) -> DataFrame:
    c = t.small("categories", MAX_BROADCAST_CATEGORIES)
    return c.where(F.col("cat_id").isin(list(cat_ids))).select("category_id")


def live_jobs_items(t: Tables, cfg: JobConfig) -> DataFrame:
    """Items with ``is_dead = false`` in a jobs category (J4 semi join on category)."""
    return (
        t.items.where(is_false("is_dead"))
        .select("item_id", "user_id", "category_id", "attr1", "attr2")
        .join(jobs_category_ids(t, cfg), "category_id", "left_semi")
    )


def test_user_ids(t: Tables) -> DataFrame:
    return t.users.where(is_true("is_test") & F.col("user_id").isNotNull()).select("user_id")


def non_test_users(t: Tables) -> DataFrame:
    """J5 ``user_id not in (select user_id from users where is_test)``: an anti join, since a
    user may have several rows and one test row excludes the user. Null user ids are dropped
    (they never join), so the null-aware form is not needed."""
    known = t.users.where(F.col("user_id").isNotNull()).select("user_id", "external_id")
    return known.join(test_user_ids(t), "user_id", "left_anti")


def active_population(t: Tables, cfg: JobConfig) -> DataFrame:
    paid_items = (
        t.payment_events.where(
            closed_window("event_time", cfg.as_of, cfg.population_days) & is_true("is_revenue")
        )
        .select("item_id")
        .distinct()
    )
    owners = live_jobs_items(t, cfg).join(paid_items, "item_id", "left_semi").select("user_id").distinct()
    return non_test_users(t).join(owners, "user_id", "inner").select("user_id", "external_id").distinct()


class Population:
    """The population plus what we know about its size.

    ``rows`` is a checked row count (``None`` = unknown). Features restrict facts to the
    population in one of two exact ways:

    * small, counted population: broadcast its ids and semi-join the fact on the map side
      before aggregating (no shuffle of the fact);
    * otherwise: aggregate the fact first (partial aggregation collapses hot users before
      the shuffle) and semi-join the per-user result, which is already hash-partitioned on
      ``user_id``.

    Both give the same rows because the aggregates are grouped by the restricting key.
    """

    def __init__(self, df: DataFrame, rows: int | None = None, broadcast_max_rows: int = 2_000_000):
        self.df = df
        self.rows = rows
        self.broadcast_max_rows = broadcast_max_rows

    @property
    def ids(self) -> DataFrame:
        return self.df.select("user_id")

    @property
    def small(self) -> bool:
        return self.rows is not None and self.rows <= self.broadcast_max_rows

    def semi(self, df: DataFrame, key: str = "user_id") -> DataFrame:
        ids = self.ids if key == "user_id" else self.ids.withColumnRenamed("user_id", key)
        return df.join(F.broadcast(ids) if self.small else ids, key, "left_semi")

    def scope(self, fact: DataFrame, aggregate) -> DataFrame:
        """``aggregate`` must group by ``user_id``.

        The large-population path joins the aggregate to the distinct population ids with an
        *inner* join: Catalyst pushes a left-semi join below an aggregate on its grouping key
        (which would shuffle every fact row by user before any map-side reduction), but not
        an inner join. With unique ids both keep exactly the population's groups."""
        if self.small:
            return aggregate(self.semi(fact))
        return aggregate(fact).join(self.ids.distinct(), "user_id", "inner")


def as_population(pop) -> Population:
    return pop if isinstance(pop, Population) else Population(pop)


def materialize_population(df: DataFrame, broadcast_max_rows: int = 2_000_000) -> Population:
    """Write the population once to the reliable checkpoint folder and count it.

    Every feature family reads the population; checkpointing cuts its lineage (a lost
    executor re-reads the files instead of rescanning 30 days of payment events) and the
    count is the size check behind the broadcast decision."""
    from ..session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    saved = df.checkpoint(eager=True)
    return Population(saved, saved.count(), broadcast_max_rows)
