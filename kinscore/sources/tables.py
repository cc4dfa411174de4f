"""Input tables.

The pipeline reads nine logical tables (users, items, categories, payment_events,
payments, activations, item_days, manager_days, clicks) plus the event catalog.
``Tables`` bundles them as lazy DataFrames; every builder selects only the columns it
needs, so Catalyst prunes the parquet ``ReadSchema`` and pushes the date predicates into
the scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# logical schema every source must provide (FIXTURES.md §1)
SCHEMAS = {
    "users": ["user_id", "external_id", "is_test"],
    "items": ["item_id", "user_id", "category_id", "is_dead", "attr1", "attr2"],
    "categories": ["category_id", "vertical", "slug", "cat_id"],
    "payment_events": ["item_id", "event_time", "is_revenue", "subtype", "operation_id"],
    "payments": [
        "user_id",
        "amount_net",
        "event_time",
        "is_revenue",
        "is_dead",
        "is_test",
        "cat_id",
        "tx_type",
        "subtype",
        "fact_id",
    ],
    "activations": ["item_id", "activation_time", "activation_type"],
    "item_days": ["item_id", "event_date"],
    "manager_days": ["user_id", "event_date", "team"],
    "clicks": ["user_id", "eid", "event_date"],
    "event_catalog": ["name", "description", "sort_key", "eid"],
}


@dataclass
class Tables:
    users: DataFrame
    items: DataFrame
    categories: DataFrame
    payment_events: DataFrame
    payments: DataFrame
    activations: DataFrame
    item_days: DataFrame
    manager_days: DataFrame
    clicks: DataFrame
    event_catalog: DataFrame

    def small(self, name: str, max_rows: int) -> DataFrame:
        """Table ``name`` with a broadcast hint when it has at most ``max_rows`` rows.

        The row count is checked once per table (a ``limit`` job over that table only) and
        remembered; above the bound the table is returned unhinted and AQE decides."""
        cache = self.__dict__.setdefault("_small", {})
        if name not in cache:
            cache[name] = getattr(self, name).limit(max_rows + 1).count() <= max_rows
        df = getattr(self, name)
        return F.broadcast(df) if cache[name] else df

    def validate(self) -> "Tables":
        for name, cols in SCHEMAS.items():
            have = set(getattr(self, name).columns)
            missing = [c for c in cols if c not in have]
            if missing:
                raise ValueError(f"table {name} lacks columns {missing}")
        return self


def read_parquet_tables(spark: SparkSession, root: str, event_catalog: DataFrame | None = None) -> Tables:
    """Read the logical tables stored as ``<root>/<name>`` parquet datasets; a given
    ``event_catalog`` takes the place of ``<root>/event_catalog``."""
    given = {} if event_catalog is None else {"event_catalog": event_catalog}
    read = {name: spark.read.parquet(f"{root}/{name}") for name in SCHEMAS if name not in given}
    return Tables(**read, **given).validate()


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
