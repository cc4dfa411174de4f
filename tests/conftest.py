from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from kinscore.session import ensure_checkpoint_dir  # noqa: E402
from kinscore.sources.tables import Tables  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]")
        .appName("kinscore-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture(scope="module", autouse=True)
def nothing_cached(spark):
    """A module's cached frames end with it: others look at what is left in the executors' memory."""
    yield
    spark.catalog.clearCache()


AS_OF = dt.date(2001, 6, 30)


def ts(day: dt.date, h=0, m=0, s=0) -> dt.datetime:
    return dt.datetime(day.year, day.month, day.day, h, m, s)


def days_ago(n: int) -> dt.date:
    return AS_OF - dt.timedelta(days=n)


SCHEMAS = {
    "users": "user_id long, external_id long, is_test boolean",
    "items": "item_id long, user_id long, category_id long, is_dead boolean, attr1 string, attr2 string",
    "categories": "category_id long, vertical string, slug string, cat_id long",
    "payment_events": "item_id long, event_time timestamp_ntz, is_revenue boolean, subtype string, operation_id string",
    "payments": (
        "user_id long, amount_net decimal(18,4), event_time timestamp_ntz, is_revenue boolean, is_dead boolean, "
        "is_test boolean, cat_id long, tx_type string, subtype string, fact_id string"
    ),
    "activations": "item_id long, activation_time timestamp_ntz, activation_type string",
    "item_days": "item_id long, event_date date",
    "manager_days": "user_id long, event_date date, team string",
    "clicks": "user_id long, eid int, event_date date",
    "event_catalog": "name string, description string, sort_key long, eid int",
}

DEFAULT_CATEGORIES = [(1, "V1", "s1", 6), (2, "V1", "s1", 6), (3, "V2", "s2", 9), (4, "V1", "s1", 4), (5, "V2", "s2", 9)]


def make_tables(spark, **rows) -> Tables:
    """Tiny hand-made tables; unspecified ones are empty (categories default to the driver's)."""
    rows.setdefault("categories", DEFAULT_CATEGORIES)
    frames = {}
    for name, schema in SCHEMAS.items():
        frames[name] = spark.createDataFrame(rows.get(name, []), schema)
    return Tables(**frames).validate()
