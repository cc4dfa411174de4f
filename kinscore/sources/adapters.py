"""Adapters from the driver's TPC-H-like tables to the pipeline's logical tables.

The mapping is FIXTURES.md §2; the DuckDB oracle inlines the same definitions as CTEs
(``kinscore.plans.oracle``). Every adapter is a lazy projection/join, so column pruning
and filter pushdown reach the driver parquet scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .catalog import driver_event_catalog
from .tables import Tables, read_driver_table

# Fixed values of the driver mapping: category rows (category_id, vertical, slug, cat_id).
DRIVER_CATEGORIES = [
    (1, "V1", "s1", 6),
    (2, "V1", "s1", 6),
    (3, "V2", "s2", 9),
    (4, "V1", "s1", 4),
    (5, "V2", "s2", 9),
]

CATEGORY_SCHEMA = T.StructType(
    [
        T.StructField("category_id", T.LongType()),
        T.StructField("vertical", T.StringType()),
        T.StructField("slug", T.StringType()),
        T.StructField("cat_id", T.LongType()),
    ]
)

MONEY = T.DecimalType(18, 4)


def click_eid(event_type):
    """Driver rule giving every event type a stable integer id: 100·ascii(first char) + length."""
    return (F.ascii(event_type) * 100 + F.length(event_type)).cast("int")


def _items(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("item_id"),
        F.col("o_custkey").alias("user_id"),
        F.substring("o_orderpriority", 1, 1).cast("long").alias("category_id"),
        (F.col("o_orderstatus") == "F").alias("is_dead"),
        F.col("o_orderpriority").alias("attr1"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("attr2"),
    )


def _users(customer: DataFrame) -> DataFrame:
    return customer.select(
        F.col("c_custkey").alias("user_id"),
        (F.col("c_custkey") + 1000000).alias("external_id"),
        (F.col("c_acctbal") < -500).alias("is_test"),
    )


def _line_events(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    # part is a dimension keyed by p_partkey; lineitem is the fact
    return lineitem.join(part, F.col("l_partkey") == F.col("p_partkey"), "inner")


def _operation_id():
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


def driver_tables(spark: SparkSession, sf_dir: str) -> Tables:
    read = lambda name: read_driver_table(spark, sf_dir, name)
    customer, orders, lineitem, part = read("customer"), read("orders"), read("lineitem"), read("part")
    nation, region, events = read("nation"), read("region"), read("events")

    users = _users(customer)
    items = _items(orders)
    categories = spark.createDataFrame(DRIVER_CATEGORIES, CATEGORY_SCHEMA)

    payment_events = _line_events(lineitem, part).select(
        F.col("l_orderkey").alias("item_id"),
        F.col("l_shipdate").alias("event_time"),
        (F.col("l_linestatus") == "O").alias("is_revenue"),
        F.col("p_type").alias("subtype"),
        _operation_id().alias("operation_id"),
    )

    # the 5-row category table has a literal size bound, so broadcasting it is safe
    payments = (
        _line_events(lineitem, part)
        .join(items.withColumnRenamed("item_id", "l_orderkey"), "l_orderkey", "inner")
        .join(users.select("user_id", "is_test"), "user_id", "left")
        .join(F.broadcast(categories.select("category_id", "cat_id")), "category_id", "left")
        .select(
            "user_id",
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast(MONEY).alias("amount_net"),
            F.col("l_shipdate").alias("event_time"),
            (F.col("l_linestatus") == "O").alias("is_revenue"),
            "is_dead",
            "is_test",
            "cat_id",
            F.col("l_returnflag").alias("tx_type"),
            F.col("p_type").alias("subtype"),
            _operation_id().alias("fact_id"),
        )
    )

    activations = _line_events(lineitem, part).select(
        F.col("l_orderkey").alias("item_id"),
        F.col("l_shipdate").alias("activation_time"),
        F.col("p_type").alias("activation_type"),
    )

    item_days = lineitem.select(
        F.col("l_orderkey").alias("item_id"), F.to_date("l_shipdate").alias("event_date")
    ).distinct()

    manager_days = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("o_custkey").alias("user_id"),
            F.last_day(F.to_date("o_orderdate")).alias("event_date"),
            F.col("r_name").alias("team"),
        )
    )

    clicks = events.select(
        "user_id",
        click_eid(F.col("event_type")).alias("eid"),
        F.to_date("ts").alias("event_date"),
    )

    return Tables(
        users=users,
        items=items,
        categories=categories,
        payment_events=payment_events,
        payments=payments,
        activations=activations,
        item_days=item_days,
        manager_days=manager_days,
        clicks=clicks,
        event_catalog=driver_event_catalog(spark),
    ).validate()
