"""Event catalog (S4): (name, description, sort_key, eid) rows.

The catalog is a small dimension (hundreds of rows). It is loaded from a file that the
user provides (csv with a header, json lines or parquet) rather than compiled into code,
and joined with a broadcast hint: its size is bounded by the catalog itself, not by the
clickstream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CATALOG_SCHEMA = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("sort_key", T.LongType()),
        T.StructField("eid", T.IntegerType()),
    ]
)

# Fixed values of the driver mapping: the five event types of the `events` table.
DRIVER_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

# largest catalog we agree to broadcast; the original catalog has 649 rows
MAX_CATALOG_ROWS = 100_000


def driver_event_catalog(spark: SparkSession) -> DataFrame:
    """Catalog for the driver's events: name = event type, eid = the driver id rule."""
    from .adapters import click_eid

    rows = spark.createDataFrame(
        [(name, i + 1) for i, name in enumerate(DRIVER_EVENT_TYPES)], "event_type string, sort_key long"
    )
    return rows.select(
        F.initcap("event_type").alias("name"),
        F.concat(F.lit("driver events / "), F.col("event_type")).alias("description"),
        F.col("sort_key"),
        click_eid(F.col("event_type")).alias("eid"),
    )


def load_event_catalog(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """The catalog from a csv (with header), json-lines or parquet file; the format follows the
    file's ending unless given. A catalog that breaks an invariant fails here."""
    kind = fmt or path.rstrip("/").rsplit(".", 1)[-1].lower()
    reader = spark.read.schema(CATALOG_SCHEMA)
    if kind == "csv":
        df = reader.option("header", True).csv(path)
    elif kind in ("json", "jsonl"):
        df = reader.json(path)
    elif kind == "parquet":
        df = spark.read.parquet(path).select(*[F.col(f.name).cast(f.dataType) for f in CATALOG_SCHEMA])
    else:
        raise ValueError(f"catalog {path}: expected csv, json, jsonl or parquet")
    problems = catalog_problems(df).limit(5).collect()
    if problems:
        raise ValueError("event catalog: " + ", ".join(f"{r['problem']} {r['value']}" for r in problems))
    return df


def checked_catalog(catalog: DataFrame) -> DataFrame:
    """Events become columns: prove the catalog's size before names are collected."""
    n = catalog.limit(MAX_CATALOG_ROWS + 1).count()
    if n > MAX_CATALOG_ROWS:
        raise ValueError(f"event catalog has more than {MAX_CATALOG_ROWS} rows; too many for columns")
    return catalog


def catalog_problems(catalog: DataFrame) -> DataFrame:
    """One row per violated catalog invariant: duplicate name, eid or sort_key, or null eid."""
    checks = []
    for col in ("name", "eid", "sort_key"):
        checks.append(
            catalog.where(F.col(col).isNotNull())
            .groupBy(col)
            .count()
            .where("count > 1")
            .select(F.lit(f"duplicate {col}").alias("problem"), F.col(col).cast("string").alias("value"))
        )
    checks.append(
        catalog.where(F.col("eid").isNull()).select(
            F.lit("null eid").alias("problem"), F.col("name").alias("value")
        )
    )
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out
