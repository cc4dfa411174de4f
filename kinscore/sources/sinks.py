"""Sinks S5-S8: dataset and last list (overwrite), history (append per ``date_rec``
partition), run log (append, JSON comment)."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("date_time", T.TimestampType()),
        T.StructField("task", T.StringType()),
        T.StructField("operation", T.StringType()),
        T.StructField("comment", T.StringType()),
    ]
)


def write_dataset(df: DataFrame, path: str) -> None:
    """Replace the dataset (column names may vary run to run, so no append)."""
    df.write.mode("overwrite").parquet(path)


def write_last_list(df: DataFrame, path: str) -> None:
    """Replace the last list."""
    df.write.mode("overwrite").parquet(path)


def append_history(df: DataFrame, path: str, date_rec: dt.date | None = None) -> None:
    """Append with ``date_rec`` (default today). Partitioned by ``date_rec`` so the
    180-day read prunes files; ``partitionOverwriteMode=dynamic`` makes a rerun of the same
    day replace that day's partition instead of duplicating it."""
    day = F.lit(date_rec) if date_rec else F.current_date()
    writer = df.withColumn("date_rec", day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date_rec").parquet(path)


def read_history(spark: SparkSession, path: str) -> DataFrame | None:
    """The history, or None when its folder does not exist yet (the first run). Any other
    failure to read it fails the run: without the history nobody would be excluded."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def comment_row(values: DataFrame, task: str, operation: str) -> DataFrame:
    """(task, operation, comment) with the one row of ``values`` as JSON."""
    return values.select(
        F.lit(task).alias("task"), F.lit(operation).alias("operation"), F.to_json(F.struct("*")).alias("comment")
    )


def label_balance(dataset: DataFrame) -> DataFrame:
    """A10: row count and the counts of both labels."""
    return dataset.agg(
        F.count(F.lit(1)).alias("dataset_length"),
        F.count(F.when(F.col("is_asd") == 1, 1)).alias("asd"),
        F.count(F.when(F.col("is_asd") == 0, 1)).alias("non_asd"),
    )


def balance_log_row(dataset: DataFrame, task: str, operation: str, **extra) -> DataFrame:
    """S8 for the dataset stage: the label balance, and ``extra`` values."""
    counts = label_balance(dataset).select("*", *[F.lit(v).alias(k) for k, v in extra.items()])
    return comment_row(counts, task, operation)


def dict_log_row(spark: SparkSession, task: str, operation: str, comment: dict) -> DataFrame:
    """S8 for the scoring stage, whose metrics are driver-side numbers."""
    row = [(task, operation, json.dumps(comment, default=str))]
    return spark.createDataFrame(row, "task string, operation string, comment string")


def append_run_log(row: DataFrame, path: str) -> None:
    stamped = row.select(F.current_timestamp().alias("date_time"), "task", "operation", "comment")
    stamped.coalesce(1).write.mode("append").parquet(path)
