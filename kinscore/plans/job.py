"""The whole job: dataset → sinks → recommendation → sinks, with run-log rows.

Layout under ``out_root``: ``dataset/``, ``rec_last/``, ``recommendations/`` (partitioned by
``date_rec``), ``runlog/``. Every intermediate that several stages read is written once
(population to the checkpoint folder, dataset as parquet), so a lost executor costs a
re-read, not a rescan of the facts.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig
from ..operators.population import active_population, materialize_population
from ..sources import sinks
from ..sources.tables import Tables
from .dataset import Dataset, build_dataset
from .recommend import recommend


def collect_dataset(spark: SparkSession, t: Tables, cfg: JobConfig, out_root: str) -> Dataset:
    start = time.time()
    pop = materialize_population(active_population(t, cfg))
    ds = build_dataset(t, cfg, pop)
    sinks.write_dataset(ds.df, f"{out_root}/dataset")
    # later stages read the written table, not the feature plan
    stored = Dataset(spark.read.parquet(f"{out_root}/dataset"), ds.spec)
    duration = f"{time.time() - start:.1f}s"
    row = sinks.balance_log_row(stored.df, "lookalike", "collect_dataset", duration=duration)
    sinks.append_run_log(row, f"{out_root}/runlog")
    return stored


def get_recommendations(
    spark: SparkSession, ds: Dataset, cfg: JobConfig, out_root: str, today: dt.date | None = None
):
    start = time.time()
    today = today or dt.date.today()
    history = sinks.read_history(spark, f"{out_root}/recommendations")
    if history is not None:
        # a retried run must not see its own day's partition (the write replaces it)
        history = history.where(F.col("date_rec") != F.lit(today))
    rec = recommend(ds, cfg, history, today)
    sinks.write_last_list(rec.rows, f"{out_root}/rec_last")
    last = spark.read.parquet(f"{out_root}/rec_last")
    sinks.append_history(last, f"{out_root}/recommendations", today)
    log = dict(rec.log)
    log["selection"] = dict(log["selection"], stored=last.count())
    log["duration"] = f"{time.time() - start:.1f}s"
    sinks.append_run_log(sinks.dict_log_row(spark, "lookalike", "get_recommendations", log), f"{out_root}/runlog")
    return last, log


def run_job(spark: SparkSession, t: Tables, cfg: JobConfig, out_root: str, today: dt.date | None = None):
    ds = collect_dataset(spark, t, cfg, out_root)
    return get_recommendations(spark, ds, cfg, out_root, today)

