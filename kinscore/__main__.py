"""Command line: build the dataset, then the recommendation list (the whole daily job).

    python -m kinscore --tables <root with the nine parquet tables> --out <output root>
    python -m kinscore --driver-sf /root/testdata/sf0.01 --out /tmp/run-x/out

``--tables`` reads ``<root>/<name>`` parquet datasets with the columns of
``kinscore.sources.tables.SCHEMAS`` and uses the production parameters; ``--driver-sf`` maps
the driver's TPC-H-like tables instead. Outputs: ``dataset/``, ``rec_last/``,
``recommendations/`` (partitioned by ``date_rec``) and ``runlog/`` under ``--out``.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from .config import driver_config, production_config
from .plans.job import collect_dataset, get_recommendations
from .sources.adapters import driver_tables
from .sources.catalog import load_event_catalog
from .sources.tables import read_parquet_tables


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="kinscore")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--tables", help="root folder of the nine input tables (parquet)")
    src.add_argument("--driver-sf", help="folder of the driver's TPC-H-like parquet tables")
    ap.add_argument("--catalog", help="event catalog file (.csv with header, .json lines or .parquet: name, description, sort_key, eid)")
    ap.add_argument("--out", required=True, help="output root (shared storage on a cluster)")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, help="reference day (default: today - 2)")
    ap.add_argument("--today", type=dt.date.fromisoformat, help="day stamped on the history rows")
    ap.add_argument("--n-rec", type=int, help="list size (default 1000)")
    ap.add_argument("--step", choices=["all", "dataset", "recommend"], default="all")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("kinscore").getOrCreate()
    if args.driver_sf:
        tables = driver_tables(spark, args.driver_sf)
        cfg = driver_config()
    else:
        catalog = load_event_catalog(spark, args.catalog) if args.catalog else None
        tables = read_parquet_tables(spark, args.tables, catalog)
        cfg = production_config(args.as_of)
    if args.n_rec:
        cfg = cfg.with_(n_rec=args.n_rec)

    if args.step in ("all", "dataset"):
        ds = collect_dataset(spark, tables, cfg, args.out)
    if args.step in ("all", "recommend"):
        if args.step == "recommend":
            from .plans.dataset import Dataset
            from .operators.assemble import DatasetSpec, KEY_COLUMNS, LABEL_COLUMNS

            df = spark.read.parquet(f"{args.out}/dataset")
            feats = [c for c in df.columns if c not in (*KEY_COLUMNS, *LABEL_COLUMNS)]
            clicks = [c for c in feats if c.endswith(cfg.click_suffix)]
            ds = Dataset(df, DatasetSpec(list(KEY_COLUMNS), list(LABEL_COLUMNS), feats, clicks))
        _, log = get_recommendations(spark, ds, cfg, args.out, args.today)
        print(json.dumps(log, default=str))


if __name__ == "__main__":
    main()
