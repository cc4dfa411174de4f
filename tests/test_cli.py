"""The command line builds and writes the dataset with its run-log row."""

from __future__ import annotations

import datetime as dt
import json
import tempfile

import pytest
from conftest import SCHEMAS, make_tables

from kinscore.__main__ import main


def test_cli_dataset_step(spark):
    out = tempfile.mkdtemp(prefix="kinscore-cli-", dir="/tmp") + "/out"
    main(["--driver-sf", "/root/testdata/sf0.001", "--out", out, "--step", "dataset"])
    ds = spark.read.parquet(f"{out}/dataset")
    assert ds.columns[:5] == ["user_id", "external_id", "is_asd", "was_asd", "asd_others"]
    log = spark.read.parquet(f"{out}/runlog").first()
    assert log["operation"] == "collect_dataset"
    assert json.loads(log["comment"])["dataset_length"] == ds.count()


@pytest.mark.parametrize("kind", ["csv", "json", "parquet"])
def test_cli_on_parquet_tables_with_a_catalog_file(spark, kind):
    """--tables without an event_catalog folder, --catalog in each format."""
    root = tempfile.mkdtemp(prefix="kinscore-cli-", dir="/tmp")
    as_of = dt.date(2024, 3, 31)
    when = dt.datetime(2024, 3, 20)
    t = make_tables(
        spark,
        users=[(1, 501, False), (2, 502, False)],
        items=[(100, 1, 11, False, "a", "b"), (200, 2, 11, False, "a", None)],
        categories=[(11, "Jobs", "vakansii", 250006)],
        payment_events=[(100, when, True, "XL", "o1"), (200, when, True, "XL", "o2")],
        clicks=[(1, 7, as_of), (1, 7, as_of), (2, 9, as_of)],
    )
    for name in SCHEMAS:
        if name != "event_catalog":
            getattr(t, name).write.parquet(f"{root}/tables/{name}")
    events = spark.createDataFrame([("Open page", "d", 1, 7)], SCHEMAS["event_catalog"])
    writer = events.coalesce(1).write.option("header", True)
    getattr(writer, kind)(f"{root}/catalog.{kind}")
    args = ["--tables", f"{root}/tables", "--catalog", f"{root}/catalog.{kind}", "--out", f"{root}/out"]
    main([*args, "--as-of", str(as_of), "--step", "dataset"])
    rows = {r["user_id"]: r["open_page_csf"] for r in spark.read.parquet(f"{root}/out/dataset").collect()}
    assert rows == {1: 2.0, 2: 0.0}
