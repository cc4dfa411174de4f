"""Registered queries against their DuckDB oracle on sf0.001 (the driver checks sf0.01)."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events embeddings".split()
FAST = [
    "active_population",
    "flag_managed_by_others",
    "revenue_90",
    "revenue_180_rule",
    "activation_buckets",
    "distinct_payments_180",
    "service_counts",
    "tariff_counts",
    "attr2_counts",
    "slug",
    "click_counts",
    "click_pivot",
    "feature_assembly",
    "run_log_comment",
    "standardize",
    "nearest_l1",
    "quota_fill",
    "tree_root_histogram",
]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf, cols):
    return sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("driver data not present")
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_is_registered_with_callable():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert all(callable(f) for f in qs.values())


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    sp = entry.queries()[name](spark, SF).toPandas()
    dk = con.sql(entry.oracle_sql()[name]).df()
    cols = sorted(sp.columns)
    assert cols == sorted(dk.columns)
    assert _rows(sp, cols) == _rows(dk, cols)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["user_id", "external_id"]
    assert df.count() >= 0
