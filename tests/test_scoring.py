"""Scoring, selection, transforms, slugs and sinks."""

from __future__ import annotations

import datetime as dt
import json
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinscore.functions.text import assert_unique_names, slug
from kinscore.operators import nearest
from kinscore.operators.nearest import nearest_positive
from kinscore.operators.selection import exclude_recent, quota, select_users, top_k, vote, tagged_top_lists
from kinscore.operators.transform import log_domain_violations, log_features, standardize
from kinscore.sources import sinks


def _vectors(spark, arr, offset=0):
    rows = [(int(i + offset), [float(x) for x in v]) for i, v in enumerate(arr)]
    return spark.createDataFrame(rows, "user_id long, vec array<double>")


@pytest.mark.parametrize("block_cells,wave_blocks,tile", [(10**6, 8, 10**6), (18, 8, 10**6), (18, 2, 7)])
def test_nearest_matches_brute_force(spark, monkeypatch, block_cells, wave_blocks, tile):
    monkeypatch.setattr(nearest, "TILE_CELLS", tile)
    rng = np.random.default_rng(5)
    pos = rng.normal(size=(11, 6))
    cand = rng.normal(size=(40, 6))
    want = {i: np.abs(cand[i] - pos).sum(axis=1).min() for i in range(len(cand))}
    got = nearest_positive(
        _vectors(spark, cand), _vectors(spark, pos, 1000), block_cells=block_cells, wave_blocks=wave_blocks
    ).collect()
    assert len(got) == len(cand)
    for r in got:
        assert r["knn_dist"] == pytest.approx(want[r["user_id"]], rel=1e-12)
        assert r["knn_score"] == pytest.approx(1 - want[r["user_id"]], rel=1e-12)


@pytest.mark.parametrize("block_cells", [10**6, 2])
def test_nearest_leaves_out_vectors_without_a_distance(spark, block_cells):
    nan = float("nan")
    schema = "user_id long, vec array<double>"
    pos = spark.createDataFrame([(10, [nan, 0.0]), (11, [3.0, 0.0]), (12, [0.0, None]), (13, None)], schema)
    cand = spark.createDataFrame([(1, [1.0, 0.0]), (2, [nan, 0.0]), (3, [None, 1.0]), (4, None)], schema)
    got = {r["user_id"]: r["knn_dist"] for r in nearest_positive(cand, pos, block_cells=block_cells).collect()}
    assert got == {1: 2.0, 2: None, 3: None, 4: None}


def test_nearest_without_positives(spark):
    cand = _vectors(spark, np.zeros((3, 2)))
    out = nearest_positive(cand, cand.where(F.lit(False))).collect()
    assert len(out) == 3 and all(r["knn_score"] is None for r in out)


def test_nearest_keeps_vectors_off_the_driver(spark, monkeypatch):
    """Copies of one positive make no block larger, nothing is broadcast, and the plan does not grow."""
    sent = []
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(value))
    packed = []
    make = nearest.positive_blocks
    monkeypatch.setattr(nearest, "positive_blocks", lambda *a: packed.append(make(*a)) or packed[-1])
    rng = np.random.default_rng(6)
    pos = np.concatenate([np.tile(rng.normal(size=(1, 6)), (60, 1)), rng.normal(size=(40, 6))])
    cand = rng.normal(size=(30, 6))
    want = {i: np.abs(cand[i] - pos).sum(axis=1).min() for i in range(30)}
    lines = []
    for cells in (10**6, 18):
        df = nearest_positive(_vectors(spark, cand).repartition(3), _vectors(spark, pos), block_cells=cells, wave_blocks=2)
        assert {r["user_id"]: r["knn_dist"] for r in df.collect()} == pytest.approx(want, rel=1e-12)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        lines.append(sum(x in plan and plan.count(x) for x in ("Join", "MapInArrow", "Union")))
    sizes = [len(r["block"]) for r in packed[1].collect()]
    assert not sent and max(sizes) == 18 * 8 and sum(sizes) == 41 * 6 * 8
    assert lines[1] <= lines[0]


@pytest.mark.parametrize("block_cells", [10**6, 2])
def test_nearest_keeps_rows_with_the_same_key(spark, block_cells):
    schema = "user_id string, vec array<double>"
    pos = spark.createDataFrame([("p", [0.0, 0.0]), ("q", [9.0, 0.0])], schema)
    cand = spark.createDataFrame([("a", [1.0, 0.0]), ("a", [7.0, 0.0]), (None, [0.0, 3.0])], schema)
    got = [(r["user_id"], r["knn_dist"]) for r in nearest_positive(cand, pos, block_cells=block_cells, wave_blocks=1).collect()]
    assert sorted(got, key=repr) == [("a", 1.0), ("a", 2.0), (None, 3.0)]


def test_quota_clamps_and_truncates():
    assert quota(1000, 10) == 330
    assert quota(1000, 999) == 0
    assert quota(1000, 1200) == 0  # negative quota: take none (not "drop the last k")


def _scores(spark, rows):
    return spark.createDataFrame(rows, "user_id long, knn_score double, logreg_score double, xgb_score double")


def test_top_k_ties_and_threshold(spark):
    df = _scores(spark, [(3, 0.9, 0.5, 0.0), (1, 0.9, 0.6, 0.0), (2, 0.8, 0.7, 0.0), (4, 0.0, 0.9, 0.0)])
    assert [r[0] for r in top_k(df, "knn_score", 0.0, 2).collect()] == [1, 3]  # tie broken by id
    # strict threshold: 0.5 does not pass 0.5
    assert sorted(r[0] for r in top_k(df, "logreg_score", 0.5, 10).collect()) == [1, 2, 4]


def test_vote_and_fill(spark):
    rows = [
        (1, 0.9, 0.9, 0.1),  # knn + logreg → voted
        (2, 0.8, 0.1, 0.8),  # knn + xgb → voted
        (3, 0.7, 0.1, 0.1),
        (4, -1.0, 0.8, 0.1),
        (5, -1.0, 0.1, 0.9),
        (6, 0.6, 0.1, 0.1),
    ]
    df = _scores(spark, rows)
    th = {"knn": 0.0, "logreg": 0.5, "xgb": 0.5}
    voted = sorted(r[0] for r in vote(tagged_top_lists(df, th, 3)).collect())
    assert voted == [1, 2]
    sel = select_users(df, th, 5)  # quota = int((5 - 2) / 3) = 1 per model
    assert sel.per_model_quota == 1
    assert sorted(r[0] for r in sel.ids.collect()) == [1, 2, 3, 4, 5]
    assert sel.counts == {"top_users": 2, "knn_users": 1, "logreg_users": 1, "xgb_users": 1}
    assert not spark.sparkContext._jsc.getPersistentRDDs()  # nothing is left in executors' memory


def test_exclude_recent_is_strict(spark):
    today = dt.date(2024, 6, 30)
    hist = spark.createDataFrame(
        [(1, today - dt.timedelta(days=180)), (2, today - dt.timedelta(days=179)), (None, today)],
        "user_id long, date_rec date",
    )
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    assert sorted(r[0] for r in exclude_recent(users, hist, today, 180).collect()) == [1, 3]


def test_log_and_standardize(spark):
    df = spark.createDataFrame([(1, 9.0, 5.0, -1.0), (2, 99.0, 5.0, 0.0)], "user_id long, a double, b double, c double")
    logged = {r["user_id"]: r for r in log_features(df, ["a", "b", "c"]).collect()}
    assert logged[1]["a"] == pytest.approx(1.0) and logged[2]["a"] == pytest.approx(2.0)
    assert logged[1]["c"] == 0.0  # x <= -1 maps to 0
    assert log_domain_violations(df, ["c"]).first()[0] == 1
    z = {r["user_id"]: r for r in standardize(df, ["a", "b"]).collect()}
    assert z[1]["a"] == pytest.approx(-1.0) and z[2]["a"] == pytest.approx(1.0)  # population std
    assert z[1]["b"] == 0.0  # zero variance → 0


def test_slug_cyrillic_and_collisions(spark):
    names = ["Просмотр телефона", "User  Edit_Email!", "Щука и Ёж", "x10_1 Job"]
    got = [r[0] for r in spark.createDataFrame([(n,) for n in names], "n string").select(slug("n")).collect()]
    assert got[0] == "prosmotr_telefona"
    assert got[3] == "x101_job"
    assert got[1] == "user_editemail"
    assert got[2] == "huka_i_ej"
    with pytest.raises(ValueError):
        assert_unique_names(["ab", "AB"])


def test_history_append_is_idempotent_per_day(spark):
    root = tempfile.mkdtemp(prefix="kinscore-test-", dir="/tmp")
    rows = spark.createDataFrame([(1, 0.5), (2, 0.7)], "user_id long, knn_score double")
    day = dt.date(2024, 1, 2)
    sinks.append_history(rows, f"{root}/h", day)
    sinks.append_history(rows, f"{root}/h", day)  # a retried run replaces its own day
    sinks.append_history(rows.limit(1), f"{root}/h", day + dt.timedelta(days=1))
    h = sinks.read_history(spark, f"{root}/h")
    assert h.count() == 3
    sinks.append_run_log(sinks.dict_log_row(spark, "t", "op", {"a": 1, "long": "y" * 2000}), f"{root}/log")
    row = spark.read.parquet(f"{root}/log").first()
    assert json.loads(row["comment"])["a"] == 1 and row["date_time"] is not None
    labels = spark.createDataFrame([(1.0,), (0.0,), (0.0,)], "is_asd double")
    row = sinks.balance_log_row(labels, "t", "op", duration="1s").first()
    assert json.loads(row["comment"]) == {"dataset_length": 3, "asd": 1, "non_asd": 2, "duration": "1s"}


def test_unreadable_history_fails_the_run(spark):
    root = tempfile.mkdtemp(prefix="kinscore-test-", dir="/tmp")
    assert sinks.read_history(spark, f"{root}/absent") is None
    with open(f"{root}/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception, match="(?i)footer|parquet|corrupt"):
        sinks.read_history(spark, root).count()


def test_history_read_prunes_partitions(spark):
    root = tempfile.mkdtemp(prefix="kinscore-test-", dir="/tmp")
    rows = spark.createDataFrame([(1, 0.5)], "user_id long, knn_score double")
    for day in (dt.date(2023, 1, 1), dt.date(2024, 1, 1)):
        sinks.append_history(rows, f"{root}/h", day)
    hist = sinks.read_history(spark, f"{root}/h")
    recent = exclude_recent(spark.createDataFrame([(1,), (2,)], "user_id long"), hist, dt.date(2024, 1, 2), 180)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_rec" in plan and "date_rec" in plan
    assert sorted(r[0] for r in recent.collect()) == [2]


def test_fold_takes_exact_distances(spark):
    """Single precision only picks the pairs: far, tied and non-finite components end as the plain fold leaves them."""
    rng = np.random.default_rng(8)
    wide = 10.0 ** rng.integers(-40, 29, (60, 8))
    odd = np.array([[np.nan, 1.0], [np.inf, 2.0], [1e31, 0.0], [1.0, 2.0], [-np.inf, 0.0]])
    cases = [
        (rng.normal(size=(50, 8)), rng.normal(size=(70, 8))),
        (rng.integers(0, 3, (50, 5)).astype(float), rng.integers(0, 3, (70, 5)).astype(float)),
        (1e9 + rng.normal(size=(50, 8)), 1e9 + rng.normal(size=(70, 8))),
        (rng.normal(size=(60, 8)) * wide, rng.normal(size=(60, 8)) * wide),
        (np.zeros((9, 8)), np.eye(8)),
        (odd, np.array([[1.0, 2.0], [3.0, 4.0]])),
        (odd, np.array([[1.0, np.inf], [3.0, 4.0]])),
    ]
    for cand, pos in cases:
        best, want = np.full(len(cand), np.inf), np.full(len(cand), np.inf)
        with np.errstate(invalid="ignore"):
            for i in range(0, len(pos), 40):
                nearest.fold_block(cand, pos[i : i + 40], best)
            for p in pos:  # one by one, summed in the order of the dimensions
                total = np.zeros(len(cand))
                for d in range(pos.shape[1]):
                    total += np.abs(cand[:, d] - p[d])
                np.minimum(want, total, out=want)
        assert np.array_equal(best, want, equal_nan=True)


def test_nearest_shares_the_pairs_of_one_partition(spark, monkeypatch):
    """The pairs of a table that comes in one partition are the work of many tasks."""
    tasks = []
    fold = nearest._fold
    monkeypatch.setattr(nearest, "_fold", lambda pairs, *a: tasks.append(pairs.rdd.getNumPartitions()) or fold(pairs, *a))
    rng = np.random.default_rng(9)
    cand, pos = rng.normal(size=(64, 6)), rng.normal(size=(5, 6))
    df = nearest_positive(_vectors(spark, cand).coalesce(1), _vectors(spark, pos), block_cells=8 * 6 * 4)
    want = {i: np.abs(cand[i] - pos).sum(axis=1).min() for i in range(64)}
    assert {r["user_id"]: r["knn_dist"] for r in df.collect()} == pytest.approx(want, rel=1e-12)
    assert tasks == [8]


def test_scores_are_made_once(spark, monkeypatch, tmp_path):
    """Top lists, vote, F1 and the list read written scores; none looks for the nearest positives again."""
    from kinscore.plans import scoring_checks as checks

    rng = np.random.default_rng(10)
    rows = [(i, [float(x) for x in rng.normal(size=4)], i % 3) for i in range(30)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    folded = spark.sparkContext.accumulator(0)

    def counted(candidates, positives, key):
        def see(batches):
            for batch in batches:
                folded.add(batch.num_rows)
                yield batch

        found = nearest_positive(candidates, positives, key)
        return found.mapInArrow(see, found.schema)

    monkeypatch.setattr(checks, "nearest_positive", counted)
    for query in (checks.top_k_q, checks.vote_q, checks.f1_scores_q, lambda *a: checks.list_scores(*a)[0]):
        before = folded.value
        query(spark, str(tmp_path)).collect()
        assert folded.value - before == 20


def test_training_frame_deals_large_frames(spark):
    """A fit is one task a partition: a frame of a million cells is not one task."""
    from kinscore.config import driver_config
    from kinscore.operators.assemble import DatasetSpec
    from kinscore.plans.dataset import Dataset
    from kinscore.plans.recommend import training_frame

    feats = [f"f{i}" for i in range(20)]
    values = [(F.col("id") % (i + 2)).cast("double").alias(f) for i, f in enumerate(feats)]
    users = spark.range(50_000).select(F.col("id").alias("user_id"), (F.col("id") % 7 == 0).cast("int").alias("is_asd"), *values)
    ds = Dataset(users, DatasetSpec(["user_id"], ["is_asd"], feats, []))
    train, _ = training_frame(ds, driver_config())
    sizes = [r["count"] for r in train.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 50_000 and len(sizes) > 1 and max(sizes) < 40_000
    small, _ = training_frame(Dataset(users.where("user_id < 1000"), ds.spec), driver_config())
    assert small.rdd.getNumPartitions() == 1
