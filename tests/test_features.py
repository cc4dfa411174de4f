"""Edge cases of the feature operators on hand-made tables."""

from __future__ import annotations

from decimal import Decimal

from conftest import AS_OF, days_ago, make_tables, ts

from kinscore.config import driver_config
from kinscore.operators import activations as act
from kinscore.operators import flags
from kinscore.operators import payment_events as pev
from kinscore.operators import payments as pay
from kinscore.operators.population import Population, active_population
from kinscore.plans.dataset import build_dataset

CFG = driver_config()


def _base_rows():
    # users: 1 normal, 2 test, 3 null is_test, 4 normal but dead item, 5 event outside window
    users = [(1, 101, False), (2, 102, True), (3, 103, None), (4, 104, False), (5, 105, False), (6, 106, False)]
    items = [
        (10, 1, 1, False, "A", "x"),
        (20, 2, 1, False, "A", "x"),
        (30, 3, 2, False, "B", None),
        (40, 4, 1, True, "A", "x"),
        (50, 5, 4, False, "A", ""),
        (60, 6, 3, False, "A", "x"),  # category outside the jobs vertical
        (11, 1, 2, False, "B", "y"),
    ]
    pe = [
        (10, ts(AS_OF), True, "PROMO", "op1"),  # midnight of as_of: inside
        (10, ts(AS_OF, 0, 0, 1), True, "PROMO", "op2"),  # one second later: outside
        (20, ts(days_ago(3)), True, "PROMO", "op3"),
        (30, ts(days_ago(30)), True, "ECONOMY", "op4"),  # exactly as_of-30: inside
        (40, ts(days_ago(3)), True, "PROMO", "op5"),
        (50, ts(days_ago(31)), True, "PROMO", "op6"),  # outside the 30-day window
        (60, ts(days_ago(3)), True, "PROMO", "op7"),
        (11, ts(days_ago(100)), True, "PROMO", "op1"),  # repeated operation id, other item
        (11, ts(days_ago(100)), False, "STANDARD", "op8"),  # not revenue
    ]
    return dict(users=users, items=items, payment_events=pe)


def test_population_rules(spark):
    t = make_tables(spark, **_base_rows())
    got = sorted(tuple(r) for r in active_population(t, CFG).collect())
    # 2 is a test user, 4's item is dead, 5's event is 31 days back, 6 is in another vertical
    assert got == [(1, 101), (3, 103)]


def test_one_test_row_excludes_a_user(spark):
    rows = _base_rows()
    rows["users"] = rows["users"] + [(1, 101, True)]  # user 1 has a normal and a test row
    assert [tuple(r) for r in active_population(make_tables(spark, **rows), CFG).collect()] == [(3, 103)]


def test_many_attribute_values_and_a_hot_item(spark):
    """No cap on values; an item with a third of the rows, under a sort-merge join."""
    n = 5000
    items = [(i, 1 + i % 7, 1, False, f"value {i}", "") for i in range(n)]
    pe = [(i, ts(days_ago(5)), True, "PROMO", f"op{i}") for i in range(n)]
    pe += [(0, ts(days_ago(i % 100)), i % 2 == 0, "ECONOMY", f"hot{i % 900}") for i in range(n // 2)]
    t = make_tables(spark, users=[(u, u + 100, False) for u in range(1, 8)], items=items, payment_events=pe)
    pop = Population(active_population(t, CFG))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        grain = pev.item_grain(t, CFG, pop)
        counts = pev.attr_counts(grain, CFG, "attr1")
        assert len(pev.attr_features(counts)) == n
        got = {r["feature"]: r["cnt"] for r in counts.where("user_id = 1").collect()}
        assert got["p1_value_0"] == 1 + n // 4 and got["p1_value_7"] == 1 and len(got) == len(range(0, n, 7))
        ops = {r["user_id"]: r for r in pev.operation_branch(t, CFG, pop).collect()}
        hot = len({f"hot{i % 900}" for i in range(0, n // 2, 2)})
        assert ops[1]["ECONOMY"] == hot and ops[1]["PROMO"] == len(range(0, n, 7))
        assert ops[1]["count_payments_180"] == hot + ops[1]["PROMO"]
        plan = pev.operation_branch(t, CFG, pop)._jdf.queryExecution().executedPlan().toString()
        # an exchange stands between the item join and the (user, operation) aggregate
        assert plan.index("hashpartitioning(user_id") < plan.index("SortMergeJoin [item_id")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_event_family_distinct_counts(spark):
    t = make_tables(spark, **_base_rows())
    for pop in (Population(active_population(t, CFG)), Population(active_population(t, CFG), rows=2)):
        frames, a1, a2 = pev.payment_event_family(t, CFG, pop)
        joined = frames[0]
        for f in frames[1:]:
            joined = joined.join(f, "user_id", "left")
        rows = {r["user_id"]: r for r in joined.collect()}
        # user 1: items 10 and 11 have events (op2 is outside by one second, so item 10 via op1)
        assert rows[1]["count_items_180"] == 2
        # revenue operations of user 1: op1 (twice, two items) → 1 distinct
        assert rows[1]["count_payments_180"] == 1
        assert rows[1]["PROMO"] == 1 and rows[1]["STANDARD"] == 0
        assert a1 == ["p1_a", "p1_b"]
        # attr2: null skipped, empty string skipped
        assert a2 == ["p2_x", "p2_y"]
        # attr counts are row counts of revenue events: user 1 has two revenue rows (A, B)
        assert rows[1]["p1_a"] == 1 and rows[1]["p1_b"] == 1


def test_payment_family_nulls_and_rules(spark):
    pays = [
        # user, amount, time, rev, dead, test, cat, tx, subtype, fact
        (1, Decimal("10.5"), ts(days_ago(10)), True, False, False, 6, "N", "LARGE", "f1"),
        (1, Decimal("-3.25"), ts(days_ago(60)), True, False, False, 9, "N", "SMALL", "f2"),
        (1, Decimal("100"), ts(days_ago(10)), True, None, None, 6, "N", "LARGE", "f3"),  # null dead/test
        (1, Decimal("7"), ts(days_ago(10)), True, False, False, 6, "N", "LARGE", "f1"),  # repeated fact
        (3, Decimal("5"), ts(days_ago(200)), True, False, False, 6, "N", "LARGE", "f9"),  # too old
        (3, Decimal("1"), ts(days_ago(5)), True, False, False, 4, "A", "MEDIUM", "f8"),  # second arm
    ]
    t = make_tables(spark, payments=pays, **_base_rows())
    pop = active_population(t, CFG)
    fam = {r["user_id"]: r for r in pay.payments_family(t, CFG, pop).collect()}
    u1 = fam[1]
    assert u1["all_revenue_30"] == Decimal("17.5")  # f3 has is_dead null: dropped by `= false`
    assert u1["all_revenue_90"] == Decimal("14.25")
    assert u1["revenue_180"] == Decimal("17.5")  # cat 9 row fails the rule
    assert u1["LARGE"] == 2  # f1 (twice) and f3 (null-tolerant): 2 distinct facts
    assert fam[3]["MEDIUM"] == 1 and fam[3]["n_all_revenue_90"] == 1
    long = {(r["user_id"], r["feature"]): r["cnt"] for r in pev.long_counts(pay.payments_family(t, CFG, pop), pay.tariff_columns(CFG)).collect()}
    assert long == {(1, "LARGE"): 2.0, (3, "MEDIUM"): 1.0}


def test_activation_buckets_boundaries(spark):
    acts = [
        (10, ts(AS_OF, 23, 59), "PROMO"),  # as_of day itself: bucket 0-30 (dates compared)
        (10, ts(days_ago(30)), "PROMO"),  # exactly 30 back: bucket 0-30 (closed)
        (10, ts(days_ago(31)), "PROMO"),  # 30-60
        (10, ts(days_ago(60), 12), "ECONOMY"),  # exactly 60 back: 30-60 ([as_of-60, as_of-30))
        (10, ts(days_ago(90)), "STANDARD"),  # exactly 90 back: 60-90
        (10, ts(days_ago(91)), "PROMO"),  # outside
        (10, ts(days_ago(5)), "LARGE"),  # unpaid type
        (11, ts(days_ago(5)), "PROMO"),
    ]
    t = make_tables(spark, activations=acts, **_base_rows())
    fam = {r["user_id"]: r for r in act.activation_family(t, CFG, active_population(t, CFG)).collect()}
    assert (fam[1]["activations_30"], fam[1]["activations_30_60"], fam[1]["activations_60_90"]) == (3, 2, 1)


def test_flags_null_team_and_case(spark):
    md = [
        (1, AS_OF, "ASIA team"),
        (1, days_ago(40), "asia"),
        (3, AS_OF, None),  # null team: neither matches nor "other"
        (3, AS_OF, "Europe"),
        (1, days_ago(1), "Europe"),  # before as_of: not an "other" flag
    ]
    t = make_tables(spark, manager_days=md, **_base_rows())
    pop = active_population(t, CFG)
    assert [tuple(r) for r in flags.flagged(flags.manager_flags(t, CFG), "is_asd").collect()] == [(1, 1.0)]
    assert [tuple(r) for r in flags.flagged(flags.manager_flags(t, CFG, pop), "asd_others").collect()] == [(3, 1.0)]
    merged = {r["user_id"]: (r["is_asd"], r["was_asd"], r["asd_others"]) for r in flags.manager_flags(t, CFG, pop).collect()}
    assert merged == {1: (1.0, 1.0, 0.0), 3: (0.0, 0.0, 1.0)}


def test_snapshot_excludes_categories_and_nulls(spark):
    rows = _base_rows()
    rows["items"] = rows["items"] + [(70, 1, 3, False, "A", "x"), (80, 1, None, False, "A", "x")]
    t = make_tables(spark, item_days=[(70, AS_OF), (80, AS_OF), (10, AS_OF), (70, days_ago(1))], **rows)
    out = act.snapshot_other_items(t, CFG, active_population(t, CFG)).collect()
    assert [(r[0], r[1]) for r in out] == [(1, 1.0)]


def test_dataset_one_row_per_user_and_zero_fill(spark):
    t = make_tables(spark, **_base_rows())
    ds = build_dataset(t, CFG)
    pdf = ds.df.toPandas()
    assert sorted(pdf["user_id"]) == [1, 3]
    assert not pdf.isnull().values.any()
    assert list(pdf.columns[:5]) == ["user_id", "external_id", "is_asd", "was_asd", "asd_others"]


def test_production_parameters_and_cyrillic_columns(spark):
    import datetime as dt

    from kinscore.config import production_config

    as_of = dt.date(2024, 3, 31)
    cfg = production_config(as_of)
    cats = [(11, "Jobs", "vakansii", 250006), (12, "Jobs", "rezume", 250004), (13, "Other", "x", 1)]
    users = [(1, 501, False), (2, 502, False)]
    items = [
        (100, 1, 11, False, "Продавец-консультант", "Полный день"),
        (101, 1, 11, False, "Водитель", None),
        (200, 2, 11, False, "Водитель", "Сменный график"),
    ]
    t0 = dt.datetime(2024, 3, 20)
    pe = [
        (100, t0, True, "XL", "a1"),
        (101, t0, True, "max single", "a2"),
        (200, t0, True, "XL", "a3"),
    ]
    t = make_tables(spark, users=users, items=items, categories=cats, payment_events=pe)
    ds = build_dataset(t, cfg)
    cols = ds.df.columns
    # the soft sign maps to "_" (fixed letter map), the hyphen is dropped
    for name in ("prodaveckonsul_tant", "voditel_", "polnyy_den_", "smennyy_grafik", "XL", "max_single", "tariff_ext_Job_ASD"):
        assert name in cols, name
    rows = {r["user_id"]: r for r in ds.df.collect()}
    assert rows[1]["voditel_"] == 1.0 and rows[1]["prodaveckonsul_tant"] == 1.0 and rows[1]["max_single"] == 1.0
    assert rows[2]["smennyy_grafik"] == 1.0 and rows[2]["XL"] == 1.0
