"""A hot user holding a third of the rows: results against a pandas brute force, and the
plan shape that keeps such a user cheap (partial aggregation before every shuffle)."""

from __future__ import annotations

import datetime as dt
import re
from decimal import Decimal

import numpy as np
import pandas as pd
from conftest import AS_OF, make_tables

from kinscore.config import driver_config
from kinscore.operators import payments as pay
from kinscore.operators.population import Population

CFG = driver_config()


def _payments(n=3000, seed=11):
    rng = np.random.default_rng(seed)
    users = np.where(rng.random(n) < 1 / 3, 7, rng.integers(1, 60, n))  # user 7 holds a third
    rows = []
    for i in range(n):
        rows.append(
            (
                int(users[i]),
                Decimal(str(round(float(rng.normal(50, 30)), 2))),
                dt.datetime.combine(AS_OF, dt.time()) - dt.timedelta(days=int(rng.integers(0, 200)), hours=int(rng.integers(0, 24))),
                bool(rng.random() < 0.8),
                [False, True, None][int(rng.integers(0, 3))],
                [False, None][int(rng.integers(0, 2))],
                int(rng.choice([4, 6, 9])),
                str(rng.choice(["A", "N", "R"])),
                str(rng.choice(["LARGE", "SMALL", "MEDIUM", "PROMO"])),
                f"f{int(rng.integers(0, 900))}",
            )
        )
    return rows


def _brute(rows, pop_ids):
    cols = ["user_id", "amount", "t", "rev", "dead", "test", "cat", "tx", "sub", "fact"]
    df = pd.DataFrame(rows, columns=cols)
    df = df[df.user_id.isin(pop_ids) & (df.rev == True)]  # noqa: E712
    as_of = pd.Timestamp(AS_OF)

    def win(days):
        return (df.t >= as_of - pd.Timedelta(days=days)) & (df.t <= as_of)

    alive = df.dead == False  # noqa: E712
    rule = (df.cat == 6) | ((df.cat == 4) & (df.tx == "A")) | df["sub"].str.lower().str.contains("prom")
    out = {}
    for uid, g in df.groupby("user_id"):
        a = alive.loc[g.index]
        out[uid] = {
            "all_revenue_90": g.amount[a & win(90).loc[g.index]].sum(),
            "all_revenue_30": g.amount[a & win(30).loc[g.index]].sum(),
            "revenue_180": g.amount[a & rule.loc[g.index] & win(180).loc[g.index]].sum(),
        }
        base = g[(g.test != True) & (g.dead != True) & rule.loc[g.index] & win(180).loc[g.index]]  # noqa: E712
        for s in CFG.tariffs:
            out[uid][s] = base[base["sub"] == s].fact.nunique()
    return out


def test_hot_user_matches_brute_force(spark):
    rows = _payments()
    users = [(u, u + 1000, False) for u in range(1, 60)]
    t = make_tables(spark, payments=rows, users=users)
    pop_ids = list(range(1, 40)) + [7]
    pop_df = spark.createDataFrame([(u, u + 1000) for u in sorted(set(pop_ids))], "user_id long, external_id long")
    want = _brute(rows, set(pop_ids))
    for pop in (Population(pop_df), Population(pop_df, rows=len(set(pop_ids)))):
        got = {r["user_id"]: r for r in pay.payments_family(t, CFG, pop).collect()}
        assert set(got) == set(want)
        for uid, w in want.items():
            for k in ("all_revenue_90", "all_revenue_30", "revenue_180"):
                g = got[uid][k] if got[uid][f"n_{k}"] > 0 else Decimal(0)
                assert Decimal(str(w[k])) == (g or Decimal(0)), (uid, k)
            for s in CFG.tariffs:
                assert got[uid][s] == w[s], (uid, s)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_partial_aggregation_before_shuffle(spark):
    t = make_tables(spark, payments=_payments(200))
    pop_df = spark.createDataFrame([(7, 1007)], "user_id long, external_id long")
    for pop in (Population(pop_df), Population(pop_df, rows=1)):
        plan = _plan(pay.payments_family(t, CFG, pop))
        # every Exchange hashing on the grouping keys sits on top of a partial aggregate
        assert "partial_sum" in plan and "partial_count" in plan
        assert not re.search(r"(CartesianProduct|BroadcastNestedLoopJoin)", plan)


def test_counted_population_is_broadcast_semi_join(spark):
    t = make_tables(spark, payments=_payments(200))
    pop_df = spark.createDataFrame([(7, 1007)], "user_id long, external_id long")
    small = _plan(pay.payments_family(t, CFG, Population(pop_df, rows=1)))
    assert re.search(r"BroadcastHashJoin \[user_id#\d+L?\], \[user_id#\d+L?\], LeftSemi", small)
    unknown = _plan(pay.payments_family(t, CFG, Population(pop_df)))
    # aggregate first: an inner join with the distinct ids sits above the final aggregate;
    # a semi join would have been pushed below the aggregate by the optimizer
    assert "LeftSemi" not in unknown
    top = unknown.splitlines()
    join_line = next(i for i, line in enumerate(top) if "Join" in line)
    below = next(line for line in top[join_line + 1 :] if "Sort " not in line)
    assert "Inner" in top[join_line] and "HashAggregate(keys=[user_id" in below
