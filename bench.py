"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Queries:
  population     FE0, checkpointed and counted as the job does
  dataset        the whole zero-filled feature dataset
  payments       payments family (FE4, FE5, FE10, FE14)
  event_family   payment-event family (FE11-FE13, FE15, FE16)
  clicks         click pivot (FE17)
  nearest_l1     nearest positive over `embeddings`
  selection      vote + quota fill on the embedding-derived scores
  recommend      grid search, cross-fit logistic and trees, tree CV, list (BENCH_ML=0 leaves it out)

A warm-up query runs first, and what Spark keeps in memory is dropped before every timing, so no
number holds the start of the session or a cache that another query filled. Each query is timed
to a full materialisation (the ``noop`` sink runs the whole plan).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kinscore.config import driver_config  # noqa: E402
from kinscore.operators import clicks as clk  # noqa: E402
from kinscore.operators import payment_events as pev  # noqa: E402
from kinscore.operators import payments as pay  # noqa: E402
from kinscore.operators.population import active_population, materialize_population  # noqa: E402
from kinscore.plans.dataset import Dataset, build_dataset  # noqa: E402
from kinscore.plans.scoring_checks import nearest_l1_q, quota_fill_q  # noqa: E402
from kinscore.session import local_session  # noqa: E402
from kinscore.sources.adapters import driver_tables  # noqa: E402


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "8")))
    cfg = driver_config()
    t = driver_tables(spark, sf_dir)
    times: dict[str, float] = {}

    def timed(name, fn):
        spark.catalog.clearCache()
        for kept in spark.sparkContext._jsc.getPersistentRDDs().values():
            kept.unpersist(True)
        t0 = time.time()
        fn()
        times[name] = round(time.time() - t0, 3)

    run(pay.payments_family(t, cfg, materialize_population(active_population(t, cfg))))  # warm-up
    state = {}
    timed("population", lambda: state.update(pop=materialize_population(active_population(t, cfg))))
    pop = state["pop"]

    def dataset():
        ds = build_dataset(t, cfg, pop)
        state["ds"] = Dataset(ds.df.checkpoint(eager=True), ds.spec)

    timed("dataset", dataset)
    timed("payments", lambda: run(pay.payments_family(t, cfg, pop)))
    timed("event_family", lambda: [run(f) for f in pev.payment_event_family(t, cfg, pop)[0]])
    timed("clicks", lambda: run(clk.click_pivot(t, cfg, pop)[0]))
    timed("nearest_l1", lambda: run(nearest_l1_q(spark, sf_dir)))
    timed("selection", lambda: run(quota_fill_q(spark, sf_dir)))
    if os.environ.get("BENCH_ML", "1") == "1":
        from kinscore.plans.recommend import recommend

        timed("recommend", lambda: run(recommend(state["ds"], cfg).rows))

    total = round(sum(times.values()), 3)
    sf_name = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf_name)
    except ValueError:
        sf = sf_name
    print(
        json.dumps(
            {"metric": "total_query_time", "value": total, "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}
        )
    )


if __name__ == "__main__":
    main()
