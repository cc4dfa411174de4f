"""Per-stage times and shuffle bytes of the dataset build, from Spark's event log.

Usage: python tools/stage_times.py [sf_dir]
The event log goes to a fresh scratch folder (no UI, no server); the summary lists the
slowest stages with their shuffle read/write volumes.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import SparkSession  # noqa: E402

from kinscore.config import driver_config  # noqa: E402
from kinscore.operators.population import active_population, materialize_population  # noqa: E402
from kinscore.plans.dataset import build_dataset  # noqa: E402
from kinscore.session import SCALE_CONF, ensure_checkpoint_dir  # noqa: E402
from kinscore.sources.adapters import driver_tables  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="kinscore-evlog-", dir="/tmp")
    b = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", scratch)
        .config("spark.eventLog.compress", "false")
    )
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    cfg = driver_config()
    t = driver_tables(spark, sf_dir)
    t0 = time.time()
    pop = materialize_population(active_population(t, cfg))
    ds = build_dataset(t, cfg, pop)
    ds.df.write.format("noop").mode("overwrite").save()
    wall = time.time() - t0
    spark.stop()

    stages = []
    for path in glob.glob(os.path.join(scratch, "**", "*"), recursive=True):
        if os.path.isdir(path) or os.path.basename(path).startswith("appstatus"):
            continue
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                if ev.get("Event") != "SparkListenerStageCompleted":
                    continue
                info = ev["Stage Info"]
                acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                stages.append(
                    (
                        (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000.0,
                        info["Stage ID"],
                        info["Stage Name"][:60],
                        info["Number of Tasks"],
                        int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0),
                        int(acc.get("internal.metrics.shuffle.read.remoteBytesRead", 0) or 0)
                        + int(acc.get("internal.metrics.shuffle.read.localBytesRead", 0) or 0),
                    )
                )
    stages.sort(reverse=True)
    print(f"wall {wall:.1f}s, {len(stages)} stages, sum of stage times {sum(s[0] for s in stages):.1f}s")
    print(f"{'sec':>6} {'id':>4} {'tasks':>5} {'shufW':>10} {'shufR':>10}  name")
    for sec, sid, name, tasks, w, r in stages[:15]:
        print(f"{sec:6.2f} {sid:4d} {tasks:5d} {w:10d} {r:10d}  {name}")


if __name__ == "__main__":
    main()
