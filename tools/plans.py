"""Print the physical plan trees of the key operators (``explain("formatted")`` top part).

Usage: python tools/plans.py [sf_dir]   (AQE is switched off here so the static plan shows;
at run time AQE may still turn sort-merge joins into broadcast joins and coalesce partitions)
"""

from __future__ import annotations

import contextlib
import io
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from kinscore.config import driver_config  # noqa: E402
from kinscore.operators import payment_events as pev  # noqa: E402
from kinscore.operators import payments as pay  # noqa: E402
from kinscore.operators.population import Population, active_population  # noqa: E402
from kinscore.operators.selection import top_k  # noqa: E402
from kinscore.plans.scoring_checks import embedding_vectors  # noqa: E402
from kinscore.operators.nearest import nearest_positive  # noqa: E402
from kinscore.session import local_session  # noqa: E402
from kinscore.sources.adapters import driver_tables  # noqa: E402


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    return text.split("\n\n(1)")[0].strip()


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    cfg = driver_config()
    t = driver_tables(spark, sf_dir)
    pop_df = active_population(t, cfg)
    counted = Population(pop_df, rows=125)
    e = embedding_vectors(spark, sf_dir)
    shown = {
        "FE0 population": pop_df,
        "payments family, counted population (broadcast semi join, then two-level aggregate)": pay.payments_family(
            t, cfg, counted
        ),
        "payments family, population of unknown size (aggregate first, then semi join)": pay.payments_family(
            t, cfg, Population(pop_df)
        ),
        "payment events, operation grain (item join, then exchange, then two-level aggregate)": pev.operation_branch(
            t, cfg, counted
        ),
        "payment events, attribute counts over the checkpointed item grain": pev.attr_counts(
            pev.item_grain(t, cfg, counted), cfg, "attr1"
        ),
        "nearest positive (packed chunks of candidates × packed blocks of positives)": nearest_positive(
            e.where(F.col("label") != 0), e.where(F.col("label") == 0)
        ),
        "top-k (TakeOrderedAndProject)": top_k(e.select("user_id", F.col("vec")[0].alias("s")), "s", 0.0, 100),
    }
    for title, df in shown.items():
        print(f"### {title}\n\n```\n{tree(df)}\n```\n")


if __name__ == "__main__":
    main()
