"""FE15-FE17, P17, A12/L9 and the models' input without columns: one sparse vector per user.

Attribute values and click events are as many as the data hold. Here they never become columns and no list
of them reaches the driver:

* **dictionary** (family, place, feature, index): every feature's rank by (family, place, name). The names are
  dealt over range partitions and sorted; a feature's index is its place in its partition plus the
  number of features in the partitions before (one row per partition), so nothing ranks all names in one task. Two
  values whose names collide fail the run, found by an aggregate;
* **vectors** (user_id, indices, values): one row per user with a non-zero, straight from the counted
  (user, feature) rows: a join with the dictionary and one aggregate by user. A user has as many
  entries as features of their own;
* **log10(1 + x)** maps 0 to 0 and is taken of the non-zeros only; **moments** over all users come from the
  non-zeros and the number of users: with mean m and squared deviations q of n non-zeros among N users, the
  deviations of all are q + m^2 n (N - n) / N.

The wide dataset (``plans/dataset.py``) stays what the dataset sink writes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import JobConfig
from ..session import ensure_checkpoint_dir
from ..sources.tables import Tables
from . import activations as act
from . import clicks as clk
from . import flags
from . import payment_events as pev
from . import payments as pay
from .assemble import KEY_COLUMNS, LABEL_COLUMNS, left_join_features, zero_fill
from .population import as_population
from .transform import log1p10

#: families in the order of the dataset's columns
FIXED, ATTR1, ATTR2, CLICK = range(4)


@dataclass
class SparseDataset:
    users: DataFrame  # the keys and labels of every user
    entries: DataFrame  # user_id, index, value: the non-zeros
    dictionary: DataFrame  # family, place, feature, index
    n_users: int
    n_features: int

    def vectors(self) -> DataFrame:
        """(user_id, indices, values) of users with a non-zero, indices ascending."""
        pairs = F.sort_array(F.collect_list(F.struct("index", "value")))
        rows = self.entries.groupBy("user_id").agg(pairs.alias("p"))
        return rows.select("user_id", F.col("p.index").alias("indices"), F.col("p.value").alias("values"))

    def named(self) -> DataFrame:
        """(user_id, index, feature, value)."""
        return self.entries.join(self.dictionary.select("index", "feature"), "index").select(
            "user_id", "index", "feature", "value"
        )

    def logged(self) -> SparseDataset:
        """P17 on the non-zeros; entries that become 0 leave."""
        entries = self.entries.withColumn("value", log1p10(F.col("value"))).where("value != 0")
        return SparseDataset(self.users, entries, self.dictionary, self.n_users, self.n_features)

    def moments(self) -> DataFrame:
        """(index, feature, mean, std) over all users, zeros counted; features without a non-zero have 0 and 0."""
        part = self.entries.groupBy("index").agg(
            F.count(F.lit(1)).cast("double").alias("n"), F.avg("value").alias("m"), F.var_pop("value").alias("v")
        )
        total = F.lit(float(max(1, self.n_users)))
        joined = self.dictionary.select("index", "feature").join(part, "index", "left").fillna(0.0, ["n", "m", "v"])
        spread = F.col("v") * F.col("n") + F.col("m") * F.col("m") * F.col("n") * (total - F.col("n")) / total
        mean = F.col("m") * F.col("n") / total
        return joined.select("index", "feature", mean.alias("mean"), F.sqrt(spread / total).alias("std"))


def rank_features(names: DataFrame) -> DataFrame:
    """(family, place, feature, index): the dense rank of each (family, place, feature)."""
    order = ["family", "place", "feature"]
    ensure_checkpoint_dir(names.sparkSession)
    sorted_names = names.distinct().repartitionByRange(*order).sortWithinPartitions(*order)
    # written with its partition's number, which a recomputed range could change
    dealt = sorted_names.withColumn("part", F.spark_partition_id()).checkpoint(eager=True)
    sizes = dealt.groupBy("part").count()
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy(*order)
    ranked = dealt.withColumn("own", F.row_number().over(inside) - 1).join(F.broadcast(offsets), "part")
    return ranked.select(*order, (F.col("own") + F.col("offset")).cast("int").alias("index"))


def check_names(values: DataFrame, fixed: list[str]) -> None:
    """Fail when two (family, value) pairs, or one and a fixed feature, share a name, or a name is empty."""
    named = values.select("family", "value", "feature").distinct()
    clash = named.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).where(
        (F.col("n") > 1) | F.col("feature").isin([*KEY_COLUMNS, *LABEL_COLUMNS, *fixed, ""])
    )
    found = clash.select("feature").limit(5).collect()
    if found:
        raise ValueError(f"feature names that are empty or not unique: {[r.feature for r in found]}")


def sparse_dataset(users: DataFrame, fixed: list[str], counts: DataFrame) -> SparseDataset:
    """``users``: keys, labels and the fixed features, one row per user; ``counts``: (user_id, family,
    value, feature, cnt) of everything else."""
    spark = users.sparkSession
    ensure_checkpoint_dir(spark)
    users, counts = users.checkpoint(eager=True), counts.checkpoint(eager=True)
    check_names(counts, fixed)
    literal = spark.createDataFrame([(FIXED, i, c) for i, c in enumerate(fixed)], "family int, place int, feature string")
    seen = counts.select(F.col("family").cast("int"), F.lit(0).alias("place"), "feature")
    dictionary = rank_features(literal.unionByName(seen)).checkpoint(eager=True)
    pairs = F.inline(F.array(*(F.struct(F.lit(i).alias("index"), F.col(f"`{c}`").alias("value")) for i, c in enumerate(fixed))))
    own = users.select("user_id", pairs)  # the fixed features come first, so their places are their indices
    rest = counts.groupBy("user_id", "feature").agg(F.sum("cnt").cast("double").alias("value"))
    rest = rest.join(dictionary.where(F.col("family") != FIXED).select("feature", "index"), "feature")
    kept = rest.join(users.select("user_id"), "user_id", "left_semi").select("user_id", "index", "value")
    entries = own.unionByName(kept).where("value != 0").checkpoint(eager=True)
    return SparseDataset(
        users.select(*KEY_COLUMNS, *LABEL_COLUMNS), entries, dictionary, users.count(), dictionary.count()
    )


def build_sparse(t: Tables, cfg: JobConfig, population) -> SparseDataset:
    """The dataset of ``plans/dataset.py`` as sparse vectors: the same features in the same order, no pivot."""
    from ..plans.dataset import FIXED_HEAD

    pop = as_population(population)
    grain = pev.item_grain(t, cfg, pop)
    fixed = [*FIXED_HEAD, *pev.service_columns(cfg), *pay.tariff_columns(cfg)]
    frames = [
        flags.manager_flags(t, cfg, pop),
        pay.payment_features(pay.payments_family(t, cfg, pop), cfg),
        act.activation_family(t, cfg, pop),
        act.snapshot_other_items(t, cfg, pop),
        pev.item_counts(grain),
        pev.operation_branch(t, cfg, pop),
    ]
    users = zero_fill(left_join_features(pop.df.select(*KEY_COLUMNS), frames), [*LABEL_COLUMNS, *fixed])
    family = lambda df, n: df.select("user_id", F.lit(n).alias("family"), "value", "feature", F.col("cnt").cast("double").alias("cnt"))
    clicks = clk.named_click_counts(t, cfg, pop).withColumn("value", F.col("feature"))
    counts = family(pev.attr_counts(grain, cfg, "attr1"), ATTR1)
    counts = counts.unionByName(family(pev.attr_counts(grain, cfg, "attr2"), ATTR2)).unionByName(family(clicks, CLICK))
    return sparse_dataset(users, fixed, counts)


def sparse_training_frame(ds: SparseDataset, cfg: JobConfig) -> DataFrame:
    """(user_id, label, indices, values, half, fold): log features but for the excluded ones, as
    ``operators/logistic.py`` packs them; users without a non-zero have empty arrays."""
    from .models import add_split_columns

    out = ds.dictionary.where(F.col("feature").isin(list(cfg.exclude_features))).select("index")
    logged = ds.logged()
    logged.entries = logged.entries.join(F.broadcast(out), "index", "left_anti")  # at most the listed names
    rows = ds.users.select("user_id", F.col("is_asd").cast("double").alias("label")).join(logged.vectors(), "user_id", "left")
    empty = {"indices": "array<int>", "values": "array<double>"}
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.array().cast(kind)) for c, kind in empty.items()})
    return add_split_columns(rows.checkpoint(eager=True), "user_id", cfg.seed, cfg.cv_folds).checkpoint(eager=True)
