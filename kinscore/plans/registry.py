"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the driver tables at ``sf_dir`` through the adapters, runs over the whole
tables, and runs the plans the job runs: the population is checkpointed and counted once,
flags come from the one-pass ``manager_flags``, the run-log row from the job's builder. The
assembled dataset is registered in long form (its columns follow the data).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import JobConfig, driver_config
from ..functions.text import slug
from ..operators import activations as act
from ..operators import clicks as clk
from ..operators import flags
from ..operators import payment_events as pev
from ..operators import payments as pay
from ..operators.population import Population, active_population, materialize_population
from ..sources.adapters import driver_tables
from ..sources.tables import Tables, read_driver_table
from .dataset import Dataset, build_dataset, long_form


def setup(spark: SparkSession, sf_dir: str) -> tuple[Tables, JobConfig, Population]:
    cfg = driver_config()
    t = driver_tables(spark, sf_dir)
    return t, cfg, materialize_population(active_population(t, cfg))


def dataset(spark: SparkSession, sf_dir: str) -> tuple[Dataset, JobConfig]:
    t, cfg, pop = setup(spark, sf_dir)
    return build_dataset(t, cfg, pop), cfg


def stored_dataset(spark: SparkSession, sf_dir: str) -> tuple[Dataset, JobConfig]:
    """The dataset behind a checkpoint, as the job's later stages read it from its table."""
    ds, cfg = dataset(spark, sf_dir)
    return Dataset(ds.df.checkpoint(eager=True), ds.spec), cfg


def active_population_q(spark, sf_dir):
    return setup(spark, sf_dir)[2].df


def flag_on_date_q(spark, sf_dir):
    t, cfg = driver_tables(spark, sf_dir), driver_config()
    return flags.flagged(flags.manager_flags(t, cfg), "is_asd")


def flag_ever_q(spark, sf_dir):
    t, cfg = driver_tables(spark, sf_dir), driver_config()
    return flags.flagged(flags.manager_flags(t, cfg), "was_asd")


def flag_others_q(spark, sf_dir):
    t, cfg, pop = setup(spark, sf_dir)
    return flags.flagged(flags.manager_flags(t, cfg, pop), "asd_others")


def _payments(spark, sf_dir):
    t, cfg, pop = setup(spark, sf_dir)
    return pay.payments_family(t, cfg, pop), cfg


def _nonzero(df: DataFrame, name: str) -> DataFrame:
    return df.where(F.col(name) != 0).select("user_id", F.col(name).cast("double").alias(name))


def revenue_90_q(spark, sf_dir):
    return _nonzero(_payments(spark, sf_dir)[0], "all_revenue_90")


def revenue_30_q(spark, sf_dir):
    return _nonzero(_payments(spark, sf_dir)[0], "all_revenue_30")


def revenue_180_q(spark, sf_dir):
    return _nonzero(_payments(spark, sf_dir)[0], "revenue_180")


def tariff_counts_q(spark, sf_dir):
    fam, cfg = _payments(spark, sf_dir)
    return pev.long_counts(fam, pay.tariff_columns(cfg))


def activation_buckets_q(spark, sf_dir):
    t, cfg, pop = setup(spark, sf_dir)
    return act.activation_buckets_long(act.activation_family(t, cfg, pop))


def snapshot_other_q(spark, sf_dir):
    t, cfg, pop = setup(spark, sf_dir)
    return act.snapshot_other_items(t, cfg, pop)


def distinct_items_q(spark, sf_dir):
    t, cfg, pop = setup(spark, sf_dir)
    return _nonzero(pev.item_counts(pev.item_grain(t, cfg, pop)), "count_items_180")


def distinct_payments_q(spark, sf_dir):
    t, cfg, pop = setup(spark, sf_dir)
    return _nonzero(pev.operation_branch(t, cfg, pop), "count_payments_180")


def service_counts_q(spark, sf_dir):
    t, cfg, pop = setup(spark, sf_dir)
    return pev.long_counts(pev.operation_branch(t, cfg, pop), pev.service_columns(cfg))


def _attr_counts(spark, sf_dir, attr):
    t, cfg, pop = setup(spark, sf_dir)
    return pev.attr_counts(pev.item_grain(t, cfg, pop), cfg, attr).select("user_id", "feature", "cnt")


def attr1_counts_q(spark, sf_dir):
    return _attr_counts(spark, sf_dir, "attr1")


def attr2_counts_q(spark, sf_dir):
    return _attr_counts(spark, sf_dir, "attr2")


def slug_q(spark, sf_dir):
    part = read_driver_table(spark, sf_dir, "part")
    return part.select("p_partkey", slug("p_name").alias("name_slug"))


def click_counts_q(spark, sf_dir):
    t, cfg, pop = setup(spark, sf_dir)
    return clk.named_click_counts(t, cfg, pop)


def click_pivot_q(spark, sf_dir):
    """A9 with the fixed schema: one column per event of the catalog."""
    t, cfg, pop = setup(spark, sf_dir)
    return clk.click_pivot(t, cfg, pop, all_catalog=True)[0]


def feature_assembly_q(spark, sf_dir):
    return long_form(dataset(spark, sf_dir)[0])


def _sparse(spark, sf_dir):
    from ..operators.sparse import build_sparse

    return build_sparse(*setup(spark, sf_dir))


def sparse_features_q(spark, sf_dir):
    """FE0-FE17 as sparse vectors: every non-zero with its index in the feature dictionary."""
    return _sparse(spark, sf_dir).named()


def sparse_log_features_q(spark, sf_dir):
    return _sparse(spark, sf_dir).logged().named().withColumn("value", F.round("value", 6))


def sparse_moments_q(spark, sf_dir):
    moments = _sparse(spark, sf_dir).moments()
    return moments.select("index", "feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


def sparse_crossfit_q(spark, sf_dir):
    """L4 + L7 on sparse vectors (rows-only): the logistic score of every user, no feature a column."""
    from ..operators.models import cross_fit_logreg, grid_search_logreg
    from ..operators.sparse import build_sparse, sparse_training_frame

    t, cfg, pop = setup(spark, sf_dir)
    ds = build_sparse(t, cfg, pop)
    train = sparse_training_frame(ds, cfg)
    grid = grid_search_logreg(train, cfg.logreg_c_grid, cfg.logreg_weightings, cfg.cv_folds, ds.n_features)
    return cross_fit_logreg(train, grid.best_c, grid.best_weighting, "logreg_score", ds.n_features).scores


def _binned(spark, sf_dir):
    """The training rows in bins, and the parameters of a first tree that takes all rows and features."""
    from ..operators.boosting import CHECKED, TreeParams, bin_rows
    from ..operators.sparse import build_sparse, sparse_training_frame

    t, cfg, pop = setup(spark, sf_dir)
    p = TreeParams(**{**cfg.tree_params, **CHECKED})
    return bin_rows(sparse_training_frame(build_sparse(t, cfg, pop), cfg), p), p


def tree_root_histogram_q(spark, sf_dir):
    """Rows, gradients and hessians of the first tree's root per (feature, bin)."""
    from ..operators.boosting import Part, first_histogram

    data, p = _binned(spark, sf_dir)
    return first_histogram(data, Part(), p).select("index", "bin", "n", "g", "h")


def tree_first_splits_q(spark, sf_dir):
    """Every split of the first tree on all rows and features, with its gain and what goes left and right."""
    from ..operators.boosting import Part, fit_trees

    data, p = _binned(spark, sf_dir)
    rows = [(s[2], s[3], s[4], round(s[5], 6), *s[6:]) for s in fit_trees(data, [Part()], p).splits]
    return spark.createDataFrame(rows, "node int, index int, cut int, gain double, gl double, hl double, gr double, hr double")


def label_balance_q(spark, sf_dir):
    from ..sources.sinks import label_balance

    return label_balance(dataset(spark, sf_dir)[0].df)


def run_log_comment_q(spark, sf_dir):
    """The dataset stage's run-log row, without the run's duration."""
    from ..sources.sinks import balance_log_row

    return balance_log_row(dataset(spark, sf_dir)[0].df, "lookalike", "collect_dataset")


def class_weights_q(spark, sf_dir):
    from ..operators.models import class_weight_table

    return class_weight_table(dataset(spark, sf_dir)[0].df, "is_asd")


def _training(spark, sf_dir):
    from .recommend import training_frame

    ds, cfg = dataset(spark, sf_dir)
    return cfg, training_frame(ds, cfg)[0]


def grid_search_q(spark, sf_dir):
    """L4 (rows-only): mean cross-validated F1 per (C, weighting), with the worst KKT residual of its fits."""
    from .recommend import logistic_scores

    cfg, train = _training(spark, sf_dir)
    grid, _ = logistic_scores(train, cfg)
    return spark.createDataFrame(grid.rows, "C double, weighting string, f1 double, kkt double")


def crossfit_logreg_q(spark, sf_dir):
    """L2 + L7 (rows-only): cross-fitted logistic score per user."""
    from .recommend import logistic_scores

    cfg, train = _training(spark, sf_dir)
    return logistic_scores(train, cfg)[1].scores


def crossfit_trees_q(spark, sf_dir):
    """L5 + L7 (rows-only): cross-fitted boosted-tree score per user."""
    from .recommend import tree_fit

    cfg, train = _training(spark, sf_dir)
    return tree_fit(train, cfg).scores


def tree_cv_q(spark, sf_dir):
    """L6 (rows-only): F1 of the tree setting on each fold."""
    from .recommend import tree_cv

    cfg, train = _training(spark, sf_dir)
    folds = list(enumerate(tree_cv(train, cfg)))
    return spark.createDataFrame([(k, float(f)) for k, f in folds], "fold int, f1 double")


def recommend_list_q(spark, sf_dir):
    """The job's output list (rows-only): 14 columns, no history yet."""
    from .recommend import recommend

    ds, cfg = stored_dataset(spark, sf_dir)
    return recommend(ds, cfg).rows


QUERIES = {
    "active_population": active_population_q,
    "flag_managed_on_date": flag_on_date_q,
    "flag_managed_ever": flag_ever_q,
    "flag_managed_by_others": flag_others_q,
    "revenue_90": revenue_90_q,
    "revenue_30": revenue_30_q,
    "activation_buckets": activation_buckets_q,
    "snapshot_items_other": snapshot_other_q,
    "revenue_180_rule": revenue_180_q,
    "distinct_items_180": distinct_items_q,
    "distinct_payments_180": distinct_payments_q,
    "service_counts": service_counts_q,
    "tariff_counts": tariff_counts_q,
    "attr1_counts": attr1_counts_q,
    "attr2_counts": attr2_counts_q,
    "slug": slug_q,
    "click_counts": click_counts_q,
    "click_pivot": click_pivot_q,
    "feature_assembly": feature_assembly_q,
    "sparse_features": sparse_features_q,
    "sparse_log_features": sparse_log_features_q,
    "sparse_moments": sparse_moments_q,
    "sparse_crossfit": sparse_crossfit_q,
    "tree_root_histogram": tree_root_histogram_q,
    "tree_first_splits": tree_first_splits_q,
    "label_balance": label_balance_q,
    "class_weights": class_weights_q,
    "run_log_comment": run_log_comment_q,
    "grid_search": grid_search_q,
    "crossfit_logreg": crossfit_logreg_q,
    "crossfit_trees": crossfit_trees_q,
    "tree_cv": tree_cv_q,
    "recommend_list": recommend_list_q,
}
