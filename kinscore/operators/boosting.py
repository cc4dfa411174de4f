"""Second-order boosted trees on histograms (logistic loss, L1 and L2 on the leaves), several fits together.

With gradient g and hessian h of a row's log-loss, G and H their sums over a node and T(G) = sign(G) max(|G| - l1, 0),
a node scores T(G)^2 / (H + l2), a split gains what its children score above their parent, and a leaf adds
``-learning_rate * T(G) / (H + l2)`` to its rows' margins. Both children of a split hold a hessian of ``min_hessian`` or more.

* **Bins.** A feature's non-zeros are read at levels of 1/1024 and dealt into at most ``bins`` quantiles by exact
  counts of the levels; zero is a bin of its own between negative and positive values. Features are logarithms, so their
  levels are bounded by the range of a double, not by the number of rows.
* **A level of all trees is one job.** A row finds its node by walking the trees so far (arrays indexed by the node's
  number, children of n are 2n and 2n + 1), gives (g, h) to each bin it is not zero in, and partial sums by (fit, node,
  feature, bin) are what is shuffled; the zero bin is the node's total, known from its parent's split, less the others. Gains are running sums over
  a feature's bins (``bins`` + 2 at most). The best split of each node reaches the driver: fits x 2^depth rows.
* **A finished tree** moves its rows' margins; the rows are written to the checkpoint folder, which costs one write for the
  ``depth`` reads that the tree took. A lost executor costs its tasks.
* ``subsample`` of the rows and ``columns`` of the features, by hashes of (seed, tree, id), grow each tree; every
  row gets every fit's margin, so a fit scores the rows it did not learn from without another pass.

Ties go to the smaller feature, then the smaller bin. A null label takes no part in growing and is scored. A fit without rows, or
whose nodes cannot be split, gives single leaves; no features, the same.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

LEVELS_PER_UNIT = 1024
LEAF = -1
TREES = "array<struct<feature:array<int>,cut:array<int>,zero:array<int>,weight:array<double>>>"
TOTALS = "array<array<struct<n:bigint,g:double,h:double>>>"


@dataclass(frozen=True)
class TreeParams:
    rounds: int = 100
    depth: int = 10
    learning_rate: float = 0.1
    subsample: float = 0.7
    columns: float = 0.5
    l1: float = 0.5
    l2: float = 1.0
    min_hessian: float = 10.0
    bins: int = 254
    seed: int = 17


#: the registered first tree: with the job's own penalties the rare positives of the test tables allow no split
CHECKED = {"rounds": 1, "subsample": 1.0, "columns": 1.0, "l1": 0.01, "l2": 0.01, "min_hessian": 1.0}


@dataclass(frozen=True)
class Part:
    """The rows that a fit learns from: those whose ``column`` is, or is not, ``value``; all without a column."""

    column: str | None = None
    value: int = 0
    inside: bool = True

    def rows(self) -> Column:
        if self.column is None:
            return F.lit(True)
        own = F.col(self.column) == self.value
        return own if self.inside else ~own


@dataclass(frozen=True)
class Binned:
    rows: DataFrame  # user_id, label, half, fold, indices, bins: the non-zeros of each row
    zeros: DataFrame  # index, zero: the bin of 0


@dataclass
class Tree:
    """One tree as arrays by node number; number 0 is not used."""

    feature: list[int] = field(default_factory=lambda: [LEAF, LEAF])
    cut: list[int] = field(default_factory=lambda: [0, 0])
    zero: list[int] = field(default_factory=lambda: [0, 0])
    weight: list[float] = field(default_factory=lambda: [0.0, 0.0])

    totals: list[dict] = field(default_factory=lambda: [{}, {}])

    def set_node(self, node: int, total: tuple, p: TreeParams) -> None:
        for values, empty in ((self.feature, LEAF), (self.cut, 0), (self.zero, 0), (self.weight, 0.0), (self.totals, {})):
            values.extend([empty] * (node + 1 - len(values)))
        self.totals[node] = dict(zip("ngh", total, strict=True))
        self.weight[node] = _leaf(*total[1:], p)


@dataclass
class Trees:
    rows: DataFrame  # the binned rows with ``margins``: one number per fit
    splits: list[tuple]  # (fit, tree, node, feature, cut, gain, left and right gradient and hessian)


def bin_of(level: Column, before: Column, total: Column, bins: int, positive: Column) -> Column:
    """The quantile of the rows below the level; positive values lie two bins higher, so that 0 fits between."""
    return (F.floor(before * bins / total) + F.when(positive, 2).otherwise(0)).cast("int")


def bin_rows(train: DataFrame, p: TreeParams) -> Binned:
    """``train``: user_id, label, half, fold, indices, values (as ``sparse_training_frame`` gives them)."""
    ensure_checkpoint_dir(train.sparkSession)
    cells = train.select("user_id", F.inline(F.arrays_zip("indices", "values"))).withColumnRenamed("indices", "index")
    cells = cells.select(
        "user_id", "index", (F.col("values") > 0).alias("positive"), F.floor(F.col("values") * LEVELS_PER_UNIT).alias("level")
    ).where(F.col("values") != 0)
    sizes = cells.groupBy("index", "positive", "level").agg(F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("index")
    below = own.orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("total", F.sum("n").over(own)).withColumn("before", F.coalesce(F.sum("n").over(below), F.lit(0)))
    bins = sizes.withColumn("bin", bin_of(F.col("level"), F.col("before"), F.col("total"), p.bins, F.col("positive")))
    bins = bins.checkpoint(eager=True)
    negative = F.sum(F.when(F.col("positive"), 0).otherwise(F.col("n")))
    zeros = bins.groupBy("index").agg((F.floor(negative * p.bins / F.sum("n")) + 1).cast("int").alias("zero"))
    binned = cells.join(bins.select("index", "positive", "level", "bin"), ["index", "positive", "level"])
    pairs = binned.groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("index", "bin"))).alias("p"))
    pairs = pairs.select("user_id", F.col("p.index").alias("indices"), F.col("p.bin").alias("bins"))
    rows = train.select("user_id", "label", "half", "fold").join(pairs, "user_id", "left")
    rows = rows.withColumns({c: F.coalesce(F.col(c), F.expr("cast(array() as array<int>)")) for c in ("indices", "bins")})
    return Binned(rows.checkpoint(eager=True), zeros.checkpoint(eager=True))


def _chosen(share: float, *key: Column) -> Column:
    unit = F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") * F.lit(2.0**-53)
    return unit < share if share < 1 else F.lit(True)


def _literal(trees: list[Tree]) -> Column:
    """The trees as one constant of the plan; nothing is shipped as a table."""
    return F.from_json(F.lit(json.dumps([{c: getattr(t, c) for c in ("feature", "cut", "zero", "weight")} for t in trees])), TREES)


def _node(trees: Column, k: int, levels: int) -> Column:
    """The number of the node that a row has reached in fit k's tree."""
    tree = F.get(trees, k)

    def step(n: Column, _: Column) -> Column:
        feature = F.coalesce(F.get(tree["feature"], n), F.lit(LEAF))
        own = F.get("bins", (F.array_position("indices", feature) - 1).cast("int"))
        right = F.coalesce(own, F.get(tree["zero"], n)) > F.get(tree["cut"], n)
        return F.when(feature == LEAF, n).otherwise(2 * n + right.cast("int"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(1), step) if levels else F.lit(1)


def _probability(margin: Column) -> Column:
    return 1 / (1 + F.exp(-margin))


def gradients(rows: DataFrame, parts: list[Part], trees: list[Tree], p: TreeParams, tree: int, level: int) -> DataFrame:
    """(indices, bins, fit, node, g, h): the rows of each fit's sample that have reached this level."""
    literal, states = _literal(trees), []
    for k, part in enumerate(parts):
        prob = _probability(F.get("margins", F.lit(k)))
        learns = part.rows() & _chosen(p.subsample, F.lit(p.seed), F.lit(tree), F.col("user_id"))
        state = F.struct(
            F.lit(k).alias("fit"),
            _node(literal, k, level).alias("node"),
            (prob - F.col("label")).alias("g"),
            F.greatest(prob * (1 - prob), F.lit(1e-16)).alias("h"),
        )
        states.append(F.when(learns & F.col("label").isNotNull(), state))
    found = rows.select("indices", "bins", F.explode(F.array(*states)).alias("s")).where("s is not null")
    return found.select("indices", "bins", "s.*").where(F.col("node") >= 2**level)


def histograms(states: DataFrame, zeros: DataFrame, totals: Column, p: TreeParams, tree: int) -> DataFrame:
    """(fit, node, index, zero, bin, n, g, h, g_all, h_all): every bin that a node has rows in, with the node's totals.

    ``totals`` are arrays by (fit, node) that the splits of the level above gave; the zero bin is what the others leave."""
    cells = F.zip_with("indices", "bins", lambda i, b: F.struct(i.alias("index"), b.alias("bin")))
    if p.columns < 1:
        cells = F.filter(cells, lambda c: _chosen(p.columns, F.lit(p.seed + 1), F.lit(tree), c["index"]))
    sums = states.select("fit", "node", "g", "h", F.inline(cells)).groupBy("fit", "node", "index", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.sum("g").alias("g"), F.sum("h").alias("h")
    )
    # at most ``bins`` + 2 entries a list
    lists = sums.groupBy("fit", "node", "index").agg(
        F.collect_list(F.struct("bin", "n", "g", "h")).alias("own"), *[F.sum(c).alias(f"{c}_own") for c in ("n", "g", "h")]
    )
    lists = lists.join(zeros, "index").withColumn("all", F.get(F.get(totals, F.col("fit")), F.col("node")))
    rest = F.struct(F.col("zero").alias("bin"), *[(F.col(f"all.{c}") - F.col(f"{c}_own")).alias(c) for c in ("n", "g", "h")])
    every = F.when(F.col("all.n") > F.col("n_own"), F.array_append("own", rest)).otherwise(F.col("own"))
    return lists.select("fit", "node", "index", "zero", F.col("all.g").alias("g_all"), F.col("all.h").alias("h_all"), F.inline(every))


def _score(g: Column, h: Column, p: TreeParams) -> Column:
    kept = F.greatest(F.abs(g) - p.l1, F.lit(0.0))
    return kept * kept / (h + p.l2)


def split_gains(hist: DataFrame, p: TreeParams) -> DataFrame:
    """(fit, node, index, cut, zero, gain, nl, gl, hl, gr, hr) of every split whose children hold the least hessian."""
    w = Window.partitionBy("fit", "node", "index").orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    cut = hist.withColumns({f"{c}l": F.sum(c).over(w) for c in ("n", "g", "h")})
    cut = cut.withColumns({f"{c}r": F.col(f"{c}_all") - F.col(f"{c}l") for c in ("g", "h")})
    cut = cut.where((F.col("hl") >= p.min_hessian) & (F.col("hr") >= p.min_hessian))
    left, right = _score(F.col("gl"), F.col("hl"), p), _score(F.col("gr"), F.col("hr"), p)
    gain = left + right - _score(F.col("g_all"), F.col("h_all"), p)
    return cut.select("fit", "node", "index", F.col("bin").alias("cut"), "zero", gain.alias("gain"), "nl", "gl", "hl", "gr", "hr")


#: a split has to gain more than rounding gives
LEAST_GAIN = 1e-6


def best_splits(gains: DataFrame) -> DataFrame:
    """One row a node: the largest gain, ties to the smaller feature and cut."""
    names = ["cut", "zero", "nl", "gl", "hl", "gr", "hr"]
    order = F.struct("gain", (-F.col("index")).alias("by_index"), (-F.col("cut")).alias("by_cut"), *names)
    best = gains.where(F.col("gain") > LEAST_GAIN).groupBy("fit", "node").agg(F.max(order).alias("b"))
    return best.select("fit", "node", (-F.col("b.by_index")).alias("index"), "b.gain", *[f"b.{c}" for c in names])


def _leaf(g: float, h: float, p: TreeParams) -> float:
    kept = math.copysign(max(abs(g) - p.l1, 0.0), g)
    return -p.learning_rate * kept / (h + p.l2)


def set_roots(states: DataFrame, trees: list[Tree], p: TreeParams) -> None:
    sums = [F.count(F.lit(1)).alias("n"), F.sum("g").alias("g"), F.sum("h").alias("h")]
    for r in states.groupBy("fit").agg(*sums).collect():
        trees[r.fit].set_node(1, (r.n, r.g, r.h), p)


def _totals(trees: list[Tree]) -> Column:
    return F.from_json(F.lit(json.dumps([t.totals for t in trees])), TOTALS)


def first_histogram(data: Binned, part: Part, p: TreeParams) -> DataFrame:
    """The histogram of the root of a part's first tree."""
    rows, trees = data.rows.withColumn("margins", F.array(F.lit(0.0))), [Tree()]
    states = gradients(rows, [part], trees, p, 0, 0)
    set_roots(states, trees, p)
    return histograms(states, data.zeros, _totals(trees), p, 0)


def fit_trees(data: Binned, parts: list[Part], p: TreeParams) -> Trees:
    """Grow ``p.rounds`` trees for every part, level by level, all parts in the same jobs."""
    spark = data.rows.sparkSession
    ensure_checkpoint_dir(spark)
    rows = data.rows.withColumn("margins", F.array_repeat(F.lit(0.0), len(parts)))
    splits = []
    for t in range(p.rounds):
        trees = [Tree() for _ in parts]
        for level in range(p.depth):
            states = gradients(rows, parts, trees, p, t, level)
            if level == 0:
                set_roots(states, trees, p)
            totals = _totals(trees)
            found = best_splits(split_gains(histograms(states, data.zeros, totals, p, t), p)).collect()
            for r in found:
                tree = trees[r.fit]
                tree.feature[r.node], tree.cut[r.node], tree.zero[r.node] = r["index"], r.cut, r.zero
                n = tree.totals[r.node]["n"]
                tree.set_node(2 * r.node, (r.nl, r.gl, r.hl), p)
                tree.set_node(2 * r.node + 1, (n - r.nl, r.gr, r.hr), p)
                splits.append((r.fit, t, r.node, r["index"], r.cut, r.gain, r.gl, r.hl, r.gr, r.hr))
            if not found:
                break
        literal = _literal(trees)
        step = [F.get(F.get(literal, k)["weight"], _node(literal, k, p.depth)) for k in range(len(parts))]
        moved = [F.get("margins", F.lit(k)) + s for k, s in enumerate(step)]
        rows = rows.withColumn("margins", F.array(*moved)).checkpoint(eager=True)
    return Trees(rows, splits)


def cross_fit_trees(data: Binned, p: TreeParams, folds: int, name: str):
    """L6 and L7 in one batch of fits: (scores by the half that did not see the row, F1 of both halves, F1 per fold)."""
    parts = [Part("half", h) for h in (0, 1)] + [Part("fold", k, False) for k in range(folds)]
    rows = fit_trees(data, parts, p).rows
    # fit 0 learned from half 0 and scores half 1
    unseen = [F.col("half") == 1, F.col("half") == 0] + [F.col("fold") == k for k in range(folds)]
    sums = []
    for k, held in enumerate(unseen):
        hit, true = F.get("margins", F.lit(k)) > 0, F.col("label") == 1
        marks = {"tp": hit & true, "fp": hit & ~true, "fn": ~hit & true}
        sums += [F.count_if(held & m).alias(f"{c}{k}") for c, m in marks.items()]
    r = rows.agg(*sums).first()
    wrong = [2 * r[f"tp{k}"] + r[f"fp{k}"] + r[f"fn{k}"] for k in range(len(parts))]
    f1 = [2 * r[f"tp{k}"] / wrong[k] if wrong[k] else 0.0 for k in range(len(parts))]
    margin = F.when(F.col("half") == 1, F.get("margins", F.lit(0))).otherwise(F.get("margins", F.lit(1)))
    return rows.select("user_id", _probability(margin).alias(name)), f1[:2], f1[2:]
