"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

DataFrame expressions only: no Python function, pandas, Arrow or RDD code.

1. *Targets*. Sources in code point order (null last) weigh 1, 2, 3, 1, 2, 3, ... and share the
   total size of all documents; no target exceeds ``MAX_REPEATS`` times its source's size, and the
   excess is shared again by weight. The end of that resharing is the water level L with
   target = min(MAX_REPEATS * size, L * weight), found from running sums over the sources in
   the order of their caps per unit of weight.
2. *Blocks*. A source is cut into blocks of about ``BLOCK_WORDS`` words by a hash of the id and text,
   so the order of the blocks is a random permutation. Prefix sums over superblocks, blocks and
   documents (windows that never hold more than a block, or 1024 blocks) place every
   document on the source's line of words, which begins anew with every pass over the source.
3. *Splitting tree*. The line is counted in units of a 4,096th of the source (``BLOCK_WORDS`` words at
   most), and the quota of a source is the number of whole units in its target. The vector of
   quotas at the root covers all output shards; each node draws the quotas of its left half
   of shards from the multivariate hypergeometric distribution and leaves the rest to the right half.
   A draw goes over buckets of ``BUCKET`` sources and then over the sources of each bucket, one
   conditional hypergeometric draw each (by inversion of the distribution function around its mode),
   which is the same distribution. Leaves are shards: their sources' quotas add up exactly. The tree works
   on counts only. The number of shards follows the words of the mix, ``SHARD_WORDS`` to a shard.
4. *Draw*. The leaves of a source take its units in the order of shards: leaf k the next ``quota`` of them,
   so leaves are disjoint. A document is taken once for every leaf stretch and pass that its midpoint lies
   in, and by no other rule; inside a shard rows are shuffled by a hash. Leaves meet blocks in an equi-join
   on cells of the line; a block carries only the leaves that overlap it.

Every draw is a hash of (seed, tree node, source): reruns and lost executors give the same mix.

Cases: a null or empty text has size 0 and is never cut short (it is taken with its block); a null
source is a source of its own, the last; a null id is placed by its text; rows that repeat an id are
documents of their own and lie in different blocks if their texts differ (wholly equal rows share a block
and stream through one sorted window); ties in the hash go by id and size; a very long text is one document
and is never cut; extra columns pass through; if all sizes are 0 every target is 0 and nothing is taken;
an empty table gives no rows. One row per source passes through one task in ``targets``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinscore.llm.common import WORD, named, require, saved

MAX_REPEATS = 3
BLOCK_WORDS = 65_536
#: words of the mix in an output shard, some 50 MB of text
SHARD_WORDS = 1 << 23
#: units that a source's line is counted in, unless units would exceed a block
GRAINS = 4096
#: sources whose quotas are drawn together, in one array
BUCKET = 1024
SEED = 8
#: sources (a few dozen bytes each) up to which their table is broadcast
BROADCAST_SOURCES = 10_000
_SUPER = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _unit(*key: Column) -> Column:
    """A uniform double in [0, 1) out of a hash."""
    return F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") * F.lit(2.0**-53)


def targets(sizes: DataFrame, max_repeats: float = MAX_REPEATS) -> DataFrame:
    """``sizes(source, source_size)`` -> (source, source_size, position, weight, target)."""
    every = Window.partitionBy(F.lit(0))
    by_name = every.orderBy(F.col("source").asc_nulls_last())
    t = sizes.withColumn("position", F.row_number().over(by_name) - 1)
    t = t.withColumn("weight", (F.col("position") % 3 + 1).cast("double"))
    t = t.withColumn("cap", F.lit(max_repeats) * F.col("source_size"))
    by_cap = every.orderBy(F.col("cap") / F.col("weight"), "position").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(every).cast("double")
    below = F.coalesce(F.sum("cap").over(by_cap), F.lit(0.0))
    light = F.coalesce(F.sum("weight").over(by_cap), F.lit(0.0))
    # the level if all sources before this one, in the order of caps, are at their caps
    t = t.withColumn("level", (total - below) / (F.sum("weight").over(every) - light))
    # the first source whose cap is not reached sets the level
    open_ = F.when(F.col("cap") >= F.col("level") * F.col("weight"), F.struct(F.col("cap") / F.col("weight"), "position", "level"))
    t = t.withColumn("level", F.min(open_).over(every)["level"])
    target = F.least("cap", F.coalesce(F.col("level") * F.col("weight"), F.col("cap")))
    return t.select("source", "source_size", "position", "weight", target.alias("target"))


def _ln_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, shifted up by eight so that small n are exact to 1e-13."""
    x = n + F.lit(9.0)
    low = F.lit(1.0)
    for k in range(1, 9):
        low = low * (n + F.lit(float(k)))
    series = (x - 0.5) * F.ln(x) - x + F.lit(0.9189385332046728) + 1 / (12 * x) - 1 / (360 * x * x * x)
    return series + 1 / (1260 * x * x * x * x * x) - F.ln(low)


def _let(fn, **cols: Column) -> Column:
    """Evaluate ``cols`` once and hand them to ``fn`` as the fields of a struct."""
    bound = F.array(F.struct(*[c.alias(k) for k, c in cols.items()]))
    return F.element_at(F.transform(bound, fn), 1)


def _hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """The number of good units among ``draws`` of ``total`` units, by inversion at ``u``.

    The support is cut at 12 standard deviations, beyond which the mass is under 1e-30;
    the mass is summed relative to the mode, so nothing over- or underflows."""

    def bounds(s: Column) -> Column:
        n, k, m = s["n"], s["k"], s["m"]
        mean = m * k / F.greatest(n, F.lit(1.0))
        share = (1 - k / F.greatest(n, F.lit(1.0))) * (n - m) / F.greatest(n - 1, F.lit(1.0))
        reach = 12 * F.sqrt(F.greatest(F.lit(0.0), mean * share)) + 12
        low = F.greatest(F.lit(0.0), m + k - n, F.floor(mean - reach).cast("double"))
        high = F.least(m, k, F.ceil(mean + reach).cast("double"))
        mode = F.floor((m + 1) * (k + 1) / (n + 2)).cast("double")
        return _let(masses, n=n, k=k, m=m, low=low, high=high, mode=F.least(high, F.greatest(low, mode)), u=s["u"])

    def ln_mass(s: Column, x: Column) -> Column:
        rest = s["n"] - s["k"] - s["m"] + x
        return -(_ln_factorial(x) + _ln_factorial(s["k"] - x) + _ln_factorial(s["m"] - x) + _ln_factorial(rest))

    def masses(s: Column) -> Column:
        def each(t: Column) -> Column:
            support = F.sequence(t["s"]["low"].cast("long"), t["s"]["high"].cast("long"))
            mass = F.transform(support, lambda x: F.exp(ln_mass(t["s"], x.cast("double")) - t["peak"]))
            return _let(invert, s=t["s"], mass=mass)

        return _let(each, s=s, peak=ln_mass(s, s["mode"]))

    def invert(t: Column) -> Column:
        def pick(v: Column) -> Column:
            zero = F.struct(F.lit(0.0).alias("sum"), F.lit(0).cast("long").alias("n"))
            passed = F.aggregate(
                v["mass"],
                zero,
                lambda a, p: F.struct(
                    (a["sum"] + p).alias("sum"), (a["n"] + F.when(a["sum"] + p <= v["aim"], 1).otherwise(0)).alias("n")
                ),
                lambda a: a["n"],
            )
            return F.least(v["s"]["high"].cast("long"), v["s"]["low"].cast("long") + passed)

        aim = t["s"]["u"] * F.aggregate(t["mass"], F.lit(0.0), lambda a, p: a + p)
        return _let(pick, s=t["s"], mass=t["mass"], aim=aim)

    return _let(bounds, n=total.cast("double"), k=good.cast("double"), m=draws.cast("double"), u=u)


def _drawn(quotas: Column, draws: Column, *key: Column) -> Column:
    """How many of ``draws`` units each entry of ``quotas(name, quota)`` gives: an array of longs.

    Entry i draws from what the entries from i on still hold."""
    start = F.struct(
        F.aggregate(quotas, F.lit(0).cast("long"), lambda a, x: a + x["quota"]).alias("left"),
        draws.alias("draws"),
        F.expr("cast(array() as array<bigint>)").alias("got"),
    )

    def step(a: Column, x: Column) -> Column:
        got = _hypergeometric(a["left"], x["quota"], a["draws"], _unit(*key, x["name"]))
        return F.struct(
            (a["left"] - x["quota"]).alias("left"),
            (a["draws"] - got).alias("draws"),
            F.concat(a["got"], F.array(got)).alias("got"),
        )

    return F.aggregate(quotas, start, step, lambda a: a["got"])


def splitting_tree(quotas: DataFrame, shards: int, seed: int = SEED, bucket: int = BUCKET) -> DataFrame:
    """``quotas(position, quota)`` -> (position, shard, quota): exact splits of every quota.

    One level of the tree per round; a node is one row for each bucket of its sources. The node's units are
    drawn over its buckets first, then over the sources of each bucket."""
    if shards < 1:
        raise ValueError("at least one shard")
    entry = F.struct(F.col("position").cast("long").alias("name"), F.col("quota").cast("long").alias("quota"))
    node = quotas.groupBy(F.floor(F.col("position") / bucket).alias("bucket")).agg(
        F.sort_array(F.collect_list(entry)).alias("q")
    )
    node = node.select(F.lit(0).alias("first"), F.lit(shards).alias("n"), "bucket", "q")
    size = 1
    while size < shards:
        size *= 2
        half = F.floor(F.col("n") / 2).cast("int")
        own = F.aggregate("q", F.lit(0).cast("long"), lambda a, x: a + x["quota"])
        held = F.struct(F.col("bucket").alias("name"), F.col("own").alias("quota"))
        drawn = node.withColumn("half", half).withColumn("own", own)
        drawn = drawn.withColumn("heads", F.sort_array(F.collect_list(held).over(Window.partitionBy("first"))))
        whole = F.aggregate("heads", F.lit(0).cast("long"), lambda a, x: a + x["quota"])
        wanted = F.floor(whole * F.col("half") / F.greatest("n", F.lit(1))).cast("long")
        key = (F.lit(seed), F.col("first"), F.col("n"))
        place = F.array_position(F.transform("heads", lambda h: h["name"]), F.col("bucket"))
        share = F.element_at(_drawn(F.col("heads"), wanted, *key, F.lit("bucket")), place.cast("int"))
        drawn = drawn.withColumn("share", share).withColumn("got", _drawn(F.col("q"), F.col("share"), *key))
        left = F.zip_with("q", "got", lambda x, g: F.struct(x["name"].alias("name"), g.alias("quota")))
        right = F.zip_with("q", "got", lambda x, g: F.struct(x["name"].alias("name"), (x["quota"] - g).alias("quota")))
        first, n = F.col("first"), F.col("n")
        children = F.array(
            F.struct(first.alias("first"), F.col("half").alias("n"), F.col("bucket").alias("bucket"), left.alias("q")),
            F.struct(
                (first + F.col("half")).alias("first"), (n - F.col("half")).alias("n"),
                F.col("bucket").alias("bucket"), right.alias("q"),
            ),
        )
        node = saved(drawn.select(F.inline(children)).where("n > 0"))
    return node.select(F.col("first").alias("shard"), F.inline("q")).select(
        F.col("name").cast("int").alias("position"), "shard", "quota"
    )


def plan_mix(docs: DataFrame, **options) -> DataFrame:
    """All columns of ``docs`` plus ``__mix``: struct(size, source_size, target, copies), where
    ``copies`` lists the (pass, shard) of every time the mix takes the document."""
    return _planned(docs, **options)[0]


def _planned(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    shards: int | None = None,
    block_words: int = BLOCK_WORDS,
    max_repeats: float = MAX_REPEATS,
    seed: int = SEED,
) -> tuple[DataFrame, int]:
    """The plan and its number of shards, which follows the size of the mix if it is not given."""
    require(docs, doc_id, text, source)
    own = {c: f"__c{i}" for i, c in enumerate(docs.columns)}  # no name of the input meets one of ours
    key, body = F.col(own[doc_id]), F.col(own[text])
    sized = docs.toDF(*own.values()).withColumns({
        "__source": F.col(own[source]),
        "__id": key,
        "__size": word_count(body),
        "__hash": F.xxhash64(key, body, F.lit(seed)),
    })
    totals = saved(sized.groupBy(F.col("__source").alias("source")).agg(F.sum("__size").alias("source_size")))
    unit = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.col("source_size") / GRAINS))).cast("long")
    goal = targets(totals, max_repeats).withColumns({
        "n_blocks": F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long"),
        "unit": unit,
        "quota": F.floor(F.col("target") / unit).cast("long"),  # never above max_repeats passes
    })
    goal = saved(goal)
    n_sources, words = goal.agg(F.count(F.lit(1)), F.coalesce(F.sum("target"), F.lit(0.0))).first()
    if shards is None:
        shards = max(1, math.ceil(words / SHARD_WORDS))

    def per_source(df: DataFrame) -> DataFrame:
        """A table of one row per source, broadcast only if their counted number is small."""
        return F.broadcast(df) if n_sources <= BROADCAST_SOURCES else df

    # documents -> blocks of their source
    named = goal.select(F.col("source").alias("__s"), "source_size", "target", "position", "n_blocks")
    placed = sized.join(per_source(named), F.col("__source").eqNullSafe(F.col("__s"))).drop("__s")
    u = F.shiftrightunsigned("__hash", 11).cast("double") * F.lit(2.0**-53)
    placed = placed.withColumn("block", F.least(F.floor(u * F.col("n_blocks")), F.col("n_blocks") - 1))
    blocks = saved(placed.groupBy("position", "block").agg(F.sum("__size").alias("words")))
    # prefix sums over superblocks, then over the blocks inside one
    outer = F.floor(F.col("block") / _SUPER)
    supers = blocks.groupBy("position", outer.alias("super")).agg(F.sum("words").alias("words"))
    before = Window.partitionBy("position").orderBy("super").rowsBetween(Window.unboundedPreceding, -1)
    supers = supers.select("position", "super", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    inner = Window.partitionBy("position", "super").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        blocks.withColumn("super", outer)
        .withColumn("own", F.coalesce(F.sum("words").over(inner), F.lit(0)))
        .join(supers, ["position", "super"])
        .select("position", "block", "words", (F.col("base") + F.col("own")).alias("start"))
    )
    starts = saved(starts)
    # leaves: the stretch [a, e) of a source's line, in words, that a shard takes
    before_shard = Window.partitionBy("position").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    leaves = splitting_tree(goal.select("position", "quota"), shards, seed).where("quota > 0")
    leaves = leaves.withColumn("end", F.sum("quota").over(before_shard))
    leaves = leaves.join(per_source(goal.select("position", "unit")), "position").select(
        "position", "shard", ((F.col("end") - F.col("quota")) * F.col("unit")).alias("a"),
        (F.col("end") * F.col("unit")).alias("e"),
    )
    # leaves and blocks meet on cells of the line
    cells = lambda lo, hi: F.sequence(F.floor(lo / block_words), F.floor(hi / block_words))
    spread = leaves.withColumn("cell", F.explode(cells(F.col("a"), F.col("e") - 1)))
    passes = F.sequence(F.lit(0), F.lit(max(0, math.ceil(max_repeats) - 1)))
    lo = F.col("pass") * F.col("source_size") + F.col("start")
    laid = starts.join(per_source(goal.select("position", "source_size")), "position")
    laid = laid.withColumn("pass", F.explode(passes)).select("position", "block", lo.alias("lo"), (lo + F.col("words")).alias("hi"))
    laid = laid.withColumn("cell", F.explode(cells(F.col("lo"), F.col("hi"))))
    met = laid.join(spread, ["position", "cell"]).where("a <= hi and e > lo")
    met = met.groupBy("position", "block").agg(F.collect_set(F.struct("a", "e", "shard")).alias("leaves"))
    where = saved(starts.drop("words").join(met, ["position", "block"], "left"))
    order = Window.partitionBy("position", "block").orderBy("__hash", "__id", "__size")
    at = placed.withColumn(
        "__before", F.coalesce(F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ).join(where, ["position", "block"])

    def copy(p: Column) -> Column:
        twice = 2 * (p * F.col("source_size") + F.col("start") + F.col("__before")) + F.col("__size")
        own = F.filter("leaves", lambda x: (2 * x["a"] <= twice) & (twice < 2 * x["e"]))
        return F.struct(p.cast("int").alias("pass"), F.try_element_at(own, F.lit(1))["shard"].alias("shard"))

    copies = F.filter(F.transform(passes, copy), lambda c: c["shard"].isNotNull())
    mix = F.struct(F.col("__size").alias("size"), "source_size", "target", copies.alias("copies"))
    at = at.withColumn("__mix", mix).select(*own.values(), "__mix")
    return at.toDF(*own, "__mix"), shards


def mix_sources(docs: DataFrame, shards: int | None = None, seed: int = SEED, **names) -> DataFrame:
    """The mix itself, in the columns of ``docs``: one row for every time a document is taken,
    one partition per shard, shuffled inside."""
    key = named(names.get("doc_id", "doc_id"))
    plan, shards = _planned(docs, shards=shards, seed=seed, **names)
    drawn = plan.withColumn("__copy", F.explode("__mix.copies"))
    drawn = drawn.withColumn("__order", F.xxhash64(key, F.col("__copy.pass"), F.lit(seed)))
    dealt = drawn.repartitionById(shards, F.col("__copy.shard")).sortWithinPartitions("__order")
    return dealt.select(*[named(c) for c in docs.columns])
