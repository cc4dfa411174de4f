"""Toxicity by non-negative positive-unlabelled learning.

Learning sees confirmed toxic documents (P) and a sample U of all learning rows whose labels it does not
use, toxic ones included, so that the toxic share of U is the class prior p (as far as labels
are given regardless of the class). The risk of a classifier g under loss l is

    p * E_P[l(g)] + max(0, E_U[l(-g)] - p * E_P[l(-g)])

the second term being the risk of clean text, corrected for the toxic part of U. When a step drives
it below zero, the classifier has begun to fit U's toxic documents as clean, and the step goes the
other way (the non-negative estimator). The loss is the sigmoid loss, whose bound keeps an
inexact prior from moving the bias; linear classifiers are trained in numpy.

1. A bounded sample of the learning rows: the ``MAX_POSITIVE`` and ``MAX_UNLABELLED`` ids with the
   smallest id hash, one row each: of an id's texts the one with the smallest hash. The same rows come out
   at every run.
2. Features: the distinct lower-case words of a text and their first ``PREFIX`` letters, as 64-bit
   hashes (no shared buckets, so a long text meets no false ones). Features kept: those
   ``MIN_RATIO`` times as frequent in P as in U, by ``MIN_DEVIATIONS`` standard deviations (fewer for
   small samples, which cannot show as many); copies of one text count once.
3. ``MEMBERS`` classifiers, each without another part of the sample, are trained in parallel tasks;
   their weights (at most ``MAX_FEATURES`` each, the most telling features: rarer signs beyond these
   score nothing) are averaged.
4. One map over all documents sums the weights of the features that a whole text holds.

Without positive rows every score is 0. The prior is a parameter; by default it is the toxic share
of the labelled learning rows, so of U itself where every document has a label.

Cases: a null or empty text has no features and gets the bias's score; a null id is in the learning
folds but never in the sample; repeated rows are scored row by row, and a document with several labels is
positive if one says so; extra columns are not read; an empty table gives none; a very long text
takes memory in proportion to its distinct words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinscore.llm.common import SmallestText, held_out, require, saved, slices

MAX_POSITIVE, MAX_UNLABELLED = 3000, 9000
PREFIX = 5
MIN_RATIO, MIN_DEVIATIONS = 3.0, 8.0
MAX_FEATURES = 1024
MEMBERS = 4
ROUNDS, RATE, LASSO = 300, 100.0, 3e-6
THRESHOLD = 0.7
_EDGES = ".,!?;:\"'()[]{}<>|#*$%&-_/\\«»“”„‘’…"


def word_features(token: str) -> list[int]:
    """Signed 64-bit hashes of a word and of its first letters; none for bare punctuation."""
    word = token.strip(_EDGES)
    if not word:
        return []
    out = [xxhash.xxh64_intdigest(word) - 2**63]
    if len(word) >= PREFIX:
        out.append(xxhash.xxh64_intdigest(word[:PREFIX] + "\0") - 2**63)
    return out


def text_features(text: str | None) -> list[int]:
    return sorted({f for w in set((text or "").lower().split()) for f in word_features(w)})


def nn_pu(p_rows: np.ndarray, u_rows: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk with sigmoid loss (full-batch descent with
    an L1 penalty; steps in proportion to a feature's frequency, so frequent features explain first)."""
    n = p_rows.shape[1]
    w = np.zeros(n + 1)
    w[n] = -1.0

    def loss(z):
        return 1 / (1 + np.exp(np.clip(z, -50, 50)))

    def slope(z):  # of the loss at z
        at = loss(z)
        return at * at - at

    def pull(rows, g):
        return np.append(rows.T @ g, g.sum()) / max(len(rows), 1)

    for _ in range(ROUNDS):
        zp, zu = p_rows @ w[:n] + w[n], u_rows @ w[:n] + w[n]
        clean = loss(-zu).mean() - prior * loss(-zp).mean()
        to_clean = -pull(u_rows, slope(-zu)) + prior * pull(p_rows, slope(-zp))
        grad = prior * pull(p_rows, slope(zp)) + to_clean if clean >= 0 else -to_clean
        w -= RATE * grad
        # every feature was chosen because it speaks for P; the penalty ends those that say nothing new
        w[:n] = np.maximum(w[:n] - RATE * LASSO, 0)
    return w[:n], float(w[n])


def calibrate(w: np.ndarray, p_rows: np.ndarray, u_rows: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias on a scale on which ``THRESHOLD`` is the cut with the least non-negative risk
    (errors counted, not smoothed), in the middle of all that have it; no feature gives 0.04."""
    at_p, at_u = np.sort(p_rows @ w), np.sort(u_rows @ w)
    cuts = np.unique(np.concatenate([at_p, at_u]))
    cuts = cuts[cuts > 0]
    if not len(cuts):
        return w, float(np.log(0.04 / 0.96))
    miss = np.searchsorted(at_p, cuts) / len(at_p)
    alarm = 1 - np.searchsorted(at_u, cuts) / max(len(at_u), 1)
    risk = prior * miss + np.maximum(0, alarm - prior * (1 - miss))
    least = cuts[risk <= risk.min() + 1e-12]
    cut = (least[0] + least[-1]) / 2
    scale = 4.0 / cut
    return scale * w, float(np.log(THRESHOLD / (1 - THRESHOLD)) - scale * cut)


def fit_member(features: list[np.ndarray], positive: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(feature hashes, weights, bias) of one classifier."""
    first = {}
    for i, f in enumerate(features):
        first.setdefault((bool(positive[i]), f.tobytes()), i)
    kept = sorted(first.values())
    features, positive = [features[i] for i in kept], positive[kept].astype(bool)
    n_pos, n_unl = int(positive.sum()), int((~positive).sum())
    flat = np.concatenate(features) if features else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(features)), [len(f) for f in features])
    names, of = np.unique(flat, return_inverse=True)
    in_p = np.bincount(of, positive[row], len(names))
    in_u = np.bincount(of, minlength=len(names)) - in_p
    expected = n_pos * (in_u + 1) / (n_unl + 1)
    excess = (in_p - expected) / np.sqrt(expected + 1)
    telling = (in_p >= MIN_RATIO * expected) & (excess >= min(MIN_DEVIATIONS, 3 + np.sqrt(n_pos) / 8))
    gain = np.where(telling, excess, 0)
    chosen = np.sort(np.argsort(-gain, kind="stable")[: min(MAX_FEATURES, int(telling.sum()))])
    place = np.full(len(names), -1)
    place[chosen] = np.arange(len(chosen))
    x = np.zeros((len(features), len(chosen)), np.float32)
    at = place[of]
    x[row[at >= 0], at[at >= 0]] = 1
    w, _ = nn_pu(x[positive], x[~positive], prior)
    w, b = calibrate(w, x[positive], x[~positive], prior)
    return names[chosen], w, b


def marked_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) per document of the learning folds; toxic is null without a label."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    ids = ids.where(~held_out(F.col("doc_id"))).distinct()
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return ids.join(marks, "doc_id", "left")


def sample_rows(marked: DataFrame) -> DataFrame:
    """(doc_id, positive): the bounded sample; a toxic document may be in P and in U."""
    order = F.xxhash64("doc_id", F.lit(2))
    p = marked.where("toxic = 1").orderBy(order, "doc_id").limit(MAX_POSITIVE)
    u = marked.orderBy(order, "doc_id").limit(MAX_UNLABELLED)
    return saved(p.select("doc_id", F.lit(1).alias("positive")).unionByName(u.select("doc_id", F.lit(0).alias("positive"))))


def toxic_share(marked: DataFrame) -> float:
    """The toxic share of the labelled learning rows."""
    return marked.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()[0] or 0.0


def learning_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return sample_rows(marked_rows(docs, labels))


def sample_features(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, positive, features): one row for each row of the sample, however often an id occurs."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")

    def features(batches):
        smallest = SmallestText()
        for batch in slices(batches):
            rows, hashes, found = [], [], []
            ids, marks = batch.column("doc_id").to_pylist(), batch.column("positive").to_pylist()
            for i, text in enumerate(batch.column("text").to_pylist()):
                own = smallest.passes((ids[i], marks[i]), text)
                if own is not None:
                    rows.append(i)
                    hashes.append(own)
                    found.append(text_features(text))
            kept = batch.select(["doc_id", "positive"]).take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(hashes, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                ["doc_id", "positive", "own", "features"],
            )

    rows = texts.mapInArrow(features, "doc_id long, positive int, own long, features array<long>")
    return rows.groupBy("doc_id", "positive").agg(F.min_by("features", "own").alias("features"))


def train(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> tuple[dict[int, float], float] | None:
    """The averaged weights by feature and the bias; None without positive rows."""
    marked = marked_rows(docs, labels)
    if prior is None:
        prior = min(max(toxic_share(marked), 1e-3), 0.999)
    rows = saved(sample_features(docs, sample_rows(marked)))
    if rows.where("positive = 1").isEmpty():
        return None
    part = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(MEMBERS)).cast("int")
    member = F.explode(F.sequence(F.lit(0), F.lit(MEMBERS - 1))).alias("member")
    copies = rows.select("*", member).where(part != F.col("member"))

    def fit(key, t):
        t = t.sort_by([("doc_id", "ascending"), ("positive", "ascending")])
        found = [np.asarray(x, np.int64) for x in t.column("features").to_pylist()]
        names, w, b = fit_member(found, t.column("positive").to_numpy(), prior)
        return pa.table({
            "names": pa.array([names.tolist()], pa.list_(pa.int64())),
            "weights": pa.array([w.tolist()], pa.list_(pa.float64())),
            "bias": pa.array([b], pa.float64()),
        })

    fitted = copies.groupBy("member").applyInArrow(fit, "names array<long>, weights array<double>, bias double").collect()
    total: dict[int, float] = {}
    for r in fitted:
        for f, w in zip(r.names, r.weights, strict=True):
            total[f] = total.get(f, 0.0) + w / len(fitted)
    return total, sum(r.bias for r in fitted) / len(fitted)


def toxicity(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs``."""
    require(docs, "doc_id", "text")
    require(labels, "doc_id", "toxic")
    model = train(docs, labels, prior)
    weights, bias = model if model else ({}, -np.inf)

    def score(batches):
        # word -> its features with a weight: most words have none; words are seen once per task
        known: dict[str, tuple[int, ...]] = {}
        for batch in slices(batches):
            out = []
            if len(known) > 300_000:
                known.clear()
            for text in batch.column("text").to_pylist():
                held: set[int] = set()
                for word in set((text or "").lower().split()):
                    hit = known.get(word)
                    if hit is None:
                        hit = known[word] = tuple(f for f in word_features(word) if f in weights)
                    if hit:
                        held.update(hit)
                z = bias + sum(weights[f] for f in sorted(held))
                out.append(1 / (1 + np.exp(-z)) if z > -700 else 0.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held"), pa.array(out, pa.float64())], ["doc_id", "held_out", "score"]
            )

    source = docs.select("doc_id", held_out(F.col("doc_id")).alias("held"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = source.mapInArrow(score, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
