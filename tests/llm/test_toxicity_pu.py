from __future__ import annotations

import random

import numpy as np
import pytest

from kinscore.llm.common import crc_fold
from kinscore.llm import toxicity_pu
from kinscore.llm.toxicity_pu import calibrate, learning_rows, marked_rows, nn_pu, sample_features, text_features, toxic_share, toxicity


def test_risk_finds_positives_hidden_in_the_unlabelled():
    """All labelled rows are positive; a third of the unlabelled ones are, too."""
    rng = np.random.default_rng(1)

    def rows(n, toxic):
        x = (rng.random((n, 6)) < 0.1).astype(float)
        x[:, 0] = rng.random(n) < (0.9 if toxic else 0.02)
        return x

    p, u = rows(300, True), np.concatenate([rows(300, True), rows(600, False)])
    w, _ = nn_pu(p, u, 1 / 3)
    assert w[0] > 10 * w[1:].max()
    w, b = calibrate(w, p, u, 1 / 3)
    scores = 1 / (1 + np.exp(-(u @ w + b)))
    assert (scores[:300] >= 0.7).mean() > 0.85 and (scores[300:] >= 0.7).mean() < 0.05


def test_features():
    assert text_features(None) == text_features("") == text_features(" ... !! ") == []
    assert text_features("Moron moron, MORON!") == text_features("moron")
    assert len(text_features("moron")) == 2 and len(text_features("oaf")) == 1


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    vocab = [f"w{i}ord" for i in range(800)]
    bad = ["vilefool", "nastyoaf", "grimlout"]
    rows, labels = [], []
    for i in range(1500):
        words = [rng.choice(vocab) for _ in range(rng.randrange(20, 120))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(rng.randrange(2, 6)):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words)))
        if rng.random() < 0.5:
            labels.append((i, rng.randrange(2), int(toxic)))
    truth = {i: any(b in t for b in bad) for i, t in rows}
    rows += [(2000, None), (2001, ""), (2002, "vilefool " * 3), (2003, "x " * 40_000), (None, "nastyoaf grimlout vilefool")]
    rows += [rows[0], rows[1]]
    labels += [labels[0], (9999, 1, 1), (None, 1, 1), (2001, None, None)]
    return rows, labels, truth


def test_held_out_accuracy(spark, docs_of, corpus):
    rows, labels, truth = corpus
    docs = docs_of([(*r, None, None, None, 0.5) for r in rows],
                   "doc_id long, text string, lang string, source string, n_chars long, score double")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = toxicity(docs, marks).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "held_out", "score", "predicted"}
    by = {r.doc_id: r for r in got}
    for i in truth:
        assert by[i].held_out == (crc_fold(i) == 1) and 0 <= by[i].score <= 1
        assert by[i].predicted == (by[i].score >= 0.7)
    held = [i for i in truth if by[i].held_out]
    assert np.mean([by[i].predicted == truth[i] for i in held]) > 0.97
    assert by[2002].predicted == 1 and by[None].predicted == 1
    assert by[2000].predicted == by[2001].predicted == by[2003].predicted == 0 and by[2000].score == by[2001].score
    again = {r.doc_id: r.score for r in toxicity(docs.repartition(3), marks).collect()}
    assert all(np.isclose(again[i], by[i].score) for i in truth)
    ids = [r.doc_id for r in learning_rows(docs, marks).collect()]
    assert ids and all(crc_fold(i) != 1 for i in ids)


@pytest.mark.parametrize("labelled,enough", [(1.0, 10**4), (0.6, 10**4), (0.6, 10)])
def test_unlabelled_sample_fits_the_prior(spark, docs_of, monkeypatch, labelled, enough):
    """U is learning rows whatever their label, toxic ones included, at every size."""
    monkeypatch.setattr(toxicity_pu, "MAX_UNLABELLED", enough)
    rng = random.Random(3)
    known = {i: int(i % 4 == 0) for i in range(600) if rng.random() < labelled}
    docs, marks = docs_of([(i, "a") for i in range(600)]), spark.createDataFrame(list(known.items()), "doc_id long, toxic int")
    rows = learning_rows(docs, marks).collect()
    learn = [i for i in range(600) if crc_fold(i) != 1]
    p, u = sorted(r.doc_id for r in rows if r.positive), sorted(r.doc_id for r in rows if not r.positive)
    assert p == [i for i in learn if known.get(i) == 1]
    if enough == 10:
        bare = learning_rows(docs, marks.where("false")).collect()
        assert len(u) == 10 and set(u) <= set(learn) and u == sorted(r.doc_id for r in bare)
    else:
        assert u == learn
    share = toxic_share(marked_rows(docs, marks))
    assert share == pytest.approx(np.mean([known[i] for i in learn if i in known]))


def test_without_labels_or_rows(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity(docs_of([(1, "a b"), (2, None)]), none).collect()] == [0.0, 0.0]
    assert toxicity(docs_of([]), none).count() == 0


def test_a_repeated_id_is_one_learning_row(spark):
    """20,000 rows under one toxic id, of two texts: one row in P and one in U, with the same text at any layout."""
    from pyspark.sql import functions as F

    hot = next(i for i in range(9) if crc_fold(i) != 1)
    docs = spark.range(20_000).select(F.lit(hot).cast("long").alias("doc_id"), F.concat(F.lit("vile "), F.col("id") % 2).alias("text"))
    marks = spark.createDataFrame([(hot, 1)], "doc_id long, toxic int")
    one, two = (sample_features(docs.repartition(n), learning_rows(docs, marks)).collect() for n in (6, 3))
    assert sorted(r.positive for r in one) == [0, 1] and len({tuple(r.features) for r in one + two}) == 1


def test_risk_minimum_against_a_plain_optimiser():
    """Without a step below zero the risk is smooth: many plain gradient steps find no lower value."""
    rng = np.random.default_rng(5)
    p = (rng.random((200, 4)) < [0.9, 0.2, 0.2, 0.1]).astype(float)
    u = np.concatenate([(rng.random((100, 4)) < [0.9, 0.2, 0.2, 0.1]), (rng.random((300, 4)) < [0.05, 0.2, 0.2, 0.1])]).astype(float)
    prior = 0.25

    def risk(v):
        loss = lambda z: 1 / (1 + np.exp(z))
        gp, gu = p @ v[:-1] + v[-1], u @ v[:-1] + v[-1]
        return prior * loss(gp).mean() + max(0.0, loss(-gu).mean() - prior * loss(-gp).mean())

    w, b = nn_pu(p, u, prior)
    v = np.r_[np.asarray(w, float), b]
    best = np.zeros(5)
    for _ in range(3000):
        step = np.array([(risk(best + 1e-5 * e) - risk(best - 1e-5 * e)) / 2e-5 for e in np.eye(5)])
        best -= 2.0 * step
    assert risk(v) <= risk(best) + 0.01 and risk(v) < risk(np.zeros(5)) - 0.05
