from __future__ import annotations

import random

import numpy as np
import pytest

from kinscore.llm.common import crc_fold
from kinscore.llm.language_id import family, features, identify, svm

SYLLABLES = {
    "en": "the ing wh th ly ed sh ou ea",
    "de": "sch ung der ein ich ß ä keit ver",
    "nl": "ij het een aa oo van ge schap uu",
    "fr": "eau que les é ou aux tion è re",
    "es": "ción ado ñ los que rr mente í ez",
    "xx": "zu qa vx kw jj",
}


def text_of(lang, rng, n):
    parts = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    out = []
    for i in range(900):
        lang = rng.choice([*SYLLABLES, "en", "en"])
        out.append((i, text_of(lang, rng, rng.randrange(8, 80)), lang))
    extra = [(2000, None, "en"), (2001, "", "de"), (2002, "123 !? \n 4.5", "fr"), (None, out[0][1], out[0][2])]
    extra += [(2003, text_of("es", rng, 30_000), None), out[1], out[1], (2004, "日本", None)]
    return out + extra


def test_families():
    assert family("en") == family("DE") == family("de-AT") != family("fr") == family("es")
    assert family("xx") == "xx"


def test_machine_separates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 5))
    y = np.where(x[:, 0] - 2 * x[:, 3] + 0.3 > 0, 1.0, -1.0)
    w = svm(x, y)
    assert (np.sign(np.c_[x, np.ones(300)] @ w) == y).mean() > 0.97


def test_features_are_unit_and_ignore_case_and_digits():
    assert np.isclose(np.linalg.norm(features("Öl und Brot")), 1, atol=1e-5)
    assert np.array_equal(features("Brot 123, UND"), features("brot und"))


def test_held_out_accuracy(docs_of, rows):
    docs = docs_of([(i, t, lang, "s", 1, "x") for i, t, lang in rows],
                   "doc_id long, text string, lang string, source string, n_chars long, lang_pred string")
    got = identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    truth = {i: lang for i, _, lang in rows[:900]}
    held = [i for i in truth if by[i].held_out]
    assert all(by[i].held_out == (crc_fold(i) == 1) and 0 < by[i].score <= 1 for i in truth)
    assert np.mean([by[i].lang_pred == truth[i] for i in held]) > 0.97
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (2000, 2001, 2002))
    assert by[2003].lang_pred == "es" and by[2004].lang_pred in SYLLABLES
    again = {r.doc_id: r.lang_pred for r in identify(docs.repartition(3)).collect()}
    assert all(again[i] == by[i].lang_pred for i in truth)


def test_little_to_learn_from(docs_of):
    ids = [i for i in range(20) if crc_fold(i) != 1]
    one = identify(docs_of([(ids[0], "hello there", "en"), (ids[1], "guten tag", None)])).collect()
    assert {r.lang_pred for r in one} == {"en"}
    none = identify(docs_of([(ids[0], "hello", None), (ids[1], None, "en")])).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert identify(docs_of([])).count() == 0


def test_a_repeated_id_is_one_learning_row(spark):
    """20,000 rows under one id, of two texts: the sample holds the id once, with the same text at any layout."""
    from pyspark.sql import functions as F

    from kinscore.llm.language_id import sample_texts

    hot = next(i for i in range(9) if crc_fold(i) != 1)
    docs = spark.range(20_000).select(
        F.lit(hot).cast("long").alias("doc_id"), F.concat(F.lit("the wing "), F.col("id") % 2).alias("text"), F.lit("en").alias("lang")
    )
    one, two = sample_texts(docs.repartition(6)).collect(), sample_texts(docs.repartition(3)).collect()
    assert len(one) == 1 and one[0].text == two[0].text
