from __future__ import annotations

import re

import pytest

from kinscore.llm.quality_rules import accepted, judge, quality_rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed from the definitions."""
    text = text or ""
    words = WORD.findall(text)
    lines, dup = [], 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.append(line)
    wins = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    hit = {j for i, w in enumerate(wins) if wins.count(w) > 1 for j in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


PROSE = " ".join(f"wörd{i}" for i in range(70)) + "."
TEXTS = [
    None,
    "",
    " \n\t ",
    "one two",
    PROSE,
    PROSE + "\n" + PROSE,
    "a b c a b c a b\na b c\n\na b c",
    "x y z w \x0b q\x0cr\r\ns",
    PROSE + "\nHome | About | Contact | Login\nAll rights reserved.",
    " ".join(f"w{i}!!" for i in range(80)),
    "\n".join(["# $% & <tag> *"] * 3) + PROSE,
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_fields_match_brute_force(text):
    assert judge(text)[:6] == brute(text)


def test_verdict_and_cleaning():
    page = PROSE + "\nHome | About | Contact | Login\nAll rights reserved.\n" + PROSE.replace("wörd", "other")
    got = judge(page)
    assert got[6] == 2 and got[8] is True
    assert got[9] == PROSE + "\n" + PROSE.replace("wörd", "other")
    shouting = judge(" ".join(f"w{i}!!" for i in range(80)))
    assert shouting[5] is False and shouting[8] is False  # all of its text is lost


def test_frame_keeps_extra_and_clashing_columns(docs_of):
    rows = [(i, t, "en", "s", 1, f"k{i}") for i, t in enumerate([*TEXTS, PROSE])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    docs = docs_of(rows, schema)
    got = quality_rules(docs).collect()
    assert [r.n_words for r in got] == [brute(t)[0] for t in [*TEXTS, PROSE]]
    out = accepted(docs)
    assert out.schema == docs.schema
    kept = {r.doc_id: r for r in out.collect()}
    assert kept[4].kept == "k4" and kept[4].text == PROSE and kept[8].n_chars == len(PROSE)
    assert 0 not in kept and 9 not in kept
    assert accepted(docs.limit(0)).count() == 0


def test_very_long_text(docs_of):
    long = " ".join(f"word{i}" for i in range(300_000))
    assert quality_rules(docs_of([(1, long), (2, long)])).where("kept").count() == 2
