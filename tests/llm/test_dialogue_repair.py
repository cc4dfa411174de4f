from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from kinscore.llm.dialogue_repair import CODES, Lattice, damaged, edited, repair, solve
from kinscore.llm.queries import op13_dialogue_repair

KIND = "conv_id long, turn long, role string, text string"
INK = re.compile("[^\x20\x09-\x0d]")


def cheapest(rows):
    """(cost, audit) by dynamic programming over prefixes; rows: (role initial, must go, truncated)."""
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
    best = {"": (0, "")}

    def put(to, state, cost, audit):
        to[state] = min(to.get(state, (cost, audit)), (cost, audit))

    def filled(now):
        for _ in range(3):
            for s, (c, a) in list(now.items()):
                put(now, "a" if s == "u" else "u", c + 5, a + "I")
        return now

    for initial, must, trunc in rows:
        to = {}
        for s, (c, a) in filled(best).items():
            put(to, s, c + 2, a + "D")
            if not must:
                if (s, initial) in after:
                    put(to, after[s, initial], c + 5 * trunc, a + "K")
                put(to, "a" if s == "u" else "u", c + 1 + 5 * trunc, a + "R")
        best = to
    return min(v for s, v in filled(best).items() if s in ("", "a"))


def by_codes(codes):
    return [("?" if c in "xoO" else c.lower(), c == "x", c.isupper()) for c in codes]


def brute(rows):
    """All columns but the digest, and the repaired rows, from the definitions; rows: (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [t for t, *_ in rows if t is not None]
    n = {"blank": 0, "duplicate": 0, "truncated": 0}
    flags, seen = [], set()
    for _, role, text in rows:
        ink = INK.findall(text)
        must = trunc = False
        if not ink:
            n["blank"] += 1
            must = True
        elif (role, text) in seen:
            n["duplicate"] += 1
            must = True
        elif ink[-1] not in ".!?":
            n["truncated"] += 1
            trunc = True
        seen.add((role, text))
        flags.append((role[:1], must, trunc))
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:], strict=False)]
    cost, audit = cheapest(flags)
    out, state, it = [], "", iter(rows)
    for e in audit:
        row = None if e == "I" else next(it)
        if e == "D":
            continue
        if e == "K":
            state = row[1][:1]
            out.append((row[1], row[2]))
        else:
            state = "a" if state == "u" else "u"
            out.append(({"a": "assistant", "u": "user"}[state], "" if e == "I" else row[2]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, n["blank"], n["duplicate"], n["truncated"], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit), out


def test_auction_finds_the_cheapest_least_edits():
    r = random.Random(3)
    every = ["".join(r.choices(CODES, k=r.randrange(0, 9))) for _ in range(1500)] + list(CODES) + ["", "uaua", "suaua"]
    for codes in every:
        want = cheapest(by_codes(codes))
        assert solve(codes) == want, codes
        assert solve(codes, segment=2) == want, codes


@pytest.mark.parametrize("n", [16, 17, 33, 300])
def test_segments_of_longer_conversations(n):
    r = random.Random(n)
    for _ in range(8):
        codes = "".join(r.choices(CODES, k=n))
        assert solve(codes) == cheapest(by_codes(codes))


def test_prices_are_dual_feasible_and_tight_on_the_path():
    r = random.Random(9)
    for _ in range(200):
        lattice = Lattice("".join(r.choices(CODES, k=r.randrange(1, 40))))
        p = lattice.prices()
        for node in range(lattice.sink):
            if node % 4 in range(4):
                assert all(p[node] <= c + p[j] for _, c, j in lattice.arcs(node))
        assert p[lattice.sink] == 0


def test_work_grows_with_the_rows():
    """The auction's steps per row stay the same for a conversation ten times as long."""
    steps = []
    for n in (400, 4000):
        lattice, count = Lattice("".join(random.Random(1).choices(CODES, k=n))), 0
        plain = lattice.arcs

        def counted(node, plain=plain):
            nonlocal count
            count += 1
            return plain(node)

        lattice.arcs = counted
        lattice.prices()
        steps.append(count / n)
    assert steps[1] < 1.3 * steps[0]


def conversations():
    r = random.Random(5)
    texts = ["Yes.", "Yes.", "no", "What?", "  ", "", "ok!\n", "a b c", None, " ", "ends. )"]
    roles = ["user", "assistant", "system", "tool", None, "", "ux", "User"]
    rows = []
    for conv in [*range(40), None]:
        for _ in range(r.randrange(0, 14)):
            rows.append((conv, r.choice([None, *range(9)]), r.choices(roles, [6, 6, 2, 1, 1, 1, 1, 1])[0], r.choice(texts)))
    return rows


@pytest.mark.parametrize("held", [4096, 5])
def test_brute_force(spark, held):
    rows = conversations()
    df = spark.createDataFrame([(*r, "x") for r in rows], KIND + ", `meta.k` string").repartition(3)
    found = {r.conv_id: r for r in repair(df, held=held).collect()}
    assert set(found) == {r[0] for r in rows}
    for conv, r in found.items():
        want, turns = brute([x[1:] for x in rows if x[0] == conv])
        assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == want
        assert [(t.role, t.text) for t in r.repaired] == turns


def test_long_conversation_in_pieces(spark):
    r = random.Random(2)
    rows = [(1, i, r.choice(["user", "assistant", "system"]), f"text {i}{r.choice(['.', '', '!'])}") for i in range(700)]
    rows += [(2, 0, "user", "Hello."), (2, 1, "assistant", "Hi.")]
    found = {x.conv_id: x for x in repair(spark.createDataFrame(rows, KIND), held=64).collect()}
    want, turns = brute([x[1:] for x in rows if x[0] == 1])
    assert found[1].audit == want[-1] and [(t.role, t.text) for t in found[1].repaired] == turns
    assert found[2].audit == "KK"


def test_damage(spark):
    df = spark.createDataFrame([(1, i, "assistant", "A. b! c?") for i in range(6)], KIND)
    hurt = damaged(df, F.col("turn")).orderBy("turn", "copy").collect()
    assert [(r.turn, r.role, r.text, r.gone) for r in hurt] == [
        (0, "assistant", None, True), (1, "assistant", "", False), (2, "assistant", "A b c", False), (3, "assistant", "A. b! c?", False),
        (3, "assistant", "A. b! c?", False), (4, "user", "A. b! c?", False), (5, "assistant", "A. b! c?", False),
    ]


def test_gone_and_empty(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], KIND).withColumn("gone", F.lit(True))
    r = repair(df, gone="gone").first()
    assert (r.conv_id, r.gaps, r.cost, r.audit, r.repaired) == (1, 0, 0, "", [])
    assert repair(df).first().audit == "D"  # an extra column of that name means nothing
    assert repair(df.limit(0)).count() == 0
    assert edited("KR", ["user", "user"]) == [("K", "user", "user"), ("R", "assistant", "user")]


def test_query_names_every_conversation(spark, tmp_path):
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for c in range(30) for t in range(4)] + [(77, None, None, None), (None, 3, "user", "x.")]
    spark.createDataFrame(rows, KIND).write.parquet(f"{tmp_path}/conversations.parquet")
    assert {r.conv_id for r in op13_dialogue_repair(spark, str(tmp_path)).collect()} == {*range(30), 77, None}
