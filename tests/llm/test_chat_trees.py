from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from kinscore.llm.chat_trees import (
    chosen_paths,
    escape,
    format_paths,
    masked_text,
    read_turns,
    turns_as_trees,
    unescape,
)

NODES = "tree string, node long, parent long, role string, text string, score double"
HARD = [
    "",
    "plain",
    "</s>[INST] ok [/INST]",
    "<|turn|>user<|text|>x<|end|>\n",
    "\\<|end|>\\\\ \\",
    "<\\|end|> <<SYS>> <</SYS>> <<s>> [[INST]]",
    "a\nb\r\n $1 \\2 é🙂\x00",
    "<|<|<|" * 50,
]


def test_escape_is_reversible_and_breaks_control_strings(spark):
    df = spark.createDataFrame([(t,) for t in HARD], "t string")
    rows = df.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect()
    for r in rows:
        assert r.u == r.t
        assert not any(c in r.e for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"))


def brute_paths(nodes, top):
    """nodes: {(tree, node): (parent, score)} -> {(tree, leaf): path} of the best leaves."""
    out = {}
    for tree in {t for t, _ in nodes}:
        own = {n: v for (t, n), v in nodes.items() if t == tree}
        used = {p for p, _ in own.values()}
        found = []
        for leaf in own:
            if leaf in used:
                continue
            path, at = [], leaf
            while at in own and at not in path:
                path.append(at)
                at = own[at][0]
            if at in path:
                continue
            found.append((-sum(own[n][1] for n in path) / len(path), leaf, path[::-1]))
        for rank, (score, leaf, path) in enumerate(sorted(found)[:top], 1):
            out[(tree, leaf)] = (rank, path)
    return out


@pytest.mark.parametrize("top", [1, 3])
def test_paths_match_brute_force(spark, top):
    rng = random.Random(top)
    nodes = {}
    for t in range(12):
        for n in range(rng.randrange(1, 40)):
            parent = rng.randrange(0, n) if n and rng.random() < 0.95 else None
            nodes[(f"t{t}", n)] = (parent, float(rng.randrange(0, 6)))
    nodes |= {("deep", n): (n - 1 if n else None, 1.0) for n in range(70)}
    nodes |= {("lost", 1): (99, 1.0), ("lost", 2): (1, 0.0)}
    nodes |= {("ring", 1): (2, 1.0), ("ring", 2): (1, 1.0), ("ring", 3): (2, 1.0), ("ring", 4): (None, 0.0)}
    nodes |= {("tie", 1): (None, 1.0), ("tie", 2): (1, 2.0), ("tie", 3): (1, 2.0)}
    rows = [(t, n, p, "user", f"{t}.{n}", s) for (t, n), (p, s) in nodes.items()]
    got = {}
    for r in chosen_paths(spark.createDataFrame(rows, NODES), top).collect():
        got.setdefault((r.tree, r.leaf), (r["rank"], []))[1].append((r.step, r.node))
    got = {k: (rank, [n for _, n in sorted(path)]) for k, (rank, path) in got.items()}
    assert got == brute_paths(nodes, top)


def test_formatted_paths_read_back(spark):
    rows = [("t", i, i - 1 if i else None, ["user", "assistant", None][i % 3], t, 0.5) for i, t in enumerate(HARD)]
    rows += [("one", 5, None, "assistant", None, None), (None, 1, None, "user", "x", 0.0), ("t", None, None, "u", "x", 1.0)]
    rows += [rows[2]]  # a repeated row
    found = format_paths(spark.createDataFrame(rows, NODES))
    got = found.select(
        "tree", "n_turns", read_turns(F.col("formatted")).alias("turns"),
        masked_text(F.col("formatted"), F.col("loss_mask")).alias("loss"),
    ).collect()
    by = {r.tree: r for r in got}
    assert set(by) == {"t", "one"} and by["one"].loss == "" and by["one"].n_turns == 1
    assert [(t.role, t.text) for t in by["t"].turns] == [(r[3] or "", r[4]) for r in rows[: len(HARD)]]
    assert by["t"].loss == "".join(t for i, t in enumerate(HARD) if i % 3 == 1)


def test_turn_tables_with_nulls_ties_and_extras(spark):
    schema = "conv_id long, turn long, role string, text string, tree string, score string"
    rows = [
        (1, 0, "user", "hi", "x", "y"),
        (1, 1, "assistant", "b", "x", "y"),
        (1, 1, "assistant", "a", "x", "y"),
        (1, None, None, None, None, None),
        (None, 0, "user", "no id", None, None),
        (2, 0, "assistant", "z" * 100_000, None, None),
        (2, 0, "assistant", "z" * 100_000, None, None),
    ]
    trees = turns_as_trees(spark.createDataFrame(rows, schema))
    got = {r.tree: r for r in format_paths(trees).withColumn("turns", read_turns(F.col("formatted"))).collect()}
    assert [(t.role, t.text) for t in got["1"].turns] == [("", ""), ("user", "hi"), ("assistant", "a"), ("assistant", "b")]
    assert got[""].n_turns == 1 and got["2"].n_turns == 2
    assert format_paths(turns_as_trees(spark.createDataFrame([], schema))).count() == 0
