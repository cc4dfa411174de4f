"""Conversation structure repair by the auction shortest-path algorithm.

A conversation is repaired by the cheapest edits of its rows, in order of turns, after which its roles
read as an optional system row and then user and assistant by turns, the assistant last (or as nothing
at all). Edits: K keep (0), R set the role that fits, user or assistant (1), D delete (2; blank and
repeated rows must go), I insert an empty user or assistant row (5); a row whose text breaks off costs 5
more unless it is deleted. Of equally cheap edits the sequence of initials that is least in ASCII wins.

The edits are arcs of an integer-cost lattice with a node for every (row, state); the states are: nothing yet,
system, user, assistant. On this lattice the auction algorithm runs: a path starts at its origin; at
the end node i of the path, with best arc (i, j) by cost + price(j), the price of i rises to
that value and the path *contracts* by one arc, or, where the price has it already, the path
*extends* to j, until it reaches the sink. All along, price(i) <= cost(i, j) + price(j) for every arc: the
prices are dual feasible, and once the origin's price is its distance, every shortest path runs over
*tight* arcs (equality) only. The tight arcs that lead to the sink are traced by the least initial first.

The lattice is worked off from its end in segments of ``SEGMENT`` rows. The auction runs from all four entry nodes of
a segment, whose prices then are exact distances, so they serve the segment before as its sinks, and
the prices of a segment start at the least of them. Prices climb by a segment's costs instead of the
conversation's, and the work grows in proportion to the rows. Conversations with the same sequence of row codes share one result within a worker.

One exchange by conversation with a sort; a conversation is read as a stream. A task keeps the texts of
``HELD`` rows at most; a longer conversation passes its rows on, numbered, keeps a code and a digest of each,
and leaves its edits in pieces of ``HELD`` rows; rows and pieces meet in a second exchange by
(conversation, piece). Its texts then gather nowhere but in the one row of the result that holds them.

Cases: a null conversation id is a conversation of its own; null roles and texts read as one space;
null turns come first; rows with one turn are taken in order of role, then text; a conversation
without rows has zeros and no edits; very long texts take memory in proportion to the
``HELD`` rows at hand; repeated rows are repeats and must go; extra columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kinscore.llm.common import named, require, saved

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: rows of a lattice segment
SEGMENT = 16
#: rows of a conversation whose texts a task holds
HELD = 4096

BEGIN, SYSTEM, USER, ASSISTANT = range(4)
#: the state that a role's initial leads to, by the state before
_NEXT = {("s", BEGIN): SYSTEM, ("u", BEGIN): USER, ("u", SYSTEM): USER, ("a", USER): ASSISTANT, ("u", ASSISTANT): USER}
#: the state that rerole and insert lead to
_FILL = (USER, USER, ASSISTANT, USER)
_ROLE = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
_INK = re.compile("[^\x20\x09-\x0d]")
_LAST = re.compile("[^\x20\x09-\x0d](?=[\x20\x09-\x0d]*\\Z)")
#: row codes: s, u, a, o for other roles, capital where the text breaks off; x where the row must go
CODES = "suaoSUAOx"


def code_of(role: str, text: str) -> str:
    """The code of a row that is neither blank nor repeated."""
    own = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return own.upper() if truncated(text) else own


def blank(text: str) -> bool:
    return _INK.search(text) is None


def truncated(text: str) -> bool:
    last = _LAST.search(text)
    return last is not None and last[0] not in ".!?"


def _arcs() -> dict[str, list[list[tuple[str, int, int, int]]]]:
    """By row code and state: (initial, cost, rows ahead, state), in order of the initials."""
    out = {}
    for code in CODES:
        own = []
        for q in range(4):
            arcs = [("D", DELETE, 1, q), ("I", INSERT, 0, _FILL[q])]
            if code != "x":
                extra = TRUNCATED if code.isupper() else 0
                fit = _NEXT.get((code.lower(), q))
                if fit is not None:
                    arcs.append(("K", KEEP + extra, 1, fit))
                if fit != _FILL[q]:  # else dearer than keeping the row
                    arcs.append(("R", REROLE + extra, 1, _FILL[q]))
            own.append(arcs)
        out[code] = own
    return out


ARCS = _arcs()


class Lattice:
    """Node 4 * row + state; behind the last row only insertions, and the sink from a whole dialogue."""

    def __init__(self, codes: str):
        self.codes, self.n = codes, len(codes)
        self.sink = 4 * (self.n + 1)

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        i, q = divmod(node, 4)
        if i < self.n:
            return [(e, c, node + 4 * ahead + to - q) for e, c, ahead, to in ARCS[self.codes[i]][q]]
        end = [("", 0, self.sink)] if q in (BEGIN, ASSISTANT) else []
        return [*end, ("I", INSERT, node + _FILL[q] - q)]

    def prices(self, segment: int = SEGMENT) -> list[int]:
        """Dual prices: exact distances at the entry rows of all segments, feasible everywhere."""
        p = [0] * (self.sink + 1)
        stop = self.sink
        for low in range((self.n // segment) * segment, -1, -segment):
            first, last = 4 * low, stop
            floor = 0 if stop == self.sink else min(p[stop : stop + 4])
            for node in range(first, last):
                p[node] = floor
            for origin in range(first, first + (4 if low else 1)):
                self._auction(origin, last, p)
            stop = first
        return p

    def _auction(self, origin: int, stop: int, p: list[int]) -> None:
        """Raise the prices until a path of tight arcs leads from the origin to a node from ``stop`` on."""
        path = [origin]
        while path[-1] < stop:
            node = path[-1]
            best, to = min((cost + p[j], j) for _, cost, j in self.arcs(node))
            if p[node] < best:
                p[node] = best  # contract, but never the origin
                if node != origin:
                    path.pop()
            else:
                path.append(to)

    def trace(self, p: list[int]) -> str:
        """The ASCII-least initials along tight arcs that lead from the first node to the sink."""
        dead: set[int] = set()
        path, initials = [0], []
        options = [self._tight(0, p)]
        while path[-1] != self.sink:
            for initial, to in options[-1]:
                if to not in dead:
                    path.append(to)
                    initials.append(initial)
                    options.append(self._tight(to, p) if to != self.sink else iter(()))
                    break
            else:
                dead.add(path.pop())
                options.pop()
                initials.pop()
        return "".join(initials)

    def _tight(self, node: int, p: list[int]):
        return iter(sorted((e, j) for e, c, j in self.arcs(node) if p[node] == c + p[j]))


def solve(codes: str, segment: int = SEGMENT) -> tuple[int, str]:
    """(cost, initials of the edits)."""
    lattice = Lattice(codes)
    p = lattice.prices(segment)
    return p[0], lattice.trace(p)


def edited(audit: str, roles) -> list[tuple[str, str | None, str | None]]:
    """(edit, role, role it had) of every edit, given the rows' roles in order."""
    out, state, rows = [], BEGIN, iter(roles)
    for e in audit:
        had = None if e == "I" else next(rows)
        if e == "D":
            out.append((e, None, had))
            continue
        state = _NEXT[(had[:1], state)] if e == "K" else _FILL[state]
        out.append((e, had if e == "K" else _ROLE[state], had))
    return out


def damaged(rows: DataFrame, key: Column, text: str = "text", role: str = "role") -> DataFrame:
    """The table with faults put in by the remainder ``key``: 0 drops the row (``gone``), 1 empties its text, 2
    removes its sentence ends, 3 repeats it, 4 makes it a user's."""
    hurt = (
        F.when(key == 0, F.lit(None).cast("string"))
        .when(key == 1, F.lit(""))
        .when(key == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(F.col(text))
    )
    return rows.withColumns({
        "gone": key == 0,
        text: hurt,
        role: F.when(key == 4, F.lit("user")).otherwise(F.col(role)),
        "copy": F.explode(F.when(key == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    })


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def _plain(rows: DataFrame, conv_id: str, turn: str, role: str, text: str, gone: str | None) -> DataFrame:
    spaced = {"role": F.coalesce(named(role).cast("string"), F.lit(" ")), "text": F.coalesce(named(text).cast("string"), F.lit(" "))}
    return rows.select(
        named(conv_id).alias("conv_id"), named(turn).cast("long").alias("turn"), *(c.alias(n) for n, c in spaced.items()),
        (named(gone) if gone else F.lit(False)).alias("gone"),
    )


class _Conversation:
    """What a task keeps of the conversation it reads."""

    def __init__(self, conv):
        self.conv, self.codes, self.roles, self.texts = conv, [], [], []
        self.seen: set[bytes] = set()
        self.low = self.high = self.at = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before = None

    def add(self, turn, role: str, text: str) -> None:
        if turn is not None:
            self.turns += turn != self.at
            self.low, self.high, self.at = turn if self.low is None else self.low, turn, turn
        if self.before is not None:
            self.illegal += self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]
        digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        repeat = digest in self.seen
        self.seen.add(digest)
        if blank(text):
            self.blank += 1
            self.codes.append("x")
        elif repeat:
            self.duplicate += 1
            self.codes.append("x")
        else:
            code = code_of(role, text)
            self.truncated += code.isupper()
            self.codes.append(code)

    def counts(self, cost: int) -> list[int]:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return [gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost]


def repair(
    rows: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    gone: str | None = None,
    held: int = HELD,
    segment: int = SEGMENT,
) -> DataFrame:
    """One row per conversation: its id, the counts (``COUNTS``), ``audit`` (the initials of the edits) and
    ``repaired``, the rows after them as (role, text). Rows that the boolean column named by ``gone`` marks
    only name their conversation."""
    require(rows, conv_id, turn, role, text)
    plain = _plain(rows, conv_id, turn, role, text, gone)
    kind = plain.schema["conv_id"].dataType
    schema = T.StructType(
        [T.StructField("conv_id", kind)]
        + [T.StructField(c, T.LongType()) for c in COUNTS]
        + [
            T.StructField("audit", T.StringType()),
            T.StructField("repaired", T.ArrayType(_TURN)),
            T.StructField("piece", T.LongType()),
            T.StructField("part", T.StringType()),
            T.StructField("row", T.StructType([T.StructField("at", T.LongType()), *_TURN.fields])),
        ]
    )

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        shared = lru_cache(maxsize=1 << 16)(lambda codes: solve(codes, segment))
        done: list[tuple] = []
        size = 0
        own = None

        def flush():
            nonlocal size
            cols = [pa.array(c, f.type) for c, f in zip(zip(*done, strict=True), out, strict=True)]
            done.clear()
            size = 0
            return pa.RecordBatch.from_arrays(cols, schema=out)

        def finish(c: _Conversation):
            codes = "".join(c.codes)
            cost, audit = shared(codes) if len(codes) <= held else solve(codes, segment)
            repaired = None
            if len(codes) <= held:
                texts = iter(c.texts)
                repaired = []
                for e, new, _ in edited(audit, c.roles):
                    t = "" if e == "I" else next(texts)
                    if e != "D":
                        repaired.append({"role": new, "text": t})
            done.append((c.conv, *c.counts(cost), audit, repaired, None, None, None))
            if len(codes) > held:
                done.extend((c.conv, *[None] * 8, i, part, None) for i, part in enumerate(pieces_of(audit, codes, held)))

        for batch in batches:
            for conv, at, r, t, gone in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                if own is None or conv != own.conv:
                    if own is not None:
                        finish(own)
                    own = _Conversation(conv)
                if gone:
                    continue
                own.add(at, r, t)
                size += len(t) + 64
                n = len(own.codes)
                if n <= held:
                    own.roles.append(r)
                    own.texts.append(t)
                else:  # too long to be held: the rows go on, and meet their edits later
                    early = zip(own.roles, own.texts, strict=True) if n == held + 1 else ()
                    for i, (r0, t0) in enumerate(early):
                        done.append((conv, *[None] * 8, i // held, None, {"at": i, "role": r0, "text": t0}))
                    own.roles, own.texts = [], []
                    done.append((conv, *[None] * 8, (n - 1) // held, None, {"at": n - 1, "role": r, "text": t}))
                if size > 4 << 20 and done:
                    yield flush()
        if own is not None:
            finish(own)
        if done:
            yield flush()

    placed = plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    found = saved(placed.mapInArrow(run, schema))
    short = found.where("piece is null").select("conv_id", *COUNTS, "audit", "repaired")
    if not found.where("piece is not null").limit(1).count():
        return short
    pieces = found.where("part is not null").select("conv_id", "piece", "part")
    texts = found.where("row is not null").select("conv_id", "piece", "row")
    same = F.col("p.conv_id").eqNullSafe(F.col("t.conv_id")) & (F.col("p.piece") == F.col("t.piece"))
    by_piece = texts.groupBy("conv_id", "piece").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    whole = pieces.alias("p").join(by_piece.alias("t"), same).select("p.conv_id", "p.piece", "part", "rows")
    joined = whole.mapInArrow(
        _edit_piece, T.StructType([T.StructField("conv_id", kind), T.StructField("piece", T.LongType()), T.StructField("turns", T.ArrayType(_TURN))])
    )
    long = joined.groupBy("conv_id").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("piece", "turns"))), lambda x: x["turns"])).alias("turns"))
    same = F.col("s.conv_id").eqNullSafe(F.col("l.conv_id"))
    return short.alias("s").join(long.alias("l"), same, "left").select(
        "s.conv_id", *COUNTS, "audit", F.coalesce("repaired", "turns").alias("repaired")
    )


def pieces_of(audit: str, codes: str, held: int) -> list[str]:
    """The edits in pieces of ``held`` rows, each led by the number of its first state; insertions stand
    with the row before them (those before the first row with the first piece)."""
    out, state, rows, start, first = [], BEGIN, 0, 0, BEGIN
    for i, e in enumerate(audit):
        if e != "I":
            if rows and rows % held == 0:
                out.append(f"{first}{audit[start:i]}")
                start, first = i, state
            if e == "K":
                state = _NEXT[(codes[rows].lower(), state)]
            elif e == "R":
                state = _FILL[state]
            rows += 1
        else:
            state = _FILL[state]
    out.append(f"{first}{audit[start:]}")
    return out


def _edit_piece(batches):
    from pyspark.sql.pandas.types import to_arrow_type

    kind = to_arrow_type(T.ArrayType(_TURN))
    for batch in batches:
        found = []
        for part, rows in zip(batch.column("part").to_pylist(), batch.column("rows").to_pylist(), strict=True):
            state, it, turns = int(part[0]), iter(rows), []
            for e in part[1:]:
                row = {"role": "", "text": ""} if e == "I" else next(it)
                if e == "D":
                    continue
                state = _NEXT[(row["role"][:1], state)] if e == "K" else _FILL[state]
                turns.append({"role": row["role"] if e == "K" else _ROLE[state], "text": row["text"]})
            found.append(turns)
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), batch.column("piece"), pa.array(found, kind)], ["conv_id", "piece", "turns"]
        )
