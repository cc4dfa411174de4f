"""Language identification by hierarchical discrimination.

A first classifier names the family of a text; inside the family, one-versus-one linear support
vector machines vote between its languages, so closely related languages are told apart by
machines that have seen nothing else. The languages are those of the learning rows; families are a table of codes
(:data:`FAMILIES`), a code outside it being a family of its own.

Features are counts of hashed byte n-grams of the lower-cased letters (1 to 4 bytes, words set off by blanks), scaled
to unit length after a square root. Machines are trained in numpy on a bounded sample of whole texts
(``MAX_ROWS`` ids of each language with the smallest id hash, one row each: of an id's texts the one with the
smallest hash; as many of each family for the first classifier), by dual coordinate descent on the squared hinge loss. The first
classifier and every family are fitted in tasks of their own. Prediction reads whole texts: one map over the documents, no exchange.

The score of a prediction is the product of the family's share and the language's share, each a
softmax of votes and margins.

Cases: a null text or one without a letter is ``und`` with score 0; without learning rows every text is
``und``; a single family or a single language needs no machine and is predicted; ties go to the smaller
code; a null id is in the learning folds by its crc32 of the empty string but never in the sample; repeated rows are predicted
row by row; extra columns are not read; an empty table gives no rows; a very long text takes
memory in proportion to itself.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kinscore.llm.common import SmallestText, held_out, require, saved, slices

#: fixed values: families of language codes
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk bg mk sr hr sl bs",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tt",
    "indic": "hi ur bn mr ne gu pa",
    "semitic": "ar he mt am",
    "celtic": "ga gd cy br",
    "baltic": "lt lv",
}
MAX_ROWS = 1000
DIMS = 1 << 12
ORDERS = (1, 2, 3, 4)
SWEEPS, COST = 12, 1.0
UNKNOWN = "und"
_FAMILY_OF = {code: name for name, codes in FAMILIES.items() for code in codes.split()}


def family(code: str) -> str:
    return _FAMILY_OF.get(code.split("-")[0].lower(), code)


def _letters() -> np.ndarray:
    """Byte -> byte of a lower-case ASCII letter, a byte of a longer character, or a blank."""
    table = np.full(256, 32, np.uint8)
    for c in range(26):
        table[65 + c] = table[97 + c] = 97 + c
    table[128:] = np.arange(128, 256)
    return table


_TABLE = _letters()


def features(text: str) -> np.ndarray:
    """Unit vector of square roots of n-gram counts."""
    raw = _TABLE[np.frombuffer((" " + text.lower() + " ").encode("utf-8", "ignore"), np.uint8)]
    # runs of blanks count once
    raw = raw[np.r_[True, (raw[1:] != 32) | (raw[:-1] != 32)]].astype(np.uint32)
    total = np.zeros(DIMS)
    code = np.zeros(len(raw), np.uint32)
    for n in range(1, max(ORDERS) + 1):
        code = code[: len(raw) - n + 1] * np.uint32(0x01000193) + raw[n - 1 :] + np.uint32(1)
        mixed = code ^ (code >> np.uint32(15))
        mixed = mixed * np.uint32(0x2C1B3C6D)
        total += np.bincount((mixed >> np.uint32(16)) & np.uint32(DIMS - 1), minlength=DIMS)
    total = np.sqrt(total)
    return (total / max(np.linalg.norm(total), 1e-12)).astype(np.float32)


def svm(x: np.ndarray, y: np.ndarray, seed: int = 5) -> np.ndarray:
    """Weights of a linear support vector machine, y in {-1, 1}: squared hinge loss by dual
    coordinate descent; both classes weigh the same. The last weight is the bias."""
    x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
    share = np.where(y > 0, (y > 0).mean(), (y < 0).mean())
    cost = COST * 0.5 / np.maximum(share, 1e-9)
    square = np.einsum("nd,nd->n", x, x) + 0.5 / cost
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    rng = np.random.default_rng(seed)
    for _ in range(SWEEPS):
        for i in rng.permutation(len(x)):
            g = y[i] * (x[i] @ w) - 1 + 0.5 / cost[i] * alpha[i]
            new = max(alpha[i] - g / square[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


def pairwise(x: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """Weights (pairs x dims) of one machine for every two of ``n`` classes, the first one positive."""
    machines = []
    for a, b in combinations(range(n), 2):
        pick = (of == a) | (of == b)
        machines.append(svm(x[pick], np.where(of[pick] == a, 1.0, -1.0)))
    return np.array(machines) if machines else np.zeros((0, x.shape[1] + 1))


def shares(margins: np.ndarray, n: int) -> np.ndarray:
    """(rows x classes): softmax of votes, with margins deciding between equal votes."""
    total = np.zeros((len(margins), n))
    for k, (a, b) in enumerate(combinations(range(n), 2)):
        m = margins[:, k]
        soft = np.tanh(2 * m)
        total[:, a] += (m >= 0) + soft
        total[:, b] += (m < 0) - soft
    e = np.exp(total - total.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Model:
    """Machines between families, and between the languages of each family.

    ``parts``: (classes, machines) of the families under "" and of each family's languages."""

    def __init__(self, parts: dict[str, tuple[list[str], np.ndarray]]):
        self.families, self.top = parts[""]
        self.inside = [parts[f] for f in self.families]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        x = np.concatenate([x, np.ones((len(x), 1), x.dtype)], axis=1)
        top = shares(x @ self.top.T, len(self.families))
        best = top.argmax(axis=1)
        out, score = [""] * len(x), np.zeros(len(x))
        for f in np.unique(best).tolist():
            own, machines = self.inside[f]
            pick = np.flatnonzero(best == f)
            inner = shares(x[pick] @ machines.T, len(own))
            at = inner.argmax(axis=1)
            for i, k, s in zip(pick.tolist(), at.tolist(), inner[np.arange(len(pick)), at].tolist(), strict=True):
                out[i], score[i] = own[k], s * top[i, f]
        return out, score


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def learning_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, family, in_top): the bounded sample; ``in_top`` marks what the first classifier
    learns from."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang").where("doc_id is not null and lang is not null")
    known = known.where(~held_out(F.col("doc_id"))).distinct()
    # of a large language only the part of the hash range that holds about 2 * MAX_ROWS ids is ranked
    sizes = saved(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")))
    sizes = F.broadcast(sizes) if sizes.count() <= 10_000 else sizes
    hashed = known.withColumn("h", F.xxhash64("doc_id", F.lit(5))).join(sizes, "lang")
    share = F.shiftrightunsigned("h", 11).cast("double") * F.lit(2.0**-53)
    hashed = hashed.where(share * F.col("n") <= 2 * MAX_ROWS)
    order = Window.partitionBy("lang").orderBy(F.shiftrightunsigned("h", 11), "doc_id")
    few = hashed.withColumn("r", F.row_number().over(order)).where(F.col("r") <= MAX_ROWS)
    code = F.lower(F.substring_index("lang", "-", 1))
    name = F.coalesce(F.create_map(*[F.lit(x) for kv in _FAMILY_OF.items() for x in kv])[code], F.col("lang"))
    few = few.withColumn("family", name)
    rank = F.row_number().over(Window.partitionBy("family").orderBy("r", "lang"))
    return few.select("doc_id", "lang", "family", (rank <= MAX_ROWS).alias("in_top"))


def sample_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, family, in_top, text): one row for each row of the sample, however often an id occurs."""
    sample = saved(learning_rows(docs))
    n_rows = sample.count()
    # at most MAX_ROWS ids of each language: broadcast while that is a small table
    chosen = F.broadcast(sample) if n_rows <= 200_000 else sample
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text").join(chosen, ["doc_id", "lang"])

    def once(batches):
        smallest = SmallestText()
        for batch in slices(batches):
            keys = zip(batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist(), strict=True)
            own = [smallest.passes(k, t) for k, t in zip(keys, batch.column("text").to_pylist(), strict=True)]
            rows = [i for i, h in enumerate(own) if h is not None]
            kept = batch.take(pa.array(rows, pa.int64()))
            hashes = pa.array([own[i] for i in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([*kept.columns, hashes], [*batch.schema.names, "own"])

    columns = "doc_id long, lang string, family string, in_top boolean, text string"
    few = texts.select("doc_id", "lang", "family", "in_top", "text").mapInArrow(once, columns + ", own long")
    return few.groupBy("doc_id", "lang", "family", "in_top").agg(F.min_by("text", "own").alias("text"))


def train(docs: DataFrame) -> Model | None:
    texts = sample_texts(docs)

    groups = F.when(F.col("in_top"), F.array(F.lit(""), "family")).otherwise(F.array("family"))
    rows = texts.select("doc_id", "lang", "family", "text", F.explode(groups).alias("part"))

    def fit(key, t):
        part = key[0].as_py()
        t = t.filter(pa.array([has_letter(x) for x in t.column("text").to_pylist()], pa.bool_()))
        t = t.sort_by([("lang", "ascending"), ("doc_id", "ascending")])
        x = np.zeros((t.num_rows, DIMS), np.float32)
        for i, text in enumerate(t.column("text").to_pylist()):
            x[i] = features(text)
        marks = t.column("lang" if part else "family").to_pylist()
        classes = sorted(set(marks))
        machines = pairwise(x, np.array([classes.index(m) for m in marks], int), len(classes))
        return pa.table({
            "part": pa.array([part]),
            "classes": pa.array([classes], pa.list_(pa.string())),
            "machines": pa.array([machines.astype(np.float32).tobytes()], pa.binary()),
        })

    found = rows.groupBy("part").applyInArrow(fit, "part string, classes array<string>, machines binary").collect()
    found = [r for r in found if r.classes]
    parts = {r.part: (r.classes, np.frombuffer(r.machines, np.float32).reshape(-1, DIMS + 1)) for r in found}
    return Model(parts) if parts else None


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) per row of ``docs`` (doc_id, text, lang)."""
    require(docs, "doc_id", "text", "lang")
    model = train(docs)

    def predict(batches):
        for batch in slices(batches, limit=1 << 20):
            texts = batch.column("text").to_pylist()
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            known = [i for i, t in enumerate(texts) if has_letter(t)] if model else []
            if known:
                found, s = model.predict(np.stack([features(texts[i]) for i in known]))
                score[known] = s
                for i, code in zip(known, found, strict=True):
                    lang[i] = code
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held"), pa.array(lang, pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    source = docs.select("doc_id", held_out(F.col("doc_id")).alias("held"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(predict, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
