"""Many L1-penalised logistic fits over one table, carried through the data together.

Every fit minimises ``C * sum(w * log-loss) + |coefficients|_1`` (the intercept is free) on rows of its own
choice (a fold left out, a half) with its own class weights. All of them share each pass: a
task computes, for all fits at once, losses, gradients and the curvature of small working sets from its
blocks, the partial sums are added up in a tree, and the driver makes one proximal Newton step per fit.

* A *working set* of a fit is the support of its coefficients and the strongest violations of its optimality
  conditions, ``WORKING_SET`` coordinates or twice the support, so curvature costs the square of that per fit,
  whatever the number of features; a support beyond ``LARGEST_SET`` / 2 is worked on in turns, the strongest
  violations first (right, but slower). It is read from ``CURVATURE_ROWS`` rows or so (an even share of every block;
  twice as many after every eight passes): it only shapes the step, while losses and gradients, which decide where a fit ends, are those of all rows.
* The step solves the penalised quadratic model by coordinate descent, for all fits in lockstep, and is halved
  until the objective falls (each trial is one more pass, shared with the other fits).
* A fit ends when its KKT residual, the largest violation of the optimality conditions relative to the
  penalty, is at most ``TOLERANCE``. The residual is returned as the certificate of the fit.

Rows are packed once, sparse, into blocks in the checkpoint folder. The driver holds fits x features
numbers. A fit whose rows lack a class has no finite optimum: its coefficients are 0 and its
intercept is infinite on the side of the class that is there.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

# tasks run these functions on workers that need numpy and pyarrow, but not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 2048
#: coordinates whose curvature is read, at least; twice the support where that is more, up to LARGEST_SET
WORKING_SET = 192
LARGEST_SET = 1024
#: rows (about) that curvature is read from
CURVATURE_ROWS = 50_000
TOLERANCE = 1e-6
MAX_PASSES = 80
#: products of values and fits that are formed at once
CELLS = 1 << 20
#: partial sums that the driver adds up itself
DIRECT_PARTS = 32

BLOCKS = "n int, ids array<{}>, label binary, fold binary, half binary, rows binary, columns binary, values binary"


@dataclass(frozen=True)
class Rows:
    """Blocks of a training table: key, label, fold, half and sparse features."""

    blocks: DataFrame
    n_features: int
    n_rows: int


@dataclass(frozen=True)
class Problem:
    """One fit: rows whose ``part`` (fold or half) is, or is not, ``value``."""

    c: float
    positive: float
    negative: float
    part: str
    value: int
    inside: bool

    def rows(self, block) -> np.ndarray:
        own = block.fold if self.part == "fold" else block.half
        return (own == self.value) == self.inside


@dataclass
class Fit:
    coefficients: np.ndarray
    intercept: float
    kkt: float
    passes: int


class Block:
    def __init__(self, batch: pa.RecordBatch, i: int):
        raw = {c: batch.column(c)[i].as_py() for c in ("label", "fold", "half", "rows", "columns", "values")}
        self.label = np.frombuffer(raw["label"], np.float64)
        self.fold, self.half = (np.frombuffer(raw[c], np.int32) for c in ("fold", "half"))
        self.rows, self.columns = (np.frombuffer(raw[c], np.int32) for c in ("rows", "columns"))
        self.values = np.frombuffer(raw["values"], np.float64)
        self.ids = batch.column("ids")[i].values

    def margins(self, b: np.ndarray) -> np.ndarray:
        """Rows x fits; the last row of ``b`` holds the intercepts."""
        z = np.tile(b[-1], (len(self.label), 1))
        for part in self._parts(b.shape[1]):
            own = self.rows[part]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            z[own[first]] += np.add.reduceat(self.values[part, None] * b[self.columns[part]], first, axis=0)
        return z

    def transposed(self, r: np.ndarray, out: np.ndarray) -> None:
        """Add the products of the columns with r (rows x fits) to ``out``, the intercepts' last."""
        out[-1] += r.sum(0)
        for part in self._parts(r.shape[1]):
            order = np.argsort(self.columns[part], kind="stable")
            own = self.columns[part][order]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            terms = self.values[part][order, None] * r[self.rows[part][order]]
            out[own[first]] += np.add.reduceat(terms, first, axis=0)

    def dense(self, rows: np.ndarray, columns: np.ndarray, width: int) -> np.ndarray:
        """The chosen rows and columns, a column of ones (number ``width - 1``) among them."""
        at_row, at_col = np.full(len(self.label), -1), np.full(width, -1)
        at_row[rows] = np.arange(len(rows))
        at_col[columns] = np.arange(len(columns))
        out = np.zeros((len(rows), len(columns)))
        own = (at_row[self.rows] >= 0) & (at_col[self.columns] >= 0)
        out[at_row[self.rows[own]], at_col[self.columns[own]]] = self.values[own]
        out[:, at_col[width - 1]] = 1.0
        return out

    def _parts(self, fits: int):
        step = max(1, CELLS // max(1, fits))
        # a part ends where a row ends: a row's values are added up in one go or in several, either is right
        return [slice(i, i + step) for i in range(0, len(self.values), step)]


def pack(train: DataFrame, key: str = "user_id", n_features: int | None = None) -> Rows:
    """Blocks of (key, label, half, fold) and the features: a vector column ``features``, or sparse rows in
    the arrays ``indices`` and ``values`` of ``n_features`` numbers."""
    kind, sparse = train.schema[key].dataType.simpleString(), "indices" in train.columns
    own = (F.col("indices"), F.col("values")) if sparse else (vector_to_array("features").alias("values"),)
    plain = train.select(
        F.col(key).alias("id"), F.col("label").cast("double").alias("label"), F.col("fold").cast("int").alias("fold"),
        F.col("half").cast("int").alias("half"), *own,
    )

    def numbers(x: pa.Array) -> np.ndarray:
        return x.flatten().to_numpy(zero_copy_only=False)

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(at, BLOCK_ROWS)
                values = numbers(batch.column("values"))
                if sparse:
                    sizes = batch.column("values").value_lengths().to_numpy()
                    rows, columns = np.repeat(np.arange(batch.num_rows), sizes), numbers(batch.column("indices"))
                else:
                    values = values.reshape(batch.num_rows, -1)
                    rows, columns = np.nonzero(values)
                    values = values[rows, columns]
                ids = pa.concat_arrays([batch.column("id")])
                cols = [
                    pa.array([batch.num_rows], pa.int32()),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    *(pa.array([batch.column(c).to_numpy(zero_copy_only=False).astype(t).tobytes()], pa.binary()) for c, t in (("label", np.float64), ("fold", np.int32), ("half", np.int32))),
                    *(pa.array([v.tobytes()], pa.binary()) for v in (rows.astype(np.int32), columns.astype(np.int32), values.astype(np.float64))),
                ]
                yield pa.RecordBatch.from_arrays(
                    cols, ["n", "ids", "label", "fold", "half", "rows", "columns", "values"]
                )

    ensure_checkpoint_dir(train.sparkSession)
    blocks = plain.mapInArrow(run, BLOCKS.format(kind)).checkpoint(eager=True)
    if n_features is None:
        if sparse:
            raise ValueError("sparse rows need n_features")
        width = plain.select(F.size("values").alias("n")).limit(1).collect()
        n_features = width[0].n if width else 0
    return Rows(blocks, n_features, blocks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0])


def _blocks(batches):
    for batch in batches:
        for i in range(batch.num_rows):
            yield Block(batch, i)


def _weights(problems: list[Problem], block: Block) -> np.ndarray:
    """Rows x fits: class weights, 0 outside of a fit's rows."""
    up = block.label == 1
    return np.stack([np.where(p.rows(block), np.where(up, p.positive, p.negative), 0.0) for p in problems], axis=1)


def _evaluate(rows: Rows, problems: list[Problem], b: np.ndarray, sets: list[np.ndarray], seen_rows: int):
    """Losses, gradients (features + 1 x fits) and curvature of each fit's working set at ``b``."""
    width, share = len(b), min(1.0, seen_rows / max(1, rows.n_rows))
    ends = np.cumsum([0, len(problems), b.size, *(len(s) ** 2 for s in sets)])

    def run(batches):
        loss, gradient = np.zeros(len(problems)), np.zeros_like(b)
        curvature = [np.zeros((len(s), len(s))) for s in sets]
        for block in _blocks(batches):
            z, w, y = block.margins(b), _weights(problems, block), block.label[:, None]
            loss += (w * (np.logaddexp(0, z) - y * z)).sum(0)
            p = 0.5 * (1 + np.tanh(0.5 * z))
            block.transposed(w * (p - y), gradient)
            seen = np.arange(len(block.label))
            if share < 1:  # Weyl's sequence: a share of every block
                seen = seen[(seen * 0.6180339887498949) % 1 < share]
            s = (w * p * (1 - p))[seen] / share
            for own, h, at in zip(sets, curvature, range(len(sets)), strict=True):
                on = s[:, at] > 0
                x = block.dense(seen[on], own, width)
                h += x.T @ (x * s[on, at][:, None])
        flat = np.concatenate([loss, gradient.ravel(), *(h.ravel() for h in curvature)])
        yield pa.RecordBatch.from_arrays([pa.array([flat.tobytes()], pa.binary())], ["part"])

    def add(batches):
        total = np.zeros(ends[-1])
        for batch in batches:
            for part in batch.column("part").to_pylist():
                total += np.frombuffer(part)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["part"])

    parts = rows.blocks.mapInArrow(run, "part binary")
    n = rows.blocks.rdd.getNumPartitions()
    while n > DIRECT_PARTS:
        n = -(-n // DIRECT_PARTS)
        parts = parts.repartition(n).mapInArrow(add, "part binary")
    flat = sum((np.frombuffer(r.part) for r in parts.collect()), np.zeros(ends[-1]))
    pieces = [flat[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)]
    shaped = [h.reshape(len(s), len(s)) for h, s in zip(pieces[2:], sets, strict=True)]
    return pieces[0], pieces[1].reshape(b.shape), shaped


def _violation(b: np.ndarray, gradient: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """How far each coordinate is from optimal, relative to the fit's penalty (the intercept is the last)."""
    at_zero = np.maximum(np.abs(gradient) - penalty, 0)
    out = np.where(b != 0, np.abs(gradient + penalty * np.sign(b)), at_zero)
    out[-1] = np.abs(gradient[-1])
    return out / penalty


def _step(b, gradient, curvature, sets, penalty, sweeps: int = 400) -> np.ndarray:
    """Coordinate descent on the penalised quadratic models, all fits in lockstep."""
    fits, size = len(sets), max(map(len, sets))
    h, start, g, lam = np.zeros((fits, size, size)), np.zeros((fits, size)), np.zeros((fits, size)), np.zeros((fits, size))
    for f, own in enumerate(sets):
        n = len(own)
        h[f, :n, :n], start[f, :n], g[f, :n] = curvature[f], b[own, f], gradient[own, f]
        lam[f, :n] = np.where(own == len(b) - 1, 0.0, penalty[f])
    diagonal = np.einsum("fii->fi", h)
    ridge = 1e-9 * diagonal.max(1, keepdims=True) + 1e-12
    diagonal += ridge
    x, slope = start.copy(), g.copy()  # slope of the smooth part of the model at x
    for _ in range(sweeps):
        most = np.zeros(fits)
        for j in range(size):
            d = diagonal[:, j]
            t = d * x[:, j] - slope[:, j]
            new = np.sign(t) * np.maximum(np.abs(t) - lam[:, j], 0) / d
            change = new - x[:, j]
            if change.any():
                slope += change[:, None] * h[:, j]
                x[:, j] = new
                most = np.maximum(most, np.abs(change) * d)
        if (most <= 1e-9 * penalty).all():
            break
    out = b.copy()
    for f, own in enumerate(sets):
        out[own, f] = x[f, : len(own)]
    return out


def fit_many(rows: Rows, problems: list[Problem], tolerance: float = TOLERANCE, max_passes: int = MAX_PASSES) -> list[Fit]:
    """All fits; every fit carries its KKT residual and the passes over the data made until it ended."""
    width, n = rows.n_features + 1, len(problems)
    classes = class_counts(rows, problems)
    found: list[Fit | None] = [None] * n
    for i, (up, down) in enumerate(classes):
        if not up or not down:
            found[i] = Fit(np.zeros(rows.n_features), np.inf if up else -np.inf, 0.0, 0)
    left = [i for i in range(n) if found[i] is None]
    best = np.zeros((width, n))
    for i in left:  # the intercept alone, at its optimum
        up, down = classes[i]
        best[-1, i] = np.log(up * problems[i].positive / (down * problems[i].negative))
    penalty = np.array([1.0 / p.c for p in problems])
    value, expected, scale = np.full(n, np.inf), np.zeros(n), np.ones(n)
    trial, state = best.copy(), {}
    sets = {i: np.arange(width)[-WORKING_SET:] for i in left}
    for done in range(1, max_passes + 1):
        if not left:
            break
        seen_rows = CURVATURE_ROWS << (done // 8)
        loss, gradient, curvature = _evaluate(
            rows, [problems[i] for i in left], trial[:, left], [sets[i] for i in left], seen_rows
        )
        ready = []
        for place, i in enumerate(left):
            now = loss[place] + penalty[i] * np.abs(trial[:-1, i]).sum()
            slack = 1e-12 * abs(value[i]) if np.isfinite(value[i]) else 0.0
            if now <= value[i] + 0.01 * scale[i] * expected[i] + slack:
                best[:, i], value[i], scale[i] = trial[:, i], now, 1.0
                state[i] = (gradient[:, place], curvature[place], sets[i])
                ready.append(i)
            else:  # too long a step
                scale[i] /= 2
                trial[:, i] = best[:, i] + scale[i] * (state[i][3] - best[:, i])
        for i in ready:
            violation = _violation(best[:, [i]], state[i][0][:, None], penalty[[i]])[:, 0]
            if violation.max() <= tolerance or done == max_passes:
                found[i] = Fit(best[:-1, i].copy(), float(best[-1, i]), float(violation.max()), done)
            support = np.count_nonzero(best[:-1, i])
            size = min(max(WORKING_SET, 2 * support), LARGEST_SET)
            # the support first, unless it leaves no room for the worst violations
            wish = violation + np.where((best[:, i] != 0) & (2 * support <= size), 1e6, 0.0)
            wish[-1] = np.inf
            sets[i] = np.sort(np.argsort(-wish, kind="stable")[:size])
        left = [i for i in left if found[i] is None]
        going = [i for i in ready if found[i] is None]
        if going:
            own = [state[i][2] for i in going]
            full = _step(best[:, going], np.stack([state[i][0] for i in going], axis=1), [state[i][1] for i in going], own, penalty[going])
            for place, i in enumerate(going):
                g, h, s = state[i][:3]
                state[i] = (g, h, s, full[:, place])
                move = full[:, place] - best[:, i]
                expected[i] = g @ move + penalty[i] * (np.abs(full[:-1, place]).sum() - np.abs(best[:-1, i]).sum())
                trial[:, i] = full[:, place]
    for i in left:  # a fit whose steps found no descent within the passes
        g = state[i][0]
        worst = _violation(best[:, [i]], g[:, None], penalty[[i]]).max()
        found[i] = Fit(best[:-1, i].copy(), float(best[-1, i]), float(worst), max_passes)
    return found


def class_counts(rows: Rows, problems: list[Problem]) -> list[tuple[int, int]]:
    """Rows of label 1 and 0 of each fit."""

    def run(batches):
        n = np.zeros((len(problems), 2), np.int64)
        for block in _blocks(batches):
            for i, p in enumerate(problems):
                own = block.label[p.rows(block)] == 1
                n[i] += (own.sum(), (~own).sum())
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.arange(len(n)), n[:, 0], n[:, 1])], ["fit", "up", "down"])

    counted = rows.blocks.mapInArrow(run, "fit long, up long, down long").groupBy("fit").agg(F.sum("up"), F.sum("down"))
    by = {r[0]: (r[1], r[2]) for r in counted.collect()}
    return [by.get(i, (0, 0)) for i in range(len(problems))]


def _stacked(fits: list[Fit]) -> np.ndarray:
    return np.stack([np.r_[f.coefficients, f.intercept] for f in fits], axis=1)


def confusion(rows: Rows, problems: list[Problem], fits: list[Fit]) -> list[tuple[int, int, int]]:
    """(tp, fp, fn) of each fit on the rows it has not seen, all in one pass."""
    b = _stacked(fits)

    def run(batches):
        n = np.zeros((len(problems), 3), np.int64)
        for block in _blocks(batches):
            said, up = block.margins(b) > 0, block.label[:, None] == 1
            unseen = ~np.stack([p.rows(block) for p in problems], axis=1)
            n += np.stack([(said & up & unseen).sum(0), (said & ~up & unseen).sum(0), (~said & up & unseen).sum(0)], axis=1)
        cols = [np.arange(len(n)), *n.T]
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in cols], ["fit", "tp", "fp", "fn"])

    made = rows.blocks.mapInArrow(run, "fit long, tp long, fp long, fn long")
    by = {r[0]: tuple(r[1:]) for r in made.groupBy("fit").agg(F.sum("tp"), F.sum("fp"), F.sum("fn")).collect()}
    return [by.get(i, (0, 0, 0)) for i in range(len(problems))]


def f1_of(tp: int, fp: int, fn: int) -> float:
    return 2.0 * tp / (2 * tp + fp + fn) if 2 * tp + fp + fn else 0.0


def unseen_scores(rows: Rows, problems: list[Problem], fits: list[Fit], key: str, name: str) -> DataFrame:
    """(key, name): the probability of label 1 by the fit that has not seen the row."""
    b, kind = _stacked(fits), rows.blocks.schema["ids"].dataType.elementType.simpleString()

    def run(batches):
        for block in _blocks(batches):
            p = 0.5 * (1 + np.tanh(0.5 * block.margins(b)))
            for i, own in enumerate(problems):
                at = np.flatnonzero(~own.rows(block))
                yield pa.RecordBatch.from_arrays([block.ids.take(pa.array(at)), pa.array(p[at, i])], ["id", "score"])

    return rows.blocks.mapInArrow(run, f"id {kind}, score double").toDF(key, name)
