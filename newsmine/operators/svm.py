"""Multi-class linear SVM: one-vs-one, calibrated, cross-validated.

Cross-validation needs many binary machines: one per class pair, held-out fold
and inner fold. They all read the same rows, so they are trained together: one
Spark pass per step gives value and gradient of every machine, computed as dense
matrix products inside the tasks. Only the coefficients, whose number does not
depend on the rows, meet on the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmine.config import ModelSettings
from newsmine.operators.blocks import total_of
from newsmine.session import cut

Pair = tuple[int, int]

#: Small inputs are read by few tasks; big ones keep their partitions.
ROWS_PER_TASK = 2_000
_CHUNK_ROWS = 4_096
# (margin width over which the hinge is rounded off, share of the iterations,
# slack of the tolerance); each stage starts from the last.
_STAGES = ((0.5, 0.2, 10.0), (0.02, 1.0, 1.0))


def class_pairs(n_classes: int) -> list[Pair]:
    return list(combinations(range(n_classes), 2))


def label_index(classes: Sequence[str]) -> Column:
    """Position of ``label`` among the (alphabetical) classes."""
    return (F.array_position(F.array(*[F.lit(c) for c in classes]), F.col("label")) - 1).cast("int")


# ── rows inside a task ────────────────────────────────────────────────────────


def _dense(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batch pieces with their feature matrix (``idx`` marks sparse rows)."""
    for whole in batches:
        for at in range(0, whole.num_rows, _CHUNK_ROWS):
            batch = whole.slice(at, _CHUNK_ROWS)
            values = batch.column("val").flatten().to_numpy()
            if "idx" not in batch.schema.names:
                yield batch, values.reshape(batch.num_rows, width)
                continue
            x = np.zeros((batch.num_rows, width))
            lengths = np.diff(batch.column("idx").offsets.to_numpy())
            x[np.repeat(np.arange(batch.num_rows), lengths), batch.column("idx").flatten().to_numpy()] = values
            yield batch, x


def _ints(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False).astype(int)


# ── training many machines at once ────────────────────────────────────────────


@dataclass(frozen=True)
class Machine:
    """One binary problem: the pair, the folds it must not see, its feature set."""

    features: int | None
    excluded: frozenset
    pair: Pair


def _hinge(m: np.ndarray, width: float) -> tuple[np.ndarray, np.ndarray]:
    """Rounded hinge loss of margins and its slope."""
    gap = 1.0 - m
    share = np.clip(gap / width, 0.0, 1.0)
    return share * (gap - share * (width / 2)), -share


def minimise(
    evaluate: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]],
    start: np.ndarray,
    max_iter: int,
    tol: float,
    memory: int = 10,
) -> np.ndarray:
    """Limited-memory quasi-Newton steps for independent problems, one row each.

    Every call of ``evaluate`` costs one pass for all problems that are not done; a
    problem whose step does not help halves it and tries again with the others' next step.
    """
    w = start
    active = np.ones(len(w), bool)
    value, slope = evaluate(w, active)
    history: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    step = np.ones(len(w))
    direction = -slope / np.maximum(1.0, np.linalg.norm(slope, axis=1, keepdims=True))
    for _ in range(max_iter):
        trial = w + (step * active)[:, None] * direction
        new_value, new_slope = evaluate(trial, active)
        descent = (slope * direction).sum(axis=1)
        better = active & (new_value <= value + 1e-4 * step * descent)
        gain = np.where(better, value - new_value, 0.0)
        ds = np.where(better[:, None], trial - w, 0.0)
        dg = np.where(better[:, None], new_slope - slope, 0.0)
        curve = (ds * dg).sum(axis=1)
        history = [*history, (ds, dg, np.where(curve > 1e-12, 1.0 / np.maximum(curve, 1e-300), 0.0))][-memory:]
        w = np.where(better[:, None], trial, w)
        value, slope = np.where(better, new_value, value), np.where(better[:, None], new_slope, slope)
        active &= ~(better & (gain <= tol * np.maximum(np.abs(value), 1e-12)))
        active &= better | (step > 1e-8)
        if not active.any():
            break
        direction = np.where(better[:, None], -_two_loop(slope, history), direction)
        uphill = better & ((direction * slope).sum(axis=1) >= 0)
        direction = np.where(uphill[:, None], -slope, direction)
        step = np.where(better, 1.0, step / 2)
    return w


def _two_loop(slope: np.ndarray, history: list) -> np.ndarray:
    """Inverse-curvature estimate times the gradient, per problem (Nocedal 1980)."""
    q, kept = slope.copy(), []
    for ds, dg, rho in reversed(history):
        a = rho * (ds * q).sum(axis=1)
        q -= a[:, None] * dg
        kept.append(a)
    scale = np.ones(len(slope))
    for ds, dg, rho in history:  # the latest useful pair of each problem wins
        scale = np.where(rho > 0, (ds * dg).sum(axis=1) / np.maximum((dg * dg).sum(axis=1), 1e-300), scale)
    q *= scale[:, None]
    for (ds, dg, rho), a in zip(history, reversed(kept), strict=True):
        b = rho * (dg * q).sum(axis=1)
        q += (a - b)[:, None] * ds
    return q


def _sides(machines: Sequence[Machine], n_classes: int, folds: Sequence[int]) -> np.ndarray:
    """+1, -1 or 0 (not used) per class, fold and machine."""
    sides = np.zeros((n_classes, max(folds) + 1, len(machines)))
    for p, machine in enumerate(machines):
        for f in folds:
            if f not in machine.excluded:
                sides[machine.pair[0], f, p], sides[machine.pair[1], f, p] = 1.0, -1.0
    return sides


def fit_machines(
    rows: DataFrame, width: int, sides: np.ndarray, masks: np.ndarray, settings: ModelSettings
) -> np.ndarray:
    """Weights and intercept (last column) per machine: ½‖w‖² + C · Σ hinge."""
    sc = rows.sparkSession.sparkContext
    columns = rows.select(*_columns(rows), "y", "fold")

    def evaluate_at(smooth: float) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        def evaluate(w: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Values and gradients of the active machines, zeros for the others."""
            some = np.flatnonzero(active)
            shape = (len(some), width + 2)
            shared = sc.broadcast((w[some], sides[:, :, some]))

            def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
                (w, sides), out = shared.value, np.zeros(shape)
                # A machine reads the rows of its two classes only.
                using = [np.flatnonzero((own != 0).any(axis=0)) for own in sides]
                for batch, x in _dense(batches, width):
                    y, fold = _ints(batch, "y"), _ints(batch, "fold")
                    for c, on in enumerate(using):
                        at = np.flatnonzero(y == c)
                        if not len(on) or not len(at):
                            continue
                        own, side = x[at], sides[c][:, on][fold[at]]
                        loss, drop = _hinge(side * (own @ w[on, :-1].T + w[on, -1]), smooth)
                        pull = drop * side
                        out[on, 0] += (loss * (side != 0)).sum(axis=0)
                        out[on, 1:-1] += pull.T @ own
                        out[on, -1] += pull.sum(axis=0)
                return out

            found = np.zeros((len(w), width + 2))
            found[some] = total_of(columns, partial, shape)
            shared.unpersist()
            free = np.concatenate([w[:, :-1], np.zeros((len(w), 1))], axis=1)
            value = 0.5 * (free**2).sum(axis=1) + settings.c * found[:, 0]
            return value, (free + settings.c * found[:, 1:]) * masks

        return evaluate

    w = np.zeros((sides.shape[2], width + 1))
    for smooth, share, slack in _STAGES:
        steps = max(1, round(share * settings.max_iter))
        w = minimise(evaluate_at(smooth), w, steps, slack * settings.tol)
    return w


def _columns(rows: DataFrame) -> list[str]:
    return [c for c in ("idx", "val") if c in rows.columns]


# ── calibration ───────────────────────────────────────────────────────────────


def fit_sigmoids(
    rows: DataFrame, width: int, weights: np.ndarray, held: np.ndarray, pairs: Sequence[Pair], counts: np.ndarray, max_iter: int = 30
) -> np.ndarray:
    """Platt sigmoids on held-out margins: P(first class) = s(a·m + b).

    ``held[t, g, p]`` is the machine whose margins of fold g count for test t and
    pair p (-1: none); ``counts[t, p]`` are the sizes that smooth the targets.
    """
    sc = rows.sparkSession.sparkContext
    tests, _, n_pairs = held.shape
    goal = np.stack([(counts[..., 0] + 1.0) / (counts[..., 0] + 2.0), 1.0 / (counts[..., 1] + 2.0)], axis=-1)
    shared = sc.broadcast((weights, held, goal))
    shape = (tests * n_pairs, 6)

    def measure(curve: np.ndarray) -> np.ndarray:
        """Loss, gradient and curvature of every sigmoid in one pass."""

        def partial(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            w, held, goal = shared.value
            out = np.zeros(shape)
            for batch, x in _dense(batches, width):
                y, fold = _ints(batch, "y"), _ints(batch, "fold")
                m = x @ w[:, :-1].T + w[:, -1]
                for t in range(tests):
                    for p, (i, j) in enumerate(pairs):
                        machine = held[t, fold, p]
                        on = np.flatnonzero((machine >= 0) & ((y == i) | (y == j)))
                        if not len(on):
                            continue
                        v, want = m[on, machine[on]], np.where(y[on] == i, goal[t, p, 0], goal[t, p, 1])
                        a, b = curve[t * n_pairs + p]
                        z = a * v + b
                        s = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))
                        e, h = s - want, np.maximum(s * (1 - s), 1e-12)
                        loss = np.logaddexp(0.0, z) - want * z
                        out[t * n_pairs + p] += [loss.sum(), (e * v).sum(), e.sum(), (h * v * v).sum(), (h * v).sum(), h.sum()]
            return out

        return total_of(rows.select(*_columns(rows), "y", "fold"), partial, shape)

    flat = counts.reshape(-1, 2)
    curve = np.stack([np.zeros(len(flat)), np.log((flat[:, 0] + 1.0) / (flat[:, 1] + 1.0))], axis=1)
    found, step, shift = measure(curve), np.ones(len(curve)), np.zeros_like(curve)
    for _ in range(max_iter):
        loss, slope = found[:, 0], found[:, 1:3]
        h11, h12, h22 = found[:, 3] + 1e-12, found[:, 4], found[:, 5] + 1e-12
        area = np.maximum(h11 * h22 - h12 * h12, 1e-300)
        newton = -np.stack(
            [(h22 * slope[:, 0] - h12 * slope[:, 1]) / area, (h11 * slope[:, 1] - h12 * slope[:, 0]) / area], axis=1
        )
        shift = np.where((step == 1.0)[:, None], newton, shift)
        small = np.abs(slope).max(axis=1) < 1e-5
        trial = curve + np.where(small, 0.0, step)[:, None] * shift
        tried = measure(trial)
        better = tried[:, 0] <= loss
        curve, found = np.where(better[:, None], trial, curve), np.where(better[:, None], tried, found)
        step = np.where(better, 1.0, step / 2)
        gain = np.where(better, loss - tried[:, 0], np.inf)
        if (small | (gain <= 1e-7 * np.maximum(np.abs(loss), 1e-12)) | (step < 1e-8)).all():
            break
    shared.unpersist()
    return curve.reshape(tests, n_pairs, 2)


def couple(pairwise: np.ndarray, n_classes: int, pairs: Sequence[Pair]) -> np.ndarray:
    """Class probabilities that agree best with all pairwise ones (Wu, Lin and Weng 2004)."""
    given = np.clip(pairwise, 1e-7, 1 - 1e-7)
    r = np.zeros((len(given), n_classes, n_classes))
    for p, (i, j) in enumerate(pairs):
        r[:, i, j], r[:, j, i] = given[:, p], 1.0 - given[:, p]
    # Classes without any machine have no say and get no probability.
    live = sorted({c for pair in pairs for c in pair})
    r = r[:, live][:, :, live]
    k = len(live)
    system = np.zeros((len(given), k + 1, k + 1))
    # r[a, b] is P(a beats b): the quadratic form pairs r[b, a]·p[a] with r[a, b]·p[b].
    system[:, :k, :k] = -r.transpose(0, 2, 1) * r
    system[:, np.arange(k), np.arange(k)] = (r.transpose(0, 2, 1) ** 2).sum(axis=2)
    system[:, :k, k] = system[:, k, :k] = 1.0
    right = np.zeros((len(given), k + 1, 1))
    right[:, k, 0] = 1.0
    out = np.zeros((len(given), n_classes))
    out[:, live] = np.clip(np.linalg.solve(system, right)[:, :k, 0], 0.0, 1.0)
    return out


# ── the fitted classifier ─────────────────────────────────────────────────────


@dataclass
class LinearSvm:
    """One-vs-one machines in class order, each with its sigmoid."""

    classes: list[str]
    pairs: list[Pair]
    weights: np.ndarray  # (pairs, features + 1), intercept last
    curves: np.ndarray  # (pairs, 2)

    @property
    def width(self) -> int:
        return self.weights.shape[1] - 1

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Majority of pair votes (lowest class wins ties) and probabilities."""
        m = x @ self.weights[:, :-1].T + self.weights[:, -1]
        votes = np.zeros((len(x), len(self.classes)), int)
        for p, (i, j) in enumerate(self.pairs):
            votes[:, i] += m[:, p] > 0
            votes[:, j] += m[:, p] <= 0
        pairwise = 1.0 / (1.0 + np.exp(-np.clip(self.curves[:, 0] * m + self.curves[:, 1], -500, 500)))
        return votes.argmax(axis=1), couple(pairwise, len(self.classes), self.pairs)

    def transform(self, rows: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
        return score({None: self}, rows, keep)

    def save(self, path: str, spark: SparkSession) -> None:
        machines = [
            (n, i, j, w[:-1].tolist(), float(w[-1]), float(c[0]), float(c[1]))
            for n, ((i, j), w, c) in enumerate(zip(self.pairs, self.weights, self.curves, strict=True))
        ]
        schema = "n int, pos int, neg int, weights array<double>, intercept double, slope double, offset double"
        spark.createDataFrame(machines, schema).write.mode("overwrite").parquet(f"{path}/machines")
        classes = spark.createDataFrame(list(enumerate(self.classes)), "idx int, label string")
        classes.write.mode("overwrite").parquet(f"{path}/classes")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> LinearSvm:
        classes = [r["label"] for r in spark.read.parquet(f"{path}/classes").orderBy("idx").collect()]
        rows = spark.read.parquet(f"{path}/machines").orderBy("n").collect()
        weights = np.array([[*r["weights"], r["intercept"]] for r in rows])
        curves = np.array([[r["slope"], r["offset"]] for r in rows])
        return cls(classes, [(r["pos"], r["neg"]) for r in rows], weights, curves)


def score(models: dict[int | None, LinearSvm], rows: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(…, pred, probs): each row by the model of its fold, or by the only model (``None``)."""
    shared = rows.sparkSession.sparkContext.broadcast(models)
    width = next(iter(models.values())).width
    kept = rows.select(*keep, *_columns(rows))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.select(*keep).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _dense(batches, width):
            models = shared.value
            which = np.zeros(batch.num_rows, int) if None in models else _ints(batch, "fold")
            n_classes = len(next(iter(models.values())).classes)
            pred, probs = np.zeros(batch.num_rows, np.int32), np.zeros((batch.num_rows, n_classes))
            for name, model in models.items():
                on = np.flatnonzero(which == (0 if name is None else name))
                if len(on):
                    pred[on], probs[on] = model.predict(x[on])
            lists = pa.ListArray.from_arrays(
                np.arange(0, probs.size + 1, n_classes, dtype=np.int32), probs.ravel()
            )
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(pred), lists], names=[*keep, "pred", "probs"]
            )

    return kept.mapInArrow(run, f"{schema}, pred int, probs array<double>")


# ── training ──────────────────────────────────────────────────────────────────


@dataclass
class SvmTrainer:
    """Cross-validation and final fit over one feature table.

    ``rows`` is (doc_id, label, fold, [idx,] val) with ``width`` features;
    ``chosen`` gives the features each held-out fold may use (absent: all).
    Held-out margins for a sigmoid come from the other outer folds: those of fold
    g come from a machine that saw neither the test fold nor g. Where folds share
    their features that machine serves both directions.
    """

    rows: DataFrame
    classes: list[str]
    width: int
    settings: ModelSettings
    chosen: dict[int | None, list[int]] | None = None
    sizes: dict[tuple[int, int], int] = field(init=False)

    def __post_init__(self) -> None:
        rows = self.rows.withColumn("y", label_index(self.classes))
        # One small row per fold and class.
        found = rows.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n")).collect()
        self.sizes = {(r["fold"], r["y"]): r["n"] for r in found}
        self.folds = sorted({f for f, _ in self.sizes})
        self.pairs = class_pairs(len(self.classes))
        tasks = max(1, -(-sum(self.sizes.values()) // ROWS_PER_TASK))
        self.rows = rows if rows.rdd.getNumPartitions() <= tasks else rows.coalesce(tasks)
        self.rows.persist()

    def close(self) -> None:
        self.rows.unpersist()

    def _count(self, y: int, excluded: frozenset) -> int:
        return sum(n for (fold, label), n in self.sizes.items() if label == y and fold not in excluded)

    def _machine(self, test: int | None, pair: Pair, inner: int | None = None) -> Machine | None:
        """The problem for a test fold (and inner fold); None if a class has no rows left."""
        excluded = frozenset(f for f in (test, inner) if f is not None)
        if min(self._count(y, excluded) for y in pair) == 0:
            return None
        return Machine(test if self.chosen else None, excluded, pair)

    def train(self, tests: Sequence[int | None]) -> dict[int | None, LinearSvm]:
        """One classifier per test fold (``None`` trains on all rows), all in one go."""
        inner = {t: [f for f in self.folds if f != t] for t in tests}
        wanted = [self._machine(t, p, g) for t in tests for p in self.pairs for g in [None, *inner[t]]]
        machines = list(dict.fromkeys(m for m in wanted if m is not None))
        number = {m: n for n, m in enumerate(machines)}

        masks = np.ones((len(machines), self.width + 1))
        if self.chosen:
            for n, machine in enumerate(machines):
                masks[n, :-1] = 0.0
                masks[n, self.chosen[machine.features]] = 1.0
        sides = _sides(machines, len(self.classes), self.folds)
        weights = fit_machines(self.rows, self.width, sides, masks, self.settings)

        held = np.full((len(tests), max(self.folds) + 1, len(self.pairs)), -1)
        counts = np.zeros((len(tests), len(self.pairs), 2))
        for a, t in enumerate(tests):
            for p, pair in enumerate(self.pairs):
                counts[a, p] = [self._count(y, frozenset([t])) for y in pair]
                for g in inner[t]:
                    held[a, g, p] = number.get(self._machine(t, pair, g), -1)
        curves = fit_sigmoids(self.rows, self.width, weights, held, self.pairs, counts, self.settings.sigmoid_max_iter)

        models = {}
        for a, t in enumerate(tests):
            live = [p for p, pair in enumerate(self.pairs) if self._machine(t, pair)]
            own = [number[self._machine(t, self.pairs[p])] for p in live]
            models[t] = LinearSvm(self.classes, [self.pairs[p] for p in live], weights[own], curves[a, live])
        return models

    def run(self, evaluate: bool = True, final: bool = False) -> tuple[DataFrame | None, LinearSvm | None]:
        """Held-out predictions (fold, doc_id, label, pred, probs) and the model of all rows.

        Whatever is asked for is trained in the same passes.
        """
        folds = self.folds if evaluate else []
        models = self.train([*folds, *([None] if final else [])])
        last = models.pop(None, None)
        if not evaluate:
            return None, last
        rows = self.rows.withColumn("label", F.col("y"))
        return cut(score(models, rows, ("fold", "doc_id", "label"))), last


def class_scores(predictions: DataFrame) -> DataFrame:
    """One row per document and class: (fold, doc_id, label, class, score)."""
    return predictions.select("fold", "doc_id", "label", F.posexplode("probs").alias("class", "score"))
