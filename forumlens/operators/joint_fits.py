"""Logistic regressions of two classes fitted side by side: one pass over the rows gives loss and gradient of all of them.

Each fit is that of pyspark.ml's LogisticRegression on the rows outside its fold: features scaled by the standard deviation of those rows
and centred without touching the rows, intercept, steps of Breeze's L-BFGS (OWL-QN where there is an L1 penalty) with its line searches
and its tests of convergence. A fit that may take more rounds goes through those of the fits that may take fewer, so fits that differ
by nothing else are one descent, looked at when each of them would have ended.

Rows are stored in blocks of a few MB. A task makes a block dense and multiplies it by the coefficients of all descents; the driver
adds up a partial gradient for each task (treewise where there are many) and takes the steps. Descents go side by side in groups of COEFFICIENTS numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.operators.metrics import area_under_roc
from forumlens.session import ship, spread, stored

#: Numbers of a dense block, and of the coefficients of descents that go side by side.
CELLS, COEFFICIENTS = 1 << 19, 1 << 18
#: Tasks whose partial gradients the driver adds up by itself.
TASKS = 64
TOLERANCE, MEMORY, VALUES = 1e-6, 10, 20
BLOCK = "labels binary, folds binary, lengths binary, places binary, numbers binary"

Steps = Iterator  # a generator that yields points, is sent (loss, gradient) there and returns its result


class StepFailed(ArithmeticError):
    """No step from here: the history is dropped once, then the descent ends."""


@dataclass(frozen=True)
class Descent:
    """Parameters of a descent and the fold that is left out."""

    reg_param: float
    elastic_net_param: float
    fold: int

    @property
    def l1(self) -> float:
        return self.reg_param * self.elastic_net_param

    @property
    def l2(self) -> float:
        return self.reg_param * (1 - self.elastic_net_param)


# The optimiser


def _direction(history: list[tuple[np.ndarray, np.ndarray]], gradient: np.ndarray) -> np.ndarray:
    """The step of the approximate inverse Hessian; `history` has steps and changes of the gradient, the latest first."""
    found, shares, scale = gradient.copy(), [], 1.0
    if history:
        step, change = history[0]
        scale = (step @ change) / (change @ change)
        if not step @ change >= 0:
            raise StepFailed("history")
    for step, change in history:
        shares.append((step @ found) / (step @ change))
        if np.isnan(shares[-1]):
            raise StepFailed("history")
        found -= shares[-1] * change
    found *= scale
    for (step, change), share in zip(reversed(history), reversed(shares)):
        found += (share - (change @ found) / (step @ change)) * step
    return -found


def _between(low: tuple, high: tuple) -> float:
    """Where the cubic through two points (t, value, slope) is least, not too close to either."""
    (t0, v0, s0), (t1, v1, s1) = sorted((low, high), key=lambda p: p[0])
    d1 = s0 + s1 - 3 * (v0 - v1) / (t0 - t1)
    d2 = np.sqrt(d1 * d1 - s0 * s1)
    t = t1 - (t1 - t0) * (s1 + d2 - d1) / (s1 - s0 + 2 * d2)
    least, most = t0 + 0.1 * (t1 - t0), t0 + 0.9 * (t1 - t0)
    return least if t < least else most if t > most else t


def _strong_wolfe(phi: Callable, t: float) -> Steps:
    """Step length by the strong Wolfe conditions; `phi` is a generator function of the length that returns (value, slope)."""
    value, slope = yield from phi(0.0)
    low = (0.0, value, slope)
    if slope > 0:
        raise StepFailed("not a descent")

    def zoom(low: tuple, high: tuple) -> Steps:
        for _ in range(10):
            t = _between(low, high)
            here = (t, *(yield from phi(t)))
            if here[1] > value + 1e-4 * t * slope or here[1] >= low[1]:
                high = here
                continue
            if abs(here[2]) <= 0.9 * abs(slope):
                return t
            if here[2] * (high[0] - low[0]) >= 0:
                high = low
            low = here
        raise StepFailed("zoom")

    for i in range(10):
        here = (t, *(yield from phi(t)))
        if not np.isfinite(here[1]):
            t /= 2
            continue
        if here[1] > value + 1e-4 * t * slope or (here[1] >= low[1] and i > 0):
            return (yield from zoom(low, here))
        if abs(here[2]) <= 0.9 * abs(slope):
            return t
        if here[2] >= 0:
            return (yield from zoom(here, low))
        low, t = here, t * 1.5
    raise StepFailed("line search")


def _backtracking(phi: Callable, t: float, first: float, shrink: float) -> Steps:
    """Step length by shrinking and growing; `first` stands for the value at the first length."""
    value, slope = yield from phi(0.0)
    _, here = yield from phi(t)
    there = first
    for _ in range(20):
        if there > value + t * slope * 1e-4:
            factor = shrink
        elif here < 0.9 * slope:
            factor = 2.1
        elif here > -0.9 * slope:
            factor = shrink
        else:
            return t
        last, t = t, t * factor
        if t < 1e-10 or t > 1e10:
            raise StepFailed("step size")
        there, here = yield from phi(t)
    return last


def minimise(start: np.ndarray, l1: np.ndarray | None, stops: Iterable[int]) -> Steps:
    """Descend from `start`; what is returned is the point after each number of rounds in `stops`, or the last before it.

    `l1` has the weight of each coordinate's absolute value.
    """
    stops, known = sorted(set(stops)), None

    def at(x: np.ndarray) -> Steps:
        nonlocal known
        if known is None or not np.array_equal(known[0], x):
            known = (x, *(yield x))
        return known[1:]

    def adjusted(x: np.ndarray, value: float, gradient: np.ndarray) -> tuple[float, np.ndarray]:
        if l1 is None:
            return value, gradient
        up, down = gradient + l1, gradient - l1
        at_zero = np.where(down > 0, down, np.where(up < 0, up, 0.0))
        return value + np.abs(l1 * x).sum(), np.where(x != 0, gradient + np.sign(x) * l1, at_zero)

    def moved(x: np.ndarray, slope: np.ndarray, direction: np.ndarray, t: float) -> np.ndarray:
        stepped = x + direction * t
        if l1 is None:
            return stepped
        return np.where(np.sign(stepped) == np.where(x != 0, np.sign(x), np.sign(-slope)), stepped, 0.0)

    def step() -> Steps:
        direction = _direction(history, slope)
        if l1 is not None:
            direction = np.where(direction * slope < 0, direction, 0.0)

        def phi(t: float) -> Steps:
            there = moved(x, slope, direction, t)
            found, way = adjusted(there, *(yield from at(there)))
            return found, way @ direction

        if l1 is not None:
            t = yield from _backtracking(phi, 0.5 / np.linalg.norm(gradient) if rounds < 1 else 1.0, value, 0.1 if rounds < 1 else 0.5)
        else:
            t = yield from _strong_wolfe(phi, 1.0 / np.linalg.norm(direction) if rounds == 0 else 1.0)
            if t * np.linalg.norm(gradient) < 1e-10:
                raise StepFailed("step size")
        return moved(x, slope, direction, t)

    x, rounds, history, values, found = start, 0, [], [np.inf], {}
    failed = given_up = False
    value, gradient = yield from at(x)
    total, slope = adjusted(x, value, gradient)
    scale = abs(total)
    while True:
        still = len(values) > 1 and abs(total - max(values)) <= TOLERANCE * scale
        ended = given_up or still or rounds >= stops[-1] or np.linalg.norm(slope) <= max(TOLERANCE * abs(total), 1e-8)
        found |= {stop: x for stop in stops if stop not in found and (ended or rounds >= stop)}
        if ended:
            return found
        try:
            new = yield from step()
        except StepFailed:
            failed, given_up, history = True, failed, []
            continue
        new_value, new_gradient = yield from at(new)
        history = [(new - x, new_gradient - gradient), *history][:MEMORY]
        x, value, gradient, rounds, failed = new, new_value, new_gradient, rounds + 1, False
        total, slope = adjusted(x, value, gradient)
        values = [*values, total][-VALUES:]


# Blocks of rows


def row_blocks(rows: DataFrame, features: int) -> DataFrame:
    """`rows` (label, fold, features) in stored blocks that are CELLS numbers when dense."""
    ship(rows.sparkSession)
    most = max(1, CELLS // features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, len(batch), most):
                part = batch.slice(begin, most)
                label, fold, places, numbers = part.columns
                arrays = [label, fold, pc.list_value_length(places), places.flatten(), numbers.flatten()]
                kinds = [np.float64, np.int32, np.int32, np.int32, np.float64]
                cells = [x.to_numpy(zero_copy_only=False).astype(kind, copy=False).tobytes() for x, kind in zip(arrays, kinds)]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in cells], BLOCK.replace(" binary", "").split(", "))

    vector = rows.select("label", "fold", F.unwrap_udt("features").alias("v"))
    places = F.when(F.col("v.type") == 1, F.sequence(F.lit(0), F.size("v.values") - 1)).otherwise(F.col("v.indices"))
    columns = spread(vector.select(F.col("label").cast("double"), F.col("fold").cast("int"), places.alias("places"), F.col("v.values").alias("numbers")))
    return stored(columns.mapInArrow(run, BLOCK), "row-blocks")


def _read(block: Iterable) -> tuple[np.ndarray, ...]:
    kinds = (np.float64, np.int32, np.int32, np.int32, np.float64)
    return tuple(np.frombuffer(cell, kind) for cell, kind in zip(block, kinds))


def _dense(lengths: np.ndarray, places: np.ndarray, numbers: np.ndarray, features: int) -> np.ndarray:
    x = np.zeros((len(lengths), features))
    x[np.repeat(np.arange(len(lengths)), lengths), places] = numbers
    return x


def _summed(blocks: RDD, part: Callable, add: Callable):
    """`part` of the blocks of each task, which may be None, added up."""
    parts = blocks.mapPartitions(lambda rows: [found] if (found := part(rows)) is not None else [])
    return parts.treeReduce(add, depth=1 if parts.getNumPartitions() <= TASKS else 2)


# Moments of the features in each fold


@dataclass(frozen=True)
class Moments:
    """Of the features over some rows: how many are not zero, and the mean, squared deviations, least and greatest of those."""

    rows: int
    ones: int
    count: np.ndarray
    mean: np.ndarray
    squares: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        count = self.count + other.count
        share = other.count / np.maximum(count, 1)
        apart = other.mean - self.mean
        mean = self.mean + apart * share
        squares = self.squares + other.squares + apart * apart * self.count * share
        return Moments(self.rows + other.rows, self.ones + other.ones, count, mean, squares, np.minimum(self.least, other.least), np.maximum(self.most, other.most)).exact()

    def exact(self) -> Moments:
        """Features of one value deviate by nothing, whatever the rounding."""
        same = self.least == self.most
        return Moments(self.rows, self.ones, self.count, np.where(same, self.least, self.mean), np.where(same, 0.0, self.squares), self.least, self.most)

    def means(self) -> np.ndarray:
        return self.mean * (self.count / self.rows)

    def scales(self) -> np.ndarray:
        """1 / standard deviation over the rows, zeros counted; 0 for constant features."""
        squares = self.squares + self.mean * self.mean * self.count * (self.rows - self.count) / self.rows
        deviations = np.sqrt(np.maximum(squares / max(self.rows - 1, 1), 0.0))
        return np.divide(1.0, deviations, out=np.zeros_like(deviations), where=deviations != 0)


def _moments(label: np.ndarray, x: np.ndarray) -> Moments:
    there = x != 0
    count = there.sum(axis=0).astype(float)
    mean = x.sum(axis=0) / np.maximum(count, 1)
    squares = (np.where(there, x - mean, 0.0) ** 2).sum(axis=0)
    least, most = np.where(there, x, np.inf).min(axis=0), np.where(there, x, -np.inf).max(axis=0)
    return Moments(len(label), int((label > 0).sum()), count, mean, squares, least, most).exact()


def fold_moments(blocks: RDD, features: int) -> dict[int, Moments]:
    def add(a: dict[int, Moments], b: dict[int, Moments]) -> dict[int, Moments]:
        return {k: a[k] + b[k] if k in a and k in b else a.get(k) or b[k] for k in {**a, **b}}

    def part(rows: Iterable) -> dict[int, Moments] | None:
        found = None
        for block in rows:
            label, fold, *terms = _read(block)
            x = _dense(*terms, features)
            own = {int(k): _moments(label[fold == k], x[fold == k]) for k in np.unique(fold)}
            found = own if found is None else add(found, own)
        return found

    return _summed(blocks, part, add)


# Fits


def loss_and_gradient(blocks: RDD, features: int, weights: np.ndarray, starts: np.ndarray, folds: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sums over the rows outside each descent's fold: log loss, residuals, and residuals by feature (features x descents)."""
    sent = blocks.context.broadcast((weights, starts, folds))

    def part(rows: Iterable) -> tuple[np.ndarray, ...] | None:
        weights, starts, folds = sent.value
        found = None
        for block in rows:
            label, fold, *terms = _read(block)
            x, ones, inside = _dense(*terms, features), label[:, None] > 0, fold[:, None] != folds
            with np.errstate(over="ignore"):
                margins = x @ weights + starts
                rest = np.where(inside, 1 / (1 + np.exp(-margins)) - ones, 0.0)
                loss = np.where(inside, np.logaddexp(0.0, np.where(ones, -margins, margins)), 0.0)
            own = (loss.sum(axis=0), rest.sum(axis=0), x.T @ rest)
            found = own if found is None else tuple(a + b for a, b in zip(found, own))
        return found

    try:
        return _summed(blocks, part, lambda a, b: tuple(x + y for x, y in zip(a, b)))
    finally:
        sent.destroy()


def fitted(blocks: RDD, features: int, moments: dict[int, Moments], descents: dict[Descent, Iterable[int]]) -> dict[tuple[Descent, int], tuple[np.ndarray, float]]:
    """Coefficients and intercept of each descent after each number of rounds that is asked for."""
    outside = {}
    for left_out in {d.fold for d in descents}:
        parts = [m for fold, m in sorted(moments.items()) if fold != left_out]
        outside[left_out] = sum(parts[1:], parts[0])
    scales = {fold: m.scales() for fold, m in outside.items()}
    centres = {fold: m.means() * scales[fold] for fold, m in outside.items()}

    def plain(descent: Descent, x: np.ndarray) -> tuple[np.ndarray, float]:
        """Coefficients of the features as they are, and the intercept."""
        return x[:-1] * scales[descent.fold], x[-1] - x[:-1] @ centres[descent.fold]

    running, asked, found = {}, {}, {}

    def go(descent: Descent, answer: tuple[float, np.ndarray] | None) -> None:
        try:
            asked[descent] = running[descent].send(answer)
        except StopIteration as end:
            del running[descent]
            asked.pop(descent, None)
            found.update({(descent, rounds): plain(descent, x) for rounds, x in end.value.items()})

    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for descent, stops in descents.items():
            rows = outside[descent.fold]
            start = np.append(np.zeros(features), np.log(rows.ones / (rows.rows - rows.ones)))
            running[descent] = minimise(start, np.append(np.full(features, descent.l1), 0.0) if descent.l1 else None, stops)
            go(descent, None)
        while running:
            now = list(running)
            models = [plain(d, asked[d]) for d in now]
            weights, starts = np.column_stack([w for w, _ in models]), np.array([s for _, s in models])
            losses, rests, by_feature = loss_and_gradient(blocks, features, weights, starts, np.array([d.fold for d in now], np.int32))
            for k, d in enumerate(now):
                n, w = outside[d.fold].rows, asked[d][:-1]
                gradient = (by_feature[:, k] * scales[d.fold] - rests[k] * centres[d.fold]) / n + d.l2 * w
                go(d, (losses[k] / n + d.l2 / 2 * (w @ w), np.append(gradient, rests[k] / n)))
    return found


def held_out_areas(blocks: DataFrame, models: list[tuple[int, np.ndarray, float]]) -> dict[int, float]:
    """Area under ROC of each model (fold, coefficients, intercept) on the rows of its fold, by its place in the list."""
    by_fold: dict[int, list[int]] = {}
    for k, (fold, _, _) in enumerate(models):
        by_fold.setdefault(fold, []).append(k)
    sent = blocks.sparkSession.sparkContext.broadcast({f: (ks, np.column_stack([models[k][1] for k in ks]), np.array([models[k][2] for k in ks])) for f, ks in by_fold.items()})

    def scores(lengths: np.ndarray, places: np.ndarray, numbers: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Row by row in the order of the terms, so that equal rows score the same wherever they stand."""
        found, some = np.zeros((len(lengths), weights.shape[1])), lengths > 0
        begins = (np.cumsum(lengths) - lengths)[some]
        wide = max(1, 8 * CELLS // max(1, len(places)))
        for k in range(0, weights.shape[1], wide) if len(places) else ():
            found[some, k : k + wide] = np.add.reduceat(numbers[:, None] * weights[places, k : k + wide], begins, axis=0)
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in zip(*(column.to_pylist() for column in batch.columns)):
                label, fold, lengths, places, numbers = _read(block)
                of_term = np.repeat(fold, lengths)
                for k in np.intersect1d(fold, list(sent.value)):
                    names, weights, starts = sent.value[int(k)]
                    own = fold == k
                    found = scores(lengths[own], places[of_term == k], numbers[of_term == k], weights) + starts
                    rows = [np.tile(np.array(names, np.int32), len(found)), np.repeat(label[own], len(names)), found.ravel()]
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in rows], ["model", "label", "score"])

    scored = blocks.mapInArrow(run, "model int, label double, score double")
    areas = {r["model"]: r["area_under_roc"] for r in area_under_roc(scored, "label", "score", "model").collect()}
    sent.destroy()
    return areas


def joint_areas(rows: DataFrame, fits: dict[tuple[Descent, int], object], features: int) -> Iterator[dict]:
    """Area under ROC on the fold that each fit (descent, rounds) leaves out of `rows` (label, fold, features), by what stands for the fit.

    A dictionary comes for each group of descents as it is done. Every fold needs both classes, on either side.
    """
    if not fits:
        return
    blocks = row_blocks(rows, features)
    read = blocks.rdd
    moments = fold_moments(read, features)
    stops: dict[Descent, list[int]] = {}
    for descent, rounds in fits:
        stops.setdefault(descent, []).append(rounds)
    order, wide = list(stops), max(1, COEFFICIENTS // (features + 1))
    for begin in range(0, len(order), wide):
        models = fitted(read, features, moments, {d: stops[d] for d in order[begin : begin + wide]})
        places = list(models)
        areas = held_out_areas(blocks, [(d.fold, *models[d, rounds]) for d, rounds in places])
        yield {fits[place]: areas[k] for k, place in enumerate(places)}
