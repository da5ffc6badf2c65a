"""Wide elastic-net fits in step: every pass over the rows serves all fits at once.

Rows are packed once, and each pass gives for the point that every fit asks for
the product of its own rows' covariances with that point; objective and gradient
follow from it, and along a line without another pass. The steps are those of
the library's regression: L-BFGS without a penalty, and its orthant-wise form
with one, ten pairs of history, and its two line searches.
"""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.session import materialize

#: Values of a packed block, fits in step (each takes about thirty vectors on the driver), and pairs of history.
BLOCK_VALUES, FITS, MEMORY = 1 << 19, 8, 10
#: Slices of the slots in which sums are added up before they reach the driver, and passes after which their shuffles are given back.
SLICES, KEPT_PASSES = 16, 1
#: Files of packed rows for each core, and bytes of their row groups.
FILES, ROW_GROUP = 8, 4 << 20
_CODEC = pa.Codec("zstd", compression_level=1)
_passes = 0
_BLOCK = pa.schema([
    ("labels", pa.list_(pa.float64())), ("lengths", pa.list_(pa.int32())), ("steps", pa.list_(pa.int32())),
    ("codes", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())),
])


class SearchFailed(Exception):
    """A step that could not be found; the history is dropped once, then the fit ends where it is."""


# Rows


@dataclass(frozen=True)
class Block:
    """Rows of one fold as sparse rows, one after the other."""

    labels: np.ndarray
    lengths: np.ndarray
    slots: np.ndarray
    values: np.ndarray

    def pack(self) -> tuple[int, bytes]:
        # values are few in kind, and slots of a row lie in order: both pack well as they are here
        coded = pa.array(self.values).dictionary_encode()
        columns = [self.labels, self.lengths, np.diff(self.slots, prepend=0), coded.indices.to_numpy(), coded.dictionary.to_numpy()]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), pa.array(c, f.type.value_type), type=f.type) for c, f in zip(columns, _BLOCK)]
        raw = pa.RecordBatch.from_arrays(lists, schema=_BLOCK).serialize()
        return len(raw), _CODEC.compress(raw, asbytes=True)

    @classmethod
    def unpack(cls, size: int, packed: bytes) -> Block:
        batch = pa.ipc.read_record_batch(_CODEC.decompress(packed, size), _BLOCK)
        labels, lengths, steps, codes, values = (batch.column(i).flatten().to_numpy() for i in range(5))
        return cls(labels, lengths, np.cumsum(steps, dtype=np.int64), values[codes])

    def times(self, points: np.ndarray) -> np.ndarray:
        """The rows times the columns of `points`."""
        out = np.empty((len(self.lengths), points.shape[1]))
        if points.shape[1] == 1:
            rows = np.repeat(np.arange(len(self.lengths)), self.lengths)
            out[:, 0] = np.bincount(rows, points[:, 0].take(self.slots) * self.values, len(self.lengths))
            return out
        ends = np.cumsum(self.lengths)
        for row, (first, last) in enumerate(zip((ends - self.lengths).tolist(), ends.tolist())):
            out[row] = self.values[first:last] @ points.take(self.slots[first:last], axis=0)
        return out

    def sums(self, weights: np.ndarray, width: int) -> np.ndarray:
        """The sum of all rows, each times its weight."""
        return np.bincount(self.slots, np.repeat(weights, self.lengths) * self.values, width)


def _sparse(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, slots, values) of stored vectors; whole ones lose their zeros."""
    kinds = batch.column(0).field("type").to_numpy(zero_copy_only=False)
    values, slots = batch.column(0).field("values"), batch.column(0).field("indices")
    if not (kinds == 1).any():
        return values.value_lengths().to_numpy(zero_copy_only=False), slots.flatten().to_numpy().astype(np.int64), values.flatten().to_numpy()
    rows = []
    for kind, own, at in zip(kinds, values, slots):
        own = own.values.to_numpy()
        at = np.flatnonzero(own) if kind == 1 else at.values.to_numpy()
        rows.append((at, own[at] if kind == 1 else own))
    return np.array([len(at) for at, _ in rows]), np.concatenate([at for at, _ in rows]).astype(np.int64), np.concatenate([own for _, own in rows])


def packed_rows(rows: DataFrame, fold: str, label: str, vectors: str = "features") -> DataFrame:
    """(fold, size, packed): the rows in blocks of one fold, written once; -1 for rows without a fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            if batch.column(0).null_count or not np.isfinite(labels).all():
                raise ValueError("a row has no vector, or a label that is no number")
            lengths, slots, values = _sparse(batch)
            if not np.isfinite(values).all():
                raise ValueError("a vector holds a value that is no number")
            of, ends = batch.column(2).to_numpy(zero_copy_only=False), np.cumsum(lengths)
            for held in np.unique(of):
                chosen = np.flatnonzero(of == held)
                upto = np.cumsum(lengths[chosen])
                for part in np.split(chosen, np.searchsorted(upto, np.arange(BLOCK_VALUES, upto[-1], BLOCK_VALUES))):
                    if len(part):
                        size = lengths[part]
                        at = np.arange(size.sum()) + np.repeat(ends[part] - np.cumsum(size), size)
                        block = Block(labels[part], size, slots[at], values[at]).pack()
                        yield pa.record_batch({"fold": pa.array([held], pa.int32()), "size": pa.array([block[0]], pa.int32()), "packed": pa.array([block[1]], pa.binary())})

    needed = rows.select(F.unwrap_udt(vectors).alias("vector"), F.col(label).cast("double").alias("label"), F.coalesce(F.col(fold).cast("int"), F.lit(-1)).alias("fold"))
    # dealt evenly and in small row groups: the slowest task of every pass is what all fits wait for
    dealt = needed.mapInArrow(run, "fold int, size int, packed binary").repartition(FILES * max(rows.sparkSession.sparkContext.defaultParallelism, 1))
    return materialize(dealt, "blocks", **{"parquet.block.size": str(ROW_GROUP)})


# Passes


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Block]]:
    for batch in batches:
        for fold, size, packed in zip(*(batch.column(i) for i in range(3))):
            yield fold.as_py(), Block.unpack(size.as_py(), packed.as_buffer())


def _sliced(name: int, table: np.ndarray) -> pa.RecordBatch:
    """A table of numbers by slot (last axis) in slices of the slots."""
    parts = [np.ascontiguousarray(p).tobytes() for p in np.array_split(table, SLICES, axis=-1)]
    return pa.record_batch({"slice": pa.array(range(SLICES), pa.int32()), "name": pa.array([name] * SLICES, pa.int32()), "numbers": pa.array(parts, pa.binary())})


def _gathered(rows: DataFrame, task: Callable, merge: Callable, shape: tuple[int, int]) -> dict[int, np.ndarray]:
    """The tables that the tasks make by name, merged slice by slice: of each, one reaches the driver, whatever the number of tasks."""
    height, schema = shape[0], "slice int, name int, numbers binary"

    def joined(batches: Iterator[pa.RecordBatch]) -> dict[tuple[int, int], np.ndarray]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for at, name, numbers in zip(*(batch.column(i) for i in range(3))):
                table = np.frombuffer(numbers.as_buffer()).reshape(height, -1)
                key = at.as_py(), name.as_py()
                found[key] = merge(found[key], table) if key in found else table.copy()
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (at, name), table in joined(batches).items():
            yield pa.record_batch({"slice": pa.array([at], pa.int32()), "name": pa.array([name], pa.int32()), "numbers": pa.array([table.tobytes()], pa.binary())})

    parts = max(rows.sparkSession.sparkContext.defaultParallelism, 1)
    made = rows.coalesce(parts).mapInArrow(task, schema).repartition(SLICES, "slice").mapInArrow(run, schema)
    found = joined(made.toArrow().to_batches())
    return {name: np.concatenate([found[at, name] for at in range(SLICES)], axis=1) for name in {name for _, name in found}}


# Rows of a table of moments: the number of rows, the label's mean and squares, and by slot the mean, squares and products with the label.
_N, _LABEL, _LABELS, _MEAN, _SQUARES, _PRODUCTS = range(6)


def _together(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The moments of two sets of rows."""
    n = one[_N] + other[_N]
    share, apart, label = one[_N] * other[_N] / n, other[_MEAN] - one[_MEAN], other[_LABEL] - one[_LABEL]
    out = one + other
    out[_LABEL], out[_MEAN] = one[_LABEL] + label * (other[_N] / n), one[_MEAN] + apart * (other[_N] / n)
    out[_LABELS] += label * label * share
    out[_SQUARES] += apart * apart * share
    out[_PRODUCTS] += apart * label * share
    return out


def fold_moments(rows: DataFrame, width: int) -> dict[int, np.ndarray]:
    """The moments of the rows of each fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for fold, block in _blocks(batches):
            n, centred = len(block.labels), block.labels - block.labels.mean()
            out = np.empty((6, width))
            out[_N], out[_LABEL], out[_LABELS] = n, block.labels.mean(), centred @ centred
            out[_MEAN] = block.sums(np.ones(n), width) / n
            off = block.values - out[_MEAN][block.slots]
            held = np.bincount(block.slots, minlength=width)
            out[_SQUARES] = np.bincount(block.slots, off * off, width) + (n - held) * out[_MEAN] ** 2
            out[_PRODUCTS] = block.sums(centred, width)
            found[fold] = _together(found[fold], out) if fold in found else out
        for fold, table in found.items():
            yield _sliced(fold, table)

    return _gathered(rows, run, _together, (6, width))


@dataclass
class Fit:
    """One fit: which rows it learns from, and their scaled moments."""

    held: int | None
    penalty: float
    n: float
    mean: np.ndarray
    inverse: np.ndarray
    label_mean: float
    label_deviation: float
    pull: np.ndarray

    @classmethod
    def of(cls, moments: dict[int, np.ndarray], held: int | None, penalty: float) -> Fit | None:
        """Without the rows of fold `held` (and those of none), or on all rows; None if there are no rows."""
        chosen = [table for fold, table in sorted(moments.items()) if held is None or fold not in (held, -1)]
        if not chosen:
            return None
        total = chosen[0]
        for table in chosen[1:]:
            total = _together(total, table)
        n = float(total[_N][0])
        deviation, label = np.sqrt(total[_SQUARES] / max(n - 1, 1)), float(np.sqrt(total[_LABELS][0] / max(n - 1, 1)))
        # what rounding leaves of a slot or label that does not vary
        deviation[deviation <= 1e-13 * np.abs(total[_MEAN])] = 0.0
        label = 0.0 if label <= 1e-13 * abs(total[_LABEL][0]) else label
        inverse = np.divide(1.0, deviation, out=np.zeros_like(deviation), where=deviation > 0)
        pull = total[_PRODUCTS] * inverse / (n * label) if label else np.zeros_like(inverse)
        return cls(held, penalty, n, total[_MEAN].copy(), inverse, float(total[_LABEL][0]), label, pull)

    def learns_from(self, fold: int) -> bool:
        return self.held is None or fold not in (self.held, -1)


def _products(rows: DataFrame, fits: list[Fit], points: list[np.ndarray]) -> list[np.ndarray]:
    """For each fit the covariances of its rows' scaled slots times its point, from one pass."""
    scaled = np.stack([fit.inverse * point for fit, point in zip(fits, points)], axis=1)
    shifts = np.array([fit.mean @ scaled[:, k] for k, fit in enumerate(fits)])
    width, count, folds = len(scaled), len(fits), [fit.held for fit in fits]
    sent = rows.sparkSession.sparkContext.broadcast((scaled, shifts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, shifts = sent.value
        out, last, chosen, own = np.zeros((count + 1, width)), None, [], points
        for fold, block in _blocks(batches):
            if fold != last:
                last, chosen = fold, [k for k, held in enumerate(folds) if held is None or fold not in (held, -1)]
                own = np.ascontiguousarray(points[:, chosen])
            if chosen:
                off = block.times(own) - shifts[chosen]
                for column, k in enumerate(chosen):
                    out[k] += block.sums(off[:, column], width)
                    out[count, k] += off[:, column].sum()
        yield _sliced(0, out)

    try:
        found = _gathered(rows, run, np.add, (count + 1, width))[0]
    finally:
        sent.destroy()
        global _passes
        _passes += 1
        if _passes % KEPT_PASSES == 0:
            # shuffle files go when the driver collects what refers to them
            rows.sparkSession.sparkContext._jvm.System.gc()
    return [(found[k] - found[count, k] * fit.mean) * fit.inverse / fit.n for k, fit in enumerate(fits)]


# Steps


class _History:
    """The last steps and the changes of the gradient with them, newest first."""

    def __init__(self, width: int):
        self.kept, self.order = np.empty((MEMORY, 2, width)), []

    def __iter__(self) -> Iterator[np.ndarray]:
        return (self.kept[at] for at in self.order)

    def __reversed__(self) -> Iterator[np.ndarray]:
        return (self.kept[at] for at in reversed(self.order))

    def add(self, step: np.ndarray, change: np.ndarray) -> None:
        at = self.order.pop() if len(self.order) == MEMORY else len(self.order)
        self.kept[at, 0], self.kept[at, 1] = step, change
        self.order.insert(0, at)


Asking = Generator[np.ndarray, np.ndarray, np.ndarray]


def _direction(gradient: np.ndarray, history: _History) -> np.ndarray:
    """The gradient turned by what the last steps tell of the curvature; the newest pair comes first."""
    out, kept, scale = gradient.copy(), [], 1.0
    for last, change in list(history)[:1]:
        along, square = last @ change, change @ change
        if along < 0 or np.isnan(along) or not square:
            raise SearchFailed
        scale = along / square
    for step, change in history:
        ratio = (step @ out) / (step @ change)
        if np.isnan(ratio):
            raise SearchFailed
        kept.append(ratio)
        out -= ratio * change
    out *= scale
    for ratio, (step, change) in zip(reversed(kept), reversed(history)):
        out += (ratio - (change @ out) / (step @ change)) * step
    return -out


def _strong_wolfe(value: float, slope: float, curvature: float, first: float) -> float:
    """The step that a line search by cubic interpolation takes on a parabola."""
    if slope > 0:
        raise SearchFailed

    def at(t: float) -> tuple[float, float, float]:
        return t, slope + t * curvature, value + t * (slope + t * curvature / 2)

    def between(left, right) -> float:
        third = left[1] + right[1] - 3 * (left[2] - right[2]) / (left[0] - right[0])
        root, span = np.sqrt(third * third - left[1] * right[1]), right[0] - left[0]
        t = right[0] - span * (right[1] + root - third) / (right[1] - left[1] + 2 * root)
        low, high = left[0] + 0.1 * span, left[0] + 0.9 * span
        return low if t < low else high if t > high else t

    def zoom(low, high) -> float:
        for _ in range(10):
            here = at(between(high, low) if low[0] > high[0] else between(low, high))
            if here[2] > value + 1e-4 * here[0] * slope or here[2] >= low[2]:
                high = here
            else:
                if abs(here[1]) <= 0.9 * abs(slope):
                    return here[0]
                if here[1] * (high[0] - low[0]) >= 0:
                    high = low
                low = here
        raise SearchFailed

    low, t = at(0.0), first
    for i in range(10):
        here = at(t)
        if not np.isfinite(here[2]):
            t /= 2.0
            continue
        if here[2] > value + 1e-4 * t * slope or (here[2] >= low[2] and i > 0):
            return zoom(low, here)
        if abs(here[1]) <= 0.9 * abs(slope):
            return t
        if here[1] >= 0:
            return zoom(here, low)
        low, t = here, t * 1.5
    raise SearchFailed


class _Steps:
    """State of a fit between two steps, and when it ends."""

    def __init__(self, pull: np.ndarray, constant: float, lasso: float, ridge: float, iterations: int, tolerance: float):
        self.pull, self.constant, self.lasso, self.ridge, self.iterations, self.tolerance = pull, constant, lasso, ridge, iterations, tolerance
        self.x, self.history, self.iteration, self.values = np.zeros_like(pull), _History(len(pull)), 0, [np.inf]
        self.value, self.gradient, self.failed = constant, -pull, False
        self.first = self.adjusted()[0]

    def objective(self, x: np.ndarray, product: np.ndarray) -> tuple[float, np.ndarray]:
        value = self.constant - self.pull @ x + (product @ x + self.ridge * (x @ x)) / 2
        return value, product - self.pull + self.ridge * x

    def adjust(self, x: np.ndarray, value: float, gradient: np.ndarray) -> tuple[float, np.ndarray]:
        """With the penalty on absolute values: at zero the gradient towards the better side, or none."""
        if not self.lasso:
            return value, gradient
        at_zero = np.where(gradient - self.lasso > 0, gradient - self.lasso, np.where(gradient + self.lasso < 0, gradient + self.lasso, 0.0))
        return value + self.lasso * np.abs(x).sum(), np.where(x == 0, at_zero, gradient + np.sign(x) * self.lasso)

    def adjusted(self) -> tuple[float, np.ndarray]:
        return self.adjust(self.x, self.value, self.gradient)

    def over(self) -> bool:
        value, gradient = self.adjusted()
        settled = len(self.values) >= 2 and abs(value - max(self.values)) <= self.tolerance * abs(self.first)
        return self.failed or self.iteration >= self.iterations or settled or np.linalg.norm(gradient) <= max(self.tolerance * abs(value), 1e-8)

    def move(self, x: np.ndarray, value: float, gradient: np.ndarray) -> None:
        self.history.add(x - self.x, gradient - self.gradient)
        self.x, self.value, self.gradient, self.iteration = x, value, gradient, self.iteration + 1
        self.values = [*self.values, value][-20:]

    def smooth(self) -> Asking:
        """One step of L-BFGS: asks for the product of the direction."""
        direction = _direction(self.gradient, self.history)
        product = yield direction
        turned = product + self.ridge * direction
        slope, curvature = self.gradient @ direction, turned @ direction
        step = _strong_wolfe(self.value, slope, curvature, 1.0 if self.iteration else 1.0 / np.linalg.norm(direction))
        if step * np.linalg.norm(self.gradient) < 1e-10:
            raise SearchFailed
        self.move(self.x + step * direction, self.value + step * (slope + step * curvature / 2), self.gradient + step * turned)

    def orthant(self) -> Asking:
        """One step of its orthant-wise form: asks for the product of each point that is tried."""
        began, adjusted = self.adjusted()
        direction = _direction(adjusted, self.history)
        direction[direction * adjusted >= 0] = 0.0
        side = np.where(self.x != 0, np.sign(self.x), np.sign(-adjusted))
        slope, before, along = adjusted @ direction, self.gradient + self.pull - self.ridge * self.x, None

        def tried(step: float) -> Generator:
            nonlocal along
            x = self.x + step * direction
            inside = np.sign(x) == side
            free = bool((inside | (x == 0)).all())
            x[~inside] = 0.0
            if free and along is not None:
                product = before + step * along
            else:
                product = yield x
                along = (product - before) / step if free else along
            value, gradient = self.objective(x, product)
            with_penalty, turned = self.adjust(x, value, gradient)
            return with_penalty, turned @ direction, x, value, gradient

        shrink = 0.5 if self.iteration else 0.1
        step, found, seen = 1.0 if self.iteration else 0.5 / np.linalg.norm(self.gradient), None, self.value
        for count in range(22):
            if seen > began + step * slope * 1e-4:
                factor = shrink
            else:
                found = found or (yield from tried(step))
                factor = 2.1 if found[1] < 0.9 * slope else shrink if found[1] > -0.9 * slope else 1.0
            if factor == 1.0:
                self.move(*found[2:])
                return
            step *= factor
            if count >= 20 or not 1e-10 <= step <= 1e10:
                raise SearchFailed
            found = yield from tried(step)
            seen = found[0]

    def run(self) -> Asking:
        again = False
        while not self.over():
            try:
                yield from self.orthant() if self.lasso else self.smooth()
                again = False
            except SearchFailed:
                self.failed, again = again, True
                self.history.order.clear()
        return self.x


# Fits


def _solved(rows: DataFrame, fits: list[Fit], line: Callable[[float], LinearRegression]) -> list[np.ndarray]:
    """The scaled coefficients of all fits, in step."""
    out, asking = [np.zeros_like(fit.mean) for fit in fits], {}

    def resume(k: int, answer: np.ndarray | None) -> None:
        try:
            asking[k] = runs[k], runs[k].send(answer)
        except StopIteration as end:
            asking.pop(k, None)
            out[k] = end.value

    runs = {}
    for k, fit in enumerate(fits):
        if fit.label_deviation:
            own = line(fit.penalty)
            strength, mixing = fit.penalty / fit.label_deviation, own.getElasticNetParam()
            runs[k] = _Steps(fit.pull, (fit.n - 1) / fit.n / 2, strength * mixing, strength * (1 - mixing), own.getMaxIter(), own.getTol()).run()
            resume(k, None)
    while asking:
        order = sorted(asking)
        answers = _products(rows, [fits[k] for k in order], [asking[k][1] for k in order])
        for k, answer in zip(order, answers):
            resume(k, answer)
    return out


def fit_all(
    rows: DataFrame, width: int, moments: dict[int, np.ndarray], jobs: Sequence[tuple[int | None, float]], line: Callable[[float], LinearRegression],
) -> list[LinearRegressionModel]:
    """The model of each (fold left out, penalty), `FITS` of them in step; no fold: on all rows."""
    models = []
    for first in range(0, len(jobs), FITS):
        part = jobs[first : first + FITS]
        # fits that leave out the same fold share its moments
        known = {held: Fit.of(moments, held, 0.0) for held in {held for held, _ in part}}
        if None in known.values():
            raise ValueError("a fit has no rows to learn from")
        fits = [replace(known[held], penalty=penalty) for held, penalty in part]
        for fit, scaled in zip(fits, _solved(rows, fits, line)):
            weights = scaled * fit.inverse * fit.label_deviation
            models.append(_model(rows, line(fit.penalty), weights, fit.label_mean - float(weights @ fit.mean)))
    return models


def _model(rows: DataFrame, line: LinearRegression, weights: np.ndarray, intercept: float) -> LinearRegressionModel:
    context = rows.sparkSession.sparkContext
    made = context._jvm.org.apache.spark.ml.regression.LinearRegressionModel(line.uid, _py2java(context, Vectors.dense(weights)), float(intercept))
    return line._copyValues(LinearRegressionModel(made))
