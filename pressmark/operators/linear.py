"""Linear classifiers for many labels and folds, all fitted by the same passes over the rows.

A problem is a label and, in validation, a fold that it does not learn from. Every problem is a support
vector machine with squared hinge loss and a penalised intercept: the weights w minimise
|w|^2 / 2 + penalty * sum(max(0, 1 - y (w x + b))^2). One pass works out loss and gradient of all
problems: tasks add up their rows, the sums are combined by blocks of terms, and only the finished
gradient reaches the driver, where each problem takes its own limited-memory quasi-Newton step. So the number of
Spark jobs is that of the slowest problem, not the sum over labels and folds.

Rows hold ``fold`` (null or -1: none), ``labels`` (ids), ``terms`` (distinct ids) and ``tf``, the last two as arrays or
packed (:func:`packed`): every pass reads them, and numbers in one piece reach the tasks as they are.
"""

from __future__ import annotations

import io
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

# tasks get these functions themselves, so workers need not be able to import this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# terms of a chunk of rows worked on at once
_CHUNK = 1 << 20
# terms whose numbers stay in a core's cache
_PIECE = 1 << 15
# so many problems fetch their weights of a term together
_WIDE = 4
# a fit to this tolerance needs no more than single precision of each value; sums are in double
_SINGLE = 1e-4
# rows with no more terms than this are sent whole to every task, and each task fits some of the problems
_WHOLE = 24 * 2**20
# bytes of weights, at most, that such tasks send to the driver
_TOGETHER = 256 * 2**20
# bytes of the state of open problems in such a task
_TASK_STATE = 96 * 2**20
_BLOCKS = 16
#: Bytes of the driver for a problem and term: 16 vectors of past steps, place, direction and trial in single precision,
#: slopes of now and of before in double, and what is sent to and comes from the tasks.
STATE_BYTES = 4 * 19 + 8 * 2 + 12


@dataclass(frozen=True)
class Problems:
    """``label`` and left-out ``fold`` (-1: none) of each problem.

    ``scales`` has a row for each of the distinct folds in ``folds``: the factor of a term's count, 0 for terms that
    the fold's training rows do not have.
    """

    label: np.ndarray
    fold: np.ndarray
    folds: np.ndarray
    scales: np.ndarray

    def only(self, chosen: np.ndarray) -> Problems:
        """Some problems, with the folds that these leave out."""
        own = np.isin(self.folds, self.fold[chosen])
        return Problems(self.label[chosen], self.fold[chosen], self.folds[own], self.scales[own])


class NotConverged(RuntimeError):
    """A fit has not reached its tolerance within its passes."""


@dataclass
class Fit:
    """Weights (a row for each problem; the intercept comes last), passes, and the gradients' lengths against the first ones."""

    weights: np.ndarray
    passes: int
    slopes: np.ndarray


def packed(lists: pa.Array) -> pa.Array:
    """A column of lists of 32-bit numbers as a column of bytes."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy()[offsets[0] : offsets[-1]].astype("<i4")
    if values.nbytes >= 2**31:
        raise ValueError("a batch holds too many terms; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    bounds = (4 * (offsets - offsets[0])).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(bounds), pa.py_buffer(values)])


def _offsets(column: pa.Array) -> np.ndarray:
    if not pa.types.is_binary(column.type):
        return column.offsets.to_numpy().astype(np.int64)
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int32, count=column.offset + len(column) + 1)
    return bounds[column.offset :].astype(np.int64) // 4


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = _offsets(column)
    if not pa.types.is_binary(column.type):
        values = column.values.to_numpy()
    else:
        data = column.buffers()[2]
        values = np.frombuffer(data, dtype="<i4", count=int(offsets[-1])) if data else np.zeros(0, dtype=np.int32)
    return values[offsets[0] : offsets[-1]], offsets - offsets[0]


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    values, offsets = _numbers(column)
    return values.astype(np.int64), offsets


def stretches(column: pa.Array) -> Iterator[slice]:
    """Runs of rows of a column of lists that hold about ``_CHUNK`` items, one row at least."""
    at = _offsets(column)
    first = 0
    while first < len(column):
        stop = max(int(np.searchsorted(at, at[first] + _CHUNK, side="right")) - 1, first + 1)
        yield slice(first, stop)
        first = stop


def counts(batches: Iterator[pa.RecordBatch], terms_n: int) -> Iterator[pa.RecordBatch]:
    """``fold``, ``i`` and ``n``: in how many of the rows of a fold a term is."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        folds = batch.column("fold").to_numpy(zero_copy_only=False)
        for place, row, terms, _ in chunks(batch):
            for fold in np.unique(folds[place]).tolist():
                own = terms[(folds[place] == fold)[row]]
                found[fold] = found.get(fold, 0) + np.bincount(own, minlength=terms_n)
    for fold, times in found.items():
        own = np.flatnonzero(times)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(own), fold), pa.int32()), pa.array(own, pa.int32()), pa.array(times[own], pa.int64())], names=["fold", "i", "n"])


def chunks(batch: pa.RecordBatch) -> Iterator[tuple[slice, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of rows: their places, and row, term and count of all their terms."""
    for place in stretches(batch.column("terms")):
        rows = place.stop - place.start
        own = batch.slice(place.start, rows)
        (terms, at), (tf, _) = _flat(own.column("terms")), _flat(own.column("tf"))
        yield place, np.repeat(np.arange(rows), np.diff(at)), terms, tf


def unit_values(row: np.ndarray, terms: np.ndarray, tf: np.ndarray, scale: np.ndarray, rows: int) -> np.ndarray:
    """Weights of terms; those of a row have length 1."""
    values = tf * scale.take(terms)
    length = np.sqrt(np.bincount(row, weights=values**2, minlength=rows))
    return values / np.where(length > 0, length, 1.0)[row]


def _marks(labels_of: pa.Array, labels: int) -> np.ndarray:
    """1 where a row has a label, else -1; a line for each label."""
    found, at = _flat(labels_of)
    marks = np.full((labels, len(labels_of)), -1, dtype=np.int8)
    marks[found, np.repeat(np.arange(len(labels_of)), np.diff(at))] = 1
    return marks


def row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of the values of each row; ``at`` are the rows' first places and the end."""
    sums, some = np.zeros(len(at) - 1), np.flatnonzero(np.diff(at))
    if len(some):
        sums[some] = np.add.reduceat(values, at[some])
    return sums


@dataclass
class Rows:
    """What passes need of rows: their folds and marks, and sums over their terms by row and by term."""

    folds: np.ndarray
    marks: np.ndarray
    shrinks: dict[int, np.ndarray] = field(default_factory=dict)

    def shrink(self, fold: int, scale: np.ndarray) -> np.ndarray:
        """What brings the weights of each row, counts times ``scale``, to length 1; worked out once for a fold."""
        if fold not in self.shrinks:
            length = self.margins((scale**2)[None, :], 2)[0]
            self.shrinks[fold] = 1.0 / np.sqrt(np.where(length > 0, length, 1.0))
        return self.shrinks[fold]

    def margins(self, tables: np.ndarray, power: int = 1, wide: np.ndarray | None = None) -> np.ndarray:
        """For each line of weights by term the sum over the counts of each row. ``wide`` is the same, a line for each term."""
        raise NotImplementedError

    def add_slopes(self, pulled: np.ndarray, slopes: np.ndarray, power: int = 1) -> None:
        """Add each row's counts times its number in a line of ``pulled`` to that line of ``slopes``."""
        raise NotImplementedError


@dataclass
class Chunk(Rows):
    """Rows with about ``_CHUNK`` terms: ``at`` are the rows' first places in ``terms`` and ``tf``, and the end."""

    at: np.ndarray = field(kw_only=True)
    terms: np.ndarray = field(kw_only=True)
    tf: np.ndarray = field(kw_only=True)

    def pieces(self) -> Iterator[tuple[slice, slice, np.ndarray]]:
        """Runs of rows whose terms stay in a core's cache: their places, those of their terms, and the bounds of their rows."""
        first, rows = 0, len(self.at) - 1
        while first < rows:
            stop = max(int(np.searchsorted(self.at, self.at[first] + _PIECE, side="right")) - 1, first + 1)
            begin, end = int(self.at[first]), int(self.at[stop])
            yield slice(first, stop), slice(begin, end), self.at[first : stop + 1] - begin
            first = stop

    def margins(self, tables: np.ndarray, power: int = 1, wide: np.ndarray | None = None) -> np.ndarray:
        terms, tf = self.terms.astype(np.intp), self.tf.astype(tables.dtype) ** power
        if wide is not None:  # a line of weights is fetched at once
            found, at = np.empty((len(self.at) - 1, len(tables)), tables.dtype), self.at.tolist()
            for row, (begin, end) in enumerate(zip(at, at[1:])):
                np.dot(tf[begin:end], wide.take(terms[begin:end], axis=0), out=found[row])
            return found.T
        found, pieces = np.empty((len(tables), len(self.at) - 1)), list(self.pieces())
        for p, table in enumerate(tables):
            for place, own, at in pieces:
                values = table.take(terms[own])
                values *= tf[own]
                found[p, place] = row_sums(values, at)
        return found

    def add_slopes(self, pulled: np.ndarray, slopes: np.ndarray, power: int = 1) -> None:
        terms, tf, pieces, lengths = self.terms.astype(np.intp), self.tf.astype(slopes.dtype) ** power, list(self.pieces()), np.diff(self.at)
        for line, slope in zip(pulled, slopes):
            for place, own, _ in pieces:
                pull, times = line[place], lengths[place]
                pulls = pull != 0
                if np.count_nonzero(pulls) * 3 < len(pulls):  # the others add nothing
                    some = np.flatnonzero(np.repeat(pulls, times))
                    np.add.at(slope, terms[own][some], np.repeat(pull[pulls], times[pulls]) * tf[own][some])
                else:
                    values = np.repeat(pull, times)
                    values *= tf[own]
                    np.add.at(slope, terms[own], values)


class Columns(Rows):
    """Rows in order of their terms: pieces with terms, how often each is there, rows and counts. Takes the chunks out of a list."""

    def __init__(self, chunks: list[Chunk]):
        super().__init__(np.concatenate([own.folds for own in chunks]), np.concatenate([own.marks for own in chunks], axis=1))
        self.pieces: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        firsts = np.cumsum([0, *(len(own.at) - 1 for own in chunks)])
        kind = np.min_scalar_type(int(firsts[-1]))
        end = max(int(own.terms.max(initial=-1)) for own in chunks) + 1
        ranges = -(-sum(len(own.terms) for own in chunks) // _CHUNK)  # so a range has about as many terms as a chunk
        edges = np.linspace(0, end, ranges + 1).astype(np.int64)
        for begin, stop in zip(edges, edges[1:]):
            found = []
            for own, first in zip(chunks, firsts):
                some = np.flatnonzero((own.terms >= begin) & (own.terms < stop))
                found.append((own.terms[some], (first + np.searchsorted(own.at, some, side="right") - 1).astype(kind), own.tf[some]))
            terms, rows, tf = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(terms, kind="stable")
            for at in range(0, len(order), _PIECE):
                own = order[at : at + _PIECE]
                some = terms[own]
                starts = np.flatnonzero(np.diff(some, prepend=-1))
                self.pieces.append((some[starts], starts.astype(np.int32), rows[own], tf[own]))
        chunks.clear()

    def margins(self, tables: np.ndarray, power: int = 1, wide: np.ndarray | None = None) -> np.ndarray:
        found = np.zeros((len(tables), len(self.folds)), tables.dtype)
        for terms, starts, rows, tf in self.pieces:
            rows, tf, times = rows.astype(np.intp), tf.astype(tables.dtype) ** power, np.diff(starts, append=len(rows))
            for table, sums in zip(tables, found):
                values = np.repeat(table[terms], times)
                values *= tf
                np.add.at(sums, rows, values)
        return found

    def add_slopes(self, pulled: np.ndarray, slopes: np.ndarray, power: int = 1) -> None:
        for terms, starts, rows, tf in self.pieces:
            rows, tf = rows.astype(np.intp), tf.astype(pulled.dtype) ** power
            for line, slope in zip(pulled, slopes):
                values = line.take(rows)
                values *= tf
                slope[terms] += np.add.reduceat(values, starts)


def chunks_of(batch: pa.RecordBatch, labels: int | None = None) -> Iterator[Chunk]:
    """Chunks of rows with ``terms`` and ``tf``; with ``labels`` also of ``fold`` and ``labels``."""
    folds = batch.column("fold").fill_null(-1).to_numpy(zero_copy_only=False) if labels is not None else None
    for place in stretches(batch.column("terms")):
        own = batch.slice(place.start, place.stop - place.start)
        (terms, at), (tf, _) = _numbers(own.column("terms")), _numbers(own.column("tf"))
        marks = None if labels is None else _marks(own.column("labels"), labels)
        yield Chunk(None if labels is None else folds[place], marks, at=at, terms=terms, tf=tf)


class Sums:
    """Losses and gradients of all problems, added up over rows. With ``squares`` lines of sums of squared values for each fold follow.

    ``number`` is the kind of the values; sums over all rows are in double.
    """

    def __init__(self, problems: Problems, weights: np.ndarray, penalty: float, squares: bool, number: type, wide: bool):
        self.problems, self.penalty, self.squares = problems, penalty, squares
        n, width = weights.shape
        self.place = np.searchsorted(problems.folds, problems.fold)
        self.intercepts = weights[:, -1:].astype(np.float64)
        self.tables = np.empty((n, width - 1), dtype=number)
        for p, k in enumerate(self.place):
            np.multiply(weights[p, :-1], problems.scales[k], out=self.tables[p], casting="same_kind")
        self.wide = np.ascontiguousarray(self.tables.T) if wide and n >= _WIDE else None
        more = len(problems.folds) if squares else 0
        self.losses, self.slopes = np.zeros(n + more), np.zeros((n + more, width))

    def add(self, own: Rows) -> None:
        problems, n = self.problems, len(self.place)
        folds = problems.folds.tolist()
        shrinks = np.stack([own.shrink(fold, problems.scales[k]) for k, fold in enumerate(folds)])
        learns = np.stack([own.folds != fold if fold >= 0 else np.ones(len(own.folds), dtype=bool) for fold in folds])
        y = own.marks[problems.label]
        margins = own.margins(self.tables, wide=self.wide) * shrinks[self.place] + self.intercepts
        slack = np.where(learns[self.place], np.maximum(0.0, 1.0 - y * margins), 0.0)
        self.losses[:n] += self.penalty * np.einsum("ij,ij->i", slack, slack)
        pull = -2.0 * self.penalty * y * slack
        self.slopes[:n, -1] += pull.sum(axis=1)
        part = np.zeros_like(self.tables)
        own.add_slopes((pull * shrinks[self.place]).astype(part.dtype), part)
        self.slopes[:n, :-1] += part
        if self.squares:
            self.slopes[n:, -1] += learns.sum(axis=1)
            own.add_slopes(learns * shrinks**2, self.slopes[n:, :-1], 2)

    def done(self) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.place)
        for p, k in enumerate(self.place):
            self.slopes[p, :-1] *= self.problems.scales[k]
        if self.squares:
            self.slopes[n:, :-1] *= self.problems.scales**2
        return self.losses, self.slopes


def _pass(
    batches: Iterator[pa.RecordBatch], problems: Problems, weights: np.ndarray, penalty: float, labels: int, squares: bool, number: type
) -> Iterator[pa.RecordBatch]:
    terms_n, total = weights.shape[1] - 1, Sums(problems, weights, penalty, squares, number, True)
    for batch in batches:
        for own in chunks_of(batch, labels):
            total.add(own)
    losses, slopes = total.done()
    blocks, places, sums = [-1], [b""], [np.concatenate((losses, slopes[:, -1])).tobytes()]
    edges = np.linspace(0, terms_n, _BLOCKS + 1).astype(np.int64)
    for b in range(_BLOCKS):
        own = edges[b] + np.flatnonzero(slopes[:, edges[b] : edges[b + 1]].any(axis=0))
        if len(own):
            blocks.append(b)
            places.append((own - edges[b]).astype(np.int32).tobytes())
            sums.append(slopes[:, own].astype(np.float32).tobytes())
    yield pa.RecordBatch.from_arrays(
        [pa.array(blocks, pa.int32()), pa.array(places, pa.binary()), pa.array(sums, pa.binary())], names=["block", "places", "sums"]
    )


def _combine(batches: Iterator[pa.RecordBatch], n: int, terms_n: int) -> Iterator[pa.RecordBatch]:
    edges = np.linspace(0, terms_n, _BLOCKS + 1).astype(np.int64)
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for i in range(batch.num_rows):
            block, places, sums = (batch.column(c)[i].as_py() for c in ("block", "places", "sums"))
            if block < 0:
                totals[block] = totals.get(block, 0) + np.frombuffer(sums)
                continue
            total = totals.setdefault(block, np.zeros((n, edges[block + 1] - edges[block])))
            at = np.frombuffer(places, dtype=np.int32)
            total[:, at] += np.frombuffer(sums, dtype=np.float32).reshape(n, len(at))
    for block, total in totals.items():
        data = total.tobytes() if block < 0 else total.astype(np.float32).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([data], pa.binary())], names=["block", "sums"])


def losses_and_slopes(
    rows: DataFrame, problems: Problems, weights: np.ndarray, penalty: float, labels: int, squares: bool = False,
    number: type = np.float64,
) -> tuple[np.ndarray, np.ndarray]:
    """Loss and gradient of every problem, penalty on the weights left out: one pass over the rows.

    With ``squares`` more rows follow: for each of the folds the sums of the squared values of its training rows.
    """
    n, terms_n = weights.shape[0] + (len(problems.folds) if squares else 0), weights.shape[1] - 1
    parts = (problems.label, problems.fold, problems.folds, problems.scales)
    shared = rows.sparkSession.sparkContext.broadcast((parts, weights))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, trial = shared.value
        return _pass(batches, Problems(*own), trial, penalty, labels, squares, number)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _combine(batches, n, terms_n)

    # sums of all problems leave every task, so there is a task a core, however many files hold the rows
    own = rows.select("fold", "labels", "terms", "tf").coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    parts = own.mapInArrow(add, "block int, places binary, sums binary")
    found = parts.repartition(_BLOCKS + 1, "block").mapInArrow(combine, "block int, sums binary").collect()
    shared.destroy()
    edges = np.linspace(0, terms_n, _BLOCKS + 1).astype(np.int64)
    losses, slopes = np.zeros(n), np.zeros((n, terms_n + 1))
    for row in found:
        if row["block"] < 0:
            both = np.frombuffer(row["sums"])
            losses, slopes[:, -1] = both[:n], both[n:]
        else:
            slopes[:, edges[row["block"]] : edges[row["block"] + 1]] = np.frombuffer(row["sums"], dtype=np.float32).reshape(n, -1)
    return losses, slopes


@dataclass
class Descent:
    """One problem on its way down by limited-memory quasi-Newton steps: place, value, slope, direction, step, and its last steps."""

    w: np.ndarray
    damping: np.ndarray
    value: float = 0.0
    slope: np.ndarray | None = None
    first: float = 0.0
    direction: np.ndarray | None = None
    step: float = 0.0
    past: list[tuple[np.ndarray, np.ndarray, float]] = field(default_factory=list)

    def trial(self) -> np.ndarray:
        return self.w if self.direction is None else self.w + np.float32(self.step) * self.direction

    def take(self, value: float, slope: np.ndarray, memory: int) -> None:
        """A trial's value and slope: go there and choose the next direction, or shorten the step.

        ``damping`` is the curvature along each coordinate where every row counts; steps start from its inverse.
        """
        if self.direction is not None:
            gain = float(np.dot(self.slope, self.direction))
            if value > self.value + 1e-4 * self.step * gain and self.step > 1e-10:
                self.step /= 4
                return
            moved, turned = np.float32(self.step) * self.direction, (slope - self.slope).astype(np.float32)
            curve = float(np.dot(moved, turned))
            if curve > 0:
                self.past = [*self.past[1 - memory :], (moved, turned, curve)]
            self.w = self.w + moved
        else:
            self.first = float(np.linalg.norm(slope))
        self.value, self.slope = value, slope
        q = slope.astype(np.float32)
        kept = []
        for moved, turned, curve in reversed(self.past):
            a = float(np.dot(moved, q)) / curve
            q = q - np.float32(a) * turned
            kept.append(a)
        q = q / self.damping
        if self.past:
            moved, turned, curve = self.past[-1]
            q = q * np.float32(curve / float(np.dot(turned, turned / self.damping)))
        for (moved, turned, curve), a in zip(self.past, reversed(kept)):
            q = q + np.float32(a - float(np.dot(turned, q)) / curve) * moved
        self.direction, self.step = -q, 1.0 if self.past else 0.25

    def ratio(self) -> float:
        return float(np.linalg.norm(self.slope)) / self.first if self.first else 0.0


def _descend(
    problems: Problems, sums: Callable[[Problems, np.ndarray, bool], tuple[np.ndarray, np.ndarray]], penalty: float,
    tolerance: float, passes: int, memory: int, held: int | None,
) -> tuple[Fit, list[int]]:
    """A fit by ``sums`` of losses and gradients, and the problems that are not done after ``passes`` passes: it ends with the first of these."""
    width = problems.scales.shape[1] + 1
    n, done = len(problems.label), 0
    weights, ratios = np.zeros((n, width), np.float32), np.zeros(n)
    states: dict[int, Descent] = {}
    begun: dict[int, int] = {}
    damping: dict[int, np.ndarray] = {}
    waiting = list(range(n))
    while states or waiting:
        late = [i for i in states if done - begun[i] == passes]
        if late:
            ratios[late] = [states[i].ratio() for i in late]
            return Fit(weights, done, ratios), late
        for i in waiting[: n if held is None else held - len(states)]:
            states[i], begun[i] = Descent(np.zeros(width, dtype=np.float32), np.ones(width, dtype=np.float32)), done
            waiting.remove(i)
        open_ones = np.array(sorted(states), dtype=np.int64)
        now = problems.only(open_ones)
        squares = any(fold not in damping for fold in now.folds.tolist())
        trial = np.stack([states[i].trial() for i in open_ones])
        losses, slopes = sums(now, trial, squares)
        if squares:
            found = (1.0 + 2.0 * penalty * slopes[len(open_ones) :]).astype(np.float32)
            damping = {fold: damping.get(fold, found[k]) for k, fold in enumerate(now.folds.tolist())}
        done += 1
        for place, i in enumerate(open_ones.tolist()):
            w = trial[place].astype(np.float64)
            states[i].damping = damping[int(problems.fold[i])]
            states[i].take(losses[place] + 0.5 * float(w @ w), slopes[place] + w, memory)
            if not states[i].ratio() > tolerance:  # its weights are all that is needed
                weights[i], ratios[i] = states[i].w, states[i].ratio()
                del states[i]
    return Fit(weights, done, ratios), []


def _to_bytes(own: Chunk) -> bytes:
    """A chunk with steps from term to term and counts in as few bytes as their largest need."""
    steps = np.diff(own.terms, prepend=np.int32(0))
    firsts = own.at[:-1][np.diff(own.at) > 0]
    steps[firsts] = own.terms[firsts]
    small = [x.astype(np.min_scalar_type(int(x.max(initial=0)))) if x.min(initial=0) >= 0 else x for x in (steps, own.tf)]
    out = io.BytesIO()
    np.savez(out, own.at, *small, own.folds.astype(np.int32), own.marks)
    return out.getvalue()


def _from_bytes(data: pa.Buffer) -> Chunk:
    with np.load(io.BytesIO(data)) as found:
        at, steps, tf, folds, marks = (found[name] for name in found.files)
    sums = np.cumsum(steps, dtype=np.int64)
    times = np.diff(at)
    before = np.concatenate(([0], sums))[at[:-1]]
    return Chunk(folds, marks, at=at, terms=(sums - np.repeat(before, times)).astype(np.int32), tf=tf)


def _fit_in_tasks(
    rows: DataFrame, problems: Problems, labels: int, penalty: float, tolerance: float, passes: int, memory: int, number: type
) -> tuple[Fit, int]:
    """As :func:`fit_together`, and how many problems are not done: all rows go to every task, once, and each fits its share of the problems."""
    spark, n, width = rows.sparkSession, len(problems.label), problems.scales.shape[1] + 1
    tasks = min(spark.sparkContext.defaultParallelism, n)
    held = max(1, _TASK_STATE // (width * STATE_BYTES))
    shared = spark.sparkContext.broadcast((problems.label, problems.fold, problems.folds, problems.scales))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in chunks_of(batch, labels):
                data = _to_bytes(own)
                both = [pa.array([len(data)], pa.int64()), pa.array([pa.compress(data, "zstd", asbytes=True)], pa.binary())]
                yield pa.RecordBatch.from_arrays(both, names=["size", "data"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every, kept, shares = Problems(*shared.value), [], []
        for batch in batches:
            for size, data, task in zip(batch.column("size").to_pylist(), batch.column("data"), batch.column("task").to_pylist()):
                if task not in shares:
                    shares.append(task)
                if task == shares[0]:  # others get the same rows
                    kept.append(_from_bytes(pa.decompress(data.as_buffer(), size, "zstd")))

        whole = [Columns(kept)] if kept else []

        def sums(now: Problems, trial: np.ndarray, squares: bool) -> tuple[np.ndarray, np.ndarray]:
            total = Sums(now, trial, penalty, squares, number, False)
            for own in whole:
                total.add(own)
            return total.done()

        for share in shares:
            own = np.arange(share, n, tasks)
            found, late = _descend(every.only(own), sums, penalty, tolerance, passes, memory, held)
            columns = [
                pa.array(own, pa.int32()), pa.array(np.full(len(own), found.passes), pa.int32()), pa.array(found.slopes),
                pa.array(np.isin(np.arange(len(own)), late)), pa.array([w.tobytes() for w in found.weights], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["problem", "passes", "slope", "late", "weights"])

    own = rows.select("fold", "labels", "terms", "tf").coalesce(spark.sparkContext.defaultParallelism)
    copies = own.mapInArrow(pack, "size long, data binary").withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    fits = copies.repartitionById(tasks, F.col("task")).mapInArrow(fit, "problem int, passes int, slope double, late boolean, weights binary")
    found = fits.toArrow()
    shared.destroy()
    weights, slopes = np.zeros((n, width), np.float32), np.zeros(n)
    place = found["problem"].to_numpy()
    slopes[place] = found["slope"].to_numpy()
    for i, data in zip(place.tolist(), found["weights"]):
        weights[i] = np.frombuffer(data.as_buffer(), dtype=np.float32)
    done = Fit(weights, int(found["passes"].to_numpy().max(initial=0)), slopes)
    return done, int(np.count_nonzero(found["late"].to_numpy(zero_copy_only=False)))


def fit_together(
    rows: DataFrame, problems: Problems, labels: int, penalty: float, tolerance: float, passes: int, memory: int = 8,
    held: int | None = None, terms: float | None = None,
) -> Fit:
    """Fit all problems, ``held`` of them at a time: one that is done makes room for the next.

    A problem is done when its gradient is ``tolerance`` times the first one. If one is not after ``passes``
    passes, :class:`NotConverged` is raised. The driver holds ``2 * memory + 3`` vectors for each open problem, then its weights.
    ``terms`` is how many terms all rows have together, if that is known: tasks fit each their share of the problems
    over all rows where these are few (``_WHOLE``), by the same steps.
    """
    n, number = len(problems.label), np.float32 if tolerance >= _SINGLE else np.float64
    if terms is not None and 0 < n and terms <= _WHOLE and 4 * n * problems.scales.shape[1] <= _TOGETHER:
        fit, late = _fit_in_tasks(rows, problems, labels, penalty, tolerance, passes, memory, number)
    else:
        def sums(now: Problems, trial: np.ndarray, squares: bool) -> tuple[np.ndarray, np.ndarray]:
            return losses_and_slopes(rows, now, trial, penalty, labels, squares, number)

        fit, found = _descend(problems, sums, penalty, tolerance, passes, memory, held)
        late = len(found)
    if late:
        raise NotConverged(f"{late} of {n} fits are not done after {passes} passes; the largest gradient left is {fit.slopes.max():.2g}")
    return fit
