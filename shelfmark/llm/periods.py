"""Periodic runs of words: maximal stretches that repeat one block at least four times.

For a period q, words q apart are compared on the grid 0, q, 2q, ...: a stretch
of 4q words or more holds four grid words, so three neighbouring pairs are
equal. Summed over all periods the grids have n log n pairs. Where they agree,
the longest common extensions forward and backward give the whole stretch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.batches import append_columns
from shelfmark.llm.lce import Extensions
from shelfmark.llm.tokens import parts, word_numbers

MIN_EXPONENT = 4
MIN_LENGTH = 6
#: Grid pairs extended at once.
PAIRS = 1 << 18
FOUND = "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def _grid(numbers: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """(positions, period) whose grid pairs may lie in a stretch; texts are in order of falling size."""
    longest = int(sizes[0]) if len(sizes) else 0
    for q in range(1, longest // MIN_EXPONENT + 1):
        texts = np.searchsorted(-sizes, -MIN_EXPONENT * q, side="right")
        end = starts[texts - 1] + sizes[texts - 1]
        grid = numbers[:end:q]
        same = grid[1:] == grid[:-1]
        at = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * q
        # what lies between three equal pairs of a stretch is equal too
        for offset in (q // 2, q + q // 3, 2 * q - 1):
            if len(at):
                at = at[numbers[at + offset] == numbers[at + offset + q]]
        if len(at):
            yield at, q


def stretches(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each text of word numbers its runs (start, length, period), by start, then period."""
    sizes = np.array([len(t) for t in texts])
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= max(MIN_LENGTH, MIN_EXPONENT)]
    empty = [np.zeros((0, 3), np.int64)] * len(texts)
    if not len(order):
        return empty
    numbers, starts = _joined([texts[i] for i in order])
    touched, total = np.zeros(len(order), bool), 0
    for at, q in _grid(numbers, starts, sizes[order]):
        touched[np.searchsorted(starts, at, side="right") - 1] = True
        total += len(at)
        if total > PAIRS:
            touched[:] = True  # dense: not looked through to the end before it is extended
            break
    chosen = np.flatnonzero(touched)
    out = list(empty)
    if not len(chosen):
        return out
    numbers, starts = _joined([texts[i] for i in order[chosen]])
    own = sizes[order][chosen]
    forward = Extensions(numbers)
    # each text ends in a number of its own in both directions
    backward = Extensions(np.append(numbers[-2::-1], numbers[-1] + 1))
    last = len(numbers) - 2
    found = np.zeros((0, 3), np.int64)
    pending: list[np.ndarray] = []
    waiting, most = 0, 1 << 10

    def extend():
        nonlocal found, pending
        pairs = np.concatenate(pending)
        pending = []
        for k in range(0, len(pairs), PAIRS):
            i, q = pairs[k : k + PAIRS].T
            ahead = forward(i, i + q)
            first = i.copy()
            inner = np.flatnonzero(i > 0)
            first[inner] -= backward(last - (i[inner] - 1), last - (i[inner] + q[inner] - 1))
            length = i + q + ahead - first
            long = length >= np.maximum(MIN_LENGTH, MIN_EXPONENT * q)
            new = np.stack([first[long], length[long], q[long]], axis=1)
            found = _least_periods(np.concatenate([found, new]))

    for at, q in _grid(numbers, starts, own):
        if len(found):  # a multiple of a known run's period gives that run again
            run = found[np.maximum(np.searchsorted(found[:, 0], at, side="right") - 1, 0)]
            inside = (run[:, 0] <= at) & (at + 3 * q < run[:, 0] + run[:, 1]) & (q % run[:, 2] == 0)
            at = at[~inside]
        pending.append(np.stack([at, np.full(len(at), q)], axis=1))
        waiting += len(at)
        if waiting >= most:
            extend()
            waiting, most = 0, min(2 * most, PAIRS)
    if pending:
        extend()
    text = np.searchsorted(starts, found[:, 0], side="right") - 1
    found[:, 0] -= starts[text]
    for t, i in enumerate(order[chosen]):
        mine = found[text == t]
        out[i] = mine[np.lexsort((mine[:, 2], mine[:, 0]))]
    return out


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one row, each followed by a number of its own, and where each starts."""
    top = max(int(t.max(initial=0)) for t in texts) + 1
    numbers = np.concatenate([np.append(t, top + i) for i, t in enumerate(texts)]).astype(np.int64)
    return numbers, np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]


def _least_periods(rows: np.ndarray) -> np.ndarray:
    """One row of each (start, length): that of the least period, of which the other periods are multiples."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[new]


def dropped(size: int, runs: np.ndarray) -> np.ndarray:
    """Which of `size` words lie in a run after its first period."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def find_runs(docs: DataFrame, text_col: str = "text", keep=None) -> DataFrame:
    """`docs` with `FOUND`: the runs of each text by start and period, and the text without repeated blocks.

    Words are what ASCII white space parts. A run is a stretch of `MIN_LENGTH`
    words or more and four periods or more that no neighbouring word extends;
    its period is the smallest. `collapsed` joins by one space the words that no
    run contains after its first period. Null, empty and blank texts have no
    words, no runs and an empty `collapsed`; every row stays a row, repeated ids
    too; an input column with the name of a new one is replaced by it. A text is
    treated whole, however long: it is held as one number per word.
    """

    def make(piece):
        raws = [(t or "").encode("utf-8", "surrogatepass") for t in piece.column("__text").to_pylist()]
        known: dict[bytes, int] = {}
        texts = [word_numbers(raw, known) for raw in raws]
        names = list(known)
        runs, collapsed = stretches(texts), []
        for raw, words, found in zip(raws, texts, runs):
            if len(found):
                words = words[~dropped(len(words), found)]
                collapsed.append(b" ".join([names[i] for i in words.tolist()]))
            else:
                collapsed.append(b" ".join(w for part in parts(raw) if (w := b" ".join(part.split()))))
        flat = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
        rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
        ends = np.cumsum([0] + [len(r) for r in runs]).astype(np.int32)
        return [pa.ListArray.from_arrays(pa.array(ends), rows), pa.array([c.decode("utf-8", "surrogatepass") for c in collapsed], pa.string())]

    return append_columns(docs, text_col, FOUND, make, keep)


def repeated(doc_id: Column, text: Column) -> Column:
    """`text`, or for a tenth of the ids its words with one block of them repeated to the end.

    Which block is told by the crc32 of the id; a null id changes nothing.
    """
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    every = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def spelled(words: Column) -> Column:
        n = F.size(words)
        a = (g % n).cast("int")
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8)).cast("int")
        source = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when(i < a, i).otherwise(a + (i - a) % p))
        # bound like `words`, and for the same reason: an expression would be worked out anew for every word
        return F.when(n > 0, F.array_join(F.transform(source, lambda i: F.get(words, i)), " ")).otherwise(text)

    bound = F.transform(F.array(every), spelled)[0]
    return F.when(h % 10 == 0, bound).otherwise(text)


def digests(found: DataFrame) -> DataFrame:
    """`found` with n_runs, the run of greatest length per period, and digests in place of runs and text."""
    spelled = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))

    def better(best: Column, r: Column) -> Column:
        # runs come by start and period, so the first of equal exponents stays
        return F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best)

    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return (
        found.withColumn("best", F.aggregate("runs", none, better))
        .withColumns({
            "n_runs": F.size("runs").cast("long"),
            "start": F.col("best.start"),
            "length": F.col("best.length"),
            "period": F.col("best.period"),
            "exponent_milli": F.expr("1000 * best.length div best.period"),
            "runs_sha256": F.sha2(F.array_join(F.transform(spelled, lambda s: F.concat(s, F.lit("\n"))), ""), 256),
            "collapsed_sha256": F.sha2("collapsed", 256),
        })
        .drop("best", "runs", "collapsed")
    )
