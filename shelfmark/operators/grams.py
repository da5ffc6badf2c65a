"""Terms of rows counted batch by batch in Arrow: n-grams are joined and counted column-wise, never one by one."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words worked through at once; a row of more is a part of its own.
PART_WORDS = 1 << 18
#: Rows of a batch handed back, and text bytes beyond which offsets of 32 bits may not do.
OUT_ROWS, LARGE_BYTES = 1 << 16, 1 << 28


def _parts(words: pa.Array) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of parts of about `PART_WORDS` words."""
    ends = np.cumsum(_lengths(words))
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        stop = max(int(np.searchsorted(ends, before + PART_WORDS, "right")), first + 1)
        yield first, stop - first
        first = stop


def _lengths(words: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(words.value_lengths(), 0)).astype(np.int64)


def _grams(words: pa.Array, n: int) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(row, term, terms by row): the windows of `n` neighbouring words of each row, in order."""
    lengths, values = _lengths(words), words.flatten()
    if values.nbytes * n > LARGE_BYTES:
        values = values.cast(pa.large_string())
    rows = np.repeat(np.arange(len(lengths)), lengths)
    found = np.maximum(lengths - n + 1, 0)
    windows = len(values) - n + 1
    if n == 1 or windows <= 0:
        return (rows, values, found) if n == 1 else (rows[:0], values.slice(0, 0), found)
    inside = np.arange(windows) + n <= np.repeat(np.cumsum(lengths), lengths)[:windows]
    joined = pc.binary_join_element_wise(*[values.slice(k, windows) for k in range(n)], pa.scalar(" ", values.type), null_handling="skip")
    return rows[:windows][inside], joined.filter(pa.array(inside)), found


def _column(table: pa.Table, name: str) -> pa.Array:
    return pa.concat_arrays(table.column(name).chunks) if table.num_rows else pa.array([], table.schema.field(name).type)


def _counted(words: pa.Array, n: int) -> tuple[pa.Table, np.ndarray]:
    """((row, term, tf), terms by row)."""
    rows, grams, found = _grams(words, n)
    return pa.table({"row": rows, "term": grams}).group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")]), found


def _out(columns: dict[str, pa.Array]) -> Iterator[pa.RecordBatch]:
    for first in range(0, len(next(iter(columns.values()))), OUT_ROWS):
        cut = {name: column.slice(first, OUT_ROWS) for name, column in columns.items()}
        yield pa.record_batch({name: c.cast(pa.string()) if c.type == pa.large_string() else c for name, c in cut.items()})


def gram_counts(df: DataFrame, key: str, words: str, n: int = 1, min_tf: float = 1) -> DataFrame:
    """(key, term, tf) per input row; no shuffle. `min_tf` leaves out what is rare in its row: a count, or a share if below 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, size in _parts(batch.column(1)):
                part = batch.slice(first, size)
                counts, found = _counted(part.column(1), n)
                if min_tf != 1:
                    least = min_tf if min_tf >= 1 else min_tf * found[counts.column("row").to_numpy()]
                    counts = counts.filter(pa.array(counts.column("count_all").to_numpy() >= least))
                yield from _out({
                    key: part.column(0).take(_column(counts, "row")), "term": _column(counts, "term"), "tf": _column(counts, "count_all"),
                })

    field = df.select(key).schema.fields[0]
    return df.select(key, words).mapInArrow(run, f"`{key}` {field.dataType.simpleString()}, term string, tf long")


def gram_parts(df: DataFrame, words: str, n: int = 1) -> DataFrame:
    """(term, cf, df): occurrences and rows of each term in a part of a batch; a frequent term comes once per part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, size in _parts(batch.column(0)):
                counts, _ = _counted(batch.column(0).slice(first, size), n)
                sums = counts.group_by("term", use_threads=False).aggregate([("count_all", "sum"), ([], "count_all")])
                yield from _out({"term": _column(sums, "term"), "cf": _column(sums, "count_all_sum"), "df": _column(sums, "count_all")})

    return df.select(words).mapInArrow(run, "term string, cf long, df long")


def gram_stats(df: DataFrame, words: str, n: int = 1) -> DataFrame:
    """(term, cf, df): occurrences and rows per term.

    The sums of the parts are dealt by term at once: most terms occur once, so a
    table of sums in every writing task would be as large as its terms and be
    spilled.
    """
    parts = gram_parts(df, words, n).repartition("term")
    return parts.groupBy("term").agg(F.sum("cf").alias("cf"), F.sum("df").alias("df"))
