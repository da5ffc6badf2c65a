"""N-grams of rows and the number of rows that hold each, dealt as runs of words instead of one by one.

A term is dealt by its anchor, the least hash among the `ANCHOR` neighbouring
words inside it. Windows that follow each other mostly have the same anchor, so
they lie in the same bucket and travel as one run of words, not as a text each.
The anchor is made from the term's text alone: equal terms meet in one bucket,
and there they are compared as text. Runs of a batch are packed by bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from shelfmark.operators import grams

#: Words of an anchor; fewer make longer runs, more deal frequent words more evenly.
ANCHOR = 3
#: Words packed at once, and buckets for each partition of the shuffle: one bucket is counted at a time.
DEAL_WORDS, BUCKETS = 1 << 19, 4
_CODEC = pa.Codec("zstd", compression_level=3)
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def _hashes(words: pa.Array) -> np.ndarray:
    """A hash of each word, the same in every process."""
    coded = words.dictionary_encode()
    return pd.util.hash_array(np.array(coded.dictionary.to_pylist(), object), categorize=False)[coded.indices.to_numpy()]


def _buckets(columns: list[np.ndarray], buckets: int) -> np.ndarray:
    """The bucket of terms from the hashes of their first words, of their second, and so on."""
    size, least = min(ANCHOR, len(columns)), None
    for first in range(len(columns) - size + 1):
        mixed = columns[first] * _ODD[0]
        for k in range(1, size):
            mixed = mixed + columns[first + k] * _ODD[k]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _ODD[1]
        least = mixed if least is None else np.minimum(least, mixed)
    # the least of several hashes is small; multiplied, it is spread again
    return ((least * _ODD[0]) >> np.uint64(33)).astype(np.int64) % buckets


def _buckets_of_texts(terms: pa.Array, buckets: int) -> np.ndarray:
    """The same from the texts, for words that hold blanks or are missing."""
    split = pc.split_pattern(terms, " ")
    sizes, hashes = grams._lengths(split), _hashes(split.flatten())
    starts, out = np.cumsum(sizes) - sizes, np.zeros(len(terms), np.int64)
    for size in np.unique(sizes):
        chosen = np.flatnonzero(sizes == size)
        out[chosen] = _buckets([hashes[starts[chosen] + k] for k in range(size)], buckets)
    return out


def _schema(key: pa.DataType) -> pa.Schema:
    return pa.schema([
        ("words", pa.large_string()), ("terms", pa.list_(pa.large_string())), ("keys", pa.list_(key)), ("sizes", pa.list_(pa.int32())), ("tf", pa.list_(pa.int32())),
    ])


def _lists(starts: np.ndarray, values: pa.Array, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), values.cast(kind.value_type), type=kind)


def _packed(keys: pa.Array, words: pa.Array, n: int, buckets: int, schema: pa.Schema) -> pa.RecordBatch:
    """(bucket, size, packed): the terms of rows with their counts inside the row, as runs by bucket."""
    lengths, values = grams._lengths(words), words.flatten()
    rows, terms, found = grams._grams(words, n)
    at = np.arange(len(terms))
    counts = pa.table({"row": rows, "term": terms, "at": at}).group_by(["row", "term"], use_threads=False).aggregate([("at", "min"), ([], "count_all")])
    at, tf = counts.column("at_min").to_numpy(), counts.column("count_all").to_numpy()
    plain = values.null_count == 0 and not pc.any(pc.match_substring(values, " ")).as_py()
    if plain:
        # where each window starts among the words of all rows
        begins = at + np.repeat(np.cumsum(lengths) - lengths - (np.cumsum(found) - found), found)[at]
        hashes = _hashes(values)
        bucket = _buckets([hashes[begins + k] for k in range(n)], buckets)
    else:
        bucket = _buckets_of_texts(terms, buckets)[at]
    order = np.lexsort((at, bucket))
    bucket, at, tf = bucket[order], at[order], tf[order]
    first = np.ones(len(at), bool)
    if plain:
        begins = begins[order]
        # windows of different rows never start one word apart
        first[1:] = (begins[1:] != begins[:-1] + 1) | (bucket[1:] != bucket[:-1])
    run = np.flatnonzero(first)
    sizes = np.diff(run, append=len(at))
    used, starts = np.unique(bucket[run], return_index=True)
    ends = np.append(starts, len(run))
    if plain:
        long = sizes + n - 1
        upto = np.cumsum(long)
        taken = values.take(pa.array(np.arange(upto[-1] if len(upto) else 0) + np.repeat(begins[run] - (upto - long), long)))
        bounds = np.append(0, upto)[ends]
        joined = pc.binary_join(_lists(bounds, taken, schema.field("terms").type), pa.scalar(" ", pa.large_string()))
        texts = pa.nulls(len(used), schema.field("terms").type)
    else:
        joined = pa.nulls(len(used), pa.large_string())
        texts = _lists(ends, terms.take(pa.array(at)), schema.field("terms").type)
    made = pa.RecordBatch.from_arrays(
        [
            joined, texts, _lists(ends, keys.take(pa.array(rows[at[run]])), schema.field("keys").type),
            _lists(ends, pa.array(sizes), schema.field("sizes").type), _lists(np.append(run, len(at))[ends], pa.array(tf), schema.field("tf").type),
        ],
        schema=schema,
    )
    raw = [made.slice(i, 1).serialize() for i in range(len(used))]
    return pa.record_batch({
        "bucket": pa.array(used, pa.int32()), "size": pa.array([len(x) for x in raw], pa.int32()),
        "packed": pa.array([_CODEC.compress(x, asbytes=True) for x in raw], pa.binary()),
    })


def _counted(packed: list[tuple[int, bytes]], n: int, key: str, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """(key, term, tf, df) of the terms of one bucket."""
    read = [pa.ipc.read_record_batch(_CODEC.decompress(blob, size), schema) for size, blob in packed]
    table = pa.Table.from_batches(read, schema).combine_chunks()
    made = []
    for plain in (True, False):
        part = table.filter(pc.is_valid(table.column("words")) if plain else pc.is_null(table.column("words")))
        if part.num_rows:
            sizes = grams._column(part, "sizes").flatten().to_numpy()
            keys = grams._column(part, "keys").flatten().take(pa.array(np.repeat(np.arange(len(sizes)), sizes)))
            if plain:
                words = pc.split_pattern(grams._column(part, "words"), " ").flatten()
                terms = grams._grams(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes + n - 1)), pa.int32()), words), n)[1]
            else:
                terms = grams._column(part, "terms").flatten()
            made.append(pa.table({key: keys, "term": terms.cast(pa.large_string()), "tf": grams._column(part, "tf").flatten().cast(pa.int64())}))
    rows = pa.concat_tables(made).combine_chunks()
    numbers = grams._column(rows, "term").dictionary_encode().indices.to_numpy()
    containing = np.bincount(numbers)[numbers]
    yield from grams._out({key: grams._column(rows, key), "term": grams._column(rows, "term"), "tf": grams._column(rows, "tf"), "df": pa.array(containing, pa.int64())})


def gram_rows(df: DataFrame, key: str, words: str, n: int, buckets: int | None = None) -> DataFrame:
    """(key, term, tf, df) per input row and window of `n` words, n > 1: `df` rows hold the term; one shuffle, of words.

    A worker holds the terms of one bucket, of which there are `BUCKETS` for each shuffle partition.
    """
    buckets = buckets or BUCKETS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    field = df.select(key).schema.fields[0]
    kind = to_arrow_type(field.dataType)
    schema = _schema(kind)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, held = [], 0
        for batch in batches:
            for first, size in grams._parts(batch.column(1)):
                part = batch.slice(first, size)
                waiting.append(part)
                held += int(grams._lengths(part.column(1)).sum())
                if held >= DEAL_WORDS:
                    yield _packed(*_joined(waiting, kind), n, buckets, schema)
                    waiting, held = [], 0
        if waiting:
            yield _packed(*_joined(waiting, kind), n, buckets, schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, current = [], None
        for batch in batches:
            for bucket, size, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if bucket != current and waiting:
                    yield from _counted(waiting, n, key, schema)
                    waiting = []
                current = bucket
                waiting.append((size, blob))
        if waiting:
            yield from _counted(waiting, n, key, schema)

    dealt = df.select(key, words).mapInArrow(pack, "bucket int, size int, packed binary").repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(count, f"`{key}` {field.dataType.simpleString()}, term string, tf long, df long")


def _joined(batches: list[pa.RecordBatch], kind: pa.DataType) -> tuple[pa.Array, pa.Array]:
    return pa.concat_arrays([b.column(0) for b in batches]).cast(kind), pa.concat_arrays([b.column(1) for b in batches])
