"""Arrow batches of texts: bounded sizes, appended columns, and checked broadcasts."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BATCH_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 1 << 20
#: Text after which a worker returns its freed memory to the system.
GIVE_BACK_BYTES = 8 << 20
#: Text that is worked on at once. Workers live on from stage to stage, so what one piece needs is what they keep.
PIECE_BYTES = 256 << 10
_shipped: set[str] = set()
_worked = 0


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given tables; the session is prepared for this package's Python from here on."""
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def prepare(spark: SparkSession) -> None:
    """Python workers find this package, and get at most `BATCH_BYTES` of text at once, however long the texts are."""
    spark.conf.set(BATCH_BYTES_KEY, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        archive = Path(tempfile.mkdtemp(prefix="shelfmark-")) / "shelfmark_package.zip"
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted((root / "shelfmark").rglob("*.py")):
                out.write(source, source.relative_to(root))
        context.addPyFile(str(archive))  # Spark hands it to every executor
        _shipped.add(context.applicationId)


def give_back() -> None:
    """Return freed memory to the system; a worker would keep the most that it ever used."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def _libc_trim():
    """glibc's way to do that; other C libraries have none."""
    import ctypes

    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return None


_trim = _libc_trim()


def pieces(batch: pa.RecordBatch, column: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of `batch` with at most `limit` bytes in `column`; a longer text is a slice alone."""
    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
    start = size = 0
    for row, length in enumerate(lengths):
        if size and size + length > limit:
            yield batch.slice(start, row - start)
            start, size = row, 0
        size += length
    if start < batch.num_rows:
        yield batch.slice(start)
    global _worked
    _worked += sum(lengths)
    if _worked >= GIVE_BACK_BYTES:
        _worked = 0
        give_back()


def append_columns(
    docs: DataFrame,
    text_col: str,
    fields: str,
    make: Callable[[pa.RecordBatch], list],
    keep: Iterable[str] | None = None,
    sized: bool = True,
) -> DataFrame:
    """`docs` with the columns of the DDL string `fields`, made from each batch by `make`.

    `keep` names the input columns that stay (all by default). An input column
    with the name of a new one is replaced by it, whatever its case. `make`
    finds the text as column `__text`, `sized` if that is to be cut into pieces.
    """
    new = StructType.fromDDL(fields)
    taken = {name.lower() for name in new.names}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in taken]
    schema = StructType([docs.schema[c] for c in kept] + new.fields)
    source = docs.select(*(F.col(f"`{c}`") for c in kept), F.col(f"`{text_col}`").alias("__text"))

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, "__text") if sized else (batch,):
                columns = [piece.column(c) for c in kept] + [
                    x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x)
                    for x in make(piece)
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(run, schema)


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """`df` marked for broadcast if it has at most `max_rows` rows, else as it is.

    The caller joins either form the same way; beyond the bound Spark shuffles.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
