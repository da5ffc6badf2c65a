"""The newest row of every key, kept up to date while records stream in.

The table is cut into hash buckets of the key. A micro-batch is reduced to its
newest rows, and these are written into a folder of the batch, by bucket. Every
`FAN_IN` parts of a bucket that stand for as many batches each are merged into
one by the last of them, so a row is written anew as often as the logarithm of
the number of batches, and readers merge a bounded number of parts. A manifest
per batch says which folders hold each bucket; it is committed last and at once.
So a replayed batch changes nothing, a batch that died half-way leaves the table
as it was, and readers see whole states only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfmark.functions.codec import parse_lines
from shelfmark.streaming.manifest import Manifests

BUCKETS = 64
#: Parts of a bucket, of equal weight, that become one.
FAN_IN = 8
_ORDER = ("_batch", "_deleted", "_text")


class MergedTable:
    """A table under `root`: one row per `key`, that with the greatest `newest` columns.

    Of rows equal in those the later batch wins, inside a batch a deletion, and
    then the greatest row, so the outcome never depends on the order in which
    tasks ran. `deleted` names a boolean column: a row that has it true deletes
    its key, until a newer row comes. Rows without a key are copies of nothing
    and are all kept. `buckets` is fixed by the first batch: about the size of
    the table over what one task should rewrite.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "id", newest: tuple[str, ...] = ("timestamp",),
                 deleted: str | None = None, buckets: int = BUCKETS):
        self.spark, self.root = spark, root.rstrip("/")
        self.key, self.newest, self.deleted, self.buckets = key, newest, deleted, buckets
        self.manifests = Manifests(spark, self.root)

    def _stored(self, rows: DataFrame, batch_id: int) -> DataFrame:
        """Rows of a batch with the columns that the table keeps besides theirs."""
        gone = F.coalesce(F.col(self.deleted), F.lit(False)) if self.deleted else F.lit(False)
        text = F.to_json(F.struct(*rows.columns))
        spread = F.coalesce(F.xxhash64(self.key), F.lit(0))
        own = F.when(F.col(self.key).isNull(), F.xxhash64(text)).otherwise(spread)
        return rows.withColumns({
            "_batch": F.lit(batch_id).cast("long"), "_deleted": gone, "_text": F.md5(text),
            "_bucket": F.pmod(own, F.lit(self.buckets)).cast("int"),
        })

    def _newest(self, rows: DataFrame) -> DataFrame:
        """One row per key; partial aggregation reduces a key's copies before the shuffle."""
        keyed = rows.where(F.col(self.key).isNotNull()).groupBy("_bucket", self.key).agg(
            F.max_by(F.struct(*rows.columns), F.struct(*self.newest, *_ORDER)).alias("row")
        )
        return keyed.select("row.*").unionByName(rows.where(F.col(self.key).isNull()))

    def _parts(self, state: dict, bucket: str) -> list[list[int]]:
        """[batch, weight] of the folders that hold a bucket, the newest last; the weight is the batches it stands for."""
        if bucket not in state["versions"]:
            return []
        return [*state.get("earlier", {}).get(bucket, []), [state["versions"][bucket], state.get("weights", {}).get(bucket, 1)]]

    def _read(self, spark: SparkSession, state: dict, parts: dict[str, list[list[int]]]) -> DataFrame | None:
        """The rows of some parts of buckets."""
        paths = [f"{self.root}/data/batch={v}/_bucket={b}" for b in sorted(parts) for v, _ in parts[b]]
        if not paths:
            return None
        schema = T.StructType.fromJson(state["schema"])
        return spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths).select(*schema.names)

    def merge(self, rows: DataFrame, batch_id: int) -> None:
        """Take in one batch; a batch that was committed before, or one older than that, changes nothing."""
        latest = self.manifests.latest()
        if latest and latest[0] >= batch_id:
            return
        state = latest[1] if latest else {"versions": {}, "buckets": self.buckets}
        if state["buckets"] != self.buckets:
            raise ValueError(f"the table has {state['buckets']} buckets")
        stored = self._stored(rows, batch_id)
        if "schema" in state and T.StructType.fromJson(state["schema"]) != _nullable(stored.schema):
            raise ValueError("the batch has other columns than the table")
        reduced = self._newest(stored).persist()
        try:
            touched = {r._bucket for r in reduced.select("_bucket").distinct().collect()}  # at most `buckets` numbers
            held = {str(b): self._parts(state, str(b)) for b in touched}
            joined = {b: _joined(parts) for b, parts in held.items()}
            before = self._read(rows.sparkSession, state, {b: held[b][-k:] for b, (k, _) in joined.items() if k})
            merged = reduced if before is None else self._newest(before.unionByName(reduced))
            if touched:
                # a batch alone is not shuffled again, and has as many writers as buckets, since each makes a file
                # per bucket; merged parts are balanced by bytes: a large bucket is several tasks' work and several files
                out = merged.coalesce(self.buckets) if before is None else merged.hint("rebalance", "_bucket")
                out.write.mode("overwrite").partitionBy("_bucket").parquet(f"{self.root}/data/batch={batch_id}")
        finally:
            reduced.unpersist()
        self.manifests.commit(batch_id, {
            "versions": state["versions"] | {b: batch_id for b in held},
            "weights": state.get("weights", {}) | {b: weight for b, (_, weight) in joined.items()},
            "earlier": state.get("earlier", {}) | {b: parts[: len(parts) - joined[b][0]] for b, parts in held.items()},
            "buckets": self.buckets, "schema": state.get("schema") or _nullable(stored.schema).jsonValue(),
        })

    def rows(self, batch_id: int | None = None) -> DataFrame | None:
        """The table after the last committed batch, or after `batch_id`; None before the first one."""
        if batch_id is None:
            latest = self.manifests.latest()
            state = latest[1] if latest else None
        else:
            state = self.manifests.get(batch_id)
        parts = {b: self._parts(state, b) for b in state["versions"]} if state else {}
        several = {b: found for b, found in parts.items() if len(found) > 1}
        single = self._read(self.spark, state, {b: found for b, found in parts.items() if b not in several})
        merged = self._read(self.spark, state, several)
        found = single
        if merged is not None:
            found = self._newest(merged) if single is None else single.unionByName(self._newest(merged))
        if found is None:
            return None
        kept = found.where("NOT _deleted").drop("_batch", "_deleted", "_text", "_bucket")
        return kept.drop(self.deleted) if self.deleted else kept

    def vacuum(self, keep: int = 2) -> list[int]:
        """Remove the folders that none of the newest `keep` states uses; gives the batches removed."""
        numbers = self.manifests.numbers()
        states = [self.manifests.get(n) for n in numbers[-keep:]]
        held = {v for state in states for b in state["versions"] for v, _ in self._parts(state, b)}
        found = [int(n.split("=")[1]) for n in self.manifests.store.names("data") if n.startswith("batch=")]
        unused = [b for b in found if b not in held and numbers and b <= numbers[-1]]
        for batch in unused:
            self.manifests.store.remove(f"data/batch={batch}")
        return unused


def _joined(parts: list[list[int]]) -> tuple[int, int]:
    """How many of the last parts a new one is merged with, and the weight of what comes out."""
    taken, weight, others = 0, 1, FAN_IN - 1
    while len(parts) - taken >= others and all(w == weight for _, w in parts[len(parts) - taken - others : len(parts) - taken]):
        taken, weight = taken + others, weight * FAN_IN
    return taken, weight


def _nullable(schema: T.StructType) -> T.StructType:
    """The schema as files give it back: everything may be NULL, nothing carries metadata."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def parse_records(records: DataFrame) -> DataFrame:
    """Typed rows of (key, value, timestamp) records; one without a value deletes the row whose id is its key."""
    parsed = parse_lines(records, keep=("key", "value", "timestamp"))
    gone = F.col("value").isNull() & F.col("key").isNotNull()
    own = F.when(gone, F.col("key").cast("string").try_cast("int")).otherwise(F.col("id"))
    return parsed.withColumns({"id": own, "deleted": gone}).drop("key", "value")


def start_merge(lines: DataFrame, table: MergedTable, checkpoint: str, every: str | None) -> StreamingQuery:
    """Merge every micro-batch of line records into `table`; `every=None` takes what is there and ends.

    `lines` has `value` and `timestamp`, and `key` if records may delete; then
    `table` must be told that `deleted` is the column that says so.
    """
    rows = parse_records(lines) if "key" in lines.columns else parse_lines(lines, keep=("timestamp",))
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(table.merge)
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return writer.trigger(**trigger).start()


def merge_available(lines: DataFrame, table: MergedTable, checkpoint: str) -> None:
    """Merge all that is there and return when the last batch is committed."""
    start_merge(lines, table, checkpoint, None).awaitTermination()
