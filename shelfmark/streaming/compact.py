"""Micro-batch folders gathered into a table by day, while readers go on reading.

A trigger of five seconds leaves 17,280 folders a day. Compaction writes the
rows of finished batches into day folders of a new part and then commits a
manifest that names the parts and the last batch they cover. Readers take the
manifest's parts and the batch folders after it; before, during and after a
compaction that is the same rows. Folders that a manifest has replaced are
removed by `vacuum`, later, when no reader uses an older manifest any more.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.schema import STAMPED
from shelfmark.streaming.manifest import Manifests

_BATCH = re.compile(r"batch_(\d+)$")
DAY = "_day"


class BatchTable:
    """All rows ingested under `root`, compacted or not."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType = STAMPED, time: str = "timestamp"):
        self.spark, self.root, self.schema, self.time = spark, root.rstrip("/"), schema, time
        self.manifests = Manifests(spark, self.root)

    def _state(self) -> tuple[int, dict]:
        return self.manifests.latest() or (0, {"parts": [], "through": -1})

    def _batches(self) -> list[int]:
        """Batches whose folder is whole, in order."""
        found = [int(m[1]) for n in self.manifests.store.names() if (m := _BATCH.match(n))]
        return sorted(b for b in found if self.manifests.store.exists(f"batch_{b}/_SUCCESS"))

    def _of(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def rows(self, day: str | None = None) -> DataFrame:
        """All rows, or those of one day (`yyyy-mm-dd`); of compacted parts only that day's folders are read."""
        _, state = self._state()
        later = [f"{self.root}/batch_{b}" for b in self._batches() if b > state["through"]]
        fresh = self._of(later)
        if day is not None:
            fresh = fresh.where(F.to_date(self.time) == F.lit(day).cast("date"))
        parts = [f"{self.root}/{p}" for p in state["parts"]]
        if not parts:
            return fresh
        stored = T.StructType([*self.schema.fields, T.StructField(DAY, T.DateType())])
        old = None
        for part in parts:
            one = self.spark.read.schema(stored).parquet(part)
            one = one if day is None else one.where(F.col(DAY) == F.lit(day).cast("date"))
            old = one if old is None else old.unionByName(one)
        return old.drop(DAY).unionByName(fresh)

    def compact(self, through: int | None = None) -> int:
        """Gather the finished batches up to `through` (all by default) into one part; gives how many.

        Rows of a day are dealt to as many files as their bytes ask for, so a
        day that holds most rows is not one task's.
        """
        number, state = self._state()
        chosen = [b for b in self._batches() if b > state["through"] and (through is None or b <= through)]
        if not chosen:
            return 0
        part = f"days_{chosen[0]}_{chosen[-1]}"
        rows = self._of([f"{self.root}/batch_{b}" for b in chosen]).withColumn(DAY, F.to_date(self.time))
        rows.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(f"{self.root}/{part}")
        self.manifests.commit(number + 1, {"parts": [*state["parts"], part], "through": chosen[-1]})
        return len(chosen)

    def merge_parts(self) -> int:
        """Rewrite all parts as one, for when many compactions have left small files; gives how many there were."""
        number, state = self._state()
        if len(state["parts"]) < 2:
            return 0
        stored = T.StructType([*self.schema.fields, T.StructField(DAY, T.DateType())])
        whole = None
        for part in state["parts"]:
            one = self.spark.read.schema(stored).parquet(f"{self.root}/{part}")
            whole = one if whole is None else whole.unionByName(one)
        name = f"whole_{number + 1}"
        whole.hint("rebalance", DAY).write.mode("overwrite").partitionBy(DAY).parquet(f"{self.root}/{name}")
        self.manifests.commit(number + 1, {"parts": [name], "through": state["through"]})
        return len(state["parts"])

    def vacuum(self) -> list[str]:
        """Remove batch folders and parts that the newest manifest has replaced; gives their names."""
        _, state = self._state()
        gone = []
        for name in self.manifests.store.names():
            batch = _BATCH.match(name)
            part = re.match(r"(days|whole)_\d+", name)
            if (batch and int(batch[1]) <= state["through"]) or (part and name not in state["parts"]):
                self.manifests.store.remove(name)
                gone.append(name)
        return gone
