"""Numbered manifests: which files make up a table, switched from one state to the next at once.

All access goes through Hadoop's file systems, as Spark's own readers and
writers do, so a root may be in any store that Spark reads.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

FOLDER = "_manifest"


class Store:
    """The few file operations that manifests need."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self.root = root.rstrip("/")
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._path("").getFileSystem(self._conf)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        """Names inside a folder; a folder that is not there has none."""
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(name))

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_once(self, name: str, text: str) -> bool:
        """Write a file that appears whole or not at all; False if the name is taken."""
        if self.exists(name):
            return False
        draft = self._path(f"{FOLDER}/.{uuid.uuid4().hex}")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        if self._fs.rename(draft, self._path(name)):
            return True
        self._fs.delete(draft, False)
        return False

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)


class Manifests:
    """States of a table by ascending number; each is a small JSON object."""

    def __init__(self, spark: SparkSession, root: str):
        self.store = Store(spark, root)

    def _name(self, number: int) -> str:
        return f"{FOLDER}/{number:012d}.json"

    def numbers(self) -> list[int]:
        return [int(n[:-5]) for n in self.store.names(FOLDER) if n.endswith(".json") and not n.startswith(".")]

    def get(self, number: int) -> dict | None:
        return json.loads(self.store.read(self._name(number))) if self.store.exists(self._name(number)) else None

    def latest(self) -> tuple[int, dict] | None:
        """The newest state and its number."""
        numbers = self.numbers()
        return (numbers[-1], self.get(numbers[-1])) if numbers else None

    def commit(self, number: int, state: dict) -> None:
        """Make `state` the one of `number`; another state under that number is an error."""
        text = json.dumps(state, sort_keys=True)
        if not self.store.write_once(self._name(number), text) and self.store.read(self._name(number)) != text:
            raise RuntimeError(f"another writer committed state {number}")
