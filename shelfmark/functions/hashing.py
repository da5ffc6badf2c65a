"""Deterministic bucket of a key, equal on every engine that has MD5."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bucket(key: Column, salt: str, buckets: int) -> Column:
    """First 32 bits of md5(key:salt), modulo `buckets`; independent of partitioning."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{salt}")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % buckets).cast("int")
