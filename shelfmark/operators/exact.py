"""A split in which exactly the wanted number of keys falls on one side, without a sort.

Keys are ordered by their MD5. A histogram of the first four digits tells in
which bin the wanted number is reached; inside that bin the next four digits
decide, and so on, until a bin ends at the very number. Each step counts 65,536
bins at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.split import SEED, TRAIN_TENTHS
from shelfmark.session import materialize

_DIGITS, _STEP = 32, 4


def key_digest(key: Column, seed: int = SEED) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(f":exact:{seed}")))


def threshold(keys: DataFrame, wanted: int) -> str:
    """The digest prefix up to which exactly `wanted` keys lie; `keys` has one row per key, with its `digest`.

    Only keys of equal MD5 cannot be parted; the number is then off by those.
    """
    prefix, room = "", wanted
    while len(prefix) < _DIGITS:
        inside = keys.where(F.col("digest").startswith(prefix)) if prefix else keys
        bins = inside.groupBy(F.substring("digest", len(prefix) + 1, _STEP).alias("bin")).count().collect()
        taken, last = 0, None
        for row in sorted(bins, key=lambda r: r["bin"]):
            if taken + row["count"] > room:
                break
            taken, last = taken + row["count"], row["bin"]
        else:
            row = None
        if taken == room:
            # the bins up to here are the wanted keys; with none of them, all below this prefix
            return prefix + last if last is not None else prefix + "\0"
        if row is None:
            return prefix + last if last is not None else ""
        prefix, room = prefix + row["bin"], room - taken
    return prefix[:-1]


def exact_split(df: DataFrame, key: str = "id", seed: int = SEED, tenths: int = TRAIN_TENTHS) -> DataFrame:
    """Add `split`: 'train' for exactly floor(keys * tenths / 10) of the distinct keys, else 'test'; no key, 'rejected'.

    Copies of a key fall on the same side, and the same keys always do: neither
    partitions nor other rows' order matter.
    """
    found = df.select(key_digest(F.col(key), seed).alias("digest")).where("digest IS NOT NULL").distinct()
    keys = materialize(found, "split-keys")
    wanted = keys.count() * tenths // 10
    end = threshold(keys, wanted)
    digest = key_digest(F.col(key), seed)
    inside = F.substring(digest, 1, len(end)) <= F.lit(end) if wanted else F.lit(False)
    return df.withColumn(
        "split", F.when(F.col(key).isNull(), "rejected").when(inside, "train").otherwise("test")
    )
