"""Train/test split and cross-validation folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.hashing import bucket

SEED = 123
TRAIN_TENTHS = 7
FOLDS = 5


def in_train(key: Column, seed: int = SEED, tenths: int = TRAIN_TENTHS) -> Column:
    """About `tenths`/10 of the keys, always the same ones; copies of a key stay together."""
    return bucket(key, str(seed), 10) < tenths


def fold_of(key: Column, folds: int = FOLDS) -> Column:
    return bucket(key, "fold", folds)


def with_split(df: DataFrame, key: str = "id", folds: int = FOLDS) -> DataFrame:
    """Add `split` ('train' or 'test') and `fold`; a narrow step that no repartition changes.

    A row without a key belongs to neither part: its split is 'rejected' and its fold NULL.
    """
    return df.withColumns(
        {
            "split": F.when(F.col(key).isNull(), F.lit("rejected"))
            .when(in_train(F.col(key)), F.lit("train"))
            .otherwise(F.lit("test")),
            "fold": fold_of(F.col(key), folds),
        }
    )


def random_split(df: DataFrame, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Spark's own 70/30 split: which rows fall where depends on partitioning."""
    train, test = df.randomSplit([TRAIN_TENTHS / 10, 1 - TRAIN_TENTHS / 10], seed=seed)
    return train, test
