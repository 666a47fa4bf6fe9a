"""Repeatable train/test split and folds from a hash of the id.

The outcome depends on the id alone, so it is the same for any partitioning, and all rows
of a question fall on one side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _hash_number(id_column: str, seed: int, first_digit: int) -> Column:
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_column).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, first_digit, 8), 16, 10).cast("bigint")


def is_train(id_column: str, train_percent: int = 70, seed: int = 100) -> Column:
    return _hash_number(id_column, seed, 1) % 100 < train_percent


def hash_split(
    df: DataFrame, id_column: str = "id", train_percent: int = 70, seed: int = 100
) -> tuple[DataFrame, DataFrame]:
    train = is_train(id_column, train_percent, seed)
    return df.filter(train), df.filter(~train)


def fold(id_column: str, folds: int, seed: int = 100) -> Column:
    """Fold number from digits that the split does not use."""
    return (_hash_number(id_column, seed, 9) % folds).cast("int")
