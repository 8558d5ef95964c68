"""Reproducible splits (F3) and folds (H10) by key hash.

``randomSplit`` depends on how the input happens to be partitioned; a hash
of the key does not, so the same rating lands in the same half on any
cluster size, and the SQL oracle computes the same halves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.functions.columns import key_hash


def split_halves(ratings: DataFrame, seed: int = 0, user_col: str = "user_id",
                 item_col: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """Half A (hash even) trains the base models, half B (odd) the stacker."""
    h = key_hash(user_col, item_col, seed=seed)
    return ratings.filter(h % 2 == 0), ratings.filter(h % 2 == 1)


def with_half(ratings: DataFrame, seed: int = 0, user_col: str = "user_id",
              item_col: str = "item_id", name: str = "half") -> DataFrame:
    """Label each row 'A' or 'B' instead of splitting it."""
    h = key_hash(user_col, item_col, seed=seed)
    return ratings.withColumn(name, F.when(h % 2 == 0, F.lit("A")).otherwise(F.lit("B")))


def with_fold(ratings: DataFrame, n_folds: int, seed: int = 0, user_col: str = "user_id",
              item_col: str = "item_id", name: str = "fold") -> DataFrame:
    """Assign each rating to one of ``n_folds`` folds by key hash."""
    h = key_hash(user_col, item_col, seed=seed)
    return ratings.withColumn(name, (h % n_folds).cast("int"))
