"""Deterministic, distributed row splits (C3 folds, C4 hold-out, D1 strata).

A shuffled K-fold of a single-machine library is not reproducible elsewhere;
the fold of a row is instead a hash of its key and a seed, computed per row
(no shuffle, no global ordering).  ``md5`` keeps the SQL oracle identical.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_SEED = 42


def key_hash(key: Column, salt: str) -> Column:
    """32-bit unsigned hash: first 8 hex digits of ``md5(key || salt)``."""
    hexpart = F.substring(F.md5(F.concat(key.cast("string"), F.lit(salt))), 1, 8)
    return F.conv(hexpart, 16, 10).cast("bigint")


def hash_fold(key: Column, n_folds: int = 5, seed: int = DEFAULT_SEED) -> Column:
    """Fold id in ``[0, n_folds)``."""
    return (key_hash(key, f":{seed}") % F.lit(n_folds)).cast("int")


def holdout_flag(key: Column, test_size: float = 0.12, seed: int = DEFAULT_SEED, purpose: str = "split") -> Column:
    """C4: True for the hold-out share ``test_size`` (resolution 1/10000).

    ``purpose`` salts the hash, so nested splits (a validation split inside a
    training split) are independent of each other."""
    bucket = key_hash(key, f":{purpose}:{seed}") % F.lit(10000)
    return bucket < F.lit(int(round(test_size * 10000)))


def with_folds(df: DataFrame, key: str, n_folds: int = 5, seed: int = DEFAULT_SEED, name: str = "fold") -> DataFrame:
    return df.withColumn(name, hash_fold(F.col(key), n_folds, seed))


def train_test_split(df: DataFrame, key: str, test_size: float = 0.12, seed: int = DEFAULT_SEED,
                     purpose: str = "split") -> tuple[DataFrame, DataFrame]:
    flag = holdout_flag(F.col(key), test_size, seed, purpose)
    return df.where(~flag), df.where(flag)


def stratified_folds(
    df: DataFrame, key: str, target: str, n_strata: int = 10, n_folds: int = 5, seed: int = DEFAULT_SEED
) -> DataFrame:
    """``stratum`` = target quantile band (exact cut points), ``fold`` =
    position modulo ``n_folds`` in the order of (stratum, key hash, key).

    The cut points are exact quantiles (``n_strata - 1`` numbers, applied as
    literals); the stratum of a row is the number of cut points below its
    target.  Every stratum's rows stand together in that order, so its folds
    differ by one row at most.  Positions come from range-sorted partitions
    that are written once and the partitions' sizes (one row each): no window
    holds a band in one task.
    """
    from .label_encoder import global_position
    from .quantiles import column_quantiles

    probs = [i / n_strata for i in range(1, n_strata)]
    cuts = column_quantiles(df, [target], probs)[target] or []
    y = F.col(target)
    below = [F.when(F.lit(c) < y, 1).otherwise(0) for c in cuts]
    stratum = sum(below[1:], below[0]).cast("int") if below else F.lit(0)
    banded = df.withColumn("stratum", stratum).withColumn("_h", key_hash(F.col(key), f":{seed}"))
    placed = global_position(banded, ["stratum", "_h", key], "_at")
    return placed.withColumn("fold", (F.col("_at") % n_folds).cast("int")).drop("_h", "_at")
