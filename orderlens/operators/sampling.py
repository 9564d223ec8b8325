"""Seeded samples (P11, P12, I5).  The limit here IS the feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.joins import semi_join_keys
from orderlens.operators.split import class_counts, hash_order


def sample_rows(df: DataFrame, n: int, key_cols: Sequence[str], seed: int = 42) -> DataFrame:
    """n rows without replacement, the same on every run and engine.

    Top-n by md5(seed|key): a distributed top-k (each task keeps n rows,
    the driver merges #tasks x n), not a sort of the whole table.
    """
    return (df.withColumn("_h", hash_order(key_cols, seed))
            .orderBy("_h", *key_cols).limit(n).drop("_h"))


def sample_key_histories(df: DataFrame, key: str, n_keys: int, order_cols: Sequence[str],
                         seed: int = 777) -> DataFrame:
    """Full history of n sampled keys, ordered.

    Keys are sampled from the distinct keys, then a left-semi join (the key
    list is broadcast: its size is n_keys) picks their rows.
    """
    keys = sample_rows(df.select(key).filter(F.col(key).isNotNull()).distinct(), n_keys, [key], seed)
    return semi_join_keys(df, keys, key).orderBy(key, *order_cols)


def test_sample(df: DataFrame, label: str, n: int, key_cols: Sequence[str], seed: int = 42):
    """(sample rows, ground-truth class counts of the sample)."""
    rows = sample_rows(df, n, key_cols, seed)
    return rows, class_counts(rows, label)
