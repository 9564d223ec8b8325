"""Joins with a checked broadcast side and distribution alignment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.ranking import global_rank

# Largest row count we broadcast after checking it.
BROADCAST_MAX_ROWS = 100_000


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``df`` as a broadcast table of at most ``max_rows`` rows, or ``df`` itself if it has more.

    The check keeps the rows that it has read (at most ``max_rows + 1``), so a
    small table is computed once and is no part of the later plan.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def lookup_join(big: DataFrame, small: DataFrame, on: str | Sequence[str], how: str = "left",
                max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join a lookup table: broadcast when its row count is checked to be small,
    otherwise a plain shuffle join (AQE splits skewed keys there)."""
    return big.join(checked_broadcast(small, max_rows), on, how)


def semi_join_keys(big: DataFrame, keys: DataFrame, on: str | Sequence[str],
                   max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Rows of ``big`` whose key is in ``keys`` (J2): left-semi, broadcast when small."""
    return big.join(checked_broadcast(keys, max_rows), on, "left_semi")


def align_distributions(template: DataFrame, source: DataFrame, key: str = "class",
                        value: str = "n", order_col: str | None = None) -> DataFrame:
    """Source counts in template key order, 0 where absent, extra keys after.

    ``template`` and ``source`` are (key, value) tables, one row per key.
    Template keys keep their order (``order_col`` ascending, else key name);
    source keys missing from the template follow, by name.  Result:
    ``key, value, extra, position``.  Positions come from a range partitioning
    with an offset per range, so the key may be as wide as the data.
    """
    order = F.col(order_col) if order_col else F.col(key)
    t = template.select(key, order.alias("_t_order"))
    joined = t.join(source.select(key, value), key, "full_outer")
    extra = F.col("_t_order").isNull()
    rows = joined.select(key, F.coalesce(F.col(value), F.lit(0)).cast("long").alias(value),
                         extra.alias("extra"), "_t_order")
    ranked = global_rank(rows, ["extra", "_t_order", key], rank_col="_at", size_col=None, unique_order=True)
    return ranked.select(key, value, "extra", (F.col("_at") + 1).cast("int").alias("position"))
