"""Calendar tables per class, zero-filled on a fixed grid.

The grid (every class x 7 weekdays) is built by exploding ``sequence(0, 6)``
from the distinct classes - derived from the data, no cross join - and the
counts are left-joined onto it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions.scalar import DAY_NAMES_ES


def _dated(df: DataFrame, date_col: str, label: str) -> DataFrame:
    ts = F.col(date_col).cast("timestamp_ntz") if dict(df.dtypes)[date_col] == "string" else F.col(date_col)
    return (df.select(F.col(label).cast("string").alias(label), ts.alias("_d"))
            .filter(F.col(label).isNotNull() & F.col("_d").isNotNull()))


def _weekday_grid(dated: DataFrame, label: str) -> DataFrame:
    classes = dated.select(label).distinct()
    return classes.select(label, F.explode(F.sequence(F.lit(0), F.lit(6))).alias("weekday"))


def weekday_counts(df: DataFrame, date_col: str, label: str,
                   names=DAY_NAMES_ES) -> DataFrame:
    """Rows per (class, weekday), Monday = 0, all 7 days present."""
    d = _dated(df, date_col, label)
    counts = d.groupBy(label, F.weekday("_d").alias("weekday")).agg(F.count(F.lit(1)).alias("n"))
    grid = _weekday_grid(d, label)
    names_arr = F.array(*[F.lit(x) for x in names])
    out = grid.join(counts, [label, "weekday"], "left").fillna({"n": 0})
    return out.withColumn("day_name", F.element_at(names_arr, F.col("weekday") + 1))


def weekday_shares(df: DataFrame, date_col: str, label: str) -> DataFrame:
    """Share of each weekday within its class (T2); the window runs over the
    7-rows-per-class count table, not over the data."""
    t1 = weekday_counts(df, date_col, label)
    return t1.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(label)))


def weekday_month_counts(df: DataFrame, date_col: str, label: str) -> DataFrame:
    """Weekday x month counts per class, 7 rows x 12 month columns.

    ``pivot`` gets its 12 values explicitly, so no extra distinct job runs.
    """
    d = _dated(df, date_col, label)
    piv = (d.withColumn("month", F.month("_d"))
           .groupBy(label, F.weekday("_d").alias("weekday"))
           .pivot("month", list(range(1, 13))).agg(F.count(F.lit(1))))
    months = {str(m): f"m{m:02d}" for m in range(1, 13)}
    piv = piv.withColumnsRenamed(months)
    grid = _weekday_grid(d, label)
    out = grid.join(piv, [label, "weekday"], "left").fillna(0, subset=list(months.values()))
    names_arr = F.array(*[F.lit(x) for x in DAY_NAMES_ES])
    return out.withColumn("day_name", F.element_at(names_arr, F.col("weekday") + 1))
