"""Exact quantiles of any number of groups (A9): the search state is a DataFrame, never the driver's.

Each (group, quantile) has a bracket [lo, hi] that holds its order statistics.
One sketch aggregate gives the first brackets; brackets with many distinct
values are cut by further sketches, taken inside them, until none holds more
than ``finish`` values.  Rows are only counted against the brackets, combined
map-side; what is finally read out are (value, count) pairs inside a bracket,
``finish`` of them at most, so no task ever holds a group, however large.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import shared_path

FINISH = 10_000           # distinct values of a bracket that are read out
ACCURACY = 1_000          # rank error of a sketch: 1 / ACCURACY of its rows
GRID = 100                # cuts of a bracket per further sketch
STATE_BROADCAST = 500_000   # groups (about 100 bytes) that may be broadcast to the rows


def _stored(df: DataFrame, tag: str) -> DataFrame:
    path = shared_path(df.sparkSession, f"quantiles-{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def grouped_quantiles(df: DataFrame, value_col: str, probs: Sequence[float], group_cols: Sequence[str], *,
                      extra: Sequence[Column] = (), prefix: str = "q", finish: int = FINISH) -> DataFrame:
    """(groups..., n, extra..., q25, ...): exact linear-interpolated quantiles of each group.

    Missing values (null, NaN) are ignored.  ``extra`` are aggregates over
    ``_v``, the values as doubles, taken in the first pass.
    """
    groups, probs = list(group_cols), [float(p) for p in probs]
    v = F.col("_v")
    rows = (df.select(F.struct(*groups).alias("_g"), F.col(value_col).cast("double").alias("_v"))
            .filter(v.isNotNull() & ~F.isnan("_v")))
    margin = 2.0 / ACCURACY
    cuts = [x for p in probs for x in (max(p - margin, 0.0), min(p + margin, 1.0))]
    first = _stored(rows.groupBy("_g").agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx"),
        F.percentile_approx("_v", cuts, ACCURACY).alias("_cuts"),
        F.struct(*([e for e in extra] or [F.lit(None).alias("_none")])).alias("_extra")), "groups")
    few = F.col("n") <= finish
    small = first.count() <= STATE_BROADCAST           # a footer count: the size of every bracket table

    def target(i: int, p: float) -> Column:
        pos = (F.col("n") - 1) * F.lit(p)
        lo = F.when(few | F.lit(p <= margin), F.col("_mn")).otherwise(F.get("_cuts", F.lit(2 * i)))
        hi = F.when(few | F.lit(p >= 1 - margin), F.col("_mx")).otherwise(F.get("_cuts", F.lit(2 * i + 1)))
        return F.struct(F.lit(i).alias("i"), F.floor(pos).cast("long").alias("k"), (pos - F.floor(pos)).alias("frac"),
                        lo.alias("lo"), hi.alias("hi"))
    state = first.select("_g", "n", F.inline(F.array(*[target(i, p) for i, p in enumerate(probs)])))

    def inside(brackets: DataFrame, below: bool) -> DataFrame:
        """(rows, bracket) for the rows up to the end of a bracket of their group, or those in it."""
        packed = brackets.groupBy(F.col("_g").alias("_key")).agg(F.collect_list(F.struct("i", "lo", "hi")).alias("t"))
        side = F.broadcast(packed) if small else packed
        met = rows.join(side, rows["_g"].eqNullSafe(packed["_key"]))       # null is a group like any other
        fits = lambda x: (v <= x["hi"]) & (F.lit(below) | (v >= x["lo"]))
        return met.select("_g", "_v", F.inline(F.filter("t", fits)))

    settled, open_ = state.filter(few).withColumn("below", F.lit(0).cast("long")), state.filter(~few)
    for _ in range(12):
        if open_.isEmpty():
            break
        grid = F.percentile_approx(F.when(v >= F.col("lo"), v), [x / GRID for x in range(GRID + 1)], ACCURACY)
        counts = inside(open_, True).groupBy("_g", "i").agg(
            F.count(F.when(v < F.col("lo"), 1)).alias("below"), F.count(F.when(v >= F.col("lo"), 1)).alias("m"),
            F.approx_count_distinct(F.when(v >= F.col("lo"), v)).alias("d"), grid.alias("grid"))
        got = _stored(open_.alias("s").join(counts.alias("c"), F.col("s._g").eqNullSafe(F.col("c._g"))
                                            & (F.col("s.i") == F.col("c.i")))
                      .select("s.*", "below", "m", "d", "grid"), "counts")
        # a tenth more, since the distinct count is an estimate
        done = (F.col("d") <= 0.9 * finish) | (F.col("lo") == F.col("hi"))
        settled = settled.unionByName(got.filter(done).select(*settled.columns))
        at = (F.col("k") - F.col("below")) / F.col("m") * GRID
        lo = F.get("grid", F.greatest(F.floor(at) - 1, F.lit(0)).cast("int"))
        hi = F.get("grid", F.least(F.ceil(at) + 1, F.lit(GRID)).cast("int"))
        open_ = got.filter(~done).select("_g", "n", "i", "k", "frac", lo.alias("lo"), hi.alias("hi"))
    else:
        raise RuntimeError("quantile brackets did not shrink")
    pairs = inside(settled, False).groupBy("_g", "i", "_v").agg(F.count(F.lit(1)).alias("c"))
    cum = F.sum("c").over(Window.partitionBy("_g", "i").orderBy("_v")
                          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    pairs = pairs.withColumn("cum", cum).alias("p").join(
        settled.alias("s"), F.col("p._g").eqNullSafe(F.col("s._g")) & (F.col("p.i") == F.col("s.i")))
    rank = F.col("k") - F.col("below")
    last = F.least(F.col("k") + 1, F.col("n") - 1) - F.col("below")
    found = pairs.groupBy(F.col("s._g").alias("_g"), F.col("s.i").alias("i")).agg(
        F.min(F.when(F.col("cum") > rank, v)).alias("a"), F.min(F.when(F.col("cum") > last, v)).alias("b"),
        F.first("frac").alias("frac"))
    wide = found.groupBy(F.col("_g").alias("_key")).agg(*[
        F.max(F.when(F.col("i") == i, F.col("a") + (F.col("b") - F.col("a")) * F.col("frac")))
        .alias(f"{prefix}{int(round(p * 100))}") for i, p in enumerate(probs)])
    out = first.join(wide, first["_g"].eqNullSafe(wide["_key"]))
    return out.select(F.col("_g.*"), "n", *([F.col("_extra.*")] if extra else []),
                      *[f"{prefix}{int(round(p * 100))}" for p in probs])
