"""Exact positions and quantiles without single-task windows.

Quantiles use exact selection by counting (``selection_exact``): no sort,
no shuffle of rows.  ``global_rank`` numbers EVERY row, which needs a
distributed sort; it serves callers that need per-row positions (J3).

``row_number() OVER (PARTITION BY class ORDER BY ...)`` sends every row of
a class through ONE task; with three classes and 100 TB that is a third of
the data in one task.  Here the position is computed the way a distributed
sort numbers rows:

1. range-partition on (group, order keys, unique tiebreak) and sort inside
   each partition, so partitions hold consecutive key ranges and even a hot
   value is split across partitions by the tiebreak;
2. number rows inside each partition (``monotonically_increasing_id`` keeps
   the in-partition row index in its low 33 bits);
3. count rows per (group, partition) - a table of at most
   #partitions + #groups rows - and turn the counts into offsets with a
   running sum over that small table;
4. join the offsets back (AQE broadcasts them after measuring their size;
   a shuffle join remains the fallback).

position = offset(group, partition) + local index - first local index of
the group in that partition.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import types as T
from pyspark.sql import functions as F

from orderlens.operators.selection_exact import group_stats, select_kth
from orderlens.session import ensure_checkpoint_dir

_LOW33 = (1 << 33) - 1


def _partitions(df: DataFrame, num_partitions: int | None) -> int:
    if num_partitions:
        return num_partitions
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def global_rank(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (), *,
                rank_col: str = "_rank", size_col: str | None = "_group_n",
                num_partitions: int | None = None, unique_order: bool = False) -> DataFrame:
    """Add the exact 0-based position of each row inside its group.

    ``order_cols`` ascending, nulls first (Spark's default).  When the order
    keys are not unique, pass ``unique_order=False`` (default): a per-row
    tiebreak keeps hot values splittable; tied rows get consecutive
    positions in an arbitrary order.  ``size_col`` adds the group size.
    """
    group_cols, order_cols = list(group_cols), list(order_cols)
    keys = [*group_cols, *order_cols]
    work = df
    if not unique_order:
        work = work.withColumn("_tb", F.monotonically_increasing_id())
        keys = keys + ["_tb"]
    n = _partitions(df, num_partitions)
    ranged = (work.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_local", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW33))))
    # Both the counts and the rows must see the SAME range partitioning and
    # row numbers; the plan holds non-deterministic ids, so Spark would run
    # (and sample range bounds for) each branch separately.  A reliable
    # checkpoint in spark.checkpoint.dir fixes one copy that survives
    # executor loss.
    ensure_checkpoint_dir(df.sparkSession)
    ranged = ranged.checkpoint(eager=True)
    part_keys = [*group_cols, "_pid"]
    stats = ranged.groupBy(*part_keys).agg(F.count(F.lit(1)).alias("_cnt"),
                                           F.min("_local").alias("_first"))
    if group_cols:
        w = Window.partitionBy(*group_cols).orderBy("_pid")
        stats = stats.withColumn("_offset", F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)))
        if size_col:
            stats = stats.withColumn(size_col, F.sum("_cnt").over(Window.partitionBy(*group_cols)))
    else:
        # one row per partition: offsets are summed in the driver, not in a window over everything
        rows, run = [], 0
        for r in sorted(stats.collect(), key=lambda r: r["_pid"]):
            rows.append((r["_pid"], r["_cnt"], r["_first"], run))
            run += r["_cnt"]
        stats = df.sparkSession.createDataFrame(rows, "_pid int, _cnt long, _first long, _offset long")
        if size_col:
            stats = stats.withColumn(size_col, F.lit(run).cast("long"))
    stats = stats.fillna({"_offset": 0})
    out = ranged.join(stats, part_keys, "inner").withColumn(
        rank_col, F.col("_offset") + F.col("_local") - F.col("_first"))
    drop = ["_pid", "_local", "_cnt", "_first", "_offset"] + ([] if unique_order else ["_tb"])
    return out.drop(*drop)


def quantile_values(long_df: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), stats: dict | None = None) -> dict:
    """{group_tuple: [q_p for p in probs]} - exact, linear interpolation.

    ``stats`` ({group: Row(n, mn, mx, ...)} from ``group_stats``) saves the
    first pass when the caller aggregates the groups anyway.
    """
    group_cols = list(group_cols)
    stats = stats if stats is not None else group_stats(long_df, value_col, group_cols)
    targets, plan = {}, []
    for gi, (g, r) in enumerate(sorted(stats.items(), key=lambda kv: str(kv[0]))):
        n, row = r["n"], []
        for pi, p in enumerate(probs):
            pos = (n - 1) * float(p)
            lo, hi = math.floor(pos), math.ceil(pos)
            targets[f"{gi}:{pi}:lo"] = (g, lo)
            targets[f"{gi}:{pi}:hi"] = (g, hi)
            row.append((f"{gi}:{pi}", pos - lo))
        plan.append((g, row))
    init = {g: (r["n"], r["mn"], r["mx"]) for g, r in stats.items()}
    vals = select_kth(long_df, value_col, targets, group_cols, init=init) if targets else {}
    out = {}
    for g, row in plan:
        qs = []
        for tid, frac in row:
            lo, hi = vals[f"{tid}:lo"], vals[f"{tid}:hi"]
            qs.append(None if lo is None else lo + (hi - lo) * frac)
        out[g] = qs
    return out


def exact_quantiles(long_df: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), *, prefix: str = "q",
                    num_partitions: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles (numpy 'linear', DuckDB quantile_cont).

    ``long_df`` holds one value per row (nulls/NaN are skipped).  Returns one
    row per group with columns ``{prefix}{int(p*100)}`` plus ``n``.  The two
    order statistics around each position (n-1)*p come from exact selection
    by counting; the result has one row per group.
    """
    group_cols = list(group_cols)
    stats = group_stats(long_df, value_col, group_cols)
    qv = quantile_values(long_df, value_col, probs, group_cols, stats)
    rows = [(*g, stats[g]["n"], *qs) for g, qs in qv.items()]
    fields = [f for f in long_df.schema.fields if f.name in group_cols]
    fields = sorted(fields, key=lambda f: group_cols.index(f.name))
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in fields],
                           T.StructField("n", T.LongType()),
                           *[T.StructField(f"{prefix}{int(round(p * 100))}", T.DoubleType())
                             for p in probs]])
    return long_df.sparkSession.createDataFrame(rows, schema)


def approx_quantiles(long_df: DataFrame, value_col: str, probs: Sequence[float],
                     group_cols: Sequence[str] = (), *, prefix: str = "q",
                     accuracy: int = 10000) -> DataFrame:
    """Sketch-based quantiles: one partial-aggregating pass, bounded memory."""
    vals = long_df.filter(F.col(value_col).isNotNull() & ~F.isnan(F.col(value_col)))
    arr = F.percentile_approx(F.col(value_col), [float(p) for p in probs], accuracy)
    small = vals.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n"), arr.alias("_qs"))
    return small.select(*group_cols, "n", *[
        F.col("_qs")[i].alias(f"{prefix}{int(round(p * 100))}") for i, p in enumerate(probs)])


def quantiles(long_df: DataFrame, value_col: str, probs: Sequence[float],
              group_cols: Sequence[str] = (), *, exact: bool = True, **kw) -> DataFrame:
    """Exact (distributed rank) or sketch quantiles by option."""
    fn = exact_quantiles if exact else approx_quantiles
    return fn(long_df, value_col, probs, group_cols, **kw)
