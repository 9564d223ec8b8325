"""Exact, reproducible stratified split and balanced class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators.joins import BROADCAST_MAX_ROWS, lookup_join
from orderlens.operators.selection_exact import group_stats, select_kth

# 60 / 20 / 20 as tenths, so the bounds are exact integers.
DEFAULT_FRACTIONS = (6, 2, 2)


def hash_order(key_cols: Sequence[str], seed: int) -> F.Column:
    """md5(seed || '|' || key): a seeded, engine-independent row order."""
    parts = [F.lit(str(seed))] + [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in key_cols]
    return F.md5(F.concat_ws("|", *parts))


def _below_equal(df: DataFrame, marks: dict) -> dict:
    """{target: (rows below, rows equal)} for {target: (group condition, column, value)}, one aggregate."""
    if not marks:
        return {}
    exprs = []
    for i, (cond, c, v) in enumerate(marks.values()):
        exprs += [F.count(F.when(cond & (F.col(c) < v), 1)).alias(f"b{i}"),
                  F.count(F.when(cond & (F.col(c) == v), 1)).alias(f"e{i}")]
    row = df.agg(*exprs).first()
    return {t: (row[f"b{i}"], row[f"e{i}"]) for i, t in enumerate(marks)}


def _cut_points(narrow: DataFrame, label: str, cuts: Sequence[int]) -> dict:
    """{class: [(h, r, m) per cut]}: rows of the class with _h < h, or _h = h and _r < r, or the
    first m copies at (h, r), lie before the cut.  r is infinite where the cut splits no tie."""
    stats = group_stats(narrow, "_h", [label])
    targets = {(g, j): (g, (c * r["n"]) // 10 - 1) for g, r in stats.items() for j, c in enumerate(cuts)}
    init = {g: (r["n"], r["mn"], r["mx"]) for g, r in stats.items()}
    h = select_kth(narrow, "_h", targets, [label], init=init) if targets else {}
    cls = {g: F.col(label) == F.lit(g[0]) for g in stats}
    at_h = _below_equal(narrow, {t: (cls[t[0]], "_h", v) for t, v in h.items() if v is not None})
    # rows still wanted out of those that tie on _h (repeated keys only)
    need = {t: targets[t][1] + 1 - below for t, (below, equal) in at_h.items()
            if targets[t][1] + 1 - below < equal}
    r = {}
    if need:
        tied = narrow.filter(F.col("_h").isin(sorted({h[t] for t in need})))
        r = select_kth(tied, "_r", {t: ((t[0][0], h[t]), n - 1) for t, n in need.items()}, [label, "_h"])
    at_r = _below_equal(narrow, {t: (cls[t[0]] & (F.col("_h") == h[t]), "_r", v) for t, v in r.items()})
    inf = float("inf")
    return {g[0]: [(h.get((g, j)), r.get((g, j), inf), need[(g, j)] - at_r[(g, j)][0] if (g, j) in r else None)
                   for j in range(len(cuts))] for g in stats}


def stratified_split(df: DataFrame, label: str, key_cols: Sequence[str], seed: int = 42, *,
                     tenths: Sequence[int] = DEFAULT_FRACTIONS,
                     names: Sequence[str] = ("train", "val", "test"),
                     split_col: str = "split") -> DataFrame:
    """Add ``split`` so every class is cut exactly 60/20/20.

    Rows are ordered inside each class by md5(seed|key); position p
    (1-based) of a class of size n goes to train when 10*p <= 6n, to val
    when 10*p <= 8n, else test.  Instead of numbering rows (a sort, and a
    third of the data in one task for a big class), the cuts of each class
    are found by exact selection (a few counting passes), and every row is
    then compared with its class's cuts - a broadcast of one row per class.

    Keys may repeat: rows that tie with a cut are ordered by a hash of the
    whole row, and equal rows at the cut are counted out, so the sizes stay
    exact.  Rows with a missing label are left out (no class to stratify on).
    """
    if sum(tenths) != 10:
        raise ValueError("tenths must add up to 10")
    if label not in df.columns:
        raise KeyError(f"target column {label!r} not found")
    md5 = hash_order(list(key_cols), seed)
    # maps have no order and no hash: their JSON text stands for them
    maps = [f.name for f in df.schema.fields if "map<" in f.dataType.simpleString()]
    texts = {c: F.to_json(F.struct(F.col(c))) for c in maps}
    content = [texts.get(c, F.col(c)) for c in df.columns]
    # 52-bit hashes: exact as doubles; _h keeps the order of the hex text
    ordered = (df.filter(F.col(label).isNotNull())
               .withColumn("_h", F.conv(F.substring(md5, 1, 13), 16, 10).cast("double"))
               .withColumn("_r", F.shiftrightunsigned(F.xxhash64(*content), 12).cast("double")))
    # the counting passes read a narrow copy with the hashes computed once
    narrow = ordered.select(label, "_h", "_r").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        points = _cut_points(narrow, label, (tenths[0], tenths[0] + tenths[1]))
    finally:
        narrow.unpersist()
    fields = [df.schema[label]]
    for j in (0, 1):
        fields += [T.StructField(f"_h{j}", T.DoubleType()), T.StructField(f"_r{j}", T.DoubleType()),
                   T.StructField(f"_m{j}", T.LongType())]
    rows = [(g, *[x for cut in cuts for x in cut]) for g, cuts in points.items()]
    thr = df.sparkSession.createDataFrame(rows, T.StructType(fields))
    thr = F.broadcast(thr) if len(rows) <= BROADCAST_MAX_ROWS else thr
    ordered = ordered.join(thr, label, "left")

    def side(j):
        return (F.col("_h") < F.col(f"_h{j}")) | ((F.col("_h") == F.col(f"_h{j}")) & (F.col("_r") < F.col(f"_r{j}")))

    def at(j):
        return F.coalesce((F.col("_h") == F.col(f"_h{j}")) & (F.col("_r") == F.col(f"_r{j}")), F.lit(False))
    plain = F.when(side(0), names[0]).when(side(1), names[1]).otherwise(names[2])
    if not any(m is not None for cuts in points.values() for _, _, m in cuts):
        return ordered.withColumn(split_col, plain).select(*df.columns, split_col)
    # copies at a cut: one row per distinct content, numbered, then written out again
    marks = ["_h", "_r", *[f.name for f in fields[1:]]]
    keys = {f"_c{j}": e for j, e in enumerate(content)}
    copies = (ordered.filter(at(0) | at(1)).withColumns(keys).groupBy(*keys, *marks)
              .agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in df.columns]))
    upto = F.sum("_n").over(Window.partitionBy(label, "_h", "_r").orderBy(F.struct(*keys)))
    copies = copies.withColumn("_to", upto).withColumn(
        "_p", F.explode(F.sequence(F.col("_to") - F.col("_n") + 1, F.col("_to"))))
    counted = (F.when(side(0) | (at(0) & (F.col("_p") <= F.col("_m0"))), names[0])
               .when(side(1) | (at(1) & (F.col("_p") <= F.col("_m1"))), names[1]).otherwise(names[2]))
    rest = ordered.filter(~(at(0) | at(1))).withColumn(split_col, plain)
    return (rest.select(*df.columns, split_col)
            .unionByName(copies.withColumn(split_col, counted).select(*df.columns, split_col)))


def split_frames(df_split: DataFrame, label: str, split_col: str = "split",
                 names: Sequence[str] = ("train", "val", "test")):
    """X/y frames per split: (X_train, X_val, X_test, y_train, y_val, y_test)."""
    xs = [df_split.filter(F.col(split_col) == s).drop(split_col, label) for s in names]
    ys = [df_split.filter(F.col(split_col) == s).select(label) for s in names]
    return (*xs, *ys)


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """(label, n) - combines map-side; one row per class."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def with_class_size(df: DataFrame, label: str, size_col: str = "n_class") -> DataFrame:
    """Class size as a column (W2): k-row count table joined back with a
    checked broadcast, instead of a per-class window over the rows."""
    return lookup_join(df, class_counts(df, label).withColumnRenamed("n", size_col), label, "left")


def balanced_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Row weight n / (k * n_class), sklearn's 'balanced' (F15, J1, W2).

    Class sizes come from one map-side-combined count; n and k are sums over
    its rows.  The weight table is read out and broadcast if it has at most
    ``BROADCAST_MAX_ROWS`` classes, so the rows are scanned once in the plan and
    never shuffled by the (skewed) label; past the limit it is a shuffle join.
    """
    counts = class_counts(df.filter(F.col(label).isNotNull()), label)
    whole = counts.select(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    w = counts.select(label, (whole["n"] / (whole["k"] * F.col("n"))).alias(weight_col))
    return lookup_join(df, w, label, "left")
