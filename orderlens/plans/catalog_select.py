"""Registered queries: association, split, weights, calendars, alignment, sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.scalar import DAY_NAMES_ES
from orderlens.operators import association as A
from orderlens.operators import timegrid as TG
from orderlens.operators.joins import align_distributions
from orderlens.operators.sampling import sample_key_histories, sample_rows, test_sample
from orderlens.operators.split import balanced_weights, class_counts, split_frames, stratified_split
from orderlens.plans.catalog_profile import rounded
from orderlens.sources.tables import table

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _union(parts):
    return "\nUNION ALL\n".join(parts)


# --- customer attributes (customer ⋈ nation ⋈ region) ---------------------

def customer_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    df = (c.join(n, c.c_nationkey == n.n_nationkey, "left")
          .join(r, n.n_regionkey == r.r_regionkey, "left"))
    return df.select(
        "c_custkey", "c_mktsegment", F.nullif("n_name", F.lit("NATION_7")).alias("n_name"),
        "r_name", "c_acctbal",
        F.when(F.col("c_acctbal") > 5000, "high").otherwise("low").alias("bal_band"),
        F.when(F.col("c_mktsegment") == "BUILDING", "yes").otherwise("no").alias("is_building"))


ATTRS_SQL = """attrs AS (
  SELECT c.c_custkey, c.c_mktsegment, nullif(n.n_name, 'NATION_7') AS n_name, r.r_name, c.c_acctbal,
         CASE WHEN c.c_acctbal > 5000 THEN 'high' ELSE 'low' END AS bal_band,
         CASE WHEN c.c_mktsegment = 'BUILDING' THEN 'yes' ELSE 'no' END AS is_building
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""


def _cramer_sql(a: str, b: str, eda: bool) -> str:
    if eda:
        x, y = f"CAST({a} AS VARCHAR)", f"CAST({b} AS VARCHAR)"
        where = f"WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
    else:
        x = f"coalesce(CAST({a} AS VARCHAR), '__NA__')"
        y = f"coalesce(CAST({b} AS VARCHAR), '__NA__')"
        where = ""
    if eda:
        n1 = "(tot - 1)"
        v = ("CASE WHEN least(rr - (rr-1)*(rr-1)/n1, kk - (kk-1)*(kk-1)/n1) - 1 = 0 THEN 0.0 "
             "ELSE sqrt(greatest(0.0, chi2/tot - (kk-1)*(rr-1)/n1) / "
             "(least(rr - (rr-1)*(rr-1)/n1, kk - (kk-1)*(kk-1)/n1) - 1)) END")
    else:
        n1 = "greatest(tot - 1, 1)"
        v = ("CASE WHEN rr < 2 OR kk < 2 THEN 0.0 ELSE sqrt(greatest(0.0, chi2/tot - (kk-1)*(rr-1)/n1) / "
             "greatest(1e-12, least(rr - (rr-1)*(rr-1)/n1, kk - (kk-1)*(kk-1)/n1) - 1)) END")
    return f"""(WITH cells AS (SELECT {x} AS x, {y} AS y, count(*) AS n FROM attrs {where} GROUP BY 1, 2),
 r AS (SELECT x, sum(n) AS rs FROM cells GROUP BY x),
 c AS (SELECT y, sum(n) AS cs FROM cells GROUP BY y),
 m AS (SELECT CAST((SELECT count(*) FROM r) AS DOUBLE) AS rr, CAST((SELECT count(*) FROM c) AS DOUBLE) AS kk,
              CAST((SELECT sum(n) FROM cells) AS DOUBLE) AS tot),
 s AS (SELECT sum(n * n / (rs * cs)) AS s FROM cells JOIN r USING (x) JOIN c USING (y)),
 g AS (SELECT r.x, c.y, r.rs, c.cs, coalesce(cells.n, 0) AS cnt FROM r CROSS JOIN c
       LEFT JOIN cells ON cells.x = r.x AND cells.y = c.y),
 yt AS (SELECT sum(power(greatest(abs(cnt - rs*cs/tot) - least(0.5, abs(cnt - rs*cs/tot)), 0), 2) / (rs*cs/tot)) AS chi2y
        FROM g, m),
 st AS (SELECT rr, kk, tot, {n1} AS n1,
          CASE WHEN {str(eda).upper()} AND rr = 2 AND kk = 2 THEN (SELECT chi2y FROM yt)
               ELSE tot * (s - 1) END AS chi2 FROM m, s)
 SELECT '{a}' AS var_a, '{b}' AS var_b, round({v}, 6) AS cramers_v FROM st)"""


ASSOC_COLS = ["c_mktsegment", "n_name", "r_name"]
EDA_COLS = ["bal_band", "is_building", "r_name"]


def _pairs(cols):
    return [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]


@register("f8_cramers_v_matrix", "WITH " + ATTRS_SQL + "\n" + _union(
    [f"SELECT * FROM {_cramer_sql(a, b, False)}" for a, b in _pairs(ASSOC_COLS)]))
def cramers_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bias-corrected Cramér's V of every pair, missing as a level."""
    return rounded(A.cramers_v_matrix(customer_attrs(spark, sf_dir), ASSOC_COLS))


@register("f7_cramers_v_eda", "WITH " + ATTRS_SQL + "\n" + _union(
    [f"SELECT * FROM {_cramer_sql(a, b, True)}" for a, b in _pairs(EDA_COLS)]))
def cramers_eda(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Notebook Cramér's V: missing dropped, Yates on 2x2."""
    return rounded(A.cramers_v_matrix(customer_attrs(spark, sf_dir), EDA_COLS, eda=True))


PEARSON_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("f10_pearson_matrix", _union([
    f"SELECT '{a}' AS var_a, '{b}' AS var_b, round(corr({a}, {b}), 6) AS pearson FROM lineitem"
    for a, b in _pairs(PEARSON_COLS)]))
def pearson(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairwise-complete Pearson matrix in one aggregate."""
    return rounded(A.pearson_matrix(table(spark, sf_dir, "lineitem"), PEARSON_COLS))


NEAR_CONST_COLS = ["l_returnflag", "l_linestatus", "l_discount", "l_tax", "l_quantity"]


@register("f5_near_constant", "WITH tot AS (SELECT count(*) AS t FROM lineitem)\n" + _union([
    f"""SELECT '{c}' AS variable, round(max(n) / max(t), 6) AS top_share, max(n) / max(t) >= 0.95 AS drop
FROM (SELECT CAST({c} AS VARCHAR) AS v, count(*) AS n FROM lineitem WHERE {c} IS NOT NULL GROUP BY 1), tot"""
    for c in NEAR_CONST_COLS]))
def near_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-level share per column and the 0.95 drop flag."""
    return rounded(A.near_constant(table(spark, sf_dir, "lineitem"), NEAR_CONST_COLS))


# --- split and weights -----------------------------------------------------

_SPLIT_ORDERS = """
SELECT o_orderkey, o_orderstatus,
  CASE WHEN 10 * rn <= 6 * n THEN 'train' WHEN 10 * rn <= 8 * n THEN 'val' ELSE 'test' END AS split
FROM (SELECT o_orderkey, o_orderstatus,
        row_number() OVER (PARTITION BY o_orderstatus
                           ORDER BY md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey) AS rn,
        count(*) OVER (PARTITION BY o_orderstatus) AS n
      FROM orders WHERE o_orderstatus IS NOT NULL)"""


def _split_orders(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return stratified_split(o, "o_orderstatus", ["o_orderkey"], seed=42)


@register("f3_stratified_split", _SPLIT_ORDERS)
def split_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact 60/20/20 split per class, md5-seeded order."""
    return _split_orders(spark, sf_dir)


@register("e7_split_sizes", f"""
SELECT split, o_orderstatus, count(*) AS n FROM ({_SPLIT_ORDERS}) GROUP BY 1, 2""")
def split_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per (split, class)."""
    return _split_orders(spark, sf_dir).groupBy("split", "o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"))


@register("p8_split_frames", f"""
SELECT 'X_' || split AS frame, count(*) AS n, 'o_orderkey' AS columns FROM ({_SPLIT_ORDERS}) GROUP BY split
UNION ALL SELECT 'y_' || split, count(*), 'o_orderstatus' FROM ({_SPLIT_ORDERS}) GROUP BY split""")
def xy_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features and target of each split as frames of their own: rows and columns."""
    frames = split_frames(_split_orders(spark, sf_dir), "o_orderstatus")
    names = [f"{side}_{part}" for side in ("X", "y") for part in ("train", "val", "test")]
    out = [f.agg(F.lit(n).alias("frame"), F.count(F.lit(1)).alias("n"), F.lit(",".join(f.columns)).alias("columns"))
           for n, f in zip(names, frames)]
    return reduce(DataFrame.unionByName, out)


@register("f3_split_maps", """
WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1)
SELECT 'train' AS split, o_orderstatus, (6 * n) // 10 AS n FROM c
UNION ALL SELECT 'val', o_orderstatus, (8 * n) // 10 - (6 * n) // 10 FROM c
UNION ALL SELECT 'test', o_orderstatus, n - (8 * n) // 10 FROM c""")
def split_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class sizes per split of rows with a map column and few keys (F3): still exactly 60/20/20."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderstatus", F.pmod("o_custkey", F.lit(7)).alias("k"),
        F.create_map(F.lit("priority"), "o_orderpriority", F.lit("month"),
                     F.month("o_orderdate").cast("string")).alias("facts"))
    return (stratified_split(o, "o_orderstatus", ["k"], seed=42)
            .groupBy("split", "o_orderstatus").agg(F.count(F.lit(1)).alias("n")))


@register("f3_split_repeated_keys", """
WITH c AS (SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY 1)
SELECT 'train' AS split, o_orderstatus, (6 * n) // 10 AS n FROM c
UNION ALL SELECT 'val', o_orderstatus, (8 * n) // 10 - (6 * n) // 10 FROM c
UNION ALL SELECT 'test', o_orderstatus, n - (8 * n) // 10 FROM c""")
def split_repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class sizes per split when the split key repeats (F3): still exactly 60/20/20."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus")
    return (stratified_split(o, "o_orderstatus", ["o_custkey"], seed=42)
            .groupBy("split", "o_orderstatus").agg(F.count(F.lit(1)).alias("n")))


@register("f15_balanced_weights", """
SELECT o_orderkey, o_orderstatus,
  round((SELECT count(*) FROM orders WHERE o_orderstatus IS NOT NULL)
        / ((SELECT count(DISTINCT o_orderstatus) FROM orders)
           * count(*) OVER (PARTITION BY o_orderstatus)), 6) AS weight
FROM orders""")
def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balanced sample weight n/(k*n_class)."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return rounded(balanced_weights(o, "o_orderstatus"))


# --- calendars ---------------------------------------------------------------

_DAYS_SQL = "[" + ", ".join(f"'{d}'" for d in DAY_NAMES_ES) + "]"
_DATED = """d AS (SELECT o_orderstatus, o_orderdate FROM orders
           WHERE o_orderstatus IS NOT NULL AND o_orderdate IS NOT NULL),
g AS (SELECT o_orderstatus, CAST(w AS INTEGER) AS weekday
      FROM (SELECT DISTINCT o_orderstatus FROM d), range(0, 7) t(w))"""
_T1 = f"""WITH {_DATED},
c AS (SELECT o_orderstatus, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday, count(*) AS n
      FROM d GROUP BY 1, 2)
SELECT g.o_orderstatus, g.weekday, coalesce(c.n, 0) AS n, ({_DAYS_SQL})[g.weekday + 1] AS day_name
FROM g LEFT JOIN c USING (o_orderstatus, weekday)"""


@register("t1_weekday_counts", _T1)
def weekday_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per weekday per class, zero-filled."""
    return TG.weekday_counts(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderstatus")


@register("t2_weekday_shares", f"""SELECT *, round(n / sum(n) OVER (PARTITION BY o_orderstatus), 6) AS share
FROM ({_T1})""")
def weekday_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekday share within each class."""
    return rounded(TG.weekday_shares(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderstatus"))


_MONTHS = ", ".join(f"coalesce(p.m{m:02d}, 0) AS m{m:02d}" for m in range(1, 13))
_PIV = ", ".join(f"count(*) FILTER (WHERE month(o_orderdate) = {m}) AS m{m:02d}" for m in range(1, 13))


@register("t3_weekday_month_counts", f"""WITH {_DATED},
p AS (SELECT o_orderstatus, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS weekday, {_PIV}
      FROM d GROUP BY 1, 2)
SELECT g.o_orderstatus, g.weekday, {_MONTHS}, ({_DAYS_SQL})[g.weekday + 1] AS day_name
FROM g LEFT JOIN p ON g.o_orderstatus = p.o_orderstatus AND g.weekday = p.weekday""")
def weekday_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """7 x 12 weekday-by-month counts per class."""
    return TG.weekday_month_counts(table(spark, sf_dir, "orders"), "o_orderdate", "o_orderstatus")


# --- alignment, sampling ----------------------------------------------------

@register("j3_align_distributions", """
WITH t AS (SELECT l_linestatus AS class, count(*) AS n FROM lineitem GROUP BY 1),
s AS (SELECT o_orderstatus AS class, count(*) AS n FROM orders GROUP BY 1),
j AS (SELECT coalesce(t.class, s.class) AS class, coalesce(s.n, 0) AS n, t.class IS NULL AS extra,
             t.class AS t_order FROM t FULL OUTER JOIN s ON t.class = s.class)
SELECT class, n, extra, row_number() OVER (ORDER BY extra, t_order, class) AS position FROM j""")
def align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-status counts aligned to the line-status key order, extras last."""
    t = class_counts(table(spark, sf_dir, "lineitem"), "l_linestatus").withColumnRenamed(
        "l_linestatus", "class")
    s = class_counts(table(spark, sf_dir, "orders"), "o_orderstatus").withColumnRenamed(
        "o_orderstatus", "class")
    return align_distributions(t, s, "class", "n")


_SAMPLE = """SELECT * FROM orders
ORDER BY md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))), o_orderkey LIMIT 50"""


@register("p11_seeded_sample", _SAMPLE)
def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """50 rows, seeded, engine-independent."""
    return sample_rows(table(spark, sf_dir, "orders"), 50, ["o_orderkey"], seed=42)


@register("i5_sample_truth_counts", f"""
SELECT o_orderstatus, count(*) AS n FROM ({_SAMPLE}) GROUP BY 1""")
def sample_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """True class counts of the seeded sample."""
    return test_sample(table(spark, sf_dir, "orders"), "o_orderstatus", 50, ["o_orderkey"])[1]


@register("p12_key_histories", """
WITH k AS (SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
           ORDER BY md5(concat_ws('|', '777', CAST(o_custkey AS VARCHAR))), o_custkey LIMIT 5)
SELECT * FROM orders WHERE o_custkey IN (SELECT o_custkey FROM k)""")
def key_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of 5 sampled customers, by date."""
    return sample_key_histories(table(spark, sf_dir, "orders"), "o_custkey", 5,
                                ["o_orderdate", "o_orderkey"], seed=777)
