"""Registered queries: column typing and profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import profile as P
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


def rounded(df: DataFrame, digits: int = 6, skip=()) -> DataFrame:
    """Round every double column (both engines sum in different orders)."""
    dbl = [f.name for f in df.schema.fields
           if f.dataType.typeName() in ("double", "float") and f.name not in skip]
    return df.withColumns({c: F.round(F.col(c), digits) for c in dbl})


def _union(parts):
    return "\nUNION ALL\n".join(parts)


LINE_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

# -- F1 --------------------------------------------------------------------
_LINE_TYPES = {"l_orderkey": "n", "l_partkey": "n", "l_suppkey": "n", "l_linenumber": "n",
               "l_quantity": "n", "l_extendedprice": "n", "l_discount": "n", "l_tax": "n",
               "l_returnflag": "s", "l_linestatus": "s", "l_shipdate": "t"}


def _typify_sql():
    parts = []
    for c, k in _LINE_TYPES.items():
        if k == "n":
            nd = (f"(count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END))")
            parts.append(f"SELECT '{c}' AS variable, CAST({nd} AS BIGINT) AS n_distinct, "
                         f"CASE WHEN {nd} <= 5 THEN 'discrete' ELSE 'continuous' END AS kind "
                         f"FROM lineitem")
        else:
            kind = "categorical" if k == "s" else "temporal"
            parts.append(f"SELECT '{c}' AS variable, CAST(NULL AS BIGINT) AS n_distinct, "
                         f"'{kind}' AS kind")
    return _union(parts)


@register("f1_typify_lineitem", _typify_sql())
def typify_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous / categorical / discrete / temporal kinds of lineitem, distinct counts of the numeric (F1)."""
    return (P.typify_columns(table(spark, sf_dir, "lineitem"), exact_distinct=True)
            .select("variable", "n_distinct", "kind"))


# -- A4 --------------------------------------------------------------------
@register("a4_value_shares", """
SELECT o_orderstatus AS value, count(*) AS n,
  round(count(*) / (SELECT count(*) FROM orders WHERE o_orderstatus IS NOT NULL), 6) AS share
FROM orders WHERE o_orderstatus IS NOT NULL GROUP BY o_orderstatus""")
def value_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class distribution, normalised (A4)."""
    return rounded(P.value_shares(table(spark, sf_dir, "orders"), "o_orderstatus"))


# -- A5 --------------------------------------------------------------------
@register("a5_category_counts", """
SELECT 'c_mktsegment' AS variable, c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 2
UNION ALL
SELECT 'c_nationkey', CAST(c_nationkey AS VARCHAR), count(*) FROM customer GROUP BY 2""")
def category_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Absolute counts of each categorical level (A5)."""
    return P.category_counts(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_nationkey"])


# -- A6 --------------------------------------------------------------------
@register("a6_missing_shares", """
WITH t AS (SELECT nullif(o_orderstatus, 'F') AS o_orderstatus,
                  nullif(o_orderpriority, '5-LOW') AS o_orderpriority,
                  CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_totalprice END AS o_totalprice,
                  o_orderdate, o_custkey FROM orders),
s AS (
  SELECT 'o_orderstatus' AS variable, avg(CASE WHEN o_orderstatus IS NULL THEN 1.0 ELSE 0.0 END) AS missing_share FROM t
  UNION ALL SELECT 'o_orderpriority', avg(CASE WHEN o_orderpriority IS NULL THEN 1.0 ELSE 0.0 END) FROM t
  UNION ALL SELECT 'o_totalprice', avg(CASE WHEN o_totalprice IS NULL THEN 1.0 ELSE 0.0 END) FROM t
  UNION ALL SELECT 'o_orderdate', avg(CASE WHEN o_orderdate IS NULL THEN 1.0 ELSE 0.0 END) FROM t
  UNION ALL SELECT 'o_custkey', avg(CASE WHEN o_custkey IS NULL THEN 1.0 ELSE 0.0 END) FROM t)
SELECT variable, round(CAST(missing_share AS DOUBLE), 6) AS missing_share FROM s WHERE missing_share > 0""")
def missing_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing share per column with injected nulls and NaN."""
    o = table(spark, sf_dir, "orders")
    t = o.select(
        F.nullif("o_orderstatus", F.lit("F")).alias("o_orderstatus"),
        F.nullif("o_orderpriority", F.lit("5-LOW")).alias("o_orderpriority"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(float("nan")))
        .otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate", "o_custkey")
    return rounded(P.missing_shares(t))


# -- A7 --------------------------------------------------------------------
def _describe_sql():
    parts = []
    for c in LINE_NUM:
        parts.append(
            f"SELECT '{c}' AS variable, count({c}) AS count, round(avg({c}), 6) AS mean, "
            f"round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
            f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
            f"round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM lineitem")
    return _union(parts)


@register("a7_describe_continuous", _describe_sql())
def describe_continuous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """count/mean/std/min/quartiles/max with exact distributed quartiles."""
    return rounded(P.describe_continuous(table(spark, sf_dir, "lineitem"), LINE_NUM))


@register("a8_describe_temporal", """
WITH e AS (SELECT epoch_us(o_orderdate) / 1e6 AS v FROM orders WHERE o_orderdate IS NOT NULL)
SELECT 'o_orderdate' AS variable, count(*) AS count, round(avg(v), 3) AS mean_epoch,
  round(min(v), 3) AS min_epoch, round(max(v), 3) AS max_epoch,
  round(quantile_cont(v, 0.25), 3) AS q_epoch25, round(quantile_cont(v, 0.5), 3) AS q_epoch50,
  round(quantile_cont(v, 0.75), 3) AS q_epoch75 FROM e""")
def describe_temporal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamp summary."""
    return rounded(P.describe_temporal(table(spark, sf_dir, "orders"), ["o_orderdate"]), 3)


def _by_class_sql():
    parts = []
    for c in ["l_quantity", "l_discount", "l_extendedprice"]:
        parts.append(
            f"SELECT l_returnflag, '{c}' AS variable, round(avg({c}), 6) AS mean, "
            f"round(min({c}), 6) AS min, round(max({c}), 6) AS max, "
            f"round(stddev_samp({c}), 6) AS std, round(quantile_cont({c}, 0.5), 6) AS median "
            f"FROM lineitem GROUP BY l_returnflag")
    return _union(parts)


@register("a9_stats_by_class", _by_class_sql())
def stats_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """mean/median/min/max/std of continuous columns per class."""
    li = table(spark, sf_dir, "lineitem")
    return rounded(P.stats_by_class(li, ["l_quantity", "l_discount", "l_extendedprice"],
                                    "l_returnflag"))


@register("a10_categorical_by_class", """
SELECT o_orderstatus, 'o_orderpriority' AS variable, count(o_orderpriority) AS count,
       count(DISTINCT o_orderpriority) AS nunique FROM orders GROUP BY o_orderstatus
UNION ALL
SELECT o_orderstatus, 'o_custkey', count(o_custkey), count(DISTINCT o_custkey)
FROM orders GROUP BY o_orderstatus""")
def categorical_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """count / nunique of categoricals per class (A10)."""
    return P.categorical_summary_by_class(table(spark, sf_dir, "orders"),
                                          ["o_orderpriority", "o_custkey"], "o_orderstatus")


@register("a11_counts_by_class", """
SELECT 'o_orderpriority' AS variable, o_orderpriority AS value, o_orderstatus, count(*) AS n
FROM orders GROUP BY 2, 3""")
def counts_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by (variable, level, class)."""
    return P.counts_by_class(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderstatus")


def _rare_sql():
    parts = [f"SELECT '{c}' AS variable, CAST({c} AS VARCHAR) AS value, count(*) AS n FROM part "
             f"WHERE {c} IS NOT NULL GROUP BY 2" for c in ["p_brand", "p_type", "p_size"]]
    return f"""WITH c AS ({_union(parts)})
SELECT variable, value, n, round(n / sum(n) OVER (PARTITION BY variable), 6) AS share,
       n / sum(n) OVER (PARTITION BY variable) < 0.05 AS rare FROM c"""


@register("a12_rare_levels", _rare_sql())
def rare_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level shares with the 5% rare flag."""
    return rounded(P.rare_levels(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"]))


@register("a13_histogram", """
WITH v AS (SELECT l_extendedprice AS v FROM lineitem
           WHERE l_extendedprice IS NOT NULL AND NOT isnan(l_extendedprice)),
r AS (SELECT min(v) AS mn, max(v) AS mx FROM v),
b AS (SELECT CAST(CASE WHEN mx = mn THEN 1 ELSE least(floor((v - mn) / (mx - mn) * 25) + 1, 25) END
              AS INTEGER) AS bin FROM v, r),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin),
g AS (SELECT CAST(i AS INTEGER) AS bin, mn, mx FROM r, range(1, 26) t(i))
SELECT g.bin, round(mn + (g.bin - 1) * ((mx - mn) / 25), 6) AS bin_low,
       round(mn + g.bin * ((mx - mn) / 25), 6) AS bin_high, coalesce(c.n, 0) AS n
FROM g LEFT JOIN c ON g.bin = c.bin""")
def histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """25-bin zero-filled histogram."""
    return rounded(P.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 25))


@register("a14_ecdf", """
WITH v AS (SELECT value FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
c AS (SELECT value, count(*) AS n FROM v GROUP BY value)
SELECT value, n, CAST(sum(n) OVER (ORDER BY value) AS BIGINT) AS cum_n,
  round(sum(n) OVER (ORDER BY value) / (SELECT count(*) FROM v), 6) AS ecdf,
  round((SELECT avg(value) FROM v), 6) AS normal_mean,
  round((SELECT stddev_samp(value) FROM v), 6) AS normal_std
FROM c""")
def ecdf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empirical CDF with the normal-fit parameters."""
    return rounded(P.ecdf(table(spark, sf_dir, "events"), "value"))


def _moments_sql():
    parts = []
    for c in ["l_quantity", "l_extendedprice", "l_discount"]:
        parts.append(f"""SELECT '{c}' AS variable,
  round(avg(power({c} - m, 3)) / power(avg(power({c} - m, 2)), 1.5), 6) AS skewness,
  round(avg(power({c} - m, 4)) / power(avg(power({c} - m, 2)), 2) - 3, 6) AS kurtosis
FROM lineitem, (SELECT avg({c}) AS m FROM lineitem) WHERE {c} IS NOT NULL""")
    return _union(parts)


@register("a15_skew_kurtosis", _moments_sql())
def skew_kurtosis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Population skewness and excess kurtosis."""
    return rounded(P.shape_moments(table(spark, sf_dir, "lineitem"),
                                   ["l_quantity", "l_extendedprice", "l_discount"]))


@register("a16_kde", """
WITH v AS (SELECT value AS v FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
p AS (SELECT min(v) AS mn, max(v) AS mx, count(*) AS n, stddev_samp(v) AS sd FROM v),
p2 AS (SELECT *, sd * pow(CAST(n AS DOUBLE), -0.2) * 1.0 AS h FROM p),
p3 AS (SELECT *, mn - 3.0 * h AS lo, ((mx + 3.0 * h) - (mn - 3.0 * h)) / 199 AS step FROM p2),
b AS (SELECT CAST(CASE WHEN mx = mn THEN 1 ELSE least(floor((v - mn) / (mx - mn) * 2048) + 1, 2048) END
              AS INTEGER) AS bin, count(*) AS c FROM v, p GROUP BY 1),
cen AS (SELECT bin, c, CASE WHEN mx = mn THEN mn ELSE mn + (bin - 0.5) * ((mx - mn) / 2048) END AS center
        FROM b, p),
g AS (SELECT CAST(i AS INTEGER) AS grid_index FROM range(0, 200) t(i))
SELECT grid_index, round(lo + grid_index * step, 6) AS x,
  round(sum(c * 0.3989422804014327 * exp(-0.5 * pow((lo + grid_index * step - center) / h, 2)))
        / (n * h), 6) AS density
FROM g, cen, p3 GROUP BY grid_index, lo, step, n, h""")
def kde(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binned Gaussian KDE on a 200-point grid."""
    return rounded(P.kde(table(spark, sf_dir, "events"), "value"))


def _box_sql():
    parts = []
    for c in ["l_quantity", "l_extendedprice", "l_discount"]:
        parts.append(f"""SELECT '{c}' AS variable, q25, q50, q75, q75 - q25 AS iqr,
  q25 - 1.5 * (q75 - q25) AS lower_fence, q75 + 1.5 * (q75 - q25) AS upper_fence,
  (SELECT min({c}) FROM lineitem WHERE {c} >= q25 - 1.5 * (q75 - q25) AND {c} <= q75 + 1.5 * (q75 - q25)) AS whisker_low,
  (SELECT max({c}) FROM lineitem WHERE {c} >= q25 - 1.5 * (q75 - q25) AND {c} <= q75 + 1.5 * (q75 - q25)) AS whisker_high,
  (SELECT count(*) FROM lineitem WHERE {c} < q25 - 1.5 * (q75 - q25) OR {c} > q75 + 1.5 * (q75 - q25)) AS n_outliers
FROM (SELECT quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50,
             quantile_cont({c}, 0.75) AS q75 FROM lineitem)""")
    body = _union(parts)
    return f"""SELECT variable, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75,
  round(iqr, 6) AS iqr, round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence,
  round(whisker_low, 6) AS whisker_low, round(whisker_high, 6) AS whisker_high, n_outliers
FROM ({body})"""


@register("a17_box_stats", _box_sql())
def box_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Box-plot numbers with 1.5 IQR whiskers."""
    return rounded(P.box_stats(table(spark, sf_dir, "lineitem"),
                               ["l_quantity", "l_extendedprice", "l_discount"]))
