"""Registered queries: feature columns, encoders, scalar functions, small reports."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import scalar as S
from orderlens.operators.cast import align_columns, drop_id_columns
from orderlens.operators.split import class_counts, with_class_size
from orderlens.plans.selection import DateFeatures
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


@register("f4_date_features", """
SELECT o_orderkey, CAST(isodow(o_orderdate) - 1 AS INTEGER) AS o_orderdate_day_of_week,
       CAST(quarter(o_orderdate) AS INTEGER) AS o_orderdate_quarter FROM orders""")
def date_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day of week (Monday = 0) and quarter; the timestamp is dropped."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return DateFeatures(inputCols=["o_orderdate"]).transform(o)


_TRAIN = "o_orderpriority <> '5-LOW'"


@register("f13_category_index", """
WITH lv AS (SELECT o_orderpriority AS lvl, row_number() OVER (ORDER BY o_orderpriority) - 1 AS ix
            FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW'))
SELECT o.o_orderkey, CAST(coalesce(lv.ix, (SELECT count(*) FROM lv)) AS DOUBLE) AS priority_idx
FROM orders o LEFT JOIN lv ON o.o_orderpriority = lv.lvl""")
def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels learned on TRAIN rows only, alphabetical; unseen levels go to an
    extra index (F13)."""
    o = table(spark, sf_dir, "orders")
    model = StringIndexer(inputCol="o_orderpriority", outputCol="priority_idx",
                          stringOrderType="alphabetAsc", handleInvalid="keep").fit(o.filter(_TRAIN))
    return model.transform(o).select("o_orderkey", "priority_idx")


@register("f14_label_index", """
SELECT o_orderkey, CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS DOUBLE) AS label_idx
FROM orders""")
def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target codes from the sorted TRAIN classes; unseen classes raise."""
    o = table(spark, sf_dir, "orders")
    model = StringIndexer(inputCol="o_orderstatus", outputCol="label_idx",
                          stringOrderType="alphabetAsc", handleInvalid="error").fit(o)
    return model.transform(o).select("o_orderkey", "label_idx")


@register("p7_drop_id_columns", "SELECT c_name, c_acctbal, c_mktsegment FROM customer")
def drop_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns whose name contains the ID marker are dropped."""
    return drop_id_columns(table(spark, sf_dir, "customer"), pattern="key")


@register("p9_align_columns", "SELECT c_mktsegment, c_acctbal, c_custkey FROM customer")
def align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns in model order; a missing column raises."""
    return align_columns(table(spark, sf_dir, "customer"), ["c_mktsegment", "c_acctbal", "c_custkey"])


_DAYS = "[" + ", ".join(f"'{d}'" for d in S.DAY_NAMES_ES) + "]"
_MONTHS = "[" + ", ".join(f"'{m}'" for m in S.MONTH_NAMES_ES) + "]"


@register("c_scalar_functions", f"""
SELECT o_orderkey,
  {_DAYS}[isodow(o_orderdate)] AS day_name,
  {_MONTHS}[month(o_orderdate)] AS month_name,
  coalesce(nullif(o_orderstatus, 'P'), '__NA__') AS status_token,
  trim('  ' || o_orderpriority || ' ') AS priority_trimmed,
  CAST(trunc(o_totalprice / 100000) AS INTEGER) AS price_band,
  round(least(greatest(o_totalprice, 50000), 400000), 2) AS price_clamped,
  round(sqrt(o_totalprice), 6) AS price_sqrt,
  json_object('o_orderkey', o_orderkey, 'o_orderstatus', o_orderstatus)::VARCHAR AS record_json,
  string_split('models:/orders/' || CAST(o_custkey AS VARCHAR), '/')[-1] AS model_version
FROM orders""")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day/month names, missing token, trim, int truncation, clamp, sqrt,
    JSON record, URI tail (C3-C7, C11-C13)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey",
        S.day_name("o_orderdate").alias("day_name"),
        S.month_name("o_orderdate").alias("month_name"),
        S.with_na_token(F.nullif("o_orderstatus", F.lit("P"))).alias("status_token"),
        S.clean_text(F.concat(F.lit("  "), "o_orderpriority", F.lit(" "))).alias("priority_trimmed"),
        S.truncate_to_int((F.col("o_totalprice") / 100000).cast("string")).alias("price_band"),
        F.round(S.clamp("o_totalprice", 50000, 400000), 2).alias("price_clamped"),
        F.round(F.sqrt("o_totalprice"), 6).alias("price_sqrt"),
        S.to_json_record("o_orderkey", "o_orderstatus").alias("record_json"),
        S.uri_tail(F.concat(F.lit("models:/orders/"), F.col("o_custkey").cast("string")))
        .alias("model_version"))


@register("o3_mode_class", """
SELECT arg_max(o_orderstatus, n) AS mode_class, max(n) AS n
FROM (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1)""")
def mode_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Most frequent class (O3): max_by over the class counts."""
    c = class_counts(table(spark, sf_dir, "orders"), "o_orderstatus")
    return c.agg(F.max_by("o_orderstatus", F.struct("n", "o_orderstatus")).alias("mode_class"),
                 F.max("n").alias("n"))


@register("w2_class_size", """
SELECT o_orderkey, o_orderstatus, count(*) OVER (PARTITION BY o_orderstatus) AS n_class FROM orders""")
def class_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class size as a column (W2) without a per-class window over the rows."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return with_class_size(o, "o_orderstatus")
