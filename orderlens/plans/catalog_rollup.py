"""Registered queries: sources, casting and the customer roll-up.

Every query reads the test tables (or frames Spark derives from them) at
``sf_dir`` in full; each has a DuckDB twin in ``ORACLE``.
"""

from __future__ import annotations

import math
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.config import CastConfig
from orderlens.functions.scalar import to_numeric, to_timestamp_lenient
from orderlens.operators.cast import validate_and_cast
from orderlens.operators.rollup import (aggregate_to_customer, aggregate_with_attributes,
                                        drop_exact_duplicates, keep_last_per_key)
from orderlens.session import shared_path
from orderlens.sources.parquet import (file_row_report, load_report, read_parquet_folder,
                                       schema_report, stack_frames)
from orderlens.sources.tables import (TPCH_ROLLUP, TPCH_SCHEMA, customer_attributes, order_facts,
                                     table, transactions)

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _round(df: DataFrame, cols, digits: int = 2) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# DuckDB twin of sources.tables.transactions + the priority cast.
TX_SQL = """
lines AS (SELECT l_orderkey, sum(l_quantity) AS line_qty, count(*) AS n_lines
          FROM lineitem GROUP BY l_orderkey),
tx AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
         o.o_orderpriority, c.c_nationkey, c.c_mktsegment, c.c_acctbal, n.n_name, r.r_name,
         l.line_qty, l.n_lines,
         TRY_CAST(substring(o.o_orderpriority, 1, 1) AS DOUBLE) AS priority_num
  FROM orders o
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN lines l ON o.o_orderkey = l.l_orderkey)
"""


def cast_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with the text priority digit coerced to a number."""
    tx = transactions(spark, sf_dir).withColumn(
        "priority_num", F.substring("o_orderpriority", 1, 1))
    return validate_and_cast(tx, CastConfig(dtype_map={"priority_num": "float64"},
                                            timestamp_cols=("o_orderdate",)))


def _rollup_sql(source: str) -> str:
    def first(c):
        return (f"first({c} ORDER BY o_orderdate NULLS LAST, o_orderkey) "
                f"FILTER (WHERE {c} IS NOT NULL) AS {c}")

    def last(c):
        return (f"last({c} ORDER BY o_orderdate NULLS LAST, o_orderkey) "
                f"FILTER (WHERE {c} IS NOT NULL) AS {c}")
    return f"""
SELECT o_custkey,
  {first('n_name')}, {first('r_name')}, {first('c_mktsegment')}, {first('c_nationkey')},
  {first('o_orderpriority')}, {first('priority_num')},
  round(coalesce(sum(o_totalprice), 0), 2) AS o_totalprice,
  round(coalesce(sum(line_qty), 0), 2) AS line_qty,
  CAST(coalesce(sum(n_lines), 0) AS BIGINT) AS n_lines,
  max(o_orderdate) AS o_orderdate,
  {last('o_orderstatus')}
FROM {source} WHERE o_custkey IS NOT NULL GROUP BY o_custkey"""


def cast_order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order-level facts with the text priority digit coerced to a number."""
    facts = order_facts(spark, sf_dir).withColumn(
        "priority_num", F.substring("o_orderpriority", 1, 1))
    return validate_and_cast(facts, CastConfig(dtype_map={"priority_num": "float64"},
                                               timestamp_cols=("o_orderdate",)))


def customer_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: transactions -> one row per customer.

    Order facts are rolled up per customer first (map-side combine), then
    the customer / nation / region attributes are attached 1:1; the result
    equals rolling up the denormalised transaction table.
    """
    out = aggregate_with_attributes(cast_order_facts(spark, sf_dir),
                                    customer_attributes(spark, sf_dir), TPCH_ROLLUP, TPCH_SCHEMA)
    return _round(out, ["o_totalprice", "line_qty"])


def customer_rollup_denormalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same roll-up straight over the denormalised transactions (A1)."""
    out = aggregate_to_customer(cast_transactions(spark, sf_dir), TPCH_ROLLUP, TPCH_SCHEMA)
    return _round(out, ["o_totalprice", "line_qty"])


register("a1_customer_rollup", f"WITH {TX_SQL} {_rollup_sql('tx')}")(customer_rollup)
register("a1_customer_rollup_denormalised",
         f"WITH {TX_SQL} {_rollup_sql('tx')}")(customer_rollup_denormalised)


@register("a1_customer_rollup_nulls", f"""WITH {TX_SQL},
txn AS (SELECT o_orderkey, o_custkey,
   nullif(o_orderstatus, 'O') AS o_orderstatus,
   CASE WHEN o_orderpriority = '3-MEDIUM' THEN NULL ELSE o_totalprice END AS o_totalprice,
   CASE WHEN o_orderpriority = '2-HIGH' THEN NULL ELSE o_orderdate END AS o_orderdate,
   nullif(o_orderpriority, '1-URGENT') AS o_orderpriority,
   c_nationkey, c_mktsegment, c_acctbal, nullif(n_name, 'NATION_3') AS n_name, r_name,
   CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE line_qty END AS line_qty,
   n_lines,
   CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE priority_num END AS priority_num
 FROM tx)
{_rollup_sql('txn')}""")
def customer_rollup_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll-up with injected missing values: null first/last values, null
    dates (sorted last), NaN and null in sums (§2.9 rules 1-3)."""
    tx = cast_transactions(spark, sf_dir)
    pr = F.col("o_orderpriority")
    tx = tx.withColumns({
        "o_orderstatus": F.nullif(F.col("o_orderstatus"), F.lit("O")),
        "o_totalprice": F.when(pr == "3-MEDIUM", F.lit(float("nan"))).otherwise(F.col("o_totalprice")),
        "o_orderdate": F.when(pr == "2-HIGH", F.lit(None)).otherwise(F.col("o_orderdate")),
        "n_name": F.nullif(F.col("n_name"), F.lit("NATION_3")),
        "line_qty": F.when(pr == "4-NOT SPECIFIED", F.lit(float("nan"))).otherwise(F.col("line_qty")),
        "priority_num": F.when(pr == "1-URGENT", F.lit(None)).otherwise(F.col("priority_num")),
    }).withColumn("o_orderpriority", F.nullif(pr, F.lit("1-URGENT")))
    out = aggregate_to_customer(tx, TPCH_ROLLUP, TPCH_SCHEMA)
    return _round(out, ["o_totalprice", "line_qty"])


@register("s1_read_dedup_orders", "SELECT DISTINCT * FROM orders")
def read_dedup_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder read with per-file exact de-dup."""
    return read_parquet_folder(spark, os.path.join(sf_dir, "orders.parquet"))


@register("s3_stack_copies", """
SELECT * FROM (SELECT DISTINCT * FROM events)
UNION ALL SELECT * FROM (SELECT DISTINCT * FROM events)""")
def stack_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two copies of one file stacked: per-file de-dup keeps both copies."""
    ev = table(spark, sf_dir, "events")
    return stack_frames([ev, ev], per_frame_dedup=True)


@register("s4_file_row_report", """
SELECT 'orders.parquet' AS file_name, count(*) AS n_rows FROM (SELECT DISTINCT * FROM orders)
UNION ALL
SELECT '__total__' AS file_name, count(*) AS n_rows FROM (SELECT DISTINCT * FROM orders)""")
def file_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per file after de-dup, with the stacked total."""
    df = read_parquet_folder(spark, os.path.join(sf_dir, "orders.parquet"), keep_source=True)
    return file_row_report(df)


@register("s5_load_report", """
SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS n_keys,
       round(count(*) / count(DISTINCT o_custkey), 4) AS rows_per_key FROM orders""")
def load_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unique customers, rows, rows per customer."""
    return load_report(table(spark, sf_dir, "orders"), "o_custkey")


#: orders per file of the folder that is written and read back: a file is written, and its copies are
#: looked for, by one task
FILE_ROWS = 250_000


@register("s1_read_folder", """
SELECT * FROM orders UNION ALL SELECT * FROM orders UNION ALL
SELECT * FROM orders WHERE o_orderkey % 3 = 0""")
def read_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of files: copies inside a file go, copies in different files stay, other names and
    sub-folders are not read (S1/S2/S7)."""
    o = table(spark, sf_dir, "orders")
    folder = shared_path(spark, f"orderlens-folder-{uuid.uuid4().hex[:12]}")
    third = o.filter("o_orderkey % 3 = 0")
    files = max(1, math.ceil(o.count() / FILE_ROWS))
    for part in (o.unionByName(third), o, third.unionByName(third).unionByName(third)):
        # copies of a row have one hash: they stay in one file however many there are
        part.repartition(files, *o.columns).write.mode("append").parquet(folder)
    third.write.json(f"{folder}/deeper")
    return read_parquet_folder(spark, folder)


@register("p2_cast_fallback", """
SELECT o_orderkey, o_orderpriority, CAST(o_custkey AS VARCHAR) AS o_custkey,
  CAST(trunc(o_totalprice) AS BIGINT) AS o_totalprice FROM orders""")
def cast_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Casts by map: text that is no number keeps its column, absent columns are skipped."""
    o = table(spark, sf_dir, "orders").withColumn("o_totalprice", F.floor("o_totalprice").cast("string"))
    config = CastConfig(dtype_map={"o_orderpriority": "int", "o_custkey": "string", "o_totalprice": "bigint",
                                   "no_such_column": "double"}, timestamp_cols=())
    return validate_and_cast(o, config).select("o_orderkey", "o_orderpriority", "o_custkey", "o_totalprice")


@register("s6_schema_report")
def schema_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every test file's schema against the first file's (S6); metadata only."""
    return schema_report(spark, sf_dir)


@register("p1_numeric_coercion", """
SELECT event_id,
  TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_num,
  TRY_CAST(NULL AS DOUBLE) AS type_num,
  CAST(user_id AS DOUBLE) AS padded_num
FROM events""")
def numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lenient numeric coercion of text (P1): JSON numbers parse, words -> null."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        to_numeric(F.get_json_object("props", "$.k")).alias("k_num"),
        to_numeric("event_type").alias("type_num"),
        to_numeric(F.concat(F.lit(" "), F.col("user_id").cast("string"), F.lit(" ")))
        .alias("padded_num"))


@register("p3_lenient_timestamp", """
SELECT o_orderkey,
  CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE o_orderdate END AS parsed_date
FROM orders""")
def lenient_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamp parse where bad text becomes null."""
    o = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("not a date")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return o.select("o_orderkey", to_timestamp_lenient(text).alias("parsed_date"))


@register("a2_keep_last_event_per_user", """
SELECT event_id, ts, user_id, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events) WHERE rn = 1""")
def keep_last_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last row per key (A2) without a per-key window."""
    ev = table(spark, sf_dir, "events")
    return keep_last_per_key(ev, ["user_id"], ["ts", "event_id"]).select(*ev.columns)


@register("a3_drop_exact_duplicates", """
SELECT DISTINCT user_id, event_type FROM events""")
def exact_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact duplicate rows removed (A3)."""
    return drop_exact_duplicates(table(spark, sf_dir, "events").select("user_id", "event_type"))
