"""Registered queries: prepared file folders, streams over them, the model table.

The folders are written from the given tables, so the work grows with them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators.validate import RecordRules, split_valid, validate_records
from orderlens.plans import registry
from orderlens.plans.catalog_ml import CLASSES
from orderlens.session import shared_path
from orderlens.sources.footers import list_files
from orderlens.sources.parquet import schema_report
from orderlens.sources.tables import table
from orderlens.streaming.windows import stream_scores, stream_windowed_counts

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _folder(spark: SparkSession, tag: str) -> str:
    return shared_path(spark, f"orderlens-{tag}-{uuid.uuid4().hex[:12]}")


def _broken_file(spark: SparkSession, path: str) -> None:
    """A file with a parquet name that is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.writeBytes("this is no parquet file")
    out.close()


# --- S6: schemas of many files ---------------------------------------------

@register("s6_schema_drift", """
WITH years AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
same AS (SELECT * FROM (VALUES ('o_orderkey', 'bigint'), ('o_custkey', 'bigint'), ('o_totalprice', 'double'),
                               ('o_orderdate', 'timestamp_ntz')) t(c, ty))
SELECT CAST(y AS VARCHAR) AS part, c AS "column", ty AS ref_type,
  CASE WHEN y % 3 = 1 AND c = 'o_totalprice' THEN NULL WHEN y % 3 = 2 AND c = 'o_custkey' THEN 'string' ELSE ty END
    AS file_type,
  CASE WHEN y % 3 = 1 AND c = 'o_totalprice' THEN 'missing' WHEN y % 3 = 2 AND c = 'o_custkey' THEN 'retyped'
       ELSE 'same' END AS status FROM years, same
UNION ALL SELECT CAST(y AS VARCHAR), 'o_net', NULL, 'double', 'extra' FROM years WHERE y % 3 = 1
UNION ALL SELECT '0000', c, ty, ty, 'same' FROM same
UNION ALL SELECT '9999', NULL, NULL, NULL, 'unreadable'""")
def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per order year, some with drifted columns, and a broken file, against the first."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    folder = _folder(spark, "drift")
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    fs = fs_path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(fs_path(folder))

    def one_file(df: DataFrame, name: str) -> None:
        df.coalesce(1).write.parquet(f"{folder}/_make-{name}")
        part = list_files(spark, f"{folder}/_make-{name}").first()["path"]
        fs.rename(fs_path(part), fs_path(f"{folder}/{name}.parquet"))

    one_file(o.filter(F.lit(False)), "0000")
    for y in [r[0] for r in o.select(F.year("o_orderdate")).distinct().collect()]:
        rows = o.filter(F.year("o_orderdate") == y)
        if y % 3 == 1:
            rows = rows.withColumn("o_net", F.col("o_totalprice") * 0.9).drop("o_totalprice")
        elif y % 3 == 2:
            rows = rows.withColumn("o_custkey", F.col("o_custkey").cast("string"))
        one_file(rows, str(y))
    _broken_file(spark, f"{folder}/9999.parquet")
    return schema_report(spark, folder).withColumn(
        "part", F.substring_index("file_name", ".", 1)).drop("file_name")


# --- R1: a stream of record files ---------------------------------------------

STREAM_RULES = RecordRules(allowed={"l_linestatus": ["F", "O"]}, ranges={"l_quantity": (1, 45)})


def rule_scores(records: DataFrame):
    """(scored, quarantined) of a rule model over lineitem records."""
    valid, bad = split_valid(validate_records(records, STREAM_RULES))
    k = F.when(F.col("l_discount") < 0.03, 0).when(F.col("l_discount") < 0.07, 1).otherwise(2)
    names = F.array(*map(F.lit, CLASSES))
    return (valid.select("l_orderkey", "l_linenumber", F.get(names, k).alias("predicted_class")),
            bad.select("l_orderkey", "l_linenumber", F.concat_ws("; ", "errors").alias("reason")))


@register("r1_stream_scores", """
SELECT 'scored' AS kind, l_orderkey, l_linenumber,
  CASE WHEN l_discount < 0.03 THEN 'A' WHEN l_discount < 0.07 THEN 'N' ELSE 'R' END AS outcome
FROM lineitem WHERE l_quantity BETWEEN 1 AND 45
UNION ALL SELECT 'quarantined', l_orderkey, l_linenumber, 'l_quantity: out of range ' || CAST(l_quantity AS VARCHAR)
FROM lineitem WHERE l_quantity NOT BETWEEN 1 AND 45
UNION ALL SELECT 'file', NULL, NULL, 'unreadable'
UNION ALL SELECT 'file', NULL, NULL, 'l_discount: retyped'""")
def scored_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record files scored by the rule model as they arrive, over three starts from one checkpoint;
    bad records, a broken file and a drifted file are quarantined, nothing is scored twice (R1/V1/I4)."""
    folder, out = _folder(spark, "records"), _folder(spark, "scores")
    li = table(spark, sf_dir, "lineitem")
    half = F.pmod("l_orderkey", F.lit(2)) == 0
    li.filter(half).write.mode("append").parquet(folder)
    # named, or a restart takes the columns of the first file by name, which may be the drifted one
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in li.schema)
    stream_scores(spark, folder, rule_scores, schema=ddl, out_path=out)
    li.filter(~half).write.mode("append").parquet(folder)
    (li.filter("l_quantity > 45").withColumn("l_discount", F.col("l_discount").cast("string")).coalesce(1)
     .write.mode("append").parquet(folder))
    _broken_file(spark, f"{folder}/part-broken.parquet")
    stream_scores(spark, folder, rule_scores, schema=ddl, out_path=out, max_files_per_trigger=3)
    scores, bad = stream_scores(spark, folder, rule_scores, schema=ddl, out_path=out)   # nothing new: adds nothing
    files = spark.read.parquet(f"{bad}-files").select(
        F.lit("file").alias("kind"), F.lit(None).cast("long").alias("l_orderkey"),
        F.lit(None).cast("int").alias("l_linenumber"),
        F.regexp_replace(F.concat_ws("; ", "reasons"), "^unreadable.*", "unreadable").alias("outcome"))
    return (spark.read.parquet(scores).select(F.lit("scored").alias("kind"), "l_orderkey", "l_linenumber",
                                              F.col("predicted_class").alias("outcome"))
            .unionByName(spark.read.parquet(bad).select(F.lit("quarantined").alias("kind"), "l_orderkey",
                                                        "l_linenumber", F.col("reason").alias("outcome")))
            .unionByName(files))


# --- R2: closed windows of an endless stream --------------------------------------

@register("r2_windowed_counts_append", """
WITH e AS (SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 1 DAY AS window_end, event_type, n FROM e
WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""")
def windowed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-mode daily counts over three starts from one checkpoint: old days, new days, late copies of the
    old days.  Each closed window is written once, late rows are dropped, open windows are not there (R2)."""
    folder, out = _folder(spark, "events"), _folder(spark, "windows")
    ev = table(spark, sf_dir, "events")
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).first()
    cut = F.date_trunc("day", F.lit(lo + (hi - lo) / 2).cast("timestamp_ntz")).cast("timestamp_ntz")
    waves = [ev.filter(F.col("ts") < cut), ev.filter(F.col("ts") >= cut),
             ev.filter(F.col("ts") < cut - F.expr("INTERVAL 2 DAYS"))]
    for wave in waves:
        wave.write.mode("append").parquet(folder)
        stream_windowed_counts(spark, folder, "ts", "event_type", window="1 day", watermark="1 hour",
                               mode="append", out_path=out)
    return spark.read.parquet(out)


# --- M6: the model table -------------------------------------------------------

@register("m6_model_table", """
WITH o AS (SELECT o_orderpriority AS name, year(o_orderdate) AS y, count(*) AS n, sum(o_totalprice) AS v FROM orders
           GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY name ORDER BY y) AS INTEGER) AS version,
        row_number() OVER (PARTITION BY name ORDER BY n DESC, y) AS by_n,
        row_number() OVER (PARTITION BY name ORDER BY v DESC, y) AS by_v FROM o),
s AS (SELECT *, CASE WHEN name < '3' AND by_v = 1 THEN 'Production' WHEN name < '3' AND by_n = 1 THEN 'Archived'
                     WHEN name < '5' AND by_n = 1 THEN 'Production' ELSE 'None' END AS stage FROM r),
p AS (SELECT name, coalesce(max(version) FILTER (stage = 'Production'), max(version)) AS version FROM s GROUP BY name)
SELECT s.name, s.version, s.stage, '/models/' || s.name || '/' || CAST(y AS VARCHAR) AS path,
  p.version IS NOT NULL AS picked
FROM s LEFT JOIN p ON p.name = s.name AND p.version = s.version""")
def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model per order priority and year: registered, promoted, promoted anew, resolved (M6)."""
    root = _folder(spark, "models")
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("name"),
                                               F.year("o_orderdate").alias("order")).agg(
        F.count("*").alias("n"), F.sum("o_totalprice").alias("v"),
        F.array_sort(F.collect_set("o_orderstatus")).alias("classes"))
    o = o.withColumn("path", F.concat(F.lit("/models/"), "name", F.lit("/"), F.col("order").cast("string")))
    registry.register(o, root)
    # versions follow the order years within a name
    have = registry.current(spark, root).join(o.select("path", "order", "n", "v"), "path")

    def best(rows, by):
        return rows.groupBy("name").agg(F.max_by("version", F.struct(by, -F.col("order"))).alias("version"))
    registry.promote(best(have.filter("name < '5'"), "n"), root)
    registry.promote(best(have.filter("name < '3'"), "v"), root)
    now = registry.current(spark, root)
    picked = registry.resolve_all(now).select("name", "version", F.lit(True).alias("picked"))
    return (now.join(picked, ["name", "version"], "left").na.fill(False, ["picked"])
            .select("name", "version", "stage", "path", "picked"))
