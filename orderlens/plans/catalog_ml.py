"""Registered queries: evaluation, validation, payloads, scoring, streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.scalar import all_finite_nonneg, argmax_index, index_to_label
from orderlens.operators import evaluate as E
from orderlens.operators.validate import (RecordRules, payload_size_ok, payload_to_rows,
                                          validate_records)
from orderlens.plans.catalog_profile import rounded
from orderlens.plans.scoring import batch_summary, confidence_by_class, predictions_vs_truth
from orderlens.sources.tables import table
from orderlens.streaming.windows import stream_windowed_counts, windowed_counts

QUERIES: dict = {}
ORACLE: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- rule-based predictions over lineitem: metric checks with a SQL twin -------

CLASSES = ["A", "N", "R"]


def rule_predictions(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    """True class = return flag; predicted class and probabilities by a fixed
    rule on discount / tax.  Only a fixture for the metric operators."""
    li = table(spark, sf_dir, "lineitem")
    actual = (F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1)
              .otherwise(2))
    pred = F.when(F.col("l_discount") < 0.03, 0).when(F.col("l_discount") < 0.07, 1).otherwise(2)
    probs = F.array(F.lit(0.2) + F.col("l_discount"), F.lit(0.3) + F.col("l_tax"),
                    F.lit(0.5) - F.col("l_discount") - F.col("l_tax"))
    return li.select("l_orderkey", "l_linenumber", *more, actual.alias("actual"),
                     pred.alias("predicted"), probs.alias("probs"))


RULE_SQL = """rp AS (SELECT l_orderkey, l_linenumber,
  CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN 1 ELSE 2 END AS actual,
  CASE WHEN l_discount < 0.03 THEN 0 WHEN l_discount < 0.07 THEN 1 ELSE 2 END AS predicted,
  [0.2 + l_discount, 0.3 + l_tax, 0.5 - l_discount - l_tax] AS probs FROM lineitem)"""


@register("e1_log_loss", f"""WITH {RULE_SQL}
SELECT round(avg(-ln(least(greatest(probs[actual + 1], 1e-15), 1 - 1e-15))), 6) AS log_loss FROM rp""")
def log_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean clipped log loss."""
    return rounded(E.log_loss(rule_predictions(spark, sf_dir), "actual", "probs"))


@register("e2_accuracy", f"""WITH {RULE_SQL}
SELECT round(avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM rp""")
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy (E2)."""
    return rounded(E.accuracy(rule_predictions(spark, sf_dir), "actual", "predicted"))


_CONF_SQL = f"""{RULE_SQL},
g AS (SELECT CAST(a AS INTEGER) AS actual, CAST(p AS INTEGER) AS predicted
      FROM range(0, 3) t1(a), range(0, 3) t2(p)),
c AS (SELECT actual, predicted, count(*) AS n FROM rp GROUP BY 1, 2),
cm AS (SELECT g.actual, g.predicted, coalesce(c.n, 0) AS n FROM g LEFT JOIN c USING (actual, predicted))"""


@register("e4_confusion_matrix", f"""WITH {_CONF_SQL}
SELECT actual, predicted, n, (['A', 'N', 'R'])[actual + 1] AS actual_class,
       (['A', 'N', 'R'])[predicted + 1] AS predicted_class FROM cm""")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k x k confusion counts with zero cells."""
    return E.confusion_counts(rule_predictions(spark, sf_dir), "actual", "predicted", CLASSES)


@register("e3_class_report", f"""WITH {_CONF_SQL},
rep AS (SELECT t.actual AS cls,
          CASE WHEN p.pn > 0 THEN t.n / p.pn ELSE 0.0 END AS precision,
          CASE WHEN s.sn > 0 THEN t.n / s.sn ELSE 0.0 END AS recall, s.sn AS support
        FROM (SELECT actual, n FROM cm WHERE actual = predicted) t
        JOIN (SELECT actual, sum(n) AS sn FROM cm GROUP BY actual) s ON s.actual = t.actual
        JOIN (SELECT predicted, sum(n) AS pn FROM cm GROUP BY predicted) p ON p.predicted = t.actual),
r2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
                      ELSE 0.0 END AS f1 FROM rep)
SELECT CAST(cls AS VARCHAR) AS scope, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM r2
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM r2
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM r2""")
def class_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-class precision / recall / F1 / support, macro and weighted."""
    cm = E.confusion_counts(rule_predictions(spark, sf_dir), "actual", "predicted", k=3)
    return rounded(E.per_class_report(cm))


_PER_SQL = """SELECT split, 'precision' AS metric, c.class, precision AS value FROM cls c
UNION ALL SELECT split, 'recall', class, recall FROM cls UNION ALL SELECT split, 'f1', class, f1 FROM cls
UNION ALL SELECT split, 'support', class, support FROM cls"""
_AVG_SQL = "\n".join(f"""UNION ALL SELECT split, 'macro_{m}', NULL, avg({m}) FROM cls GROUP BY split
UNION ALL SELECT split, 'weighted_{m}', NULL, sum({m} * support) / sum(support) FROM cls GROUP BY split"""
                     for m in ("precision", "recall", "f1"))


@register("e6_split_metrics_rules", f"""WITH rp AS (SELECT l_linestatus AS split,
  CASE WHEN l_returnflag = 'A' THEN 0 WHEN l_returnflag = 'N' THEN 1 ELSE 2 END AS actual,
  CASE WHEN l_discount < 0.03 THEN 0 WHEN l_discount < 0.07 THEN 1 ELSE 2 END AS predicted,
  [0.2 + l_discount, 0.3 + l_tax, 0.5 - l_discount - l_tax] AS probs FROM lineitem),
g AS (SELECT split, CAST(i AS INTEGER) AS i FROM (SELECT DISTINCT split FROM rp), range(0, 3) t(i)),
n AS (SELECT g.split, (['A', 'N', 'R'])[g.i + 1] AS class, count(*) FILTER (actual = g.i) AS support,
        count(*) FILTER (predicted = g.i) AS said, count(*) FILTER (actual = g.i AND predicted = g.i) AS tp
      FROM g JOIN rp ON rp.split = g.split GROUP BY 1, 2),
pr AS (SELECT split, class, CAST(support AS DOUBLE) AS support, CASE WHEN said > 0 THEN tp / said ELSE 0.0 END AS precision,
         CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM n),
cls AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
        FROM pr),
al AS ({_PER_SQL}
{_AVG_SQL}
UNION ALL SELECT split, 'rows', NULL, CAST(count(*) AS DOUBLE) FROM rp GROUP BY split
UNION ALL SELECT split, 'bad_width', NULL, 0.0 FROM rp GROUP BY split
UNION ALL SELECT split, 'accuracy', NULL, avg(CASE WHEN actual = predicted THEN 1.0 ELSE 0.0 END) FROM rp GROUP BY split
UNION ALL SELECT split, 'log_loss', NULL, avg(-ln(least(greatest(probs[actual + 1], 1e-15), 1 - 1e-15))) FROM rp
          GROUP BY split)
SELECT split, metric, class, round(CAST(value AS DOUBLE), 6) AS value FROM al""")
def split_metrics_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every metric of every split of the rule model from one scan; line status plays the split."""
    rows = rule_predictions(spark, sf_dir, "l_linestatus").withColumnRenamed("l_linestatus", "split")
    return rounded(E.evaluate_splits(rows, "actual", "predicted", "probs", CLASSES))


@register("c8_argmax_labels", f"""WITH {RULE_SQL}
SELECT l_orderkey, l_linenumber, CAST(list_position(probs, list_max(probs)) - 1 AS INTEGER) AS pred_idx,
  (['A', 'N', 'R'])[list_position(probs, list_max(probs))] AS predicted_class,
  round(list_max(probs), 6) AS confidence,
  len(list_filter(probs, lambda x: x < 0 OR isnan(x) OR isinf(x))) = 0 AS probs_ok,
  len(probs) = 3 AS width_ok
FROM rp""")
def argmax_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arg-max class, name, confidence, probability validity."""
    rp = rule_predictions(spark, sf_dir)
    return rp.select(
        "l_orderkey", "l_linenumber", argmax_index("probs").alias("pred_idx"),
        index_to_label(argmax_index("probs"), CLASSES).alias("predicted_class"),
        F.round(F.array_max("probs"), 6).alias("confidence"),
        all_finite_nonneg("probs").alias("probs_ok"),
        (F.size("probs") == 3).alias("width_ok"))


# --- validation and payloads ---------------------------------------------------

TEST_RULES = RecordRules(
    allowed={"n_name": ["NATION_0", "NATION_1", "NATION_2", "NATION_3"],
             "c_mktsegment": ["AUTOMOBILE", "BUILDING", "MACHINERY"],
             "stars": [1, 2, 3]},
    ranges={"c_acctbal": (0, None)},
    int_cols=("stars",))


def customer_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        "c_custkey", F.concat(F.lit(" "), F.col("n_name")).alias("n_name"), "c_mktsegment",
        "c_acctbal", (F.col("c_acctbal") / 3000).cast("string").alias("stars"))


_V1_SQL = """WITH rec AS (
  SELECT c.c_custkey, n.n_name, c.c_mktsegment, c.c_acctbal,
         CAST(trunc(c.c_acctbal / 3000) AS INTEGER) AS stars
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey),
chk AS (SELECT c_custkey, list_filter([
    CASE WHEN n_name IS NULL THEN 'n_name: missing'
         WHEN n_name NOT IN ('NATION_0', 'NATION_1', 'NATION_2', 'NATION_3')
         THEN 'n_name: not allowed ' || n_name END,
    CASE WHEN c_mktsegment IS NULL THEN 'c_mktsegment: missing'
         WHEN c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')
         THEN 'c_mktsegment: not allowed ' || c_mktsegment END,
    CASE WHEN stars IS NULL THEN 'stars: missing'
         WHEN stars NOT IN (1, 2, 3) THEN 'stars: not allowed ' || CAST(stars AS VARCHAR) END,
    CASE WHEN c_acctbal IS NULL THEN 'c_acctbal: missing'
         WHEN c_acctbal < 0 THEN 'c_acctbal: out of range ' || CAST(c_acctbal AS VARCHAR) END
  ], lambda x: x IS NOT NULL) AS errors FROM rec)"""


@register("v1_validate_records", _V1_SQL + "\nSELECT c_custkey, errors FROM chk")
def validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Allowed values, ranges, trimming, int truncation; reasons per record (V1)."""
    return validate_records(customer_records(spark, sf_dir), TEST_RULES).select("c_custkey", "errors")


@register("v1_quarantine_split", _V1_SQL + """
SELECT len(errors) = 0 AS is_valid, count(*) AS n FROM chk GROUP BY 1""")
def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """valid + quarantine = input (V1/I4)."""
    checked = validate_records(customer_records(spark, sf_dir), TEST_RULES)
    return checked.groupBy((F.size("errors") == 0).alias("is_valid")).agg(
        F.count(F.lit(1)).alias("n"))


@register("i1_payload_explode", """
SELECT c_custkey, 0 AS record_pos,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN c_mktsegment END AS segment,
       c_acctbal AS balance FROM customer
UNION ALL
SELECT c_custkey, 1, CASE WHEN lower(c_mktsegment) IN ('AUTOMOBILE', 'BUILDING') THEN lower(c_mktsegment) END,
       -c_acctbal FROM customer""")
def payload_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads of records (array<struct>) to rows, unknown levels to null."""
    c = table(spark, sf_dir, "customer")
    payloads = c.select("c_custkey", F.array(
        F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance")),
        F.struct(F.lower("c_mktsegment").alias("segment"), (-F.col("c_acctbal")).alias("balance")),
    ).alias("records"))
    ok = payloads.filter(payload_size_ok("records"))
    return payload_to_rows(ok, "records", {"segment": ["AUTOMOBILE", "BUILDING"]}, keep=["c_custkey"])


# --- R2: windowed counts, batch and streaming --------------------------------------

_R2_SQL = """SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end,
       event_type, count(*) AS n FROM events GROUP BY 1, 2, 3"""


@register("r2_windowed_counts_batch", _R2_SQL)
def windowed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per (day window, type), batch form (R2)."""
    return windowed_counts(table(spark, sf_dir, "events"), "ts", "event_type", "1 day")


@register("r2_windowed_counts_stream", _R2_SQL)
def windowed_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same counts through Structured Streaming (availableNow, watermark) (R2)."""
    out = stream_windowed_counts(spark, sf_dir, "ts", "event_type", glob="events.parquet",
                                 window="1 day", watermark="1 hour", mode="complete")
    return spark.read.parquet(out)


# --- summaries of scored rows, over every row of the rule model --------------

def rule_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule model's predictions in the shape of scored records."""
    names = F.array(*map(F.lit, CLASSES))
    return rule_predictions(spark, sf_dir).select(
        F.get(names, F.col("actual")).alias("actual_class"),
        F.get(names, F.col("predicted")).alias("predicted_class"),
        F.array_max("probs").alias("confidence"), F.lit("rules-1").alias("model_version"))


_SCORED_SQL = f"""{RULE_SQL},
sc AS (SELECT (['A', 'N', 'R'])[actual + 1] AS actual_class, (['A', 'N', 'R'])[predicted + 1] AS predicted_class,
              list_max(probs) AS confidence FROM rp)"""


@register("a18_batch_summary_rules", f"""WITH {_SCORED_SQL}
SELECT count(*) AS total_samples, count(*) AS successful_predictions, 100.0::DOUBLE AS success_rate,
  count(*) FILTER (WHERE predicted_class = 'A') AS n_a, count(*) FILTER (WHERE predicted_class = 'N') AS n_n,
  count(*) FILTER (WHERE predicted_class = 'R') AS n_r,
  round(min(confidence), 6) AS conf_min, round(max(confidence), 6) AS conf_max,
  round(avg(confidence), 6) AS conf_avg, round(stddev_pop(confidence), 6) AS conf_std,
  'rules-1' AS model_version FROM sc""")
def summary_of_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batch summary of all rows scored by the rule model."""
    scored = rule_scored(spark, sf_dir)
    got = batch_summary(scored, scored)
    counts = [F.coalesce(F.col("prediction_distribution")[c], F.lit(0)).alias(f"n_{c.lower()}") for c in CLASSES]
    stats = [F.col("confidence_stats")[k].alias(f"conf_{k}") for k in ("min", "max", "avg", "std")]
    return rounded(got.select("total_samples", "successful_predictions",
                              F.col("success_rate").cast("double").alias("success_rate"),
                              *counts, *stats, "model_version"))


@register("d2_confidence_by_class_rules", f"""WITH {_SCORED_SQL}
SELECT predicted_class, count(*) AS n, round(avg(confidence), 6) AS mean_confidence FROM sc GROUP BY 1""")
def confidence_of_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean confidence per predicted class, all rows of the rule model."""
    return rounded(confidence_by_class(rule_scored(spark, sf_dir)))


@register("d3_predictions_vs_truth_rules", f"""WITH {_SCORED_SQL},
p AS (SELECT predicted_class AS class, count(*) AS n FROM sc GROUP BY 1),
t AS (SELECT actual_class AS class, count(*) AS n FROM sc GROUP BY 1)
SELECT class, coalesce(t.n, 0) AS ground_truth, p.n IS NULL AS extra,
  row_number() OVER (ORDER BY p.n IS NULL, class) AS position, coalesce(p.n, 0) AS predictions
FROM p FULL OUTER JOIN t USING (class)""")
def distributions_of_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted and true class counts side by side, all rows of the rule model."""
    return predictions_vs_truth(rule_scored(spark, sf_dir), "actual_class")
