"""Registered queries over the end-to-end workflow (selection, model, scoring).

The model-dependent results have no SQL twin (rows-only check); the
customer split does.  One fitted workflow is shared by these queries per
(session, data folder), so the model is trained once per run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import association as A
from orderlens.plans.catalog_rollup import TX_SQL, _rollup_sql, cast_order_facts
from orderlens.plans.catalog_select import (ASSOC_COLS, ATTRS_SQL, PEARSON_COLS, _cramer_sql, _pairs, _union,
                                            customer_attrs)
from orderlens.plans.scoring import confidence_by_class
from orderlens.plans.selection import CramersVSelector
from orderlens.operators.split import stratified_split
from orderlens.operators.validate import RecordRules
from orderlens.plans.training import BoostParams, predict, train_model
from orderlens.plans.workflow import (WorkflowConfig, fit, metrics_table, score_sample)
from orderlens.session import shared_path
from orderlens.sources.tables import TPCH_ROLLUP, TPCH_SCHEMA, customer_attributes, table
from orderlens.config import CastConfig

QUERIES: dict = {}
ORACLE: dict = {}
_RUNS: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


#: records that the scorer accepts; MACHINERY customers and those of many lines are quarantined
RULES = RecordRules(allowed={"c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD"]},
                    ranges={"n_lines": (1, 50)})


def _config(spark: SparkSession) -> WorkflowConfig:
    return WorkflowConfig(
        out_dir=shared_path(spark, f"orderlens-workflow-{uuid.uuid4().hex[:12]}"),
        schema=TPCH_SCHEMA, rollup=TPCH_ROLLUP, cast=CastConfig(), id_pattern="key",
        boost=BoostParams(), sample_size=None, rules=RULES)


def fitted_run(spark: SparkSession, sf_dir: str):
    """Fit the workflow once per (application, folder)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _RUNS:
        cfg = _config(spark)
        fitted = fit(spark, cast_order_facts(spark, sf_dir), cfg,
                     attributes=customer_attributes(spark, sf_dir))
        _RUNS[key] = (cfg, fitted)
    return _RUNS[key]


_SPLIT_SQL = f"""WITH {TX_SQL}, cu AS ({_rollup_sql('tx')})
SELECT o_custkey, o_orderstatus,
  CASE WHEN 10 * rn <= 6 * n THEN 'train' WHEN 10 * rn <= 8 * n THEN 'val' ELSE 'test' END AS split
FROM (SELECT o_custkey, o_orderstatus,
        row_number() OVER (PARTITION BY o_orderstatus
                           ORDER BY md5(concat_ws('|', '42', CAST(o_custkey AS VARCHAR))), o_custkey) AS rn,
        count(*) OVER (PARTITION BY o_orderstatus) AS n
      FROM cu WHERE o_orderstatus IS NOT NULL)"""


@register("f3_split_customers", _SPLIT_SQL)
def split_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workflow steps 1-2: rolled-up customers split 60/20/20 per class (A1 + F3)."""
    cfg, fitted = fitted_run(spark, sf_dir)
    return spark.read.parquet(cfg.out_dir + "/split").select("o_custkey", "o_orderstatus", "split")


@register("f12_selected_features")
def selected_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each selection step removed and what was kept."""
    _, fitted = fitted_run(spark, sf_dir)
    sel = fitted.selector
    rows = [(step, c) for step, cols in (sel.report_ or {}).items() for c in cols]
    rows += [("kept", c) for c in sel.getOrDefault(sel.outputCols)]
    return spark.createDataFrame(rows, "step string, variable string")


@register("m1_test_predictions")
def test_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model scores of every TEST customer."""
    _, fitted = fitted_run(spark, sf_dir)
    scored = predict(fitted.model, fitted.splits["test"], fitted.categorical, fitted.continuous)
    return scored.select("o_custkey", "o_orderstatus", "predicted_class",
                         F.round("confidence", 6).alias("confidence"))


@register("m1_rule_label_predictions", """
WITH c AS (SELECT c_custkey, CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'X'
                                  WHEN c_mktsegment = 'FURNITURE' THEN 'Y' ELSE 'Z' END AS target FROM customer),
r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY md5(concat_ws('|', '42', CAST(c_custkey AS VARCHAR))),
                                   c_custkey) AS rn, count(*) OVER (PARTITION BY target) AS n FROM c)
SELECT c_custkey, target AS predicted_class FROM r WHERE 10 * rn > 8 * n""")
def rule_label_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees trained on a rule over a category give that rule back on the TEST customers (M1-M3)."""
    seg = F.col("c_mktsegment")
    df = table(spark, sf_dir, "customer").withColumn("target", F.when(
        seg.isin("AUTOMOBILE", "BUILDING"), "X").when(seg == "FURNITURE", "Y").otherwise("Z"))
    parts = stratified_split(df, "target", ["c_custkey"], 42).persist()
    try:
        pick = {s: parts.filter(F.col("split") == s) for s in ("train", "val", "test")}
        args = ["target", ["c_mktsegment"], ["c_acctbal"]]
        model = train_model(pick["train"], pick["val"], *args,
                            BoostParams(max_iter=6, patience=2, step_size=0.3, max_depth=3))
        out = shared_path(spark, f"orderlens-rule-label-{uuid.uuid4().hex[:12]}")
        predict(model, pick["test"], *args[1:]).select("c_custkey", "predicted_class").write.parquet(out)
    finally:
        parts.unpersist()
    return spark.read.parquet(out)


@register("m7_model_bundle", f"""WITH t AS (SELECT DISTINCT o_orderstatus AS c FROM ({_SPLIT_SQL}) WHERE split = 'train')
SELECT 1 AS version, 'Production' AS stage, CAST(row_number() OVER (ORDER BY c) - 1 AS INTEGER) AS position,
       c AS class FROM t""")
def bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version, stage and classes of the workflow's model, read from the model table (M6, M7)."""
    _, fitted = fitted_run(spark, sf_dir)
    got = fitted.bundle
    return spark.createDataFrame([(got["version"], got["stage"], k, c) for k, c in enumerate(got["classes"])],
                                 "version int, stage string, position int, class string")


@register("i4_quarantine", f"""SELECT s.o_custkey, list_filter([
    CASE WHEN c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD')
         THEN 'c_mktsegment: not allowed ' || c_mktsegment END,
    CASE WHEN coalesce(n.n, 0) NOT BETWEEN 1 AND 50
         THEN 'n_lines: out of range ' || CAST(coalesce(n.n, 0) AS VARCHAR) END],
    lambda x: x IS NOT NULL) AS errors
FROM ({_SPLIT_SQL}) s JOIN customer c ON c.c_custkey = s.o_custkey
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1) n
  ON n.o_custkey = s.o_custkey
WHERE s.split = 'test' AND len(errors) > 0""")
def quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TEST customers that the record rules keep from the scorer, read back from the quarantine."""
    return _sample(spark, sf_dir)[1]


@register("e6_split_metrics")
def split_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All metrics per split: log loss, accuracy, averages and per-class rows."""
    cfg, fitted = fitted_run(spark, sf_dir)
    return metrics_table(spark, fitted, cfg)


def _sample(spark, sf_dir):
    cfg, fitted = fitted_run(spark, sf_dir)
    return score_sample(spark, fitted, cfg)


@register("a18_batch_summary")
def summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary of the scored TEST split."""
    return _sample(spark, sf_dir)[2]


@register("d3_predictions_vs_truth")
def distributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted vs true class counts of the TEST split, aligned."""
    return _sample(spark, sf_dir)[3]


@register("d2_confidence_by_class")
def confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean confidence per predicted class of the TEST split."""
    return confidence_by_class(_sample(spark, sf_dir)[0])


_LEVELS_SQL = _union([f"""SELECT '{c}' AS variable, count(DISTINCT coalesce(CAST({c} AS VARCHAR), '__NA__')) AS n
FROM attrs""" for c in ASSOC_COLS])
_MATRIX_SQL = _union([f"SELECT * FROM {_cramer_sql(a, b, False)}" for a, b in _pairs(ASSOC_COLS)])


@register("f9_cramers_selection", f"""WITH {ATTRS_SQL},
half AS ({_MATRIX_SQL}),
m AS (SELECT var_a AS a, var_b AS b, cramers_v AS v FROM half UNION ALL SELECT var_b, var_a, cramers_v FROM half),
o AS (SELECT variable, row_number() OVER (ORDER BY n, variable) AS k FROM ({_LEVELS_SQL})),
near AS (SELECT x.k AS i, y.k AS j FROM m JOIN o x ON x.variable = m.a JOIN o y ON y.variable = m.b
         WHERE x.k < y.k AND m.v >= 0.8),
k2 AS (SELECT NOT EXISTS (SELECT 1 FROM near WHERE i = 1 AND j = 2) AS kept)
SELECT variable, CASE k WHEN 1 THEN TRUE WHEN 2 THEN kept
  ELSE NOT EXISTS (SELECT 1 FROM near WHERE j = 3 AND (i = 1 OR i = 2 AND kept)) END AS kept FROM o, k2""")
def cramers_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy Cramér's V redundancy selection by cardinality."""
    attrs = customer_attrs(spark, sf_dir)
    model = CramersVSelector(variables=ASSOC_COLS, threshold=0.8,
                             selectionMethod="cardinality").fit(attrs)
    kept = set(model.getOrDefault(model.featuresToKeep))
    return spark.createDataFrame([(c, c in kept) for c in ASSOC_COLS], "variable string, kept boolean")


_F11_COLS = sorted([*PEARSON_COLS, "l_gross"])


def _greedy_sql(cols: list[str]) -> str:
    """One step per column: dropped if |r| > 0.8 with an earlier column that leads."""
    steps, last = [], "li"
    corr = ", ".join(f"coalesce(abs(corr({a}, {b})), -1) AS r_{i}_{j}"
                     for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j)
    steps.append(f"s0 AS (SELECT {corr}, FALSE AS d0 FROM li)")
    for j in range(1, len(cols)):
        hit = " OR ".join(f"(NOT d{i} AND r_{i}_{j} > 0.8)" for i in range(j))
        steps.append(f"s{j} AS (SELECT *, ({hit}) AS d{j} FROM s{j - 1})")
        last = f"s{j}"
    return ",\n".join(steps) + "\n" + _union(
        [f"SELECT '{c}' AS variable, d{j} AS dropped FROM {last}" for j, c in enumerate(cols)])


@register("f11_pearson_selection", "WITH li AS (SELECT *, l_extendedprice * (1 + l_tax) AS l_gross FROM lineitem),\n"
          + _greedy_sql(_F11_COLS))
def pearson_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Correlated numerics dropped at |r| > 0.8, alphabetical scan."""
    li = table(spark, sf_dir, "lineitem").withColumn(
        "l_gross", F.col("l_extendedprice") * (1 + F.col("l_tax")))
    cols = _F11_COLS
    corr = {(r["var_a"], r["var_b"]): r["pearson"] for r in A.pearson_matrix(li, cols).collect()}
    dropped, _ = A.greedy_correlated(cols, corr, 0.8)
    return spark.createDataFrame([(c, c in dropped) for c in cols], "variable string, dropped boolean")
