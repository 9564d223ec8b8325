"""The end-to-end customer workflow: ELT -> split -> selection -> model -> scoring.

Same steps as the reference's entry point, as Spark jobs:

1. read + cast + roll up to one row per customer; written to parquet (S7)
   and read back, which also cuts the lineage (S8);
2. exact stratified 60/20/20 split, written once (the ranking is reused by
   every later step instead of being recomputed);
3. feature selection fitted on TRAIN, applied to all splits;
4. model trained only when none is stored (M5), saved as a PipelineModel, registered and promoted
   in the model table (M6, M7);
5. metrics per split (E1-E6) written as a (split, metric, value) table;
6. a seeded test sample is scored with validation + quarantine (I4/I5),
   and its summary (A18), scored rows (S9) and prediction-vs-truth
   distributions (S10/D3) are written as JSON lines.

All intermediate tables go under ``out_dir`` - on a cluster a shared folder
(by default under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.config import CastConfig, RollupSpec, TransactionSchema
from orderlens.operators.cast import validate_and_cast
from orderlens.operators.evaluate import evaluate_splits
from orderlens.operators.rollup import aggregate_to_customer, aggregate_with_attributes
from orderlens.operators.sampling import sample_rows
from orderlens.operators.split import stratified_split
from orderlens.operators.validate import RecordRules, split_valid, validate_records
from orderlens.plans import registry
from orderlens.plans.scoring import batch_summary, predict_batch, predictions_vs_truth
from orderlens.plans.selection import FeatureSelector
from orderlens.plans.training import BoostParams, ensure_model, predict, train_model
from orderlens.sources.parquet import read_json_lines, read_processed, write_json_lines, write_processed

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class WorkflowConfig:
    out_dir: str
    schema: TransactionSchema
    rollup: RollupSpec
    cast: CastConfig = field(default_factory=CastConfig)
    seed: int = 42
    id_pattern: str = "_id"
    boost: BoostParams = field(default_factory=BoostParams)
    sample_size: int | None = 50
    model_name: str = "customers"
    rules: RecordRules | None = None      # record checks before scoring; bad records go to quarantine


def path(cfg: WorkflowConfig, name: str) -> str:
    return os.path.join(cfg.out_dir, name) if "://" not in cfg.out_dir else \
        cfg.out_dir.rstrip("/") + "/" + name


def customers_table(spark: SparkSession, transactions: DataFrame, cfg: WorkflowConfig,
                    attributes: DataFrame | None = None) -> DataFrame:
    """Step 1: cast, roll up, write, read back.

    With ``attributes`` (one row per key), the fact rows are rolled up first
    and the attributes joined after (skew-safe form of the same result).
    """
    # emptiness is looked at in the written result (write_processed), not by running the input's joins
    valid = validate_and_cast(transactions, cfg.cast, check_empty=False)
    if attributes is not None:
        customers = aggregate_with_attributes(valid, attributes, cfg.rollup, cfg.schema)
    else:
        customers = aggregate_to_customer(valid, cfg.rollup, cfg.schema)
    out = write_processed(customers, path(cfg, "customers"), fail_if_empty=cfg.cast.fail_if_empty)
    return read_processed(spark, out)


def split_table(spark: SparkSession, customers: DataFrame, cfg: WorkflowConfig) -> DataFrame:
    """Step 2: exact split, materialised once."""
    sp = stratified_split(customers, cfg.schema.label, [cfg.schema.key], cfg.seed)
    sp.write.mode("overwrite").parquet(path(cfg, "split"))
    return spark.read.parquet(path(cfg, "split"))


@dataclass
class Fitted:
    selector: object
    model: object
    categorical: list
    continuous: list
    splits: dict          # selected features per split
    table: object         # the split table: all columns of every customer, and split
    bundle: dict          # the model's row of the model table: version, stage, classes, columns, best round


def fit(spark: SparkSession, transactions: DataFrame, cfg: WorkflowConfig,
        attributes: DataFrame | None = None) -> Fitted:
    """Steps 1-4."""
    customers = customers_table(spark, transactions, cfg, attributes)
    sp = split_table(spark, customers, cfg)
    parts = {s: sp.filter(F.col("split") == s).drop("split") for s in ("train", "val", "test")}
    selector = FeatureSelector(labelCol=cfg.schema.label, passthroughCols=[cfg.schema.key],
                               idPattern=cfg.id_pattern).fit(parts["train"])
    cats = list(selector.getOrDefault(selector.categoricalCols))
    conts = list(selector.getOrDefault(selector.continuousCols))
    sel = {s: selector.transform(df) for s, df in parts.items()}
    model_path, root = path(cfg, "model"), path(cfg, "models")

    def train_and_save():
        m = train_model(sel["train"], sel["val"], cfg.schema.label, cats, conts, cfg.boost)
        m.write().overwrite().save(model_path)
        facts = registry.model_facts(m, cats, conts)
        row = spark.createDataFrame([(cfg.model_name, model_path, *facts.values())], registry_row(facts))
        registry.register(row, root)
        new = registry.current(spark, root).groupBy("name").agg(F.max("version").alias("version"))
        registry.promote(new, root)

    model = ensure_model(model_path, train_and_save)
    # what the scorer needs comes from the stored model's row, not from this run (M6, M7)
    bundle = registry.model_bundle(spark, root, cfg.model_name)
    cats = bundle["categorical"]
    return Fitted(selector, model, cats, [c for c in bundle["inputs"] if c not in cats], sel, sp, bundle)


def registry_row(facts: dict) -> str:
    kinds = {"best_round": "int"}
    return "name string, path string, " + ", ".join(f"{c} {kinds.get(c, 'array<string>')}" for c in facts)


def metrics_table(spark: SparkSession, fitted: Fitted, cfg: WorkflowConfig) -> DataFrame:
    """Step 5: (split, metric, class, value) for every split, all splits scored in one scan."""
    from orderlens.plans.training import class_names
    sel = fitted.selector
    both = sel.copy({sel.passthroughCols: [*sel.getOrDefault(sel.passthroughCols), "split"]})
    scored = predict(fitted.model, both.transform(fitted.table), fitted.categorical, fitted.continuous,
                     with_label=True)
    out = evaluate_splits(scored, "label_idx", "prediction", "probabilities", class_names(fitted.model))
    out.write.mode("overwrite").parquet(path(cfg, "metrics"))
    return spark.read.parquet(path(cfg, "metrics"))


def score_sample(spark: SparkSession, fitted: Fitted, cfg: WorkflowConfig):
    """Step 6: TEST split, or a seeded sample of it (I5) -> scored rows, quarantine, summary, distributions.

    Records are checked by ``cfg.rules`` before any feature is made (I4); the
    results are written as JSON lines and read back from there (S9, S10).
    """
    test = fitted.table.filter(F.col("split") == "test").drop("split")
    sample = test if cfg.sample_size is None else sample_rows(test, cfg.sample_size, [cfg.schema.key], cfg.seed)
    checked = validate_records(sample, cfg.rules) if cfg.rules else sample.withColumn(
        "errors", F.array().cast("array<string>"))
    write_json_lines(split_valid(checked)[1].select(cfg.schema.key, "errors"), path(cfg, "quarantine"))
    valid = fitted.selector.transform(split_valid(checked)[0])
    scored, _ = predict_batch(fitted.model, valid, None, fitted.categorical, fitted.continuous,
                              str(fitted.bundle["version"]))
    results = scored.select(cfg.schema.key, cfg.schema.label, "predicted_class", "confidence",
                            "probabilities", "model_version")
    key = sample.schema[cfg.schema.key].dataType.simpleString()
    label = sample.schema[cfg.schema.label].dataType.simpleString()
    write_json_lines(results, path(cfg, "inference_results"))
    scored = read_json_lines(spark, path(cfg, "inference_results"),
                             f"{cfg.schema.key} {key}, {cfg.schema.label} {label}, predicted_class string, "
                             "confidence double, probabilities array<double>, model_version string")
    bad = read_json_lines(spark, path(cfg, "quarantine"), f"{cfg.schema.key} {key}, errors array<string>")
    summary = batch_summary(scored, sample)
    write_json_lines(predictions_vs_truth(scored, cfg.schema.label), path(cfg, "inference_distributions"))
    write_json_lines(summary, path(cfg, "inference_summary"))
    dist = read_json_lines(spark, path(cfg, "inference_distributions"),
                           f"class {label}, ground_truth long, extra boolean, position int, predictions long")
    return scored, bad, summary, dist


def run(spark: SparkSession, transactions: DataFrame, cfg: WorkflowConfig) -> dict:
    """Run all steps; returns the written tables as DataFrames."""
    fitted = fit(spark, transactions, cfg)
    metrics = metrics_table(spark, fitted, cfg)
    results, bad, summary, dist = score_sample(spark, fitted, cfg)
    return {"fitted": fitted, "metrics": metrics, "results": results, "quarantine": bad,
            "summary": summary, "distributions": dist}
