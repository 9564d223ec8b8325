"""Batch scoring with validation and summaries.

The reference scores requests one by one under a concurrency limit; here a
batch is a DataFrame: partitions replace the semaphore, invalid rows go to a
quarantine frame instead of being silently dropped, and every summary is an
aggregate.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions.scalar import all_finite_nonneg, uri_tail
from orderlens.operators.joins import align_distributions
from orderlens.operators.validate import RecordRules, split_valid, validate_records
from orderlens.plans.training import predict


def predict_batch(model: PipelineModel, records: DataFrame, rules: RecordRules | None,
                  categorical: list[str], continuous: list[str], model_version: str | None = None):
    """(scored valid rows, quarantined rows) (I4).

    Scored rows carry ``predicted_class``, ``confidence``, ``probabilities``
    (class order of the model) and ``model_version``.
    """
    if rules is not None:
        valid, bad = split_valid(validate_records(records, rules))
    else:
        valid, bad = records, records.limit(0).withColumn("errors", F.array().cast("array<string>"))
    scored = predict(model, valid, categorical, continuous)
    scored = scored.withColumn("model_version", F.lit(model_version))
    scored = scored.withColumn("valid_probabilities", all_finite_nonneg("probabilities"))
    return scored, bad


def batch_summary(scored: DataFrame, total: DataFrame | int) -> DataFrame:
    """One summary row (A18): total, successes, success %, class distribution
    (map), confidence min / max / avg / population std, model version."""
    total_col = F.lit(total) if isinstance(total, int) else total.select(F.count(F.lit(1))).scalar()
    dist = (scored.groupBy("predicted_class").agg(F.count(F.lit(1)).alias("n"))
            .agg(F.map_from_entries(F.collect_list(F.struct("predicted_class", "n")))
                 .alias("prediction_distribution")))
    stats = scored.agg(
        F.count(F.lit(1)).alias("successful_predictions"),
        F.struct(F.min("confidence").alias("min"), F.max("confidence").alias("max"),
                 F.avg("confidence").alias("avg"), F.stddev_pop("confidence").alias("std"))
        .alias("confidence_stats"),
        F.first("model_version", ignorenulls=True).alias("model_version"))
    out = stats.select("*", dist.select("prediction_distribution").scalar()
                       .alias("prediction_distribution"))
    return out.select(
        total_col.cast("long").alias("total_samples"), "successful_predictions",
        F.when(total_col > 0, F.col("successful_predictions") * 100.0 / total_col)
        .otherwise(0.0).alias("success_rate"),
        "prediction_distribution", "confidence_stats", "model_version")


def confidence_by_class(scored: DataFrame) -> DataFrame:
    """Mean confidence per predicted class."""
    return scored.groupBy("predicted_class").agg(F.count(F.lit(1)).alias("n"),
                                                 F.avg("confidence").alias("mean_confidence"))


def predictions_vs_truth(scored: DataFrame, label: str) -> DataFrame:
    """Truth counts aligned to the prediction counts' key order."""
    pred = scored.groupBy(F.col("predicted_class").alias("class")).agg(
        F.count(F.lit(1)).alias("n"))
    truth = scored.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    aligned = align_distributions(pred, truth, "class", "n")
    return aligned.withColumnRenamed("n", "ground_truth").join(
        pred.withColumnRenamed("n", "predictions"), "class", "left").fillna({"predictions": 0})


def hyperparameter_frame(spark: SparkSession, params: dict) -> DataFrame:
    """(param, value) rows of a hyper-parameter record (M4)."""
    return spark.createDataFrame([(k, str(v)) for k, v in params.items()],
                                 "param string, value string")


def model_version_of(path_col) -> F.Column:
    """Model version = last element of the model URI."""
    return uri_tail(path_col)
