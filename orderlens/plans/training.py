"""Multiclass training with pyspark.ml.

* Categorical features: ``StringIndexer`` fitted on TRAIN only, alphabetical
  level order, unseen levels kept in an extra bucket (F13).
* Target: ``StringIndexer`` on TRAIN classes, alphabetical; an unseen class
  in val/test raises (F14).
* Continuous features: median ``Imputer`` (trees here have no native
  missing-value handling).
* Classifier: boosted trees on the softmax loss (:mod:`orderlens.plans.boosting`) with
  patience on the validation loss and best-round truncation (M1-M3), or a
  ``RandomForestClassifier`` (native multiclass probabilities).
* Balanced row weights n/(k*n_class) on TRAIN rows, 1.0 on validation rows
  (F15).

Everything is saved as one ``PipelineModel`` (the label indexer carries
the class names), so training and serving use the same encodings.
"""

from __future__ import annotations

import logging
import math
from dataclasses import replace

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators.split import balanced_weights
from orderlens.plans.boost_params import BoostParams
from orderlens.plans.boosting import SoftmaxBoost

log = logging.getLogger(__name__)


# --- the training pipeline ---------------------------------------------------------

def _prep_stages(categorical: list[str], continuous: list[str], label: str):
    cat_idx = [f"{c}__idx" for c in categorical]
    cont_imp = [f"{c}__imp" for c in continuous]
    stages = []
    if categorical:
        stages.append(StringIndexer(inputCols=categorical, outputCols=cat_idx,
                                    stringOrderType="alphabetAsc", handleInvalid="keep"))
    if continuous:
        stages.append(Imputer(inputCols=continuous, outputCols=cont_imp, strategy="median"))
    stages.append(StringIndexer(inputCol=label, outputCol="label_idx",
                                stringOrderType="alphabetAsc", handleInvalid="error"))
    stages.append(VectorAssembler(inputCols=cat_idx + cont_imp, outputCol="features",
                                  handleInvalid="keep"))
    return stages


def _cast_inputs(df: DataFrame, categorical: list[str], continuous: list[str]) -> DataFrame:
    return df.withColumns({**{c: F.col(c).cast("string") for c in categorical},
                           **{c: F.col(c).cast("double") for c in continuous}})


def train_model(train: DataFrame, val: DataFrame, label: str, categorical: list[str],
                continuous: list[str], params: BoostParams | None = None,
                balanced: bool = True) -> PipelineModel:
    """Fit encoders on TRAIN, the classifier on TRAIN (+ VAL for early stop) (M1-M3).

    Unseen classes in VAL raise when the label indexer meets them (F14).
    """
    params = params or BoostParams()
    train = _cast_inputs(train, categorical, continuous)
    val = _cast_inputs(val, categorical, continuous)
    prep = Pipeline(stages=_prep_stages(categorical, continuous, label)).fit(train)
    t = prep.transform(train)
    if balanced:
        t = balanced_weights(t, "label_idx", "weight")
    else:
        t = t.withColumn("weight", F.lit(1.0))
    t = t.withColumn("is_val", F.lit(False))
    v = prep.transform(val).withColumn("weight", F.lit(1.0)).withColumn("is_val", F.lit(True))
    fit_df = t.unionByName(v.select(*t.columns))
    k = len(prep.stages[-2].labels)
    # trees need a bin per level of a categorical feature (and one for unseen levels)
    levels = [len(x) + 1 for st in prep.stages if st.hasParam("outputCols") and hasattr(st, "labelsArray")
              for x in st.labelsArray]
    params = replace(params, max_bins=max([params.max_bins, *levels]))
    if params.classifier == "rf":
        clf = RandomForestClassifier(
            featuresCol="features", labelCol="label_idx", weightCol="weight",
            numTrees=params.num_trees, maxDepth=params.max_depth,
            minInstancesPerNode=params.min_instances_per_node,
            subsamplingRate=params.subsampling_rate, featureSubsetStrategy=params.feature_subset,
            seed=params.seed, maxBins=params.max_bins)
        model = clf.fit(fit_df.filter(~F.col("is_val")))
    else:
        model = SoftmaxBoost(featuresCol="features", labelCol="label_idx", weightCol="weight",
                             validationIndicatorCol="is_val", numClasses=k, params=params).fit(fit_df)
    return PipelineModel(stages=[*prep.stages, model])


def _output_col(stage) -> str:
    if stage.hasParam("outputCol") and stage.isDefined(stage.getParam("outputCol")):
        return stage.getOrDefault(stage.getParam("outputCol"))
    return ""


def class_names(model: PipelineModel) -> list[str]:
    """Classes in index order, read from the label indexer (M7)."""
    for st in model.stages:
        if _output_col(st) == "label_idx":
            return list(st.labels)
    raise ValueError("model has no label indexer")


def encoder_columns(model: PipelineModel) -> tuple[list[str], list[str]]:
    """(categorical, continuous) input columns of a stored model, read from its encoders (M7)."""
    found = {"__idx": [], "__imp": []}
    for st in model.stages:
        for kind, cols in found.items():
            if st.hasParam("outputCols") and st.isDefined(st.getParam("outputCols")):
                outs = st.getOrDefault(st.getParam("outputCols"))
                cols += [o[:-len(kind)] for o in outs if o.endswith(kind)]
    return found["__idx"], found["__imp"]


def predict(model: PipelineModel, df: DataFrame, categorical: list[str],
            continuous: list[str], with_label: bool = False) -> DataFrame:
    """Probabilities per row (I2) plus class, confidence.

    Without a label column the label indexer stage is skipped.
    """
    df = _cast_inputs(df, categorical, continuous)
    labels = class_names(model)
    out = df
    for st in model.stages:
        if not with_label and _output_col(st) == "label_idx":
            continue
        out = st.transform(out)
    if "probabilities" not in out.columns:
        out = out.withColumn("probabilities", vector_to_array("probability"))
    names = F.array(*[F.lit(x) for x in labels])
    best = F.array_position("probabilities", F.array_max("probabilities"))
    return out.withColumns({"predicted_class": F.element_at(names, best.cast("int")),
                            "confidence": F.array_max("probabilities")})


def _exists(path: str) -> bool:
    spark = SparkSession.active()
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def ensure_model(path: str, train_fn) -> PipelineModel:
    """Load the stored model, training it first when absent; recheck after (M5)."""
    if not _exists(path):
        log.info("no model at %s; training", path)
        train_fn()
        if not _exists(path):
            raise RuntimeError(f"model not available at {path} after training")
    return PipelineModel.load(path)   # a model that is there but unreadable is an error, not a retrain


def uniform_log_loss(k: int) -> float:
    """ln k: the log loss of a uniform guess, a floor any model must beat."""
    return math.log(k)
