"""Multiclass boosted trees with a warm start (M1-M3).

Boosting runs round by round over MLlib regression trees.  The margins of the
classes, one column each, are carried from round to round; every round

1. turns margins into softmax probabilities, and those into the Newton target
   and weight of each class and the row's loss: plain columns, computed once
   when the round's rows are cached, and only read by the passes of the trees;
2. fits one regression tree per class, all classes at the same time, on the
   Newton target gradient / Hessian with the Hessian as row weight, so a leaf
   holds the Newton step of its rows;
3. adds the damped trees to the margins of the cached rows.  Every tenth round
   writes them to the shared folder, which cuts the lineage, so a lost executor
   repeats ten rounds of this step at most, and never a tree.

No round is ever fitted twice: patience is checked after each round, and the
model of the best round is a prefix of the trees.
"""

from __future__ import annotations

import json
import logging
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressor
from pyspark.ml.util import (DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader,
                             MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.plans.boost_params import BoostParams
from orderlens.session import shared_path

log = logging.getLogger(__name__)

MIN_HESSIAN = 1e-6        # rows that are settled keep this weight
MAX_STEP = 4.0            # bound of a row's Newton target
EPS = 1e-15               # probability clip of the validation loss
WRITE_EVERY = 10          # rounds between two writes of the rows, as MLlib's own boosting checkpoints


def _p(name, doc, conv):
    return Param(Params._dummy(), name, doc, typeConverter=conv)


class _BoostParams(Params):
    featuresCol = _p("featuresCol", "features vector", TypeConverters.toString)
    labelCol = _p("labelCol", "0-based class index", TypeConverters.toString)
    weightCol = _p("weightCol", "row weight column ('' = none)", TypeConverters.toString)
    validationIndicatorCol = _p("validationIndicatorCol", "true on validation rows ('' = none)",
                                TypeConverters.toString)
    numClasses = _p("numClasses", "number of classes (0 = from data)", TypeConverters.toInt)
    paramsJson = _p("paramsJson", "BoostParams as JSON", TypeConverters.toString)


def softmax(margins: str | Column) -> Column:
    """Softmax of an array column, shifted by its maximum."""
    m = F.col(margins) if isinstance(margins, str) else margins
    e = F.transform(m, lambda x: F.exp(x - F.array_max(m)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))


def newton_columns(rows: DataFrame, k: int) -> DataFrame:
    """Target ``t<c>`` and weight ``h<c>`` of every class and ``loss``, from the margins ``m<c>``, ``y`` and ``w``.

    The softmax is that of :func:`softmax`, term by term, in scalar columns: a higher-order
    function is interpreted per row, these are compiled.
    """
    classes, carried = range(k), rows.columns
    top = F.greatest(*[F.col(f"m{c}") for c in classes]) if k > 1 else F.col("m0")
    rows = rows.withColumn("_top", top)
    rows = rows.withColumns({f"_e{c}": F.exp(F.col(f"m{c}") - F.col("_top")) for c in classes})
    total = F.lit(0.0)
    for c in classes:
        total = total + F.col(f"_e{c}")
    rows = rows.withColumn("_sum", total)
    rows = rows.withColumns({f"_p{c}": F.col(f"_e{c}") / F.col("_sum") for c in classes})
    rows = rows.withColumns({f"_h{c}": F.greatest(F.col(f"_p{c}") * (1.0 - F.col(f"_p{c}")), F.lit(MIN_HESSIAN))
                             for c in classes})

    def target(c):
        step = ((F.col("y") == c).cast("double") - F.col(f"_p{c}")) / F.col(f"_h{c}")
        return F.least(F.greatest(step, F.lit(-MAX_STEP)), F.lit(MAX_STEP))
    p_true = F.get(F.array(*[F.col(f"_p{c}") for c in classes]), F.col("y"))
    return rows.select(*carried, *[target(c).alias(f"t{c}") for c in classes],
                       *[(F.col("w") * F.col(f"_h{c}")).alias(f"h{c}") for c in classes],
                       (-F.ln(F.greatest(p_true, F.lit(EPS)))).alias("loss"))


class SoftmaxBoost(Estimator, _BoostParams):
    """One regression tree per class and round on the softmax loss, stopped by patience."""

    def __init__(self, featuresCol="features", labelCol="label_idx", weightCol="",
                 validationIndicatorCol="", numClasses=0, params: BoostParams | None = None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label_idx", weightCol="",
                         validationIndicatorCol="", numClasses=0, paramsJson=json.dumps(asdict(BoostParams())))
        self._set(featuresCol=featuresCol, labelCol=labelCol, weightCol=weightCol,
                  validationIndicatorCol=validationIndicatorCol, numClasses=numClasses,
                  paramsJson=json.dumps(asdict(params or BoostParams())))

    def _start(self, df: DataFrame, k: int) -> DataFrame:
        """features, y, w, is_val and zero margins."""
        g = self.getOrDefault
        w, v = g(self.weightCol), g(self.validationIndicatorCol)
        return df.select(
            F.col(g(self.featuresCol)).alias("features"), F.col(g(self.labelCol)).cast("int").alias("y"),
            (F.col(w).cast("double") if w else F.lit(1.0)).alias("w"),
            (F.col(v) if v else F.lit(False)).alias("is_val"),
            *[F.lit(0.0).alias(f"m{c}") for c in range(k)])

    def _tree(self, rows: DataFrame, c: int, r: int, bp: BoostParams):
        """The tree of class ``c`` in round ``r`` on the rows' current targets."""
        target = rows.select("features", F.col(f"t{c}").alias("target"), F.col(f"h{c}").alias("hessian"))
        forest = RandomForestRegressor(
            featuresCol="features", labelCol="target", weightCol="hessian", numTrees=1, bootstrap=False,
            subsamplingRate=bp.subsampling_rate, featureSubsetStrategy=bp.feature_subset, maxDepth=bp.max_depth,
            minInstancesPerNode=bp.min_instances_per_node, maxBins=bp.max_bins, seed=bp.seed + 1_000 * r + c)
        return forest.fit(target).trees[0]

    def _fit(self, df: DataFrame) -> "SoftmaxBoostModel":
        g = self.getOrDefault
        bp = BoostParams(**json.loads(g(self.paramsJson)))
        k = g(self.numClasses) or int(df.agg(F.max(g(self.labelCol))).first()[0]) + 1
        stops = bool(g(self.validationIndicatorCol))
        spark, root = df.sparkSession, shared_path(df.sparkSession, f"boost-{uuid.uuid4().hex}")

        def kept(rows: DataFrame, r: int) -> DataFrame:
            if r % WRITE_EVERY == 0:
                rows.write.parquet(f"{root}/{r}")
                rows = spark.read.schema(rows.schema).parquet(f"{root}/{r}")
            return newton_columns(rows, k).persist(StorageLevel.MEMORY_AND_DISK)

        now = kept(self._start(df, k), 0)
        trees, losses, best = [], [], 0
        with ThreadPoolExecutor(k) as pool:
            for r in range(bp.max_iter):
                rows = now.filter(~F.col("is_val")) if stops else now
                fitted = list(pool.map(inheritable_thread_target(spark)(
                    lambda c, rows=rows, r=r: self._tree(rows, c, r, bp)), range(k)))
                trees.append(fitted)
                nxt = now
                for c, tree in enumerate(fitted):
                    nxt = tree.setFeaturesCol("features").setPredictionCol(f"_t{c}").transform(nxt)
                steps = [(F.col(f"m{c}") + bp.step_size * F.col(f"_t{c}")).alias(f"m{c}") for c in range(k)]
                nxt = kept(nxt.select("features", "y", "w", "is_val", *steps), r + 1)
                # reads every partition, so the rows are cached before the trees of the next round start
                loss = nxt.agg(F.avg(F.when(F.col("is_val") | F.lit(not stops), F.col("loss")))).first()[0]
                now.unpersist()
                now = nxt
                losses.append(loss)
                if loss is not None and (losses[best] is None or loss < losses[best]):
                    best = r
                if stops and r - best >= bp.patience:
                    break
        now.unpersist()
        kept = trees[:best + 1] if stops else trees
        log.info("%d rounds, best %d", len(trees), best + 1)
        model = SoftmaxBoostModel([_ensemble(spark, [t[c] for t in kept], bp.step_size) for c in range(k)])
        model.validation_losses = losses
        return self._copyValues(model)


def _ensemble(spark, trees: list, step: float) -> GBTRegressionModel:
    """The damped trees of one class as one MLlib model: stored in one piece, scored in one expression."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    array = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(gateway.jvm.double, len(trees))
    for i, tree in enumerate(trees):
        array[i], weights[i] = tree._java_obj, float(step)
    return GBTRegressionModel(jvm.org.apache.spark.ml.regression.GBTRegressionModel(
        f"boost_{uuid.uuid4().hex[:12]}", array, weights))


class SoftmaxBoostModel(Model, _BoostParams, MLWritable, MLReadable):
    """Adds ``probability`` (vector), ``probabilities`` (array) and ``prediction``."""

    def __init__(self, models=None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label_idx", weightCol="",
                         validationIndicatorCol="", numClasses=0, paramsJson=json.dumps(asdict(BoostParams())))
        self.models = list(models or [])

    @property
    def best_round(self) -> int:
        return self.models[0].getNumTrees if self.models else 0

    def _transform(self, df: DataFrame) -> DataFrame:
        out, names = df, [f"_margin{i}" for i in range(len(self.models))]
        for m, name in zip(self.models, names):
            out = m.setFeaturesCol(self.getOrDefault(self.featuresCol)).setPredictionCol(name).transform(out)
        out = out.withColumn("probabilities", softmax(F.array(*names))).drop(*names)
        best = F.array_position(F.col("probabilities"), F.array_max("probabilities")) - 1
        return out.withColumns({"probability": array_to_vector(F.col("probabilities")),
                                "prediction": best.cast("double")})

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sc,
                                         extraMetadata={"numModels": len(self.instance.models)})
        for i, m in enumerate(self.instance.models):
            m.save(f"{path}/model_{i}")


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        meta = DefaultParamsReader.loadMetadata(path, self.sc)
        inst = self.cls([GBTRegressionModel.load(f"{path}/model_{i}") for i in range(meta["numModels"])])
        DefaultParamsReader.getAndSetParams(inst, meta)
        inst._resetUid(meta["uid"])
        return inst
