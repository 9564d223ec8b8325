"""Selection, training, scoring and streaming on a learnable label."""

import math
import os
import uuid

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from orderlens.operators.split import stratified_split
from orderlens.plans.catalog_rollup import customer_rollup
from orderlens.plans.boosting import SoftmaxBoostModel
from orderlens.plans.registry import resolve_model_path
from orderlens.plans.scoring import batch_summary, predict_batch
from orderlens.plans.selection import (CramersVSelector, DateFeatures, FeatureSelector,
                                       FeatureSelectorModel)
from orderlens.plans.training import (BoostParams, class_names, encoder_columns, ensure_model, predict,
                                      train_model)
from orderlens.operators.evaluate import log_loss
from orderlens.operators.validate import RecordRules
from orderlens.session import shared_path
from orderlens.streaming.windows import stream_scores

from paths import SF_CHECK


@pytest.fixture(scope="module")
def data(spark):
    cust = customer_rollup(spark, SF_CHECK)
    # label by rule so that a model can learn it (the test tables' labels are random)
    lab = (F.when(F.col("o_totalprice") > 1_500_000, "HIGH")
           .when(F.col("c_mktsegment") == "BUILDING", "BUILD").otherwise("OTHER"))
    df = cust.withColumn("target", lab).drop("o_orderstatus")
    sp = stratified_split(df, "target", ["o_custkey"], 42).cache()
    parts = {s: sp.filter(F.col("split") == s).drop("split") for s in ("train", "val", "test")}
    sel = FeatureSelector(labelCol="target", passthroughCols=["o_custkey"],
                          idPattern="key").fit(parts["train"])
    return {s: sel.transform(d) for s, d in parts.items()}, sel


def test_selector_chain(data):
    parts, sel = data
    rep = sel.report_
    out = sel.getOrDefault(sel.outputCols)
    assert "o_orderdate" not in out and "o_orderdate_day_of_week" in rep["date_features"]
    assert "c_nationkey" in rep["ids"] and "c_nationkey" not in out
    dropped = set(rep["near_constant"]) | set(rep["cramers_v"]) | set(rep["pearson"]) | set(rep["ids"])
    assert not (dropped & set(out))
    assert parts["test"].columns == ["o_custkey", "target", *out]


def test_selector_persistence_and_idempotence(data, spark, scratch):
    parts, sel = data
    p = os.path.join(scratch, "sel")
    sel.write().overwrite().save(p)
    again = FeatureSelectorModel.load(p)
    assert again.getOrDefault(again.outputCols) == sel.getOrDefault(sel.outputCols)
    # applying the fitted choice twice changes nothing
    assert again.transform(parts["val"]).columns == parts["val"].columns


def test_date_features(spark):
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 5, 5),)], "d timestamp_ntz")
    r = DateFeatures(inputCols=["d"]).transform(df).first()
    assert (r["d_day_of_week"], r["d_quarter"]) == (6, 2)


def test_cramers_selector_errors(spark):
    df = spark.createDataFrame([("a", "x")], "p string, q string")
    with pytest.raises(ValueError):
        CramersVSelector(variables=["nope"]).fit(df)
    with pytest.raises(ValueError):
        CramersVSelector(variables=["p", "q"], selectionMethod="bogus").fit(df)


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_train_learns_and_persists(data, spark, scratch, kind):
    parts, sel = data
    cats = sel.getOrDefault(sel.categoricalCols)
    conts = sel.getOrDefault(sel.continuousCols)
    params = BoostParams(max_iter=15, classifier=kind, num_trees=20, max_depth=4)
    model = train_model(parts["train"], parts["val"], "target", cats, conts, params)
    path = os.path.join(scratch, f"m_{kind}")
    model.write().overwrite().save(path)
    model = PipelineModel.load(path)
    assert class_names(model) == ["BUILD", "HIGH", "OTHER"]
    scored = predict(model, parts["test"], cats, conts, with_label=True)
    sums = scored.select(F.aggregate("probabilities", F.lit(0.0), lambda a, x: a + x).alias("s"))
    assert sums.filter(F.abs(F.col("s") - 1.0) > 1e-9).count() == 0
    ll = log_loss(scored, "label_idx", "probabilities").first()[0]
    assert ll < math.log(3)
    assert encoder_columns(model) == (cats, conts)
    if kind == "gbt":
        boost = model.stages[-1]
        assert isinstance(boost, SoftmaxBoostModel) and len(boost.models) == 3


def test_patience_keeps_the_best_round(data, spark):
    parts, sel = data
    cats, conts = sel.getOrDefault(sel.categoricalCols), sel.getOrDefault(sel.continuousCols)
    params = BoostParams(max_iter=12, patience=4, step_size=0.3, max_depth=3)
    boost = train_model(parts["train"], parts["val"], "target", cats, conts, params).stages[-1]
    losses = boost.validation_losses
    best = losses.index(min(losses)) + 1
    assert boost.best_round == best > 1 and min(losses) < losses[0] < math.log(3)
    assert len(losses) in (best + 4, 12)         # it ends four rounds after the best, or at the limit


def test_a_prefix_of_the_rounds_is_the_shorter_run(data, spark):
    """Warm start: the first rounds of a long run are those of a short one, and each is fitted once."""
    parts, sel = data
    cats, conts = sel.getOrDefault(sel.categoricalCols), sel.getOrDefault(sel.continuousCols)

    def losses(rounds):
        params = BoostParams(max_iter=rounds, patience=9, step_size=0.2, max_depth=3)
        return train_model(parts["train"], parts["val"], "target", cats, conts, params).stages[-1].validation_losses
    short, long_ = losses(2), losses(4)
    assert len(short) == 2 and len(long_) == 4
    assert long_[:2] == pytest.approx(short, abs=1e-9)


def test_many_levels_train(data, spark):
    parts, _ = data
    wide = {k: parts[k].withColumn("city", F.concat(F.lit("c"), F.pmod(F.xxhash64(*parts[k].columns), F.lit(60))))
            for k in ("train", "val")}
    train_model(wide["train"], wide["val"], "target", ["city"], [], BoostParams(max_iter=1, max_depth=2))


def test_unseen_class_raises(data, spark):
    parts, sel = data
    cats = sel.getOrDefault(sel.categoricalCols)
    conts = sel.getOrDefault(sel.continuousCols)
    bad_val = parts["val"].withColumn("target", F.lit("NEW"))
    with pytest.raises(Exception):
        train_model(parts["train"], bad_val, "target", cats, conts,
                    BoostParams(classifier="rf", num_trees=5)).stages  # noqa: B018
        raise RuntimeError("no error")


def test_ensure_model_and_registry(data, spark, scratch):
    parts, sel = data
    cats = sel.getOrDefault(sel.categoricalCols)
    conts = sel.getOrDefault(sel.continuousCols)
    path = os.path.join(scratch, "ensured")
    calls = []

    def train_fn():
        calls.append(1)
        train_model(parts["train"], parts["val"], "target", cats, conts,
                    BoostParams(classifier="rf", num_trees=5)).write().overwrite().save(path)

    ensure_model(path, train_fn)
    ensure_model(path, train_fn)
    assert calls == [1]
    with pytest.raises(RuntimeError):
        ensure_model(os.path.join(scratch, "never"), lambda: None)
    reg = spark.createDataFrame(
        [("m", 1, "Production", "/models/m/1"), ("m", 3, "None", "/models/m/3"),
         ("m", 2, "Production", "/models/m/2"), ("x", 9, "Production", "/models/x/9")],
        "name string, version int, stage string, path string")
    assert resolve_model_path(reg, "m") == "/models/m/2"
    assert resolve_model_path(reg, "m", "Staging") == "/models/m/3"
    with pytest.raises(LookupError):
        resolve_model_path(reg, "zz")


def test_batch_and_stream_scoring_agree(data, spark, scratch):
    parts, sel = data
    cats = sel.getOrDefault(sel.categoricalCols)
    conts = sel.getOrDefault(sel.continuousCols)
    model = train_model(parts["train"], parts["val"], "target", cats, conts,
                        BoostParams(classifier="rf", num_trees=10))
    rules = RecordRules(allowed={"c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE",
                                                  "HOUSEHOLD", "MACHINERY"]},
                        ranges={"o_totalprice": (0, 2_000_000)})
    records = parts["test"].drop("target")
    scored, bad = predict_batch(model, records, rules, cats, conts, "7")
    n_in = records.count()
    assert scored.count() + bad.count() == n_in
    summ = batch_summary(scored, records).first()
    assert summ["total_samples"] == n_in
    assert summ["successful_predictions"] == scored.count()
    assert sum(summ["prediction_distribution"].values()) == scored.count()
    assert 0.0 <= summ["confidence_stats"]["min"] <= summ["confidence_stats"]["max"] <= 1.0

    src = os.path.join(scratch, "incoming")
    records.repartition(3).write.parquet(src)

    def score_fn(batch):
        s, b = predict_batch(model, batch, rules, cats, conts, "7")
        return s.select("o_custkey", "predicted_class", "confidence"), b.select("o_custkey", "errors")

    to = shared_path(spark, f"r1-test-{uuid.uuid4().hex}")
    out, quarantine = stream_scores(spark, src, score_fn, out_path=to)
    assert stream_scores(spark, src, score_fn, out_path=to) == (out, quarantine)   # a rerun adds nothing
    streamed = spark.read.parquet(out).drop("batch")
    batch = scored.select("o_custkey", "predicted_class", "confidence")
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0
