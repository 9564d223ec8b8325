"""Classification metrics as DataFrames.

Input: a predictions frame with an integer true class index, an integer
predicted index and (for log loss) a probability array in class order.
All metrics come from aggregates; the confusion counts are a k x k table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: probability clip for log loss (sklearn style).
LOG_LOSS_EPS = 1e-15


def log_loss(df: DataFrame, label: str, probs: str, eps: float = LOG_LOSS_EPS) -> DataFrame:
    """Mean -ln(p_true), p clipped to [eps, 1-eps]."""
    p = F.element_at(F.col(probs), F.col(label).cast("int") + 1)
    p = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    return df.agg(F.avg(-F.ln(p)).alias("log_loss"))


def accuracy(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Share of exact hits."""
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"))


def confusion_counts(df: DataFrame, label: str, pred: str, classes: Sequence[str] | None = None,
                     k: int | None = None) -> DataFrame:
    """(actual, predicted, n) for EVERY class pair, zero cells included.

    The k x k grid comes from exploding ``sequence(0, k-1)`` twice over a
    one-row frame; counts are left-joined onto it.
    """
    k = k if k is not None else len(classes)
    counts = df.groupBy(F.col(label).cast("int").alias("actual"),
                        F.col(pred).cast("int").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    seq = F.sequence(F.lit(0), F.lit(k - 1))
    grid = (df.sparkSession.range(1).select(F.explode(seq).alias("actual"))
            .select("actual", F.explode(seq).alias("predicted")))
    out = grid.join(counts, ["actual", "predicted"], "left").fillna({"n": 0})
    if classes:
        names = F.array(*[F.lit(c) for c in classes])
        out = out.withColumns({"actual_class": F.element_at(names, F.col("actual") + 1),
                               "predicted_class": F.element_at(names, F.col("predicted") + 1)})
    return out


def per_class_report(confusion: DataFrame) -> DataFrame:
    """precision / recall / f1 / support per class plus macro and weighted
    averages, from the k x k counts (E3).  Empty denominators give 0, as
    sklearn's zero_division default reports."""
    tp = confusion.filter(F.col("actual") == F.col("predicted")).select(
        F.col("actual").alias("cls"), F.col("n").alias("tp"))
    sup = confusion.groupBy(F.col("actual").alias("cls")).agg(F.sum("n").alias("support"))
    prd = confusion.groupBy(F.col("predicted").alias("cls")).agg(F.sum("n").alias("predicted_n"))
    rep = tp.join(sup, "cls").join(prd, "cls")
    prec = F.when(F.col("predicted_n") > 0, F.col("tp") / F.col("predicted_n")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    rep = rep.select("cls", prec.alias("precision"), rec.alias("recall"),
                     F.col("support").cast("long").alias("support"))
    rep = rep.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall")
                                      / (F.col("precision") + F.col("recall"))).otherwise(0.0))
    per = rep.select(F.col("cls").cast("string").alias("scope"), "precision", "recall", "f1",
                     "support")
    macro = rep.agg(F.lit("macro avg").alias("scope"), F.avg("precision").alias("precision"),
                    F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                    F.sum("support").cast("long").alias("support"))
    tot = F.sum("support")
    weighted = rep.agg(F.lit("weighted avg").alias("scope"),
                       (F.sum(F.col("precision") * F.col("support")) / tot).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / tot).alias("recall"),
                       (F.sum(F.col("f1") * F.col("support")) / tot).alias("f1"),
                       tot.cast("long").alias("support"))
    return per.unionByName(macro).unionByName(weighted)


def metric_cells(df: DataFrame, label: str, pred: str, probs: str, k: int, by: Sequence[str] = (),
                 eps: float = LOG_LOSS_EPS) -> DataFrame:
    """(by..., actual, predicted, n, loss, bad_width): all that the metrics need, one scan.

    ``loss`` sums -ln of the clipped true-class probability, ``bad_width`` counts
    rows whose probability array does not have ``k`` entries (E5); those have no
    loss of their own beyond the clip.
    """
    p = F.coalesce(F.get(F.col(probs), F.col(label).cast("int")), F.lit(0.0))
    p = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    return df.groupBy(*by, F.col(label).cast("int").alias("actual"), F.col(pred).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(-F.ln(p)).alias("loss"),
        F.count(F.when(F.coalesce(F.size(F.col(probs)), F.lit(-1)) != k, 1)).alias("bad_width"))


def _ratio(a: F.Column, b: F.Column) -> F.Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def metrics_from_cells(cells: DataFrame, classes: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by..., metric, class, value) rows from :func:`metric_cells`.

    Per class precision, recall, f1 and support (E3); over all classes log_loss
    (E1), accuracy (E2), bad_width (E5), rows, and macro and weighted averages.
    Empty denominators give 0.  Cells are counted once: each hands its counts to
    its actual and its predicted class, and zero rows add the classes without any.
    """
    k, by = len(classes), list(by)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)

    def share(cls, support, tp, said, loss, bad):
        return F.struct(cls.alias("cls"), support.cast("long").alias("support"), tp.cast("long").alias("tp"),
                        said.cast("long").alias("said"), loss.alias("loss"), bad.cast("long").alias("bad"))
    zero, none = F.lit(0), F.lit(0.0)
    given = F.array(share(F.col("actual"), F.col("n"), hit, zero, F.col("loss"), F.col("bad_width")),
                    share(F.col("predicted"), zero, zero, F.col("n"), none, zero))
    every = F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                        lambda c: share(c, zero, zero, zero, none, zero))
    parts = cells.select(*by, F.inline(F.concat(given, every)))
    cls = parts.filter(F.col("cls").isNotNull()).groupBy(*by, "cls").agg(
        *[F.sum(c).alias(c) for c in ("support", "tp", "said", "loss", "bad")])
    cls = cls.withColumns({"precision": _ratio(F.col("tp"), F.col("said")),
                           "recall": _ratio(F.col("tp"), F.col("support"))})
    both = F.col("precision") + F.col("recall")
    cls = cls.withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), both))
    rows = F.sum("support")
    whole = [("rows", rows.cast("double")), ("log_loss", F.sum("loss") / rows), ("accuracy", F.sum("tp") / rows),
             ("bad_width", F.sum("bad").cast("double"))]
    for m in ("precision", "recall", "f1"):
        whole += [(f"macro_{m}", F.avg(m)), (f"weighted_{m}", F.sum(F.col(m) * F.col("support")) / rows)]
    names = F.array(*[F.lit(c) for c in classes])
    total = cls.groupBy(*by).agg(F.collect_list(F.struct("cls", "precision", "recall", "f1", "support")).alias("per"),
                                 F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(None).cast("string").alias("class"),
                                                    v.alias("value")) for m, v in whole]).alias("whole"))
    out = total.withColumn("all", F.concat("whole", F.flatten(F.transform("per", lambda x: F.array(*[
        F.struct(F.lit(m).alias("metric"), F.get(names, x["cls"]).alias("class"), x[m].cast("double").alias("value"))
        for m in ("precision", "recall", "f1", "support")])))))
    return out.select(*by, F.inline("all"))


def evaluate_splits(scored: DataFrame, label: str, pred: str, probs: str, classes: Sequence[str],
                    split: str = "split") -> DataFrame:
    """All metrics of all splits as (split, metric, class, value) rows, from one scan."""
    return metrics_from_cells(metric_cells(scored, label, pred, probs, len(classes), [split]), classes, [split])
