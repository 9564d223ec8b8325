"""The boosting rounds: targets from margins, and how often the rows are written."""

import math
import os

import pytest
from pyspark.ml.linalg import Vectors

from orderlens.plans import boosting as B
from orderlens.plans.boost_params import BoostParams


def test_rows_are_written_every_tenth_round(spark, scratch, monkeypatch):
    """A round reads the cached rows of the one before; the shared folder sees one in ten."""
    monkeypatch.setattr(B, "shared_path", lambda _, name: os.path.join(scratch, "boost"))
    rows = spark.createDataFrame(
        [(Vectors.dense([float(i % 7), float(i * 37 % 101)]), (i % 7) % 3, 1.0 + i % 2, i % 5 == 0) for i in range(300)],
        ["features", "label_idx", "weight", "is_val"])
    model = B.SoftmaxBoost(weightCol="weight", validationIndicatorCol="is_val", numClasses=3,
                           params=BoostParams(max_iter=11, max_depth=3, step_size=0.1)).fit(rows)
    assert sorted(os.listdir(os.path.join(scratch, "boost"))) == ["0", "10"]
    losses = model.validation_losses
    # the label is a rule over a feature: no round is lost where rows are carried or written
    assert len(losses) == 11 and all(b < a for a, b in zip([math.log(3), *losses], losses))
    # the margins carried through the rounds are those of the model that was kept
    p = {tuple(r["features"]): r["probabilities"] for r in model.transform(rows).collect()}
    val = [(tuple(r["features"]), r["label_idx"]) for r in rows.filter("is_val").collect()]
    assert losses[-1] == pytest.approx(-sum(math.log(p[f][y]) for f, y in val) / len(val), abs=1e-9)


@pytest.mark.parametrize("margins", [[0.0, 0.0, 0.0], [2.5, -1.0, 0.25], [40.0, 0.0, -40.0], [0.7]])
def test_newton_columns_match_the_formulas(spark, margins):
    k = len(margins)
    df = spark.createDataFrame([(y, 1.5, *margins) for y in range(k)], ["y", "w", *[f"m{c}" for c in range(k)]])
    e = [math.exp(m - max(margins)) for m in margins]
    p = [x / sum(e) for x in e]
    for r in B.newton_columns(df, k).collect():
        for c in range(k):
            h = max(p[c] * (1 - p[c]), B.MIN_HESSIAN)
            t = min(max(((r["y"] == c) - p[c]) / h, -B.MAX_STEP), B.MAX_STEP)
            assert r[f"t{c}"] == pytest.approx(t, abs=1e-12) and r[f"h{c}"] == pytest.approx(1.5 * h, rel=1e-12)
        assert r["loss"] == pytest.approx(-math.log(max(p[r["y"]], B.EPS)), abs=1e-12)
