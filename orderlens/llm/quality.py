"""Quality classifier from weak labels.

Overlapping heuristic labellers vote on every document (junk, prose, or
nothing).  Expectation-maximisation over the counts of vote patterns estimates
each labeller's vote rates per class and the class share; no gold label is
read.  The posterior of a document's pattern is its soft label, and a logistic
scorer over hashed word-shape features is trained on those of all documents by
MLlib.  The scorer's output decides, so a document that no labeller knows is
judged too.

Defined results: null or empty text (and text of white space only) votes junk
by the emptiness labeller, has no features and scores below 0.5; repeated rows
get equal scores, one row out per row in; null doc_ids are kept; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter

import numpy as np
import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import map_text
from orderlens.session import shared_path

DIMS = 2048          # hashed feature space
L2, MAX_STEPS = 1e-4, 200   # penalty and most iterations of the logistic regression
KEEP_AT = 0.5        # least score of a kept document

LABELLERS = ("empty", "symbols", "capitals", "repeats", "few_types", "exclaims", "loose_symbols",
             "same_lines", "prose", "sentences", "plain_lines")
JUNK, PROSE, NONE = "0", "1", "-"

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#$%&*|@^~<>{}[]\\+=")] = True
#: bytes of the UTF-8 text to shape classes: a (other letters), A, 0; white space and signs stay
_CLASS = bytes(ord("A") if 65 <= c <= 90 else ord("0") if 48 <= c <= 57 else
               ord("a") if 97 <= c <= 122 or c >= 128 else c for c in range(256))
_RUNS = re.compile(rb"(.)\1+", re.S)


def _slot(name: str) -> int:
    return xxhash.xxh32_intdigest(name.encode("utf-8", "replace")) % DIMS


class _Shapes(dict):
    """class string -> (slot of its shape: runs collapsed, as in "Aa" or "a,"; stands for loose
    symbols; ends a sentence); bounded memo."""

    def __missing__(self, word):
        s = _RUNS.sub(rb"\1", word)
        got = (_slot(f"shape {s!r}"), len(s) <= 3 and not any(c in b"aA0" for c in s),
               s[-1:] in (b".", b"?", b"!"))
        if len(self) < 50_000 and len(word) <= 64:
            self[word] = got
        return got


def measures(text: str, known: _Shapes) -> dict:
    """The few whole-text ratios that the labellers look at, and counts per word shape."""
    words = text.split()
    n = len(words)
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    raw = text.encode("utf-8", "replace")
    byte = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    letters = max(1, int(byte[33:].sum()))
    loose, stops, shapes = 0, 0, {}
    for s, k in Counter(raw.translate(_CLASS).split()).items():
        slot, is_loose, is_stop = known[s]
        shapes[slot] = shapes.get(slot, 0) + k
        loose += k * is_loose
        stops += k * is_stop
    return {"n": n, "shapes": shapes, "symbols": byte[_SYMBOLS].sum() / letters,
            "capitals": byte[65:91].sum() / letters,
            "repeats": sum(map(str.__eq__, words, words[1:])) / max(1, n - 1),
            "richness": len(set(words)) / max(1, n) ** 0.5,
            "exclaims": byte[33] / max(1, n), "loose": loose / max(1, n), "stops": stops / max(1, n),
            "lines": len(lines), "same_lines": 1 - len(set(lines)) / len(lines) if lines else 0.0}


def votes(m: dict) -> str:
    """One character per labeller: 0 junk, 1 prose, - no vote."""
    if not m["n"]:
        return JUNK + NONE * (len(LABELLERS) - 1)
    junk = lambda x: JUNK if x else NONE
    good = lambda x: PROSE if x else NONE
    tidy = m["symbols"] < 0.02 and m["capitals"] < 0.2 and m["repeats"] < 0.05
    return "".join([
        NONE, junk(m["symbols"] > 0.05), junk(m["capitals"] > 0.5), junk(m["repeats"] > 0.2),
        junk(m["n"] >= 30 and m["richness"] < 2.5), junk(m["exclaims"] > 0.3), junk(m["loose"] > 0.2),
        junk(m["lines"] >= 4 and m["same_lines"] > 0.5),
        good(tidy and (m["richness"] > 3.5 or m["n"] < 30 and m["richness"] > 0.7 * m["n"] ** 0.5)),
        good(tidy and m["stops"] > 0 and (m["stops"] < 0.3 or m["n"] < 10)),
        good(m["same_lines"] < 0.2 and m["exclaims"] < 0.05 and m["loose"] < 0.05)])


def features(m: dict):
    """(indices, values) of the hashed feature vector."""
    if not m["n"]:
        return [], []
    out = {i: (v / m["n"]) ** 0.5 for i, v in m["shapes"].items()}
    for i in (i for name, cuts in _CUTS.items() for cut, i in cuts if m[name] > cut):
        out[i] = out.get(i, 0.0) + 0.5
    for i in (i for cut, i in _RICH if m["n"] >= 30 and m["richness"] < cut):
        out[i] = out.get(i, 0.0) + 0.5
    for i in (i for cut, i in _SHORT if m["n"] < cut):
        out[i] = out.get(i, 0.0) + 0.5
    return list(out), list(out.values())


_SHORT = [(cut, _slot(f"words {cut}")) for cut in (4, 8, 16, 30)]
_CUTS = {name: [(cut, _slot(f"{name} {cut}")) for cut in (0.02, 0.05, 0.1, 0.2, 0.4, 0.6)]
         for name in ("symbols", "capitals", "repeats", "exclaims", "loose", "same_lines")}
_RICH = [(cut, _slot(f"richness {cut}")) for cut in (1.5, 2.5, 3.5, 5.0)]


# ------------------------------------------------------------ label model

def fit_label_model(patterns: dict[str, int], rounds: int = 200) -> dict:
    """EM over vote-pattern counts: class share and per-class vote rates of each labeller."""
    rows = sorted(patterns)
    n = np.array([patterns[r] for r in rows], dtype=float)
    codes = np.array([[(JUNK, PROSE, NONE).index(c) for c in r] for r in rows])
    k = len(LABELLERS)
    # start: junk votes are rare but telling, prose votes common on prose
    rate = np.zeros((2, k, 3))
    rate[0] = (0.25, 0.15, 0.60)
    rate[1] = (0.01, 0.60, 0.39)
    share = np.array([0.2, 0.8])
    for _ in range(rounds):
        logp = np.log(share)[None, :] + sum(np.log(rate[:, j, codes[:, j]]).T for j in range(k))
        post = np.exp(logp - logp.max(1, keepdims=True))
        post /= post.sum(1, keepdims=True)
        weight = post * n[:, None]
        share = (weight.sum(0) + 1) / (n.sum() + 2)
        for j in range(k):
            for v in range(3):
                rate[:, j, v] = (weight[codes[:, j] == v].sum(0) + (0.5, 0.5)) / (weight.sum(0) + 1.5)
    return {"posterior": dict(zip(rows, post[:, 1].tolist())), "share": share.tolist(), "rates": rate.tolist()}


# ------------------------------------------------------------------ Spark

def measured(documents: DataFrame) -> DataFrame:
    """(votes, features): votes and feature vector of every row, written."""
    spark = documents.sparkSession

    def start():
        known = _Shapes()

        def f(texts):
            ms = [measures(t or "", known) for t in texts]
            fs = [sorted(zip(*features(m))) for m in ms]
            return [[votes(m) for m in ms], [[i for i, _ in x] for x in fs],
                    [np.asarray([v for _, v in x], dtype=np.float32) for x in fs]]
        return f
    rows = map_text(documents, [], "text", start, [("votes", "string"), ("idx", "array<int>"), ("val", "array<float>")])
    # the fields of a sparse vector, so the table is read back with a vector column
    sparse = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(DIMS).alias("size"), F.col("idx").alias("indices"),
                      F.col("val").cast("array<double>").alias("values"))
    path = shared_path(spark, f"llm-quality-{uuid.uuid4().hex}")
    rows.select("votes", sparse.alias("features")).write.parquet(path)
    return spark.read.schema(T.StructType([T.StructField("votes", T.StringType()),
                                           T.StructField("features", VectorUDT())])).parquet(path)


def fit(documents: DataFrame) -> dict:
    """Label model and scorer, both of all documents.

    A document with posterior p is two rows of the logistic regression: prose with weight p, junk
    with weight 1 - p.
    """
    spark = documents.sparkSession
    every = measured(documents)
    # a vote pattern has one of three values per labeller: a bounded number of groups
    counts = {r["votes"]: r["count"] for r in every.groupBy("votes").count().collect()}
    if not counts:
        return {"posterior": {}, "weights": np.zeros(DIMS), "bias": 0.0, "label_model": None}
    label_model = fit_label_model(counts)
    post = label_model["posterior"]
    model = {"posterior": post, "weights": np.zeros(DIMS), "bias": 0.0, "label_model": label_model}
    if not any(v[0] != JUNK for v in counts):       # the first labeller votes on empty texts, which have no features
        return model
    soft = F.broadcast(spark.createDataFrame([(v, min(max(p, 1e-9), 1 - 1e-9)) for v, p in post.items()],
                                             "votes string, p double"))
    sides = F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("p").alias("weight")),
                              F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("weight"))))
    rows = (every.where(~F.col("votes").startswith(JUNK)).join(soft, "votes")
            .select("features", sides.alias("side")).select("features", "side.*"))
    scorer = LogisticRegression(weightCol="weight", regParam=L2, standardization=False, maxIter=MAX_STEPS,
                                family="binomial").fit(rows)
    model["weights"], model["bias"] = scorer.coefficients.toArray(), float(scorer.intercept)
    return model


def _scorer(model: dict):
    weights, bias, posterior = np.asarray(model["weights"]), model["bias"], model["posterior"]

    def make():
        known = _Shapes()

        def one(t):
            m = measures(t or "", known)
            v = votes(m)
            if not m["n"]:
                return v, posterior.get(v, 0.0), 0.0
            idx, val = features(m)
            z = float(weights[idx] @ np.asarray(val)) + bias
            return v, posterior.get(v, 0.5), float(1 / (1 + np.exp(-z)))
        return one
    return make


def score(documents: DataFrame, model: dict) -> DataFrame:
    """(doc_id, votes, posterior, score, kept) for every row of ``documents``."""
    make = _scorer(model)

    def start():
        one = make()

        def f(texts):
            rows = [one(t) for t in texts]
            return [[r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows],
                    [r[2] >= KEEP_AT for r in rows]]
        return f
    return map_text(documents, ["doc_id"], "text", start, [
        ("votes", "string"), ("posterior", "double"), ("score", "double"), ("kept", "boolean")])


def keep_good(documents: DataFrame, model: dict) -> DataFrame:
    """The rows of ``documents`` (all columns) whose score reaches ``KEEP_AT``."""
    make = _scorer(model)
    at = documents.columns.index("text")

    def run(batches):
        import pyarrow as pa
        one = make()
        for b in batches:
            good = [one(t)[2] >= KEEP_AT for t in b.column(at).to_pylist()]
            yield b.filter(pa.array(good, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
