"""Toxicity by multiple-instance learning.

A document is a bag of sentences.  A sentence's probability is the logistic of
a bias and the weights of its distinct words (a word's weight is its own plus
those of its prefixes of 5 to 7 letters); the document's probability is
their noisy-or, 1 - prod(1 - p).  Weights are trained from document labels
alone by proximal gradient steps on the bag likelihood (an L1 term keeps the
lexicon small), so the sentences that carry a label are found on the way.

Defined results: null, empty and word-free texts hold one empty sentence, whose
score is the bias; repeated rows score alike (one row out per row in) and are
trained on once (the smallest text of a doc_id); a null
doc_id is kept (it is not held out); other columns are ignored; without labels
of both classes every score is the share of label 1 (0 if there is none).
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import map_text

SENTENCE = re.compile(r"[.!?\n]+")
WORD = re.compile(r"\w+")
MAX_PER_CLASS = 4000   # labelled rows of each class that the model is fitted on
MIN_DOCS = 8           # label-1 training documents that a word must occur in
MIN_Z = 6.0            # least z-score of its share in label-1 against label-0 documents
MAX_WORDS = 20_000     # words that can get a weight, highest z-score first
PREFIXES = (5, 6, 7)
COMMON = 20            # sentences in more documents than this don't identify copies
THRESHOLD = 0.3


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans (code points) of the non-empty pieces between sentence marks."""
    out, at = [], 0
    for m in SENTENCE.finditer(text):
        if m.start() > at:
            out.append((at, m.start()))
        at = m.end()
    if at < len(text):
        out.append((at, len(text)))
    return out


def features(word: str) -> list[str]:
    return [word, *("^" + word[:k] for k in PREFIXES if len(word) > k)]


class Weights(dict):
    """word -> summed weight of its features; bounded memo."""

    def __init__(self, model: dict):
        super().__init__()
        self.known = model["words"]

    def __missing__(self, word):
        got = sum(self.known.get(f, 0.0) for f in features(word))
        if len(self) < 500_000:
            self[word] = got
        return got


def fit_bags(bags: list, labels: np.ndarray, weights: np.ndarray, l1: float = 2e-5,
             steps: int = 300) -> dict:
    """``bags``: per document a list of sentences, each a list of distinct words."""
    pos_df, neg_df = Counter(), Counter()
    for bag, y in zip(bags, labels):
        (pos_df if y else neg_df).update({f for s in bag for w in s for f in features(w)})
    n1, n0 = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))

    def z_score(w):
        p1, p0 = pos_df[w] / n1, neg_df[w] / n0
        p = (pos_df[w] + neg_df[w]) / (n1 + n0)
        return (p1 - p0) / math.sqrt(p * (1 - p) * (1 / n1 + 1 / n0)) if p < 1 else 0.0
    usable = sorted((-z, w) for w in pos_df if pos_df[w] >= MIN_DOCS and (z := z_score(w)) >= MIN_Z)
    usable = [w for _, w in usable]
    index = {w: i for i, w in enumerate(usable[:MAX_WORDS])}
    sent_doc, tok_sent, tok_word = [], [], []
    for d, bag in enumerate(bags):
        for s in bag or [[]]:
            k = len(sent_doc)
            sent_doc.append(d)
            for f in (f for w in s for f in features(w)):
                if f in index:
                    tok_sent.append(k)
                    tok_word.append(index[f])
    sent_doc, tok_sent, tok_word = (np.array(x, dtype=np.int64) for x in (sent_doc, tok_sent, tok_word))
    n_doc, n_sent, n_word = len(bags), len(sent_doc), len(index)
    w, b = np.zeros(n_word), -6.0
    m, v, mb, vb = np.zeros(n_word), np.zeros(n_word), 0.0, 0.0
    scale = weights / weights.sum()
    for t in range(1, steps + 1):
        z = b + np.bincount(tok_sent, w[tok_word], n_sent)
        p = 1 / (1 + np.exp(-z))
        log_none = np.bincount(sent_doc, np.log1p(-np.minimum(p, 1 - 1e-12)), n_doc)
        none = np.exp(log_none)                       # probability that no sentence offends
        some = np.maximum(1 - none, 1e-9)
        # d(-loglik)/dz of a sentence: p for label 0, -p * none / some for label 1
        g_doc = scale * np.where(labels == 1, -none / some, 1.0)
        g_sent = g_doc[sent_doc] * p
        g, gb = np.bincount(tok_word, g_sent[tok_sent], n_word), float(g_sent.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9 ** t, 1 - 0.999 ** t
        rate = 0.1 / (np.sqrt(v / c2) + 1e-8)
        w = w - rate * (m / c1)
        w = np.sign(w) * np.maximum(np.abs(w) - np.minimum(rate * l1, 0.05), 0)
        b = b - 0.1 * (mb / c1) / ((vb / c2) ** 0.5 + 1e-8)
    words = {x: float(w[i]) for x, i in index.items() if abs(w[i]) > 1e-3}
    return {"words": words, "bias": float(b)}


def distinct_bags(bags: list) -> list[int]:
    """Numbers of the bags left when copies are dropped: bags with the same least sentence hash,
    over sentences of few documents, count once (copies would repeat their words as evidence)."""
    keys = [{xxhash.xxh3_64_intdigest(" ".join(s)) for s in b} for b in bags]
    df = Counter(k for own in keys for k in own)
    first: dict = {}
    for i, own in enumerate(keys):
        first.setdefault(min((k for k in own if df[k] <= COMMON), default=min(own, default=0)), i)
    return sorted(first.values())


def _logistic(z: float) -> float:
    return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def _sentence(piece: str, weights: Weights, bias: float) -> float:
    return _logistic(bias + math.fsum(map(weights.__getitem__, set(WORD.findall(piece)))))


def sentence_scores(text: str, model: dict) -> list[tuple[int, int, float]]:
    """(start, end, probability) of every sentence."""
    weights, bias = Weights(model), model["bias"]
    return [(s, e, _sentence(text[s:e].lower(), weights, bias)) for s, e in sentences(text)]


def document_score(text: str | None, model: dict, weights: Weights | None = None) -> float:
    """Noisy-or of the sentence probabilities (an empty text is one empty sentence)."""
    weights, bias = weights if weights is not None else Weights(model), model["bias"]
    pieces = [x for x in SENTENCE.split((text or "").lower()) if x] or [""]
    return -math.expm1(math.fsum(math.log1p(-min(_sentence(x, weights, bias), 1 - 1e-12)) for x in pieces))


def fit(documents: DataFrame, labels: DataFrame, max_per_class: int = MAX_PER_CLASS) -> dict:
    """Train on labelled rows that are not held out, at most ``max_per_class`` of each class."""
    rows = (labels.where(~held_out("doc_id") & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
            .select("doc_id", F.col("toxic").cast("int").alias("toxic")).distinct())
    totals = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    if len(totals) < 2:
        p = 1.0 - 1e-9 if totals.get(1) else 0.0
        return {"words": {}, "bias": math.log(p / (1 - p)) if p else -1e9}
    part = [rows.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_per_class)
            for y in (0, 1)]
    # at most 2 * max_per_class rows: a proven broadcast size
    chosen = F.broadcast(part[0].unionByName(part[1]))

    def start():
        def f(texts):
            bags = [[sorted(set(WORD.findall(x))) for x in SENTENCE.split((t or "").lower()) if x]
                    for t in texts]
            return [["\n".join(" ".join(s) for s in b) for b in bags]]
        return f
    docs = (documents.select("doc_id", "text").join(chosen, "doc_id")
            .groupBy("doc_id", "toxic").agg(F.min("text").alias("text")))   # a repeated doc_id stays one row
    got = map_text(docs, ["doc_id", "toxic"], "text", start, [("bag", "string")]).collect()
    got.sort(key=lambda r: (r["doc_id"], r["toxic"], r["bag"]))
    bags = [[s.split(" ") if s else [] for s in r["bag"].split("\n")] for r in got]
    left = distinct_bags(bags)
    bags, y = [bags[i] for i in left], np.array([got[i]["toxic"] for i in left])
    if len(set(y.tolist())) < 2:
        return {"words": {}, "bias": -1e9 if not y.sum() else 20.0}
    share = {c: totals[c] / max(1, (y == c).sum()) for c in (0, 1)}
    weight = np.array([share[int(c)] for c in y])
    return fit_bags(bags, y, weight)


def score(documents: DataFrame, model: dict) -> DataFrame:
    """(doc_id, score, worst_start, worst_end): noisy-or score and the likeliest offending sentence
    (null unless the score reaches the threshold)."""
    def start():
        weights = Weights(model)

        def f(texts):
            scores, first, last = [], [], []
            for t in texts:
                s = document_score(t, model, weights)
                scores.append(s)
                worst = max(sentence_scores(t, model), key=lambda x: (x[2], -x[0]),
                            default=None) if s >= THRESHOLD and t else None
                first.append(worst and worst[0])
                last.append(worst and worst[1])
            return [scores, first, last]
        return f
    return map_text(documents, ["doc_id"], "text", start, [
        ("score", "double"), ("worst_start", "int"), ("worst_end", "int")])
