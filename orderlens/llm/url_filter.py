"""URL filter: rules first, then a character language-model ratio, in Spark functions only.

URLs that a rule judges are the labelled examples.  Two variable-order Markov
models (contexts of up to three characters, Witten-Bell interpolation down to
the uniform distribution) are counted over the accepted and the rejected ones.
A URL's score is the mean over its characters (and its end) of the difference
of log-probabilities; the cut is calibrated on labelled URLs that the counts
did not see.  Counts, contexts and scores are grouped sums and joins: nothing
but the two calibration histograms reaches the driver.

Defined results: a null url, or one without ``://``, has empty host and path
and no rule, and is scored like any other (null as empty); repeated rows get
equal verdicts, one row out per row in; null page_ids pass through; other
columns are ignored; without examples of both classes every score is zero or
above the cut and the verdict is allow.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import broadcast_checked, written

# Fixed values: (host, path, verdict).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
ORDER = 4            # characters a gram: one predicted from up to three
ALPHABET = 256       # size of the uniform distribution at the bottom
PAD, END = "\x02", "\x03"
BIN = 200            # calibration bins per nat
MAX_BROADCAST = 300_000   # grams (about 60 bytes each) up to which their scores are broadcast


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def rule_of(h: Column, p: Column, rules=RULES, verdict: bool = False) -> Column:
    """The longest rule that fits (or its verdict), else null."""
    out = F.lit(None).cast("string")
    for rh, rp, v in sorted(rules, key=lambda r: len(r[0]) + len(r[1])):
        fits = ((h == rh) | h.endswith("." + rh)) & p.startswith(rp)
        out = F.when(fits, F.lit(v if verdict else rh + rp)).otherwise(out)
    return out


def _grams(url: Column) -> Column:
    s = F.concat(F.lit(PAD * (ORDER - 1)), F.lower(F.coalesce(url, F.lit(""))), F.lit(END))
    at = F.sequence(F.lit(1), F.length(s) - F.lit(ORDER - 1))
    return F.transform(at, lambda i: F.substring(s, i, F.lit(ORDER)))


def gram_scores(grams: DataFrame) -> DataFrame:
    """(g, delta) from (g, na, nr): log P(last | rest) under accepted minus under rejected."""
    level = {ORDER: grams}
    for k in range(ORDER - 1, 0, -1):
        level[k] = level[k + 1].groupBy(F.substring("g", 2, k).alias("g")).agg(
            F.sum("na").alias("na"), F.sum("nr").alias("nr"))
    prob = None
    for k in range(1, ORDER + 1):
        t = level[k].withColumn("h", F.substring("g", 1, k - 1))
        ctx = t.groupBy("h").agg(F.sum("na").alias("ca"), F.sum("nr").alias("cr"),
                                 F.count(F.when(F.col("na") > 0, 1)).alias("ta"),
                                 F.count(F.when(F.col("nr") > 0, 1)).alias("tr"))
        t = t.join(ctx, "h")
        if prob is None:
            t = t.withColumn("la", F.lit(1.0 / ALPHABET)).withColumn("lr", F.lit(1.0 / ALPHABET))
        else:
            t = t.withColumn("s", F.substring("g", 2, k - 1)).join(
                prob.select(F.col("g").alias("s"), F.col("pa").alias("la"), F.col("pr").alias("lr")), "s")

        def mix(n, c, types, lower):
            total = F.col(c) + F.col(types)
            return F.when(total > 0, (F.col(n) + F.col(types) * F.col(lower)) / total).otherwise(F.col(lower))
        prob = t.select("g", mix("na", "ca", "ta", "la").alias("pa"), mix("nr", "cr", "tr", "lr").alias("pr"))
    return prob.select("g", (F.log("pa") - F.log("pr")).alias("delta"))


def score_urls(pages: DataFrame, rules=RULES) -> DataFrame:
    """(url, label, n, score, cut): every distinct url with its rule label and ratio score."""
    urls = pages.groupBy("url").agg(F.count("*").alias("n"))
    h, p = host(F.col("url")), path(F.col("url"))
    urls = urls.withColumn("label", rule_of(h, p, rules, verdict=True))
    # four of five labelled urls are counted, the fifth calibrates the cut
    urls = written(urls.withColumn("held", F.pmod(F.xxhash64("url"), F.lit(5)) == 0), "url-distinct")
    rows = urls.select("url", "n", "label", "held", F.explode(_grams(F.col("url"))).alias("g"))
    count = lambda v: F.sum(F.when((F.col("label") == v) & ~F.col("held"), F.col("n")).otherwise(0))
    grams = written(rows.groupBy("g").agg(count("allow").alias("na"), count("block").alias("nr")), "url-grams")
    scores = written(gram_scores(grams), "url-scores")
    rows = rows.join(broadcast_checked(scores, MAX_BROADCAST), "g")
    scored = written(rows.groupBy("url", "n", "label", "held").agg(F.avg("delta").alias("score")), "url-scored")
    # bins are bounded: a score is a mean of log-ratios of smoothed probabilities
    bins = (scored.where("held and label is not null")
            .groupBy("label", F.floor(F.col("score") * BIN).alias("bin")).agg(F.sum("n").alias("n")).collect())
    return scored.withColumn("cut", F.lit(_cut([(r["label"], r["bin"], r["n"]) for r in bins])))


def _cut(bins: list) -> float:
    """The bin edge with the best balanced accuracy, nearest to zero; 0 without both classes."""
    total = {v: sum(n for x, _, n in bins if x == v) for v in ("allow", "block")}
    if not all(total.values()):
        return 0.0
    edges = sorted({b for _, b, _ in bins} | {b + 1 for _, b, _ in bins} | {0})
    best, allow_below, block_below, i = (-1.0, 0.0, 0), 0, 0, 0
    order = sorted(bins, key=lambda x: x[1])
    for e in edges:
        while i < len(order) and order[i][1] < e:
            allow_below += order[i][2] * (order[i][0] == "allow")
            block_below += order[i][2] * (order[i][0] == "block")
            i += 1
        right = (1 - allow_below / total["allow"]) + block_below / total["block"]
        best = max(best, (right, -abs(e), e))
    return best[2] / BIN


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) for every page."""
    scored = score_urls(pages, rules).select(F.col("url").alias("u"), "score", "cut")
    h, p = host(F.col("url")), path(F.col("url"))
    ruled = pages.select("page_id", "url", h.alias("host"), p.alias("path"),
                         rule_of(h, p, rules).alias("rule"), rule_of(h, p, rules, True).alias("by_rule"))
    out = ruled.join(scored, ruled["url"].eqNullSafe(scored["u"]), "left")
    model = F.when(F.coalesce("score", F.lit(0.0)) >= F.coalesce("cut", F.lit(0.0)), "allow").otherwise("block")
    return out.select("page_id", "host", "path", "rule", F.coalesce("by_rule", model).alias("verdict"), "score")
