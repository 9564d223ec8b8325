"""Filter interaction audit: what every order of a set of filters removes, step by step.

Each document is reduced to the mask of the filters it fails, and documents are
counted per part and mask before anything else happens.  Orders are numbered by
their Lehmer rank, so all orders that start with the same letters are one
interval of ranks.  A mask is removed at step ``i`` by filter ``f`` in exactly
those orders whose first ``i - 1`` letters lie outside the mask and whose next
letter is ``f``: one interval for each such prefix.  The counts of a mask are
added at the start of its intervals and subtracted at their end, and one prefix
sum over the ranks turns these difference arrays into the totals of every
order.  Work after the counting depends on the parts, not on the documents.

Repeated texts are found from the counted cells of a text digest: only the
smallest doc_id of a text passes, wherever the others stand.

Defined results: a null text is the empty text, a null lang the part ``""``, a
null doc_id is smaller than nothing and repeats nothing; every row counts, also
repeated ones, and rows that share the smallest doc_id of a text all pass; a
doc_id with several labels has a label if one of them says so; other columns
are ignored; an empty table gives an empty result; any length is read whole.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import written

MIN_WORDS = 100        # A: fewer words
MIN_DISTINCT = 80      # B: fewer distinct words, percent
MAX_CAPITALS = 10      # C: more capitals, percent of the code points
SIGNS = "[#$%&*|]"     # D: any of these
LETTERS = "ABCDE"      # E: the text of a smaller doc_id

SUMS = ("removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def lehmer_rank(order: str, letters: str = LETTERS) -> int:
    """Place of ``order`` (or of the first order that starts with it) among all orders, from 0."""
    left, rank = list(letters), 0
    for ch in order:
        at = left.index(ch)
        rank += at * factorial(len(left) - 1)
        del left[at]
    return rank


def intervals(letters: str = LETTERS) -> list[tuple[int, int, str, bool, bool, int, int]]:
    """(mask, step, filter, removed here, fails only this, first rank, end rank) for every prefix of an order."""
    n, out = len(letters), []
    bit = {ch: 1 << k for k, ch in enumerate(letters)}
    for step in range(1, n + 1):
        for order in permutations(letters, step):
            lo = lehmer_rank(order, letters)
            hi, own = lo + factorial(n - step), bit[order[-1]]
            before = sum(bit[ch] for ch in order[:-1])
            for mask in range(1, 1 << n):
                if mask & own:
                    out.append((mask, step, order[-1], not mask & before, mask == own, lo, hi))
    return out


def order_audit(cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Totals of all orders from counted cells.

    ``cells`` holds part, mask (bit k: fails the filter of letter k), n, good
    and toxic; the result has a row per part, filter_order and step.
    """
    spark, total = cells.sparkSession, factorial(len(letters))
    cells = written(cells.groupBy("part", "mask").agg(*(F.sum(c).cast("long").alias(c)
                                                        for c in ("n", "good", "toxic"))), "audit-cells")
    table = spark.createDataFrame(intervals(letters), "mask int, step int, letter string, here boolean, "
                                                      "single boolean, lo int, hi int")
    hit = cells.join(F.broadcast(table), "mask")       # at most letters * 2 ** letters * orders rows, whatever the data

    def only(cond: str, value: str) -> Column:
        return F.when(F.col(cond), F.col(value)).otherwise(0)

    sums = [only("here", "n"), F.when(~F.col("here"), F.col("n")).otherwise(0), only("single", "n"),
            only("here", "good"), only("here", "toxic")]
    ends = hit.select("part", "step", *(s.alias(c) for s, c in zip(sums, SUMS)), F.explode(F.array(
        F.struct(F.col("lo").alias("rank"), F.lit(1).alias("sign")),
        F.struct(F.col("hi").alias("rank"), F.lit(-1).alias("sign")))).alias("end"))
    ends = ends.select("part", "step", "end.rank", *((F.col(c) * F.col("end.sign")).alias(c) for c in SUMS))
    parts = cells.groupBy("part").agg(F.sum("n").alias("total"))
    grid = (parts.select("part", F.explode(F.sequence(F.lit(1), F.lit(len(letters)))).alias("step"))
            .select("part", "step", F.explode(F.sequence(F.lit(0), F.lit(total - 1))).alias("rank"))
            .select("part", "step", "rank", *(F.lit(0).cast("long").alias(c) for c in SUMS)))
    diffs = ends.unionByName(grid).groupBy("part", "step", "rank").agg(*(F.sum(c).alias(c) for c in SUMS))
    along = Window.partitionBy("part", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    runs = (diffs.select("part", "step", "rank", *(F.sum(c).over(along).alias(c) for c in SUMS))
            .where(F.col("rank") < total))
    names = spark.createDataFrame([(lehmer_rank(p, letters), "".join(p)) for p in permutations(letters)],
                                  "rank int, filter_order string")
    runs = runs.join(F.broadcast(names), "rank").join(parts, "part")
    steps = Window.partitionBy("part", "filter_order").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    letter = F.expr("substring(filter_order, step, 1)")
    return runs.select(
        "part", "filter_order", "step", (F.col("total") - F.sum("removed").over(steps)).alias("kept"), *SUMS,
        F.sum("removed").over(Window.partitionBy("part", letter)).alias("shapley"))


def text_flags(text: Column) -> Column:
    """Bits of the filters A to D that a text fails."""
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.size(words)
    fails = [n < MIN_WORDS, 100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * n,
             100 * F.regexp_count(text, F.lit("[A-Z]")) > MAX_CAPITALS * F.length(text), text.rlike(SIGNS)]
    return sum((f.cast("int") * (1 << k) for k, f in enumerate(fails)), F.lit(0)).cast("int")


def masks(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents counted by the filters they fail."""
    text = F.coalesce("text", F.lit(""))
    seen = documents.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"),
                            F.unhex(F.sha2(text, 256)).alias("sha"), text_flags(text).alias("bits"))
    # one row per document and text, so repeated rows of any number are one row before they meet
    seen = written(seen.groupBy("doc_id", "part", "sha", "bits").agg(F.count("*").alias("n")), "audit-texts")

    def says(column: str) -> Column:
        return F.max(F.coalesce((F.col(column) == 1).cast("int"), F.lit(0)))

    marks = (labels.where("doc_id is not null").groupBy("doc_id")
             .agg(says("quality").alias("good"), says("toxic").alias("toxic")))
    live = seen.where("doc_id is not null").join(marks, "doc_id", "left").na.fill(0, ["good", "toxic"])
    lone = seen.where("doc_id is null").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    cells = live.unionByName(lone).groupBy("sha", "bits", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("free"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first"))
    least = F.min("first.doc_id").over(Window.partitionBy("sha"))     # a few cells per text
    cells = cells.withColumn("least", least)
    good = F.col("free") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    both = F.explode(F.array(F.struct(F.col("bits").alias("mask"), F.col("ok").alias("n")),
                             F.struct((F.col("bits") + 16).alias("mask"), (F.col("n") - F.col("ok")).alias("n"))))
    return (cells.withColumn("ok", good).select("part", "good", "toxic", both.alias("m"))
            .groupBy("part", "m.mask").agg(F.sum("m.n").alias("n"), F.sum(F.col("m.n") * F.col("good")).alias("good"),
                                           F.sum(F.col("m.n") * F.col("toxic")).alias("toxic")))


def report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step."""
    return order_audit(masks(documents, labels))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                 max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT w.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
        [len(ws) < 100, 100 * len(list_distinct(ws)) < 80 * len(ws),
         100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t),
         regexp_matches(t, '[#$%&*|]'),
         coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false)] AS fails
      FROM w LEFT JOIN marks m ON m.doc_id = w.doc_id),
cells AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT unnest(range(1, 6)) AS i),
orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS p FROM l a, l b, l c, l d, l e
           WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT p, i AS step, p[i] AS f, p[1:i - 1] AS before,
                 array_to_string(list_transform(p, lambda x: substr('ABCDE', x, 1)), '') AS filter_order FROM orders, l),
hit AS (SELECT c.part, s.filter_order, s.step, s.f, c.n, c.good, c.toxic, c.fails[s.f] AS fails_it,
               len(list_filter(s.before, lambda x: c.fails[x])) AS earlier, len(list_filter(c.fails, lambda x: x)) AS k
        FROM cells c, steps s),
sums AS (SELECT part, filter_order, step, any_value(f) AS f,
           sum(n)::BIGINT AS total, coalesce(sum(n) FILTER (earlier > 0), 0)::BIGINT AS gone,
           coalesce(sum(n) FILTER (fails_it AND earlier = 0), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (fails_it AND earlier > 0), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (fails_it AND k = 1), 0)::BIGINT AS unique_fails,
           coalesce(sum(good) FILTER (fails_it AND earlier = 0), 0)::BIGINT AS good_lost,
           coalesce(sum(toxic) FILTER (fails_it AND earlier = 0), 0)::BIGINT AS toxic_lost
         FROM hit GROUP BY part, filter_order, step)
SELECT part, filter_order, step, total - gone - removed AS kept, removed, redundant, unique_fails, good_lost,
       toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM sums
"""
