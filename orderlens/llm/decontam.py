"""Benchmark decontamination: prefix-filtered set join on word shingles, in Spark functions only.

Every benchmark item is cut into windows of ``window`` consecutive words (an
item with fewer words is one window).  A window's shingles are ordered by their
rarity in the documents.  A window occurs in a document only if all its
shingles do, so its necessary prefix is its single rarest shingle: candidates
are the document positions of that shingle.  Positional and length bounds drop
starts outside the document, and a candidate counts only if the shingles at
all its positions are the window's own (shingles are joined word by word, so
this is exact word equality over the item-sized window).

Defined results: null, empty or word-free documents have zero counts and are
clean; null, empty or word-free items have no window; repeated item rows count
as one item; rows of ``documents`` that repeat (same doc_id and text) give one
row, the same doc_id with different texts one row per text; null ids are
groups of their own (a null item_id is left out of the digest); extra columns
are ignored; empty tables give empty or clean results.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import broadcast_checked, written

WINDOW = 10
SHINGLE = 3
#: benchmark shingles up to this many are broadcast (about 100 bytes each); more are shuffled
MAX_BROADCAST = 500_000
#: everything that is not a word character (after A-Z became a-z)
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Word array; A-Z lower-cased only, other letters as they are."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, GAP), "")


def shingles(arr: Column, q: int) -> Column:
    """By position, from 0: null in place of all words, so that an empty array has an element too; from 1:
    (0, 1, ... q - 1), a word and the q - 1 words after it, null past the end."""
    none = F.array(F.lit(None).cast("string"))
    after = [F.slice(arr, F.lit(k + 1), F.greatest(F.size(arr) - F.lit(k), F.lit(0))) for k in range(q)]
    return F.arrays_zip(*[F.concat(none, a) for a in after])


def around(hits: str, reach: int) -> Column:
    """Per (pos, gid) of a sorted array: (pos, gid, at, h) with the ``reach`` hits before and after it
    as ``h`` and its own place there, from 0."""
    return F.transform(hits, lambda x, i: F.struct(
        x["pos"].alias("pos"), x["gid"].alias("gid"), F.least(i, F.lit(reach)).alias("at"),
        F.slice(hits, F.greatest(i - F.lit(reach - 1), F.lit(1)), F.lit(2 * reach + 1)).alias("h")))


def windows(benchmark: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """(wid, len, w: words) of distinct windows, and (wid, item_id) of their items."""
    items = (benchmark.select("item_id", words(F.col("text")).alias("w")).where(F.size("w") > 0))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - F.lit(window - 1), F.lit(1)))
    cut = (items.select("item_id", "w", F.explode(starts).alias("s"))
           .select("item_id", F.slice("w", F.col("s"), F.lit(window)).alias("w")))
    cut = cut.withColumn("key", F.concat_ws(" ", "w"))
    own = written(cut.groupBy("key").agg(F.first("w").alias("w"))
                  .select(F.monotonically_increasing_id().alias("wid"), "key",
                          F.size("w").alias("len"), "w"), "decontam-windows")
    of_item = cut.select("key", "item_id").distinct().join(own.select("key", "wid"), "key")
    return own, written(of_item.select("wid", "item_id"), "decontam-items")


def scan(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW,
         shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, tkey, n_words, spans, items): per document its word count, the sorted
    (start, len) word spans of occurring windows and the sorted ids of occurring items.
    ``tkey`` tells texts of one doc_id apart."""
    wins, of_item = windows(benchmark, window)
    grams = (wins.withColumn("q", F.least(F.lit(shingle), F.col("len")))
             .select("wid", "len", "q", "w", F.explode(F.sequence(F.lit(0), F.col("len") - F.col("q"))).alias("off"))
             .select("wid", "len", "q", "off", F.slice("w", F.col("off") + 1, F.col("q")).alias("gram")))
    ids = written(grams.select("q", "gram").distinct()
                  .select("q", "gram", F.monotonically_increasing_id().alias("gid")), "decontam-grams")
    grams = written(grams.join(ids, ["q", "gram"]).select("wid", "len", "q", "off", "gid"),
                    "decontam-window-grams")
    sizes = sorted(r["q"] for r in ids.select("q").distinct().collect()) or [1]  # at most `shingle` values

    # one row a position, its shingle as columns of words; one marker row (position -1) per document
    # carries its word count through the filter
    cols = [f"w{k}" for k in range(sizes[-1])]
    rows = (documents.select("doc_id", F.xxhash64("text").alias("tkey"), words(F.col("text")).alias("w"))
            .select("doc_id", "tkey", F.size("w").cast("long").alias("n_words"),
                    F.posexplode(shingles(F.col("w"), len(cols))).alias("at", "x"))
            .select("doc_id", "tkey", "n_words", (F.col("at") - 1).alias("pos"),
                    *[F.col("x").getField(str(k)).alias(c) for k, c in enumerate(cols)]))
    for q in sizes:
        own = ids.where(F.col("q") == q).select(
            F.col("gid").alias(f"g{q}"), *[F.get("gram", F.lit(k)).alias(c) for k, c in enumerate(cols[:q])])
        rows = rows.join(broadcast_checked(own, MAX_BROADCAST), cols[:q], "left")
    gids = [F.struct(F.lit(q).alias("q"), F.col(f"g{q}").alias("gid")) for q in sizes]
    marker = F.array(F.struct(F.lit(0).alias("q"), F.lit(None).cast("long").alias("gid")))
    hits = (rows.where((F.col("pos") == -1) | F.coalesce(*[F.col(f"g{q}") for q in sizes]).isNotNull())
            .select("doc_id", "tkey", "n_words", "pos",
                    F.explode(F.when(F.col("pos") == -1, marker).otherwise(F.array(*gids))).alias("g"))
            .select("doc_id", "tkey", "n_words", F.col("g.q").alias("q"), "pos", F.col("g.gid").alias("gid"))
            .where("pos = -1 or gid is not null"))
    hits = written(hits, "decontam-hits")

    # rarity of every benchmark shingle over all documents; a window's prefix is its rarest one
    freq = hits.where("pos >= 0").groupBy("gid").count()
    ranked = grams.join(freq, "gid")               # a window with an unseen shingle cannot occur
    whole = F.count("*") == F.max(F.col("len") - F.col("q") + 1)
    prefix = written(ranked.groupBy("wid").agg(
        F.min(F.struct("count", "gid", "off", "q", "len")).alias("m"), whole.alias("whole"),
        F.transform(F.array_sort(F.collect_list(F.struct("off", "gid"))), lambda x: x["gid"]).alias("gids"))
        .where("whole").select("wid", "m.gid", "m.off", "m.q", "m.len", "gids"), "decontam-prefix")

    # hits of one document side by side: positions ascend, at most one shingle of each size a position;
    # every hit takes along the hits that a window over it can reach, itself at place `at`
    seq = written(hits.where("pos >= 0").groupBy("doc_id", "tkey", "q").agg(
        F.max("n_words").alias("n_words"), F.array_sort(F.collect_set(F.struct("pos", "gid"))).alias("h")),
        "decontam-sequences")
    cand = (seq.select("doc_id", "tkey", "q", "n_words", F.explode(around("h", max(window - shingle, 0))).alias("x"))
            .select("doc_id", "tkey", "q", "n_words", "x.*")
            .join(broadcast_checked(prefix, MAX_BROADCAST // 5), ["q", "gid"]))
    start, n = F.col("pos") - F.col("off"), F.size("gids")
    cand = cand.where((start >= 0) & (start + F.col("len") <= F.col("n_words"))
                      & (F.col("at") >= F.col("off")) & (F.col("at") - F.col("off") + n <= F.size("h")))
    # the bounds above may be evaluated after these: both stay valid for any row
    part = F.slice("h", F.greatest(F.col("at") - F.col("off") + 1, F.lit(1)), n)
    same = ((F.transform(part, lambda x: x["gid"]) == F.col("gids"))
            & (F.get(part, F.lit(0))["pos"] == start)
            & (F.get(part, n - 1)["pos"] == start + n - 1))
    found = written(cand.where(same).select("doc_id", "tkey", "wid", start.alias("start"), "len")
                    .distinct(), "decontam-found")
    spans = found.groupBy("doc_id", "tkey").agg(
        F.array_sort(F.collect_set(F.struct("start", "len"))).alias("spans"))
    items = (found.select("doc_id", "tkey", "wid").distinct()
             .join(of_item, "wid").groupBy("doc_id", "tkey")
             .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items")))
    base = hits.where("pos = -1").select("doc_id", "tkey", "n_words").distinct()
    key = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & a["tkey"].eqNullSafe(b["tkey"])
    out = base.join(spans, key(base, spans), "left").select(base["*"], "spans")
    out = out.join(items, key(out, items), "left").select(out["*"], "items")
    none = F.array().cast("array<struct<start:int,len:int>>")
    return out.select("doc_id", "tkey", "n_words", F.coalesce("spans", none).alias("spans"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def covered(spans: Column) -> Column:
    """Number of words inside a sorted array of (start, len) spans that may overlap."""
    fold = F.aggregate(
        spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(F.lit(0), s["start"] + s["len"] - F.greatest(a["end"], s["start"]))).alias("n"),
            F.greatest(a["end"], s["start"] + s["len"]).alias("end")))
    return fold["n"].cast("long")


def report(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, tkey)."""
    got = scan(documents, benchmark, window).withColumn("n_hit", covered(F.col("spans")))
    return got.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"), "tkey")


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``documents`` without any benchmark window."""
    bad = written(report(documents, benchmark, window).where("contaminated").select("doc_id", "tkey"),
                  "decontam-bad")
    bad = broadcast_checked(bad, 1_000_000).alias("bad")   # two longs a row
    doc = documents.alias("doc")
    same = (F.col("doc.doc_id").eqNullSafe(F.col("bad.doc_id"))
            & F.xxhash64(F.col("doc.text")).eqNullSafe(F.col("bad.tkey")))
    return doc.join(bad, same, "left_anti")
