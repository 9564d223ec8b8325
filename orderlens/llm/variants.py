"""Spelling variants: words one edit apart, found through a variable-length gram index.

Words are runs of letters, counted over all documents.  A word is written as
``^word$`` and cut at each place into the shortest gram of at least ``Q_MIN``
characters that is no longer frequent (more than 1 / ``GRAM_SHARE`` of all
places, at least ``MIN_FREQUENT``), at most ``Q_MAX`` characters.  The dictionary
behind that, the frequent grams, holds at most ``GRAM_SHARE`` grams of each
length, whatever the corpus; all other grams are cut by not being in it.

A gram depends on its own characters only, so one edit affects just the grams
that cover the place of the edit.  The largest number of grams over one place is
the word's affected-gram bound: a word one edit away shares all other grams, each
at the same place or one further on.  Grams have one order, rare ones first, so
two near words share a gram within the first ``bound + 1`` of each, and only
those are listed.  With words of at least ``MIN_LENGTH`` characters more grams
than the bound always remain: no pair is missed.  Lists are kept apart by place
and length, merged by joins (long lists in blocks), and each pair that meets is
verified inside the join, so only near pairs leave it.

A word's form is its most frequent near word, if that is ``RATIO`` times as
frequent; its root is where the forms lead to.

Defined results: a null or empty text has no words, a null doc_id is written as
the empty text; every row counts, also repeated ones; among forms of the same
frequency the smallest in code-point order is taken; other columns are ignored;
an empty table gives an empty result; texts and words of any length are used whole.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import broadcast_checked, byte_slices, tidy, written

MIN_LENGTH = 7         # code points of a word
MIN_COUNT = 2          # occurrences of a word
TYPO = 31              # one run in so many loses a code point
RATIO = 10             # least frequency of a form, in frequencies of the word
Q_MIN, Q_MAX = 2, 5    # code points of a gram; Q_MAX <= MIN_LENGTH - Q_MIN + 2 keeps every word indexed
GRAM_SHARE = 50_000    # a gram is frequent if it holds more than 1 / GRAM_SHARE of all places
MIN_FREQUENT = 8
HELD = 100_000         # counted keys a task holds before it passes them on
BLOCK = 2_000          # list entries that one side of a join task holds
MAX_BROADCAST = 500_000     # list keys (about 40 bytes) that may be broadcast

#: letters in UTF-8: A-Z, a-z and U+00C0 to U+00FF, whose first byte starts no other character
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")


def runs(doc_id, text: bytes) -> Counter:
    """Occurrences of the long words of one text, after the deletions that ``TYPO`` asks for."""
    out: Counter = Counter()
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(_RUN.findall(text.lower())).items():      # bytes.lower changes A-Z only
        if len(run) < MIN_LENGTH:
            continue
        h = zlib.crc32(run, start)
        if h % TYPO == 0:
            s = run.decode()
            at = h % len(s)
            run = (s[:at] + s[at + 1:]).encode()
        out[run] += n
    return out


def _sums(counts: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(counts)).cast(pa.string()),
                                       pa.array(list(counts.values()), pa.int64())], ["key", "n"])


def word_counts(documents: DataFrame) -> DataFrame:
    """(word, n, length): the words of all documents; counted within tasks before the shuffle."""
    def run(batches):
        held: Counter = Counter()
        for b in (part for whole in batches for part in byte_slices(whole, 1)):
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text:
                    held.update(runs(doc_id, text))
                if len(held) >= HELD:
                    yield _sums(held)
                    held.clear()
        if held:
            yield _sums(held)

    texts = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    counts = texts.mapInArrow(tidy(run), "key string, n long").groupBy(F.col("key").alias("word")).agg(F.sum("n").alias("n"))
    return (counts.withColumn("length", F.length("word"))
            .where((F.col("length") >= MIN_LENGTH) & (F.col("n") >= MIN_COUNT)))


def frequent_grams(words: DataFrame) -> dict[str, int]:
    """The frequent grams and their counts: at most ``GRAM_SHARE`` of each length."""
    places = words.agg(F.sum(F.col("length") + 1)).first()[0] or 0
    least = max(MIN_FREQUENT, places // GRAM_SHARE)

    def run(batches):
        held: Counter = Counter()
        for b in batches:
            for w in b.column(0).to_pylist():
                s = f"^{w}$"
                for q in range(Q_MIN, Q_MAX + 1):
                    held.update(s[p:p + q] for p in range(len(s) - q + 1))
                if len(held) >= HELD:
                    yield _sums(held)
                    held.clear()
        if held:
            yield _sums(held)

    got = words.select("word").mapInArrow(tidy(run), "key string, n long").groupBy("key").agg(F.sum("n").alias("n"))
    return {r.key: r.n for r in got.where(F.col("n") > least).collect()}


def grams(word: str, frequent: dict[str, int]) -> list[tuple[str, int]]:
    """(gram, place) of a word: at each place the shortest gram that is not frequent."""
    s, out = f"^{word}$", []
    for p in range(len(s) - Q_MIN + 1):
        q = Q_MIN
        while q < Q_MAX and p + q < len(s) and s[p:p + q] in frequent:
            q += 1
        out.append((s[p:p + q], p))
    return out


def affected(parts: list[tuple[str, int]]) -> int:
    """The largest number of grams that one edit can affect."""
    starts, ends = [p for _, p in parts], sorted(p + len(g) for g, p in parts)
    most = done = 0
    for k, p in enumerate(starts):           # places are ascending: grams over place p have started and not ended
        while ends[done] <= p:
            done += 1
        most = max(most, k + 1 - done)
    return most


def listed(word: str, frequent: dict[str, int]) -> list[tuple[str, int]]:
    """The first ``affected + 1`` grams of a word, rare ones first."""
    parts = grams(word, frequent)
    order = sorted(parts, key=lambda x: (frequent.get(x[0], 0), zlib.crc32(x[0].encode()), x))
    return order[:affected(parts) + 1]


def gram_lists(words: DataFrame) -> DataFrame:
    """(gram, place, length, word, n): the lists of the index."""
    frequent = words.sparkSession.sparkContext.broadcast(frequent_grams(words))

    def run(batches):
        known = frequent.value
        for whole in batches:
            for at in range(0, whole.num_rows, 1_000):
                b = whole.slice(at, 1_000)
                found = [(k, *g) for k, w in enumerate(b.column(0).to_pylist()) for g in listed(w, known)]
                rows = pa.array([k for k, _, _ in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g for _, g, _ in found], pa.string()), pa.array([p for _, _, p in found], pa.int32()),
                     *(b.column(c).take(rows) for c in (2, 0, 1))], ["gram", "place", "length", "word", "n"])

    return (words.select("word", "n", "length")
            .mapInArrow(tidy(run), "gram string, place int, length int, word string, n long"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b, na, nb): all pairs one edit apart, ``a`` the shorter or, at equal length, the smaller."""
    key = ["gram", "place", "length"]
    lists = written(gram_lists(words), "variant-lists")
    size = lists.groupBy(*key).agg(F.count("*").alias("k")).where(F.col("k") > BLOCK)
    long_ = broadcast_checked(written(size.select(*key, F.ceil(F.col("k") / BLOCK).cast("int").alias("blocks")),
                                      "variant-long"), MAX_BROADCAST)

    def blocks(frame):
        return frame.join(long_, key, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))

    # a word of the same length has the gram at the same place, a longer one there or one further on
    mine = lists.select("gram", F.col("word").alias("a"), F.col("n").alias("na"), F.explode(F.array(
        F.struct("place", "length", F.lit(True).alias("same")),
        F.struct("place", (F.col("length") + 1).alias("length"), F.lit(False).alias("same")),
        F.struct((F.col("place") + 1).alias("place"), (F.col("length") + 1).alias("length"),
                 F.lit(False).alias("same")))).alias("at")).select("gram", "at.*", "a", "na")
    mine = blocks(mine).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    other = (blocks(lists).withColumn("block", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int"))
             .select(*key, "block", F.col("word").alias("b"), F.col("n").alias("nb")))
    met = mine.alias("m").join(other.alias("o"), [
        *(F.col(f"m.{c}") == F.col(f"o.{c}") for c in (*key, "block")),
        ~F.col("same") | (F.col("a") < F.col("b")), F.levenshtein("a", "b", 1) == 1])
    return met.select("a", "b", "na", "nb").dropDuplicates(["a", "b"])


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of each chain; a form is at least ``RATIO`` times as frequent, so chains
    are short and each round doubles the way a pointer spans."""
    cur, r = written(forms.select("word", F.col("form").alias("root")), "variant-root0"), 0
    while True:
        r += 1
        step = cur.select(F.col("word").alias("root"), F.col("root").alias("further"))
        nxt = written(cur.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                            F.col("further").isNotNull().alias("moved")),
                      f"variant-root{r}")
        cur = nxt.select("word", "root")
        if nxt.where("moved").isEmpty():
            return cur


def report(documents: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    words = written(word_counts(documents), "variant-words")
    pairs = written(near_pairs(words), "variant-pairs")
    near = pairs.select(F.col("a").alias("word"), F.col("na").alias("n"), F.col("b").alias("other"),
                        F.col("nb").alias("m")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("nb").alias("n"), F.col("a").alias("other"),
                     F.col("na").alias("m")))
    best = near.groupBy("word").agg(
        F.first("n").alias("own"), F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("m")).alias("neg"), "other")).alias("top"))      # the most frequent, then the smallest
    fits = -F.col("top.neg") >= RATIO * F.col("own")
    best = written(best.select("word", "n_near", F.when(fits, F.col("top.other")).alias("form"),
                               F.when(fits, -F.col("top.neg")).alias("form_n")), "variant-best")
    roots = _roots(best.where("form is not null"))
    return (words.select("word", "n").join(best, "word", "left").join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n"))
