"""Secret scan: grammar inference over labelled credentials, then format likelihood.

Three fixed patterns find the labelled credentials (kinds assign, access, hex).
For each kind a prefix tree of their values is generalised by state merging:
two states merge when a Hoeffding bound cannot tell their end and symbol
frequencies apart, all the way down.  The result is a probabilistic automaton;
every other candidate token is scored by its log-likelihood per symbol and
becomes a ``format`` span when it is as likely as labelled values are.

All distinct labelled values take part.  Spark counts the prefixes of all of
them; the driver merges the states of those prefixes that at least
``SUPPORT`` values (and one in ``SHARE``) have in common, so its tree is
bounded.  A prefix of one value is alike to every state, so it merges with the
start; rarer prefixes than one in ``SHARE`` are merged there too.  Spark then
sends all values through the states: symbol and end counts, and the threshold,
are those of every labelled value.

Defined results: null and empty text have no spans; repeated rows are scanned
one by one (one row out per row in); a null doc_id is kept; other columns of
the input are ignored; without any labelled credential there is no automaton
and only the (empty) base spans.  Whole texts are scanned, any length.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import map_text, tidy, written

# The three base patterns and their least lengths.
ASSIGN = re.compile(
    r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"""
    r"""|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex")
MIN_ASSIGN, MIN_ACCESS = 12, 18

DIGIT = re.compile(r"[0-9]")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]+")
MIN_CANDIDATE = 16
#: words of the assign pattern, as a quick test before the pattern runs
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

SUPPORT = 2            # values that share a prefix which can become a state: a single one always merges
SHARE = 5_000          # and at least one value in so many
ALPHA = 0.05           # confidence of the Hoeffding merge test
_PRIME, _BASE, _START = (1 << 61) - 1, 1_318_699_440_233_716_411, 1   # hash of a prefix; of the empty one
FLOOR = math.log(1e-4)  # log-probability of a symbol the automaton never saw
MARGIN = 0.5           # nats per symbol below the lowest labelled percentile


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the base patterns, by start, then kind as listed."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [(m.start(), m.end(), "assign", m.group(2)) for m in ASSIGN.finditer(text)
                  if len(m.group(2)) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access", m.group(0)) for m in ACCESS.finditer(text)
                  if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), m.end(), "hex", m.group(0)) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def candidates(text: str, base: list) -> list[tuple[int, int, str]]:
    """Long tokens with a digit that no base span touches (text order, two pointers)."""
    if not DIGIT.search(text):
        return []
    out, taken, i = [], sorted((s, e) for s, e, _, _ in base), 0
    top = 0  # furthest end among base spans that start before the token ends
    for m in CANDIDATE.finditer(text):
        s, e = m.span()
        if e - s < MIN_CANDIDATE or not DIGIT.search(m.group(0)):
            continue
        while i < len(taken) and taken[i][0] < e:
            top, i = max(top, taken[i][1]), i + 1
        if top <= s:
            out.append((s, e, m.group(0)))
    return out


# ---------------------------------------------------------------- automaton

class _State:
    __slots__ = ("n", "end", "to", "hits")

    def __init__(self):
        self.n, self.end, self.to, self.hits = 0, 0, {}, {}


def _prefix_tree(values: list[str]) -> _State:
    root = _State()
    for v in values:
        s = root
        s.n += 1
        for ch in v:
            s.hits[ch] = s.hits.get(ch, 0) + 1
            s = s.to.setdefault(ch, _State())
            s.n += 1
        s.end += 1
    return root


def _differ(f1: int, n1: int, f2: int, n2: int, bound: float) -> bool:
    return abs(f1 / n1 - f2 / n2) > bound * (n1 ** -0.5 + n2 ** -0.5)


def _alike(a: _State, b: _State, bound: float) -> bool:
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        if _differ(x.end, x.n, y.end, y.n, bound):
            return False
        for ch in x.hits.keys() | y.hits.keys():
            if _differ(x.hits.get(ch, 0), x.n, y.hits.get(ch, 0), y.n, bound):
                return False
            if ch in x.to and ch in y.to:
                stack.append((x.to[ch], y.to[ch]))
    return True


def _fold(into: _State, tree: _State) -> None:
    """Add the counts of a subtree that nothing else points to."""
    stack = [(into, tree)]
    while stack:
        x, y = stack.pop()
        x.n += y.n
        x.end += y.end
        for ch, k in y.hits.items():
            x.hits[ch] = x.hits.get(ch, 0) + k
            if ch not in y.to:          # a rare branch that was not read out
                continue
            if ch in x.to:
                stack.append((x.to[ch], y.to[ch]))
            else:
                x.to[ch] = y.to[ch]


def infer_automaton(values: list[str], alpha: float = ALPHA) -> list[tuple[float, dict]]:
    """States as (log end probability, {symbol: (log probability, next state)}); state 0 starts."""
    fixed = merge_states(_prefix_tree(values), alpha)
    at = {id(s): i for i, s in enumerate(fixed)}
    return [(math.log(s.end / s.n) if s.end else FLOOR,
             {ch: (math.log(k / s.n), at[id(s.to[ch])]) for ch, k in s.hits.items()}) for s in fixed]


def merge_states(root: _State, alpha: float = ALPHA) -> list[_State]:
    """The states that are left of a prefix tree, start first, most frequent branches tried first."""
    bound = math.sqrt(0.5 * math.log(2 / alpha))
    fixed = [root]
    while True:
        known = {id(s) for s in fixed}
        fringe = [(s, ch, t) for s in fixed for ch, t in sorted(s.to.items()) if id(t) not in known]
        if not fringe:
            break
        s, ch, t = max(fringe, key=lambda x: x[2].n)
        twin = next((r for r in fixed if _alike(r, t, bound)), None)
        if twin is None:
            fixed.append(t)
        else:
            s.to[ch] = twin
            _fold(twin, t)
    return fixed


def likelihood(automaton: list, value: str) -> float:
    """Log-likelihood per symbol (the end counts as one)."""
    state, total = 0, 0.0
    for ch in value:
        p, state = automaton[state][1].get(ch, (FLOOR, state))
        total += p
    return (total + automaton[state][0]) / (len(value) + 1)


def fit(values: dict[str, list[str]]) -> dict[str, tuple[list, float]]:
    """kind -> (automaton, least likelihood): the lowest percentile of labelled values less a margin."""
    model = {}
    for kind, vs in sorted(values.items()):
        if vs:
            pfa = infer_automaton(vs)
            scores = sorted(likelihood(pfa, v) for v in vs)
            model[kind] = (pfa, scores[len(scores) // 100] - MARGIN)
    return model


# ---------------------------------------------------------------- Spark

def extract(documents: DataFrame) -> DataFrame:
    """One pass over all texts: base spans, labelled values and candidates per document."""
    def start():
        def f(texts):
            cols = [[] for _ in range(9)]
            for t in texts:
                base = base_spans(t) if t else []
                cand = candidates(t, base) if t else []
                kinds = [k for _, _, k, _ in base]
                row = ([s for s, _, _, _ in base], [e for _, e, _, _ in base], kinds,
                       [v for _, _, _, v in base], [s for s, _, _ in cand], [e for _, e, _ in cand],
                       [v for _, _, v in cand])
                for c, v in zip(cols, row):
                    c.append(v)
            return cols[:7]
        return f
    return map_text(documents, ["doc_id"], "text", start, [
        ("starts", "array<int>"), ("ends", "array<int>"), ("kinds", "array<string>"),
        ("labelled", "array<string>"), ("cand_starts", "array<int>"), ("cand_ends", "array<int>"),
        ("cand_values", "array<string>")])


def prefix_counts(labelled: DataFrame) -> DataFrame:
    """(kind, h, parent, ch, n, n_end): every prefix of the values by its hash modulo 2^61 - 1, the
    prefix one symbol shorter, its last symbol, how many values have it and how many are it."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            # values can be long: rows go out in pieces
            cols, size = ([], [], [], [], []), 0
            for kind, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                hs = [_START]
                for ch in v:
                    hs.append((hs[-1] * _BASE + ord(ch)) % _PRIME)
                n = len(hs)
                for c, x in zip(cols, ([kind] * n, hs, [0, *hs[:-1]], ["", *v], [0] * (n - 1) + [1])):
                    c.extend(x)
                size += n
                if size > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["kind", "h", "parent", "ch", "e"])
                    cols, size = ([], [], [], [], []), 0
            if size:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["kind", "h", "parent", "ch", "e"])
    rows = labelled.select("kind", "value").mapInArrow(tidy(run), "kind string, h long, parent long, ch string, e long")
    return rows.groupBy("kind", "h").agg(F.first("parent").alias("parent"), F.first("ch").alias("ch"),
                                         F.count(F.lit(1)).alias("n"), F.sum("e").alias("n_end"))


def shared_tree(counts: DataFrame, kind: str) -> _State | None:
    """The prefix tree of a kind down to the prefixes that enough values share; their states keep the
    counts of all branches."""
    mine = counts.where(F.col("kind") == kind)
    top = mine.where(F.col("h") == _START).select("n").first()
    if top is None:
        return None
    shared = mine.where(F.col("n") >= max(SUPPORT, top["n"] // SHARE))
    kept = {r["h"]: r for r in shared.collect()}
    states = {h: _State() for h in kept}
    for h, r in kept.items():
        states[h].n, states[h].end = r["n"], r["n_end"]
    # at most one branch per symbol of the patterns and state
    branches = mine.where(F.col("h") != _START).join(
        F.broadcast(shared.select(F.col("h").alias("parent"))), "parent", "left_semi")
    for r in branches.select("parent", "ch", "h", "n").collect():
        states[r["parent"]].hits[r["ch"]] = r["n"]
        if r["h"] in states:
            states[r["parent"]].to[r["ch"]] = states[r["h"]]
    return states.get(_START, _prefix_tree([]))


def path_counts(labelled: DataFrame, moves: dict[str, list[dict]]) -> DataFrame:
    """(kind, state, ch, n): how often the values of a kind leave a state by a symbol ('' is the end);
    a symbol without a move leads to the start."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            seen = Counter()
            for kind, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at, state = moves[kind], 0
                for ch in v:
                    seen[kind, state, ch] += 1
                    state = at[state].get(ch, 0)
                seen[kind, state, ""] += 1
            if seen:
                kind, state, ch = zip(*seen)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind), pa.array(state, pa.int32()), pa.array(ch), pa.array(list(seen.values()), pa.int64())],
                    ["kind", "state", "ch", "n"])
    rows = labelled.select("kind", "value").mapInArrow(tidy(run), "kind string, state int, ch string, n long")
    return rows.groupBy("kind", "state", "ch").agg(F.sum("n").alias("n"))


def train(extracted: DataFrame) -> dict:
    """kind -> (automaton, least likelihood), fitted on all distinct labelled values."""
    labelled = (extracted.where(F.size("kinds") > 0)
                .select(F.explode(F.arrays_zip("kinds", "labelled")).alias("z"))
                .select(F.col("z.kinds").alias("kind"), F.col("z.labelled").alias("value")).distinct())
    labelled = written(labelled, "secret-values")
    counts = written(prefix_counts(labelled), "secret-prefixes")
    moves = {}
    for kind in KINDS:
        root = shared_tree(counts, kind)
        if root is not None:
            fixed = merge_states(root)
            at = {id(s): i for i, s in enumerate(fixed)}
            moves[kind] = [{ch: at[id(t)] for ch, t in s.to.items()} for s in fixed]
    if not moves:
        return {}
    leave = {kind: [{} for _ in m] for kind, m in moves.items()}
    for r in path_counts(labelled, moves).collect():
        leave[r["kind"]][r["state"]][r["ch"]] = r["n"]
    pfa = {kind: [_log_state(out, to) for out, to in zip(leave[kind], m)] for kind, m in moves.items()}

    def run(batches):
        import pyarrow as pa
        for b in batches:
            scores = [likelihood(pfa[k], v) for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], ["kind", "score"])
    scores = written(labelled.select("kind", "value").mapInArrow(run, "kind string, score double"), "secret-scores")
    model = {}
    for kind in sorted(pfa):
        # the lowest percentile of labelled values less a margin, as in ``fit``
        mine = scores.where(F.col("kind") == kind)
        least = mine.orderBy("score").offset(mine.count() // 100).select("score").first()[0]
        model[kind] = (pfa[kind], least - MARGIN)
    return model


def _log_state(out: dict, to: dict) -> tuple[float, dict]:
    n = sum(out.values())
    return (math.log(out[""] / n) if out.get("") else FLOOR,
            {ch: (math.log(k / n), to.get(ch, 0)) for ch, k in out.items() if ch})


def scan(documents: DataFrame) -> DataFrame:
    """All spans of every document: (doc_id, starts, ends, kinds, n_assign, n_access, n_hex,
    base_sha256, spans).  ``starts``/``ends``/``kinds`` hold base and ``format`` spans by start."""
    table = written(extract(documents), "secret-extract")
    model = train(table)
    schema = ("doc_id long, starts array<int>, ends array<int>, kinds array<string>, n_assign long,"
              " n_access long, n_hex long, base_sha256 string, spans string")
    id_type = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa
        for b in batches:
            d = b.to_pydict()
            ids = b.column(b.schema.get_field_index("doc_id"))
            cols = [[] for _ in range(8)]
            for st, en, ki, cs, ce, cv in zip(d["starts"], d["ends"], d["kinds"], d["cand_starts"],
                                              d["cand_ends"], d["cand_values"]):
                base = list(zip(st, en, ki))
                extra = [(s, e, "format") for s, e, v in zip(cs, ce, cv)
                         if any(likelihood(pfa, v) >= least for pfa, least in model.values())]
                order = {k: i for i, k in enumerate((*KINDS, "format"))}
                every = sorted(base + extra, key=lambda x: (x[0], order[x[2]]))
                text = ",".join(f"{k}:{s}:{e}" for s, e, k in base)
                row = ([s for s, _, _ in every], [e for _, e, _ in every], [k for _, _, k in every],
                       ki.count("assign"), ki.count("access"), ki.count("hex"),
                       hashlib.sha256(text.encode()).hexdigest(),
                       ",".join(f"{k}:{s}:{e}" for s, e, k in every))
                for c, v in zip(cols, row):
                    c.append(v)
            types = [pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int64(),
                     pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [ids] + [pa.array(c, t) for c, t in zip(cols, types)],
                ["doc_id", "starts", "ends", "kinds", "n_assign", "n_access", "n_hex",
                 "base_sha256", "spans"])

    return table.mapInArrow(run, schema.replace("doc_id long", f"doc_id {id_type}"))


def redact(documents: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """Documents with every span replaced by ``mark``; ``n_chars`` follows where it exists.

    Trains on one pass, replaces in a second one; no document is dropped.
    """
    model = train(written(extract(documents), "secret-extract"))

    def start():
        def clean(t):
            if not t:
                return t
            base = base_spans(t)
            cuts = [(s, e) for s, e, _, _ in base]
            cuts += [(s, e) for s, e, v in candidates(t, base)
                     if any(likelihood(pfa, v) >= least for pfa, least in model.values())]
            if not cuts:
                return t
            out, at = [], 0
            for s, e in sorted(cuts):
                if s >= at:
                    out += [t[at:s], mark]
                at = max(at, e)
            return "".join([*out, t[at:]])
        return lambda texts: [[clean(t) for t in texts]]

    rest = [c for c in documents.columns if c != "text"]
    out = map_text(documents, rest, "text", start, [("text", "string")])
    if "n_chars" in rest:
        kind = documents.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out.select(*documents.columns)
