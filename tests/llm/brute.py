"""Plain single-process versions of the operators' contracts, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(text) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def secrets_base(text):
    """(n_assign, n_access, n_hex, base_sha256) straight from the three patterns."""
    text = text or ""
    key = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k)
                   for k in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY]"
    found = [(m.start(), 0, "assign", m.end()) for m in
             re.finditer(rf"""({key})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    found.sort()
    kinds = [k for _, _, k, _ in found]
    return (kinds.count("assign"), kinds.count("access"), kinds.count("hex"),
            sha(",".join(f"{k}:{s}:{e}" for s, _, k, e in found)))


def decontam(docs, items, size=10):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}."""
    wins: dict[tuple, set] = {}
    for item, text in items:
        w = WORD.findall((text or "").translate(UPPER))
        for i in range(max(1, len(w) - size + 1) if w else 0):
            wins.setdefault(tuple(w[i:i + size]), set()).add(item)
    sizes = {len(w) for w in wins}
    out = {}
    for doc, text in docs:
        w = WORD.findall((text or "").translate(UPPER))
        hit, got = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (own := wins.get(tuple(w[i:i + n]))) is not None:
                    hit.update(range(i, i + n))
                    got |= own
        ids = ",".join(sorted(str(x) for x in got if x is not None))
        out[doc] = (len(w), len(hit), len(got), sha(ids), bool(hit))
    return out


def _components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def near_dups(docs, size=5, link=85):
    """{doc_id: (n_shingles, component_id, kept)} by comparing all pairs that share a shingle."""
    sets, inverted = {}, {}
    for doc, text in docs:
        w = (text or "").encode().lower().split()
        s = {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
        sets[doc] = s
        for g in s:
            inverted.setdefault(g, []).append(doc)
    counts: dict[tuple, int] = {}
    for own in inverted.values():
        for i, a in enumerate(own):
            for b in own[i + 1:]:
                counts[a, b] = counts.get((a, b), 0) + 1
    links = [(a, b) for (a, b), k in counts.items() if 100 * k >= link * (len(sets[a]) + len(sets[b]) - k)]
    comp = _components(sets, links)
    return {d: (len(s), comp[d], comp[d] == d) for d, s in sets.items()}


def cosine_links(vectors, least=0.9):
    """{vec_id: (n_links, component_id, kept)}."""
    ok = {i: np.asarray(v, dtype=np.float64) for i, v in vectors
          if v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    ids = list(ok)
    links = []
    if ids:
        x = np.stack([ok[i] / np.linalg.norm(ok[i]) for i in ids])
        a, b = np.nonzero(np.triu(x @ x.T >= least, 1))
        links = [(ids[i], ids[j]) for i, j in zip(a, b)]
    n = {i: 0 for i, _ in vectors}
    for a, b in links:
        n[a] += 1
        n[b] += 1
    comp = _components(n, links)
    return {i: (n[i], comp[i], comp[i] == i) for i in n}


def suffix(docs, length=100):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)} from every window, in order."""
    seen, out = set(), {}
    for doc, text in sorted(docs):
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            if w in seen:
                gone[i:i + length] = True
            seen.add(w)
        runs = int((np.diff(np.concatenate(([0], gone.astype(np.int8)))) == 1).sum())
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc] = (len(raw), int(gone.sum()), runs, sha(kept))
    return out


def viterbi(codec, text):
    """Full-table Viterbi over the whole text (literal space marks and unknowns as bytes)."""
    if not text:
        return []
    marks = [(" " + text)]
    s = "".join("\x00" if c == "▁" else "▁" if c == " " else c for c in marks[0])
    n = len(s)
    best, back = [0.0] + [-math.inf] * n, [None] * (n + 1)
    for j in range(1, n + 1):
        for i in range(max(0, j - codec.longest), j):
            piece = s[i:j]
            hit = None if "\x00" in piece else codec.best.get(piece)
            if hit is None and j - i == 1:
                hit = (codec.unknown, -1)
            if hit is not None and best[i] + hit[0] > best[j]:
                best[j], back[j] = best[i] + hit[0], (i, hit[1])
    out, j = [], n
    while j:
        i, k = back[j]
        out.append([k] if k >= 0 else [codec.byte_id[b] for b in s[i:j].replace("\x00", "▁").encode()])
        j = i
    return [x for part in reversed(out) for x in part]


def variants(docs):
    """{word: (form, root, n, n_near, form_n)} by deletion neighbourhoods."""
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    hole = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            hole[i, w[:i] + w[i + 1:]].add(w)
    near = defaultdict(set)
    for w in words:
        for i in range(len(w)):
            short = w[:i] + w[i + 1:]
            near[w] |= hole[i, short] - {w}
            if short in words:
                near[w].add(short)
                near[short].add(w)
    form = {}
    for w, n in words.items():
        top = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = top if top is not None and words[top] >= 10 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def token_files(docs, tokenizer):
    """{doc_id: (start, n_tokens, crc32)} with whole texts encoded one by one."""
    out, at = {}, 0
    for doc_id, text in sorted(docs):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        out[doc_id] = (at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        at += len(ids)
    return out


def filter_audit(docs, labels):
    """{(part, order, step): (kept, removed, redundant, unique, good, toxic, shapley)} one order at a time."""
    first, marks, fails = {}, defaultdict(lambda: [0, 0]), []
    for i, q, t in labels:
        marks[i] = [max(marks[i][0], int(q == 1)), max(marks[i][1], int(t == 1))]
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    for i, text, lang in docs:
        t = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {c for c, b in zip("ABCDE", (
            len(w) < 100, 100 * len(set(w)) < 80 * len(w), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            re.search("[#$%&*|]", t), i is not None and first[t] < i)) if b}
        fails.append((lang or "", bad, marks[i] if i is not None else [0, 0]))
    out, shapley = {}, Counter()
    for part in {p for p, _, _ in fails}:
        mine = [(b, m) for p, b, m in fails if p == part]
        for order in permutations("ABCDE"):
            left, gone = mine, []
            for step, f in enumerate(order, 1):
                now = [x for x in left if f in x[0]]
                redundant = sum(f in b for b, _ in gone)
                left, gone = [x for x in left if f not in x[0]], gone + now
                shapley[part, f] += len(now)
                out[part, "".join(order), step] = (
                    len(left), len(now), redundant, sum(b == {f} for b, _ in mine),
                    sum(m[0] for _, m in now), sum(m[1] for _, m in now))
    return {k: v + (shapley[k[0], k[1][k[2] - 1]],) for k, v in out.items()}
