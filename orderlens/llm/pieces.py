"""SentencePiece encoding and decoding by streaming Viterbi.

Pieces and scores come from a public SentencePiece model file.  The encoder
reads a text once.  It holds one back-pointer per open boundary, looks back at
most the longest piece, and commits ids as soon as all surviving back-pointer
paths meet in one boundary.  A boundary that no piece can cross (before a space
mark, around a character without a longer piece) is such a meeting point for
every text; stretches between two of them are independent, so their ids are
memoised per task.

Text convention: one space is put in front, spaces become U+2581; a character
without a piece is written as its UTF-8 byte pieces, and so is a literal
U+2581, which makes decoding the exact inverse.

Defined results: null text encodes to null, empty text to no ids; rows pass one
by one, whatever their ids or other columns; any length is encoded whole.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import map_text

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
DECODE_ROWS = 64   # rows whose ids one step of a decoding task holds as Python numbers
MEMO = 50_000      # memoised stretches per generation and task
MEMO_LEN = 48      # longest stretch that is kept in the memo


_NONE = float("-inf")   # score of a boundary that no path has reached


class _Memo(dict):
    """Ids (little-endian 32-bit, as bytes) by stretch, in two generations of ``MEMO``: a full one becomes
    the old one, and what is still in use moves on from there."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, word):
        got = self.old.get(word)
        if got is None:
            got = np.asarray(self.make(word), dtype="<i4").tobytes()
            if len(word) > MEMO_LEN:
                return got
        if len(self) >= MEMO:
            self.old = dict(self)
            self.clear()
        self[word] = got
        return got


class Codec:
    """Viterbi encoder and decoder over the pieces of one model file."""

    def __init__(self, model_file: str = MODEL):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=os.path.realpath(model_file))
        self.ids, self.byte_id, self.piece, self.scores = {}, [0] * 256, [], []
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            self.piece.append(p)
            self.scores.append(sp.get_score(i))
            if sp.is_byte(i):
                self.byte_id[int(p[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[p] = i
        self.bytes_of = {i: b for b, i in enumerate(self.byte_id)}
        self.longest = max(map(len, self.ids))
        self.best = {p: (self.scores[i], i) for p, i in self.ids.items()}
        self.unknown = min(self.scores) - 10.0          # a character written as bytes
        #: character pairs that some piece holds side by side; no other boundary can be crossed
        self.pairs = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        #: pieces as a character trie; key 0 holds (score, id)
        self.trie: dict = {}
        for p, hit in self.best.items():
            node = self.trie
            for ch in p:
                node = node.setdefault(ch, {})
            node[0] = hit
        self.raw = [bytes([self.bytes_of[i]]) if i in self.bytes_of else
                    p.replace(SPACE, " ").encode() for i, p in enumerate(self.piece)]
        # words: stretches between boundaries that no piece of this model crosses
        signs = {c for p in self.pairs for c in p if not (c.isalpha() or c.isdecimal())} - {SPACE, "\n"}
        while odd := {b for a, b in self.pairs if b in signs and a not in signs and a != SPACE}:
            signs -= odd                      # what is left never follows a letter inside a piece
        crossed = any(b in (SPACE, "\n") and a != b or a == "\n" for a, b in self.pairs)
        sign = "".join(map(re.escape, sorted(signs)))
        rest = f"[^{SPACE}\n{sign}]"
        self.word = re.compile(".+" if crossed or not signs else
                               f"{SPACE}+(?:[{sign}]+{rest}*|{rest}*)|[{sign}]+{rest}*|{rest}+|\n+", re.S)
        self.memo = _Memo(self.stream)

    # -- one stretch -----------------------------------------------------
    def _bytes(self, ch: str) -> list[int]:
        return [self.byte_id[b] for b in ch.encode()]

    def stream(self, s: str) -> list[int]:
        """Best ids of a stretch of any length, in one pass; ties go to the longer last piece.

        The window holds the boundaries that a piece can still reach or start
        from.  Every ``longest`` characters the paths of all live boundaries are
        followed back to the one in which they meet, and the ids up to there
        are committed.
        """
        n, trie, unknown, longest = len(s), self.trie, self.unknown, self.longest
        room = min(n, 3 * longest)
        # scores and back-pointers of the boundaries from ``done`` on
        total, back = [0.0] + [_NONE] * room, [None] * (room + 1)
        out, done, due = [], 0, 2 * longest
        for i in range(n):
            if i >= due:
                due = i + longest
                meet = self._meet(back, total, done, i)
                if meet > done:
                    self._commit(s, back, done, meet, out)
                    base, gone, done = total[meet - done], meet - done, meet
                    total, back = [t - base for t in total[gone:]], back[gone:]
                more = i + 2 * longest + 1 - done - len(total)
                if more > 0:
                    total += [_NONE] * more
                    back += [None] * more
            t, node, j = total[i - done], trie.get(s[i]), i + 1
            k = j - done
            if node is None or 0 not in node:
                if t + unknown > total[k]:
                    total[k], back[k] = t + unknown, (i, -1)
            while node:
                hit = node.get(0)
                if hit is not None and t + hit[0] > total[k]:
                    total[k], back[k] = t + hit[0], (i, hit[1])
                if j == n:
                    break
                node = node.get(s[j])
                j += 1
                k += 1
        self._commit(s, back, done, n, out)
        return out

    @staticmethod
    def _meet(back: list, total: list, done: int, i: int) -> int:
        """The boundary through which the paths of all live boundaries (``i`` and later) run."""
        live = {k for k in range(i, done + len(total)) if total[k - done] > _NONE}
        while len(live) > 1:
            last = max(live)
            live.discard(last)
            live.add(back[last - done][0])
        return min(live)

    def _commit(self, s: str, back: list, done: int, end: int, out: list[int]) -> None:
        """Append the ids of ``s[done:end]`` along the back-pointers."""
        parts, j = [], end
        while j > done:
            i, k = back[j - done]
            parts.append([k] if k >= 0 else self._bytes(s[i:j]))
            j = i
        for part in reversed(parts):
            out += part

    # -- whole texts -----------------------------------------------------
    def buffer(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian 32-bit integers."""
        if not text:
            return b""
        out: list[bytes] = []
        # a literal space mark is spelled in bytes, between two independent parts
        for n, part in enumerate(text.split(SPACE)):
            if n:
                out.append(np.asarray([self.byte_id[b] for b in SPACE.encode()], dtype="<i4").tobytes())
            part = part.replace(" ", SPACE)
            out += map(self.memo.__getitem__, self.word.findall(part if n else SPACE + part))
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.buffer(text), dtype="<i4").tolist()

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def _id_column(buffers: list[bytes | None]) -> pa.Array:
    """One int32 list column over a single values buffer."""
    sizes = np.fromiter((0 if b is None else len(b) // 4 for b in buffers), dtype=np.int32, count=len(buffers))
    ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    offsets = pa.array(ends, mask=np.append([b is None for b in buffers], False))
    values = pa.array(np.frombuffer(b"".join(b for b in buffers if b), dtype="<i4"))
    return pa.ListArray.from_arrays(offsets, values)


def encode(documents: DataFrame, model_file: str = MODEL, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id) and ``ids``: the token ids of every whole text."""
    def start():
        codec = Codec(model_file)
        return lambda texts: [_id_column([None if t is None else codec.buffer(t) for t in texts])]
    return map_text(documents, keep or ["doc_id"], "text", start, [("ids", "array<int>")])


def decode(encoded: DataFrame, model_file: str = MODEL, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default doc_id) and ``text``: the texts of an ``ids`` column (null stays null,
    null ids inside a row are skipped)."""
    names = keep or ["doc_id"]
    frame = encoded.select(*names, F.col("ids").cast("array<int>").alias("_ids"))
    schema = T.StructType([encoded.schema[c] for c in names] + [T.StructField("text", T.StringType())])
    columns = [f.name for f in schema.fields]

    def run(batches):
        codec = Codec(model_file)
        for whole in batches:
            for at in range(0, whole.num_rows, DECODE_ROWS):
                b = whole.slice(at, DECODE_ROWS)
                texts = [None if row is None else codec.decode([x for x in row if x is not None])
                         for row in b.column(len(names)).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(k) for k in range(len(names))] + [pa.array(texts, pa.string())], columns)

    return frame.mapInArrow(run, schema)


def digest(documents: DataFrame, model_file: str = MODEL) -> DataFrame:
    """(doc_id, n_ids, ids_sha256 of the little-endian 32-bit ids, exact): ``exact`` says that
    decoding gives the text back.  Null text: no ids, exact is null."""
    def start():
        codec = Codec(model_file)

        def f(texts):
            cols = [[], [], []]
            for t in texts:
                ids = codec.buffer(t)
                cols[0].append(len(ids) // 4)
                cols[1].append(hashlib.sha256(ids).hexdigest())
                cols[2].append(None if t is None else codec.decode(np.frombuffer(ids, dtype="<i4").tolist()) == t)
            return cols
        return f
    return map_text(documents, ["doc_id"], "text", start, [
        ("n_ids", "long"), ("ids_sha256", "string"), ("exact", "boolean")])
