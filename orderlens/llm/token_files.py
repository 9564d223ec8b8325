"""Token-id files: equal-length id sequences with masks in Arrow files, read at random without copies.

Documents are range-partitioned and sorted by doc_id; every partition is one
shard, so no id is shuffled.  A shard is an Arrow file of record batches with
two fixed-size-list columns, ``ids`` (unsigned 16-bit where the vocabulary
allows, else 32-bit) and ``mask`` (true: an id, false: padding of the shard's
last sequence), and a small Arrow file with the place of each document in the
shard.  Each record batch but the last has the same number of sequences, so
sequence ``k`` is found by division, and a memory-mapped read hands out views
of the file.  The manifest, one row per shard with the ids of all shards before
it, is written last and names the files of the task attempts that succeeded: a
lost executor leaves files that nothing refers to.

A document is encoded by the tokenizers library.  Where the tokenizer drops
white space (checked when it is loaded), no token reaches over an ASCII space,
so texts are cut there and the distinct words of a slice of texts are encoded
once; where its text rules are the known ones, plain words are cut into their
pieces here and the library's model encodes the pieces that the worker's
bounded memo does not hold.  Other tokenizers get whole texts.

Defined results: a null text is the empty text, which has the end id only; null
doc_ids come first; rows that share a doc_id are ordered by their text's hash,
and equal rows are written once each; other columns are ignored; an empty table
gives no shard and an empty result; a text of any length is encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import byte_slices, shared_path, tidy, written

TOKENIZER = "/opt/tokenizers/word_bpe_49k.json"
END_ID = 1             # appended to each document
LENGTH = 2048          # ids of a sequence
SEQUENCES = 256        # sequences of a record batch
SLICE = 8 << 20        # text bytes that one step of a task encodes
MEMO = 100_000         # memoised words and pieces per generation and worker
MEMO_BYTES = 64        # longest memoised word

MANIFEST = "shard int, path string, index_path string, n_docs long, n_ids long, n_sequences long"


# The text rules of the word tokenizer's file, and what they make of plain words.
NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
     "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: signs, digits and letters up to U+017F: none composes with another, and each has one lower-case letter
PLAIN = "^[!-~À-ÖØ-öø-įı-ſ]+$"
PIECE = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ſ]+|[0-9]|[^a-z0-9ß-öø-ſ\n]+|\n")


def byte_letters() -> dict[int, int]:
    """Byte -> code point of the byte-level alphabet: printable bytes stand for themselves, the others
    follow from U+0100 in their order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: b for b in plain} | {b: 256 + k for k, b in enumerate(others)}


class _Memo(dict):
    """Ids by key in two generations: when one is full it becomes the old one, and what is still in
    use moves on from there, so the memo stays bounded and frequent keys stay in it."""

    def __init__(self, make, size: int):
        super().__init__()
        self.make, self.size, self.old = make, size, {}

    def __missing__(self, key):
        got = self.old.get(key)
        if got is None:
            got = self.make(key)
            if len(key) > MEMO_BYTES:
                return got
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = got
        return got


class Encoder:
    """Ids of whole texts."""

    def __init__(self, tokenizer: str = TOKENIZER, end_id: int = END_ID):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"      # Spark runs one task per core
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(os.path.realpath(tokenizer))
        top = max(self.tok.get_vocab_size(with_added_tokens=True) - 1, end_id)
        self.dtype = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.end = end_id
        rules = json.loads(self.tok.to_str())
        # the library's model is asked directly where the rules for plain words are the known ones
        self.known = rules["normalizer"] == NORMALIZER and rules["pre_tokenizer"] == PRE_TOKENIZER
        self.special = "|".join(re.escape(t["content"]) for t in rules["added_tokens"])
        self.by_word = self.known or self._drops_space()
        self.letters = byte_letters()
        self.pieces, self.words = _Memo(self._piece, MEMO), _Memo(self._word, MEMO)

    def _ids(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _plain(self, text: str) -> list[int]:
        return self.tok.encode(text, add_special_tokens=False).ids

    def _drops_space(self) -> bool:
        """Whether a text's ids are those of its space-separated words, one after the other."""
        probes = ["a b", "The  quick\t\nfox's 12 34", " . , ' s 's", "é ́e x́ Σ ΣΑΣ ß", "<|x|> <b>   y"]
        return all(self._plain(p) == [i for w in re.split(r"[ \t-\r]+", p) for i in self._plain(w)] for p in probes)

    def _word(self, word: str) -> bytes:
        return self._ids(self._plain(word))

    def _piece(self, piece: str) -> bytes:
        if piece == "\n":                       # between two words
            return b""
        return self._ids([t.id for t in self.tok.model.tokenize(
            piece.encode().decode("latin-1").translate(self.letters))])

    def _joined(self, parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // self.dtype.itemsize
        return np.frombuffer(b"".join(parts), dtype=self.dtype), sizes

    def _distinct(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, sizes, place of each word among the sizes) of distinct words."""
        plain = np.zeros(len(words), dtype=bool)
        if self.known:
            plain = pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False)
            if self.special:
                plain &= ~pc.match_substring_regex(words, self.special).to_numpy(zero_copy_only=False)
        place, n = np.empty(len(words), dtype=np.int64), int(plain.sum())
        place[plain], place[~plain] = np.arange(n), np.arange(n, len(words))
        pieces = PIECE.findall("\n".join(words.filter(pa.array(plain)).to_pylist()).lower())
        ids, sizes = self._joined(list(map(self.pieces.__getitem__, pieces)))
        word = np.cumsum(np.fromiter(map("\n".__eq__, pieces), dtype=bool, count=len(pieces)))
        sizes = np.bincount(word, sizes, n).astype(np.int64) if n else sizes
        rest, more = self._joined(list(map(self.words.__getitem__, words.filter(pa.array(~plain)).to_pylist())))
        return np.concatenate([ids, rest]), np.concatenate([sizes, more]), place

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, ids per text), each text with its end id; null is empty."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            return self._joined([self._ids([*self._plain(t), self.end]) for t in texts.to_pylist()])
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        ids, sizes, place = self._distinct(coded.dictionary)
        # every text ends in one more word, whose only id is the end id
        ids, sizes = np.append(ids, np.array([self.end], dtype=self.dtype)), np.append(sizes, 1)
        n_words = split.value_lengths().to_numpy().astype(np.int64)
        at = np.insert(place[coded.indices.to_numpy()], np.cumsum(n_words), len(sizes) - 1)
        ends = np.concatenate(([0], np.cumsum(sizes)))
        found = pa.LargeListArray.from_arrays(pa.array(ends), pa.array(ids)).take(pa.array(at))
        starts = np.concatenate(([0], np.cumsum(n_words + 1)[:-1]))
        return found.flatten().to_numpy(), np.add.reduceat(sizes[at], starts)

    def encode(self, text: str) -> list[int]:
        """Ids of one text, without the end id."""
        return self.column(pa.array([text], pa.string()))[0][:-1].tolist()


@lru_cache(maxsize=2)
def encoder_of(tokenizer: str, end_id: int) -> Encoder:
    """The encoder of this worker process: its file is read once and its memo stays for later tasks."""
    return Encoder(tokenizer, end_id)


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder, given as a path or URI."""
    if re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:/", folder):
        return fs.FileSystem.from_uri(re.sub(r"^([^:]+):/(?!/)", r"\1:///", folder))
    return fs.LocalFileSystem(), folder


def _schema(dtype: np.dtype, length: int) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


class ShardWriter:
    """Packs documents into the record batches of one Arrow file, one batch in memory at a time."""

    def __init__(self, store: fs.FileSystem, path: str, dtype: np.dtype, length: int, sequences: int):
        self.dtype, self.length, self.sequences = dtype, length, sequences
        self.schema = _schema(dtype, length)
        self.out = store.open_output_stream(path)
        meta = {"length": str(length), "sequences_per_batch": str(sequences)}
        self.file = pa.ipc.new_file(self.out, self.schema.with_metadata(meta))
        self.parts, self.waiting, self.n_ids, self.n_sequences = [], 0, 0, 0

    def add(self, ids: np.ndarray) -> None:
        self.parts.append(ids.tobytes())
        self.waiting += ids.nbytes
        self.n_ids += len(ids)
        full = self.length * self.sequences * self.dtype.itemsize
        if self.waiting >= full:
            data = b"".join(self.parts)
            end = len(data) - len(data) % full
            for at in range(0, end, full):
                self._batch(np.frombuffer(data[at:at + full], dtype=self.dtype), self.length * self.sequences)
            self.parts, self.waiting = [data[end:]], len(data) - end

    def _batch(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(ids), self.length),
                   pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length)]
        self.file.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.n_sequences += len(ids) // self.length

    def close(self) -> None:
        rest = np.frombuffer(b"".join(self.parts), dtype=self.dtype)
        if len(rest):
            self._batch(np.pad(rest, (0, -len(rest) % self.length)), len(rest))
        self.file.close()
        self.out.close()


class TokenFile:
    """Random access to a shard; arrays are views of the memory-mapped file on a local or mounted store."""

    def __init__(self, folder: str, path: str):
        store, root = _store(folder)
        full = f"{root}/{path}"
        local = isinstance(store, fs.LocalFileSystem)
        self.source = pa.memory_map(full) if local else store.open_input_file(full)
        self.file = pa.ipc.open_file(self.source)
        meta = self.file.schema.metadata
        self.length, self.sequences = int(meta[b"length"]), int(meta[b"sequences_per_batch"])
        self._at, self._now = -1, None

    def _batch(self, k: int) -> pa.RecordBatch:
        if k != self._at:
            self._at, self._now = k, self.file.get_batch(k)
        return self._now

    def sequence(self, k: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence ``k``, without a copy."""
        batch, row = self._batch(k // self.sequences), k % self.sequences
        return (batch.column(0).slice(row, 1).flatten().to_numpy(zero_copy_only=True),
                batch.column(1).slice(row, 1).flatten())

    def ids(self, start: int, n: int):
        """Views that together hold the ids ``start`` to ``start + n``, one per record batch."""
        size = self.length * self.sequences
        while n > 0:
            values = self._batch(start // size).column(0).flatten()
            part = values.slice(start % size, n).to_numpy(zero_copy_only=True)
            yield part
            start, n = start + len(part), n - len(part)

    def close(self) -> None:
        self._now = self.file = None
        self.source.close()


def write_token_files(documents: DataFrame, folder: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                      length: int = LENGTH, sequences: int = SEQUENCES) -> DataFrame:
    """Write the shards of ``documents`` (doc_id, text) into ``folder``; the manifest with ``base``,
    the ids of all shards before, is written to ``folder/manifest`` and returned."""
    spark = documents.sparkSession
    store, root = _store(folder)
    store.create_dir(root, recursive=True)
    places = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_ids", pa.int64())])
    # the last key spreads equal rows of one doc_id over several shards
    keys = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"),
                            F.rand(7).alias("r"), "text")
    keys = keys.repartitionByRange("doc_id", "h", "r").sortWithinPartitions("doc_id", "h", "r")

    def run(batches):
        shard = None
        store, root = _store(folder)
        name, n_docs = uuid.uuid4().hex, 0
        for b in (part for whole in batches for part in byte_slices(whole, 1, SLICE)):
            if shard is None:
                encoder = encoder_of(tokenizer, end_id)
                shard = ShardWriter(store, f"{root}/{name}.arrow", encoder.dtype, length, sequences)
                index_out = store.open_output_stream(f"{root}/{name}.index.arrow")
                index = pa.ipc.new_file(index_out, places)
            ids, sizes = encoder.column(b.column(1))
            starts = shard.n_ids + np.concatenate(([0], np.cumsum(sizes)[:-1]))
            shard.add(ids)
            index.write_batch(pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(starts), pa.array(sizes)], schema=places))
            n_docs += b.num_rows
        if shard is not None:
            shard.close()
            index.close()
            index_out.close()
            # the row is committed with the task: files of failed attempts are in no manifest
            yield pa.RecordBatch.from_pylist([{
                "shard": TaskContext.get().partitionId(), "path": f"{name}.arrow", "index_path": f"{name}.index.arrow",
                "n_docs": n_docs, "n_ids": shard.n_ids, "n_sequences": shard.n_sequences}],
                schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("index_path", pa.string()),
                                  ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("n_sequences", pa.int64())]))

    shards = written(keys.select("doc_id", "text").mapInArrow(tidy(run), MANIFEST), "token-shards")
    rows, base = [], 0
    for r in sorted(shards.collect()):       # one short row per shard, not per document
        rows.append((*r, base))
        base += r.n_ids
    out = spark.createDataFrame(rows, f"{MANIFEST}, base long").coalesce(1)
    out.write.parquet(f"{folder}/manifest")
    return read_manifest(spark, folder)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{MANIFEST}, base long").parquet(f"{folder}/manifest")


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read back from the files of ``folder``."""
    shards = read_manifest(spark, folder).select("shard", "path", "index_path", "base")
    n = max(shards.count(), 1)

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                tokens, places = TokenFile(folder, r["path"]), _store(folder)
                with places[0].open_input_file(f"{places[1]}/{r['index_path']}") as source:
                    index = pa.ipc.open_file(source)
                    for k in range(index.num_record_batches):
                        docs = index.get_batch(k)
                        sums = []
                        for start, n_ids in zip(docs.column(1).to_pylist(), docs.column(2).to_pylist()):
                            crc = 0
                            for part in tokens.ids(start, n_ids):
                                crc = zlib.crc32(part.astype("<u4"), crc)
                            sums.append(crc)
                        starts = docs.column(1).to_numpy() + r["base"]
                        yield pa.RecordBatch.from_arrays(
                            [docs.column(0), pa.array(starts), docs.column(2), pa.array(sums, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"])
                tokens.close()

    return (shards.repartitionByRange(n, "shard")
            .mapInArrow(tidy(run), "doc_id long, start long, n_tokens long, ids_crc32 long"))


def report(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """Write ``documents`` into the shared folder and return what its files hold."""
    spark = documents.sparkSession
    folder = shared_path(spark, f"llm-token-files-{uuid.uuid4().hex}")
    write_token_files(documents, folder, tokenizer)
    return read_documents(spark, folder)
