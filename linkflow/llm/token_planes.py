"""Token-ID output in bit planes: blocks of ids are transposed, each plane is compressed alone.

A shard file holds, in this order:

    magic "LFPLANES"
    planes of all chunks: per chunk of ``CHUNK`` ids, one zstandard frame per plane
    index (one zstandard frame of JSON): partition, sequence, plane kind, doc ids, ids per
        document, and per chunk its offset, number of ids and the length of each plane
    footer: index offset u64, index length u64, magic (little endian), one newline

Byte planes hold byte k of each id; bit planes hold bit k of each id, packed. Planes that are all
zero are stored with length 0. Files are written by Spark's own file writer (so any Hadoop file
system and its commit protocol serve) and read by the ``binaryFile`` source.

Documents are dealt by range of doc_id and sorted, so that shards in order hold ascending ids.
Defined results: null text counts as empty (one end id); null doc_ids come first; rows with equal
doc_id are ordered by text; an empty table gives no file rows; extra columns are not carried.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from itertools import chain
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linkflow.llm.common import batch, save, scratch, trimmed

MAGIC = b"LFPLANES"
CHUNK = 1 << 16
#: Ids after which a shard is closed; bounds the memory of a task and the size of a file.
SHARD_IDS = 2_000_000
END_ID = 2
CACHE_WORDS = 600_000
#: Marks of words that a worker has seen before: only those are remembered. A power of two.
SEEN = 1 << 24
#: Between an ASCII letter or digit and punctuation behind it, the tokenizer always splits.
PLAIN = frozenset(bytes([c]) for c in b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
TAIL = b".,!?;:*#$%&"

_BLOB = pa.schema([("blob", pa.binary())])
_DOCS = pa.schema(
    [("pid", pa.int32()), ("seq", pa.int32()), ("pos", pa.int64()), ("doc_id", pa.int64()), ("local", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)
_DOCS_DDL = "pid int, seq int, pos long, doc_id long, local long, n_tokens long, ids_crc32 long"


class Encoder:
    """Encodes texts with a tokenizer file whose normaliser and splitter never join across white space.

    ASCII white space separates words that the tokenizer encodes independently of each other, it
    always splits an ASCII letter or digit from the ASCII punctuation behind it, and it lower-cases.
    So each distinct word, less such a tail, is encoded by the library once and remembered (up to ``limit``).
    A text that may hold a special token (which is matched before lower-casing) keeps its case.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        self.limit, self.seen, self.once = limit, bytearray(SEEN), []
        # On lower-case ASCII letters the file's normaliser and splitter change nothing.
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = WhitespaceSplit()

    def _encode(self, pieces: list[bytes], tokenizer, plain: bool) -> None:
        """Many pieces in one call. Plain ones are a pre-token each; others are told apart by their offsets."""
        for i in range(0, len(pieces), 512):
            part = pieces[i : i + 512]
            text = b" ".join(part).decode("utf-8", "replace")
            e = tokenizer.encode(text, add_special_tokens=False)
            if plain:
                first = np.flatnonzero(np.diff(np.array(e.word_ids, np.int64), prepend=-1))
            else:
                starts = np.cumsum([0, *[len(x) + 1 for x in text.split(" ")[:-1]]])
                first = np.searchsorted([a for a, _ in e.offsets], starts)
            raw, first = np.array(e.ids, "<u4").tobytes(), (4 * first).tolist()
            self.known.update(zip(part, [raw[a:b] for a, b in zip(first, [*first[1:], len(raw)], strict=True)], strict=True))

    def _learn(self, words: set[bytes]) -> None:
        if len(self.known) > self.limit:
            self.known.clear()
        new = words.difference(self.known)
        if not new:
            return
        joined = []
        pieces = set()
        for w in new:
            stem = w.rstrip(TAIL)
            if stem == w or stem[-1:] not in PLAIN or not stem:
                pieces.add(w)
            else:
                joined.append((w, stem, w[len(stem) :]))
                pieces.add(stem)
                pieces.add(joined[-1][2])
        pieces = pieces.difference(self.known)
        plain = [p for p in pieces if p.isalpha() and p.islower()]
        self._encode(plain, self.plain, True)
        pieces.difference_update(plain)
        self._encode(list(pieces), self.tokenizer, False)
        for w, stem, tail in joined:
            self.known[w] = self.known[stem] + self.known[tail]
        # What is new to the worker serves this batch only; what comes again is kept.
        pieces.update(plain, new)
        for p in pieces:
            i = hash(p) & (SEEN - 1)
            if self.seen[i]:
                continue
            self.seen[i] = 1
            self.once.append(p)

    @staticmethod
    def _words(text: str | bytes | None) -> list[bytes]:
        if not text:
            return []
        raw = text if isinstance(text, bytes) else text.encode("utf-8", "replace")
        return (raw if b"<|" in raw else raw.lower()).split()

    def encode(self, texts: list[str | bytes | None]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [self._words(t) for t in texts]
        self._learn(set(chain.from_iterable(split)))
        # itemgetter looks all words of a text up in one call; of one key it gives the bare value.
        out = [b"".join(itemgetter(*w)(self.known)) if len(w) > 1 else self.known[w[0]] if w else b"" for w in split]
        for p in self.once:
            del self.known[p]
        self.once.clear()
        return out


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, limit: int = CACHE_WORDS) -> Encoder:
    """The encoder of this Python worker: what it has learned serves all tasks of the worker."""
    if (path, limit) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, limit] = Encoder(path, limit)
    return _ENCODERS[path, limit]


def transpose(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of a block of ids; a plane that is all zero is empty."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        planes = [np.ascontiguousarray(raw[:, k]) for k in range(4)]
    else:
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        planes = [np.packbits(np.ascontiguousarray(bits[:, k])) for k in range(32)]
    return [p.tobytes() if p.any() else b"" for p in planes]


def restore(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    if kind == "byte":
        raw = np.zeros((n, 4), np.uint8)
        for k, p in enumerate(planes):
            if p:
                raw[:, k] = np.frombuffer(p, np.uint8)
    else:
        bits = np.zeros((n, 32), np.uint8)
        for k, p in enumerate(planes):
            if p:
                bits[:, k] = np.unpackbits(np.frombuffer(p, np.uint8))[:n]
        raw = np.packbits(bits, axis=1, bitorder="little")
    return raw.reshape(-1).view("<u4")


def pack(ids: np.ndarray, doc_ids: list, lengths: list[int], pid: int, seq: int, kind: str = "byte", level: int = 1) -> bytes:
    """A whole shard file, without the newline that the writer appends."""
    import zstandard

    z, out, chunks, at = zstandard.ZstdCompressor(level=level), [MAGIC], [], len(MAGIC)
    for i in range(0, len(ids), CHUNK):
        block = ids[i : i + CHUNK]
        planes = [z.compress(p) if p else b"" for p in transpose(block, kind)]
        chunks.append([at, len(block), [len(p) for p in planes]])
        out += planes
        at += sum(map(len, planes))
    index = z.compress(json.dumps({"pid": pid, "seq": seq, "kind": kind, "doc_ids": doc_ids, "lengths": lengths, "chunks": chunks}).encode())
    return b"".join([*out, index, struct.pack("<QQ", at, len(index)), MAGIC])


def unpack(blob: bytes) -> tuple[dict, np.ndarray]:
    """The index and all ids of a shard file."""
    import zstandard

    blob = memoryview(blob)[: len(blob) - (blob[-1:] == b"\n")]
    if bytes(blob[:8]) != MAGIC or bytes(blob[-8:]) != MAGIC:
        raise ValueError("not a plane file, or cut off")
    z = zstandard.ZstdDecompressor()
    at, n = struct.unpack("<QQ", blob[-24:-8])
    index = json.loads(z.decompress(blob[at : at + n]))
    parts = [read_chunk(blob, c, index["kind"], z) for c in index["chunks"]]
    return index, np.concatenate(parts) if parts else np.zeros(0, "<u4")


def read_chunk(blob, chunk: list, kind: str, z) -> np.ndarray:
    """One chunk by its index entry: the random access that the index is for."""
    at, n, sizes = chunk
    planes = []
    for s in sizes:
        planes.append(z.decompress(blob[at : at + s]) if s else b"")
        at += s
    return restore(planes, n, kind)


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, kind: str = "byte", shard_ids: int = SHARD_IDS, cache_words: int = CACHE_WORDS) -> None:
    """Encodes ``docs(doc_id, text)`` and writes shard files below ``path``."""

    def run(batches):
        encode, pid = encoder(tokenizer, cache_words).encode, TaskContext.get().partitionId()
        end, seq, parts, doc_ids, lengths, held = np.array([end_id], "<u4").tobytes(), 0, [], [], [], 0
        for b in batches:
            for i in range(0, b.num_rows, 128):
                piece = b.slice(i, 128)
                for d, raw in zip(piece.column(0).to_pylist(), encode(piece.column(1).cast(pa.binary()).to_pylist()), strict=True):
                    parts += (raw, end)
                    doc_ids.append(d)
                    lengths.append(len(raw) // 4 + 1)
                    held += lengths[-1]
                    if held >= shard_ids:
                        yield batch(_BLOB, [pack(np.frombuffer(b"".join(parts), "<u4"), doc_ids, lengths, pid, seq, kind)])
                        seq, parts, doc_ids, lengths, held = seq + 1, [], [], [], 0
        if lengths:
            yield batch(_BLOB, [pack(np.frombuffer(b"".join(parts), "<u4"), doc_ids, lengths, pid, seq, kind)])

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    files = ordered.mapInArrow(trimmed(run), "blob binary").select(F.col("blob").cast("string").alias("value"))
    files.write.option("maxRecordsPerFile", 1).text(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the shard files: its shard, place, first id within the shard, ids and their crc32."""

    def run(batches):
        for b in batches:
            for blob in b.column(0):
                index, ids = unpack(blob.as_py())
                n, raw = np.array(index["lengths"], np.int64), memoryview(ids.astype("<u4", copy=False).tobytes())
                local = np.cumsum(n) - n
                crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(local.tolist(), n.tolist(), strict=True)]
                yield batch(_DOCS, [index["pid"]] * len(n), [index["seq"]] * len(n), list(range(len(n))), index["doc_ids"], local, n, crc)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(trimmed(run), _DOCS_DDL)


def digests(docs: DataFrame, tokenizer: str, end_id: int = END_ID, kind: str = "byte", cache_words: int = CACHE_WORDS) -> DataFrame:
    """Writes the files, reads them back, and places each document among all ids.

    ``cache_words`` trades the memory of a Python worker (about 300 bytes a word) for time.
    """
    spark = docs.sparkSession
    path = scratch(spark, "planes")
    write(docs, path, tokenizer, end_id, kind, cache_words=cache_words)
    rows = save(read(spark, path), "plane-docs")
    shards = rows.groupBy("pid", "seq").agg(F.sum("n_tokens").alias("ids"))
    # Running totals: over the files of a task, and over the tasks, of which there is one row each.
    so_far = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = shards.groupBy("pid").agg(F.sum("ids").alias("all")).select("pid", so_far("all", Window.orderBy("pid")).alias("start"))
    shards = shards.withColumn("inner", so_far("ids", Window.partitionBy("pid").orderBy("seq"))).join(tasks, "pid")
    shards = shards.select("pid", "seq", (F.col("start") + F.col("inner")).alias("base"))
    return rows.join(shards, ["pid", "seq"]).select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")
