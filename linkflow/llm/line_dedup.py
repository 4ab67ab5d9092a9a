"""Line deduplication by passages of lines, compared byte by byte.

A document's passages are its windows and its chunks. From each line with words a window reaches to
the first line where it has ``PASSAGE_WORDS`` words, and to each such line one reaches back; so any
run of whole lines of that many words is made up of windows of its own, whatever stands around it.
Shorter repeats are found by chunks: the local maxima of a rolling hash over two line hashes cut the
lines into chunks of two lines or more (three on average, never at a fixed length), which count if they
hold at least two lines with words, with their first line and (as lines before may move it) without. A
single line counts as a window only, from ``PASSAGE_WORDS`` words on. A line goes if it is part of a passage that
occurred before: the first occurrence (smallest doc_id, then text hash, then place) stays. A passage
that overlaps its own first occurrence in the document is no occurrence, so a line repeated without
end keeps one window.

Only 128-bit hashes are shuffled to find the repeats; the texts of repeated passages alone are
compared, and a hash that stands for several texts is counted for each of them.

Defined results: null text stays null (no lines); empty text is one empty line; null doc_ids come
after all others in the order of occurrences; rows equal in doc_id and text are one occurrence and
are treated alike; extra columns are not carried.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkflow.llm.common import batch, mix64, release, save, trimmed

PASSAGE_WORDS = 50
#: Marks (28 bytes each) up to which they are broadcast to the texts.
BROADCAST_MARKS = 1_000_000

_OCCUR = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("pos", pa.int32()), ("n", pa.int32()), ("h", pa.binary())])
_TEXT = pa.schema([("h", pa.binary()), ("chunk", pa.binary()), ("doc_id", pa.int64()), ("th", pa.int64()), ("pos", pa.int32()), ("n", pa.int32())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_lines", pa.int64()), ("n_removed", pa.int64())])


def _cuts(lines: list[bytes]) -> list[tuple[int, int]]:
    """(first, end) of the content-defined chunks of a document's lines."""
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, lines), np.uint64, len(lines))
    prev = np.concatenate((np.zeros(1, np.uint64), h[:-1]))
    roll = mix64(h ^ (prev << np.uint64(1)))
    cut = np.zeros(len(lines), bool)
    cut[1:-1] = (roll[1:-1] > roll[:-2]) & (roll[1:-1] > roll[2:])
    cut[-1] = True
    ends = (np.flatnonzero(cut) + 1).tolist()
    return list(zip([0, *ends], ends, strict=False))


def passages(lines: list[bytes]) -> list[tuple[int, int, bytes]]:
    """(first line, end, bytes) of the windows and chunks that are removed if they repeat."""
    size = np.fromiter((len(x.split()) for x in lines), np.int64, len(lines))
    sums = np.concatenate(([0], np.cumsum(size)))
    some = np.flatnonzero(size)
    end = np.searchsorted(sums, sums[some] + PASSAGE_WORDS)
    start = np.searchsorted(sums, sums[some + 1] - PASSAGE_WORDS, "right") - 1
    ahead, back = end <= len(lines), sums[some + 1] >= PASSAGE_WORDS
    at = {*zip(some[ahead].tolist(), end[ahead].tolist(), strict=True), *zip(start[back].tolist(), (some[back] + 1).tolist(), strict=True)}
    told = np.concatenate(([0], np.cumsum(size > 0)))
    for first, b in _cuts(lines):
        for a in (first, first + 1):
            if told[b] - told[a] > 1:
                at.add((a, b))
    raw, edge = b"\n".join(lines), np.concatenate(([0], np.cumsum([len(x) + 1 for x in lines]))).tolist()
    out, first = [], {}
    for a, b in sorted(at):
        part = raw[edge[a] : edge[b] - 1]
        if not 0 < a - first.setdefault(part, a) < b - a:
            out.append((a, b, part))
    return out


def _lines(text: str) -> list[bytes]:
    return text.encode("utf-8", "replace").split(b"\n")


def _occurrences(batches):
    for b in batches:
        rows: tuple[list, ...] = ([], [], [], [], [])
        for d, t, th in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
            for a, e, raw in passages(_lines(t.as_py())):
                for r, v in zip(rows, (d, th, a, e - a, xxhash.xxh3_128_digest(raw)), strict=True):
                    r.append(v)
        yield batch(_OCCUR, *rows)


def _chunk_texts(batches):
    """The bytes of marked passages and their places."""
    for b in batches:
        for i in range(0, b.num_rows, 256):
            p = b.slice(i, 256)
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            for t, marks, d, th in zip(p.column(0), p.column(1).to_pylist(), p.column(2).to_pylist(), p.column(3).to_pylist(), strict=True):
                raw, edge = t.as_py().encode("utf-8", "replace"), [0]
                for line in raw.split(b"\n"):
                    edge.append(edge[-1] + len(line) + 1)
                for m in marks:
                    a, n = m["pos"], m["n"]
                    for r, v in zip(rows, (m["h"], raw[edge[a] : edge[a + n] - 1], d, th, a, n), strict=True):
                        r.append(v)
            yield batch(_TEXT, *rows)


def _rebuild(batches):
    for b in batches:
        for i in range(0, b.num_rows, 256):
            p = b.slice(i, 256)
            texts, n, gone = [], [], []
            for t, marks in zip(p.column(1), p.column(2).to_pylist(), strict=True):
                text = t.as_py()
                removed = 0
                if marks:
                    lines = _lines(text)
                    drop = np.zeros(len(lines) + 1, np.int64)
                    for m in marks:
                        drop[m["pos"]] += 1
                        drop[m["pos"] + m["n"]] -= 1
                    drop = np.cumsum(drop[:-1]) > 0
                    removed, kept = int(drop.sum()), [x for x, gone_ in zip(lines, drop.tolist(), strict=True) if not gone_]
                    text = b"\n".join(kept).decode("utf-8", "replace")
                texts.append(text)
                n.append(0 if t.as_py() is None else t.as_py().count("\n") + 1)
                gone.append(removed)
            yield batch(_RESULT, p.column(0), texts, n, gone)


def _per_doc(rows: DataFrame, *fields: str) -> DataFrame:
    """Marks of each document (doc_id and hash of its text) in one list, bounded by its lines.

    Rows that are equal in both give equal marks, which count once. A saved table of few marks is
    broadcast, so that texts stay where they are; beyond that both sides are sorted.
    """
    lists = rows.groupBy(F.col("doc_id").alias("mark_id"), F.col("th").alias("mark_th")).agg(F.collect_set(F.struct(*fields)).alias("marks"))
    return F.broadcast(lists) if rows.count() <= BROADCAST_MARKS else lists.hint("merge")


def dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, text, n_lines, n_removed`` of ``docs(doc_id, text)``: the text that is left, lines before, lines removed."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(F.col("text").cast("string")).alias("th"))
    own = F.col("doc_id").eqNullSafe(F.col("mark_id")) & (F.col("th") == F.col("mark_th"))
    seen = save(docs.where("text is not null").mapInArrow(trimmed(_occurrences), "doc_id long, th long, pos int, n int, h binary"), "line-chunks")
    at = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "pos")
    repeated = seen.groupBy("h").agg(F.min(at).alias("first"), F.max(at).alias("last")).where("first != last").select("h", "first")
    marks = save(seen.join(repeated, "h").select("doc_id", "th", "pos", "n", "h", (at == F.col("first")).alias("is_first")), "line-marks")
    release(seen)
    ddl = "h binary, chunk binary, doc_id long, th long, pos int, n int"
    texts = docs.where("text is not null").join(_per_doc(marks, "pos", "n", "h"), own).select("text", "marks", "doc_id", "th").mapInArrow(trimmed(_chunk_texts), ddl)
    # The comparison of bytes: one distinct text behind the hash, or (never seen) the first place of each text.
    kinds = save(texts.groupBy("h", "chunk").agg(F.lit(1).alias("one")).groupBy("h").agg(F.count("*").alias("k")), "line-kinds")
    gone = marks.where("not is_first").join(kinds.where("k = 1"), "h", "left_semi").select("doc_id", "th", "pos", "n")
    several = kinds.where("k > 1").select("h")
    if not several.isEmpty():
        mixed = save(texts.join(F.broadcast(several) if several.count() <= BROADCAST_MARKS else several, "h", "left_semi"), "line-mixed")
        first = mixed.groupBy("h", "chunk").agg(F.min(at).alias("first"))
        gone = gone.union(mixed.join(first, ["h", "chunk"]).where(at != F.col("first")).select("doc_id", "th", "pos", "n"))
    gone = save(gone, "line-gone")
    for used in (marks, kinds):
        release(used)
    both = docs.join(_per_doc(gone, "pos", "n"), own, "left").select("doc_id", "text", "marks")
    return both.mapInArrow(trimmed(_rebuild), "doc_id long, text string, n_lines long, n_removed long")
