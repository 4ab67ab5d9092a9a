"""Benchmark decontamination: a broadcast hash set of the benchmark's word windows.

The documents' words are hashed, all windows of each needed length are hashed with array
arithmetic, looked up in the sorted hashes of the benchmark's windows, and each candidate is verified
by comparing words. No shuffle of documents takes place. A benchmark of more than ``PART_BYTES`` is
scanned part by part, each in a pass of its own over the documents, which carry the hits so far; an
item that is larger than a quarter of that is cut into pieces that share ``WINDOW`` - 1 words, so that
no window is lost.

Defined results: a null or empty text has no words, so it has no hits and is clean; rows are
judged one by one, so repeated rows give repeated results; an empty benchmark hits nothing; a
null item text has no words and no window; items with the same windows are all reported; items
with a null id hit like all others, all of them count as one item in ``n_items``, and its name in
``items_sha256`` is the empty string; extra columns of the input are not carried (``flag``) or kept
as they are (``keep_clean``).
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from linkflow.llm.common import batch, release, save, shingle_hashes, trimmed, word_hashes

WINDOW = 13
#: Share of hit words from which a document is contaminated: 1 in SHARE.
SHARE = 20
#: Bytes of benchmark text that are broadcast at once (a worker holds about five times as much).
PART_BYTES = 16 << 20

# Lower-cases A-Z; every other ASCII character than a digit or a letter separates words.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_RESULT = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, spans array<struct<first:int,last:int>>"
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_()), ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())])))]
)


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "replace").translate(_TABLE).split() if text else []


class Windows:
    """The windows of benchmark items by length: sorted hashes, and where each one stands in the items' words."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        self.names = ["" if i is None else str(i) for i, _ in items]
        self.raw: list[bytes] = []
        self.edge: list[np.ndarray] = []
        found: dict[int, list[tuple[np.ndarray, int, np.ndarray]]] = {}
        for k, (_, text) in enumerate(items):
            w = words(text)
            self.raw.append(b" ".join(w))
            self.edge.append(np.cumsum([0, *[len(x) + 1 for x in w]], dtype=np.int64))
            if w:
                n = min(window, len(w))
                h, first = np.unique(shingle_hashes(word_hashes(w), n), return_index=True)
                found.setdefault(n, []).append((h, k, first))
        self.tables = {}
        for n, parts in found.items():
            h = np.concatenate([x for x, _, _ in parts])
            by = np.argsort(h, kind="stable")
            owner = np.repeat([k for _, k, _ in parts], [len(x) for x, _, _ in parts])
            # A bitmap of 2**20 hash prefixes answers nearly all lookups before the binary search.
            maybe = np.zeros(1 << 20, bool)
            maybe[(h >> np.uint64(44)).astype(np.int64)] = True
            self.tables[n] = h[by], owner[by], np.concatenate([x for _, _, x in parts])[by], maybe

    def scan(self, w: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words are hit, and the names of the items that have an occurring window."""
        hit, found = np.zeros(len(w), bool), set()
        h = word_hashes(w) if w else np.zeros(0, np.uint64)
        for n, (known, owner, place, maybe) in self.tables.items():
            if len(w) < n:
                continue
            s = shingle_hashes(h, n)
            at = np.flatnonzero(maybe[(s >> np.uint64(44)).astype(np.int64)])
            low, high = np.searchsorted(known, s[at]), np.searchsorted(known, s[at], "right")
            for i, a, b in zip(at.tolist(), low.tolist(), high.tolist(), strict=True):
                if a == b:
                    continue
                own = b" ".join(w[i : i + n])
                for j in range(a, b):
                    k, p = owner[j], place[j]
                    if self.raw[k][self.edge[k][p] : self.edge[k][p + n] - 1] == own:
                        hit[i : i + n] = True
                        found.add(self.names[k])
        return hit, found


#: The windows that this worker has built last, by the part they come from.
_BUILT: dict[str, Windows] = {}


def _windows(name: str, items, window: int) -> Windows:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = Windows(items.value, window)
    return _BUILT[name]


def _spans(hit: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return [{"first": int(a), "last": int(b) - 1} for a, b in zip(edge[::2], edge[1::2], strict=True)]


_STATE = pa.struct([("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))), ("names", pa.list_(pa.string()))])
_STATE_DDL = "state struct<spans:array<struct<first:int,last:int>>,names:array<string>>"


def pieces(text: str | None, window: int, most: int) -> list[str]:
    """A text's words in pieces of about ``most`` bytes; each window of ``window`` words is whole in one of them."""
    w = words(text)
    out, first = [], 0
    while first + window <= len(w) or (not first and w):
        size, end = 0, first
        while end < len(w) and (size < most or end - first < window):
            size += len(w[end]) + 1
            end += 1
        out.append(b" ".join(w[first:end]).decode("utf-8", "replace"))
        if end == len(w):
            break
        first = end - window + 1
    return out


def _cut(items: DataFrame, window: int, most: int) -> DataFrame:
    """``items`` with those of more than ``most`` bytes in pieces."""

    def run(batches):
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for p in pieces(t.as_py(), window, most):
                    yield pa.RecordBatch.from_pylist([{"item_id": i, "text": p}], pa.schema([("item_id", pa.string()), ("text", pa.string())]))

    large = F.octet_length("text") > most
    return items.where(~F.coalesce(large, F.lit(False))).union(items.where(large).mapInArrow(run, "item_id string, text string"))


def _scanned(docs: DataFrame, benchmark: DataFrame, window: int, part_bytes: int):
    """The documents after all parts of the benchmark but the last, and a function that scans for that.

    The function takes (row of the batch, text, state column or None) and gives words, hits and names.
    Before the last part, rows carry their hits so far in a last column.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string").alias("text"))
    size, largest = items.agg(F.sum(F.octet_length("text")), F.max(F.octet_length("text"))).first()
    if (largest or 0) > part_bytes // 4:
        items = save(_cut(items, window, part_bytes // 4), "decontaminate-pieces")
        size = items.agg(F.sum(F.octet_length("text"))).first()[0]
    size = size or 0
    n = max(1, -(-size // part_bytes))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    at, carried = docs.columns.index("text"), None

    def scanner(i: int):
        shared, name = spark.sparkContext.broadcast([tuple(r) for r in items.where(part == i).collect()]), uuid.uuid4().hex

        def scan(text: str | None, state) -> tuple[list[bytes], np.ndarray, set[str]]:
            w = words(text)
            hit, found = _windows(name, shared, window).scan(w)
            for s in state["spans"] if state else ():
                hit[s["first"] : s["last"] + 1] = True
            return w, hit, found | set(state["names"] if state else ())

        return scan

    rows = docs
    for i in range(n - 1):
        scan = scanner(i)

        def run(batches, scan=scan, first=i == 0):
            for b in batches:
                state = [None] * b.num_rows if first else b.column(b.num_columns - 1).to_pylist()
                out = []
                for t, s in zip(b.column(at), state, strict=True):
                    _, hit, found = scan(t.as_py(), s)
                    out.append({"spans": _spans(hit), "names": sorted(found)})
                kept = b.columns if first else b.columns[:-1]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(out, _STATE)], names=[*(f"c{k}" for k in range(len(kept))), "state"])

        names = [f"c{k}" for k in range(len(docs.columns))]
        fields = [f for f in docs.toDF(*names).schema.fields]
        schema = StructType([*fields, *StructType.fromDDL(_STATE_DDL).fields])
        rows = save((rows.toDF(*names) if i == 0 else rows).mapInArrow(trimmed(run), schema), "decontaminate-part")
        if carried is not None:
            release(carried)
        carried = rows
    return rows, scanner(n - 1), carried is not None


def flag(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, part_bytes: int = PART_BYTES) -> DataFrame:
    """Per document the number of words, hit words and items, the word spans hit, and the verdict."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    rows, scan, carried = _scanned(docs, benchmark, window, part_bytes)

    def run(batches):
        for b in batches:
            out = [[], [], [], [], [], []]
            state = b.column(2).to_pylist() if carried else [None] * b.num_rows
            for t, s in zip(b.column(1), state, strict=True):
                w, hit, found = scan(t.as_py(), s)
                n, names = int(hit.sum()), sorted(found)
                for o, v in zip(
                    out,
                    (len(w), n, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), n > 0 and share * n >= len(w), _spans(hit) if n else []),
                    strict=True
                ):
                    o.append(v)
            yield batch(_SCHEMA, b.column(0), *out)

    return rows.mapInArrow(trimmed(run), _RESULT)


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = SHARE, remove: str = "documents", part_bytes: int = PART_BYTES) -> DataFrame:
    """The documents without contamination, with all columns.

    ``remove="documents"`` drops contaminated documents; ``remove="spans"`` keeps them and cuts the
    hit word spans out of the text instead.
    """
    rows, scan, carried = _scanned(docs, benchmark, window, part_bytes)
    at, names = docs.columns.index("text"), docs.columns

    def run(batches):
        for b in batches:
            keep, texts = [], []
            state = b.column(b.num_columns - 1).to_pylist() if carried else [None] * b.num_rows
            for t, s in zip(b.column(at), state, strict=True):
                text = t.as_py()
                w, hit, _ = scan(text, s)
                n = int(hit.sum())
                bad = n > 0 and share * n >= len(w)
                keep.append(remove != "documents" or not bad)
                texts.append(cut_spans(text, hit) if bad and remove == "spans" else text)
            columns = [*b.columns[: len(names)]]
            columns[at] = pa.array(texts, b.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(keep, pa.bool_()))

    return rows.mapInArrow(trimmed(run), docs.schema)


def cut_spans(text: str, hit: np.ndarray) -> str:
    """The text without its hit words and what separates them."""
    raw = text.encode("utf-8", "replace")
    a = np.frombuffer(raw.translate(_TABLE), np.uint8) != 32
    edge = np.flatnonzero(np.diff(np.concatenate(([0], a.view(np.int8), [0]))))
    first, last = edge[::2], edge[1::2]
    out, at = [], 0
    for s in _spans(hit):
        out.append(raw[at : first[s["first"]]])
        at = last[s["last"]]
    return b"".join([*out, raw[at:]]).decode("utf-8", "replace")
