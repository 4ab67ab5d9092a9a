"""Language-model scores by prediction by partial matching (PPM) over a byte-context trie.

A text is its tokens with a space behind each, and one end. Its bytes are predicted one by one from
the ``ORDER`` bytes before, across the borders of tokens; in front of a text stand ends. The trie
counts every byte of all training documents in all of its contexts. A symbol is coded in the longest
context that training has seen; unseen symbols escape to the next shorter one (method D), where the
symbols already seen above are excluded; what remains is uniform over the bytes never seen at order
0. As every shorter context has seen at least the symbols of a longer one, the excluded set of a
level is the set of the level above, so a node needs four numbers: a symbol's count, the total, the
number of symbols, and the total that its own symbols have one level below.

``pretrained`` is distributed; nothing that grows with the corpus is broadcast:

1. One scan cuts the documents into blocks of text. Per block it keeps the text, the distinct tokens
   with their training counts, and the distinct windows (a context and its symbol packed in 64 bits,
   the nearest byte first) with theirs. Sorted windows are dealt by ranges, whose bounds are
   quantiles of a sample: so no context, however frequent, is one task's work.
2. A trie node is an interval of sorted windows. Nodes within one range are counted there. Of nodes
   on a bound, each range reports its part (at most 256 symbols a level and bound); the sums go back
   to the ranges that need them. Orders 0 and 1 (65,792 counts) are broadcast.
3. Each range works out the code length of its windows and gives each block its own.
4. Each block looks up the windows of its text, byte by byte, and adds up its documents.

Defined results: null text is empty (one end token); a null doc_id is carried; repeated rows are
scored and learned each; without training documents every byte costs log10(256); a text of any
length is one row of one block; extra columns are not carried.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkflow.llm.common import batch, release, save, trimmed, word_hashes

#: Bytes of context; at most 7, as a window is one 64-bit number.
ORDER = 6
END = b"\n"
#: Text after which a block is closed, and text whose windows are sorted or looked up at once.
BLOCK_BYTES, PIECE_BYTES = 16 << 20, 2 << 20
#: Text per range of windows, and text that the ranges' bounds are taken from (only balance depends on it).
RANGE_BYTES, SAMPLE_BYTES = 8 << 20, 2 << 20
#: Text per group of tokens.
TOKEN_GROUP_BYTES = 32 << 20

_PAD = END * 7
_BLOCK = pa.schema([
    ("kind", pa.string()), ("block", pa.int64()), ("part", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
    ("keys", pa.binary()), ("counts", pa.binary()),
])
_BLOCK_DDL = "kind string, block long, part int, doc_ids array<long>, held array<boolean>, keys binary, counts binary"
_EDGE = pa.schema([("part", pa.int32()), ("level", pa.int32()), ("edge", pa.int64()), ("n", pa.int64())])
_PULL = pa.schema([("kind", pa.string()), ("block", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()), ("total", pa.int64()), ("distinct", pa.int64())])
_PULL_DDL = "kind string, block long, keys binary, counts binary, total long, distinct long"
_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
    ("base_score", pa.float64()), ("score", pa.float64()),
])
_RESULT_DDL = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def tokens(text: str | None) -> list[bytes]:
    """Words split at ASCII white space with A-Z lower-cased, then the end."""
    return [*(text.encode("utf-8", "replace").lower().split() if text else []), END]


def normal(text: str | None) -> bytes:
    """The bytes that are predicted: each token with a space behind it, and the end."""
    words = text.encode("utf-8", "replace").lower().split() if text else []
    return b"".join((b" ".join(words), b" \n")) if words else END


class Ppm:
    """The trie in memory: ``learn`` adds a text, ``score`` gives its log10 probability."""

    def __init__(self, order: int = ORDER):
        self.order, self.node = order, defaultdict(Counter)

    def _steps(self, text: str | None):
        full = _PAD + normal(text)
        for i in range(len(_PAD), len(full)):
            yield full[i - self.order : i], full[i]

    def _count(self, context: bytes, s: int) -> None:
        for k in range(self.order + 1):
            self.node[context[self.order - k :]][s] += 1

    def learn(self, text: str | None) -> None:
        for context, s in self._steps(text):
            self._count(context, s)

    def score(self, text: str | None) -> float:
        return sum(self.symbol(context, s) for context, s in self._steps(text))

    def adapt(self, text: str | None) -> float:
        """The same, learning each byte once it is coded."""
        total = 0.0
        for context, s in self._steps(text):
            total += self.symbol(context, s)
            self._count(context, s)
        return total

    def symbol(self, context: bytes, s: int) -> float:
        excluded: set[int] = set()
        total = 0.0
        for k in range(len(context), -1, -1):
            seen = self.node.get(context[len(context) - k :])
            left = {x: n for x, n in seen.items() if x not in excluded} if seen else {}
            if not left:
                continue
            t = sum(left.values())
            if s in left:
                return total + float(np.log10((2 * left[s] - 1) / (2 * t)))
            total += float(np.log10(len(left) / (2 * t)))
            excluded |= left.keys()
        return total - float(np.log10(256 - len(excluded)))


def adaptive(text: str | None, order: int = ORDER) -> float:
    """log10 probability of a text under a trie that starts empty and learns as it goes."""
    return Ppm(order).adapt(text)


def windows(texts: list[bytes], order: int = ORDER) -> np.ndarray:
    """The window of each byte of normal texts: context bytes from the nearest on, then the symbol."""
    raw = b"".join([x for t in texts for x in (_PAD, t)])
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + len(_PAD)
    # The eight bytes that end at each place, as one little-endian number: the symbol is its top byte.
    w = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    inner = np.ones(len(raw), bool)
    inner[((np.cumsum(size) - size)[:, None] + np.arange(len(_PAD))).reshape(-1)] = False
    w = w[inner[7:]]
    w = w << np.uint64(8) | w >> np.uint64(56)
    return w & np.uint64(0xFF | (0xFFFFFFFFFFFFFFFF << 8 * (8 - order)) & 0xFFFFFFFFFFFFFFFF)


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k = np.concatenate(keys)
    by = np.argsort(k, kind="stable")
    k = k[by]
    first = np.flatnonzero(np.concatenate(([True], k[1:] != k[:-1]))) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(np.concatenate(counts)[by], first) if len(k) else np.zeros(0, np.int64)


def _planes(x: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    import zstandard

    raw = np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())


def _numbers(blob: bytes, kind: str) -> np.ndarray:
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(raw.T).reshape(-1).view(kind)


def _pack(keys: np.ndarray) -> bytes:
    return _planes(np.diff(keys, prepend=np.zeros(1, np.uint64)))


def _unpack(blob: bytes) -> np.ndarray:
    return np.cumsum(_numbers(blob, "<u8"), dtype=np.uint64)


class _Block:
    """What one block of documents gathers."""

    def __init__(self, order: int):
        self.order, self.size, self.rows = order, 0, []
        self.pending: tuple[list, list, list] = ([], [], [])
        self.waiting = 0
        self.tokens: dict[bytes, int] = {}
        self.keys: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []

    def add(self, doc_id: int | None, text: str | None, held: bool) -> None:
        raw = normal(text)
        for x, v in zip(self.pending, (doc_id, raw, held), strict=True):
            x.append(v)
        for t, n in Counter(raw.split()).items():
            self.tokens[t] = self.tokens.get(t, 0) + n * (not held)
        self.tokens[END] = self.tokens.get(END, 0) + (not held)
        self.size += len(raw)
        self.waiting += len(raw)
        if self.waiting >= PIECE_BYTES:
            self._piece()

    def _piece(self) -> None:
        import zstandard

        ids, raws, held = self.pending
        for out in (False, True):
            if own := [r for r, h in zip(raws, held, strict=True) if h == out]:
                k, n = np.unique(windows(own, self.order), return_counts=True)
                self.keys.append(k)
                self.counts.append(np.zeros(len(k), np.int64) if out else n)
        self.rows.append({"doc_ids": ids, "held": held, "keys": zstandard.ZstdCompressor(level=3).compress(b"".join(raws))})
        self.pending, self.waiting = ([], [], []), 0

    def close(self, block: int, bounds: np.ndarray, groups: int):
        if self.waiting:
            self._piece()
        for r in self.rows:
            yield _block_rows("text", [block], doc_ids=[r["doc_ids"]], held=[r["held"]], keys=[r["keys"]])
        keys, counts = summed(self.keys, self.counts)
        cut = [0, *np.searchsorted(keys, bounds).tolist(), len(keys)]
        some = [i for i in range(len(cut) - 1) if cut[i] < cut[i + 1]]
        for i in range(0, len(some), 64):
            at = some[i : i + 64]
            packed = [_pack(keys[cut[j] : cut[j + 1]]) for j in at], [_planes(counts[cut[j] : cut[j + 1]].astype("<u4")) for j in at]
            yield _block_rows("window", [block] * len(at), part=at, keys=packed[0], counts=packed[1])
        dealt: dict[int, list[bytes]] = defaultdict(list)
        words = list(self.tokens)
        for w, g in zip(words, (word_hashes(words) % np.uint64(groups)).tolist(), strict=True):
            dealt[g].append(w)
        for g, own in dealt.items():
            counted = np.fromiter(map(self.tokens.__getitem__, own), np.int64, len(own))
            yield _block_rows("token", [block], part=[g], keys=[_words(own)], counts=[_planes(counted.astype("<u4"))])


def _words(words: list[bytes]) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(b" ".join(words))


def _split(blob: bytes) -> list[bytes]:
    import zstandard

    return zstandard.ZstdDecompressor().decompress(blob).split(b" ")


def _block_rows(kind: str, block: list[int], **columns) -> pa.RecordBatch:
    size = len(block)
    columns |= {"kind": [kind] * size, "block": block}
    return batch(_BLOCK, *[columns.get(f.name, pa.nulls(size, f.type)) for f in _BLOCK])


def _blocks(order: int, bounds: np.ndarray, groups: int, block_bytes: int):
    def run(batches):
        base, seq, own = TaskContext.get().partitionId() << 32, 0, _Block(order)
        for b in batches:
            for d, t, h in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist(), strict=True):
                own.add(d, t.as_py(), h)
                if own.size >= block_bytes:
                    yield from own.close(base + seq, bounds, groups)
                    own, seq = _Block(order), seq + 1
        if own.size:
            yield from own.close(base + seq, bounds, groups)

    return run


def _bounds(docs: DataFrame, size: int, order: int, range_bytes: int) -> np.ndarray:
    """Sorted windows that cut all windows into ranges of about equal numbers of distinct ones."""
    want = max(16, -(-size // range_bytes))
    share = min(1.0, max(SAMPLE_BYTES, 64 * want) / max(size, 1))
    some = [normal(r.text) for r in docs.select("text").sample(share, 7).collect()] if size else []
    found = np.unique(windows(some, order)) if some else np.zeros(0, np.uint64)
    return np.unique(found[np.linspace(0, len(found) - 1, min(want, len(found)) + 1).astype(int)[1:-1]]) if len(found) > 1 else np.zeros(0, np.uint64)


def _range(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a range and their training counts."""
    keys = [_unpack(x.as_py()) for x in t.column("keys")]
    return summed(keys, [_numbers(x.as_py(), "<u4").astype(np.int64) for x in t.column("counts")])


def _prefix(w, level: int):
    return w >> np.uint64(64 - 8 * level) if level else w & np.uint64(0)


def borders(part: int, w: np.ndarray, n: np.ndarray, bounds: np.ndarray, order: int):
    """Per level the range's edges (prefix and symbol) that other ranges may hold too, and their counts."""
    ends = [bounds[i] for i in (part - 1, part) if 0 <= i < len(bounds)]
    for k in range(1, order + 1):
        prefix = _prefix(w, k)
        at = np.flatnonzero(np.isin(prefix, [_prefix(x, k) for x in ends])) if k > 1 else np.arange(len(w))
        edge, count = summed([prefix[at] << np.uint64(8) | w[at] & np.uint64(0xFF)], [n[at]])
        yield k, edge, count


def costs(w: np.ndarray, n: np.ndarray, order: int, order1: np.ndarray, border: dict[int, tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """log10 probability of each of a range's sorted distinct windows.

    ``order1[context byte, s]`` are counts of the whole corpus; ``border[level]`` holds the sorted
    edges and counts, over all ranges, of the nodes that cross this range's bounds.
    """
    sym, one = (w & np.uint64(0xFF)).astype(np.int64), (w >> np.uint64(56)).astype(np.int64)
    order0 = order1.sum(0)
    some = order1 > 0
    # Per level, for every window: its count, the node's total and number of symbols, their total one level below.
    c, t = [order0[sym], order1[one, sym]], [np.full(len(w), order0.sum()), order1.sum(1)[one]]
    d, x = [np.full(len(w), (order0 > 0).sum()), some.sum(1)[one]], [np.zeros(len(w), np.int64), (some * order0).sum(1)[one]]
    below = np.arange(1 << 16, dtype=np.uint64), order1.reshape(-1)
    for k in range(2, order + 1):
        edges, at = np.unique(_prefix(w, k) << np.uint64(8) | w & np.uint64(0xFF), return_inverse=True)
        count, lower = np.zeros(len(edges), np.int64), np.zeros(len(edges), np.int64)
        np.add.at(count, at, n)
        lower[at] = c[k - 1]
        known, sums = border.get(k, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
        first = np.flatnonzero(np.concatenate(([True], edges[1:] >> np.uint64(8) != edges[:-1] >> np.uint64(8)))) if len(edges) else np.zeros(0, np.int64)
        node = np.repeat(np.arange(len(first)), np.diff([*first, len(edges)]))
        total, distinct, under = (np.add.reduceat(v, first) if len(first) else v for v in (count, (count > 0).astype(np.int64), np.where(count > 0, lower, 0)))
        if len(known):
            place = np.minimum(np.searchsorted(known, edges), len(known) - 1)
            count = np.where(known[place] == edges, sums[place], count)
            # The same edge one level below loses its farthest byte.
            less = _shorter(known, k)
            place = np.minimum(np.searchsorted(below[0], less), len(below[0]) - 1)
            under_known = np.where((below[0][place] == less) & (sums > 0), below[1][place], 0)
            names = edges[first] >> np.uint64(8)
            for v in np.unique(known >> np.uint64(8)):
                i = np.searchsorted(names, v)
                if i < len(names) and names[i] == v:
                    own = known >> np.uint64(8) == v
                    total[i], distinct[i], under[i] = sums[own].sum(), (sums[own] > 0).sum(), under_known[own].sum()
        below = known, sums
        c.append(count[at])
        for out, v in ((t, total), (d, distinct), (x, under)):
            out.append(v[node[at]])
    out, left = np.zeros(len(w)), np.ones(len(w), bool)
    above_d, above_x = np.zeros(len(w), np.int64), np.zeros(len(w), np.int64)
    for k in range(order, -1, -1):
        total, distinct = t[k] - above_x, d[k] - above_d
        open_ = left & (t[k] > 0) & (distinct > 0)
        hit = open_ & (c[k] > 0)
        out[hit] += np.log10((2 * c[k][hit] - 1) / (2 * total[hit]))
        miss = open_ & ~hit
        out[miss] += np.log10(distinct[miss] / (2 * total[miss]))
        left &= ~hit
        above_d, above_x = d[k], x[k]
    out[left] -= np.log10(256 - d[0][left])
    return out


def _shorter(edges: np.ndarray, level: int) -> np.ndarray:
    return (edges >> np.uint64(16)) << np.uint64(8) | edges & np.uint64(0xFF)


class Lookup:
    """Places of keys in a sorted hash array; every key that is asked for must be there."""

    ODD = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray):
        h = keys * self.ODD
        self.at = np.argsort(h, kind="stable")
        self.h = h[self.at]
        self.shift = np.uint64(64 - max(1, int(len(keys)).bit_length()))
        self.first = np.searchsorted(self.h, np.arange(1 << (64 - int(self.shift)), dtype=np.uint64) << self.shift)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        h = keys * self.ODD
        at = self.first[(h >> self.shift).astype(np.int64)]
        left = np.flatnonzero(self.h[at] != h)
        while len(left):
            at[left] += 1
            left = left[self.h[at[left]] != h[left]]
        return at


def pretrained(docs: DataFrame, held_out: Column, order: int = ORDER, block_bytes: int = BLOCK_BYTES, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Scores of all documents, learning from those for which ``held_out`` is false."""
    if not 1 < order < 8:
        raise ValueError("order must be from 2 to 7")
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held_out.alias("held_out"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    cuts = spark.sparkContext.broadcast(bounds := _bounds(docs, size, order, range_bytes))
    groups = max(16, -(-size // TOKEN_GROUP_BYTES))
    blocks = save(docs.mapInArrow(trimmed(_blocks(order, bounds, groups, block_bytes)), _BLOCK_DDL), "ppm-blocks", by="kind")
    entries = blocks.where("kind = 'window'").select("part", "block", "keys", "counts")

    def report(key, t):
        part, (w, n) = key[0].as_py(), _range(t)
        out = [
            pa.table([pa.array(np.full(len(e), part, np.int32)), pa.array(np.full(len(e), k, np.int32)), pa.array(e.view(np.int64)), pa.array(c)], schema=_EDGE) for k,
            e, c in borders(part, w, n, cuts.value, order)
        ]
        return pa.concat_tables(out)

    edges = save(entries.groupBy("part").applyInArrow(report, "part int, level int, edge long, n long"), "ppm-borders")
    order1 = np.zeros(1 << 16, np.int64)
    # At most 65,536 rows: contexts of one byte.
    for r in edges.where("level = 1").groupBy("edge").agg(F.sum("n").alias("n")).collect():
        order1[r.edge] = r.n
    low = spark.sparkContext.broadcast(order1.reshape(256, 256))
    node = F.shiftrightunsigned("edge", 8)
    upper = edges.where("level > 1")
    sums = upper.groupBy("level", "edge").agg(F.sum("n").alias("n")).withColumn("node", node)
    needs = upper.select("part", "level", node.alias("node")).distinct()
    border = needs.join(sums, ["level", "node"]).select("part", "level", "edge", "n")

    def price(t, b):
        if not t.num_rows:
            return _PULL.empty_table()
        level, edge, n = b.column("level").to_numpy(), b.column("edge").to_numpy().view(np.uint64), b.column("n").to_numpy()
        known = {}
        for k in range(2, order + 1):
            at = np.flatnonzero(level == k)
            at = at[np.argsort(edge[at])]
            known[k] = edge[at], n[at]
        w, counts = _range(t)
        cost = costs(w, counts, order, low.value, known).astype("<f4")
        pulled = [_planes(cost[np.searchsorted(w, _unpack(x.as_py()))]) for x in t.column("keys")]
        size = t.num_rows
        return pa.table(
            [pa.array(["window"] * size), t.column("block"), t.column("keys").cast(pa.binary()), pa.array(pulled, pa.binary()), pa.nulls(size, pa.int64()), pa.nulls(size, pa.int64())],
            schema=_PULL
        )

    def count(key, t):
        total: dict[bytes, int] = {}
        words = [_split(x.as_py()) for x in t.column("keys")]
        for own, x in zip(words, t.column("counts"), strict=True):
            for w, n in zip(own, _numbers(x.as_py(), "<u4").tolist(), strict=True):
                total[w] = total.get(w, 0) + n
        pulled = [_planes(np.fromiter(map(total.__getitem__, own), np.int64, len(own))) for own in words]
        size = t.num_rows
        once = lambda v: pa.array([v, *[0] * (size - 1)], pa.int64())
        return pa.table(
            [pa.array(["token"] * size), t.column("block"), t.column("keys").cast(pa.binary()), pa.array(pulled, pa.binary()), once(sum(total.values())), once(sum(n > 0 for n in total.values()))],
            schema=_PULL
        )

    counted = save(blocks.where("kind = 'token'").select("part", "block", "keys", "counts").groupBy("part").applyInArrow(count, _PULL_DDL), "ppm-tokens")
    priced = save(entries.groupBy("part").cogroup(border.groupBy("part")).applyInArrow(price, _PULL_DDL), "ppm-costs")
    release(edges)
    release(blocks, "kind=window")
    release(blocks, "kind=token")
    n, v = counted.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()

    def score(t, p):
        import zstandard

        if not t.num_rows:
            return _RESULT.empty_table()
        kind = p.column("kind").to_numpy(zero_copy_only=False)
        own, of_token = p.filter(pa.array(kind == "window")), p.filter(pa.array(kind == "token"))
        place = Lookup(np.concatenate([_unpack(x.as_py()) for x in own.column("keys")]))
        cost = np.concatenate([_numbers(x.as_py(), "<f4") for x in own.column("counts")])[place.at].astype(float)
        words = [w for x in of_token.column("keys") for w in _split(x.as_py())]
        known = dict(zip(words, np.concatenate([_numbers(x.as_py(), "<i8") for x in of_token.column("counts")]).tolist(), strict=True))
        out = []
        for ids, held, blob in zip(t.column("doc_ids"), t.column("held"), t.column("keys"), strict=True):
            raws = zstandard.ZstdDecompressor().decompress(blob.as_py()).split(END)[:-1]
            raws = [r + END for r in raws]
            start = np.cumsum([0, *map(len, raws[:-1])])
            spelled = np.add.reduceat(cost[place(windows(raws, order))], start)
            split = [r.split() for r in raws]
            m = np.fromiter(map(len, split), np.int64, len(split)) + 1
            c = np.fromiter((known[w] for s in split for w in (*s, END)), np.int64, int(m.sum()))
            first = np.cumsum(m) - m
            base = np.add.reduceat(np.log10((c + 0.1) / (n + 0.1 * (v + 1))), first)
            out.append(
                pa.record_batch([ids.values, held.values, pa.array(m), pa.array(np.add.reduceat((c > 0).astype(np.int64), first)), pa.array(np.full(len(m), n, np.int64)), pa.array(base), pa.array(spelled)], schema=_RESULT)
            )
        return pa.Table.from_batches(out, _RESULT)

    texts = blocks.where("kind = 'text'").select("block", "doc_ids", "held", "keys")
    pulled = priced.unionByName(counted).select("kind", "block", "keys", "counts")
    return texts.groupBy("block").cogroup(pulled.groupBy("block")).applyInArrow(score, _RESULT_DDL)
