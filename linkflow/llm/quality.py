"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages (``PASSAGE`` words each). Every passage is encoded from its words and
word pairs, hashed into ``HASHED`` signed counts, and from shares of character classes and word
repetition; one learned layer turns that into an embedding, gated attention (tanh times sigmoid)
weights the passages, and a linear layer scores the weighted sum. Only document labels are used. The
network is small, so it is trained on the driver from a bounded sample of labelled documents
(``TRAIN_DOCS``) and broadcast; training and scores are of all passages of whole texts.

Defined results: null or empty text is one passage without words and gets that passage's score;
without usable labels every score is 0.5; a document with several labels counts by their mean;
repeated rows give repeated results; extra columns are not carried (``score``) or kept (``keep``).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkflow.llm.common import batch, mix64, trimmed, word_hashes

PASSAGE = 64
#: Labelled documents that the network is trained on, at most (expected; chosen by hash).
TRAIN_DOCS = 4000
HIDDEN, GATE, RATE, DECAY = 24, 12, 0.005, 1e-4
#: Documents a step, and passes over the sample (small samples get ``STEPS`` steps at least).
BATCH, EPOCHS, STEPS = 256, 30, 400

# Character classes: 0 lower, 1 upper, 2 digit, 3 white, 4 sentence marks, 5 "!?", 6 other ASCII, 7 beyond ASCII.
_CLASS = np.full(256, 6, np.uint8)
_CLASS[np.arange(ord("a"), ord("z") + 1)] = 0
_CLASS[np.arange(ord("A"), ord("Z") + 1)] = 1
_CLASS[np.arange(ord("0"), ord("9") + 1)] = 2
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[np.frombuffer(b".,;:'\"-()", np.uint8)] = 4
_CLASS[np.frombuffer(b"!?", np.uint8)] = 5
_CLASS[128:] = 7
HASHED, SHAPE = 256, 15
FEATURES = HASHED + SHAPE


def encode(text: str | None) -> np.ndarray:
    """One row of features per passage; an empty text has one row of zeros."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return np.zeros((1, FEATURES), np.float32)
    kind = _CLASS[np.frombuffer(raw, np.uint8)]
    word = kind != 3
    starts = np.flatnonzero(word & ~np.concatenate(([False], word[:-1])))[: len(words)]
    first = np.arange(0, len(words), PASSAGE)
    if len(first) > 1 and len(words) - first[-1] < PASSAGE // 4:
        first = first[:-1]
    k = len(first)
    n = np.diff([*first, len(words)]).astype(float)
    edge = starts[np.minimum(first, len(starts) - 1)]
    edge[0] = 0
    size = np.diff([*edge, len(raw)])
    own = np.repeat(np.arange(k), size)
    share = np.bincount(own * 8 + kind, minlength=8 * k).reshape(k, 8) / np.maximum(size, 1)[:, None]
    h = word_hashes(raw.lower().split())
    bag = np.repeat(np.arange(k), n.astype(int))
    order = np.lexsort((h, bag))
    hs, bs = h[order], bag[order]
    new = np.concatenate(([True], (hs[1:] != hs[:-1]) | (bs[1:] != bs[:-1])))
    at = np.flatnonzero(new)
    times = np.diff([*at, len(hs)])
    most = np.zeros(k)
    np.maximum.at(most, bs[at], times)
    distinct = np.bincount(bs[new], minlength=k)
    same = np.bincount(bag[1:], (h[1:] == h[:-1]) & (bag[1:] == bag[:-1]), k) if len(h) > 1 else np.zeros(k)
    length = np.fromiter(map(len, words), np.int64, len(words))
    shape = np.column_stack(
        [share, distinct / n, most / n, same / n, np.bincount(bag, length, k) / n / 10, np.bincount(bag, length <= 2, k) / n, np.log1p(n) / 5, np.bincount(bag, length == 1, k) / n]
    )
    # Words and pairs within a passage; the hash gives the place and, by its top bit, the sign.
    pair = mix64(h[1:] + mix64(h[:-1]))[bag[1:] == bag[:-1]]
    at, own = np.concatenate((h, pair)), np.concatenate((bag, bag[1:][bag[1:] == bag[:-1]]))
    sign = 1.0 - 2.0 * (at >> np.uint64(63)).astype(float)
    counts = np.bincount(own * HASHED + (at % np.uint64(HASHED)).astype(np.int64), sign, HASHED * k).reshape(k, HASHED)
    return np.column_stack([counts / np.sqrt(n)[:, None], shape]).astype(np.float32)


@dataclass
class Network:
    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, first: np.ndarray):
        """Logit of each bag; ``first`` holds the bags' first rows. Also what training needs again."""
        w = self.w
        x = (x - self.mean) / self.scale
        e = np.tanh(x @ w["E"] + w["e"])
        t, s = np.tanh(e @ w["T"]), 1 / (1 + np.exp(-(e @ w["S"])))
        a = (t * s) @ w["a"]
        bag = np.repeat(np.arange(len(first)), np.diff([*first, len(x)]))
        a = np.exp(a - np.maximum.reduceat(a, first)[bag])
        a /= np.add.reduceat(a, first)[bag]
        z = np.add.reduceat(a[:, None] * e, first, axis=0)
        return z @ w["c"] + w["d"][0], (x, e, t, s, a, z, bag)

    def score(self, x: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        logit, (*_, a, _, _) = self.forward(x, first)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30))), a


def train(x: np.ndarray, first: np.ndarray, label: np.ndarray, seed: int = 7) -> Network:
    """Adam on the log loss of the bags, in steps of ``BATCH`` bags."""
    rng = np.random.default_rng(seed)
    f, bags = x.shape[1], len(first)
    w = {
        "E": rng.normal(0, f**-0.5, (f, HIDDEN)), "e": np.zeros(HIDDEN), "T": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)), "S": rng.normal(0, HIDDEN**-0.5, (HIDDEN, GATE)),
        "a": rng.normal(0, GATE**-0.5, GATE), "c": rng.normal(0, HIDDEN**-0.5, HIDDEN), "d": np.zeros(1),
    }
    net = Network(x.mean(0), x.std(0) + 1e-2, w)
    size = np.diff([*first, len(x)])
    m, v = ({k: np.zeros_like(p) for k, p in w.items()} for _ in range(2))
    per = -(-bags // BATCH)
    step = 0
    for _ in range(max(EPOCHS, -(-STEPS // per))):
        order = rng.permutation(bags)
        for i in range(0, bags, BATCH):
            step += 1
            own = order[i : i + BATCH]
            n = size[own]
            begin = np.cumsum(n) - n
            rows = np.repeat(first[own] - begin, n) + np.arange(n.sum())
            grad = _gradient(net, x[rows].astype(float), begin, label[own])
            for k, p in w.items():
                d = grad[k] + DECAY * p
                m[k] += 0.1 * (d - m[k])
                v[k] += 0.001 * (d * d - v[k])
                p -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return net


def _gradient(net: Network, x: np.ndarray, first: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    w = net.w
    logit, (xs, e, t, s, a, z, bag) = net.forward(x, first)
    g = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label) / len(label)
    grad = {"c": z.T @ g, "d": np.array([g.sum()])}
    gz = g[:, None] * w["c"]
    ga = (e * gz[bag]).sum(1)
    ga = a * (ga - np.add.reduceat(a * ga, first)[bag])
    gts = ga[:, None] * w["a"]
    grad["a"] = (t * s).T @ ga
    gt, gs = gts * s * (1 - t * t), gts * t * s * (1 - s)
    grad["T"], grad["S"] = e.T @ gt, e.T @ gs
    ge = (a[:, None] * gz[bag] + gt @ w["T"].T + gs @ w["S"].T) * (1 - e * e)
    grad["E"], grad["e"] = xs.T @ ge, ge.sum(0)
    return grad


def fit(docs: DataFrame, labels: DataFrame, column: str = "quality", usable: Column | None = None, train_docs: int = TRAIN_DOCS) -> Network | None:
    """Learns ``labels(doc_id, <column> 0/1)``; ``usable`` says which label rows may be learned from."""
    rows = labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & (F.lit(True) if usable is None else usable))
    rows = rows.groupBy("doc_id").agg((F.avg(column) >= 0.5).cast("double").alias("label"))
    n = rows.count()
    if not n:
        return None
    u = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # The sample is bounded by train_docs, so its ids can be broadcast.
    sample = rows.where(u * n < train_docs)

    def run(batches):
        for b in batches:
            bags = [encode(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([x.tobytes() for x in bags], pa.binary())], names=["doc_id", "label", "x"])

    both = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "text", "label")
    # Sorted: the order of summation, and so the network, is the same in every run.
    got = sorted(both.mapInArrow(trimmed(run), "doc_id long, label double, x binary").collect(), key=lambda r: (r.doc_id, bytes(r.x)))
    if len({r.label for r in got}) < 2:
        return None
    bags = [np.frombuffer(r.x, np.float32).reshape(-1, FEATURES) for r in got]
    first = np.cumsum([0, *map(len, bags[:-1])])
    return train(np.concatenate(bags), first, np.array([r.label for r in got]))


def _scores(net: Network | None, texts: pa.Array) -> tuple[np.ndarray, list[int], list[float]]:
    """Scores, number of passages and largest attention weight."""
    out, count, top = [], [], []
    for i in range(0, len(texts), 256):
        bags = [encode(t.as_py()) for t in texts.slice(i, 256)]
        size = [len(x) for x in bags]
        first = np.cumsum([0, *size[:-1]])
        if net is None:
            s, a = np.full(len(bags), 0.5), np.repeat(1 / np.array(size), size)
        else:
            s, a = net.score(np.concatenate(bags), first)
        out.append(s)
        count += size
        top += np.maximum.reduceat(a, first).tolist()
    return np.concatenate(out) if out else np.zeros(0), count, top


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("n_passages", pa.int32()), ("top_weight", pa.float64())]
)


def score(docs: DataFrame, net: Network | None, held_out: Column) -> DataFrame:
    """``doc_id, held_out, score, predicted``, the number of passages and the largest attention weight."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches):
        for b in batches:
            s, n, top = _scores(shared.value, b.column(2))
            yield batch(_SCHEMA, b.column(0), b.column(1), s, (s >= 0.5).astype(np.int32), n, top)

    return docs.select(F.col("doc_id").cast("long"), held_out.alias("held_out"), "text").mapInArrow(
        trimmed(run), "doc_id long, held_out boolean, score double, predicted int, n_passages int, top_weight double"
    )


def keep(docs: DataFrame, net: Network | None) -> DataFrame:
    """The documents that are not rejected (score 0.5 or more), with all columns."""
    shared, at = docs.sparkSession.sparkContext.broadcast(net), docs.columns.index("text")

    def run(batches):
        for b in batches:
            s, _, _ = _scores(shared.value, b.column(at))
            yield b.filter(pa.array(s >= 0.5))

    return docs.mapInArrow(trimmed(run), docs.schema)
