import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from linkflow.llm import quality, queries


def test_gradients_lower_the_loss_and_attention_sums_to_one():
    rng = np.random.default_rng(0)
    size = rng.integers(1, 6, 200)
    first = np.cumsum([0, *size[:-1]])
    x = rng.normal(size=(size.sum(), quality.FEATURES))
    label = rng.integers(0, 2, 200).astype(float)
    # One marked passage makes a bag positive: the case that attention is for.
    for k in np.flatnonzero(label):
        x[first[k] + rng.integers(size[k])] += 4
    net = quality.train(x, first, label)
    s, a = net.score(x, first)
    assert np.mean((s >= 0.5) == label) >= 0.97
    assert np.allclose(np.add.reduceat(a, first), 1)


def test_encoding():
    assert quality.encode(None).shape == quality.encode("").shape == quality.encode(" \n").shape == (1, quality.FEATURES)
    x = quality.encode("word " * 200)
    assert len(x) == 3 and np.isfinite(x).all()
    assert len(quality.encode("w " * 70)) == 1
    assert len(quality.encode("x" * 300_000)) == 1 and np.isfinite(quality.encode("\x00 é \x85 !!")).all()


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op2_quality(spark, d).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{d}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for i, r in got.items())
    held = [i for i in labels if got[i].held_out]
    assert np.mean([got[i].predicted == labels[i] for i in held]) >= 0.95


@pytest.fixture(scope="module")
def small(spark):
    good, bad = "A calm sentence about nothing in particular, of many words. " * 5, "BUY!! NOW!! CHEAP!! " * 20
    rows = [(i, (good if i % 2 else bad) + str(i)) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2, None) for i, _ in rows] + [(1, None, 1), (None, 1, 0), (999, 1, 0)], "doc_id long, quality int, toxic int")
    return spark.createDataFrame(rows, "doc_id long, text string"), labels


def test_edges(spark, small):
    docs, labels = small
    net = quality.fit(docs, labels)
    odd = spark.createDataFrame([(1, None, "a", 1), (2, "", "a", 1), (None, "BUY!! NOW!! " * 30, "a", 1), (3, "ok text here, fine. " * 20_000, "a", 1), (3, "ok text here, fine. " * 20_000, "a", 1)], "doc_id long, text string, score string, held_out int")
    got = quality.score(odd, net, F.lit(False)).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got) and math.isclose(got[0].score, got[1].score)
    assert next(r for r in got if r.doc_id is None).predicted == 0
    kept = quality.keep(odd, net)
    assert kept.columns == odd.columns and kept.where("doc_id = 3").count() == 2 and kept.where("doc_id is null").count() == 0
    assert quality.fit(docs, labels.limit(0)) is None
    assert [r.score for r in quality.score(docs.limit(2), None, F.lit(True)).collect()] == [0.5, 0.5]
    assert quality.score(docs.limit(0), net, F.lit(True)).count() == 0
    again = quality.fit(docs.repartition(7), labels)
    assert all(np.array_equal(net.w[k], again.w[k]) for k in net.w)


def plain_features(text):
    """The passages and their features from the definition, byte by byte and word by word."""
    import xxhash

    full, white = 2**64 - 1, b" \t\n\r\x0b\x0c"

    def mixed(x):
        for _ in range(2):
            x ^= x >> 32
            x = x * 0xD6E8FEB86659FD93 & full
        return x ^ x >> 32

    def kind(b):
        c = chr(b)
        tests = ["a" <= c <= "z", "A" <= c <= "Z", "0" <= c <= "9", b in white, c in ".,;:'\"-()", c in "!?", b < 128, True]
        return tests.index(True)

    raw = (text or "").encode()
    at, i = [], 0
    while i < len(raw):
        if raw[i] in white:
            i += 1
            continue
        j = i
        while j < len(raw) and raw[j] not in white:
            j += 1
        at.append((i, j))
        i = j
    if not at:
        return [[0.0] * quality.FEATURES]
    bags = [at[k : k + 64] for k in range(0, len(at), 64)]
    if len(bags) > 1 and len(bags[-1]) < 16:
        bags[-2:] = [bags[-2] + bags[-1]]
    out = []
    for k, bag in enumerate(bags):
        first = 0 if k == 0 else bag[0][0]
        part = raw[first : bags[k + 1][0][0] if k + 1 < len(bags) else len(raw)]
        kinds = [kind(b) for b in part]
        words = [raw[i:j].lower() for i, j in bag]
        n, size = len(words), [j - i for i, j in bag]
        shape = [kinds.count(c) / len(part) for c in range(8)]
        shape += [len(set(words)) / n, max(map(words.count, words)) / n, sum(a == b for a, b in zip(words, words[1:], strict=False)) / n]
        shape += [sum(size) / n / 10, sum(s <= 2 for s in size) / n, math.log1p(n) / 5, sum(s == 1 for s in size) / n]
        h = [xxhash.xxh3_64_intdigest(w) for w in words]
        hashed = [0.0] * quality.HASHED
        for x in h + [mixed((b + mixed(a)) & full) for a, b in zip(h, h[1:], strict=False)]:
            hashed[x % quality.HASHED] += -1 if x >> 63 else 1
        out.append([x / math.sqrt(n) for x in hashed] + shape)
    return out


def test_query_against_the_definition(spark):
    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    net = queries.quality_network(spark, docs, d)
    got = {r.doc_id: r.score for r in queries.op2_quality(spark, d).collect()}
    w = net.w
    for doc_id, text in docs.select("doc_id", "text").collect():
        total, weights = [], []
        for f in plain_features(text):
            e = np.tanh(((np.array(f) - net.mean) / net.scale) @ w["E"] + w["e"])
            weights.append(math.exp((np.tanh(e @ w["T"]) / (1 + np.exp(-(e @ w["S"])))) @ w["a"]))
            total.append(e)
        z = np.average(total, axis=0, weights=weights)
        assert math.isclose(got[doc_id], 1 / (1 + math.exp(-(z @ w["c"] + w["d"][0]))), rel_tol=1e-3, abs_tol=1e-4)
