import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkflow.llm import ppm, queries

ORDER = 6


class Trie:
    """Plain PPM (method D, exclusion), written for the tests alone: one dictionary of dictionaries."""

    def __init__(self, order=ORDER):
        self.order, self.seen = order, defaultdict(lambda: defaultdict(int))

    @staticmethod
    def spelled(text):
        out = b""
        for ch in (text or "").encode("utf-8", "replace"):
            out += bytes([ch + 32 if 65 <= ch <= 90 else ch])
        words = [w for w in out.replace(b"\t", b" ").replace(b"\n", b" ").replace(b"\x0b", b" ").replace(b"\x0c", b" ").replace(b"\r", b" ").split(b" ") if w]
        return b"".join(w + b" " for w in words) + b"\n", [*words, None]

    def steps(self, text):
        s = b"\n" * self.order + self.spelled(text)[0]
        return [(s[i - self.order : i], s[i]) for i in range(self.order, len(s))]

    def learn(self, text):
        for before, x in self.steps(text):
            for start in range(self.order + 1):
                self.seen[before[start:]][x] += 1

    def code(self, before, x):
        gone, log = set(), 0.0
        for start in range(self.order + 1):
            here = {s: n for s, n in self.seen.get(before[start:], {}).items() if s not in gone}
            whole = 2 * sum(here.values())
            if x in here:
                return log + math.log10((2 * here[x] - 1) / whole)
            if here:
                log += math.log10(len(here) / whole)
                gone.update(here)
        return log - math.log10(256 - len(gone))

    def score(self, text):
        return sum(self.code(*s) for s in self.steps(text))


def brute(rows, held=None, order=ORDER):
    held = held or (lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0)
    count, model = Counter(), Trie(order)
    for d, x in rows:
        if not held(d):
            count.update(Trie.spelled(x)[1])
            model.learn(x)
    total, kinds = sum(count.values()), len(count)
    for d, x in rows:
        w = Trie.spelled(x)[1]
        base = sum(math.log10((count[t] + 0.1) / (total + 0.1 * (kinds + 1))) for t in w)
        yield d, held(d), len(w), sum(count[t] > 0 for t in w), total, base, model.score(x)


def same(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[6], 3))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], rtol=1e-6), (a, b)


TEXT = st.lists(st.text(alphabet="abA", min_size=1, max_size=5), max_size=12).map(" ".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(TEXT, st.booleans()), min_size=1, max_size=6), st.integers(0, 6), st.integers(2, 7), st.randoms())
def test_ranges_equal_the_trie(texts, cuts, order, random):
    """Windows cut into ranges anywhere, and boundary nodes summed over ranges, cost what the trie says."""
    model = Trie(order)
    for t, held in texts:
        if not held:
            model.learn(t)
    keys, counts = [], []
    for t, held in texts:
        k, n = np.unique(ppm.windows([ppm.normal(t)], order), return_counts=True)
        keys.append(k)
        counts.append(n * (not held))
    w, n = ppm.summed(keys, counts)
    bounds = np.unique(np.array(random.sample(w.tolist(), min(cuts, len(w))), np.uint64))
    edge = [0, *np.searchsorted(w, bounds).tolist(), len(w)]
    parts = [(w[a:b], n[a:b]) for a, b in zip(edge, edge[1:], strict=False)]
    found = defaultdict(Counter)
    for i, (x, c) in enumerate(parts):
        for k, e, m in ppm.borders(i, x, c, bounds, order):
            found[k].update(dict(zip(e.tolist(), m.tolist(), strict=True)))
            for one, zero in zip(e.tolist(), m.tolist(), strict=True):
                found[k].setdefault(one, zero)
    one = np.zeros(1 << 16, np.int64)
    for e, m in found[1].items():
        one[e] = m
    border = {k: (np.array(sorted(found[k]), np.uint64), np.array([found[k][e] for e in sorted(found[k])], np.int64)) for k in range(2, order + 1)}
    cost = np.concatenate([ppm.costs(x, c, order, one.reshape(256, 256), border) if len(x) else np.zeros(0) for x, c in parts])
    for t, _ in texts:
        got = cost[np.searchsorted(w, ppm.windows([ppm.normal(t)], order))]
        assert np.allclose(got, [model.code(*s) for s in model.steps(t)])


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=300, unique=True), st.randoms())
def test_lookup(keys, random):
    table = ppm.Lookup(np.array(keys, np.uint64))
    asked = [random.choice(keys) for _ in range(500)]
    assert np.array(keys, np.uint64)[table.at[table(np.array(asked, np.uint64))]].tolist() == asked


def test_symbol_probabilities_add_up_to_one():
    model = ppm.Ppm()
    for t in ("the then", "that", "a the"):
        model.learn(t)
    for context in (b"the the", b"\n" * 6, b"zzzzzz", b"t the "):
        assert math.isclose(sum(10 ** model.symbol(context[-6:], s) for s in range(256)), 1)


def test_the_model_in_memory_equals_the_plain_trie():
    own, plain = ppm.Ppm(), Trie()
    for t in ("the cat sat", "on the mat", None, "The cat"):
        own.learn(t)
        plain.learn(t)
    for t in ("the cat sat on the mat", "unseen \x1c ü", "", None):
        assert math.isclose(own.score(t), plain.score(t))


def test_adaptive_learns_within_a_text():
    assert ppm.adaptive("abc " * 50) > ppm.adaptive(" ".join(chr(97 + i % 26) + chr(97 + i * 7 % 26) + "c" for i in range(50)))
    assert math.isclose(ppm.adaptive(None), -math.log10(256))
    model, total = Trie(), 0.0
    for before, x in model.steps("abab cab ab"):
        total += model.code(before, x)
        for start in range(7):
            model.seen[before[start:]][x] += 1
    assert math.isclose(ppm.adaptive("abab cab ab"), total)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, "A b\x1cb\tB"), (3, "A b\x1cb\tB"), (None, "naïve é"), (4, "word " * 40_000), (5, "unseen" * 3000), (19, "the held out ü \x00"), (30, "x")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, score int")
    same(ppm.pretrained(df, queries.id_crc() % 10 == 0, block_bytes=50).collect(), brute(rows))
    same(ppm.pretrained(df, queries.id_crc() % 10 == 0, order=3, range_bytes=2000).collect(), brute(rows, order=3))
    assert ppm.pretrained(df.limit(0), F.lit(False)).count() == 0
    assert math.isclose(ppm.pretrained(df.where("doc_id = 30"), F.lit(True)).first().score, -3 * math.log10(256), rel_tol=1e-6)


def test_query_against_the_trie(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op5_ppm(spark, d).collect()
    same(got, brute(rows))


def test_the_model_beats_single_words(spark):
    held = queries.op5_ppm(spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_word_order_matters(spark):
    """The same token costs less behind the word it follows in training than behind another."""
    rows = [(k, f"x{k} new york y{k} old paris z{k}") for k in range(40)] + [(100, "a old york"), (101, "a new york")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in ppm.pretrained(df, F.col("doc_id") >= 100).collect()}
    assert got[101].base_score == got[100].base_score and got[101].score > got[100].score + 1
    same(got.values(), brute(rows, held=lambda d: d >= 100))
