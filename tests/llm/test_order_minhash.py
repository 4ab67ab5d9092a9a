import hashlib
import random
from collections import Counter

import pytest
import regex
import xxhash

from linkflow.llm import order_minhash as omh
from linkflow.llm import queries

SPACE = " \t\n\x0b\f\r"
IDEOGRAPH = "⺀-鿿豈-﫿\U00020000-\U0003ffff"
TOKENS = regex.compile(rf"[^{SPACE}{IDEOGRAPH}]{{1,32}}+[{SPACE}]*+|[{IDEOGRAPH}][{SPACE}]*+|[{SPACE}]++")


def chained(*parts):
    """Spark's xxhash64 over several values."""
    h = 42
    for x in parts:
        h = xxhash.xxh64_intdigest(x, seed=h)
    return h - 2**64 if h >> 63 else h


def number(v, size=8):
    return (v % 2 ** (8 * size)).to_bytes(size, "little")


def fingerprint(text):
    """From the definition: each sample sorts all numbered k-mers from its own point of the ring."""
    t = TOKENS.findall(text)
    assert "".join(t) == text
    kmers = [chained(*(x.encode() for x in t[i : i + omh.K])) >> 30 for i in range(max(len(t) - omh.K + 1, 1))]
    seen, ring = Counter(), []
    for place, kmer in enumerate(kmers):
        ring.append((chained(number(kmer), number(seen[kmer], 4)) >> 30, place))
        seen[kmer] += 1
    out = []
    for j in range(omh.SAMPLES):
        start = j * 2**34 // omh.SAMPLES - 2**33
        least = sorted(ring, key=lambda x: ((x[0] - start) % 2**34, x[1]))[:2]
        pair = [number(h) for h, _ in sorted(least, key=lambda x: x[1])]
        out.append(chained(*pair) % 2**64 >> 32)
    return ",".join(map(str, out))


def plain(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), chained((r[1] or "").encode()) % 2**64))
    texts = [r[1] or "" for r in order]
    prints = [fingerprint(t) for t in texts]
    like = lambda a, b: sum(x == y for x, y in zip(a.split(","), b.split(","), strict=True)) / omh.SAMPLES
    out = []
    for i, (r, text) in enumerate(zip(order, texts, strict=True)):
        n, half = (i + 1) % len(order), len(text) // 2
        edited = text[: len(text) - half] + texts[n][:half]
        f = fingerprint(edited)
        out.append((r[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), prints[i], f, like(prints[i], f), like(prints[i], prints[n])))
    return Counter(out)


rng = random.Random(5)
PROSE = [(i * 3, " ".join(rng.choice("alpha beta gamma delta epsilon".split()) for _ in range(rng.randrange(60)))) for i in range(60)]
CASES = {
    "empty": [],
    "one": [(1, "only one text here")],
    "odd": [(9, None), (8, ""), (7, "  "), (6, "x"), (5, "a b"), (None, "no id"), (None, None), (4, "日本語のテキスト 𠀀𠀁 é ü"), (3, "w" * 5000), (2, "same " * 3000), (-5, "tab\tand\nline")],
    "prose": PROSE,
    "ties": [(4, t) for _, t in PROSE[:20]] + [(4, "copy of it")] * 3,
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("leaf", [2, 1024])
def test_against_the_definition(spark, name, leaf):
    df = spark.createDataFrame([(*r, "x", 1) for r in CASES[name]], "doc_id long, text string, fingerprint string, copies int")
    assert Counter(map(tuple, omh.compare(df, leaf).collect())) == plain(CASES[name])


def test_order_counts(spark):
    words = [f"w{i}" for i in range(300)]
    turned = words[150:] + words[:150]
    other = words[:]
    random.Random(1).shuffle(other)
    rows = [(i, " ".join(w) + " ") for i, w in enumerate((words, words, turned, other))]
    got = {r.doc_id: r.fingerprint.split(",") for r in omh.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    like = lambda a, b: sum(x == y for x, y in zip(got[a], got[b], strict=True)) / omh.SAMPLES
    # The turned text has nearly all k-mers of the first, half of all pairs in the other order.
    assert like(0, 1) == 1.0 and 0.25 < like(0, 2) < 0.75 and like(0, 3) < 0.1


def test_query_against_the_definition(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert Counter(map(tuple, queries.op12_order_minhash(spark, d).collect())) == plain(rows)


def test_no_python_in_the_plan(spark):
    plan = queries.op12_order_minhash(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
