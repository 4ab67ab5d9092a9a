from collections import defaultdict

import xxhash

from linkflow.llm import line_dedup, queries

FULL = 2**64 - 1


def spark_hash(text):
    x = xxhash.xxh64_intdigest(text.encode(), seed=42)
    return x - 2**64 if x >> 63 else x


def mixed(x):
    for _ in range(2):
        x ^= x >> 32
        x = x * 0xD6E8FEB86659FD93 & FULL
    return x ^ x >> 32


def plain_chunks(lines):
    """(first, end) by the rule: a chunk ends at a local maximum of the rolling hash."""
    h = [xxhash.xxh3_64_intdigest(x) for x in lines]
    roll = [mixed(h[i] ^ ((h[i - 1] if i else 0) << 1 & FULL)) for i in range(len(h))]
    out, first = [], 0
    for i in range(len(lines)):
        peak = 0 < i < len(lines) - 1 and roll[i - 1] < roll[i] > roll[i + 1]
        if peak or i + 1 == len(lines):
            out.append((first, i + 1))
            first = i + 1
    return out


def plain_passages(lines):
    """(first, end) of windows of 50 words from and to each line with words, and of chunks that count."""
    n = [len(x.split()) for x in lines]
    out = set()
    for i in range(len(lines)):
        if not n[i]:
            continue
        e = i
        while e < len(lines) and sum(n[i:e]) < 50:
            e += 1
        if sum(n[i:e]) >= 50:
            out.add((i, e))
        a = i
        while a >= 0 and sum(n[a : i + 1]) < 50:
            a -= 1
        if a >= 0:
            out.add((a, i + 1))
    for first, e in plain_chunks(lines):
        for a in (first, first + 1):
            if sum(x > 0 for x in n[a:e]) > 1:
                out.add((a, e))
    kept, start = [], {}
    for a, e in sorted(out):
        raw = b"\n".join(lines[a:e])
        if not 0 < a - start.setdefault(raw, a) < e - a:
            kept.append((a, e, raw))
    return kept


def brute(rows):
    """The plain version: all passages in the order of occurrences, compared as bytes."""
    order = {(d, t) for d, t in rows if t is not None}
    at = lambda d, t, a: (d is None, d or 0, spark_hash(t), a)
    found = {(d, t): plain_passages(t.encode().split(b"\n")) for d, t in order}
    first = {}
    for place, raw in sorted((at(d, t, a), raw) for (d, t), own in found.items() for a, _, raw in own):
        first.setdefault(raw, place)
    out = []
    for d, t in rows:
        if t is None:
            out.append((d, None, 0, 0))
            continue
        lines = t.encode().split(b"\n")
        drop = {i for a, e, raw in found[d, t] if first[raw] != at(d, t, a) for i in range(a, e)}
        keep = [x for i, x in enumerate(lines) if i not in drop]
        out.append((d, b"\n".join(keep).decode() if drop else t, len(lines), len(drop)))
    return sorted(out, key=str)


def test_edges(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    block = "\n".join(f"line {i} of a block that many documents share" for i in range(30))
    rows = [(1, f"a\n{passage}\nb"), (2, f"other start\nx\n{passage}"), (None, passage), (3, None), (4, ""), (5, f"own\n{block}\nend"), (6, f"{block}\nmore\nlines"), (6, f"{block}\nmore\nlines"), (7, "same\nsame\nsame\nsame"), (8, "x" * 200_000), (9, "\n" * 5000)]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, n_lines long")
    got = sorted((tuple(r) for r in line_dedup.dedup(df).collect()), key=str)
    assert got == brute(rows)
    text = defaultdict(list)
    for d, t, *_ in got:
        text[d].append(t)
    assert passage in text[1][0] and passage not in text[2][0] and text[None] == [""]
    assert block in text[5][0] and text[6][0].count("of a block") < 8
    assert line_dedup.dedup(df.limit(0)).count() == 0


def test_cuts_resist_shifts():
    lines = [f"line number {i} says {i * 7919 % 1000}".encode() for i in range(200)]
    whole = {raw for *_, raw in line_dedup.passages(lines)}
    shifted = {raw for *_, raw in line_dedup.passages([b"new line", *lines])}
    assert len(whole - shifted) <= 2


def test_short_chunks_go_and_rows_without_words_stay(spark):
    own = lambda k: "\n".join(f"own {k} {i}" for i in range(3))
    block = "\n".join(f"say {i}" for i in range(9))
    rows = [(1, f"{own(1)}\n{block}\n{own(2)}"), (2, f"{own(3)}\n{block}\n{own(4)}"), (3, f"{own(5)}\n\n\n\n\n{own(6)}"), (4, f"{own(7)}\n\n\n\n\n{own(8)}")]
    got = sorted((tuple(r) for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute(rows)
    assert got[1][3] >= 3 and [r[3] for r in got[2:]] == [0, 0]


def test_texts_behind_one_hash_are_told_apart(spark, monkeypatch):
    """With a hash of one bit, the bytes decide."""
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    df = spark.createDataFrame([(1, a), (2, b), (3, a), (4, b)], "doc_id long, text string")
    seen = line_dedup._occurrences

    def weak(batches):
        for x in seen(batches):
            yield x.set_column(4, x.schema.field(4), line_dedup.pa.array([b"0"] * x.num_rows, line_dedup.pa.binary()))

    monkeypatch.setattr(line_dedup, "_occurrences", weak)
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup(df).collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 1}


def test_query_against_plain_version(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in queries.op8_line_dedup(spark, d).collect()), key=str) == brute(rows)


def test_passages_go_whatever_stands_around_them(spark):
    """Short-lined passages of over 50 words leave no line in the second copy."""
    rows, parts = [], []
    for k, (n, size) in enumerate([(2, 29), (3, 19), (4, 15), (5, 12), (6, 10), (12, 8), (60, 1), (3, 26)] * 5):
        parts.append([" ".join(f"p{k}x{i}y{j}" for j in range(size)) for i in range(n)])
        for side in (0, 1):
            around = [[f"own {side} {k} {i} {j}" for i in range(3)] for j in "ab"]
            rows.append((2 * k + side, "\n".join(around[0] + parts[-1] + around[1])))
    got = {r.doc_id: r for r in line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, part in enumerate(parts):
        assert got[2 * k].text == rows[2 * k][1]
        assert got[2 * k + 1].n_removed == len(part) and got[2 * k + 1].text.count("own") == 6


def test_a_line_without_end_keeps_one_passage(spark):
    line = "one line of ten words that comes again and again"
    df = spark.createDataFrame([(1, "\n".join([line] * 100)), (2, "\n".join([line] * 40))], "doc_id long, text string")
    got = {r.doc_id: r for r in line_dedup.dedup(df).collect()}
    assert got[2].text == "" and got[2].n_removed == 40
    assert got[1].text.split("\n") == [line] * 5


def test_one_shared_line_of_under_fifty_words_stays(spark):
    shared = " ".join(f"w{i}" for i in range(41))
    df = spark.createDataFrame([(i, f"own {i} first\n{shared}\nown {i} last") for i in range(3)], "doc_id long, text string")
    assert {r.n_removed for r in line_dedup.dedup(df).collect()} == {0}
