import random
from collections import defaultdict

import pytest

from linkflow.llm import jaccard, queries


def brute(rows, k=3, percent=90):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    holds = defaultdict(list)
    for i, s in enumerate(sets):
        shared = defaultdict(int)
        for x in s:
            for j in holds[x]:
                shared[j] += 1
            holds[x].append(i)
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                up[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d, len(s), low.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def corpus(seed, groups=25, size=8, words=60):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(4000)}" for _ in range(words)]
        for _ in range(rng.randrange(1, size)):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(9)}"
            rows.append(" ".join(w))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("seed", "k", "percent"), [(1, 3, 90), (2, 5, 80)])
def test_random_groups(spark, seed, k, percent):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r)[:3] for r in jaccard.groups(df, k, percent).collect()), key=str)
    want = brute(rows, k, percent)
    assert got == want
    if k == 5:
        assert sorted(r.doc_id for r in jaccard.keep_one(df, k, percent).collect()) == sorted({c for _, _, c in want})


def test_one_hot_group_and_chain(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SALT_ROWS", 7)
    rng = random.Random(5)
    base = [f"h{i}" for i in range(120)]
    rows = []
    for i in range(150):
        w = list(base)
        for _ in range(rng.randrange(1, 5)):
            w[rng.randrange(120)] = f"z{i}"
        rows.append((i, " ".join(w)))
    # A chain: each links with the next only.
    rows += [(1000 + i, " ".join(f"c{j}" for j in range(3 * i, 3 * i + 80))) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r)[:3] for r in jaccard.groups(df, 3, 90).collect()), key=str) == brute(rows)


def test_edges(spark):
    long = " ".join(f"v{i}" for i in range(50_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE TWO"), (8, "a b c d"), (8, "a b c d"), (8, "other text here"), (None, "a b c d"), (None, "lonely null text"), (9, long), (10, long + " tail"), (11, None)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, g long, comp int")
    assert sorted((tuple(r)[:3] for r in jaccard.groups(df, 3, 90).collect()), key=str) == brute(rows)
    kept = sorted(((r.doc_id, r.text) for r in jaccard.keep_one(df, 3, 90).collect()), key=str)
    assert kept == sorted([(1, None), (2, ""), (3, " \n"), (11, None), (6, "one two"), (8, "a b c d"), (8, "other text here"), (None, "lonely null text"), (9, long), (4, "One")], key=str)
    assert jaccard.groups(df.limit(0), 3, 90).count() == 0 and jaccard.keep_one(df.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in queries.op7_jaccard(spark, d).collect()), key=str) == brute(rows)


def templated(seed, n, slots=24):
    """Texts of one template with two choices a slot: dense regions of documents that mostly do not link."""
    rng = random.Random(seed)
    fixed = [[f"t{i}{x}" for x in "abcd"] for i in range(slots)]
    return [(k, " ".join(w for i in range(slots) for w in (*fixed[i], f"c{i}{rng.randrange(2)}"))) for k in range(n)]


def counting(monkeypatch):
    """Counts the pairs that are compared by their texts."""
    compared, verify = [], jaccard._verify

    def counted(pairs, *more):
        compared.append(pairs.count())
        return verify(pairs, *more)

    monkeypatch.setattr(jaccard, "_verify", counted)
    return compared


@pytest.mark.parametrize(("chunk", "share"), [(4000, 0.2), (40, 1.0)])
def test_dense_regions_are_cut_by_pivot_distances(spark, monkeypatch, chunk, share):
    """The recursion finds what brute force finds, far from comparing all pairs."""
    rows, compared = templated(3, 400), counting(monkeypatch)
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r)[:3] for r in jaccard.groups(df, 3, 90).collect()), key=str) == brute(rows, 3, 90)
    assert sum(compared) < share * 400 * 399 / 2, compared


@pytest.mark.parametrize("chunk", [4000, 12])
def test_rings_separate_clusters_and_leave_the_rest_whole(spark, monkeypatch, chunk):
    """Regions of several clusters, with members at equal distances from each other, end and are exact."""
    monkeypatch.setattr(jaccard, "SMALL", 2)
    monkeypatch.setattr(jaccard, "CHUNK", chunk)
    shared = " ".join(f"s{i}" for i in range(40))
    rows = [(k, f"{shared} " + " ".join(f"o{k}x{i}" for i in range(9))) for k in range(40)]
    rows += [(100 + k, f"{shared} " + " ".join(f"o{k}x{i}" for i in range(8))) for k in range(0, 40, 4)]
    rows += [(200 + k, f"{shared} " + " ".join(f"o{k % 5}y{i}" for i in range(30)) + f" z{k}") for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r)[:3] for r in jaccard.groups(df, 2, 93).collect()), key=str) == brute(rows, 2, 93)
