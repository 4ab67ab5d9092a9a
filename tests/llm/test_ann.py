import math

import numpy as np
from pyspark.sql import functions as F

from linkflow.llm import ann, queries


def brute(rows, k=20):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    ids, x = np.array([i for i, _ in ok]), np.stack([v for _, v in ok])
    out = {}
    for i, q in ok:
        if i % 20 == 0:
            s = (x * q).sum(1)
            keep = ids != i
            order = np.lexsort((ids[keep], -s[keep]))[:k]
            out[i] = list(zip(ids[keep][order].tolist(), s[keep][order].tolist(), strict=True))
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall_on_the_query(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want, got = brute(rows), found(queries.op4_ann(spark, d))
    assert got.keys() == want.keys()
    hit = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in want) / sum(map(len, want.values()))
    assert hit >= 0.9
    score = {q: dict(w) for q, w in want.items()}
    for q, hits in got.items():
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0])) and len(hits) == 20
        assert all(math.isclose(s, score[q][i], rel_tol=1e-12) for i, s in hits if i in score[q])


def test_edges(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=8).tolist()
    rows = [(i, rng.normal(size=8).tolist()) for i in range(1, 60)]
    rows += [(i, base) for i in range(100, 400)]  # one vector many times: ties by id
    rows += [(500, None), (501, []), (502, [0.0] * 8), (503, [float("nan")] * 8), (504, [1.0, None] + [0.0] * 6), (505, [float("inf")] * 8), (506, [1.0] * 7), (None, base), (520, [0.0] * 8)]
    df = spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<double>, score int")
    got, want = found(ann.search(df, F.col("vec_id") % 20 == 0, target=1.0)), brute([r for r in rows if r[0] != 506])
    assert got.keys() == want.keys()
    for q in want:
        if q >= 100:
            assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
    assert ann.search(df.limit(0), F.lit(True)).count() == 0
    few = ann.search(df.where("vec_id in (20, 40, 41)"), F.col("vec_id") % 20 == 0)
    assert {q: [i for i, _ in h] for q, h in found(few).items()} == {q: [i for i, _ in h] for q, h in brute([r for r in rows if r[0] in (20, 40, 41)]).items()}


def test_no_neighbour_is_missed_whatever_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ann, "RERANK", 10)
    monkeypatch.setattr(ann, "PROBE_LEAST", 2)
    rng = np.random.default_rng(3)
    g = rng.normal(size=(3000, 16))
    sets = {
        "sphere": g / np.linalg.norm(g, axis=1)[:, None], "lengths": g * np.exp(rng.normal(size=(3000, 1))), "large": g * 1e25,
        "clusters": rng.normal(size=(40, 16))[rng.integers(0, 40, 3000)] + 0.01 * g,
        "near copies": np.where(rng.random((3000, 1)) < 0.5, g[0] + 1e-4 * g, g),
        "queries elsewhere": np.where(np.arange(3000)[:, None] % 20 == 0, g * (np.arange(16) < 2), g * (np.arange(16) >= 1)),
    }
    for name, x in sets.items():
        rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
        got = found(ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, target=0.5))
        want = brute(rows)
        assert {q: [i for i, _ in h] for q, h in got.items()} == {q: [i for i, _ in h] for q, h in want.items()}, name
