import hashlib
import math
from collections import Counter

import duckdb
import pytest

from linkflow.llm import mixing, queries


def plain(rows, weights=None, seed=mixing.SEED):
    """The counts by inversion, from the definition."""
    n = Counter(s for _, s in rows)
    w = {s: weights.get(s, 0.0) if weights is not None else math.sqrt(k) for s, k in n.items()}
    out = Counter()
    for d, s in rows:
        mean = w[s] * len(rows) / (sum(w.values()) * n[s]) if sum(w.values()) else 0.0
        parts = max(1, math.ceil(mean / mixing.PART))
        for j in range(1, parts + 1):
            u = (int(hashlib.md5(f"{seed}|{'' if d is None else d}|{j}".encode()).hexdigest()[:12], 16) + 0.5) / 2**48
            p = c = math.exp(-mean / parts)
            k = 0
            while c <= u and k < mixing.TERMS:
                k += 1
                p *= mean / parts / k
                c += p
            out[d, s] += k + (c <= u)
    return Counter({k: v for k, v in out.items() if v})


ROWS = [(i, "hot") for i in range(400)] + [(1000 + i, "rare") for i in range(3)] + [(2000 + i, None) for i in range(40)] + [(3000, ""), (None, "rare"), (7, "dup"), (7, "dup")]


@pytest.mark.parametrize("weights", [None, {"hot": 1.0, "rare": 3.0, None: 1.0}])
def test_counts_follow_the_definition(spark, weights):
    df = spark.createDataFrame([(d, None if i % 5 == 0 else "t" * (i % 3), s, 9, "x") for i, (d, s) in enumerate(ROWS)], "doc_id long, text string, source string, copy int, extra string")
    got = mixing.replicate(df, weights).collect()
    assert Counter((r.doc_id, r.source) for r in got) == plain(ROWS, weights)
    keys = [(r.shuffle_key, r.doc_id or 0, r.copy) for r in got]
    assert keys == sorted(keys)
    assert mixing.replicate(df.limit(0), weights).count() == 0


def test_shares_meet_the_targets(spark):
    df = spark.createDataFrame([(i, "a" if i % 10 else "b") for i in range(6000)], "doc_id long, source string")
    got = Counter(r.source for r in mixing.replicate(df, {"a": 1.0, "b": 1.0}, output_rows=4000).collect())
    assert abs(got["a"] - 2000) < 200 and abs(got["b"] - 2000) < 200


def test_query_against_sql(spark):
    d = "/root/testdata/sf0.001"
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{d}/documents.parquet'")
    want = c.sql(queries.oracle_sql()["op3_mixing"])
    got = queries.op3_mixing(spark, d)
    at = [want.columns.index(x) for x in got.columns]
    assert Counter(map(tuple, got.collect())) == Counter(tuple(r[i] for i in at) for r in want.fetchall())


def test_no_python_in_the_plan(spark):
    plan = queries.op3_mixing(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
