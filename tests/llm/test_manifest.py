import hashlib
import zlib
from collections import Counter

import duckdb
import pytest

from linkflow.llm import manifest, queries, ranks
from linkflow.llm.common import id_crc, save

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, idx int"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """The root of a list of digests, and each one's siblings (before, after) level by level."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i in range(len(nodes)):
            run, place = divmod(at[i], 16)
            kids = level[run * 16 : run * 16 + 16]
            paths[i].append(("".join(kids[:place]), "".join(kids[place + 1 :])))
            at[i] = run
        level = [digest(*level[j : j + 16]) for j in range(0, len(level), 16)]
    return level[0], paths


def plain(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: digest(*map(field, (r[0], r[3], r[2], r[4], text)))
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r)
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    members = {s: sorted(by[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1]))) for s in order}
    trees = {s: tree([leaf(r, r[1]) for r in members[s]]) for s in order}
    out = []
    if order:
        root, above = tree([trees[s][0] for s in order])
        for s, top in zip(order, above, strict=True):
            for r, path in zip(members[s], trees[s][1], strict=True):
                path, text = path + top, r[1]
                if text is not None and zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 5 == 0:
                    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
                x = leaf(r, text)
                for a, b in path:
                    x = digest(a, x, b)
                out.append((r[0], leaf(r, r[1]), trees[s][0], root, digest(*[a + b for a, b in path]), x, x == root))
    return Counter(out)


CASES = {
    "empty": [],
    "one": [(5, "A", None, "s", 1)],
    "sources": [(i, f"Text {i}", "de", f"s{i}", None) for i in range(40)],
    "hot": [(i * 7 - 900, f"Text É {i}" * (i % 5), "de", "hot" if i % 3 else None, i) for i in range(900)] + [(None, None, None, "", None), (3, "", "x", "", 0), (10**17, "Z" * 9000, "é", "ü", 1)],
    "copies": [(4, "Same", "de", "s", 4)] * 700 + [(4, f"Other{i % 3}", "de", "s", 4) for i in range(20)] + [(None, f"T{i}", "de", "s", 4) for i in range(300)],
}


@pytest.mark.parametrize("name", CASES)
def test_against_plain_trees(spark, name):
    rows = CASES[name]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = manifest.prove(df, id_crc() % 5 == 0, manifest.lowered())
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert Counter(map(tuple, got.collect())) == plain(rows)


def test_untouched_documents_verify(spark):
    df = spark.createDataFrame([(*r, "x", 1) for r in CASES["hot"]], SCHEMA)
    assert manifest.prove(df).where("NOT verified").count() == 0


def test_query_against_sql(spark):
    d = "/root/testdata/sf0.001"
    c = duckdb.connect()
    c.sql(f"create view documents as select * from '{d}/documents.parquet'")
    want = c.sql(queries.oracle_sql()["op11_manifest"])
    got = queries.op11_manifest(spark, d)
    assert got.columns == want.columns
    assert Counter(map(tuple, got.collect())) == Counter(want.fetchall())


@pytest.mark.parametrize("leaf", [4, 256])
def test_ranks_are_places_in_the_sorted_group(spark, leaf):
    keys = [("a", i * i % 5003) for i in range(700)] + [("b", v) for v in (-(2**63), -1, 0, 2**63 - 1, None)] + [("c", 1)] * 9
    rows = spark.createDataFrame(keys, "g string, v long")
    rows = save(rows.withColumn("key", ranks.hex_key(rows.v)), "ranks-test")
    got = ranks.ranked(rows, ["g"], "key", leaf).collect()
    want = Counter()
    for g in "abc":
        own = sorted((v for x, v in keys if x == g), key=lambda v: (v is not None, v or 0))
        want.update((g, v, i, len(own)) for i, v in enumerate(own))
    assert Counter((r.g, r.v, r.idx, r.total) for r in got) == want


def test_running_sums_over_levels(spark):
    rows = spark.range(1000).selectExpr("id % 2 as g", "id div 2 as idx", "id as x")
    got = ranks.running_sums(rows, ["g"], rows.x, leaf_bits=2).collect()
    assert {(r.g, r.idx): int(r.running) for r in got} == {(g, i): sum(2 * j + g for j in range(i + 1)) for g in (0, 1) for i in range(500)}
