import hashlib
import re

from linkflow.llm import decontaminate, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(docs, items):
    out = []
    win = [(str(i), WORD.findall(lower(t))) for i, t in items]
    for d, t in docs:
        w, hit, found = WORD.findall(lower(t)), set(), set()
        for name, x in win:
            n = min(13, len(x))
            own = {tuple(x[k : k + n]) for k in range(len(x) - n + 1)} if n else set()
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in own:
                    hit.update(range(k, k + n))
                    found.add(name)
        names = sorted(found)
        out.append((d, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_edges(spark):
    long = " ".join(f"w{i}" for i in range(40))
    items = [(1, long), (2, "short ITEM é"), (3, None), (4, "...!"), (5, long), (10, "short item É")]
    docs = [(1, None), (2, ""), (3, "x " * 300 + long), (4, "a SHORT-item,é b"), (4, "a SHORT-item,é b"), (None, long.upper()), (6, " ".join(f"w{i}" for i in range(12))), (7, "word " * 30_000 + " ".join(f"w{i}" for i in range(5, 18)))]
    d = spark.createDataFrame([(*r, True) for r in docs], "doc_id long, text string, contaminated boolean")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in decontaminate.flag(d, b).drop("spans").collect()), key=str)
    assert got == brute(docs, items)
    bad = {r[0] for r in got if r[5]}
    assert sorted((r.doc_id for r in decontaminate.keep_clean(d, b).collect()), key=str) == sorted((r[0] for r in docs if r[0] not in bad), key=str)
    cut = {r.doc_id: r.text for r in decontaminate.keep_clean(d, b, remove="spans").collect()}
    assert cut[4] == "a  b" and cut[7] == docs[7][1] and cut[3] == "x " * 300
    assert decontaminate.flag(d, b.limit(0)).where("contaminated").count() == 0
    assert decontaminate.flag(d.limit(0), b).count() == 0


def test_query_against_brute_force(spark):
    d = "/root/testdata/sf0.001"
    read = lambda t, *c: [tuple(r) for r in spark.read.parquet(f"{d}/{t}.parquet").select(*c).collect()]
    want = brute(read("documents", "doc_id", "text"), read("benchmark", "item_id", "text"))
    assert sorted((tuple(r) for r in queries.op9_decontaminate(spark, d).collect()), key=str) == want
    assert any(r[5] for r in want)


def test_items_without_an_id_hit(spark):
    first, other = (" ".join(f"{c}{i}" for i in range(20)) for c in "vw")
    items = spark.createDataFrame([(None, first), (None, other), (7, other), (None, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, first), (2, f"{first} {other}"), (3, "clean " * 30)], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.flag(docs, items).collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert [(got[k].n_hit, got[k].n_items, got[k].items_sha256, got[k].contaminated) for k in (1, 2, 3)] == [(20, 1, sha(""), True), (40, 2, sha(",7"), True), (0, 0, sha(""), False)]
    assert [r.doc_id for r in decontaminate.keep_clean(docs, items).collect()] == [3]


def test_a_benchmark_in_parts_gives_the_same(spark):
    d = "/root/testdata/sf0.001"
    read = lambda t, *c: spark.read.parquet(f"{d}/{t}.parquet").select(*c)
    docs, items = read("documents", "doc_id", "text").limit(300), read("benchmark", "item_id", "text")
    extra = spark.createDataFrame([(None, None), (None, "a window without an id"), (9, "A window without, an id")], "item_id long, text string")
    docs = docs.union(spark.createDataFrame([(None, "xx a window without an id"), (5, None)], "doc_id long, text string")).cache()
    items = items.withColumn("item_id", items.item_id.cast("long")).union(extra)
    key = lambda df: sorted(map(str, df.collect()))
    assert key(decontaminate.flag(docs, items, part_bytes=2000)) == key(decontaminate.flag(docs, items))
    assert key(decontaminate.keep_clean(docs, items, part_bytes=2000)) == key(decontaminate.keep_clean(docs, items))
    assert key(decontaminate.keep_clean(docs, items, remove="spans", part_bytes=3000)) == key(decontaminate.keep_clean(docs, items, remove="spans"))


def test_items_of_one_repeated_window(spark):
    items = [(1, "la " * 5000), (2, "la " * 13), (3, "la la")]
    docs = [(1, "la " * 40), (2, "x la la y"), (3, "la")]
    got = decontaminate.flag(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r) for r in got.drop("spans").collect()), key=str) == brute(docs, items)


def test_an_item_beyond_a_part_is_cut_without_losing_a_window(spark):
    long = [f"w{i}" for i in range(400)]
    got = decontaminate.pieces(" ".join(long), 13, 100)
    assert len(got) > 10 and all(len(p.split()) >= 13 for p in got)
    assert {tuple(p.split()[i : i + 13]) for p in got for i in range(len(p.split()) - 12)} == {tuple(long[i : i + 13]) for i in range(388)}
    assert decontaminate.pieces("", 13, 9) == [] and decontaminate.pieces("only four words here", 13, 2) == ["only four words here"]
    docs = spark.createDataFrame([(i, " ".join(["x", *long[i : i + 13], "y"])) for i in range(0, 388, 7)] + [(1000, " ".join(long[5:17])), (1001, None)], "doc_id long, text string")
    items = spark.createDataFrame([("big", " ".join(long)), ("small", "x w7 w8")], "item_id string, text string")
    rows = lambda n: sorted(tuple(r) for r in decontaminate.flag(docs, items, part_bytes=n).drop("spans").collect())
    assert rows(400) == rows(1 << 20) and sum(r[5] for r in rows(400)) == len(range(0, 388, 7))
