"""Upserts by batch, and streams whose state equals the batch form."""

import pytest
from linkflow import schemas
from linkflow.operators import diff
from linkflow.settings import Settings
from linkflow.streaming import bundles, cascade, lifecycle
from linkflow.streaming.upsert import UpsertTable, newest_wins


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_a_batch_counts_once_and_a_dead_one_not_at_all(spark, tmp_path):
    table = UpsertTable(spark, f"{tmp_path}/t", "k string, v long")
    batch = lambda *r: spark.createDataFrame(list(r), "part string, k string, v long")
    merge = newest_wins(["part", "k"], "v")
    assert table.read().count() == 0
    assert table.apply(batch(("a", "x", 1), ("b", "y", 1)), 0, merge)
    assert not table.apply(batch(("a", "x", 9)), 0, merge)

    def dies(old, new):
        merge(old, new).write.parquet(f"{tmp_path}/t/data/a/b=000000000001")
        raise OSError("lost")

    with pytest.raises(OSError):
        table.apply(batch(("a", "x", 5)), 1, dies)
    assert rows(table.read(), "part", "k", "v") == [("a", "x", 1), ("b", "y", 1)]
    assert table.apply(batch(("a", "x", 5), ("a", "z", 2)), 1, merge)
    assert rows(table.read(), "part", "k", "v") == [("a", "x", 5), ("a", "z", 2), ("b", "y", 1)]
    assert rows(table.read(["b"]), "k") == [("y",)]
    # A part that loses all its rows is empty, others are not touched.
    assert table.apply(batch(("a", "x", 6)), 2, lambda old, new: old.limit(0))
    assert rows(table.read(), "part", "k") == [("b", "y")]
    assert UpsertTable(spark, f"{tmp_path}/t", "k string, v long").apply(batch(), 3, merge)


def test_a_bundle_survives_a_death_between_batches(spark, tmp_path):
    schema = "external_id string, title string, collected_at string, pos long"
    days = [[("a", "A1", "2026-08-01T01:00:00", 0), ("b", "B1", "2026-08-01T17:00:00", 1)], [("a", "A2", "2026-08-01T02:00:00", 0), ("c", "C1", "2026-08-01T03:00:00", 1), ("", "none", "2026-08-01T03:00:00", 2)]]

    def day(i, at):
        spark.createDataFrame(days[i], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        bundles.start(stream, at, f"{tmp_path}/check").awaitTermination()

    at = f"{tmp_path}/table"
    day(0, at)
    # The log of the batch is lost: it runs again, and leaves the same.
    whole = rows(bundles.table(spark, at, schema).read(), "day", "external_id", "title")
    for name in ("0", ".0.crc"):
        (tmp_path / "check/commits" / name).unlink()
    day(1, at)
    got = rows(bundles.table(spark, at, schema).read(), "day", "external_id", "title", "pos")
    assert whole == [("2026-08-01", "a", "A1"), ("2026-08-02", "b", "B1")]
    assert got == [("2026-08-01", "a", "A2", 0), ("2026-08-01", "c", "C1", 2), ("2026-08-02", "b", "B1", 1)]


def test_candidates_with_a_cap_equal_the_batch_form(spark, tmp_path):
    looks = [
        [("s", "a", "A", False), ("s", "b", "B", False), ("t", "x", "X", True)], [("s", "c", "C", True), ("s", "b", "", False), ("s", "d", "D", False)],
        [("s", "e", "E", False), ("s", "a", "A3", False), ("t", "y", "Y", True), ("u", "old", "O", False)], [("s", "d", "D4", True), ("u", "seen", "S", False)],
    ]
    schema = "source_id string, run long, url string, title string, selected boolean"
    seen = spark.createDataFrame([("u", "seen")], "source_id string, url string")
    ready = spark.createDataFrame([("u",)], "source_id string")
    empty = spark.createDataFrame([], schemas.CANDIDATE_STATE)
    first = lifecycle.initial_rows(empty.selectExpr("source_id", "url", "title", "1L as first_seen", "1L as last_seen", "baseline", "selected", "1L as last_selected"), seen, ready)
    state, known = empty, {"u"}
    for run, look in enumerate(looks, 1):
        df = spark.createDataFrame([(s, run, u, t, x) for s, u, t, x in look], schema)
        df.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
        lifecycle.start(stream, f"{tmp_path}/table", f"{tmp_path}/check", limit=3, initial=first).awaitTermination()
        old = spark.createDataFrame([(k,) for k in known], "source_id string")
        observed = df.selectExpr("source_id", "url", "title", "selected", "'llm' as selector")
        state = spark.createDataFrame(diff.update_candidates(state, observed, f"{run}", old, seen, Settings(candidate_cap=3)).collect(), state.schema)
        known |= {r[0] for r in look}
    columns = ("source_id", "url", "title", "first_seen", "last_seen", "baseline", "selected", "last_selected")
    want = rows(state.selectExpr("source_id", "url", "title", "cast(first_seen as long) first_seen", "cast(last_seen as long) last_seen", "baseline", "selected", "cast(last_selected as long) last_selected"), *columns)
    got = rows(lifecycle.table(spark, f"{tmp_path}/table").read(), *columns)
    assert got == want and len([r for r in got if r[0] == "s"]) == 3


def test_access_remembers_and_forgets(spark, tmp_path):
    schema = "source_id string, pos long, ok boolean, feed_url string, method string"
    tries = [("s", i, ok, f"f{i}", "rss") for i, ok in enumerate([True, False, False, False, False, True])]
    for part in (tries[:3], tries[3:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        cascade.start(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/table", f"{tmp_path}/check").awaitTermination()
    got = sorted((r.pos, r.streak, r.forget, r.resolved) for r in cascade.table(spark, f"{tmp_path}/table").read().collect())
    assert got == [(0, 0, False, "f0"), (1, 1, False, "f0"), (2, 2, False, "f0"), (3, 3, True, None), (4, 4, True, None), (5, 0, False, "f5")]


def test_state_in_buckets_is_not_shuffled(spark, tmp_path):
    from linkflow.sources import store
    from pyspark.sql import functions as F

    seen = spark.range(400).select(F.concat(F.lit("s"), F.col("id") % 7).alias("source_id"), F.concat(F.lit("u"), "id").alias("url"), *[F.lit(x).alias(c) for c, x in (("title", "t"), ("first_seen", "r1"), ("published_at", ""))], *[F.lit(None).cast("string").alias(c) for c in ("content_status", "content_sha256", "content_fetched_at")])
    store.write_buckets(seen, f"{tmp_path}/b")
    assert len(list((tmp_path / "b").glob("*.parquet"))) <= store.BUCKETS
    held = store.read_buckets(spark, f"{tmp_path}/b", schemas.SEEN)
    new = spark.range(390, 410).select(F.concat(F.lit("s"), F.col("id") % 7).alias("source_id"), F.concat(F.lit("u"), "id").alias("url"), F.lit("t2").alias("title"), F.lit("").alias("published_at"), F.lit("ok").alias("content_status"), F.lit("h").alias("content_sha256"), F.lit("n").alias("content_fetched_at"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh, after = diff.new_urls(new, held), diff.update_seen(held, new, "r2", Settings(seen_cap=50))
        for df in (fresh, after):
            lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
            at = next(i for i, x in enumerate(lines) if "FileScan" in x)
            # Above the scan of the state, up to the join, nothing is shuffled.
            depth = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
            above, d = [], depth(lines[at])
            for x in reversed(lines[:at]):
                if depth(x) < d:
                    above.append(x)
                    d = depth(x)
            above = above[: next(i for i, x in enumerate(above) if "Join" in x) + 1]
            assert not any("Exchange" in x for x in above), above
        assert fresh.count() == 10 and after.count() == 7 * 50
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = diff.update_seen(seen, new, "r2", Settings(seen_cap=50))
    assert rows(after, *after.columns) == rows(want, *after.columns)
