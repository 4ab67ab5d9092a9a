"""Nearest neighbours by inverted file, product-quantised residuals and exact reranking.

Coarse centroids and residual codebooks are fitted by k-means on a bounded sample (``SAMPLE``
vectors, or ``LIST_SAMPLE`` a list if that is more; chosen by hash). Every vector is then indexed: its
centroid's list, and one byte per sub-space of its residual. A query probes the lists whose centroids
have the largest inner products with it; in each list, asymmetric distance tables (exact query,
quantised vectors) rank the entries, the best ``RERANK`` are reranked by the inner product of the
original vectors in double precision, and the lists' best are merged.

An exact check follows, so that no row is missed, whatever the vectors' lengths and spread. Within a
list, an entry's inner product is at most that of its quantised vector plus the length of the query
times the length of what the codes leave out: entries that by this bound may beat the k-th best are
weighed too. Then the k-th best of all probed lists is a threshold: every other list is asked whose
centroid's inner product, plus the query's length times the list's radius, reaches it. Lists and
entries within clusters are ruled out so; vectors without structure are in the end all compared.

How many lists a query probes is measured, not set: for some sample vectors as queries, the true
neighbours within the sample are found by brute force, and the least number of probes is taken that
reaches the lists of a share ``TARGET`` of them. Vectors in clusters need few lists; vectors without
structure (such as independent directions on a sphere) need most of them. The index is fitted and asked
in a scale (a power of two) in which no component is above 1, so large numbers do not overflow.

A list longer than ``PART`` is split, and so are the queries of a list; each pair of parts is one
task's work, so a list that holds a third of all vectors is shared out. A query's best of its lists
are merged by a bounded sum: each task keeps the best of what it has seen. Equal vectors have equal
codes, and ties are ordered by vec_id at every step.

Defined results: vectors that are null, zero, of another length than most, or hold null or
non-finite components take no part, and neither do rows with a null vec_id; rows that share a
query's vec_id are its own; with fewer candidates than asked for, all are returned;
an empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from linkflow.llm.common import batch, save

SAMPLE, LIST_SAMPLE = 20_000, 40
#: Lists: the square root of the number of vectors, at most so many (longer lists are split into parts).
MAX_LISTS = 4096
#: Share of true neighbours whose lists the probes must reach, measured with so many queries; least number of probes.
TARGET, TRIALS, PROBE_LEAST = 0.965, 400, 16
SUBSPACES, CODES = 16, 256
RERANK = 60
PART, QUERY_PART = 8192, 2048
#: Room for rounding, as a share of the greatest inner product there can be: of sums in single and in double precision.
ROOM, FINE_ROOM = 1e-5, 1e-12
#: Vectors that one batch of routed queries holds.
ROUTED = 1 << 15
NEIGHBOURS = 20


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, steps: int = 12) -> np.ndarray:
    """Lloyd's iterations from random distinct rows; empty clusters restart at a random row."""
    rows = np.unique(x, axis=0)
    if len(rows) <= k:
        return rows
    c = rows[rng.choice(len(rows), k, replace=False)]
    for _ in range(steps):
        at = _nearest(x, c)
        n = np.bincount(at, minlength=k)
        total = np.zeros_like(c)
        np.add.at(total, at, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], x[rng.integers(0, len(x), k)])
    return c


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c * c).sum(1) / 2
    return np.concatenate([np.argmax(x[i : i + 4096] @ c.T - half, axis=1) for i in range(0, len(x), 4096)]) if len(x) else np.zeros(0, np.int64)


class Index:
    """Coarse centroids and one codebook per sub-space; lists of at most MAX_LISTS * dimensions numbers."""

    def __init__(self, sample: np.ndarray, lists: int, subspaces: int = SUBSPACES, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.dim = sample.shape[1]
        self.cuts = np.unique(np.linspace(0, self.dim, min(subspaces, self.dim) + 1).astype(int))
        self.centroids = _kmeans(sample, lists, rng)
        rest = sample - self.centroids[_nearest(sample, self.centroids)]
        self.books = [_kmeans(rest[:, a:b], CODES, rng) for a, b in zip(self.cuts, self.cuts[1:], strict=False)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = _nearest(x, self.centroids)
        rest = x - self.centroids[cell]
        code = [_nearest(rest[:, a:b], book) for a, b, book in zip(self.cuts, self.cuts[1:], self.books, strict=False)]
        return cell, np.stack(code, 1).astype(np.uint8)

    def probes(self, q: np.ndarray, n: int) -> np.ndarray:
        return np.argsort(-(q @ self.centroids.T), axis=1, kind="stable")[:, :n]

    def enough(self, sample: np.ndarray, k: int, target: float) -> int:
        """The least number of probes that reach the lists of a share ``target`` of the sample's true neighbours."""
        lists = len(self.centroids)
        own = np.unique(np.linspace(0, len(sample) - 1, min(TRIALS, len(sample))).astype(int))
        cell, depth = _nearest(sample, self.centroids), []
        # The sample is thinner than the table: its neighbours are as near as the table's if fewer are taken.
        for i in range(0, len(own), 64):
            q = sample[own[i : i + 64]]
            near = q @ sample.T
            near[np.arange(len(q)), own[i : i + 64]] = -np.inf
            best = np.argpartition(-near, min(k, len(sample) - 1), axis=1)[:, :k] if len(sample) > 1 else np.zeros((len(q), 0), int)
            place = np.empty((len(q), lists), int)
            np.put_along_axis(place, self.probes(q, lists), np.broadcast_to(np.arange(lists), place.shape), 1)
            depth.append(np.take_along_axis(place, cell[best], 1).reshape(-1))
        depth = np.sort(np.concatenate(depth)) if depth else np.zeros(0, int)
        return min(lists, max(PROBE_LEAST, int(depth[min(len(depth) - 1, math.ceil(target * len(depth)))]) + 1 if len(depth) else lists))

    def ruled_in(self, q: np.ndarray, radius: np.ndarray, least: np.ndarray, done: int) -> np.ndarray:
        """Which lists beyond a query's first ``done`` may hold an inner product of ``least`` or more."""
        near, size = q @ self.centroids.T, np.sqrt((q * q).sum(1))[:, None]
        room = FINE_ROOM * size * (np.sqrt((self.centroids**2).sum(1)) + radius)
        out = near + size * radius + room >= least[:, None]
        np.put_along_axis(out, self.probes(q, done), False, 1)
        return out & (radius >= 0)

    def search(
        self, cell: int, code: np.ndarray, ids: np.ndarray, x: np.ndarray, qid: np.ndarray, q: np.ndarray, k: int, rerank: int = RERANK,
        least: np.ndarray | None = None, unit: float = 1.0
    ) -> list[tuple[np.ndarray, np.ndarray]]:
        """Per query the ids and exact scores of the best k of one part of a list, of those that reach ``least``.

        ``x`` and ``q`` are the original vectors, ``unit`` leads to the scale of the index.
        """
        order = np.argsort(ids, kind="stable")
        ids, code, x = ids[order], code[order], x[order]
        xs, qs = x * unit, q * unit
        # One row of all queries' table entries per code, so that a look-up copies a row.
        tables = [(book @ qs[:, a:b].T).astype(np.float32) for a, b, book in zip(self.cuts, self.cuts[1:], self.books, strict=False)]
        near = np.broadcast_to((qs @ self.centroids[cell]).astype(np.float32), (len(ids), len(q))).copy()
        for m, t in enumerate(tables):
            near += t[code[:, m]]
        near = np.ascontiguousarray(near.T)
        own = np.zeros(near.shape, bool)
        where = np.searchsorted(ids, qid)
        for i in np.flatnonzero(where < len(ids)):
            own[i, where[i] : np.searchsorted(ids, qid[i], "right")] = True
        near[own] = -np.inf
        tops, take = [], min(rerank + 1, len(ids))
        kth = np.full(len(q), -np.inf)
        for i in range(len(q)):
            row = near[i]
            if take < len(ids):
                # All that tie with the last one taken are weighed, in the order of their ids.
                cut = np.partition(row, len(ids) - take)[len(ids) - take]
                top = np.flatnonzero(row > cut)
                top = np.concatenate((top, np.flatnonzero(row == cut)[: take - len(top)]))
            else:
                top = np.arange(len(ids))
            top = top[~own[i, top]]
            exact = (x[top] * q[i]).sum(1)
            if len(top) >= k:
                kth[i] = np.partition(exact, len(top) - k)[len(top) - k] * unit * unit
            tops.append((top, exact))
        if least is not None:
            kth = np.maximum(kth, least)
        if take < len(ids):
            # What the codes leave out bounds what the quantised vectors may hide.
            kept = self.centroids[cell] + np.concatenate([book[code[:, m]] for m, book in enumerate(self.books)], 1)
            lost, size = np.sqrt(((xs - kept) ** 2).sum(1)), np.sqrt((qs * qs).sum(1))[:, None]
            reach = size * (np.sqrt((kept * kept).sum(1)) + np.sqrt((self.centroids[cell] ** 2).sum()) + lost)
            may = (near + size * lost + ROOM * reach >= kth[:, None]) & ~own
            for i, (top, _) in enumerate(tops):
                may[i, top] = False
            at = np.flatnonzero(may.any(0))
            if len(at):
                may[:, at] &= qs @ xs[at].T >= kth[:, None] - FINE_ROOM * reach[:, at]
            for i in np.flatnonzero(may.any(1)):
                more = np.flatnonzero(may[i])
                tops[i] = np.concatenate((tops[i][0], more)), np.concatenate((tops[i][1], (x[more] * q[i]).sum(1)))
        out = []
        for top, exact in tops:
            best = np.lexsort((ids[top], -exact))[:k]
            out.append((ids[top][best], exact[best]))
        return out


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors that take part; v keeps single precision, other numbers are made double."""
    kind = vectors.schema["embedding"].dataType.elementType
    v = F.col("embedding").cast("array<float>" if isinstance(kind, FloatType) else "array<double>")
    fine = F.col("vec_id").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    out = vectors.where(F.col("embedding").isNotNull()).where(fine).select(F.col("vec_id").cast("long"), v.alias("v"))
    size = out.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return out.where(F.size("v") == (size.d if size else 0))


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def search(vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS, target: float = TARGET) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the nearest by inner product, for the rows that ``is_query``."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    n, top = rows.agg(F.count("*"), F.max(F.array_max(F.transform("v", F.abs)))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    unit = 2.0 ** -max(-500, math.frexp(top)[1])
    u = F.pmod(F.xxhash64("vec_id", F.lit("ann")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    lists = min(MAX_LISTS, max(1, round(math.sqrt(n))))
    sample = rows.where(u * n < max(SAMPLE, LIST_SAMPLE * lists)).orderBy("vec_id").toArrow()
    sample = unit * (_matrix(sample.column("v")) if sample.num_rows else _matrix(rows.limit(1).toArrow().column("v")))
    index = Index(sample, lists)
    shared = spark.sparkContext.broadcast(index)
    # The table's k best, counted within the thinner sample.
    probes = index.enough(sample, max(1, math.ceil(k * len(sample) / n)), target) if target < 1 else len(index.centroids)
    vector = rows.schema["v"].dataType.simpleString()
    own = pa.list_(pa.float32() if "float" in vector else pa.float64())
    entry = pa.schema([("cell", pa.int32()), ("vec_id", pa.int64()), ("v", own), ("code", pa.binary()), ("away", pa.float64())])

    def encode(batches):
        for b in batches:
            x = unit * _matrix(b.column(1))
            cell, code = shared.value.encode(x)
            away = np.sqrt(((x - shared.value.centroids[cell]) ** 2).sum(1))
            yield batch(entry, cell.astype(np.int32), b.column(0), b.column(1).cast(own), [c.tobytes() for c in code], away)

    entries = save(rows.mapInArrow(encode, f"cell int, vec_id long, v {vector}, code binary, away double"), "ann-index")
    asked = pa.schema([("cell", pa.int32()), ("qid", pa.int64()), ("q", own), ("least", pa.float64())])
    hits = pa.schema([("query_id", pa.int64()), ("hits", pa.list_(pa.struct([("score", pa.float64()), ("vec_id", pa.int64())])))])

    def scan(t, asked):
        if not t.num_rows or not asked.num_rows:
            return hits.empty_table()
        code = np.frombuffer(b"".join(t.column("code").to_pylist()), np.uint8).reshape(t.num_rows, -1)
        qid, q, least = asked.column("qid").to_numpy(), _matrix(asked.column("q")), asked.column("least").to_numpy()
        x, ids, cell = _matrix(t.column("v")), t.column("vec_id").to_numpy(), t.column("cell")[0].as_py()
        out = []
        for i in range(0, len(q), 256):
            out += shared.value.search(cell, code, ids, x, qid[i : i + 256], q[i : i + 256], k, least=least[i : i + 256], unit=unit)
        size = np.cumsum([0, *[len(a) for a, _ in out]]).astype(np.int32)
        flat = pa.StructArray.from_arrays([pa.array(np.concatenate([s for _, s in out])), pa.array(np.concatenate([a for a, _ in out]))], names=["score", "vec_id"])
        return pa.table([pa.array(qid), pa.ListArray.from_arrays(pa.array(size), flat)], schema=hits)

    def look(asks: DataFrame, choose) -> DataFrame:
        """(query_id, score, vec_id) of what the lists hold that ``choose(index, vectors, least)`` takes for queries (qid, q, least)."""

        def route(batches):
            for b in batches:
                step = max(1, ROUTED // len(shared.value.centroids))
                for i in range(0, b.num_rows, step):
                    part = b.slice(i, step)
                    at, to = choose(shared.value, unit * _matrix(part.column(1)), part.column(2).to_numpy(zero_copy_only=False) * unit * unit)
                    t = part.take(pa.array(at))
                    yield batch(asked, to.astype(np.int32), t.column(0), t.column(1).cast(own), t.column(2).to_numpy(zero_copy_only=False) * unit * unit)

        queries = asks.mapInArrow(route, f"cell int, qid long, q {vector}, least double")
        # Parts per list: two numbers for each of at most MAX_LISTS lists.
        parts = entries.groupBy("cell").agg(F.ceil(F.count("*") / PART).cast("int").alias("parts"))
        sizes = F.broadcast(parts.join(queries.groupBy("cell").agg(F.ceil(F.count("*") / QUERY_PART).cast("int").alias("qparts")), "cell"))
        every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        left = entries.join(sizes, "cell").select(
            "cell", F.pmod(F.xxhash64("vec_id"), "parts").cast("int").alias("part"), every("qparts").alias("qpart"), "vec_id", "v", "code"
        )
        right = queries.join(sizes, "cell").select(
            F.col("cell").alias("qcell"), every("parts").alias("rpart"),
            F.pmod(F.xxhash64("qid", F.lit(1)), "qparts").cast("int").alias("rqpart"), "qid", "q", "least"
        )
        found = left.groupBy("cell", "part", "qpart").cogroup(right.groupBy("qcell", "rpart", "rqpart")).applyInArrow(
            scan, "query_id long, hits array<struct<score:double,vec_id:long>>"
        )
        hit = F.col("hit")
        return found.select("query_id", F.explode("hits").alias("hit")).select("query_id", hit["score"].alias("score"), hit["vec_id"].alias("vec_id"))

    def best(found: DataFrame) -> DataFrame:
        # Each task first keeps its own best; the best of the lists' parts are at most k rows each.
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    def probed(index, q, least):
        to = index.probes(q, probes)
        return np.repeat(np.arange(len(q)), to.shape[1]), to.reshape(-1)

    asks = rows.where(is_query).select(F.col("vec_id").alias("qid"), F.col("v").alias("q"))
    first = best(look(asks.withColumn("least", F.lit(float("-inf"))), probed))
    if probes >= len(index.centroids):
        return first
    first = save(first, "ann-first")
    # One number for each of at most MAX_LISTS lists; -1: no rows.
    radius = np.full(len(index.centroids), -1.0)
    for r in entries.groupBy("cell").agg(F.max("away").alias("away")).collect():
        radius[r.cell] = r.away
    kth = first.where(F.col("rank") == k).select(F.col("query_id").alias("qid"), F.col("score").alias("least"))
    rest = asks.join(kth, "qid", "left").select("qid", "q", F.coalesce("least", F.lit(float("-inf"))).alias("least"))
    checked = look(rest, lambda index, q, least: np.nonzero(index.ruled_in(q, radius, least, probes)))
    return best(first.select("query_id", "score", "vec_id").unionByName(checked.select("query_id", "score", "vec_id")))
