"""Exact n-gram Jaccard join in metric space, and the groups it forms.

Documents are sets of word shingles under the Jaccard distance, a metric. Two link if their
distance is at most eps = 1 - threshold.

*First pivots: shingles.* The set of one shingle s is at distance 1 - 1/n from a document of n
shingles that holds s, and at distance 1 from every other. So each document lies on the border of
the Voronoi regions of all its shingles, and the window of eps around it decides how many regions it
must be copied to: a partner may lack at most n - ceil(threshold * n) of its shingles, so one more
than that many suffice. All documents rank the shingles alike, rare ones first (by a count sketch of
fixed size), so that common passages make no regions; and a pair that first meets at the i-th
shingle of one and the j-th of the other can share no more than what stands behind, which must be
enough.

*Second pivots: documents.* A region's first pivot is the document with the fewest rarer shingles;
all members that it can link with are compared with it by their whole texts, which mostly makes the
region one group, and pairs within one group need no comparison. A region that still holds several
groups is joined again. Where few members (``SMALL``) are outside its largest group, these meet all
others. Else about ``PIVOTS`` members, the same ones in regions that overlap, become pivots, and the
distances of all members to them are worked out. By the triangle inequality, partners' distances to
each pivot differ by at most eps. A region of more than ``CHUNK`` members is cut into rings around the
pivots that separate it best: a member is at home in one ring of each, and is copied, as a guest, to
each other ring that its window of eps reaches; what lies in the same rings is a region again, and is
joined recursively. A smaller region, or one that rings do not separate, is sorted by its distances
to one pivot; a member meets those in its window, if the distances to all other pivots, sizes and
places allow a link, and only such pairs are compared by their texts. Pairs within one group need no
comparison, as a group's links stay its links. Nothing is cut off: each pair of different texts that
can link and is not yet in one group is compared.

Equal sets (by a 128-bit digest) are one class from the start, so copies are never expanded. Hot
pivots are salted; tables by region or shingle are reduced before they are dealt, and joins with
them are broadcasts of a checked size or sort-merge joins, whose hot keys Spark splits.

Defined results: null, empty or white text has no shingles, links with nothing and is its own
component; a text shorter than a shingle is one shingle; documents with null doc_id take part, and
a component of nothing but null ids has a null id; equal doc_ids are one component only if their
texts link; extra columns are not carried (``links``) or kept (``keep_one``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from linkflow.llm.common import batch, release, save, shingle_hashes, trimmed, word_hashes

SHINGLE, PERCENT = 5, 80
#: Counters of the sketch (2 bytes each) and slices it is summed in.
SKETCH_BITS, SLICES = 22, 16
#: Members outside a region's largest group that are compared with all others; larger regions are cut.
SMALL = 16
#: Pivots of a region, and members from which it is cut into rings.
PIVOTS, CHUNK = 10, 4000
#: Rings must leave at most this share of a region's pairs; pivots that a region is cut by at once.
SEPARATES, CUTS = 0.8, 4
#: Partners of one pivot in one task.
SALT_ROWS = 64
#: Id tables of at most so many rows (24 bytes each) are broadcast.
BROADCAST_ROWS = 1_000_000
NO_ID = -(2**63)

_CLASSES = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("n", pa.int32()), ("g", pa.binary()), ("slice", pa.int32()), ("sketch", pa.binary())])
_CLASSES_DDL = "doc_id long, th long, n int, g binary, slice int, sketch binary"


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    w = text.encode("utf-8", "replace").lower().split() if text else []
    return np.unique(shingle_hashes(word_hashes(w), k)) if w else np.zeros(0, np.uint64)


def _digest(s: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(s.tobytes())


def _bucket(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _classify(docs: DataFrame, k: int) -> DataFrame:
    """Rows of (doc_id, th, n, g) per document, and the task's sketch of shingle counts in slices."""

    def run(batches):
        import zstandard

        count, z = np.zeros(1 << SKETCH_BITS, np.uint32), zstandard.ZstdCompressor(level=1)
        held, size = [], 0

        def add():
            if held:
                count[:] += np.bincount(_bucket(np.concatenate(held)), minlength=len(count)).astype(np.uint32)
                held.clear()

        for b in batches:
            n, g = [], []
            for t in b.column(1):
                s = shingles(t.as_py(), k)
                n.append(len(s))
                g.append(_digest(s) if len(s) else None)
                held.append(s)
                size += len(s)
                if size > 1_000_000:
                    add()
                    size = 0
            none = pa.nulls(len(n))
            yield batch(_CLASSES, b.column(0), b.column(2), n, g, none.cast(pa.int32()), none.cast(pa.binary()))
        add()
        if count.any():
            part = np.split(np.minimum(count, 65535).astype("<u2"), SLICES)
            none = pa.nulls(SLICES)
            yield batch(
                _CLASSES, none.cast(pa.int64()), none.cast(pa.int64()), none.cast(pa.int32()), none.cast(pa.binary()), list(range(SLICES)),
                [z.compress(p.tobytes()) for p in part]
            )

    return docs.mapInArrow(trimmed(run), _CLASSES_DDL)


def _sketch(parts: DataFrame) -> np.ndarray:
    """The sum of all tasks' sketches (saturating); ``SLICES`` rows of fixed size reach the driver."""
    import zstandard

    def run(batches):
        total: dict[int, np.ndarray] = {}
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            for i, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                own = total.setdefault(i, np.zeros((1 << SKETCH_BITS) // SLICES, np.uint32))
                own += np.frombuffer(unpack(blob.as_py()), "<u2")
                np.minimum(own, 65535, out=own)
        for i, own in total.items():
            yield pa.RecordBatch.from_pydict({"slice": pa.array([i], pa.int32()), "sketch": [zstandard.ZstdCompressor(level=1).compress(own.astype("<u2").tobytes())]})

    ddl = "slice int, sketch binary"
    # Two steps, so that no task reads the sketches of all tasks of a large corpus.
    some = parts.repartition(2 * SLICES, "slice", F.spark_partition_id()).mapInArrow(trimmed(run), ddl)
    rows = some.repartition(SLICES, "slice").mapInArrow(trimmed(run), ddl).collect()
    out = np.zeros((SLICES, (1 << SKETCH_BITS) // SLICES), "<u2")
    for r in rows:
        out[r["slice"]] = np.frombuffer(zstandard.ZstdDecompressor().decompress(bytes(r.sketch)), "<u2")
    return out.reshape(-1)


def _regions(docs: DataFrame, sketch: np.ndarray, k: int, percent: int) -> DataFrame:
    """(cell, g, n, pos) for regions with at least two classes; regions of the same members are one."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    schema = pa.schema([("s", pa.int64()), ("g", pa.binary()), ("n", pa.int32()), ("pos", pa.int32())])

    def run(batches):
        seen: set[bytes] = set()
        count = shared.value
        for b in batches:
            for i in range(0, b.num_rows, 256):
                ss, gs, ns, at = [], [], [], []
                for t in b.column(0).slice(i, 256):
                    s = shingles(t.as_py(), k)
                    if not len(s):
                        continue
                    g = _digest(s)
                    if g in seen:
                        continue
                    seen.add(g)
                    n = len(s)
                    p = n - (percent * n + 99) // 100 + 1
                    key = count[_bucket(s)].astype(np.uint64) << np.uint64(48) | s >> np.uint64(16)
                    first = np.argpartition(key, p - 1)[:p] if p < n else np.arange(n)
                    pick = s[first[np.argsort(key[first], kind="stable")]]
                    ss.append(pick)
                    at.append(np.arange(p, dtype=np.int32))
                    gs += [g] * len(pick)
                    ns.append(np.full(len(pick), n, np.int32))
                if ss:
                    yield batch(schema, np.concatenate(ss).view(np.int64), gs, np.concatenate(ns), np.concatenate(at))

    rows = save(docs.select("text").mapInArrow(trimmed(run), "s long, g binary, n int, pos int"), "jaccard-prefixes")
    # Most shingles belong to one class; only the others' rows are joined with what is known of them.
    # Both tables grow with the corpus, so both sides are sorted, whatever their size.
    name = F.xxhash64("g")
    shared_by = rows.groupBy("s").agg(F.min("n").alias("least"), F.min(name).alias("lo"), F.max(name).alias("hi")).where("lo != hi")
    shared_by = save(shared_by.select("s", "least"), "jaccard-shared")
    own = rows.join(shared_by.hint("merge"), "s")
    # Partners of this size or more share too little if so many shingles were passed before.
    own = own.where(f"(n - pos) * {100 + percent} >= {percent} * (n + greatest(least, ceil({percent} * n / 100)))")
    own = save(own.groupBy("s", "g", "n", "pos").agg(F.lit(1).alias("one")).drop("one"), "jaccard-own")
    release(rows)
    of = save(own.groupBy("s").agg(F.count("*").alias("m"), F.expr("bit_xor(xxhash64(g))").alias("sig")).where("m > 1"), "jaccard-signatures")
    out = own.join(of.hint("merge"), "s").groupBy(F.xxhash64("m", "sig").alias("cell"), "g", "n").agg(F.min("pos").alias("pos"))
    out = save(out, "jaccard-regions")
    release(own)
    return out


def _texts(docs: DataFrame, classes: DataFrame, regions: DataFrame, k: int) -> DataFrame:
    """(g, blob): one compressed text for each class that is in a region."""
    own = classes.groupBy("g", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "th").agg(F.count("*").alias("times"))
    own = own.groupBy("g").agg(F.min(F.struct("id", "th", "times")).alias("first"))
    wanted = save(own.join(regions.select("g").distinct(), "g", "left_semi").select("g", "first.id", "first.th", "first.times"), "jaccard-wanted")
    schema = pa.schema([("g", pa.binary()), ("blob", pa.binary())])

    def run(batches):
        import zstandard

        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            g, blob = [], []
            for t, want in zip(b.column(0), b.column(1).to_pylist(), strict=True):
                text = t.as_py()
                # Rows may agree in doc_id and the text's hash; only those of this class are meant.
                if _digest(shingles(text, k)) == want:
                    g.append(want)
                    blob.append(z.compress(text.encode("utf-8", "replace")))
            yield batch(schema, g, blob)

    both = docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "th", "text"
    ).where("text is not null").join(_sized(wanted.drop("times")), ["id", "th"]).select("text", "g")
    texts = both.mapInArrow(trimmed(run), "g binary, blob binary")
    # Only rows that are equal in doc_id and text give a class two texts.
    return texts if wanted.where("times > 1").isEmpty() else texts.dropDuplicates(["g"])


def _sized(df: DataFrame) -> DataFrame:
    """A saved table of ids, to be broadcast if it is small, and else joined by sorting both sides."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df.hint("merge")


def _verify(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """(a, b, inter, na, nb) of distinct pairs of classes, by their whole texts.

    Each b goes to its pivot a; a pivot with many partners is copied to as many tasks as it needs.
    """
    need = save(pairs.groupBy("a").agg(F.ceil(F.count("*") / SALT_ROWS).cast("int").alias("salts")), "jaccard-need")
    pivots = texts.select(F.col("g").alias("a"), F.col("blob").alias("pivot")).join(_sized(need), "a").select(
        "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "pivot"
    )
    dealt = save(pairs.join(need, "a").select(F.col("a").alias("pa"), F.expr("pmod(xxhash64(b), salts)").cast("int").alias("psalt"), "b"), "jaccard-dealt")
    members = texts.withColumnRenamed("g", "b").join(_sized(dealt), "b").select("pa", "psalt", "b", "blob")
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary()), ("inter", pa.int32()), ("na", pa.int32()), ("nb", pa.int32())])

    def run(left, right):
        import zstandard

        grow = zstandard.ZstdDecompressor().decompress
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        p = shingles(grow(left.column("pivot")[0].as_py()).decode(), k)
        inter, nb = [], []
        for blob in right.column("blob"):
            s = shingles(grow(blob.as_py()).decode(), k)
            at = np.minimum(np.searchsorted(p, s), len(p) - 1)
            inter.append(int((p[at] == s).sum()))
            nb.append(len(s))
        size = right.num_rows
        return pa.table(
            [pa.array([left.column("a")[0].as_py()] * size, pa.binary()), right.column("b").cast(pa.binary()), pa.array(inter, pa.int32()), pa.array(np.full(size, len(p), np.int32)), pa.array(nb, pa.int32())],
            schema=schema
        )

    out = save(pivots.groupBy("a", "salt").cogroup(members.groupBy("pa", "psalt")).applyInArrow(run, "a binary, b binary, inter int, na int, nb int"), "jaccard-found")
    release(need)
    release(dealt)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(g, comp): the smallest member of the connected component of each node of ``edges(a, b)``.

    Labels pass along edges and jump to their label's label; each round is a saved table.
    """
    both = save(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = save(both.groupBy(F.col("a").alias("g")).agg(F.least(F.min("b"), F.col("g")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("g").alias("a"), "comp"), "a").groupBy(F.col("b").alias("g")).agg(F.min("comp").alias("near"))
        step = labels.join(near, "g", "left").select("g", F.least("comp", F.coalesce("near", "comp")).alias("comp"), F.col("comp").alias("old"))
        up = labels.select(F.col("g").alias("comp"), F.col("comp").alias("up"))
        step = save(step.join(up, "comp", "left").select("g", F.least("comp", F.coalesce("up", "comp")).alias("comp"), "old"), "labels")
        release(labels)
        if step.where("comp != old").isEmpty():
            release(both)
            return step.select("g", "comp")
        labels = step.select("g", "comp")
        labels.saved_at = step.saved_at


def links(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes, components and links of ``docs(doc_id, text)``.

    Returns (doc_id, n, g) per document, where g is the class of equal sets (null: no shingles);
    (g, comp) of the classes that link with another one, where comp is a class of the component; and
    (a, b, inter, na, nb) of the pairs of classes that were found to link, which connect every
    component.
    """
    # The hash of the text tells rows with one doc_id, or none, apart.
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(F.col("text").cast("string")).alias("th"))
    all_rows = save(_classify(docs, shingle), "jaccard-classes")
    classes = all_rows.where("slice is null").select("doc_id", "th", "n", "g")
    sketch = _sketch(all_rows.where("slice is not null").select("slice", "sketch"))
    regions = _regions(docs, sketch, shingle, percent)
    texts = save(_texts(docs, classes.where("g is not null"), regions, shingle), "jaccard-texts")
    found, comps = _first_pivots(regions, texts, shingle, percent)
    cells, turn = regions.withColumn("home", F.lit(True)), 1
    while True:
        cells = _open(cells, comps)
        if cells.isEmpty():
            break
        new, cells = _turn(cells, texts, found, shingle, percent, turn)
        if not new.where(_linked(percent)).isEmpty():
            found = found.unionByName(new)
            comps = components(found.where(_linked(percent)))
        else:
            found = found.unionByName(new)
        turn += 1
    release(texts)
    return classes, comps, found.where(_linked(percent))


def _linked(percent: int) -> str:
    return f"100 * inter >= {percent} * (na + nb - inter)"


def _fits(percent: int) -> str:
    """Sizes must allow a link, and so must what stands behind the first shared shingle in both."""
    return f"{percent} * greatest(n, pn) <= 100 * least(n, pn) AND least(n - pos, pn - ppos) * {100 + percent} >= {percent} * (n + pn)"


def _first_pivots(regions: DataFrame, texts: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The distances of each region's first pivot to the members that it can link with, and the groups so far."""
    key = F.min(F.struct("pos", "g", "n")).alias("p")
    pivot = save(regions.groupBy("cell").agg(key).select("cell", F.col("p.g").alias("pg"), F.col("p.n").alias("pn"), F.col("p.pos").alias("ppos")), "jaccard-pivots")
    pairs = regions.join(_sized(pivot), "cell").where(f"g != pg AND {_fits(percent)}").select(F.col("pg").alias("a"), F.col("g").alias("b")).distinct()
    found = _verify(save(pairs, "jaccard-pairs"), texts, shingle)
    release(pivot)
    return found, components(found.where(_linked(percent)))


def _open(cells: DataFrame, comps: DataFrame) -> DataFrame:
    """The cells that hold several groups, with the members' groups and the cell's sizes.

    ``main`` is the largest group, ``minor`` the number of members outside it, ``m`` that of all.
    """
    own = cells.drop("comp", "main", "minor", "m").join(_sized(comps), "g", "left").withColumn("comp", F.coalesce("comp", "g"))
    size = own.groupBy("cell", "comp").agg(F.count("*").alias("k"), F.max("home").alias("home"))
    top = size.groupBy("cell").agg(F.max(F.struct("k", "comp")).alias("top"), F.sum("k").alias("m"), F.count("*").alias("groups"), F.max("home").alias("home"))
    top = save(top.where("groups > 1 AND home").select("cell", F.col("top.comp").alias("main"), (F.col("m") - F.col("top.k")).alias("minor"), "m"), "jaccard-open")
    out = save(own.join(_sized(top), "cell"), "jaccard-cells")
    release(top)
    return out


def _turn(cells: DataFrame, texts: DataFrame, found: DataFrame, shingle: int, percent: int, turn: int) -> tuple[DataFrame, DataFrame]:
    """One step of the recursion: newly found distances, and the cells that are left.

    A pair that lives in several cells is compared in the home of its lesser member.
    """
    last = cells.where(F.col("minor") <= SMALL)
    few = last.where("comp != main").select(
        "cell", F.col("g").alias("pg"), F.col("n").alias("pn"), F.col("pos").alias("ppos"), F.col("comp").alias("pcomp"),
        F.col("home").alias("phome")
    )
    few = save(few, "jaccard-few")
    # At most SMALL rows a cell.
    pairs = last.join(_sized(few), "cell").where(f"comp != pcomp AND (comp = main OR pg < g) AND IF(pg < g, phome, home) AND {_fits(percent)}")
    pairs = pairs.select(F.col("pg").alias("a"), F.col("g").alias("b"))
    large = cells.where(F.col("minor") > SMALL)
    if large.isEmpty():
        new = _verify(_new(pairs, found), texts, shingle)
        release(few)
        return new, cells.limit(0)
    # About PIVOTS a cell, at most an eighth of its members, by hash; one at least.
    order = F.pmod(F.xxhash64("g", F.lit(turn)), F.lit(1 << 30))
    wanted = F.least(F.lit(PIVOTS), F.ceil(F.col("m") / 8))
    chosen = large.where(order * F.col("m") < wanted * F.lit(1 << 30)).select("cell", F.col("g").alias("pg"))
    first = large.groupBy("cell").agg(F.min(F.struct(order.alias("order"), "g")).alias("p")).select("cell", F.col("p.g").alias("pg"))
    pivots = save(chosen.union(first).distinct(), "jaccard-pivots")
    by_cell = save(large.join(_sized(pivots), "cell").where("g != pg").select("cell", "pg", "g", "home"), "jaccard-met")
    new = _verify(_new(by_cell.select(F.col("pg").alias("a"), F.col("g").alias("b")), found), texts, shingle)
    every = found.unionByName(new)
    gap = 1 - F.col("inter") / (F.col("na") + F.col("nb") - F.col("inter"))
    far = every.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"), gap.alias("d")).groupBy("lo", "hi").agg(F.min("d").alias("d"))
    gone = _sized(pivots.select("cell", F.col("pg").alias("g"), F.lit(True).alias("gone")))
    met = by_cell.withColumn("lo", F.least("pg", "g")).withColumn("hi", F.greatest("pg", "g")).join(far, ["lo", "hi"])
    met = save(met.join(gone, ["cell", "g"], "left").where("gone IS NULL").select("cell", "pg", "g", "home", "d"), "jaccard-distances")
    rest = large.join(gone, ["cell", "g"], "left").where("gone IS NULL").drop("gone", "main", "minor")
    eps = max(1 - percent / 100, 0.005)
    best = _separating(met.join(_sized(large.where(F.col("m") > CHUNK).select("cell").distinct()), "cell", "left_semi"), large, eps)
    cut_cells = _sized(save(best.select("cell").distinct(), "jaccard-cut"))
    left = save(_cut(met.join(_sized(best), ["cell", "pg"]), rest, eps), "jaccard-left")
    near = _windows(met, rest.join(cut_cells, "cell", "left_anti"), percent, eps)
    met_pairs = save(pairs.union(near), "jaccard-near")
    out = new.unionByName(_verify(_new(met_pairs, every), texts, shingle))
    for used in (few, by_cell, met, best, pivots, met_pairs, cells):
        release(used)
    return out, left


def _new(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Distinct pairs (a, b), whichever way round, whose distance is not known yet."""
    both = pairs.groupBy(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).agg(F.min("a").alias("a"))
    known = found.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct()
    todo = both.join(known, ["lo", "hi"], "left_anti").select("a", F.when(F.col("a") == F.col("lo"), F.col("hi")).otherwise(F.col("lo")).alias("b"))
    return save(todo, "jaccard-pairs")


def _rings(eps: float) -> tuple[Column, Column]:
    """The ring (of width 2 * eps) of a distance ``d``, and all rings that its window of eps reaches."""
    ring = lambda x: F.floor(x / (2 * eps)).cast("int")
    return ring(F.col("d")), F.sequence(ring(F.col("d") - eps - 1e-9), ring(F.col("d") + eps + 1e-9))


def _separating(met: DataFrame, large: DataFrame, eps: float) -> DataFrame:
    """(cell, pg) of the pivots that cells are cut by."""
    at, reach = _rings(eps)
    rings = met.select("cell", "pg", "home", at.alias("at"), F.explode(reach).alias("ring"))
    size = rings.groupBy("cell", "pg", "ring").agg(F.count("*").alias("k"), F.sum((F.col("home") & (F.col("ring") == F.col("at"))).cast("int")).alias("homes"))
    # A ring's pairs: its homes with all of it.
    size = size.groupBy("cell", "pg").agg(F.sum(F.col("k") * F.col("homes")).alias("pairs"))
    plain = large.groupBy("cell").agg(F.count("*").alias("k"), F.sum(F.col("home").cast("int")).alias("homes"))
    nth = F.row_number().over(Window.partitionBy("cell").orderBy("pairs", "pg"))
    best = size.join(plain, "cell").where(f"pairs <= {SEPARATES} * k * homes").withColumn("nth", nth).where(F.col("nth") <= CUTS)
    return save(best.select("cell", "pg"), "jaccard-best")


def _cut(met: DataFrame, rest: DataFrame, eps: float) -> DataFrame:
    """The cells that rings make of larger ones: a new cell is a combination of rings, one of each pivot."""
    at, reach = _rings(eps)
    own = met.select("cell", "pg", "g", at.alias("at"), reach.alias("reach")).groupBy("cell", "g").agg(
        F.array_sort(F.collect_list(F.struct("pg", "at", "reach"))).alias("rings")
    )
    one = lambda c, x: F.transform(
        x["reach"], lambda r: F.struct(F.xxhash64(c["cell"], x["pg"], r).alias("cell"), (c["home"] & (r == x["at"])).alias("home"))
    )
    combined = F.aggregate("rings", F.array(F.struct("cell", "home")), lambda acc, x: F.flatten(F.transform(acc, lambda c: one(c, x))))
    cut = rest.join(own, ["cell", "g"]).select("g", "n", "pos", F.explode(combined).alias("new")).select("new.cell", "g", "n", "pos", "new.home")
    return cut.groupBy("cell", "g", "n").agg(F.min("pos").alias("pos"), F.max("home").alias("home"))


def _windows(met: DataFrame, rest: DataFrame, percent: int, eps: float) -> DataFrame:
    """Pairs (a, b) whose distances to all pivots of their cell differ by at most eps, and that can link otherwise.

    A cell of more than ``CHUNK`` members is met in blocks of its homes.
    """
    rows = rest.join(met.groupBy("cell", "g").agg(F.array_sort(F.collect_list(F.struct("pg", "d"))).alias("ds")), ["cell", "g"])
    rows = rows.select("cell", "g", "n", "pos", "comp", "home", F.transform("ds", lambda x: x["d"]).alias("ds"), F.ceil(F.col("m") / CHUNK).cast("int").alias("blocks"))
    rows = save(rows, "jaccard-rows")
    left = rows.where("home").select("cell", F.expr("pmod(xxhash64(g), blocks)").cast("int").alias("block"), "g", "n", "pos", "comp", "ds")
    right = rows.select(
        F.col("cell").alias("of"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("at"),
        *[F.col(c).alias(f"o_{c}") for c in ("g", "n", "pos", "comp", "ds")]
    )
    schema = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(one, other):
        if not one.num_rows or not other.num_rows:
            return schema.empty_table()
        other = other.rename_columns(one.column_names)
        names = [np.array(t.column(c).to_pylist(), "S16") for t in (one, other) for c in ("g", "comp")]
        g, comp = (np.unique(np.concatenate(names[i::2]), return_inverse=True)[1] for i in (0, 1))
        k = one.num_rows
        size, place = (np.concatenate([t.column(c).to_numpy() for t in (one, other)]).astype(np.int64) for c in ("n", "pos"))
        far = np.concatenate([t.column("ds").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1) for t in (one, other)])
        main = int(np.argmax(far.std(0)))
        order = k + np.argsort(far[k:, main], kind="stable")
        x = far[order, main]
        a, b = [], []
        for i in range(k):
            at = order[np.searchsorted(x, far[i, main] - eps - 1e-9) : np.searchsorted(x, far[i, main] + eps + 1e-9, "right")]
            at = at[(g[at] > g[i]) & (comp[at] != comp[i])]
            at = at[(np.abs(far[at] - far[i]) <= eps + 1e-9).all(1)]
            both, behind = size[at] + size[i], np.minimum(size[at] - place[at], size[i] - place[i])
            at = at[(percent * np.maximum(size[at], size[i]) <= 100 * np.minimum(size[at], size[i])) & (behind * (100 + percent) >= percent * both)]
            a.append(np.full(len(at), i))
            b.append(at - k)
        a, b = np.concatenate(a), np.concatenate(b)
        return pa.table([one.column("g").take(pa.array(a)).cast(pa.binary()), other.column("g").take(pa.array(b)).cast(pa.binary())], schema=schema)

    return left.groupBy("cell", "block").cogroup(right.groupBy("of", "at")).applyInArrow(run, "a binary, b binary")


def _labels(classes: DataFrame, comps: DataFrame) -> DataFrame:
    """(g, first_id, first_class) of each class: the smallest doc_id of its component, and that document's class.

    Documents are reduced to classes before anything is joined, so a large group is one row or few.
    """
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "g")
    own = save(classes.where("g is not null").groupBy("g").agg(F.min(key).alias("own")).join(comps, "g", "left"), "jaccard-own")
    first = save(own.where("comp is not null").groupBy("comp").agg(F.min("own").alias("first")), "jaccard-first")
    both = own.join(_sized(first), "comp", "left").withColumn("first", F.coalesce("first", "own"))
    return save(both.select("g", F.col("first.doc_id").alias("first_id"), F.col("first.g").alias("first_class")), "jaccard-labels")


def groups(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each document, and its class."""
    classes, comps, _ = links(docs, shingle, percent)
    labels = _labels(classes, comps).select("g", "first_id")
    out = classes.join(_sized(labels), "g", "left")
    return out.select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("g").isNull(), F.col("doc_id")).otherwise(F.col("first_id")).alias("component_id"), F.col("g").alias("class_id")
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One document of each group stays, that with the smallest doc_id, with all columns.

    Documents without shingles are groups of their own. Rows that share a doc_id (or have none) are
    told apart by their class; of rows equal in both, any one stays.
    """
    member, comps, _ = links(docs, shingle, percent)
    kept = save(_labels(member, comps).where("g = first_class").select(F.col("first_id").alias("kept_id"), F.col("first_class").alias("kept_class")), "jaccard-kept")
    shared = save(member.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL").select(F.col("doc_id").alias("kept_id")), "jaccard-shared")
    by_id = F.col("doc_id").eqNullSafe(F.col("kept_id"))
    ids = kept.select("kept_id").union(member.where("g is null").select("doc_id")).distinct()
    if shared.isEmpty():
        return docs.join(ids, F.col("doc_id") == F.col("kept_id"), "left_semi")
    alone = docs.join(shared, by_id, "left_anti").join(ids, F.col("doc_id") == F.col("kept_id"), "left_semi")

    def classify(batches):
        at = columns.index("text")
        for b in batches:
            sets = [shingles(t.as_py(), shingle) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([_digest(s) if len(s) else None for s in sets], pa.binary())], names=[*columns, "own_class"])

    columns = [f"c{i}" if c != "text" else c for i, c in enumerate(docs.columns)]
    some = docs.join(shared, by_id, "left_semi").toDF(*columns)
    some = some.mapInArrow(classify, StructType([*some.schema.fields, StructField("own_class", BinaryType())]))
    key = columns[docs.columns.index("doc_id")]
    none = some.where("own_class is null").drop("own_class")
    rest = some.where("own_class is not null").join(kept, F.col(key).eqNullSafe(F.col("kept_id")) & (F.col("own_class") == F.col("kept_class")), "left_semi")
    rest = rest.dropDuplicates([key, "own_class"]).drop("own_class")
    return alone.union(none.union(rest).toDF(*docs.columns))
