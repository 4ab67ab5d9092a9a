r"""Document fingerprints by order MinHash, in DataFrame functions only.

A text's tokens are runs of up to 32 characters with the white space after them, or single
ideographs; every character is in a token. Its k-mers are windows of three tokens, each numbered by
how often it has occurred before, so repeats count. One hash orders the numbered k-mers on a ring;
sample ``j`` orders them from the ring's point ``j`` on, takes the two least, and hashes the pair *in
the order of the text*. A fingerprint is the list of those hashes, so it tells texts apart that hold
the same k-mers in another order. The likeness of two fingerprints is the share of equal samples.

Everything happens within a row, on sorted arrays of longs (34 bits of hash, 30 bits of place), in
time n log n of the text's length. Texts are shuffled once, to meet their neighbours: the documents
are cut by the digits of doc_id into nodes of at most ``LEAF`` documents (``ranks``), ``lead`` works
within a node, and the first document of each node is joined to the last of the node before.

Defined results: null text is the empty one, whose fingerprint is that of no tokens, equal to itself
(likeness 1) and to nothing else; a text of fewer than three tokens is one k-mer; one k-mer alone is
hashed alone; documents with equal doc_id follow each other by a hash of their texts, those without
come last; a single document is its own neighbour; exact copies that exceed a node are computed
once; an empty table gives an empty table; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkflow.llm.common import release, save
from linkflow.llm.ranks import Buckets, expand, hex_key

K = 3
#: Samples of a fingerprint: a power of two, told apart by a hash's leading bits.
SAMPLE_BITS = 6
SAMPLES = 1 << SAMPLE_BITS
#: From the radicals to the end of the unified ideographs, kana included, and the planes of further ones.
_IDEOGRAPH = r"\x{2E80}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
TOKEN = rf"[^\s{_IDEOGRAPH}]{{1,32}}+\s*+|[{_IDEOGRAPH}]\s*+|\s++"
#: Bits of a token's place in a packed long: a text of 2**31 bytes has fewer tokens.
PLACE_BITS = 30
_PLACE = (1 << PLACE_BITS) - 1
#: Documents whose neighbours one task looks up.
LEAF, WIDTH = 1024, 1


def _let(x: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(x), body), 1)


def _packed(h: Column, place: Column) -> Column:
    return h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(place)


def _indices(n: Column) -> Column:
    """0 to ``n`` - 1, for ``n`` of one or more."""
    return F.sequence(F.lit(0), n - 1)


def kmers(text: Column) -> Column:
    """The hashes of all k-mers with their places, sorted."""
    tokens = F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))
    windows = lambda t: F.transform(
        F.sequence(F.lit(0), F.greatest(F.size(t) - K, F.lit(0))), lambda i: _packed(F.xxhash64(*[F.get(t, i + j) for j in range(K)]), i.cast("long"))
    )
    return F.sort_array(_let(tokens, windows))


def numbered(s: Column) -> Column:
    """Of sorted k-mers: the hashes of k-mer and occurrence number, with their places, sorted on the ring."""
    kmer = lambda x: F.shiftright(x, PLACE_BITS)

    def first(x: Column) -> Column:
        """Where the run of a k-mer starts: the number of smaller k-mers, by halving."""
        steps = F.sequence(F.lit(1), F.ceil(F.log2(F.size(s) + F.lit(1))).cast("int"))

        def halve(lohi: Column, _: Column) -> Column:
            mid = F.shiftright(lohi["lo"] + lohi["hi"], 1)
            less = kmer(F.get(s, mid)) < kmer(x)
            return F.struct(F.when(less, mid + 1).otherwise(lohi["lo"]).alias("lo"), F.when(less, lohi["hi"]).otherwise(mid).alias("hi"))

        return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(s).alias("hi")), lambda acc, i: F.when(acc["lo"] < acc["hi"], halve(acc, i)).otherwise(acc))["lo"]

    # Most k-mers occur once; of the others, those before are counted.
    nth = lambda x, j: F.when(kmer(x) == kmer(F.get(s, j - 1)), j - first(x)).otherwise(F.lit(0))
    return F.sort_array(F.transform(s, lambda x, j: _packed(F.xxhash64(kmer(x), nth(x, j)), x.bitwiseAND(F.lit(_PLACE)))))


def samples(ring: Column) -> Column:
    """The fingerprint, numbers below 2**32, of sorted numbered k-mers."""
    n = F.size(ring)
    part = lambda x: (F.shiftright(x, 64 - SAMPLE_BITS) + SAMPLES // 2).cast("int")
    parts = F.transform(ring, part)
    firsts = lambda ps: F.transform(F.array_distinct(ps), lambda p: (F.array_position(ps, p) - 1).cast("int"))

    def pair(x: Column, y: Column) -> Column:
        place = lambda v: v.bitwiseAND(F.lit(_PLACE))
        ident = lambda v: F.shiftright(v, PLACE_BITS)
        both = F.when(place(x) < place(y), F.xxhash64(ident(x), ident(y))).otherwise(F.xxhash64(ident(y), ident(x)))
        return F.shiftrightunsigned(F.when(n > 1, both).otherwise(F.xxhash64(ident(x))), 32)

    def spread(at: Column) -> Column:
        # A sample whose part of the ring is empty goes on to the next k-mers: those of the next full part.
        end = part(F.get(ring, F.element_at(at, -1)))

        def serve(j: Column, r: Column) -> Column:
            own = part(F.get(ring, j))
            before = F.when(r == 0, end - SAMPLES).otherwise(part(F.get(ring, F.get(at, r - 1))))
            return F.array_repeat(pair(F.get(ring, j), F.get(ring, (j + 1) % n)), own - before)

        after = F.lit(SAMPLES - 1) - end
        return _let(F.flatten(F.transform(at, serve)), lambda v: F.concat(F.slice(v, after + 1, end + 1), F.slice(v, F.lit(1), after)))

    return _let(_let(parts, firsts), spread)


def with_samples(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with the fingerprint of a text column as an array of numbers; each step is a column that is computed once."""
    df = df.withColumn("omh_kmers", kmers(F.col(text)))
    df = df.withColumn("omh_ring", numbered(F.col("omh_kmers"))).drop("omh_kmers")
    return df.withColumn(out, samples(F.col("omh_ring"))).drop("omh_ring")


def as_text(fingerprint: Column) -> Column:
    """The samples in order, as decimal numbers with commas between them."""
    return F.array_join(fingerprint.cast("array<string>"), ",")


def likeness(a: Column, b: Column) -> Column:
    """The share of samples in which two fingerprints agree."""
    return F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: x["a"] == x["b"])) / F.lit(float(SAMPLES))


def fingerprints(docs: DataFrame) -> DataFrame:
    """``docs`` with ``fingerprint`` of the column text."""
    rows = docs.withColumn("omh_text", F.coalesce("text", F.lit("")))
    return with_samples(rows, "omh_text", "fingerprint").withColumn("fingerprint", as_text(F.col("fingerprint"))).drop("omh_text")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.concat(hex_key(F.col("doc_id"), descending=True), F.lpad(F.hex(F.xxhash64(text)), 16, "0")).alias("key"), "doc_id", text.alias("text"))


def neighbours(docs: DataFrame, leaf: int = LEAF) -> tuple[DataFrame, bool]:
    """``prefix, key, doc_id, text, copies`` with ``next_text`` and, for the last row of a prefix, the next row's ``head`` fingerprint.

    The next document is that of the next smaller doc_id, after the last the first: the next row by
    key of the prefix, or the first one of the next prefix. The second value says whether ``copies``
    exceed 1.
    """
    rows = _keyed(docs)
    keys = save(rows.select(F.lit(0).alias("all"), "key"), "omh-keys")
    b = Buckets(keys, ["all"], "key", leaf, WIDTH)
    nodes = b.table.select("prefix", "first", "n", "lo", "total")
    rows = rows.withColumn("copies", F.lit(1).cast("long"))
    if b.crowded:
        # Copies beyond a node are one row that is its own neighbour, and one that has the next text.
        many = save(keys.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > leaf), "omh-copies")
        one = rows.join(many, "key", "left_semi").groupBy("key").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"))
        one = one.join(many, "key").withColumn("copies", F.explode(F.array(F.col("n") - 1, F.lit(1).cast("long")))).drop("n")
        rows = rows.join(many, "key", "left_anti").unionByName(one)
    ends = nodes.select("prefix", ((F.col("first") + F.col("n")) % F.col("total")).alias("at"))
    ends = ends.join(nodes.select(F.col("first").alias("at"), F.col("lo").alias("key")), "at")
    heads = rows.select("key", "text").join(ends.select("key", "prefix"), "key").groupBy("prefix").agg(F.first("text").alias("head_text"))
    heads = save(with_samples(heads, "head_text", "head"), "omh-heads")
    release(keys)
    b.release()
    w = Window.partitionBy("prefix").orderBy("key")
    rows = rows.withColumn("prefix", F.substring("key", 1, b.depth))
    rows = rows.withColumn("next_text", F.lead("text").over(w)).join(heads, "prefix")
    last = F.col("next_text").isNull()
    return rows.withColumn("head", F.when(last, F.col("head"))).withColumn("next_text", F.when(last, F.col("head_text")).otherwise(F.col("next_text"))).drop("head_text"), b.crowded


def compare(docs: DataFrame, leaf: int = LEAF) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and the likeness to that and to the next document's.

    The edited text has the last half (rounded down) of the characters replaced by as many of the
    next document's first, or all of them.
    """
    rows, crowded = neighbours(docs, leaf)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumn("n_chars", n.cast("long")).drop("next_text")
    rows = with_samples(with_samples(rows, "text", "own"), "edited", "other")
    out = rows.select("prefix", "key", "doc_id", "copies", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "own", "other", "head")
    w = Window.partitionBy("prefix").orderBy("key")
    out = out.withColumn("next", F.coalesce("head", F.lead("own").over(w)))
    out = out.select(
        "doc_id", "copies", "n_chars", "edited_sha256", as_text(F.col("own")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("other")).alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next")
    )
    return expand(out, leaf=leaf) if crowded else out.drop("copies")
