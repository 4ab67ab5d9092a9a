"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

Each source has a target share of the output; its mean repetition rate is
``share * output rows / rows of the source``. A document's number of copies is Poisson distributed
with that mean, by inversion of the distribution at a number in (0, 1) that is hashed from the seed
and the doc_id, so a rerun or a lost executor gives the same copies. Copies are exploded and
shuffled globally by sorting on a second hash; that hash is uniform, so its leading bits deal the
copies to equal partitions in order, without a sampling run over the corpus.

Means above ``PART`` are split into equal parts with a number each, whose counts are added: a sum
of Poisson variables is Poisson distributed, and no term underflows.

Defined results: a null source is a source of its own, and so is the empty one; a null doc_id
hashes as the empty string; rows with equal doc_id get equal counts (they are told apart by
nothing); null and empty texts are copied like others; an empty table gives an empty table; input
columns named ``copy`` or ``shuffle_key`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEED = "mix-1"
#: Exponent of the source sizes in the default target weights (1: as they are, 0: all equal).
TEMPERATURE = 0.5
PART = 8.0
#: Terms of the distribution function; the rest of a Poisson(8) beyond 64 is below 2**-53.
TERMS = 64
#: Hexadecimal digits of the shuffle key.
KEY_DIGITS = 15
#: A table of at most so many sources is broadcast (three numbers and a 64-term list each).
BROADCAST_SOURCES = 20_000


def _hash(digits: int, *parts) -> Column:
    text = F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, digits), 16, 10).cast("long")


def rates(docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE, output_rows: int | None = None) -> DataFrame:
    """Per source its rows, parts and the distribution function of one part's count.

    ``weights`` are target weights by source (absent sources: 0); without them the weights are the
    source sizes to the power ``temperature``. ``output_rows`` is the expected output size; without
    it, the input size.
    """
    n = docs.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        n = n.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(float(temperature))))
    else:
        given = docs.sparkSession.createDataFrame(list(weights.items()), "source string, w double")
        n = n.alias("n").join(given.alias("g"), F.col("n.source").eqNullSafe(F.col("g.source")), "left").select("n.source", "n", F.coalesce("w", F.lit(0.0)).alias("w"))
    rows, all_w = n.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("w"), F.lit(0.0))).first()
    rows = rows if output_rows is None else output_rows
    n = n.withColumn("mean", F.coalesce(F.try_divide(F.col("w") * F.lit(rows), F.lit(all_w) * F.col("n")), F.lit(0.0)))
    n = n.withColumn("parts", F.greatest(F.ceil(F.col("mean") / PART), F.lit(1)).cast("int"))
    r = F.col("mean") / F.col("parts")
    first = F.struct(F.exp(-r).alias("p"), F.array(F.exp(-r)).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * r / k
        return F.struct(p.alias("p"), F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + p)).alias("cdf"))

    cdf = F.aggregate(F.transform(F.sequence(F.lit(1), F.lit(TERMS)), lambda k: k.cast("double")), first, step)["cdf"]
    return n.select(F.col("source").alias("rate_source"), "parts", cdf.alias("cdf"))


def replicate(
    docs: DataFrame, weights: dict[str | None, float] | None = None, temperature: float = TEMPERATURE, output_rows: int | None = None,
    seed: str = SEED
) -> DataFrame:
    """All copies in shuffled order: the input's columns, ``copy`` (from 1) and ``shuffle_key``."""
    docs = docs.drop("copy", "shuffle_key")
    r = rates(docs, weights, temperature, output_rows)
    if docs.select("source").distinct().limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        r = F.broadcast(r)
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    u = lambda j: (_hash(12, seed, doc, j.cast("string")) + F.lit(0.5)) / F.lit(float(1 << 48))
    # Inversion: the count is the number of values of the distribution function up to the number.
    counts = F.transform(F.sequence(F.lit(1), F.col("parts")), lambda j: F.size(F.filter("cdf", lambda c: c <= u(j))))
    total = F.aggregate(counts, F.lit(0), lambda a, b: a + b)
    both = docs.join(r, F.col("source").eqNullSafe(F.col("rate_source"))).withColumn("rate_n", total).where("rate_n > 0")
    copies = both.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rate_n"))))
    key = _hash(KEY_DIGITS, seed, "order", doc, F.col("copy").cast("string"))
    copies = copies.select(*docs.columns, "copy", key.alias("shuffle_key"))
    # The share of the key in its range times the number of partitions, by its 24 leading bits.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    task = F.shiftright(F.shiftright("shuffle_key", 4 * KEY_DIGITS - 24) * F.lit(tasks).cast("long"), 24).cast("int")
    return copies.repartitionById(tasks, task).sortWithinPartitions("shuffle_key", "doc_id", "copy")


ORACLE = """
WITH n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
m AS (SELECT source, sqrt(n::DOUBLE) * (SELECT sum(n) FROM n) / ((SELECT sum(sqrt(n::DOUBLE)) FROM n) * n) AS mean FROM n),
r AS (SELECT source, greatest(ceil(mean / 8.0), 1)::INT AS parts, mean / greatest(ceil(mean / 8.0), 1) AS r FROM m),
pmf AS (SELECT source, k, exp(-r + k * ln(r) - lgamma(k + 1)) AS p FROM r, (SELECT unnest(range(0, 65)) AS k)),
cdf AS (SELECT source, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM pmf),
lists AS (SELECT source, list(c ORDER BY c) AS cdf FROM cdf GROUP BY source),
u AS (SELECT d.doc_id, r.source, (('0x' || substr(md5('mix-1|' || d.doc_id || '|' || j), 1, 12))::BIGINT + 0.5) / 281474976710656.0 AS u
      FROM documents d JOIN r ON d.source IS NOT DISTINCT FROM r.source, unnest(range(1, r.parts + 1)) AS t(j)),
counts AS (SELECT u.doc_id, sum(len(list_filter(l.cdf, lambda c: c <= u.u))) AS c FROM u JOIN lists l ON u.source IS NOT DISTINCT FROM l.source GROUP BY u.doc_id)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, k.copy::INT AS copy,
       ('0x' || substr(md5('mix-1|order|' || d.doc_id || '|' || k.copy), 1, 15))::BIGINT AS shuffle_key
FROM documents d JOIN counts USING (doc_id), unnest(range(1, counts.c::BIGINT + 1)) AS k(copy)
"""
