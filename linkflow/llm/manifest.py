"""A Merkle manifest of a dataset: one tree per source, a tree of the sources' roots above them.

A document's leaf hashes its columns. Its rank within its source is exact (``ranks``: hierarchical
histograms of doc_id digits, no global sort), and the rank's base-16 digits are its place in the
trie: nodes that share all digits but the last are one run, whose digests in order hash to their
parent, level by level to the source's subroot. Subroots, ordered by source, are the leaves of the
upper tree. Paths go from the root down, once per run of 16, so no document carries its whole path
through a shuffle. Texts are read once and never shuffled.

Every shuffle key is a source and a number, never a source alone, so a source with most documents is
spread like any other. The driver gets the root, the largest source's size and the levels' number.

Defined results: a null column hashes as ``-``, an empty one as ``0:``; a null source is a source of
its own and comes before the empty one; a null doc_id ranks first in its source, and counts as the
empty text where a crc32 is taken; documents of equal source and doc_id rank by their leaf, and exact copies are leaves
of their own that follow each other; an empty table gives an empty table; other columns, whatever
their names, play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkflow.llm.common import release, save
from linkflow.llm.ranks import hex_key, ranked

#: Binary digits of a place within a run.
BITS = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_STEPS = "array<struct<before:string,after:string>>"


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """sha256 over the fields, each as its length in bytes, a colon and its value, so that none can be taken for another."""
    values = [x.cast("string") for x in (doc_id, source, lang, n_chars, text)]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values]), 256)


def leaves(docs: DataFrame, tampered: Column | None = None, altered: Column | None = None) -> DataFrame:
    """``tree, key, doc_id, leaf, changed`` of each document, saved.

    ``tree`` names the source in an order by bytes, ``key`` the place in it. Where ``tampered`` holds,
    ``changed`` is the leaf of the document with the text ``altered``.
    """
    c = F.col
    own = leaf(c("doc_id"), c("source"), c("lang"), c("n_chars"), c("text"))
    other = F.lit(None).cast("string") if tampered is None else F.when(tampered, leaf(c("doc_id"), c("source"), c("lang"), c("n_chars"), altered))
    tree = F.coalesce(F.concat(F.lit("1"), F.hex(F.encode("source", "UTF-8"))), F.lit("0"))
    rows = docs.select(tree.alias("tree"), "doc_id", own.alias("leaf"), other.alias("changed"))
    return save(rows.select("tree", F.concat(hex_key(c("doc_id")), F.substring("leaf", 1, 32)).alias("key"), "doc_id", "leaf", "changed"), "manifest-leaves")


def grow(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Reduces ``nodes(tree, idx, digest, total)`` level by level.

    Gives each level's runs ``tree, run, kids, total`` (saved; kids are the digests in order) and the
    roots ``tree, digest``. A tree of one node has no runs.
    """
    most = nodes.agg(F.max("total")).first()[0] or 0
    levels, roots = [], nodes.where("total = 1").select("tree", "digest")
    while most > 1:
        kids = F.transform(F.array_sort(F.collect_list(F.struct("idx", "digest"))), lambda x: x["digest"])
        runs = nodes.where("total > 1").groupBy("tree", F.shiftright("idx", BITS).alias("run")).agg(kids.alias("kids"), F.first("total").alias("total"))
        runs = save(runs, f"manifest-level{len(levels)}")
        levels.append(runs)
        nodes = runs.select("tree", F.col("run").alias("idx"), F.sha2(F.array_join("kids", ""), 256).alias("digest"), F.shiftright(F.col("total") + 15, BITS).alias("total"))
        roots = roots.unionByName(nodes.where("total = 1").select("tree", "digest"))
        most = (most + 15) >> BITS
    return levels, roots


def _step(place: Column) -> Column:
    """The siblings before and after a place of its run, each as one text."""
    side = lambda start, n: F.array_join(F.slice("kids", start, n), "")
    return F.struct(side(F.lit(1), place).alias("before"), side(place + 2, F.lit(1 << BITS)).alias("after"))


def descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame | None:
    """The lowest runs with the path above them: ``tree, run, kids, path, *``; ``tops(tree, path, *)`` are the roots' paths."""
    carried = [c for c in tops.columns if c not in ("tree", "path")]
    above = None
    for depth in range(len(levels) - 1, -1, -1):
        runs = levels[depth]
        out = runs.where(f"total <= {1 << BITS}").join(tops, "tree").select("tree", "run", "kids", "path", *carried)
        if above is not None:
            more = runs.where(f"total > {1 << BITS}").join(above, ["tree", "run"])
            out = out.unionByName(more.select("tree", "run", "kids", "path", *carried))
        if depth:
            kids = out.withColumn("place", F.explode(F.sequence(F.lit(0), F.size("kids") - 1)))
            above = kids.select(
                "tree", (F.shiftleft("run", BITS) + F.col("place")).alias("run"), F.concat(F.array(_step(F.col("place"))), "path").alias("path"), *carried
            )
    return out if levels else None


def _paths(nodes: DataFrame, levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``nodes(tree, idx, total, *)`` with their whole path and what ``tops`` carry."""
    carried = [c for c in tops.columns if c not in ("tree", "path")]
    columns = [*nodes.columns, "path", *carried]
    out = nodes.where("total = 1").join(tops, "tree").select(*columns)
    runs = descend(levels, tops)
    if runs is None:
        return out
    many = nodes.where("total > 1").withColumn("run", F.shiftright("idx", BITS)).join(runs, ["tree", "run"])
    place = F.col("idx").bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")
    many = many.withColumn("path", F.concat(F.array(_step(place)), "path"))
    return out.unionByName(many.select(*columns))


def folded(start: Column, path: str = "path") -> Column:
    """The root that a leaf and the siblings of its path lead to."""
    return F.aggregate(path, start, lambda acc, x: F.sha2(F.concat(x["before"], acc, x["after"]), 256))


def prove(docs: DataFrame, tampered: Column | None = None, altered: Column | None = None) -> DataFrame:
    """Per document ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    The manifest is that of ``docs``; a document is verified if its leaf, that of the ``altered`` text
    where ``tampered`` holds, leads to the root along the manifest's siblings.
    """
    spark = docs.sparkSession
    rows = leaves(docs, tampered, altered)
    places = ranked(rows, ["tree"], "key").drop("key")
    release(rows)
    levels, subroots = grow(places.select("tree", "idx", F.col("leaf").alias("digest"), "total"))
    sources = save(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest"), "manifest-subroots")
    upper = ranked(sources, ["tree"], "key")
    above, roots = grow(upper.select("tree", "idx", "digest", "total"))
    root = roots.first()
    root = None if root is None else root.digest
    tops = _paths(upper, above, spark.createDataFrame([("", [])], f"tree string, path {_STEPS}"))
    tops = save(tops.select(F.col("key").alias("tree"), "path", F.col("digest").alias("subroot")), "manifest-tops")
    out = _paths(places, levels, tops)
    proof = F.sha2(F.array_join(F.transform("path", lambda x: F.concat(x["before"], x["after"])), ""), 256)
    out = out.select("doc_id", "leaf", "subroot", F.lit(root).cast("string").alias("root"), proof.alias("proof_sha256"), folded(F.coalesce("changed", "leaf")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def lowered(text: str = "text") -> Column:
    """The text with A-Z in lower case, other letters as they are."""
    return F.translate(text, UPPER, LOWER)


def _oracle(levels: int = 4) -> str:
    """The query over ``documents`` in SQL, for trees of up to ``16 ** levels`` leaves."""
    fields = "||".join(f"coalesce(octet_length(encode({c}::VARCHAR))||':'||{c}::VARCHAR,'-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}"))
    own, low = fields.replace("{text}", "text"), fields.replace("{text}", "low")

    def tree(name: str) -> str:
        # Each level from the one before; a tree of one node goes up as it is.
        sql = ""
        for k in range(levels + 1):
            if k:
                sql += f"""{name}{k} AS (SELECT src, idx//16 AS idx, CASE WHEN max(total)=1 THEN max(d) ELSE sha256(string_agg(d,'' ORDER BY idx)) END AS d, (max(total)+15)//16 AS total
                    FROM {name}{k - 1} GROUP BY src, idx//16),\n"""
            sql += f"""{name}{k}s AS (SELECT src, idx, d, total, coalesce(string_agg(d,'') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),'') AS b,
                    coalesce(string_agg(d,'') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING),'') AS a FROM {name}{k} WINDOW w AS (PARTITION BY src, idx//16 ORDER BY idx)),\n"""
        return sql

    def climb(name: str, frm: str) -> str:
        sql = ""
        for k in range(levels):
            to = f"{name}_{k}"
            key = "s.src=c.src" if name == "n" else "true"
            idx = "c.idx" if name == "n" else "c.sidx"
            sql += f"""{to} AS (SELECT c.* REPLACE (CASE WHEN s.total=1 THEN c.x ELSE sha256(s.b||c.x||s.a) END AS x, c.proof||s.b||s.a AS proof)
                    FROM {frm} c JOIN {name}{k}s s ON {key} AND s.idx={idx}//{16**k}),\n"""
            frm = to
        return sql

    return f"""WITH tab AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT)) AS t),
docs AS (SELECT *, coalesce(doc_id::VARCHAR,'') AS name, translate(text, '{UPPER}', '{LOWER}') AS low, coalesce('1'||hex(encode(source)),'0') AS src FROM documents),
leaf AS (SELECT doc_id, src, sha256({own}) AS leaf, sha256({low}) AS other,
    xor(list_reduce(list_transform(range(1, length(name)+1), lambda i: ascii(substr(name, i, 1))::BIGINT), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 5 = 0 AS due FROM docs, tab),
n0 AS (SELECT *, leaf AS d, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY src) AS total FROM leaf),
{tree("n")}
u0 AS (SELECT src AS own, '' AS src, d, row_number() OVER (ORDER BY src) - 1 AS idx, count(*) OVER () AS total FROM n{levels}),
{tree("u")}
c AS (SELECT n0.doc_id, n0.src, n0.leaf, n0.idx, u0.idx AS sidx, u0.d AS subroot, CASE WHEN due THEN other ELSE leaf END AS x, '' AS proof FROM n0 JOIN u0 ON u0.own=n0.src),
{climb("n", "c")}
{climb("u", f"n_{levels - 1}")}
root AS (SELECT d AS root FROM u{levels})
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, x AS folded_root, x=root AS verified FROM u_{levels - 1}, root"""


ORACLE = _oracle()
