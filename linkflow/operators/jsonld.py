"""The article body of JSON-LD documents by variant expressions, without Python.

The walk is depth first in the order of the keys that may hold the body, as ``dom.article_body``
walks: each level of nesting is one explode of the documents that still have something to open, and a
value's place is the path of its indices, so the first body of a document is the one with the least
path. The levels end with the deepest document.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkflow.functions.dom import BODY_KEY, BODY_PARENTS


def _is(v: Column, kind: str) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith(kind), F.lit(False))


def _get(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def bodies(docs: DataFrame, key: str, column: str, keep=lambda df, name: df) -> DataFrame:
    """``key, body`` of each document whose JSON text in ``column`` holds a non-blank body; ``keep(df, name)`` saves a table."""
    rows = docs.select(key, F.try_parse_json(column).alias("v"), F.lit("").alias("path")).where("v IS NOT NULL")
    found = []
    while not rows.isEmpty():
        v = F.col("v")
        body = F.when(_is(v, "OBJECT") & _is(_get(v, f"$.{BODY_KEY}"), "STRING"), F.try_variant_get(v, f"$.{BODY_KEY}", "string"))
        # A body closes its branch, a blank one does not; of the rest, lists and the keys that may hold a body are opened.
        looked = rows.withColumn("body", F.when(F.trim(F.regexp_replace(body, r"\s+", " ")) != "", body))
        looked = keep(looked, f"jsonld{len(found)}")
        found.append(looked.where("body IS NOT NULL").select(key, "path", "body"))
        inner = F.when(_is(v, "ARRAY"), F.try_variant_get(v, "$", "array<variant>")).when(_is(v, "OBJECT"), F.array(*[_get(v, f"$['{k}']") for k in BODY_PARENTS]))
        opened = looked.where("body IS NULL").select(key, "path", F.posexplode(inner).alias("at", "v")).where("v IS NOT NULL")
        rows = opened.select(key, "v", F.concat("path", F.lpad(F.col("at").cast("string"), 10, "0")).alias("path"))
    if not found:
        return rows.select(key, F.lit("").alias("body"))
    every = reduce(DataFrame.unionByName, found)
    return every.groupBy(key).agg(F.min_by("body", "path").alias("body"))
