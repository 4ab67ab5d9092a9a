"""Choosing articles among candidates: scorers and the strict parser of their answers."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkflow.operators import pages


class Scorer(Protocol):
    """Picks rows of ``eligible`` candidates; its result holds a subset of them."""

    def __call__(self, eligible: DataFrame) -> DataFrame: ...


def heuristic(eligible: DataFrame) -> DataFrame:
    return pages.heuristic_picks(eligible)


def parse_ids(answer: Column, key: str, n: Column) -> Column:
    """Distinct ids in range, in order, of the list under ``key`` in the outermost ``{...}`` of a text.

    Integers and integer strings count; booleans, anything else, and other shapes do not.
    """
    body = F.regexp_extract(answer, r"(?s)(\{.*\})", 1)
    raw = F.try_variant_get(F.try_parse_json(F.nullif(body, F.lit(""))), f"$.{key}", "array<string>")
    kinds = F.transform(F.try_variant_get(F.try_parse_json(F.nullif(body, F.lit(""))), f"$.{key}", "array<variant>"), F.schema_of_variant)
    both = F.filter(F.arrays_zip(raw.alias("v"), kinds.alias("k")), lambda x: x["k"] != "BOOLEAN")
    ids = F.transform(
        both,
        lambda x: F.expr("1") * F.when(F.trim(x["v"]).rlike(r"^[+-]?\d{1,9}$"), F.trim(x["v"]).try_cast("int")).otherwise(F.when((x["k"] != "STRING") & x["v"].rlike(r"^-?\d{1,9}\.\d*$"), x["v"].try_cast("double").cast("int")))
    )
    good = F.filter(ids, lambda i: i.isNotNull() & (i >= 0) & (i < n))
    return F.coalesce(F.array_distinct(good), F.expr("cast(array() as array<int>)"))


def picked(candidates: DataFrame, picks: DataFrame) -> DataFrame:
    """Candidates whose URL a scorer named; a trailing slash more or less does not matter."""
    bare = lambda c: F.regexp_replace(F.col(c), "/+$", "")
    return candidates.withColumn("bare", bare("link_url")).join(picks.select(bare("url").alias("bare")).distinct(), "bare", "left_semi").drop("bare")


def choose(candidates: DataFrame, known: DataFrame, scorer: Scorer = heuristic, baseline_only: bool = False) -> DataFrame:
    """Scores only what is not known yet: the anti-join stands before the costly scorer."""
    if baseline_only:
        return candidates.limit(0)
    return scorer(candidates.join(known.select(F.col("url").alias("link_url")).distinct(), "link_url", "left_anti"))
