"""The source dimension: configuration read on the driver, checked as a DataFrame."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkflow import schemas

# The configuration's enumerations.
COLLECT_MODES = ("auto", "rss", "html_llm", "browser_llm")
ACCESS_STATUSES = ("direct", "browser_required", "intermittent", "blocked")


def from_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Coerced sources of plain dictionaries; rows without id or home_url go."""
    text = lambda r, k: str(r.get(k) or "").strip()
    words = lambda r, k: [str(x).strip() for x in (r.get(k) or []) if str(x).strip()]
    out = []
    for r in rows:
        if not text(r, "id") or not text(r, "home_url"):
            continue
        ssl = r.get("ssl_verify")
        out.append((
            text(r, "id"), text(r, "name") or text(r, "id"), text(r, "home_url"), text(r, "rss_url"), text(r, "collect_mode").lower() or "auto",
            words(r, "tags"), bool(r.get("enabled", True)), bool(r.get("browser_fallback", False)), None if ssl is None else bool(ssl), text(r, "notes"),
            words(r, "allowed_hosts"), words(r, "strip_query_keys"), text(r, "access_status").lower() or "direct", text(r, "access_issue"),
            text(r, "access_tested_at"), text(r, "access_tested_via"),
        ))
    return spark.createDataFrame(out, schemas.SOURCE)


def load(spark: SparkSession, path: str) -> DataFrame:
    """Sources of a YAML file (a list, or a mapping with ``sources``); a missing file raises."""
    import yaml

    doc = yaml.safe_load(Path(path).read_text(encoding="utf-8")) or []
    return from_rows(spark, (doc.get("sources") or []) if isinstance(doc, dict) else doc)


def enabled(sources: DataFrame) -> DataFrame:
    return sources.where("enabled")


def strict(sources: DataFrame) -> DataFrame:
    """Raises for an unknown mode or status, and for rss without a feed URL, when it is computed."""
    wrong = F.when(~F.col("collect_mode").isin(*COLLECT_MODES), F.concat(F.lit("collect_mode: "), "collect_mode")).when(
        ~F.col("access_status").isin(*ACCESS_STATUSES), F.concat(F.lit("access_status: "), "access_status")
    )
    wrong = wrong.when((F.col("collect_mode") == "rss") & (F.col("rss_url") == ""), F.lit("rss without rss_url"))
    return sources.withColumn("id", F.when(wrong.isNotNull(), F.raise_error(F.concat(F.col("id"), F.lit(": "), wrong)).cast("string")).otherwise(F.col("id")))


def _rules() -> list[tuple[str, Column]]:
    c = F.col
    return [
        ("auto mode", c("collect_mode") == "auto"),
        ("unknown mode", ~c("collect_mode").isin(*COLLECT_MODES)),
        ("unknown access status", ~c("access_status").isin(*ACCESS_STATUSES)),
        ("rss needs rss_url", (c("collect_mode") == "rss") & (c("rss_url") == "")),
        ("browser mode needs browser_fallback", (c("collect_mode") == "browser_llm") & ~c("browser_fallback")),
        ("browser_required needs browser_fallback", (c("access_status") == "browser_required") & ~c("browser_fallback")),
        ("blocked but enabled", (c("access_status") == "blocked") & c("enabled")),
    ]


def validate(sources: DataFrame) -> DataFrame:
    """(id, rule) of every broken rule, duplicate ids included."""
    broken = sources.select("id", F.explode(F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in _rules()]))).alias("rule"))
    twice = sources.groupBy("id").count().where("count > 1").select("id", F.lit("duplicate id").alias("rule"))
    return broken.union(twice)


def mode_counts(sources: DataFrame) -> DataFrame:
    return sources.groupBy("collect_mode").agg(F.count("*").alias("n"))


def select_ids(sources: DataFrame, ids: list[str]) -> tuple[DataFrame, DataFrame]:
    """The requested sources, and the requested ids that no source has."""
    asked = sources.sparkSession.createDataFrame([(i,) for i in ids], "id string")
    return sources.join(asked, "id", "left_semi"), asked.join(sources, "id", "left_anti")
