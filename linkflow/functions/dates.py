"""Date functions. Times are ISO-8601 strings; session time zone is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RFC822 = "d MMM yyyy HH:mm:ss Z"
# The zone names of mail dates. Other names say nothing, and count as UTC.
ZONES = {
    "AST": "-0400", "ADT": "-0300", "EST": "-0500", "EDT": "-0400", "CST": "-0600", "CDT": "-0500",
    "MST": "-0700", "MDT": "-0600", "PST": "-0800", "PDT": "-0700",
}


def beijing_date(ts: Column) -> Column:
    """The UTC+8 calendar date of a UTC time."""
    return F.date_format(ts + F.expr("INTERVAL 8 HOURS"), "yyyy-MM-dd")


def format_iso(ts: Column) -> Column:
    """``2026-01-02T03:04:05[.ffffff]+00:00``; a fraction of zero is left out."""
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)), F.lit("+00:00"))


def to_iso(x: Column) -> Column:
    """UTC ISO form of a time string; what cannot be read stays as it is."""
    return F.coalesce(format_iso(F.try_to_timestamp(F.regexp_replace(x, "Z$", "+00:00"))), x, F.lit(""))


def _plain(x: Column) -> Column:
    """A feed date without its weekday, its year in four digits, its zone as an offset."""
    bare = F.regexp_replace(F.trim(x), r"^[A-Za-z]{3,9},?\s+", "")
    # Years of two digits: 69 to 99 are of the last century.
    bare = F.regexp_replace(bare, r"^(\d{1,2}\s+[A-Za-z]{3,9}\s+)(69|[7-9]\d)(\s)", "$119$2$3")
    bare = F.regexp_replace(bare, r"^(\d{1,2}\s+[A-Za-z]{3,9}\s+)(\d{2})(\s)", "$120$2$3")
    name = F.upper(F.regexp_extract(bare, r"\s([A-Za-z]{1,5})$", 1))
    offset = F.coalesce(*[F.when(name == n, z) for n, z in ZONES.items()], F.lit("+0000"))
    named = F.when(name != "", F.concat(F.regexp_replace(bare, r"\s+[A-Za-z]{1,5}$", " "), offset))
    # A date without a zone counts as UTC.
    return named.when(bare.rlike(r"\s\d{1,2}:\d{2}(:\d{2})?$"), F.concat(bare, F.lit(" +0000"))).otherwise(bare)


def parse_rfc822(x: Column) -> Column:
    """Feed dates; the weekday is dropped, as it cannot be parsed, and zone names become offsets."""
    bare = _plain(x)
    return F.coalesce(F.try_to_timestamp(bare, F.lit(RFC822)), F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm Z")))


def rfc822_iso(x: Column) -> Column:
    """A feed date as ISO text in its own offset, which decides the order of feed items as text.

    ``-0000`` says that the zone is not known, and counts as UTC.
    """
    ts, zone = parse_rfc822(x), F.regexp_extract(_plain(x), r"([+-]\d{4})$", 1)
    zone = F.when(zone.isin("", "-0000"), "+0000").otherwise(zone)
    minutes = (F.substring(zone, 2, 2).cast("int") * 60 + F.substring(zone, 4, 2).cast("int")) * F.when(zone.startswith("-"), -1).otherwise(1)
    local = F.timestamp_seconds(F.unix_timestamp(ts) + minutes * 60)
    return F.concat(F.date_format(local, "yyyy-MM-dd'T'HH:mm:ss"), F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2))


def published(*xs: Column) -> Column:
    """The first readable of several date strings, as ISO text: feed dates in their own offset, others in UTC."""
    return F.coalesce(*[F.coalesce(rfc822_iso(x), format_iso(F.try_to_timestamp(x))) for x in xs], F.lit(""))


def window_hours(start: Column, end: Column) -> Column:
    """Whole hours between two times; nothing or zero counts as 24."""
    s, e = F.try_to_timestamp(start), F.try_to_timestamp(end)
    hours = F.floor((F.unix_micros(e) - F.unix_micros(s)) / F.lit(3_600_000_000))
    return F.coalesce(F.nullif(hours, F.lit(0)), F.lit(24)).cast("long")
