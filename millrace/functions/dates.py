"""Date expressions, in UTC; the present is always given as a value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(day: Column) -> Column:
    """The Monday of the day's week."""
    return F.date_trunc("week", day).cast("date")


def week_end(day: Column) -> Column:
    """The Friday of that week."""
    return F.date_add(week_start(day), 4)


def week_title(day: Column) -> Column:
    return F.concat(F.date_format(week_start(day), "yyyy-MM-dd"), F.lit(" to "), F.date_format(week_end(day), "yyyy-MM-dd"))


def parse_iso(text: Column) -> Column:
    """An ISO date or time, zoneless as UTC; null if it isn't one."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(text), r"Z$", "+00:00"))


def parse_any(text: Column, now: Column) -> Column:
    """ISO, epoch seconds or milliseconds, RFC 2822, ``3 hours ago``, today and yesterday; else null."""
    text = F.trim(text)
    number = text.try_cast("bigint")
    ago = F.regexp_extract(text, r"(?i)^(\d+)\s*(?:minutes?|mins?|hours?|hrs?|days?|[mhd])\s+ago$", 1).try_cast("bigint")
    unit = F.lower(F.regexp_extract(text, r"(?i)^\d+\s*([mhd])", 1))
    seconds = ago * F.when(unit == "m", 60).when(unit == "h", 3600).otherwise(86400)
    day = F.date_trunc("day", now)
    return F.coalesce(
        F.when(text.rlike(r"^\d{13}$"), F.timestamp_millis(number)),
        F.when(text.rlike(r"^\d{10}$"), F.timestamp_seconds(number)),
        F.when(ago.isNotNull(), F.timestamp_seconds(F.unix_timestamp(now) - seconds)),
        F.when(F.lower(text) == "today", day),
        F.when(F.lower(text) == "yesterday", day - F.expr("INTERVAL 1 DAY")),
        F.try_to_timestamp(F.regexp_replace(text, r"^\p{L}{3}, ", ""), F.lit("d MMM yyyy HH:mm:ss Z")),
        F.try_to_timestamp(text, F.lit("d MMM yyyy")),
        F.try_to_timestamp(text, F.lit("MMM d, yyyy")),
        F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), parse_iso(text)),
    )


def freshness(published: Column, precise: Column, now: Column, days: int = 3) -> Column:
    """current, stale, future or unknown; a time known to the day counts as that whole day."""
    last = F.when(precise, published).otherwise(published + F.expr("INTERVAL 1 DAY"))
    return F.when(published.isNull(), "unknown").when(published > now, "future").when(last >= now - F.expr(f"INTERVAL {days} DAYS"), "current").otherwise("stale")


def is_due(kind: Column, frequency: Column, last_attempt: Column, now: Column) -> Column:
    """Publishers whose interval has passed since the last attempt, or that had none; those on demand never are."""
    wait = F.unix_timestamp(now) - F.unix_timestamp(last_attempt)
    return (kind == "Publisher") & (frequency != "On Demand") & (last_attempt.isNull() | (wait >= F.when(frequency == "Daily", 86400).otherwise(7 * 86400)))
