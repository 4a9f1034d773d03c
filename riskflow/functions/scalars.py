"""Small scalar column helpers shared by operators (all JVM-side built-ins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_prefix_int(s: Column) -> Column:
    """First 32 bits of md5(s) as a non-negative BIGINT. Stable across engines and across
    repartitioning (unlike randomSplit), so splits and labels are reproducible."""
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint")


def flag(cond: Column) -> Column:
    """1 when cond holds, else 0; NULL counts as false."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def pct_change(base: Column, recent: Column) -> Column:
    """(recent - base) / base * 100, and 0.0 where the base is 0 (guarded: ANSI division by
    zero would raise)."""
    return F.when(base != 0, (recent - base) / base * F.lit(100.0)).otherwise(F.lit(0.0))


def hour_from_text(ts_text: Column) -> Column:
    """Hour by text slice: characters 12-13 of the timestamp text as INT, NULL if not a
    number (an ISO text ``YYYY-MM-DDTHH...`` gives its own wall-clock hour)."""
    return F.substring(ts_text, 12, 2).try_cast("int")


# Fixed value: an ISO text that names at least a day
ISO_DAY = r"^\d{4}-\d{2}-\d{2}([T ]|$)"
# Fixed value: a trailing UTC offset after an ISO date-time ("Z", "+05:30", "-0800", "+01")
ISO_OFFSET = r"^(\d{4}-\d{2}-\d{2}[T ][0-9:.]+)(Z|z|[+-]\d{2}(:?\d{2})?)$"


def hour_iso_wallclock(ts_text: Column) -> Column:
    """Hour of an ISO-8601 text in the text's own offset (its wall clock): the offset is
    stripped and the rest parsed, so "...T03:04:05+05:30" gives 3 and a date alone gives 0.
    NULL when the text does not parse as a timestamp or names no day ("2026-04", "12:30:00")."""
    local = F.regexp_replace(ts_text, ISO_OFFSET, "$1")
    whole = ts_text.rlike(ISO_DAY) & F.try_to_timestamp(ts_text).isNotNull()
    return F.when(whole, F.hour(F.try_to_timestamp(local)))


def hour_session(ts_text: Column) -> Column:
    """Hour of the parsed instant in the session time zone (pinned to UTC by riskflow)."""
    return F.hour(F.try_to_timestamp(ts_text))
