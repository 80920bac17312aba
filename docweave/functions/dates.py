"""Date column functions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, strip_ws

# ISO 8601 forms ``datetime.fromisoformat`` accepts that Spark's cast reads
# the same way (week dates such as 2024-W01-1 are left out: null).
_ISO_RE = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?$"
_COMPACT_RE = r"^\d{8}$"
# RFC 2822 mail date: optional weekday, day, month name, year, time, zone.
_RFC_RE = r"^(?:[A-Za-z]{3},\s*)?(\d{1,2}\s+[A-Za-z]{3}\s+\d{4})\s+(\d{1,2}:\d{2}(?::\d{2})?)\s*([+-]\d{4}|[A-Za-z]{1,5})?$"


def _iso_text(raw: Column) -> Column:
    s = F.regexp_replace(raw, "Z$", "+00:00")
    return F.when(raw.rlike(_ISO_RE), F.regexp_replace(s, ",", "."))


def parse_datetime(c) -> Column:
    """ISO (with 'Z') else RFC-2822 mail date else null -> timestamp (UTC instant)."""
    raw = strip_ws(col(c))
    iso = _iso_text(raw).try_cast("timestamp")
    compact = F.when(raw.rlike(_COMPACT_RE), F.try_to_timestamp(raw, F.lit("yyyyMMdd")))
    day = F.regexp_extract(raw, _RFC_RE, 1)
    clock = F.regexp_extract(raw, _RFC_RE, 2)
    zone = F.regexp_extract(raw, _RFC_RE, 3)
    clock = F.when(F.length(clock) <= 5, F.concat(clock, F.lit(":00"))).otherwise(clock)
    clock = F.when(clock.rlike(r"^\d:"), F.concat(F.lit("0"), clock)).otherwise(clock)
    zone = (F.when(zone.rlike(r"^[+-]\d{4}$"), zone)
            .when(F.upper(zone).isin("", "GMT", "UT", "UTC", "Z"), F.lit("+0000"))
            .when(F.upper(zone) == "EST", F.lit("-0500")).when(F.upper(zone) == "EDT", F.lit("-0400"))
            .when(F.upper(zone) == "CST", F.lit("-0600")).when(F.upper(zone) == "CDT", F.lit("-0500"))
            .when(F.upper(zone) == "MST", F.lit("-0700")).when(F.upper(zone) == "MDT", F.lit("-0600"))
            .when(F.upper(zone) == "PST", F.lit("-0800")).when(F.upper(zone) == "PDT", F.lit("-0700")))
    rfc = F.when(day != "", F.try_to_timestamp(
        F.concat_ws(" ", day, clock, zone), F.lit("d MMM yyyy HH:mm:ss Z")))
    return F.when(raw == "", F.lit(None)).otherwise(F.coalesce(iso, compact, rfc))


def local_date(c) -> Column:
    """U8: calendar date of a raw timestamp text in its own offset.

    Spark timestamps forget the offset, so the date is read from the text
    (``2024-01-01T23:30:00-05:00`` -> 2024-01-01), and only where the whole
    value parses (U7).
    """
    raw = strip_ws(col(c))
    parsed = parse_datetime(raw)
    iso_day = F.when(raw.rlike(_ISO_RE), F.substring(raw, 1, 10).try_cast("date"))
    compact_day = F.when(raw.rlike(_COMPACT_RE), F.to_date(F.try_to_timestamp(raw, F.lit("yyyyMMdd"))))
    rfc_day = F.to_date(F.try_to_timestamp(F.regexp_extract(raw, _RFC_RE, 1), F.lit("d MMM yyyy")))
    return F.when(parsed.isNotNull(), F.coalesce(iso_day, compact_day, rfc_day))


def parse_cli_date(value: str) -> _dt.date:
    """ISO date parameter, or ValueError."""
    try:
        return _dt.date.fromisoformat(value)
    except ValueError as exc:
        raise ValueError(f"Invalid date '{value}'. Use YYYY-MM-DD.") from exc


def date_parameter(c) -> Column:
    """U9 on a column: an ISO date (with or without hyphens), null if it is none."""
    text = col(c)
    return (F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))
            .when(text.rlike(r"^\d{8}$"), F.to_date(F.try_to_timestamp(text, F.lit("yyyyMMdd")))))


def window_parameters(start, end, today) -> dict[str, Column]:
    """P5 + U9 on columns: ``start_date`` and ``end_date`` of a run (missing ones: the thirty days up to ``today``) and the
    ``problem`` that stops it."""
    start, end, today = col(start), col(end), col(today)
    first = F.when(start.isNull(), F.date_sub(today, 30)).otherwise(date_parameter(start))
    last = F.when(end.isNull(), today).otherwise(date_parameter(end))
    bad = F.when(first.isNull(), start).when(last.isNull(), end)
    return {"start_date": first, "end_date": last, "problem": F.when(bad.isNotNull(), F.concat(
        F.lit("Invalid date '"), bad, F.lit("'. Use YYYY-MM-DD."))).when(first > last, "start date cannot be after end date")}


def default_window(today: _dt.date | None = None) -> tuple[_dt.date, _dt.date]:
    """P5: (today - 30 days, today)."""
    today = today or _dt.date.today()
    return today - _dt.timedelta(days=30), today


def check_window(start: _dt.date | None, end: _dt.date | None) -> None:
    if start is not None and end is not None and start > end:
        raise ValueError("start date cannot be after end date")


def utc_now() -> Column:
    """U10 (session time zone is pinned to UTC)."""
    return F.current_timestamp()
