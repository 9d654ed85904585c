"""Column expressions for times (TIM1, TIM3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: formats -------------------------------------------------
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# HTTP-date forms: "Sun, 06 Nov 1994 08:49:37 GMT", "Sunday, 06-Nov-94 08:49:37
# GMT", "Sun Nov  6 08:49:37 1994". Weekday and, but for the last, zone are
# required. (form, pattern of the date inside it)
_WEEKDAY = "(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)"
_LONG_WEEKDAY = "(?:Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day"
HTTP_DATE_FORMS = [
    (rf"^{_WEEKDAY}, ([0-9]{{2}} [A-Za-z]{{3}} [0-9]{{4}} [0-9:]{{8}}) (\S+)$", "dd MMM yyyy HH:mm:ss"),
    (rf"^{_LONG_WEEKDAY}, ([0-9]{{2}}-[A-Za-z]{{3}}-[0-9]{{2}} [0-9:]{{8}}) (\S+)$", "dd-MMM-yy HH:mm:ss"),
    (rf"^{_WEEKDAY} ([A-Za-z]{{3}} [0-9]{{1,2}} [0-9:]{{8}} [0-9]{{4}})()$", "MMM d HH:mm:ss yyyy"),
]
# Hours from UTC of the zone names of mail and HTTP dates.
ZONE_HOURS = {
    "": 0, "GMT": 0, "UTC": 0, "UT": 0, "Z": 0, "EST": -5, "EDT": -4, "CST": -6, "CDT": -5, "MST": -7, "MDT": -6, "PST": -8, "PDT": -7,
}
# ----------------------------------------------------------------------------


def iso_seconds(ts: Column) -> Column:
    """ISO-8601, whole seconds, UTC (the session time zone must be UTC)."""
    return F.date_format(ts, ISO_SECONDS)


def event_time(given: Column, ts: Column) -> Column:
    """TIM1: the caller's timestamp, else the call time."""
    return F.coalesce(given, iso_seconds(ts))


def _trim_spaces(c: Column) -> Column:
    # Spaces and tabs only: newlines are not trimmed.
    return F.regexp_replace(c, r"^[\p{Zs}\t]+|[\p{Zs}\t]+$", "")


def parse_http_date(text: Column, now: Column) -> Column:
    """HTTP-date (RFC 7231 forms with their weekday and zone; a zone is a name
    of ``ZONE_HOURS`` or a numeric offset) to a timestamp, else NULL.

    A two-digit year more than 50 years after ``now`` is taken as 19xx.
    """
    t = F.regexp_replace(text, " {2,}", " ")

    def read(form: str, pattern: str) -> Column:
        zone = F.regexp_extract(t, form, 2)
        named = F.try_element_at(F.create_map(*[F.lit(x) for kv in ZONE_HOURS.items() for x in kv]), zone) * 3600
        offset = r"^(?:GMT|UTC)?([+-])([0-9]{1,2}):?([0-9]{2})$"
        part = lambda i: F.regexp_extract(zone, offset, i)
        numeric = (part(2).try_cast("int") * 3600 + part(3).try_cast("int") * 60) * F.when(part(1) == "-", F.lit(-1)).otherwise(F.lit(1))
        seconds = F.coalesce(named, F.when(zone.rlike(offset), numeric))
        local = F.try_to_timestamp(F.regexp_extract(t, form, 1), F.lit(pattern))
        return F.when(t.rlike(form) & seconds.isNotNull(), F.timestamp_micros(F.unix_micros(local) - seconds.cast("bigint") * 1_000_000))

    parsed = F.coalesce(*[read(*f) for f in HTTP_DATE_FORMS])
    too_far = F.year(parsed) > F.year(now) + 50
    return F.when(too_far, F.add_months(parsed, -1200)).otherwise(parsed)


def retry_after_ms(headers: Column, now: Column) -> Column:
    """TIM3: Retry-After (any letter case) in ms from ``now``; integer seconds
    or HTTP-date, both floored at 0; NULL when absent or unreadable."""
    hit = F.map_filter(headers, lambda k, v: F.lower(k) == "retry-after")
    raw = F.try_element_at(F.map_values(hit), F.lit(1))
    trimmed = _trim_spaces(raw)
    seconds = F.when(trimmed.rlike(r"^[+-]?[0-9]+$"), trimmed.try_cast("bigint"))
    date = parse_http_date(raw, now)
    date_ms = F.unix_millis(date) - F.unix_millis(now)
    return (
        F.when(seconds.isNotNull(), F.greatest(F.lit(0), F.try_multiply(seconds, F.lit(1000).cast("bigint"))))
        .when(date.isNotNull(), F.greatest(F.lit(0), date_ms))
        .cast("bigint")
    )
