"""Dates in headers and metadata."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
_MONTH = "(Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
_DAY = "(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)"
_CLOCK = "([0-9]{2}:[0-9]{2}:[0-9]{2})"
#: The three layouts of HTTP dates, each with the groups of year, month, day and clock.
LAYOUTS = (
    (rf"^{_DAY}, ([0-9]{{2}}) {_MONTH} ([0-9]{{4}}) {_CLOCK} GMT$", (3, 2, 1, 4)),
    (rf"^(?:Mon|Tues|Wednes|Thurs|Fri|Satur|Sun)day, ([0-9]{{2}})-{_MONTH}-([0-9]{{2}}) {_CLOCK} GMT$", (3, 2, 1, 4)),
    (rf"^{_DAY} {_MONTH} ([ 0-9][0-9]) {_CLOCK} ([0-9]{{4}})$", (4, 1, 2, 3)),
)
#: Years of two digits above this one are of the last century.
PIVOT = 60


def http_date(text: Column) -> Column:
    """Timestamp of an HTTP date in any of its layouts, else null; the weekday isn't held against the date."""
    out = F.lit(None).cast("timestamp")
    for pattern, (y, m, d, clock) in reversed(LAYOUTS):
        part = lambda n, pattern=pattern: F.regexp_extract(text, pattern, n)
        year = F.when(F.length(part(y)) == 4, part(y)).when(part(y).cast("int") > PIVOT, F.concat(F.lit("19"), part(y))).otherwise(F.concat(F.lit("20"), part(y)))
        month = F.lpad(((F.position(part(m), F.lit(MONTHS)) + 2) / 3).cast("int").cast("string"), 2, "0")
        written = F.concat(year, F.lit("-"), month, F.lit("-"), F.lpad(F.trim(part(d)), 2, "0"), F.lit(" "), part(clock))
        out = F.when(text.rlike(pattern), F.try_to_timestamp(written, F.lit("yyyy-MM-dd HH:mm:ss"))).otherwise(out)
    return out


def true_modification(modified: Column, served: Column) -> Column:
    """Last-Modified, null where it only repeats the server's date."""
    return F.when(~modified.eqNullSafe(served), modified)


def date_violations(capture: Column, modified: Column, memento: Column, served: Column) -> Column:
    """Names of the rules that the dates break, in order; null dates break none. A month has 30 days."""
    seconds = lambda c: F.unix_timestamp(c)
    ahead = lambda c: seconds(c) - seconds(capture)
    rules = {"last-modified-after-capture": ahead(modified) > 3600, "memento-off-by-an-hour": F.abs(ahead(memento)) > 3600, "server-date-off-by-a-month": F.abs(ahead(served)) > 30 * 86400}
    return F.array_compact(F.array(*(F.when(rule, name) for name, rule in rules.items())))


def metadata_date(text: Column, utc: bool) -> Column:
    """An item's date in one spelling: ISO if in UTC, else a space between day and clock; other texts as they are."""
    layout, shown = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'") if utc else ("yyyyMMddHHmmss", "yyyy-MM-dd HH:mm:ss")
    return F.nullif(F.coalesce(F.date_format(F.try_to_timestamp(text, F.lit(layout)), shown), text), F.lit(""))


def precise_stamp(millis: Column) -> Column:
    """ISO text with nine digits, the last six of them zeros, of a fetch time in milliseconds."""
    return F.date_format(F.timestamp_millis(millis), "yyyy-MM-dd'T'HH:mm:ss.SSS'000000Z'")
