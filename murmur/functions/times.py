"""Time helpers: job windows (C14), recency buckets (C15), mixed publish-time parsing.

A window is one column expression for literals and per-row values alike; a literal window is folded
into two literal bounds, and Catalyst pushes the predicate into the parquet scan.
"""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The grammar of job windows (a number and a unit, or two dates) and its date patterns.
INTERVAL = r"^(\d+)\s*(d|w|m|y|h)$"
DATES = r"^(.*?)\s+(?:-|to)\s+(.*)$"
DATE_PATTERNS = ("d/M/yyyy", "yyyy-M-d", "M/d/yyyy")
DEFAULT_DAYS = 30

# Length of one unit as (months, days, hours).
UNITS = {"h": (0, 0, 1), "d": (0, 1, 0), "w": (0, 7, 0), "m": (1, 0, 0), "y": (12, 0, 0)}


def ntz_literal(dt: datetime) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{dt:%Y-%m-%d %H:%M:%S}'")


def window_bounds_col(interval: Column | str, now: datetime) -> tuple[Column, Column]:
    """C14: start and end of a job window ('30d', '24h', 'a - b', 'a to b'), per row or of a literal.

    Units are looked up in one table; months clamp at the month end. A pair of dates counts if both
    read by the same pattern, else the window is empty (now, now). Anything else is 30 days back.
    A literal window folds to two literals, so predicates on it reach the scan.
    """
    text = F.lower(F.trim(F.col(interval) if isinstance(interval, str) else interval))
    n = F.when(text.rlike(INTERVAL), F.regexp_extract(text, INTERVAL, 1)).cast("int")
    unit = F.regexp_extract(text, INTERVAL, 2)

    def length(part: int) -> Column:
        sizes = F.create_map(*[x for u, v in UNITS.items() for x in (F.lit(u), F.lit(v[part]))])
        return n * F.try_element_at(sizes, unit)
    end = ntz_literal(now)
    back = end - F.make_ym_interval(months=length(0)) - F.make_dt_interval(days=length(1), hours=length(2))
    pair = [[F.try_to_timestamp(F.trim(F.regexp_extract(text, DATES, g)), F.lit(f)).cast("timestamp_ntz") for g in (1, 2)]
            for f in DATE_PATTERNS]
    whole = [(F.when(b.isNotNull(), a), F.when(a.isNotNull(), b)) for a, b in pair]
    dated = text.rlike(DATES)
    start = F.when(dated, F.coalesce(*[a for a, _ in whole], end)) \
        .otherwise(F.coalesce(back, end - F.make_dt_interval(days=F.lit(DEFAULT_DAYS))))
    return start, F.when(dated, F.coalesce(*[b for _, b in whole], end)).otherwise(end)


def in_window(ts: Column | str, value: str | None, today: datetime) -> Column:
    """Window predicate on a timestamp column: hour windows compare timestamps, all others whole
    days with both ends included."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    lo, hi = window_bounds_col(F.lit(value or ""), today)
    if re.search(r"\d\s*h\s*$", value or "", re.I):
        return ts.between(lo, hi)
    day = lambda c, n: F.date_add(F.to_date(c), n).cast("timestamp_ntz")
    return (ts >= day(lo, 0)) & (ts < day(hi, 1))


def window_start_col(interval: Column | str, now: datetime) -> Column:
    """C14 per row (e.g. one window per job): the start of the window."""
    return window_bounds_col(interval, now)[0]


def recency_bucket(days: Column) -> Column:
    """Coarse recency class of an age in days: <=1 today, <=7 week, <=30 month, else year."""
    return (F.when(days <= 1, "today").when(days <= 7, "week").when(days <= 30, "month").otherwise("year"))


# Month-name prefixes accepted in day-month-year publish dates (Indonesian and English,
# matched on the first three letters, lower case).
MONTH_PREFIXES = {
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "mei": 5, "may": 5, "jun": 6, "jul": 7,
    "agu": 8, "aug": 8, "sep": 9, "okt": 10, "oct": 10, "nov": 11, "des": 12, "dec": 12,
}


def _month_number(prefix: Column) -> Column:
    m = F.create_map(*[x for k, v in MONTH_PREFIXES.items() for x in (F.lit(k), F.lit(v))])
    return F.try_element_at(m, prefix)


#: Epoch values from here on are milliseconds (as seconds they lie beyond the year 5138).
MILLISECONDS = 100_000_000_000


def parse_publish_time(text: Column | str) -> Column:
    """Mixed publish-time text -> TIMESTAMP_NTZ in UTC (NULL when nothing matches).

    ISO-8601 dates and times with `T` or a blank, minutes only, seconds or fractions, without zone
    (read as UTC), with `Z` or an offset (turned to UTC); a date alone; `d <month> yyyy` with an
    Indonesian or English month name; epoch seconds, or milliseconds from 10^11 on. Empty, zero and
    unparseable values give NULL (never 1970). ANSI mode is on, so only `try_*` forms.
    """
    t = F.trim(F.col(text) if isinstance(text, str) else text)
    iso = r"^(\d{4}-\d{2}-\d{2})(?:[T ](\d{2}:\d{2})(?::(\d{2})(?:\.(\d+))?)?\s*(Z|z|[+-]\d{2}:?\d{2})?)?$"
    part = lambda k, default: F.coalesce(F.nullif(F.regexp_extract(t, iso, k), F.lit("")), F.lit(default))
    local = F.try_to_timestamp(
        F.concat(part(1, ""), F.lit(" "), part(2, "00:00"), F.lit(":"), part(3, "00"), F.lit("."), F.substring(F.rpad(part(4, "0"), 6, "0"), 1, 6)),
        F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")).cast("timestamp_ntz")
    zone = F.replace(F.regexp_extract(t, iso, 5), F.lit(":"), F.lit(""))
    minutes = F.when(zone.rlike(r"^[+-]\d{4}$"), F.when(zone.startswith("-"), -1).otherwise(1)
                     * (F.substring(zone, 2, 2).cast("int") * 60 + F.substring(zone, 4, 2).cast("int"))).otherwise(0)
    iso_time = F.when(t.rlike(iso), local - F.make_dt_interval(mins=minutes))
    dmy = r"^(\d{1,2})\s+([A-Za-z]+)\s+(\d{4})$"
    month = _month_number(F.lower(F.substring(F.regexp_extract(t, dmy, 2), 1, 3)))
    canon = F.concat_ws("-", F.regexp_extract(t, dmy, 3), month.cast("string"), F.regexp_extract(t, dmy, 1))
    named = F.when(t.rlike(dmy), F.try_to_timestamp(canon, F.lit("yyyy-M-d")).cast("timestamp_ntz"))
    number = F.when(t.rlike(r"^\d{1,15}(\.\d+)?$"), t.cast("double"))
    secs = F.when(number >= MILLISECONDS, number / 1000).otherwise(number)
    epoch = F.when(secs > 0, epoch_to_ntz(secs))
    return F.coalesce(iso_time, named, epoch)


def window_recency_bucket(interval: Column | str, now: datetime) -> Column:
    """C15 per job: the coarse upload-date filter for a job's window ('24h' -> today, '7d' -> week,
    '1m' -> month, '1y' -> year), from the window's length in days."""
    days = F.datediff(F.to_date(ntz_literal(now)), F.to_date(window_start_col(interval, now)))
    return recency_bucket(days)


def epoch_to_ntz(secs: Column) -> Column:
    """Epoch seconds -> TIMESTAMP_NTZ wall time in UTC, whatever the session time zone."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.timestamp_seconds(secs).cast("timestamp_ntz"))


def iso_day(c: Column | str) -> Column:
    """DATE -> 'yyyy-MM-dd' (serving format)."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd")


def iso_ts(c: Column | str) -> Column:
    """TIMESTAMP -> 'yyyy-MM-dd HH:mm:ss' (serving format)."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss")
