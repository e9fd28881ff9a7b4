"""Free-form timestamp parsing (PRJ12-14) by a small grammar.

A date is a day, a month and a year in one of five orders, with a time and a zone
that may be missing: ``12 Nov 2020``, ``Nov 12, 2020``, asctime, ``2020-11-12``,
``11/12/2020`` (month first, unless that is over 12), or seconds or milliseconds
since 1970. Weekdays, ``st``/``nd``/``rd``/``th``, ``at``, commas and fractions of
a second are read and dropped; months and weekdays are English, by their first
three letters or in full. A text with anything else in it gives NULL (FLT5 drops
the row; ``clean.rejected_times`` counts it), never an error. Without a zone the
time is UTC, without a time it is midnight.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
WEEKDAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
# Zone names and their minutes east of Greenwich.
ZONES = {
    "Z": 0, "UTC": 0, "GMT": 0, "UT": 0, "WET": 0, "BST": 60, "CET": 60, "WEST": 60, "CEST": 120, "EET": 120, "SAST": 120, "EEST": 180,
    "MSK": 180, "IST": 330, "SGT": 480, "HKT": 480, "AWST": 480, "JST": 540, "KST": 540, "AEST": 600, "AEDT": 660, "NZST": 720, "NZDT": 780,
    "NST": -210, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480,
    "PDT": -420, "AKST": -540, "AKDT": -480, "HST": -600, "BRT": -180, "ART": -180,
}
# ---------------------------------------------------------------------------

_MON = "(" + "|".join(f"{m[:3]}(?:{m[3:]})?" if len(m) > 3 else m for m in MONTHS).replace("sep(?:tember)?", "sep(?:t(?:ember)?)?") + r")\.?"
_DAY_NAME = "(?:(?:" + "|".join(f"{d[:3]}(?:{d[3:]})?" for d in WEEKDAYS) + r"|tues|thur|thurs)\.?,?\s+)?"
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d{1,9})?)?\s*([ap])?(?:\.?m\.?)?"
_ZONE = r"\s*\(?(?:(?:utc|gmt)(?=[+-]))?(" + "|".join(sorted(ZONES, key=lambda z: (-len(z), z))) + r"|[+-]\d{1,2}(?::?\d{2})?)?\)?"
_TIME = rf"(?:(?:\s*t\s*|,?\s+(?:at\s+)?){_CLOCK}{_ZONE})?"

# Orders of the parts: a pattern and, in its groups, where year, month, day, clock (4 groups) and zone stand.
ORDERS = (
    (rf"(?i)^{_DAY_NAME}{_DAY}(?:\s+of)?[\s-]+{_MON}[\s,-]+(\d{{4}}|\d{{2}}){_TIME}$", "$3|$2|$1|$4|$5|$6|$7|$8"),
    (rf"(?i)^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}}){_TIME}$", "$1|$2|$3|$4|$5|$6|$7|$8"),
    (rf"(?i)^{_DAY_NAME}{_MON}\s+{_DAY},?\s+(\d{{4}}){_TIME}$", "$3|$1|$2|$4|$5|$6|$7|$8"),
    (rf"(?i)^{_DAY_NAME}{_MON}\s+{_DAY}\s+{_CLOCK}{_ZONE}\s+(\d{{4}})$", "$8|$1|$2|$3|$4|$5|$6|$7"),
    (rf"(?i)^(\d{{1,2}})[/.-](\d{{1,2}})[/.-](\d{{4}}|\d{{2}}){_TIME}$", "$3|$1|$2|$4|$5|$6|$7|$8|swap"),
)
EPOCH_RE = r"^\d{9,10}(?:\d{3})?$"


def _parts(s: Column) -> Column:
    """year|month|day|hour|minute|second|a or p|zone of a text in a known order."""
    out = F.lit(None).cast("string")
    for pattern, parts in reversed(ORDERS):
        out = F.when(s.rlike(pattern), F.regexp_replace(s, pattern, parts)).otherwise(out)
    return F.split(out, r"\|")


def _number(c: Column) -> Column:
    return F.nullif(c, F.lit("")).try_cast("int")


def _from_parts(p: Column) -> Column:
    year, half = _number(p[0]), F.lower(p[6])
    year = F.when(F.length(p[0]) == 2, year + 2000).otherwise(year)
    named = F.instr(F.lit("".join(m[:3] for m in MONTHS)), F.lower(F.substring(p[1], 1, 3)))
    first, second = _number(p[1]), _number(p[2])
    swap = F.get(p, F.lit(8)).isNotNull() & F.coalesce(first > 12, F.lit(False))  # 25/12/2020 can only be day first
    month = F.when(first.isNull(), ((named + 2) / 3).cast("int")).when(swap, second).otherwise(first)
    day = F.when(swap, first).otherwise(second)
    hour = F.coalesce(_number(p[3]), F.lit(0))
    hour = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    zone = F.upper(p[7])
    digits = F.rpad(F.when(F.length(F.regexp_replace(zone, r"\D", "")) % 2 == 1, F.concat(F.lit("0"), F.regexp_replace(zone, r"\D", "")))
                    .otherwise(F.regexp_replace(zone, r"\D", "")), 4, "0")
    offset = _number(F.substring(digits, 1, 2)) * 60 + _number(F.substring(digits, 3, 2))
    names = F.create_map(*[x for z, m in ZONES.items() for x in (F.lit(z), F.lit(m))])
    minutes = (F.when(F.coalesce(zone, F.lit("")) == "", 0).when(zone.startswith("+"), offset)
               .when(zone.startswith("-"), -offset).otherwise(F.try_element_at(names, zone)))
    second_of = F.coalesce(_number(p[5]), F.lit(0))
    at = F.try_make_timestamp(year, month, day, hour, F.coalesce(_number(p[4]), F.lit(0)), second_of.cast("decimal(16,6)"))
    return F.timestamp_seconds(F.unix_seconds(at) - minutes * 60)


def _from_epoch(s: Column) -> Column:
    n = s.try_cast("long")
    return F.timestamp_seconds(F.when(F.length(s) > 10, F.floor(n / 1000)).otherwise(n))


def parse_feed_time(c: Column) -> Column:
    """PRJ13: many layouts -> TimestampType (UTC session); NULL when none fits.

    The trimmed text and its parts are bound once (one-element ``transform``s), so no
    expression is copied into every branch, nor into every predicate a filter
    push-down inlines it into."""
    def parse(s: Column) -> Column:
        return F.when(s.rlike(EPOCH_RE), _from_epoch(s)).otherwise(F.transform(F.array(_parts(s)), _from_parts)[0])

    return F.transform(F.array(F.regexp_replace(F.trim(c), r"\s+", " ")), parse)[0]


def format_utc(ts: Column) -> Column:
    """PRJ14: ``yyyy-MM-dd HH:mm:ss`` (the session time zone is pinned to UTC)."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
