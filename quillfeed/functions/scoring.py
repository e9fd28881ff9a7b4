"""Score expressions (PRJ29 popularity dampening, PRJ30 recency)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillfeed import config


def dampen_popularity(s: Column, cutoff: float = config.POP_SCORE_CUTOFF, exponent: float = config.POP_SCORE_EXPONENT) -> Column:
    """PRJ29: identity up to ``cutoff``; above it ``(cutoff-1) + (1 + s - cutoff) ** exponent``."""
    return F.when(s <= cutoff, s).otherwise(
        F.lit(float(cutoff - 1)) + F.pow(F.lit(1.0) + s - F.lit(float(cutoff)), F.lit(float(exponent)))
    )


def seconds_between(later: Column | _dt.datetime, earlier: Column) -> Column:
    """Seconds (fractional) from ``earlier`` to ``later``."""
    if isinstance(later, _dt.datetime):
        later = ts_literal(later)
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(1_000_000.0)


def ts_literal(t: _dt.datetime) -> Column:
    """A naive datetime as a timestamp in the (UTC) session time zone."""
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def recency(publish_time: Column, as_of: _dt.datetime) -> Column:
    """PRJ30: ln(seconds since publish) when positive, else 0.1."""
    secs = seconds_between(as_of, publish_time)
    return F.when(secs > 0, F.log(secs)).otherwise(F.lit(0.1))
