"""Event-time parsing and window helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted timestamp layouts.  The first takes ISO-8601 with a
# colon offset (``+00:00``), ``Z`` and an optional 6-digit fraction (what the
# producer's isoformat() emits); the second is the pipeline's original
# pattern, which additionally accepts the short offset form ``+00``.
ISO_OFFSET_PATTERN = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX"
SHORT_OFFSET_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"


_UNIT_US = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
            "hour": 3_600_000_000, "day": 86_400_000_000}


def interval_us(text: str) -> int:
    """Microseconds of an interval such as "5 minutes" or "1 hour 30 seconds"."""
    parts = text.lower().split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not an interval: {text!r}")
    return round(sum(float(n) * _UNIT_US[unit.removesuffix("s")]
                     for n, unit in zip(parts[::2], parts[1::2], strict=True)))


def parse_event_time(col: Column | str) -> Column:
    """String -> TIMESTAMP, NULL (never an error) when no layout matches."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(
        F.try_to_timestamp(c, F.lit(ISO_OFFSET_PATTERN)),
        F.try_to_timestamp(c, F.lit(SHORT_OFFSET_PATTERN)),
    )


def format_iso_utc(ts: Column) -> Column:
    """TIMESTAMP -> ISO-8601 UTC text as Python's isoformat() writes it:
    the fraction is printed only when it is non-zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.when(F.unix_micros(ts) % 1_000_000 != 0,
                  F.concat(F.lit("."), F.date_format(ts, "SSSSSS"))).otherwise(F.lit(""))
    return F.concat(whole, frac, F.lit("+00:00"))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole-second boundaries crossed between two instants (DATEDIFF(second)
    semantics: .9 s -> 1.1 s counts 1)."""
    return F.unix_seconds(end) - F.unix_seconds(start)


def hub_latency_ms() -> Column:
    """Whole milliseconds from event time to arrival at the hub."""
    return F.expr("(unix_micros(kafka_timestamp) - unix_micros(event_timestamp)) div 1000")


def asa_window(ts: Column | str, size: str, slide: str | None = None) -> Column:
    """Tumbling / hopping window closed on the right: (start, end].

    Spark windows are [start, end); shifting the event time back by one
    microsecond puts an event that sits exactly on a boundary into the
    earlier window while leaving the window bounds themselves unchanged.
    """
    c = F.col(ts) if isinstance(ts, str) else ts
    shifted = c - F.expr("INTERVAL 1 MICROSECOND")
    return F.window(shifted, size, slide) if slide else F.window(shifted, size)
