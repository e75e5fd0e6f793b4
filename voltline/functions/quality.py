"""Business-rule quality flags (mark, never drop)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (column, lower bound, upper bound, flag), bounds inclusive.
QUALITY_RULES = [
    ("temperature_c", -50, 85, "TEMP_OUT_OF_RANGE"),
    ("humidity_pct", 0, 100, "HUMIDITY_INVALID"),
    ("battery_pct", 0, 100, "BATTERY_INVALID"),
    ("latitude", -90, 90, "LAT_INVALID"),
    ("longitude", -180, 180, "LON_INVALID"),
]


def quality_flags(rules=QUALITY_RULES) -> Column:
    """array<string> of violated rules.  A NULL reading counts as a violation:
    ``between`` yields NULL, the WHEN branch is not taken and the flag is
    emitted."""
    checks = [F.when(F.col(c).between(lo, hi), F.lit(None)).otherwise(F.lit(flag))
              for c, lo, hi, flag in rules]
    return F.array_compact(F.array(*checks))
