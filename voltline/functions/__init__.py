"""Column-level building blocks (all built-in Spark expressions)."""

from voltline.functions.timefmt import (  # noqa: F401
    parse_event_time, asa_window, seconds_between, hub_latency_ms, format_iso_utc,
)
from voltline.functions.quality import quality_flags, QUALITY_RULES  # noqa: F401
from voltline.functions.stats import (  # noqa: F401
    merged_aggs, merged_mean, merged_stddev, moment_aggs,
)
