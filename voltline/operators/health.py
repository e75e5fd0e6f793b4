"""Fleet health: per-device checks and their rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltline.functions.timefmt import hub_latency_ms
from voltline.operators.streamsql import BATTERY_CRITICAL_PCT

# Check statuses and the rollup order.
STATUSES = ["healthy", "degraded", "critical", "unknown"]


def device_checks(silver: DataFrame) -> DataFrame:
    """One check per device, grouped under its registry region
    ("environment").  unknown: device not in the registry; critical: a
    battery reading below the critical level; degraded: any row failing a
    quality rule; healthy otherwise.  latency_ms: mean hub latency."""
    lat_ms = hub_latency_ms()
    agg = (silver.groupBy("device_id", "region")
           .agg(F.count(F.lit(1)).alias("events"),
                F.count_if(~F.col("is_valid")).alias("invalid"),
                F.min("battery_pct").alias("min_battery"),
                F.sum(lat_ms).alias("lat_sum"), F.count(lat_ms).alias("lat_n")))
    status = (F.when(F.col("region").isNull(), "unknown")
              .when(F.col("min_battery") < BATTERY_CRITICAL_PCT, "critical")
              .when(F.col("invalid") > 0, "degraded").otherwise("healthy"))
    return agg.select(
        F.coalesce("region", F.lit("unassigned")).alias("environment"),
        F.col("device_id").alias("name"),
        status.alias("status"),
        F.when(F.col("lat_n") > 0, F.col("lat_sum") / F.col("lat_n")).alias("latency_ms"),
        F.concat_ws(" ", F.col("events").cast("string"), F.lit("events,"),
                    F.col("invalid").cast("string"), F.lit("invalid")).alias("message"))


def overall_status(status_col: str = "status"):
    """Aggregate: CRITICAL if any check is critical; DEGRADED if any is
    degraded or unknown; HEALTHY if all are healthy; UNKNOWN without checks."""
    s = F.col(status_col)
    return (F.when(F.count(F.lit(1)) == 0, F.lit("UNKNOWN"))
            .when(F.bool_or(s == "critical"), F.lit("CRITICAL"))
            .when(F.bool_or(s.isin("degraded", "unknown")), F.lit("DEGRADED"))
            .otherwise(F.lit("HEALTHY")))


def rollup(checks: DataFrame) -> DataFrame:
    return (checks.groupBy("environment")
            .agg(overall_status().alias("overall_status"), F.count(F.lit(1)).alias("n_checks")))


def rollup_all(checks: DataFrame) -> DataFrame:
    """Single report row over every check; zero checks gives UNKNOWN."""
    return checks.agg(overall_status().alias("overall_status"), F.count(F.lit(1)).alias("n_checks"))


def summary(checks: DataFrame) -> DataFrame:
    """Count of checks per status, zeros included (fixed pivot values, so
    no extra pass to discover them)."""
    return (checks.groupBy("environment").pivot("status", STATUSES).count()
            .na.fill(0, subset=STATUSES))


def flatten(checks: DataFrame) -> DataFrame:
    """Check rows with their environment's overall status attached."""
    return checks.join(rollup(checks).select("environment", "overall_status"), "environment")


def layer_presence(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Per layer: row count and whether it is non-empty, plus the overall
    status (HEALTHY when every layer has data, else DEGRADED)."""
    parts = [bronze.agg(F.count(F.lit(1)).alias("rows")).withColumn("layer", F.lit("bronze")),
             silver.agg(F.count_if(F.col("is_valid")).alias("rows")).withColumn("layer", F.lit("silver")),
             gold.agg(F.count(F.lit(1)).alias("rows")).withColumn("layer", F.lit("gold"))]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("present", F.col("rows") > 0)
    # three rows: a single-partition window is bounded by the number of layers
    all_present = F.bool_and("present").over(Window.partitionBy())
    return out.withColumn("status", F.when(all_present, "HEALTHY").otherwise("DEGRADED")) \
              .select("layer", "rows", "present", "status")
