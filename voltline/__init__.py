"""voltline: device-telemetry analytics on Spark.

Bronze (raw envelope) -> Silver (parsed, flagged, de-duplicated, enriched)
-> Gold (windowed KPIs, anomaly alerts), plus windowed stream-SQL style
queries, fleet health rollups and table-maintenance jobs.  Every operator is
a DataFrame -> DataFrame function built from Spark's own expressions so the
same code serves batch and Structured Streaming wherever Spark allows it.
"""

__version__ = "0.1.0"
