"""Table and payload schemas (the JSON payload is the ingest contract)."""

from pyspark.sql import types as T

# Payload field names and types of the telemetry contract.
TELEMETRY_SCHEMA = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("device_id", T.StringType(), False),
    T.StructField("device_type", T.StringType(), True),
    T.StructField("timestamp_utc", T.StringType(), False),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("temperature_c", T.DoubleType(), True),
    T.StructField("humidity_pct", T.DoubleType(), True),
    T.StructField("pressure_hpa", T.DoubleType(), True),
    T.StructField("battery_pct", T.DoubleType(), True),
    T.StructField("firmware_version", T.StringType(), True),
    T.StructField("anomaly_flag", T.BooleanType(), True),
    T.StructField("payload", T.MapType(T.StringType(), T.StringType()), True),
])

TELEMETRY_FIELDS = [f.name for f in TELEMETRY_SCHEMA.fields]
REQUIRED_FIELDS = ["event_id", "device_id", "timestamp_utc"]

CORRUPT_COLUMN = "_corrupt_record"

# Parse schema: the contract plus a slot where from_json keeps the raw text of
# a record it could not fully parse.
PARSE_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType, True) for f in TELEMETRY_SCHEMA.fields]
    + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)]
)

# Kafka-protocol record as delivered by the source.
KAFKA_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType(), True),
    T.StructField("value", T.BinaryType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
])

BRONZE_SCHEMA = T.StructType([
    T.StructField("kafka_key", T.StringType(), True),
    T.StructField("raw_payload", T.StringType(), True),
    T.StructField("kafka_topic", T.StringType(), True),
    T.StructField("kafka_partition", T.IntegerType(), True),
    T.StructField("kafka_offset", T.LongType(), True),
    T.StructField("kafka_timestamp", T.TimestampType(), True),
    T.StructField("ingested_at", T.TimestampType(), True),
    T.StructField("event_date", T.StringType(), True),
])

REGISTRY_COLUMNS = ["device_id", "site_name", "region", "owner_team", "sla_tier"]
REGISTRY_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in REGISTRY_COLUMNS])

ENVELOPE_COLUMNS = ["kafka_key", "kafka_partition", "kafka_offset", "kafka_timestamp",
                    "ingested_at", "event_date"]

SILVER_SCHEMA = T.StructType(
    [f for f in BRONZE_SCHEMA.fields if f.name in ENVELOPE_COLUMNS]
    + [T.StructField(f.name, f.dataType, True) for f in TELEMETRY_SCHEMA.fields]
    + [T.StructField("event_timestamp", T.TimestampType(), True),
       T.StructField("quality_flags", T.ArrayType(T.StringType(), True), True),
       T.StructField("is_valid", T.BooleanType(), True)]
    + [f for f in REGISTRY_SCHEMA.fields if f.name != "device_id"]
)

SILVER_COLUMNS = [f.name for f in SILVER_SCHEMA.fields]
