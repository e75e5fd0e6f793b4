"""Silver: parse, validate, flag, enrich, de-duplicate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltline.functions.quality import quality_flags
from voltline.operators.joins import broadcast_if_small
from voltline.functions.timefmt import parse_event_time
from voltline.schemas import (CORRUPT_COLUMN, PARSE_SCHEMA, REGISTRY_COLUMNS,
                              REQUIRED_FIELDS, TELEMETRY_FIELDS)

ENVELOPE = ["kafka_key", "kafka_partition", "kafka_offset", "kafka_timestamp",
            "ingested_at", "event_date"]


def _present(df: DataFrame, cols: list[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def _parsed(keep=None):
    """from_json of ``raw_payload`` as a one-element array of structs, kept
    only when ``keep`` holds.  Expanded with ``inline`` (a generator), the
    payload is parsed exactly once per record: a plain filter on parsed
    fields would be pushed below the projection and parse every record
    again for each predicate."""
    parsed = F.from_json(F.col("raw_payload"), PARSE_SCHEMA,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN})
    arr = F.array(parsed)
    return F.inline(F.filter(arr, keep) if keep is not None else arr)


def parse_payload(bronze: DataFrame) -> DataFrame:
    """from_json with the contract schema; every row is kept.  A record that
    is not JSON at all yields NULL fields; a record with one unreadable field
    keeps the others (that field is NULL).  ``_corrupt_record`` holds the raw
    text of any record that did not parse cleanly."""
    return (bronze.select(*_present(bronze, ENVELOPE + ["raw_payload"]), _parsed())
            .withColumn("event_timestamp", parse_event_time("timestamp_utc")))


def _required(p):
    cond = None
    for c in REQUIRED_FIELDS:
        cond = p[c].isNotNull() if cond is None else cond & p[c].isNotNull()
    return cond


def parse_and_validate(bronze: DataFrame) -> DataFrame:
    """Bronze -> typed rows that carry the three required fields, with
    ``event_timestamp`` (NULL when the text has no accepted layout)."""
    return (bronze.select(*_present(bronze, ENVELOPE), _parsed(_required))
            .select(*_present(bronze, ENVELOPE), *TELEMETRY_FIELDS,
                    parse_event_time("timestamp_utc").alias("event_timestamp")))


def add_quality(df: DataFrame) -> DataFrame:
    """Add ``quality_flags`` (violated range rules) and ``is_valid``."""
    return (df.withColumn("quality_flags", quality_flags())
              .withColumn("is_valid", F.size("quality_flags") == 0))


def enrich(df: DataFrame, registry: DataFrame, check_size: bool = True, devices: DataFrame | None = None) -> DataFrame:
    """Left join with the device registry on device_id.

    The registry is measured first and broadcast only when it is under
    ``BROADCAST_MAX_BYTES``: the telemetry side then never shuffles for the
    join, so a hot device does not pile up in one join task, and later
    aggregations shuffle on their own full keys.  A larger registry is cut to
    the devices that a batch holds (``devices``: their device_id, taken from
    ``df`` if not given) and measured again.  Above the bound even so, or in a
    stream, Spark plans a shuffle join whose skewed partitions AQE splits."""
    reg = registry.select(*REGISTRY_COLUMNS)
    if check_size:
        met = None if df.isStreaming else (df if devices is None else devices).select("device_id")
        reg = broadcast_if_small(reg, met=met)
    return df.join(reg, on="device_id", how="left")


def reject_reason():
    all_missing = (F.col("event_id").isNull() & F.col("device_id").isNull()
                   & F.col("timestamp_utc").isNull())
    return (F.when(all_missing & F.col(CORRUPT_COLUMN).isNotNull(), F.lit("MALFORMED_JSON"))
             .when(F.col("event_id").isNull(), F.lit("MISSING_EVENT_ID"))
             .when(F.col("device_id").isNull(), F.lit("MISSING_DEVICE_ID"))
             .when(F.col("timestamp_utc").isNull(), F.lit("MISSING_TIMESTAMP"))
             .when(F.col("event_timestamp").isNull(), F.lit("BAD_TIMESTAMP")))


def rejects(bronze: DataFrame) -> DataFrame:
    """Dead letters: records the required-field filter drops, plus kept rows
    whose timestamp text could not be parsed (they stay in Silver but no
    window will ever count them)."""
    return (parse_payload(bronze)
            .withColumn("reject_reason", reject_reason())
            .where(F.col("reject_reason").isNotNull())
            .select(*_present(bronze, ["kafka_partition", "kafka_offset", "kafka_timestamp",
                                       "event_date", "raw_payload"]),
                    "event_id", "reject_reason"))


def silver_rows(bronze: DataFrame, registry: DataFrame, check_size: bool = True) -> DataFrame:
    """Full Silver transformation of one batch of Bronze rows (no dedup).
    ``check_size=False`` when the caller already measured the registry."""
    return enrich(add_quality(parse_and_validate(bronze)), registry, check_size)


def dedup_batch(df: DataFrame, key: str = "event_id",
                order: tuple[str, ...] = ("kafka_offset", "kafka_partition")) -> DataFrame:
    """One row per key: the earliest delivery (lowest offset, then partition).

    ``min_by(row, (offset, partition))`` is an ordinary aggregate, so each map
    task collapses its copies before the shuffle; a key with a huge number of
    copies never lands whole in one task."""
    rest = [c for c in df.columns if c != key]
    best = F.min_by(F.struct(*rest), F.struct(*order)).alias("_best")
    return (df.groupBy(key).agg(best)
              .select(key, *[F.col(f"_best.{c}").alias(c) for c in rest])
              .select(*df.columns))


def silver_upsert_rows(bronze: DataFrame, registry: DataFrame, target_keys: DataFrame | None,
                       check_size: bool = True, devices: DataFrame | None = None) -> DataFrame:
    """New Silver rows for one batch: parse, de-duplicate and drop keys the
    table already holds *before* flagging and enriching.  Flags and the
    registry join are row-wise functions of the payload, so the result equals
    flag -> enrich -> dedup, but duplicates are never flagged or joined and
    the dedup shuffle carries the narrower parsed rows.  ``devices``: at least
    the device_ids of ``bronze``, where they are known without parsing."""
    parsed = parse_and_validate(bronze)
    fresh = upsert_new_rows(parsed, target_keys)
    return enrich(add_quality(fresh), registry, check_size, parsed if devices is None else devices)


def upsert_new_rows(batch: DataFrame, target_keys: DataFrame | None,
                    key: str = "event_id") -> DataFrame:
    """Insert-only upsert: rows of ``batch`` (de-duplicated) whose key is not
    in the target yet.  Only the key column of the target is read."""
    fresh = dedup_batch(batch, key)
    if target_keys is None:
        return fresh
    return fresh.join(target_keys.select(key), on=key, how="left_anti")
