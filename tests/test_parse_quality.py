import json

from pyspark.sql import functions as F

from voltline.functions.quality import quality_flags
from voltline.functions.timefmt import parse_event_time
from voltline.operators.silver import add_quality, parse_and_validate, rejects


def test_timestamp_layouts(spark):
    df = spark.createDataFrame(
        [("2024-01-01T00:01:00.123456+00:00",), ("2024-01-01T00:01:00Z",),
         ("2024-01-01T00:01:00.123456+00",), ("2024-01-01T00:01:00+00:00",), ("garbage",)], "s string")
    got = [r[0] for r in df.select(F.date_format(parse_event_time("s"), "HH:mm:ss.SSSSSS")).collect()]
    assert got == ["00:01:00.123456", "00:01:00.000000", "00:01:00.123456", "00:01:00.000000", None]


def _bronze(spark, payloads):
    rows = [("k", p, "t", 0, i, None, None, "2024-01-01") for i, p in enumerate(payloads)]
    return spark.createDataFrame(
        rows, "kafka_key string, raw_payload string, kafka_topic string, kafka_partition int, "
              "kafka_offset long, kafka_timestamp timestamp, ingested_at timestamp, event_date string")


def _payload(**kw):
    base = {"event_id": "e1", "device_id": "d1", "timestamp_utc": "2024-01-01T00:00:00+00:00",
            "temperature_c": 20.0, "humidity_pct": 50.0, "battery_pct": 50.0,
            "latitude": 51.5, "longitude": 0.0}
    base.update(kw)
    return json.dumps(base)


def test_parse_rejects_and_partial_fields(spark):
    b = _bronze(spark, [_payload(), "{bad", '{"event_id": null}',
                        _payload(event_id="e2", temperature_c="oops"),
                        _payload(event_id="e3", timestamp_utc="garbage")])
    ok = {r.event_id: r for r in parse_and_validate(b).collect()}
    assert set(ok) == {"e1", "e2", "e3"}
    assert ok["e2"].temperature_c is None          # bad field -> NULL, row kept
    assert ok["e3"].event_timestamp is None        # unparseable time kept in Silver
    flags = {r.event_id: r.quality_flags for r in add_quality(parse_and_validate(b)).collect()}
    assert flags["e2"] == ["TEMP_OUT_OF_RANGE"]
    reasons = sorted(r.reject_reason for r in rejects(b).collect())
    assert reasons == ["BAD_TIMESTAMP", "MALFORMED_JSON", "MISSING_EVENT_ID"]


def test_quality_bounds(spark):
    df = spark.createDataFrame(
        [(85.0, 50.0, 50.0, 51.0, 0.0), (85.01, 50.0, 50.0, 51.0, 0.0), (None, 50.0, 50.0, 51.0, 0.0),
         (20.0, 50.0, 50.0, 90.1, -180.1)],
        "temperature_c double, humidity_pct double, battery_pct double, latitude double, longitude double")
    got = [r[0] for r in df.select(quality_flags()).collect()]
    assert got == [[], ["TEMP_OUT_OF_RANGE"], ["TEMP_OUT_OF_RANGE"], ["LAT_INVALID", "LON_INVALID"]]
