import datetime as dt

from voltline.operators.health import device_checks
from voltline.operators.metrics import sla_attainment

T0 = dt.datetime(2024, 1, 1)


def _tel(spark, hub_lag_s):
    return spark.createDataFrame([(T0, T0 + dt.timedelta(seconds=hub_lag_s))],
                                 "event_timestamp timestamp, kafka_timestamp timestamp")


def test_sla_colours(spark):
    # hub lag 7 s: bronze 17/30 = 57 % green, silver 47/120 green, gold 527/900 green
    got = {r.layer: (round(r.actual_sec), r.status) for r in sla_attainment(_tel(spark, 7)).collect()}
    assert got == {"bronze": (17, "green"), "silver": (47, "green"), "gold": (527, "green")}
    # hub lag 15 s: bronze 25/30 = 83 % amber; lag 40 s: bronze capped at 100 % red
    assert {r.layer: r.status for r in sla_attainment(_tel(spark, 15)).collect()}["bronze"] == "amber"
    red = {r.layer: (r.pct, r.status) for r in sla_attainment(_tel(spark, 40)).collect()}
    assert red["bronze"] == (100.0, "red")


def test_device_check_status_order(spark):
    rows = [("d1", None, True, 50.0), ("d2", "EU", True, 5.0), ("d2", "EU", False, 50.0),
            ("d3", "EU", False, 50.0), ("d4", "EU", True, 50.0)]
    silver = spark.createDataFrame(
        [(d, r, v, b, T0, T0 + dt.timedelta(seconds=2)) for d, r, v, b in rows],
        "device_id string, region string, is_valid boolean, battery_pct double, "
        "event_timestamp timestamp, kafka_timestamp timestamp")
    got = {r.name: (r.environment, r.status, r.latency_ms) for r in device_checks(silver).collect()}
    assert got["d1"] == ("unassigned", "unknown", 2000.0)   # not in the registry
    assert got["d2"][1] == "critical"                       # battery below 10 wins over invalid
    assert got["d3"][1] == "degraded"
    assert got["d4"][1] == "healthy"
