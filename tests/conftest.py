import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from voltline.session import get_spark

    s = get_spark("local[4]", app="voltline-tests", shuffle_partitions=4,
                  extra_conf={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        d = str(tmp_path_factory.mktemp("ckpt"))
        s.conf.set("spark.checkpoint.dir", d)
        s.sparkContext.setCheckpointDir(d)
    yield s
    s.stop()


def telemetry_rows(spark, rows):
    """Typed telemetry rows from (event_id, device_id, iso time, temp, flag)
    tuples; other readings are in range."""
    from pyspark.sql import functions as F

    from voltline.functions.timefmt import parse_event_time

    data = [(e, d, t, float(temp) if temp is not None else None, flag) for e, d, t, temp, flag in rows]
    df = spark.createDataFrame(
        data, "event_id string, device_id string, timestamp_utc string, temperature_c double, "
              "anomaly_flag boolean")
    return (df.withColumn("event_timestamp", parse_event_time("timestamp_utc"))
              .withColumn("device_type", F.lit("sensor_v2"))
              .withColumn("region", F.lit("EUROPE"))
              .withColumn("humidity_pct", F.lit(50.0)).withColumn("battery_pct", F.lit(50.0))
              .withColumn("latitude", F.lit(51.5)).withColumn("longitude", F.lit(0.0))
              .withColumn("pressure_hpa", F.lit(1013.0)))
