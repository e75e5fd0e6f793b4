"""``oracle_sql()``: name -> DuckDB SQL over the driver tables.

Each statement recomputes a catalog query independently: the same
events -> telemetry mapping written in plain SQL, windows built with
``time_bucket`` / ``generate_series`` instead of Spark's window functions,
sessions with LAG and a running sum, range joins with BETWEEN.
Statistics are DuckDB's own AVG and STDDEV_SAMP over raw readings, rounded to
six decimals like the catalog's results (sums of doubles depend on their order
in the last digits).
"""

from __future__ import annotations


def D(x) -> str:
    return f"CAST({x} AS DOUBLE)"


TEL = f"""
tel AS (
  SELECT
    'evt-' || CAST(event_id AS VARCHAR) AS event_id,
    'device-' || CAST(1000 + user_id % 25 AS VARCHAR) AS device_id,
    CASE (user_id % 25) % 4 WHEN 0 THEN 'sensor_v2' WHEN 1 THEN 'gateway_v3'
         WHEN 2 THEN 'actuator_v1' ELSE 'edge_compute' END AS device_type,
    strftime(make_timestamp(ev_us), '%Y-%m-%dT%H:%M:%S')
      || CASE WHEN ev_us % 1000000 <> 0
              THEN '.' || lpad(CAST(ev_us % 1000000 AS VARCHAR), 6, '0') ELSE '' END
      || '+00:00' AS timestamp_utc,
    {D(51.4)} + {D('user_id % 200')} * {D(0.2)} AS latitude,
    {D(-0.2)} + {D('user_id % 150')} * {D(0.1)} AS longitude,
    value - {D(30)} AS temperature_c,
    {D('k')} * {D(1.05)} - {D(1)} AS humidity_pct,
    {D(1013.25)} + {D('k - 50')} * {D(0.1)} AS pressure_hpa,
    CASE WHEN event_id % 50 = 0 THEN NULL ELSE {D('k')} END AS battery_pct,
    CASE event_id % 3 WHEN 0 THEN '2.4.1' WHEN 1 THEN '2.4.2' ELSE '2.5.0' END AS firmware_version,
    (event_type = 'error' AND event_id % 10 = 0) AS anomaly_flag,
    CAST(event_id AS VARCHAR) AS payload_seq,
    make_timestamp(ev_us) AS event_timestamp,
    'device-' || CAST(1000 + user_id % 25 AS VARCHAR) AS kafka_key,
    CAST((user_id % 25) % 32 AS INTEGER) AS kafka_partition,
    event_id AS kafka_offset,
    make_timestamp(ev_us + (event_id % 90) * 1000000) AS kafka_timestamp,
    strftime(make_timestamp(ev_us + (event_id % 90) * 1000000), '%Y-%m-%d') AS event_date,
    event_id AS n_id
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
               1704067200000000 + (epoch_us(ts) - 1704067200000000) // 120 AS ev_us
        FROM events) e
)"""

REG = """
reg AS (
  SELECT 'device-' || CAST(1000 + c_custkey AS VARCHAR) AS device_id, c_name AS site_name,
         r_name AS region, n_name AS owner_team, c_mktsegment AS sla_tier
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
                LEFT JOIN region ON n_regionkey = r_regionkey
)"""

FLAGS = """concat_ws(',',
      CASE WHEN temperature_c BETWEEN -50 AND 85 THEN NULL ELSE 'TEMP_OUT_OF_RANGE' END,
      CASE WHEN humidity_pct BETWEEN 0 AND 100 THEN NULL ELSE 'HUMIDITY_INVALID' END,
      CASE WHEN battery_pct BETWEEN 0 AND 100 THEN NULL ELSE 'BATTERY_INVALID' END,
      CASE WHEN latitude BETWEEN -90 AND 90 THEN NULL ELSE 'LAT_INVALID' END,
      CASE WHEN longitude BETWEEN -180 AND 180 THEN NULL ELSE 'LON_INVALID' END)"""

QF = f"""
qf AS (SELECT tel.*, {FLAGS} AS flags FROM tel),
q AS (SELECT qf.*, flags = '' AS is_valid,
             CAST(CASE WHEN flags = '' THEN 0 ELSE length(flags) - length(replace(flags, ',', '')) + 1 END
                  AS INTEGER) AS n_flags FROM qf)"""

# Bronze deliveries: every event once, events with id % 20 = 0 a second time
# at offset + 2^40; ids with id % 97 = 0 carry broken JSON text.
DELIVERIES = f"""{TEL},
deliv AS (
  SELECT tel.*, n_id % 97 = 0 AS broken FROM tel
  UNION ALL
  SELECT * REPLACE (kafka_offset + 1099511627776 AS kafka_offset), n_id % 97 = 0 AS broken
  FROM tel WHERE n_id % 20 = 0
)"""

# Silver as batch and streaming upsert leave it: well-formed deliveries, first
# delivery of each event, enriched.
SILVER = f"""{DELIVERIES},{REG},
ok AS (SELECT d.*, {FLAGS} AS flags FROM deliv d WHERE NOT broken),
firsts AS (
  SELECT *, flags = '' AS is_valid FROM ok
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY kafka_offset, kafka_partition) = 1),
silver AS (SELECT firsts.*, reg.site_name, reg.region, reg.owner_team, reg.sla_tier
           FROM firsts LEFT JOIN reg USING (device_id))"""

SCALAR = """kafka_key, kafka_partition, kafka_offset, kafka_timestamp, event_date, event_id,
  device_id, device_type, timestamp_utc, latitude, longitude, temperature_c, humidity_pct,
  pressure_hpa, battery_pct, firmware_version, anomaly_flag, event_timestamp"""


def avg(x: str) -> str:
    return f"round(AVG({x}), 6)"


def std(x: str) -> str:
    return f"round(STDDEV_SAMP({x}), 6)"


SQL: dict[str, str] = {}

SQL["silver_parse"] = f"""WITH {DELIVERIES}
SELECT {SCALAR}, payload_seq FROM deliv WHERE NOT broken"""

SQL["silver_quality"] = f"""WITH {TEL},{QF}
SELECT event_id, device_id, flags, n_flags, is_valid FROM q"""

SQL["silver_enriched"] = f"""WITH {SILVER}
SELECT {SCALAR}, flags, is_valid, site_name, region, owner_team, sla_tier FROM silver"""

SQL["silver_rejects"] = f"""WITH {DELIVERIES}
SELECT kafka_partition, kafka_offset, kafka_timestamp, event_date,
       '{{"event_id": "' || event_id || '", "device_id": ' AS raw_payload,
       CAST(NULL AS VARCHAR) AS event_id, 'MALFORMED_JSON' AS reject_reason
FROM deliv WHERE broken"""

SQL["silver_upsert"] = f"""WITH {DELIVERIES},{REG},
ok AS (SELECT d.*, {FLAGS} = '' AS is_valid FROM deliv d WHERE NOT broken),
firsts AS (
  SELECT * FROM ok
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY kafka_offset, kafka_partition) = 1)
SELECT event_id, device_id, kafka_partition, kafka_offset, event_date, is_valid, reg.region,
       CASE WHEN kafka_timestamp < TIMESTAMP '2024-01-01 03:00:00' THEN 0 ELSE 1 END AS batch_id
FROM firsts LEFT JOIN reg USING (device_id)"""

SQL["gold_kpis"] = f"""WITH {SILVER}
SELECT device_id, device_type, region, sla_tier,
       COUNT(*) AS event_count,
       {avg('temperature_c')} AS avg_temp_c,
       MAX(temperature_c) AS max_temp_c, MIN(temperature_c) AS min_temp_c,
       {avg('humidity_pct')} AS avg_humidity,
       {avg('battery_pct')} AS avg_battery,
       MIN(battery_pct) AS min_battery,
       CAST(SUM(CAST(anomaly_flag AS INTEGER)) AS BIGINT) AS anomaly_count,
       COUNT(DISTINCT firmware_version) AS firmware_versions,
       time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE AS window_end,
       round(CAST(SUM(CAST(anomaly_flag AS INTEGER)) AS DOUBLE) / COUNT(*) * 100, 2)
         AS anomaly_rate_pct
FROM silver WHERE is_valid
GROUP BY device_id, device_type, region, sla_tier, time_bucket(INTERVAL 5 MINUTE, event_timestamp)"""

ASA_END_1 = ("time_bucket(INTERVAL 1 MINUTE, event_timestamp - INTERVAL 1 MICROSECOND)"
             " + INTERVAL 1 MINUTE")

SQL["asa_tumbling"] = f"""WITH {TEL}
SELECT {ASA_END_1} AS window_end, {ASA_END_1} - INTERVAL 1 MINUTE AS window_start, device_type,
       COUNT(*) AS event_count,
       {avg('temperature_c')} AS avg_temperature_c,
       MAX(temperature_c) AS max_temperature_c, MIN(temperature_c) AS min_temperature_c,
       {avg('humidity_pct')} AS avg_humidity_pct,
       {avg('battery_pct')} AS avg_battery_pct,
       CAST(SUM(CAST(anomaly_flag AS BIGINT)) AS BIGINT) AS anomaly_count,
       round({D(100)} * CAST(SUM(CAST(anomaly_flag AS BIGINT)) AS DOUBLE) / NULLIF(COUNT(*), 0), 2)
         AS anomaly_rate_pct
FROM tel WHERE event_timestamp IS NOT NULL
GROUP BY device_type, {ASA_END_1}"""

SQL["asa_hopping"] = f"""WITH {TEL},
hop AS (
  SELECT tel.*, {ASA_END_1} + INTERVAL (h) MINUTE AS window_end
  FROM tel, unnest(generate_series(0, 4)) AS g(h)
  WHERE event_timestamp IS NOT NULL),
agg AS (
  SELECT window_end, device_id, device_type, COUNT(*) AS event_count,
         {avg('temperature_c')} AS avg_temp_c, {std('temperature_c')} AS stddev_temp_c,
         MAX(temperature_c) AS max_temp_c, MIN(temperature_c) AS min_temp_c,
         {avg('pressure_hpa')} AS avg_pressure_hpa,
         MIN(battery_pct) AS min_battery_pct,
         CAST(SUM(CAST(anomaly_flag AS BIGINT)) AS BIGINT) AS anomaly_count
  FROM hop GROUP BY window_end, device_id, device_type)
SELECT window_end, window_end - INTERVAL 5 MINUTE AS window_start, device_id, device_type,
       event_count, avg_temp_c, stddev_temp_c, max_temp_c, min_temp_c, avg_pressure_hpa, min_battery_pct, anomaly_count
FROM agg"""

SQL["asa_alerts"] = f"""WITH {TEL}
SELECT event_id, device_id, device_type, timestamp_utc AS event_time,
       event_timestamp AS detected_at, temperature_c, humidity_pct, battery_pct, anomaly_flag,
       CASE WHEN CAST(anomaly_flag AS BIGINT) = 1 THEN 'MODEL_ALERT'
            WHEN temperature_c > 80 THEN 'TEMP_HIGH'
            WHEN temperature_c < -20 THEN 'TEMP_LOW'
            WHEN battery_pct < 10 THEN 'BATTERY_CRITICAL'
            ELSE 'UNKNOWN' END AS alert_type,
       'STREAM_ANALYTICS' AS detection_source
FROM tel
WHERE CAST(anomaly_flag AS BIGINT) = 1 OR temperature_c > 80 OR temperature_c < -20
   OR battery_pct < 10"""

SQL["asa_sessions"] = f"""WITH {TEL},
g AS (
  SELECT device_id, event_timestamp,
         CASE WHEN lag(event_timestamp) OVER w IS NULL
                OR event_timestamp - lag(event_timestamp) OVER w > INTERVAL 5 MINUTE
              THEN 1 ELSE 0 END AS opens
  FROM tel WHERE event_timestamp IS NOT NULL
  WINDOW w AS (PARTITION BY device_id ORDER BY event_timestamp)),
s AS (SELECT *, SUM(opens) OVER (PARTITION BY device_id ORDER BY event_timestamp
                                 ROWS UNBOUNDED PRECEDING) AS sid FROM g)
SELECT device_id, MIN(event_timestamp) AS session_start, MAX(event_timestamp) AS session_end,
       COUNT(*) AS events_in_session,
       date_diff('second', MIN(event_timestamp), MAX(event_timestamp)) AS session_duration_sec
FROM s GROUP BY device_id, sid"""

SQL["silent_devices"] = f"""WITH {TEL},
last AS (SELECT device_id, MAX(event_timestamp) AS last_seen FROM tel
         WHERE event_timestamp IS NOT NULL GROUP BY device_id),
mx AS (SELECT MAX(event_timestamp) AS now FROM tel)
SELECT device_id, last_seen,
       (epoch_us(now) - epoch_us(last_seen)) / {D(1000000)} AS silent_for_sec,
       (epoch_us(now) - epoch_us(last_seen)) > 300000000 AS is_silent
FROM last, mx"""

ROLLING = f"""
stats AS (
  SELECT device_id, date_trunc('minute', event_timestamp) - INTERVAL (h) MINUTE AS window_start,
         date_trunc('minute', event_timestamp) - INTERVAL (h) MINUTE + INTERVAL 10 MINUTE AS window_end,
         AVG(temperature_c) AS rolling_avg_temp, STDDEV_SAMP(temperature_c) AS rolling_std_temp
  FROM silver, unnest(generate_series(0, 9)) AS g(h)
  WHERE event_timestamp IS NOT NULL GROUP BY 1, 2, 3),
rj AS (
  SELECT s.*, r.window_start, r.window_end, r.rolling_avg_temp, r.rolling_std_temp,
         abs(s.temperature_c - r.rolling_avg_temp) > 3 * r.rolling_std_temp AS stat
  FROM silver s LEFT JOIN stats r
    ON s.device_id = r.device_id
   AND s.event_timestamp BETWEEN r.window_start AND r.window_end),
al AS (SELECT * FROM rj WHERE anomaly_flag OR stat)"""

TRIGGER = """CASE WHEN anomaly_flag AND coalesce(stat, false) THEN 'BOTH'
            WHEN anomaly_flag THEN 'MODEL' WHEN coalesce(stat, false) THEN 'STATISTICAL' END"""

SQL["alerts_range"] = f"""WITH {SILVER},{ROLLING}
SELECT event_id, device_id, device_type, region, event_timestamp, temperature_c,
       round(rolling_avg_temp, 6) AS rolling_avg_temp, round(rolling_std_temp, 6) AS rolling_std_temp,
       anomaly_flag AS model_anomaly_flag, 'statistical_outlier' AS detection_method, {TRIGGER} AS trigger, window_start, window_end
FROM al"""

SQL["alerts_per_event"] = f"""WITH {SILVER},{ROLLING}
SELECT event_id, device_id, device_type, region, event_timestamp, temperature_c,
       anomaly_flag AS model_anomaly_flag, COUNT(*) AS alert_windows,
       COUNT(*) FILTER (WHERE coalesce(stat, false)) AS stat_windows,
       round(MAX(abs(temperature_c - rolling_avg_temp)), 6) AS max_abs_dev,
       CASE WHEN anomaly_flag AND COUNT(*) FILTER (WHERE coalesce(stat, false)) > 0 THEN 'BOTH'
            WHEN anomaly_flag THEN 'MODEL'
            WHEN COUNT(*) FILTER (WHERE coalesce(stat, false)) > 0 THEN 'STATISTICAL' END AS trigger
FROM al GROUP BY event_id, device_id, device_type, region, event_timestamp, temperature_c,
                 anomaly_flag"""

SQL["alerts_trailing"] = f"""WITH {SILVER},
st AS (
  SELECT *, COUNT(temperature_c) OVER w AS trailing_n, AVG(temperature_c) OVER w AS trailing_avg_temp,
         STDDEV_SAMP(temperature_c) OVER w AS trailing_std_temp
  FROM silver WHERE event_timestamp IS NOT NULL
  WINDOW w AS (PARTITION BY device_id ORDER BY event_timestamp
               RANGE BETWEEN INTERVAL 10 MINUTE PRECEDING AND CURRENT ROW)),
al AS (SELECT *, abs(temperature_c - trailing_avg_temp) > 3 * trailing_std_temp AS stat FROM st)
SELECT event_id, device_id, device_type, region, event_timestamp, temperature_c, trailing_n,
       round(trailing_avg_temp, 6) AS trailing_avg_temp, round(trailing_std_temp, 6) AS trailing_std_temp,
       anomaly_flag AS model_anomaly_flag,
       {TRIGGER} AS trigger
FROM al WHERE anomaly_flag OR stat"""


THRESHOLD = """
al AS (
  SELECT event_id, device_id, device_type, event_timestamp AS detected_at, kafka_timestamp,
         CASE WHEN CAST(anomaly_flag AS BIGINT) = 1 THEN 'MODEL_ALERT'
              WHEN temperature_c > 80 THEN 'TEMP_HIGH'
              WHEN temperature_c < -20 THEN 'TEMP_LOW'
              WHEN battery_pct < 10 THEN 'BATTERY_CRITICAL' ELSE 'UNKNOWN' END AS alert_type
  FROM tel
  WHERE CAST(anomaly_flag AS BIGINT) = 1 OR temperature_c > 80 OR temperature_c < -20
     OR battery_pct < 10)"""

SQL["throughput_series"] = f"""WITH {TEL},
b AS (SELECT epoch_us(event_timestamp) // 2000000 AS slot, COUNT(*) AS events
      FROM tel WHERE event_timestamp IS NOT NULL GROUP BY 1),
spine AS (SELECT unnest(generate_series(m - 39, m)) AS slot FROM (SELECT MAX(slot) AS m FROM b))
SELECT make_timestamp(slot * 2000000) AS window_start, make_timestamp(slot * 2000000 + 2000000) AS window_end,
       coalesce(events, 0) AS events, CAST(coalesce(events, 0) AS DOUBLE) / {D(2)} AS events_per_sec
FROM spine LEFT JOIN b USING (slot)"""

SQL["latency_p99"] = f"""WITH {TEL},
l AS (SELECT device_type, (epoch_us(kafka_timestamp) - epoch_us(event_timestamp)) // 1000 AS lat
      FROM tel WHERE event_timestamp IS NOT NULL)
SELECT device_type, COUNT(*) AS events,
       CAST(quantile_cont(lat, 0.5) AS DOUBLE) AS p50_ms,
       CAST(quantile_cont(lat, 0.95) AS DOUBLE) AS p95_ms,
       CAST(quantile_cont(lat, 0.99) AS DOUBLE) AS p99_ms, MAX(lat) AS max_ms
FROM l GROUP BY device_type"""

SQL["events_today"] = f"""WITH {TEL}
SELECT CAST(event_timestamp AS DATE) AS event_day, COUNT(*) AS events,
       COUNT(DISTINCT device_id) AS devices, COUNT(*) FILTER (WHERE anomaly_flag) AS anomalies
FROM tel GROUP BY 1"""

SQL["anomaly_rate_5m"] = f"""WITH {TEL},
mx AS (SELECT MAX(event_timestamp) AS m FROM tel),
r AS (SELECT COUNT(*) AS events, COUNT(*) FILTER (WHERE anomaly_flag) AS anomalies
      FROM tel, mx WHERE event_timestamp > m - INTERVAL 5 MINUTE)
SELECT events, anomalies,
       round({D(100)} * anomalies / NULLIF(events, 0), 2) AS anomaly_rate_pct FROM r"""

SQL["active_devices"] = f"""WITH {TEL}
SELECT device_type, COUNT(DISTINCT device_id) AS active_devices, COUNT(*) AS events
FROM tel GROUP BY device_type"""

SQL["recent_alerts"] = f"""WITH {TEL},{THRESHOLD},
mx AS (SELECT MAX(detected_at) AS m FROM al),
rc AS (SELECT COUNT(*) AS n FROM al, mx WHERE detected_at > m - INTERVAL 5 MINUTE)
SELECT event_id, device_id, alert_type, detected_at, rc.n AS alerts_last_5m
FROM al, rc ORDER BY detected_at DESC, event_id DESC LIMIT 8"""

SQL["region_throughput"] = f"""WITH {SILVER},
span AS (SELECT (epoch_us(MAX(event_timestamp)) - epoch_us(MIN(event_timestamp)))
                / {D(1000000)} AS s FROM silver),
per AS (SELECT region, COUNT(*) AS events FROM silver
        WHERE event_timestamp IS NOT NULL GROUP BY region),
mx AS (SELECT MAX(events) AS m FROM per)
SELECT region, events, events / s AS events_per_sec, {D(100)} * events / m AS pct_of_busiest
FROM per, span, mx"""

SQL["sla_attainment"] = f"""WITH {TEL},
hub AS (SELECT MAX((epoch_us(kafka_timestamp) - epoch_us(event_timestamp)) // 1000) AS ms FROM tel),
b AS (SELECT {D('ms')} / {D(1000)} + {D(10)} AS bronze FROM hub),
l AS (
  SELECT 'bronze' AS layer, bronze AS actual_sec, {D(30)} AS target_sec FROM b
  UNION ALL SELECT 'silver', bronze + {D(30)}, {D(120)} FROM b
  UNION ALL SELECT 'gold', bronze + {D(30)} + {D(480)}, {D(900)} FROM b)
SELECT layer, actual_sec, target_sec,
       least({D(100)}, actual_sec / target_sec * {D(100)}) AS pct,
       CASE WHEN least({D(100)}, actual_sec / target_sec * {D(100)}) < 60 THEN 'green'
            WHEN least({D(100)}, actual_sec / target_sec * {D(100)}) < 85 THEN 'amber'
            ELSE 'red' END AS status
FROM l"""

SQL["event_log"] = f"""WITH {SILVER},
lg AS (
  SELECT kafka_timestamp AS log_time, 'ALERT' AS badge, event_id AS ref,
         'alert on ' || device_id AS message
  FROM silver WHERE anomaly_flag OR temperature_c > 80 OR temperature_c < -20 OR battery_pct < 10
  UNION ALL
  SELECT kafka_timestamp, 'WARN', event_id, flags || ' on ' || device_id FROM silver WHERE NOT is_valid
  UNION ALL
  SELECT kafka_timestamp, 'ERROR', 'offset-' || CAST(kafka_offset AS VARCHAR),
         'dead letter MALFORMED_JSON' FROM deliv WHERE broken)
SELECT * FROM lg ORDER BY log_time DESC, badge, ref DESC LIMIT 80"""

CHECKS = """
chk AS (
  SELECT coalesce(region, 'unassigned') AS environment, device_id AS name,
         CASE WHEN region IS NULL THEN 'unknown' WHEN MIN(battery_pct) < 10 THEN 'critical'
              WHEN COUNT(*) FILTER (WHERE NOT is_valid) > 0 THEN 'degraded'
              ELSE 'healthy' END AS status,
         CASE WHEN COUNT(lat) > 0 THEN CAST(SUM(lat) AS DOUBLE) / COUNT(lat) END AS latency_ms,
         CAST(COUNT(*) AS VARCHAR) || ' events, '
           || CAST(COUNT(*) FILTER (WHERE NOT is_valid) AS VARCHAR) || ' invalid' AS message
  FROM (SELECT *, (epoch_us(kafka_timestamp) - epoch_us(event_timestamp)) // 1000 AS lat
        FROM silver) s
  GROUP BY device_id, region),
rollup AS (
  SELECT environment,
         CASE WHEN bool_or(status = 'critical') THEN 'CRITICAL'
              WHEN bool_or(status IN ('degraded', 'unknown')) THEN 'DEGRADED'
              ELSE 'HEALTHY' END AS overall_status,
         COUNT(*) AS n_checks
  FROM chk GROUP BY environment)"""

SQL["health_rollup"] = f"""WITH {SILVER},{CHECKS}
SELECT environment, overall_status, n_checks FROM rollup"""

SQL["health_summary"] = f"""WITH {SILVER},{CHECKS}
SELECT environment,
       COUNT(*) FILTER (WHERE status = 'healthy') AS healthy,
       COUNT(*) FILTER (WHERE status = 'degraded') AS degraded,
       COUNT(*) FILTER (WHERE status = 'critical') AS critical,
       COUNT(*) FILTER (WHERE status = 'unknown') AS unknown
FROM chk GROUP BY environment"""

SQL["health_flatten"] = f"""WITH {SILVER},{CHECKS}
SELECT chk.environment, name, status, latency_ms, message, overall_status
FROM chk JOIN rollup USING (environment)"""

SQL["layer_presence"] = f"""WITH {DELIVERIES},{REG},{QF},
silver AS (SELECT q.*, reg.region, reg.sla_tier FROM q LEFT JOIN reg USING (device_id)
           WHERE n_id % 97 <> 0),
gold AS (SELECT DISTINCT device_id, device_type, region, sla_tier,
                time_bucket(INTERVAL 5 MINUTE, event_timestamp) AS w
         FROM silver WHERE is_valid),
l AS (
  SELECT 'bronze' AS layer, COUNT(*) AS rows FROM deliv
  UNION ALL SELECT 'silver', COUNT(*) FILTER (WHERE is_valid) FROM silver
  UNION ALL SELECT 'gold', COUNT(*) FROM gold)
SELECT layer, rows, rows > 0 AS present,
       CASE WHEN bool_and(rows > 0) OVER () THEN 'HEALTHY' ELSE 'DEGRADED' END AS status
FROM l"""

SQL["retention_plan"] = """WITH
p AS (SELECT CAST(ts AS DATE) AS partition_date, COUNT(*) AS rows FROM events GROUP BY 1),
l AS (SELECT p.*, v.layer FROM p, (VALUES ('bronze'), ('gold')) v(layer)),
a AS (SELECT *, CAST(date_diff('day', partition_date, DATE '2024-04-01') AS BIGINT) AS age_days
      FROM l)
SELECT layer, partition_date, rows, age_days,
       CASE WHEN layer = 'bronze' THEN
              CASE WHEN age_days > 90 THEN 'delete' WHEN age_days > 30 THEN 'archive'
                   WHEN age_days > 7 THEN 'cool' ELSE 'hot' END
            ELSE
              CASE WHEN age_days > 365 THEN 'delete' WHEN age_days > 30 THEN 'cool'
                   ELSE 'hot' END END AS tier
FROM a"""

SQL["compact_cluster"] = f"""WITH {SILVER}
SELECT event_id, device_id, event_timestamp, event_date, temperature_c, humidity_pct,
       battery_pct, is_valid, region FROM silver"""


SQL["silver_stream"] = f"""WITH {SILVER}
SELECT event_id, device_id, kafka_partition, kafka_offset, event_date, is_valid, region
FROM silver"""

SQL["gold_kpis_stream"] = SQL["gold_kpis"]



def _on_deliveries(sql: str) -> str:
    """Re-target a query written over ``tel`` to the well-formed deliveries
    (duplicates included, as a stream consumer sees them)."""
    body = (sql[len(f"WITH {TEL}"):].replace("FROM tel", "FROM feed")
            .replace("tel.*", "feed.*"))
    return f"WITH {DELIVERIES},\nfeed AS (SELECT * FROM deliv WHERE NOT broken)" + body


for _name in ("asa_tumbling", "asa_hopping", "asa_alerts", "asa_sessions"):
    SQL[_name] = SQL[f"{_name}_stream"] = _on_deliveries(SQL[_name])

# Streaming alerts use half-open windows [start, end): each event meets the
# ten windows that contain it.
SQL["alerts_stream"] = (SQL["alerts_range"]
                        .replace("s.event_timestamp BETWEEN r.window_start AND r.window_end",
                                 "s.event_timestamp >= r.window_start "
                                 "AND s.event_timestamp < r.window_end"))

SQL["bronze_schema_evolution"] = f"""WITH {DELIVERIES}
SELECT kafka_partition, kafka_offset, kafka_timestamp, event_date,
       CASE WHEN kafka_timestamp >= TIMESTAMP '2024-01-01 03:00:00' THEN 2 END AS schema_version
FROM deliv"""

# Hub payload text.  Spark's to_json leaves NULL fields out (ignoreNullFields);
# battery_pct is the only field the mapping can leave NULL.
PAYLOAD_JSON = """replace(CAST(to_json({'event_id': event_id, 'device_id': device_id,
    'device_type': device_type, 'timestamp_utc': timestamp_utc, 'latitude': latitude,
    'longitude': longitude, 'temperature_c': temperature_c, 'humidity_pct': humidity_pct,
    'pressure_hpa': pressure_hpa, 'battery_pct': battery_pct,
    'firmware_version': firmware_version, 'anomaly_flag': anomaly_flag,
    'payload': MAP {'seq': payload_seq}}) AS VARCHAR), '"battery_pct":null,', '')"""

SQL["bronze_project"] = f"""WITH {DELIVERIES}
SELECT kafka_key,
       CASE WHEN broken THEN '{{"event_id": "' || event_id || '", "device_id": '
            ELSE {PAYLOAD_JSON} END AS raw_payload,
       'telemetry-events' AS kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, event_date
FROM deliv"""

SQL["bronze_stream"] = SQL["bronze_project"]

# A killed and resumed pipeline, pruned lookups and an evolving stream give what
# the plain queries give.
SQL["gold_kpis_replay"] = SQL["gold_kpis"]
SQL["silver_upsert_pruned"] = SQL["silver_upsert"]
SQL["bronze_evolving_stream"] = SQL["bronze_schema_evolution"]

# The same alerts where every 11th event carries a text that is no time: such an
# event is in no window, and the LEFT JOIN keeps it if it is flagged.
TEL_TIMELESS = TEL.replace("tel AS (", "timed AS (", 1) + """,
tel AS (
  SELECT * REPLACE (CASE WHEN n_id % 11 = 0 THEN 'no time' ELSE timestamp_utc END AS timestamp_utc,
                    CASE WHEN n_id % 11 = 0 THEN NULL ELSE event_timestamp END AS event_timestamp)
  FROM timed
)"""
SQL["alerts_stream_left"] = SQL["alerts_stream"].replace(TEL, TEL_TIMELESS)

SQL["zorder_cluster"] = SQL["compact_cluster"]

# Quantiles as the middle of logarithmic buckets (1 % relative error).
_Q = {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}
SQL["metric_sketches"] = f"""WITH {TEL},
l AS (SELECT device_type, device_id, (epoch_us(kafka_timestamp) - epoch_us(event_timestamp)) // 1000 AS ms
      FROM tel WHERE event_timestamp IS NOT NULL),
b AS (SELECT device_type, CASE WHEN ms > 0 THEN ceil(ln(ms) / ln({D('1.01')} / 0.99)) END AS bucket, COUNT(*) AS n
      FROM l GROUP BY ALL),
r AS (SELECT *, SUM(n) OVER (PARTITION BY device_type ORDER BY bucket NULLS FIRST) AS upto,
             SUM(n) OVER (PARTITION BY device_type) AS total FROM b),
q AS (SELECT device_type, {", ".join(
    f"round(coalesce(2 * pow({D('1.01')} / 0.99, arg_min(coalesce(bucket, -1e9), upto) FILTER (WHERE upto >= ceil({D(v)} * total)))"
    f" / ({D('1.01')} / 0.99 + 1), 0), 6) AS {k}" for k, v in _Q.items())}
      FROM r GROUP BY device_type),
d AS (SELECT device_type, COUNT(DISTINCT device_id) AS active_devices, COUNT(*) AS events FROM l GROUP BY device_type)
SELECT * FROM q JOIN d USING (device_type)"""

SQL["retention_expire"] = """WITH
p AS (SELECT CAST(ts AS DATE) AS partition_date, COUNT(*) AS rows FROM events GROUP BY 1)
SELECT layer, partition_date, rows
FROM p, (VALUES ('bronze', 90), ('gold', 365)) v(layer, days)
WHERE date_diff('day', partition_date, DATE '2024-04-01') <= days"""

# The feed arrives in three parts, cut at 02:00 and 04:00 of hub time.  Bronze
# and Silver get a part each; Gold emits a window once the newest event time of
# valid rows so far, less two minutes, has reached its end.
BATCHES = f"""{SILVER},
part AS (SELECT *, CASE WHEN kafka_timestamp < TIMESTAMP '2024-01-01 02:00:00' THEN 1
                        WHEN kafka_timestamp < TIMESTAMP '2024-01-01 04:00:00' THEN 2 ELSE 3 END AS p FROM deliv),
spart AS (SELECT *, CASE WHEN kafka_timestamp < TIMESTAMP '2024-01-01 02:00:00' THEN 1
                         WHEN kafka_timestamp < TIMESTAMP '2024-01-01 04:00:00' THEN 2 ELSE 3 END AS p FROM silver),
seen AS (SELECT p, MAX(MAX(event_timestamp)) OVER (ORDER BY p) - INTERVAL 2 MINUTE AS mark FROM spart WHERE is_valid GROUP BY p),
kpi AS (SELECT DISTINCT device_id, device_type, region, sla_tier,
               time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE AS window_end
        FROM silver WHERE is_valid),
gpart AS (SELECT window_end, (SELECT MIN(p) FROM seen WHERE mark >= window_end) AS p FROM kpi),
batches AS (
  SELECT 'bronze' AS layer, p, COUNT(*) AS rows, MIN(kafka_timestamp) AS oldest, MAX(kafka_timestamp) AS newest
  FROM part GROUP BY p
  UNION ALL SELECT 'silver', p, COUNT(*), MIN(kafka_timestamp), MAX(kafka_timestamp) FROM spart GROUP BY p
  UNION ALL SELECT 'gold', p, COUNT(*), MIN(window_end), MAX(window_end) FROM gpart WHERE p IS NOT NULL GROUP BY p),
numbered AS (SELECT *, CAST(row_number() OVER (PARTITION BY layer ORDER BY p) AS INTEGER) AS n FROM batches)"""

SQL["batch_metrics"] = f"""WITH {BATCHES}
SELECT layer, n, rows, oldest, newest FROM numbered"""

SQL["sla_measured"] = f"""WITH {BATCHES},
clock AS (SELECT p, MAX(newest) OVER (ORDER BY p) AS now FROM batches WHERE layer = 'bronze'),
worst AS (
  SELECT layer, MAX((epoch_us(now) - epoch_us(oldest)) / {D(1000000)}) AS actual_sec, COUNT(*) AS batches,
         CASE layer WHEN 'bronze' THEN {D(30)} WHEN 'silver' THEN {D(120)} ELSE {D(900)} END AS target_sec
  FROM batches JOIN clock USING (p) GROUP BY layer),
scored AS (SELECT *, least({D(100)}, actual_sec / target_sec * {D(100)}) AS pct FROM worst)
SELECT layer, actual_sec, batches, target_sec, pct,
       CASE WHEN pct < 60 THEN 'green' WHEN pct < 85 THEN 'amber' ELSE 'red' END AS status
FROM scored"""

# Every 13th event reaches the hub two hours late, and the feed arrives in three
# parts again.  A consumer's watermark for a part is the newest event time of
# the parts before it, less the delay; a window that ends by then is closed.
_ARRIVES = "kafka_timestamp + CASE WHEN n_id % 13 = 0 THEN INTERVAL 2 HOUR ELSE INTERVAL 0 HOUR END"
_PART = (f"CASE WHEN {_ARRIVES} < TIMESTAMP '2024-01-01 02:00:00' THEN 1 "
         f"WHEN {_ARRIVES} < TIMESTAMP '2024-01-01 04:00:00' THEN 2 ELSE 3 END")


def _marked(name: str, rows: str, time: str, delay: str) -> str:
    return f"""
{name}_p AS (SELECT *, {_PART} AS p FROM {rows}),
{name}_marks AS (
  SELECT p, date_trunc('milliseconds', MAX(MAX({time})) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
            - INTERVAL {delay} AS mark
  FROM {name}_p GROUP BY p),
{name} AS (SELECT {name}_p.*, mark FROM {name}_p JOIN {name}_marks USING (p) WHERE event_timestamp IS NOT NULL)"""


_KPI_END = "time_bucket(INTERVAL 5 MINUTE, event_timestamp) + INTERVAL 5 MINUTE"
_HOP_END = "date_trunc('minute', event_timestamp - INTERVAL 1 MICROSECOND) + INTERVAL 1 MINUTE * (1 + h)"
GATED = f"""{SILVER},
feed AS (SELECT * FROM deliv WHERE NOT broken),{_marked("for_kpis", "(SELECT * FROM silver WHERE is_valid)", "event_timestamp", "2 MINUTE")},
{_marked("for_hopping", "feed", "event_timestamp - INTERVAL 1 MICROSECOND", "1 MINUTE")},
{_marked("for_sessions", "feed", "event_timestamp", "1 MINUTE")},
{_marked("for_alerts", "silver", "event_timestamp", "1 MINUTE")},
placed AS (
  SELECT 'kpis' AS consumer, event_id, kafka_offset, device_id, event_timestamp, {_KPI_END} AS closed_at, mark FROM for_kpis
  UNION ALL SELECT 'hopping', event_id, kafka_offset, device_id, event_timestamp, {_HOP_END}, mark
  FROM for_hopping, unnest(generate_series(0, 4)) AS g(h)
  UNION ALL SELECT 'sessions', event_id, kafka_offset, device_id, event_timestamp, event_timestamp + INTERVAL 5 MINUTE, mark FROM for_sessions
  UNION ALL SELECT 'alerts', event_id, kafka_offset, device_id, event_timestamp, event_timestamp, mark FROM for_alerts)"""

SQL["late_rows"] = f"""WITH {GATED}
SELECT * FROM placed WHERE closed_at <= mark"""

SQL["late_balance"] = f"""WITH {GATED}
SELECT consumer, COUNT(*) FILTER (WHERE NOT coalesce(closed_at <= mark, false)) AS kept,
       COUNT(*) FILTER (WHERE closed_at <= mark) AS late
FROM placed WHERE consumer <> 'alerts' GROUP BY consumer"""


def _on_time(sql: str, consumer: str, closed_at: str) -> str:
    """``sql`` over the rows of Silver that came in time."""
    gated = GATED.replace("silver AS (SELECT firsts.*", "all_silver AS (SELECT firsts.*", 1).replace(
        "FROM silver", "FROM all_silver")
    return sql.replace(SILVER, f"""{gated},
silver AS (SELECT * EXCLUDE (p, mark) FROM for_{consumer} WHERE mark IS NULL OR {closed_at} > mark)""", 1)


SQL["gold_kpis_gated"] = _on_time(SQL["gold_kpis"], "kpis", _KPI_END)
SQL["alerts_gated"] = _on_time(SQL["alerts_stream"], "alerts", "event_timestamp")
SQL["asa_hopping_gated"] = SQL["asa_hopping"].replace(f"WITH {DELIVERIES},\nfeed AS (SELECT * FROM deliv WHERE NOT broken)", f"WITH {GATED}", 1).replace(
    "FROM feed, unnest(generate_series(0, 4)) AS g(h)\n  WHERE event_timestamp IS NOT NULL",
    f"FROM for_hopping AS feed, unnest(generate_series(0, 4)) AS g(h)\n  WHERE mark IS NULL OR {_HOP_END} > mark")


ORACLE_SQL = SQL
