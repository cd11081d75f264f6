"""Station data derived from the driver's tables, with one SQL text for Spark and for DuckDB.

A station for each user, but a third of the rows belong to ten hot stations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Engine-specific fragments of the view texts.
SPARK = {
    "<K>": "get_json_object(props, '$.k')",
    "<STRING>": "STRING",
    "<CREATED>": "ts + make_dt_interval(0,0,0,(event_id * 31) % 300)",
    "<UPDATED>": "ts + make_dt_interval(0,0,0,(event_id * 31) % 300 + CASE WHEN event_id % 333 = 0 THEN -30 WHEN event_id % 50 = 0 THEN 120 ELSE 0 END)",
    "<UPDATED2>": "updated_at + make_dt_interval(0,0,0,600)",
}
DUCKDB = {
    "<K>": "json_extract_string(props, '$.k')",
    "<STRING>": "VARCHAR",
    "<CREATED>": "ts + to_seconds((event_id * 31) % 300)",
    "<UPDATED>": "ts + to_seconds((event_id * 31) % 300 + CASE WHEN event_id % 333 = 0 THEN -30 WHEN event_id % 50 = 0 THEN 120 ELSE 0 END)",
    "<UPDATED2>": "updated_at + to_seconds(600)",
}
VIEWS = {
    "fx_station": """
SELECT c_custkey AS station_id, c_name AS station_code, c_mktsegment AS operator_code,
 n_name AS province, r_name AS region,
 CASE c_custkey % 3 WHEN 0 THEN 'urban' WHEN 1 THEN 'suburban' ELSE 'rural' END AS density_class,
 CASE c_custkey % 4 WHEN 0 THEN '2G' WHEN 1 THEN '3G' WHEN 2 THEN '4G' ELSE '5G' END AS technology
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_custkey % 11 <> 0""",
    "fx_traffic": """
SELECT event_id AS traffic_id, CASE WHEN event_id % 97 = 0 THEN NULL WHEN user_id % 3 = 0 THEN user_id % 10 ELSE user_id END AS station_id,
 ts AS event_time, CASE WHEN event_id % 89 = 0 THEN '' ELSE concat('sub_', <K>) END AS imsi_hash,
 CASE event_id % 20 WHEN 0 THEN 'SCTP' WHEN 1 THEN NULL WHEN 2 THEN 'UDP' WHEN 3 THEN 'ICMP' ELSE 'TCP' END AS protocol,
 CASE WHEN event_id % 101 = 0 THEN -1 ELSE (event_id * 7919) % 100003 END AS bytes_up,
 (event_id * 104729) % 1000003 AS bytes_down,
 value AS latency_ms, CASE WHEN event_id % 61 = 0 THEN NULL ELSE value / 10 END AS jitter_ms, value / 2 AS packet_loss_pct,
 (event_id * 25907) % 90000000 AS connection_duration_ms,
 <CREATED> AS created_at, <UPDATED> AS updated_at, event_id % 41 = 0 AS is_deleted
FROM events""",
    "fx_traffic_changes": """
SELECT traffic_id, station_id, event_time, imsi_hash, protocol, bytes_up * 2 AS bytes_up, bytes_down, latency_ms, jitter_ms, packet_loss_pct,
 connection_duration_ms, created_at, <UPDATED2> AS updated_at, traffic_id % 50 = 0 AS is_deleted
FROM fx_traffic WHERE traffic_id % 25 = 0""",
    "fx_metrics": """
SELECT event_id AS metric_id, CASE WHEN user_id % 3 = 0 THEN user_id % 10 ELSE user_id END AS station_id, ts AS metric_time,
 CAST((event_id * 37) % 103 AS DOUBLE) AS cpu_usage_pct, CAST((event_id * 53) % 101 AS DOUBLE) AS memory_usage_pct,
 CAST(20 + (event_id * 29) % 80 AS DOUBLE) AS temperature_celsius,
 CAST((event_id * 17) % 700 AS DOUBLE) AS uplink_throughput_mbps, CAST((event_id * 41) % 2500 AS DOUBLE) AS downlink_throughput_mbps,
 CASE event_id % 6 WHEN 0 THEN 'n78' WHEN 1 THEN 'Band-3' WHEN 2 THEN 'GSM-900' WHEN 3 THEN 'unknown' WHEN 4 THEN 'Band-99' ELSE NULL END AS frequency_band,
 <CREATED> AS created_at, <CREATED> AS updated_at, event_id % 43 = 0 AS is_deleted
FROM events""",
    "fx_events": """
SELECT event_id, CASE WHEN user_id % 3 = 0 THEN user_id % 10 ELSE user_id END AS station_id, ts AS event_time,
 CASE event_type WHEN 'error' THEN 'incident_start' WHEN 'signup' THEN 'incident_end' WHEN 'click' THEN 'handover' WHEN 'view' THEN 'alarm'
  ELSE CASE WHEN event_id % 2 = 0 THEN 'maintenance_start' ELSE 'maintenance_end' END END AS event_type,
 CASE event_id % 5 WHEN 0 THEN 'info' WHEN 1 THEN 'warning' WHEN 2 THEN 'error' WHEN 3 THEN 'critical' ELSE 'bogus' END AS severity,
 concat('cause_', CAST(event_id % 7 AS <STRING>)) AS description,
 CASE event_type WHEN 'error' THEN concat('{"incident_type":"', CASE event_id % 2 WHEN 0 THEN 'failure' ELSE 'degradation' END, '","severity":0.5,"estimated_duration_min":', <K>, '}')
  WHEN 'purchase' THEN concat('{"duration_min":', <K>, ',"sla_excluded":true,"upgrade":false}')
  WHEN 'click' THEN concat('{"imsi_hash":"sub_', <K>, '"}') ELSE '{}' END AS metadata,
 CASE WHEN event_type = 'click' THEN (user_id + event_id) % 10 END AS target_station_id,
 <CREATED> AS created_at, <CREATED> AS updated_at, event_id % 47 = 0 AS is_deleted
FROM events""",
}
TABLES = ("events", "customer", "nation", "region")
#: The time at which open intervals are read, so that results repeat.
AS_OF = "2024-02-01 00:00:00"


def view_sql(name: str, parts: dict[str, str]) -> str:
    """A view's text for one engine."""
    text = VIEWS[name]
    for mark, part in parts.items():
        text = text.replace(mark, part)
    return text


def load(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    """The named fixture frames over the tables of ``sf_dir``."""
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(f"source_{name}")

    def frame(name: str) -> DataFrame:
        text = view_sql(name, SPARK)
        for t in TABLES:
            text = text.replace(f"FROM {t}", f"FROM source_{t} AS {t}").replace(f"JOIN {t} ", f"JOIN source_{t} AS {t} ")
        if name == "fx_traffic_changes":
            frame("fx_traffic").createOrReplaceTempView("fx_traffic")
        return spark.sql(text)

    return [frame(n) for n in names]
