"""The station queries in DuckDB SQL, over the same fixture views as common table expressions."""

from __future__ import annotations

import re

from stationflow.functions.numbers import LIFT
from stationflow.operators import quality as q
from stationflow.sources.fixtures import AS_OF, DUCKDB, VIEWS, view_sql


def _in(values: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _issues(rules: dict[str, str]) -> str:
    return "concat_ws(','," + ", ".join(f"CASE WHEN {rule} THEN '{label}' END" for label, rule in rules.items()) + ")"


def _outside(col: str, lo: float, hi: float) -> str:
    return f"coalesce(NOT ({col} BETWEEN {lo} AND {hi}), true)"


def _alien(col: str, values: tuple[str, ...]) -> str:
    return f"coalesce({col} NOT IN {_in(values)}, true)"


P = q.DEFAULT
FUTURE = "coalesce({} > TIMESTAMP '" + AS_OF + "' + INTERVAL 300 SECOND, false)"
TRAFFIC_RULES = {
    "event_time_null": "event_time IS NULL",
    "event_future": FUTURE.format("event_time"),
    "bytes_up<0": "coalesce(bytes_up < 0, false)",
    "bytes_down<0": "coalesce(bytes_down < 0, false)",
    "latency_invalid": _outside("latency_ms", *P.latency),
    "jitter_invalid": _outside("jitter_ms", *P.jitter),
    "pkt_loss_invalid": _outside("packet_loss_pct", *P.packet_loss),
    "duration_invalid": _outside("connection_duration_ms", *P.duration),
    "protocol_invalid": _alien("protocol", q.PROTOCOLS),
    "station_null": "station_id IS NULL",
    "imsi_null": "(imsi_hash IS NULL OR imsi_hash = '')",
    "updated_before_created": "coalesce(updated_at < created_at, false)",
}
METRIC_RULES = {
    "event_time_null": "metric_time IS NULL",
    "station_null": "station_id IS NULL",
    "cpu_invalid": _outside("cpu_usage_pct", *P.percent),
    "memory_invalid": _outside("memory_usage_pct", *P.percent),
    "temp_invalid": _outside("temperature_celsius", *P.temperature),
    "uplink_invalid": _outside("uplink_throughput_mbps", *P.throughput),
    "downlink_invalid": _outside("downlink_throughput_mbps", *P.throughput),
    "band_invalid": _alien("frequency_band", q.BANDS),
}
EVENT_RULES = {
    "event_time_null": "event_time IS NULL",
    "station_null": "station_id IS NULL",
    "event_type_invalid": _alien("event_type", q.EVENT_TYPES),
    "severity_invalid": _alien("severity", q.SEVERITIES),
    "event_future": FUTURE.format("event_time"),
}


def r(x: str, digits: int = 4, lift: float = LIFT) -> str:
    """Half-up rounding by floor, off exact halves by ``lift``."""
    return f"floor(({x}) * {10**digits} + {0.5 + lift}::DOUBLE) / {float(10**digits)}"


def _latest(source: str, time: str, key: str) -> str:
    return f"SELECT * EXCLUDE (nth) FROM (SELECT *, row_number() OVER (PARTITION BY station_id, {time}, {key} ORDER BY updated_at DESC) AS nth FROM {source}) WHERE nth = 1 AND NOT coalesce(is_deleted, false)"


def _lookup(body: str, key: str, attrs: dict[str, str]) -> str:
    cols = ", ".join(f"coalesce(ds.{c}, '') AS {n}" for n, c in attrs.items())
    return f"SELECT b.*, {cols} FROM ({body}) b LEFT JOIN fx_station ds ON b.{key} = ds.station_id"


ALL6 = {a: a for a in ("station_code", "operator_code", "province", "region", "density_class", "technology")}
SOFT = "[" + ", ".join(f"'{s}'" for s in q.SOFT) + "]"
MINUTES = "(floor(epoch({1}) / 60) - floor(epoch({0}) / 60))::BIGINT"
DURATION = "coalesce(TRY_CAST(json_extract_string(end_meta, '$.duration_min') AS DOUBLE), " + MINUTES.format("started", "ended") + ")"
EXPECTED = "CASE technology WHEN '2G' THEN 0.01 WHEN '3G' THEN 0.1 WHEN '4G' THEN 1.0 WHEN '5G' THEN 5.0 ELSE 1.0 END"
Z = {"latency": ("avg_latency_ms", "current_latency_ms"), "cpu": ("avg_cpu_pct", "current_cpu_pct"), "throughput": ("avg_downlink_throughput_mbps", "current_throughput"), "subscribers": ("unique_subscribers", "current_subscribers")}


def _pairs(start: str, end: str) -> str:
    return f"""SELECT s.station_id, s.report_date, s.start_id, s.started, s.start_meta, e.ended, e.end_meta FROM (
 SELECT station_id, CAST(event_time AS DATE) AS report_date, event_id AS start_id, event_time AS started, metadata AS start_meta,
  row_number() OVER (PARTITION BY station_id, CAST(event_time AS DATE) ORDER BY event_time, event_id) AS nth FROM live_events WHERE event_type = '{start}') s
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY station_id, report_date ORDER BY ended, event_id) AS nth FROM (
 SELECT station_id, event_id, event_time AS ended, metadata AS end_meta, unnest([CAST(event_time AS DATE), CAST(event_time AS DATE) - 1]) AS report_date FROM live_events WHERE event_type = '{end}')) e
 ON s.station_id = e.station_id AND s.report_date = e.report_date AND s.nth = e.nth"""


def _next_end(start: str, end: str) -> str:
    return f"""SELECT station_id, report_date, start_id, started, start_meta, ended, end_meta FROM (
 SELECT station_id, event_type, CAST(event_time AS DATE) AS report_date, event_id AS start_id, event_time AS started, metadata AS start_meta,
  min(CASE WHEN event_type = '{end}' THEN event_time END) OVER w AS ended, first(CASE WHEN event_type = '{end}' THEN metadata END IGNORE NULLS) OVER w AS end_meta
 FROM live_events WHERE event_type IN ('{start}', '{end}') WINDOW w AS (PARTITION BY station_id ORDER BY event_time, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
WHERE event_type = '{start}'"""


def _outage(pairs: str) -> str:
    return _lookup(f"""SELECT p.station_id, p.report_date, p.start_id, json_extract_string(start_meta, '$.incident_type') AS incident_type,
 TRY_CAST(json_extract_string(start_meta, '$.severity') AS DOUBLE) AS severity, started AS incident_start, ended AS incident_end,
 {DURATION} AS duration_min, TRY_CAST(json_extract_string(start_meta, '$.estimated_duration_min') AS DOUBLE) AS estimated_duration_min,
 coalesce(it.affected_subscribers, 0) AS affected_subscribers,
 {r("greatest(0.0, coalesce(bl.avg_hourly_bytes, 0.0) * (coalesce(" + DURATION + ", 0.0) / 60) - coalesce(it.incident_bytes, 0))")} AS traffic_loss_bytes,
 TRY_CAST(json_extract_string(start_meta, '$.hardware_quality') AS DOUBLE) AS hardware_quality, {r("ih.health_score_during")} AS health_score_during
FROM {pairs} p
LEFT JOIN (SELECT start_id, count(DISTINCT imsi_hash) AS affected_subscribers, sum(bytes_up + bytes_down)::BIGINT AS incident_bytes FROM {pairs} i
 JOIN live_traffic t ON i.station_id = t.station_id AND t.event_time BETWEEN i.started AND coalesce(i.ended, TIMESTAMP '{AS_OF}') GROUP BY start_id) it ON p.start_id = it.start_id
LEFT JOIN (SELECT start_id, avg(health_score) AS health_score_during FROM {pairs} i JOIN health h ON i.station_id = h.station_id AND coalesce(i.ended, TIMESTAMP '{AS_OF}') >= i.started
 AND h.hour_start BETWEEN date_trunc('hour', i.started) AND date_trunc('hour', coalesce(i.ended, TIMESTAMP '{AS_OF}')) GROUP BY start_id) ih ON p.start_id = ih.start_id
LEFT JOIN baseline bl ON p.station_id = bl.station_id AND p.report_date = bl.report_date AND hour(p.started) = bl.hour_of_day""", "station_id", {a: a for a in ("station_code", "operator_code", "province", "region", "technology")})


#: Common table expressions by name; a query gets those it names, in this order.
CTES: dict[str, str] = {name: view_sql(name, DUCKDB) for name in VIEWS} | {
    "all_traffic": "SELECT * FROM fx_traffic UNION ALL BY NAME SELECT * FROM fx_traffic_changes",
    "judged_traffic": f"SELECT *, quality_issues = '' AS is_valid FROM (SELECT *, {_issues(TRAFFIC_RULES)} AS quality_issues FROM all_traffic)",
    "judged_metrics": f"SELECT *, quality_issues = '' AS is_valid FROM (SELECT *, {_issues(METRIC_RULES)} AS quality_issues FROM fx_metrics)",
    "judged_events": f"SELECT *, quality_issues = '' AS is_valid FROM (SELECT *, {_issues(EVENT_RULES)} AS quality_issues FROM fx_events)",
    "staged_traffic": f"SELECT *, CASE WHEN is_valid THEN 'valid' ELSE 'quarantined' END AS data_quality FROM judged_traffic WHERE is_valid OR len(list_filter(string_split(quality_issues, ','), lambda x: NOT list_contains({SOFT}, x))) = 0",
    "live_traffic": _latest("staged_traffic", "event_time", "traffic_id"),
    "live_metrics": _latest("judged_metrics WHERE is_valid", "metric_time", "metric_id"),
    "live_events": _latest("judged_events WHERE is_valid", "event_time", "event_id"),
    "traffic_dim": _lookup("SELECT * FROM live_traffic", "station_id", ALL6),
    "metrics_hour": "SELECT station_id, date_trunc('hour', metric_time) AS hour_start, avg(cpu_usage_pct) AS avg_cpu_pct, max(cpu_usage_pct) AS max_cpu_pct, avg(memory_usage_pct) AS avg_memory_pct, avg(temperature_celsius) AS avg_temperature_celsius, max(temperature_celsius) AS max_temperature_celsius, avg(uplink_throughput_mbps) AS avg_uplink_throughput_mbps, avg(downlink_throughput_mbps) AS avg_downlink_throughput_mbps FROM live_metrics GROUP BY 1, 2",
    "events_hour": "SELECT station_id, date_trunc('hour', event_time) AS hour_start, count(*) FILTER (event_type = 'alarm') AS alarm_count, count(*) FILTER (severity IN ('warning', 'error', 'critical')) AS warning_count, count(*) FILTER (severity = 'critical') AS critical_count, count(*) FILTER (event_type = 'handover') AS handover_count, max((event_type = 'incident_start')::INT) AS incident_active, arg_max(json_extract_string(metadata, '$.incident_type'), (event_time, event_id)) FILTER (event_type = 'incident_start') AS incident_type, max((event_type = 'maintenance_start')::INT) AS maintenance_active FROM live_events GROUP BY 1, 2",
    "health_base": _lookup("""SELECT t.*, m.* EXCLUDE (station_id, hour_start), coalesce(e.alarm_count, 0) AS alarm_count, coalesce(e.warning_count, 0) AS warning_count, coalesce(e.critical_count, 0) AS critical_count,
 coalesce(e.handover_count, 0) AS handover_count, coalesce(e.incident_active, 0) AS incident_active, e.incident_type, coalesce(e.maintenance_active, 0) AS maintenance_active
FROM (SELECT station_id, date_trunc('hour', event_time) AS hour_start, count(*) AS session_count, count(DISTINCT imsi_hash) AS unique_subscribers, sum(bytes_up + bytes_down)::BIGINT AS total_bytes, avg(latency_ms) AS avg_latency_ms,
 quantile_cont(latency_ms, 0.95) AS p95_latency_ms, avg(packet_loss_pct) AS avg_packet_loss_pct, count(*) FILTER (latency_ms > 100) / count(*) AS high_latency_ratio FROM live_traffic GROUP BY 1, 2) t
LEFT JOIN metrics_hour m ON t.station_id = m.station_id AND t.hour_start = m.hour_start LEFT JOIN events_hour e ON t.station_id = e.station_id AND t.hour_start = e.hour_start""", "station_id", ALL6),
    "health_raw": f"""SELECT *, least(0.25 * greatest(0.0, 100 - (coalesce(avg_latency_ms, 0) - 30) * 100 / 470) + 0.20 * greatest(0.0, 100 - coalesce(avg_packet_loss_pct, 0) * 10) + 0.15 * greatest(0.0, 100 - greatest(0.0, coalesce(avg_cpu_pct, 0) - 50) * 2)
 + 0.10 * greatest(0.0, 100 - greatest(0.0, coalesce(avg_temperature_celsius, 0) - 45) * 100 / 35) + 0.15 * greatest(0.0, 100 - (10.0 * warning_count + 30.0 * critical_count)) + 0.15 * least(1.0, coalesce(avg_downlink_throughput_mbps, 0) / greatest(0.001, ({EXPECTED})::DOUBLE * 1000 * 0.3)) * 100,
 CASE WHEN incident_active = 1 THEN CASE incident_type WHEN 'failure' THEN 15.0 WHEN 'degradation' THEN 50.0 END END) AS raw FROM health_base""",
    "health": f"SELECT * EXCLUDE (raw), CASE WHEN maintenance_active = 0 THEN {r('raw::DOUBLE', 2)} END AS health_score, CASE WHEN maintenance_active = 1 THEN 'maintenance' WHEN raw < 30 THEN 'critical' WHEN raw < 60 THEN 'degraded' WHEN raw < 80 THEN 'warning' ELSE 'healthy' END AS health_category FROM health_raw",
    "incident_pairs": _pairs("incident_start", "incident_end"),
    "incident_next": _next_end("incident_start", "incident_end"),
    "maintenance_pairs": _pairs("maintenance_start", "maintenance_end"),
    "volume": "SELECT station_id, CAST(event_time AS DATE) AS day, hour(event_time) AS hour_of_day, sum(bytes_up + bytes_down)::BIGINT AS bytes FROM live_traffic GROUP BY 1, 2, 3",
    "baseline": "SELECT station_id, report_date, hour_of_day, sum(bytes) / 7.0::DOUBLE AS avg_hourly_bytes FROM (SELECT *, day + unnest([1, 2, 3, 4, 5, 6, 7]) AS report_date FROM volume) WHERE report_date IN (SELECT CAST(event_time AS DATE) FROM live_events WHERE event_type = 'incident_start') GROUP BY 1, 2, 3",
    "sla_days": "SELECT station_id, CAST(hour_start AS DATE) AS report_date, station_code, operator_code, province, region, density_class, technology, count(*) AS total_hours, count(*) FILTER (health_category <> 'maintenance') AS active_hours, count(*) FILTER (health_category = 'critical') AS down_hours, count(*) FILTER (health_category = 'maintenance') AS maintenance_hours, count(*) FILTER (health_category IN ('degraded', 'warning')) AS degraded_hours, avg(health_score) AS avg_health_score, min(health_score) AS min_health_score, count(*) FILTER (health_score < 60) AS hours_below_60, count(*) FILTER (health_score < 30) AS hours_below_30 FROM health GROUP BY ALL",
    "sla_up": "SELECT *, 24 - maintenance_hours AS billable_hours, 24 - maintenance_hours - down_hours AS available_hours, CASE WHEN maintenance_hours < 24 THEN (24 - maintenance_hours - down_hours) / (24 - maintenance_hours) ELSE 1.0::DOUBLE END * 100 AS uptime_pct, CASE technology WHEN '5G' THEN 99.99::DOUBLE WHEN '4G' THEN 99.9 WHEN '3G' THEN 99.5 ELSE 99.0 END AS sla_target_pct FROM sla_days",
    "sla": f"""SELECT s.*, (uptime_pct >= sla_target_pct)::INT AS sla_met, greatest(0.0, sla_target_pct / 100 * billable_hours - available_hours) AS sla_breach_hours,
 CASE WHEN uptime_pct >= sla_target_pct THEN 'compliant' WHEN uptime_pct <= 95 THEN 'critical_breach' ELSE 'minor_breach' END AS compliance_status,
 coalesce(i.incident_count, 0) AS incident_count, i.total_incident_min, i.longest_incident_min, i.mttr_min
FROM sla_up s LEFT JOIN (SELECT station_id, report_date, count(*) AS incident_count, sum({DURATION}) AS total_incident_min, max({DURATION}) AS longest_incident_min, avg({DURATION}) AS mttr_min FROM incident_pairs GROUP BY 1, 2) i
 ON s.station_id = i.station_id AND s.report_date = i.report_date""",
    "based": "SELECT h.*, " + ", ".join(f"{fn}({c}) OVER past AS {n}_{stat}" for n, (c, _) in Z.items() for stat, fn in (("mean", "avg"), ("std", "stddev_pop"))) + " FROM (SELECT *, hour(hour_start) AS hod, date_diff('day', DATE '1970-01-01', CAST(hour_start AS DATE)) AS dayno FROM health) h WINDOW past AS (PARTITION BY station_id, hod ORDER BY dayno RANGE BETWEEN 7 PRECEDING AND 1 PRECEDING)",
    "measured": "SELECT * REPLACE (" + ", ".join(f"{r(x + '::DOUBLE', 6)} AS {x}" for n, (c, _) in Z.items() for x in (c, f"{n}_mean", f"{n}_std")) + ") FROM based",
    "scored": "SELECT *, " + ", ".join(f"{c}::DOUBLE AS {shown}, coalesce({n}_mean, {c}::DOUBLE) AS baseline_{n}_mean, coalesce({n}_std, 0.0::DOUBLE) AS baseline_{n}_std, ({c}::DOUBLE - coalesce({n}_mean, {c}::DOUBLE)) / greatest(coalesce({n}_std, 0.0), 1e-6) AS z_{n}" for n, (c, shown) in Z.items()) + " FROM measured",
    "anomalies": "SELECT station_id, station_code, hour_start, " + ", ".join(f"{shown}, baseline_{n}_mean, baseline_{n}_std, z_{n}" for n, (_, shown) in Z.items()) + ", avg_packet_loss_pct AS current_packet_loss, (kinds <> '')::INT AS is_anomalous, nullif(kinds, '') AS anomaly_type, 0 AS neighbor_anomaly_count FROM (SELECT *, concat_ws(',', " + ", ".join(f"CASE WHEN {'z_throughput < -3' if n == 'throughput' else f'abs(z_{n}) > 3'} THEN '{n}' END" for n in Z) + ") AS kinds FROM scored)",
    "manifest_parts": "SELECT CAST(floor(epoch(updated_at) / 3600) AS BIGINT) AS batch_id, strftime(event_time, 'year=%Y/month=%m/day=%d/hour=%H') AS key, count(*) AS n, min(updated_at) AS low, max(updated_at) AS high FROM all_traffic GROUP BY 1, 2",
    "manifest": "SELECT batch_id, sum(n)::BIGINT AS record_count, list_sort(list(key)) AS data_keys, min(low) AS from_time, max(high) AS to_time, batch_id % 3 <> 0 AS is_loaded FROM manifest_parts GROUP BY 1",
    "windows": f"SELECT i + 1 AS nth, s + to_seconds(3600 * i) - to_seconds(CASE WHEN i > 0 THEN 24 ELSE 0 END) AS from_time, s + to_seconds(3600 * i) AS nominal_from, least(TIMESTAMP '{AS_OF}' - INTERVAL 240 SECOND, s + to_seconds(3600 * i) + INTERVAL 3600 SECOND) AS to_time FROM (SELECT min(updated_at) AS s FROM fx_traffic) CROSS JOIN (SELECT unnest(range(100)) AS i) WHERE s + to_seconds(3600 * i) < TIMESTAMP '{AS_OF}' - INTERVAL 240 SECOND",
    "short_windows": f"SELECT i + 1 AS nth, s + to_seconds(30 * i) - to_seconds(CASE WHEN i > 0 THEN 24 ELSE 0 END) AS from_time, s + to_seconds(30 * i) AS nominal_from, least(TIMESTAMP '{AS_OF}' - INTERVAL 240 SECOND, s + to_seconds(30 * i) + INTERVAL 30 SECOND) AS to_time FROM (SELECT min(updated_at) AS s FROM fx_traffic) CROSS JOIN (SELECT unnest(range(2000)) AS i) WHERE s + to_seconds(30 * i) < TIMESTAMP '{AS_OF}' - INTERVAL 240 SECOND",
}


def oracle(body: str) -> str:
    """``body`` with the expressions it needs, directly or through others."""
    need: set[str] = set()
    todo = [body]
    while todo:
        for name in set(re.findall(r"[a-z_]+", todo.pop())) & CTES.keys() - need:
            need.add(name)
            todo.append(CTES[name])
    ctes = [f"{name} AS ({text})" for name, text in CTES.items() if name in need]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def rounded_sql(sql: str, doubles: str = "") -> str:
    """``sql`` with the named double columns rounded as the queries round theirs."""
    return f"SELECT * REPLACE ({', '.join(f'{r(c)} AS {c}' for c in doubles.split())}) FROM ({sql})" if doubles else sql


def outage(pairs: str) -> str:
    return _outage(pairs)


def lookup(body: str, key: str, attrs: dict[str, str]) -> str:
    return _lookup(body, key, attrs)
