"""Station queries that SQL can state, each with its DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.times import at, hour_start
from stationflow.operators import distinct, joins, manifest, quality, reports, rollup, versions
from stationflow.plans import contract
from stationflow.plans.feeds import Feeds, tidy
from stationflow.plans.oracle import AS_OF, MINUTES, lookup, oracle, outage, r, rounded_sql
from stationflow.sources import lake
from stationflow.sources.scratch import staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
LO, HI = "2024-01-10 00:00:00", "2024-01-20 00:00:00"
HOUR_SECONDS = 3600


def query(sql: str, doubles: str = "") -> Callable:
    """Register a function of the feeds under its name, with SQL for the same rows; ``doubles`` are rounded in both."""

    def add(fn: Callable[[Feeds], DataFrame]) -> Callable:
        QUERIES[fn.__name__] = lambda spark, sf_dir: tidy(fn(Feeds(spark, sf_dir)))
        ORACLE_SQL[fn.__name__] = oracle(rounded_sql(sql, doubles))
        return fn

    return add


# Extraction and windows


@query(f"SELECT traffic_id, updated_at FROM fx_traffic WHERE updated_at > TIMESTAMP '{LO}' AND updated_at <= TIMESTAMP '{HI}'")
def cdc_extract(f: Feeds) -> DataFrame:
    return lake.cdc_extract(f.traffic, LO, HI, "traffic_id").select("traffic_id", "updated_at")


QUERIES["cdc_order"], ORACLE_SQL["cdc_order"] = (lambda spark, sf_dir: Feeds(spark, sf_dir).traffic.select("traffic_id", "updated_at").orderBy("updated_at", "traffic_id")), oracle("SELECT traffic_id, updated_at FROM fx_traffic ORDER BY updated_at, traffic_id")


@query("SELECT * FROM windows")
def plan_windows(f: Feeds) -> DataFrame:
    return manifest.plan_windows(f.traffic, AS_OF)


@query("SELECT min(updated_at) AS watermark FROM fx_traffic")
def initial_watermark(f: Feeds) -> DataFrame:
    return lake.initial_watermark(f.traffic)


#: Windows so short that some hold no change.
SHORT = {"max_window": 30, "max_n": 2000}


@query("SELECT w.nth, w.from_time, w.to_time, (SELECT min(updated_at) FROM fx_traffic WHERE updated_at > w.to_time) AS next_from FROM short_windows w WHERE NOT EXISTS (SELECT 1 FROM fx_traffic t WHERE t.updated_at > w.from_time AND t.updated_at <= w.to_time)")
def skip_gaps(f: Feeds) -> DataFrame:
    return manifest.skip_gaps(manifest.plan_windows(f.traffic, AS_OF, **SHORT), f.traffic)


@query("SELECT w.nth, w.from_time, w.to_time FROM short_windows w WHERE EXISTS (SELECT 1 FROM fx_traffic t WHERE t.updated_at > w.from_time AND t.updated_at <= w.to_time)")
def file_semi(f: Feeds) -> DataFrame:
    return manifest.windows_with_data(manifest.plan_windows(f.traffic, AS_OF, **SHORT), f.traffic).select("nth", "from_time", "to_time")


@query(f"SELECT traffic_id, event_time FROM all_traffic WHERE event_time >= TIMESTAMP '{AS_OF}' - INTERVAL 20 DAY")
def retention(f: Feeds) -> DataFrame:
    return lake.retention(f.all_traffic, "event_time", 20, AS_OF).select("traffic_id", "event_time")


# Quality

JUDGED = "is_valid, quality_issues"


@query(f"SELECT traffic_id, updated_at, {JUDGED} FROM judged_traffic")
def validate_traffic(f: Feeds) -> DataFrame:
    return f.judged_traffic().select("traffic_id", "updated_at", "is_valid", "quality_issues")


@query(f"SELECT metric_id, {JUDGED} FROM judged_metrics")
def validate_metrics(f: Feeds) -> DataFrame:
    return f.judged_metrics().select("metric_id", "is_valid", "quality_issues")


@query(f"SELECT event_id, {JUDGED} FROM judged_events")
def validate_events(f: Feeds) -> DataFrame:
    return f.judged_events().select("event_id", "is_valid", "quality_issues")


@query("SELECT quality_issues, count(*) AS n FROM judged_traffic GROUP BY 1")
def quality_string(f: Feeds) -> DataFrame:
    return f.judged_traffic().groupBy("quality_issues").agg(F.count("*").alias("n"))


@query("SELECT count(*) FILTER (coalesce(NOT (jitter_ms BETWEEN 0 AND 40), true)) AS out_of_range, count(*) FILTER (coalesce(protocol NOT IN ('TCP', 'UDP', 'ICMP', 'OTHER'), true)) AS alien, count(*) FILTER (imsi_hash IS NULL OR imsi_hash = '') AS empty, count(*) FILTER (event_time > TIMESTAMP '2024-01-20 00:05:00') AS future, count(*) FILTER (updated_at < created_at) AS unordered FROM all_traffic")
def rule_counts(f: Feeds) -> DataFrame:
    rules = {"out_of_range": quality.rule_range("jitter_ms", 0, 40), "alien": quality.rule_domain("protocol", quality.PROTOCOLS), "empty": quality.rule_not_empty("imsi_hash"), "future": quality.rule_future("event_time", HI), "unordered": quality.rule_order("created_at", "updated_at")}
    return f.all_traffic.agg(*(F.count_if(c).alias(n) for n, c in rules.items()))


@query("SELECT traffic_id, (latency_ms NOT BETWEEN 0 AND 5000 OR coalesce(jitter_ms NOT BETWEEN 0 AND 1000, true) OR packet_loss_pct NOT BETWEEN 0 AND 100) AS soft FROM all_traffic")
def strict_profile(f: Feeds) -> DataFrame:
    judged = quality.validate_traffic(f.all_traffic.select("traffic_id", "event_time", "latency_ms", "jitter_ms", "packet_loss_pct"), AS_OF, quality.STRICT)
    return judged.select("traffic_id", (~F.col("is_valid")).alias("soft"))


@query("SELECT traffic_id, CAST(event_time AS TIMESTAMP) - INTERVAL 7 HOUR AS event_time FROM fx_traffic")
def normalize_time(f: Feeds) -> DataFrame:
    return quality.normalize_time(f.traffic, "event_time", "Asia/Ho_Chi_Minh").select("traffic_id", "event_time")


@query("SELECT is_valid, count(*) AS n, min(traffic_id) AS low, max(traffic_id) AS high FROM judged_traffic GROUP BY 1")
def split_valid(f: Feeds) -> DataFrame:
    parts = quality.split_valid(f.judged_traffic())
    return parts[0].unionByName(parts[1]).groupBy("is_valid").agg(F.count("*").alias("n"), F.min("traffic_id").alias("low"), F.max("traffic_id").alias("high"))


@query("SELECT traffic_id, updated_at, quality_issues FROM staged_traffic WHERE NOT is_valid")
def split_quarantine(f: Feeds) -> DataFrame:
    return quality.split_quarantine(quality.split_valid(f.judged_traffic())[1])[0].select("traffic_id", "updated_at", "quality_issues")


@query("SELECT traffic_id, updated_at, data_quality FROM staged_traffic")
def union_staging(f: Feeds) -> DataFrame:
    return f.staged_traffic().select("traffic_id", "updated_at", "data_quality")


@query(f"SELECT traffic_id, coalesce(bytes_up, 0) + coalesce(bytes_down, 0) AS bytes_total, CAST(event_time AS DATE) AS event_date, date_trunc('hour', event_time) AS event_hour, latency_ms > 100 AS is_high_latency, TIMESTAMP '{AS_OF}' AS transformed_at FROM fx_traffic")
def derive_traffic(f: Feeds) -> DataFrame:
    return quality.derive_traffic(f.traffic, AS_OF).select("traffic_id", "bytes_total", "event_date", "event_hour", "is_high_latency", "transformed_at")


@query(f"SELECT metric_id, TIMESTAMP '{AS_OF}' AS transformed_at FROM fx_metrics")
def derive_stamp(f: Feeds) -> DataFrame:
    return f.metrics.select("metric_id", at(AS_OF).alias("transformed_at"))


@query("SELECT count(*) AS total_rows, count(*) FILTER (NOT is_valid) AS invalid_rows, count(*) FILTER (NOT is_valid) * 100.0::DOUBLE / greatest(count(*), 1) AS invalid_pct FROM judged_traffic", "invalid_pct")
def quality_summary(f: Feeds) -> DataFrame:
    return quality.quality_summary(f.judged_traffic())


@query("SELECT issue, count(*) AS n FROM (SELECT unnest(string_split(quality_issues, ',')) AS issue FROM judged_traffic WHERE quality_issues <> '') GROUP BY 1")
def validity_pct_by_issue(f: Feeds) -> DataFrame:
    return quality.issue_counts(f.judged_traffic())


@query("SELECT 'unknown_technology' AS warning, count(*) AS n FROM customer WHERE c_custkey % 7 = 0 UNION ALL SELECT 'duplicate_code', sum(n - 1)::BIGINT FROM (SELECT count(*) AS n FROM customer GROUP BY c_mktsegment)")
def check_dimension(f: Feeds) -> DataFrame:
    customers = f.spark.table("source_customer")
    return quality.check_dimension(customers.select(F.col("c_mktsegment").alias("station_code"), F.when(F.col("c_custkey") % 7 == 0, "6G").otherwise("5G").alias("technology")))


@query("SELECT 'negative_latency' AS warning, count(*) AS n FROM health WHERE avg_latency_ms - 200 < 0")
def check_health(f: Feeds) -> DataFrame:
    return quality.check_health(reports.health_hourly(f.tables()).withColumn("avg_latency_ms", F.col("avg_latency_ms") - 200))


@query("SELECT 'uptime_pct_out_of_range' AS warning, count(*) AS n FROM sla WHERE uptime_pct + 1 > 100")
def check_sla(f: Feeds) -> DataFrame:
    t, health = f.report_tables()
    return quality.check_sla(reports.sla_compliance(t, health).withColumn("uptime_pct", F.col("uptime_pct") + 1))


@query("SELECT warning, n FROM (SELECT 'z_cpu_extreme' AS warning, count(*) FILTER (abs(z_cpu) > 10) AS n FROM anomalies UNION ALL SELECT 'z_latency_extreme', count(*) FILTER (abs(z_latency) > 10) FROM anomalies UNION ALL SELECT 'z_throughput_extreme', count(*) FILTER (abs(z_throughput) > 10) FROM anomalies) WHERE n > 0")
def check_anomaly(f: Feeds) -> DataFrame:
    return quality.check_anomaly(reports.anomaly_features(reports.health_hourly(f.tables())))


@query("SELECT DISTINCT frequency_band AS value FROM fx_metrics WHERE frequency_band = 'Band-99'")
def distinct_values(f: Feeds) -> DataFrame:
    return quality.distinct_values(f.metrics, "frequency_band", quality.BANDS)


@query("SELECT DISTINCT severity AS value FROM fx_events WHERE severity = 'bogus'")
def unknown_values(f: Feeds) -> DataFrame:
    allowed = f.spark.createDataFrame([(s,) for s in quality.SEVERITIES], "value string")
    return f.events.select(F.col("severity").alias("value")).subtract(allowed)


@query("SELECT traffic_id, station_id, NULL::VARCHAR AS tmsi, NULL::BIGINT AS packets_up FROM fx_traffic")
def reconcile(f: Feeds) -> DataFrame:
    return contract.reconcile(f.traffic, contract.TRAFFIC).select("traffic_id", "station_id", "tmsi", "packets_up")


# Joins


@query("SELECT c_custkey AS station_id, c_mktsegment AS station_code, n_name AS operator_name, r_name AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON c_custkey % 6 = r_regionkey")
def dim_station(f: Feeds) -> DataFrame:
    stations = f.spark.table("source_customer").select(F.col("c_custkey").alias("station_id"), F.col("c_mktsegment").alias("station_code"), F.col("c_nationkey").alias("operator_id"), (F.col("c_custkey") % 6).alias("location_id"))
    operators = f.spark.table("source_nation").select(F.col("n_nationkey").alias("operator_id"), F.col("n_name").alias("operator_name"))
    locations = f.spark.table("source_region").select(F.col("r_regionkey").alias("location_id"), F.col("r_name").alias("region"))
    return joins.dim_station(stations, operators, locations).select("station_id", "station_code", "operator_name", "region")


@query("SELECT t.traffic_id, t.updated_at, s.region, CASE WHEN s.station_id IS NOT NULL THEN 'matched' ELSE 'station_missing' END AS dim_match_status FROM all_traffic t LEFT JOIN fx_station s ON t.station_id = s.station_id")
def enrich(f: Feeds) -> DataFrame:
    return joins.enrich(f.all_traffic, f.stations).select("traffic_id", "updated_at", "region", "dim_match_status")


@query(lookup("SELECT event_id, station_id FROM fx_events", "station_id", {"code": "station_code", "area": "region"}))
def station_lookup(f: Feeds) -> DataFrame:
    return joins.lookup(f.events.select("event_id", "station_id"), f.stations, {"code": "station_code", "area": "region"})


@query("SELECT t.station_id, t.n, m.cpu, e.alarms FROM (SELECT station_id, count(*) AS n FROM live_traffic GROUP BY 1) t LEFT JOIN (SELECT station_id, avg(cpu_usage_pct) AS cpu FROM live_metrics GROUP BY 1) m ON t.station_id = m.station_id LEFT JOIN (SELECT station_id, count(*) FILTER (event_type = 'alarm') AS alarms FROM live_events GROUP BY 1) e ON t.station_id = e.station_id", "cpu")
def join_preaggregated(f: Feeds) -> DataFrame:
    traffic = f.live_traffic().groupBy("station_id").agg(F.count("*").alias("n"))
    metrics = f.live_metrics().groupBy("station_id").agg(F.avg("cpu_usage_pct").alias("cpu"))
    events = f.live_events().groupBy("station_id").agg(F.count_if(F.col("event_type") == "alarm").alias("alarms"))
    return traffic.join(metrics, "station_id", "left").join(events, "station_id", "left")


PAIR = "station_id, report_date, start_id, started, ended"


@query(f"SELECT {PAIR} FROM incident_pairs")
def pair_by_rank(f: Feeds) -> DataFrame:
    return joins.pair_by_rank(f.live_events(), "incident_start", "incident_end").select(*PAIR.split(", "))


@query(f"SELECT {PAIR} FROM incident_next")
def pair_next_end(f: Feeds) -> DataFrame:
    return joins.pair_next_end(f.live_events(), "incident_start", "incident_end").select(*PAIR.split(", "))


@query("SELECT start_id, count(DISTINCT imsi_hash) AS subscribers, sum(bytes_up + bytes_down)::BIGINT AS bytes FROM incident_next i JOIN live_traffic t ON i.station_id = t.station_id AND t.event_time BETWEEN i.started AND coalesce(i.ended, TIMESTAMP '" + AS_OF + "') GROUP BY 1")
def interval_join(f: Feeds) -> DataFrame:
    pairs = joins.pair_next_end(f.live_events(), "incident_start", "incident_end")
    return joins.interval_join(pairs, f.live_traffic(), AS_OF).groupBy("start_id").agg(F.count_distinct("imsi_hash").alias("subscribers"), F.sum(F.col("bytes_up") + F.col("bytes_down")).alias("bytes"))


@query("SELECT start_id, count(*) AS hours, avg(health_score) AS score FROM incident_next i JOIN health h ON i.station_id = h.station_id AND h.hour_start BETWEEN date_trunc('hour', started) AND date_trunc('hour', coalesce(ended, TIMESTAMP '" + AS_OF + "')) GROUP BY 1", "score")
def hour_range_join(f: Feeds) -> DataFrame:
    pairs = joins.pair_next_end(f.live_events(), "incident_start", "incident_end").select("station_id", "start_id", "started", "ended")
    health = reports.health_hourly(f.tables()).select("station_id", "hour_start", "health_score")
    return joins.hour_range_join(pairs, health, AS_OF).groupBy("start_id").agg(F.count("*").alias("hours"), F.avg("health_score").alias("score"))


@query("SELECT e.event_id, b.n AS before, a.n AS after FROM live_events e LEFT JOIN events_n b ON e.station_id = b.station_id AND date_trunc('hour', e.event_time) - INTERVAL 1 HOUR = b.hour_start LEFT JOIN events_n a ON e.station_id = a.station_id AND date_trunc('hour', e.event_time) + INTERVAL 1 HOUR = a.hour_start".replace("events_n", "(SELECT station_id, date_trunc('hour', event_time) AS hour_start, count(*) AS n FROM live_events GROUP BY 1, 2)"))
def offset_join(f: Feeds) -> DataFrame:
    events = f.live_events()
    hourly = events.groupBy("station_id", hour_start("event_time").alias("hour_start")).agg(F.count("*").alias("n"))
    out = joins.offset_value(events, hourly, F.col("event_time"), -1, "n", "before")
    return joins.offset_value(out, hourly, F.col("event_time"), 1, "n", "after").select("event_id", "before", "after")


@query("SELECT e.event_id, v.n FROM live_events e LEFT JOIN (SELECT station_id, hour(event_time) AS h, count(*) AS n FROM live_traffic GROUP BY 1, 2) v ON e.station_id = v.station_id AND hour(e.event_time) = v.h")
def join_hour_of_day(f: Feeds) -> DataFrame:
    base = f.live_traffic().groupBy("station_id", F.hour("event_time").alias("h")).agg(F.count("*").alias("n"))
    return f.live_events().withColumn("h", F.hour("event_time")).join(base, ["station_id", "h"], "left").select("event_id", "n")


KEYS4 = ["region", "province", "operator_code", "technology"]


@query("SELECT a.*, coalesce(b.slow, 0) AS slow FROM (SELECT region, province, operator_code, technology, count(*) AS n FROM traffic_dim GROUP BY ALL) a LEFT JOIN (SELECT region, province, operator_code, technology, count(*) AS slow FROM traffic_dim WHERE latency_ms > 400 GROUP BY ALL) b ON a.region = b.region AND a.province = b.province AND a.operator_code = b.operator_code AND a.technology = b.technology")
def join_multi_key(f: Feeds) -> DataFrame:
    rows = located(f)
    slow = rows.where("latency_ms > 400").groupBy(*KEYS4).agg(F.count("*").alias("slow"))
    return rows.groupBy(*KEYS4).agg(F.count("*").alias("n")).join(slow, KEYS4, "left").withColumn("slow", F.coalesce("slow", F.lit(0)))


@query("SELECT e.station_id, e.target_station_id, e.n, s.latency AS at_source, g.latency AS at_target FROM (SELECT station_id, target_station_id, count(*) AS n FROM live_events WHERE event_type = 'handover' GROUP BY 1, 2) e LEFT JOIN l s ON e.station_id = s.station_id LEFT JOIN l g ON e.target_station_id = g.station_id".replace(" l ", " (SELECT station_id, avg(latency_ms) AS latency FROM live_traffic GROUP BY 1) "), "at_source at_target")
def two_role_join(f: Feeds) -> DataFrame:
    latency = f.live_traffic().groupBy("station_id").agg(F.avg("latency_ms").alias("latency"))
    edges = f.live_events().where("event_type = 'handover'").groupBy("station_id", "target_station_id").agg(F.count("*").alias("n"))
    return edges.join(latency.withColumnRenamed("latency", "at_source"), "station_id", "left").join(latency.select(F.col("station_id").alias("target_station_id"), F.col("latency").alias("at_target")), "target_station_id", "left")


@query("SELECT c.station_id, c.n, b.n AS base FROM (SELECT station_id, count(*) AS n FROM live_traffic WHERE event_time >= TIMESTAMP '2024-01-15' GROUP BY 1) c LEFT JOIN (SELECT station_id, count(*) AS n FROM live_traffic WHERE event_time < TIMESTAMP '2024-01-15' GROUP BY 1) b ON c.station_id = b.station_id")
def baseline_join(f: Feeds) -> DataFrame:
    rows = f.live_traffic()
    late = F.col("event_time") >= at("2024-01-15 00:00:00")
    count = lambda df, name: df.groupBy("station_id").agg(F.count("*").alias(name))
    return count(rows.where(late), "n").join(count(rows.where(~late), "base"), "station_id", "left")


# Aggregates


def located(f: Feeds) -> DataFrame:
    return joins.lookup(f.live_traffic(), f.stations, {a: a for a in reports.STATION_ATTRS})


@query("SELECT station_id, count(*) AS n, count(*) FILTER (latency_ms > 100) AS slow, sum(bytes_up + bytes_down)::BIGINT AS bytes, avg(latency_ms) AS mean, min(latency_ms) AS low, max(latency_ms) AS high, sum(latency_ms) FILTER (protocol = 'UDP') AS udp_sum, max(latency_ms) FILTER (protocol = 'UDP') AS udp_max, avg(latency_ms) FILTER (protocol = 'UDP') AS udp_mean, bool_or(protocol = 'ICMP') AS any_icmp, count(DISTINCT imsi_hash) AS subs, count(DISTINCT CASE WHEN latency_ms > 400 THEN imsi_hash END) AS slow_subs, quantile_cont(latency_ms, 0.95) AS p95, stddev_pop(latency_ms) AS dev, count(*) FILTER (latency_ms > 100) / count(*) AS slow_share, quantile_cont(latency_ms, 0.99) AS p99 FROM live_traffic GROUP BY 1", "mean low high udp_sum udp_max udp_mean p95 dev slow_share p99")
def station_aggregates(f: Feeds) -> DataFrame:
    udp = F.when(F.col("protocol") == "UDP", F.col("latency_ms"))
    slow = F.count_if(F.col("latency_ms") > 100)
    return f.live_traffic().groupBy("station_id").agg(
        F.count("*").alias("n"), slow.alias("slow"), F.sum(F.col("bytes_up") + F.col("bytes_down")).alias("bytes"),
        F.avg("latency_ms").alias("mean"), F.min("latency_ms").alias("low"), F.max("latency_ms").alias("high"),
        F.sum(udp).alias("udp_sum"), F.max(udp).alias("udp_max"), F.avg(udp).alias("udp_mean"), F.bool_or(F.col("protocol") == "ICMP").alias("any_icmp"),
        F.count_distinct("imsi_hash").alias("subs"), F.count_distinct(F.when(F.col("latency_ms") > 400, F.col("imsi_hash"))).alias("slow_subs"),
        F.percentile("latency_ms", 0.95).alias("p95"), F.stddev_pop("latency_ms").alias("dev"), (slow / F.count("*")).alias("slow_share"), F.percentile("latency_ms", 0.99).alias("p99"),
    )


@query("SELECT station_id, arg_max(json_extract_string(metadata, '$.incident_type'), (event_time, event_id)) FILTER (event_type = 'incident_start') AS incident_type FROM live_events GROUP BY 1")
def agg_argmax_if(f: Feeds) -> DataFrame:
    return f.live_events().groupBy("station_id").agg(F.max_by(F.get_json_object("metadata", "$.incident_type"), F.when(F.col("event_type") == "incident_start", F.struct("event_time", "event_id"))).alias("incident_type"))


TOP = "SELECT station_id, description AS top_alarm_description FROM (SELECT station_id, description, row_number() OVER (PARTITION BY station_id ORDER BY count(*) DESC, description) AS nth FROM live_events WHERE event_type = 'alarm' GROUP BY 1, 2) WHERE nth = 1"


@query(TOP)
def agg_top1(f: Feeds) -> DataFrame:
    return rollup.top_value(f.live_events().where("event_type = 'alarm'"), ["station_id"], "description", "top_alarm_description")


@query("SELECT (epoch_us(updated_at) // 3600000000) AS batch, max((epoch_us(updated_at) - epoch_us(created_at)) / 1e6) AS max_propagation_s, quantile_cont((epoch_us(updated_at) - epoch_us(created_at)) / 1e6, 0.99) AS p99_propagation_s, max((epoch_us(created_at) - epoch_us(event_time)) / 1e6) AS max_offset_s, quantile_cont((epoch_us(created_at) - epoch_us(event_time)) / 1e6, 0.99) AS p99_offset_s, count(*) FILTER ((epoch_us(created_at) - epoch_us(event_time)) / 1e6 > 240) AS late_rows, count(*) FILTER ((epoch_us(updated_at) - epoch_us(created_at)) / 1e6 > 1) AS updated_rows, max(updated_at) AS max_updated_at FROM all_traffic GROUP BY 1", "max_propagation_s p99_propagation_s max_offset_s p99_offset_s")
def delay_metrics(f: Feeds) -> DataFrame:
    batch = F.floor(F.unix_micros(F.col("updated_at").cast("timestamp")) / 3_600_000_000).alias("batch")
    return rollup.delay_metrics(f.all_traffic, "event_time", keys=(batch,))


@query("SELECT technology, hour(event_time) AS hour, count(*) AS n FROM traffic_dim GROUP BY 1, 2")
def group_by_derived(f: Feeds) -> DataFrame:
    return located(f).groupBy("technology", F.hour("event_time").cast("bigint").alias("hour")).agg(F.count("*").alias("n"))


@query("SELECT station_id, target_station_id, count(*) AS n FROM live_events WHERE event_type = 'handover' GROUP BY 1, 2")
def sum_merge(f: Feeds) -> DataFrame:
    hourly = f.live_events().where("event_type = 'handover'").groupBy("station_id", "target_station_id", F.hour("event_time")).agg(F.count("*").alias("n"))
    return rollup.sum_merge(hourly, ["station_id", "target_station_id"], ["n"])


@query("SELECT DISTINCT year(event_time) AS year, month(event_time) AS month, day(event_time) AS day, hour(event_time) AS hour FROM all_traffic")
def hour_signal(f: Feeds) -> DataFrame:
    return manifest.hour_signal(f.all_traffic, "event_time").select(*(F.col(c).cast("bigint") for c in ("year", "month", "day", "hour")))


# Windows, versions, order


@query("SELECT event_id, row_number() OVER (PARTITION BY station_id, event_type ORDER BY event_time, event_id) AS nth FROM fx_events")
def rank_events(f: Feeds) -> DataFrame:
    return joins.rank_events(f.events, ("station_id", "event_type")).select("event_id", F.col("nth").cast("bigint"))


@query("SELECT traffic_id, updated_at, is_deleted FROM (SELECT *, row_number() OVER (PARTITION BY station_id, event_time, traffic_id ORDER BY updated_at DESC) AS nth FROM all_traffic) WHERE nth = 1")
def latest_version(f: Feeds) -> DataFrame:
    return versions.latest_version(f.all_traffic, ["station_id", "event_time", "traffic_id"]).select("traffic_id", "updated_at", "is_deleted")


@query("SELECT traffic_id, updated_at FROM (SELECT *, row_number() OVER (PARTITION BY station_id, event_time, traffic_id ORDER BY updated_at DESC) AS nth FROM all_traffic) WHERE nth = 1 AND NOT is_deleted")
def live_rows(f: Feeds) -> DataFrame:
    return versions.live_rows(versions.latest_version(f.all_traffic, ["station_id", "event_time", "traffic_id"])).select("traffic_id", "updated_at")


BASED = [f"{n}_{s}" for n in reports.ANOMALY_MEASURES for s in ("mean", "std")]


@query(f"SELECT station_id, hour_start, {', '.join(BASED)} FROM based", " ".join(BASED))
def rolling_baseline(f: Feeds) -> DataFrame:
    health = reports.health_hourly(f.tables())
    return reports.rolling_baseline(health, {n: c for n, (c, _) in reports.ANOMALY_MEASURES.items()}).select("station_id", "hour_start", *BASED)


@query("SELECT station_id, report_date, hour_of_day, avg_hourly_bytes FROM baseline", "avg_hourly_bytes")
def hour_of_day_volume(f: Feeds) -> DataFrame:
    starts = f.live_events().where("event_type = 'incident_start'").select(F.to_date("event_time").alias("report_date"))
    return reports.hour_of_day_volume(f.live_traffic(), starts).select("station_id", "report_date", F.col("hour_of_day").cast("bigint"), "avg_hourly_bytes")


CONFIG = "SELECT user_id, event_type, ts AS effective_from, max(value) AS setting FROM events GROUP BY 1, 2, 3"


def config_log(f: Feeds) -> DataFrame:
    return f.spark.table("source_events").groupBy("user_id", "event_type", F.col("ts").alias("effective_from")).agg(F.max("value").alias("setting"))


ORACLE_HISTORY = f"SELECT *, lead(effective_from) OVER w AS effective_to, lead(effective_from) OVER w IS NULL AS is_current FROM ({CONFIG}) WINDOW w AS (PARTITION BY user_id, event_type ORDER BY effective_from)"


@query(ORACLE_HISTORY, "setting")
def scd2_as_history(f: Feeds) -> DataFrame:
    return versions.scd2_history(config_log(f), ["user_id", "event_type"], "effective_from")


@query(ORACLE_HISTORY, "setting")
def scd2_apply(f: Feeds) -> DataFrame:
    """The whole log but each key's newest change as history, which that change then closes."""
    keys = ["user_id", "event_type"]
    newest = config_log(f).groupBy(*keys).agg(F.max(F.struct("effective_from", "setting")).alias("c")).select(*keys, "c.*")
    older = config_log(f).join(newest.select(*keys, "effective_from"), [*keys, "effective_from"], "left_anti")
    return versions.scd2_apply(versions.scd2_history(older, keys, "effective_from"), newest, keys)


@query("SELECT traffic_id, updated_at, bytes_up, is_deleted FROM (SELECT *, row_number() OVER (PARTITION BY traffic_id ORDER BY updated_at DESC) AS nth FROM all_traffic) WHERE nth = 1")
def apply_corrections(f: Feeds) -> DataFrame:
    return versions.apply_corrections(f.traffic, f.changes, ["traffic_id"]).select("traffic_id", "updated_at", "bytes_up", "is_deleted")


def _merged(*own: str) -> str:
    """SQL of the merged text: the patch beside the event's own keys (SQL of ``"key":value``), in the order of keys."""
    parts = sorted([*own, """'"root_cause":"' || description || '"'""", """'"severity":0.9'"""])
    return "'{' || " + " || ',' || ".join(parts) + " || '}'"


FIELD = lambda key, quote="": f"""'"{key}":{quote}' || json_extract_string(metadata, '$.{key}') || '{quote}'"""
PATCHED = f"""CASE event_type WHEN 'incident_start' THEN {_merged(FIELD("estimated_duration_min"), FIELD("incident_type", '"'))} WHEN 'handover' THEN {_merged(FIELD("imsi_hash", '"'))}
 WHEN 'maintenance_start' THEN {_merged(FIELD("duration_min"), FIELD("sla_excluded"), FIELD("upgrade"))} WHEN 'maintenance_end' THEN {_merged(FIELD("duration_min"), FIELD("sla_excluded"), FIELD("upgrade"))} ELSE {_merged()} END"""


@query(f"SELECT event_id, {PATCHED} AS metadata FROM fx_events")
def merge_json(f: Feeds) -> DataFrame:
    patch = F.concat(F.lit('{"root_cause":"'), F.col("description"), F.lit('","severity":0.9}'))
    return f.events.select("event_id", versions.merge_json(F.col("metadata"), patch).alias("metadata"))


@query("SELECT traffic_id, is_deleted OR coalesce(imsi_hash IN (SELECT imsi_hash FROM fx_traffic WHERE traffic_id % 500 = 7), false) AS is_deleted FROM fx_traffic")
def apply_tombstones(f: Feeds) -> DataFrame:
    erased = f.traffic.where("traffic_id % 500 = 7").select("imsi_hash")
    return versions.apply_tombstones(f.traffic, erased, "imsi_hash").select("traffic_id", "is_deleted")


@query("SELECT event_id, first_id, nth FROM (SELECT event_id, min(event_id) OVER (PARTITION BY station_id, event_type, CAST(event_time AS DATE), description) AS first_id, row_number() OVER (PARTITION BY station_id, event_type, CAST(event_time AS DATE), description ORDER BY event_id) AS nth FROM fx_events) WHERE nth > 1")
def find_duplicates(f: Feeds) -> DataFrame:
    rows = f.events.withColumn("day", F.to_date("event_time"))
    return versions.find_duplicates(rows, ["station_id", "event_type", "day", "description"], "event_id").select("event_id", "first_id", F.col("nth").cast("bigint"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 10 = 1 THEN 'added' WHEN c_custkey % 10 = 2 THEN 'removed' ELSE 'changed' END AS change FROM customer WHERE c_custkey % 10 IN (1, 2, 3)")
def changed_rows(f: Feeds) -> DataFrame:
    return versions.changed_rows(*renamed(f), "c_custkey")


def renamed(f: Feeds) -> tuple[DataFrame, DataFrame]:
    """A new and an old customer dimension: some rows are added, some removed, some renamed."""
    rows = f.spark.table("source_customer").select("c_custkey", "c_name", "c_mktsegment")
    new = rows.where("c_custkey % 10 <> 2").withColumn("c_name", F.when(F.col("c_custkey") % 10 == 3, F.lit("renamed")).otherwise(F.col("c_name")))
    return new, rows.where("c_custkey % 10 <> 1")


@query(f"SELECT c_custkey, CASE WHEN c_custkey % 10 = 3 THEN 'renamed' ELSE c_name END AS c_name, c_mktsegment, CASE WHEN c_custkey % 10 IN (1, 3) THEN TIMESTAMP '{AS_OF}' ELSE TIMESTAMP '{LO}' END AS updated_at FROM customer WHERE c_custkey % 10 <> 2")
def load_dim(f: Feeds) -> DataFrame:
    new, old = renamed(f)
    return versions.load_dim(new, old.withColumn("updated_at", at(LO)), "c_custkey", at(AS_OF))


@query("SELECT traffic_id, imsi_hash FROM fx_traffic WHERE NOT coalesce(imsi_hash IN (SELECT imsi_hash FROM fx_traffic WHERE traffic_id % 500 = 7), false)")
def purge(f: Feeds) -> DataFrame:
    return versions.purge(f.traffic, f.traffic.where("traffic_id % 500 = 7").select("imsi_hash"), "imsi_hash").select("traffic_id", "imsi_hash")


# Contracts


@query("SELECT traffic_id, station_id::BIGINT AS station_id, event_time, updated_at, imsi_hash, bytes_up::BIGINT AS bytes_up, latency_ms, connection_duration_ms::BIGINT AS connection_duration_ms, is_deleted, (bytes_down / 1)::DECIMAL(38,2) AS charge FROM fx_traffic")
def normalize_types(f: Feeds) -> DataFrame:
    """The feed as text under its contract, and a decimal that the contract doesn't name."""
    names = ("traffic_id", "station_id", "event_time", "updated_at", "imsi_hash", "bytes_up", "latency_ms", "connection_duration_ms", "is_deleted")
    text = f.traffic.select(*(F.col(c).cast("string").alias(c) for c in names), F.col("bytes_down").cast("decimal(12,2)").alias("charge"))
    return contract.normalize_types(text, contract.TRAFFIC)


@query("""SELECT event_id, concat('{"station_id":', station_id, ',"severity":"', severity, '"}') AS detail, concat('["', event_type, '","', description, '"]') AS words FROM fx_events""")
def serialize_json(f: Feeds) -> DataFrame:
    rows = f.events.select("event_id", F.struct("station_id", "severity").alias("detail"), F.array("event_type", "description").alias("words"))
    return lake.serialize_json(rows, ["detail", "words"])


DRIFT = [("new", "surprise", False), ("missing_required", "station_id", True), ("missing_expected", "protocol", False), *(("missing_passthrough", c, False) for c in ("tmsi", "ip_address", "destination_ip", "destination_port", "packets_up", "packets_down"))]


@query("SELECT kind, column_name, is_breaking, (SELECT count(*) FROM fx_traffic) AS n_rows FROM (VALUES " + ", ".join(f"('{k}', '{c}', {str(x).lower()})" for k, c, x in DRIFT) + ") AS v(kind, column_name, is_breaking)")
def detect_drift(f: Feeds) -> DataFrame:
    """Traffic with a column added and two dropped, and how many rows it has."""
    odd = f.traffic.drop("station_id", "protocol").withColumn("surprise", F.col("bytes_up"))
    return contract.drift_rows(odd, contract.TRAFFIC).join(F.broadcast(odd.agg(F.count("*").alias("n_rows"))))  # one row


ACCESSED = [("event_id", "required", "bigint", False), ("station_id", "required", "bigint", False), ("event_time", "required", "timestamp_ntz", False), ("updated_at", "required", "timestamp_ntz", False), ("created_at", "expected", "timestamp_ntz", False), ("event_type", "expected", "string", False), ("severity", "expected", "string", False), ("description", "passthrough", "string", False), ("metadata", "passthrough", "string", False), ("target_station_id", "passthrough", "bigint", False), ("is_deleted", "passthrough", "boolean", False)]


@query(" UNION ALL ".join(f"SELECT '{n}' AS column_name, '{c}' AS category, '{k}' AS type, {str(s).lower()} AS is_soft, count({n}) AS n_values FROM fx_events" for n, c, k, s in ACCESSED))
def contract_columns(f: Feeds) -> DataFrame:
    return contract.profile_columns(f.events, contract.EVENTS)


# Manifest


def batches(f: Feeds) -> DataFrame:
    rows = f.all_traffic.withColumn("batch", F.floor(F.unix_seconds(F.col("updated_at").cast("timestamp")) / HOUR_SECONDS))
    return manifest.batch_manifest(rows, "batch", "event_time")


def flagged(f: Feeds) -> DataFrame:
    return batches(f).withColumn("is_loaded", F.col("batch_id") % 3 != 0)


@query("SELECT batch_id, record_count, array_to_string(data_keys, ',') AS data_keys, from_time, to_time FROM manifest")
def batch_manifest(f: Feeds) -> DataFrame:
    return batches(f).select("batch_id", "record_count", F.array_join("data_keys", ",").alias("data_keys"), "source_watermark.from_time", "source_watermark.to_time")


@query("SELECT batch_id FROM (SELECT * FROM manifest ORDER BY batch_id DESC LIMIT 720) WHERE NOT is_loaded")
def find_unprocessed(f: Feeds) -> DataFrame:
    return manifest.find_unprocessed(flagged(f), "is_loaded", 720).select("batch_id")


@query("SELECT batch_id, is_loaded OR batch_id % 2 = 0 AS is_loaded FROM manifest")
def mark_loaded(f: Feeds) -> DataFrame:
    rows = flagged(f)
    return manifest.mark_loaded(rows, rows.where("batch_id % 2 = 0")).select("batch_id", "is_loaded")


@query("SELECT batch_id, is_loaded AND batch_id % 2 <> 0 AS is_loaded FROM manifest")
def unmark(f: Feeds) -> DataFrame:
    rows = flagged(f)
    return manifest.unmark(rows, rows.where("batch_id % 2 = 0")).select("batch_id", "is_loaded")


KEY_HOUR = "strptime(key, 'year=%Y/month=%m/day=%d/hour=%H')"


@query(f"SELECT count(DISTINCT batch_id) AS batches, min({KEY_HOUR}) AS first_hour, max({KEY_HOUR}) AS last_hour, (SELECT string_agg(key, ',' ORDER BY key) FROM (SELECT DISTINCT unnest(data_keys) AS key FROM (SELECT * FROM manifest ORDER BY batch_id DESC LIMIT 720) WHERE NOT is_loaded ORDER BY 1 LIMIT 5)) AS sample_keys FROM (SELECT batch_id, unnest(data_keys) AS key FROM (SELECT * FROM manifest ORDER BY batch_id DESC LIMIT 720) WHERE NOT is_loaded)")
def affected_summary(f: Feeds) -> DataFrame:
    return manifest.affected_summary(flagged(f), "is_loaded")


@query("SELECT h AS hour_start, CAST(h AS DATE) AS day FROM (SELECT date_trunc('hour', max(event_time)) - to_hours(48) + to_hours(i) AS h FROM fx_traffic, (SELECT unnest(range(48)) AS i) GROUP BY i)")
def recovery_periods(f: Feeds) -> DataFrame:
    return manifest.recovery_periods(f.traffic, "event_time", 48)


@query("SELECT batch_id FROM manifest WHERE batch_id % 3 = 0")
def unprocessed_anti(f: Feeds) -> DataFrame:
    rows = flagged(f).select("batch_id", "is_loaded")
    return manifest.unprocessed_anti(rows, rows.where("is_loaded")).select("batch_id")


@query("SELECT report, grain, period FROM (SELECT h AS period, CAST(h AS DATE) AS day FROM (SELECT date_trunc('hour', max(event_time)) - to_hours(48) + to_hours(i) AS h FROM fx_traffic, (SELECT unnest(range(48)) AS i) GROUP BY i)) JOIN (SELECT 'health' AS report, 'hour' AS grain) ON true UNION ALL SELECT DISTINCT report, grain, CAST(CAST(h AS DATE) AS TIMESTAMP) FROM (SELECT date_trunc('hour', max(event_time)) - to_hours(48) + to_hours(i) AS h FROM fx_traffic, (SELECT unnest(range(48)) AS i) GROUP BY i) JOIN (SELECT unnest(['alarm', 'sla']) AS report, 'day' AS grain) ON true")
def report_period_cross(f: Feeds) -> DataFrame:
    return manifest.report_periods({"health": "hour", "sla": "day", "alarm": "day"}, manifest.recovery_periods(f.traffic, "event_time", 48)).select("report", "grain", "period")


@query("SELECT date_trunc('hour', event_time) AS hour FROM fx_traffic INTERSECT SELECT date_trunc('hour', metric_time) FROM fx_metrics INTERSECT SELECT date_trunc('hour', event_time) FROM fx_events WHERE event_type = 'alarm'")
def ready_hours(f: Feeds) -> DataFrame:
    hours = lambda df, c: df.select(hour_start(c).alias("hour"))
    return manifest.ready_hours(hours(f.traffic, "event_time"), hours(f.metrics, "metric_time"), hours(f.events.where("event_type = 'alarm'"), "event_time"))


@query("SELECT CAST(event_time AS DATE) AS day, bool_or(hour(event_time) = 23) AS is_closed, count(DISTINCT hour(event_time)) AS hours FROM fx_events WHERE event_type = 'incident_end' GROUP BY 1")
def affected_days(f: Feeds) -> DataFrame:
    return manifest.affected_days(manifest.hour_signal(f.events.where("event_type = 'incident_end'"), "event_time"))


@query("SELECT batch_id FROM manifest ORDER BY batch_id DESC LIMIT 20")
def last_n(f: Feeds) -> DataFrame:
    return manifest.last_n_rows(batches(f).select("batch_id"), "batch_id", 20)


@query("SELECT batch_id FROM manifest ORDER BY batch_id LIMIT 5")
def sample_first(f: Feeds) -> DataFrame:
    return manifest.sample_first(batches(f).select("batch_id"), "batch_id", 5)


# Rollups and reports

HOURLY = "total_bytes session_count unique_subs"


@query("SELECT date_trunc('hour', event_time) AS event_hour, station_code, operator_code, region, province, density_class, technology, sum(bytes_up + bytes_down)::BIGINT AS total_bytes, count(*) AS session_count, count(DISTINCT imsi_hash) AS unique_subs, avg(latency_ms) AS avg_latency, quantile_cont(latency_ms, 0.95) AS p95_latency, avg(packet_loss_pct) AS avg_packet_loss, avg(jitter_ms) AS avg_jitter FROM traffic_dim GROUP BY ALL", "avg_latency p95_latency avg_packet_loss avg_jitter")
def traffic_hourly(f: Feeds) -> DataFrame:
    return rollup.traffic_hourly(located(f))


@query("SELECT CAST(event_time AS DATE) AS event_date, station_code, operator_code, region, province, density_class, technology, sum(bytes_up + bytes_down)::BIGINT AS total_bytes, count(*) AS session_count, count(DISTINCT imsi_hash) AS unique_subs, avg(latency_ms) AS avg_latency, quantile_cont(latency_ms, 0.95) AS p95_latency, avg(packet_loss_pct) AS avg_packet_loss FROM traffic_dim GROUP BY ALL", "avg_latency p95_latency avg_packet_loss")
def traffic_daily(f: Feeds) -> DataFrame:
    return rollup.traffic_daily(located(f))


@query("SELECT CAST(event_time AS DATE) AS event_date, operator_code, region, sum(bytes_up + bytes_down)::BIGINT AS total_bytes, count(*) AS session_count, count(DISTINCT imsi_hash) AS unique_subs, count(DISTINCT station_code) AS active_stations, avg(latency_ms) AS avg_latency FROM traffic_dim GROUP BY ALL", "avg_latency")
def operator_daily(f: Feeds) -> DataFrame:
    return rollup.operator_daily(located(f))


HEALTH_DOUBLES = "avg_latency_ms p95_latency_ms avg_packet_loss_pct high_latency_ratio avg_cpu_pct max_cpu_pct avg_memory_pct avg_temperature_celsius max_temperature_celsius avg_uplink_throughput_mbps avg_downlink_throughput_mbps health_score"


@query("SELECT * FROM health", HEALTH_DOUBLES)
def health_hourly(f: Feeds) -> DataFrame:
    return reports.health_hourly(f.tables())


@query("SELECT station_id, hour_start, health_score, health_category FROM health", "health_score")
def health_score(f: Feeds) -> DataFrame:
    return reports.health_hourly(f.tables()).select("station_id", "hour_start", "health_score", "health_category")


@query("SELECT CAST(hour_start AS DATE) AS report_date, station_id, operator_code, region, density_class, avg(health_score) AS avg_health_score, min(health_score) AS min_health_score, max(health_score) AS max_health_score, count(*) FILTER (health_category = 'critical') AS hours_critical, count(*) FILTER (health_category IN ('degraded', 'critical')) AS hours_degraded FROM health WHERE health_score IS NOT NULL GROUP BY ALL", "avg_health_score min_health_score max_health_score")
def health_daily(f: Feeds) -> DataFrame:
    return reports.health_daily(reports.health_hourly(f.tables()))


@query("SELECT * FROM sla", "avg_health_score min_health_score uptime_pct sla_target_pct sla_breach_hours total_incident_min longest_incident_min mttr_min")
def sla_compliance(f: Feeds) -> DataFrame:
    t, health = f.report_tables()
    return reports.sla_compliance(t, health)


@query("SELECT * FROM anomalies", "current_latency_ms baseline_latency_mean baseline_latency_std z_latency current_cpu_pct baseline_cpu_mean baseline_cpu_std z_cpu current_throughput baseline_throughput_mean baseline_throughput_std z_throughput current_subscribers baseline_subscribers_mean baseline_subscribers_std z_subscribers current_packet_loss")
def anomaly_features(f: Feeds) -> DataFrame:
    return reports.anomaly_features(reports.health_hourly(f.tables()))


OUTAGE_DOUBLES = "severity duration_min estimated_duration_min traffic_loss_bytes hardware_quality health_score_during"


@query(outage("incident_pairs"), OUTAGE_DOUBLES)
def outage_report(f: Feeds) -> DataFrame:
    t, health = f.outage_tables()
    return reports.outage_report(t, health, AS_OF)


@query(outage("incident_next"), OUTAGE_DOUBLES)
def outage_report_next_end(f: Feeds) -> DataFrame:
    t, health = f.outage_tables()
    return reports.outage_report(t, health, AS_OF, joins.pair_next_end)


@query("SELECT a.*, CASE WHEN k.stations > 0 THEN (k.stations - coalesce(k.breaches, 0)) * 100.0::DOUBLE / k.stations ELSE 100.0::DOUBLE END AS sla_compliance_pct, coalesce(k.breaches, 0) AS sla_breach_count FROM (SELECT CAST(hour_start AS DATE) AS report_date, region, province, operator_code, technology, count(DISTINCT station_id) AS station_count, count(DISTINCT CASE WHEN session_count > 0 THEN station_id END) AS active_station_count, sum(unique_subscribers)::BIGINT AS total_subscribers, sum(session_count)::BIGINT AS total_sessions, sum(total_bytes)::BIGINT AS total_bytes, avg(health_score) AS avg_health_score, min(health_score) AS min_health_score, count(DISTINCT CASE WHEN health_score < 30 THEN station_id END) AS stations_critical, count(DISTINCT CASE WHEN health_score >= 30 AND health_score < 60 THEN station_id END) AS stations_degraded, avg(avg_latency_ms) AS avg_latency_ms, quantile_cont(p95_latency_ms, 0.95) AS p95_latency_ms, avg(avg_packet_loss_pct) AS avg_packet_loss_pct, count(*) FILTER (incident_active = 1) AS incident_count FROM health GROUP BY ALL) a LEFT JOIN (SELECT report_date, region, province, operator_code, technology, count(*) AS stations, count(*) FILTER (sla_met = 0) AS breaches FROM sla GROUP BY ALL) k ON a.report_date = k.report_date AND a.region = k.region AND a.province = k.province AND a.operator_code = k.operator_code AND a.technology = k.technology", "avg_health_score min_health_score avg_latency_ms p95_latency_ms avg_packet_loss_pct sla_compliance_pct")
def region_daily(f: Feeds) -> DataFrame:
    t, health = f.report_tables()
    return reports.region_daily(health, reports.sla_compliance(t, health))


ATTRS4 = {a: a for a in ("station_code", "operator_code", "region", "technology")}
PLANNED = "coalesce(TRY_CAST(json_extract_string(start_meta, '$.planned_duration_min') AS DOUBLE), TRY_CAST(json_extract_string(start_meta, '$.duration_min') AS DOUBLE))::BIGINT"
STOP = f"coalesce(ended, TIMESTAMP '{AS_OF}')"
ACTUAL = MINUTES.format("started", STOP)


@query(lookup(f"SELECT p.station_id, report_date, start_id, started AS maintenance_start, ended AS maintenance_end, {PLANNED} AS planned_duration_min, {ACTUAL} AS actual_duration_min, {ACTUAL} - {PLANNED} AS overrun_min, coalesce(TRY_CAST(json_extract_string(start_meta, '$.tech_upgrade') AS BOOLEAN), TRY_CAST(json_extract_string(start_meta, '$.upgrade') AS BOOLEAN)) AS tech_upgrade, TRY_CAST(json_extract_string(start_meta, '$.sla_excluded') AS BOOLEAN) AS sla_excluded, b.health_score AS pre_maintenance_health, a.health_score AS post_maintenance_health FROM maintenance_pairs p LEFT JOIN health b ON p.station_id = b.station_id AND b.hour_start = date_trunc('hour', started) - INTERVAL 1 HOUR LEFT JOIN health a ON p.station_id = a.station_id AND a.hour_start = date_trunc('hour', {STOP}) + INTERVAL 1 HOUR", "station_id", ATTRS4), "pre_maintenance_health post_maintenance_health")
def maintenance_report(f: Feeds) -> DataFrame:
    t, health = f.report_tables()
    return reports.maintenance_report(t, health, AS_OF)


LATENCY = "(SELECT station_id, CAST(event_time AS DATE) AS report_date, avg(latency_ms) AS latency FROM live_traffic GROUP BY 1, 2)"


@query(lookup(lookup(f"SELECT h.*, s.latency AS avg_latency_before_ms, g.latency AS avg_latency_after_ms FROM (SELECT CAST(event_time AS DATE) AS report_date, station_id AS source_station_id, target_station_id, count(*) AS handover_count, count(DISTINCT json_extract_string(metadata, '$.imsi_hash')) AS unique_subscribers FROM live_events WHERE event_type = 'handover' AND coalesce(target_station_id, 0) <> 0 GROUP BY 1, 2, 3) h LEFT JOIN {LATENCY} s ON h.source_station_id = s.station_id AND h.report_date = s.report_date LEFT JOIN {LATENCY} g ON h.target_station_id = g.station_id AND h.report_date = g.report_date", "source_station_id", {"source_station_code": "station_code", "source_region": "region"}), "target_station_id", {"target_station_code": "station_code", "target_region": "region"}), "avg_latency_before_ms avg_latency_after_ms")
def handover_daily(f: Feeds) -> DataFrame:
    return reports.handover_daily(f.tables())


@query(lookup("SELECT a.report_date, a.station_id, a.warning_count, a.error_count, a.critical_count, a.total_alarm_count, t.description AS top_alarm_description, h.health_score_avg, CASE WHEN coalesce(h.active_hours, 0) > 0 THEN a.total_alarm_count / h.active_hours ELSE a.total_alarm_count::DOUBLE END AS alarm_rate_per_hour FROM (SELECT CAST(event_time AS DATE) AS report_date, station_id, count(*) FILTER (severity = 'warning') AS warning_count, count(*) FILTER (severity = 'error') AS error_count, count(*) FILTER (severity = 'critical') AS critical_count, count(*) AS total_alarm_count FROM live_events WHERE event_type = 'alarm' GROUP BY 1, 2) a LEFT JOIN (SELECT CAST(event_time AS DATE) AS report_date, station_id, description, row_number() OVER (PARTITION BY CAST(event_time AS DATE), station_id ORDER BY count(*) DESC, description) AS nth FROM live_events WHERE event_type = 'alarm' GROUP BY 1, 2, 3) t ON a.report_date = t.report_date AND a.station_id = t.station_id AND t.nth = 1 LEFT JOIN (SELECT CAST(hour_start AS DATE) AS report_date, station_id, count(*) FILTER (health_category <> 'maintenance') AS active_hours, avg(health_score) AS health_score_avg FROM health GROUP BY 1, 2) h ON a.report_date = h.report_date AND a.station_id = h.station_id", "station_id", ATTRS4), "health_score_avg alarm_rate_per_hour")
def alarm_daily(f: Feeds) -> DataFrame:
    t, health = f.report_tables()
    return reports.alarm_daily(t, health)


# Exact merging: subscribers of days from bitmaps of hours


@query("SELECT CAST(event_time AS DATE) AS event_date, operator_code, region, count(DISTINCT imsi_hash) AS unique_subs FROM traffic_dim GROUP BY ALL")
def agg_distinct_merge(f: Feeds) -> DataFrame:
    """Hourly states of stations in two batches, the second with subscribers that the first one's dictionary lacks, merged to days of operators."""
    rows = staged(located(f).select("traffic_id", "station_id", "imsi_hash", hour_start("event_time").alias("event_hour"), "operator_code", "region"))
    first, second = rows.where("traffic_id % 2 = 0"), rows.where("traffic_id % 2 = 1")
    codes = distinct.dictionary(first, "imsi_hash", "station_id")
    states, keys = [], ["event_hour", "station_id", "operator_code", "region"]
    for part in (first, second):
        codes = distinct.extended(codes, part, "imsi_hash", "station_id")
        states.append(distinct.distinct_state(part, codes, "imsi_hash", keys))
    days = states[0].unionByName(states[1]).withColumn("event_date", F.to_date("event_hour"))
    by = ["event_date", "operator_code", "region"]
    return distinct.finish_distinct(distinct.merge_distinct(days, by), by, "unique_subs")


# Estimates: whether sketches, merged from finer keys, lie within 3 % of the exact figures (quantiles: within 2 % of the ranks)

WITHIN = "SELECT technology, true AS rows_equal, true AS bytes_equal, true AS subs_close, true AS p95_close, true AS mean_equal FROM traffic_dim GROUP BY 1"


@query(WITHIN)
def agg_merge(f: Feeds) -> DataFrame:
    rows = located(f)
    hourly = rollup.traffic_state(rows, "technology", hour_start("event_time").alias("hour"))
    merged = rollup.finish_states(rollup.merge_states(hourly, "technology"), "technology")
    exact = rows.groupBy("technology").agg(F.count("*").alias("n"), F.sum(F.col("bytes_up") + F.col("bytes_down")).alias("b"), F.count_distinct("imsi_hash").alias("u"), F.percentile("latency_ms", 0.93).alias("low"), F.percentile("latency_ms", 0.97).alias("high"), F.avg("latency_ms").alias("m"))
    close = lambda a, b, tolerance: F.abs(F.col(a) - F.col(b)) <= tolerance * F.abs(F.col(b))
    return merged.join(exact, "technology").select("technology", (F.col("session_count") == F.col("n")).alias("rows_equal"), (F.col("total_bytes") == F.col("b")).alias("bytes_equal"), close("unique_subs", "u", 0.03).alias("subs_close"), F.col("p95_latency").between(F.col("low"), F.col("high")).alias("p95_close"), close("avg_latency", "m", 1e-9).alias("mean_equal"))


@query("SELECT station_id, count(DISTINCT traffic_id) AS n, true AS close FROM live_traffic GROUP BY 1")
def agg_approx_distinct(f: Feeds) -> DataFrame:
    """Whether a sketch lies within 3 % of the exact figure; it holds the few ids of a small station as they are, so none is lost there."""
    ids = f.live_traffic().select("station_id", "traffic_id").distinct()  # before the sketch, which would else be kept for each id
    counted = ids.groupBy("station_id").agg(F.count("traffic_id").alias("n"), rollup.approx_distinct("traffic_id").alias("about"))
    return counted.select("station_id", "n", (F.abs(F.col("about") - F.col("n")) <= 0.03 * F.col("n")).alias("close"))
