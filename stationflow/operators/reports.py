"""Reports over any range of hours or days at once, one function each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationflow.functions.health import with_health
from stationflow.functions.numbers import LIFT, json_flag, json_number, json_object, json_text, ratio, rounded
from stationflow.functions.times import at, day_number, hour_start, minutes_between
from stationflow.operators import joins, quantiles
from stationflow.operators.rollup import top_value
from stationflow.sources.scratch import staged

#: The hour of a row's time, where a table has it.
HOUR = "hour_start"
STATION_ATTRS = ("station_code", "operator_code", "province", "region", "density_class", "technology")


@dataclass(frozen=True)
class Tables:
    """Live staged rows of the three feeds, and the station dimension."""

    traffic: DataFrame
    metrics: DataFrame
    events: DataFrame
    stations: DataFrame


def reported_traffic(traffic: DataFrame) -> DataFrame:
    """The traffic columns that reports read."""
    return traffic.select("station_id", "event_time", "imsi_hash", "bytes_up", "bytes_down", "latency_ms", "jitter_ms", "packet_loss_pct")


def reported_events(events: DataFrame) -> DataFrame:
    """The event columns that reports read."""
    return events.select("station_id", "event_id", "event_time", "event_type", "severity", "description", "metadata", "target_station_id")


def with_hour(rows: DataFrame, time: str) -> DataFrame:
    """The rows with their hour; a table that has it may be dealt by it, and then isn't dealt again."""
    return rows if HOUR in rows.columns else rows.withColumn(HOUR, hour_start(time))


def metrics_hourly(metrics: DataFrame) -> DataFrame:
    return with_hour(metrics, "metric_time").groupBy("station_id", HOUR).agg(
        F.avg("cpu_usage_pct").alias("avg_cpu_pct"),
        F.max("cpu_usage_pct").alias("max_cpu_pct"),
        F.avg("memory_usage_pct").alias("avg_memory_pct"),
        F.avg("temperature_celsius").alias("avg_temperature_celsius"),
        F.max("temperature_celsius").alias("max_temperature_celsius"),
        F.avg("uplink_throughput_mbps").alias("avg_uplink_throughput_mbps"),
        F.avg("downlink_throughput_mbps").alias("avg_downlink_throughput_mbps"),
    )


def events_hourly(events: DataFrame) -> DataFrame:
    is_ = lambda kind: F.col("event_type") == kind
    started = F.when(is_("incident_start"), F.struct("event_time", "event_id"))
    return with_hour(events, "event_time").groupBy("station_id", HOUR).agg(
        F.count_if(is_("alarm")).alias("alarm_count"),
        F.count_if(F.col("severity").isin("warning", "error", "critical")).alias("warning_count"),
        F.count_if(F.col("severity") == "critical").alias("critical_count"),
        F.count_if(is_("handover")).alias("handover_count"),
        F.max(is_("incident_start").cast("int")).alias("incident_active"),
        F.max_by(F.get_json_object("metadata", "$.incident_type"), started).alias("incident_type"),
        F.max(is_("maintenance_start").cast("int")).alias("maintenance_active"),
    )


def health_hourly(t: Tables) -> DataFrame:
    """Traffic, load and events of each station and hour, with the health score.

    The feeds are aggregated first and joined by station and hour, so no raw rows meet. Feeds that are dealt by
    station and hour are aggregated and joined where they lie.
    """
    rows = with_hour(t.traffic, "event_time").select("station_id", HOUR, "imsi_hash", (F.col("bytes_up") + F.col("bytes_down")).alias("bytes"), "latency_ms", "packet_loss_pct")
    measures = [
        F.count("*").alias("session_count"),
        F.count_distinct("imsi_hash").alias("unique_subscribers"),
        F.sum("bytes").alias("total_bytes"),
        F.avg("latency_ms").alias("avg_latency_ms"),
        F.avg("packet_loss_pct").alias("avg_packet_loss_pct"),
        (F.count_if(F.col("latency_ms") > 100) / F.count("*")).alias("high_latency_ratio"),
    ]
    on = ["station_id", HOUR]
    traffic = quantiles.aggregate_small(rows, on, measures, {"p95_latency_ms": ("latency_ms", 0.95)})
    joined = traffic.join(metrics_hourly(t.metrics), on, "left").join(events_hourly(t.events), on, "left")
    counts = ("alarm_count", "warning_count", "critical_count", "handover_count", "incident_active", "maintenance_active")
    joined = joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})
    return with_health(joins.lookup(joined, t.stations, {a: a for a in STATION_ATTRS}))


HEALTH_KEYS = ("report_date", "station_id", "operator_code", "region", "density_class")


def scored_days(health: DataFrame) -> tuple[DataFrame, Column, Column]:
    """Hours with a score under their day, and which are critical, and which degraded or worse.

    Hours without a score (maintenance) belong to no day, so a day of them alone has no row. The category decides,
    which is taken before rounding: an hour just under a threshold counts although its score shows the threshold.
    """
    hours = health.where(F.col("health_score").isNotNull()).withColumn("report_date", F.to_date("hour_start"))
    category = F.col("health_category")
    return hours, category == "critical", category.isin("degraded", "critical")


def health_daily(health: DataFrame) -> DataFrame:
    """Scores of each station and day, over its hours with a score."""
    hours, critical, degraded = scored_days(health)
    return hours.groupBy(*HEALTH_KEYS).agg(
        F.avg("health_score").alias("avg_health_score"),
        F.min("health_score").alias("min_health_score"),
        F.max("health_score").alias("max_health_score"),
        F.count_if(critical).alias("hours_critical"),
        F.count_if(degraded).alias("hours_degraded"),
    )


def health_state(health: DataFrame) -> DataFrame:
    """Hourly health as mergeable daily states of each station."""
    score = F.col("health_score")
    hours, critical, degraded = scored_days(health)
    return hours.groupBy(*HEALTH_KEYS).agg(
        F.sum(score).alias("score_sum"),
        F.count(score).alias("score_n"),
        F.min(score).alias("score_min"),
        F.max(score).alias("score_max"),
        F.count_if(critical).alias("critical"),
        F.count_if(degraded).alias("degraded"),
    )


def merge_health_states(states: DataFrame) -> DataFrame:
    """States of any batches as one state for each station and day."""
    sums, least, most = ("score_sum", "score_n", "critical", "degraded"), ("score_min",), ("score_max",)
    return states.groupBy(*HEALTH_KEYS).agg(*(fn(c).alias(c) for fn, names in ((F.sum, sums), (F.min, least), (F.max, most)) for c in names))


def merge_health(states: DataFrame) -> DataFrame:
    """States of any batches as ``health_daily`` gives them."""
    return states.groupBy(*HEALTH_KEYS).agg(
        ratio(F.sum("score_sum"), F.sum("score_n")).alias("avg_health_score"),
        F.min("score_min").alias("min_health_score"),
        F.max("score_max").alias("max_health_score"),
        F.sum("critical").alias("hours_critical"),
        F.sum("degraded").alias("hours_degraded"),
    )


def incident_minutes(pairs: DataFrame) -> Column:
    """The end's recorded duration, else the minutes between start and end; null while open."""
    return F.coalesce(json_number(json_object("end_meta"), "duration_min"), minutes_between(F.col("started"), F.col("ended")).cast("double"))


def incident_days(pairs: DataFrame) -> DataFrame:
    """Incidents of each station and day, and the minutes of those that ended."""
    minutes = incident_minutes(pairs)
    return pairs.groupBy("station_id", "report_date").agg(F.count("*").alias("incident_count"), F.sum(minutes).alias("total_incident_min"), F.max(minutes).alias("longest_incident_min"), F.avg(minutes).alias("mttr_min"))


# The agreed uptime by technology.
UPTIME_TARGETS = {"5G": 99.99, "4G": 99.9, "3G": 99.5}


def sla_compliance(t: Tables, health: DataFrame) -> DataFrame:
    """Uptime of each station and day against its target; maintenance hours aren't billed."""
    category = F.col("health_category")
    days = health.groupBy("station_id", F.to_date("hour_start").alias("report_date"), *STATION_ATTRS).agg(
        F.count("*").alias("total_hours"),
        F.count_if(category != "maintenance").alias("active_hours"),
        F.count_if(category == "critical").alias("down_hours"),
        F.count_if(category == "maintenance").alias("maintenance_hours"),
        F.count_if(category.isin("degraded", "warning")).alias("degraded_hours"),
        F.avg("health_score").alias("avg_health_score"),
        F.min("health_score").alias("min_health_score"),
        F.count_if(F.col("health_score") < 60).alias("hours_below_60"),
        F.count_if(F.col("health_score") < 30).alias("hours_below_30"),
    )
    target = F.lit(99.0)
    for name, pct in UPTIME_TARGETS.items():
        target = F.when(F.col("technology") == name, pct).otherwise(target)
    days = days.withColumn("billable_hours", 24 - F.col("maintenance_hours")).withColumn("available_hours", F.col("billable_hours") - F.col("down_hours"))
    days = days.withColumns({"uptime_pct": ratio(F.col("available_hours"), F.col("billable_hours"), F.lit(1.0)) * 100, "sla_target_pct": target})
    met, breach = F.col("uptime_pct") >= F.col("sla_target_pct"), F.col("sla_target_pct") / 100 * F.col("billable_hours") - F.col("available_hours")
    status = F.when(met, "compliant").when(F.col("uptime_pct") <= 95, "critical_breach").otherwise("minor_breach")
    days = days.withColumns({"sla_met": met.cast("int"), "sla_breach_hours": F.greatest(F.lit(0.0), breach), "compliance_status": status})
    pairs = joins.pair_by_rank(t.events, "incident_start", "incident_end")
    return days.join(incident_days(pairs), ["station_id", "report_date"], "left").withColumn("incident_count", F.coalesce("incident_count", F.lit(0)))


ANOMALY_MEASURES = {"latency": ("avg_latency_ms", "current_latency_ms"), "cpu": ("avg_cpu_pct", "current_cpu_pct"), "throughput": ("avg_downlink_throughput_mbps", "current_throughput"), "subscribers": ("unique_subscribers", "current_subscribers")}


def rolling_baseline(hourly: DataFrame, measures: dict[str, str], days: int = 7) -> DataFrame:
    """``hourly`` with mean and deviation of each measure at the same hour of the ``days`` days before."""
    past = Window.partitionBy("station_id", F.hour("hour_start")).orderBy(day_number(F.to_date("hour_start"))).rangeBetween(-days, -1)
    return hourly.withColumns({f"{n}_{stat}": fn(c).over(past) for n, c in measures.items() for stat, fn in (("mean", F.avg), ("std", F.stddev_pop))})


def anomaly_features(health: DataFrame) -> DataFrame:
    """How far each station-hour lies from its baseline, in deviations.

    Measures and baselines are taken to six decimals, as a flat baseline would else magnify
    what summing left behind.
    """
    based = rolling_baseline(health, {n: c for n, (c, _) in ANOMALY_MEASURES.items()})
    cols: dict[str, Column] = {}
    for name, (measure, shown) in ANOMALY_MEASURES.items():
        now, mean, std = (rounded(F.col(c).cast("double"), 6, LIFT) for c in (measure, f"{name}_mean", f"{name}_std"))
        mean, std = F.coalesce(mean, now), F.coalesce(std, F.lit(0.0))
        cols |= {shown: now, f"baseline_{name}_mean": mean, f"baseline_{name}_std": std, f"z_{name}": (now - mean) / F.greatest(std, F.lit(1e-6))}
    z = {n: F.col(f"z_{n}") for n in ANOMALY_MEASURES}
    odd = {n: (c < -3 if n == "throughput" else F.abs(c) > 3) for n, c in z.items()}
    kinds = F.concat_ws(",", *(F.when(o, n) for n, o in odd.items()))
    out = based.withColumns(cols).withColumn("current_packet_loss", F.col("avg_packet_loss_pct")).withColumn("anomaly_type", F.when(kinds != "", kinds))
    out = out.withColumns({"is_anomalous": F.col("anomaly_type").isNotNull().cast("int"), "neighbor_anomaly_count": F.lit(0)})
    return out.select("station_id", "station_code", "hour_start", *cols, "current_packet_loss", "is_anomalous", "anomaly_type", "neighbor_anomaly_count")


def hour_of_day_volume(traffic: DataFrame, dates: DataFrame, days: int = 7) -> DataFrame:
    """Mean hourly bytes of the ``days`` days before each of ``dates``, by station and hour of day.

    A day's volume is taken once and given to the days that follow it.
    """
    volume = traffic.groupBy("station_id", F.to_date("event_time").alias("day"), F.hour("event_time").alias("hour_of_day")).agg(F.sum(F.col("bytes_up") + F.col("bytes_down")).alias("bytes"))
    later = volume.withColumn("report_date", F.explode(F.sequence(F.date_add("day", 1), F.date_add("day", days))))
    later = later.join(dates.select("report_date").distinct(), "report_date", "left_semi")
    return later.groupBy("station_id", "report_date", "hour_of_day").agg((F.sum("bytes") / float(days)).alias("avg_hourly_bytes"))


def outage_report(t: Tables, health: DataFrame, as_of: str, pair: Callable = joins.pair_by_rank) -> DataFrame:
    """Incidents with their duration, who was affected, and the traffic lost against the baseline. The pairs, which meet most tables, are written once."""
    pairs = staged(pair(t.events, "incident_start", "incident_end"))
    hit = joins.interval_join(pairs.select("station_id", "start_id", "started", "ended"), t.traffic, as_of).groupBy("start_id").agg(F.count_distinct("imsi_hash").alias("affected_subscribers"), F.sum(F.col("bytes_up") + F.col("bytes_down")).alias("incident_bytes"))
    during = joins.hour_range_join(pairs.select("station_id", "start_id", "started", "ended"), health.select("station_id", "hour_start", "health_score"), as_of).groupBy("start_id").agg(F.avg("health_score").alias("health_score_during"))
    base = hour_of_day_volume(t.traffic, pairs)
    out = pairs.withColumn("hour_of_day", F.hour("started")).join(hit, "start_id", "left").join(during, "start_id", "left").join(base, ["station_id", "report_date", "hour_of_day"], "left")
    minutes = incident_minutes(pairs)
    out = out.withColumns({"start_json": json_object("start_meta"), "duration": minutes})
    minutes, start = F.col("duration"), F.col("start_json")
    lost = F.greatest(F.lit(0.0), F.coalesce("avg_hourly_bytes", F.lit(0.0)) * (F.coalesce(minutes, F.lit(0.0)) / 60) - F.coalesce("incident_bytes", F.lit(0)))
    out = out.select(
        "station_id",
        "report_date",
        "start_id",
        json_text(start, "incident_type").alias("incident_type"),
        json_number(start, "severity").alias("severity"),
        F.col("started").alias("incident_start"),
        F.col("ended").alias("incident_end"),
        minutes.alias("duration_min"),
        json_number(start, "estimated_duration_min").alias("estimated_duration_min"),
        F.coalesce("affected_subscribers", F.lit(0)).alias("affected_subscribers"),
        lost.alias("traffic_loss_bytes"),
        json_number(start, "hardware_quality").alias("hardware_quality"),
        "health_score_during",
    )
    return joins.lookup(out, t.stations, {a: a for a in ("station_code", "operator_code", "province", "region", "technology")})


def region_daily(health: DataFrame, sla: DataFrame) -> DataFrame:
    """Stations, load, health and compliance of each day, region, province, operator and technology."""
    keys = ["report_date", "region", "province", "operator_code", "technology"]
    score, station = F.col("health_score"), F.col("station_id")
    areas = health.withColumn("report_date", F.to_date("hour_start")).groupBy(*keys).agg(
        F.count_distinct(station).alias("station_count"),
        F.count_distinct(F.when(F.col("session_count") > 0, station)).alias("active_station_count"),
        F.sum("unique_subscribers").alias("total_subscribers"),
        F.sum("session_count").alias("total_sessions"),
        F.sum("total_bytes").alias("total_bytes"),
        F.avg(score).alias("avg_health_score"),
        F.min(score).alias("min_health_score"),
        F.count_distinct(F.when(score < 30, station)).alias("stations_critical"),
        F.count_distinct(F.when((score >= 30) & (score < 60), station)).alias("stations_degraded"),
        F.avg("avg_latency_ms").alias("avg_latency_ms"),
        F.percentile("p95_latency_ms", 0.95).alias("p95_latency_ms"),
        F.avg("avg_packet_loss_pct").alias("avg_packet_loss_pct"),
        F.count_if(F.col("incident_active") == 1).alias("incident_count"),
    )
    kept = sla.groupBy(*keys).agg(F.count("*").alias("__stations"), F.count_if(F.col("sla_met") == 0).alias("sla_breach_count"))
    breaches = F.coalesce("sla_breach_count", F.lit(0))
    pct = ratio((F.col("__stations") - breaches) * 100.0, F.col("__stations"), F.lit(100.0))
    return areas.join(kept, keys, "left").withColumns({"sla_compliance_pct": pct, "sla_breach_count": breaches}).drop("__stations")


def maintenance_report(t: Tables, health: DataFrame, as_of: str) -> DataFrame:
    """Maintenance with planned and actual minutes, and health the hour before and after."""
    pairs = joins.pair_by_rank(t.events, "maintenance_start", "maintenance_end")
    stop = F.coalesce("ended", at(as_of))
    out = joins.offset_value(pairs, health, F.col("started"), -1, "health_score", "pre_maintenance_health")
    out = joins.offset_value(out, health, stop, 1, "health_score", "post_maintenance_health")
    out, start = out.withColumn("start_json", json_object("start_meta")), F.col("start_json")
    planned, actual = json_number(start, "planned_duration_min", "duration_min").cast("long"), minutes_between(F.col("started"), stop)
    out = out.select(
        "station_id",
        "report_date",
        "start_id",
        F.col("started").alias("maintenance_start"),
        F.col("ended").alias("maintenance_end"),
        planned.alias("planned_duration_min"),
        actual.alias("actual_duration_min"),
        (actual - planned).alias("overrun_min"),
        json_flag(start, "tech_upgrade", "upgrade").alias("tech_upgrade"),
        json_flag(start, "sla_excluded").alias("sla_excluded"),
        "pre_maintenance_health",
        "post_maintenance_health",
    )
    return joins.lookup(out, t.stations, {a: a for a in ("station_code", "operator_code", "region", "technology")})


def handover_daily(t: Tables) -> DataFrame:
    """Handovers between stations by day, with the mean latency at both; the latency is taken once and joined twice."""
    latency = t.traffic.groupBy("station_id", F.to_date("event_time").alias("report_date")).agg(F.avg("latency_ms").alias("latency"))
    moves = t.events.where((F.col("event_type") == "handover") & (F.coalesce("target_station_id", F.lit(0)) != 0))
    moves = moves.groupBy(F.to_date("event_time").alias("report_date"), F.col("station_id").alias("source_station_id"), "target_station_id").agg(F.count("*").alias("handover_count"), F.count_distinct(F.get_json_object("metadata", "$.imsi_hash")).alias("unique_subscribers"))
    for side, when in (("source", "before"), ("target", "after")):
        role = latency.select("report_date", F.col("station_id").alias(f"{side}_station_id"), F.col("latency").alias(f"avg_latency_{when}_ms"))
        moves = moves.join(role, ["report_date", f"{side}_station_id"], "left")
        moves = joins.lookup(moves, t.stations, {f"{side}_station_code": "station_code", f"{side}_region": "region"}, key=f"{side}_station_id")
    return moves


def alarm_daily(t: Tables, health: DataFrame) -> DataFrame:
    """Alarms of each station and day by severity, their rate, and the most frequent text."""
    keys = ["report_date", "station_id"]
    alarms = t.events.where(F.col("event_type") == "alarm").withColumn("report_date", F.to_date("event_time"))
    counts = alarms.groupBy(*keys).agg(*(F.count_if(F.col("severity") == s).alias(f"{s}_count") for s in ("warning", "error", "critical")), F.count("*").alias("total_alarm_count"))
    hours = health.groupBy(F.to_date("hour_start").alias("report_date"), "station_id").agg(F.count_if(F.col("health_category") != "maintenance").alias("active_hours"), F.avg("health_score").alias("health_score_avg"))
    out = counts.join(top_value(alarms, keys, "description", "top_alarm_description"), keys, "left").join(hours, keys, "left")
    out = out.withColumn("alarm_rate_per_hour", ratio(F.col("total_alarm_count").cast("double"), F.coalesce("active_hours", F.lit(0)), F.col("total_alarm_count").cast("double"))).drop("active_hours")
    return joins.lookup(out, t.stations, {a: a for a in ("station_code", "operator_code", "region", "technology")})
