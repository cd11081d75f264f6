"""Row rules, labels, the valid/quarantine split, and checks of dimensions and reports."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions.times import at, hour_start, parsed

# The domains of the source data.
EVENT_TYPES = (
    "handover", "attach", "detach", "paging", "alarm", "config_change",
    "incident_start", "incident_end", "maintenance_start", "maintenance_end",
    "station_commissioned", "station_testing", "station_go_live", "station_decommission", "station_retired",
    "cluster_outage_start", "cluster_outage_end", "weather_degradation", "weather_clear",
    "mass_event_start", "mass_event_end", "firmware_bug_start", "firmware_reboot", "firmware_hotfix",
)
SEVERITIES = ("debug", "info", "warning", "error", "critical")
PROTOCOLS = ("TCP", "UDP", "ICMP", "OTHER")
TECHNOLOGIES = ("2G", "3G", "4G", "5G")
BANDS = ("GSM-900", "GSM-1800", "UMTS-2100", "UMTS-900", "Band-3", "Band-7", "Band-20", "n78", "n258", "n77", "unknown")
STATUSES = ("planned", "provisioning", "testing", "active", "degraded", "maintenance", "down", "decommissioning", "retired")
# Labels of rows that may be re-admitted.
SOFT = ("jitter_invalid", "duration_invalid", "pkt_loss_invalid", "latency_invalid")


# The thresholds of the profiles.
@dataclass(frozen=True)
class Profile:
    """Thresholds; ranges are inclusive."""

    latency: tuple[float, float] = (0.0, 10_000.0)
    jitter: tuple[float, float] = (0.0, 5_000.0)
    packet_loss: tuple[float, float] = (0.0, 100.0)
    duration: tuple[int, int] = (0, 86_400_000)
    percent: tuple[float, float] = (0.0, 100.0)
    temperature: tuple[float, float] = (-20.0, 95.0)
    power: tuple[float, float] = (0.0, 10_000.0)
    throughput: tuple[float, float] = (0.0, 100_000.0)
    signal: tuple[float, float] = (-120.0, -30.0)
    bytes_min: int = 0
    future_seconds: int = 300


DEFAULT = Profile()
STRICT = replace(DEFAULT, latency=(0.0, 5_000.0), jitter=(0.0, 1_000.0), temperature=(-10.0, 85.0), future_seconds=120)


def rule_range(col: str, lo: float, hi: float) -> Column:
    """Outside the range, or null."""
    return F.coalesce(~F.col(col).between(lo, hi), F.lit(True))


def rule_domain(col: str, values: tuple[str, ...]) -> Column:
    """Not among the values, or null."""
    return F.coalesce(~F.col(col).isin(*values), F.lit(True))


def rule_not_empty(col: str) -> Column:
    return F.col(col).isNull() | (F.col(col) == "")


def rule_below(col: str, least: float) -> Column:
    """Below the least value; null is no issue."""
    return F.coalesce(F.col(col) < least, F.lit(False))


def rule_future(col: str, as_of: str, tolerance: int = DEFAULT.future_seconds) -> Column:
    """More than ``tolerance`` seconds after ``as_of``."""
    return F.coalesce(F.col(col) > at(as_of) + F.make_dt_interval(secs=F.lit(tolerance)), F.lit(False))


def rule_order(earlier: str, later: str) -> Column:
    """``later`` lies before ``earlier``."""
    return F.coalesce(F.col(later) < F.col(earlier), F.lit(False))


def quality_string(rules: dict[str, Column]) -> Column:
    """Labels of the rules that hold, in their order, joined by commas."""
    return F.concat_ws(",", *(F.when(rule, label) for label, rule in rules.items()))


def judged(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``df`` with ``is_valid`` (never null) and ``quality_issues``."""
    return df.withColumns({"quality_issues": quality_string(rules), "is_valid": ~some(rules.values())})


def some(rules: Iterable[Column]) -> Column:
    """Whether one of the rules holds; no labels are built for it."""
    return reduce(or_, (F.coalesce(rule, F.lit(False)) for rule in rules), F.lit(False))


def staged_at_once(df: DataFrame, rules: dict[str, Column], soft: tuple[str, ...] = SOFT) -> DataFrame:
    """``staged_rows`` of both sides of ``judged``, from one look at ``df``: rows that no rule but soft ones holds for."""
    kept = judged(df.where(~some(rule for label, rule in rules.items() if label not in soft)), rules)
    return kept.withColumn("data_quality", F.when(F.col("is_valid"), "valid").otherwise("quarantined"))


#: What judging adds to a row; it follows from the row's other columns.
JUDGEMENT = ("quality_issues", "is_valid", "data_quality")


def traffic_rules(df: DataFrame, as_of: str, profile: Profile = DEFAULT) -> dict[str, Column]:
    """The twelve rules of traffic rows; rules of absent columns are left out."""
    rules = {
        "event_time_null": ("event_time", lambda: F.col("event_time").isNull()),
        "event_future": ("event_time", lambda: rule_future("event_time", as_of, profile.future_seconds)),
        "bytes_up<0": ("bytes_up", lambda: rule_below("bytes_up", profile.bytes_min)),
        "bytes_down<0": ("bytes_down", lambda: rule_below("bytes_down", profile.bytes_min)),
        "latency_invalid": ("latency_ms", lambda: rule_range("latency_ms", *profile.latency)),
        "jitter_invalid": ("jitter_ms", lambda: rule_range("jitter_ms", *profile.jitter)),
        "pkt_loss_invalid": ("packet_loss_pct", lambda: rule_range("packet_loss_pct", *profile.packet_loss)),
        "duration_invalid": ("connection_duration_ms", lambda: rule_range("connection_duration_ms", *profile.duration)),
        "protocol_invalid": ("protocol", lambda: rule_domain("protocol", PROTOCOLS)),
        "station_null": ("station_id", lambda: F.col("station_id").isNull()),
        "imsi_null": ("imsi_hash", lambda: rule_not_empty("imsi_hash")),
        "updated_before_created": ("updated_at", lambda: rule_order("created_at", "updated_at") if "created_at" in df.columns else F.lit(False)),
    }
    return {label: rule() for label, (col, rule) in rules.items() if col in df.columns}


def validate_traffic(df: DataFrame, as_of: str, profile: Profile = DEFAULT) -> DataFrame:
    """Traffic rows judged by their rules."""
    return judged(df, traffic_rules(df, as_of, profile))


def validate_metrics(df: DataFrame, profile: Profile = DEFAULT, as_of: str | None = None) -> DataFrame:
    """Metric rows judged by the ranges of the columns they have; the future rule only with ``as_of``."""
    ranges = {
        "cpu_invalid": (("cpu_usage_pct", "cpu_util_pct"), profile.percent),
        "memory_invalid": (("memory_usage_pct", "memory_util_pct"), profile.percent),
        "disk_invalid": (("disk_usage_pct", "disk_util_pct"), profile.percent),
        "temp_invalid": (("temperature_celsius", "temperature_c"), profile.temperature),
        "power_invalid": (("power_consumption_watts",), profile.power),
        "uplink_invalid": (("uplink_throughput_mbps",), profile.throughput),
        "downlink_invalid": (("downlink_throughput_mbps",), profile.throughput),
        "signal_invalid": (("signal_strength_dbm",), profile.signal),
        "channel_invalid": (("channel_utilization_pct",), profile.percent),
    }
    rules = {"event_time_null": F.col("metric_time").isNull(), "station_null": F.col("station_id").isNull()}
    if as_of:
        rules["event_future"] = rule_future("metric_time", as_of, profile.future_seconds)
    for label, (names, span) in ranges.items():
        there = [n for n in names if n in df.columns]
        if there:
            rules[label] = rule_range(there[0], *span)
    if "frequency_band" in df.columns:
        rules["band_invalid"] = rule_domain("frequency_band", BANDS)
    for name in ("active_subscribers", "active_connections"):
        if name in df.columns:
            rules.setdefault("subscribers_negative", rule_below(name, 0))
    return judged(df, rules)


def validate_events(df: DataFrame, as_of: str, profile: Profile = DEFAULT) -> DataFrame:
    """Event rows judged by time, station, type and severity."""
    rules = {
        "event_time_null": F.col("event_time").isNull(),
        "station_null": F.col("station_id").isNull(),
        "event_type_invalid": rule_domain("event_type", EVENT_TYPES),
        "severity_invalid": rule_domain("severity", SEVERITIES),
        "event_future": rule_future("event_time", as_of, profile.future_seconds),
    }
    return judged(df, rules)


def normalize_time(df: DataFrame, col: str, source_tz: str | None = None) -> DataFrame:
    return df.withColumn(col, parsed(F.col(col), source_tz))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and quarantined rows; together all rows."""
    return df.where("is_valid"), df.where("not is_valid")


def recoverable(issues: Column, soft: tuple[str, ...] = SOFT) -> Column:
    """Some issue, and none but soft ones."""
    return (issues != "") & (F.size(F.array_except(F.split(issues, ","), F.array(*map(F.lit, soft)))) == 0)


def split_quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Recoverable and hard rows of a quarantine."""
    soft = recoverable(F.col("quality_issues"))
    return df.where(soft), df.where(~soft)


def staged_rows(valid: DataFrame, quarantine: DataFrame, include_recoverable: bool = True) -> DataFrame:
    """Valid rows, and recoverable ones if wanted, told apart by ``data_quality``."""
    rows = valid.withColumn("data_quality", F.lit("valid"))
    if include_recoverable:
        rows = rows.unionByName(split_quarantine(quarantine)[0].withColumn("data_quality", F.lit("quarantined")), allowMissingColumns=True)
    return rows


def derive_traffic(df: DataFrame, as_of: str) -> DataFrame:
    """Total bytes (null counts as 0), event date and hour, high latency, and the time of the step."""
    return df.withColumns({
        "bytes_total": F.coalesce("bytes_up", F.lit(0)) + F.coalesce("bytes_down", F.lit(0)),
        "event_date": F.to_date("event_time"),
        "event_hour": hour_start("event_time"),
        "is_high_latency": F.coalesce(F.col("latency_ms") > 100, F.lit(False)),
        "transformed_at": at(as_of),
    })


def quality_summary(df: DataFrame) -> DataFrame:
    """Rows, invalid rows and their percentage."""
    total, bad = F.count("*"), F.count_if(~F.col("is_valid"))
    return df.agg(total.alias("total_rows"), bad.alias("invalid_rows"), (bad * 100.0 / F.greatest(total, F.lit(1))).alias("invalid_pct"))


def issue_counts(df: DataFrame) -> DataFrame:
    """Rows with each label."""
    return df.where("quality_issues <> ''").select(F.explode(F.split("quality_issues", ",")).alias("issue")).groupBy("issue").agg(F.count("*").alias("n"))


def _warnings(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """One row for each check that some row fails, from one pass over ``df``."""
    counted = df.agg(F.count("*").alias("rows"), *(F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in checks.items()))
    every = F.array(F.struct(F.lit("empty").alias("warning"), (F.col("rows") == 0).cast("long").alias("n")), *(F.struct(F.lit(k).alias("warning"), F.col(f"`{k}`").alias("n")) for k in checks))
    return counted.select(F.explode(every).alias("w")).select("w.*").where("n > 0")


def check_dimension(dim: DataFrame) -> DataFrame:
    """Unknown technologies and statuses, repeated codes, places off the map, an empty dimension."""
    checks = {"unknown_technology": ~F.col("technology").isin(*TECHNOLOGIES)}
    if "status" in dim.columns:
        checks["unknown_status"] = ~F.col("status").isin(*STATUSES)
    if {"latitude", "longitude"} <= {*dim.columns}:
        checks["off_the_map"] = ~(F.col("latitude").between(8, 24) & F.col("longitude").between(102, 110))
    twice = dim.groupBy("station_code").count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("n")).where("n > 0")
    return _warnings(dim, checks).unionByName(twice.select(F.lit("duplicate_code").alias("warning"), "n"))


def health_checks(columns: list[str]) -> dict[str, Column]:
    """What must not be in a health report."""
    checks = {"cpu_out_of_range": ~F.col("avg_cpu_pct").between(0, 100), "negative_latency": F.col("avg_latency_ms") < 0, "negative_bytes": F.col("total_bytes") < 0}
    return checks | ({"no_station": F.col("station_count") <= 0} if "station_count" in columns else {})


def sla_checks(columns: list[str]) -> dict[str, Column]:
    return {f"{c}_out_of_range": ~F.col(c).between(0, 100) for c in ("availability_pct", "uptime_pct") if c in columns}


def anomaly_checks(columns: list[str]) -> dict[str, Column]:
    return {f"{c}_extreme": F.abs(c) > 10 for c in ("z_cpu", "z_latency", "z_throughput") if c in columns}


def check_health(df: DataFrame) -> DataFrame:
    return _warnings(df, health_checks(df.columns))


def check_sla(df: DataFrame) -> DataFrame:
    return _warnings(df, sla_checks(df.columns))


def check_anomaly(df: DataFrame) -> DataFrame:
    return _warnings(df, anomaly_checks(df.columns))


def distinct_values(df: DataFrame, col: str, allowed: tuple[str, ...]) -> DataFrame:
    """Values that occur but aren't allowed."""
    return df.select(F.col(col).alias("value")).where(F.col("value").isNotNull() & ~F.col("value").isin(*allowed)).distinct()
