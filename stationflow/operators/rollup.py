"""Hourly and daily rollups, mergeable states, and delay metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationflow.functions.numbers import ratio
from stationflow.functions.times import epoch_micros, hour_start
from stationflow.operators import quantiles
from stationflow.sources.scratch import staged

P95 = {"p95_latency": ("latency_ms", 0.95)}
#: What is measured, and so written once, as quantiles take a second look.
MEASURED = ("bytes_up", "bytes_down", "imsi_hash", "latency_ms", "packet_loss_pct")
STATION = ["station_code", "operator_code", "region", "province", "density_class", "technology"]


def traffic_measures(jitter: bool) -> list[Column]:
    """The exact measures of a traffic rollup."""
    cols = [
        F.sum(F.col("bytes_up") + F.col("bytes_down")).alias("total_bytes"),
        F.count("*").alias("session_count"),
        F.count_distinct("imsi_hash").alias("unique_subs"),
        F.avg("latency_ms").alias("avg_latency"),
        F.avg("packet_loss_pct").alias("avg_packet_loss"),
    ]
    return [*cols, F.avg("jitter_ms").alias("avg_jitter")] if jitter else cols


def traffic_hourly(traffic: DataFrame) -> DataFrame:
    """Traffic by hour and station attributes."""
    rows = traffic.select(hour_start("event_time").alias("event_hour"), *STATION, *MEASURED, "jitter_ms")
    return quantiles.aggregate(staged(rows), ["event_hour", *STATION], traffic_measures(True), P95)


def traffic_daily(traffic: DataFrame) -> DataFrame:
    """Traffic by day and station attributes."""
    rows = traffic.select(F.to_date("event_time").alias("event_date"), *STATION, *MEASURED)
    return quantiles.aggregate(staged(rows), ["event_date", *STATION], traffic_measures(False), P95)


def operator_daily(traffic: DataFrame) -> DataFrame:
    """Traffic by day, operator and region."""
    return traffic.groupBy(F.to_date("event_time").alias("event_date"), "operator_code", "region").agg(
        F.sum(F.col("bytes_up") + F.col("bytes_down")).alias("total_bytes"),
        F.count("*").alias("session_count"),
        F.count_distinct("imsi_hash").alias("unique_subs"),
        F.count_distinct("station_code").alias("active_stations"),
        F.avg("latency_ms").alias("avg_latency"),
    )


def approx_distinct(value: Column | str) -> Column:
    """About how many distinct values there are: within 0.4 % in large groups (one standard error), the values' own hashes in small ones.

    ``approx_count_distinct`` is off by one or more as soon as two of a few values share a register, which is over any share of a small number.
    """
    return F.hll_sketch_estimate(F.hll_sketch_agg(value, F.lit(16)))


#: What ``traffic_state`` reads, beside its keys.
STATE_COLUMNS = ("bytes_up", "bytes_down", "imsi_hash", "latency_ms")


def traffic_state(traffic: DataFrame, *keys: Column | str) -> DataFrame:
    """Mergeable partial aggregates: sums and counts, a distinct sketch and a quantile sketch."""
    return traffic.groupBy(*keys).agg(
        F.sum(F.col("bytes_up") + F.col("bytes_down")).alias("bytes_sum"),
        F.count("*").alias("rows"),
        F.hll_sketch_agg("imsi_hash", F.lit(14)).alias("subs_hll"),
        F.sum("latency_ms").alias("latency_sum"),
        F.count("latency_ms").alias("latency_n"),
        F.min("latency_ms").alias("latency_min"),
        F.max("latency_ms").alias("latency_max"),
        F.kll_sketch_agg_double("latency_ms", F.lit(800)).alias("latency_kll"),
        F.count_if(F.col("latency_ms") > 100).alias("slow_rows"),
    )


def merge_states(states: DataFrame, *keys: Column | str) -> DataFrame:
    """States of finer keys or of other batches as one state for each key."""
    return states.groupBy(*keys).agg(
        F.sum("bytes_sum").alias("bytes_sum"),
        F.sum("rows").alias("rows"),
        F.hll_union_agg("subs_hll").alias("subs_hll"),
        F.sum("latency_sum").alias("latency_sum"),
        F.sum("latency_n").alias("latency_n"),
        F.min("latency_min").alias("latency_min"),
        F.max("latency_max").alias("latency_max"),
        F.kll_merge_agg_double("latency_kll").alias("latency_kll"),
        F.sum("slow_rows").alias("slow_rows"),
    )


def finish_states(states: DataFrame, *keys: str) -> DataFrame:
    """Final measures of states; distinct counts and quantiles are estimates."""
    return states.select(
        *keys,
        F.col("bytes_sum").alias("total_bytes"),
        F.col("rows").alias("session_count"),
        F.hll_sketch_estimate("subs_hll").alias("unique_subs"),
        ratio(F.col("latency_sum"), F.col("latency_n")).alias("avg_latency"),
        "latency_min",
        "latency_max",
        F.kll_sketch_get_quantile_double("latency_kll", F.lit(0.95)).alias("p95_latency"),
        (F.col("slow_rows") / F.col("rows")).alias("high_latency_ratio"),
    )


def sum_merge(df: DataFrame, keys: list[str], counts: list[str]) -> DataFrame:
    """Rows of one key with their counts summed."""
    return df.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in counts))


def delay_metrics(df: DataFrame, time: str, buffer_seconds: int = 240, keys: tuple[str | Column, ...] = ()) -> DataFrame:
    """Propagation (created to updated) and clock offset (event to created) in seconds, late and updated rows."""
    seconds = lambda a, b: (epoch_micros(F.col(b)) - epoch_micros(F.col(a))) / 1e6
    propagation, offset = seconds("created_at", "updated_at"), seconds(time, "created_at")
    measures = [
        F.max(propagation).alias("max_propagation_s"),
        F.max(offset).alias("max_offset_s"),
        F.count_if(offset > buffer_seconds).alias("late_rows"),
        F.count_if(propagation > 1).alias("updated_rows"),
        F.max("updated_at").alias("max_updated_at"),
    ]
    return quantiles.aggregate(df, [*keys], measures, {"p99_propagation_s": (propagation, 0.99), "p99_offset_s": (offset, 0.99)})


def top_value(df: DataFrame, keys: list[str], col: str, name: str) -> DataFrame:
    """Each key's most frequent value; of equally frequent ones the smallest. Counts come first, so no group is gathered."""
    counts = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("order"), F.col(col).alias("value")))
    return counts.groupBy(*keys).agg(best["value"].alias(name))
