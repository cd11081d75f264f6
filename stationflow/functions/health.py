"""The health score of a station-hour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stationflow.functions.numbers import LIFT, rounded

# Expected downlink throughput by technology in Gbit/s, and the part weights.
EXPECTED_GBPS = {"2G": 0.01, "3G": 0.1, "4G": 1.0, "5G": 5.0}
WEIGHTS = {"latency": 0.25, "loss": 0.20, "cpu": 0.15, "temperature": 0.10, "errors": 0.15, "throughput": 0.15}


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def _floored(x: Column) -> Column:
    return F.greatest(F.lit(0.0), x)


def raw_score() -> Column:
    """The weighted score before rounding; missing measures count as zero."""
    expected = F.lit(1.0)
    for name, gbps in EXPECTED_GBPS.items():
        expected = F.when(F.col("technology") == name, gbps).otherwise(expected)
    parts = {
        "latency": _floored(100 - (_zero("avg_latency_ms") - 30) * 100 / 470),
        "loss": _floored(100 - _zero("avg_packet_loss_pct") * 10),
        "cpu": _floored(100 - _floored(_zero("avg_cpu_pct") - 50) * 2),
        "temperature": _floored(100 - _floored(_zero("avg_temperature_celsius") - 45) * 100 / 35),
        "errors": _floored(100 - (10 * _zero("warning_count") + 30 * _zero("critical_count"))),
        "throughput": F.least(F.lit(1.0), _zero("avg_downlink_throughput_mbps") / F.greatest(F.lit(0.001), expected * 1000 * 0.3)) * 100,
    }
    score = sum((parts[k] * w for k, w in WEIGHTS.items()), F.lit(0.0))
    cap = F.when(F.col("incident_active") == 1, F.when(F.col("incident_type") == "failure", 15.0).when(F.col("incident_type") == "degradation", 50.0))
    return F.least(score, cap)


def with_health(df):  # noqa: ANN001, ANN201
    """``health_score`` and ``health_category``; the category is taken before rounding, maintenance has no score."""
    resting = F.coalesce(F.col("maintenance_active"), F.lit(0)) == 1
    df = df.withColumn("__raw", raw_score())
    category = F.when(resting, "maintenance").when(F.col("__raw") < 30, "critical").when(F.col("__raw") < 60, "degraded").when(F.col("__raw") < 80, "warning").otherwise("healthy")
    return df.withColumns({"health_score": F.when(~resting, rounded(F.col("__raw"), 2, LIFT)), "health_category": category}).drop("__raw")
