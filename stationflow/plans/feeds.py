"""The feeds as queries read them: judged, staged and live rows of one table folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.functions.numbers import LIFT, rounded
from stationflow.functions.times import hour_start
from stationflow.operators import quality, versions
from stationflow.operators.reports import HOUR, Tables, health_hourly, reported_events
from stationflow.sources.fixtures import AS_OF, load
from stationflow.sources.scratch import staged


class Feeds:
    """Fixture feeds over ``sf_dir``; frames are lazy and built once."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.stations, self.traffic, self.changes, self.metrics, self.events = load(spark, sf_dir, "fx_station", "fx_traffic", "fx_traffic_changes", "fx_metrics", "fx_events")
        self.all_traffic = self.traffic.unionByName(self.changes)

    def judged_traffic(self) -> DataFrame:
        return quality.validate_traffic(self.all_traffic, AS_OF)

    def judged_metrics(self) -> DataFrame:
        return quality.validate_metrics(self.metrics)

    def judged_events(self) -> DataFrame:
        return quality.validate_events(self.events, AS_OF)

    def staged_traffic(self) -> DataFrame:
        return quality.staged_at_once(self.all_traffic, quality.traffic_rules(self.all_traffic, AS_OF))

    def live_traffic(self) -> DataFrame:
        return self.tables().traffic.drop(HOUR)

    def live_metrics(self) -> DataFrame:
        return self.tables().metrics.drop(HOUR)

    def live_events(self) -> DataFrame:
        return self.tables().events.drop(HOUR)

    def tables(self) -> Tables:
        """The live feeds as plans, for a report that reads each once; each is dealt by station and hour, which it has as a column."""
        traffic = newest_live(self.staged_traffic(), "event_time", "traffic_id")
        metrics = newest_live(quality.split_valid(self.judged_metrics())[0], "metric_time", "metric_id")
        events = newest_live(quality.split_valid(self.judged_events())[0], "event_time", "event_id")
        return Tables(traffic, metrics, events, self.stations)

    def report_tables(self) -> tuple[Tables, DataFrame]:
        """The live feeds as plans, but events, which health and pairs read, and hourly health as written tables: for reports of health."""
        lazy = self.tables()
        tables = Tables(lazy.traffic, lazy.metrics, staged(reported_events(lazy.events)), self.stations)
        return tables, staged(health_hourly(tables))

    def outage_tables(self) -> tuple[Tables, DataFrame]:
        """Live traffic and events as written tables too, for the report that meets intervals with raw traffic."""
        lazy = self.tables()
        tables = Tables(staged(lazy.traffic.select("station_id", "event_time", "imsi_hash", "bytes_up", "bytes_down", "latency_ms", "packet_loss_pct")), lazy.metrics, staged(reported_events(lazy.events)), self.stations)
        return tables, staged(health_hourly(tables))


def newest_live(rows: DataFrame, time: str, row_id: str) -> DataFrame:
    """The newest version of each row, unless it is marked as deleted. Rows meet by station and hour, as most reports take them."""
    hours = rows.withColumn(HOUR, hour_start(time))
    return versions.live_rows(versions.latest_version(hours, ["station_id", time, row_id], follow=quality.JUDGEMENT, near=("station_id", HOUR)))


def tidy(df: DataFrame, digits: int = 4, exact: tuple[str, ...] = ()) -> DataFrame:
    """Doubles rounded off exact halves, so that sums taken in another order give the same row."""
    pick = lambda c, kind: rounded(F.col(c), digits, LIFT).alias(c) if kind == "double" and c not in exact else F.col(c)
    cols: list[Column] = [pick(c, kind) for c, kind in df.dtypes]
    return df.select(*cols)
