"""The catalogue of reports: what each is built from, its grain, and what must not be in it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.operators import quality, reports, rollup
from stationflow.operators.reports import Tables
from stationflow.sources import lake
from stationflow.sources.scratch import staged

Checks = Callable[[list[str]], dict[str, Column]]


def no_checks(columns: list[str]) -> dict[str, Column]:
    return {}


class Inputs:
    """What reports are built from; written tables are made once, by the first report that needs them, and shared by the others."""

    def __init__(self, tables: Tables, as_of: str) -> None:
        self.lazy, self.as_of = tables, as_of

    @cached_property
    def tables(self) -> Tables:
        """Live traffic and events as written tables."""
        return Tables(staged(reports.reported_traffic(self.lazy.traffic)), self.lazy.metrics, staged(reports.reported_events(self.lazy.events)), self.lazy.stations)

    @cached_property
    def health(self) -> DataFrame:
        return staged(reports.health_hourly(self.tables))

    @cached_property
    def sla(self) -> DataFrame:
        return staged(reports.sla_compliance(self.tables, self.health))

    @cached_property
    def located(self) -> DataFrame:
        return reports.joins.lookup(self.tables.traffic, self.tables.stations, {a: a for a in reports.STATION_ATTRS})


@dataclass(frozen=True)
class Report:
    """A report: its grain (``hour`` or ``day``), the column that tells the period, how it is built, and its checks."""

    name: str
    grain: str
    period: str
    build: Callable[[Inputs], DataFrame]
    checks: Checks = no_checks


REPORTS = {
    r.name: r
    for r in (
        Report("health_hourly", "hour", "hour_start", lambda i: i.health, quality.health_checks),
        Report("anomaly_features", "hour", "hour_start", lambda i: reports.anomaly_features(i.health), quality.anomaly_checks),
        Report("traffic_hourly", "hour", "event_hour", lambda i: rollup.traffic_hourly(i.located)),
        Report("health_daily", "day", "report_date", lambda i: reports.health_daily(i.health)),
        Report("sla_compliance", "day", "report_date", lambda i: i.sla, quality.sla_checks),
        Report("region_daily", "day", "report_date", lambda i: reports.region_daily(i.health, i.sla)),
        Report("outage_report", "day", "report_date", lambda i: reports.outage_report(i.tables, i.health, i.as_of)),
        Report("maintenance_report", "day", "report_date", lambda i: reports.maintenance_report(i.tables, i.health, i.as_of)),
        Report("handover_daily", "day", "report_date", lambda i: reports.handover_daily(i.tables)),
        Report("alarm_daily", "day", "report_date", lambda i: reports.alarm_daily(i.tables, i.health)),
        Report("traffic_daily", "day", "event_date", lambda i: rollup.traffic_daily(i.located)),
        Report("operator_daily", "day", "event_date", lambda i: rollup.operator_daily(i.located)),
    )
}


def publish(spark: SparkSession, inputs: Inputs, path: str, names: list[str], lo: str | None = None, hi: str | None = None) -> DataFrame:
    """Write reports under ``path``/name, by slices of their grain from ``lo`` until before ``hi``, and tell how each went.

    ``report, grain, rows, warning, n``: a row for each check that some row failed, and one without a warning for a
    report that passed; ``empty`` is a warning too. Counts come from the job that writes the report. Publishing again replaces the same slices.
    """
    told = []
    for report in (REPORTS[n] for n in names):
        df = report.build(inputs)
        if lo is not None:
            df = df.where(F.col(report.period) >= F.lit(lo).cast("timestamp_ntz"))
        if hi is not None:
            df = df.where(F.col(report.period) < F.lit(hi).cast("timestamp_ntz"))
        seen = lake.overwrite_slice(df, f"{path}/{report.name}", report.period, report.checks(df.columns))
        rows = seen.pop("rows")
        bad = {k: n for k, n in seen.items() if n} | ({} if rows else {"empty": 1})
        told += [(report.name, report.grain, rows, w, n) for w, n in (bad or {None: 0}).items()]
    return spark.createDataFrame(told, "report string, grain string, rows long, warning string, n long")
