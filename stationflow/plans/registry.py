"""All station queries by name, and the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from stationflow.plans import station_queries, written_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = station_queries.QUERIES | written_queries.QUERIES
ORACLE_SQL: dict[str, str] = station_queries.ORACLE_SQL | written_queries.ORACLE_SQL
