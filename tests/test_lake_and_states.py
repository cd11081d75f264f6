"""The lake's layout, writes that count, clustered months, mergeable distinct counts, and the catalogue's warnings."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stationflow.operators import distinct, quality
from stationflow.plans import catalogue
from stationflow.sources import lake

AS_OF = "2024-02-01 00:00:00"


def t(text):
    return dt.datetime.fromisoformat(text)


def hours(spark, n):
    return spark.range(n).select("id", (F.timestamp_seconds(F.col("id") * 1800).cast("timestamp_ntz")).alias("event_time"))


def test_reads_open_only_the_listed_hours(spark, tmp_path):
    path = f"file://{tmp_path}/lake"
    lake.write_hourly(hours(spark, 60), path, "event_time", AS_OF, "1")
    lake.write_hourly(hours(spark, 4), path, "event_time", AS_OF, "2")
    broken = next((tmp_path / "lake/year=1970/month=01/day=02/hour=05/batch=1").glob("part-*"))
    broken.write_bytes(b"no parquet")
    got = lake.read_partitions(spark, path, ["1970-01-01 00", "1970-01-01 23", "1999-01-01 00"])
    assert sorted((r.id, r.hour, r.batch) for r in got.collect()) == [(0, "00", "1"), (0, "00", "2"), (1, "00", "1"), (1, "00", "2"), (46, "23", "1"), (47, "23", "1")]
    assert {f.rsplit("/", 3)[1] for f in got.inputFiles()} <= {"hour=00", "hour=23", "batch=1", "batch=2"} and len(got.inputFiles()) <= 6
    assert lake.read_partitions(spark, path, ["1999-01-01 00"], got.schema).count() == 0


def test_silver_is_read_once_and_counted(spark, tmp_path):
    reads = spark.sparkContext.accumulator(0)

    def count(parts):
        for part in parts:
            reads.add(len(part))
            yield part

    rows = hours(spark, 40).repartition(4).mapInPandas(count, "id long, event_time timestamp_ntz").withColumn("is_valid", F.col("id") % 5 > 0)
    for batch, again in (("1", False), ("1", True)):
        seen = lake.write_silver(rows, f"file://{tmp_path}/silver", "event_time", AS_OF, batch)
        assert seen == {"total_rows": 40, "invalid_rows": 8, "invalid_pct": 20.0}
        assert reads.value == 40 * (1 + again)
    sides = {n: spark.read.parquet(f"file://{tmp_path}/silver/side={n}").count() for n in ("valid", "quarantine")}
    assert sides == {"valid": 32, "quarantine": 8}


def test_slices_count_what_checks_find(spark, tmp_path):
    rows = spark.createDataFrame([(t("2024-01-01T00:00:00"), 101.0), (t("2024-01-01T01:00:00"), None), (t("2024-01-02T00:00:00"), 7.0)], "h timestamp_ntz, uptime_pct double")
    seen = lake.overwrite_slice(rows, f"file://{tmp_path}/r", "h", quality.sla_checks(rows.columns))
    assert seen == {"rows": 3, "uptime_pct_out_of_range": 1}


def test_a_hot_station_is_split_over_files(spark, tmp_path):
    rows = spark.range(6000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(7).alias("station"), "id", F.lit(t("2024-01-05T00:00:00")).alias("at"))
    lake.month_partition(rows, f"file://{tmp_path}/m", "at", ("station", "id"), files=8)
    files = spark.read.parquet(f"file://{tmp_path}/m").groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n"), F.min(F.struct("station", "id")).alias("lo"), F.max(F.struct("station", "id")).alias("hi")).collect()
    spans = sorted((tuple(f.lo), tuple(f.hi)) for f in files)
    assert len(files) == 8 and max(f.n for f in files) < 2 * 6000 / 8
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert sum(lo[0] <= 3 <= hi[0] for lo, hi in spans) <= 2


def test_distinct_counts_merge(spark):
    rng = random.Random(6)
    rows = [(rng.randrange(5), rng.randrange(30), rng.choice([None, *(f"s{k}" for k in range(400))])) for _ in range(5000)]
    df = spark.createDataFrame(rows, "station long, hour int, imsi string").repartition(6)
    early, late = df.where("hour < 10"), df.where("hour >= 10")
    codes = distinct.dictionary(early, "imsi", "station")
    wide = distinct.extended(codes, late, "imsi", "station")
    assert wide.count() == wide.select("code").distinct().count() == len({i for *_, i in rows} - {None})
    assert codes.exceptAll(wide).count() == 0
    states = distinct.distinct_state(early, codes, "imsi", ["station", "hour"]).unionByName(distinct.distinct_state(late, wide, "imsi", ["station", "hour"]))
    got = {r.station: r.n for r in distinct.finish_distinct(distinct.merge_distinct(states, ["station"]), ["station"], "n").collect()}
    assert got == {s: len({i for x, _, i in rows if x == s} - {None}) for s in range(5)}
    by_hour = {(r.station, r.hour): r.n for r in distinct.finish_distinct(states, ["station", "hour"], "n").collect()}
    assert by_hour == {k: len({i for a, b, i in rows if (a, b) == k} - {None}) for k in {(a, b) for a, b, i in rows if i}}
    assert distinct.dictionary(df.limit(0), "imsi", "station").count() == 0


@pytest.mark.parametrize("rows", [0, 3])
def test_published_warnings(spark, tmp_path, monkeypatch, rows):
    df = spark.range(rows).select(F.lit(t("2024-01-01T00:00:00")).alias("d"), (F.col("id") * 60.0).alias("uptime_pct"))
    monkeypatch.setitem(catalogue.REPORTS, "odd", catalogue.Report("odd", "day", "d", lambda i: df, quality.sla_checks))
    told = catalogue.publish(spark, catalogue.Inputs(None, AS_OF), f"file://{tmp_path}/gold", ["odd"]).collect()
    assert [tuple(r) for r in told] == [("odd", "day", rows, "uptime_pct_out_of_range" if rows else "empty", 1)]


def test_states_of_few_values_are_small(spark):
    """A state takes some bytes for each word it has codes in, not a bitmap's four kilobytes, and is combined in place by hash."""
    df = spark.range(2000).select((F.col("id") % 500).alias("station"), F.concat(F.lit("s"), F.col("id") % 100).alias("imsi"))
    states = distinct.distinct_state(df, distinct.dictionary(df, "imsi", "station"), "imsi", ["station"])
    assert dict(states.dtypes)["bits"] == "bigint"
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    got = distinct.finish_distinct(distinct.merge_distinct(states, ["station"]), ["station"], "n")
    assert {r.n for r in got.collect()} == {1} and dict(got.dtypes)["n"] == "bigint"
