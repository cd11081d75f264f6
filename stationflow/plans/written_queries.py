"""Queries that write to the shared folder, in batch or as a stream, and return what they read back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationflow.functions.times import at, hour_start
from stationflow.operators import manifest, quality, rollup, versions
from stationflow.operators import reports as rep
from stationflow.plans import catalogue
from stationflow.plans.feeds import Feeds, tidy
from stationflow.plans.oracle import AS_OF, oracle, rounded_sql
from stationflow.plans.station_queries import located
from stationflow.sources import lake
from stationflow.sources.scratch import fresh_path
from stationflow.streaming import jobs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str, doubles: str = "") -> Callable:
    """Register a function of the feeds under its name, with SQL for the same rows; ``doubles`` are rounded in both."""

    def add(fn: Callable[[Feeds], DataFrame]) -> Callable:
        QUERIES[fn.__name__] = lambda spark, sf_dir: tidy(fn(Feeds(spark, sf_dir)))
        ORACLE_SQL[fn.__name__] = oracle(rounded_sql(sql, doubles))
        return fn

    return add


BY_HOUR = "SELECT strftime(event_time, '%Y-%m-%d %H') AS part, count(*) AS n, sum(bytes_down)::BIGINT AS bytes FROM fx_traffic GROUP BY 1"


def by_part(df: DataFrame) -> DataFrame:
    part = F.concat_ws("-", *(F.col(c).cast("string") for c in ("year", "month", "day")))
    return df.groupBy(F.concat_ws(" ", part, F.col("hour").cast("string")).alias("part")).agg(F.count("*").alias("n"), F.sum("bytes_down").alias("bytes"))


def all_hours(f: Feeds, path: str) -> DataFrame:
    return f.spark.read.schema(lake.hour_schema(f.spark, path)).parquet(path)


def in_batches(df: DataFrame, write: Callable[[DataFrame, str], None]) -> None:
    """Two batches that share their hours are written, the second one twice."""
    for name, part in (("1", "traffic_id % 3 <> 0"), ("2", "traffic_id % 3 = 0"), ("2", "traffic_id % 3 = 0")):
        write(df.where(part), name)


@query(BY_HOUR)
def write_hourly(f: Feeds) -> DataFrame:
    path = fresh_path(f.spark, "hourly")
    in_batches(f.traffic, lambda part, name: lake.write_hourly(part, path, "event_time", AS_OF, name))
    return by_part(all_hours(f, path))


@query("SELECT '2024-02-01 00' AS part, count(*) AS n, sum(bytes_down)::BIGINT AS bytes FROM fx_traffic")
def write_cutoff(f: Feeds) -> DataFrame:
    path = fresh_path(f.spark, "cutoff")
    in_batches(f.traffic, lambda part, name: lake.write_cutoff(part, path, AS_OF, name))
    return by_part(all_hours(f, path))


@query(BY_HOUR.replace("GROUP BY", "WHERE strftime(event_time, '%Y-%m-%d %H') IN ('2024-01-05 10', '2024-01-05 11', '2024-01-20 23') GROUP BY"))
def read_partitions(f: Feeds) -> DataFrame:
    path = fresh_path(f.spark, "hourly")
    lake.write_hourly(f.traffic, path, "event_time", AS_OF, "1")
    return by_part(lake.read_partitions(f.spark, path, ["2024-01-05 10", "2024-01-05 11", "2024-01-20 23"]))


@query("SELECT is_valid, strftime(event_time, '%Y-%m-%d %H') AS part, count(*) AS n, sum(bytes_down)::BIGINT AS bytes, (SELECT count(*) FROM judged_traffic) AS total_rows, (SELECT count(*) FROM judged_traffic WHERE NOT is_valid) AS invalid_rows FROM judged_traffic GROUP BY 1, 2")
def write_silver(f: Feeds) -> DataFrame:
    """Valid and quarantined rows of two batches as they were written, and the counts that the writes gave."""
    path, seen = fresh_path(f.spark, "silver"), {}
    in_batches(f.judged_traffic(), lambda part, name: seen.update({name: lake.write_silver(part, path, "event_time", AS_OF, name)}))
    sides = [by_part(all_hours(f, f"{path}/side={name}")).withColumn("is_valid", F.lit(name == "valid")) for name in ("valid", "quarantine")]
    return sides[0].unionByName(sides[1]).withColumns({c: F.lit(sum(x[c] for x in seen.values())).cast("long") for c in ("total_rows", "invalid_rows")})


@query("SELECT traffic_id, updated_at, data_quality, quality_issues FROM staged_traffic")
def load_staging(f: Feeds) -> DataFrame:
    path = fresh_path(f.spark, "silver")
    lake.write_silver(f.judged_traffic(), path, "event_time", AS_OF, "1")
    rows = quality.staged_rows(*(all_hours(f, f"{path}/side={name}") for name in ("valid", "quarantine")))
    return rows.select("traffic_id", "updated_at", "data_quality", "quality_issues")


@query("SELECT event_date, n + (event_date >= DATE '2024-01-15')::INT AS n, (SELECT count(DISTINCT CAST(event_time AS DATE)) FROM fx_traffic WHERE event_time >= TIMESTAMP '2024-01-15') AS replaced, (SELECT count(DISTINCT CAST(event_time AS DATE)) FROM fx_traffic WHERE CAST(event_time AS DATE) > DATE '2024-01-20') AS after_20th FROM (SELECT CAST(event_time AS DATE) AS event_date, count(*) AS n FROM fx_traffic GROUP BY 1)")
def overwrite_slice(f: Feeds) -> DataFrame:
    """All days are written, then the later ones replaced, twice; the last job's counts beside."""
    path, seen = fresh_path(f.spark, "slices"), {}
    days = f.traffic.groupBy(F.to_date("event_time").alias("event_date")).agg(F.count("*").alias("n"))
    lake.overwrite_slice(days, path, "event_date")
    for _ in range(2):
        seen = lake.overwrite_slice(days.where("event_date >= date '2024-01-15'").withColumn("n", F.col("n") + 1), path, "event_date", {"after_20th": F.col("event_date") > F.lit("2024-01-20").cast("date")})
    return f.spark.read.parquet(path).select("event_date", "n", F.lit(seen["rows"]).cast("long").alias("replaced"), F.lit(seen["after_20th"]).cast("long").alias("after_20th"))


@query("SELECT strftime(updated_at, '%Y%m') AS month, count(*) AS n, min(traffic_id) AS low, true AS disjoint FROM all_traffic GROUP BY 1")
def month_partition(f: Feeds) -> DataFrame:
    """Months, and whether the files of each hold ranges of the sort key that don't overlap."""
    path, key = fresh_path(f.spark, "months"), ("station_id", "event_time", "traffic_id")
    lake.month_partition(f.all_traffic, path, "updated_at", key)
    rows = f.spark.read.parquet(path).withColumn("month", F.col("month").cast("string"))
    files = rows.groupBy("month", F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"), F.min("traffic_id").alias("low"), F.min(F.struct(*key)).alias("first"), F.max(F.struct(*key)).alias("last"))
    behind = F.lag("last").over(Window.partitionBy("month").orderBy("first"))
    return files.withColumn("after", F.coalesce(F.col("first") >= behind, F.lit(True))).groupBy("month").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.bool_and("after").alias("disjoint"))


PUBLISHED = {"health_hourly": ("hour", "health", "hour_start"), "health_daily": ("day", "(SELECT DISTINCT CAST(hour_start AS DATE) AS d, station_id, operator_code, region, density_class FROM health WHERE health_score IS NOT NULL)", "d"), "sla_compliance": ("day", "sla", "report_date"), "alarm_daily": ("day", "(SELECT DISTINCT CAST(event_time AS DATE) AS d, station_id FROM live_events WHERE event_type = 'alarm')", "d"), "operator_daily": ("day", "(SELECT DISTINCT CAST(event_time AS DATE) AS d, operator_code, region FROM traffic_dim)", "d")}
SINCE, UNTIL = "2024-01-10", "2024-01-25"


@query(" UNION ALL ".join(f"SELECT '{n}' AS report, '{grain}' AS grain, NULL::VARCHAR AS warning, 0::BIGINT AS n, count(*) AS rows, count(DISTINCT strftime({c}, '%Y-%m-%d-%H')) AS slices FROM {t} WHERE {c} >= TIMESTAMP '{SINCE}' AND {c} < TIMESTAMP '{UNTIL}'" for n, (grain, t, c) in PUBLISHED.items()))
def publish_reports(f: Feeds) -> DataFrame:
    """Reports of the catalogue over a range of days from one load of the feeds, published twice, and how many rows and slices lie there then."""
    path, inputs = fresh_path(f.spark, "gold"), catalogue.Inputs(f.tables(), AS_OF)
    catalogue.publish(f.spark, inputs, path, ["operator_daily"], SINCE, UNTIL)
    told = catalogue.publish(f.spark, inputs, path, [*PUBLISHED], SINCE, UNTIL)
    there = [f.spark.read.parquet(f"{path}/{n}").agg(F.lit(n).alias("report"), F.count("*").alias("there"), F.count_distinct("slice").alias("slices")) for n in PUBLISHED]
    found = there[0]
    for one in there[1:]:
        found = found.unionByName(one)
    return told.join(found, "report").where("rows = there").select("report", "grain", "warning", "n", "rows", "slices")


BROKEN = [("bad-1.parquet", "unreadable"), ("bad-2.parquet", "unreadable"), ("ab", "missing"), ("part", "incomplete"), ("part", "incomplete")]


@query("SELECT 'bronze' AS stage, 'b1' AS batch_id, name, error_type, (SELECT count(*) FROM fx_traffic WHERE traffic_id % 3 <> 2) AS n, (SELECT sum(bytes_down)::BIGINT FROM fx_traffic WHERE traffic_id % 3 <> 2) AS bytes FROM (VALUES " + ", ".join(map(str, BROKEN)) + ") AS v(name, error_type)")
def read_with_failures(f: Feeds) -> DataFrame:
    """Good, empty and corrupt files in one folder, a good folder beside a missing one whose name it continues, and files whose pages are damaged half-way."""
    path = fresh_path(f.spark, "landing")
    here, good, torn = f"{path}/mixed", f"{path}/abc", f"{path}/torn +%20"
    f.traffic.where("traffic_id % 3 = 0").write.parquet(here)
    f.traffic.where("false").write.mode("append").parquet(here)
    f.traffic.where("traffic_id % 3 = 1").write.parquet(good)
    f.traffic.where("traffic_id % 3 = 2").repartition(2).write.option("parquet.block.size", 1 << 16).parquet(torn)
    damage_files(f, torn)
    texts = fresh_path(f.spark, "texts")
    f.events.select("metadata").coalesce(1).write.text(texts)
    put_files(f, texts, [f"{here}/bad-1.parquet", f"{good}/bad-2.parquet"])
    rows, failed = lake.read_with_failures(f.spark, [here, good, f"{path}/ab", torn], "bronze", AS_OF, ", ".join(f"{c} {kind}" for c, kind in f.traffic.dtypes), "b1")
    failed = manifest.list_failures(failed.withColumn("table", F.lit("traffic")), "bronze", "traffic")
    count = rows.groupBy(F.lit("bronze").alias("stage")).agg(F.count("*").alias("n"), F.sum("bytes_down").alias("bytes"))
    name = F.regexp_replace(F.element_at(F.split("key", "/"), -1), "^part-.*", "part")
    return failed.select("stage", "batch_id", name.alias("name"), "error_type").join(count, "stage")


def damage_files(f: Feeds, folder: str) -> None:
    """Blank out some bytes in the middle of every data file of ``folder``; they stream through, file by file."""
    jvm, conf = f.spark.sparkContext._jvm, f.spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(folder)
    fs, copy = place.getFileSystem(conf), jvm.org.apache.commons.io.IOUtils.copyLarge
    for status in fs.listStatus(place):
        if status.getPath().getName().startswith("part-"):
            half, lost, whole = status.getLen() // 2, min(512, status.getLen() // 8), status.getLen()
            spare = jvm.org.apache.hadoop.fs.Path(place, "_spare")
            source, target = fs.open(status.getPath()), fs.create(spare, True)
            copy(source, target, 0, half)
            target.write(bytearray(lost))
            source.seek(half + lost)
            copy(source, target, 0, whole - half - lost)
            source.close()
            target.close()
            fs.delete(status.getPath(), False)
            fs.rename(spare, status.getPath())


def put_files(f: Feeds, folder: str, names: list[str]) -> None:
    """Copies of the one text file of ``folder`` under other names."""
    jvm, conf = f.spark.sparkContext._jvm, f.spark.sparkContext._jsc.hadoopConfiguration()
    source = jvm.org.apache.hadoop.fs.Path(folder)
    fs = source.getFileSystem(conf)
    (text,) = (s.getPath() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-"))
    for name in names:
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, text, fs, jvm.org.apache.hadoop.fs.Path(name), False, conf)


@query("SELECT station_id, hour_start, session_count, total_bytes, health_score FROM health WHERE hour_start < (SELECT date_trunc('hour', max(event_time)) FROM fx_traffic) AND hour(hour_start) % 2 = 1 AND hour_start >= (SELECT date_trunc('hour', max(event_time)) - INTERVAL 48 HOUR FROM fx_traffic)")
def recompute(f: Feeds) -> DataFrame:
    """Health of the last 48 hours, but for even hours, which count as done."""
    periods = manifest.recovery_periods(f.traffic, "event_time", 48)
    done = periods.where(F.hour("hour_start") % 2 == 0).select(F.lit("health").alias("report"), F.col("hour_start").alias("period"))
    health = rep.health_hourly(f.tables())
    build = lambda left: health.join(left, health["hour_start"] == left["period"], "left_semi")
    found = manifest.recompute({"health": ("hour", build)}, periods, done)["health"]
    return found.select("station_id", "hour_start", "session_count", "total_bytes", "health_score")


# Streams over the feed, which arrives in three parts; a job runs after each


def arrive(df: DataFrame, time: str, name: str, job: Callable[[DataFrame, str, str], None]) -> str:
    """Land ``df`` in three parts in the order of ``time`` (null: last), run ``job`` after each, and give its folder.

    ``df`` is computed and written once, with its parts apart; a part lands when its files are moved in.
    """
    spark, schema = df.sparkSession, df.schema
    path, out, mark, waiting = (fresh_path(spark, f"{name}{end}") for end in ("", "-out", "-mark", "-waiting"))
    t = F.col(time)
    part = F.when(t < at("2024-01-10 00:00:00"), 0).when(t < at("2024-01-20 00:00:00"), 1).otherwise(2)
    df.withColumn("__part", part).write.partitionBy("__part").parquet(waiting)
    for k in range(3):
        if not lake.move_files(spark, f"{waiting}/__part={k}", path, f"{k}-"):
            spark.createDataFrame([], schema).write.mode("append").parquet(path)
        job(jobs.source(spark, path, schema), out, mark)
    return out


@query(BY_HOUR)
def stream_bronze(f: Feeds) -> DataFrame:
    return by_part(all_hours(f, arrive(f.traffic, "updated_at", "bronze", lambda stream, out, mark: jobs.stream_bronze(stream, out, mark, "event_time", AS_OF))))


@query("SELECT traffic_id, updated_at, is_valid, quality_issues, region, CASE WHEN s.station_id IS NOT NULL THEN 'matched' ELSE 'station_missing' END AS dim_match_status FROM judged_traffic t LEFT JOIN fx_station s ON t.station_id = s.station_id")
def stream_silver(f: Feeds) -> DataFrame:
    out = arrive(f.all_traffic, "updated_at", "silver", lambda stream, out, mark: jobs.stream_silver(stream, f.stations, out, mark, AS_OF))
    cols = ("traffic_id", "updated_at", "is_valid", "quality_issues", "region", "dim_match_status")
    parts = [f.spark.read.parquet(f"{out}/{name}").select(*cols) for name in ("valid", "quarantine")]
    return parts[0].unionByName(parts[1])


@query("SELECT date_trunc('hour', event_time) AS window_start, station_id, count(*) AS session_count, sum(bytes_up + bytes_down)::BIGINT AS total_bytes FROM fx_traffic GROUP BY 1, 2")
def stream_hourly_rollup(f: Feeds) -> DataFrame:
    return jobs.rollup_result(f.spark, arrive(f.traffic, "updated_at", "rollup", jobs.stream_rollup), f.traffic.schema)


@query("SELECT date_trunc('day', event_time)::TIMESTAMP AS window_start, station_id, count(*) AS session_count, sum(bytes_up + bytes_down)::BIGINT AS total_bytes FROM fx_traffic GROUP BY 1, 2")
def stream_daily_rollup(f: Feeds) -> DataFrame:
    return jobs.rollup_result(f.spark, arrive(f.traffic, "updated_at", "rollup", lambda stream, out, mark: jobs.stream_rollup(stream, out, mark, "1 day")), f.traffic.schema, "1 day")


@query("SELECT date_trunc('hour', event_time) AS window_start, station_id, count(*) AS session_count, sum(bytes_up + bytes_down)::BIGINT AS total_bytes, (SELECT count(*) FROM fx_traffic WHERE event_time < TIMESTAMP '2024-01-10') > 0 AS some_late FROM fx_traffic GROUP BY 1, 2")
def stream_late_rows(f: Feeds) -> DataFrame:
    """Newest rows arrive first, so that most come behind a watermark of an hour; rows in time and late ones together are all rows."""
    backwards = f.traffic.withColumn("order", at("2024-01-31 00:00:00") - (F.col("event_time") - at("2024-01-01 00:00:00")))
    late = []
    out = arrive(backwards, "order", "backwards", lambda stream, out, mark: late.append(jobs.stream_rollup(stream, out, mark, delay="1 hour")))
    return jobs.rollup_result(f.spark, out, backwards.schema).withColumn("some_late", F.lit(late[-1] > 0))


@query("SELECT DISTINCT traffic_id, updated_at, bytes_up FROM all_traffic")
def stream_dedup(f: Feeds) -> DataFrame:
    twice = f.all_traffic.unionByName(f.all_traffic.where("traffic_id % 3 = 0"))
    return jobs.dedup_result(f.spark, arrive(twice, "updated_at", "dedup", jobs.stream_dedup), twice.schema).select("traffic_id", "updated_at", "bytes_up")


SECONDS = "(epoch_us({1}) - epoch_us({0})) / 1e6"


@query(f"""SELECT part, max({SECONDS.format('created_at', 'updated_at')}) AS max_propagation_s, quantile_cont({SECONDS.format('created_at', 'updated_at')}, 0.99) AS p99_propagation_s,
 max({SECONDS.format('event_time', 'created_at')}) AS max_offset_s, quantile_cont({SECONDS.format('event_time', 'created_at')}, 0.99) AS p99_offset_s,
 count(*) FILTER ({SECONDS.format('event_time', 'created_at')} > 240) AS late_rows, count(*) FILTER ({SECONDS.format('created_at', 'updated_at')} > 1) AS updated_rows, max(updated_at) AS max_updated_at
FROM (SELECT *, CASE WHEN updated_at < TIMESTAMP '2024-01-10' THEN 0 WHEN updated_at < TIMESTAMP '2024-01-20' THEN 1 ELSE 2 END AS part FROM all_traffic) GROUP BY 1""", "max_propagation_s p99_propagation_s max_offset_s p99_offset_s")
def late_data_metrics(f: Feeds) -> DataFrame:
    return f.spark.read.parquet(arrive(f.all_traffic, "updated_at", "late", jobs.late_data_metrics)).withColumnRenamed("batch", "part")


@query("SELECT date_trunc('hour', event_time) AS hour_start, count(*) AS session_count, sum(bytes_up + bytes_down)::BIGINT AS total_bytes FROM (SELECT *, row_number() OVER (PARTITION BY traffic_id ORDER BY updated_at DESC) AS nth FROM all_traffic) WHERE nth = 1 GROUP BY 1")
def late_reopen(f: Feeds) -> DataFrame:
    """Hourly figures of the newest versions; changes come later than the rows they change."""

    def build(rows: DataFrame) -> DataFrame:
        newest = versions.latest_version(rows, ["traffic_id"])
        return newest.groupBy(hour_start("event_time").alias("hour_start")).agg(F.count("*").alias("session_count"), F.sum(F.col("bytes_up") + F.col("bytes_down")).alias("total_bytes"))

    out = arrive(f.all_traffic, "updated_at", "reopen", lambda stream, out, mark: jobs.late_reopen(stream, out, mark, build, AS_OF))
    return f.spark.read.parquet(f"{out}/report").select("hour_start", "session_count", "total_bytes")


@query("SELECT station_id::BIGINT AS station_id, start_id, started, ended FROM incident_next")
def stream_pair(f: Feeds) -> DataFrame:
    """Events come by their change time, so not in order; open incidents come too."""
    events = f.live_events().select("station_id", "event_id", "event_type", "event_time", "updated_at")
    return jobs.pair_result(f.spark, arrive(events, "updated_at", "pair", jobs.stream_pair))


@query("SELECT CAST(hour_start AS DATE) AS report_date, station_id, operator_code, region, density_class, avg(health_score) AS avg_health_score, min(health_score) AS min_health_score, max(health_score) AS max_health_score, count(*) FILTER (health_category = 'critical') AS hours_critical, count(*) FILTER (health_category IN ('degraded', 'critical')) AS hours_degraded FROM health WHERE health_score IS NOT NULL GROUP BY ALL", "avg_health_score min_health_score max_health_score")
def stream_health_daily(f: Feeds) -> DataFrame:
    """Hourly health arrives in three parts and cascades into days."""
    return jobs.health_result(f.spark, arrive(rep.health_hourly(f.tables()), "hour_start", "health", jobs.stream_health_daily))


@query("SELECT CAST(event_time AS DATE) AS report_date, technology, count(*) AS session_count, sum(bytes_up + bytes_down)::BIGINT AS total_bytes FROM traffic_dim GROUP BY 1, 2")
def stream_states(f: Feeds) -> DataFrame:
    merged = rollup.merge_states(f.spark.read.parquet(arrive(located(f), "updated_at", "states", jobs.stream_states)), "report_date", "technology")
    return rollup.finish_states(merged, "report_date", "technology").select("report_date", "technology", "session_count", "total_bytes")
