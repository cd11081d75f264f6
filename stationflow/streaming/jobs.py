"""Structured Streaming forms of extraction, validation, rollup, deduplication and pairing.

Every job runs what is there and stops (``availableNow``); its checkpoint takes the place
of the extraction watermark. Sinks made by ``foreachBatch`` write one folder for each
batch number and replace it if the batch runs again, so a retried batch counts once.
Results that supersede each other are compacted, and rows behind a watermark go to a side table.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from stationflow.operators import joins, quality, reports, rollup, versions
from stationflow.sources import lake

BUFFER = "240 seconds"


def source(spark: SparkSession, path: str, schema: StructType, files: int | None = None) -> DataFrame:
    """New parquet files of ``path`` as a stream, at most ``files`` for each batch."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def run_batches(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None], mode: str = "append") -> None:
    """Run what is there."""
    stream.writeStream.foreachBatch(step).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def batch_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``file, batch, watermark``: what each batch of a finished run read, and behind which time it left rows out (null in the first).

    Read back from the checkpoint: a batch's offset says up to which entry of the file log it read, and the
    watermark that its operators drop late rows by is the one of the batch before.
    """
    log = "struct<batchWatermarkMs:bigint,logOffset:bigint>"
    name = F.element_at(F.split(F.url_decode("_metadata.file_path"), "/"), -1)
    lines = lambda part: spark.read.text(f"{checkpoint}/{part}").select(name.alias("name"), "value").where("value like '{%'")
    offsets = lines("offsets").select(F.col("name").cast("long").alias("batch"), F.from_json("value", log).alias("o")).groupBy("batch").agg(F.max("o.batchWatermarkMs").alias("mark"), F.max("o.logOffset").alias("last"))
    order = Window.orderBy("batch")  # one row for each batch of the run's log, not for each row or file
    offsets = offsets.select("batch", F.lag("mark").over(order).alias("mark"), (F.coalesce(F.lag("last").over(order), F.lit(-1)) + 1).alias("first"), "last").where("first <= last")
    files = lines("sources/0").select(F.from_json("value", "path string, batchId bigint").alias("f")).select("f.path", F.col("f.batchId").alias("entry")).distinct()
    spread = offsets.select("batch", "mark", F.explode(F.sequence("first", "last")).alias("entry"))
    mark = F.when(F.col("mark") > 0, F.timestamp_millis("mark").cast("timestamp_ntz"))
    return files.join(spread, "entry").select(F.col("path").alias("file"), "batch", mark.alias("watermark"))


def keep_late(spark: SparkSession, schema: StructType, checkpoint: str, path: str, ready: Callable[[Column], Column]) -> int:
    """Write the rows that came behind the watermark to ``path``/batch=N, and return how many there are in all.

    ``ready`` gives the time after which the job takes a row no more. Files of batches that aren't
    in the side table yet are read once more, only where their statistics allow for late rows; a batch without any has an empty folder.
    """
    done = {int(n.removeprefix("batch=")) for n in folders(spark, path) if n.startswith("batch=")}
    found = batch_files(spark, checkpoint).where("watermark is not null")
    for row in found.groupBy("batch", "watermark").agg(F.collect_list("file").alias("files")).toLocalIterator():  # a batch's file names, as its trigger read them
        if row["batch"] not in done:
            rows = spark.read.schema(schema).parquet(*row["files"])
            rows.where(ready(F.lit(row["watermark"]).cast("timestamp_ntz"))).write.mode("overwrite").parquet(f"{path}/batch={row['batch']}")
    kept = [n for n in folders(spark, path) if n.startswith("batch=")]
    return spark.read.schema(schema).parquet(*(f"{path}/{n}" for n in kept)).count() if kept else 0


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it isn't there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(place) if s.isDirectory()] if fs.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


#: Batch folders that may stand beside the compacted ones before they are merged.
COMPACT_AFTER = 10


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """What a job has written to ``path``, with its ``batch``: the newest compacted folder and the batches after it."""
    whole, later = _parts(spark, path)
    parts = ([spark.read.parquet(f"{path}/upto={whole}")] if whole is not None else []) + [spark.read.parquet(f"{path}/batch={n}").withColumn("batch", F.lit(n).cast("long")) for n in later]
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def _parts(spark: SparkSession, path: str) -> tuple[int | None, list[int]]:
    found = [re.fullmatch(r"(upto|batch)=(\d+)", n) for n in folders(spark, path)]
    whole = max((int(m[2]) for m in found if m and m[1] == "upto"), default=None)
    return whole, sorted(int(m[2]) for m in found if m and m[1] == "batch" and (whole is None or int(m[2]) > whole))


def compact(spark: SparkSession, path: str, merge: Callable[[DataFrame], DataFrame], after: int = COMPACT_AFTER) -> None:
    """Merge batch folders into one once there are more than ``after``, so that reading costs the same however many batches ran.

    To be called when no batch is running. The merged folder is written before those it replaces are
    removed, and readers leave out what it holds: a run that is cut short in between loses and repeats nothing.
    """
    whole, later = _parts(spark, path)
    if len(later) > after:
        merge(read_batches(spark, path)).write.mode("overwrite").parquet(f"{path}/upto={later[-1]}")
        for old in [*(f"batch={n}" for n in later), *([f"upto={whole}"] if whole is not None else [])]:
            remove(spark, f"{path}/{old}")


def to_batch_folder(path: str, build: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """A step that writes ``build(rows)`` under its batch number, replacing an earlier try."""

    def step(rows: DataFrame, number: int) -> None:
        build(rows).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return step


def stream_bronze(stream: DataFrame, path: str, checkpoint: str, time: str, fallback: str) -> None:
    """Rows of new files appended under their event hours."""
    when = F.coalesce(F.col(time), F.lit(fallback).cast("timestamp_ntz"))
    stream.withColumns(lake.hour_columns(when)).writeStream.partitionBy(*lake.HOUR).format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path).awaitTermination()


def stream_silver(stream: DataFrame, stations: DataFrame, path: str, checkpoint: str, as_of: str) -> None:
    """Rows judged, joined with the station dimension and split into two sinks."""

    def step(rows: DataFrame, number: int) -> None:
        judged = joins.enrich(quality.validate_traffic(rows, as_of), stations).persist()
        for name, part in zip(("valid", "quarantine"), quality.split_valid(judged), strict=True):
            part.write.mode("overwrite").parquet(f"{path}/{name}/batch={number}")
        judged.unpersist()

    run_batches(stream, checkpoint, step)


def stream_rollup(stream: DataFrame, path: str, checkpoint: str, width: str = "1 hour", delay: str = "30 days") -> int:
    """Tumbling windows by station; each batch writes the windows it changed under ``path``/windows, and the last one counts.

    State is bounded by ``delay``. Rows whose window had left the state lie in ``path``/late; returns how many.
    ``rollup_result`` adds them, so no row is lost.
    """
    zoned = stream.withColumn("event_time", F.col("event_time").cast("timestamp")).withWatermark("event_time", delay)
    windows = zoned.groupBy(F.window("event_time", width).alias("w"), "station_id").agg(*rollup_measures())
    flat = windows.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "station_id", "session_count", "total_bytes")
    run_batches(flat, checkpoint, to_batch_folder(f"{path}/windows", lambda rows: rows), "update")
    compact(stream.sparkSession, f"{path}/windows", lambda rows: versions.latest_version(rows, WINDOW_KEYS, "batch"))
    return keep_late(stream.sparkSession, stream.schema, checkpoint, f"{path}/late", lambda mark: F.window(F.col("event_time"), width)["end"].cast("timestamp_ntz") <= mark)


WINDOW_KEYS = ["window_start", "station_id"]


def rollup_measures() -> list[Column]:
    return [F.count("*").alias("session_count"), F.sum(F.col("bytes_up") + F.col("bytes_down")).alias("total_bytes")]


def rollup_result(spark: SparkSession, path: str, schema: StructType, width: str = "1 hour") -> DataFrame:
    """The newest figures of every window, with the rows that came too late for the state."""
    newest = versions.latest_version(read_batches(spark, f"{path}/windows"), WINDOW_KEYS, "batch").drop("batch")
    late = late_rows(spark, path, schema).groupBy(F.window(F.col("event_time"), width)["start"].cast("timestamp_ntz").alias("window_start"), "station_id").agg(*rollup_measures())
    both = newest.unionByName(late)
    return both.groupBy(*WINDOW_KEYS).agg(*(F.sum(c).alias(c) for c in ("session_count", "total_bytes")))


def late_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The side table of a job's late rows; empty if none came."""
    names = [f"{path}/late/{n}" for n in folders(spark, f"{path}/late")]
    return spark.read.schema(schema).parquet(*names) if names else spark.createDataFrame([], schema)


def stream_dedup(stream: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = ("traffic_id", "updated_at"), time: str = "updated_at", delay: str = "10 minutes") -> int:
    """Each (row, version) once, although overlapping windows read some twice; under ``path``/rows.

    Windows overlap by seconds, so keys are held for minutes. Rows that came more than ``delay`` late
    lie in ``path``/late, repeats included; returns how many. ``dedup_result`` takes in those that aren't known.
    """
    zoned = stream.withColumn("__mark", F.col(time).cast("timestamp")).withWatermark("__mark", delay)
    run_batches(zoned.dropDuplicatesWithinWatermark([*keys]), checkpoint, to_batch_folder(f"{path}/rows", lambda rows: rows.drop("__mark")))
    return keep_late(stream.sparkSession, stream.schema, checkpoint, f"{path}/late", lambda mark: F.col(time) <= mark)


def dedup_result(spark: SparkSession, path: str, schema: StructType, keys: tuple[str, ...] = ("traffic_id", "updated_at")) -> DataFrame:
    """Rows in time, and late ones whose key isn't among them; late rows with a null in the key can't be known and stay."""
    rows = spark.read.schema(schema).parquet(f"{path}/rows").select(*schema.names)
    late = late_rows(spark, path, schema).dropDuplicates([*keys])
    return rows.unionByName(late.join(rows.select(*keys), [*keys], "left_anti"))


def late_data_metrics(stream: DataFrame, path: str, checkpoint: str, buffer_seconds: int = 240) -> None:
    """Delay metrics of every batch."""
    run_batches(stream, checkpoint, to_batch_folder(path, lambda rows: rollup.delay_metrics(rows, "event_time", buffer_seconds)))


def late_reopen(stream: DataFrame, path: str, checkpoint: str, build: Callable[[DataFrame], DataFrame], fallback: str) -> None:
    """Rows are kept by hour, and the report's slices of all hours that a batch touches are computed anew.

    ``build`` makes the report from rows, with the hour as ``hour_start``. Late rows so reopen
    their hour, and no other slice is written. Rows lie in ``path``/rows, the report in ``path``/report.
    """

    def step(rows: DataFrame, number: int) -> None:
        if rows.isEmpty():
            return
        lake.write_hourly(rows, f"{path}/rows", "event_time", fallback, str(number))
        hour = F.date_format(F.coalesce("event_time", F.lit(fallback).cast("timestamp_ntz")), "yyyy-MM-dd HH")
        touched = [r[0] for r in rows.select(hour).distinct().collect()]  # a name for each hour of the batch
        again = lake.read_partitions(rows.sparkSession, f"{path}/rows", touched).select(*rows.columns)
        lake.overwrite_slice(build(again), f"{path}/report", "hour_start")

    run_batches(stream, checkpoint, step)


def stream_health_daily(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Each batch of hourly health as daily states, which are merged as batches add up; ``health_result`` gives the days.

    Columns are chosen in the stream, as a batch is read with all that the stream has.
    """
    stream = stream.select("hour_start", *(k for k in reports.HEALTH_KEYS if k != "report_date"), "health_score", "health_category")
    run_batches(stream, checkpoint, to_batch_folder(path, reports.health_state))
    compact(stream.sparkSession, path, lambda rows: reports.merge_health_states(rows).withColumn("batch", F.lit(-1).cast("long")))


def health_result(spark: SparkSession, path: str) -> DataFrame:
    return reports.merge_health(read_batches(spark, path))


def stream_states(stream: DataFrame, path: str, checkpoint: str, keys: tuple[str, ...] = ("technology",)) -> None:
    """Each batch's partial states by day; merging all batches gives the daily figures. Only the columns that states take are read."""
    stream = stream.select("event_time", *keys, *rollup.STATE_COLUMNS)
    run_batches(stream, checkpoint, to_batch_folder(path, lambda rows: rollup.traffic_state(rows, F.to_date("event_time").alias("report_date"), *keys)))


PAIRS = "station_id long, start_id long, started timestamp_ntz, ended timestamp_ntz"
#: Stations are dealt into so many groups of the state, so that a call serves many of them; part of a checkpoint's meaning.
PAIR_GROUPS = 1024
#: Rows of one entry of the state.
PAIR_CHUNK = 4096
NEW = -2  # the end of a start that wasn't written yet


def next_ends(start_ids: np.ndarray, start_at: np.ndarray, end_ids: np.ndarray, end_at: np.ndarray, start_of: np.ndarray | None = None, end_of: np.ndarray | None = None) -> np.ndarray:
    """The time of the first end after each start, by time and id, among those of the same station (``start_of``, ``end_of``; one by default); -1 if there is none."""
    ids, times = np.concatenate([start_ids, end_ids]), np.concatenate([start_at, end_at])
    of = np.zeros(len(ids), np.int64) if start_of is None else np.concatenate([start_of, end_of])
    order = np.lexsort((ids, times, of))
    places = np.where(order >= len(start_ids), np.arange(len(ids)), len(ids))
    ahead = np.minimum.accumulate(places[::-1])[::-1]
    near = np.minimum(ahead, len(ids) - 1)
    hit = (ahead < len(ids)) & (of[order][near] == of[order])
    found = np.empty(len(ids), np.int64)
    found[order] = np.where(hit, times[order][near], -1)
    return found[: len(start_ids)]


def newest_of(rows: np.ndarray, keys: int) -> np.ndarray:
    """The last of the rows that share their first ``keys`` columns, ordered by these."""
    order = np.lexsort(rows[:, :keys].T[::-1])  # stable, so later rows stay behind
    rows = rows[order]
    last = np.ones(len(rows), bool)
    last[:-1] = (rows[1:, :keys] != rows[:-1, :keys]).any(axis=1)
    return rows[last]


class Packed:
    """Rows of numbers in a map state, some thousand to an entry; entries that stay the same aren't written."""

    def __init__(self, state, width: int) -> None:  # noqa: ANN001
        self.state, self.width = state, width

    def read(self) -> np.ndarray:
        self.old = {k[0]: bytes(v[0]) for k, v in self.state.iterator()}
        return np.frombuffer(b"".join(self.old[k] for k in sorted(self.old)), np.int64).reshape(-1, self.width)

    def write(self, rows: np.ndarray) -> None:
        new = {k: rows[at : at + PAIR_CHUNK].tobytes() for k, at in enumerate(range(0, len(rows), PAIR_CHUNK))}
        for k, data in new.items():
            if self.old.get(k) != data:
                self.state.updateValue((k,), (data,))
        for k in self.old.keys() - new.keys():
            self.state.removeKey((k,))


class PairEnds(StatefulProcessor):
    """Starts with their station's first end, from events of a group of stations in any order within ``delay`` (microseconds).

    ``starts`` (station, id, start, end; the end -1 while open) holds open starts however old they are, and closed ones while an
    earlier end may still come; ``ends`` (station, time, id) holds the ends before which a start may still come. They are packed,
    so that a batch makes a few calls to the state for each group, however many events it has, and a timer takes rows out once the watermark
    has passed them. A batch reads what its group holds: its open starts, and what came within the delay.
    """

    def __init__(self, delay: int) -> None:
        self.delay = delay

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.starts = Packed(handle.getMapState("starts", "chunk long", "data binary"), 4)
        self.ends = Packed(handle.getMapState("ends", "chunk long", "data binary"), 3)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        starts, ends = [self.starts.read()], [self.ends.read()]
        for part in rows:
            of, ids = part["station_id"].to_numpy(np.int64), part["event_id"].to_numpy(np.int64)
            at, is_end = part["event_time"].to_numpy("datetime64[us]").astype(np.int64), (part["event_type"] == "incident_end").to_numpy()
            starts.append(np.column_stack([of, ids, at, np.full(len(at), NEW)])[~is_end])
            ends.append(np.column_stack([of, at, ids])[is_end])
        came = np.concatenate(ends[1:]) if len(ends) > 1 else ends[0][:0]
        known, held = newest_of(np.concatenate(starts), 2), newest_of(np.concatenate(ends), 3)
        of, ids, at, old = known.T
        new = next_ends(ids, at, held[:, 2], held[:, 1], of, held[:, 0])
        new = np.where((old >= 0) & ((new < 0) | (old < new)), old, new)  # an end that left the state stays the first
        moved = np.flatnonzero(new != old)
        self.starts.write(np.column_stack([of, ids, at, new]))
        self.ends.write(held)
        if len(moved):
            yield pd.DataFrame({"station_id": of[moved], "start_id": ids[moved], "started": at[moved].astype("datetime64[us]"), "ended": np.where(new[moved] < 0, np.iinfo(np.int64).min, new[moved]).astype("datetime64[us]")})
        if len(came):  # an end leaves the state when no start before it can come, and then the starts it closed do
            self.handle.registerTimer(max((int(came[:, 1].max()) + self.delay) // 1000 + 1, timerValues.getCurrentWatermarkInMs() + 1))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N803
        past = timerValues.getCurrentWatermarkInMs() * 1000 - self.delay
        ends, starts = self.ends.read(), self.starts.read()
        self.ends.write(ends[ends[:, 1] >= past])
        self.starts.write(starts[(starts[:, 3] < 0) | (starts[:, 3] >= past)])
        return iter([])

    def close(self) -> None:
        pass


@contextmanager
def rocks_db(spark: SparkSession) -> Iterator[None]:
    """Map states and timers need the RocksDB state store; the session's choice comes back after."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stream_pair(stream: DataFrame, path: str, checkpoint: str, delay: str = "1 hour") -> int:
    """Incidents with their end, or null while they are open, from events in any order within ``delay``; under ``path``/pairs.

    An end pairs however long its incident was open; stations are dealt into ``PAIR_GROUPS`` groups, whose state holds open
    incidents and those of the last ``delay``. Every
    batch writes the incidents it opened, closed or changed; ``pair_result`` takes the last of each. Events that
    came too late lie in ``path``/late; returns how many.
    """
    spark, kinds = stream.sparkSession, ("incident_start", "incident_end")
    events = stream.where(F.col("event_type").isin(*kinds) & F.col("station_id").isNotNull())
    events = events.select(F.col("station_id").cast("long").alias("station_id"), F.col("event_id").cast("long").alias("event_id"), "event_type", F.col("event_time").cast("timestamp").alias("event_time")).withWatermark("event_time", delay)
    micros = int(pd.Timedelta(delay).total_seconds() * 1e6)
    with rocks_db(spark):
        pairs = events.withColumn("group", F.pmod(F.xxhash64("station_id"), F.lit(PAIR_GROUPS))).groupBy("group").transformWithStateInPandas(PairEnds(micros), PAIRS, "Update", "EventTime")
        run_batches(pairs, checkpoint, to_batch_folder(f"{path}/pairs", lambda rows: rows), "update")
    compact(spark, f"{path}/pairs", lambda rows: versions.latest_version(rows, ["station_id", "start_id"], "batch"))
    return keep_late(spark, stream.schema, checkpoint, f"{path}/late", lambda mark: F.col("event_type").isin(*kinds) & F.col("station_id").isNotNull() & (F.col("event_time") <= mark))


def pair_result(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of every incident."""
    return versions.latest_version(read_batches(spark, f"{path}/pairs"), ["station_id", "start_id"], "batch").drop("batch")
