"""Joins of facts with dimensions, intervals and each other.

No dimension is marked for broadcast: Spark broadcasts it while its size, estimated or
measured at run time, is below its threshold, and shuffles it beyond.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationflow.functions.times import at, hour_start, shifted


def dim_station(stations: DataFrame, operators: DataFrame, locations: DataFrame) -> DataFrame:
    """Stations with the attributes of their operator and location, where known."""
    return stations.join(operators, "operator_id", "left").join(locations, "location_id", "left")


def enrich(df: DataFrame, dim: DataFrame, key: str = "station_id") -> DataFrame:
    """``df`` with the dimension's attributes and whether its key was found."""
    found = dim.withColumn("__found", F.lit(True))
    status = F.when(F.col("__found"), "matched").otherwise("station_missing")
    return df.join(found, key, "left").withColumn("dim_match_status", status).drop("__found")


def lookup(df: DataFrame, dim: DataFrame, attrs: dict[str, str], key: str = "station_id", dim_key: str = "station_id") -> DataFrame:
    """``df`` with attributes ``{new name: dimension column}``; ``''`` where the key is unknown."""
    names = dim.select(F.col(dim_key).alias("__key"), *(F.col(c).alias(f"__{n}") for n, c in attrs.items()))
    return df.join(names, F.col(key) == F.col("__key"), "left").withColumns({n: F.coalesce(f"__{n}", F.lit("")) for n in attrs}).drop("__key", *(f"__{n}" for n in attrs))


def _nth(df: DataFrame, keys: list[str], time: str, row_id: str) -> DataFrame:
    return df.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(time, row_id)))


def rank_events(events: DataFrame, keys: tuple[str, ...] = ("station_id",)) -> DataFrame:
    """Events numbered by time within their keys; ties go by event id.

    Each hour of a key is numbered by itself, from the number of events in the hours before, so that no task gets a key's
    whole history. Only the counts of hours (a calendar, whatever the number of events) are summed along a key.
    """
    dealt = events.withColumn("__hour", hour_start("event_time"))
    before = Window.partitionBy(*keys).orderBy("__hour").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(*keys, "__hour").agg(F.count("*").alias("__n")).withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    sizes = sizes.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col("__hour").alias("__h"), "__before")
    same = F.col("__hour").eqNullSafe(F.col("__h"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    local = _nth(dealt, [*keys, "__hour"], "event_time", "event_id").join(sizes, same)
    return local.withColumn("nth", (F.col("nth") + F.col("__before")).cast("int")).select(*events.columns, "nth")


def pair_by_rank(events: DataFrame, start: str, end: str) -> DataFrame:
    """Each day's nth start with the station's nth end of that day or the next.

    ``report_date`` is the start's day; an end counts for its own day and the day before.
    """
    cols = ("station_id", "report_date")
    starts = events.where(F.col("event_type") == start).withColumn("report_date", F.to_date("event_time"))
    days = F.array(F.to_date("event_time"), F.date_sub(F.to_date("event_time"), 1))
    ends = events.where(F.col("event_type") == end).withColumn("report_date", F.explode(days))
    starts = _nth(starts, [*cols], "event_time", "event_id").select(*cols, "nth", F.col("event_id").alias("start_id"), F.col("event_time").alias("started"), F.col("metadata").alias("start_meta"))
    ends = _nth(ends, [*cols], "event_time", "event_id").select(*cols, "nth", F.col("event_time").alias("ended"), F.col("metadata").alias("end_meta"))
    return starts.join(ends, [*cols, "nth"], "left").drop("nth")


def pair_next_end(events: DataFrame, start: str, end: str) -> DataFrame:
    """Each start with the station's first end after it by time and id: an as-of join as a segmented scan.

    A station's events are dealt into hours. Each hour is scanned by itself, from its last event back; an hour's first end is
    then carried back over the hours before it (one row an hour, whatever the number of events), and takes part there as one
    more event behind all others. So a station with most of the rows is spread over its hours, and rows are never joined.
    """
    marked = events.where(F.col("event_type").isin(start, end)).select("station_id", "event_id", "event_time", "metadata", (F.col("event_type") == end).alias("is_end"), hour_start("event_time").alias("slice"))
    first = F.min(F.when(F.col("is_end"), F.struct("event_time", "event_id", "metadata")))
    slices = marked.groupBy("station_id", "slice").agg(first.alias("first_end"))
    later = Window.partitionBy("station_id").orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.withColumn("e", F.last("first_end", ignorenulls=True).over(later)).where("e is not null")
    carried = carried.select("station_id", "e.event_id", "e.event_time", "e.metadata", F.lit(True).alias("is_end"), "slice")
    back = Window.partitionBy("station_id", "slice").orderBy(F.desc("event_time"), F.desc("event_id")).rowsBetween(Window.unboundedPreceding, -1)
    found = marked.unionByName(carried).withColumn("e", F.last(F.when(F.col("is_end"), F.struct("event_time", "metadata")), ignorenulls=True).over(back))
    return found.where(~F.col("is_end")).select("station_id", F.to_date("event_time").alias("report_date"), F.col("event_id").alias("start_id"), F.col("event_time").alias("started"), F.col("metadata").alias("start_meta"), F.col("e.event_time").alias("ended"), F.col("e.metadata").alias("end_meta"))


def cover_of(intervals: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """Each interval's hours as few buckets: its whole days (as ``day``), and the hours at both ends that these leave (as ``hour_start``).

    An interval makes a row for each whole day and at most 46 for hours, however long it is.
    Intervals that end before they start have none.
    """
    hour, day = F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 1 DAY")
    stop = F.coalesce("ended", at(as_of))
    lo, hi = hour_start("started"), hour_start(stop) + hour  # half-open
    first, last = F.to_date(lo + F.expr("INTERVAL 23 HOUR")).cast("timestamp_ntz"), F.to_date(hi).cast("timestamp_ntz")
    some = F.col("__first") < F.col("__last")
    spans = intervals.where(stop >= F.col("started")).withColumns({"__lo": lo, "__hi": hi, "__first": first, "__last": last})
    span = lambda a, b, step: F.when(a < b, F.sequence(a, b - step, step))
    ends = F.concat(*(F.coalesce(span(a, b, hour), F.array().cast("array<timestamp_ntz>")) for a, b in ((F.col("__lo"), F.col("__first")), (F.col("__last"), F.col("__hi")))))
    hours = F.when(some, ends).otherwise(span(F.col("__lo"), F.col("__hi"), hour))
    drop = ("__lo", "__hi", "__first", "__last")
    by_day = spans.where(some).withColumn("day", F.explode(span(F.col("__first"), F.col("__last"), day))).drop(*drop)
    return by_day, spans.withColumn("hour_start", F.explode(hours)).drop(*drop)


def interval_join(intervals: DataFrame, facts: DataFrame, as_of: str, key: str = "station_id", time: str = "event_time") -> DataFrame:
    """Facts of the interval's key within it, both ends included.

    Intervals are covered by whole days and hours, and facts are joined by key and day with the one, by key and hour with the
    other, so that no key's whole history meets its intervals and a long interval makes few rows; the exact times are tested on what is left.
    """
    inside = F.col(time).between(F.col("started"), F.coalesce("ended", at(as_of)))
    found = []
    for cover, bucket, of in zip(cover_of(intervals, as_of), ("day", "hour_start"), (F.to_date(F.col(time)).cast("timestamp_ntz"), hour_start(time)), strict=True):
        side = cover.withColumnsRenamed({bucket: "__bucket", key: "__key"})
        found.append(facts.withColumn("__at", of).join(side, (F.col(key) == F.col("__key")) & (F.col("__at") == F.col("__bucket")) & inside).drop("__at", "__bucket", "__key"))
    return found[0].unionByName(found[1])


def hour_range_join(intervals: DataFrame, hourly: DataFrame, as_of: str, key: str = "station_id") -> DataFrame:
    """Hourly rows of the interval's key from its first hour to its last, met by whole days and by the hours left at the ends."""
    by_day, by_hour = cover_of(intervals, as_of)
    days = hourly.withColumn("day", F.to_date("hour_start").cast("timestamp_ntz"))
    return by_day.join(days, [key, "day"]).drop("day").unionByName(by_hour.join(hourly, [key, "hour_start"]))


def offset_value(df: DataFrame, hourly: DataFrame, time: Column, hours: int, value: str, name: str, key: str = "station_id") -> DataFrame:
    """``df`` with the hourly value ``hours`` away from the hour of ``time``."""
    other = hourly.select(F.col(key).alias("__key"), F.col("hour_start").alias("__hour"), F.col(value).alias(name))
    return df.join(other, (F.col(key) == F.col("__key")) & (shifted(hour_start(time), hours) == F.col("__hour")), "left").drop("__key", "__hour")
