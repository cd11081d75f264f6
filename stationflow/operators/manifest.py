"""The batch manifest: what was extracted, what is still to do, and what must be done again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stationflow.functions.times import at, hour_start

PARTITION = r"year=(\d{4})/month=(\d{2})/day=(\d{2})/hour=(\d{2})"


def partition_key(time: Column) -> Column:
    """The hour partition of a time, as in the lake's paths."""
    return F.date_format(time, "'year='yyyy/'month='MM/'day='dd/'hour='HH")


def partition_hour(key: Column) -> Column:
    """The hour that a partition key stands for; null if it is none."""
    parts = [F.regexp_extract(key, PARTITION, k) for k in range(1, 5)]
    text = F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2], F.lit(" "), parts[3], F.lit(":00:00"))
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def batch_manifest(batches: DataFrame, batch: str, time: str) -> DataFrame:
    """One row for each batch: rows, hour partitions touched, watermark, and processing flags.

    ``batches`` holds the extracted rows with their ``batch`` number. Rows are counted by
    partition first, so a batch gathers partition keys, not rows.
    """
    parts = batches.groupBy(batch, partition_key(F.col(time)).alias("key")).agg(F.count("*").alias("rows"), F.min("updated_at").alias("low"), F.max("updated_at").alias("high"))
    mark = F.struct(F.min("low").alias("from_time"), F.max("high").alias("to_time"))
    return parts.groupBy(F.col(batch).alias("batch_id")).agg(
        F.sum("rows").alias("record_count"),
        F.array_sort(F.collect_list("key")).alias("data_keys"),
        mark.alias("source_watermark"),
        F.lit("success").alias("status"),
        F.lit(False).alias("is_transformed"),
        F.lit(False).alias("is_loaded"),
    )


def find_unprocessed(manifest: DataFrame, flag: str, last_n: int | None = None, since: int | None = None) -> DataFrame:
    """Batches that hold rows and whose flag is false or missing, among the ``last_n`` batches."""
    if since is not None:
        manifest = manifest.where(F.col("batch_id") >= since)
    return (last_n_rows(manifest, "batch_id", last_n) if last_n else manifest).where(~F.coalesce(F.col(flag), F.lit(False)) & (F.col("record_count") > 0))


def set_flag(manifest: DataFrame, batches: DataFrame, flag: str, value: bool) -> DataFrame:
    """The manifest with the flag of the given batches set; empty batches count as done too."""
    named = batches.select(F.col("batch_id").alias("__id")).distinct().withColumn("__named", F.lit(True))
    joined = manifest.join(named, F.col("batch_id") == F.col("__id"), "left")
    return joined.withColumn(flag, F.when(F.col("__named"), F.lit(value)).when(F.col("record_count") == 0, F.lit(True)).otherwise(F.coalesce(F.col(flag), F.lit(False)))).select(*manifest.columns)


def mark_loaded(manifest: DataFrame, batches: DataFrame, flag: str = "is_loaded") -> DataFrame:
    return set_flag(manifest, batches, flag, True)


def unmark(manifest: DataFrame, batches: DataFrame, flag: str = "is_loaded") -> DataFrame:
    return set_flag(manifest, batches, flag, False)


def unprocessed_anti(batches: DataFrame, done: DataFrame, key: str = "batch_id") -> DataFrame:
    return batches.join(done, key, "left_anti")


def affected_summary(manifest: DataFrame, flag: str, last_n: int = 720, sample: int = 5) -> DataFrame:
    """How many batches a rerun touches, their first and last hour, and some of their partitions."""
    keys = find_unprocessed(manifest, flag, last_n).select("batch_id", F.explode("data_keys").alias("key"))
    hours = keys.agg(F.count_distinct("batch_id").alias("batches"), F.min(partition_hour(F.col("key"))).alias("first_hour"), F.max(partition_hour(F.col("key"))).alias("last_hour"))
    some = sample_first(keys.select("key").distinct(), "key", sample).agg(F.array_join(F.array_sort(F.collect_list("key")), ",").alias("sample_keys"))
    return hours.join(F.broadcast(some))  # one row each


def last_n_rows(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(n)


def sample_first(df: DataFrame, order: str, n: int) -> DataFrame:
    return df.orderBy(order).limit(n)


def list_failures(failures: DataFrame, layer: str, table: str) -> DataFrame:
    return failures.where((F.col("stage") == layer) & (F.col("table") == table))


def hour_signal(df: DataFrame, time: str) -> DataFrame:
    """The distinct hour partitions that rows fall into."""
    t = F.col(time)
    return df.where(t.isNotNull()).select(F.year(t).alias("year"), F.month(t).alias("month"), F.dayofmonth(t).alias("day"), F.hour(t).alias("hour")).distinct()


def ready_hours(*feeds: DataFrame) -> DataFrame:
    """Hours that every feed has staged, null among them if all have it: each feed comes down to its hours, which are counted over the feeds.

    So only hours are shuffled. An ``intersect`` matches before it makes distinct, and would sort all rows.
    """
    first, *rest = (feed.distinct() for feed in feeds)
    for feed in rest:
        first = first.union(feed)
    return first.groupBy(*first.columns).agg(F.count("*").alias("__feeds")).where(F.col("__feeds") == len(feeds)).drop("__feeds")


def affected_days(signals: DataFrame) -> DataFrame:
    """Days that are signalled, and whether their last hour is among them."""
    day = F.make_date("year", "month", "day")
    return signals.groupBy(day.alias("day")).agg(F.bool_or(F.col("hour") == 23).alias("is_closed"), F.count("*").alias("hours"))


def recovery_periods(df: DataFrame, time: str, lookback_hours: int) -> DataFrame:
    """The hours, and their days, of the ``lookback_hours`` before the newest row's hour."""
    newest = df.agg(hour_start(F.max(time)).alias("now")).where("now is not null")
    hours = F.sequence(F.col("now") - F.make_dt_interval(hours=F.lit(lookback_hours)), F.col("now") - F.expr("INTERVAL 1 HOUR"), F.expr("INTERVAL 1 HOUR"))
    return newest.select(F.explode(hours).alias("hour_start")).withColumn("day", F.to_date("hour_start"))


def report_periods(reports: dict[str, str], periods: DataFrame) -> DataFrame:
    """Each report with each period of its grain (``hour`` or ``day``)."""
    spark = periods.sparkSession
    names = spark.createDataFrame(sorted(reports.items()), "report string, grain string")
    grains = periods.select(F.lit("hour").alias("grain"), F.col("hour_start").alias("period")).unionByName(periods.select(F.lit("day").alias("grain"), F.col("day").cast("timestamp_ntz").alias("period")).distinct())
    return grains.join(F.broadcast(names), "grain")  # the list of reports is the caller's


def recompute(reports: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]], periods: DataFrame, done: DataFrame) -> dict[str, DataFrame]:
    """For each report, its result over its periods that aren't done, in one job for all of them."""
    left = report_periods({n: grain for n, (grain, _) in reports.items()}, periods).join(done, ["report", "period"], "left_anti")
    return {name: build(left.where(F.col("report") == name).select("period")) for name, (_, build) in reports.items()}


def plan_windows(df: DataFrame, as_of: str, buffer: int = 240, overlap: int = 24, max_window: int = 3600, max_n: int = 100) -> DataFrame:
    """Extraction windows over the change times of ``df``: ``nth, from_time, nominal_from, to_time``.

    The first starts at the smallest change time. Each next one starts ``overlap`` seconds
    before the last one's end, and none reaches nearer to ``as_of`` than ``buffer``.
    """
    start = df.agg(F.min("updated_at").alias("start")).where("start is not null")
    seconds = lambda n: F.make_dt_interval(secs=n)
    stop = at(as_of) - F.make_dt_interval(secs=F.lit(buffer))
    nth = F.explode(F.sequence(F.lit(0), F.lit(max_n - 1)))
    plan = start.select("start", nth.alias("nth")).withColumn("nominal_from", F.col("start") + seconds(F.col("nth") * max_window)).where(F.col("nominal_from") < stop)
    return plan.select(
        (F.col("nth") + 1).cast("long").alias("nth"),
        (F.col("nominal_from") - seconds(F.when(F.col("nth") > 0, overlap).otherwise(0))).alias("from_time"),
        "nominal_from",
        F.least(stop, F.col("nominal_from") + F.make_dt_interval(secs=F.lit(max_window))).alias("to_time"),
    )


def windows_with_data(windows: DataFrame, df: DataFrame) -> DataFrame:
    """Windows that hold a change, found by the minutes they span, not by comparing all with all."""
    minute = lambda t: F.date_trunc("minute", t).cast("timestamp_ntz")
    changes = df.where("updated_at is not null").select(minute("updated_at").alias("__minute"), F.col("updated_at").alias("__at")).distinct()
    spans = windows.withColumn("__minute", F.explode(F.sequence(minute("from_time"), minute("to_time"), F.expr("INTERVAL 1 MINUTE"))))
    hits = spans.join(changes, "__minute").where("__at > from_time and __at <= to_time").select("nth").distinct()
    return windows.join(hits, "nth", "left_semi")


def skip_gaps(windows: DataFrame, df: DataFrame) -> DataFrame:
    """For each window without a change, the time of the next change after it (null if none): where extraction goes on.

    The next change lies in the window's last hour, or is the first of a later hour.
    """
    empty = windows.join(windows_with_data(windows, df), "nth", "left_anti").withColumn("h", hour_start("to_time"))
    times = df.where("updated_at is not null").select(hour_start("updated_at").alias("h"), F.col("updated_at").alias("t"))
    same = times.join(empty.select("nth", "to_time", "h"), "h").where("t > to_time").groupBy("nth").agg(F.min("t").alias("same_hour"))
    line = times.groupBy("h").agg(F.min("t").alias("first")).select(F.lit(None).cast("long").alias("nth"), "h", "first")
    line = line.unionByName(empty.select("nth", "h", F.lit(None).cast("timestamp_ntz").alias("first")))
    # one row for each hour and each window: a calendar, whatever the number of changes
    later = Window.orderBy(F.col("h").desc(), F.col("nth").isNull()).rowsBetween(Window.unboundedPreceding, -1)
    after = line.withColumn("later_hour", F.min("first").over(later)).where("nth is not null").select("nth", "later_hour")
    return empty.join(same, "nth", "left").join(after, "nth", "left").select("nth", "from_time", "to_time", F.least("same_hour", "later_hour").alias("next_from"))
