"""Incremental extraction, and the hour-partitioned parquet lake."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from stationflow.functions.times import at
from stationflow.sources.scratch import fresh_path, staged

HOUR = ("year", "month", "day", "hour")
#: Files without rows that are opened in one job, and how large one can be: a sound one holds little but its footer.
FILES_AT_ONCE, EMPTY_BYTES = 1000, 16 << 20
#: Characters of an error that are kept.
MESSAGE_CHARS = 500


def cdc_extract(df: DataFrame, lo: str, hi: str, pk: str) -> DataFrame:
    """Rows changed after ``lo`` and up to ``hi``, by change time and key. The bounds reach the scan."""
    return df.where((F.col("updated_at") > at(lo)) & (F.col("updated_at") <= at(hi))).orderBy("updated_at", pk)


def initial_watermark(df: DataFrame) -> DataFrame:
    return df.agg(F.min("updated_at").alias("watermark"))


def hour_columns(time: Column) -> dict[str, Column]:
    """Partition columns of a time."""
    return {"year": F.date_format(time, "yyyy"), "month": F.date_format(time, "MM"), "day": F.date_format(time, "dd"), "hour": F.date_format(time, "HH")}


def _place(spark: SparkSession, path: str):  # noqa: ANN202
    """A path and its file system."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def move_files(spark: SparkSession, source: str, path: str, prefix: str) -> int:
    """Move the data files of the folder ``source`` into ``path``, and tell how many there were; no row is read.

    Their names get ``prefix``, as folders of one write name their files alike. A file that is there already is an error.
    """
    (place, fs), (target, _) = _place(spark, source), _place(spark, path)
    fs.mkdirs(target)
    files = [s.getPath() for s in fs.listStatus(place) if not s.getPath().getName().startswith(("_", "."))] if fs.exists(place) else []
    for file in files:
        there = _place(spark, f"{path}/{prefix}{file.getName()}")[0]
        if fs.exists(there) or not fs.rename(file, there):
            raise OSError(f"{file.toString()} couldn't be moved to {there.toString()}")
    return len(files)


def _write_batch(df: DataFrame, path: str, batch: str, above: tuple[str, ...] = ()) -> None:
    """Write under ``above``, hours and then the batch, so that an hour's files lie together.

    A mark tells that the batch was begun before; only then the hours are searched for what it left. Rows are
    appended, as nothing of the batch is there by then.
    """
    spark = df.sparkSession
    mark, fs = _place(spark, f"{path}/_batches/{batch}")
    if fs.exists(mark):
        levels = "/".join(f"{c}=*" for c in (*above, *HOUR))
        for old in fs.globStatus(_place(spark, f"{path}/{levels}/batch={batch}")[0]) or ():
            fs.delete(old.getPath(), True)
    else:
        fs.create(mark, True).close()
    df.withColumn("batch", F.lit(batch)).write.mode("append").partitionBy(*above, *HOUR, "batch").parquet(path)


def _by_hour(df: DataFrame, time: str, fallback: str, above: tuple[str, ...] = ()) -> DataFrame:
    """Rows with their hour, rebalanced by partition: each hour has few files, and Spark splits a hot hour over several tasks."""
    when = F.coalesce(F.try_to_timestamp(F.col(time).cast("string")).cast("timestamp_ntz"), at(fallback))
    return df.withColumns(hour_columns(when)).hint("rebalance", *above, *HOUR)


def write_hourly(df: DataFrame, path: str, time: str, fallback: str, batch: str, sort: tuple[str, ...] = ()) -> None:
    """Write one batch under its event hours; rows whose time is null or can't be read go under ``fallback``.

    An hour keeps the files of every batch that touched it; writing a batch again replaces that
    batch alone, also where its rows moved to other hours.
    """
    out = _by_hour(df, time, fallback)
    _write_batch(out.sortWithinPartitions(*HOUR, *sort) if sort else out, path, batch)


def write_cutoff(df: DataFrame, path: str, cutoff: str, batch: str) -> None:
    """Write a whole batch under the hour of ``cutoff``, beside that hour's other batches."""
    _write_batch(df.withColumns(hour_columns(at(cutoff))), path, batch)


def read_partitions(spark: SparkSession, path: str, hours: list[str], schema: StructType | None = None) -> DataFrame:
    """Rows of the listed hours (``yyyy-MM-dd HH``); only their folders are listed and opened, however large the lake is.

    Without a ``schema`` it is taken from those folders, or, if none of them is there, from the lake.
    """
    names = {f"{path}/year={h[:4]}/month={h[5:7]}/day={h[8:10]}/hour={h[11:13]}" for h in hours}
    there = sorted(n for n in names for place, fs in [_place(spark, n)] if fs.exists(place))
    if not there:
        return spark.createDataFrame([], schema or hour_schema(spark, path))
    return spark.read.schema(schema or hour_schema(spark, path, there)).option("basePath", path).parquet(*there)


def hour_schema(spark: SparkSession, path: str, folders: list[str] | None = None) -> StructType:
    """The schema of the lake (or of some of its folders) with its partition columns as text, so that ``00`` stays ``00``."""
    found = (spark.read.option("basePath", path).parquet(*folders) if folders else spark.read.parquet(path)).schema
    for name in {*HOUR, "batch"} & {*found.names}:
        found[name].dataType = StringType()
    return found


def _footer_state(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Why each file's bytes are no parquet file without rows; null if they are."""
    for part in parts:
        why = []
        for content in part["content"]:
            try:
                n = pq.ParquetFile(io.BytesIO(content)).metadata.num_rows
                why.append(f"{n} rows told, none read" if n else None)
            except (pa.ArrowException, OSError, ValueError) as e:
                why.append(f"{type(e).__name__}: {e}"[:MESSAGE_CHARS])
        yield pd.DataFrame({"path": part["path"], "why": why}, dtype=object)


def _whole(schema: StructType) -> Column:
    """A hash of every column, which can't be had without decoding them all."""
    odd = lambda f: "map<" in f.dataType.simpleString() or "variant" in f.dataType.simpleString()
    return F.xxhash64(*(F.to_json(F.struct(f.name)) if odd(f) else F.col(f.name) for f in schema))


def _silent(spark: SparkSession, files: DataFrame) -> DataFrame:
    """``path, why`` of the small files that gave no row: they are opened in workers, FILES_AT_ONCE of them in a job."""
    states, names = fresh_path(spark, "footers"), []
    schema = "path string, why string"
    spark.createDataFrame([], schema).write.parquet(states)

    def look() -> None:
        contents = spark.read.format("binaryFile").load(names).select("path", "content")
        contents.mapInPandas(_footer_state, schema).write.mode("append").parquet(states)
        names.clear()

    for row in files.select("path").toLocalIterator():
        names.append(row["path"])
        if len(names) == FILES_AT_ONCE:
            look()
    if names:
        look()
    return spark.read.schema(schema).parquet(states)


def read_with_failures(spark: SparkSession, paths: list[str], stage: str, as_of: str, schema: str, batch: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows of the sound files of the listed files and folders, and a failure row for each other file.

    Failures are ``stage, batch_id, key, error_type, error_message, size_bytes, failed_at``. A file's rows are
    counted twice before any is given out: by its footer, where Spark reads no page, and by decoding every column, where
    page checksums are verified. A file that gives fewer rows than its footer tells is ``incomplete`` and gives none. One
    without a readable footer is ``unreadable``, a listed path that isn't there ``missing``. A sound file without rows is no failure.

    Files are told apart by their full paths; sizes, counts and failures are tables, and only names of small
    files without rows pass through the driver. Rows of failed files are left out by an anti-join with
    the written failures, which Spark broadcasts while they are few.
    """
    hadoop, there = spark.sparkContext._jsc.hadoopConfiguration(), []
    for p in paths:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        if place.getFileSystem(hadoop).exists(place):
            there.append(p)
    gone = spark.createDataFrame([(p,) for p in paths if p not in there], "key string").select("key", F.lit("missing").alias("error_type"), F.lit("no such path").alias("error_message"), F.lit(None).cast("long").alias("size_bytes"))

    def told(failures: DataFrame) -> DataFrame:
        return failures.select(F.lit(stage).alias("stage"), F.lit(batch).cast("string").alias("batch_id"), "key", "error_type", "error_message", "size_bytes", at(as_of).alias("failed_at"))

    if not there:
        return spark.createDataFrame([], schema), told(gone)
    only = {"pathGlobFilter": "*.parquet"}
    rows = spark.read.schema(schema).options(ignoreCorruptFiles="true", ignoreMissingFiles="true", **only, **{"parquet.page.verify-checksum.enabled": "true"}).parquet(*there)
    file = F.col("_metadata.file_path").alias("file")
    listed = spark.read.format("binaryFile").options(**only).load(there).select(file, "path", F.col("length").alias("size_bytes"))
    footers = rows.groupBy(file).agg(F.count("*").alias("told"))
    decoded = rows.select(file, _whole(rows.schema).alias("whole")).groupBy("file").agg(F.count("*").alias("decoded"), F.bit_xor("whole").alias("whole"))
    states = staged(listed.join(footers, "file", "left").join(decoded, "file", "left"))
    short = states.where(F.coalesce("decoded", F.lit(0)) < F.col("told")).withColumns({"error_type": F.lit("incomplete"), "error_message": F.concat(F.lit("read "), F.coalesce("decoded", F.lit(0)), F.lit(" of "), F.col("told"), F.lit(" rows"))})
    mute = states.where(F.col("told").isNull())
    large = mute.where(F.col("size_bytes") > EMPTY_BYTES).withColumns({"error_type": F.lit("unreadable"), "error_message": F.lit("no footer could be read")})
    small = mute.join(_silent(spark, mute.where(F.col("size_bytes") <= EMPTY_BYTES)), "path").where(F.col("why").isNotNull()).withColumns({"error_type": F.lit("unreadable"), "error_message": F.col("why")})
    cols = ("file", "path", "error_type", "error_message", "size_bytes")
    failed = staged(short.select(*cols).unionByName(large.select(*cols)).unionByName(small.select(*cols)))
    sound = rows.withColumn("__file", F.col("_metadata.file_path")).join(failed.select(F.col("file").alias("__file")), "__file", "left_anti").drop("__file")
    named = failed.select(F.regexp_replace("path", r"^[a-z0-9]+:/+", "/").alias("key"), "error_type", "error_message", "size_bytes")
    return sound, told(named.unionByName(gone))


def serialize_json(df: DataFrame, cols: list[str]) -> DataFrame:
    """Structs, maps and arrays as JSON text."""
    return df.withColumns({c: F.to_json(c) for c in cols})


def write_silver(judged: DataFrame, path: str, time: str, fallback: str, batch: str) -> dict[str, float]:
    """One batch's judged rows under ``side=valid`` and ``side=quarantine`` by event hour, in one write; how many there were, and how many invalid.

    The rows are read and judged once, and counted as they are written (in the last stage, where a task counts once
    however often others are repeated).
    """
    seen = Observation()
    sides = judged.withColumn("side", F.when(F.col("is_valid"), "valid").otherwise("quarantine"))
    out = _by_hour(sides, time, fallback, ("side",)).observe(seen, F.count("*").alias("total_rows"), F.count_if(~F.col("is_valid")).alias("invalid_rows"))
    _write_batch(out, path, batch, ("side",))
    return seen.get | {"invalid_pct": seen.get["invalid_rows"] * 100.0 / max(1, seen.get["total_rows"])}


def overwrite_slice(df: DataFrame, path: str, by: str, checks: dict[str, Column] | None = None) -> dict[str, int]:
    """Replace exactly the hours or days of ``df`` (column ``by``) in a report; running twice changes nothing.

    Rows are rebalanced by slice, so a large slice is split over several tasks. Returns the number of ``rows``, and of rows
    for which each of ``checks`` holds, counted by the same job.
    """
    seen = Observation()
    counted = {"rows": F.count("*")} | {name: F.count_if(F.coalesce(c, F.lit(False))) for name, c in (checks or {}).items()}
    out = df.withColumn("slice", F.date_format(by, "yyyy-MM-dd-HH")).hint("rebalance", "slice").observe(seen, *(c.alias(n) for n, c in counted.items()))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("slice").parquet(path)
    return seen.get


def retention(df: DataFrame, col: str, days: int, as_of: str) -> DataFrame:
    """Rows not older than ``days`` before ``as_of``; a range on the column, so that scans are pruned."""
    return df.where(F.col(col) >= at(as_of) - F.make_dt_interval(days=F.lit(days)))


def month_partition(df: DataFrame, path: str, col: str, sort: tuple[str, ...], files: int | None = None) -> None:
    """Write by month, clustered by ``sort``: the files of a month hold disjoint ranges of it, and so do their row groups.

    Ranges are cut from a sample of the rows, so files are alike in size and one hot key is split over several; a read
    of one key opens the few files whose range has it. ``files`` is how many ranges there are in all (Spark's number of shuffle partitions by default).
    """
    out = df.withColumn("month", F.date_format(col, "yyyyMM"))
    keys = ("month", *sort)
    ranged = out.repartitionByRange(files, *keys) if files else out.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)
