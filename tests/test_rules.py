"""Boundaries of rules, versions, windows and pairs on rows made by hand."""

import datetime as dt
import json

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stationflow.functions.times import minutes_between
from stationflow.operators import joins, manifest, quality, reports, rollup, versions
from stationflow.plans import contract, written_queries
from stationflow.plans.feeds import Feeds
from stationflow.sources import lake
from stationflow.streaming import jobs

AS_OF = "2024-02-01 00:00:00"


def t(text):
    return dt.datetime.fromisoformat(text)


@pytest.mark.parametrize(("value", "bad"), [(0.0, False), (10_000.0, False), (10_000.1, True), (-0.1, True), (None, True)])
def test_range_rule(spark, value, bad):
    df = spark.createDataFrame([(value,)], "latency_ms double")
    assert df.select(quality.rule_range("latency_ms", 0, 10_000)).first()[0] is bad


def test_rules_are_never_null(spark):
    df = spark.createDataFrame([(None, None, None, None)], "x double, d string, a timestamp_ntz, b timestamp_ntz")
    row = df.select(quality.rule_below("x", 0), quality.rule_domain("d", ("a",)), quality.rule_future("a", AS_OF), quality.rule_order("a", "b"), quality.rule_not_empty("d")).first()
    assert list(row) == [False, True, False, False, True]


def test_future_tolerance(spark):
    df = spark.createDataFrame([(t("2024-02-01T00:05:00"),), (t("2024-02-01T00:05:01"),)], "a timestamp_ntz")
    assert [r[0] for r in df.orderBy("a").select(quality.rule_future("a", AS_OF)).collect()] == [False, True]


@pytest.mark.parametrize(("issues", "soft"), [("", False), ("jitter_invalid", True), ("jitter_invalid,latency_invalid", True), ("jitter_invalid,imsi_null", False)])
def test_recoverable(spark, issues, soft):
    assert spark.createDataFrame([(issues,)], "i string").select(quality.recoverable(F.col("i"))).first()[0] is soft


def test_split_is_lossless(spark, sf_dir):
    judged = Feeds(spark, sf_dir).judged_traffic()
    valid, bad = quality.split_valid(judged)
    assert valid.count() + bad.count() == judged.count()


def test_latest_version_ties_and_idempotence(spark):
    rows = [(1, t("2024-01-01T00:00:00"), "b"), (1, t("2024-01-01T00:00:00"), "a"), (1, None, "c"), (2, None, "d")]
    df = spark.createDataFrame(rows, "k int, updated_at timestamp_ntz, v string")
    once = versions.latest_version(df, ["k"])
    assert sorted((r.k, r.v) for r in once.collect()) == [(1, "a"), (2, "d")]
    assert once.exceptAll(versions.latest_version(once, ["k"])).count() == 0


def test_correction_wins_ties(spark):
    base = spark.createDataFrame([(1, t("2024-01-01T00:00:00"), "old")], "k int, updated_at timestamp_ntz, v string")
    new = base.withColumn("v", F.lit("new"))
    assert versions.apply_corrections(base, new, ["k"]).first()["v"] == "new"


def test_windows_tile_time(spark, sf_dir):
    rows = manifest.plan_windows(Feeds(spark, sf_dir).traffic, AS_OF, max_n=50).orderBy("nth").collect()
    for a, b in zip(rows, rows[1:], strict=False):
        assert a.to_time == b.nominal_from
        assert (a.to_time - b.from_time).total_seconds() == 24


def test_minutes_are_boundaries(spark):
    df = spark.createDataFrame([(t("2024-01-01T00:00:59"), t("2024-01-01T00:02:00"))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(minutes_between(F.col("a"), F.col("b")), minutes_between(F.col("b"), F.col("a"))).first()[:] == (2, -2)


def events(spark, *rows):
    return spark.createDataFrame([(1, i, t(at), kind, "{}") for i, (at, kind) in enumerate(rows)], "station_id long, event_id long, event_time timestamp_ntz, event_type string, metadata string")


def test_pairs_by_rank_and_next_end_differ(spark):
    e = events(spark, ("2024-01-01T01:00:00", "incident_end"), ("2024-01-01T02:00:00", "incident_start"), ("2024-01-01T03:00:00", "incident_end"))
    assert joins.pair_by_rank(e, "incident_start", "incident_end").first()["ended"] == t("2024-01-01T01:00:00")
    assert joins.pair_next_end(e, "incident_start", "incident_end").first()["ended"] == t("2024-01-01T03:00:00")


def covered(spark, *rows):
    days, hours = joins.cover_of(spark.createDataFrame([(1, a and t(a), b and t(b)) for a, b in rows], "station_id long, started timestamp_ntz, ended timestamp_ntz"), AS_OF)
    return [r.day for r in days.orderBy("day").collect()], [r.hour_start for r in hours.orderBy("hour_start").collect()]


def test_reversed_and_open_intervals(spark):
    days, hours = covered(spark, ("2024-01-01T05:00:00", "2024-01-01T04:00:00"), ("2024-01-31T22:30:00", None))
    assert not days and [h.hour for h in hours] == [22, 23, 0]


@pytest.mark.parametrize(("start", "end"), [("2024-01-01T00:00:00", "2024-01-01T23:10:00"), ("2024-01-01T00:59:00", "2024-01-02T00:00:00"), ("2024-01-01T01:00:00", "2024-01-03T22:00:00"), ("2024-01-01T03:30:00", "2024-03-01T07:00:00"), ("2024-01-05T12:00:00", "2024-01-05T12:00:00")])
def test_covers_are_exact_and_small(spark, start, end):
    days, hours = covered(spark, (start, end))
    first, last = t(start).replace(minute=0), t(end).replace(minute=0)
    want = [first + dt.timedelta(hours=k) for k in range(int((last - first).total_seconds()) // 3600 + 1)]
    assert sorted(hours + [d + dt.timedelta(hours=k) for d in days for k in range(24)]) == want
    assert len(days) + len(hours) < 110 and len(hours) <= 46


def test_interval_joins_against_loops(spark):
    rng = np.random.default_rng(5)
    base = t("2024-01-01T00:00:00")
    when = lambda: base + dt.timedelta(minutes=int(rng.integers(0, 8000)))
    facts = [(int(rng.integers(0, 2)), k, when()) for k in range(500)]
    spans = [(int(rng.integers(0, 2)), k, a := when(), None if k % 9 == 0 else a + dt.timedelta(minutes=int(rng.integers(-60, 5000)))) for k in range(40)]
    i = spark.createDataFrame(spans, "station_id long, start_id long, started timestamp_ntz, ended timestamp_ntz")
    f = spark.createDataFrame(facts, "station_id long, fact_id long, event_time timestamp_ntz")
    stop = lambda e: e or t("2024-02-01T00:00:00")
    want = sorted((s, k) for st, s, a, e in spans for ft, k, x in facts if st == ft and a <= x <= stop(e))
    assert sorted((r.start_id, r.fact_id) for r in joins.interval_join(i, f, AS_OF).collect()) == want
    hourly = f.select("station_id", F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("hour_start"), "fact_id")
    hour = lambda x: x.replace(minute=0)
    want = sorted((s, k) for st, s, a, e in spans for ft, k, x in facts if st == ft and stop(e) >= a and hour(a) <= hour(x) <= hour(stop(e)))
    assert sorted((r.start_id, r.fact_id) for r in joins.hour_range_join(i, hourly, AS_OF).collect()) == want


def test_next_end_and_rank_against_loops(spark):
    """Stations with many events in an hour, ends days later, equal times, and events without a station or a time."""
    rng = np.random.default_rng(8)
    base = t("2024-01-01T00:00:00")
    rows = []
    for k in range(600):
        station = None if k % 50 == 0 else int(rng.integers(0, 3))
        minute = int(rng.choice([0, 1, 30, 59, 60, 61, 3000, 9000, int(rng.integers(0, 12_000))]))
        rows.append((station, k, None if k % 97 == 0 else base + dt.timedelta(minutes=minute), str(rng.choice(["s", "s", "s", "e", "x"])), f"m{k}"))
    df = spark.createDataFrame(rows, "station_id long, event_id long, event_time timestamp_ntz, event_type string, metadata string").repartition(5)
    at = lambda r: (r[2] is not None, r[2] or base, r[1])
    want = {}
    for r in rows:
        if r[3] == "s":
            ends = sorted((x for x in rows if x[3] == "e" and x[0] == r[0] and at(x) > at(r)), key=at)
            want[r[1]] = (ends[0][2], ends[0][4]) if ends else (None, None)
    assert {r.start_id: (r.ended, r.end_meta) for r in joins.pair_next_end(df, "s", "e").collect()} == want
    ranks = {r[1]: 1 + sum(x[0] == r[0] and at(x) < at(r) for x in rows) for r in rows}
    got = joins.rank_events(df)
    assert got.columns == [*df.columns, "nth"] and {r.event_id: r.nth for r in got.collect()} == ranks


def test_a_hot_station_is_spread(spark):
    """All rows of one station: the scan's tasks by far outnumber the stations."""
    rows = spark.range(20_000).select(F.lit(1).alias("station_id"), F.col("id").alias("event_id"), (F.timestamp_seconds(F.col("id") * 180).cast("timestamp_ntz")).alias("event_time"), F.when(F.col("id") % 50 == 7, "e").otherwise("s").alias("event_type"), F.lit("").alias("metadata"))
    found = joins.pair_next_end(rows, "s", "e").withColumn("task", F.spark_partition_id())
    sizes = [r["count"] for r in found.groupBy("task").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 0.6 * sum(sizes)


def test_scd2(spark):
    history = spark.createDataFrame([(1, "a", t("2024-01-01T00:00:00"), None, True)], "k int, v string, effective_from timestamp_ntz, effective_to timestamp_ntz, is_current boolean")
    changes = spark.createDataFrame([(1, "b", t("2024-01-02T00:00:00")), (2, "c", t("2024-01-02T00:00:00"))], "k int, v string, effective_from timestamp_ntz")
    rows = versions.scd2_apply(history, changes, ["k"]).orderBy("k", "effective_from").collect()
    assert [(r.k, r.v, r.is_current, r.effective_to is None) for r in rows] == [(1, "a", False, False), (1, "b", True, True), (2, "c", True, True)]


def test_load_dim_stamps_changes(spark):
    old = spark.createDataFrame([(1, "a", t("2024-01-01T00:00:00")), (2, "b", t("2024-01-01T00:00:00"))], "k int, v string, updated_at timestamp_ntz")
    new = spark.createDataFrame([(1, "a", None), (2, "z", None), (3, "c", None)], "k int, v string, updated_at timestamp_ntz")
    rows = versions.load_dim(new, old, "k", F.lit(AS_OF).cast("timestamp_ntz")).orderBy("k").collect()
    assert [r.updated_at.month for r in rows] == [1, 2, 2]


def test_merge_json(spark):
    df = spark.createDataFrame([('{"a":1,"b":"x"}', '{"b":null,"c":true}'), (None, '{"q":"say \\"hi\\""}'), ('{"a\\"b":1,"c\\\\d":[1]}', '{"é\\n":{"x":"y"}}')], "a string, b string")
    got = [r[0] for r in df.select(versions.merge_json(F.col("a"), F.col("b"))).collect()]
    assert got[1] == '{"q":"say \\"hi\\""}'
    assert '"c":true' in got[0] and '"a":1' in got[0]
    assert json.loads(got[2]) == {'a"b': 1, "c\\d": [1], "é\n": {"x": "y"}}


def test_values_that_move_to_a_null_column_are_changes(spark):
    schema = "k int, a string, b string"
    old = spark.createDataFrame([(1, "x", None), (2, None, None), (3, "x", "y")], schema)
    new = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, "x", "y")], schema)
    assert [tuple(r) for r in versions.changed_rows(new, old, "k").collect()] == [(1, "changed")]
    stamped = versions.load_dim(new, old.withColumn("updated_at", F.expr("timestamp_ntz '2024-01-01 00:00:00'")), "k", F.lit(AS_OF).cast("timestamp_ntz"))
    assert {r.k: r.updated_at.month for r in stamped.collect()} == {1: 2, 2: 1, 3: 1}


def test_daily_health_by_category(spark):
    """A score that shows the threshold but lies below it, and a day of maintenance alone."""
    rows = [("2024-01-01T00:00:00", 30.0, "critical"), ("2024-01-01T01:00:00", 60.0, "degraded"), ("2024-01-01T02:00:00", None, "maintenance"), ("2024-01-02T00:00:00", None, "maintenance")]
    health = spark.createDataFrame([(t(h), 1, "o", "r", "d", s, c) for h, s, c in rows], "hour_start timestamp_ntz, station_id long, operator_code string, region string, density_class string, health_score double, health_category string")
    want = [(dt.date(2024, 1, 1), 45.0, 30.0, 60.0, 1, 2)]
    for found in (reports.health_daily(health), reports.merge_health(reports.health_state(health))):
        assert [(r.report_date, r.avg_health_score, r.min_health_score, r.max_health_score, r.hours_critical, r.hours_degraded) for r in found.collect()] == want


def test_drift_and_reconcile(spark):
    df = spark.createDataFrame([(1, 2, t("2024-01-01T00:00:00"), t("2024-01-01T00:00:00"), "x")], "event_id int, station_id int, event_time timestamp_ntz, updated_at timestamp_ntz, extra string")
    drift = contract.detect_drift(df, contract.EVENTS)
    assert drift.new == ["extra"] and not drift.breaking and "severity" in drift.missing_expected and "metadata" in drift.missing_passthrough
    fit = contract.reconcile(df, contract.EVENTS)
    assert fit.columns[-1] == "extra" and dict(fit.dtypes)["event_id"] == "bigint" and fit.first()["severity"] is None
    with pytest.raises(ValueError, match="missing required"):
        contract.reconcile(df.drop("station_id"), contract.EVENTS)


def test_contract_accessors():
    assert contract.TRAFFIC.soft_labels() == ["latency_invalid", "jitter_invalid", "pkt_loss_invalid", "duration_invalid"]
    assert contract.canonical("numeric(10,2)") == "decimal(38,2)" and contract.canonical("varchar(64)") == "string"
    assert contract.METRICS.schema()["metric_time"].dataType.simpleString() == "timestamp_ntz"


def test_dimension_off_the_map(spark):
    df = spark.createDataFrame([("a", "4G", "active", 21.0, 105.8), ("a", "9G", "gone", 48.0, 2.3)], "station_code string, technology string, status string, latitude double, longitude double")
    assert {r.warning: r.n for r in quality.check_dimension(df).collect()} == {"unknown_technology": 1, "unknown_status": 1, "off_the_map": 1, "duplicate_code": 1}


def test_unparsable_times_are_null(spark):
    df = quality.normalize_time(spark.createDataFrame([("2024-01-01 07:00:00",), ("soon",), (None,)], "e string"), "e", "Asia/Ho_Chi_Minh")
    assert [r[0] for r in df.collect()] == [t("2024-01-01T00:00:00"), None, None]


def test_json_text_purge_and_decimals(spark):
    from stationflow.sources import lake

    df = spark.sql("select 1 as k, named_struct('a', 1) as s, cast(1.5 as decimal(6,2)) as d union all select 2, null, null")
    got = {r.k: r.s for r in lake.serialize_json(df, ["s"]).collect()}
    assert got == {1: '{"a":1}', 2: None}
    assert dict(contract.widen_decimals(df).dtypes)["d"] == "decimal(38,2)"
    assert [r.k for r in versions.purge(df, df.where("k = 1"), "k").collect()] == [2]


def test_late_time_goes_to_the_fallback_hour(spark):
    from stationflow.sources import lake
    from stationflow.sources.scratch import fresh_path

    path = fresh_path(spark, "late")
    rows = spark.createDataFrame([(1, "2024-01-01 05:30:00"), (2, None), (3, "soon")], "k int, e string")
    lake.write_hourly(rows, path, "e", AS_OF, "1")
    assert sorted(r.k for r in lake.read_partitions(spark, path, ["2024-02-01 00"]).collect()) == [2, 3]
    assert [r.k for r in lake.read_partitions(spark, path, ["2024-01-01 05"]).collect()] == [1]


@pytest.mark.parametrize(("source", "kind"), [("bool", "boolean"), ("numeric(10,2)", "decimal(38,2)"), ("numeric(10)", "decimal(38,0)"), ("numeric", None), ("timestamp", None), ("uuid", None), ("varchar(9)", "string")])
def test_canonical_types(source, kind):
    assert contract.canonical(source) == kind


def test_bare_numerics_keep_their_fraction(spark):
    fields = (contract.Field("a", "numeric", "required"), contract.Field("b", "bool", "required"), contract.Field("c", "uuid", "passthrough"))
    odd = contract.Contract("odd", "a", "a", fields)
    row = contract.reconcile(spark.sql("select 1.25 as a, 'true' as b"), odd).first()
    assert (str(row.a), row.b, row.c) == ("1.25", True, None)
    assert odd.schema().simpleString() == "struct<a:decimal(38,18),b:boolean,c:string>"


def test_batches_of_one_hour_stay(spark, tmp_path):
    path = f"file://{tmp_path}/lake"
    rows = spark.sql("select id, timestamp_ntz '2024-01-01 05:10:00' as event_time from range(4)")
    lake.write_hourly(rows.where("id < 2"), path, "event_time", AS_OF, "1")
    lake.write_hourly(rows.where("id >= 2"), path, "event_time", AS_OF, "2")
    moved = rows.where("id >= 2").withColumn("event_time", F.expr("timestamp_ntz '2024-01-02 00:00:00'"))
    lake.write_hourly(moved, path, "event_time", AS_OF, "2")  # a retry whose rows moved
    got = {(r.id, r.day, r.batch) for r in spark.read.schema(lake.hour_schema(spark, path)).parquet(path).collect()}
    assert got == {(0, "01", "1"), (1, "01", "1"), (2, "02", "2"), (3, "02", "2")}


def test_pairs_in_any_order_and_open_ones(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "COMPACT_AFTER", 2)
    schema = "station_id long, event_id long, event_type string, event_time timestamp_ntz"
    batches = [
        [(1, 1, "incident_start", t("2024-01-01T10:00:00")), (1, 9, "incident_end", t("2024-01-01T10:50:00")), (2, 2, "incident_start", t("2024-01-01T10:00:00"))],
        [(1, 4, "incident_end", t("2024-01-01T10:20:00")), (1, 3, "incident_start", t("2024-01-01T10:30:00"))],  # before what came first
        [(3, 5, "incident_start", t("2024-01-03T10:00:00"))],
        [(1, 6, "incident_start", t("2024-01-01T10:40:00")), (1, 7, "incident_start", t("2024-01-03T10:00:00"))],  # the first comes too late
        [(2, 8, "incident_end", t("2024-06-01T00:00:00"))],  # after five months
    ]
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        late = jobs.stream_pair(jobs.source(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema), f"{tmp_path}/out", f"{tmp_path}/mark")
    got = {(r.start_id, r.ended) for r in jobs.pair_result(spark, f"{tmp_path}/out").collect()}
    assert got == {(1, t("2024-01-01T10:20:00")), (3, t("2024-01-01T10:50:00")), (2, t("2024-06-01T00:00:00")), (5, None), (7, None)}
    assert late == 1 and [r.event_id for r in jobs.late_rows(spark, f"{tmp_path}/out", spark.createDataFrame([], schema).schema).collect()] == [6]


def test_pairs_of_many_batches_against_loops(spark, tmp_path):
    """Events shuffled within the delay over batches give the pairs of the sorted whole."""
    rng = np.random.default_rng(2)
    base = t("2024-01-01T00:00:00")
    schema = "station_id long, event_id long, event_type string, event_time timestamp_ntz"
    rows = [(int(rng.integers(0, 3)), k, str(rng.choice(["incident_start", "incident_end"], p=[0.7, 0.3])), base + dt.timedelta(minutes=int(m))) for k, m in enumerate(np.sort(rng.integers(0, 3000, 150)))]
    order = np.argsort(np.arange(150) + rng.integers(0, 4, 150), kind="stable")
    for part in np.array_split(order, 6):
        spark.createDataFrame([rows[k] for k in part], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        late = jobs.stream_pair(jobs.source(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema), f"{tmp_path}/out", f"{tmp_path}/mark", "5 hours")
    want = {}
    for s, k, kind, at in rows:
        if kind == "incident_start":
            want[k] = min((x[3] for x in rows if x[2] == "incident_end" and x[0] == s and (x[3], x[1]) > (at, k)), default=None)
    assert late == 0
    assert {r.start_id: r.ended for r in jobs.pair_result(spark, f"{tmp_path}/out").collect()} == want


def test_next_ends_against_loops():
    rng = np.random.default_rng(1)
    for _ in range(50):
        n, m = rng.integers(0, 8, 2)
        start_at, end_at = rng.integers(0, 9, n), rng.integers(0, 9, m)
        ids = rng.permutation(n + m)
        want = [min((e for i, e in zip(ids[n:], end_at, strict=True) if (e, i) > (s, k)), default=-1) for k, s in zip(ids[:n], start_at, strict=True)]
        assert jobs.next_ends(ids[:n], start_at, ids[n:], end_at).tolist() == want


def test_too_late_rows_are_kept(spark, tmp_path):
    schema = "traffic_id long, updated_at timestamp_ntz"
    kind = spark.createDataFrame([], schema).schema
    for k, when in enumerate(("2024-01-02T00:00:00", "2024-01-03T00:00:00", "2024-01-01T00:00:00", "2024-01-01T00:00:00", "2024-01-05T00:00:00")):
        spark.createDataFrame([(k, t(when)), (0, t("2024-01-02T00:00:00"))], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        late = jobs.stream_dedup(jobs.source(spark, f"{tmp_path}/in", kind), f"{tmp_path}/out", f"{tmp_path}/mark")
    assert late == 5  # two of 2024-01-01, and three repeats of the first row
    assert sorted(r.traffic_id for r in jobs.dedup_result(spark, f"{tmp_path}/out", kind).collect()) == [0, 1, 2, 3, 4]


def test_results_stay_few_files(spark, tmp_path):
    """Reading costs the same after many batches, and a compaction that is cut short changes nothing."""
    path = f"{tmp_path}/out"
    for n in range(25):
        spark.createDataFrame([(n % 4, n)], "k long, v long").write.parquet(f"{path}/batch={n}")
        jobs.compact(spark, path, lambda rows: versions.latest_version(rows, ["k"], "batch"), after=5)
        assert len(jobs.folders(spark, path)) <= 6
    want = {0: 24, 1: 21, 2: 22, 3: 23}
    newest = lambda: {r.k: r.v for r in versions.latest_version(jobs.read_batches(spark, path), ["k"], "batch").collect()}
    assert newest() == want
    spark.createDataFrame([(0, -1)], "k long, v long").write.parquet(f"{path}/batch=3")  # left behind by a cut compaction
    assert newest() == want


def test_half_read_files_give_nothing(spark, tmp_path):
    """A file of many row groups whose later pages are damaged, a file that was cut off, an empty one and a sound one, in an odd folder."""
    folder = tmp_path / "in +%20é"
    rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.create_map(F.lit("k"), "id").alias("m"))
    for part, where in (("torn", "id < 40000"), ("cut", "id >= 40000 and id < 50000"), ("empty", "false"), ("sound", "id >= 50000")):
        rows.where(where).coalesce(1).write.option("parquet.block.size", 1 << 18).parquet(f"file://{tmp_path}/{part}")
    folder.mkdir()
    for part in ("torn", "cut", "empty", "sound"):
        (data,) = (tmp_path / part).glob("part-*.parquet")
        content = bytearray(data.read_bytes())
        if part == "torn":
            content[len(content) * 2 // 3 : len(content) * 2 // 3 + 200] = bytes(200)
        (folder / f"{part}.parquet").write_bytes(content[: len(content) // 2] if part == "cut" else content)
    assert 0 < spark.read.option("ignoreCorruptFiles", "true").parquet(str(folder / "torn.parquet")).where("text is not null").count() < 40_000
    good, failed = lake.read_with_failures(spark, [str(folder), f"{tmp_path}/nowhere"], "silver", AS_OF, "id long, text string, m map<string,bigint>", "b7")
    got = {r.key.split("/")[-1]: r for r in failed.collect()}
    assert {k: r.error_type for k, r in got.items()} == {"torn.parquet": "incomplete", "cut.parquet": "unreadable", "nowhere": "missing"}
    assert got["torn.parquet"].error_message.endswith(" of 40000 rows") and got["cut.parquet"].error_message and got["cut.parquet"].size_bytes == (folder / "cut.parquet").stat().st_size
    assert {(r.stage, r.batch_id) for r in got.values()} == {("silver", "b7")} and got["torn.parquet"].key == str(folder / "torn.parquet")
    assert good.count() == 10_000 == good.where("text is not null").count() and good.columns == ["id", "text", "m"]
    assert lake.read_with_failures(spark, [f"{tmp_path}/nowhere"], "silver", AS_OF, "id long")[0].count() == 0


def test_sketches_of_small_groups_are_close(spark):
    """20,000 groups of 15 values: in some of them two values share a register of a plain sketch, which then tells 14."""
    df = spark.range(300_000).select((F.col("id") / 15).cast("long").alias("g"), "id")
    told = df.groupBy("g").agg(rollup.approx_distinct("id").alias("n"), F.approx_count_distinct("id", 0.01).alias("plain"))
    row = told.agg(F.count_if(F.abs(F.col("n") - 15) > 0.03 * 15).alias("off"), F.count_if(F.abs(F.col("plain") - 15) > 0.05 * 15).alias("plain_off")).first()
    assert row.off == 0 and row.plain_off > 0
    assert abs(df.agg(rollup.approx_distinct("id")).first()[0] - 300_000) <= 0.03 * 300_000


def test_feeds_come_down_to_hours_before_they_meet(spark):
    """Rows are combined by hash before any shuffle, and none is matched or sorted; an hour repeated in one feed counts once, null as an hour."""
    hour = F.timestamp_seconds(F.col("id") % 30 * 3600).cast("timestamp_ntz").alias("hour")
    nothing = spark.range(2).select(F.lit(None).cast("timestamp_ntz").alias("hour"))
    feeds = [spark.range(3000).where(f"id % 30 < {k}").select(hour).union(nothing) for k in (30, 20, 25)]
    ready = manifest.ready_hours(*feeds)
    assert sorted((r.hour.hour if r.hour else -1) for r in ready.collect()) == list(range(-1, 20))
    assert manifest.ready_hours(feeds[0], feeds[1], feeds[1].limit(0)).count() == 0
    plan = ready._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan


def scans(df):
    return df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")


def test_traffic_is_staged_in_one_look(spark, sf_dir):
    """Valid and recoverable rows come from one scan of the rows and one of the changes, and are those of both sides."""
    f = Feeds(spark, sf_dir)
    once, sides = f.staged_traffic(), quality.staged_rows(*quality.split_valid(f.judged_traffic()))
    assert once.columns == sides.columns and once.count() == sides.count() and once.exceptAll(sides).isEmpty()
    assert scans(once) == 2 and scans(f.live_traffic()) == 2


def test_feeds_of_hourly_health_are_dealt_once(spark, sf_dir):
    """Each feed is shuffled once, by station and hour, and sorted by its versions once; what follows works where the rows lie."""
    tables = Feeds(spark, sf_dir).tables()
    for name, hourly in (("traffic", reports.health_hourly(tables)), ("metrics", reports.metrics_hourly(tables.metrics)), ("events", reports.events_hourly(tables.events))):
        plan = hourly._jdf.queryExecution().executedPlan().toString()
        dealt = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line and "hour_start" in line]
        assert len(dealt) == (3 if name == "traffic" else 1), plan
        assert all("REPARTITION_BY_COL" in line for line in dealt)
        assert sum("Sort [" in line and "updated_at" in line for line in plan.split("\n")) == len(dealt)


def test_daily_health_stream_reads_the_columns_it_takes(spark, tmp_path):
    """Parts of one write land whole although their files are named alike, and a batch reads no column beside those of the states."""
    rows = spark.range(90).select((F.col("id") % 3).alias("station_id"), F.expr("timestamp_ntz '2024-01-05 00:00:00' + make_dt_interval(0, CAST(id AS INT) * 7)").alias("hour_start"), *(F.lit("x").alias(c) for c in ("operator_code", "region", "density_class", "beside")), F.col("id").cast("double").alias("health_score"), F.lit("healthy").alias("health_category")).coalesce(1)
    seen, state = [], reports.health_state
    reports.health_state = lambda batch: seen.append(batch.columns) or state(batch)
    try:
        out = written_queries.arrive(rows, "hour_start", "daily", jobs.stream_health_daily)
    finally:
        reports.health_state = state
    found = jobs.health_result(spark, out)
    assert found.exceptAll(reports.health_daily(rows)).isEmpty() and found.count() == reports.health_daily(rows).count()
    assert seen and all("beside" not in columns for columns in seen)


def test_reports_of_health_read_raw_events_once(spark, sf_dir):
    """Pairs are made of written events, not of raw ones that are judged again for either side."""
    tables, _ = Feeds(spark, sf_dir).report_tables()
    assert all("events.parquet" not in name for name in tables.events.inputFiles())


def test_rows_land_from_one_computation(spark):
    """Three parts land, but the rows behind them are computed once."""
    reads, landed = spark.sparkContext.accumulator(0), []

    def count(parts):
        for part in parts:
            reads.add(len(part))
            yield part

    rows = spark.range(30).select("id", F.expr("timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(CAST(id AS INT))").alias("at"))
    rows = rows.repartition(2).mapInPandas(count, "id long, at timestamp_ntz")
    written_queries.arrive(rows, "at", "once", lambda stream, out, mark: jobs.run_batches(stream, mark, lambda part, number: landed.append(part.count())))
    assert reads.value == 30 and sum(landed) == 30 and len([n for n in landed if n]) == 3


class CountedState:
    """A map state that counts the calls made to it."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def iterator(self):
        self.calls += 1
        return iter([(k, v) for k, v in self.held.items()])

    def keys(self):
        self.calls += 1
        return iter([*self.held])

    def updateValue(self, key, value):  # noqa: N802
        self.calls += 1
        self.held[key] = value

    def removeKey(self, key):  # noqa: N802
        self.calls += 1
        self.held.pop(key)


def test_pairing_calls_the_state_for_groups_not_for_events():
    """20,000 events of 50 stations in two batches take some calls, and what has passed leaves the state."""
    states, rng, hour = {}, np.random.default_rng(5), 3_600_000_000

    class Handle:
        getMapState = staticmethod(lambda name, *_: states.setdefault(name, CountedState()))  # noqa: N815
        registerTimer = staticmethod(lambda at: None)  # noqa: N815

    class Clock:
        now = 0
        getCurrentWatermarkInMs = classmethod(lambda cls: cls.now)  # noqa: N815

    pairs, got = jobs.PairEnds(hour), {}
    pairs.init(Handle)
    at = np.sort(rng.integers(0, 200 * hour, 20_000))
    rows = pd.DataFrame({"station_id": rng.integers(0, 50, 20_000), "event_id": np.arange(20_000), "event_type": rng.choice(["incident_start", "incident_end"], 20_000), "event_time": at.astype("datetime64[us]")})
    for half in (rows[:10_000], rows[10_000:]):
        for out in pairs.handleInputRows((0,), iter([half[:4000], half[4000:]]), Clock):
            got |= dict(zip(out["start_id"], out["ended"], strict=True))
        Clock.now = int(half["event_time"].max().value // 1_000_000) - hour // 1000
        pairs.handleExpiredTimer((0,), Clock, None)
    want = {}
    for _, one in rows.groupby("station_id"):
        ahead = pd.NaT
        for row in one[::-1].itertuples():
            if row.event_type == "incident_end":
                ahead = row.event_time
            else:
                want[row.event_id] = ahead
    assert got.keys() == want.keys() and all(got[k] == v or (pd.isna(got[k]) and pd.isna(v)) for k, v in want.items())
    assert sum(s.calls for s in states.values()) < 50
    assert sum(len(v[0]) for v in states["ends"].held.values()) // 24 < 400
