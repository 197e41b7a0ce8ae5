"""Lake, tables and the jobs over them."""

import glob
import os
import shutil
from datetime import datetime, timedelta, timezone
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tests.build import HOUR, NOON, stored
from tests.conftest import plan_of
from tidewatch import session
from tidewatch.operators import historical
from tidewatch.plans import batch_job, history_reads, incremental, retention, sketches
from tidewatch.schemas import HISTORY_SCHEMAS, LAKE_SCHEMA, TRAFFIC_SCHEMA
from tidewatch.sources import jdbc, lake, versions
from tidewatch.sources.tables import read_table
from tidewatch.streaming.queries import run_available

DAY = 24 * HOUR
AS_OF = datetime.fromtimestamp(NOON, timezone.utc)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "lake")


@pytest.fixture
def filled(spark, path):
    """One event per day for sixty days up to noon, user d0 being the newest."""
    events = stored(spark, *[{"user": f"d{d}", "timestamp": NOON - d * DAY, "bytes_changed": d} for d in range(60)])
    lake.write_lake(events, path, by="event_time")
    return path


def users(df):
    return sorted(int(r.user[1:]) for r in df.select("user").collect())


def test_look_back_window_and_types(spark, filled):
    week = lake.scan_lake(spark, filled, 7, AS_OF)
    assert users(week) == list(range(8))
    assert dict(week.dtypes)["timestamp"] == "timestamp"
    assert (week.first().year, week.first().month) == (2024, 1)
    later = lake.scan_lake(spark, filled, 7, AS_OF + timedelta(microseconds=1))
    assert users(later) == list(range(7))


def test_zero_days_reads_all(spark, filled):
    assert lake.scan_lake(spark, filled, 0).count() == 60


def test_cutoff_reaches_scan_and_folders(spark, filled):
    plan = plan_of(lake.scan_lake(spark, filled, 7, AS_OF, by="event_time").select("user"))
    assert f"GreaterThanOrEqual(timestamp,{NOON - 7 * DAY})" in plan
    assert ">= 202401)" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "ReadSchema: struct<timestamp:bigint,user:string>" in plan
    default = plan_of(lake.scan_lake(spark, filled).select("user"))
    assert "GreaterThanOrEqual(timestamp," in default and "PartitionFilters: []" in default


def test_an_event_stamped_after_its_archive_time_is_found(spark, path):
    early = AS_OF - timedelta(days=60)
    lake.write_lake(stored(spark, {"user": "d0", "timestamp": NOON}), path, ingest_time=early)
    assert users(lake.scan_lake(spark, path, 7, AS_OF)) == [0]


def test_a_stream_and_a_batch_job_share_a_lake(spark, path, tmp_path):
    arrived = str(tmp_path / "arrived")
    stored(spark, {"user": "d1"}).write.parquet(arrived)
    stream = spark.readStream.schema(LAKE_SCHEMA).parquet(arrived)
    run_available(lake.lake_writer(stream, path, str(tmp_path / "cp")))
    lake.write_lake(stored(spark, {"user": "d2"}), path)
    assert users(lake.scan_lake(spark, path, 0)) == [1, 2]
    assert users(lake.scan_lake(spark, path, 0, merge_schema=True)) == [1, 2]


def test_compaction_of_one_month(spark, path, tmp_path):
    target = str(tmp_path / "t")
    for when in (NOON, NOON - 40 * DAY):
        lake.write_lake(stored(spark, {"user": "d0", "timestamp": when}), path, by="event_time")
    for _ in range(2):
        lake.compact_lake(spark, path, target, 2024, 1)
    assert lake.scan_lake(spark, target, 0).count() == 1


def test_archive_partitions_by_ingest_time_and_late_events_are_found(spark, path):
    lake.write_lake(stored(spark, {"user": "d0", "timestamp": NOON}), path, ingest_time=AS_OF + timedelta(days=40))
    folders = spark.read.parquet(lake.events_path(path)).select("year", "month").first()
    assert tuple(folders) == (2024, 2)
    assert users(lake.scan_lake(spark, path, 7, AS_OF)) == [0]


def test_a_lake_that_does_not_exist_is_empty(spark, path):
    nothing = lake.scan_lake(spark, path)
    assert nothing.isEmpty()
    assert nothing.drop("year", "month").columns == LAKE_SCHEMA.fieldNames()
    assert lake.scan_lake(spark, path, merge_schema=True).isEmpty()


def test_other_read_errors_are_raised(spark, tmp_path):
    (tmp_path / "bad.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        read_table(spark, str(tmp_path / "bad.parquet"), TRAFFIC_SCHEMA).collect()


def test_older_files_with_fewer_or_narrower_columns_are_read(spark, filled):
    old = spark.sql(f"SELECT cast({NOON} AS bigint) AS timestamp, 'd99' AS user, 7 AS bytes_changed, 2024 AS year, 1 AS month")
    old.write.mode("append").partitionBy("year", "month").parquet(lake.events_path(filled))
    assert lake.scan_lake(spark, filled, 0).agg(F.sum("bytes_changed")).first()[0] == sum(range(60)) + 7
    added = stored(spark, {"user": "d98"}).withColumn("extra", F.lit("x"))
    lake.write_lake(added, filled)
    merged = lake.scan_lake(spark, filled, 0, merge_schema=False)
    assert "extra" not in merged.columns and merged.count() == 62


def test_merge_schema_takes_added_columns(spark, path):
    lake.write_lake(stored(spark, {"user": "d1"}), path, by="event_time")
    lake.write_lake(stored(spark, {"user": "d2"}).withColumn("extra", F.lit("x")), path, by="event_time")
    merged = lake.scan_lake(spark, path, 0, merge_schema=True)
    assert {r.extra for r in merged.collect()} == {None, "x"}


def test_s3_paths_use_the_hadoop_scheme():
    assert lake.events_path("s3://bucket/base/") == "s3a://bucket/base/raw_events"
    assert lake.events_path("/data") == "/data/raw_events"


def test_compaction_keeps_rows_and_makes_few_ordered_files(spark, path, tmp_path):
    for d in range(6):
        lake.write_lake(stored(spark, {"user": f"d{d}", "timestamp": NOON - d}), path, by="event_time")
    target = str(tmp_path / "compact")
    lake.compact_lake(spark, path, target)
    assert len(spark.read.parquet(lake.events_path(path)).inputFiles()) == 6
    compacted = spark.read.parquet(lake.events_path(target))
    assert len(compacted.inputFiles()) == 1
    assert [r.timestamp for r in compacted.collect()] == [NOON - d for d in range(5, -1, -1)]


def test_a_month_with_most_rows_is_split_over_tasks(spark, path):
    """The rebalance before a clustered write must not send a hot month to one task."""
    plan = plan_of(lake._clustered(lake.with_partitions(stored(spark, {}), by="event_time")))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan


# --- batch job ----------------------------------------------------------------------------


def test_batch_job_stores_all_views(spark, filled, tmp_path, rows):
    root = str(tmp_path / "history")
    counts = batch_job.run(spark, filled, batch_job.parquet_store(root), days_back=7, as_of=AS_OF)
    assert counts == {
        "events": 8,
        "historical_hourly_patterns": 8,
        "historical_hourly_trends": 8,
        "historical_top_contributors": 8,
        "historical_language_distribution": 1,
        "historical_server_rankings": 1,
    }
    events = lake.scan_lake(spark, filled, 7, AS_OF)
    for view, schema in HISTORY_SCHEMAS.items():
        table = batch_job.read_history(spark, root, view)
        assert table.columns == schema.fieldNames()
        assert rows(table) == rows(getattr(historical, view)(events))


def test_batch_job_without_events_touches_nothing(spark, path, tmp_path):
    def fail(view, table):
        raise AssertionError(table)

    assert batch_job.run(spark, path, fail) == {}


def test_batch_job_runs_again_over_its_tables(spark, filled, tmp_path):
    root = str(tmp_path / "history")
    for days in (0, 7):
        batch_job.run(spark, filled, batch_job.parquet_store(root), days, AS_OF, literal_counts=True)
    assert batch_job.read_history(spark, root, "hourly_patterns").count() == 8


def test_history_reads(spark):
    ranks = spark.range(40).selectExpr("cast(id + 1 AS int) AS rank")
    assert [r["rank"] for r in history_reads.read_servers(ranks).collect()] == list(range(1, 16))
    many = spark.range(60).selectExpr("id AS language", "id AS project", "id AS user", "true AS is_bot", "id % 9 AS edit_count")
    languages = history_reads.read_languages(many).collect()
    assert len(languages) == 20 and languages[0].language == 8
    assert history_reads.read_contributors(many).count() == 50


def test_jdbc_options():
    connect = jdbc.connection("jdbc:x:y", "d.D", user="u")
    options = jdbc.write_options(connect, "t", truncate=True, batch_size=100, connections=2)
    assert options == {
        "url": "jdbc:x:y", "driver": "d.D", "user": "u", "dbtable": "t", "truncate": "true",
        "batchsize": "100", "numPartitions": "2",
    }


# --- incremental hours --------------------------------------------------------------------


def test_incremental_hours_take_late_events_of_the_last_day(spark, path, tmp_path, rows):
    table = str(tmp_path / "hours")
    incremental.update_hours(spark, path, table)
    assert incremental.read_hours(spark, table).isEmpty()
    first = stored(spark, {"timestamp": NOON}, {"timestamp": NOON - 2 * DAY})
    lake.write_lake(first, path, by="event_time")
    incremental.update_hours(spark, path, table)
    late = stored(spark, {"timestamp": NOON - HOUR}, {"timestamp": NOON + DAY})
    lake.write_lake(late, path, by="event_time")
    for _ in range(2):
        incremental.update_hours(spark, path, table)
        hours = incremental.read_hours(spark, table)
        got = rows(hours, F.unix_seconds("hour_bucket") - (NOON - NOON % HOUR), "total_events")
        assert sorted(got) == [(-2 * DAY, 1), (-HOUR, 1), (0, 1), (DAY, 1)]


def test_incremental_hours_count_events_of_any_age_and_of_the_future(spark, path, tmp_path):
    table = str(tmp_path / "hours")
    for when in ([NOON, NOON + 30000 * DAY], [NOON - 900 * DAY, NOON + HOUR], [NOON]):
        events = stored(spark, *[{"timestamp": second} for second in when])
        lake.write_lake(events, path, by="event_time")
        incremental.update_hours(spark, path, table)
    total = incremental.read_hours(spark, table).agg(F.sum("total_events")).first()[0]
    assert total == 5


def test_incremental_hours_read_new_files_only(spark, filled, tmp_path, monkeypatch):
    table = str(tmp_path / "hours")
    incremental.update_hours(spark, filled, table)
    lake.write_lake(stored(spark, {"timestamp": NOON}), filled, by="event_time")
    read = []
    for name in ("read_files", "scan_files"):
        original = getattr(incremental, name)
        monkeypatch.setattr(incremental, name, lambda *args, f=original: read.append(args[1]) or f(*args))
    incremental.update_hours(spark, filled, table)
    incremental.update_hours(spark, filled, table)
    assert [len(paths) for paths in read] == [1]
    assert incremental.read_hours(spark, table).agg(F.sum("total_events")).first()[0] == 61


# --- incremental tables -------------------------------------------------------------------


def tables_of(spark, state, rows, **options):
    views = batch_job.views_of(incremental.rollup_rows(spark, state, **options))
    return {name: rows(view) for name, view in views.items()}


def expected_tables(spark, path, rows, days=0, as_of=None):
    events = lake.scan_lake(spark, path, days, as_of)
    return {name: rows(getattr(historical, name)(events)) for name in HISTORY_SCHEMAS}


def people(spark, first, count, step=HOUR):
    return stored(
        spark,
        *[
            {"user": f"u{n % 7}", "timestamp": NOON - n * step, "bytes_changed": n, "is_bot": [True, False, None][n % 3],
             "server_name": ["a.b.c", "d.e.f", None][n % 3], "language": ["a", "d", None][n % 3], "type": ["new", "edit"][n % 2]}
            for n in range(first, first + count)
        ],
    )


def set_time(path, seconds):
    for folder, _, names in os.walk(path):
        for name in names:
            os.utime(os.path.join(folder, name), (seconds, seconds))


def test_waves_add_up_whatever_the_age_of_their_files(spark, path, tmp_path, rows):
    state = str(tmp_path / "state")
    assert incremental.update(spark, path, state) == 0
    assert tables_of(spark, state, rows)["hourly_patterns"] == []
    lake.write_lake(people(spark, 0, 60), path, by="event_time")
    assert incremental.update(spark, path, state) == 1
    lake.write_lake(people(spark, 30, 60), path, by_day=True, ingest_time=AS_OF)
    lake.write_lake(people(spark, 200, 5), path, ingest_time=AS_OF + timedelta(days=90))
    set_time(path, 1)
    assert incremental.update(spark, path, state, most_files=2) > 1
    assert incremental.update(spark, path, state) == 0
    assert tables_of(spark, state, rows) == expected_tables(spark, path, rows)
    # The cutoff lies inside a day, whose events are read from its own files.
    for days in (1, 2, 300):
        found = tables_of(spark, state, rows, days_back=days, as_of=AS_OF + timedelta(milliseconds=1))
        assert found == expected_tables(spark, path, rows, days, AS_OF + timedelta(milliseconds=1))


def test_files_that_go_or_change_are_counted_again(spark, path, tmp_path, rows):
    state, table = str(tmp_path / "state"), str(tmp_path / "hours")
    lake.write_lake(people(spark, 0, 100), path, by_day=True)
    lake.write_lake(people(spark, 40, 100), path, by_day=True)
    incremental.update(spark, path, state)
    incremental.update_hours(spark, path, table)
    # One day loses all its files, another is compacted, a file of a third is gone.
    root = lake.events_path(path, by_day=True)
    days = sorted(glob.glob(f"{root}/*/*/event_date=*"))
    shutil.rmtree(days[0])
    one = spark.read.schema(LAKE_SCHEMA).parquet(days[1])
    one.coalesce(1).write.parquet(str(tmp_path / "one"))
    shutil.rmtree(days[1])
    shutil.copytree(tmp_path / "one", days[1])
    os.remove(sorted(glob.glob(f"{days[3]}/*.parquet"))[0])
    lake.write_lake(people(spark, 10, 5), path, by_day=True)
    assert incremental.update(spark, path, state) == 1
    assert tables_of(spark, state, rows) == expected_tables(spark, path, rows)
    incremental.update_hours(spark, path, table)
    expected = expected_tables(spark, path, rows)["hourly_patterns"]
    assert rows(incremental.read_hours(spark, table).select(*HISTORY_SCHEMAS["hourly_patterns"].fieldNames())) == expected
    assert incremental.update(spark, path, state) == 0


def test_an_interrupted_wave_does_not_count(spark, path, tmp_path, rows, monkeypatch):
    state = str(tmp_path / "state")
    lake.write_lake(people(spark, 0, 30), path)
    incremental.update(spark, path, state)
    lake.write_lake(people(spark, 30, 30), path)
    before = tables_of(spark, state, rows)
    with monkeypatch.context() as patched:
        patched.setattr(incremental, "_commit", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental.update(spark, path, state)
    assert tables_of(spark, state, rows) == before
    lake.write_lake(people(spark, 60, 30), path)
    assert incremental.update(spark, path, state) == 1
    assert tables_of(spark, state, rows) == expected_tables(spark, path, rows)


def test_days_of_many_waves_are_merged(spark, path, tmp_path, rows):
    state = str(tmp_path / "state")
    for wave in range(3):
        lake.write_lake(people(spark, 8 * wave, 9), path)
        incremental.update(spark, path, state)
        incremental._merge_days(spark, state, most_waves=1)
        assert tables_of(spark, state, rows) == expected_tables(spark, path, rows)
    lake.write_lake(people(spark, 0, 9), path)
    assert incremental.update(spark, path, state) == 1
    assert tables_of(spark, state, rows) == expected_tables(spark, path, rows)
    waves = incremental.read_partials(spark, state).groupBy("event_date").agg(F.count_distinct("wave").alias("n"))
    assert waves.agg(F.max("n")).first()[0] <= 2
    # What the first merge has passed is deleted by the second.
    assert not glob.glob(f"{state}/partials/wave=1/event_date=2024-01-15")


def test_the_job_stores_the_tables_of_the_batch_job(spark, path, tmp_path, rows):
    lake.write_lake(people(spark, 0, 90), path, by_day=True)
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    counts = batch_job.run(spark, path, batch_job.parquet_store(one), 2, AS_OF)
    state = str(tmp_path / "state")
    assert counts == incremental.store_tables(spark, path, state, batch_job.parquet_store(two), 2, AS_OF)
    for view in HISTORY_SCHEMAS:
        assert rows(batch_job.read_history(spark, one, view)) == rows(batch_job.read_history(spark, two, view))


def test_sketches_are_near_the_exact_users_and_merge(spark, path, tmp_path):
    state, table = str(tmp_path / "state"), str(tmp_path / "sketches")
    many = spark.range(30_000).selectExpr(
        f"{NOON} - id * 20 AS timestamp", "cast(id % 9000 AS string) AS user", "id % 3 AS bytes_changed"
    )
    named = many.withColumn("server_name", F.when(F.col("bytes_changed") == 0, "big").otherwise("two"))
    shaped = stored(spark).unionByName(named, allowMissingColumns=True)
    for part in ("user < '5'", "user >= '5'"):
        lake.write_lake(shaped.where(part), path, by_day=True)
        sketches.update_sketches(spark, path, state, table, most_files=5)
    sketches.update_sketches(spark, path, state, table)
    for hours in (0, 48):
        found = sketches.server_rankings(sketches.read_sketches(spark, table, hours, AS_OF)).collect()
        start = 0 if not hours else NOON - NOON % HOUR - hours * HOUR
        exact = historical.server_rankings(shaped.where(F.col("timestamp") >= start)).collect()
        assert [r.server_name for r in found] == [r.server_name for r in exact]
        for got, want in zip(found, exact):
            assert (got.edit_count, got.total_bytes) == (want.edit_count, want.total_bytes)
            assert abs(got.unique_users - want.unique_users) <= 0.03 * want.unique_users
    # A day that has lost its files has no sketches any more.
    gone = sorted(glob.glob(f"{lake.events_path(path, by_day=True)}/*/*/event_date=*"))[0]
    shutil.rmtree(gone)
    sketches.update_sketches(spark, path, state, table)
    day = os.path.basename(gone).partition("=")[2]
    assert sketches.read_sketches(spark, table).where(F.to_date("hour_bucket") == day).isEmpty()


# --- lake by day, table versions ----------------------------------------------------------


def test_a_look_back_prunes_the_days_of_a_lake_placed_by_ingest_time(spark, path):
    lake.write_lake(people(spark, 0, 400), path, by_day=True, ingest_time=AS_OF - timedelta(days=700))
    week = lake.scan_lake(spark, path, 7, AS_OF).select("user")
    partition_filters = plan_of(week).split("PartitionFilters")[1].split("PushedFilters")[0]
    assert "event_date" in partition_filters and ">= 2024-01-08" in partition_filters
    assert week.count() == 169
    assert len(week.inputFiles()) > 8  # names all files; those read are:
    read = lake.scan_lake(spark, path, 7, AS_OF).select(F.input_file_name()).distinct().count()
    assert read == 8


def test_a_lake_may_hold_both_layouts(spark, path, tmp_path):
    lake.write_lake(stored(spark, {"user": "d1"}), path)
    lake.write_lake(stored(spark, {"user": "d2"}, {"user": "d3", "timestamp": None}), path, by_day=True)
    assert users(lake.scan_lake(spark, path, 0)) == [1, 2, 3]
    assert users(lake.scan_lake(spark, path, 0, merge_schema=True)) == [1, 2, 3]
    assert users(lake.scan_lake(spark, path, 7, AS_OF)) == [1, 2]
    target = str(tmp_path / "t")
    lake.compact_lake(spark, path, target, by_day=True)
    assert users(lake.scan_lake(spark, target, 0)) == [1, 2, 3]
    assert glob.glob(f"{lake.events_path(target, by_day=True)}/year=*/month=*/event_date=2024-01-15/*.parquet")


def test_a_reader_sees_the_old_version_until_the_new_one_is_finished(spark, tmp_path):
    table, schema = str(tmp_path / "t"), "x int"
    one, two = (spark.createDataFrame([(n,)], schema) for n in (1, 2))
    assert versions.read(spark, table, one.schema).isEmpty()
    versions.replace(one, table)
    planned = versions.read(spark, table, one.schema)
    failing = two.withColumn("x", F.raise_error(F.lit("disk is full")).cast("int"))
    with pytest.raises(Exception, match="disk is full"):
        versions.replace(failing, table)
    assert versions.read(spark, table, one.schema).first().x == 1
    # A write that has not ended: files, and no mark.
    two.write.parquet(f"{table}/version=2", mode="overwrite")
    os.remove(f"{table}/version=2/_SUCCESS")
    assert versions.read(spark, table, one.schema).first().x == 1
    versions.replace(two, table)
    assert versions.read(spark, table, one.schema).first().x == 2
    assert planned.first().x == 1
    for _ in range(3):
        versions.replace(one, table)
    assert sorted(os.listdir(table)) == ["version=4", "version=5"]


def test_a_table_without_versions_is_read_as_it_is(spark, tmp_path):
    one = spark.createDataFrame([(1,)], "x int")
    one.write.parquet(str(tmp_path / "t"))
    assert versions.read(spark, str(tmp_path / "t"), one.schema).first().x == 1


# --- retention and session ----------------------------------------------------------------


def test_whole_expired_days_are_deleted(spark, tmp_path):
    table = str(tmp_path / "live")
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-10', DATE'2024-01-15')) AS event_date, 1 AS x")
    days.write.partitionBy("event_date").parquet(table)
    gone = retention.expire_days(spark, table, hours=48, as_of=AS_OF)
    assert gone == ["2024-01-10", "2024-01-11", "2024-01-12"]
    assert spark.read.parquet(table).count() == 3
    assert retention.expire_days(spark, str(tmp_path / "none")) == []


def session_of(master, shared):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: shared or default),
        sparkContext=SimpleNamespace(master=master, applicationId="app-1"),
    )


def test_work_folders_lie_below_the_shared_one():
    cluster = session_of("yarn", "hdfs:///shared/")
    one, two = session.work_dir(cluster, "x"), session.work_dir(cluster, "x")
    assert one != two and one.startswith("hdfs:///shared/tidewatch/app-1/x-")


def test_only_a_local_session_may_use_a_temporary_folder():
    alone = session_of("local[8]", None)
    roots = {session.work_dir(alone, "x").split("/tidewatch/")[0] for _ in range(2)}
    assert len(roots) == 1
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(session_of("yarn", None), "x")
