"""The historical tables kept up to date from what is new in the lake.

A state folder holds, per wave (one run over new files):

* ``partials``: the rollup of the batch job per day of events, from that wave's files alone. Rows of
  several waves, and of several days, merge by addition.
* ``ledger``: the files that were counted, with their size and the days they have events of. A file
  is new if it is not in the ledger under its size, however old it is or looks.
* ``replaced``: days that the wave counted from all their files, because a file of theirs has gone or
  changed, as compaction does. What earlier waves hold of them is left out.

A mark, written last, makes a wave count; an interrupted one is overwritten by the next run. A run
reads the new files, and nothing else of the lake unless files have gone.
"""

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, LongType

from tidewatch.functions import clock
from tidewatch.operators import rollup
from tidewatch.operators.historical import hourly_patterns_of
from tidewatch.plans import batch_job
from tidewatch.schemas import FLAG, HISTORY_SCHEMAS, LONG, TEXT, TIME, extended, struct
from tidewatch.sources import files
from tidewatch.sources.lake import FILE, list_files, read_files, scan_files
from tidewatch.sources.tables import materialised, read_table

PARTITION = "event_date"
WAVE = "wave"
# Files that one wave takes; a larger backlog is worked off in several.
MOST_FILES = 10_000
# A day that more waves have added to is merged into one.
MOST_WAVES = 24
DAY_SECONDS = 24 * 3600

FILES = "files"
GRAINS = {name: [PARTITION, *keys] for name, keys in [*rollup.GRAINS.items(), (FILES, [FILE])]}
_KEYS = {
    "hour_bucket": TIME, "user": TEXT, "is_bot": FLAG, "language": TEXT, "project": TEXT,
    "server_name": TEXT, FILE: TEXT,
}
PARTIALS = struct({"grain": TEXT, **_KEYS, **{name: LONG for name in rollup.MEASURES}})
LEDGER = struct({FILE: TEXT, "path": TEXT, "size": LONG, PARTITION: DateType(), "gone": FLAG})
REPLACED = struct({PARTITION: DateType()})


def _part(state: str, name: str) -> str:
    return f"{state.rstrip('/')}/{name}"


def _wave(state: str, name: str, wave: int) -> str:
    return f"{_part(state, name)}/{WAVE}={wave}"


def last_wave(spark: SparkSession, state: str) -> int:
    """The last wave that counts, 0 for none."""
    return marked(spark, _part(state, "marks"))


def _read(spark: SparkSession, state: str, name: str, schema, **places) -> DataFrame:
    rows = read_table(spark, _part(state, name), schema, {WAVE: LongType(), **places})
    return rows.where(F.col(WAVE) <= last_wave(spark, state))


def read_ledger(spark: SparkSession, state: str) -> DataFrame:
    """``file, path, size, event_date``: the files that are counted, a row per day they hold."""
    log = _read(spark, state, "ledger", LEDGER)
    latest = log.groupBy(F.col(FILE).alias("_file")).agg(F.max(WAVE).alias("_wave"))
    current = log.join(latest, (F.col(FILE) == F.col("_file")) & (F.col(WAVE) == F.col("_wave")))
    return current.where("NOT gone").select(FILE, "path", "size", PARTITION)


def read_partials(spark: SparkSession, state: str, since: date | None = None) -> DataFrame:
    """Rollup rows per day, wave and grain, of the days from ``since`` on."""
    rows = _read(spark, state, "partials", PARTIALS, **{PARTITION: DateType()})
    if since is not None:
        rows = rows.where(F.col(PARTITION) >= F.lit(since))
    if not files.names(spark, _part(state, "replaced")):
        return rows
    bases = _read(spark, state, "replaced", REPLACED).groupBy(F.col(PARTITION).alias("_day"))
    bases = bases.agg(F.max(WAVE).alias("_base"))
    based = rows.join(bases, F.col(PARTITION).eqNullSafe(F.col("_day")), "left")
    return based.where(F.coalesce("_base", F.lit(0)) <= F.col(WAVE)).drop("_day", "_base")


# --- taking in new files ------------------------------------------------------------------


def update(spark: SparkSession, lake: str, state: str, most_files: int = MOST_FILES) -> int:
    """Count what is new in the lake; the number of waves it took, 0 if nothing has changed."""
    waves, taken = 0, most_files
    while taken == most_files:
        taken = _update_once(spark, lake, state, most_files)
        if taken is None:
            break
        waves += 1
        if last_wave(spark, state) % MOST_WAVES == 0:
            _merge_days(spark, state)
    return waves


def _update_once(spark: SparkSession, lake: str, state: str, most_files: int) -> int | None:
    """One wave; how many files it took, or None if there was nothing to do."""
    known = read_ledger(spark, state)
    same = [FILE, "size"]
    with materialised(list_files(spark, lake), "lake-files") as listed:
        new = listed.join(known, same, "left_anti").limit(most_files)
        with materialised(new, "new-files") as new, materialised(
            known.join(listed, same, "left_anti"), "gone-files"
        ) as gone:
            paths = [row.path for row in new.select("path").collect()]
            lost = not gone.isEmpty()
            if not paths and not lost:
                return None
            wave = last_wave(spark, state) + 1
            if lost:
                days = gone.select(PARTITION).distinct()
                left = known.join(gone, same, "left_anti").select(FILE).distinct()
                events = _again(spark, lake, left, new, days)
            else:
                days, events = None, read_files(spark, paths)
            _write_partials(events, state, wave)
            counted = read_table(
                spark, _wave(state, "partials", wave), PARTIALS, {PARTITION: DateType()}
            )
            held = counted.where(F.col("grain") == FILES).select(FILE, PARTITION).distinct()
            added = new.join(held, FILE, "left").withColumn("gone", F.lit(False))
            dropped = gone.join(new, FILE, "left_anti").withColumn("gone", F.lit(True))
            ledger = added.unionByName(dropped).select(*LEDGER.fieldNames())
            _commit(spark, state, wave, ledger, days)
    return len(paths)


def _again(
    spark: SparkSession, lake: str, left: DataFrame, new: DataFrame, days: DataFrame
) -> DataFrame:
    """The events of the new files, and those of ``days`` in the files that are left."""
    unknown = F.count_if(F.col(PARTITION).isNull())
    first, last, nulls = days.agg(F.min(PARTITION), F.max(PARTITION), unknown).first()
    bounds = (None, None) if nulls else (_second(first), _second(last) + DAY_SECONDS)
    old = scan_files(spark, lake, *bounds).join(left, FILE, "left_semi")
    day = F.to_date("timestamp")
    old = old.join(days, day.eqNullSafe(days[PARTITION]), "left_semi")
    paths = [row.path for row in new.select("path").collect()]
    return read_files(spark, paths).unionByName(old.drop("year", "month"))


def _write_partials(events: DataFrame, state: str, wave: int) -> None:
    rows = rollup.rollup_all(events.withColumn(PARTITION, F.to_date("timestamp")), GRAINS)
    _write_days(rows, state, wave)


def _write_days(rows: DataFrame, state: str, wave: int) -> None:
    (
        rows.select(*PARTIALS.fieldNames(), PARTITION)
        .hint("rebalance", PARTITION)
        .sortWithinPartitions(PARTITION, "grain")
        .write.mode("overwrite")
        .partitionBy(PARTITION)
        .parquet(_wave(state, "partials", wave))
    )


def _commit(
    spark: SparkSession, state: str, wave: int, ledger: DataFrame, replaced: DataFrame | None
) -> None:
    ledger.write.mode("overwrite").parquet(_wave(state, "ledger", wave))
    if replaced is None:
        # What an interrupted run may have left.
        files.delete(spark, _wave(state, "replaced", wave))
    else:
        replaced.select(PARTITION).coalesce(1).write.mode("overwrite").parquet(
            _wave(state, "replaced", wave)
        )
    set_mark(spark, _part(state, "marks"), wave)


def _merge_days(spark: SparkSession, state: str, most_waves: int = MOST_WAVES) -> None:
    """Merge the days that many waves have added to, in a wave without files. What they are merged
    from stays for readers until the next merge and is deleted then."""
    rows = read_partials(spark, state)
    waves = rows.groupBy(PARTITION).agg(F.count_distinct(WAVE).alias("waves"))
    with materialised(waves.where(F.col("waves") > most_waves).drop("waves"), "merged-days") as days:
        if days.isEmpty():
            return
        before = _read(spark, state, "replaced", REPLACED).collect()
        wave = last_wave(spark, state) + 1
        merged = rows.join(days, rows[PARTITION].eqNullSafe(days[PARTITION]), "left_semi")
        keys = [PARTITION, "grain", *_KEYS]
        _write_days(rollup.roll_up(merged, keys), state, wave)
        _commit(spark, state, wave, spark.createDataFrame([], LEDGER), days)
        _clean(spark, state, {row[PARTITION]: row[WAVE] for row in sorted(before, key=lambda r: r[WAVE])})


def _clean(spark: SparkSession, state: str, bases: dict[date | None, int]) -> None:
    """Delete the folders of days that an older merge, or a count of a whole day, has passed."""
    passed = {day_folder(day): base for day, base in bases.items()}
    for held in files.names(spark, _part(state, "partials")):
        wave = int(held.partition("=")[2])
        for day in files.names(spark, _wave(state, "partials", wave)):
            if wave < passed.get(day, 0):
                files.delete(spark, f"{_wave(state, 'partials', wave)}/{day}")


def day_folder(day: date | None) -> str:
    return f"{PARTITION}={day or '__HIVE_DEFAULT_PARTITION__'}"


def _second(day: date) -> int:
    return (day - date(1970, 1, 1)).days * DAY_SECONDS


# --- the tables ---------------------------------------------------------------------------


def rollup_rows(
    spark: SparkSession, state: str, days_back: int = 0, as_of: clock.AsOf = None
) -> DataFrame:
    """Rollup rows, as ``rollup.rollup_all`` gives them for the events of the look-back. Whole days
    come from the partials; only the files of the first day, which the cutoff divides, are read."""
    columns = ["grain", *rollup_keys(), *rollup.MEASURES]
    counted = F.col("grain") != FILES
    if days_back <= 0:
        rows = read_partials(spark, state).where(counted).select(*columns)
    else:
        cutoff = _whole_second(spark, clock.days_before(as_of, days_back))
        first = datetime.fromtimestamp(cutoff, timezone.utc).date()
        rest = date.fromordinal(first.toordinal() + 1)
        holding = read_ledger(spark, state).where(F.col(PARTITION) == F.lit(first))
        paths = [row.path for row in holding.select("path").distinct().collect()]
        divided = read_files(spark, paths).where(
            (F.col("timestamp") >= F.timestamp_seconds(F.lit(cutoff)))
            & (F.col("timestamp") < F.timestamp_seconds(F.lit(_second(rest))))
        )
        whole = read_partials(spark, state, since=rest).where(counted).select(*columns)
        rows = whole.unionByName(rollup.rollup_all(divided).select(*columns))
    # Keys that are not of a row's grain are null, so one grouping merges all grains.
    return rollup.roll_up(rows, columns[: 1 + len(rollup_keys())])


def rollup_keys() -> list[str]:
    return list(dict.fromkeys(key for keys in rollup.GRAINS.values() for key in keys))


def _whole_second(spark: SparkSession, moment: Column) -> int:
    """The first whole second that is not before ``moment``."""
    later = moment + F.expr("INTERVAL '0.999999' SECOND")
    return spark.range(1).select(F.unix_seconds(later)).first()[0]


def store_tables(
    spark: SparkSession,
    lake: str,
    state: str,
    store: batch_job.Store,
    days_back: int = 7,
    as_of: clock.AsOf = None,
    literal_counts: bool = False,
) -> dict[str, int]:
    """What ``batch_job.run`` stores, without reading the lake again: the five tables of the
    look-back from the partials, brought up to date before."""
    update(spark, lake, state)
    return batch_job.store_rows(rollup_rows(spark, state, days_back, as_of), store, literal_counts)


def read_hours(spark: SparkSession, table: str) -> DataFrame:
    return read_table(
        spark, table, HISTORY_SCHEMAS["hourly_patterns"], {PARTITION: DateType()}
    ).drop(PARTITION)


def state_path(table: str) -> str:
    return f"{table.rstrip('/')}_state"


def update_hours(spark: SparkSession, lake: str, table: str) -> None:
    """Bring a table of hourly patterns, by day, up to date with the files of the lake.

    The days that a wave since the table's own mark has added to or replaced are taken from the
    partials and replace their folders; a repeated run changes nothing, and a lost mark only means
    that every day is written again.
    """
    state = state_path(table)
    update(spark, lake, state)
    mark = f"{state}/hours_mark"
    done, last = marked(spark, mark), last_wave(spark, state)
    if done == last:
        return
    touched = touched_days(spark, state, done)
    with _days(touched) as (days, listed):
        hours = rollup.grain_rows(_of_days(read_partials(spark, state), days), "hours")
        patterns = hourly_patterns_of(rollup.roll_up(hours, rollup.HOURS))
        with materialised(patterns.withColumn(PARTITION, F.to_date("hour_bucket")), "hours") as rows:
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                PARTITION
            ).parquet(table)
            left = {row[0] for row in rows.select(PARTITION).distinct().collect()}
        for day in listed - left:
            files.delete(spark, f"{table}/{day_folder(day)}")
    set_mark(spark, mark, last)


def marked(spark: SparkSession, mark: str) -> int:
    """The last wave that a table derived from the partials or files has taken up."""
    names = [name for name in files.names(spark, mark) if files.finished(spark, f"{mark}/{name}")]
    return max((int(name.partition("=")[2]) for name in names), default=0)


def set_mark(spark: SparkSession, mark: str, wave: int) -> None:
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{mark}/{WAVE}={wave}")


def touched_days(spark: SparkSession, state: str, done: int) -> DataFrame:
    """The days that the waves after ``done`` have added to or replaced."""
    added = _read(spark, state, "partials", PARTIALS, **{PARTITION: DateType()})
    replaced = _read(spark, state, "replaced", REPLACED)
    days = added.select(WAVE, PARTITION).unionByName(replaced.select(WAVE, PARTITION))
    return days.where(F.col(WAVE) > done).select(PARTITION).distinct()


@contextmanager
def _days(touched: DataFrame) -> Iterator[tuple[DataFrame, set[date | None]]]:
    with materialised(touched, "touched-days") as days:
        yield days, {row[0] for row in days.collect()}


def _of_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    return rows.join(days, rows[PARTITION].eqNullSafe(days[PARTITION]), "left_semi")
