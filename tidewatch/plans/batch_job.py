"""Lake -> five historical tables, reading the lake once."""

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewatch.functions import clock
from tidewatch.operators import historical, rollup
from tidewatch.schemas import HISTORY_SCHEMAS, history_table
from tidewatch.sources import jdbc, versions
from tidewatch.sources.lake import scan_lake
from tidewatch.sources.tables import materialised

# Stores a view under a table name, replacing what was there, and returns its row count.
Store = Callable[[DataFrame, str], int]


def parquet_store(root: str) -> Store:
    def store(view: DataFrame, table: str) -> int:
        written = Observation()
        counted = view.observe(written, F.count(F.lit(1)).alias("rows"))
        versions.replace(counted, f"{root.rstrip('/')}/{table}")
        return written.get["rows"]

    return store


def jdbc_store(connect: dict, truncate: bool = False, **options: int) -> Store:
    def store(view: DataFrame, table: str) -> int:
        return jdbc.overwrite(view, jdbc.write_options(connect, table, truncate, **options))

    return store


def read_history(spark: SparkSession, root: str, view: str) -> DataFrame:
    """A stored view; while the job replaces it, the version before."""
    path = f"{root.rstrip('/')}/{history_table(view)}"
    return versions.read(spark, path, HISTORY_SCHEMAS[view])


def views_of(rows: DataFrame, literal_counts: bool = False) -> dict[str, DataFrame]:
    """The five views from rollup rows (``rollup.rollup_all``)."""
    hours, contributors, languages, server_users = (
        rollup.grain_rows(rows, grain) for grain in rollup.GRAINS
    )
    return {
        "hourly_patterns": historical.hourly_patterns_of(hours, literal_counts),
        "hourly_trends": historical.hourly_trends_of(hours, literal_counts),
        "top_contributors": historical.top_contributors_of(
            contributors, literal_counts=literal_counts
        ),
        "language_distribution": historical.language_distribution_of(languages, literal_counts),
        "server_rankings": historical.server_rankings_of(server_users),
    }


def store_views(events: DataFrame, store: Store, literal_counts: bool = False) -> dict[str, int]:
    """Compute and store all views of ``events``; see ``store_rows``."""
    return store_rows(rollup.rollup_all(events), store, literal_counts)


def store_rows(rollup_rows: DataFrame, store: Store, literal_counts: bool = False) -> dict[str, int]:
    """Store all views of rollup rows; rows per table, and ``events`` counted.

    The result is empty, and no table is touched, when there are no events. The views are small
    jobs of several stages each, so they are stored side by side; an error in one is raised.
    """
    with materialised(rollup_rows, "rollup", partition_by=["grain"]) as rows:
        read = rollup.grain_rows(rows, "hours").agg(F.sum("events")).first()[0]
        if not read:
            return {}
        tables = {
            history_table(name): view for name, view in views_of(rows, literal_counts).items()
        }
        # Jobs started from a pool thread keep the caller's Spark properties.
        submit = inheritable_thread_target(rollup_rows.sparkSession)(store)
        with ThreadPoolExecutor(len(tables)) as pool:
            counts = pool.map(submit, tables.values(), tables)
            return {"events": read, **dict(zip(tables, counts))}


def run(
    spark: SparkSession,
    lake: str,
    store: Store,
    days_back: int = 7,
    as_of: clock.AsOf = None,
    literal_counts: bool = False,
) -> dict[str, int]:
    """The scheduled job: scan the look-back window of the lake and store the views."""
    return store_views(scan_lake(spark, lake, days_back, as_of), store, literal_counts)
