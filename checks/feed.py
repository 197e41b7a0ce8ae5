"""The test tables' ``events`` as a feed of recent-change events, batch or streaming.

Everything is computed row by row, so the feed grows with the table and needs no shuffle.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidewatch.functions import event as ev
from tidewatch.operators.ingest import enrich_events, filter_events
from tidewatch.operators.live import recent_changes
from tidewatch.schemas import RAW_SCHEMA

EVENTS = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
SERVERS = [
    "en.wikipedia.org",
    "www.wikidata.org",
    "commons.wikimedia.org",
    "de.wikipedia.org",
    "fr.wiktionary.org",
    "ja.wikipedia.org",
    "localhost",
]
PARTITIONS = 3


def events_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A file source takes a folder or a pattern, not a single file.
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque*")


_SERVER_ARRAY = ", ".join(f"'{name}'" for name in SERVERS)
_FILLED = {
    "id": "event_id",
    "timestamp": "unix_seconds(cast(ts AS timestamp))",
    "type": """CASE WHEN event_type IN ('view', 'click') THEN 'edit'
        WHEN event_type = 'purchase' THEN 'new' WHEN event_type = 'signup' THEN 'log'
        ELSE 'categorize' END""",
    "bot": "CASE WHEN event_id % 97 <> 0 THEN user_id % 5 = 0 END",
    "minor": "event_id % 3 = 0",
    "user": "concat('user_', user_id)",
    "server_name": f"element_at(array({_SERVER_ARRAY}), cast(1 + (event_id * 7 + user_id) % 7 AS int))",
    "title": """concat(CASE event_id % 8 WHEN 0 THEN 'Talk:Page_' WHEN 2 THEN 'User:Page_'
        WHEN 4 THEN 'Template:Page_' ELSE 'Page_' END, event_id % 200)""",
    "namespace": "cast(event_id % 16 AS int)",
    "length": """named_struct('old', cast(regexp_extract(props, '[0-9]+', 0) AS int) * 10,
        'new', cast(floor(value * 10) AS int))""",
    "log_params": "CASE WHEN event_type = 'signup' THEN replace(props, ' ', '') END",
}


def to_raw(events: DataFrame) -> DataFrame:
    """Rows of ``events`` in the raw event's shape; what the table cannot fill is null."""
    return events.selectExpr(
        *[
            f"{_FILLED.get(field.name, f'cast(NULL AS {field.dataType.simpleString()})')}"
            f" AS `{field.name}`"
            for field in RAW_SCHEMA
        ]
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_raw(events_table(spark, sf_dir))


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Filtered and enriched; an unknown bot flag stays unknown, to exercise the null cases."""
    return enrich_events(filter_events(raw(spark, sf_dir)), keep_null_flags=True)


def enriched_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_events(filter_events(to_raw(events_stream(spark, sf_dir))), keep_null_flags=True)


def changes(spark: SparkSession, sf_dir: str, carry: list[str] | None = None) -> DataFrame:
    return recent_changes(enriched(spark, sf_dir), carry=carry)


# Payloads that are no JSON object from end to end; N stands for the event's number.
BROKEN = [
    '{"id": N', '{"id": N, "log_params": {"a": ', '{"id": N} trailing', '{"id": N} {"id": N}',
    "{'id': N}", "[N]", "N", '"N"', "null", "{N}", '{"id": N}]',
]


def _broken(number: Column) -> Column:
    forms = F.array(*map(F.lit, BROKEN))
    form = F.element_at(forms, (1 + F.floor(number / 50) % len(BROKEN)).cast("int"))
    return F.replace(form, F.lit("N"), number.cast("string"))


def sse_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as captured text: mostly data lines, some malformed ones, some comments."""
    events = raw(spark, sf_dir).withColumn(
        "log_params", F.from_json("log_params", "map<string,int>")
    )
    number = F.col("id")
    line = (
        F.when(number % 50 == 0, F.concat(F.lit("data: "), _broken(number)))
        .when(number % 50 == 1, F.lit(": keep-alive"))
        .otherwise(F.concat(F.lit("data: "), F.to_json(F.struct(*events.columns))))
    )
    return events.select(line.alias("value"))


def with_coordinates(events: DataFrame) -> DataFrame:
    """Stand-in for a broker's bookkeeping: three partitions with consecutive offsets."""
    return events.withColumns(
        {
            "partition": (F.col("id") % PARTITIONS).cast("int"),
            "offset": F.floor(F.col("id") / PARTITIONS),
        }
    )


def flat(events: DataFrame) -> DataFrame:
    """``length`` as two plain columns, for comparison across engines."""
    return events.withColumns(
        {"len_old": F.col("length.old"), "len_new": F.col("length.new")}
    ).drop("length")


def twice(events: DataFrame) -> DataFrame:
    """Every tenth event delivered twice; ``copy`` tells the deliveries apart."""
    deliveries = F.when(ev.whole_number(F.col("id")) % 10 == 0, 2).otherwise(1)
    return events.withColumn("copy", F.explode(F.sequence(F.lit(1), deliveries)))


def _files(spark: SparkSession) -> int:
    return max(1, spark.sparkContext.defaultParallelism)


def deliver(rows: DataFrame, folder: str, parts: int) -> None:
    """Add ``rows`` to ``folder`` in ``parts`` equal parts, each of as many files as there are cores: a
    part that came as one file would be read and decoded by one task, however large it is."""
    files = parts * _files(rows.sparkSession)
    rows.repartition(files).write.mode("append").parquet(folder)


def delivered(spark: SparkSession, folder: str, schema: StructType, parts: int = 1) -> DataFrame:
    """The stream of what ``deliver`` has added, so many ``parts`` to a batch."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", parts * _files(spark))
        .parquet(folder)
    )


def age_files(spark: SparkSession, folder: str, seconds: int) -> None:
    """Make the files of a folder look as if they had been written so much earlier."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = files.listFiles(path, True)
    while found.hasNext():
        status = found.next()
        files.setTimes(status.getPath(), status.getModificationTime() - seconds * 1000, -1)
