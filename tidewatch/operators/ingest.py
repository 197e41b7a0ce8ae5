"""Noise filter, enrichment and lake normalisation; all row-wise, so batch and streaming."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType

from tidewatch.functions import clock
from tidewatch.functions import event as ev
from tidewatch.schemas import LAKE_SCHEMA


def _wanted(skip_namespace_ids: bool) -> Column:
    return ev.is_kept_type(F.col("type")) & ~ev.is_talk_namespace(
        F.col("namespace"), skip_namespace_ids
    )


def filter_events(events: DataFrame, skip_namespace_ids: bool = False) -> DataFrame:
    """Keep edits, page creations and log entries outside talk namespaces.

    Feeds send namespaces as numbers, which never match the talk text; ``skip_namespace_ids``
    drops the numeric talk namespaces too.
    """
    return events.filter(_wanted(skip_namespace_ids))


def enrich_events(events: DataFrame, keep_null_flags: bool = False) -> DataFrame:
    """Add flags, size of the change, language and project."""
    return events.withColumns(
        {
            "is_bot": ev.flag(F.col("bot"), keep_null_flags),
            "is_minor": ev.flag(F.col("minor"), keep_null_flags),
            "is_new_page": ev.is_new_page(F.col("type")),
            "bytes_changed": ev.bytes_changed(F.col("length")),
            "language": ev.language(F.col("server_name")),
            "project": ev.project(F.col("server_name")),
        }
    )


def normalize_events(events: DataFrame, ingest_time: clock.AsOf = None) -> DataFrame:
    """Enriched events in the lake's shape.

    An event without a usable timestamp takes the ingest time and is marked
    ``timestamp_imputed``. A column the input lacks is null.
    """
    seconds = F.col("timestamp")
    fixed = {
        "timestamp": F.coalesce(seconds, F.unix_seconds(clock.moment(ingest_time))),
        "timestamp_imputed": seconds.isNull(),
        "namespace": F.col("namespace").try_cast("int"),
    }
    if "timestamp_imputed" in events.columns:
        fixed["timestamp_imputed"] = seconds.isNull() | F.coalesce(
            "timestamp_imputed", F.lit(False)
        )
    return project_schema(events, LAKE_SCHEMA, fixed)


def project_schema(
    events: DataFrame, schema: StructType, computed: dict[str, Column] | None = None
) -> DataFrame:
    """Select exactly ``schema``'s columns with its types. JSON text becomes a map where the schema
    asks for one, null if it is not an object."""
    computed = computed or {}
    present = {field.name: field.dataType for field in events.schema}

    def column(field: StructField) -> Column:
        if field.name in computed:
            return computed[field.name]
        if field.name not in present:
            return F.lit(None)
        if isinstance(field.dataType, MapType) and isinstance(present[field.name], StringType):
            return F.from_json(field.name, field.dataType)
        return F.col(field.name)

    return events.select(
        *[column(field).cast(field.dataType).alias(field.name) for field in schema]
    )


def ingest_counters(skip_namespace_ids: bool = False) -> list[Column]:
    """Counters over decoded events: seen, malformed, skipped by the noise filter, sent."""
    malformed = F.col("reject_reason").isNotNull()
    wanted = _wanted(skip_namespace_ids)
    return [
        F.count(F.lit(1)).alias("seen"),
        F.count_if(malformed).alias("failed"),
        F.count_if(~malformed & ~wanted).alias("skipped"),
        F.count_if(~malformed & wanted).alias("sent"),
    ]


def cap(events: DataFrame, max_messages: int | None, order_by: list[str]) -> DataFrame:
    """The first ``max_messages`` events in feed order; None passes all on."""
    return events if max_messages is None else events.orderBy(*order_by).limit(max_messages)
