"""Table shapes. Every read in this package names its schema; nothing is inferred.

All fields are nullable. ``bytes_changed`` is a bigint everywhere so that sums and
differences cannot overflow under ANSI mode.
"""

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructType,
    TimestampType,
)

TEXT, LONG, INT, FLAG = StringType(), LongType(), IntegerType(), BooleanType()
DOUBLE, TIME = DoubleType(), TimestampType()


def struct(columns: dict[str, DataType]) -> StructType:
    shape = StructType()
    for name, data_type in columns.items():
        shape = shape.add(name, data_type)
    return shape


def extended(schema: StructType, columns: dict[str, DataType]) -> StructType:
    return struct({**{field.name: field.dataType for field in schema}, **columns})


# Field names and types of the public recent-change event and its projections.
_LENGTH = struct({"old": INT, "new": INT})
_REVISION = struct({"old": LONG, "new": LONG})
_META = struct(
    {
        "uri": TEXT, "request_id": TEXT, "id": TEXT, "dt": TEXT, "domain": TEXT,
        "stream": TEXT, "topic": TEXT, "partition": INT, "offset": LONG,
    }
)
_EVENT = {
    "id": LONG, "type": TEXT, "namespace": INT, "title": TEXT, "comment": TEXT, "timestamp": LONG,
    "user": TEXT, "bot": FLAG, "minor": FLAG,
    "server_name": TEXT, "server_url": TEXT, "wiki": TEXT,
    "title_url": TEXT, "parsedcomment": TEXT,
    "length": _LENGTH, "revision": _REVISION, "meta": _META,
    "log_id": LONG, "log_type": TEXT, "log_action": TEXT, "log_params": TEXT,
    "patrolled": FLAG,
}
_DERIVED = {
    "is_bot": FLAG, "is_minor": FLAG, "is_new_page": FLAG,
    "bytes_changed": LONG, "language": TEXT, "project": TEXT,
}
_ANALYTICS = [
    "timestamp", "type", "user", "server_name", "title", "namespace", "bot", "is_bot", "is_minor",
    "is_new_page", "bytes_changed", "language", "project", "length",
]
_MINIMAL = ["user", "bot", "type", "server_name", "timestamp"]
_HISTORY = {
    "hourly_patterns": {
        "hour_bucket": TIME, "total_events": LONG, "total_bytes": LONG, "avg_bytes": DOUBLE,
        "bot_events": LONG, "human_events": LONG,
    },
    "hourly_trends": {
        "hour_bucket": TIME, "total_events": LONG, "total_bytes": LONG, "bot_count": LONG,
        "new_pages": LONG, "edits": LONG, "events_24h_avg": DOUBLE, "bytes_24h_avg": DOUBLE,
    },
    "top_contributors": {
        "user": TEXT, "is_bot": FLAG, "edit_count": LONG, "total_bytes": LONG,
        "pages_created": LONG,
    },
    "language_distribution": {
        "language": TEXT, "project": TEXT, "edit_count": LONG, "total_bytes": LONG,
        "bot_edits": LONG, "new_pages": LONG,
    },
    "server_rankings": {
        "server_name": TEXT, "language": TEXT, "project": TEXT, "edit_count": LONG,
        "total_bytes": LONG, "unique_users": LONG, "rank": INT, "percentile": DOUBLE,
    },
}

RAW_SCHEMA = struct(_EVENT)
LAKE_SCHEMA = struct({**_EVENT, **_DERIVED, "timestamp_imputed": FLAG})
# The full typed event differs from a lake row in ``log_params``: a map when an event is read
# typed, JSON text in the lake, where its values have mixed types.
FULL_SCHEMA = struct({**_EVENT, **_DERIVED, "log_params": MapType(TEXT, TEXT)})
ANALYTICS_SCHEMA = struct({name: LAKE_SCHEMA[name].dataType for name in _ANALYTICS})
MINIMAL_SCHEMA = struct({name: LAKE_SCHEMA[name].dataType for name in _MINIMAL})
RECENT_CHANGES_SCHEMA = struct(
    {
        "event_time": TIME, "user": TEXT, "title": TEXT, "server_name": TEXT,
        "is_bot": FLAG, "type": TEXT, "bytes_changed": LONG, "length_diff": LONG,
    }
)
TRAFFIC_SCHEMA = struct(
    {"window_start": TIME, "total_bytes": LONG, "event_count": LONG, "avg_bytes_per_event": DOUBLE}
)
MINUTE_PARTIALS_SCHEMA = struct(
    {"minute": TIME, "dimension": TEXT, "key": TEXT, "key_2": TEXT, "edits": LONG, "moved": LONG}
)
HISTORY_SCHEMAS = {view: struct(columns) for view, columns in _HISTORY.items()}


def history_table(view: str) -> str:
    """Table name a historical view is stored under."""
    return f"historical_{view}"
