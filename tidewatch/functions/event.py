"""Expressions over raw and enriched recent-change events."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the noise filter keeps and drops.
KEPT_TYPES = ["edit", "new", "log"]
DROPPED_NAMESPACE_TEXT = "talk"


def is_kept_type(event_type: Column) -> Column:
    return F.coalesce(event_type.isin(KEPT_TYPES), F.lit(False))


def is_talk_namespace(namespace: Column, by_id: bool = False) -> Column:
    """True for namespaces whose text names a talk space; a missing one is not talk.

    ``by_id`` also recognises numeric talk ids, which are the odd positive ones.
    """
    text = F.lower(F.coalesce(namespace.cast("string"), F.lit("")))
    talk = text.contains(DROPPED_NAMESPACE_TEXT)
    if by_id:
        number = F.coalesce(text.try_cast("int"), F.lit(0))
        talk = talk | ((number > 0) & (number % 2 == 1))
    return talk


def flag(value: Column, keep_null: bool = False) -> Column:
    """A boolean that is false when absent; ``keep_null`` leaves an absent one null."""
    return value if keep_null else F.coalesce(value, F.lit(False))


def is_new_page(event_type: Column) -> Column:
    return F.coalesce(event_type == "new", F.lit(False))


def length_diff(length: Column) -> Column:
    """Signed size change in bytes; a missing side counts as 0."""

    def side(name: str) -> Column:
        return F.coalesce(length.getField(name).cast("bigint"), F.lit(0).cast("bigint"))

    return side("new") - side("old")


def bytes_changed(length: Column) -> Column:
    return F.abs(length_diff(length))


def _host_part(server_name: Column, position: int) -> Column:
    part = F.split_part(server_name, F.lit("."), F.lit(position))
    return F.when(server_name.contains("."), part)


def language(server_name: Column) -> Column:
    """First host label, null for a host without a dot."""
    return _host_part(server_name, 1)


def project(server_name: Column) -> Column:
    """Second host label, null for a host without a dot."""
    return _host_part(server_name, 2)


def event_key(meta: Column, event_id: Column) -> Column:
    """Identity of an event for deduplication; null when the event carries none."""
    return F.coalesce(meta.getField("id"), event_id.cast("string"))


def whole_number(text: Column) -> Column:
    """Bigint from a number that may arrive quoted or with a fraction, else null."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
