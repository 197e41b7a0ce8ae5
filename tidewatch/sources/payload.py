"""JSON payload -> typed event columns, with malformed payloads kept apart.

One ``from_json`` reads every scalar as text, which accepts any JSON value: a number that arrives
quoted or a text namespace is an odd value, not a malformed event. The text is then cast per
field. Only a struct can fail to fit, when something else stands in its place; the parser then
still delivers the other fields, while a payload that is not a JSON object delivers none. A second
parse, as a variant, tells whether the payload is strict JSON from end to end.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

from tidewatch.functions import event as ev
from tidewatch.schemas import extended, struct

MALFORMED = "malformed"
NULL_LENGTH = "null_length"
_CORRUPT = "_corrupt"


def _as_text(data_type: DataType) -> DataType:
    if isinstance(data_type, StructType):
        return struct({field.name: _as_text(field.dataType) for field in data_type})
    return StringType()


def _typed(text: Column, data_type: DataType) -> Column:
    if isinstance(data_type, StringType):
        return text
    if isinstance(data_type, LongType):
        return ev.whole_number(text)
    if isinstance(data_type, IntegerType):
        return ev.whole_number(text).try_cast("int")
    if isinstance(data_type, BooleanType):
        return text.try_cast("boolean")
    fields = [
        _typed(text.getField(field.name), field.dataType).alias(field.name) for field in data_type
    ]
    return F.when(text.isNotNull(), F.struct(*fields))


def _closed(payload: Column) -> Column:
    """The payload and its own hash as a JSON array, null if that is not strict JSON."""
    proof = F.xxhash64(payload).cast("string")
    return F.try_parse_json(F.concat(F.lit("["), payload, F.lit(","), proof, F.lit("]")))


def _is_whole(payload: Column, closed: Column) -> Column:
    """Whether the payload is one JSON value from its first to its last character.

    A parser that has read a value ignores what follows. In the array the payload's hash must
    follow, so text that is cut off, or goes on after the value, does not pass.
    """
    follows = F.try_variant_get(closed, "$[1]", "bigint")
    return F.coalesce(follows == F.xxhash64(payload), F.lit(False))


def _has_null_side(closed: Column) -> Column:
    """Whether ``length`` holds an explicit null, which a typed read cannot tell from none."""

    def explicit_null(side: str) -> Column:
        return F.is_variant_null(F.try_variant_get(closed, f"$[0].length.{side}", "variant"))

    return F.coalesce(explicit_null("old"), F.lit(False)) | F.coalesce(
        explicit_null("new"), F.lit(False)
    )


def decode(payloads: DataFrame, schema: StructType, reject_null_length: bool = False) -> DataFrame:
    """Parse the ``payload`` column into ``schema``'s fields plus ``reject_reason``.

    Columns other than ``payload`` are carried through. ``namespace`` stays text, because the
    noise filter looks at its text; the lake normalisation makes it a number.
    ``reject_null_length`` also rejects an explicit null in ``length.old`` / ``length.new``,
    which otherwise counts as 0.
    """
    as_text = extended(_as_text(schema), {_CORRUPT: StringType()})
    options = {"columnNameOfCorruptRecord": _CORRUPT, "allowSingleQuotes": "false"}
    event = F.from_json("payload", as_text, options)
    # Exploding a one-element array keeps a later filter on the parsed event from being pushed
    # below it, where it would parse every payload once more.
    both = F.struct(event.alias("event"), _closed(F.col("payload")).alias("closed"))
    parsed = payloads.select("*", F.explode(F.array(both)).alias("_read"))
    event, closed = F.col("_read.event"), F.col("_read.closed")
    # Whether any is there. A chain of ORs says the same, but the optimizer takes seconds per batch to
    # derive constraints from its many parts.
    there = [event.getField(name).isNotNull() for name in schema.fieldNames()]
    delivered = F.greatest(*there, F.lit(False), F.lit(False))
    unreadable = event.getField(_CORRUPT).isNotNull() & ~delivered
    whole = _is_whole(F.col("payload"), closed)
    reason = F.when(event.isNull() | unreadable | ~whole, MALFORMED)
    if reject_null_length:
        reason = reason.when(_has_null_side(closed), NULL_LENGTH)
    # Exploded too, beside the fields it would be a constraint on them, of which the optimizer derives
    # another with every text field that the projection renames: 2 to the 16th fill the driver's memory.
    judged = parsed.select("*", F.explode(F.array(reason)).alias("_reason"))
    fields = [
        _typed(
            event.getField(field.name),
            StringType() if field.name == "namespace" else field.dataType,
        ).alias(field.name)
        for field in schema
    ]
    return judged.select(*payloads.columns, F.col("_reason").alias("reject_reason"), *fields)


def accepted(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("reject_reason").isNull()).drop("payload", "reject_reason")


def rejects(decoded: DataFrame) -> DataFrame:
    """Payloads to quarantine, with the reason."""
    return decoded.filter(F.col("reject_reason").isNotNull()).select("payload", "reject_reason")
