"""Dense numbers in a global order, without sorting a group in one task."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm.common import stored


def numbered(df: DataFrame, group: str, order: list[Column], number: str, purpose: str) -> DataFrame:
    """``df`` with ``number``, from 0 without gaps in the order of each ``group``; ``number`` is a
    long, ``group`` must not be null.

    Rows are dealt to tasks by ranges of group and order, sorted there and stored; numbers inside a
    task are then shifted by what the tasks before it hold of the group. Rows that are equal in
    group and order may stand in several tasks, so many repeats of one row don't meet in one. The
    only window runs over one row per task and group.
    """
    part, first, before = (f"__{purpose}_{name}" for name in ("part", "first", "before"))
    dealt = df.withColumn(part, F.monotonically_increasing_id())
    keys = [F.col(group), *order, F.col(part)]
    dealt = (
        dealt.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn(number, F.monotonically_increasing_id())
        # The id holds the task's number above 33 bits and the place in the task below.
        .withColumn(part, F.shiftright(number, 33))
    )
    dealt = stored(dealt, purpose)
    earlier = Window.partitionBy(group).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        dealt.groupBy(group, part)
        .agg(F.min(number).alias(first), F.count(F.lit(1)).alias(before))
        .withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    )
    return (
        dealt.join(spans, [group, part])
        .withColumn(number, F.col(number) - F.col(first) + F.col(before))
        .select(*df.columns, number)
    )
