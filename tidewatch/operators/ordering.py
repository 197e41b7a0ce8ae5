"""Deterministic top-k and ranks that stay distributed."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, measure: str, keys: list[str], k: int) -> DataFrame:
    """``k`` rows with the largest ``measure``; ties go to the smaller keys, nulls first."""
    return df.orderBy(*descending(measure, keys)).limit(k)


def descending(measure: str, keys: list[str]) -> list[Column]:
    return [F.desc(measure), *[F.asc_nulls_first(key) for key in keys]]


def value_counts(df: DataFrame, measure: str, counted: str) -> DataFrame:
    """How many rows share each value of ``measure``.

    When ``measure`` counts events, there are at most sqrt(2 * events) different values, since
    distinct positive counts must sum to no more than the events: about 630,000 for 2e11 events.
    A window over the result may therefore run in one task, whatever the number of rows in
    ``df``.
    """
    return df.groupBy(measure).agg(F.count(F.lit(1)).alias(counted))


def _counts_over_all_columns(df: DataFrame, measure: str) -> DataFrame:
    """``value_counts`` in ``_rows``, but reading every column of ``df``: the top k needs them all,
    so both are computed from the same shuffled rows, which Spark then reuses, instead of scanning
    the events once for each set of columns."""
    touched = F.bit_xor(F.xxhash64(*df.columns)).alias("_touched")
    counts = df.groupBy(measure).agg(F.count(F.lit(1)).alias("_rows"), touched)
    return counts.where(F.col("_touched").isNotNull()).select(measure, "_rows")


def rank_top(df: DataFrame, measure: str, keys: list[str], k: int) -> DataFrame:
    """The ``k`` first rows with ``rank`` (1..k, unique) and ``percentile``.

    ``percentile`` is the percent rank over all of ``df``: the share of the other rows that have
    a larger ``measure``, equal for ties and 0 for the first. A plain window would sort every row
    in one task; here the ranks come from the k rows, and the percentiles from the counts per
    value. The k rows are ordered in one task, which suits any k that somebody reads, not hundreds
    of millions.
    """
    largest_first = Window.orderBy(F.desc(measure))
    places = (
        _counts_over_all_columns(df, measure)
        .withColumns(
            {
                "_larger": F.coalesce(
                    F.sum("_rows").over(
                        largest_first.rowsBetween(Window.unboundedPreceding, -1)
                    ),
                    F.lit(0),
                ),
                "_all": F.sum("_rows").over(
                    largest_first.rowsBetween(
                        Window.unboundedPreceding, Window.unboundedFollowing
                    )
                ),
            }
        )
        .select(
            measure,
            F.when(F.col("_all") > 1, F.col("_larger") / (F.col("_all") - 1))
            .otherwise(F.lit(0.0))
            .alias("percentile"),
        )
    )
    first = top_k(df, measure, keys, k).withColumn(
        "rank", F.row_number().over(Window.orderBy(*descending(measure, keys)))
    )
    return places.join(first, measure).select(*df.columns, "rank", "percentile")
