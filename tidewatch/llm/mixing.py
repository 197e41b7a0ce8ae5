"""Mixing sources to target weights by Poisson replication, with DataFrame functions only."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewatch.llm.common import stored, unused

# Tables of the distribution up to this many numbers (16 MB) are broadcast; beyond, joined.
BROADCAST_NUMBERS = 2_000_000


def _uniform(seed: str, *parts: Column) -> Column:
    """A number strictly between 0 and 1 from the first 52 bits of an MD5 digest."""
    return (_bits(seed, *parts) + F.lit(0.5)) / F.lit(float(1 << 52))


def _bits(seed: str, *parts: Column) -> Column:
    text = F.concat_ws(":", F.lit(seed), *(part.cast("string") for part in parts))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def rates(
    docs: DataFrame,
    weights: dict[str, float],
    default_weight: float = 1.0,
    epochs: float = 1.0,
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """``source, size, rate``: how often a document of each source should appear on average.

    A source's size is its characters plus one per document. Its target is the share of its weight
    among the sources that are there, of ``epochs`` times the whole size. A source without a weight,
    null included, has ``default_weight``; a negative weight is an error.
    """
    if min([default_weight, *weights.values()]) < 0:
        raise ValueError("a weight is negative")
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.length(F.coalesce(text, F.lit(""))) + 1).cast("double").alias("size")
    )
    given = docs.sparkSession.createDataFrame(list(weights.items()), "source string, weight double")
    weighted = sizes.join(F.broadcast(given), "source", "left").withColumn(
        "weight", F.coalesce("weight", F.lit(float(default_weight)))
    )
    weighted = stored(weighted, "weights")
    total = weighted.agg(F.sum("size")).scalar()
    all_weights = weighted.agg(F.sum("weight")).scalar()
    share = F.when(all_weights > 0, F.col("weight") / all_weights).otherwise(0.0)
    return weighted.select("source", "size", (share * epochs * total / F.col("size")).alias("rate"))


def inverse_table(rates: DataFrame) -> DataFrame:
    """``source, chances``: the cumulative Poisson probabilities of 0, 1, 2, ... for each rate, up
    to where what is left is below the grain of the hash."""
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 40).cast("int")
    counts = rates.select("source", "rate", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    up_to = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    log_factorial = F.sum(F.when(F.col("k") > 0, F.log(F.col("k"))).otherwise(0.0)).over(up_to)
    power = F.when(F.col("k") > 0, F.col("k") * F.log("rate")).otherwise(0.0)
    chance = F.when(F.col("rate") > 0, F.exp(power - F.col("rate") - log_factorial)).otherwise(
        (F.col("k") == 0).cast("double")
    )
    return (
        counts.withColumn("chance", chance)
        .withColumn("upto", F.sum("chance").over(up_to))
        .groupBy("source")
        .agg(F.array_sort(F.collect_list("upto")).alias("chances"))
    )


def mix(
    docs: DataFrame,
    weights: dict[str, float],
    default_weight: float = 1.0,
    epochs: float = 1.0,
    seed: str = "mix",
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Every document as often as a Poisson number with its source's rate says, shuffled globally.

    The number is the inverse of the distribution at a uniform hash of ``seed`` and ``key``: the
    same in every run and however the input is split, and the copies of one document number
    independently of all others. Rows with equal keys get equal numbers, as do all rows whose key
    is null; a null source is a source of its own. Adds ``copy`` (from 1) and ``shuffle_key``, whose
    order is the shuffled order (replacing columns of these names): rows are dealt to partitions by
    it and sorted inside. An empty table gives an empty result.

    Sizes combine before their shuffle. The table of the distribution has a row per source; it is
    broadcast when it was found to be small, else joined on the source, where Spark may split a
    source that holds most rows.
    """
    docs = docs.drop("copy", "shuffle_key")
    of, chances, count = (unused(name, docs) for name in ("__source", "__chances", "__count"))
    table = stored(
        inverse_table(rates(docs, weights, default_weight, epochs, source, text)), "chances"
    ).withColumnsRenamed({"source": of, "chances": chances})
    numbers = table.agg(F.sum(F.size(chances))).first()[0] or 0
    if numbers <= BROADCAST_NUMBERS:
        table = F.broadcast(table)
    name = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    draw = _uniform(seed, name)
    drawn = docs.join(table, docs[source].eqNullSafe(table[of])).withColumn(
        count, F.size(F.filter(chances, lambda chance: chance < draw))
    )
    copies = drawn.where(F.col(count) > 0).select(
        *(docs[name] for name in docs.columns),
        F.explode(F.sequence(F.lit(1), F.col(count))).alias("copy"),
    )
    order = _bits(f"{seed}/order", name, F.col("copy"))
    return (
        copies.withColumn("shuffle_key", order)
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key", key, "copy")
    )
