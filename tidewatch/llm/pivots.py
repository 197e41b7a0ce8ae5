"""Near-duplicate vectors through a pivot-permutation index.

Every vector is described by the order of its nearest reference points (pivots). Each of the first
few names an inverted list the vector is put on. Vectors of a list that share enough of their
first pivots are candidates, and candidates are verified by their cosine in double precision.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from tidewatch.llm.common import stored
from tidewatch.llm.components import components, in_blocks, spanning

# Pivots a vector is listed under, and how many of them candidates must share.
PREFIX = 10
SHARED = 2
# Pivots per square root of the number of vectors, within bounds that keep them small enough to
# be broadcast (at most 4,096 vectors).
PIVOT_FACTOR = 1.5
LEAST_PIVOTS, MOST_PIVOTS = 32, 4096
APART, OVERSAMPLE = 0.8, 2
# Lists are compared in blocks of about this many vectors.
BLOCK = 256


def _valid(vector: Column) -> Column:
    """Whether a vector can be compared: known and finite throughout, and not zero."""
    odd = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    return vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0)


def _units(vectors: list) -> np.ndarray:
    """Vectors of equal width at length 1. They are brought near 1 by a power of two first, which
    rounds nothing, so that no square overflows or vanishes."""
    rows = np.array(vectors, dtype=float)
    power = np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1]
    # In two steps, as the power itself may be out of range.
    rows = np.ldexp(np.ldexp(rows, -(power // 2)), -(power - power // 2))
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def sample_pivots(vectors: DataFrame, count: int, apart: float = APART) -> np.ndarray:
    """Up to ``count`` unit vectors, no two with a cosine of ``apart`` or more, from the
    ``OVERSAMPLE * count`` vectors of smallest hash: a bounded sample, the only vectors that reach
    the driver. A dense group thus gives one pivot. Where widths differ the most common one counts.
    """
    picked = (
        vectors.select("vector")
        .orderBy(F.xxhash64("vector", F.lit(7)), "vector")
        .limit(OVERSAMPLE * count)
        .toPandas()["vector"]
    )
    widths = [len(vector) for vector in picked]
    width = max(set(widths), key=lambda w: (widths.count(w), w)) if widths else 0
    kept = np.zeros((0, width))
    for vector in picked:
        if len(vector) == width and len(kept) < count:
            row = _units([vector])[0]
            if not len(kept) or (kept @ row).max() < apart:
                kept = np.vstack([kept, row])
    return kept


def nearest_pivots(unit: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """For each row the numbers of its nearest pivots, nearest first; ties to the smaller."""
    near = -(unit @ pivots.T)
    prefix = min(prefix, len(pivots))
    return np.argsort(near, axis=1, kind="stable")[:, :prefix].astype(np.int32)


def index(vectors: DataFrame, pivots: np.ndarray, prefix: int = PREFIX) -> DataFrame:
    """``vectors`` with ``order``: the numbers of the nearest pivots to ``vector``. Vectors of another
    width than the pivots' are listed under numbers that stand for their width."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)
    schema = StructType([*vectors.schema.fields, StructField("order", ArrayType(IntegerType()))])
    at = vectors.columns.index("vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points = shared.value
        for batch in batches:
            rows = batch.column(at).to_pylist()
            fits = [len(row) == points.shape[1] for row in rows]
            orders = [[-1 - SHARED * len(row) - n for n in range(SHARED)] for row in rows]
            usual = [row for row, fit in zip(rows, fits) if fit]
            if usual:
                unit = _units(usual)
                found = iter(nearest_pivots(unit, points, prefix).tolist())
                orders = [next(found) if fit else order for order, fit in zip(orders, fits)]
            column = pa.array(orders, type=pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, column], names=[*batch.schema.names, "order"]
            )

    return vectors.mapInArrow(run, schema)


def pivot_count(vectors: int) -> int:
    return max(LEAST_PIVOTS, min(MOST_PIVOTS, int(PIVOT_FACTOR * vectors**0.5)))


class _List:
    """Two blocks of an inverted list (``rows`` of label, pivot, lo, hi, node, copies, order,
    vector), compared with each other."""

    def __init__(self, rows: pa.Table, shared: int, threshold: float):
        self.node = rows["node"].to_numpy()
        copies = rows["copies"].to_numpy()
        pivot = rows["pivot"][0].as_py()
        orders = rows["order"].to_pylist()
        numbers, flat = np.unique(np.concatenate(orders), return_inverse=True)
        put = np.zeros((len(orders), len(numbers)), dtype=np.float32)
        put[np.repeat(np.arange(len(orders)), [len(order) for order in orders]), flat] = 1
        left, right = np.nonzero(np.triu(put @ put.T >= min(shared, put.sum(axis=1).min()), 1))
        unit = _units(rows["vector"].to_pylist())
        found = np.concatenate(
            [np.zeros(0, dtype=bool)]
            + [
                np.einsum("ij,ij->i", unit[left[n : n + 65536]], unit[right[n : n + 65536]])
                >= threshold
                for n in range(0, len(left), 65536)
            ]
        )
        left, right = left[found], right[found]
        near = np.zeros((len(unit), len(unit)), dtype=bool)
        near[left, right] = near[right, left] = True
        self.child, self.parent = spanning(near)
        # A pair counts in the list of its smallest shared pivot, and there between its own two
        # blocks (rows of one block meet in many groups, and count in that of the block alone).
        lower = put[:, numbers < pivot]
        first = (lower[left] * lower[right]).sum(axis=1) == 0
        block = rows["block"].to_numpy()
        low, high = rows["lo"][0].as_py(), rows["hi"][0].as_py()
        own = (np.minimum(block[left], block[right]) == low) & (
            np.maximum(block[left], block[right]) == high
        )
        left, right = left[first & own], right[first & own]
        self.links = np.bincount(left, copies[right], len(unit)) + np.bincount(
            right, copies[left], len(unit)
        )


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The groups of equal first four columns of a sorted stream."""
    rest: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if rest is not None:
            rows = pa.concat_tables([rest, rows]).combine_chunks()
        keys = [rows.column(n).to_numpy() for n in range(4)]
        new = np.logical_or.reduce([key[1:] != key[:-1] for key in keys])
        cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:]):
            yield rows.slice(a, b - a)
        rest = rows.slice(cuts[-1])
    if rest is not None and rest.num_rows:
        yield rest


def compare(
    listed: DataFrame, shared: int = SHARED, threshold: float = 0.98, block: int = BLOCK
) -> DataFrame:
    """``a, b, links`` of vectors on inverted lists: rows with ``b`` are links that hold each group
    together (not all pairs), rows without say how many other vectors ``a`` was linked with.

    ``listed`` has ``label, pivot, node, copies, order, vector``. A pair is a candidate if its
    prefixes share ``shared`` pivots (all of them if there are fewer), and a link if its cosine is
    ``threshold`` or more.
    """
    columns = ["label", "pivot", "lo", "hi", "node", "copies", "order", "vector", "block"]
    dealt = in_blocks(listed, ["label", "pivot"], "node", block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _lists(batches):
            if rows.num_rows < 2:
                continue
            found = _List(rows, shared, threshold)
            counted = np.flatnonzero(found.links)
            a = np.concatenate([found.node[found.child], found.node[counted]])
            b = pa.array([*found.node[found.parent].tolist(), *[None] * len(counted)], pa.int64())
            links = np.concatenate([np.zeros(len(found.child)), found.links[counted]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(a), b, pa.array(links.astype(np.int64))], names=["a", "b", "links"]
            )

    return dealt.select(*columns).mapInArrow(run, "a long, b long, links long")


def near_duplicates(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = 0.98,
    prefix: int = PREFIX,
    shared: int = SHARED,
    block: int = BLOCK,
) -> DataFrame:
    """``key, n_links, component_id, kept`` per row: how many other vectors of the same label have a
    cosine of ``threshold`` or more, the smallest key that such links lead to, and whether that is
    the row's own.

    Equal vectors of a label are one node with its number of copies; copies are linked without
    being compared. Vectors that are null, empty, zero or not finite throughout, and vectors
    without a label, link with nothing: no links, their own component, kept. A row with a null key
    is counted as a vector but never names a component; alone it has a null component and is not
    kept. Vectors of different widths are never linked. Repeated rows are copies. Other columns are
    not read; an empty table gives an empty result.
    """
    node = F.when(
        F.col(label).isNotNull() & _valid(F.col(vector)), F.xxhash64(F.col(label), F.col(vector))
    )
    rows = df.select(
        F.col(key), F.col(label).alias("label"), F.col(vector).alias("vector"), node.alias("node")
    )
    members = stored(rows.select(key, "node"), "members")
    nodes = stored(
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(
            F.first("label").cast("string").alias("label"),
            F.first("vector").alias("vector"),
            F.count("*").alias("copies"),
            F.min(key).alias("first"),
        ),
        "nodes",
    )
    pivots = sample_pivots(nodes, pivot_count(nodes.count()))
    listed = index(nodes.drop("first"), pivots, prefix).withColumn("pivot", F.explode("order"))
    found = stored(compare(listed, shared, threshold, block), "vector-links")
    counts = (
        found.where("b IS NULL")
        .groupBy(F.col("a").alias("node"))
        .agg(F.sum("links").alias("links"))
    )
    linked = components(found.where("b IS NOT NULL")).withColumnRenamed("component", "root")
    rooted = (
        nodes.select("node", "copies", "first")
        .join(counts, "node", "left")
        .join(linked, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = stored(
        rooted.join(least, "root").select(
            "node",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            "component_id",
        ),
        "vector-classes",
    )
    alone = F.col("node").isNull()
    return members.join(classes, "node", "left").select(
        key,
        F.when(alone, 0).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        F.when(alone, F.col(key)).otherwise(F.col("component_id")).cast("long").alias("component_id"),
        F.coalesce(
            F.when(alone, F.col(key).isNotNull()).otherwise(F.col(key) == F.col("component_id")),
            F.lit(False),
        ).alias("kept"),
    )
