"""SimHash near-duplicates: fingerprints of word shingles, candidates by pigeonring filtering.

Two 64-bit fingerprints with at most ``max_bits`` differing bits are cut into ``max_bits + 1``
segments on a ring. Some segment then starts a chain whose first k segments differ in at most
k * max_bits / segments bits, for every k. So that segment is equal, and one half of the next one
is: these two make the key of an inverted list, and the rest of the chain is tested before the
whole distance.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidewatch.llm import minhash
from tidewatch.llm.common import shingle_hashes, stored
from tidewatch.llm.components import components, in_blocks, spanning

BITS = 64
# Lists are compared in blocks of about this many fingerprints.
BLOCK = 512


def simhash(text: str, shingle: int, seed: int) -> int:
    """The fingerprint as an unsigned number: a bit is set if it is in over half the hashes."""
    hashes = shingle_hashes(text, shingle, seed)
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 65536):
        part = hashes[start : start + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    seed: int = 42,
    *more: str,
) -> DataFrame:
    """``key``, ``fp`` (the fingerprint's 64 bits as a signed long) and the columns ``more``, one row
    per row of ``df``.

    A null text counts as empty and has fingerprint zero, like a text without words.
    """
    fields = [df.schema[name] for name in more]
    schema = StructType([df.schema[key], StructField("fp", LongType()), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array(
                [simhash(value.as_py() or "", shingle, seed) for value in batch.column(1)],
                dtype=np.uint64,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64)), *batch.columns[2:]],
                names=schema.names,
            )

    return df.select(key, text, *more).mapInArrow(run, schema)


def _segments(count: int) -> list[tuple[int, int]]:
    """``(lowest bit, width)`` of the segments of a ring over the 64 bits."""
    cuts = [BITS * n // count for n in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _keys(fp: Column, max_bits: int) -> Column:
    """The list keys of a fingerprint: a segment, and one half of the next."""

    def bits(low: int, width: int) -> Column:
        return F.shiftrightunsigned(fp, low).bitwiseAND(F.lit((1 << width) - 1))

    ring, keys = _segments(max_bits + 1), []
    for start, (low, width) in enumerate(ring):
        after, span = ring[(start + 1) % len(ring)]
        half = span // 2
        for second, (a, w) in enumerate(((after, half), (after + half, span - half))):
            name = F.lit(2 * start + second)
            value = F.shiftleft(bits(low, width), w).bitwiseOR(bits(a, w))
            keys.append(F.shiftleft(value, 8).bitwiseOR(name.cast("long")))
    return F.array(*keys)


def _chains(max_bits: int) -> list[list[tuple[int, int]]]:
    """For each start ``(mask, budget)`` of its chains, from one segment to the whole ring."""
    ring = _segments(max_bits + 1)
    chains = []
    for start in range(len(ring)):
        mask, steps = 0, []
        for length in range(1, len(ring) + 1):
            low, width = ring[(start + length - 1) % len(ring)]
            mask |= ((1 << width) - 1) << low
            steps.append((mask, length * max_bits // len(ring)))
        chains.append(steps)
    return chains


def _forest(found: np.ndarray, steps: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Links that span what the fingerprints of a list, or of two blocks of it, hold together."""
    unlike = found[:, None] ^ found[None, :]
    near = np.ones(unlike.shape, dtype=bool)
    for mask, budget in steps:
        near &= np.bitwise_count(unlike & np.uint64(mask)) <= budget
    child, parent = spanning(near)
    return found[child], found[parent]


def links(fps: DataFrame, max_bits: int = 2, block: int = BLOCK) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` (long) at most ``max_bits`` apart,
    as many as hold each component together (never all pairs of a list).

    A fingerprint is listed under ``2 * (max_bits + 1)`` keys. Keys of one fingerprint go before
    anything is gathered; a list of more than ``block`` is dealt out as pairs of blocks, so no
    task holds more than two blocks of a hot list at once.
    """
    if max_bits < 1:
        return fps.selectExpr("fp AS a", "fp AS b").where("false")
    keys = fps.select("fp", F.explode(_keys(F.col("fp"), max_bits)).alias("key"))
    dealt = in_blocks(keys, ["key"], "fp", block).select("key", "lo", "hi", "fp")
    chains = _chains(max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for batch in batches:
            columns = [batch.column(i).to_numpy() for i in range(4)]
            if rest is not None:
                columns = [np.concatenate(pair) for pair in zip(rest, columns)]
            key, lo, hi, _ = columns
            new = (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
            cuts = np.r_[0, np.flatnonzero(new) + 1]
            rest = [column[cuts[-1] :] for column in columns]
            yield from emit(columns, cuts)
        if rest is not None:
            yield from emit(rest, np.array([0, len(rest[0])]))

    def emit(columns: list[np.ndarray], cuts: np.ndarray) -> Iterator[pa.RecordBatch]:
        key, _, _, fp = columns
        fp = fp.view(np.uint64)
        pairs = [
            _forest(fp[a:b], chains[(int(key[a]) & 255) >> 1])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())
            if b - a > 1
        ]
        if pairs:
            ends = [np.concatenate(side).view(np.int64) for side in zip(*pairs)]
            yield pa.RecordBatch.from_arrays([pa.array(end) for end in ends], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_bits: int = 2,
    seed: int = 42,
    similarity: float | None = None,
    words: int = 5,
) -> DataFrame:
    """``key, fingerprint (16 hex digits), component_id`` per row: documents whose fingerprints are
    linked by steps of at most ``max_bits`` differing bits share the smallest key of them.

    Exact copies, and any documents of equal fingerprint, are one node and are never compared.
    Texts: see ``fingerprints``. Rows with a null key keep their row; they join a component but
    never name it, and a component of null keys only has a null id. Repeated rows stay. Other
    columns are not read; an empty table gives an empty result.

    With ``similarity``, texts whose sets of ``words``-word shingles have at least that Jaccard
    similarity are linked as well (see ``minhash.links``).
    """
    docs = fingerprints(df, key, text, shingle, seed)
    if similarity is not None:
        docs = fingerprints(df.withColumn("whole", minhash.whole(text)), key, text, shingle, seed, "whole")
    docs = stored(docs, "fingerprints")
    nodes = stored(docs.groupBy("fp").agg(F.min(key).alias("first")), "nodes")
    near = links(nodes.select("fp"), max_bits)
    if similarity is not None:
        prints = docs.select("whole", "fp").distinct()
        alike = minhash.links(df, similarity, text, words, seed)
        for end in ("a", "b"):
            alike = alike.join(prints.select(F.col("whole").alias(end), F.col("fp").alias(f"fp_{end}")), end)
        near = near.unionByName(alike.select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b")))
    linked = components(near)
    rooted = nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = stored(rooted.join(ids, "root").select("fp", "component_id"), "classes")
    return docs.join(classes, "fp").select(
        key, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
