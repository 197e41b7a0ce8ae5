"""Links between texts of similar word-shingle sets: MinHash bands name candidates, sets decide.

The set of a text is that of the XXH64 of its word shingles (a shorter text is one shingle). Two
sets of Jaccard similarity s agree on a minimum of a hash with probability s, so on some band of
``ROWS`` of them with 1 - (1 - s ** ROWS) ** BANDS: 0.99997 at 0.8. Every pair of a band's list is
compared by the whole sets, so nothing is linked below the similarity asked for.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import shingle_hashes, stored
from tidewatch.llm.components import in_blocks, spanning

BANDS = 20
ROWS = 4
# Lists are compared in blocks of about this many texts, by so many shingles at once.
BLOCK = 128
WIDTH = 4096

_RANDOM = np.random.default_rng(20)
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingle_set(text: str, words: int, seed: int) -> np.ndarray:
    """The sorted distinct shingle hashes; empty if there is no word."""
    return np.unique(shingle_hashes(text, words, seed))


def bands(found: np.ndarray) -> np.ndarray:
    """A key per band of a set that is not empty; the band's number is mixed in."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(found), WIDTH):
        part = found[start : start + WIDTH, None] * _FACTORS + _SHIFTS
        # A product's high bits depend on all bits of the hash, its low bits do not.
        np.minimum(least, (part ^ part >> np.uint64(32)).min(axis=0), out=least)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        key = (key ^ row) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def whole(text: str) -> Column:
    """The number of a whole text; a null text counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _alike(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs have a Jaccard similarity of at least ``similarity``, counted exactly."""
    sizes = np.array([len(found) for found in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Shingles of one text alone are in no intersection.
    several = times > 1
    place = np.cumsum(several) - 1
    owner, column = owner[several[column]], place[column[several[column]]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.float32)
    for start in range(0, int(several.sum()), WIDTH):
        a, b = np.searchsorted(column, [start, start + WIDTH])
        part = np.zeros((len(sets), WIDTH), dtype=np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        both += part @ part.T
    np.fill_diagonal(both, sizes)
    # Both sides are whole numbers up to the rounding of the product.
    return both >= similarity * (sizes[:, None] + sizes - both) - 1e-6


def links(
    docs: DataFrame,
    similarity: float,
    text: str = "text",
    words: int = 5,
    seed: int = 42,
    block: int = BLOCK,
) -> DataFrame:
    """``a, b``: links between numbers of texts (see ``whole``), as many as hold together those
    whose shingle sets are at least ``similarity`` alike and share a band.

    Exact copies are one text. Texts without words have no links. Only texts that share a band with
    another have their sets stored and joined. Lists are dealt out as by ``in_blocks``.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(value.as_py() or "", words, seed) for value in batch.column(1)]
            keys = [bands(found) if len(found) else None for found in sets]
            columns = [batch.column(0), pa.array(keys, type=pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["whole", "keys"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(v.as_py() or "", words, seed).tobytes() for v in batch.column(1)]
            columns = [batch.column(0), pa.array(sets, type=pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["whole", "shingles"])

    texts = docs.select(whole(text).alias("whole"), text)
    signed = texts.mapInArrow(sign, "whole long, keys array<long>")
    # Of exact copies one is left before anything is listed.
    listed = signed.select("whole", F.explode("keys").alias("key")).distinct()
    listed = stored(listed, "bands")
    shared = stored(in_blocks(listed, ["key"], "whole", block).select("key", "lo", "hi", "whole"), "lists")
    wanted = stored(shared.select("whole").distinct(), "candidates")
    found = texts.join(wanted, "whole").dropDuplicates(["whole"])
    sets = stored(found.mapInArrow(cut, "whole long, shingles binary"), "shingles")
    dealt = shared.join(sets, "whole").select("key", "lo", "hi", "whole", "shingles")
    group = ["key", "lo", "hi"]
    dealt = dealt.repartition(*group).sortWithinPartitions(*group)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, sets = None, [], []
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            for key, lo, hi, name, shingles in zip(*columns):
                if (key, lo, hi) != now:
                    yield from emit(nodes, sets)
                    now, nodes, sets = (key, lo, hi), [], []
                nodes.append(name)
                sets.append(np.frombuffer(shingles, dtype=np.uint64))
        yield from emit(nodes, sets)

    def emit(nodes: list[int], sets: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        if len(nodes) < 2:
            return
        child, parent = spanning(_alike(sets, similarity))
        if len(child):
            found = np.array(nodes, dtype=np.int64)
            ends = [pa.array(found[child]), pa.array(found[parent])]
            yield pa.RecordBatch.from_arrays(ends, names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")
