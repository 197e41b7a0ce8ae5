"""Document fingerprints by winnowing: the smallest k-gram hash of every window, with positions."""

import base64
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType
from pyspark.sql.window import Window

# Any run of GRAM + WINDOW - 1 equal characters is found in both texts.
GRAM = 12
WINDOW = 24
# Texts are dealt to tasks in ranges of keys of about this many documents.
RANGE_DOCUMENTS = 2_000
MAX_RANGES = 10_000

KEY_TYPES = {"tinyint": pa.int8(), "smallint": pa.int16(), "int": pa.int32(), "bigint": pa.int64()}
COMPARED = {
    "n_chars": "bigint",
    "edited_sha256": "string",
    "fingerprint": "string",
    "edited_fingerprint": "string",
    "near_edited": "double",
    "near_next": "double",
}

# One-element arrays wrap around silently, as wanted here.
_BASE = np.array([0x9E3779B97F4A7C15], dtype=np.uint64)
_MIX = np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFFFFFF)


def _gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """A polynomial hash of each run of ``gram`` code points, by joining shorter runs."""
    # ``run`` hashes runs of ``width``, ``done`` of ``have``; both are joined as binary digits say.
    run, width, weight = codes.astype(np.uint64) + np.uint64(1), 1, _BASE
    done, have = None, 0
    left = gram
    while True:
        if left & 1:
            if done is None:
                done = run
            else:
                size = min(len(done), len(run) - have)
                done = done[:size] * weight + run[have : have + size]
            have += width
        left >>= 1
        if not left:
            break
        run = run[: len(run) - width] * weight + run[width:]
        width, weight = 2 * width, weight * weight
    done = done ^ (done >> np.uint64(29))
    return (done * _MIX) >> np.uint64(32)


def winnow(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (uint32) and positions (code points) in order of position.

    Of equal hashes in a window the rightmost counts. A text with fewer than ``window`` k-grams
    has one window; one shorter than ``gram`` is a single k-gram; an empty one has none.
    """
    codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    if not len(codes):
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    hashes = _gram_hashes(codes, min(gram, len(codes)))
    # The hash above, the position from the right below: the minimum takes the rightmost.
    least = hashes << np.uint64(32) | (_LOW - np.arange(len(hashes), dtype=np.uint64))
    width = min(window, len(least))
    have = 1
    while have < width:
        step = min(have, width - have)
        least = np.minimum(least[: len(least) - step], least[step:])
        have += step
    least = least[np.r_[True, least[1:] != least[:-1]]]
    return (least >> np.uint64(32)).astype(np.uint32), (_LOW - (least & _LOW)).astype(np.int64)


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Twice the hashes in common by the hashes of both (as sets); 1 if neither has any."""
    a, b = np.unique(left), np.unique(right)
    if not len(a) and not len(b):
        return 1.0
    return 2 * len(np.intersect1d(a, b, assume_unique=True)) / (len(a) + len(b))


def as_text(hashes: np.ndarray) -> str:
    """A fingerprint as base64 of its hashes, four bytes each, in order of position."""
    return base64.b64encode(hashes.astype("<u4").tobytes()).decode()


def fingerprints(
    df: DataFrame, text: str = "text", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """All columns of ``df``, ``hashes`` (array of long) and ``positions`` (array of long), which
    replace columns of these names. A null text counts as empty. Row by row, no shuffle."""
    df = df.drop("hashes", "positions")
    kind = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [winnow(value.as_py() or "", gram, window) for value in batch.column(text)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([hashes.astype(np.int64) for hashes, _ in found], type=kind),
                    pa.array([positions for _, positions in found], type=kind),
                ],
                names=[*batch.schema.names, "hashes", "positions"],
            )

    added = [StructField(name, ArrayType(LongType())) for name in ("hashes", "positions")]
    return df.mapInArrow(run, StructType([*df.schema.fields, *added]))


def _range_of(bounds: list[int]) -> Callable[[Column], Column]:
    """A function that gives the number of a key's range; null goes to the lowest."""

    @F.pandas_udf("int")
    def find(keys: pd.Series) -> pd.Series:
        found = np.searchsorted(np.array(bounds, dtype=np.int64), keys.fillna(0).to_numpy(np.int64))
        return pd.Series(np.where(keys.isna(), 0, found).astype(np.int32))

    return find


def with_next(
    docs: DataFrame, key: str = "doc_id", text: str = "text", range_documents: int = RANGE_DOCUMENTS
) -> DataFrame:
    """``__range, __own, key, text`` dealt by ranges of keys and sorted so that the row after a
    document of its own range is the next one by descending key; the last one of a range is
    followed by a copy (``__own`` false) of the first document of the range below, after the lowest
    range of the highest.

    The text is shuffled once. Only range bounds, at most ``MAX_RANGES`` numbers, come to the
    driver; ids equal in all rows of a range are sorted by text.
    """
    count = docs.count()
    ranges = max(1, min(MAX_RANGES, count // range_documents))
    steps = [n / ranges for n in range(1, ranges)]
    bounds = docs.select(F.percentile_approx(key, steps, 10 * ranges)).first()[0] if steps else []
    placed = docs.select(key, F.coalesce(text, F.lit("")).alias(text)).withColumn(
        "__range", _range_of(sorted(set(bounds or [])))(F.col(key).cast("long"))
    )
    tops = placed.groupBy("__range").agg(F.max(key).alias("__top"))
    below, every = Window.orderBy("__range"), Window.partitionBy()
    follow = tops.select(
        F.col("__range").alias("__above"),
        F.coalesce(F.lag("__range").over(below), F.max("__range").over(every)).alias("__below"),
        F.coalesce(F.lag("__top").over(below), F.max_by("__top", "__range").over(every)).alias(
            "__first"
        ),
    )
    extra = (
        placed.join(
            F.broadcast(follow),
            (F.col("__range") == F.col("__below")) & F.col(key).eqNullSafe(F.col("__first")),
        )
        .groupBy(F.col("__above").alias("__range"))
        .agg(F.first(key).alias(key), F.min(text).alias(text))
        .select("__range", F.lit(False).alias("__own"), key, text)
    )
    own = placed.select("__range", F.lit(True).alias("__own"), key, text)
    return (
        own.unionByName(extra)
        .repartition("__range")
        .sortWithinPartitions(
            "__range", F.desc("__own"), F.desc_nulls_last(key), text
        )
    )


def edited(text: str, following: str) -> str:
    """``text`` with its second half replaced by as many first characters of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_next(
    docs: DataFrame, key: str = "doc_id", text: str = "text", gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """One row per row of ``docs``: ``key, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``, of its text, of its text edited with the next
    document's, and of that document's text.

    The next document is the one with the next smaller key, after the smallest the largest; rows
    of equal keys follow each other by text, null keys come last, and a table's only row is its
    own next. Null texts count as empty. Other columns are not read. Keys that are not whole numbers
    of 64 bits or fewer are a ``TypeError``: nothing says which document is next to which.
    """

    def rows(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            yield from zip(*(batch.column(n) for n in range(4)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        held = None
        for _, own, name, value in rows(batches):
            now = (name.as_py(), value.as_py() or "", own.as_py())
            found = winnow(now[1], gram, window)[0]
            if held is not None and held[0][2]:
                out.append(row(*held, now[1], found))
                if len(out) >= 1000:
                    yield batch_of(out)
                    out = []
            held = (now, found)
        if out:
            yield batch_of(out)

    def row(doc: tuple, found: np.ndarray, following: str, next_found: np.ndarray) -> tuple:
        changed = edited(doc[1], following)
        after = winnow(changed, gram, window)[0]
        return (
            doc[0], len(doc[1]), hashlib.sha256(changed.encode()).hexdigest(), as_text(found),
            as_text(after), likeness(found, after), likeness(found, next_found),
        )

    kind = docs.schema[key].dataType.simpleString()
    if kind not in KEY_TYPES:
        raise TypeError(f"a key is a whole number, not {kind}")
    names = list(COMPARED)
    schema = ", ".join([f"`{key}` {kind}", *(f"{name} {k}" for name, k in COMPARED.items())])
    types = [KEY_TYPES[kind], pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(column, type=t) for column, t in zip(zip(*out), types)]
        return pa.RecordBatch.from_arrays(columns, names=[key, *names])

    return with_next(docs, key, text).mapInArrow(run, schema)
