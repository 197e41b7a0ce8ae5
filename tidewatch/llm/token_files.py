"""Token ids in files of Huffman-coded blocks.

A folder holds ``code`` (the length of every id's code, from counts over all documents; the rest of
a canonical code follows from it), ``blocks`` and ``parts``. A block is some tens of thousands of ids
of consecutive documents and can be read alone: its bits, the bit offset of every ``STEP`` ids
(the checkpoints), and the key and number of ids of its documents, each of which starts at a byte.
Blocks number the ids before them within their part, the rows one task wrote; ``parts`` says how
many ids lie before a part. The files are Parquet, so any shared store and the committer's protocol
serve.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)
from pyspark.sql.window import Window

from tidewatch.llm import huffman, subwords
from tidewatch.llm.huffman import STEP
from tidewatch.sources import files

# A block is closed when it holds so many ids; a longer document is a block of its own.
BLOCK_IDS = 1 << 16
# Documents of so many ids are coded together, blocks of so many decoded side by side.
CODED_IDS = 1 << 18
DECODED_IDS = 1 << 20
# Texts of so many bytes are encoded together.
TEXT_BYTES = 1 << 23

_codes: dict[int, huffman.Code] = {}


def _code(table: tuple[bytes, bytes]) -> huffman.Code:
    """One per worker process; it holds a table of about 2 MB. The process is done with texts then."""
    key = hash(table)
    if key not in _codes:
        subwords.release()
        _codes.clear()
        _codes[key] = huffman.Code(*(np.frombuffer(column, dtype=np.int64) for column in table))
    return _codes[key]


def _planes(ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """For documents of ``counts`` 32-bit integers in ``ids``: as many runs of bytes as the largest
    integer has, low ones first, which the store's compression sees."""
    width = max(1, (int(ids.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(ids.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T)
    stops = np.cumsum(counts).tolist()
    return [planes[:, start:stop].tobytes() for start, stop in zip([0, *stops], stops)]


def _ids(planes: bytes, count: int) -> np.ndarray:
    out = np.zeros((count, 4), dtype=np.uint8)
    if count:
        out[:, : len(planes) // count] = np.frombuffer(planes, dtype=np.uint8).reshape(-1, count).T
    return out.view("<u4").ravel()


def _slices(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose ``sizes`` add up to about ``most``, to bound what a step holds. They are
    as equal as whole rows allow: each costs a look at all known segments."""
    total = int(sizes.sum())
    turns = (np.cumsum(sizes) - sizes) * max(1, round(total / most)) // max(1, total)
    starts = np.flatnonzero(np.r_[True, turns[1:] != turns[:-1]]) if len(turns) else []
    for start, stop in zip(starts, [*starts[1:], len(turns)]):
        yield batch.slice(start, stop - start)


def _bytes(batch: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy().astype(np.int64)


def _gathered(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Batches put together to ones of at least so many bytes of text, as far as there are more."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += int(_bytes(batch).sum())
        if size >= least:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def tokenize(docs: DataFrame, definition: str, end: int | None, key: str, text: str) -> DataFrame:
    """``key, n, planes`` of every row: its ids (a null text has none) and ``end`` after them. One more
    row of every task has ``ids`` and ``counts`` instead: how often each id came up in it."""
    shared = docs.sparkSession.sparkContext.broadcast(definition)
    kind = docs.schema[key].dataType

    def rows(keys: pa.Array, counts: np.ndarray, planes: list[bytes]) -> pa.RecordBatch:
        none = pa.nulls(len(keys), pa.binary())
        columns = [keys, pa.array(counts), pa.array(planes, type=pa.binary()), none, none]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = subwords.encoder(shared.value)
        held, key_type = np.zeros(0, dtype=np.int64), None
        for whole in _gathered(batches, TEXT_BYTES):
            key_type = whole.column(0).type
            for batch in _slices(whole, _bytes(whole), TEXT_BYTES):
                ids, counts = encoder.encode(batch.column(1))
                if end is not None:
                    ids, counts = np.insert(ids, np.cumsum(counts), end), counts + 1
                for first in range(0, len(ids), CODED_IDS):
                    found = np.bincount(ids[first : first + CODED_IDS], minlength=len(held))
                    found[: len(held)] += held
                    held = found
                yield rows(batch.column(0), counts, _planes(ids, counts))
                # What Arrow has freed goes back to the system, not to a pool that the process keeps.
                pa.default_memory_pool().release_unused()
        some = np.flatnonzero(held)
        if len(some):
            counted = [pa.array([column.tobytes()]) for column in (some, held[some])]
            none = [pa.nulls(1, t) for t in (key_type, pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([*none, *counted], names=names)

    binary = [StructField(name, BinaryType()) for name in ("planes", "ids", "counts")]
    schema = StructType([StructField("key", kind), StructField("n", LongType()), *binary])
    names = schema.fieldNames()
    return docs.select(key, text).mapInArrow(run, schema)


def _code_of(tokens: DataFrame) -> huffman.Code:
    """The code for the ids' counts over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                columns = [pa.array(np.frombuffer(value, dtype=np.int64)) for value in row]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "count"])

    every = tokens.where("ids IS NOT NULL").select("ids", "counts").mapInArrow(run, "id long, count long")
    counted = every.groupBy("id").agg(F.sum("count").alias("count")).toArrow()
    return huffman.code_of(*(counted.column(n).to_numpy().astype(np.int64) for n in range(2)))


def write(
    docs: DataFrame,
    folder: str,
    definition: str,
    end: int | None = None,
    key: str = "doc_id",
    text: str = "text",
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode the rows and write their ids to ``folder``, which must be new, by ascending key.

    A null key comes first; rows of equal keys follow each other in an order that depends on their
    ids alone, and repeated rows are kept. Null texts count as empty; other columns are not read; an
    empty table gives a folder without blocks. The tokenizer file is broadcast (a few MB, fixed), and
    so is the code, whose size the vocabulary bounds; its counts are all that comes to the driver.
    Coded rows are shuffled once, to ranges of keys, many rows of one key to several of them.
    """
    spark = docs.sparkSession
    tokens = _held(tokenize(docs, definition, end, key, text), f"{folder}/tokens", "zstd")
    code = _code_of(tokens)
    tokens = tokens.where("ids IS NULL").select("key", "n", "planes")
    lengths = pa.table({"id": code.symbols, "bits": code.lengths})
    spark.createDataFrame(lengths).coalesce(1).write.parquet(f"{folder}/code")
    shared = spark.sparkContext.broadcast((code.symbols.tobytes(), code.lengths.tobytes()))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _code(shared.value)
        for whole in batches:
            for batch in _slices(whole, whole.column(1).to_numpy(), CODED_IDS):
                counts = batch.column(1).to_numpy()
                each = zip(batch.column(2).to_pylist(), counts.tolist())
                payloads, lanes = table.encode(np.concatenate([_ids(*some) for some in each]), counts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(payloads, type=pa.binary()),
                        pa.array([some.tobytes() for some in lanes], type=pa.binary()),
                    ],
                    names=["key", "n", "payload", "lanes"],
                )

    kind = tokens.schema["key"].dataType
    binary = [StructField(name, BinaryType()) for name in ("payload", "lanes")]
    coded = tokens.mapInArrow(encode, StructType([*tokens.schema.fields[:2], *binary]))
    # Stored, as dealing by ranges reads its input twice.
    coded = _held(coded, f"{folder}/coded", "none")
    files.delete(spark, f"{folder}/tokens")
    # What is equal in all of these may be dealt to several tasks.
    order = [F.asc_nulls_first("key"), F.col("n"), F.xxhash64("payload"), F.col("turn")]
    dealt = coded.withColumn("turn", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*order).sortWithinPartitions(*order).drop("turn")
    blocks = dealt.mapInArrow(partial(_gather, block_ids=block_ids), _block_schema(kind))
    blocks.write.parquet(f"{folder}/blocks")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per task of the write.
    parts = (
        spark.read.schema(blocks.schema).parquet(f"{folder}/blocks")
        .groupBy("part")
        .agg(F.sum("n").alias("n"), F.sum(F.size("docs")).alias("docs"))
        .withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    )
    parts.coalesce(1).write.parquet(f"{folder}/parts")
    files.delete(spark, f"{folder}/coded")


def _held(df: DataFrame, path: str, compression: str) -> DataFrame:
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _block_schema(kind) -> StructType:
    docs = StructType([StructField("key", kind), StructField("n", LongType())])
    return StructType(
        [
            StructField("part", IntegerType()),
            StructField("first", LongType()),
            StructField("n", LongType()),
            StructField("docs", ArrayType(docs)),
            StructField("payload", BinaryType()),
            StructField("checkpoints", BinaryType()),
        ]
    )


def _gather(batches: Iterator[pa.RecordBatch], block_ids: int) -> Iterator[pa.RecordBatch]:
    """Blocks of the rows of one task, which come in order."""
    part, first = TaskContext.get().partitionId(), 0
    keys: list = []
    counts: list[int] = []
    payloads: list[bytes] = []
    lanes: list[np.ndarray] = []
    held = 0

    def block() -> pa.RecordBatch:
        offsets, base = [np.zeros(0, np.uint64)], 0
        for payload, bits in zip(payloads, lanes):
            ends = np.cumsum(bits, dtype=np.uint64)
            offsets.append(8 * base + ends - bits)
            base += len(payload)
        docs = pa.StructArray.from_arrays(
            [pa.array(keys, type=key_type), pa.array(counts, type=pa.int64())], names=["key", "n"]
        )
        return pa.RecordBatch.from_arrays(
            [
                pa.array([part], type=pa.int32()),
                pa.array([first], type=pa.int64()),
                pa.array([held], type=pa.int64()),
                pa.ListArray.from_arrays(pa.array([0, len(keys)], type=pa.int32()), docs),
                pa.array([b"".join(payloads)], type=pa.binary()),
                pa.array([np.concatenate(offsets).astype("<u8").tobytes()], type=pa.binary()),
            ],
            names=["part", "first", "n", "docs", "payload", "checkpoints"],
        )

    key_type = pa.null()
    for batch in batches:
        key_type = batch.column(0).type
        for key, n, payload, bits in zip(*(column.to_pylist() for column in batch.columns)):
            if held and held + n > block_ids:
                yield block()
                first, held = first + held, 0
                keys, counts, payloads, lanes = [], [], [], []
            keys.append(key)
            counts.append(n)
            payloads.append(payload)
            lanes.append(np.frombuffer(bits, dtype=np.uint16).astype(np.uint64))
            held += n
    if keys:
        yield block()


def _placed(spark: SparkSession, folder: str, kind) -> DataFrame:
    """The blocks, ``start`` being the ids of all documents before each."""
    blocks = spark.read.schema(_block_schema(kind)).parquet(f"{folder}/blocks")
    parts = spark.read.schema("part int, start long").parquet(f"{folder}/parts")
    return blocks.join(parts, "part").withColumn("start", F.col("start") + F.col("first"))


def _load_code(spark: SparkSession, folder: str):
    code = spark.read.schema("id long, bits long").parquet(f"{folder}/code").toArrow()
    columns = (code.column(n).to_numpy().astype(np.int64).tobytes() for n in range(2))
    return spark.sparkContext.broadcast(tuple(columns))


def _lanes(counts: np.ndarray) -> np.ndarray:
    """Ids in each lane of documents of ``counts`` ids."""
    lanes = -(-counts // STEP)
    out = np.full(int(lanes.sum()), STEP, dtype=np.int64)
    last = np.cumsum(lanes)[lanes > 0] - 1
    out[last] = (counts - (lanes - 1) * STEP)[lanes > 0]
    return out


def read(spark: SparkSession, folder: str, key: str = "doc_id", kind=LongType()) -> DataFrame:
    """``key, start, n, ids`` of every document, from the files: the ids of all documents before it,
    its own, and these as little-endian unsigned 32-bit integers one after the other. ``kind`` is the
    type the keys were written with. Blocks are decoded independently, without a shuffle."""
    shared = _load_code(spark, folder)
    names = ["start", "docs", "payload", "checkpoints"]
    out = [key, "start", "n", "ids"]

    def documents(rows: list[tuple]) -> pa.RecordBatch:
        payload = b"".join(row[2] for row in rows)
        bases = np.cumsum([0, *(len(row[2]) for row in rows)])[:-1] * 8
        keys = [doc["key"] for row in rows for doc in row[1]]
        counts = [np.array([doc["n"] for doc in row[1]], dtype=np.int64) for row in rows]
        offsets = [np.frombuffer(row[3], dtype="<u8") + np.uint64(b) for row, b in zip(rows, bases)]
        starts = [row[0] + np.cumsum(n) - n for row, n in zip(rows, counts)]
        every = np.concatenate(counts)
        ids = _code(shared.value).decode(payload, np.concatenate(offsets), _lanes(every))
        raw, cuts = ids.astype("<u4").tobytes(), [0, *(4 * np.cumsum(every)).tolist()]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys, type=key_type[0]),
                pa.array(np.concatenate(starts)),
                pa.array(every),
                pa.array([raw[a:b] for a, b in zip(cuts, cuts[1:])], type=pa.binary()),
            ],
            names=out,
        )

    key_type = [pa.null()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        held = 0
        for batch in batches:
            key_type[0] = batch.schema.field("docs").type.value_type.field("key").type
            for row in zip(*(batch.column(name).to_pylist() for name in names)):
                rows.append(row)
                held += sum(doc["n"] for doc in row[1])
                if held >= DECODED_IDS:
                    yield documents(rows)
                    rows, held = [], 0
        if rows:
            yield documents(rows)

    schema = StructType(
        [StructField(key, kind), *(StructField(n, LongType()) for n in out[1:3]),
         StructField("ids", BinaryType())]
    )
    return _placed(spark, folder, kind).select(*names).mapInArrow(run, schema)


def read_range(spark: SparkSession, folder: str, start: int, stop: int, kind=LongType()) -> DataFrame:
    """``start, ids``: the ids from number ``start`` up to ``stop`` of the whole folder, one row per
    block that holds some. Only those blocks are read, and of them what lies between the checkpoints
    around the range."""
    shared = _load_code(spark, folder)
    names = ["start", "docs", "payload", "checkpoints"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, docs, payload, marks in zip(*(batch.column(n).to_pylist() for n in names)):
                lanes = _lanes(np.array([doc["n"] for doc in docs], dtype=np.int64))
                ends = at + np.cumsum(lanes)
                some = (ends > start) & (ends - lanes < stop)
                if not some.any():
                    continue
                offsets = np.frombuffer(marks, dtype="<u8")[some]
                ids = _code(shared.value).decode(payload, offsets, lanes[some])
                first = int((ends - lanes)[some][0])
                low = max(start, first)
                wanted = ids[low - first : stop - first].astype("<u4").tobytes()
                columns = [pa.array([low], type=pa.int64()), pa.array([wanted], type=pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["start", "ids"])

    blocks = _placed(spark, folder, kind)
    inside = (F.col("start") < stop) & (F.col("start") + F.col("n") > start)
    return blocks.where(inside).select(*names).mapInArrow(run, "start long, ids binary")
