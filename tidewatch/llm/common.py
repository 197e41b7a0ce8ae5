"""What the operators share: reading tables, stored intermediates, column helpers."""

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import configure, work_dir

# Rows and bytes of one Arrow batch: long documents must not add up to more than a task's memory.
BATCH_ROWS = 512
BATCH_BYTES = 16 << 20

# The characters that count as white space in keys and between words.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def prepare(spark: SparkSession) -> SparkSession:
    """The session settings the operators are written for."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared work folder and read back.

    Cuts the lineage: a lost executor costs a re-read, and several readers cost one computation.
    """
    return stored_at(df, work_dir(df.sparkSession, purpose))


def stored_at(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(name: str, df: DataFrame) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the key as text falls into ``fold``; a null key never does."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == fold, F.lit(False))


def shingle_hashes(text: str, shingle: int, seed: int) -> np.ndarray:
    """XXH64 of every word shingle, repeats included."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(b" ".join(words), seed)], dtype=np.uint64)
    joined = b" ".join(words)
    stops = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.r_[0, stops[:-1] + 1]
    ends = stops[shingle - 1 :].tolist()
    return np.array(
        [digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends)], dtype=np.uint64
    )
