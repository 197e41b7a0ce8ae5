"""Reversible line deduplication: exact reference tables behind sharded cuckoo filters.

The index keeps one row per document and line key (the reference), and per shard of the key space
a cuckoo filter of the keys that any document holds. A new batch asks the filters first: most keys
are surely new and need no look into the references. Counts are exact, so a deletion that takes
the last reference of a key also takes its tag out of the filter, and a line that was dropped in
favour of a deleted document comes back.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidewatch.llm.common import BLANKS, lower_ascii, stored, unused
from tidewatch.llm.cuckoo import FULL, CuckooFilter

MIN_CHARS = 10
FILTERS = "shard int, tags binary, held long"


def line_keys(text: Column, min_chars: int) -> Column:
    """Digests of the distinct keys of a text that are long enough to count."""
    keys = F.transform(
        F.split(F.coalesce(text, F.lit("")), "\n", -1),
        lambda line: lower_ascii(F.btrim(line, F.lit(BLANKS))),
    )
    long_enough = F.filter(keys, lambda key: F.length(key) >= min_chars)
    return F.array_distinct(F.transform(long_enough, lambda key: F.unhex(F.md5(key))))


def _digest(line: str, min_chars: int) -> bytes | None:
    """The same key digest for one line; None if the key is too short."""
    key = line.strip(BLANKS)
    return hashlib.md5(key.encode().lower()).digest() if len(key) >= min_chars else None


def _digests(column: pa.ChunkedArray) -> np.ndarray:
    """A binary(16) column as n x 2 unsigned longs."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(-1, 2)


class LineIndex:
    """The state of a line deduplication, in generations below one shared folder.

    ``insert`` and ``delete`` write a generation each; it counts once its filters, written last,
    are there, so a failed call can be repeated. Documents are named by a long key; a document
    whose key is null is left out of the index and keeps all its lines. Rows with the same key are
    one document.
    """

    def __init__(self, spark: SparkSession, folder: str, shards: int, min_chars: int = MIN_CHARS):
        self.spark, self.folder = spark, folder
        self.shards, self.min_chars = shards, min_chars
        self.generation = 0

    def _refs(self) -> DataFrame:
        """Live references ``line, doc``: added and not taken away again."""
        schema = "line binary, doc long, sign int"
        if not self.generation:
            return self.spark.createDataFrame([], schema).drop("sign")
        paths = [f"{self.folder}/refs/{n}" for n in range(1, self.generation + 1)]
        refs = self.spark.read.schema(schema).parquet(*paths)
        if self.generation == 1:
            return refs.drop("sign")
        return refs.groupBy("line", "doc").agg(F.sum("sign").alias("n")).where("n > 0").drop("n")

    def filters(self) -> DataFrame:
        """``shard, tags, held``: the filters of the newest generation and their keys."""
        schema = FILTERS
        if not self.generation:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/filters/{self.generation}")

    def _shard(self) -> Column:
        return F.expr(f"CAST(pmod(xxhash64(line), {self.shards}) AS INT)").alias("shard")

    def _batch(self, docs: DataFrame, key: str, text: str) -> DataFrame:
        return (
            docs.where(F.col(key).isNotNull())
            .select(
                F.col(key).cast("long").alias("doc"),
                F.explode(line_keys(F.col(text), self.min_chars)).alias("line"),
            )
            .dropDuplicates(["line", "doc"])
        )

    def maybe_known(self, lines: DataFrame) -> DataFrame:
        """Those of the distinct ``line`` values that some document may hold already."""

        def ask(keys: pa.Table, filters: pa.Table) -> pa.Table:
            if not keys.num_rows or not filters.num_rows:
                return keys.select(["line"]).slice(0, 0)
            held = CuckooFilter(0, filters.column("tags")[0].as_py())
            return keys.select(["line"]).filter(pa.array(held.contains(_digests(keys["line"]))))

        sharded = lines.select("line", self._shard())
        return (
            sharded.groupBy("shard")
            .cogroup(self.filters().groupBy("shard"))
            .applyInArrow(ask, "line binary")
        )

    def insert(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> None:
        """Add the lines of ``docs``. Documents that are there already count once."""
        batch = self._batch(docs, key, text)
        number = self.generation + 1
        if self.generation:
            known = self.maybe_known(batch.select("line").distinct())
            held = self._refs().join(known, "line", "left_semi")
            batch = batch.join(held, ["line", "doc"], "left_anti")
        path = f"{self.folder}/refs/{number}"
        batch.select("line", "doc", F.lit(1).alias("sign")).write.mode("overwrite").parquet(path)
        added = self.spark.read.parquet(path).select("line").distinct()
        if self.generation:
            held = self._refs().select("line").join(known, "line", "left_semi").distinct()
            added = added.join(held, "line", "left_anti")
        self._commit(number, added, None)

    def delete(self, keys: DataFrame) -> None:
        """Take back the documents whose keys are in the first column of ``keys``."""
        number = self.generation + 1
        gone = keys.select(F.col(f"`{keys.columns[0]}`").cast("long").alias("doc")).distinct()
        path = f"{self.folder}/refs/{number}"
        (
            self._refs().join(gone, "doc", "left_semi")
            .select("line", "doc", F.lit(-1).alias("sign"))
            .write.mode("overwrite").parquet(path)
        )
        touched = self.spark.read.parquet(path).select("line").distinct()
        self.generation = number
        dead = touched.join(self._refs(), "line", "left_anti")
        self.generation = number - 1
        self._commit(number, None, dead)

    def _commit(self, number: int, added: DataFrame | None, dead: DataFrame | None) -> None:
        """Bring the filters up to date shard by shard and make generation ``number`` count."""
        change = added if dead is None else dead
        taking = dead is not None

        def update(keys: pa.Table, filters: pa.Table) -> pa.Table:
            found = _digests(keys["line"]) if keys.num_rows else np.zeros((0, 2), np.uint64)
            shard = (keys if keys.num_rows else filters)["shard"][0].as_py()
            if not filters.num_rows:
                held = CuckooFilter.of(found)
            else:
                held = CuckooFilter(0, filters["tags"][0].as_py())
                held.remove(found) if taking else held.add(found)
            size = pa.array([len(held)], type=pa.int64())
            return pa.table(
                {"shard": pa.array([shard], pa.int32()), "tags": [held.to_bytes()], "held": size}
            )

        filters = self.filters()
        if not taking and self.generation:
            # Shards without room are built anew from the references.
            sizes = change.select(self._shard()).groupBy("shard").count()
            grown = filters.join(sizes, "shard").where(self._short_of_room()).select("shard")
            every = self._refs().select("line").distinct().select("line", self._shard())
            again = every.join(F.broadcast(grown), "shard", "left_semi")
            filters = filters.join(F.broadcast(grown), "shard", "left_anti")
            lines = change.select("line", self._shard()).unionByName(again)
        else:
            lines = change.select("line", self._shard())
        (
            lines.groupBy("shard").cogroup(filters.groupBy("shard"))
            .applyInArrow(update, FILTERS)
            .write.mode("overwrite").parquet(f"{self.folder}/filters/{number}")
        )
        self.generation = number

    @staticmethod
    def _short_of_room() -> Column:
        """Whether a filter would be over its load with ``count`` more keys; a tag is two bytes."""
        return F.col("held") + F.col("count") > F.octet_length("tags") / 2 * FULL

    def repeated(self) -> DataFrame:
        """``line, owner, refs``: keys of at least two documents and the smallest of these."""
        return (
            self._refs()
            .groupBy("line")
            .agg(F.min("doc").alias("owner"), F.max("doc").alias("last"), F.count("*").alias("refs"))
            .where("owner < last")
            .drop("last")
        )

    def clean(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """``docs`` with repeated lines left in their owner only, plus ``n_lines`` (before) and
        ``n_dropped``, which replace columns of these names. A null text becomes the empty text,
        which is one empty line. Other columns and repeated rows pass through."""
        docs = docs.drop("n_lines", "n_dropped")
        of, drop = unused("__doc", docs), unused("__drop", docs)
        # Stored, so that the join below is between two shuffles and a hot line can be split.
        repeated = stored(self.repeated(), "repeated-lines")
        drops = (
            self._refs().join(repeated, "line").where("doc <> owner")
            .groupBy(F.col("doc").alias(of)).agg(F.collect_set("line").alias(drop))
        )
        joined = docs.join(drops, docs[key].cast("long") == drops[of], "left").drop(of)
        fields = [
            StructField(text, StringType()) if field.name == text else field
            for field in docs.schema
        ]
        schema = StructType(
            [*fields, StructField("n_lines", LongType()), StructField("n_dropped", LongType())]
        )
        names, at, min_chars = docs.columns, docs.columns.index(text), self.min_chars

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                kept, before, dropped = [], [], []
                for value, drop in zip(batch.column(at), batch.column(len(names))):
                    lines = (value.as_py() or "").split("\n")
                    gone = set(drop.as_py() or ())
                    rest = (
                        [line for line in lines if _digest(line, min_chars) not in gone]
                        if gone
                        else lines
                    )
                    kept.append("\n".join(rest))
                    before.append(len(lines))
                    dropped.append(len(lines) - len(rest))
                columns = list(batch.columns[: len(names)])
                columns[at] = pa.array(kept, type=pa.string())
                columns += [pa.array(before, type=pa.int64()), pa.array(dropped, type=pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        return joined.mapInArrow(run, schema)
