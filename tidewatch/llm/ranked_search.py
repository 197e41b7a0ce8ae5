"""Ranked lexical search: MaxScore whose bounds come from pairs of terms.

Documents are indexed in blocks, each holding the postings of the terms that are asked for. Once the
counts over all documents are known, a second pass gives every posting its impact (its share of a
score) and stores, per block, the largest impact of every term and, for pairs of terms of one query,
the list of documents that hold both with their joint impacts and the largest of these. A query's
terms are taken in such pairs: a pair adds at most its joint maximum to a document that holds both,
and the larger of the two single maxima to any other, which is less than the sum of both. Blocks and
lists whose combined bounds stay below the score of the k-th best document so far are skipped; what
is left is scored in full, so the result is exact.
"""

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType
from pyspark.sql.window import Window

from tidewatch.llm.common import stored

# The maximal runs of ASCII letters and digits and of anything beyond ASCII, in UTF-8.
TERMS = re.compile(rb"[0-9A-Za-z\x80-\xff]+").findall
# A block is closed when it holds so many documents or postings.
BLOCK_DOCUMENTS = 4_096
BLOCK_POSTINGS = 1 << 20
# Queries of about this many characters are answered by one pass over the documents.
QUERY_CHARS = 4_000_000
# A pair has a list if the rarer term is in at most one document of so many: short lists prune most.
PAIR_SHARE = 8


class Unit(NamedTuple):
    """One or two terms of a query and how often it holds them; ``second`` is -1 for one."""

    first: int
    times: int
    second: int = -1
    second_times: int = 0


class Query(NamedTuple):
    number: int
    units: list[Unit]


class Plan(NamedTuple):
    """What the tasks are told: weights of the terms, pairs with lists, queries, counts."""

    weights: np.ndarray
    pairs: list[Unit]
    queries: list[Query]
    documents: int
    total: int


def terms_of(text: str | None) -> list[bytes]:
    return TERMS((text or "").encode().lower())


def _ints(raw: bytes, kind: str = "<i8") -> np.ndarray:
    return np.frombuffer(raw, dtype=kind)


def _ends(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(sizes)])


# --- the index ----------------------------------------------------------------------------

_POSTINGS = ["keys", "lengths", "terms", "sizes", "places", "tfs"]


def _indexed(
    docs: DataFrame, asked: list[bytes], key: str, text: str, block_documents: int
) -> DataFrame:
    """Blocks: keys and lengths of the documents; the terms, the sizes of their lists, and the lists,
    places in the block and term frequencies, one after the other. All terms are counted in the
    lengths, lists are kept of those that are asked for."""
    shared = docs.sparkSession.sparkContext.broadcast(asked)
    kind = docs.schema[key].dataType

    def block(keys: list, lengths: list[int], found: list[np.ndarray], key_type) -> pa.RecordBatch:
        counts = np.array([len(some) for some in found])
        place = np.repeat(np.arange(len(found)), counts)
        term, tf = (np.concatenate([some[:, n] for some in found]) for n in range(2))
        order = np.argsort(term, kind="stable")
        terms, sizes = np.unique(term, return_counts=True)
        arrays = [np.array(lengths), terms, sizes, place[order], tf[order]]
        columns = [pa.array([column.astype("<i8" if n == 0 else "<i4").tobytes()])
                   for n, column in enumerate(arrays)]
        return pa.RecordBatch.from_arrays(
            [pa.array([keys], type=pa.list_(key_type)), *columns], names=_POSTINGS
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: n for n, term in enumerate(shared.value)}.get
        keys: list = []
        lengths: list[int] = []
        found: list[np.ndarray] = []
        held, key_type = 0, pa.null()
        for batch in batches:
            key_type = batch.column(0).type
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = terms_of(value.as_py())
                counts = Counter(map(number, tokens))
                counts.pop(None, None)
                some = np.array(sorted(counts.items()), dtype=np.int64).reshape(-1, 2)
                keys.append(name)
                lengths.append(len(tokens))
                found.append(some)
                held += len(some)
                if len(keys) >= block_documents or held >= BLOCK_POSTINGS:
                    yield block(keys, lengths, found, key_type)
                    keys, lengths, found, held = [], [], [], 0
        if keys:
            yield block(keys, lengths, found, key_type)

    binary = [StructField(name, BinaryType()) for name in _POSTINGS[1:]]
    schema = StructType([StructField("keys", ArrayType(kind)), *binary])
    return docs.select(key, text).mapInArrow(run, schema)


def _counts(blocks: DataFrame) -> tuple[int, int, dict[int, int]]:
    """Documents with a term, all their terms, and in how many documents each asked term is: at most
    a number per term comes to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw, terms, sizes in zip(*(column.to_pylist() for column in batch.columns)):
                lengths = _ints(raw)
                ids = np.concatenate([[-2, -1], _ints(terms, "<i4")])
                totals = [np.count_nonzero(lengths), lengths.sum()]
                values = np.concatenate([totals, _ints(sizes, "<i4")])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids.astype(np.int64)), pa.array(values.astype(np.int64))],
                    names=["id", "n"],
                )

    rows = blocks.select("lengths", "terms", "sizes").mapInArrow(run, "id long, n long")
    counted = dict(rows.groupBy("id").agg(F.sum("n")).collect())
    return counted.pop(-2, 0), counted.pop(-1, 0), counted


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def units_of(times: dict[int, int], weights: np.ndarray, holding: dict[int, int], rare: float) -> list[Unit]:
    """The terms of a query, heaviest first, two and two where one of them is rare enough."""
    order = sorted(times, key=lambda term: (-times[term] * weights[term], term))
    units = []
    while order:
        first = order.pop(0)
        if order and min(holding[first], holding[order[0]]) <= rare:
            second = order.pop(0)
            (a, m), (b, n) = sorted([(first, times[first]), (second, times[second])])
            units.append(Unit(a, m, b, n))
        else:
            units.append(Unit(first, times[first]))
    return units


class Block:
    """One block's lists with impacts, and the lists of pairs, by place."""

    def __init__(self, size: int, terms: np.ndarray, sizes: np.ndarray, places: np.ndarray, impacts: np.ndarray):
        self.size = size
        ends = _ends(sizes)
        self.lists = {
            term: (places[a:b], impacts[a:b]) for term, a, b in zip(terms.tolist(), ends, ends[1:])
        }
        self.most = {term: int(some[1].max()) for term, some in self.lists.items()}
        self.pairs: dict[int, tuple[np.ndarray, int]] = {}

    def joint(self, pair: Unit) -> tuple[np.ndarray, np.ndarray]:
        """The documents with both terms of a pair and their joint impacts."""
        left, right = self.lists.get(pair.first), self.lists.get(pair.second)
        if left is None or right is None:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        both, a, b = np.intersect1d(left[0], right[0], assume_unique=True, return_indices=True)
        return both, left[1][a] * pair.times + right[1][b] * pair.second_times

    def impacts(self, term: int, places: np.ndarray) -> np.ndarray:
        """The term's impact on each of these documents, 0 where it is not."""
        some = self.lists.get(term)
        if some is None:
            return np.zeros(len(places), np.int64)
        at = np.minimum(np.searchsorted(some[0], places), len(some[0]) - 1)
        return np.where(some[0][at] == places, some[1][at], 0)


_INDEX = ["keys", "terms", "sizes", "places", "impacts", "pairs", "pair_sizes", "pair_places", "pair_most"]
_KINDS = {"terms": "<i4", "sizes": "<i4", "places": "<i4", "impacts": "<i8", "pairs": "<i4",
          "pair_sizes": "<i4", "pair_places": "<i4", "pair_most": "<i8"}


def _with_impacts(blocks: DataFrame, shared, k: int) -> DataFrame:
    """Blocks with impacts and pair lists, and in rows without keys, one per task, the ``k`` largest
    impacts of each term and pair (``terms`` and ``pairs`` by ``sizes``, ``impacts``)."""

    def keep(best: dict, name: int, impacts: np.ndarray) -> None:
        some = np.concatenate([best.get(name, np.zeros(0, np.int64)), impacts])
        best[name] = np.sort(some)[-k:]

    def row(keys: pa.Array, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
        raw = [pa.array([columns[name].astype(kind).tobytes()]) for name, kind in _KINDS.items()]
        return pa.RecordBatch.from_arrays([keys, *raw], names=_INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan: Plan = shared.value
        best: dict[int, np.ndarray] = {}
        key_type = None
        for batch in batches:
            key_type = batch.column(0).type
            for n, raw in enumerate(zip(*(batch.column(name).to_pylist() for name in _POSTINGS[1:]))):
                lengths = _ints(raw[0])
                terms, sizes, places, tfs = (_ints(some, "<i4") for some in raw[1:])
                damping = 75 + 25 * lengths * plan.documents // plan.total
                tf = tfs.astype(np.int64)
                share = 1_000_000_000 * tf // (1000 * tf + 12 * damping[places])
                impacts = np.repeat(plan.weights[terms], sizes) * share
                block = Block(len(lengths), terms, sizes, places, impacts)
                for term, (_, some) in block.lists.items():
                    keep(best, term, some)
                found = []
                for number, pair in enumerate(plan.pairs):
                    both, joint = block.joint(pair)
                    if len(both):
                        found.append((number, both, joint.max()))
                        keep(best, -1 - number, joint)
                columns = {
                    "terms": terms, "sizes": sizes, "places": places, "impacts": impacts,
                    "pairs": np.array([number for number, _, _ in found]),
                    "pair_sizes": np.array([len(both) for _, both, _ in found]),
                    "pair_places": np.concatenate([np.zeros(0, np.int32), *(some[1] for some in found)]),
                    "pair_most": np.array([most for _, _, most in found]),
                }
                yield row(batch.column(0).slice(n, 1), columns)
        if best:
            none = {name: np.zeros(0) for name in _KINDS}
            tops = {
                "terms": np.array(list(best)),
                "sizes": np.array([len(some) for some in best.values()]),
                "impacts": np.concatenate(list(best.values())),
            }
            yield row(pa.nulls(1, key_type), {**none, **tops})

    binary = [StructField(name, BinaryType()) for name in _INDEX[1:]]
    return blocks.mapInArrow(run, StructType([blocks.schema["keys"], *binary]))


def _kth(index: DataFrame, k: int) -> dict[int, int]:
    """The k-th largest impact of each term, and of each pair under -1 - its number, over all blocks;
    those with fewer documents are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, sizes, impacts in zip(*(column.to_pylist() for column in batch.columns)):
                names = np.repeat(_ints(terms, "<i4"), _ints(sizes, "<i4")).astype(np.int64)
                columns = [pa.array(names), pa.array(_ints(impacts))]
                yield pa.RecordBatch.from_arrays(columns, names=["name", "impact"])

    tops = index.where("keys IS NULL").select("terms", "sizes", "impacts")
    rows = tops.mapInArrow(run, "name long, impact long")
    place = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("impact")))
    return dict(
        rows.withColumn("place", place).where(f"place = {k}").select("name", "impact").collect()
    )


# --- the queries --------------------------------------------------------------------------


def candidates(block: Block, units: list[Unit], pair_number: dict[Unit, int], least: int):
    """The documents that may score ``least`` or more, and their scores; all others score less.

    Units go by falling bound. ``rest[j]`` bounds what the units from ``j`` on can add, so a document
    that only they reach is not looked at once that is too little. A pair whose single terms are too
    little with the units behind it gives the documents of its own list alone.
    """
    bounded = []
    for unit in units:
        single = max(
            unit.times * block.most.get(unit.first, 0), unit.second_times * block.most.get(unit.second, 0)
        )
        both, joint = block.pairs.get(pair_number.get(unit, -1), (None, 0))
        bounded.append((max(single, joint), single, unit, both))
    bounded = sorted((some for some in bounded if some[0] > 0), key=lambda some: -some[0])
    rest = np.cumsum([0, *(some[0] for some in reversed(bounded))])[::-1].tolist()
    reached = []
    for j, (_, single, unit, both) in enumerate(bounded):
        if rest[j] < least:
            break
        if single + rest[j + 1] >= least:
            reached += [block.lists[t][0] for t in (unit.first, unit.second) if t in block.lists]
        elif both is not None:
            reached.append(both)
    if not reached:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    seen = np.zeros(block.size, dtype=bool)
    for places in reached:
        seen[places] = True
    places = np.flatnonzero(seen)
    scores = np.zeros(len(places), dtype=np.int64)
    for j, (_, _, unit, _) in enumerate(bounded):
        scores += unit.times * block.impacts(unit.first, places)
        if unit.second >= 0:
            scores += unit.second_times * block.impacts(unit.second, places)
        hopeful = scores + rest[j + 1] >= least
        places, scores = places[hopeful], scores[hopeful]
    return places, scores


def _best(held: list[tuple], keys: list, places: np.ndarray, scores: np.ndarray, k: int) -> list[tuple]:
    """The first k of ``held`` and the new documents by falling score, then key, null first."""
    if len(scores) > k:
        enough = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        places, scores = places[enough], scores[enough]
    new = [(score, keys[place]) for place, score in zip(places.tolist(), scores.tolist())]
    return sorted(held + new, key=lambda row: (-row[0], *((1, row[1]) if row[1] is not None else (0,))))[:k]


def _answered(index: DataFrame, shared, least: dict[int, int], k: int) -> DataFrame:
    """``number, key, score``: every task's k best documents of each query; a task's later blocks are
    measured by what it has found before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan: Plan = shared.value
        pair_number = {pair: n for n, pair in enumerate(plan.pairs)}
        floor = dict(least)
        held: dict[int, list[tuple]] = {}
        key_type = pa.null()
        for batch in batches:
            key_type = batch.column(0).type.value_type
            for keys, *raw in zip(*(column.to_pylist() for column in batch.columns)):
                columns = dict(zip(_KINDS, (_ints(some, kind) for some, kind in zip(raw, _KINDS.values()))))
                block = Block(len(keys), *(columns[name] for name in list(_KINDS)[:4]))
                ends = _ends(columns["pair_sizes"])
                for n, pair in enumerate(columns["pairs"].tolist()):
                    some = columns["pair_places"][ends[n] : ends[n + 1]]
                    block.pairs[pair] = (some, int(columns["pair_most"][n]))
                for number, units in plan.queries:
                    places, scores = candidates(block, units, pair_number, floor.get(number, 1))
                    if not len(places):
                        continue
                    held[number] = _best(held.get(number, []), keys, places, scores, k)
                    if len(held[number]) == k:
                        floor[number] = max(floor.get(number, 1), held[number][-1][0])
        rows = [(number, key, score) for number, some in held.items() for score, key in some]
        if rows:
            columns = [pa.array(column, type=kind)
                       for column, kind in zip(zip(*rows), (pa.int64(), key_type, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["number", "key", "score"])

    kind = index.schema["keys"].dataType.elementType
    schema = StructType(
        [StructField("number", LongType()), StructField("key", kind), StructField("score", LongType())]
    )
    return index.where("keys IS NOT NULL").mapInArrow(run, schema)


def _planned(asked: list[tuple[int, list[bytes]]], terms: list[bytes], blocks: DataFrame) -> Plan | None:
    documents, total, holding = _counts(blocks)
    if not documents:
        return None
    number = {term: n for n, term in enumerate(terms)}
    weights = np.zeros(len(terms), dtype=np.int64)
    for term, n in holding.items():
        weights[term] = weight(documents, n)
    queries = []
    for name, some in asked:
        times = Counter(number[term] for term in some if number[term] in holding)
        queries.append(Query(name, units_of(times, weights, holding, documents / PAIR_SHARE)))
    pairs = sorted({unit for query in queries for unit in query.units if unit.second >= 0})
    return Plan(weights, pairs, queries, documents, total)


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 20,
    key: str = "doc_id",
    text: str = "text",
    query_key: str = "item_id",
    query_text: str = "text",
    block_documents: int = BLOCK_DOCUMENTS,
) -> DataFrame:
    """``query_key, rank, key, score``: the ``k`` best documents of every query with a score above 0.

    A score sums weight times damped frequency over the query's terms, repeats included, in whole
    numbers; equal scores go by ascending key, null first. Every row of ``docs`` and of ``queries`` is
    one document and one query, repeated rows and null keys too; a null text has no terms, and a query
    without a term that some document holds has no rows, nor has any in an empty table. Other columns
    are not read.

    Queries are answered in batches, dealt by a hash so that a batch has about ``QUERY_CHARS`` characters,
    each by passes over all documents; a batch's terms and queries are broadcast. Nothing is shuffled
    but counts per term and the best documents of each task.
    """
    spark = docs.sparkSession
    named = queries.select(F.col(query_key).alias("query"), F.col(query_text).alias("text"))
    named = stored(named.withColumn("number", F.monotonically_increasing_id()), "queries")
    batches = 1 + (named.agg(F.sum(F.length("text"))).first()[0] or 0) // QUERY_CHARS
    found = spark.createDataFrame(
        [], StructType([StructField("number", LongType()), StructField("key", docs.schema[key].dataType),
                        StructField("score", LongType())])
    )
    for batch in range(batches):
        mine = F.expr(f"pmod(xxhash64(number), {batches}) = {batch}")
        asked = [(row.number, terms_of(row.text)) for row in named.where(mine).collect()]
        terms = sorted({term for _, some in asked for term in some})
        blocks = stored(_indexed(docs, terms, key, text, block_documents), "blocks")
        plan = _planned(asked, terms, blocks)
        if plan is None:
            continue
        shared = spark.sparkContext.broadcast(plan)
        index = stored(_with_impacts(blocks, shared, k), "index")
        kth = _kth(index, k)
        pair_number = {pair: n for n, pair in enumerate(plan.pairs)}
        least = {}
        for query in plan.queries:
            known = [1]
            for unit in query.units:
                known += [kth.get(unit.first, 0) * unit.times, kth.get(unit.second, 0) * unit.second_times]
                known.append(kth.get(-1 - pair_number.get(unit, -1), 0) if unit.second >= 0 else 0)
            least[query.number] = max(known)
        found = found.unionByName(stored(_answered(index, shared, least, k), "answers"))
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_first("key"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(named.select("number", "query"), "number").select(
        F.col("query").alias(query_key), "rank", F.col("key").alias(key), "score"
    )
