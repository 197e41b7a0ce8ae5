"""Log-probabilities of texts under a weighted backoff automaton over words.

Every n-gram of the training texts is an arc; its history is a state, and a state fails to that of
its next shorter history. Both grow with the texts, so no process ever holds them: texts are stored
in chunks as numbers of words, the chunks' distinct n-grams are dealt to slots by their hash, and a
slot answers each chunk with the counts of what it sent, in its order and without keys. A chunk then
walks its texts over the arcs it was answered. What a state gives back when it fails is summed in
slots too, from every n-gram once, for states that texts fail from.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm.common import held_out, stored_at
from tidewatch.session import remove, shuffles_dropped, work_dir

# The end of a text, as a word: no real word is empty.
END = b""
ORDER = 3
DISCOUNT = 0.5
# Bytes of texts that a chunk holds, and words of all texts for each slot.
CHUNK_CHARS = 6 << 20
SLOT_WORDS = 1 << 20
# Tells the hash that deals n-grams to slots from the one that names them within a slot.
SALT = np.uint64(0x9E3779B97F4A7C15)
LEAST = 1e-12


def _mix(numbers: np.ndarray) -> np.ndarray:
    """Other 64-bit numbers, one for each, that follow no pattern."""
    numbers = (numbers ^ (numbers >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    numbers = (numbers ^ (numbers >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return numbers ^ (numbers >> np.uint64(31))


def _pack(numbers: np.ndarray, ascending: bool = False) -> bytes:
    """Whole numbers, or the steps between ascending ones, byte by byte of equal weight, compressed."""
    numbers = np.ascontiguousarray(numbers, dtype=np.uint64)
    if ascending:
        numbers = np.diff(numbers, prepend=np.uint64(0))
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def _unpack(packed: bytes, ascending: bool = False) -> np.ndarray:
    size = int.from_bytes(packed[:8], "little")
    if not size:
        return np.zeros(0, dtype=np.uint64)
    planes = pa.decompress(packed[8:], decompressed_size=8 * size, codec="zstd", asbytes=True)
    numbers = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, size).T)
    numbers = numbers.view(np.uint64).ravel()
    return np.cumsum(numbers, dtype=np.uint64) if ascending else numbers


def _unique(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in ascending order, a row that has each, which one each row has."""
    # The leading bits of a hash leave room for its row, and numbers sort faster than rows by numbers.
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    by = (np.sort((keys & ~low) | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    ordered = keys[by]
    if (ordered[1:] < ordered[:-1]).any():
        by = np.argsort(keys)
        ordered = keys[by]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = ordered[1:] != ordered[:-1]
    which = np.empty(len(keys), dtype=np.int64)
    which[by] = np.cumsum(new) - 1
    return ordered[new], by[new], which


def _kept(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """``df`` stored, and where; what was shuffled for it is gone from the disks then."""
    path = work_dir(df.sparkSession, purpose)
    with shuffles_dropped(df.sparkSession):
        return stored_at(df, path), path


def encode(docs: DataFrame, text: str, learn: Column, key: Column | None = None) -> DataFrame:
    """A row per chunk of ``docs``: the ``words`` it has, by XXH64; its texts as a ``run`` of places in
    them, each text's end included; the ``sizes`` of its texts, whether to ``learn`` from them, and
    their ``keys``. Without a key the texts are not ``scored``."""
    limit, scored = CHUNK_CHARS, key is not None
    numbered = docs.select(
        (key if scored else F.lit(None).cast("long")).alias("key"),
        F.col(text).cast("binary").alias("text"),
        learn.alias("learn"),
        F.monotonically_increasing_id().alias("at"),
    )

    def chunk_of(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        part = pa.Table.from_batches(parts).combine_chunks()
        texts = [
            pa.array([*(value.as_py() or b"").lower().split(), END], pa.binary()) for value in part["text"]
        ]
        run = pa.concat_arrays(texts).dictionary_encode()
        words = [xxhash.xxh64_intdigest(word) for word in run.dictionary.to_pylist()]
        # Chunks that are only learned from come from other rows: their ids must differ.
        first = part["at"][0].as_py()
        keys = pa.concat_arrays(part["key"].chunks)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([first if scored else -1 - first], pa.int64()),
                pa.array([scored]),
                pa.array([len(run)], pa.int64()),
                pa.array([_pack(np.array(part["learn"]))], pa.binary()),
                pa.array([_pack(np.array([len(words) for words in texts]))], pa.binary()),
                pa.array([_pack(np.array(words, dtype=np.uint64))], pa.binary()),
                pa.array([_pack(run.indices.to_numpy())], pa.binary()),
                pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys),
            ],
            names=["chunk", "scored", "size", "learn", "sizes", "words", "run", "keys"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            parts.append(batch)
            size += batch.column(1).nbytes
            if size > limit:
                yield chunk_of(parts)
                parts, size = [], 0
        if parts:
            yield chunk_of(parts)

    schema = T.StructType(
        [
            T.StructField("chunk", T.LongType()),
            T.StructField("scored", T.BooleanType()),
            T.StructField("size", T.LongType()),
            *[T.StructField(name, T.BinaryType()) for name in ("learn", "sizes", "words", "run")],
            T.StructField("keys", T.ArrayType(numbered.schema["key"].dataType)),
        ]
    )
    return numbered.mapInArrow(run, schema)


class _Texts(NamedTuple):
    """The words of a chunk as hashes: ``text`` each is of, its ``place`` there, ``learn`` by text."""

    words: np.ndarray
    text: np.ndarray
    place: np.ndarray
    learn: np.ndarray


def _texts(row: dict) -> _Texts:
    sizes = _unpack(row["sizes"]).astype(np.int64)
    words = _unpack(row["words"])[_unpack(row["run"]).astype(np.int64)]
    place = np.arange(len(words)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return _Texts(words, np.repeat(np.arange(len(sizes)), sizes), place, _unpack(row["learn"]) > 0)


class _Grams(NamedTuple):
    """Distinct n-grams of one length in a chunk by slot and key; ``bounds`` part the slots, ``end``
    is a place where each ends, ``which`` the n-gram that ends at each word (-1: the text is shorter)."""

    keys: np.ndarray
    bounds: np.ndarray
    end: np.ndarray
    which: np.ndarray


def _grams(texts: _Texts, sizes: list[int], slots: int) -> Iterator[_Grams]:
    """The n-grams of these ascending ``sizes``."""
    key = deal = texts.words
    for size in range(1, sizes[-1] + 1):
        if size > 1:
            before, dealt = np.zeros_like(key), np.zeros_like(key)
            before[1:], dealt[1:] = _mix(key[:-1]), _mix(deal[:-1] ^ SALT)
            key, deal = before + texts.words, dealt + texts.words
        if size not in sizes:
            continue
        ends = np.flatnonzero(texts.place >= size - 1)
        keys, first, inverse = _unique(key[ends])
        first = ends[first]
        slot = ((_mix(deal[first] ^ SALT) >> np.uint64(32)) % np.uint64(slots)).astype(np.int64)
        by = np.argsort(slot.astype(np.min_scalar_type(slots)), kind="stable")
        rank = np.empty(len(by), dtype=np.int32)
        rank[by] = np.arange(len(by))
        which = np.full(len(key), -1, dtype=np.int32)
        which[ends] = rank[inverse]
        yield _Grams(keys[by], np.searchsorted(slot[by], np.arange(slots + 1)), first[by], which)


def _ask(runs: DataFrame, size: int, order: int, slots: int, pruned: bool) -> DataFrame:
    """``slot, chunk, keys, counts``: the distinct n-grams of ``size`` of every chunk, and twice how
    often they are learned from; one more for those that a scored text may fail from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                texts = _texts(row)
                (grams,) = _grams(texts, [size], slots)
                ends = np.flatnonzero(grams.which >= 0)
                learn = texts.learn[texts.text]
                counts = np.bincount(grams.which[ends], learn[ends], len(grams.keys)).astype(np.int64) * 2
                if row["scored"] and size < order:
                    follows = np.zeros(len(learn), dtype=bool)
                    follows[:-1] = (texts.place[1:] > 0) & (pruned | ~learn[1:])
                    counts[grams.which[ends[follows[ends]]]] |= 1
                parts = [(n, a, b) for n, (a, b) in enumerate(zip(grams.bounds, grams.bounds[1:])) if a < b]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([n for n, _, _ in parts], pa.int32()),
                        pa.array([row["chunk"]] * len(parts), pa.int64()),
                        pa.array([_pack(grams.keys[a:b], True) for _, a, b in parts], pa.binary()),
                        pa.array([_pack(counts[a:b]) for _, a, b in parts], pa.binary()),
                    ],
                    names=["slot", "chunk", "keys", "counts"],
                )

    schema = "slot int, chunk long, keys binary, counts binary"
    return runs.select("chunk", "scored", "learn", "sizes", "words", "run").mapInArrow(run, schema)


def _merged(table: pa.Table) -> tuple[np.ndarray, ...]:
    """What the chunks sent to a slot: distinct keys, a row that has each, which one each row has, counts."""
    keys = np.concatenate([_unpack(part, True) for part in table["keys"].to_pylist()])
    sent = np.concatenate([_unpack(part) for part in table["counts"].to_pylist()]).astype(np.int64)
    return (*_unique(keys), sent)


def _answers(asked: DataFrame) -> DataFrame:
    """``slot, chunk, counts``: for every n-gram that a chunk sent, in its order, four times its count
    in all; two more for the one chunk that answers for it, one more if a text may fail from it."""

    def answer(table: pa.Table) -> pa.Table:
        keys, first, which, sent = _merged(table)
        counts = np.bincount(which, sent >> 1).astype(np.int64) * 4
        wanted = np.zeros(len(keys), dtype=np.int64)
        wanted[which[sent % 2 == 1]] = 1
        found = (counts + wanted)[which]
        found[first] += 2
        stops = np.cumsum([int.from_bytes(part[:8], "little") for part in table["keys"].to_pylist()])
        parts = [_pack(part) for part in np.split(found, stops[:-1])]
        return pa.table(
            {"slot": table["slot"], "chunk": table["chunk"], "counts": pa.array(parts, pa.binary())}
        )

    return asked.groupBy("slot").applyInArrow(answer, "slot int, chunk long, counts binary")


def _counted(asked: DataFrame) -> DataFrame:
    """``slot, gram, c``: a row per n-gram that is learned, by its hashes, and its count."""

    def count(table: pa.Table) -> pa.Table:
        keys, _, which, sent = _merged(table)
        counts = np.bincount(which, sent >> 1).astype(np.int64)
        keys, counts = keys[counts > 0], counts[counts > 0]
        slot = np.full(len(keys), table["slot"][0].as_py(), dtype=np.int32)
        return pa.table({"slot": slot, "gram": keys.view(np.int64), "c": counts})

    return asked.groupBy("slot").applyInArrow(count, "slot int, gram long, c long")


@dataclass
class Automaton:
    """The learned texts as stored ``runs`` of chunks, and ``arcs[k]``, counted from them when read:
    the n-grams of order ``k + 1`` by their hashes with their count ``c``. ``arcs[0]`` has all words of
    the training texts; longer n-grams are followed from a count of ``least`` on."""

    arcs: list[DataFrame]
    runs: DataFrame
    tokens: int
    types: int
    unknown: float
    least: float
    discount: float


def train(
    docs: DataFrame,
    text: str = "text",
    order: int = ORDER,
    share: float = 0.0,
    discount: float = DISCOUNT,
) -> Automaton:
    """The automaton of all texts of ``docs``, which are stored.

    A unigram has its share of the tokens, less what is left for unseen words (as many tokens as
    there are words seen once, by Good and Turing; at most half). Longer n-grams are discounted by
    a constant, and what a history keeps back is spread over all other words in proportion to the
    shorter history's probabilities, so each state's probabilities sum to one. Only totals come to
    the driver. All n-grams are arcs, unless a ``share`` of the tokens is asked of those of two
    words and more.
    """
    runs, _ = _kept(encode(docs, text, F.lit(True)), "runs")
    return _automaton(runs, order, share, discount)


def _slots(runs: DataFrame) -> int:
    return 1 + (runs.agg(F.sum("size")).first()[0] or 0) // SLOT_WORDS


def _automaton(runs: DataFrame, order: int, share: float, discount: float) -> Automaton:
    slots = _slots(runs)
    arcs = [_counted(_ask(runs, size, order, slots, False)) for size in range(1, order + 1)]
    with shuffles_dropped(runs.sparkSession):
        totals = arcs[0].agg(F.sum("c"), F.count("*"), F.count_if(F.col("c") == 1)).first()
    tokens, types, once = (value or 0 for value in totals)
    unknown = min(max(once, 1) / (tokens + 1), 0.5) if tokens else 1.0
    return Automaton(arcs, runs, tokens, types, unknown, share * tokens, discount)


def score(docs: DataFrame, model: Automaton, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and, per row of ``docs``, ``n_tokens, n_known`` (tokens seen in training),
    ``train_tokens, base_score`` (sum of log10 add-one unigram probabilities) and ``score`` (log10
    probability of the text with its end).

    A null or empty text is its end alone. Rows are independent: repeated rows and null keys stay,
    an empty table gives an empty result. A word that has no arc takes the weight of its history,
    if that is a state, and goes on one word shorter.
    """
    runs, path = _kept(encode(docs, text, F.lit(False), F.col(key)), "runs")
    scores = _score(runs.unionByName(model.runs.drop("keys"), allowMissingColumns=True), model, key)
    remove(docs.sparkSession, path)
    return scores


def _score(runs: DataFrame, model: Automaton, key: str) -> DataFrame:
    """Scores of the scored texts of ``runs``, which hold all texts of the model."""
    spark, order, slots, paths = runs.sparkSession, len(model.arcs), _slots(runs), []
    answers = None
    for size in range(1, order + 1):
        asked = _ask(runs, size, order, slots, model.least > 0)
        answer, path = _kept(_answers(asked).select(F.lit(size).alias("size"), "*"), f"{size}-grams")
        answers = answer if answers is None else answers.unionByName(answer)
        paths.append(path)
    walked = runs.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    schema = T.StructType(
        [
            *[T.StructField(name, T.IntegerType()) for name in ("size", "slot")],
            T.StructField("chunk", T.LongType()),
            T.StructField("sums", T.ArrayType(T.BinaryType())),
            T.StructField("fails", T.ArrayType(T.BinaryType())),
            runs.schema["keys"],
            *[T.StructField(name, T.ArrayType(T.LongType())) for name in ("n_tokens", "n_known")],
            *[T.StructField(name, T.ArrayType(T.DoubleType())) for name in ("base_score", "score")],
        ]
    )
    walked, path = _kept(walked.applyInArrow(_walk(model, slots), schema), "walked")
    for used in paths:
        remove(spark, used)
    lost = (
        walked.where("slot IS NOT NULL").select("size", "slot", "chunk", "sums", "fails")
        .groupBy("size", "slot").applyInArrow(_weigh(model), "chunk long, text binary, lost binary")
        .groupBy("chunk").applyInArrow(_added, "chunk long, lost array<double>")
    )
    columns = ["keys", "n_tokens", "n_known", "base_score", "score"]
    found = (
        walked.where("slot IS NULL").select("chunk", *columns).join(lost, "chunk", "left")
        .withColumn("lost", F.coalesce("lost", F.array().cast("array<double>")))
        .select(F.explode(F.arrays_zip(*columns, "lost")).alias("found"))
        .select(
            F.col("found.keys").alias(key),
            "found.n_tokens",
            "found.n_known",
            F.lit(model.tokens).cast("long").alias("train_tokens"),
            "found.base_score",
            (F.col("found.score") + F.coalesce("found.lost", F.lit(0.0))).alias("score"),
        )
    )
    scores, _ = _kept(found, "scores")
    remove(spark, path)
    return scores


class _Arcs(NamedTuple):
    """The n-grams of one length in a chunk with what the slots answered: counts, whether there is an
    arc, whether this chunk answers for it, whether a text may fail from it."""

    grams: _Grams
    count: np.ndarray
    arc: np.ndarray
    own: np.ndarray
    wanted: np.ndarray


def _walk(model: Automaton, slots: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Scores of a chunk's texts up to what failing costs them; and per slot of histories ``sums`` over
    the arcs that the chunk answers for, and the ``fails`` of its texts."""
    order, least, discount = len(model.arcs), model.least, model.discount
    tokens, types, unknown = model.tokens, model.types, model.unknown

    def sums_of(longer: _Arcs, history: _Arcs) -> tuple[np.ndarray, ...]:
        """Histories, their arcs, how often these are taken, and how often without the first word."""
        own = np.flatnonzero(longer.arc & longer.own)
        end = longer.grams.end[own]
        own, end = (part[history.wanted[history.grams.which[end - 1]]] for part in (own, end))
        at, size = history.grams.which[end - 1], len(history.count)
        arcs = np.bincount(at, minlength=size)
        taken = np.bincount(at, longer.count[own], size)
        shorter = np.bincount(at, history.count[history.grams.which[end]], size)
        some = np.flatnonzero(arcs)
        return some, arcs[some], taken[some], shorter[some]

    def walk(chunk: pa.Table, answered: pa.Table) -> pa.Table:
        (row,) = chunk.drop_columns("keys").to_pylist()
        texts = _texts(row)
        answered = answered.sort_by([("size", "ascending"), ("slot", "ascending")])
        sizes = answered["size"].to_numpy()
        arcs: list[_Arcs] = []
        for size, grams in enumerate(_grams(texts, [*range(1, order + 1)], slots), 1):
            parts = answered["counts"].filter(pa.array(sizes == size)).to_pylist()
            found = np.concatenate([_unpack(part) for part in parts] or [np.zeros(0)]).astype(np.int64)
            count = found >> 2
            arc = (count > 0) & (count >= (least if size > 1 else 0))
            arcs.append(_Arcs(grams, count, arc, (found >> 1) % 2 == 1, found % 2 == 1))
        several = len(texts.learn)
        logs, left = np.zeros(len(texts.words)), np.full(len(texts.words), row["scored"])
        rows = []
        for size in range(order, 1, -1):
            longer, history = arcs[size - 1], arcs[size - 2]
            ends = np.flatnonzero(left & (texts.place >= size - 1))
            hit = longer.arc[longer.grams.which[ends]]
            taken, failed = ends[hit], ends[~hit]
            times = history.count[history.grams.which[taken - 1]]
            logs[taken] = np.log10((longer.count[longer.grams.which[taken]] - discount) / times)
            left[taken] = False
            # A history that was never seen is no state.
            failed = failed[history.count[history.grams.which[failed - 1]] > 0]
            pairs = history.grams.which[failed - 1].astype(np.int64) * several + texts.text[failed]
            pairs, often = np.unique(pairs, return_counts=True)
            states, state = np.unique(pairs // several, return_inverse=True)
            shorter = np.zeros_like(states)
            if size > 2:
                below = arcs[size - 3]
                shorter = below.count[below.grams.which[history.grams.end[states]]]
            some, *sums = sums_of(longer, history)
            cuts = np.searchsorted(some, history.grams.bounds)
            stops = np.searchsorted(states, history.grams.bounds)
            spans = np.searchsorted(state, stops)
            for slot in range(slots):
                a, b, c, d = cuts[slot], cuts[slot + 1], stops[slot], stops[slot + 1]
                if a == b and c == d:
                    continue
                e, f = spans[slot], spans[slot + 1]
                keys = history.grams.keys
                rows.append({
                    "size": size - 1,
                    "slot": slot,
                    "sums": [_pack(keys[some[a:b]], True), *[_pack(part[a:b]) for part in sums]],
                    "fails": [
                        _pack(keys[states[c:d]], True), _pack(history.count[states[c:d]]),
                        _pack(shorter[c:d]), _pack(state[e:f] - c, True),
                        _pack(pairs[e:f] % several), _pack(often[e:f]),
                    ],
                })
        words = arcs[0].count[arcs[0].grams.which]
        pa.default_memory_pool().release_unused()
        if row["scored"]:
            chance = np.where(words > 0, (1 - unknown) * words / max(tokens, 1), unknown)
            logs[left] = np.log10(chance[left])
            base = np.log10((words + 1) / float(tokens + types + 1))
            rows.append({
                "n_tokens": np.bincount(texts.text).tolist(),
                "n_known": np.bincount(texts.text, words > 0).astype(np.int64).tolist(),
                "base_score": np.bincount(texts.text, base).tolist(),
                "score": np.bincount(texts.text, logs).tolist(),
            })
        many = len(rows)
        kinds = {
            "size": pa.int32(), "slot": pa.int32(), "chunk": pa.int64(),
            "sums": pa.list_(pa.binary()), "fails": pa.list_(pa.binary()), "keys": None,
            "n_tokens": pa.list_(pa.int64()), "n_known": pa.list_(pa.int64()),
            "base_score": pa.list_(pa.float64()), "score": pa.list_(pa.float64()),
        }
        columns = {name: pa.array([r.get(name) for r in rows], kind) for name, kind in kinds.items() if kind}
        columns["chunk"] = pa.array([row["chunk"]] * many, pa.int64())
        own = pa.array([None] * (many - 1) + [0] if row["scored"] else [None] * many, pa.int64())
        columns["keys"] = chunk["keys"].combine_chunks().take(own)
        return pa.table({name: columns[name] for name in kinds})

    return walk


def _weigh(model: Automaton) -> Callable[[pa.Table], pa.Table]:
    """What each text loses, in logarithms, where it fails from the histories of a slot."""
    tokens, unknown, discount = model.tokens, model.unknown, model.discount

    def weigh(table: pa.Table) -> pa.Table:
        size, sent = table["size"][0].as_py(), table["sums"].to_pylist()
        keys, _, which = _unique(np.concatenate([_unpack(part[0], True) for part in sent]))
        arcs, taken, shorter = (
            np.bincount(which, np.concatenate([_unpack(part[n]) for part in sent]), len(keys)) for n in (1, 2, 3)
        )
        fails = table["fails"].to_pylist()
        states = [_unpack(part[0], True) for part in fails]
        stops = np.cumsum([len(part) for part in states])
        states = np.concatenate(states)
        times, below = (np.concatenate([_unpack(part[n]) for part in fails]).astype(np.int64) for n in (1, 2))
        # Without arcs, a history is no state and costs nothing.
        at = np.searchsorted(keys, states)
        known = np.flatnonzero(at < len(keys))
        known = known[keys[at[known]] == states[known]]
        at, times, below = at[known], times[known], below[known]
        kept_back = (times - taken[at] + discount * arcs[at]) / times
        if size > 1:
            others = (below - shorter[at] + discount * arcs[at]) / below
        else:
            others = (tokens - (1 - unknown) * shorter[at]) / tokens
        costs = np.zeros(len(states))
        costs[known] = np.log10(np.maximum(kept_back, LEAST) / np.maximum(others, LEAST))
        chunks, losers, losses = [], [], []
        for chunk, part, cost in zip(table["chunk"].to_pylist(), fails, np.split(costs, stops[:-1])):
            if not len(cost):
                continue
            state, text, often = (_unpack(part[n], n == 3).astype(np.int64) for n in (3, 4, 5))
            loss = np.bincount(text, often * cost[state])
            some = np.flatnonzero(loss)
            if len(some):
                chunks.append(chunk)
                losers.append(_pack(some, True))
                losses.append(_pack(loss[some].view(np.uint64)))
        return pa.table({
            "chunk": pa.array(chunks, pa.int64()),
            "text": pa.array(losers, pa.binary()),
            "lost": pa.array(losses, pa.binary()),
        })

    return weigh


def _added(table: pa.Table) -> pa.Table:
    """What each text of a chunk loses in all slots; texts after the last that loses are left out."""
    text = np.concatenate([_unpack(part, True) for part in table["text"].to_pylist()]).astype(np.int64)
    lost = np.concatenate([_unpack(part) for part in table["lost"].to_pylist()]).view(np.float64)
    sums = pa.array([np.bincount(text, lost)], pa.list_(pa.float64()))
    return pa.table({"chunk": table["chunk"][:1], "lost": sums})


def train_and_score(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    folds: int = 7,
    held_fold: int = 2,
    order: int = ORDER,
    share: float = 0.0,
) -> DataFrame:
    """Scores of all of ``docs`` under a model of those outside the held-out fold (see ``score``);
    ``held_out`` says which rows those are. A row with a null key is never held out. Texts are
    stored once, to learn from and to be scored."""
    out = held_out(F.col(key), folds, held_fold)
    runs, path = _kept(encode(docs, text, ~out, F.col(key)), "runs")
    scored = _score(runs, _automaton(runs, order, share, DISCOUNT), key)
    remove(docs.sparkSession, path)
    return scored.select(key, out.alias("held_out"), *scored.columns[1:])
