"""Byte-level BPE: texts to token ids and back, by replaying the merges over distinct pieces.

A task looks up the distinct blank-separated segments of its texts in a table of those it has seen;
the pieces of new ones are laid out in matrices, a row of symbols each, and the merge of lowest rank
of every row is done in one step, until no row has one. The ids of all texts are then gathered at
once. No shuffle: a document's ids depend on its own text only, and memory is bounded by a group of
texts plus a table of bounded size.
"""

import base64
import heapq
from array import array
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

# Pieces longer than this are merged one by one with a heap of their own; the others in matrices as
# wide as the first of these widths that holds them.
LONG_PIECE = 200
WIDTHS = (8, 12, 16, 24, 48, 96, LONG_PIECE)
# Up to so many segments of up to so many bytes are kept, some 50 bytes each.
CACHE_ENTRIES = 200_000
KEPT_BYTES = 64
# Documents are encoded in groups of about this many characters.
GROUP_CHARS = 2 << 20
# No symbol, behind the end of a piece; no merge, above all ranks.
PAD, NONE = -1, np.iinfo(np.int32).max


def load_ranks(path: str) -> bytes:
    """The rank file's text; read on the driver, so executors need no copy of it."""
    with open(path, "rb") as file:
        return file.read()


def _ranks(ranks: bytes) -> dict[bytes, int]:
    lines = (line.split() for line in ranks.splitlines() if line.strip())
    return {base64.b64decode(token): int(number) for token, number in lines}


def _runs(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all runs, one run after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


class Merges:
    """The rank table: token bytes by id, and the merged token of each pair of neighbours."""

    def __init__(self, ranks: bytes):
        self.rank = _ranks(ranks)
        self.single = np.array([self.rank[bytes([byte])] for byte in range(256)], dtype=np.int32)
        keys, found = array("q"), array("i")
        for token, number in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    found.append(number)
        order = np.argsort(np.array(keys))
        self._keys, self._merged = np.array(keys)[order], np.array(found)[order]
        self._whole = pa.array(self.rank.keys(), type=pa.binary())
        self._numbers = np.array(list(self.rank.values()), dtype=np.int32)

    @cached_property
    def pairs(self) -> dict[int, int]:
        return dict(zip(self._keys.tolist(), self._merged.tolist()))

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The token each pair merges into, ``NONE`` where there is none."""
        if not len(self._keys):
            return np.full(left.shape, NONE, dtype=np.int32)
        keys = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._merged[at], NONE)

    def replay(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces one after the other, and how many each has."""
        raw = pieces.cast(pa.binary())
        size = pc.binary_length(raw).to_numpy()
        whole = pc.fill_null(pc.index_in(raw, value_set=self._whole), -1).to_numpy()
        known = np.flatnonzero(whole >= 0)
        rows, counts, ids = [known], [np.ones(len(known), np.int64)], [self._numbers[whole[known]]]
        for place in np.flatnonzero((whole < 0) & (size > LONG_PIECE)).tolist():
            found = self._replay_long(raw[place].as_py())
            rows.append(np.array([place]))
            counts.append(np.array([len(found)]))
            ids.append(found)
        least = 0
        for width in WIDTHS:
            short = np.flatnonzero((whole < 0) & (size > least) & (size <= width))
            least = width
            for some, symbols in self._replay_rows(raw.take(pa.array(short)), width):
                rows.append(short[some])
                counts.append((symbols != PAD).sum(axis=1))
                ids.append(symbols[symbols != PAD])
        place, count = np.concatenate(rows), np.concatenate(counts)
        order = np.argsort(place)
        starts = (np.cumsum(count) - count)[order]
        return np.concatenate(ids)[_runs(starts, count[order])], count[order]

    def _replay_rows(self, pieces: pa.BinaryArray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of pieces and their ids, a padded row each, as they are done."""
        if not len(pieces):
            return
        size = pc.binary_length(pieces).to_numpy()[:, None]
        column = np.arange(width)
        text = np.frombuffer(b"".join(pieces.to_pylist()), dtype=np.uint8)
        place = np.minimum(np.cumsum(size)[:, None] - size + column, len(text) - 1)
        symbols = np.where(column < size, self.single[text[place]], PAD).astype(np.int32)
        pairs = self.merged(symbols[:, :-1], symbols[:, 1:])
        number = np.arange(len(symbols))
        while len(number):
            # The leftmost of the pairs of lowest rank.
            at = pairs.argmin(axis=1)
            rank = pairs[np.arange(len(at)), at]
            done = rank == NONE
            if done.any():
                yield number[done], symbols[done]
                number, symbols, pairs = number[~done], symbols[~done], pairs[~done]
                at, rank = at[~done], rank[~done]
            row, last = np.arange(len(number)), pairs.shape[1] - 1
            symbols[row, at] = rank
            symbols = _without(symbols, at + 1)
            if not last:
                yield number, symbols
                return
            pairs = _without(pairs, np.minimum(at + 1, last))
            after = row[at < last]
            here = at[after]
            pairs[after, here] = self.merged(symbols[after, here], symbols[after, here + 1])
            before = row[at > 0]
            here = at[before]
            pairs[before, here - 1] = self.merged(symbols[before, here - 1], symbols[before, here])

    def _replay_long(self, piece: bytes) -> np.ndarray:
        symbol = self.single[np.frombuffer(piece, dtype=np.uint8)].tolist()
        size = len(symbol)
        right, left = [*range(1, size), -1], list(range(-1, size - 1))
        pairs = self.pairs
        pair = [pairs.get(a << 32 | b, -1) for a, b in zip(symbol, symbol[1:])] + [-1]
        queue = [(token, at) for at, token in enumerate(pair) if token >= 0]
        heapq.heapify(queue)
        while queue:
            token, at = heapq.heappop(queue)
            if pair[at] != token:
                continue
            gone = right[at]
            after, before = right[gone], left[at]
            symbol[at], symbol[gone], pair[gone], right[at] = token, -1, -1, after
            pair[at] = -1
            if after >= 0:
                left[after] = at
                pair[at] = pairs.get(token << 32 | symbol[after], -1)
                if pair[at] >= 0:
                    heapq.heappush(queue, (pair[at], at))
            if before >= 0:
                pair[before] = pairs.get(symbol[before] << 32 | token, -1)
                if pair[before] >= 0:
                    heapq.heappush(queue, (pair[before], before))
        return np.array([s for s in symbol if s >= 0], dtype=np.int32)


def _without(rows: np.ndarray, column: np.ndarray) -> np.ndarray:
    """The rows, each without its entry in its ``column``."""
    keep = np.ones(rows.shape, dtype=bool)
    keep[np.arange(len(rows)), column] = False
    return rows[keep].reshape(len(rows), rows.shape[1] - 1)


class Encoder:
    """Texts to ids, with a table from blank-separated segment to ids that lasts for a task."""

    def __init__(self, merges: Merges, pattern: str):
        self.merges = merges
        self.split = regex.compile(pattern).findall
        # The segments that are kept, and their ids one after the other; a size of -1 says that a
        # segment has none of its own.
        self.segments = pa.array([], type=pa.string())
        self.flat = np.zeros(0, dtype=np.int32)
        self.starts = self.sizes = np.zeros(0, dtype=np.int64)

    def encode(self, texts: Iterable[str]) -> list[bytes]:
        ids, counts = self.encode_all(pa.array(texts, type=pa.string()))
        return [some.tobytes() for some in np.split(ids, np.cumsum(counts)[:-1])] if len(counts) else []

    def encode_all(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has; a null has none."""
        texts = texts.cast(pa.string()).fill_null("")
        length = pc.utf8_length(texts).to_numpy().astype(np.int64)
        turns = (np.cumsum(length) - length) // GROUP_CHARS
        borders = [0, *(np.flatnonzero(turns[1:] != turns[:-1]) + 1).tolist(), len(texts)]
        found = [self._encode(texts.slice(a, b - a)) for a, b in zip(borders, borders[1:]) if a < b]
        none = np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64)
        ids, counts = zip(none, *found)
        return np.concatenate(ids), np.concatenate(counts)

    def _encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """No match of the pattern goes on over a space that follows a non-blank, so the segments
        between spaces can be split on their own. Where blanks stand on both sides of a space that
        does not hold: segments that start with a blank, or are empty, have no ids of their own,
        and a text with one of them is split as a whole. So is the head of a text, which no space
        goes before."""
        parts = pc.split_pattern(texts, " ")
        borders = parts.offsets.to_numpy().astype(np.int64)
        borders -= borders[0]
        heads, flat = borders[:-1], parts.flatten()
        inner = np.ones(len(flat), dtype=bool)
        inner[heads] = False
        every = flat.filter(pa.array(inner)).dictionary_encode()
        kept = self._places(every.dictionary)
        which = kept[every.indices.to_numpy()]
        starts, sizes = np.zeros((2, len(flat)), dtype=np.int64)
        starts[inner], sizes[inner] = self.starts[which], self.sizes[which]
        odd = np.add.reduceat(sizes < 0, heads) > 0
        sizes[np.repeat(odd, np.diff(borders))] = 0
        whole = pc.if_else(pa.array(odd), texts, flat.take(pa.array(heads)))
        split = [self.split(text) for text in whole.to_pylist()]
        counts = np.array([len(some) for some in split], dtype=np.int64)
        own, own_starts, own_sizes = self._ids([piece for some in split for piece in some], counts)
        starts[heads], sizes[heads] = len(self.flat) + own_starts, own_sizes
        ids = np.concatenate([self.flat, own])[_runs(starts, sizes)]
        if len(self.segments) > CACHE_ENTRIES or self.longest > KEPT_BYTES:
            self._trim(kept)
        return ids, np.add.reduceat(sizes, heads)

    def _ids(self, pieces: list[str], counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of runs of so many pieces one after the other, where each run's start and how
        many there are."""
        every = pa.array(pieces, type=pa.string()).dictionary_encode()
        flat, sizes = self.merges.replay(every.dictionary)
        which = every.indices.to_numpy()
        starts, each = (np.cumsum(sizes) - sizes)[which], sizes[which]
        ends = np.r_[0, np.cumsum(each)][np.r_[0, np.cumsum(counts)]]
        return flat[_runs(starts, each)], ends[:-1], np.diff(ends)

    def _places(self, segments: pa.StringArray) -> np.ndarray:
        """Where the ids of these different segments are; new ones are learned."""
        at = pc.fill_null(pc.index_in(segments, value_set=self.segments), -1).to_numpy().astype(np.int64)
        missing = np.flatnonzero(at < 0)
        new = segments.take(pa.array(missing))
        at[missing] = len(self.segments) + np.arange(len(missing))
        texts = new.to_pylist()
        plain = np.array([bool(part) and not part[0].isspace() for part in texts], dtype=bool)
        # Each plain segment begins with the only space of its pieces.
        pieces = self.split("".join([" " + part for part, own in zip(texts, plain) if own]))
        first = np.flatnonzero([piece[0] == " " for piece in pieces])
        ids, starts, sizes = self._ids(pieces, np.diff(np.r_[first, len(pieces)]))
        places = np.full((2, len(new)), -1, dtype=np.int64)
        places[:, plain] = len(self.flat) + starts, sizes
        self.flat = np.concatenate([self.flat, ids])
        self.segments = pa.concat_arrays([self.segments, new])
        self.starts = np.concatenate([self.starts, places[0]])
        self.sizes = np.concatenate([self.sizes, places[1]])
        self.longest = pc.max(pc.binary_length(new)).as_py() or 0
        return at

    def _trim(self, used: np.ndarray) -> None:
        """Keep what was used last, if that is not too much, and the newer half of the rest, but no
        long segments."""
        keep = np.arange(len(self.segments)) >= len(self.segments) - CACHE_ENTRIES // 2
        if len(used) <= CACHE_ENTRIES // 2:
            keep[used] = True
        keep &= pc.less_equal(pc.binary_length(self.segments), KEPT_BYTES).to_numpy(zero_copy_only=False)
        self.segments = self.segments.filter(pa.array(keep))
        starts, sizes = self.starts[keep], self.sizes[keep]
        own = np.maximum(sizes, 0)
        self.flat = self.flat[_runs(starts, own)]
        self.starts, self.sizes = np.cumsum(own) - own, sizes


_tables: dict[int, Merges] = {}
_tokens: dict[int, pa.Array] = {}


def _table(ranks: bytes) -> Merges:
    """One per worker process; a worker keeps it over many tasks, but no table of segments, which
    would take memory from whatever the worker does next."""
    key = hash(ranks)
    if key not in _tables:
        _tables.clear()
        _tables[key] = Merges(ranks)
    return _tables[key]


def _by_id(ranks: bytes) -> pa.Array:
    """The bytes of each id, one table per worker process; null where a number is no id."""
    key = hash(ranks)
    if key not in _tokens:
        token = {number: token for token, number in _ranks(ranks).items()}
        _tokens.clear()
        _tokens[key] = pa.array(map(token.get, range(max(token) + 1)), type=pa.large_binary())
    return _tokens[key]


def _joined(ids: pa.ListArray, tokens: pa.Array) -> pa.BinaryArray:
    found = tokens.take(ids.flatten())
    if found.null_count:
        raise ValueError("an id is null or outside the vocabulary")
    sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
    borders = np.r_[0, np.cumsum(pc.binary_length(found).to_numpy())]
    offsets = borders[np.r_[0, np.cumsum(sizes)]].astype(np.int32)
    # The taken bytes lie one after the other.
    data = found.buffers()[2] or pa.py_buffer(b"")
    return pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(offsets), data])


def _appended(df: DataFrame, column: str, kind, prepare: Callable) -> DataFrame:
    """``df`` with one more column; ``prepare`` makes, once per task, the function that computes it
    from an Arrow batch."""
    schema = StructType([*df.schema.fields, StructField(column, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = prepare()
        for batch in batches:
            names = [*batch.schema.names, column]
            yield pa.RecordBatch.from_arrays([*batch.columns, function(batch)], names=names)
            # What Arrow has freed goes back to the system, not to a pool that the process keeps.
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def encode(
    df: DataFrame, ranks: bytes, pattern: str, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """All columns of ``df`` and the token ids of ``text`` as an array of int.

    A null text counts as empty and gives an empty array. An existing column named ``ids`` is
    replaced, other extra columns pass through. Rows are independent: repeated rows stay, an
    empty table gives an empty result. Special tokens are ordinary text. ``ranks`` is the text of
    a rank file and must hold all 256 single bytes; it is broadcast (about 1 MB, fixed).
    """
    df = df.drop(ids)
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def prepare() -> Callable[[pa.RecordBatch], pa.Array]:
        encoder = Encoder(_table(shared.value), pattern)

        def column(batch: pa.RecordBatch) -> pa.Array:
            found, counts = encoder.encode_all(batch.column(text))
            ends = np.r_[0, np.cumsum(counts)].astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(found))

        return column

    return _appended(df, ids, ArrayType(IntegerType()), prepare)


def decode(df: DataFrame, ranks: bytes, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns of ``df`` and the bytes that ``ids`` stand for, as binary.

    A null array counts as empty; an id outside the vocabulary is an error. An existing column
    named ``out`` is replaced.
    """
    df = df.drop(out)
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def prepare() -> Callable[[pa.RecordBatch], pa.Array]:
        tokens = _by_id(shared.value)
        return lambda batch: _joined(batch.column(ids), tokens)

    return _appended(df, out, BinaryType(), prepare)
