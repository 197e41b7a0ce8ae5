"""Texts to ids with a tokenizer file of the ``tokenizers`` library."""

import os
import re
import unicodedata
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Up to so many segments of up to so many characters are kept, some 50 bytes each.
KEPT_CHARS = 64
CACHE_ENTRIES = 600_000
# So many words become Python strings, and so many runs places, at a time.
SOME_WORDS = 1 << 12
SOME_RUNS = 1 << 17
# Fixed value: bytes that are no visible character of Latin-1 count on from 256, in order.
_HIDDEN = [n for n in range(256) if not (33 <= n <= 126 or 161 <= n <= 172 or n >= 174)]
VISIBLE = {byte: 256 + place for place, byte in enumerate(_HIDDEN)}
# Up to here no character combines with another, and none but this one changes its kind in lower case.
LAST_PLAIN = 0x2AF
DOTTED = "İ"


def _plain(kind: str) -> str:
    """The plain characters of a Unicode category, for a character class."""
    found = [chr(n) for n in range(LAST_PLAIN + 1) if unicodedata.category(chr(n)).startswith(kind)]
    return "".join(map(re.escape, found))


_L, _N, _S = _plain("L"), _plain("N"), re.escape("\t\n\x0b\x0c\r\x85") + _plain("Z")
# Fixed value: the words of the tokenizer file's own pattern, among plain characters.
WORDS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
_WORD = f"^[{_plain('Ll')}]+$"
_ODD = f"[^\x00-{chr(LAST_PLAIN)}]|{DOTTED}"
# A comma or full stop that ends a run of punctuation, which is one word.
_RUN = f"[^{_S}{_L}{_N}][,.][ \n]"


def _prepared(texts: pa.StringArray) -> pa.StringArray:
    """The texts with blanks between parts none of whose words lies in two, and one behind; plain ones
    in lower case and with most punctuation apart, so that most parts are words and few are new."""
    odd = pc.match_substring_regex(texts, _ODD)
    lower = pc.if_else(odd, texts, pc.utf8_lower(texts))
    blank = pc.replace_substring(pc.binary_join_element_wise(lower, "", " "), "\n", " ")
    apart = pc.replace_substring(pc.replace_substring(blank, ", ", " , "), ". ", " . ")
    return pc.if_else(pc.or_(odd, pc.match_substring_regex(blank, _RUN)), blank, apart)


class Encoder:
    """A tokenizer for lower-cased words with word ends, whose tokens never span white space.

    The ids of a text are those of the segments between its blanks, and the ids of a segment those of
    its words, one after the other. The different segments of a batch are looked up once each, new
    ones are cut into words, and the library encodes the new words. Segments with a character outside
    the plain ones are put to the library as they are.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        # The names of special tokens are ordinary text in a document.
        self.tokenizer.encode_special_tokens = True
        if not getattr(self.tokenizer.model, "end_of_word_suffix", None):
            raise ValueError("the tokenizer has no word ends")
        # The segments that are kept, their ids one after the other, and how often batches had them.
        self.words = pa.array([], type=pa.string())
        self.flat = np.zeros(0, dtype=np.uint32)
        self.starts = self.lengths = self.uses = np.zeros(0, dtype=np.int32)

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each has; a null has none."""
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        parts = pc.split_pattern(_prepared(texts.fill_null("")), " ")
        every = parts.flatten().dictionary_encode()
        kept = self._places(every.dictionary)
        which = every.indices.to_numpy()
        ids, sizes = _runs(self.flat, self.starts[kept], self.lengths[kept], which)
        borders = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[parts.offsets.to_numpy()]
        if len(self.words) > CACHE_ENTRIES or self.longest > KEPT_CHARS:
            self._trim()
        return ids, np.diff(borders)

    def _places(self, segments: pa.StringArray) -> np.ndarray:
        """Where the ids of these different segments are; new ones are learned."""
        at = pc.fill_null(pc.index_in(segments, value_set=self.words), -1).to_numpy().copy()
        missing = np.flatnonzero(at < 0)
        new = segments.take(pa.array(missing))
        ids, lengths = self._learn(new)
        at[missing] = len(self.words) + np.arange(len(missing))
        starts = len(self.flat) + np.cumsum(lengths) - lengths
        self.flat = np.concatenate([self.flat, ids])
        self.words = pa.concat_arrays([self.words, new])
        self.starts = np.concatenate([self.starts, starts.astype(np.int32)])
        self.lengths = np.concatenate([self.lengths, lengths.astype(np.int32)])
        self.uses = np.concatenate([self.uses, np.zeros(len(missing), np.int32)])
        self.uses[at] += 1
        self.longest = pc.max(pc.utf8_length(new)).as_py() or 0
        return at

    def _trim(self) -> None:
        """Keep no long segments and, if there are too many, those that most batches had, of equal
        ones the newer. Old uses count half from then on."""
        keep = np.flatnonzero(pc.less_equal(pc.utf8_length(self.words), KEPT_CHARS).to_numpy(False))
        if len(keep) > CACHE_ENTRIES:
            order = np.lexsort((keep, self.uses[keep]))
            keep = np.sort(keep[order[-(CACHE_ENTRIES // 2) :]])
            self.uses = self.uses >> 1
        self.words, self.uses = self.words.take(pa.array(keep)), self.uses[keep]
        self.flat, self.lengths = _runs(self.flat, self.starts, self.lengths, keep)
        self.starts = (np.cumsum(self.lengths) - self.lengths).astype(np.int32)

    def _learn(self, segments: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the segments one after the other, and how many each has."""
        odd = pc.match_substring_regex(segments, _ODD).to_numpy(False)
        word = pc.match_substring_regex(segments, _WORD).to_numpy(False)
        mixed = segments.filter(pa.array(~odd & ~word)).to_numpy(False)
        split = [WORDS.findall(part.lower()) for part in mixed]
        inner = pa.array([part for some in split for part in some], type=pa.string()).dictionary_encode()
        single = self._ids(segments.filter(pa.array(word)))
        ids, sizes = self._ids(inner.dictionary)
        ids, sizes = _runs(ids, np.cumsum(sizes) - sizes, sizes, inner.indices.to_numpy())
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.cumsum([0, *map(len, split)])]
        whole = self._whole(segments.filter(pa.array(odd)).to_pylist())
        # One kind of segments after the other, then as they came.
        flat, lengths = (np.concatenate(some) for some in zip(single, (ids, np.diff(ends)), whole))
        order = np.argsort(np.concatenate([np.flatnonzero(some) for some in (word, ~odd & ~word, odd)]))
        return _runs(flat, np.cumsum(lengths) - lengths, lengths, order)

    def _ids(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The library's model takes a word with its bytes as visible characters."""
        tokenize = self.tokenizer.model.tokenize
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for start in range(0, len(words), SOME_WORDS):
            some = words.slice(start, SOME_WORDS)
            # No word has a blank. Joined, they are one Python string to make and to replace in.
            rows = pa.ListArray.from_arrays(pa.array([0, len(some)], type=pa.int32()), some)
            text = pc.binary_join(rows, " ")[0].as_py().encode().decode("latin-1")
            for byte, place in VISIBLE.items():
                text = text.replace(chr(byte), chr(place)) if byte != 0x20 else text
            found = [[token.id for token in tokenize(word)] for word in text.split(" ")]
            ids.append(np.array([*chain.from_iterable(found)], dtype=np.uint32))
            sizes.append(np.array([*map(len, found)], dtype=np.int64))
        return np.concatenate(ids), np.concatenate(sizes)

    def _whole(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False) if parts else []
        found = [np.array(some.ids, dtype=np.uint32) for some in found]
        return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([*map(len, found)], dtype=np.int64)


def _runs(
    flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, which: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Of runs of ``flat``, those named by ``which`` one after the other, and their sizes; some at a
    time, as the places take more memory than the numbers."""
    sizes = sizes[which]
    out, at = np.empty(int(sizes.sum(dtype=np.int64)), dtype=flat.dtype), 0
    for first in range(0, len(which), SOME_RUNS):
        some = sizes[first : first + SOME_RUNS]
        ends = np.cumsum(some, dtype=np.int64)
        places = np.repeat(starts[which[first : first + SOME_RUNS]] - ends + some, some)
        places += np.arange(ends[-1])
        out[at : at + len(places)] = flat[places]
        at += len(places)
    return out, sizes


_encoders: dict[int, Encoder] = {}


def encoder(definition: str) -> Encoder:
    """One per worker process, with its cache, until ``release``."""
    key = hash(definition)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(definition)
    return _encoders[key]


def release() -> None:
    _encoders.clear()


def load(path: str) -> str:
    """The tokenizer file's text; read on the driver, so executors need no copy of it."""
    with open(path, encoding="utf-8") as file:
        return file.read()
