import heapq
import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql.types import LongType, StringType
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tests.llm.brute import read
from tidewatch.llm import huffman, subwords, token_files
from tidewatch.llm.queries import END_ID, QUERIES, WORD_VOCABULARY
from tidewatch.session import work_dir

PATH = public_tokenizers.path(WORD_VOCABULARY)
DEFINITION = subwords.load(PATH)
SIGNS = [
    *"abcXYZ'sdtrel  \n\t\r.,;:!?-_0123éÉßİıſKǺ\xa0\x85 \x1c\x01\x00漢字🙂ªºµǅ𝒜́ͅ²¼ʯ",
    "'re", "'LL", "'s", "<|endoftext|>", "  ", "İ.", ". ", ", ", "..", "word", "Über",
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    return tokenizer


def ids_of(tokenizer, texts):
    return [one.ids for one in tokenizer.encode_batch(texts, add_special_tokens=False)]


def encoded(encoder, texts):
    ids, counts = encoder.encode(pa.array(texts))
    return [some.tolist() for some in np.split(ids, np.cumsum(counts)[:-1])]


def unpacked(raw):
    return np.frombuffer(raw, dtype="<u4").tolist()


# --- the tokenizer ------------------------------------------------------------------------


def test_words_are_those_of_the_library(library, monkeypatch):
    monkeypatch.setattr(subwords, "CACHE_ENTRIES", 500)
    rng = random.Random(5)
    texts = ["".join(rng.choices(SIGNS, k=rng.randrange(40))) for _ in range(20_000)]
    texts += ["", " ", "\n", "a" * 5_000, "x. " * 3_000, "é" * 300, "漢" * 2_000]
    encoder = subwords.Encoder(DEFINITION)
    assert [ids for n in range(0, len(texts), 50) for ids in encoded(encoder, texts[n : n + 50])] == (
        ids_of(library, texts)
    )
    assert len(encoder.words) < 1_500 and max(map(len, encoder.words.to_pylist())) <= subwords.KEPT_CHARS


def test_plain_characters_keep_their_kind(library):
    """Every plain character alone, between letters, and before a full stop."""
    plain = [chr(n) for n in range(subwords.LAST_PLAIN + 2)]
    forms = ("@", "a@b", "@. x", "@@", "'@ s", "x @, y")
    texts = [form.replace("@", sign) for sign in plain for form in forms]
    assert encoded(subwords.Encoder(DEFINITION), texts) == ids_of(library, texts)


def test_frequent_segments_stay_known(library, monkeypatch):
    """A segment that comes back in every other batch is learned once, whatever rare ones come after."""
    learn, learned = subwords.Encoder._learn, []

    def seen(self, segments):
        learned.extend(map(str, segments))
        return learn(self, segments)

    monkeypatch.setattr(subwords, "CACHE_ENTRIES", 100)
    monkeypatch.setattr(subwords.Encoder, "_learn", seen)
    encoder = subwords.Encoder(DEFINITION)
    usual = [f"{a}{b}" for a in "abcdef" for b in "uvwxyz"]
    encoded(encoder, [" ".join(usual)])
    for turn in range(12):
        rare = [f"{a}{b}{'z' * turn}q" for a in "ghijklmn" for b in "opqrst"]
        text = " ".join(rare if turn % 2 else rare + usual)
        assert encoded(encoder, [text]) == ids_of(library, [text])
    assert [learned.count(word) for word in usual] == [1] * len(usual)
    assert len(encoder.words) <= 100


def test_parts_of_a_batch_are_equal():
    """No small rest that costs as many lookups as a whole part."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(220))], names=["key"])

    def parts(sizes, most):
        return [some.num_rows for some in token_files._slices(batch, np.array(sizes), most)]

    assert parts([1] * 220, 200) == [220]
    assert parts([1] * 220, 100) == [110, 110]
    assert parts([0] * 220, 100) == [220]
    assert parts([100] * 220, 100) == [1] * 220


@pytest.mark.parametrize("most, width", [(1, 1), (255, 1), (256, 2), (2**24, 4), (2**32 - 1, 4)])
def test_planes_have_the_bytes_of_the_largest_id(most, width):
    counts = [0, 3, 0, 5, 1]
    ids = np.array([most, 0, 1, 0, most - 1, 0, 0, 0, most // 2], dtype=np.uint32)
    planes = token_files._planes(ids, np.array(counts))
    assert [len(some) for some in planes] == [width * n for n in counts]
    assert np.array_equal(np.concatenate([token_files._ids(*some) for some in zip(planes, counts)]), ids)


def test_tokens_between_the_steps_are_small(spark, library):
    texts = ["some words, and others", None, "", "word " * 500]
    frame = spark.createDataFrame(enumerate(texts), "doc_id long, text string").coalesce(1)
    found = token_files.tokenize(frame, DEFINITION, END_ID, "doc_id", "text").where("ids IS NULL")
    sizes = [len(ids) + 1 for ids in ids_of(library, [text or "" for text in texts])]
    assert [(row.n, len(row.planes)) for row in found.orderBy("key").collect()] == [(n, 2 * n) for n in sizes]


# --- the code -----------------------------------------------------------------------------


def best_total(counts, max_bits):
    """The fewest bits over all lengths that a prefix code can have."""
    kraft = [n for n in itertools.product(range(1, max_bits + 1), repeat=len(counts))
             if sum(2.0**-x for x in n) <= 1]
    return min(sum(n * c for n, c in zip(lengths, counts)) for lengths in kraft)


def huffman_total(counts):
    heap, total = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        total += pair
        heapq.heappush(heap, pair)
    return total


def test_lengths_are_the_best_of_their_limit():
    rng = random.Random(3)
    for size, bits in [(2, 1), (3, 2), (4, 2), (4, 3), (5, 3), (5, 4), (6, 3)]:
        for _ in range(8):
            counts = np.array([rng.choice([1, 2, 3, 9, 50, 400]) for _ in range(size)])
            lengths = huffman.code_lengths(counts, bits)
            assert lengths.max() <= bits and sum(2.0**-lengths) <= 1
            assert (lengths * counts).sum() == best_total(counts.tolist(), bits)
    counts = np.array([rng.randrange(1, 10**9) for _ in range(3_000)])
    assert (huffman.code_lengths(counts, 40) * counts).sum() == huffman_total(counts.tolist())
    skewed = np.array([2**n for n in range(40)])
    assert huffman.code_lengths(skewed, 18).max() <= 18
    with pytest.raises(ValueError, match="no code"):
        huffman.code_lengths(np.ones(5, dtype=np.int64), 2)


def test_code_is_canonical():
    code = huffman.code_of(np.array([900, 7, 3, 8, 1]), np.array([1, 5, 6, 20, 2]))
    shown = {
        s: format(int(code._code[s]), f"0{n}b") for s, n in zip(code.symbols.tolist(), code.lengths.tolist())
    }
    assert shown == {8: "0", 3: "10", 7: "110", 1: "1110", 900: "1111"}


@pytest.mark.parametrize("kinds", [1, 2, 300, 70_000])
def test_round_trip(kinds):
    rng = np.random.default_rng(kinds)
    counts = np.array([0, 1, huffman.STEP, 0, huffman.STEP + 1, 5_000, 3, 0])
    ids = (rng.zipf(1.2, counts.sum()) % kinds).astype(np.int64)
    every = np.arange(kinds)
    code = huffman.code_of(every, np.bincount(ids, minlength=kinds) + 1)
    payloads, lanes = code.encode(ids, counts)
    found = []
    for payload, bits, n in zip(payloads, lanes, counts):
        offsets = np.cumsum(bits, dtype=np.int64) - bits
        found.append(code.decode(payload, offsets, token_files._lanes(np.array([n]))))
        assert len(payload) == -(-int(bits.sum()) // 8)
    assert np.array_equal(np.concatenate(found), ids)


# --- the files ----------------------------------------------------------------------------


def expected(library, docs, end):
    """``(key, start, n, ids)`` of documents ``(key, text)`` in their order."""
    at, out = 0, []
    for (key, _), ids in zip(docs, ids_of(library, [text or "" for _, text in docs])):
        ids = ids + ([] if end is None else [end])
        out.append((key, at, len(ids), ids))
        at += len(ids)
    return out


def found_in(df):
    return sorted(((*row[:3], unpacked(row[3])) for row in df.collect()), key=lambda row: (row[1], row[2]))


def test_query(spark, library):
    docs = sorted(tuple(row) for row in read(spark, SMALL, "documents", "doc_id", "text"))
    want = [
        (key, start, n, zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        for key, start, n, ids in expected(library, docs, END_ID)
    ]
    found = QUERIES["op13_token_files"](spark, SMALL)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(tuple(row) for row in found.collect()) == want


def test_odd_rows_and_small_blocks(spark, library):
    rng = random.Random(7)
    docs = [(n, "".join(rng.choices(SIGNS, k=n % 60))) for n in range(1, 150)]
    docs = [(None, "first"), *docs, (500, ""), (501, None), (502, "long text, " * 3_000)]
    rows = [(text, "x", key, n, -1) for n, (key, text) in enumerate(docs)]
    # Columns named as the operator's own.
    frame = spark.createDataFrame(rows, "body string, planes string, key long, n long, part int")
    rng.shuffle(rows)
    folder = work_dir(spark, "tokens")
    mixed = spark.createDataFrame(rows, frame.schema).repartition(5)
    token_files.write(mixed, folder, DEFINITION, END_ID, key="key", text="body", block_ids=300)
    want = expected(library, docs, END_ID)
    assert found_in(token_files.read(spark, folder, "key")) == want

    blocks = spark.read.parquet(f"{folder}/blocks")
    assert blocks.where("n > 300 AND aggregate(docs, 0L, (a, d) -> greatest(a, d.n)) <= 300").count() == 0
    assert blocks.count() > 10
    assert blocks.agg({"n": "sum"}).first()[0] == sum(row[2] for row in want)
    stream = [number for row in want for number in row[3]]
    for start, stop in [(0, 1), (250, 1_700), (len(stream) - 3_000, len(stream) + 9), (40, 40)]:
        parts = token_files.read_range(spark, folder, start, stop).orderBy("start").collect()
        assert [number for row in parts for number in unpacked(row.ids)] == stream[start:stop]
        assert not parts or parts[0].start == start


def test_ties_and_text_keys(spark, library):
    rows = [("b", "same")] * 40 + [("a", "one"), ("a", "two words"), ("ä", "three of them"), (None, None)]
    folder = work_dir(spark, "tokens")
    frame = spark.createDataFrame(rows, "id string, text string").repartition(3)
    token_files.write(frame, folder, DEFINITION, None, key="id")
    found = found_in(token_files.read(spark, folder, "id", StringType()))
    assert [row[0] for row in found] == [None, "a", "a", *["b"] * 40, "ä"]
    order = [(None, None), ("a", "one"), ("a", "two words"), *[("b", "same")] * 40, ("ä", "three of them")]
    assert found == expected(library, order, None)


def test_empty_table(spark):
    folder = work_dir(spark, "tokens")
    empty = spark.createDataFrame([], "doc_id long, text string")
    token_files.write(empty, folder, DEFINITION, END_ID)
    found = token_files.read(spark, folder, "doc_id", LongType())
    assert found.collect() == [] and found.columns == ["doc_id", "start", "n", "ids"]
    assert token_files.read_range(spark, folder, 0, 10).collect() == []
