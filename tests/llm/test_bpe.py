import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.conftest import SMALL
from tests.llm.brute import read
from tidewatch.llm import bpe
from tidewatch.llm.queries import QUERIES, VOCABULARY

RANKS = bpe.load_ranks(public_tokenizers.path(VOCABULARY))
MERGES = bpe.Merges(RANKS)
ORACLE = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=MERGES.rank, special_tokens={}
)


def ids(texts):
    encoder = bpe.Encoder(MERGES, public_tokenizers.PATTERN)
    return [np.frombuffer(some, dtype=np.int32).tolist() for some in encoder.encode(texts)]


def test_random_texts_equal_the_library():
    rng = random.Random(5)
    signs = "ab  \n\t'sé🙂中 \x1c\x85 ​x1२|\xa0Ⅷ\r"
    texts = ["".join(rng.choices(signs, k=rng.randint(0, 30))) for _ in range(5000)]
    texts += ["".join(rng.choices("abth", k=rng.randint(150, 400))) for _ in range(50)]
    assert ids(texts) == [ORACLE.encode_ordinary(text) for text in texts]


@pytest.mark.parametrize(
    "text",
    ["", " ", "  ", "a" * 5000, "ab" * 3000, " " * 500, "\n" * 300, "é" * 999, "<|endoftext|>",
     "a  b", "a   b", "a \n b", "a\xa0 \nb", "tail ", "tail  ", " head", "x\n y"],
)
def test_edge_texts(text):
    assert ids([text]) == [ORACLE.encode_ordinary(text)]


def test_full_cache_and_groups(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    monkeypatch.setattr(bpe, "GROUP_CHARS", 10)
    texts = ["one two three", "four five six", "one two", "", "six seven eight nine"] * 3
    assert ids(texts) == [ORACLE.encode_ordinary(text) for text in texts]


def test_query_equals_the_library(spark):
    rows = read(spark, SMALL, "documents", "doc_id", "text")
    wanted = set()
    for row in rows:
        tokens = ORACLE.encode_ordinary(row.text or "")
        joined = ",".join(map(str, tokens)).encode()
        wanted.add(
            (row.doc_id, len(tokens), hashlib.sha256(joined).hexdigest(),
             hashlib.sha256((row.text or "").encode()).hexdigest())
        )
    found = QUERIES["op4_bpe"](spark, SMALL).collect()
    assert len(found) == len(rows) and {tuple(row) for row in found} == wanted


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [(1, None, "x"), (1, "same", "y"), (1, "same", "y"), (None, "", None)],
        "doc_id long, text string, ids string",
    )
    encoded = bpe.encode(df, RANKS, public_tokenizers.PATTERN)
    assert encoded.columns == ["doc_id", "text", "ids"]
    decoded = bpe.decode(encoded, RANKS).collect()
    assert sorted(bytes(row.decoded) for row in decoded) == [b"", b"", b"same", b"same"]
    assert bpe.encode(df.where("false"), RANKS, public_tokenizers.PATTERN).count() == 0


def test_steps_grow_with_the_longest_piece_not_with_the_vocabulary(monkeypatch):
    rng, steps, merged = random.Random(3), [], bpe.Merges.merged
    monkeypatch.setattr(bpe.Merges, "merged", lambda *some: steps.append(1) or merged(*some))
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=10)) for _ in range(3000)]
    text = " ".join(words)
    assert ids([text]) == [ORACLE.encode_ordinary(text)]
    # Two lookups per merge of a matrix of 8 or 12 columns, and one before, twice (head and rest).
    assert len(steps) < 100


def test_odd_segments_between_kept_ones(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 4)
    encoder = bpe.Encoder(MERGES, public_tokenizers.PATTERN)
    texts = ["a  b", "a b", "", "a \tb c", "x" * 300 + " " + "y" * 300 + " b", "b a  ", " b  c d e"]
    for some in (texts, texts[::-1], texts[:3] * 2, texts[4:5]):
        found = [np.frombuffer(one, dtype=np.int32).tolist() for one in encoder.encode(some)]
        assert found == [ORACLE.encode_ordinary(text) for text in some]
        assert len(encoder.segments) <= 4


def test_ids_outside_the_vocabulary_are_an_error():
    tokens = bpe._by_id(RANKS)
    lists = bpe.pa.array([[0, 1], None, [], [2]], type=bpe.pa.list_(bpe.pa.int32()))
    assert bpe._joined(lists, tokens).to_pylist() == [
        b"".join(tokens[n].as_py() for n in some) for some in ([0, 1], [], [], [2])
    ]
    assert bpe._joined(lists.slice(1, 2), tokens).to_pylist() == [b"", b""]
    for bad in ([len(tokens)], [-1], [None]):
        with pytest.raises((ValueError, IndexError)):
            bpe._joined(bpe.pa.array([bad], type=lists.type), tokens)


def test_kept_segments_take_little_memory():
    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghij", k=10)) for _ in range(20_000)]
    encoder = bpe.Encoder(MERGES, public_tokenizers.PATTERN)
    encoder.encode([" ".join(words)])
    kept = [encoder.segments, encoder.flat, encoder.starts, encoder.sizes]
    assert len(encoder.segments) > 19_000
    assert sum(some.nbytes for some in kept) < 64 * len(encoder.segments)
