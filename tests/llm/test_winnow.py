import hashlib
import random

import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm.brute import read
from tidewatch.llm import winnow
from tidewatch.llm.queries import QUERIES

MASK = (1 << 64) - 1


def gram_hash(gram):
    value = 0
    for sign in gram:
        value = (value * 0x9E3779B97F4A7C15 + ord(sign) + 1) & MASK
    value ^= value >> 29
    return (value * 0xD6E8FEB86659FD93 & MASK) >> 32


def brute(text, k=winnow.GRAM, w=winnow.WINDOW):
    if not text:
        return [], []
    k = min(k, len(text))
    hashes = [gram_hash(text[i : i + k]) for i in range(len(text) - k + 1)]
    w = min(w, len(hashes))
    picked = []
    for start in range(len(hashes) - w + 1):
        at = min(range(start, start + w), key=lambda i: (hashes[i], -i))
        if not picked or picked[-1] != at:
            picked.append(at)
    return [hashes[i] for i in picked], picked


@pytest.mark.parametrize(
    "text", ["", "a", "short text", "abc" * 40, "x" * 300, "ä🙂 語" * 50, "the cat sat " * 9 + "z" * 40]
)
@pytest.mark.parametrize("k,w", [(12, 24), (1, 1), (5, 4), (7, 1), (16, 33)])
def test_winnow(text, k, w):
    hashes, positions = winnow.winnow(text, k, w)
    assert (hashes.tolist(), positions.tolist()) == brute(text, k, w)


def test_match_guarantee():
    rng = random.Random(2)
    for _ in range(50):
        shared = "".join(rng.choices("abcdefgh ", k=winnow.GRAM + winnow.WINDOW - 1))
        left, right = ("".join(rng.choices("abcdefgh ", k=90)) for _ in range(2))
        a = winnow.winnow(left[:40] + shared + left[40:])[0]
        b = winnow.winnow(right[:70] + shared + right[70:])[0]
        assert np.intersect1d(a, b).size


def expected(rows):
    """Rows ``(key, text)`` in order of following."""
    rows = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + after[:half]
        a, b, c = (brute(t)[0] for t in (text, changed, after))
        like = lambda x, y: 2 * len({*x} & {*y}) / (len({*x}) + len({*y})) if x or y else 1.0
        out.append(
            (key, len(text), hashlib.sha256(changed.encode()).hexdigest(),
             *(winnow.as_text(np.array(x, dtype=np.uint32)) for x in (a, b)), like(a, b), like(a, c))
        )
    return sorted(out, key=repr)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in read(spark, SMALL, "documents", "doc_id", "text")]
    found = [tuple(r) for r in QUERIES["op7_winnowing"](spark, SMALL).collect()]
    assert sorted(found, key=repr) == expected(rows)


@pytest.mark.parametrize("rows", [
    [], [(5, "only one, its own next")],
    [(n * n * n, f"text number {n} " * (n % 5)) for n in range(300)],
    [(None, "null key"), (None, None), (7, "same"), (7, "same"), (7, "other"), (-3, ""), (9, "y" * 70000)],
])
def test_ranges_and_odd_rows(spark, rows, monkeypatch):
    df = spark.createDataFrame([(*row, "x", 1) for row in rows], "doc_id long, text string, fingerprint string, __top int")
    with_next = winnow.with_next
    monkeypatch.setattr(winnow, "with_next", lambda *args: with_next(*args, range_documents=2))
    found = [tuple(r) for r in winnow.compare_with_next(df).collect()]
    assert sorted(found, key=repr) == expected(rows)


@pytest.mark.parametrize("kind", ["tinyint", "smallint", "int"])
def test_keys_of_other_types(spark, kind):
    rows = [(1, "a text of some length"), (2, "another text"), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    narrow = winnow.compare_with_next(df.withColumn("doc_id", df.doc_id.cast(kind)))
    assert narrow.schema["doc_id"].dataType.simpleString() == kind
    assert sorted(map(tuple, narrow.collect()), key=repr) == expected(rows)
    with pytest.raises(TypeError):
        winnow.compare_with_next(df.withColumn("doc_id", df.doc_id.cast("string")))


def test_columns_of_the_operator(spark):
    df = spark.createDataFrame([(1, None, 2), (2, "abc", 3)], "doc_id long, text string, hashes int")
    rows = {r.doc_id: r for r in winnow.fingerprints(df).collect()}
    assert rows[1].hashes == [] and rows[2].positions == [0]
