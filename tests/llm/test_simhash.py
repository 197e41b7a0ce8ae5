import random

import pytest
import xxhash

from tests.conftest import SMALL
from tests.llm.brute import classes, read
from tidewatch.llm import simhash
from tidewatch.llm.components import components
from tidewatch.llm.queries import QUERIES


def expected(text, shingle=3):
    words = (text or "").encode().lower().split()
    grams = [words[i : i + shingle] for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(b" ".join(gram), 42) for gram in grams if gram]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


@pytest.mark.parametrize(
    "text", ["", None, "a", "A b", "a b c", "a  b\tc\nd É e", "x " * 500, "a b c " * 3]
)
def test_fingerprint(text):
    assert simhash.simhash(text or "", 3, 42) == expected(text)


def test_query_equals_brute_force(spark):
    rows = read(spark, SMALL, "documents", "doc_id", "text")
    prints = {row.doc_id: expected(row.text) for row in rows}
    wanted = classes(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    found = QUERIES["op9_simhash"](spark, SMALL).collect()
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in found} == {
        key: (prints[key], wanted[key]) for key in prints
    }
    assert len(found) == len(rows)


@pytest.mark.parametrize("max_bits,block", [(1, 512), (2, 512), (2, 4), (3, 8), (5, 512)])
def test_links_hold_the_same_components(spark, max_bits, block):
    rng = random.Random(max_bits * 100 + block)
    seeds = [rng.getrandbits(64) for _ in range(8)]
    values = {0, (1 << 64) - 1}
    for seed in seeds:
        for _ in range(25):
            value = seed
            for _ in range(rng.randint(0, max_bits * 3)):
                value ^= 1 << rng.randrange(64)
            values.add(value)
    signed = {value: value - (1 << 64) if value >> 63 else value for value in values}
    df = spark.createDataFrame([(v,) for v in signed.values()], "fp long")
    edges = simhash.links(df, max_bits, block)
    assert edges.selectExpr("max(bit_count(a ^ b))").first()[0] <= max_bits
    found = {row.node: row.component for row in components(edges).collect()}
    wanted = classes(signed.values(), lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1") <= max_bits)
    assert {v: found.get(v, v) for v in signed.values()} == wanted


def test_components_of_paths_stars_and_nothing(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1001 + i) for i in range(40)] + [(1000, 1000), (None, 3), (1001, 1000)]
    df = spark.createDataFrame(path + star, "a long, b long")
    found = {row.node: row.component for row in components(df).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{1000 + i: 1000 for i in range(41)}}
    assert components(df.where("false")).count() == 0


def test_odd_rows(spark):
    long = "word " * 30000
    rows = [(1, None), (2, ""), (3, "a b c d"), (4, "A  b\tc d"), (None, "a b c d"), (5, long)]
    rows += [(6, long), (6, long), (None, "only here, null key")]
    df = spark.createDataFrame([(k, t, "x", 7) for k, t in rows], "doc_id long, text string, fp string, root int")
    found = sorted(
        ((r.doc_id, r.component_id) for r in simhash.near_duplicates(df).collect()), key=str
    )
    assert found == sorted(
        [(1, 1), (2, 1), (3, 3), (4, 3), (None, 3), (5, 5), (6, 5), (6, 5), (None, None)], key=str
    )
    assert simhash.near_duplicates(df.where("false")).collect() == []
