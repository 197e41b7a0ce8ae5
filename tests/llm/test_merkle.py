import hashlib
import zlib
from string import ascii_lowercase, ascii_uppercase

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, plan_of
from tests.llm.brute import read
from tidewatch.llm import merkle
from tidewatch.llm.numbering import numbered
from tidewatch.llm.queries import QUERIES

LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    texts = [None if value is None else str(value) for value in values]
    return digest("".join("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def levels(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        last = found[-1]
        found.append([digest("".join(last[i : i + 8])) for i in range(0, len(last), 8)])
    return found


def ascend(tree, place, folded):
    """Siblings from the leaf up, and what ``folded`` becomes at the top."""
    siblings = []
    for level in tree[:-1]:
        run, slot = level[place // 8 * 8 : place // 8 * 8 + 8], place % 8
        siblings += run[:slot] + run[slot + 1 :]
        folded, place = digest("".join(run[:slot] + [folded] + run[slot + 1 :])), place // 8
    return siblings, folded


def brute(rows):
    """``(key, leaf, subroot, root, proof, folded_root, verified)`` of rows ``(key, group, leaf,
    claimed)``."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    order = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    for some in groups.values():
        some.sort(key=lambda row: (row[0] is not None, row[0], row[2], row[3] or ""))
    trees = [levels([row[2] for row in groups[name]]) for name in order]
    top = levels([tree[-1][0] for tree in trees])
    for number, name in enumerate(order):
        for place, (key, _, own, claimed) in enumerate(groups[name]):
            low, folded = ascend(trees[number], place, claimed or own)
            high, folded = ascend(top, number, folded)
            root = top[-1][0]
            yield key, own, trees[number][-1][0], root, "".join(low + high), folded, folded == root


def climbed(manifest):
    rows = merkle.climb(manifest).withColumn("proof", F.lower(F.hex("proof"))).collect()
    return sorted((tuple(row) for row in rows), key=repr)


def test_query(spark):
    def claimed(row):
        tampered = zlib.crc32(str(row.doc_id).encode()) % 3 == 0
        return leaf(*row[:4], row.text and row.text.translate(LOWER)) if tampered else None

    docs = read(spark, SMALL, "documents", *FIELDS)
    expected = brute([(row.doc_id, row.lang, leaf(*row), claimed(row)) for row in docs])
    found = [tuple(row) for row in QUERIES["op12_merkle"](spark, SMALL).collect()]
    assert sorted(found) == sorted((*row[:4], digest(row[4]), *row[5:]) for row in expected)
    assert {row[-1] for row in found} == {True, False}


# Groups of one leaf, of a last run of one, of exactly two levels, and a null and an empty name.
SIZES = {None: 1, "": 9, "a": 1, "ä": 64, "b": 65, "c": 8, "d": 2, "e": 3, "f": 17, "g": 1}


def test_groups_of_all_sizes_ties_and_null_keys(spark):
    rows = [
        (None if key == 3 else key // 2, name, leaf(key // 4, name), leaf("x") if key % 5 == 2 else None)
        for name, size in SIZES.items()
        for key in range(size)
    ]
    rows += [(5, "b", leaf("same"), None)] * 300
    named = spark.createDataFrame(rows, "key long, tree string, leaf string, claimed string")
    manifest = merkle.build(named, "key", "tree", F.col("leaf"), F.col("claimed"))
    assert climbed(manifest) == sorted(brute(rows), key=repr)
    groups = {row.group: row["size"] for row in manifest.trees.collect()}
    assert groups == {**SIZES, "b": 365}
    # Every node but the last has its parent's place, where its own digest stands.
    nodes = manifest.nodes.collect()
    at = {(n.tree, n.level, n.place): n for n in nodes}
    ends = [n for n in nodes if n.up_tree is None]
    assert [bytes(n.digest).hex() for n in ends] == [manifest.root]
    for n in nodes:
        if n.up_tree is not None:
            kids = at[n.up_tree, n.up_level, n.up_place].kids
            assert kids[n.slot * 32 :][:32] == n.digest


@pytest.mark.parametrize("rows", [[], [(7, "en", leaf(7), None)], [(7, "en", leaf(7), leaf(8))]])
def test_no_row_and_one_row(spark, rows):
    few = spark.createDataFrame(rows, "id long, lang string, hash string, claimed string")
    manifest = merkle.build(few, "id", "lang", F.col("hash"), F.col("claimed"))
    assert manifest.root == (rows[0][2] if rows else None)
    assert climbed(manifest) == list(brute(rows))


def test_fields_keep_their_borders(spark):
    rows = [(None, ""), ("", None), ("a", "b"), ("ab", ""), ("1:a", "ä"), ("x" * 100_000, "-")]
    frame = spark.createDataFrame(rows, "a string, b string")
    found = [row[0] for row in frame.select(merkle.leaf_digest(F.col("a"), F.col("b"))).collect()]
    assert found == [leaf(*row) for row in rows] and len(set(found)) == len(rows)


def test_numbers_are_dense_in_every_group(spark):
    rows = spark.range(0, 5000, 1, 7).selectExpr("id % 3 = 0 AS big", "id % 11 AS value", "id")
    rows = rows.selectExpr("IF(big, 'b', concat('s', id % 2)) AS g", "value", "id")
    found = numbered(rows, "g", [F.col("value")], "n", "test").collect()
    for name in {row.g for row in found}:
        mine = sorted((row for row in found if row.g == name), key=lambda row: row.n)
        assert [row.n for row in mine] == list(range(len(mine)))
        assert [row.value for row in mine] == sorted(row.value for row in mine)


def test_no_python_in_the_climb(spark):
    rows = spark.range(20).selectExpr("id", "'en' AS lang", "sha2(cast(id AS string), 256) AS leaf")
    manifest = merkle.build(rows, "id", "lang", F.col("leaf"))
    assert "Python" not in plan_of(merkle.climb(manifest))
