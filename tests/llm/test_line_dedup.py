import numpy as np
import pytest

import __spark_entry__ as entry
from checks import compare
from tests.conftest import SMALL
from tidewatch.llm.cuckoo import CuckooFilter
from tidewatch.llm.line_dedup import LineIndex
from tidewatch.session import work_dir


def digests(n, seed=0):
    return np.random.default_rng(seed).integers(0, 1 << 63, (n, 2), dtype=np.uint64)


@pytest.mark.parametrize("n", [0, 1, 5, 100, 5000])
def test_filter_never_misses_and_forgets(n):
    keys, others = digests(n), digests(4000, seed=9)
    held = CuckooFilter.of(keys)
    assert held.contains(keys).all() and len(held) == n
    assert held.contains(others).mean() < 0.005
    again = CuckooFilter(0, held.to_bytes())
    again.remove(keys[: n // 2])
    assert again.contains(keys[n // 2 :]).all() and len(again) == n - n // 2


def test_filter_grows_in_steps():
    held = CuckooFilter(256)
    parts = [digests(85, seed) for seed in range(10)]
    for part in parts:
        assert held.has_room(len(part))
        held.add(part)
    assert all(held.contains(part).all() for part in parts) and not held.has_room(100)


def test_query_equals_sql(spark):
    name = "op5_line_dedup"
    assert compare.difference(spark, SMALL, entry.queries()[name], entry.oracle_sql()[name]) is None


def brute(docs, min_chars=10):
    """Expected text per document; rows of equal key are one document."""
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").encode().lower()
    size = lambda line: len(line.strip(" \t\n\x0b\x0c\r"))
    held = {}
    for doc, text in docs:
        for line in (text or "").split("\n"):
            if doc is not None and size(line) >= min_chars:
                held.setdefault(key(line), set()).add(doc)
    return sorted(
        (
            str(doc),
            "\n".join(
                line
                for line in (text or "").split("\n")
                if doc is None
                or size(line) < min_chars
                or len(held[key(line)]) < 2
                or min(held[key(line)]) == doc
            ),
        )
        for doc, text in docs
    )


def kept(index, df):
    return sorted((str(r.doc_id), r.text) for r in index.clean(df).collect())


DOCS = [
    (1, "a shared line here\nown text of one\nshort"),
    (2, "A Shared LINE here \n\nown text of two\nshort"),
    (3, "\ta shared line here\na shared line here\nown text of two"),
    (4, None), (5, ""), (6, "\n\n"), (7, "x" * 50000 + "\nÄ shared line here"),
    (8, "ä shared line here\nÄ shared line here"), (8, "ä shared line here\nown text of one"),
    (None, "a shared line here\nown text of one"),
]


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string").selectExpr(
        "doc_id", "text", "'x' AS line", "1 AS n_lines", "2L AS doc", "'s' AS sign",
        "3 AS __doc", "4 AS __drop", "5 AS ___doc",
    )


def test_batches_deletions_and_odd_rows(spark):
    index = LineIndex(spark, work_dir(spark, "lines"), shards=3)
    index.insert(frame(spark, DOCS))
    assert kept(index, frame(spark, DOCS)) == brute(DOCS)
    more = [(0, "own text of two\nnewcomer's line"), (9, "newcomer's line\na shared line here")]
    index.insert(frame(spark, more))
    index.insert(frame(spark, more))
    every = DOCS + more
    assert kept(index, frame(spark, every)) == brute(every)
    index.delete(spark.createDataFrame([(1,), (0,), (77,), (None,)], "k long"))
    rest = [row for row in every if row[0] not in (0, 1)]
    assert kept(index, frame(spark, rest)) == brute(rest)
    index.insert(frame(spark, every))
    assert kept(index, frame(spark, every)) == brute(every)
    row = index.clean(frame(spark, every)).where("doc_id = 3").first()
    assert (row.n_lines, row.n_dropped) == (3, 3)


def test_filters_follow_the_references(spark):
    index = LineIndex(spark, work_dir(spark, "lines"), shards=2)
    docs = [(n, f"line number {n} of many\nthe line of all") for n in range(300)]
    index.insert(frame(spark, docs))
    index.insert(frame(spark, [(n + 1000, f"later line number {n}") for n in range(2000)]))
    assert index.filters().selectExpr("sum(held)").first()[0] == 2301
    index.delete(spark.createDataFrame([(n,) for n in range(1, 300)], "k long"))
    assert index.filters().selectExpr("sum(held)").first()[0] == 2002
    lines = index._refs().select("line").distinct()
    assert index.maybe_known(lines).count() == 2002


def test_empty_table(spark):
    index = LineIndex(spark, work_dir(spark, "lines"), shards=2)
    none = frame(spark, []).where("false")
    index.insert(none)
    assert kept(index, none) == []
    index.insert(frame(spark, DOCS))
    assert kept(index, frame(spark, DOCS)) == brute(DOCS)
