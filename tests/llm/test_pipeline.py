"""Each stage against brute force on its own input."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.conftest import SMALL
from tests.llm.brute import classes
from tests.llm.test_bpe import ids
from tests.llm.test_line_dedup import brute as lines_kept
from tests.llm.test_simhash import expected as fingerprint
from tidewatch.llm import quality, sql


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names, found = docs.columns, [docs.toPandas()]
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), "test-stage")
        assert docs.columns[:5] == names
        found.append(docs.toPandas())
    return found


def rows(frame):
    return sorted(frame[["doc_id", "text", "lang", "source", "n_chars"]].itertuples(index=False, name=None))


def test_names_and_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "line dedup", "SimHash near-dedup",
        "mixing sources to target weights", "byte-level BPE encoding and decoding",
    ]
    assert entry.queries()["pipeline"] is corpus_pipeline.run


def test_quality(spark, stages):
    before, after = stages[:2]
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas()
    known = before.merge(labels, on="doc_id")
    learn = np.array([zlib.crc32(str(n).encode()) % 5 != 0 for n in known.doc_id])
    values = np.array([quality.features(text) for text in known.text])
    order = np.argsort(known.doc_id[learn].to_numpy(), kind="stable")
    good = known.quality.to_numpy() == 1
    model = quality.bradley_terry(values[learn][order], good[learn][order], 40_000, 1e-3, 0.3)
    every = np.array([quality.features(text) for text in before.text])
    unit = np.clip((every - np.array(model.centre)) / np.array(model.scale), -8, 8)
    raw = unit @ np.array(model.weights)
    clear = np.abs(raw - model.cut) > 1e-9
    kept = set(after.doc_id)
    for name, value, sure in zip(before.doc_id, raw, clear):
        assert not sure or (name in kept) == (value >= model.cut)
    assert rows(after) == rows(before[before.doc_id.isin(kept)])


def test_line_dedup(stages):
    before, after = stages[1:3]
    wanted = lines_kept(list(zip(before.doc_id, before.text)))
    assert sorted((str(n), t) for n, t in zip(after.doc_id, after.text)) == wanted
    assert (after.n_chars == after.text.str.len()).all()


def test_near_dedup(stages):
    before, after = stages[2:4]
    prints = {n: fingerprint(t) for n, t in zip(before.doc_id, before.text)}
    group = classes(prints, lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    assert rows(after) == rows(before[[group[n] == n for n in before.doc_id]])


def test_mixing(stages):
    before, after = stages[3:5]
    con = duckdb.connect()
    con.register("documents", before)
    wanted = con.execute(sql._MIX + "SELECT d.* FROM documents d JOIN repeated USING (doc_id)").df()
    assert rows(after) == rows(wanted)


def test_tokens(stages):
    before, after = stages[4:6]
    assert rows(after) == rows(before)
    assert [list(x) for x in after.ids] == ids(list(after.text))
    assert (after.n_tokens == after.ids.map(len)).all()


def test_run_is_the_stages(spark, stages):
    found = corpus_pipeline.run(spark, SMALL).toPandas()
    assert rows(found) == rows(stages[-1])


def test_odd_rows(spark, tmp_path):
    docs = [
        (1, None, "en", None, None), (2, "", None, "s", 0), (2, "", None, "s", 0),
        (None, "a text without an id but with words", "en", "s", 1), (3, "word " * 50000, "en", "s", 2),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(docs, schema).selectExpr("*", "1 AS ids", "'x' AS line")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for name, table in (("full", frame), ("none", frame.where("false"))):
        folder = str(tmp_path / name)
        table.write.parquet(f"{folder}/documents.parquet")
        none.write.parquet(f"{folder}/labels.parquet")
        found = Counter(r.doc_id for r in corpus_pipeline.run(spark, folder).collect())
        assert set(found) <= {None, 1, 2, 3}
