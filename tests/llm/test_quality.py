import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.brute import read
from tidewatch.llm import quality
from tidewatch.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    small = SMALL.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r.quality for r in read(spark, small, "labels", "doc_id", "quality")}
    rows = QUERIES["op10_quality"](spark, small).collect()
    assert len(rows) == spark.read.parquet(f"{small}/documents.parquet").count()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.3)
    judged = [r for r in rows if r.held_out and r.doc_id in labels]
    right = [r.predicted == labels[r.doc_id] for r in judged]
    assert len(judged) > 40 and np.mean(right) > 0.95


def test_held_out_labels_are_not_used(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    model = quality.train(docs, labels)
    turned = labels.selectExpr(
        "doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 5 = 0, 1 - quality, quality) AS quality"
    )
    assert quality.train(docs, turned) == model


def test_fit_agrees_with_plain_ascent():
    rng = np.random.default_rng(3)
    values = rng.normal(size=(60, len(quality.FEATURES)))
    better = values[:, 0] + 0.5 * values[:, 1] + rng.normal(size=60) > 0
    model = quality.bradley_terry(values, better, 500, 0.1, 0.3)
    unit = (values - values.mean(0)) / values.std(0)
    good, bad = np.flatnonzero(better), np.flatnonzero(~better)
    n = np.arange(500)
    ahead = unit[good[n % len(good)]] - unit[bad[(n + n // len(good)) % len(bad)]]
    weights = np.zeros(values.shape[1])
    for _ in range(20000):
        chance = 1 / (1 + np.exp(-ahead @ weights))
        weights += 0.1 * (ahead.T @ (1 - chance) / 500 - 0.1 * weights)
    assert np.allclose(weights, model.weights, atol=1e-4)


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, 0)], [(1, 1), (2, 0), (None, 0), (3, None)]])
def test_odd_rows(spark, labels):
    docs = spark.createDataFrame(
        [(1, None, 9.0, "p"), (2, "", 9.0, "p"), (2, "", 9.0, "p"), (None, "x " * 60000, 9.0, None)],
        "doc_id long, text string, score double, predicted string",
    )
    model = quality.train(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    rows = quality.score(docs, model).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
    assert quality.score(docs.where("false"), model).collect() == []
    named = quality.score(docs.selectExpr("*", "7 AS __features"), model)
    assert [row["__features"] for row in named.collect()] == [7] * 4


def test_copies_of_a_document_stay_within_the_bound(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "bradley_terry", lambda values, better, *_: seen.append(len(values)))
    docs = spark.range(300).selectExpr("1L AS doc_id", "concat('text ', id) AS text")
    quality.train(docs, spark.createDataFrame([(1, 1)], "doc_id long, quality int"), rows=10)
    assert seen == [10]


@pytest.mark.parametrize("common", [True, False])
def test_all_labelled_rows_are_learned_from(spark, common, monkeypatch):
    monkeypatch.setattr(quality, "with_features", lambda df, *_: df.withColumnRenamed("text", "features").withColumn("text", F.lit("")))
    rng = np.random.default_rng(5)
    values = rng.normal(size=(700, len(quality.FEATURES)))
    better = (values[:, 0] + rng.normal(size=700) > -0.8) == common
    docs = [(n, row.tolist()) for n, row in enumerate(values)]
    docs = spark.createDataFrame(docs, "doc_id long, text array<double>").repartition(5)
    labels = [(n, int(one)) for n, one in enumerate(better)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    learn = np.array([zlib.crc32(str(n).encode()) % 5 != 0 for n in range(700)])
    values, better = values[learn], better[learn]
    model = quality.train(docs, labels, pairs=50, penalty=0.1)
    unit = np.clip((values - values.mean(0)) / values.std(0), -8, 8)
    assert np.allclose(model.centre, values.mean(0)) and np.allclose(model.scale, values.std(0))
    good, bad = unit[better], unit[~better]
    n = np.arange(max(len(good), len(bad)))
    # No round is over, so the n-th rows meet and each row is in a pair.
    ahead = good[n % len(good)] - bad[n % len(bad)]
    weights = np.zeros(values.shape[1])
    for _ in range(5000):
        chance = 1 / (1 + np.exp(-ahead @ weights))
        weights += 0.2 * (ahead.T @ (1 - chance) / len(n) - 0.1 * weights)
    assert np.allclose(weights, model.weights, atol=1e-6)
    assert np.isclose(model.cut, np.quantile(unit @ model.weights, len(bad) / len(values)))


def test_a_few_rows_fit_alike_here_and_there(spark):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    here, there = (quality.train(docs, labels, rows=rows, pairs=2000) for rows in (10_000, None))
    for name in ("centre", "scale", "weights", "cut"):
        assert np.allclose(getattr(here, name), getattr(there, name), rtol=1e-6, atol=1e-9)
