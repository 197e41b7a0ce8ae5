import math

import numpy as np
import pytest

import __spark_entry__ as entry
from checks import compare
from tests.conftest import SMALL, plan_of
from tidewatch.llm import mixing


def test_query_equals_sql(spark):
    name = "op1_mixing"
    assert compare.difference(spark, SMALL, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_no_python_in_the_plan(spark):
    plan = plan_of(entry.queries()["op1_mixing"](spark, SMALL))
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("rate", [0.0, 1e-9, 0.3, 1.0, 4.5, 60.0, 900.0])
def test_table_is_the_distribution(spark, rate):
    df = spark.createDataFrame([("a", rate)], "source string, rate double")
    chances = mixing.inverse_table(df).first().chances
    term, total = math.exp(-rate), 0.0
    for k, found in enumerate(chances):
        if rate < 700:
            total += term
            assert found == pytest.approx(total, abs=1e-12)
            term *= rate / (k + 1)
    assert chances[-1] == pytest.approx(1, abs=1e-9)


def test_shares_meet_the_weights(spark):
    df = spark.range(60_000).selectExpr(
        "id AS doc_id", "IF(id % 3 = 0, 'big', concat('s', id % 7)) AS source", "repeat('x', 9) AS text"
    )
    mixed = mixing.mix(df, {"big": 1.0, "s1": 5.0}, default_weight=2.0, epochs=1.5)
    found = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    weights = {"big": 1, **{f"s{n}": 5 if n == 1 else 2 for n in range(7)}}
    for source, weight in weights.items():
        expected = 90_000 * weight / sum(weights.values())
        assert abs(found[source] - expected) < 5 * math.sqrt(expected)


def test_global_shuffle(spark):
    df = spark.range(4000).selectExpr("id AS doc_id", "'a' AS source", "'t' AS text")
    order = [r.doc_id for r in mixing.mix(df, {}).collect()]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.1


def test_odd_rows(spark):
    rows = [(1, "a", None), (2, None, ""), (2, None, ""), (None, "b", "x" * 100000), (3, "zero", "t")]
    df = spark.createDataFrame(
        [(*row, "kept", -1) for row in rows],
        "doc_id long, source string, text string, copy string, chances int",
    )
    mixed = mixing.mix(df, {"zero": 0.0}, default_weight=3.0, epochs=40.0)
    assert mixed.columns == ["doc_id", "source", "text", "chances", "copy", "shuffle_key"]
    found = {}
    for row in mixed.collect():
        found.setdefault((row.doc_id, row.source), []).append(row.copy)
    assert (3, "zero") not in found
    assert sorted(found[2, None]) == sorted([*range(1, len(found[2, None]) // 2 + 1)] * 2)
    assert mixing.mix(df.where("false"), {}).collect() == []
    clashing = df.selectExpr("*", "1 AS __count", "2 AS __CHANCES", "3 AS __source", "4 AS ___count")
    again = mixing.mix(clashing, {"zero": 0.0}, default_weight=3.0, epochs=40.0)
    assert again.select(*mixed.columns).collect() == mixed.collect()
    assert set(again.select("__count", "__CHANCES", "__source", "___count").collect()) == {(1, 2, 3, 4)}
    assert mixing.mix(df, {}, default_weight=0.0).collect() == []
    with pytest.raises(ValueError):
        mixing.mix(df, {"a": -1.0})
