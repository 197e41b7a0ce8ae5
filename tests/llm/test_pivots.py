import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm.brute import classes, read
from tidewatch.llm import pivots
from tidewatch.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """``vec_id: (n_links, component)`` by comparing everything; ids must be distinct."""
    units = {}
    for key, vector, label in rows:
        values = np.array(vector if vector else [np.nan], dtype=object)
        known = vector and label is not None and all(v is not None for v in vector)
        values = np.array(vector, dtype=float) if known else np.zeros(1)
        good = known and np.isfinite(values).all() and values.any()
        units[key] = (label, values / np.linalg.norm(values)) if good else None

    def linked(a, b):
        x, y = units[a], units[b]
        return bool(
            x and y and x[0] == y[0] and len(x[1]) == len(y[1]) and x[1] @ y[1] >= 0.98
        )

    component = classes(units, linked)
    return {
        key: (sum(linked(key, other) for other in units if other != key), component[key])
        for key in units
    }


def found(df, **options):
    rows = pivots.near_duplicates(df, **options).collect()
    for row in rows:
        assert row.kept == (row.vec_id == row.component_id)
    return {row.vec_id: (row.n_links, row.component_id) for row in rows}


def test_query_equals_brute_force(spark):
    folder = SMALL
    rows = read(spark, folder, "embeddings", "vec_id", "embedding", "label")
    ids, labels = (np.array([row[n] for row in rows]) for n in (0, 2))
    unit = np.array([row.embedding for row in rows])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.98) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(near, False)
    parts = classes(range(len(ids)), lambda a, b: near[a, b])
    least = {}
    for n, part in parts.items():
        least[part] = min(least.get(part, ids[n]), ids[n])
    wanted = {ids[n]: (near[n].sum(), least[parts[n]]) for n in parts}
    result = QUERIES["op2_embeddings"](spark, folder).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in result} == wanted


@pytest.mark.parametrize("block", [256, 7])
def test_dense_groups_copies_and_recall(spark, block):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 16))
    rows = []
    for n in range(900):
        centre = centres[0] if n % 3 == 0 else centres[rng.integers(40)]
        noise = rng.normal(size=16) * rng.choice([0, 0.02, 0.1, 0.5])
        rows.append((n * 3, [float(np.float32(x)) for x in centre + noise], int(n % 3)))
    wanted = brute(rows)
    result = found(spark.createDataFrame(rows, SCHEMA), block=block)
    links = [sum(x[0] for x in some.values()) for some in (result, wanted)]
    assert links[0] <= links[1] and links[0] >= 0.99 * links[1]
    assert all(result[key][0] <= wanted[key][0] for key in wanted)
    assert np.mean([result[key][1] == wanted[key][1] for key in wanted]) > 0.99


def test_lengths_whose_squares_are_out_of_range(spark):
    far, near, least = 1e200, 1e-200, 5e-324
    rows = [
        (1, [far, 0.0], 0), (2, [far, 1.0], 0), (3, [near, 0.0], 0), (4, [1.0, 0.0], 0),
        (5, [least, 0.0], 0), (6, [1.7e308, 1.7e308], 0), (7, [near, near], 0), (8, [0.0, far], 0),
    ]
    result = found(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    ones, diagonal = dict.fromkeys((1, 2, 3, 4, 5), (4, 1)), dict.fromkeys((6, 7), (1, 6))
    assert result == {**ones, **diagonal, 8: (0, 8)}


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], None),
        (5, None, 0), (6, [0.0, 0.0], 0), (7, [nan, 1.0], 0), (8, [inf, 1.0], 0),
        (9, [None, 1.0], 0), (10, [], 0), (11, [1.0, 0.0, 0.0], 0), (12, [1.0, 0.0], 0),
        (13, [-1.0, 0.0], 0), (14, [3.0, 0.0, 0.0], 0),
    ]
    wanted = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS node", "2 AS copies", "3 AS root")
    assert found(df) == wanted
    again = spark.createDataFrame([rows[0], rows[0], (None, [1.0, 0.0], 0), (None, None, 0)], SCHEMA)
    got = sorted(pivots.near_duplicates(again).collect(), key=str)
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got if r.vec_id) == [
        (1, 2, 1, True)
    ] * 2
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [
        (0, None, False), (2, 1, False)
    ]
    assert pivots.near_duplicates(df.where("false")).collect() == []
