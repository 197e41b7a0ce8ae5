import __spark_entry__ as entry
from checks import compare
from tests.conftest import SMALL, plan_of
from tidewatch.llm import preferences

TURNS = "pair_id long, turn long, role string, text string"


def said(role, text):
    return f"<|im_start|>{role}\n{text}<|im_end|>\n"


def formatted(spark, chosen, rejected):
    sides = [
        spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' AS chosen", "1 AS __n")
        for rows in (chosen, rejected)
    ]
    found = preferences.format_preferences(*sides)
    assert found.columns == ["pair_id", "n_prompt_turns", "prompt", "chosen", "rejected"]
    return {
        r.pair_id: (r.n_prompt_turns, r.prompt, *([tuple(s) for s in side] for side in r[3:]))
        for r in found.collect()
    }


def parts(*turns):
    out = []
    for role, text, trained in turns:
        out += [(f"<|im_start|>{role}\n", False), (f"{text}<|im_end|>\n", trained)]
    return out


def test_query_equals_sql(spark):
    name = "op3_preferences"
    assert compare.difference(spark, SMALL, entry.queries()[name], entry.oracle_sql()[name]) is None


def test_no_python_in_the_plan(spark):
    plan = plan_of(entry.queries()["op3_preferences"](spark, SMALL))
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


def test_prefix_and_masks(spark):
    chosen = [(1, 2, "assistant", "good"), (1, 0, "system", "be kind"), (1, 1, "user", "hi")]
    rejected = [
        (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "bad"),
        (1, 3, "user", "what?"), (1, 4, "assistant", "sorry"),
    ]
    assert formatted(spark, chosen, rejected) == {
        1: (
            2,
            said("system", "be kind") + said("user", "hi"),
            parts(("assistant", "good", True)),
            parts(("assistant", "bad", True), ("user", "what?", False), ("assistant", "sorry", True)),
        )
    }


def test_odd_rows(spark):
    long = "y" * 100000
    chosen = [
        (1, 0, "user", "same"), (1, 1, "assistant", "same"),
        (2, 0, "user", "only chosen"),
        (4, 0, None, None), (4, None, "assistant", ""),
        (5, 0, "user", "a"), (5, 0, "user", "a"), (5, 1, "assistant", long),
        (None, 0, "user", "no pair"),
        (6, 0, "user", "text"), (7, 0, "user", "x"), (7, 5, "assistant", "gap"),
    ]
    rejected = [
        (1, 0, "user", "same"), (1, 1, "assistant", "same"),
        (3, 0, "user", "only rejected"),
        (4, 0, None, None), (4, None, "assistant", ""), (4, 1, "user", None),
        (5, 0, "user", "a"), (5, 1, "assistant", long),
        (None, 0, "user", "no pair"), (None, 1, "assistant", "z"),
        (6, 0, "assistant", "text"), (7, 0, "user", "x"), (7, 1, "assistant", "gap"),
    ]
    user, answer = "user", "assistant"
    assert formatted(spark, chosen, rejected) == {
        1: (2, said(user, "same") + said(answer, "same"), [], []),
        2: (0, "", parts((user, "only chosen", False)), []),
        3: (0, "", [], parts((user, "only rejected", False))),
        4: (2, said(answer, "") + said(user, ""), [], parts((user, "", False))),
        5: (1, said(user, "a"), parts((user, "a", False), (answer, long, True)), parts((answer, long, True))),
        None: (1, said(user, "no pair"), [], parts((answer, "z", True))),
        6: (0, "", parts((user, "text", False)), parts((answer, "text", True))),
        7: (2, said(user, "x") + said(answer, "gap"), [], []),
    }
    assert formatted(spark, [], []) == {}


def test_swapped_answers(spark):
    rows = [
        (0, 0, "user", "q0"), (0, 1, "assistant", "a0"), (0, 2, "user", "bye"),
        (1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "assistant", "b1"),
        (2, 0, "user", "alone"), (2, 1, "assistant", "a2"), (3, 0, "user", "no answer"),
    ]
    df = spark.createDataFrame(rows, TURNS.replace("pair_id", "conv_id"))
    assert sorted(tuple(r) for r in preferences.swapped_answers(df).collect()) == [
        (0, 0, "user", "q0"), (0, 1, "assistant", "b1"),
        (1, 0, "user", "q1"), (1, 1, "assistant", "a1"), (1, 2, "assistant", "a0"),
        (2, 0, "user", "alone"), (3, 0, "user", "no answer"),
    ]
