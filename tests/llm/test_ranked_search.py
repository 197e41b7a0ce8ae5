import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm.brute import read
from tidewatch.llm import ranked_search
from tidewatch.llm.queries import QUERIES
from tidewatch.llm.ranked_search import Block, Unit, candidates

PATTERN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
UPPER = {n: n + 32 for n in range(65, 91)}


def terms(text):
    return PATTERN.findall((text or "").translate(UPPER))


def brute(docs, items, k):
    """``(item, rank, key, score)`` of documents ``(key, text)`` and items ``(item, text)``."""
    cut = [(key, terms(text)) for key, text in docs]
    known = sum(bool(some) for _, some in cut)
    total = sum(len(some) for _, some in cut)
    holding = Counter(term for _, some in cut for term in set(some))
    out = []
    for item, text in items:
        scored = []
        for key, some in cut:
            times, score = Counter(some), 0
            for term in terms(text):
                if term in times:
                    w = math.floor(1000 * math.log((2 * known + 2) / (2 * holding[term] + 1)))
                    m = 75 + 25 * len(some) * known // total
                    score += w * (1_000_000_000 * times[term] // (1000 * times[term] + 12 * m))
            if score > 0:
                scored.append((-score, key is not None, key or 0, key))
        for rank, (score, _, _, key) in enumerate(sorted(scored, key=lambda row: row[:3])[:k], 1):
            out.append((item, rank, key, -score))
    return sorted(out, key=repr)


def collected(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_terms():
    text = "Ab-c d_e Éa1 İ\x00x\x7fy\u0080z 漢字🙂 `q` {r} [s] @t:u/v"
    assert [one.decode() for one in ranked_search.terms_of(text)] == terms(text)
    assert ranked_search.terms_of(None) == ranked_search.terms_of("") == []


def test_query(spark):
    docs = [tuple(row) for row in read(spark, SMALL, "documents", "doc_id", "text")]
    items = [tuple(row) for row in read(spark, SMALL, "benchmark", "item_id", "text")]
    found = QUERIES["op11_ranked_search"](spark, SMALL)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert collected(found) == brute(docs, items, 20)


WORDS = [f"w{n}" for n in range(60)]


def written(rng, size):
    """Words of very different frequency."""
    return " ".join(WORDS[min(int(rng.expovariate(0.12)), 59)] for _ in range(size))


def test_many_blocks_ties_and_odd_rows(spark):
    rng = random.Random(11)
    docs = [(key, written(rng, rng.randrange(1, 40))) for key in range(600)]
    docs += [(1_000 + n, docs[7][1]) for n in range(80)]
    docs += [(None, docs[7][1]), (None, docs[7][1]), (7, docs[7][1]), (2_000, None), (2_001, ""), (2_002, "..")]
    docs += [(2_003, written(rng, 30_000)), (2_004, "É é W1 w1 W59")]
    items = [(n, written(rng, rng.randrange(1, 30))) for n in range(40)]
    items += [(0, "w59 w58 w57"), (None, "w1 w1 w59"), (90, None), (91, ""), (92, "unknown words"), (93, "é É")]
    items += [(94, docs[7][1]), (95, written(rng, 400))]
    # Columns named as the operator's own.
    shuffled = [(text, key, -1, "x") for key, text in docs]
    rng.shuffle(shuffled)
    frame = spark.createDataFrame(shuffled, "text string, doc_id long, rank int, keys string").repartition(3)
    asked = spark.createDataFrame([(*item, 3) for item in items], "item_id long, text string, number int")
    for block_documents in (16, 10_000):
        found = ranked_search.search(frame, asked, k=7, block_documents=block_documents)
        assert collected(found) == brute(docs, items, 7)


def test_batches_and_text_keys(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "QUERY_CHARS", 60)
    rng = random.Random(2)
    docs = [(f"d{n}", written(rng, 12)) for n in range(50)]
    items = [(f"q{n}", written(rng, 6)) for n in range(9)]
    frame = spark.createDataFrame(docs, "id string, body string")
    asked = spark.createDataFrame(items, "q string, t string")
    found = ranked_search.search(frame, asked, 3, "id", "body", "q", "t")
    assert collected(found) == brute(docs, items, 3)


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")])])
def test_empty(spark, docs, items):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = ranked_search.search(frame, spark.createDataFrame(items, "item_id long, text string"))
    assert found.collect() == [] and found.columns == ["item_id", "rank", "doc_id", "score"]


# --- the bounds ---------------------------------------------------------------------------


def a_block(lists, size=50):
    names = sorted(lists)
    sizes = np.array([len(lists[name]) for name in names])
    places = np.concatenate([np.array(sorted(lists[name])) for name in names])
    impacts = np.concatenate([[lists[name][p] for p in sorted(lists[name])] for name in names])
    return Block(size, np.array(names), sizes, places, impacts.astype(np.int64))


def with_pairs(block, pairs):
    for number, pair in enumerate(pairs):
        both, joint = block.joint(pair)
        if len(both):
            block.pairs[number] = (both, int(joint.max()))
    return {pair: number for number, pair in enumerate(pairs)}


def test_candidates_are_complete_and_exact():
    rng = random.Random(4)
    for _ in range(300):
        lists = {t: {p: rng.randrange(1, 100) for p in rng.sample(range(50), rng.randrange(1, 30))} for t in range(7)}
        units = [Unit(0, 1, 3, 2), Unit(1, 2), Unit(2, 1, 9, 1), Unit(4, 1, 6, 1), Unit(5, 1)]
        block = a_block(lists)
        numbers = with_pairs(block, [unit for unit in units if unit.second >= 0])
        scores = Counter()
        for unit in units:
            for term, times in ((unit.first, unit.times), (unit.second, unit.second_times)):
                for place, impact in lists.get(term, {}).items():
                    scores[place] += times * impact
        least = rng.choice([1, 50, 150, 250, max(scores.values()), max(scores.values()) + 1])
        places, found = candidates(block, units, numbers, least)
        assert dict(zip(places.tolist(), found.tolist())) == {p: s for p, s in scores.items() if s >= least}


def test_pairs_skip_what_single_maxima_cannot(monkeypatch):
    """Two terms of large impact that never meet: together they bound a document by one of them."""
    lists = {0: {1: 90, 2: 80}, 1: {3: 85, 4: 70, 5: 1}, 2: {5: 10, 6: 9}}
    block, pair = a_block(lists), Unit(0, 1, 1, 1)
    numbers = with_pairs(block, [pair])
    looked_at = []
    impacts = Block.impacts
    monkeypatch.setattr(Block, "impacts", lambda *args: looked_at.append(args) or impacts(*args))
    # The sum of the single maxima is 185.
    assert len(candidates(block, [pair, Unit(2, 1)], numbers, 101)[0]) == 0 and not looked_at
    # Where they meet in one document, the others are not looked at.
    lists[0][5], lists[1][5] = 60, 60
    block = a_block(lists)
    numbers = with_pairs(block, [pair])
    assert [some.tolist() for some in candidates(block, [pair, Unit(2, 1)], numbers, 110)] == [[5], [130]]
    assert all(len(args[2]) == 1 for args in looked_at)
