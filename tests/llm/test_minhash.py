import random

import numpy as np
import pytest

import corpus_pipeline
from tests.llm.brute import classes
from tests.llm.test_simhash import expected as fingerprint
from tidewatch.llm import minhash
from tidewatch.llm.components import components


def shingles(text, words=5):
    found = (text or "").lower().split()
    return {tuple(found[i : i + words]) for i in range(max(1, len(found) - words + 1))} if found else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0


def near_copies(seed, groups=12, copies=6):
    """Texts with copies of one to many changed words, so of similarities around 0.8."""
    rng = random.Random(seed)
    texts = []
    for _ in range(groups):
        first = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([3, 60, 200, 400]))]
        texts.append(" ".join(first))
        for _ in range(copies):
            words = list(first)
            for _ in range(rng.randint(0, max(1, len(words) // 30))):
                words[rng.randrange(len(words))] = f"v{rng.randrange(5000)}"
            texts.append(" ".join(words))
    return texts


@pytest.mark.parametrize("block", [3, 128])
def test_links_hold_the_same_components(spark, block):
    rows = [(n, t) for n, t in enumerate([*near_copies(block), None, "", "a", "A ", "a b"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ids = {r.doc_id: r.whole for r in df.select("doc_id", minhash.whole("text").alias("whole")).collect()}
    edges = minhash.links(df, 0.8, block=block)
    found = {row.node: row.component for row in components(edges).collect()}
    sets = {ids[n]: shingles(t) for n, t in rows}
    wanted = classes(sets, lambda a, b: jaccard(sets[a], sets[b]) >= 0.8)
    assert {n: found.get(n, n) for n in sets} == wanted
    assert len(set(wanted.values())) < len(wanted)


def test_alike_is_exact():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, 5000, dtype=np.uint64)) for _ in range(4)]
    sets += [np.arange(4, dtype=np.uint64), np.arange(5, dtype=np.uint64), sets[0][: len(sets[0]) * 8 // 10]]
    near = minhash._alike(sets, 0.8)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert near[i, j] == (jaccard(set(a.tolist()), set(b.tolist())) >= 0.8)


def test_stage_drops_near_copies_by_similarity(spark):
    texts = near_copies(7)
    df = spark.createDataFrame(
        [(n, t, "en", "s", len(t)) for n, t in enumerate(texts)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    kept = {r.doc_id for r in corpus_pipeline.without_near_copies(spark, df, "").collect()}
    sets, prints = [shingles(t) for t in texts], [fingerprint(t) for t in texts]
    bits = classes(range(len(texts)), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    both = classes(
        range(len(texts)),
        lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2 or jaccard(sets[a], sets[b]) >= 0.8,
    )
    assert kept == set(both.values())
    assert len(kept) < len(set(bits.values()))
