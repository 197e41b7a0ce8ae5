import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from tests.conftest import SMALL
from tests.llm.brute import read
from tidewatch import session
from tidewatch.llm import language_model as lm
from tidewatch.llm.queries import QUERIES

END = ""


def words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lower = lower.replace(blank, " ")
    return [word for word in lower.split(" ") if word] + [END]


class Brute:
    """The same model by recursion on the definition."""

    def __init__(self, texts, order=3, share=1e-5, discount=0.5):
        runs = [words(text) for text in texts]
        self.count = Counter(
            tuple(run[i : i + n]) for run in runs for n in range(1, order + 1) for i in range(len(run) - n + 1)
        )
        self.c = Counter({g[0]: n for g, n in self.count.items() if len(g) == 1})
        self.N, self.V, self.order, self.D = sum(self.c.values()), len(self.c), order, discount
        once = sum(n == 1 for n in self.c.values())
        self.eps = min(max(once, 1) / (self.N + 1), 0.5) if self.N else 1.0
        self.kept = {g: n for g, n in self.count.items() if n >= share * self.N}
        self.after = {}
        for g in self.kept:
            self.after.setdefault(g[:-1], []).append(g[-1])
        self.known = {}

    def p(self, h, w):
        if not h:
            return (1 - self.eps) * self.c[w] / self.N if self.c[w] else self.eps
        if h not in self.after:
            return self.p(h[1:], w)
        if (*h, w) in self.kept:
            return (self.kept[(*h, w)] - self.D) / self.kept[h]
        if h not in self.known:
            kept = sum(self.p(h, v) for v in self.after[h])
            shorter = sum(self.p(h[1:], v) for v in self.after[h])
            self.known[h] = (1 - kept) / (1 - shorter)
        return self.known[h] * self.p(h[1:], w)

    def row(self, text):
        run = words(text)
        base = sum(log10((self.c[w] + 1) / (self.N + self.V + 1)) for w in run)
        total = sum(
            log10(self.p(tuple(run[max(0, i - self.order + 1) : i]), w)) for i, w in enumerate(run)
        )
        return len(run), sum(self.c[w] > 0 for w in run), self.N, base, total


def check(rows, found, **options):
    learn = [t for k, t in rows if k is None or zlib.crc32(str(k).encode()) % 7 != 2]
    brute = Brute(learn, **options)
    wanted = sorted(((str(k), brute.row(t)) for k, t in rows), key=repr)
    got = sorted(((str(r[0]), tuple(r)[2:]) for r in found), key=repr)
    assert [(k, v[:3]) for k, v in got] == [(k, v[:3]) for k, v in wanted]
    for (_, a), (_, b) in zip(got, wanted):
        assert a[3:] == pytest.approx(b[3:], rel=1e-9, abs=1e-9)
    for r in found:
        assert r.held_out == (r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2)
    return brute


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in read(spark, SMALL, "documents", "doc_id", "text")]
    found = QUERIES["op6_language_model"](spark, SMALL).collect()
    check(rows, found)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("order,share", [(1, 1e-5), (2, 0.01), (3, 0.004), (3, 0.03)])
def test_pruned_models(spark, order, share):
    rng = np.random.default_rng(order)
    vocabulary = ["the", "of", "A", "cat", "dog", "sat", "on", *(f"w{n}" for n in range(60))]
    rows = [
        (n, " ".join(rng.choice(vocabulary, p=p, size=rng.integers(0, 60))))
        for p in [np.r_[[0.1] * 7, [0.3 / 60] * 60]]
        for n in range(80)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = lm.train_and_score(df, order=order, share=share).collect()
    brute = check(rows, found, order=order, share=share)
    for history in [(), ("the",), ("the", "of"), ("never", "the")]:
        total = sum(brute.p(history, w) for w in brute.c) + brute.p(history, "unseen word")
        assert total == pytest.approx(1)


def test_chunks_do_not_matter(spark, monkeypatch):
    rows = [(n, f"Word{n % 7} and word{n % 3} again\tÄ{n}") for n in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(lm, "CHUNK_CHARS", 100)
    check(rows, lm.train_and_score(df).collect())


@pytest.mark.parametrize("rows", [
    [], [(2, "held out or not"), (2, "held out or not"), (None, None), (None, "null key"), (3, "")],
    [(1, "x " * 60000), (5, " \x0b\t\n"), (6, "\xa0nbsp stays")],
])
def test_odd_rows(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, word string, n int")
    check(rows, lm.train_and_score(df).collect())


def test_rare_grams_of_a_large_corpus_are_arcs(spark):
    """One of 300,000 tokens is far below any share of the corpus, and is counted all the same."""
    rows = [(n, "x " * 60000) for n in (1, 2, 3, 4, 5)]
    rows += [(n, f"rare{n} words{n} of a text that is there once") for n in range(10, 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, lm.train_and_score(df).collect(), share=0)


def test_model_grows_with_the_corpus(spark):
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    sizes = [[arcs.count() for arcs in lm.train(part).arcs] for part in (df.where("doc_id % 2 = 0"), df)]
    for order in range(3):
        runs = [words(r.text) for r in df.select("text").collect()]
        grams = {tuple(run[i : i + order + 1]) for run in runs for i in range(len(run) - order)}
        assert sizes[0][order] < sizes[1][order] == len(grams)


@pytest.mark.parametrize("share", [0, 0.004])
def test_chunks_and_slots_do_not_matter(spark, monkeypatch, share):
    rng = np.random.default_rng(5)
    rows = [(n % 70, " ".join(rng.choice(["a", "b", "The", "cat", f"w{n % 9}"], rng.integers(0, 30)))) for n in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(lm, "CHUNK_CHARS", 200)
    monkeypatch.setattr(lm, "SLOT_WORDS", 150)
    check(rows, lm.train_and_score(df, share=share).collect(), share=share)


def test_a_model_scores_other_rows(spark):
    learned = [(n, f"the cat sat on mat{n % 5} and the dog sat on it") for n in range(30)]
    asked = [("k", "the cat sat on the dog"), (None, None), ("k", "the dog sat on mat3 and the mat"), ("z", "")]
    model = lm.train(spark.createDataFrame(learned, "doc_id long, text string"))
    found = lm.score(spark.createDataFrame(asked, "name string, body string"), model, "name", "body").collect()
    brute = Brute([text for _, text in learned], share=0)
    got, wanted = (sorted(part, key=repr) for part in ([tuple(r) for r in found], [(k, *brute.row(t)) for k, t in asked]))
    assert [r[:4] for r in got] == [r[:4] for r in wanted]
    assert [r[4:] for r in got] == [pytest.approx(r[4:], rel=1e-9, abs=1e-9) for r in wanted]


def test_nothing_but_the_scores_stays_on_disk(spark, tmp_path, monkeypatch):
    """Texts with few repeats: their n-grams as stored rows are several times their size."""
    rng = np.random.default_rng(1)
    rows = [(n, " ".join(f"{word:x}" for word in rng.zipf(1.3, 2000) % 1_000_000)) for n in range(300)]
    documents, folder, sizes = tmp_path / "documents", tmp_path / "shared", []
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(str(documents))

    def size(top):
        return sum(file.stat().st_size for file in top.rglob("*") if file.is_file())

    def root(spark, shared):
        sizes.append(size(folder))
        return str(folder)

    folder.mkdir()
    monkeypatch.setattr(session, "_session_root", root)
    scored = lm.train_and_score(spark.read.parquet(str(documents)))
    assert max(sizes) < 2 * size(documents) and size(folder) < 0.1 * size(documents)
    assert [part.name.split("-")[0] for part in folder.iterdir()] == ["scores"]
    assert scored.count() == 300
