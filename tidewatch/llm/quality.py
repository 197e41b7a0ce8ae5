"""Quality scores from preference pairs: a Bradley-Terry model on features of the whole text.

A pair says that a document of label 1 beats one of label 0. The probability of that is the logistic
function of the difference of their scores, and a score is linear in the features, so the weights
are those of a logistic loss on feature differences. A quantile of the training scores, the
share of label 0, becomes the threshold. All labelled rows are learned from: their features are a
stored table, pairs are dealt by a join, tasks add up the loss's derivatives and only these sums
and single values come to the driver.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from tidewatch.llm.common import held_out, stored, unused
from tidewatch.llm.numbering import numbered

FEATURES = [
    "log_words", "word_length", "distinct_words", "top_word", "short_words", "log_lines",
    "repeated_lines", "upper", "lower", "digits", "beyond_ascii", "blanks", "stops", "bars",
    "loud_marks", "other_marks", "mark_runs", "upper_words", "marked_words", "plain_words",
    "doubled_words",
]

_UPPER, _LOWER, _DIGIT, _WIDE, _BLANK, _STOP, _BAR, _LOUD, _MARK = range(9)


def _classes() -> np.ndarray:
    """The class of each byte."""
    kinds = np.full(256, _MARK)
    kinds[128:] = _WIDE
    for first, last, kind in ((65, 90, _UPPER), (97, 122, _LOWER), (48, 57, _DIGIT)):
        kinds[first : last + 1] = kind
    signs = {_BLANK: b" \t\n\x0b\x0c\r", _STOP: b".,;:'\"-", _BAR: b"|", _LOUD: b"!?"}
    for kind, found in signs.items():
        kinds[list(found)] = kind
    return kinds


_KINDS = _classes()


def features(text: str) -> list[float]:
    """One number per name in ``FEATURES``; shares, so that length counts only as such."""
    data = text.encode()
    words, lines = data.split(), data.split(b"\n")
    size, count = max(len(data), 1), max(len(words), 1)
    codes = _KINDS[np.frombuffer(data, dtype=np.uint8)]
    share = np.bincount(codes, minlength=9) / size
    marks = codes >= _STOP
    runs = np.count_nonzero(marks[1:] & marks[:-1]) / size
    tally: dict[bytes, int] = {}
    for word in words:
        tally[word] = tally.get(word, 0) + 1
    upper = sum(n for word, n in tally.items() if len(word) > 1 and word.isupper())
    short = sum(n for word, n in tally.items() if len(word) <= 3)
    plain = sum(n for word, n in tally.items() if word.isalpha() or word[:-1].isalpha())
    marked = sum(n for word, n in tally.items() if len(word) > 3 and not word[-2:].isalnum())
    return [
        np.log1p(len(words)), np.log1p(len(data) / count), len(tally) / count**0.9,
        max(tally.values(), default=0) / count, short / count, np.log1p(len(lines)),
        1 - len(set(lines)) / len(lines), *share[:_STOP].tolist(), share[_STOP],
        share[_BAR], share[_LOUD], share[_MARK], runs, upper / count, marked / count,
        plain / count, sum(map(eq, words, words[1:])) / count,
    ]


def with_features(df: DataFrame, text: str = "text", out: str = "features") -> DataFrame:
    """``df`` and its features as an array of double. A null text counts as empty."""
    df = df.drop(out)
    schema = StructType([*df.schema.fields, StructField(out, ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(value.as_py() or "") for value in batch.column(text)]
            column = pa.array(found, type=pa.list_(pa.float64()))
            names = [*batch.schema.names, out]
            yield pa.RecordBatch.from_arrays([*batch.columns, column], names=names)

    return df.mapInArrow(run, schema)


@dataclass(frozen=True)
class Model:
    """Standardised linear score, moved and scaled so that ``threshold`` is the cut."""

    centre: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    cut: float
    threshold: float

    def unit(self, features: Column) -> list[Column]:
        # Beyond eight deviations a feature says no more.
        return [
            F.greatest(F.least((features[at] - c) / s, F.lit(8.0)), F.lit(-8.0))
            for at, (c, s) in enumerate(zip(self.centre, self.scale))
        ]

    def raw(self, features: Column) -> Column:
        total = F.lit(0.0)
        for unit, weight in zip(self.unit(features), self.weights):
            total = total + unit * F.lit(weight)
        return total

    def score(self, features: Column) -> Column:
        """Between 0 and 1, ``threshold`` where the raw score meets the cut."""
        shift = float(np.log(self.threshold / (1 - self.threshold)))
        return 1 / (1 + F.exp(-(self.raw(features) - self.cut + shift)))


def _undecided(bad: int, threshold: float) -> Model:
    """Nothing to compare: every document scores alike, above the cut unless all are bad."""
    width = len(FEATURES)
    cut = 1.0 if bad else -1.0
    return Model((0.0,) * width, (1.0,) * width, (0.0,) * width, cut, threshold)


def _ascend(
    sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], pairs: int, penalty: float
) -> np.ndarray:
    """The weights, by Newton's method; ``sums`` gives slope and curve of the loss over all pairs."""
    width = len(FEATURES)
    weights = np.zeros(width)
    for _ in range(50):
        slope, curve = sums(weights)
        step = np.linalg.solve(
            curve / pairs + penalty * np.eye(width), slope / pairs - penalty * weights
        )
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _derivatives(ahead: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums over some pairs' feature differences, a row each."""
    chance = 1 / (1 + np.exp(-ahead @ weights))
    return ahead.T @ (1 - chance), (ahead.T * (chance * (1 - chance))) @ ahead


def bradley_terry(
    values: np.ndarray, better: np.ndarray, pairs: int, penalty: float, threshold: float
) -> Model:
    """Fit on the few rows of ``values``; ``better`` marks label 1. Pairs are dealt evenly: the n-th
    pair takes the n-th row of either label, round and round with different strides."""
    good, bad = np.flatnonzero(better), np.flatnonzero(~better)
    if not len(good) or not len(bad):
        return _undecided(len(bad), threshold)
    centre, scale = values.mean(axis=0), values.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    unit = np.clip((values - centre) / scale, -8, 8)
    rounds = np.arange(pairs)
    left = good[rounds % len(good)]
    right = bad[(rounds + rounds // len(good)) % len(bad)]
    ahead = unit[left] - unit[right]
    weights = _ascend(lambda weights: _derivatives(ahead, weights), pairs, penalty)
    cut = np.quantile(unit @ weights, len(bad) / len(values), method="linear")
    return Model(*(tuple(map(float, x)) for x in (centre, scale, weights)), float(cut), threshold)


def fit(found: DataFrame, pairs: int, penalty: float, threshold: float) -> Model:
    """``bradley_terry`` of all rows of ``found`` (``__key, __good, features``), however many.

    There are ``pairs`` pairs, or as many as rows of the commoner label if these are more, and the
    rows of that label take turns, so every row is in a pair. Rows are numbered per label by key.
    """
    rows = numbered(found, "__good", [F.col("__key"), F.col("features")], "__at", "labelled")
    width = len(FEATURES)
    value = [F.col("features")[at] for at in range(width)]
    total, good, *moments = rows.agg(
        F.count(F.lit(1)), F.count_if("__good"), *map(F.avg, value), *map(F.stddev_pop, value)
    ).first()
    bad = total - good
    if not good or not bad:
        return _undecided(bad, threshold)
    scale = tuple(value if value > 1e-9 else 1.0 for value in moments[width:])
    model = Model(tuple(moments[:width]), scale, (0.0,) * width, 0.0, threshold)
    pairs = max(pairs, good, bad)
    leads = good >= bad
    most, fewest = (good, bad) if leads else (bad, good)
    turn = F.col("id") % most
    other = (F.col("id") + F.floor(F.col("id") / most)) % fewest
    unit = rows.select("__good", "__at", F.array(*model.unit(F.col("features"))).alias("unit"))
    sides = [
        unit.where(F.col("__good") == label).select(
            F.col("__at").alias(number), F.col("unit").alias(name)
        )
        for label, number, name in ((leads, "turn", "lead"), (not leads, "other", "rest"))
    ]
    ahead = F.zip_with("lead", "rest", lambda a, b: a - b if leads else b - a)
    dealt = (
        found.sparkSession.range(pairs).select(turn.alias("turn"), other.alias("other"))
        .join(sides[0], "turn").join(sides[1], "other").select(ahead.alias("ahead"))
    )
    dealt = stored(dealt, "pairs")
    weights = _ascend(lambda weights: _summed(dealt, weights), pairs, penalty)
    model = replace(model, weights=tuple(map(float, weights)))
    return replace(model, cut=_quantile(rows, model, total, bad / total))


def _summed(dealt: DataFrame, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_derivatives`` over all pairs; a task adds up its own."""
    width = len(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slope, curve = np.zeros(width), np.zeros((width, width))
        for batch in batches:
            ahead = np.asarray(batch.column(0).flatten()).reshape(-1, width)
            more = _derivatives(ahead, weights)
            slope, curve = slope + more[0], curve + more[1]
        flat = np.r_[slope, curve.ravel()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat))), pa.array(flat)], names=["place", "part"]
        )

    parts = dealt.mapInArrow(run, "place long, part double").groupBy("place").agg(F.sum("part"))
    flat = np.zeros(width + width * width)
    for place, part in parts.collect():
        flat[place] = part
    return flat[:width], flat[width:].reshape(width, width)


def _quantile(rows: DataFrame, model: Model, total: int, share: float) -> float:
    """The exact ``share`` quantile of the raw scores of ``total`` rows, between two neighbours in
    proportion."""
    place = share * (total - 1)
    low = int(place)
    scores = rows.select(F.lit(True).alias("all"), model.raw(F.col("features")).alias("raw"))
    ranked = numbered(scores, "all", [F.col("raw")], "rank", "ranked")
    near = dict(ranked.where(F.col("rank").isin(low, low + 1)).select("rank", "raw").collect())
    return near[low] + (near.get(low + 1, near[low]) - near[low]) * (place - low)


def train(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    folds: int = 5,
    held_fold: int = 0,
    rows: int | None = None,
    pairs: int = 40_000,
    penalty: float = 1e-3,
    threshold: float = 0.3,
) -> Model:
    """Learn from all labelled rows outside the held-out fold, by at least ``pairs`` comparisons
    (see ``fit``).

    Null labels and labels without a document are left out; a key labelled twice counts twice. Only
    where ``rows`` is given it bounds labels (the smallest hashes of the key) and the documents that
    have one, and the model is fitted on the driver.
    """
    wanted = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
        .where(~held_out(F.col(key), folds, held_fold))
        .select(F.col(key).alias("__key"), (F.col(label) == 1).alias("__good"))
    )
    names = ["__key", "__good", "features"]
    if rows is None:
        # Features before the join: it moves numbers, not texts.
        found = with_features(docs.select(F.col(key).alias("__key"), text), text).drop(text)
        return fit(found.join(wanted, "__key").select(*names), pairs, penalty, threshold)
    order = F.xxhash64("__key", F.lit(1))
    wanted = wanted.orderBy(order, "__key", "__good").limit(rows)
    labelled = docs.select(key, text).join(F.broadcast(wanted), F.col(key) == F.col("__key"))
    found = (
        with_features(labelled.select("__key", "__good", text), text)
        .select(*names)
        .orderBy(order, *names)
        .limit(rows)
        .toPandas()
        .sort_values(["__key", "__good"], kind="stable")
    )
    values = np.array(found["features"].tolist(), dtype=float).reshape(-1, len(FEATURES))
    better = found["__good"].to_numpy(dtype=bool)
    return bradley_terry(values, better, pairs, penalty, threshold)


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 at the threshold or above).

    Only ``text`` is read; an empty or null text is scored by its features like any other. Columns
    of these names are replaced, others and repeated rows pass through.
    """
    kept = df.drop("score", "predicted")
    out = unused("__features", kept)
    found = with_features(kept, text, out)
    return found.withColumn("score", model.score(F.col(out))).select(
        *kept.columns,
        "score",
        (F.col("score") >= model.threshold).cast("int").alias("predicted"),
    )
