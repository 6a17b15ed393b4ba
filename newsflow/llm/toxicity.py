"""Toxicity: a counterfactual-regularised linear classifier over the words of whole texts.

Features are words and their first letters, present or not. Those that best tell the labels apart in a
bounded sample are kept. The logistic loss gets a penalty on the change of the score when the identity
terms of a labelled sentence are swapped, so that naming a group does not make a text toxic.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.llm.bpe import Remembered
from newsflow.llm.text import names, small_batches
from newsflow.session import written

# Terms that name groups of people, in lower case, with their inflected forms. A row has
# forms of one kind, number and language; a term is swapped for the first of its row, the first for the
# second, so these two name groups of their own.
IDENTITY_TERMS = """women men girls boys trans nonbinary
woman man girl boy
gay lesbian straight bisexual queer heterosexual
gays lesbians bisexuals queers heterosexuals
muslim christian jewish jew jude hindu buddhist atheist
muslims christians jews hindus buddhists atheists
black white asian latino latina african european arab indian
blacks whites asians latinos latinas africans europeans arabs indians
immigrant refugee foreigner citizen
immigrants refugees foreigners citizens
old young elderly teenage
older younger
oldest youngest
deaf blind disabled autistic
frauen männer männern
frau mann mannes
femmes hommes
femme homme
mujeres hombres
mujer hombre
christen juden muslime muslimen
christin jüdin muslimin muslima
christinnen jüdinnen musliminnen
christliche jüdische muslimische
christlichen jüdischen muslimischen
christlicher jüdischer muslimischer
christliches jüdisches muslimisches
christlichem jüdischem muslimischem
musulmans chrétiens juifs
musulman chrétien juif
musulmane chrétienne juive
chrétiennes juives
musulmanes cristianos judíos
musulmán cristiano judío
musulmana cristiana judía
musulmanas cristianas judías""".split("\n")

SWAPS = {term: [o for o in row.split() if o != term] for row in IDENTITY_TERMS for term in row.split()}
PREFIXES = (3, 4, 5, 6, 7, 8)
_WORD = regex.compile(r"\p{L}+")
_SENTENCE = regex.compile(r"[^.!?\n]+")


def word_features(part: str) -> tuple[str, ...]:
    """The features of what stands between two blanks: its words, and how longer words begin."""
    found = []
    for word in _WORD.findall(part.lower()):
        found.append(word)
        found += [f"{word[:n]}-" for n in PREFIXES if len(word) > n]
    return tuple(dict.fromkeys(found))


def features(text: str, known) -> set:
    """The features present in `text`; `known` gives those of a part."""
    return set().union(*map(known.__getitem__, set(text.split())))


def swapped(text: str) -> Iterator[tuple[str, str]]:
    """Each sentence of `text` that names a group, in whatever case, with one that names another."""
    if SWAPS.keys().isdisjoint(_WORD.findall(text.lower())):
        return
    for sentence in _SENTENCE.findall(text):
        words = _WORD.findall(sentence)
        swaps = [SWAPS.get(w.lower()) for w in words]
        if any(swaps):
            yield sentence, " ".join([o[0] if o else w for w, o in zip(words, swaps)])


@dataclass
class Linear:
    """Score = logistic(bias + the weights of the features present)."""

    bias: float
    weights: dict[str, float]

    def scorer(self):
        """A function from texts to probabilities; remembers the features of parts."""
        index = {f: i for i, f in enumerate(self.weights)}
        weights = np.array(list(self.weights.values()))
        known = Remembered(lambda part: tuple(index[f] for f in word_features(part) if f in index))

        def score(texts: list[str | None]) -> np.ndarray:
            total = [self.bias + weights[list(features(t or "", known))].sum()
                     if weights.size else self.bias for t in texts]
            return 1 / (1 + np.exp(-np.clip(np.array(total, dtype=float), -30, 30)))
        return score


def fit_linear(rows: list[list[int]], y: np.ndarray, pairs: list[tuple[list[int], list[int]]],
               size: int, ridge: float = 3e-5, invariance: float = 1.0, steps: int = 300,
               rate: float = 0.1) -> tuple[float, np.ndarray]:
    """Bias and weights that minimise the logistic loss, plus `ridge` times the squared weights, plus
    `invariance` times the mean squared change of the score over the counterfactual `pairs`."""
    n = max(len(rows), 1)
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.array([c for r in rows for c in r], dtype=np.int64)
    pair_at = np.repeat(np.arange(len(pairs)), [len(a) + len(b) for a, b in pairs])
    pair_column = np.array([c for a, b in pairs for c in (*a, *b)], dtype=np.int64)
    sign = np.array([s for a, b in pairs for s in [1.0] * len(a) + [-1.0] * len(b)])
    weights, share = np.zeros(size), (y.sum() + 1) / (len(y) + 2)
    bias = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return bias, weights
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        p = 1 / (1 + np.exp(-(bias + np.bincount(at, weights[column], len(rows)))))
        wrong = (p - y) / n
        slope = np.bincount(column, wrong[at], size) + 2 * ridge * weights
        if pairs:
            change = np.bincount(pair_at, sign * weights[pair_column], len(pairs))
            slope += 2 * invariance / len(pairs) * np.bincount(pair_column, sign * change[pair_at], size)
        both = np.append(slope, wrong.sum())
        first = 0.9 * first + 0.1 * both
        second = 0.99 * second + 0.01 * both ** 2
        move = rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return float(bias), weights


def _contrast(ones: int, zeros: int) -> Column:
    """Chi-square of a feature that n1 of `ones` and n0 of `zeros` texts have; null if all or none do."""
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    a, b = ones - n1, zeros - n0
    return F.try_divide((ones + zeros) * (n1 * b - n0 * a) ** 2, (n1 + n0) * (a + b) * float(ones * zeros))


def choose_features(sample: DataFrame, size: int = 2000, least: int = 5, contrast: float = 15) -> list[str]:
    """The `size` features whose presence tells the labels apart best, of those in `least` texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(word_features)
        for batch in batches:
            seen = (Counter({"": 0}), Counter({"": 0}))
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[y].update(features(text, known))
                seen[y][""] += 1  # no feature is empty: this counts the texts
            both = list({**seen[0], **seen[1]})
            yield pa.RecordBatch.from_arrays(
                [pa.array(both), *[pa.array([seen[y][f] for f in both], pa.int64()) for y in (1, 0)]],
                names=["feature", "n1", "n0"])

    counts = written(
        sample.select("text", "y").mapInArrow(count, "feature string, n1 long, n0 long")
        .groupBy("feature").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0"))
        .filter((F.col("n1") + F.col("n0") >= least) | (F.col("feature") == "")), "features")
    texts = counts.filter("feature = ''").select("n1", "n0").collect()
    if not texts:
        return []
    best = (counts.filter("feature != ''").withColumn("score", _contrast(*texts[0]))
            .filter(F.col("score") >= contrast).orderBy(F.desc("score"), "feature").limit(size))
    return [r["feature"] for r in best.select("feature").collect()]


def fit_toxicity(sample: DataFrame, **options) -> Linear:
    """The classifier for a bounded sample with the columns `text` and `y`.

    Tasks count features and turn texts into the numbers of the chosen ones; the fit sees only these.
    Without both labels the score is the smoothed share of label 1, 0.5 without rows.
    """
    small_batches(sample.sparkSession)
    sample = written(sample.select("text", "y"), "sample")
    chosen = choose_features(sample)
    index = {f: i for i, f in enumerate(chosen)}

    def numbers(text: str, known) -> list[int]:
        return sorted(features(text, known))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(lambda part: tuple(index[f] for f in word_features(part) if f in index))
        kinds = pa.list_(pa.int32())
        for batch in batches:
            y, x, other = [], [], []
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                y.append(label)
                x.append(numbers(text, known))
                other.append(None)
                for sentence, swap in swapped(text):
                    y.append(None)
                    x.append(numbers(sentence, known))
                    other.append(numbers(swap, known))
            yield pa.RecordBatch.from_arrays(
                [pa.array(y, pa.int32()), pa.array(x, kinds), pa.array(other, kinds)],
                names=["y", "x", "other"])

    rows = sample.mapInArrow(encode, "y int, x array<int>, other array<int>").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["x"], r["other"] or [], r["y"] or 0))  # whatever the partitioning
    texts = [r for r in rows if r["y"] is not None]
    pairs = [(r["x"], r["other"]) for r in rows if r["y"] is None]
    bias, weights = fit_linear([r["x"] for r in texts], np.array([r["y"] for r in texts], dtype=float),
                               pairs, len(chosen), **options)
    return Linear(bias, dict(zip(chosen, weights.tolist())))


def score_toxicity(docs: DataFrame, model: Linear, threshold: float = 0.7,
                   text: str = "text") -> DataFrame:
    """`docs` with `score` (0 to 1, higher: more toxic) and `predicted` (1 from `threshold` on).

    A null text is an empty one; rows are scored one by one. Columns named like the new ones are replaced.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    schema = docs.select(kept).schema.add("score", "double").add("predicted", "integer")
    (input_text,) = names(kept, "text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            found = scorer(batch.column(len(kept)).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(found),
                 pa.array((found >= threshold).astype(np.int32))], names=schema.names)

    return docs.select(*kept, docs[text].alias(input_text)).mapInArrow(score, schema)
