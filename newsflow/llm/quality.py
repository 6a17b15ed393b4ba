"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts are computed in tasks. The trees are fitted on the statistics of a bounded
sample and kept as flat arrays, a complete binary tree each, so that a batch walks all trees at once:
one array look-up per level.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from newsflow.llm.rules import STOP_WORDS
from newsflow.llm.text import names, small_batches

_STOP = frozenset(STOP_WORDS)
STATISTICS = ("log_words", "log_chars", "word_chars", "distinct_words", "distinct_pairs", "echoes",
              "capital_words", "stop_words", "lines_per_word", "distinct_lines", "exclamations", "bars",
              "symbols", "commas", "stops", "digits", "brackets", "wide")


def statistics(text: str) -> list[float]:
    """The numbers a text is judged by, in the order of STATISTICS."""
    words, lines, count = text.split(), text.split("\n"), text.count
    n, chars = max(len(words), 1), max(len(text), 1)
    return [
        np.log1p(len(words)), np.log1p(len(text)), sum(map(len, words)) / n, len(set(words)) / n,
        len(set(zip(words, words[1:]))) / n, sum(map(eq, words, words[1:])) / n,
        sum(map(str.isupper, words)) / n, sum(map(_STOP.__contains__, words)) / n, len(lines) / n,
        len(set(lines)) / len(lines), count("!") / n, count("|") / n, sum(map(count, "#*$%&@~^_")) / n,
        count(",") / n, count(".") / n, sum(map(count, "0123456789")) / chars,
        sum(map(count, "<>{}[]")) / n, 1 - len(text.encode()) / (4 * chars)]


def _matrix(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t or "") for t in texts]).reshape(-1, len(STATISTICS))


@dataclass
class Trees:
    """Flat trees: node i of a tree has the children 2i + 1 and 2i + 2; feature -1 marks a leaf."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of `x`."""
        total, (trees, nodes) = np.full(len(x), self.base), self.feature.shape
        feature, threshold = self.feature.ravel(), self.threshold.ravel()
        first, rows = np.arange(trees) * nodes, np.arange(len(x))[:, None]
        if trees and len(x):
            at = np.zeros((len(x), trees), np.int64)
            for _ in range(self.depth):
                column = feature[first + at]
                right = x[rows, np.maximum(column, 0)] > threshold[first + at]
                at = np.where(column < 0, at, 2 * at + 1 + right)
            total += self.value.ravel()[first + at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.2,
              bins: int = 64, least: float = 5.0, ridge: float = 1.0) -> Trees:
    """Boosted trees for the logistic loss, split on histograms of at most `bins` quantile bins.

    Without rows the score is 0.5; with one label only it is that label's smoothed share.
    """
    nodes = (2 << depth) - 1
    shape = (trees, nodes)
    feature, threshold, value = np.full(shape, -1), np.zeros(shape), np.zeros(shape)
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    if len(y) == 0 or y.min() == y.max():
        return Trees(base, feature[:0], threshold[:0], value[:0], depth)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for c in x.T]
    codes = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)])
    total = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, hessian = p - y, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth + 1):
            first, width = (1 << level) - 1, 1 << level
            here = at >= first
            local = at[here] - first
            g = np.bincount(local, gradient[here], width)
            h = np.bincount(local, hessian[here], width)
            value[t, first:first + width] = -rate * g / (h + ridge)
            if level == depth:
                break
            best, gain_best = np.full((width, 2), -1), np.full(width, 1e-6)
            for f, code in enumerate(codes):
                key = local * bins + code[here]
                size = width * bins
                left_g = np.bincount(key, gradient[here], size).reshape(width, bins).cumsum(1)
                left_h = np.bincount(key, hessian[here], size).reshape(width, bins).cumsum(1)
                right_g, right_h = g[:, None] - left_g, h[:, None] - left_h
                gain = (left_g ** 2 / (left_h + ridge) + right_g ** 2 / (right_h + ridge)
                        - (g ** 2 / (h + ridge))[:, None])
                gain[(left_h < least) | (right_h < least)] = 0
                gain[:, len(edges[f]):] = 0
                cut = gain.argmax(1)
                top = gain[np.arange(width), cut]
                better = top > gain_best
                gain_best[better], best[better] = top[better], np.stack([np.full(width, f), cut], 1)[better]
            for node in np.flatnonzero(best[:, 0] >= 0):
                f, cut = best[node]
                feature[t, first + node], threshold[t, first + node] = f, edges[f][cut]
                inside = at == first + node
                at[inside] = 2 * at[inside] + 1 + (codes[f][inside] > cut)
        total += value[t, at]
    return Trees(base, feature, threshold, value, depth)


def fit_quality(sample: DataFrame, **options) -> Trees:
    """Trees for a bounded sample with the columns `text` and `y`; tasks compute the statistics."""
    small_batches(sample.sparkSession)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column(1)],
                                             names=["x", "y"])

    rows = sample.select("text", "y").mapInArrow(measure, "x array<double>, y int").toArrow()
    x = np.array(rows.column("x").to_pylist(), dtype=float).reshape(-1, len(STATISTICS))
    order = np.lexsort(x.T)  # the fit does not depend on the order of the rows
    return fit_trees(x[order], rows.column("y").to_numpy().astype(float)[order], **options)


def score_quality(docs: DataFrame, model: Trees, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """`docs` with `score` (0 to 1, higher: better) and `predicted` (1 from `threshold` on).

    A null text is an empty one; rows are scored one by one. Columns named like the new ones are replaced.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    schema = docs.select(kept).schema.add("score", "double").add("predicted", "integer")
    (input_text,) = names(kept, "text")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.scores(_matrix(batch.column(len(kept)).to_pylist()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(kept)], pa.array(found),
                 pa.array((found >= threshold).astype(np.int32))], names=schema.names)

    return docs.select(*kept, docs[text].alias(input_text)).mapInArrow(score, schema)
