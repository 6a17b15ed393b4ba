"""Sentiment of whole texts: native lexicon scores, or a scorer plugged in as Python."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions import scores
from newsflow.functions.text import is_blank
from newsflow.session import small_batches

Scorer = Callable[[list[str]], np.ndarray]
"""A batch of chunk texts to an array (n, 3) of positive, neutral and negative probabilities."""

BATCH = 256
RESULT = "positive double, neutral double, negative double, error string"


def chunk_sliding(df: DataFrame, column: str, length: int = scores.CHUNK_LENGTH,
                  step: int = scores.CHUNK_STEP, lead: int = 0, trail: int = 0) -> DataFrame:
    """One row per window of the text: `chunk_no` and `chunk`."""
    cut = scores.windows(scores.tokens(F.col(column)), length, step, lead, trail)
    return _chunk_rows(df, column, cut)


def chunk_if_long(df: DataFrame, column: str, length: int = scores.CHUNK_LENGTH,
                  step: int = scores.CHUNK_STEP) -> DataFrame:
    """As `chunk_sliding`, but a text of up to `length` words is one chunk, as it is."""
    cut = scores.windows_if_long(scores.tokens(F.col(column)), length, step)
    joined = F.transform(cut, lambda c: F.array_join(c, " "))
    chunks = F.when(F.size(joined) > 1, joined).otherwise(F.array(F.col(column)))
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, F.posexplode(chunks).alias("chunk_no", "chunk"))


def chunk_head(df: DataFrame, column: str, length: int = scores.CHUNK_LENGTH) -> DataFrame:
    """The first `length` words as `chunk`: what a model that cuts its input would see."""
    head = F.slice(scores.tokens(F.col(column)), 1, length)
    return df.withColumn("chunk", F.array_join(head, " "))


def _chunk_rows(df: DataFrame, column: str, cut: Column) -> DataFrame:
    kept = [c for c in df.columns if c != column]
    rows = df.select(*kept, F.posexplode(cut).alias("chunk_no", "_words"))
    return rows.withColumn("chunk", F.array_join("_words", " ")).drop("_words")


def score_lexicon(df: DataFrame, column: str, lexicon: scores.Lexicon = scores.FINANCE,
                  length: int = scores.CHUNK_LENGTH, step: int = scores.CHUNK_STEP,
                  weight: float = scores.NEGATIVE_WEIGHT, only_long: bool = False) -> DataFrame:
    """Add probabilities and weighted label of a text; blank text keeps null.

    Windows are scored and averaged inside the row, so there is no exchange and no Python.
    """
    means = scores.mean_scores(scores.lexicon_scores(
        F.col(column), lexicon, length, step, only_long))
    out = df.withColumn("_scores", F.when(~is_blank(F.col(column)), means))
    out = out.select("*", F.col("_scores.negative").alias("negative_prob"),
                     F.col("_scores.neutral").alias("neutral_prob"),
                     F.col("_scores.positive").alias("positive_prob")).drop("_scores")
    return out.withColumn("sentiment_label", scores.weighted_label(
        F.col("negative_prob"), F.col("neutral_prob"), F.col("positive_prob"), weight))


# Plugged-in scorers -----------------------------------------------------------------------------

class LexiconScorer:
    """The native lexicon score for callers that want the plug-in interface."""

    def __init__(self, lexicon: scores.Lexicon):
        self.lexicon = lexicon
        self.positive = frozenset(lexicon.positive)
        self.negative = frozenset(lexicon.negative)

    def __call__(self, texts: list[str]) -> np.ndarray:
        logits = np.ones((len(texts), 3))
        for i, text in enumerate(texts):
            words = [w.strip(scores.PUNCTUATION) for w in text.lower().split()]
            share = self.lexicon.scale / max(len(words), 1)
            logits[i, 0] = share * sum(w in self.positive for w in words)
            logits[i, 2] = share * sum(w in self.negative for w in words)
        powers = np.exp(logits - logits.max(axis=1, keepdims=True))
        return powers / powers.sum(axis=1, keepdims=True)


def _probabilities(scorer: Scorer, texts: Iterable[str]) -> tuple[np.ndarray, dict[int, str]]:
    """Scores of the texts and errors by position, taking one batch of texts at a time.

    A failing batch is repeated one by one to find the culprit.
    """
    parts: list[np.ndarray] = [np.empty((0, 3))]
    errors: dict[int, str] = {}
    texts, at = iter(texts), 0
    while batch := list(islice(texts, BATCH)):
        out = np.full((len(batch), 3), np.nan)
        try:
            out[:] = scorer(batch)
        except Exception:
            out[:] = np.nan
            for i, text in enumerate(batch):
                try:
                    out[i] = scorer([text])[0]
                except Exception as problem:
                    errors[at + i] = f"{type(problem).__name__}: {problem}"
        parts.append(out)
        at += len(batch)
    return np.concatenate(parts), errors


def _mean_scores(flat: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Mean probabilities per document."""
    sums = np.zeros((len(sizes), 3))
    np.add.at(sums, owner, flat)
    with np.errstate(invalid="ignore", divide="ignore"):
        return sums / sizes[:, None]


def _top1_means(flat: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per label the mean top score of the chunks it wins, 0.0 when it wins none."""
    label, top = np.nan_to_num(flat, nan=-1.0).argmax(axis=1), flat.max(axis=1)
    found = ~np.isnan(top)
    sums, won = np.zeros((len(sizes), 3)), np.zeros((len(sizes), 3))
    np.add.at(sums, (owner[found], label[found]), top[found])
    np.add.at(won, (owner[found], label[found]), 1)
    return sums / np.maximum(won, 1)


def _score_documents(scorer: Scorer, chunk_lists: Iterable[list[str] | None],
                     top1: bool = False) -> pa.RecordBatch:
    """Reduced probabilities per document; chunks of successive documents are scored together.

    The lists are taken one by one, so of an iterator only the texts of one batch are held.
    """
    counts: list[int] = []

    def texts() -> Iterator[str]:
        for chunks in chunk_lists:
            counts.append(0 if chunks is None else len(chunks))
            if chunks is not None:
                yield from chunks

    flat, errors = _probabilities(scorer, texts())
    sizes = np.array(counts, dtype=np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    means = (_top1_means if top1 else _mean_scores)(flat, owner, sizes)
    problem: list[str | None] = [None] * len(sizes)
    for i, text in errors.items():
        problem[owner[i]] = problem[owner[i]] or text
    failed = (sizes == 0) | np.array([p is not None for p in problem], dtype=bool)
    columns = {label: pa.array(means[:, i], mask=failed | np.isnan(means[:, i]))
               for i, label in enumerate(scores.LABELS)}
    return pa.RecordBatch.from_pydict({**columns, "error": pa.array(problem, pa.string())})


def document_chunks(text: Column, length: int, step: int) -> Column:
    """Array of the chunk texts of a document."""
    return F.transform(scores.windows(scores.tokens(text), length, step),
                       lambda c: F.array_join(c, " "))


def score_udf(load: Callable[[], Scorer], top1: bool = False):
    """Vectorised UDF from an array of chunk texts to mean scores; loads the scorer once per task.

    Only the chunks travel to Python; the other columns of the row stay in the JVM. The chunks stay in
    Arrow until their document is scored.
    """
    def texts(chunks: pa.ListScalar) -> list[str] | None:
        return chunks.values.to_numpy(zero_copy_only=False).tolist() if chunks.is_valid else None

    @F.arrow_udf(RESULT)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = load()
        for chunk_lists in batches:
            yield _score_documents(scorer, map(texts, chunk_lists), top1).to_struct_array()

    return score


def add_scores(df: DataFrame, chunks: Column, load: Callable[[], Scorer], name: str,
               top1: bool = False) -> DataFrame:
    """Add the struct of mean scores of an array of chunk texts.

    The generator makes the chunks a column of their own. Without it the optimizer puts the array
    functions back into the call, and a UDF called on them may stay in the projection.
    """
    small_batches(df.sparkSession)
    cut = df.select("*", F.explode(F.array(chunks)).alias("_chunks"))
    return cut.withColumn(name, score_udf(load, top1)("_chunks")).drop("_chunks")


def _as_json(df: DataFrame) -> DataFrame:
    """The struct `_scores` as the columns `finbert_sentiment` (JSON) and `error`."""
    found = F.struct(*[F.col(f"_scores.{label}").alias(label) for label in scores.LABELS])
    kept = [c for c in df.columns if c != "_scores"]
    return df.select(*kept, F.when(F.col("_scores.positive").isNotNull(), F.to_json(found)).alias(
        "finbert_sentiment"), F.col("_scores.error").alias("error"))


def score_map(df: DataFrame, column: str, load: Callable[[], Scorer],
              length: int = scores.CHUNK_LENGTH, step: int = scores.CHUNK_STEP,
              top1: bool = False) -> DataFrame:
    """All columns plus `finbert_sentiment`, the scores of the text as JSON, and `error`.

    Blank text and text the scorer fails on keep null scores; no row is lost. `top1` reduces the
    windows by the mean score of the label each one gives, instead of the mean of all scores. Only
    the windows travel to Python.
    """
    chunks = document_chunks(F.col(column), length, step)
    return _as_json(add_scores(df, chunks, load, "_scores", top1))


def token_windows(scorer, text: str | None, length: int, step: int) -> list[str]:
    """Windows of `length` token ids, every `step`, as the texts that the tokeniser makes of them.

    `scorer.tokenise` gives the ids of a text, special tokens included, and `scorer.decode` the text of
    ids. A text without ids has no window.
    """
    ids = [] if text is None or not text.strip() else list(scorer.tokenise(text))
    starts = range(0, max(len(ids) - length, 0) + step, step) if ids else []
    return [scorer.decode(ids[at:at + length]) for at in starts if at < len(ids)]


def score_tokens(df: DataFrame, column: str, load: Callable[[], Scorer],
                 length: int = scores.CHUNK_LENGTH, step: int = scores.CHUNK_STEP,
                 top1: bool = False) -> DataFrame:
    """As `score_map`, with windows of the tokens of the model, not of words.

    What `load` returns has `tokenise` and `decode` besides the call. Only the text travels to Python, as
    the windows are cut there. A text that cannot be tokenised keeps its row and gets an error.
    """
    small_batches(df.sparkSession)

    @F.arrow_udf(RESULT)
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = load()
        for texts in batches:
            problems: list[str | None] = []

            def cut() -> Iterator[list[str]]:
                for text in texts:
                    try:
                        found, problem = token_windows(scorer, text.as_py(), length, step), None
                    except Exception as error:
                        found, problem = [], f"{type(error).__name__}: {error}"
                    problems.append(problem)
                    yield found

            found = _score_documents(scorer, cut(), top1)
            errors = [p or e for p, e in zip(problems, found["error"].to_pylist())]
            yield found.set_column(3, "error", pa.array(errors, pa.string())).to_struct_array()

    return _as_json(df.withColumn("_scores", score(F.col(column))))


def label_tokens(df: DataFrame, column: str, load: Callable[[], Scorer], length: int = scores.CHUNK_LENGTH,
                 step: int = scores.CHUNK_STEP, weight: float = scores.NEGATIVE_WEIGHT) -> DataFrame:
    """The scores of `score_tokens` as columns with the weighted label, and `error`."""
    parsed = F.from_json("finbert_sentiment", "positive double, neutral double, negative double")
    out = score_tokens(df, column, load, length, step).withColumn("_scores", parsed)
    out = out.withColumns({f"{label}_prob": F.col(f"_scores.{label}") for label in scores.LABELS})
    return out.withColumn("sentiment_label", scores.weighted_label(
        F.col("negative_prob"), F.col("neutral_prob"), F.col("positive_prob"), weight)).drop(
            "_scores", "finbert_sentiment")


def score_label(df: DataFrame, column: str, load: Callable[[], Scorer],
                length: int = scores.CHUNK_LENGTH, step: int = scores.CHUNK_STEP,
                weight: float = scores.NEGATIVE_WEIGHT, only_long: bool = True) -> DataFrame:
    """Add the weighted label and the three probabilities of a plugged-in scorer.

    With `only_long` a text of up to `length` words is scored whole, a longer one in windows.
    """
    cut = scores.windows_if_long if only_long else scores.windows
    words = cut(scores.tokens(F.col(column)), length, step)
    chunks = F.when(~is_blank(F.col(column)), F.transform(words, lambda c: F.array_join(c, " ")))
    found = add_scores(df, chunks, load, "_scores")
    p = {label: F.col(f"_scores.{label}") for label in scores.LABELS}
    label = scores.weighted_label(p["negative"], p["neutral"], p["positive"], weight)
    info = F.struct(label.alias("sentiment_label"), p["negative"].alias("negative_prob"),
                    p["neutral"].alias("neutral_prob"), p["positive"].alias("positive_prob"),
                    F.col("_scores.error").alias("error"))
    return expand_struct(found.withColumn("_info", info).drop("_scores"), "_info")


def expand_struct(df: DataFrame, column: str) -> DataFrame:
    """The fields of a struct column as columns of their own."""
    return df.select("*", f"{column}.*").drop(column)


def chunk_means(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Mean of each score over the chunk rows of a document."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def chunk_top1_means(df: DataFrame, keys: list[str], label: str = "label",
                     score: str = "score") -> DataFrame:
    """Per label the mean score of the chunk rows with that label, 0.0 without any."""
    name = scores.clean_label(F.col(label))
    return df.groupBy(*keys).agg(*[
        F.coalesce(F.avg(F.when(name == x, F.col(score))), F.lit(0.0)).alias(x)
        for x in scores.LABELS])
