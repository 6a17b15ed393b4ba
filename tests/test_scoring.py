"""Scorers plugged in as Python, against the native scores and on bad rows."""

import json
from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.functions import scores
from newsflow.operators import scoring

LEX = scores.Lexicon(("up", "gain"), ("down", "loss"))
load = partial(scoring.LexiconScorer, LEX)
TEXTS = ["Up, up and gain! " * 40, "down", "  ", None, "flat " * 30 + "LOSS. 'up'", "up down " * 200]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string").repartition(3)


def by_id(df):
    return {r.id: r for r in df.collect()}


def test_plugged_in_equals_native(docs):
    native = by_id(scoring.score_lexicon(docs, "text", LEX, 50, 25))
    mapped = by_id(scoring.score_map(docs, "text", load, 50, 25))
    chunks = scoring.document_chunks(F.col("text"), 50, 25)
    vector = by_id(scoring.add_scores(docs, chunks, load, "s"))
    for i, text in enumerate(TEXTS):
        if not (text or "").strip():
            assert native[i].positive_prob is None and mapped[i].finbert_sentiment is None
            assert vector[i].s.positive is None
            continue
        want = [native[i].positive_prob, native[i].neutral_prob, native[i].negative_prob]
        got = json.loads(mapped[i].finbert_sentiment)
        assert [got[x] for x in scores.LABELS] == pytest.approx(want)
        assert [vector[i].s[x] for x in scores.LABELS] == pytest.approx(want)


def test_top1_reduction(docs):
    got = by_id(scoring.score_map(docs, "text", load, 50, 25, top1=True))
    native = docs.withColumn("s", scores.top1_means(
        scores.lexicon_scores(F.col("text"), LEX, 50, 25)))
    for i, row in by_id(native).items():
        if (TEXTS[i] or "").strip():
            found = json.loads(got[i].finbert_sentiment)
            assert [found[x] for x in scores.LABELS] == pytest.approx([row.s[x] for x in scores.LABELS])


class Brittle:
    """Fails on a batch that holds a bad text."""

    def __call__(self, texts):
        if any("bad" in t for t in texts):
            raise RuntimeError("bad text")
        return np.tile([0.5, 0.25, 0.25], (len(texts), 1))


def test_bad_rows_are_kept_with_their_error(spark):
    df = spark.createDataFrame([(0, "good"), (1, "bad one"), (2, "good too")], "id int, text string").coalesce(1)
    got = by_id(scoring.score_map(df, "text", Brittle))
    assert json.loads(got[0].finbert_sentiment)["positive"] == 0.5
    assert got[1].finbert_sentiment is None and got[1].error == "RuntimeError: bad text"
    assert got[2].error is None and got[2].finbert_sentiment is not None
    labelled = by_id(scoring.score_label(df, "text", Brittle))
    assert labelled[1].sentiment_label is None and labelled[0].sentiment_label == "positive"


def test_chunks_are_scored_across_documents():
    sizes = []

    def scorer(texts):
        sizes.append(len(texts))
        return np.tile([0.2, 0.3, 0.5], (len(texts), 1))

    import pandas as pd
    out = scoring._score_documents(scorer, pd.Series([["a"] * 100, None, ["b"] * 300, []]))
    assert sizes == [256, 144]
    assert out["positive"].tolist() == [pytest.approx(0.2), None, pytest.approx(0.2), None]


def test_texts_are_taken_a_batch_at_a_time():
    taken, seen = [0], []

    def documents():
        for _ in range(8 * scoring.BATCH):
            taken[0] += 2
            yield ["up", "down"]

    def scorer(texts):
        seen.append(taken[0])
        return np.tile([0.2, 0.3, 0.5], (len(texts), 1))

    for top1 in (False, True):
        taken[0], seen[:] = 0, []
        out = scoring._score_documents(scorer, documents(), top1)
        assert seen == [scoring.BATCH * (i + 1) for i in range(16)]
        assert out["negative"].tolist() == [0.5] * (8 * scoring.BATCH)


def test_batches_of_long_texts_are_bounded(spark):
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    df = spark.createDataFrame([(1, "a b c")], "doc_id int, text string")
    for make in (scoring.score_map, scoring.score_label, scoring.score_tokens):
        spark.conf.set(limit, str(64 << 20))
        make(df, "text", load)
        assert int(spark.conf.get(limit)) <= 16 << 20


def test_top1_of_failed_and_missing_scores():
    def scorer(texts):
        if "bad" in texts:
            raise ValueError("no score")
        return np.array([[np.nan] * 3 if t == "none" else [0.7, 0.1, 0.2] for t in texts])

    out = scoring._score_documents(scorer, [["a", "none"], ["a", "bad", "bad"], None, ["none"]], top1=True)
    assert out["positive"].tolist() == [0.7, None, None, 0.0]
    assert out["neutral"].tolist() == [0.0, None, None, 0.0]
    assert out["error"].tolist() == [None, "ValueError: no score", None, None]


def test_label_cleaning_and_top1_rows(spark):
    rows = spark.createDataFrame([(1, "Positive", .9), (1, "POSITIVE", .7), (1, "negative", .8),
                                  (1, "odd", 1.0)], "id int, label string, score double")
    got = scoring.chunk_top1_means(rows, ["id"]).first()
    assert (got.positive, got.neutral, got.negative) == (pytest.approx(0.8), 0.0, 0.8)


class Pieces(scoring.LexiconScorer):
    """Tokens of three letters between two special ones."""

    def tokenise(self, text):
        if "broken" in text:
            raise ValueError("no tokens")
        return ["[", *[text[i:i + 3] for i in range(0, len(text), 3)], "]"]

    def decode(self, ids):
        return "".join(t for t in ids if t not in "[]")


def test_windows_of_tokens(spark):
    model = Pieces(LEX)
    text = "".join(f"{i:03d}" for i in range(20))
    windows = scoring.token_windows(model, text, 8, 4)
    assert windows == ["".join(f"{i:03d}" for i in range(max(0, s - 1), min(20, s + 7))) for s in (0, 4, 8, 12, 16)]
    assert scoring.token_windows(model, "abc", 8, 4) == ["abc"]
    assert scoring.token_windows(model, " ", 8, 4) == scoring.token_windows(model, None, 8, 4) == []
    rows = [(1, "some words of a text"), (2, None), (3, "broken"), (4, "")]
    df = spark.createDataFrame(rows, "doc_id int, text string")
    got = {r.doc_id: r for r in scoring.score_tokens(df, "text", partial(Pieces, LEX), 8, 4).collect()}
    assert got[1].finbert_sentiment and got[1].error is None
    assert got[3].finbert_sentiment is None and got[3].error == "ValueError: no tokens"
    assert got[2].finbert_sentiment is None and got[4].error is None


def test_only_windows_travel_to_python(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id int, text string")
    plan = scoring.score_map(df, "text", load)._jdf.queryExecution().executedPlan().toString()
    call = next(line for line in plan.splitlines() if "ArrowEvalPython" in line)
    assert "_chunks" in call.split("]")[0] and "MapInPandas" not in plan
