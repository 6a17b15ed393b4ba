"""Quality and toxicity classifiers: held-out accuracy, odd inputs, invariance."""

import numpy as np
import pytest

from newsflow.llm import quality, queries, samples, toxicity
from tests.llm import plain

FOLDER = "/root/testdata/sf0.01"


def _area(y, score):
    rank = np.argsort(np.argsort(score))
    ones = y.sum()
    return (rank[y == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(y) - ones))


@pytest.mark.parametrize("name, label, least", [("op1_quality_classifier", "quality", 0.97),
                                                ("op9_toxicity", "toxic", 0.75)])
def test_held_out_documents_are_ranked_well(spark, name, label, least):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    scored = queries.QUERIES[name](spark, FOLDER)
    assert scored.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = scored.join(labels, "doc_id").toPandas()
    held = rows[rows.held_out]
    assert _area(held[label].to_numpy(), held.score.to_numpy()) > least
    assert rows.score.between(0, 1).all()


def test_trees_find_a_corner():
    r = np.random.default_rng(0)
    x = r.random((4000, 5))
    y = ((x[:, 1] > 0.5) & (x[:, 3] < 0.4)).astype(float)
    model = quality.fit_trees(x[:3000], y[:3000])
    assert ((model.scores(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.99


def test_flat_trees_walk_like_nested_ones():
    r = np.random.default_rng(1)
    x = r.random((300, 4))
    model = quality.fit_trees(x, (x.sum(axis=1) > 2).astype(float), trees=7, depth=3)

    def walk(tree, row):
        at = 0
        while at < len(model.feature[tree]) and model.feature[tree][at] >= 0:
            at = 2 * at + 1 + (row[model.feature[tree][at]] > model.threshold[tree][at])
        return model.value[tree][at]

    totals = [model.base + sum(walk(t, row) for t in range(7)) for row in x]
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(-np.array(totals))))


@pytest.mark.parametrize("rows", [[], [("a b", 1)], [("a b", 0), ("", 0)]])
def test_fits_without_both_labels(spark, rows):
    sample = spark.createDataFrame(rows, "text string, y int")
    docs = plain.documents(spark, [(1, None), (2, "a b c")]).withColumnRenamed("lang", "SCORE")
    for scored in (quality.score_quality(docs, quality.fit_quality(sample)),
                   toxicity.score_toxicity(docs, toxicity.fit_toxicity(sample))):
        assert scored.columns == ["doc_id", "text", "source", "n_chars", "score", "predicted"]
        assert all(0 < r.score < 1 for r in scored.collect())


def test_odd_rows_are_scored(spark):
    sample = spark.createDataFrame([("good words here", 1), ("bad !! !!", 0)] * 40, "text string, y int")
    rows = [(None, None), (1, ""), (1, ""), (2, "word " * 60000), (3, "\n\t ")]
    for scored in (quality.score_quality(plain.documents(spark, rows), quality.fit_quality(sample)),
                   toxicity.score_toxicity(plain.documents(spark, rows), toxicity.fit_toxicity(sample))):
        got = scored.collect()
        assert len(got) == 5 and len({r.score for r in got if r.text == ""}) == 1
    assert quality.score_quality(plain.documents(spark, []), quality.fit_quality(sample)).collect() == []


def test_sample_is_bounded_and_keeps_the_fold_out(spark):
    docs = plain.documents(spark, [(i, str(i)) for i in range(300)])
    labels = spark.createDataFrame([(i, i % 2, None if i % 7 == 0 else 1) for i in range(300)] + [(None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    fold = samples.fold(labels.doc_id, 5)
    got = samples.labelled_sample(docs, labels, "toxic", fold != 0, size=50).collect()
    held = {str(r.doc_id) for r in labels.filter(fold == 0).collect()}
    assert len(got) == 50 and not held & {r.text for r in got}
    assert not any(int(r.text) % 7 == 0 for r in got)
    again = samples.labelled_sample(docs.repartition(7), labels.repartition(5), "toxic", fold != 0, size=50)
    assert sorted(again.collect()) == sorted(got)


def test_swapping_identity_terms_changes_little(spark):
    insults = [(f"you are a stupid person number {i} from the muslim town", 1) for i in range(60)]
    neutral = [(f"the council of the town met {i} times", 0) for i in range(60)]
    neutral += [("the christian women met", 0)] * 3
    sample = spark.createDataFrame(insults + neutral, "text string, y int")

    def gap(model):
        score = model.scorer()
        a, b = score(["the muslim council met", "the christian council met"])
        return abs(a - b)

    loose = toxicity.fit_toxicity(sample, invariance=0.0)
    tied = toxicity.fit_toxicity(sample, invariance=10.0)
    assert gap(tied) < 0.5 * gap(loose)
    assert (tied.scorer()(["a stupid man", "the town met"]).round() == [1, 0]).all()


def test_swapped_sentences():
    pairs = list(toxicity.swapped("Plain. Some gay men sang! More"))
    assert pairs == [(" Some gay men sang", "Some lesbian women sang")]
    assert list(toxicity.swapped("")) == []


@pytest.mark.parametrize("sentence, swap", [
    ("The Muslim council met", "The christian council met"), ("JEWS and Muslims met", "muslims and christians met"),
    ("Women met", "men met"), ("Die Männer und Juden", "Die frauen und christen"),
    ("two lesbians, three immigrants", "two gays three refugees"), ("Les femmes parlent", "Les hommes parlent"),
    ("die Muslime", "die christen"), ("los judíos", "los musulmanes"), ("A Jew's house", "A muslim s house")])
def test_identity_terms_in_any_case_and_number(sentence, swap):
    assert list(toxicity.swapped(sentence)) == [(sentence, swap)]


def test_each_identity_term_has_one_row():
    terms = [t for row in toxicity.IDENTITY_TERMS for t in row.split()]
    assert len(terms) == len(set(terms)) == len(toxicity.SWAPS)
    assert all(t == t.lower() and toxicity.SWAPS[t] for t in terms)


def test_swapping_capitalised_terms_changes_little(spark):
    insults = [(f"You are a stupid person number {i} from the town of Muslims", 1) for i in range(60)]
    neutral = [(f"The council of the town met {i} times", 0) for i in range(60)]
    sample = spark.createDataFrame(insults + neutral + [("Christians met", 0)] * 5, "text string, y int")
    gaps = []
    for invariance in (0.0, 10.0):
        score = toxicity.fit_toxicity(sample, invariance=invariance).scorer()
        a, b = score(["Muslims met", "Christians met"])
        gaps.append(abs(a - b))
    assert gaps[1] < 0.5 * gaps[0]
