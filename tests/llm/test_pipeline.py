"""The pipeline's stages and the registered queries."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from newsflow.llm import queries
from tests.compare import connect, difference
from tests.llm import plain
from tests.llm.test_groups import _groups
from tests.llm.test_tokens import _check_pieces

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_has_a_query():
    numbers = {name.split("_")[0] for name in queries.QUERIES}
    assert numbers == {f"op{n}" for n in range(1, 14)}
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert difference(spark, connect(FOLDER), FOLDER, queries.QUERIES[name], queries.ORACLES[name]) == ""


def test_run_keeps_what_the_stages_keep(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    labels = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    first = corpus_pipeline.drop_toxic(spark, docs, FOLDER).cache()
    second = corpus_pipeline.keep_quality(spark, first, FOLDER).cache()
    for stage in (first, second):
        assert stage.columns == corpus_pipeline.COLUMNS
    kept = [(r.doc_id, r.text) for r in second.collect()]
    clean = {i for i, x in labels.items() if x.quality == 1 and x.toxic == 0}
    assert len(clean & {i for i, _ in kept}) > 0.9 * len(clean)
    third = [(i, t) for i, t, _, _ in plain.dedup_lines(kept)]
    groups = _groups(third)
    fourth = {i: t for i, t in third if groups[i][1] == i}
    pieces = corpus_pipeline.run(spark, FOLDER).collect()
    _check_pieces(pieces, fourth, Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")))


def test_stages_take_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "the same words again and again in here"), (None, "the same words again"),
            (4, "the same words again and again in here"), (3, "the same words again and again in here"),
            (5, "word " * 40000)]
    docs = plain.documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, FOLDER)
        if name != "packing":
            assert got.columns == corpus_pipeline.COLUMNS and dict(got.dtypes) == dict(docs.dtypes)
        got.collect()
        assert stage(spark, docs.limit(0), FOLDER).collect() == []
    left = corpus_pipeline.one_of_each_group(spark, docs, FOLDER).collect()
    assert sorted((r.doc_id or 0) for r in left) == [0, 1, 2, 3, 5]


def test_extra_columns_are_left_behind(spark):
    docs = plain.documents(spark, [(1, "the same words again and again in here"), (2, None)])
    odd = docs.select("*", F.lit(1).alias("predicted"), F.lit("x").alias("mark"), F.lit(0.5).alias("score"),
                      F.lit(2).alias("component"), F.lit(3).alias("n"))
    for name, stage in corpus_pipeline.STAGES:
        got, want = (sorted(map(str, stage(spark, d, FOLDER).collect())) for d in (odd, docs))
        assert got == want, name


def test_a_group_loses_no_other_text_and_keeps_one_copy(spark):
    a, b, c = ("one two three four five six seven " + x for x in ("alpha " * 9, "beta " * 9, "gamma " * 9))
    rows = [(7, a), (7, b), (3, a), (None, a), (None, b), (9, c), (9, c), (None, "a text of its own without any copy"),
            (4, ""), (4, "")]
    left = corpus_pipeline.one_of_each_group(spark, plain.documents(spark, rows), FOLDER).collect()
    assert sorted(((r.doc_id or 0), r.text) for r in left) == sorted([
        (3, a), (7, b), (9, c), (0, "a text of its own without any copy"), (4, ""), (4, "")])
