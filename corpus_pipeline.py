"""From raw documents to packed windows: the stages in order, each over all that the one before kept.

Each stage is written as Parquet in the shared folder and read again, so that it is computed once and a
lost executor repeats no earlier stage. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import newsflow
from newsflow.llm import jaccard, lines, packing, quality, toxicity
from newsflow.llm.queries import fitted_quality, fitted_toxicity
from newsflow.session import written

# Python workers may be started where the package is not installed: send its functions along.
cloudpickle.register_pickle_by_value(newsflow)

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject.

    Rows are judged one by one by their text alone: a null text counts as empty, repeated rows and ids stay or go
    by their own texts, ties at the threshold are rejected. Columns beyond those of documents are left behind; an empty
    table stays empty.
    """
    scored = toxicity.score_toxicity(docs.select(COLUMNS), fitted_toxicity(spark, sf_dir))
    return scored.filter("predicted = 0").select(COLUMNS)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Nulls, repeated rows, extra columns and empty tables as in `drop_toxic`; ties at the threshold are kept.
    """
    scored = quality.score_quality(docs.select(COLUMNS), fitted_quality(spark, sf_dir))
    return scored.filter("predicted = 1").select(COLUMNS)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their repeated lines; `n_chars` follows the text, a null text becomes empty.

    All rows stay, repeated ones as well. Extra columns and empty tables as in `drop_toxic`.
    """
    done = lines.dedup_lines(docs.select(COLUMNS))
    return done.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates; all rows whose text has no words.

    The row with the smallest id stays; a null id comes last, and rows with one id are told apart by their
    texts, then by language and source. So rows that repeat an id go or stay by their own text, and of equal
    rows one stays. Extra columns and empty tables as in `drop_toxic`.
    """
    docs = docs.select(COLUMNS).withColumn("mark", F.xxhash64("text"))
    rows = written(jaccard.near_duplicates(docs).filter("component IS NOT NULL")
                   .groupBy("component", "doc_id", "mark").agg(F.count("*").alias("n")), "rows")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "mark")
    first = rows.groupBy("component").agg(F.min(place).alias("x"))
    judged = rows.join(first, "component").select("doc_id", "mark", "n", (place == F.col("x")).alias("stays"))
    # most rows are the only one of their group: the others are named, not they
    named = written(judged.filter("n > 1 OR NOT stays").select(
        F.col("doc_id").alias("id"), F.col("mark").alias("text_mark"), "stays"), "named")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("mark") == F.col("text_mark"))
    alone = docs.join(named, same, "left_anti")
    # of rows that agree in id and text one stays, whatever their number
    repeated = docs.join(named.filter("stays"), same, "left_semi").groupBy("doc_id", "mark", "text").agg(
        F.min(F.struct("lang", "source", "n_chars")).alias("x")).select("doc_id", "text", "x.*")
    return alone.select(COLUMNS).unionByName(repeated)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2048 tokens.

    A null text is an empty one and has a piece of one token; repeated rows have pieces of their own; extra
    columns are not looked at; an empty table gives no pieces.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("toxicity", drop_toxic), ("quality_classifier", keep_quality), ("line_dedup", dedup_lines),
          ("jaccard_join", one_of_each_group), ("packing", pack)]

#: SQL cannot say the classifiers, the tokenizer or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the documents of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
